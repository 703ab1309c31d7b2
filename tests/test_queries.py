"""Every registered query of the core against its SQL."""

import pytest
from conftest import same_rows

from graphloom.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toArrow()
    if name in SQL:
        want = duck.sql(SQL[name]).to_arrow_table()
        assert {f.name: f.type for f in got.schema} == {f.name: f.type for f in want.schema}
        same_rows(got.to_pylist(), want.to_pylist())
    else:
        assert got.column_names


def test_plans_push_filters_and_prune_columns(spark, sf_dir):
    plan = QUERIES["filter_in"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "In(lang, [de,fr])" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
