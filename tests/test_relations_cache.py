"""Relations by the text between mentions, and results kept by content."""

import datetime
import math

from pyspark.sql import functions as F

from graphloom.operators import relations as RL
from graphloom.plans.cache import ResultCache

PHRASES = {"works_for": ["works for", "employed by"], "lives_in": ["lives in"]}


def test_relations_by_the_words_between(spark):
    rows = [
        (1, "Alice works for Acme. Acme was sold. Bob happily lives near Paris, they say"),
        (2, "Carol is now employed in Paris by Dave."),
        (3, None),
        (4, ""),
        (5, "Alone here"),
        (6, "Left " + "x" * 150 + " works for Right"),
        (7, "Same works for works for Other"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = RL.capitalised_spans(docs, "doc_id", "text")
    places = {(r["doc_id"], r["mention"], r["start_char"], r["end_char"]) for r in spans.collect()}
    texts = dict(rows)
    assert all(texts[i][a:b] == m for i, m, a, b in places) and (1, "Paris", 60, 65) in places and len(places) == 13
    got = {(r["doc_id"], r["a"], r["b"], r["a_start"]): (r["relation"], round(r["confidence"], 6)) for r in RL.relations_by_similarity(docs, spans, "doc_id", "text", PHRASES, least=0.3).collect()}
    assert got[1, "Alice", "Acme", 0] == ("works_for", 1.0)
    lives = got[1, "Bob", "Paris", 37]
    assert lives == ("lives_in", round(1 / math.sqrt(3) / math.sqrt(2), 6))
    assert got[2, "Carol", "Dave", 0] == ("works_for", round(2 / math.sqrt(6) / 2, 6)) and got[7, "Same", "Other", 0] == ("works_for", 1.0)
    assert not [k for k in got if k[0] in (3, 4, 5, 6)]
    assert RL.relations_by_similarity(docs.limit(0), spans.limit(0), "doc_id", "text", PHRASES).count() == 0


def test_texts_are_computed_once(spark, tmp_path):
    calls = []

    def lengths(texts):
        calls.append(sorted(r["text"] for r in texts.collect()))
        return texts.filter("length(text) > 0").select("content", F.length("text").alias("n"))

    docs = spark.createDataFrame([(1, "one"), (2, "three"), (3, "one"), (4, None), (5, "")], "doc_id long, text string")
    cache = ResultCache(spark, str(tmp_path / "cache"), "v1")
    want = [(1, 3), (2, 5), (3, 3)]
    for _ in range(3):
        assert sorted(tuple(r) for r in cache.results(docs, "doc_id", "text", lengths).collect()) == want
    assert calls == [["", "one", "three"]]  # a text without a result isn't asked for again either
    more = docs.unionByName(spark.createDataFrame([(6, "seven!!"), (7, "three")], "doc_id long, text string"))
    assert sorted(tuple(r) for r in cache.results(more, "doc_id", "text", lengths).collect()) == [*want, (6, 7), (7, 5)]
    assert calls[1:] == [["seven!!"]]
    assert cache.stats().collect()[0]["texts"] == 4
    other = ResultCache(spark, str(tmp_path / "cache"), "v2")
    assert other.known() is None and other.results(docs.limit(0), "doc_id", "text", lengths).count() == 0
    assert sorted(tuple(r) for r in other.results(docs, "doc_id", "text", lengths).collect()) == want and calls[-1] == ["", "one", "three"]


def test_results_expire_and_broken_runs_leave_nothing(spark, tmp_path):
    calls = []

    def upper(texts):
        calls.append(texts.count())
        return texts.select("content", F.upper("text").alias("up"))

    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    cache = ResultCache(spark, str(tmp_path / "c"), "v", days=7)
    cache.results(docs, "doc_id", "text", upper).collect()
    # rows of a run that never marked its texts as seen
    stray = spark.createDataFrame([(r["c"], "WRONG", "zzz", "v", datetime.date.today()) for r in docs.select(F.sha2("text", 256).alias("c")).collect()], "content string, up string, run string, version string, day date")
    stray.write.mode("append").partitionBy("version", "day").parquet(f"{cache.path}/rows")
    assert sorted(tuple(r) for r in cache.results(docs, "doc_id", "text", upper).collect()) == [(1, "A"), (2, "B")] and calls == [2]
    today = datetime.date.today()
    for name in ("seen", "rows"):  # as if it had been ten days ago
        (tmp_path / "c" / name / "version=v" / f"day={today}").rename(tmp_path / "c" / name / "version=v" / f"day={today - datetime.timedelta(10)}")
    assert sorted(tuple(r) for r in cache.results(docs, "doc_id", "text", upper).collect()) == [(1, "A"), (2, "B")] and calls == [2, 2]
    assert cache.sweep(7) == 2 and cache.stats().count() == 1


def test_groups_without_a_shared_variable(spark):
    import pytest

    from graphloom.operators import triples as TR

    t = spark.createDataFrame([("a", "knows", "b"), ("b", "knows", "c"), ("c", "is", "Robot")], "s string, p string, o string")
    who = [("?x", "knows", "?y")]
    assert TR.query(t, who, exists=[[("?z", "is", "Robot")]]).count() == 2
    assert TR.query(t, who, not_exists=[[("?z", "is", "Robot")]]).count() == 0
    assert TR.query(t, who, exists=[[("?z", "is", "Human")]]).count() == 0
    assert TR.query(t, who, not_exists=[[("?z", "is", "Human")]]).count() == 2
    for bad in ({"where": [*who, ("?z", "is", "?w")]}, {"where": who, "optional": [[("?z", "is", "?w")]]}):
        with pytest.raises(ValueError, match="cross product"):
            TR.query(t, **bad)
