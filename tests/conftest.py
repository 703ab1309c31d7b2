from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])
DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        files = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{files}'")
    return con


def plain(value) -> str:
    """A value as text, the same for both engines."""
    if isinstance(value, float):
        return "nan" if value != value else repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    return "null" if value is None else str(value)


def same_rows(a: list[dict], b: list[dict]) -> None:
    """Two lists of rows are the same, whatever their order."""
    rows = [sorted("|".join(f"{k}={plain(v)}" for k, v in sorted(r.items())) for r in x) for x in (a, b)]
    assert rows[0] == rows[1]
