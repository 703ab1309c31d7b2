"""Small helpers of the operators."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PACKAGE = Path(__file__).resolve().parent.parent


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark application, so that Arrow functions find it."""
    context = spark.sparkContext
    if getattr(context, "_graphloom_shipped", False):
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for path in sorted(_PACKAGE.rglob("*.py")):
            archive.write(path, Path("graphloom") / path.relative_to(_PACKAGE))
    target = os.path.join(tempfile.mkdtemp(prefix="graphloom"), "graphloom_src.zip")
    Path(target).write_bytes(buffer.getvalue())
    context.addPyFile(target)
    context._graphloom_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or what the context was given; in local mode without either, one below the temporary folder.

    A cluster without the setting is an error: executors can't see the driver's temporary folder.
    """
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not given:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="graphloom-checkpoint"))
        given = spark.sparkContext.getCheckpointDir()
    return given.rstrip("/")


def _paths(spark: SparkSession) -> list[str]:
    context = spark.sparkContext
    if not hasattr(context, "_graphloom_settled"):
        context._graphloom_settled = []
    return context._graphloom_settled


def settled_path(spark: SparkSession) -> str:
    """A new folder below the shared one, which drop_settled removes like the tables of settled."""
    path = f"{shared_folder(spark)}/graphloom-{uuid.uuid4().hex}"
    _paths(spark).append(path)
    return path


def settled(df: DataFrame) -> DataFrame:
    """df, written once to the shared folder: it cuts the lineage of an iteration and outlives lost executors.

    The table is needed as long as results that stem from it are read; drop_settled removes all of them,
    and superseded the one that an iteration has just left behind.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/graphloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _paths(spark).append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._graphloom_path = path
    return table


def settled_buckets(df: DataFrame, key: str, rows: int, buckets: int | None = None) -> tuple[DataFrame, int]:
    """df like settled, but dealt into buckets by a unique key, about `rows` to a bucket, and how many there are.

    Tables of as many buckets join on the key without a shuffle. With `buckets` given, df is written as its
    tasks hold it, so each should hold few buckets, as after such a join. A table stands in the session's catalog
    and in the shared folder.
    """
    spark = df.sparkSession
    if buckets is None:
        df = settled(df)
        buckets = max(1, -(-df.count() // rows))
        dealt, plain = df.repartition(buckets, key), df
    else:
        dealt, plain = df, None
    name = f"graphloom_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    _paths(spark).append(path)
    if plain is not None:
        superseded(plain)
    table = spark.table(name)
    table._graphloom_path, table._graphloom_table = path, name
    return table, buckets


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def superseded(table: DataFrame) -> None:
    """Removes a table that settled returned and that no later result reads; other tables stay."""
    spark, path = table.sparkSession, getattr(table, "_graphloom_path", None)
    if path in _paths(spark):
        if hasattr(table, "_graphloom_table"):
            spark.sql(f"DROP TABLE IF EXISTS {table._graphloom_table}")
        _delete(spark, path)
        _paths(spark).remove(path)


def drop_settled(spark: SparkSession) -> int:
    """Removes the tables that settled wrote in this application, once no result needs them; how many there were."""
    paths = _paths(spark)
    for path in paths:
        if (name := path.rsplit("/", 1)[-1]).startswith("graphloom_"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        _delete(spark, path)
    spark.sparkContext._graphloom_settled = []
    return len(paths)


#: Keys that skew_join broadcasts at most, and rows that may share a key anyway.
HEAVY_KEYS = 4096
FEW_ROWS = 400_000


def skew_join(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """rows joined with table, which has each key once and in column `weight` how many of rows have it; total: at least the sum of these.

    Keys with over total / HEAVY_KEYS rows, of which there are fewer than HEAVY_KEYS, are broadcast, and
    their rows stay where they are; the others are joined by shuffle. rows are read several times, so
    they should be settled. Up to FEW_ROWS rows are joined in the plain way.
    """
    if total <= FEW_ROWS:
        return rows.join(table, keys)
    table, bar = settled(table), total // HEAVY_KEYS
    of = F.xxhash64(*keys)
    heavy = of.isin([r[0] for r in table.filter(F.col(weight) > bar).select(of).collect()])
    light = rows.filter(~heavy).join(table.filter(~heavy), keys)
    return rows.filter(heavy).join(F.broadcast(table.filter(heavy)), keys).unionByName(light)


def common_keys(sample: DataFrame, key: str, above: int = 8) -> Column | None:
    """Whether `key` is one of those that more than `above` rows of a sample have, HEAVY_KEYS at most, those of the most rows first; None if there are none."""
    counted = sample.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > above)
    found = [r[0] for r in counted.orderBy(F.desc("_n"), key).limit(HEAVY_KEYS).select(key).collect()]
    return F.col(key).isin(found) if found else None
