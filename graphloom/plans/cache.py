"""Results by content: what was computed for a text once isn't computed again for the same text."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators.frames import settled


@dataclass
class ResultCache:
    """Tables below `path`: seen(content, run) says which texts were handled by which run, and rows has what came out.

    Both are partitioned by version and day. Rows are written before the texts are marked as seen, and only rows of runs that
    were marked count, so a run that broke off leaves nothing that is read. version names the method and its parameters; days is how
    long results hold (None: for ever). Two runs at once may both compute a text, of which the one with the smaller name counts.
    """

    spark: SparkSession
    path: str
    version: str
    days: int | None = None

    def _table(self, name: str) -> DataFrame | None:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/version={self.version}")
        if not target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
            return None
        rows = self.spark.read.option("basePath", f"{self.path}/{name}").parquet(str(target.toString()))
        rows = rows.withColumn("day", F.col("day").cast("date"))
        return rows.filter(F.col("day") > F.date_sub(F.current_date(), self.days)) if self.days is not None else rows

    def known(self) -> DataFrame | None:
        """(content, run): one run for each text that was handled and still holds."""
        seen = self._table("seen")
        return seen.groupBy("content").agg(F.min("run").alias("run")) if seen is not None else None

    def results(self, docs: DataFrame, key: str, text: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """compute's rows for all docs, with `key` in place of content.

        compute takes (content, text), each text once, and returns rows with content. It is given only texts that the cache lacks, and isn't called if there
        are none. Null texts have no rows. Documents may share a text; each gets its rows.
        """
        asked = docs.select(F.col(key).alias("_key"), F.sha2(F.col(text), 256).alias("content"), F.col(text).alias("text")).filter("text is not null")
        distinct = asked.groupBy("content").agg(F.first("text").alias("text"))
        known = self.known()
        missing = settled(distinct if known is None else distinct.join(known.select("content"), "content", "left_anti"))
        if not missing.isEmpty():
            run, day = F.lit(uuid.uuid4().hex), F.current_date()
            found = compute(missing.select("content", "text"))
            for name, rows in (("rows", found), ("seen", missing.select("content"))):
                stamped = rows.withColumns({"run": run, "version": F.lit(self.version), "day": day})
                stamped.write.mode("append").partitionBy("version", "day").parquet(f"{self.path}/{name}")
        known, rows = self.known(), self._table("rows")
        if known is None or rows is None:
            return compute(missing.select("content", "text")).join(asked.select("_key", "content"), "content").withColumnRenamed("_key", key).drop("content")
        held = rows.drop("version", "day").join(known, ["content", "run"]).drop("run")
        return asked.select("_key", "content").join(held, "content").withColumnRenamed("_key", key).drop("content")

    def stats(self) -> DataFrame:
        """(day, texts): how many texts of this version were handled on each day and still hold."""
        seen = self._table("seen")
        if seen is None:
            return self.spark.createDataFrame([], "day date, texts long")
        return seen.groupBy("day").agg(F.countDistinct("content").alias("texts"))

    def sweep(self, keep: int) -> int:
        """Removes the folders of days more than `keep` days ago, of this version; how many there were. Marks go before rows."""
        gone = 0
        oldest = self.spark.range(1).select(F.date_sub(F.current_date(), keep).cast("string")).first()[0]
        for name in ("seen", "rows"):
            target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/version={self.version}")
            store = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            for entry in store.listStatus(target) if store.exists(target) else ():
                day = entry.getPath().getName().removeprefix("day=")
                if day < oldest:
                    store.delete(entry.getPath(), True)
                    gone += 1
        return gone
