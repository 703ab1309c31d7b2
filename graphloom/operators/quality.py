"""Profiles, validation, missing values and record dedup."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Texts that count as missing.
MISSING = ["", "N/A", "null", "NULL"]


def is_missing(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | c.cast("string").isin(*MISSING)


def profile(df: DataFrame) -> DataFrame:
    """A row for each column: name, kind, rows, nulls, distinct values. One pass over the data."""
    spec = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("kind"), F.count("*").alias("n_rows"), F.count_if(F.col(c).isNull()).alias("nulls"), F.countDistinct(F.col(c)).alias("n_distinct")) for c, t in df.dtypes]
    return df.agg(F.array(*spec).alias("p")).select(F.inline("p"))


def missing_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A row for each column: missing values and their share in percent."""
    columns = columns or df.columns
    spec = [F.struct(F.lit(c).alias("column_name"), F.count_if(is_missing(c)).alias("missing"), (F.count_if(is_missing(c)) * 100.0 / F.count("*")).alias("percent")) for c in columns]
    return df.agg(F.array(*spec).alias("p")).select(F.inline("p"))


def drop_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.filter(~reduce(or_, (is_missing(c) for c in columns or df.columns)))


def fill_missing(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.when(is_missing(c), F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})


def impute(df: DataFrame, columns: list[str], method: str = "mean") -> DataFrame:
    """Missing numbers become the column's mean, its upper median (the middle one, or the higher of two), or 0.

    Mean and median are found in a first pass that aggregates; the median comes from an exact
    percentile, whose state is a count for each distinct value, merged across tasks.
    """
    if method == "zero":
        return df.withColumns({c: F.coalesce(c, F.lit(0)) for c in columns})
    if method == "mean":
        found = df.agg(*(F.avg(c).alias(c) for c in columns))
    else:
        # the higher of the two middle ones is the discrete percentile just above a half
        found = df.select(*(F.expr(f"-percentile_disc(0.5) WITHIN GROUP (ORDER BY -{c})").alias(c) for c in columns))
    found = found.select(*(F.col(c).alias(f"_{c}") for c in columns))
    return df.crossJoin(F.broadcast(found)).withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*(f"_{c}" for c in columns))


def validation_errors(df: DataFrame, key: str, required: list[str] = (), kinds: dict[str, str] = {}, checks: dict[str, Column] = {}) -> DataFrame:
    """A row (key, field, problem) for each violation: required but missing, not castable, or a check that fails."""
    found = [F.when(is_missing(c), F.struct(F.lit(c).alias("field"), F.lit("required").alias("problem"))) for c in required]
    found += [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.struct(F.lit(c).alias("field"), F.lit(f"not {t}").alias("problem"))) for c, t in kinds.items()]
    found += [F.when(~c, F.struct(F.lit(n).alias("field"), F.lit("constraint").alias("problem"))) for n, c in checks.items()]
    return df.select(key, F.explode(F.array_compact(F.array(*found))).alias("e")).select(key, "e.field", "e.problem")


def number_in(c: str, low: float | None = None, high: float | None = None) -> Column:
    parts = ([F.col(c) >= low] if low is not None else []) + ([F.col(c) <= high] if high is not None else [])
    return F.coalesce(reduce(and_, parts, F.lit(True)), F.lit(True))


def text_fits(c: str, shortest: int = 0, longest: int | None = None, pattern: str | None = None, allowed: list[str] | None = None) -> Column:
    x = F.col(c)
    ok = F.length(x) >= shortest
    ok = ok & (F.length(x) <= longest) if longest is not None else ok
    ok = ok & x.rlike(pattern) if pattern else ok
    ok = ok & x.isin(*allowed) if allowed else ok
    return F.coalesce(ok, F.lit(True))


def list_fits(c: str, shortest: int = 0, longest: int | None = None, unique: bool = False) -> Column:
    ok = F.size(c) >= shortest
    ok = ok & (F.size(c) <= longest) if longest is not None else ok
    ok = ok & (F.size(F.array_distinct(c)) == F.size(c)) if unique else ok
    return F.coalesce(ok, F.lit(True))


def is_url(c: Column) -> Column:
    return c.rlike(r"^https?://[^\s/$.?#].[^\s]*$")


#: Fixed value: which texts count as an address.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def is_email(c: Column) -> Column:
    return c.rlike(EMAIL)


def valid_entity() -> Column:
    """An id, and a confidence within 0..1 if there is one."""
    return ~is_missing("id") & F.coalesce(F.col("confidence").between(0, 1), F.lit(True))


def valid_relationship() -> Column:
    return ~is_missing("src") & ~is_missing("dst") & ~is_missing("type") & F.coalesce(F.col("confidence").between(0, 1), F.lit(True))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def confidence_buckets(df: DataFrame, least: float = 0.5, high: float = 0.8) -> DataFrame:
    """One row: how many rows are at least high, at least least, or below; mean confidence."""
    c = F.col("confidence")
    return df.agg(F.count_if(c >= high).alias("high"), F.count_if((c >= least) & (c < high)).alias("medium"), F.count_if(c < least).alias("low"), F.avg(c).alias("mean_confidence"))


def exact_groups(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """df with group_first, the smallest `order` of the rows with equal keys, and group_size."""
    same = Window.partitionBy(*keys)
    return df.withColumns({"group_first": F.min(order).over(same), "group_size": F.count("*").over(same)})


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row by `order` of those with equal keys; only one row a task and key is shuffled."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def merge_records(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key: of every other field the first value, by `order`, that isn't null."""
    rest = [c for c in df.columns if c not in keys and c != order]
    pick = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest]
    return df.groupBy(*keys).agg(F.min(order).alias(order), *pick)


def metadata_filter(conditions: list[tuple[str, str, object]], any_of: bool = False) -> Column:
    """Conditions (field, eq | ne | gt | gte | lt | lte | contains | in, value); a missing field fits none, ne included."""

    def one(field: str, op: str, value: object) -> Column:
        c = F.col(field)
        test = {
            "eq": lambda: c == value,
            "ne": lambda: c != value,
            "gt": lambda: c > value,
            "gte": lambda: c >= value,
            "lt": lambda: c < value,
            "lte": lambda: c <= value,
            "contains": lambda: c.contains(value),
            "has": lambda: F.array_contains(c, value),
            "in": lambda: c.isin(*value),
        }[op]()
        return c.isNotNull() & test

    parts = [one(*x) for x in conditions]
    return reduce(or_ if any_of else and_, parts) if parts else F.lit(True)


def field_values(df: DataFrame, field: str) -> DataFrame:
    return df.groupBy(F.col(field).alias("value")).agg(F.count("*").alias("n"))


def clean(df: DataFrame, keys: list[str] | None = None, order: str | None = None) -> DataFrame:
    """Rows with missing values go, then repeats by keys."""
    rows = drop_missing(df)
    return keep_first(rows, keys or [c for c in df.columns if c != order], order) if order else rows.dropDuplicates(keys)
