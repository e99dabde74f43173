"""Quality checks: fill rates, vocabulary, partition statistics, reconciliation of two tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import present


def fill_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, filled, total): how often each column holds a value; one pass over the table."""
    one = df.agg(F.count("*").alias("total"), *[F.sum(present(c).cast("long")).alias(c) for c in columns])
    return one.unpivot(["total"], list(columns), "column_name", "filled").select("column_name", F.coalesce("filled", F.lit(0)).cast("long").alias("filled"), "total")


def vocabulary_violations(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """(column_name, value, n): known values outside a column's vocabulary (compared trimmed, in lower case)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.when(present(c) & ~F.lower(F.trim(c)).isin(*v), F.trim(c)).alias("value")) for c, v in allowed.items()])).alias("x")).select("x.*")
    return long.where("value IS NOT NULL").groupBy("column_name", "value").agg(F.count("*").alias("n"))


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that occur more than once."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """(keys, expected, observed) where two tables of counts differ; a missing side counts 0."""
    j = a.withColumnRenamed(count, "expected").join(b.withColumnRenamed(count, "observed"), list(keys), "full")
    j = j.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("expected", "observed")})
    return j.where("expected <> observed")


def partition_stats(df: DataFrame, keys: Sequence[str], distinct: Sequence[str], filled: Sequence[str]) -> DataFrame:
    """Per partition: rows, distinct known values of some columns, and filled counts of others."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        *[F.countDistinct(F.when(present(c), F.lower(F.trim(c)))).alias(f"distinct_{c}") for c in distinct],
        *[F.sum(present(c).cast("long")).alias(f"filled_{c}") for c in filled],
    )


def split_valid(df: DataFrame, key: str, required: Sequence[str], order: str) -> DataFrame:
    """Adds ``status`` (accepted, invalid, missing) and ``problems``: no key is 'missing'; a key seen before by ``order`` or a required
    value that is missing is 'invalid'. Every row is kept."""
    w = W.partitionBy(key, F.when(~present(key), F.xxhash64(order))).orderBy(order)  # rows without a key are spread
    seen = F.row_number().over(w) > 1
    problems = F.array_compact(F.array(F.when(present(key) & seen, F.lit("duplicate id")), *[F.when(~present(c), F.lit(f"no {c}")) for c in required]))
    d = df.withColumn("problems", problems)
    return d.withColumn("status", F.when(~present(key), "missing").when(F.size("problems") > 0, "invalid").otherwise("accepted"))
