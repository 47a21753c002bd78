"""Joins, deduplication, set and ranking operators in the forms that the analytic pipeline uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.runtime import checked_broadcast


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in the order; the order must be total for a repeatable result."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def join_left_first(left: DataFrame, right: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Left join that keeps the first match for each key; columns of right that left has too are dropped."""
    right = first_by(right, [key], order)
    return left.join(right.drop(*(c for c in right.columns if c in left.columns and c != key)), key, "left")


def join_lookup(df: DataFrame, dim: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """value of a small dimension for each row, or the default; broadcast only after a count."""
    return df.join(checked_broadcast(dim.select(key, value).dropDuplicates([key])), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def mode_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent value of each key, the least one on ties; nulls don't count."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return first_by(df, keys, [c.desc_nulls_last() for c in order])


def upsert(old: DataFrame, new: DataFrame, key: str, replace: bool) -> DataFrame:
    """Rows of both with one for each key: new ones replace old ones, or are ignored."""
    return (old.join(new, key, "left_anti") if replace else old).unionByName(new if replace else new.join(old, key, "left_anti"))


def topk_group(df: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= k)


def range_join(left: DataFrame, right: DataFrame, key: str, at: str, hours: float) -> DataFrame:
    """Pairs of the same key with right.at within `hours` after left.at: an equi-join on time buckets, each pair once."""
    width = int(hours * 3600)
    bucket = lambda c: F.floor(F.unix_timestamp(c) / width)
    a = left.withColumn("_b", F.explode(F.array(bucket(F.col(at)), bucket(F.col(at)) + 1))).alias("a")
    b = right.withColumn("_b", bucket(F.col(at))).alias("b")
    near = (F.unix_timestamp(F.col(f"b.{at}")) - F.unix_timestamp(F.col(f"a.{at}"))).between(0, width)
    return a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a._b") == F.col("b._b")) & near)


def asof_join(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """The last right value at or before each left row: one sort of the union, no pairs."""
    a = left.withColumn("_side", F.lit(1)).withColumn("_v", F.lit(None).cast(right.schema[value].dataType))
    b = right.select(F.col(key), F.col(at), F.col(value).alias("_v")).withColumn("_side", F.lit(0))
    both = a.unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("_v", ignorenulls=True).over(w)).where("_side = 1").drop("_side", "_v")
