"""Schema and data-quality checks; each check is one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = "check_name string, passed boolean, bad bigint"


def check_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """(column, bad): values outside the bounds, NaN included; nulls pass. All columns in one pass."""
    counts = df.agg(*(F.count_if((F.col(c) < lo) | (F.col(c) > hi) | F.isnan(F.col(c).cast("double"))).alias(c) for c, (lo, hi) in ranges.items()))
    return counts.unpivot([], list(ranges), "column_name", "bad")


def check_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, nulls, rate) in one pass."""
    n = df.agg(F.count("*").alias("_n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return n.unpivot(["_n"], columns, "column_name", "nulls").select("column_name", "nulls", F.round(F.col("nulls") / F.greatest("_n", F.lit(1)), 6).alias("rate"))


def check_keys(df: DataFrame, key: str) -> DataFrame:
    """(rows, nulls, distinct_keys, repeated)."""
    g = df.groupBy(key).agg(F.count("*").alias("n"))
    return g.agg(F.sum("n").alias("row_count"), F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("nulls"), F.count(key).alias("distinct_keys"), F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias("repeated"))


def check_schema(spark: SparkSession, df: DataFrame, expected: T.StructType) -> DataFrame:
    """(column_name, problem): missing columns, types that can't be cast safely, and extra columns."""
    have = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for f in expected.fields:
        if f.name not in have:
            rows.append((f.name, "missing"))
        elif have[f.name] != f.dataType and not (isinstance(have[f.name], T.NumericType) and isinstance(f.dataType, T.NumericType)):
            rows.append((f.name, f"{have[f.name].simpleString()} for {f.dataType.simpleString()}"))
    rows += [(n, "extra") for n in have if n not in {f.name for f in expected.fields}]
    return spark.createDataFrame(rows, "column_name string, problem string")


def check_vectors(df: DataFrame, column: str, dimension: int) -> DataFrame:
    """(total, missing, wrong_size, zero) of an array column."""
    v = F.col(column)
    return df.agg(F.count("*").alias("total"), F.count_if(v.isNull()).alias("missing"), F.count_if(F.size(v) != dimension).alias("wrong_size"), F.count_if(F.forall(v, lambda x: x == 0)).alias("zero"))


def check_foreign_keys(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(key, rows) of keys without a parent; nulls pass."""
    return df.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti").groupBy(key).agg(F.count("*").alias("n"))
