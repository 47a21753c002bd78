"""Sinks: Parquet under a schema, JSON lines, manifests, retention and keyed upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.sources.files import scan_inventory
from corpusmill.sources.tables import with_columns_present


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema in its order; values that don't fit their type become null, other columns go."""
    have = set(df.columns)
    return df.select(*((F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields))


def sink_parquet(df: DataFrame, path: str, schema: T.StructType | None = None, partition: str | None = None, mode: str = "overwrite") -> None:
    """ZSTD-compressed Parquet; the committer makes it appear as a whole."""
    out = (coerce(df, schema) if schema else df).write.mode(mode).option("compression", "zstd")
    (out.partitionBy(partition) if partition else out).parquet(path)


def sink_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return scan_inventory(spark, path, "*.parquet").select("path", "size", "digest")


def verify_manifest(spark: SparkSession, path: str, stored: DataFrame) -> DataFrame:
    """(path, ok) of the files of a stored manifest."""
    now = manifest(spark, path).select("path", F.col("digest").alias("now"))
    return stored.join(now, "path", "left").select("path", F.coalesce(F.col("digest") == F.col("now"), F.lit(False)).alias("ok"))


def ttl_purge(df: DataFrame, at: str, now: str, days: int) -> DataFrame:
    """Rows seen within the last `days` days; fewer than seven are refused, null times stay."""
    if days < 7:
        raise ValueError("entries are kept for at least 7 days")
    return df.where(F.col(at).isNull() | (F.col(at) >= F.lit(now).cast("timestamp") - F.expr(f"interval {days} days")))


def recompress(spark: SparkSession, source: str, target: str, schema: T.StructType) -> None:
    sink_parquet(with_columns_present(spark.read.parquet(source), schema), target, schema)


def archive_partitions(spark: SparkSession, live: str, archive: str, before: Column) -> int:
    """Move the crawl_date partitions older than a date to an archive; the number of partitions moved.

    The rows are copied, the copy is compared with the original by number and digest of its rows, and
    only then are the partition folders deleted. A difference leaves the dataset untouched and raises.
    """
    rows = spark.read.parquet(live)
    old = rows.where(F.col("crawl_date") < before)
    sink_parquet(old, archive, partition="crawl_date", mode="append")
    digest = (F.count("*").alias("n"), F.bit_xor(F.xxhash64(*rows.columns)).alias("x"))
    copied = spark.read.schema(rows.schema).parquet(archive).where(F.col("crawl_date") < before)
    if old.agg(*digest).first() != copied.select(*rows.columns).agg(*digest).first():
        raise OSError("the archive differs from the partitions it was made of")
    days = [r[0] for r in old.select("crawl_date").distinct().collect()]
    for day in days:  # one folder for each day of the calendar
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{live.rstrip('/')}/crawl_date={day}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(days)
