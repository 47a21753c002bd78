"""File sources: JSON lines, windows of date partitions, feeds and pages, YAML configuration, log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.sources.tables import with_columns_present


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Objects of a JSON-lines file under a declared schema; blank and malformed lines are left out."""
    marked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    rows = spark.read.schema(marked).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    return rows.where("_bad is null").drop("_bad")


def scan_window(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Rows of a dataset partitioned by crawl_date between two dates; only these partitions are listed and read."""
    return spark.read.parquet(path).where(F.col("crawl_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def window_availability(spark: SparkSession, inventory: DataFrame, last: str, days: int, essential: list[str], least_ratio: float = 0.45) -> DataFrame:
    """(day, files, complete, ratio, usable) of the window that ends at last; inventory is (day date, file string)."""
    end = F.lit(last).cast("date")
    cal = spark.range(1).select(F.explode(F.sequence(F.date_sub(end, days - 1), end)).alias("day"))
    got = inventory.groupBy("day").agg(F.collect_set("file").alias("f"))
    rows = cal.join(got, "day", "left").select("day", F.coalesce(F.size("f"), F.lit(0)).alias("files"), (F.size(F.array_except(F.array(*map(F.lit, essential)), F.coalesce("f", F.array().cast("array<string>")))) == 0).alias("complete"))
    ratio = rows.agg(F.round(F.avg(F.col("complete").cast("double")), 6).alias("ratio"))
    return rows.crossJoin(F.broadcast(ratio)).withColumn("usable", F.col("ratio") >= least_ratio)


def scan_safe(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table under its schema, or an empty one where the path can't be read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return with_columns_present(spark.read.parquet(path), schema)


def scan_latest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest crawl_date of a partitioned dataset; the maximum comes from partition values alone."""
    rows = spark.read.parquet(path)
    newest = rows.select("crawl_date").distinct().agg(F.max("crawl_date")).collect()[0][0]
    return rows.where(F.col("crawl_date") == F.lit(newest))


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, html) of whole files."""
    return spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), F.col("value").alias("html"))


def scan_log_lines(spark: SparkSession, path: str, pattern: str, names: list[str]) -> DataFrame:
    """Groups of a pattern as columns, one row for each line that matches."""
    rows = spark.read.text(path).where(F.col("value").rlike(pattern))
    return rows.select(*(F.regexp_extract("value", pattern, i).alias(n) for i, n in enumerate(names, 1)))


def scan_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, size, modified, digest) of files, with a SHA-256 digest of each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("digest"))


def scan_config(spark: SparkSession, text: str, schema: T.StructType) -> DataFrame:
    """Rows of a small YAML or JSON list as a dimension table; missing fields are null."""
    try:
        import yaml

        items = yaml.safe_load(text) or []
    except ImportError:
        import json

        items = json.loads(text)
    return spark.createDataFrame([tuple(i.get(f.name) for f in schema.fields) for i in items], schema)
