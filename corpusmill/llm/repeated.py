"""Lines repeated across one source's documents.

Normalised lines are hashed together with their source, the distinct documents of each hash are
counted with map-side combining, and hashes above the share are joined back. Only 64-bit hashes are
shuffled for counting, never line texts. At most (lines per document) / min_share lines of a source
can reach the share, so the joined-back side is small; it is broadcast only after a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import checked_broadcast, settle

MIN_SHARE = 0.02
MIN_DOCUMENTS = 4


def normalised_lines(body: Column) -> Column:
    """Array of the body's lines: lower case, white-space runs as one space and none at the ends, digit runs as 0."""
    text = F.regexp_replace(F.regexp_replace(F.lower(body), "[0-9]+", "0"), r"[\p{IsWhite_Space}&&[^\n]]+", " ")
    return F.transform(F.split(text, "\n", -1), lambda x: F.trim(x))


def _hashed(docs: DataFrame, id_col: str, source_col: str, body_col: str) -> DataFrame:
    """(id, h array): hash of each line with its source, null for empty lines."""
    source = F.coalesce(F.col(source_col), F.lit("\u0000"))
    return docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(source).alias("_s"),
        F.transform(normalised_lines(F.col(body_col)), lambda x: F.when(x != "", F.xxhash64(source, x))).alias("_h"),
    )


def frequent_lines(docs: DataFrame, id_col: str = "article_id", source_col: str = "source", body_col: str = "body", min_share: float = MIN_SHARE, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(_h, n_docs): line hashes that stand in enough distinct documents of their source."""
    doc = F.xxhash64(F.col(id_col))
    totals = docs.select(F.xxhash64(F.coalesce(F.col(source_col), F.lit("\u0000"))).alias("_s"), doc.alias("_d")).groupBy("_s").agg(F.count_distinct("_d").alias("total"))
    lines = _hashed(docs.where(F.col(body_col).isNotNull()), id_col, source_col, body_col)
    lines = lines.select("_s", F.xxhash64("_id").alias("_d"), F.explode(F.array_distinct("_h")).alias("_h")).where("_h is not null")
    counts = lines.groupBy("_h").agg(F.count_distinct("_d").alias("n_docs"), F.first("_s").alias("_s")).where(F.col("n_docs") >= min_documents)
    return counts.join(totals, "_s").where(F.col("n_docs") >= F.col("total") * F.lit(min_share)).select("_h", "n_docs")


def repeated_lines(docs: DataFrame, id_col: str = "article_id", source_col: str = "source", body_col: str = "body", min_share: float = MIN_SHARE, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Distinct (id, line_no int) of the non-empty lines repeated within their source.

    A null source is a source of its own; null and empty bodies have no lines but count in the
    source's total; repeated rows count as one document; an empty table gives no rows; other columns
    of docs are not read.
    """
    often = checked_broadcast(settle(frequent_lines(docs, id_col, source_col, body_col, min_share, min_documents)).select("_h"))
    lines = _hashed(docs.where(F.col(body_col).isNotNull()), id_col, source_col, body_col)
    lines = lines.select("_id", F.posexplode("_h").alias("_p", "_h")).where("_h is not null")
    found = lines.join(often, "_h", "left_semi")
    return found.select(F.col("_id").alias(id_col), (F.col("_p") + 1).alias("line_no")).distinct()


def without_repeated_lines(docs: DataFrame, id_col: str = "article_id", source_col: str = "source", body_col: str = "body", min_share: float = MIN_SHARE, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """docs with a column clean_body: the body without its repeated lines; null where body is null.

    The few frequent hashes of each source travel as one array per source (bounded by lines per
    document / min_share), so rows aren't exploded or regrouped. Row count and other columns stay.
    """
    source = F.coalesce(F.col(source_col), F.lit("\u0000"))
    often = settle(frequent_lines(docs, id_col, source_col, body_col, min_share, min_documents)).select("_h")
    keyed = _hashed(docs.where(F.col(body_col).isNotNull()), id_col, source_col, body_col).select("_s", F.explode(F.array_distinct("_h")).alias("_h"))
    sets = keyed.join(checked_broadcast(often), "_h", "left_semi").groupBy("_s").agg(F.collect_set("_h").alias("_often"))
    rows = docs.drop("clean_body").withColumn("_s", F.xxhash64(source)).join(checked_broadcast(settle(sets)), "_s", "left")
    kept = F.zip_with(
        F.split(F.col(body_col), "\n", -1),
        F.transform(normalised_lines(F.col(body_col)), lambda x: F.xxhash64(source, x)),
        lambda line, h: F.when(~F.array_contains(F.col("_often"), h), line),
    )
    return rows.withColumn("clean_body", F.when(F.col("_often").isNull(), F.col(body_col)).otherwise(F.array_join(kept, "\n"))).drop("_s", "_often")
