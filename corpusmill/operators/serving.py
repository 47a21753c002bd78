"""Full-text and vector search over DataFrames, and the index tables of the serving layer."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import batched, chain, pairwise
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.runtime import BROADCAST_BYTES, BROADCAST_ROWS, checked_broadcast, settle, ship

K1, B = 1.2, 0.75
#: Terms that a task holds before it hands them on.
HELD_TERMS = 200_000
#: Accented letters and what the index folds them to.
ACCENTS, PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def terms(text: Column) -> Column:
    """Words of the text in lower case without accents."""
    folded = F.translate(F.lower(F.coalesce(text, F.lit(""))), ACCENTS, PLAIN)
    return F.filter(F.split(folded, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def inverted_index(docs: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(term, id, col, tf). Null and empty texts have no entries; repeated ids add up."""
    words = docs.select(F.col(id_col).alias("id"), F.explode(F.array(*(F.struct(F.lit(c).alias("col"), terms(F.col(c)).alias("w")) for c in columns))).alias("x"))
    return words.select("id", "x.col", F.explode("x.w").alias("term")).groupBy("term", "id", "col").agg(F.count("*").alias("tf"))


def fts_match(index: DataFrame, every: list[str] = (), some: list[str] = (), none: list[str] = ()) -> DataFrame:
    """Ids that hold all of `every`, one of `some` and none of `none`; reads only the entries of these terms."""
    wanted = [*every, *some, *none]
    hits = index.where(F.col("term").isin(wanted)).groupBy("id").agg(F.collect_set("term").alias("t"))
    cond = F.lit(True)
    for t in every:
        cond &= F.array_contains("t", t)
    if some:
        cond &= F.size(F.array_intersect("t", F.array(*map(F.lit, some)))) > 0
    for t in none:
        cond &= ~F.array_contains("t", t)
    return hits.where(cond).select("id")


def fts_rank(index: DataFrame, query: list[str], top: int) -> DataFrame:
    """The `top` ids by BM25 (negative, best first), ties by id. Lengths and document count are one aggregation of the index."""
    lengths = index.groupBy("id").agg(F.sum("tf").alias("len"))
    stats = lengths.agg(F.count("*").alias("n"), F.avg("len").alias("avg_len"))
    hits = index.where(F.col("term").isin(query)).groupBy("term", "id").agg(F.sum("tf").alias("tf"))
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    x = hits.join(F.broadcast(df), "term").join(lengths, "id").crossJoin(F.broadcast(stats))
    idf = F.ln(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avg_len")))
    return x.groupBy("id").agg(F.round(-F.sum(part), 6).alias("rank")).orderBy("rank", "id").limit(top)


def snippet(text: Column, term: str, words: int = 20) -> Column:
    """About `words` words around the first hit, the hits marked; null without a hit."""
    w = F.split(text, r"\s+")
    key = F.transform(w, lambda x: F.translate(F.regexp_replace(F.lower(x), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""), ACCENTS, PLAIN))
    at = F.array_position(key, term)
    start = F.greatest(F.lit(1), at - words // 2).cast("int")
    part = F.transform(F.slice(w, start, F.lit(words)), lambda x: F.when(F.translate(F.regexp_replace(F.lower(x), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""), ACCENTS, PLAIN) == term, F.concat(F.lit("<b>"), x, F.lit("</b>"))).otherwise(x))
    return F.when(at > 0, F.concat(F.when(start > 1, "...").otherwise(""), F.array_join(part, " "), F.when(start + words - 1 < F.size(w), "...").otherwise("")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector is zero."""
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(n > 0, dot(a, b) / n).otherwise(0.0)


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))), F.lit(0.0), lambda s, v: s + v))


def vec_knn(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, id, distance, rank): exact nearest neighbours of a bounded query set against all vectors.

    The queries are broadcast after a count; each partition keeps its best k before the exchange.
    """
    q = checked_broadcast(queries.select(F.col("vec_id").alias("query"), F.col("embedding").alias("_q")))
    d = vectors.crossJoin(q).where("vec_id <> query").select("query", F.col("vec_id").alias("id"), F.round(l2_distance(F.col("embedding"), F.col("_q")), 6).alias("distance"))
    w = Window.partitionBy("query").orderBy("distance", "id")
    return d.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def centroids(vectors: DataFrame, key: str) -> DataFrame:
    """(key, centroid): element-wise mean of each group, by position, so that no group is gathered."""
    means = vectors.select(key, F.posexplode("embedding").alias("i", "v")).groupBy(key, "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return means.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x.v).alias("centroid"))


def index_topics(articles: DataFrame) -> DataFrame:
    """Articles and most frequent language of each topic; noise stays."""
    c = articles.where("topic is not null").groupBy("topic", "lang").agg(F.count("*").alias("n"))
    return c.groupBy("topic").agg(F.sum("n").alias("articles"), F.min_by("lang", F.struct(-F.col("n"), "lang")).alias("label")).withColumn("trend", F.lit("stable"))


def _peek(batches: Iterable[pa.RecordBatch], column: int) -> tuple[pa.DataType, Iterator[pa.RecordBatch]]:
    """The Arrow type of a column, and all batches."""
    batches = iter(batches)
    first = next(batches, None)
    return (pa.null(), iter(())) if first is None else (first.column(column).type, chain([first], batches))


def _term_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Any, Any, Counter[str]]]:
    """(id, group, counts of the one- and two-word terms) of rows (id, g, words) in the order of g and id; repeated ids add up."""
    held: tuple[Any, Any] | None = None
    tf: Counter[str] = Counter()
    for b in batches:
        for i, g, words in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            if held != (i, g):
                if held is not None:
                    yield *held, tf
                held, tf = (i, g), Counter()
            w = words.split(" ") if words else []
            tf.update(w)
            tf.update(map(" ".join, pairwise(w)))
    if held is not None:
        yield *held, tf


def tfidf_top(docs: DataFrame, id_col: str, text_col: str, group_col: str, top: int = 20, least_df: int = 2, most_share: float = 0.95, vocabulary: int = 10_000, max_terms: int = BROADCAST_ROWS) -> DataFrame:
    """(id, term, score, rank): one- and two-word terms by (1 + ln tf)(ln((1 + n) / (1 + df)) + 1), vectors of length one, by group.

    Only the texts are shuffled, to the place of their id: the terms of a document are counted and ranked
    there, as they come to many times the text. A group's vocabulary goes to every worker; where all
    groups together have more than max_terms terms or BROADCAST_BYTES, it is joined by a shuffle.
    Repeated ids of a group are one document (null ids, too), but each row counts in n.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = {n: docs.schema[c].dataType.simpleString() for n, c in (("id", id_col), ("g", group_col))}
    words = F.array_join(F.regexp_extract_all(F.lower(text_col), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0)), " ")
    base = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(group_col).alias("g"), words.alias("words"))
    placed = base.repartition("g", "id").sortWithinPartitions("g", "id")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total = defaultdict(Counter), defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for g, c in df.items():
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(c), type_g), pa.array(c.keys(), pa.string()), pa.array(c.values(), pa.int64()), pa.array([total[g][t] for t in c], pa.int64())], names=["g", "term", "df", "total"])
            df.clear()
            total.clear()

        type_g, batches = _peek(batches, 1)
        for _, g, tf in _term_counts(batches):
            df[g].update(tf.keys())
            total[g].update(tf)
            if sum(map(len, df.values())) > HELD_TERMS:
                yield from out()
        yield from out()

    n = base.groupBy("g").agg(F.count("*").alias("n"))
    df = placed.mapInArrow(count, f"g {kind['g']}, term string, df bigint, total bigint").groupBy("g", "term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
    df = df.join(n.hint("shuffle_hash"), "g")  # without the hint the terms may be broadcast, as Spark takes them to be as few as the texts
    df = df.where((F.col("df") >= F.when(most_share * F.col("n") < 2, 1).otherwise(least_df)) & (F.col("df") <= most_share * F.col("n")))
    df = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("total"), "term"))).where(F.col("r") <= vocabulary)
    df = settle(df.select("g", "term", (F.ln((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf")))

    terms, size = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    if terms > max_terms or size > BROADCAST_BYTES:
        def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            type_id, batches = _peek(batches, 0)
            type_g, batches = _peek(batches, 1)
            found = ((i, g, t, c) for i, g, tf in _term_counts(batches) for t, c in tf.items())
            for part in batched(found, HELD_TERMS):
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*part, strict=True), (type_id, type_g, pa.string(), pa.int64()), strict=True)], names=["id", "g", "term", "tf"])

        x = placed.mapInArrow(rows, f"id {kind['id']}, g {kind['g']}, term string, tf bigint").join(df.hint("merge"), ["g", "term"]).withColumn("s", (1 + F.ln("tf")) * F.col("idf"))
        x = x.withColumn("score", F.round(F.col("s") / F.sqrt(F.sum(F.col("s") * F.col("s")).over(Window.partitionBy("g", "id"))), 6))
        rank = F.row_number().over(Window.partitionBy("g", "id").orderBy(F.desc("score"), "term"))
        return x.withColumn("rank", rank).where(F.col("rank") <= top).select("id", "term", "score", "rank")

    weights = defaultdict(dict)
    for g, t, w in df.collect():
        weights[g][t] = w
    shared = spark.sparkContext.broadcast(dict(weights))

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = shared.value
        type_id, batches = _peek(batches, 0)

        def ranked() -> Iterator[tuple[Any, str, float, int]]:
            for i, g, tf in _term_counts(batches):
                known = idf.get(g, {})
                s = [(t, (1 + math.log(c)) * known[t]) for t, c in tf.items() if t in known]
                norm = math.sqrt(math.fsum(x * x for _, x in s))
                scores = sorted((-math.floor(x / norm * 1e6 + 0.5) / 1e6, t) for t, x in s)
                yield from ((i, t, -x, k) for k, (x, t) in enumerate(scores[:top], 1))

        for part in batched(ranked(), HELD_TERMS):
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*part, strict=True), (type_id, pa.string(), pa.float64(), pa.int32()), strict=True)], names=["id", "term", "score", "rank"])

    return placed.mapInArrow(best, f"id {kind['id']}, term string, score double, rank int")
