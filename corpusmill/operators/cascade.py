"""The duplicate cascade of a crawl: address, then title, then fingerprint, earlier articles first.

Levels one and two of the cascade are keys; level three pairs come from fingerprint blocks. What is
sequential (an article that is itself a duplicate never matches later ones) is resolved by rounds:
an article is settled once all earlier candidates are, and the number of rounds is the length of the
longest chain of candidates, not of the table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.runtime import settle

BITS = 10


def fingerprint_pairs(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """(a, b, bits) of rows (id, seq, simhash) with at most `bits` different bits, a earlier.

    Of bits + k blocks at least k are equal, so all choices of k blocks are keys and no pair is lost;
    k grows with the number of rows, so that a key's group stays small.
    """
    rows = rows.where("simhash <> 0").select("id", "seq", "simhash")
    n = rows.count()
    k = 1 + sum(n > limit for limit in (3_000, 200_000, 5_000_000))
    blocks = bits + k
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part = lambda i: F.shiftrightunsigned("simhash", edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))
    chosen = F.array(*(F.array(*map(F.lit, c)) for c in combinations(range(1, blocks + 1), k)))
    parts = rows.withColumn("_p", F.array(*(part(i) for i in range(blocks))))
    keys = F.transform(chosen, lambda c: F.xxhash64(c, F.transform(c, lambda i: F.element_at(F.col("_p"), i))))
    keyed = parts.select("id", "seq", "simhash", F.explode(keys).alias("k"))
    a, b = keyed.alias("a"), keyed.alias("b")
    dist = X.hamming(F.col("a.simhash"), F.col("b.simhash"))
    return a.join(b, (F.col("a.k") == F.col("b.k")) & (dist <= bits) & (F.col("a.seq") < F.col("b.seq"))).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), dist.alias("bits")).distinct()


def dedup_cascade(rows: DataFrame) -> DataFrame:
    """(id, is_duplicate, reason, match_id, level, confidence) of rows (id, seq, url_key, title_key, simhash).

    seq orders the arrival and is unique. Rows with simhash 0 aren't kept for matching titles.
    """
    # aggregates combine on the map side, so that a key of a third of the rows, or the empty one, is gathered nowhere
    first = rows.where("url_key <> ''").groupBy("url_key").agg(F.min_by("id", "seq").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    base = settle(rows.join(first, "url_key", "left").withColumn("url_match", F.when(F.col("_first") != F.col("id"), F.col("_first"))).drop("_first"))
    rest = base.where("url_match is null")
    t = rest.where("title_key <> ''").select("id", "seq", "title_key", "simhash")
    # a title's candidates are the articles kept under it; the first with a fingerprint is the earliest that can be kept
    holder = t.groupBy("title_key").agg(F.min(F.when(F.col("simhash") != 0, F.struct("seq", "id"))).alias("_h"), F.count("*").alias("_n")).where("_n > 1 and _h is not null").drop("_n")
    titles = t.join(holder, "title_key").where("_h.seq < seq").select(F.col("_h.id").alias("a"), F.col("id").alias("b"), F.lit(2).alias("level"), F.lit(1.0).alias("confidence"))
    prints = fingerprint_pairs(rest).select("a", "b", F.lit(3).alias("level"), (1 - F.col("bits") / 64).alias("confidence"))
    seqs = rest.select(F.col("id").alias("a"), F.col("seq").alias("a_seq"))
    pairs = settle(titles.union(prints).join(seqs, "a"))
    kept = settle(rest.join(pairs.select(F.col("b").alias("id")).distinct(), "id", "left_anti").select("id"))
    gone = kept.limit(0).withColumn("match_id", F.lit(None).cast(kept.schema["id"].dataType)).withColumn("level", F.lit(0)).withColumn("confidence", F.lit(0.0))
    while True:  # the earliest open article waits for none, so each round settles at least one
        settled = kept.select("id").union(gone.select("id"))
        open_pairs = pairs.join(settled.withColumnRenamed("id", "b"), "b", "left_anti")
        if open_pairs.isEmpty():
            break
        # semi and anti joins, as the estimated sizes of outer joins would multiply from round to round
        state = open_pairs.join(kept.select(F.col("id").alias("a")), "a", "left_semi").withColumn("state", F.lit("kept"))
        state = state.union(open_pairs.join(gone.select(F.col("id").alias("a")), "a", "left_semi").withColumn("state", F.lit("gone")))
        state = state.union(open_pairs.join(settled.withColumnRenamed("id", "a"), "a", "left_anti").withColumn("state", F.lit("open")))
        best = state.groupBy("b").agg(
            F.min(F.when(F.col("state") == "kept", F.struct("level", "a_seq", "a", "confidence"))).alias("hit"),
            F.min(F.when(F.col("state") == "open", F.struct("level", "a_seq"))).alias("wait"),
        )
        ready = (F.col("wait").isNull()) | (F.col("hit").isNotNull() & (F.struct("hit.level", "hit.a_seq") < F.col("wait")))
        done = settle(best.where(ready))
        gone = settle(gone.union(done.where("hit is not null").select(F.col("b").alias("id"), F.col("hit.a").alias("match_id"), F.col("hit.level").alias("level"), F.col("hit.confidence").alias("confidence"))))
        kept = settle(kept.union(done.where("hit is null").select(F.col("b").alias("id"))))
    dup = base.where("url_match is not null").select("id", F.col("url_match").alias("match_id"), F.lit(1).alias("level"), F.lit(1.0).alias("confidence")).union(gone)
    out = rows.select("id").join(dup, "id", "left")
    reason = F.element_at(F.array(F.lit("url"), F.lit("title"), F.lit("simhash")), F.col("level"))
    return out.select("id", F.col("match_id").isNotNull().alias("is_duplicate"), F.coalesce(F.when(F.col("level").isNotNull(), reason), F.lit("unique")).alias("reason"), "match_id", F.coalesce("level", F.lit(0)).alias("level"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
