"""Mixing sources to target weights.

Token totals are aggregated to cells of source, language and topic. Iterative proportional fitting
rakes the cells' weights (uses of a record) until the mix meets the source shares and keeps the
corpus's shares of languages and topics as well as the caps allow; the sources are fitted last, so
their shares hold. A record is then used floor(w) times and once more with the calibrated
probability w - floor(w), decided by the hash of its id. The one threshold of each source is taken
from a histogram of tokens by hash, so that the reached tokens meet the target and not only their
expectation. Only cells and histograms, whose sizes don't depend on the number of documents, reach
the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tokens import token_counts
from corpusmill.runtime import settle

#: Rounds of the fitting, and the change of any weight in a round from which it counts as settled.
ROUNDS = 10_000
SETTLED = 1e-6
BINS = 1 << 14
#: Cells that may reach the driver: sources x languages x topics.
MAX_CELLS = 200_000


def rake(tokens: np.ndarray, source: np.ndarray, others: list[np.ndarray], share: np.ndarray, cap: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """(weights of the cells, tokens of the mix).

    tokens, source and each of others have a value for each cell; share and cap one for each source.
    The mix is as large as the scarcest source allows at its cap. No weight exceeds its source's cap.
    Weights that don't settle are an error, as the marginals would not be what they are said to be.
    """
    n = len(share)
    have = np.bincount(source, tokens, n)
    wanted = (share > 0) & (have > 0) & (cap > 0)
    if not wanted.any():
        return np.zeros(len(tokens)), 0.0
    total = float((have[wanted] * cap[wanted] / share[wanted]).min() * share[wanted].sum())
    target = np.where(wanted, share / share[wanted].sum() * total, 0.0)
    limit = np.where(wanted, cap, 0)[source].astype(float)
    natural = [np.bincount(o, tokens * wanted[source]) for o in others]
    natural = [m / m.sum() * total for m in natural]
    w = np.minimum((target / np.maximum(have, 1e-300))[source], limit)
    for _ in range(rounds):
        before = w.copy()
        for o, goal in zip(others, natural, strict=True):
            now = np.bincount(o, w * tokens, len(goal))
            w = np.minimum(w * np.where(now > 0, goal / np.maximum(now, 1e-300), 1.0)[o], limit)
        w = _fit_capped(w, tokens, source, target, limit)
        if np.abs(w - before).max() < SETTLED:
            return w, total
    raise ArithmeticError(f"the weights still change by {np.abs(w - before).max():.2g} after {rounds} rounds")


def _fit_capped(w: np.ndarray, tokens: np.ndarray, group: np.ndarray, target: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Scale the weights within each group to its target, passing on what the cap cuts off."""
    for _ in range(50):
        now = np.bincount(group, w * tokens, len(target))
        free = w < limit * (1 - 1e-12)
        room = np.bincount(group, w * tokens * free, len(target))
        lack = target - now
        if (np.abs(lack) <= 1e-9 * np.maximum(target, 1)).all():
            break
        up = np.where((lack > 0) & (room > 0), 1 + lack / np.maximum(room, 1e-300), 1.0)
        down = np.where(lack < 0, target / np.maximum(now, 1e-300), 1.0)
        w = np.minimum(w * np.where(free, up[group], 1.0) * down[group], limit)
    return w


@dataclass
class Mix:
    """records: (id, source, n_tokens, copies), copies > 0; shares: one row for each target source."""

    records: DataFrame
    shares: DataFrame


def mix_sources(docs: DataFrame, targets: DataFrame, topics: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_key: str = "item_id", topic_col: str = "category", vocabulary: str | None = None) -> Mix:
    """Choose how often each record is used.

    targets has source, target_share and max_repeats; topics maps topic_key to topic_col. Records of
    other or null sources and records without tokens (null and empty texts) aren't used; a null
    language or topic is a value of its own; languages are compared in lower case. Repeated rows are
    records of their own that are decided alike. A source without records keeps actual share 0 and
    the others share the rest in proportion. Empty tables give an empty mix.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(source_col).alias("_source"), F.lower(F.coalesce(F.col(lang_col), F.lit(""))).alias("_lang"), F.col(topic_key).alias("_key"))
    if topics is not None:
        dim = topics.select(F.col(topic_key).alias("_key"), F.col(topic_col).alias("_topic")).dropDuplicates(["_key"])
        rows = rows.join(dim, "_key", "left")
    else:
        rows = rows.withColumn("_topic", F.lit(None).cast("string"))
    rows = rows.withColumn("_topic", F.coalesce("_topic", F.lit("")))
    asked_for = targets.select("source", "target_share", "max_repeats").where("source is not null").limit(MAX_CELLS + 1).collect()
    if len(asked_for) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} sources with a target")
    plan = {r[0]: (float(r[1] or 0), int(r[2] or 0)) for r in asked_for}
    names = sorted(plan)
    counted = token_counts(rows.where(F.col("_source").isin(names)).where("_text is not null and _text <> ''"), "_text", vocabulary)
    counted = settle(counted.where("n_tokens > 0").select("_id", "_source", "_lang", "_topic", "n_tokens", ((F.xxhash64("_id").bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))).alias("_u")))
    cells = counted.groupBy("_source", "_lang", "_topic").agg(F.sum("n_tokens")).limit(MAX_CELLS + 1).collect()
    if len(cells) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells of source, language and topic")
    cells.sort(key=lambda r: r[:3])
    tokens = np.array([r[3] for r in cells], float)
    code = {n: i for i, n in enumerate(names)}
    axes = [np.unique([r[k] for r in cells], return_inverse=True)[1] if cells else np.zeros(0, int) for k in (1, 2)]
    share, cap = (np.array([plan[n][k] for n in names], float) for k in (0, 1))
    source = np.array([code[r[0]] for r in cells], int)
    w, total = rake(tokens, source, axes, share, cap)
    table = spark.createDataFrame([(*r[:3], float(x)) for r, x in zip(cells, w, strict=True)], "_source string, _lang string, _topic string, _w double")
    whole = F.floor(F.col("_w") + F.lit(1e-9))
    weighted = counted.join(F.broadcast(table), ["_source", "_lang", "_topic"]).withColumn("_base", whole).withColumn("_r", F.when(F.col("_w") - whole > 1e-9, F.col("_u") / (F.col("_w") - whole)))
    # tokens by source and position of the threshold; r < 1 in expectation, up to 2 to allow for sampling noise
    hist = weighted.groupBy("_source", F.when(F.col("_r") < 2, F.floor(F.col("_r") * BINS / 2)).cast("int").alias("_bin")).agg(F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens") * F.col("_base")).alias("base")).collect()
    wanted = np.where((np.bincount(source, tokens, len(names)) > 0) & (share > 0) & (cap > 0), share, 0)
    goal = wanted / max(wanted.sum(), 1e-300) * total
    cut = []
    for n in names:
        extra, base = np.zeros(BINS), 0.0
        for r in hist:
            if r[0] == n:
                base += r[3]
                if r[1] is not None:
                    extra[r[1]] += r[2]
        reached = base + np.concatenate([[0], np.cumsum(extra)])
        cut.append((n, float(np.argmin(np.abs(reached - goal[code[n]]))) * 2 / BINS))
    cuts = spark.createDataFrame(cut, "_source string, _cut double")
    used = weighted.join(F.broadcast(cuts), "_source").withColumn("copies", (F.col("_base") + F.when(F.col("_r") < F.col("_cut"), 1).otherwise(0)).cast("int"))
    records = used.where("copies > 0").select(F.col("_id").alias(id_col), F.col("_source").alias("source"), "n_tokens", "copies")
    got = records.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("records"), F.max("copies").alias("most_repeats"))
    asked = targets.where("source is not null").select("source", F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats"))
    shares = asked.join(got, "source", "left").select(
        "source",
        "target_share",
        (F.coalesce("tokens", F.lit(0)) / F.greatest(F.sum(F.coalesce("tokens", F.lit(0))).over(_all()), F.lit(1))).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"),
        F.coalesce("records", F.lit(0)).cast("long").alias("records"),
        F.coalesce("most_repeats", F.lit(0)).cast("int").alias("most_repeats"),
        "max_repeats",
    )
    return Mix(records, shares)


def _all():
    from pyspark.sql import Window

    return Window.partitionBy()
