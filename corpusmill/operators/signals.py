"""Layered signals on topic features: composite score, layer, confidence and evidence, as expressions.

Features of a topic are columns; missing ones count as 0 or false. The highest layer whose
conditions hold wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weights of the composite and conditions of the layers.
WEIGHTS = {"ood": 0.20, "changepoint": 0.15, "cross_domain": 0.20, "transition": 0.15, "entropy_spike": 0.10, "novelty": 0.10, "network": 0.10}
DOMAINS = 6
FEATURES = ("ood", "changepoint", "domains", "transition", "entropy_spike", "novelty", "network", "drift", "period", "modularity_delta", "days_above_ma", "zscore", "burst", "span_days", "n_sources")
FLAGS = ("frame_shift", "frame_divergence", "mood_shift")


def _f(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _clamp(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def composite() -> Column:
    values = {"cross_domain": _f("domains") / DOMAINS}
    parts = [w * _clamp(values.get(k, _f(k) if k not in values else values[k])) for k, w in WEIGHTS.items()]
    return _clamp(sum(parts[1:], parts[0]))


def pathways() -> tuple[Column, Column, Column]:
    a = (_f("ood") > 0.7) | (_f("novelty") > 0.7)
    b = (_f("changepoint") > 0.8) & ((_f("entropy_spike") > 0.5) | (_f("network") > 0.5))
    c = (_f("transition") == 1) & (_f("domains") / DOMAINS > 0.3)
    return a, b, c


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def layer() -> Column:
    n = sum((p.cast("int") for p in pathways()[1:]), pathways()[0].cast("int"))
    return (
        F.when((_f("novelty") > 0.7) & (_f("domains") >= 2) & (composite() >= 0.65) & (n >= 2), "L5_singularity")
        .when((_f("drift") > 0.3) & (_f("period") > 90) & _flag("frame_shift") & (_f("span_days") >= 365), "L4_long")
        .when((_f("changepoint") > 0.8) & (_f("modularity_delta") > 0.1) & _flag("frame_divergence") & (_f("span_days") >= 90), "L3_mid")
        .when((_f("days_above_ma") >= 7) & (F.col("ma_signal") == "rising") & _flag("mood_shift") & (_f("span_days") >= 14), "L2_short")
        .when((_f("zscore") > 3) & (_f("burst") > 2), "L1_fad")
        .otherwise("")
    )


def confidence() -> Column:
    n = sum((p.cast("int") for p in pathways()[1:]), pathways()[0].cast("int"))
    add = lambda cond, x: F.when(cond, x).otherwise(0.0)
    lay = F.col("layer")
    c = (
        F.when(lay == "L1_fad", 0.4 + add(_f("n_sources") > 1, 0.2) + add(_f("domains") > 1, 0.1) - add(_f("n_sources") <= 1, 0.2))
        .when(lay == "L2_short", 0.5 + add(_flag("mood_shift"), 0.15) + add(_f("n_sources") >= 5, 0.1))
        .when(lay == "L3_mid", 0.6 + add(_flag("causal"), 0.15) + add(_flag("frame_divergence"), 0.1))
        .when(lay == "L4_long", 0.7 + add(_f("period") > 180, 0.1) + add(_f("domains") >= 3, 0.1) - add(_f("drift").between(0.3, 0.35), 0.1))
        .when(lay == "L5_singularity", 0.5 + add(n >= 3, 0.2) + add(composite() > 0.8, 0.15) - add(n <= 1, 0.2))
    )
    return F.coalesce(_clamp(c), F.lit(0.0))


def build_signals(features: DataFrame) -> DataFrame:
    """(topic, layer, composite, confidence, evidence) of the topics in a layer; repeated topics give one row, the surest."""
    have = set(features.columns)
    x = features
    for c in FEATURES:
        if c not in have:
            x = x.withColumn(c, F.lit(0.0))
    for c in (*FLAGS, "causal"):
        if c not in have:
            x = x.withColumn(c, F.lit(False))
    if "ma_signal" not in have:
        x = x.withColumn("ma_signal", F.lit(None).cast("string"))
    x = x.withColumn("layer", layer()).where("layer <> ''").withColumn("composite", composite()).withColumn("confidence", confidence())
    text = F.format_string("Topic %s classified as %s. Data span: %dd, from %d sources.", F.col("topic").cast("string"), "layer", _f("span_days").cast("int"), _f("n_sources").cast("int"))
    return x.withColumn("evidence", text).groupBy("topic", "layer").agg(F.max("composite").alias("composite"), F.max("confidence").alias("confidence"), F.max("evidence").alias("evidence"))
