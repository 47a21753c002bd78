"""Time-series kernels over daily topic series, and clustering. Kernels have no SQL; they are tested by invariants."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import LDA, BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import CountVectorizer, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.operators import kernels as K
from corpusmill.operators.insights import calendar, daily_series
from corpusmill.operators.serving import l2_distance, tfidf_top
from corpusmill.plans.bindings import registry
from corpusmill.plans.insight_queries import scored
from corpusmill.runtime import settle, ship
from corpusmill.sources.tables import table

QUERIES, SQL, query = registry()
#: Rows of a label that isolation trees are fitted on.
FOREST_ROWS = 10_000


def _series(spark, d):
    """(topic, day, value): daily articles of each topic, days without articles included."""
    ship(spark)
    return daily_series(scored(spark, d)).where("topic <> 'all'").select("topic", "day", F.col("volume").cast("double").alias("value"))


def _by_topic(df, run, schema):
    return df.groupBy("topic").applyInPandas(lambda p: run(p.sort_values("day", kind="stable").reset_index(drop=True)), schema)


@query()
def ts_stl(spark, d):
    def run(p):
        trend, season, rest = K.stl(p.value.to_numpy())
        return pd.DataFrame({"topic": p.topic, "day": p.day, "trend": trend, "seasonal": season, "residual": rest})

    return _by_topic(_series(spark, d), run, "topic string, day date, trend double, seasonal double, residual double")


@query()
def ts_kleinberg(spark, d):
    def run(p):
        rows = [(p.topic[0], p.day[a], p.day[b], level, score) for a, b, level, score in K.bursts(p.value.to_numpy())]
        return pd.DataFrame(rows, columns=["topic", "first_day", "last_day", "level", "score"]).astype({"first_day": object, "last_day": object})

    return _by_topic(_series(spark, d), run, "topic string, first_day date, last_day date, level int, score double")


@query()
def ts_pelt(spark, d):
    def run(p):
        found, sig = K.changepoint_significance(p.value.to_numpy())
        return pd.DataFrame({"topic": pd.Series([p.topic[0]] * len(found), dtype=object), "day": pd.Series([p.day[i] for i in found], dtype=object), "significance": [sig] * len(found)})

    return _by_topic(_series(spark, d), run, "topic string, day date, significance double")


@query()
def ts_prophet(spark, d):
    def run(p):
        fit, low, high = K.forecast(p.value.to_numpy())
        days = pd.date_range(p.day[0], periods=len(fit)).date
        return pd.DataFrame({"topic": p.topic[0], "day": days, "fit": fit, "low": low, "high": high})

    return _by_topic(_series(spark, d), run, "topic string, day date, fit double, low double, high double")


@query()
def ts_wavelet(spark, d):
    def run(p):
        e = K.wavelet_energy(p.value.to_numpy())
        return pd.DataFrame({"topic": p.topic[0], "level": range(1, len(e) + 1), "energy": e})

    return _by_topic(_series(spark, d), run, "topic string, level int, energy double")


@query()
def adf(spark, d):
    return _by_topic(_series(spark, d), lambda p: pd.DataFrame({"topic": [p.topic[0]], "stationary": [K.is_stationary(p.value.to_numpy())]}), "topic string, stationary boolean")


@query()
def tp3_decay(spark, d):
    def run(p):
        r = K.decay(p.value.to_numpy())
        return pd.DataFrame([{"topic": p.topic[0], **r}] if r else [], columns=["topic", "peak", "points", "lam", "alpha", "r2_exp", "r2_pow", "kind"])

    return _by_topic(_series(spark, d), run, "topic string, peak int, points int, lam double, alpha double, r2_exp double, r2_pow double, kind string")


def _pairs(spark, d, top: int, both: bool):
    """Ordered or unordered pairs of the `top` largest series, as two arrays."""
    s = _series(spark, d)
    keep = s.groupBy("topic").agg(F.sum("value").alias("v")).orderBy(F.desc("v"), "topic").limit(top).select("topic")
    a = s.join(F.broadcast(keep), "topic", "left_semi").groupBy("topic").agg(F.transform(F.array_sort(F.collect_list(F.struct("day", "value"))), lambda x: x.value).alias("x"))
    a = settle(a)
    return a.toDF("a", "xa").join(F.broadcast(a.toDF("b", "xb")), F.col("a") != F.col("b") if both else F.col("a") < F.col("b"))


@query()
def granger_bonf(spark, d):
    """Ordered pairs whose past helps, p below 5 % divided by the number of pairs."""
    pairs = _pairs(spark, d, 10, True)

    @F.pandas_udf("lag int, p double")
    def run(xa: pd.Series, xb: pd.Series) -> pd.DataFrame:
        prep = lambda x: np.asarray(x) if K.is_stationary(np.asarray(x)) else np.diff(np.asarray(x))
        got = []
        for x, y in zip(xa, xb, strict=True):
            x, y = prep(x), prep(y)
            n = min(len(x), len(y))
            got.append(K.granger(x[-n:], y[-n:]))
        return pd.DataFrame(got, columns=["lag", "p"])

    r = pairs.select("a", "b", run("xa", "xb").alias("r")).select("a", "b", "r.lag", "r.p")
    n = F.count("*").over(Window.partitionBy())
    return r.withColumn("n", n).withColumn("strength", F.least(F.lit(1.0), -F.log10(F.greatest("p", F.lit(1e-300))) / 10)).where(F.col("p") < 0.05 / F.col("n")).select("a", "b", "lag", F.round("p", 6).alias("p"), F.round("strength", 6).alias("strength"))


@query()
def tp1_cascade(spark, d):
    """Unordered pairs with the lead that the better of the two F-tests gives, p below 5 %."""
    pairs = _pairs(spark, d, 10, True)

    @F.pandas_udf("lag int, p double")
    def run(xa: pd.Series, xb: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([K.granger(np.asarray(x), np.asarray(y)) for x, y in zip(xa, xb, strict=True)], columns=["lag", "p"])

    r = pairs.select("a", "b", run("xa", "xb").alias("r")).select("a", "b", "r.lag", F.round("r.p", 6).alias("p")).where("p < 0.05")
    w = Window.partitionBy(F.least("a", "b"), F.greatest("a", "b")).orderBy("p", "a")
    return r.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


@query()
def dtw(spark, d):
    @F.pandas_udf("double")
    def run(xa: pd.Series, xb: pd.Series) -> pd.Series:
        return pd.Series([K.dtw(np.asarray(x), np.asarray(y)) for x, y in zip(xa, xb, strict=True)])

    p = _pairs(spark, d, 20, False)
    top = F.greatest(F.array_max("xa"), F.array_max("xb"), F.lit(1e-9))
    r = p.select("a", "b", run("xa", "xb").alias("distance"), (F.sqrt(F.size("xa") * F.size("xb")) * top).alias("scale"))
    return r.select("a", "b", F.round("distance", 6).alias("distance"), F.round(1 - F.col("distance") / F.col("scale"), 6).alias("strength")).where("strength > 0.1")


# vectors


@query()
def ood_lof(spark, d):
    """Local outlier factor of each vector, exact, in its own group: k nearest, reachability, ratio."""
    v = table(spark, d, "embeddings").select("vec_id", "label", "embedding")
    near = v.alias("a").join(v.alias("b"), (F.col("a.label") == F.col("b.label")) & (F.col("a.vec_id") != F.col("b.vec_id"))).select(F.col("a.vec_id").alias("a"), F.col("b.vec_id").alias("b"), F.round(l2_distance(F.col("a.embedding"), F.col("b.embedding")), 9).alias("dist"))
    near = settle(near.withColumn("rk", F.row_number().over(Window.partitionBy("a").orderBy("dist", "b"))).where("rk <= 20"))
    kd = near.groupBy("a").agg(F.max("dist").alias("kd"))
    lrd = near.join(kd.toDF("b", "kd"), "b").groupBy("a").agg((1 / F.greatest(F.avg(F.greatest("dist", "kd")), F.lit(1e-9))).alias("lrd"))
    lof = near.join(lrd.toDF("b", "lrd_b"), "b").groupBy("a").agg(F.avg("lrd_b").alias("m")).join(lrd, "a").select(F.col("a").alias("vec_id"), (F.col("m") / F.col("lrd")).alias("lof"))
    return lof.select("vec_id", F.round("lof", 6).alias("lof"))


SQL["ood_lof"] = """
    with n as (select a.vec_id as a, b.vec_id as b, round(sqrt(list_sum(list_transform(generate_series(1, len(a.embedding)), lambda i: pow(cast(a.embedding[i] as double) - cast(b.embedding[i] as double), 2)))), 9) as dist from embeddings a join embeddings b on a.label = b.label and a.vec_id <> b.vec_id),
    k as (select * from (select *, row_number() over (partition by a order by dist, b) as rk from n) where rk <= 20), kd as (select a, max(dist) as kd from k group by a), l as (select k.a, 1 / greatest(avg(greatest(k.dist, kd.kd)), 1e-9) as lrd from k join kd on kd.a = k.b group by k.a)
    select k.a as vec_id, round(avg(lb.lrd) / any_value(la.lrd), 6) as lof from k join l la on la.a = k.a join l lb on lb.a = k.b group by k.a
"""


@query()
def ood_iforest(spark, d):
    """Isolation forest scores by label. A label's trees are fitted on at most FOREST_ROWS of its rows, those with the least hashes; every row is scored.

    Rows are scored in parts of a label, each with the label's sample beside it, so that no label is
    gathered in one task and the parts change no score.
    """
    ship(spark)
    v = table(spark, d, "embeddings").where("embedding is not null").select("vec_id", "label", "embedding", F.xxhash64("vec_id").alias("h"))
    parts = v.groupBy("label").agg(F.ceil(F.count("*") / 50_000).cast("int").alias("parts"))
    least = F.row_number().over(Window.partitionBy("label").orderBy("h", "vec_id"))  # limited before the shuffle as well
    sample = v.withColumn("rn", least).where(F.col("rn") <= FOREST_ROWS).join(parts, "label")
    sample = sample.select("label", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "h", "vec_id", "embedding").toDF("s_label", "s_part", "s_h", "s_id", "s_embedding")
    rows = v.join(parts, "label").select("label", F.pmod("h", "parts").cast("int").alias("part"), "vec_id", "embedding")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({"vec_id": [], "score": []})
        fit = np.stack(right.sort_values(["s_h", "s_id"]).s_embedding.to_numpy()).astype(float)
        return pd.DataFrame({"vec_id": left.vec_id, "score": K.isolation_scores(np.stack(left.embedding.to_numpy()).astype(float), fit).round(6)})

    return rows.groupBy("label", "part").cogroup(sample.groupBy("s_label", "s_part")).applyInPandas(run, "vec_id long, score double")


def _features(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", "label", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("raw"))
    return Normalizer(inputCol="raw", outputCol="features").transform(v)


@query()
def kmeans_auto(spark, d):
    """Clusters of the vectors, the number of them by silhouette on a bounded sample."""
    x = settle(_features(spark, d).orderBy("vec_id").select("vec_id", "features"))
    n = x.count()
    sample = x.where(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, n // 5000))) == 0)
    scores = {}
    for k in (5, 8, 10, 12, 15):
        if k < n:
            scores[k] = ClusteringEvaluator().evaluate(KMeans(k=k, seed=42, maxIter=10).fit(sample).transform(sample))
    k = max(scores, key=lambda i: (round(scores[i], 6), -i)) if scores else 2
    return KMeans(k=k, seed=42, maxIter=20).fit(x).transform(x).select("vec_id", F.col("prediction").alias("cluster"))


@query()
def hierarchical(spark, d):
    x = settle(_features(spark, d).orderBy("vec_id").select("vec_id", "features"))
    return BisectingKMeans(k=10, seed=42).fit(x).transform(x).select("vec_id", F.col("prediction").alias("cluster"))


@query()
def topic_model(spark, d):
    """Topics by k-means on normalised vectors; vectors far from their centre are noise (-1)."""
    x = settle(_features(spark, d).orderBy("vec_id").select("vec_id", "features"))
    m = KMeans(k=10, seed=42, maxIter=20, distanceMeasure="cosine").fit(x)
    centres = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(m.clusterCenters())], "prediction int, centre array<double>")
    y = m.transform(x).join(F.broadcast(centres), "prediction").withColumn("dist", l2_distance(vector_to_array("features"), F.col("centre")))
    w = Window.partitionBy("prediction")
    y = y.withColumn("m", F.avg("dist").over(w)).withColumn("s", F.stddev_pop("dist").over(w))
    return y.select("vec_id", F.when(F.col("dist") > F.col("m") + 2 * F.col("s"), -1).otherwise(F.col("prediction")).alias("topic_id"), F.round(1 / (1 + F.col("dist")), 6).alias("probability"))


@query()
def lda(spark, d):
    """Topics of the documents' words by online variational inference."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{4,}"), F.lit(0)).alias("words")).where("size(words) > 0")
    cv = CountVectorizer(inputCol="words", outputCol="features", vocabSize=2000, minDF=2.0).fit(docs)
    x = settle(cv.transform(docs).orderBy("doc_id").select("doc_id", "features"))
    m = LDA(k=10, seed=42, maxIter=5, optimizer="online").fit(x)
    dist = vector_to_array("topicDistribution")
    return m.transform(x).select("doc_id", (F.array_position(dist, F.array_max(dist)) - 1).cast("int").alias("topic_id"), F.round(F.array_max(dist), 6).alias("weight"))


@query()
def nmf(spark, d):
    """Topics of the documents by non-negative factors of their TF-IDF vectors (one- and two-word terms, 10,000 at most); documents without a term have none."""
    docs = table(spark, d, "documents").where("doc_id is not null").groupBy("doc_id").agg(F.min("text").alias("text"))
    terms = tfidf_top(docs.withColumn("g", F.lit("")), "doc_id", "text", "g", top=1 << 30)
    return K.document_factors(settle(terms.select("id", "term", "score"))).select(F.col("id").alias("doc_id"), "topic_id")


@query("with c as (select event_type, cast(ts as date) as day, count(*) as n from events group by all), b as (select min(day) as a, max(day) as z from c), g as (select e.event_type, x.day from (select distinct event_type from c) e cross join (select cast(unnest(generate_series(a, z, interval 1 day)) as date) as day from b) x) select g.event_type, cast(g.day as varchar) as day, coalesce(n, 0) as n, round(avg(coalesce(n, 0)) over (partition by g.event_type order by g.day rows between 13 preceding and current row), 6) as mean14 from g left join c using (event_type, day)")
def ts_daily_events(spark, d):
    c = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    x = calendar(c, "event_type").join(c, ["event_type", "day"], "left").select("event_type", "day", F.coalesce("n", F.lit(0)).alias("n"))
    w = Window.partitionBy("event_type").orderBy("day").rowsBetween(-13, 0)
    return x.select("event_type", F.col("day").cast("string").alias("day"), "n", F.round(F.avg("n").over(w), 6).alias("mean14"))
