"""Scorers, index tables, retention and the rarer cross-analysis operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.operators import graph, kernels, scorers
from corpusmill.operators.insights import cooccurrence
from corpusmill.operators.serving import cosine
from corpusmill.plans.bindings import ANA, ART, ENT, analysis, articles, entities, r6, registry
from corpusmill.plans.series_queries import _pairs, _series, granger_bonf
from corpusmill.plans.serving_queries import _EDGES, _PR, IDX, _index
from corpusmill.runtime import checked_broadcast, settle
from corpusmill.sources.tables import table

QUERIES, SQL, query = registry()
W = Window
_TEXT = "coalesce(title, '') || ' ' || coalesce(body, '')"


def _text():
    return F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("body", F.lit("")))


@query(f"with {ART} select article_id, case " + " ".join(f"when regexp_matches(lower({_TEXT}), '{p}') then '{k}'" for k, p in scorers.FRAMES.items()) + " else 'E' end as steeps from art")
def steeps(spark, d):
    return articles(spark, d).select("article_id", scorers.score("steeps", _text()).alias("steeps"))


@query(f"with {ART} select article_id, array_to_string(list_distinct(regexp_extract_all({_TEXT}, '[A-Z][a-z]{{3,}}')), '|') <> '' as found, len(list_distinct(regexp_extract_all({_TEXT}, '[A-Z][a-z]{{3,}}'))) as n from art")
def ner(spark, d):
    e = scorers.score("ner", _text())
    return articles(spark, d).select("article_id", (F.size(e) > 0).alias("found"), F.size(e).cast("bigint").alias("n"))


@query(f"with {ART} select article_id, 1.0::double as total, 0.125::double as each from art")
def emotion(spark, d):
    e = scorers.score("emotion", F.col("body"))
    return articles(spark, d).select("article_id", F.aggregate(e, F.lit(0.0), lambda a, v: a + v).alias("total"), F.get(e, F.lit(0)).alias("each"))


@query("select vec_id, len(embedding) as dim from embeddings where embedding is not null")
def idx_vec(spark, d):
    return table(spark, d, "embeddings").where("embedding is not null").select("vec_id", F.size("embedding").cast("bigint").alias("dim"))


@query("select source_id, cast(batch_no as varchar) as run, count(*) as urls from seen_urls group by all union all select source_id, 'all', count(*) from seen_urls group by source_id")
def idx_crawl_status(spark, d):
    u = table(spark, d, "seen_urls")
    a = u.groupBy("source_id", F.col("batch_no").cast("string").alias("run")).agg(F.count("*").alias("urls"))
    return a.unionByName(u.groupBy("source_id").agg(F.count("*").alias("urls")).withColumn("run", F.lit("all")))


@query("with u as (select lower(url_hash) as h, count(distinct article_id) as n from seen_urls where url_hash is not null group by 1) select h, n from u where n > 1")
def url_equiv(spark, d):
    """Address hashes, whatever their letter case, that stand for several articles."""
    return table(spark, d, "seen_urls").where("url_hash is not null").groupBy(F.lower("url_hash").alias("h")).agg(F.count_distinct("article_id").alias("n")).where("n > 1")


@query(f"with {IDX}, v as (select term, row_number() over (order by count(*) desc, term) - 1 as col from idx group by term order by count(*) desc, term limit 1000) select id, cast(col as integer) as col, tf from idx join v using (term)")
def tfidf_matrix(spark, d):
    """Sparse (row, column, value) over the 1,000 most frequent terms."""
    i = _index(spark, d).drop("col")
    top = i.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(1000)
    v = top.withColumn("col", F.row_number().over(W.partitionBy().orderBy(F.desc("n"), "term")) - 1).select("term", "col")
    return i.join(F.broadcast(v), "term").select("id", "col", "tf")


@query(f"with {ART}, {ENT}, {_EDGES}, g as (select src as node, count(distinct dst) as degree, sum(weight) as strength from ed group by src), u as (select 'degree' as metric, node, cast(degree as double) as v from g union all select 'strength', node, cast(strength as double) from g), r as (select *, row_number() over (partition by metric order by v desc, node) as rank from u) select metric, node, v, cast(rank as integer) as rank from r where rank <= 20")
def topk_metric_rank(spark, d):
    e = graph.undirected(cooccurrence(entities(spark, d), least=2))
    g = e.groupBy(F.col("src").alias("node")).agg(F.count_distinct("dst").cast("double").alias("degree"), F.sum("weight").alias("strength"))
    u = g.unpivot(["node"], ["degree", "strength"], "metric", "v")
    return u.withColumn("rank", F.row_number().over(W.partitionBy("metric").orderBy(F.desc("v"), "node"))).where("rank <= 20").select("metric", "node", "v", "rank")


@query(f"with {ART}, {ENT}, t as (select topic, count(distinct article_id) as a, count(distinct entity) as e from ent group by topic) select topic, round(least(1, a / e), 6) as new_nodes, round(0.8 * least(1, a / e), 6) as new_edges from t")
def net_features(spark, d):
    t = entities(spark, d).groupBy("topic").agg(F.least(F.lit(1.0), F.count_distinct("article_id") / F.count_distinct("entity")).alias("r"))
    return t.select("topic", r6("r", "new_nodes"), r6(0.8 * F.col("r"), "new_edges"))


@query()
def silhouette(spark, d):
    """Mean silhouette of the given labels, from each vector's mean distance to every label's vectors."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    v = table(spark, d, "embeddings").select(F.col("label").cast("double").alias("prediction"), array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))
    return spark.createDataFrame([(float(ClusteringEvaluator().evaluate(v)),)], "silhouette double")


@query(f"with x as (select source as src, lead(source) over (partition by reviewer_id order by doc_id) as dst from documents where reviewer_id is not null and source is not null), ed as (select src, dst, cast(1 as double) as weight from x where dst is not null and src <> dst), {_PR} select node, round(rank, 6) as rank from r10")
def pagerank_multi(spark, d):
    """Unweighted rank on a directed graph with parallel edges: readers who move on to another source's shop."""
    docs = table(spark, d, "documents").where("reviewer_id is not null and source is not null").select("reviewer_id", "source", "doc_id")
    nxt = F.lead("source").over(W.partitionBy("reviewer_id").orderBy("doc_id"))
    e = settle(docs.select(F.col("source").alias("src"), nxt.alias("dst")).where("dst is not null and src <> dst").withColumn("weight", F.lit(1.0)))
    return graph.pagerank(e, rounds=10).select("node", r6("rank", "rank"))


@query(
    "with p as (select a.vec_id as a, b.vec_id as b, list_sum(list_transform(generate_series(1, len(a.embedding)), lambda i: cast(a.embedding[i] as double) * b.embedding[i])) / (sqrt(list_sum(list_transform(a.embedding, lambda x: pow(cast(x as double), 2)))) * sqrt(list_sum(list_transform(b.embedding, lambda x: pow(cast(x as double), 2))))) as s from embeddings a join embeddings b on a.label = b.label and a.vec_id % 50 = 0 and a.vec_id <> b.vec_id) "
    "select a, b, round(0.5 * s, 6) as strength from p where round(s, 6) >= 0.3"
)
def contradiction(spark, d):
    """Potential contradictions by similarity alone (no inference model): the query set of ids divisible by 50 against its label's rows."""
    v = table(spark, d, "embeddings").select("vec_id", "label", "embedding")
    a, b = v.where("vec_id % 50 = 0").toDF("a", "label", "ea"), v.toDF("b", "label", "eb")
    s = b.join(checked_broadcast(a), "label").where("a <> b").select("a", "b", cosine(F.col("ea"), F.col("eb")).alias("s"))
    return s.where(F.round("s", 6) >= 0.3).select("a", "b", r6(0.5 * F.col("s"), "strength"))


@query()
def pcmci(spark, d):
    """Lagged links between topics that hold given both series' own past: partial correlation at lags 1 to 3."""
    pairs = _pairs(spark, d, 10, True)

    @F.pandas_udf("lag int, r double, p double")
    def run(xa: pd.Series, xb: pd.Series) -> pd.DataFrame:
        out = []
        for x, y in zip(xa, xb, strict=True):
            x, y = np.asarray(x, float), np.asarray(y, float)
            best = (0, 0.0, 1.0)
            for lag in (1, 2, 3):
                m = len(y) - 4
                if m < 10:
                    break
                z = np.column_stack([np.ones(m), y[3:-1], x[3 - lag : -1 - lag] if lag < 3 else x[:m]])
                res = lambda v: v - z @ np.linalg.lstsq(z, v, rcond=None)[0]  # noqa: B023, E731
                u, w = res(x[4 - lag : len(x) - lag]), res(y[4:])
                norm = np.sqrt((u @ u) * (w @ w))
                r = float(u @ w / norm) if norm > 1e-12 else 0.0
                p = kernels.f_tail(r * r * (m - 4) / max(1 - r * r, 1e-12), 1, m - 4)
                if p < best[2]:
                    best = (lag, r, p)
            out.append(best)
        return pd.DataFrame(out, columns=["lag", "r", "p"])

    r = pairs.select("a", "b", run("xa", "xb").alias("r")).select("a", "b", "r.lag", r6("r.r", "r"), r6("r.p", "p"))
    return r.where("p < 0.05").orderBy("p", "a", "b").limit(20)


@query()
def causal_depth_topics(spark, d):
    """Longest of the shortest chains from each topic over all links of granger_bonf and pcmci, however long; 0 for topics without links."""
    e = settle(granger_bonf(spark, d).select("a", "b").union(pcmci(spark, d).select("a", "b")).distinct())
    topics = settle(_series(spark, d).select("topic").distinct())
    at = lambda c: F.struct(F.col("topic").alias("root"), F.col(c).alias("at"))
    links = e.crossJoin(topics).select(at("a").alias("src"), at("b").alias("dst"))
    return graph.bfs_depth(links, topics.select(at("topic").alias("node"))).groupBy(F.col("node.root").alias("topic")).agg(F.max("depth").alias("depth"))


@query()
def ts_arima(spark, d):
    """Autoregressive order (0 to 3) with or without one difference, by AIC of least-squares fits."""

    def run(p):
        y = p.sort_values("day").value.to_numpy()
        best = None
        for diff in (0, 1):
            x = np.diff(y) if diff else y
            for k in range(4):
                if len(x) < k + 8:
                    continue
                t = x[3:]
                z = np.column_stack([np.ones(len(t)), *(x[3 - j : len(x) - j] for j in range(1, k + 1))])
                rss = float(((t - z @ np.linalg.lstsq(z, t, rcond=None)[0]) ** 2).sum())
                aic = len(t) * np.log(max(rss / len(t), 1e-12)) + 2 * (k + 1)
                if best is None or aic < best[0]:
                    best = (aic, k, diff)
        return pd.DataFrame({"topic": [p.topic.iloc[0]], "order": [best[1] if best else 0], "diff": [best[2] if best else 0], "aic": [round(best[0], 6) if best else None]})

    return _series(spark, d).groupBy("topic").applyInPandas(run, "topic string, order int, diff int, aic double")


@query(f"with {ANA} select steeps, round(avg(score), 6) as tone, count(*) as n from ana where steeps is not null group by steeps having count(*) >= 10")
def steeps_tone(spark, d):
    return analysis(spark, d).where("steeps is not null").groupBy("steeps").agg(r6(F.avg("score"), "tone"), F.count("*").alias("n")).where("n >= 10")
