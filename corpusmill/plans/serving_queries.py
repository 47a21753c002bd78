"""Search, vectors, quality checks, duplicates and graphs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import cascade, graph, quality, serving
from corpusmill.operators.insights import cooccurrence
from corpusmill.plans.bindings import ANA, ART, EMOTIONS, ENT, analysis, articles, entities, r6, registry
from corpusmill.plans.relational_queries import R
from corpusmill.sources.tables import table

QUERIES, SQL, query = registry()

_T = f"list_filter(string_split_regex(translate(lower(coalesce(text, '')), '{serving.ACCENTS}', '{serving.PLAIN}'), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
IDX = f"idx as (select term, id, count(*) as tf from (select doc_id as id, unnest({_T}) as term from documents) group by all)"


def _index(spark, d):
    return serving.inverted_index(table(spark, d, "documents"), "doc_id", ["text"])


@query(f"with {IDX} select term, count(*) as docs, cast(sum(tf) as bigint) as tf from idx group by term")
def idx_fts(spark, d):
    return _index(spark, d).groupBy("term").agg(F.count("*").alias("docs"), F.sum("tf").alias("tf"))


@query(f"with {IDX}, t as (select id, list_distinct(list(term)) as t from idx where term in ('battery', 'old', 'lid', 'zip') group by id) select id from t where list_contains(t, 'battery') and (list_contains(t, 'lid') or list_contains(t, 'zip')) and not list_contains(t, 'old')")
def fts_match(spark, d):
    return serving.fts_match(_index(spark, d), ["battery"], ["lid", "zip"], ["old"])


@query(
    f"with {IDX}, l as (select id, sum(tf) as len from idx group by id), s as (select count(*) as n, avg(len) as a from l), h as (select term, id, sum(tf) as tf from idx where term in ('battery', 'photos') group by all), f as (select term, count(*) as df from h group by term) "
    "select id, round(-sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / a))), 6) as rank from h join f using (term) join l using (id) cross join s group by id order by rank, id limit 20"
)
def fts_rank(spark, d):
    return serving.fts_rank(_index(spark, d), ["battery", "photos"], 20)


@query()
def fts_snippet(spark, d):
    return table(spark, d, "documents").select("doc_id", serving.snippet(F.col("text"), "battery").alias("snippet")).where("snippet is not null")


@query("with q as (select vec_id as query, embedding as q from embeddings where vec_id % 50 = 0), d as (select query, vec_id as id, round(sqrt(list_sum(list_transform(generate_series(1, len(q)), lambda i: pow(cast(q[i] as double) - cast(embedding[i] as double), 2)))), 6) as distance from embeddings cross join q where vec_id <> query), r as (select *, row_number() over (partition by query order by distance, id) as rank from d) select query, id, distance, cast(rank as integer) as rank from r where rank <= 10")
def vec_knn(spark, d):
    """Queries are the vectors with an id divisible by 50, against all rows."""
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    return serving.vec_knn(v, v.where("vec_id % 50 = 0"), 10)


_CEN = "cen as (select label, i, avg(v) as v from (select label, unnest(generate_series(1, len(embedding))) as i, cast(unnest(embedding) as double) as v from embeddings) group by all)"


@query(f"with {_CEN} select a.label as a, b.label as b, round(sum(a.v * b.v) / (sqrt(sum(a.v * a.v)) * sqrt(sum(b.v * b.v))), 6) as cosine from cen a join cen b on a.i = b.i and a.label < b.label group by all")
def centroid(spark, d):
    c = serving.centroids(table(spark, d, "embeddings"), "label")
    a, b = c.toDF("a", "ca"), c.toDF("b", "cb")
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", r6(serving.cosine(F.col("ca"), F.col("cb")), "cosine"))


@query("with h as (select label, vec_id, embedding, row_number() over (partition by label order by vec_id) as rn, count(*) over (partition by label) as n from embeddings), c as (select label, rn <= n // 2 as early, i, avg(v) as v from (select label, rn, n, unnest(generate_series(1, len(embedding))) as i, cast(unnest(embedding) as double) as v from h where n >= 4) group by all) select a.label, round(1 - sum(a.v * b.v) / (sqrt(sum(a.v * a.v)) * sqrt(sum(b.v * b.v))), 6) as drift from c a join c b on a.label = b.label and a.i = b.i and a.early and not b.early group by a.label")
def emb_drift(spark, d):
    w = Window.partitionBy("label")
    h = table(spark, d, "embeddings").withColumn("rn", F.row_number().over(w.orderBy("vec_id"))).withColumn("n", F.count("*").over(w)).where("n >= 4")
    halves = h.withColumn("k", F.struct("label", (F.col("rn") <= F.floor(F.col("n") / 2)).alias("early")))
    c = serving.centroids(halves, "k").select("k.label", "k.early", "centroid")
    a, b = c.where("early").select("label", F.col("centroid").alias("x")), c.where("not early").select("label", F.col("centroid").alias("y"))
    return a.join(b, "label").select("label", r6(1 - serving.cosine(F.col("x"), F.col("y")), "drift"))


@query("select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: pow(cast(x as double), 2)))), 6) as norm, len(embedding) as dim from embeddings")
def l2_normalize(spark, d):
    v = F.col("embedding")
    return table(spark, d, "embeddings").select("vec_id", r6(F.sqrt(serving.dot(v, v)), "norm"), F.size(v).cast("bigint").alias("dim"))


@query(f"with {ART}, c as (select topic, lang, count(*) as n from art group by all) select topic, cast(sum(n) as bigint) as articles, arg_min(lang, (-n, lang)) as label, 'stable' as trend from c group by topic")
def idx_topics(spark, d):
    return serving.index_topics(articles(spark, d))


_TF = (
    "b as (select doc_id as id, lower(coalesce(lang, '')) as g, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') as w from documents where text is not null), u as (select id, g, unnest(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) as term from b), "
    "tf as (select g, id, term, count(*) as tf from u group by all), n as (select g, count(*) as n from b group by g), df as (select g, term, count(*) as df, sum(tf) as total, any_value(n) as n from tf join n using (g) group by all), "
    "v as (select *, row_number() over (partition by g order by total desc, term) as r from df where df >= case when 0.95 * n < 2 then 1 else 2 end and df <= 0.95 * n), x as (select tf.g, id, tf.term, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) as s from tf join v on v.g = tf.g and v.term = tf.term and r <= 10000), "
    "z as (select *, round(s / sqrt(sum(s * s) over (partition by g, id)), 6) as score from x), k as (select *, row_number() over (partition by g, id order by score desc, term) as rank from z)"
)


@query(f"with {_TF} select id, term, score, cast(rank as integer) as rank from k where rank <= 20")
def tfidf_top(spark, d):
    docs = table(spark, d, "documents").withColumn("g", F.lower(F.coalesce("lang", F.lit(""))))
    return serving.tfidf_top(docs, "doc_id", "text", "g")


# quality


@query("select * from (values " + ", ".join(f"('{c}', (select count(*) from article_analysis where {c} < {lo} or {c} > {hi} or isnan({c})))" for c, lo, hi in [("sentiment_score", -1, 1), ("importance_score", 0, 100), *((f"emotion_{e}", 0, 1) for e in EMOTIONS)]) + ") t(column_name, bad)")
def val_ranges(spark, d):
    return quality.check_ranges(table(spark, d, "article_analysis"), {"sentiment_score": (-1, 1), "importance_score": (0, 100), **{f"emotion_{e}": (0, 1) for e in EMOTIONS}})


_COLS = ("article_id", "title", "body", "source", "category", "language", "published_at", "crawled_at", "author", "word_count")


@query(" union all ".join(f"select '{c}' as column_name, count(*) filter (where {c} is null) as nulls, round(count(*) filter (where {c} is null) / count(*), 6) as rate from articles" for c in _COLS))
def val_nulls(spark, d):
    return quality.check_nulls(table(spark, d, "articles"), list(_COLS))


@query("with g as (select article_id, count(*) as n from articles group by 1) select cast(sum(n) as bigint) as row_count, cast(coalesce(sum(n) filter (where article_id is null), 0) as bigint) as nulls, count(article_id) as distinct_keys, count(*) filter (where n > 1 and article_id is not null) as repeated from g")
def val_quality(spark, d):
    return quality.check_keys(table(spark, d, "articles"), "article_id")


@query("select count(*) as total, count(*) filter (where embedding is null) as missing, count(*) filter (where len(embedding) <> 64) as wrong_size, count(*) filter (where list_max(list_transform(embedding, lambda x: abs(x))) = 0) as zero from embeddings")
def val_vectors(spark, d):
    return quality.check_vectors(table(spark, d, "embeddings"), "embedding", 64)


@query("select article_id, count(*) as n from article_analysis where article_id is not null and article_id not in (select article_id from articles) group by article_id")
def val_foreign_keys(spark, d):
    return quality.check_foreign_keys(table(spark, d, "article_analysis"), "article_id", table(spark, d, "articles"), "article_id")


@query("select * from (values ('embedding', 'missing'), ('doc_id', 'extra'), ('lang', 'extra'), ('n_chars', 'extra'), ('rating', 'extra'), ('item_id', 'extra'), ('reviewer_id', 'extra'), ('review_date', 'extra'), ('ingested_at', 'extra'), ('text', 'string for bigint')) t(column_name, problem)")
def val_schema(spark, d):
    from pyspark.sql import types as T

    want = T.StructType([T.StructField("title", T.StringType()), T.StructField("source", T.StringType()), T.StructField("text", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])
    return quality.check_schema(spark, table(spark, d, "documents"), want)


# duplicates


@query()
def dedup_cascade(spark, d):
    """Batches of crawled addresses and fingerprints in order of arrival."""
    u = R.first_by(table(spark, d, "seen_urls").where("article_id is not null"), ["article_id"], [F.col("first_seen"), F.col("normalized_url")])
    h = R.first_by(table(spark, d, "content_hashes").where("article_id is not null"), ["article_id"], [F.col("seen_at"), F.col("title"), F.col("simhash")])
    rows = u.join(h.select("article_id", "title", "simhash"), "article_id")
    rows = rows.select(F.col("article_id").alias("id"), F.struct("first_seen", "article_id").alias("seq"), F.lower(F.regexp_replace("normalized_url", r"^https?://(www\.)?|[?#].*$|/$", "")).alias("url_key"), X.title_key(F.col("title")).alias("title_key"), "simhash")
    return cascade.dedup_cascade(rows)


@query("with h as (select article_id as id, min(simhash) as simhash from content_hashes where article_id is not null group by 1) select a.id as a, b.id as b, cast(bit_count(xor(a.simhash, b.simhash)) as integer) as bits from h a join h b on a.id < b.id and a.simhash <> 0 and b.simhash <> 0 and bit_count(xor(a.simhash, b.simhash)) <= 10")
def join_dedup_scan(spark, d):
    h = table(spark, d, "content_hashes").where("article_id is not null").groupBy(F.col("article_id").alias("id")).agg(F.min("simhash").alias("simhash"))
    return cascade.fingerprint_pairs(h.withColumn("seq", F.col("id")))


# graphs

_EDGES = "e0 as (select a.entity as entity_a, b.entity as entity_b, count(*) as weight from ent a join ent b on a.article_id = b.article_id and a.entity < b.entity group by all having count(*) >= 2), ed as (select entity_a as src, entity_b as dst, weight from e0 union all select entity_b, entity_a, weight from e0)"


def _edges(spark, d):
    return graph.undirected(cooccurrence(entities(spark, d), least=2))


# ten rounds on ed(src, dst, weight)
_PR = "es as (select src, dst, sum(weight) as weight from ed group by all), lk as (select src, dst, weight / sum(weight) over (partition by src) as p from es), nd as (select src as node from es union select dst from es), nn as (select count(*) as n from nd), r0 as (select node, 1 / n as rank from nd, nn)" + "".join(
    f", g{i} as (select nd.node, coalesce(s.got, 0) as got from nd left join (select dst, sum(p * rank) as got from lk join r{i - 1} on src = node group by dst) s on s.dst = nd.node), r{i} as (select node, 0.15 / n + 0.85 * (got + (select 1 - sum(got) from g{i}) / n) as rank from g{i}, nn)" for i in range(1, 11)
)


@query(f"with {ART}, {ENT}, {_EDGES}, {_PR} select node, round(rank, 6) as rank from r10")
def pagerank_w(spark, d):
    return graph.pagerank(_edges(spark, d), rounds=10).select("node", r6("rank", "rank"))


@query(f"with recursive {ART}, {ENT}, {_EDGES}, reach(node, low) as (select src, src from ed union select e.dst, r.low from reach r join ed e on e.src = r.node and r.low < e.dst) select node, min(low) as component from reach group by node")
def graph_components(spark, d):
    return graph.components(_edges(spark, d))


@query(f"with {ART}, {ENT}, {_EDGES}, g as (select src as node, count(distinct dst) as degree from ed group by src) select node, degree, round(degree / greatest((select count(*) from g) - 1, 1), 6) as centrality from g")
def centrality(spark, d):
    return graph.degree_centrality(_edges(spark, d)).select("node", "degree", r6("centrality", "centrality"))


@query("with recursive e as (select distinct l_suppkey as src, l_partkey % 100 + 1 as dst from lineitem where l_quantity = 50 and l_discount = 0.1 and l_suppkey < l_partkey % 100 + 1), r(node, depth) as (select 1::bigint, 0 union select e.dst, r.depth + 1 from r join e on e.src = r.node where r.depth < 10) select node, cast(min(depth) as integer) as depth from r group by node")
def causal_depth(spark, d):
    """Depth in an acyclic graph of keys from node 1, at most ten steps."""
    e = table(spark, d, "lineitem").where("l_quantity = 50 and l_discount = 0.1 and l_suppkey < l_partkey % 100 + 1").select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") % 100 + 1).alias("dst")).distinct()
    return graph.bfs_depth(e, spark.range(1, 2).toDF("node"), max_depth=10)


@query()
def louvain(spark, d):
    """Communities of the entity graph by moves that raise the modularity, with the modularity reached."""
    e = _edges(spark, d)
    c = graph.louvain(e)
    return c.groupBy("community").agg(F.count("*").alias("nodes")).crossJoin(graph.modularity(e, c).select(r6("modularity", "modularity")))


@query(f"with {ANA} select count(*) as n from ana")
def verify_readable(spark, d):
    return analysis(spark, d).agg(F.count("*").alias("n"))
