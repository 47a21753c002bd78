"""The remaining row, rule, aggregation and synthesis operators, each under the name of its role."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.functions import markup as M
from corpusmill.functions import text as X
from corpusmill.operators import graph, signals
from corpusmill.operators import insights as I
from corpusmill.operators.serving import centroids, cosine
from corpusmill.plans.bindings import ANA, ART, EMOTIONS, ENT, analysis, articles, entities, r6, registry
from corpusmill.plans.insight_queries import _SER, EPU, SCO, SECTORS, _volumes, scored, text_col
from corpusmill.plans.relational_queries import R
from corpusmill.plans.serving_queries import _PR
from corpusmill.runtime import settle, ship
from corpusmill.sources.tables import table, with_columns_present

QUERIES, SQL, query = registry()
W = Window
_TEXT = "lower(coalesce(title, '') || ' ' || coalesce(body, ''))"

# rows


@query("select article_id, cast(null as varchar) as missing_column, word_count from articles")
def scan_parquet_cols(spark, d):
    from pyspark.sql import types as T

    want = T.StructType([T.StructField("article_id", T.StringType()), T.StructField("missing_column", T.StringType()), T.StructField("word_count", T.IntegerType())])
    return with_columns_present(table(spark, d, "articles"), want)


@query(f"with {ART}, {ENT} select article_id, entity, 'title' as kind from ent")
def explode_entities(spark, d):
    return entities(spark, d).select("article_id", "entity", F.lit("title").alias("kind"))


@query(f"with {ART}, {ENT}, {ANA} select e.article_id, entity, round(score, 6) as score from ent e join ana using (article_id) where length(entity) >= 2")
def explode_entities_min2(spark, d):
    return entities(spark, d).where("length(entity) >= 2").join(analysis(spark, d), "article_id").select("article_id", "entity", r6("score", "score"))


@query(f"with {ART} select lang, count(*) as n from art group by lang having count(*) >= 50")
def filter_languages(spark, d):
    return articles(spark, d).groupBy("lang").agg(F.count("*").alias("n")).where("n >= 50")


@query(f"with {ART} select article_id, topic from art where topic <> '-1'")
def filter_noise_topic(spark, d):
    return articles(spark, d).where("topic <> '-1'").select("article_id", "topic")


@query(f"with {ANA} select article_id from ana where upper(steeps) = 'E'")
def filter_econ(spark, d):
    return analysis(spark, d).where("upper(steeps) = 'E'").select("article_id")


@query("select distinct normalized_url from seen_urls where batch_no = 8 and normalized_url not in (select normalized_url from seen_urls where batch_no < 8 and normalized_url is not null)")
def filter_seen_urls(spark, d):
    u = table(spark, d, "seen_urls").select("normalized_url", "batch_no")
    return u.where("batch_no = 8").select("normalized_url").distinct().join(u.where("batch_no < 8"), "normalized_url", "left_anti")


@query("select source_id, article_id from (select distinct source_id, article_id from seen_urls where batch_no = 1) n where not exists (select 1 from seen_urls o where o.batch_no = 0 and o.article_id = n.article_id)")
def crawl_state(spark, d):
    """What a resumed crawl has still to do: rows whose key isn't in the processed set."""
    u = table(spark, d, "seen_urls")
    return u.where("batch_no = 1").select("source_id", "article_id").distinct().join(u.where("batch_no = 0").select("article_id"), "article_id", "left_anti").select("source_id", "article_id")


@query(f"with {ART} select article_id, coalesce(body, title, '') = coalesce(title, '') as by_title, lang, source, coalesce(cast(day as varchar), '1970-01-01') as day, coalesce(trim(body), '') = '' as paywalled from art")
def select_article_text(spark, d):
    return articles(spark, d).select("article_id", (F.coalesce("body", "title", F.lit("")) == F.coalesce("title", F.lit(""))).alias("by_title"), "lang", "source", F.coalesce(F.col("day").cast("string"), F.lit("1970-01-01")).alias("day"), (F.trim(F.coalesce("body", F.lit(""))) == "").alias("paywalled"))


@query(f"with {ART} select article_id, coalesce(length(author) between 2 and 50 and length(regexp_replace(author, '[^0-9]', '', 'g')) / length(author) <= 0.8, false) as ok, case when length(trim(coalesce(author, ''))) <= 1 then '' else author end as kept from art")
def entity_valid(spark, d):
    return articles(spark, d).select("article_id", X.entity_valid(F.col("author")).alias("ok"), F.when(F.length(F.trim(F.coalesce("author", F.lit("")))) <= 1, "").otherwise(F.col("author")).alias("kept"))


@query(f"with {ART} select article_id, case when regexp_matches({_TEXT}, 'located in|district|border|구역') then 'located_in' when regexp_matches({_TEXT}, 'works at|spokesperson|director|portavoz') then 'works_at' else 'mentioned_with' end as relation from art")
def relation_infer(spark, d):
    t = text_col()
    return articles(spark, d).select("article_id", F.when(t.rlike("located in|district|border|구역"), "located_in").when(t.rlike("works at|spokesperson|director|portavoz"), "works_at").otherwise("mentioned_with").alias("relation"))


_WORD = "(^|[^a-z0-9_])(budget|report|bridge)($|[^a-z0-9_])"


@query(f"with {ART} select article_id, regexp_matches({_TEXT}, '{_WORD}') as hit, cast(len(regexp_extract_all({_TEXT}, 'budget|report|bridge')) as integer) as n from art")
def keyword_regex(spark, d):
    t = text_col()
    return articles(spark, d).select("article_id", t.rlike(_WORD).alias("hit"), F.regexp_count(t, F.lit("budget|report|bridge")).alias("n"))


@query("with s as (select s.source_id, n.code from sources s join (values ('America', 'US'), ('Asia', 'AS'), ('Europe', 'EU')) n(part, code) on split_part(s.tz_name, '/', 1) = n.part) select source_id, code from s")
def country_resolve(spark, d):
    """Exact lookup in a small dimension."""
    dim = spark.createDataFrame([("America", "US"), ("Asia", "AS"), ("Europe", "EU")], "part string, code string")
    s = table(spark, d, "sources").withColumn("part", F.split_part("tz_name", F.lit("/"), F.lit(1)))
    return s.join(F.broadcast(dim), "part").select("source_id", "code")


_TRIM = "regexp_replace({0}, '^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '', 'g')"


def _trimmed(c):
    return F.regexp_replace(c, r"^[ \t\n\r]+|[ \t\n\r]+$", "")


@query(f"with t as (select distinct article_id, {_TRIM.format('crawled_at')} as c from articles where crawled_at is not null) select article_id, case when regexp_matches(c, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') then substr(c, 1, 10) end as d, cast(case when regexp_matches(c, '^[0-9]{{8}}T[0-9]{{6}}Z$') then strptime(c, '%Y%m%dT%H%M%SZ') end as varchar) as g from t")
def gdelt_date(spark, d):
    rows = table(spark, d, "articles").where("crawled_at is not null").select("article_id", _trimmed("crawled_at").alias("c")).distinct()
    day = F.when(F.col("c").rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring("c", 1, 10).try_cast("date"))
    at = F.try_to_timestamp(F.when(F.col("c").rlike(r"^\d{8}T\d{6}Z$"), F.col("c")), F.lit("yyyyMMdd'T'HHmmss'Z'"))
    return rows.select("article_id", day.cast("string").alias("d"), F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("g"))


@query(f"with t as (select distinct {_TRIM.format('published_at')} as raw from articles where published_at is not null) select raw, cast(coalesce(try_strptime(raw, '%Y-%m-%dT%H:%M:%S'), try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%d.%m.%Y %H:%M')) as varchar) as at from t")
def parse_date_multi(spark, d):
    """First of three formats that fits; everything else is part of the timestamp operator."""
    t = table(spark, d, "articles").where("published_at is not null").select(_trimmed("published_at").alias("raw")).distinct()
    fit = lambda p, f: F.try_to_timestamp(F.when(F.col("raw").rlike(p), F.col("raw")), F.lit(f))
    at = F.coalesce(fit(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$", "yyyy-MM-dd'T'HH:mm:ss"), fit(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$", "yyyy-MM-dd HH:mm:ss"), fit(r"^\d\d\.\d\d\.\d{4} \d\d:\d\d$", "dd.MM.yyyy HH:mm"))
    return t.select("raw", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("select doc_id, cast(timestamp '2025-06-30 12:00:00' - (doc_id % 50) * interval 1 hour as varchar) as at from documents")
def parse_date_locale(spark, d):
    """Relative times ('vor 3 Stunden', '3시간 전', ...) against a given instant."""
    n = (F.col("doc_id") % 50).cast("string")
    text = F.when(F.col("doc_id") % 4 == 0, F.concat(n, F.lit(" hours ago"))).when(F.col("doc_id") % 4 == 1, F.concat(n, F.lit("시간 전"))).when(F.col("doc_id") % 4 == 2, F.concat(F.lit("vor "), n, F.lit(" Stunden"))).otherwise(F.concat(F.lit("il y a "), n, F.lit(" heures")))
    at = M.relative_time(text, F.lit("2025-06-30 12:00:00").cast("timestamp"))
    return table(spark, d, "documents").select("doc_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(f"with {ART} select article_id, cast(date_trunc('day', ts) as varchar)[:10] as day, ts is not null and date_trunc('quarter', ts) = timestamp '2024-07-01' as in_period from art")
def period_filter(spark, d):
    return articles(spark, d).select("article_id", F.date_trunc("day", "ts").cast("date").cast("string").alias("day"), F.coalesce(F.date_trunc("quarter", "ts") == F.lit("2024-07-01").cast("timestamp"), F.lit(False)).alias("in_period"))


@query(f"with {ART} select article_id, json_extract_string(to_json({{'t': topic, 'n': word_count}}), '$.t') as t, cast(json_extract_string(to_json({{'t': topic, 'n': word_count}}), '$.n') as integer) as n from art")
def json_parse(spark, d):
    """A struct to JSON text and back under a schema."""
    j = F.from_json(F.to_json(F.struct(F.col("topic").alias("t"), F.col("word_count").alias("n"))), "t string, n int")
    return articles(spark, d).select("article_id", j.alias("j")).select("article_id", "j.t", "j.n")


@query(f"with {ART} select article_id, coalesce(case topic when 'world' then 'international' when 'sport' then 'sports' end, topic) as name from art")
def map_lookup(spark, d):
    names = F.create_map(F.lit("world"), F.lit("international"), F.lit("sport"), F.lit("sports"))
    return articles(spark, d).select("article_id", F.coalesce(F.element_at(names, F.col("topic")), "topic").alias("name"))


@query("select doc_id, coalesce(nullif(trim(json_extract_string('{\"a\": {\"name\": \"' || source || '\"}}', '$.a.name')), ''), 'uncategorized') as category from documents")
def category_extract(spark, d):
    raw = F.concat(F.lit('{"a": {"name": "'), "source", F.lit('"}}'))
    return table(spark, d, "documents").select("doc_id", F.coalesce(F.nullif(F.trim(F.get_json_object(raw, "$.a.name")), F.lit("")), F.lit("uncategorized")).alias("category"))


@query(f"with {ART} select article_id, title from art where source is not null and title is not null")
def json_embedded_article(spark, d):
    """Pages that carry their article as JSON in a script."""
    j = F.to_json(F.struct(F.struct(F.col("title").alias("basic")).alias("headlines"), F.array(F.struct(F.lit("text").alias("type"), F.lit("x").alias("content"))).alias("content_elements")))
    page = F.concat(F.lit("<script>Fusion.globalContent = "), j, F.lit(";</script>"))
    return articles(spark, d).where("source is not null and title is not null").select("article_id", M.embedded_article(page).alias("x")).select("article_id", "x.title")


@query(f"with {ART} select article_id, nullif(trim(author), '') as author from art")
def author_clean(spark, d):
    return articles(spark, d).select("article_id", M.author_clean(F.concat(F.lit("By "), F.coalesce("author", F.lit("")), F.lit(", 2024-05-01"))).alias("author"))


@query(f"with {ART} select article_id, length(coalesce(body, '')) >= 200 as usable, substr(trim(regexp_replace(coalesce(body, ''), '[ \\t\\n\\r\\f\\v]+', ' ', 'g')), 1, 80) as hint from art")
def feed_body_hint(spark, d):
    return articles(spark, d).select("article_id", (F.length(F.coalesce("body", F.lit(""))) >= 200).alias("usable"), F.substring(X.collapse(F.coalesce("body", F.lit(""))), 1, 80).alias("hint"))


@query(f"with {ART} select article_id, title from art")
def strip_ruby(spark, d):
    t = F.concat(F.lit("<ruby>"), F.col("title"), F.lit("<rt>x</rt></ruby>‎"))
    return articles(spark, d).select("article_id", M.strip_ruby(t).alias("title"))


@query(f"with {ART} select article_id, coalesce(nullif(trim(title), ''), nullif(trim(body), ''), url) as text, case when trim(coalesce(title, '')) <> '' then 'title' when trim(coalesce(body, '')) <> '' then 'body' else 'url' end as chosen from art")
def extraction_chain(spark, d):
    ok = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    return articles(spark, d).select("article_id", F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.nullif(F.trim("body"), F.lit("")), "url").alias("text"), F.when(ok("title"), "title").when(ok("body"), "body").otherwise("url").alias("chosen"))


@query()
def try_decode(spark, d):
    """Bytes as UTF-8, else as EUC-KR, else as Latin-1: an Arrow kernel over distinct texts written in turns in each."""
    import pyarrow as pa

    ship(spark)

    def run(batches):
        for b in batches:
            out = []
            for raw in b.column(1).to_pylist():
                for name in ("utf-8", "euc-kr", "latin-1"):
                    try:
                        out.append(raw.decode(name) if raw is not None else None)
                        break
                    except UnicodeDecodeError:
                        continue
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    docs = table(spark, d, "documents").select("doc_id", F.encode("text", "UTF-8").alias("raw"))
    return docs.mapInArrow(run, "doc_id long, text string")


SQL["try_decode"] = "select doc_id, text from documents"


@query("select doc_id, case when rating is null or rating = 0 then 0 else rating end as rating, try_cast(coalesce(lang, 'x') as integer) is null as bad from documents")
def safe_int(spark, d):
    return table(spark, d, "documents").select("doc_id", F.coalesce("rating", F.lit(0)).alias("rating"), F.coalesce("lang", F.lit("x")).try_cast("int").isNull().alias("bad"))


@query("select vec_id, label, list_max(list_transform(embedding, lambda x: abs(x))) > 0 as from_body from embeddings")
def embedding_select(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", F.exists("embedding", lambda x: x != 0).alias("from_body"))


@query("with p as (select a.vec_id as a, b.vec_id as b, list_sum(list_transform(generate_series(1, len(a.embedding)), lambda i: cast(a.embedding[i] as double) * b.embedding[i])) as d, sqrt(list_sum(list_transform(a.embedding, lambda x: pow(cast(x as double), 2)))) as na, sqrt(list_sum(list_transform(b.embedding, lambda x: pow(cast(x as double), 2)))) as nb from embeddings a join embeddings b on a.vec_id + 1 = b.vec_id) select a, b, round(d / (na * nb), 6) as cosine from p")
def cosine_next(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    a, b = v.toDF("a", "ea"), v.toDF("b", "eb")
    return a.join(b, F.col("a") + 1 == F.col("b")).select("a", "b", r6(cosine(F.col("ea"), F.col("eb")), "cosine"))


_CEN = "cen as (select label, i, avg(v) as v from (select label, unnest(generate_series(1, len(embedding))) as i, cast(unnest(embedding) as double) as v from embeddings) group by all)"


@query(f"with {_CEN}, p as (select a.label as a, b.label as b, round(sum(a.v * b.v) / (sqrt(sum(a.v * a.v)) * sqrt(sum(b.v * b.v))), 6) as sim from cen a join cen b on a.i = b.i and a.label % 2 = 0 and b.label % 2 = 1 group by all), m as (select max(sim) >= 0.5 as good from p) select a, b, sim from p, m where sim >= case when good then 0.5 else 0.3 end")
def join_cross_sim(spark, d):
    """Centroids of one half against the other, at 0.5, or at 0.3 if no pair reaches that; centroids are few."""
    c = centroids(table(spark, d, "embeddings"), "label")
    p = c.where("label % 2 = 0").toDF("a", "ea").join(c.where("label % 2 = 1").toDF("b", "eb")).select("a", "b", r6(cosine(F.col("ea"), F.col("eb")), "sim"))
    p = p.withColumn("good", F.max("sim").over(W.partitionBy()) >= 0.5)
    return p.where(F.col("sim") >= F.when(F.col("good"), 0.5).otherwise(0.3)).select("a", "b", "sim")


# rules

_SLOPE = f"with {SCO}, {_SER}, x as (select topic, volume as v, row_number() over (partition by topic order by day) - 1 as i from ser), g as (select topic, round(coalesce(regr_slope(v, i), 0), 8) as slope, round(stddev_pop(v) / (avg(v) + 1e-10), 6) as cv, count(*) filter (where v > 0) as active from x group by topic)"


@query(_SLOPE + " select topic, slope, cv, case when active < 2 then 'plateau' when cv > 1 then 'burst' when slope > 0.01 and cv < 0.5 then 'rising' when slope < -0.01 then 'fading' else 'plateau' end as class from g")
def trajectory_class(spark, d):
    x = _volumes(spark, d).withColumn("i", F.row_number().over(W.partitionBy("topic").orderBy("day")) - 1)
    g = x.groupBy("topic").agg(F.round(F.coalesce(F.regr_slope("value", "i"), F.lit(0.0)), 8).alias("slope"), r6(F.stddev_pop("value") / (F.avg("value") + 1e-10), "cv"), F.count_if(F.col("value") > 0).alias("active"))
    kind = F.when(F.col("active") < 2, "plateau").when(F.col("cv") > 1, "burst").when((F.col("slope") > 0.01) & (F.col("cv") < 0.5), "rising").when(F.col("slope") < -0.01, "fading").otherwise("plateau")
    return g.select("topic", "slope", "cv", kind.alias("class"))


@query("with c as (select event_type, cast(ts as date) as day, count(*) as y from events group by all), x as (select *, row_number() over (partition by event_type order by day) - 1 as t from c) select event_type, round(regr_slope(y, t), 6) as slope, round(regr_r2(y, t), 6) as r2 from x group by event_type")
def linear_slope(spark, d):
    c = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("y"))
    x = c.withColumn("t", F.row_number().over(W.partitionBy("event_type").orderBy("day")) - 1)
    return x.groupBy("event_type").agg(r6(F.regr_slope("y", "t"), "slope"), r6(F.regr_r2("y", "t"), "r2"))


@query("with c as (select event_type, cast(ts as date) as day, count(*) as y from events group by all), x as (select *, row_number() over (partition by event_type order by day) as t from c) select event_type, round(-regr_slope(ln(y), t), 6) as lambda, round(-regr_slope(ln(y), ln(t)), 6) as alpha from x group by event_type")
def power_model(spark, d):
    c = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("y"))
    x = c.withColumn("t", F.row_number().over(W.partitionBy("event_type").orderBy("day")))
    return x.groupBy("event_type").agg(r6(-F.regr_slope(F.ln("y"), "t"), "lambda"), r6(-F.regr_slope(F.ln("y"), F.ln("t")), "alpha"))


@query(_SLOPE + ", z as (select topic, row_number() over (partition by topic order by day) as i, volume as v, avg(volume) over (partition by topic order by day rows between 6 preceding and current row) as m from ser), t as (select z.topic, arg_max(round(m, 6), i) as now, arg_max(round(v, 6), i) as last from z group by z.topic) select topic, case when slope < -0.01 then 'declining' when now <= 3 then 'noise' when now <= 10 then 'weak' when slope > 0.01 then 'emerging' else 'strong' end as state from g join t using (topic)")
def bertrend_state(spark, d):
    w = W.partitionBy("topic").orderBy("day")
    x = _volumes(spark, d).withColumn("i", F.row_number().over(w) - 1).withColumn("m", F.round(F.avg("value").over(w.rowsBetween(-6, 0)), 6))
    g = x.groupBy("topic").agg(F.round(F.coalesce(F.regr_slope("value", "i"), F.lit(0.0)), 8).alias("slope"), F.max_by("m", "day").alias("now"))
    state = F.when(F.col("slope") < -0.01, "declining").when(F.col("now") <= 3, "noise").when(F.col("now") <= 10, "weak").when(F.col("slope") > 0.01, "emerging").otherwise("strong")
    return g.select("topic", state.alias("state"))


_FEAT = """f as (select topic, cast(count(*) as double) as n, count(distinct source) as n_sources, count(distinct steeps) as domains, coalesce(datediff('day', min(day), max(day)), 0) as span_days, coalesce(max(importance) / 100, 0) as novelty,
    coalesce(avg(abs(score)), 0) as ood, coalesce(max(anger), 0) as changepoint, coalesce(max(fear), 0) as entropy_spike, coalesce(max(surprise), 0) as network, cast(coalesce(avg(joy), 0) > 0.2 as int) as transition from sco group by topic)"""


def _features(spark, d):
    return scored(spark, d).groupBy("topic").agg(
        F.count_distinct("source").alias("n_sources"), F.count_distinct("steeps").alias("domains"), F.coalesce(F.datediff(F.max("day"), F.min("day")), F.lit(0)).alias("span_days"), F.coalesce(F.max("importance") / 100, F.lit(0.0)).alias("novelty"),
        F.coalesce(F.avg(F.abs("score")), F.lit(0.0)).alias("ood"), F.coalesce(F.max("anger"), F.lit(0.0)).alias("changepoint"), F.coalesce(F.max("fear"), F.lit(0.0)).alias("entropy_spike"), F.coalesce(F.max("surprise"), F.lit(0.0)).alias("network"), (F.coalesce(F.avg("joy"), F.lit(0.0)) > 0.2).cast("int").alias("transition"),
    )


@query(f"with {SCO}, {_FEAT} select topic, n_sources, domains, cast(span_days as integer) as span_days, round(novelty, 6) as novelty, round(ood, 6) as ood, transition from f")
def topic_features(spark, d):
    return _features(spark, d).select("topic", "n_sources", "domains", "span_days", r6("novelty", "novelty"), r6("ood", "ood"), "transition")


_COMP = "(0.2 * least(1, ood) + 0.15 * least(1, changepoint) + 0.2 * least(1, domains / 6) + 0.15 * transition + 0.1 * least(1, entropy_spike) + 0.1 * least(1, novelty) + 0.1 * least(1, network))"
_N = "(cast(ood > 0.7 or novelty > 0.7 as int) + cast(changepoint > 0.8 and (entropy_spike > 0.5 or network > 0.5) as int) + cast(transition = 1 and domains / 6 > 0.3 as int))"


@query(f"with {SCO}, {_FEAT} select topic, round({_COMP}, 6) as composite from f")
def singularity_composite(spark, d):
    return _features(spark, d).select("topic", r6(signals.composite(), "composite"))


@query(f"with {SCO}, {_FEAT} select topic, ood > 0.7 or novelty > 0.7 as a, changepoint > 0.8 and (entropy_spike > 0.5 or network > 0.5) as b, transition = 1 and domains / 6 > 0.3 as c from f")
def singularity_pathways(spark, d):
    a, b, c = signals.pathways()
    return _features(spark, d).select("topic", a.alias("a"), b.alias("b"), c.alias("c"))


_LAYER = f"case when novelty > 0.7 and domains >= 2 and {_COMP} >= 0.65 and {_N} >= 2 then 'L5_singularity' else '' end"


@query(f"with {SCO}, {_FEAT}, l as (select *, {_LAYER} as layer from f) select topic, layer, round({_COMP}, 6) as composite, round(cast(0.5 as double) + case when {_N} >= 3 then 0.2 else 0 end + case when {_COMP} > 0.8 then 0.15 else 0 end, 6) as confidence, 'Topic ' || topic || ' classified as ' || layer || '. Data span: ' || span_days || 'd, from ' || n_sources || ' sources.' as evidence from l where layer <> ''")
def signals_build(spark, d):
    return signals.build_signals(_features(spark, d)).select("topic", "layer", r6("composite", "composite"), r6("confidence", "confidence"), "evidence")


@query(f"with {SCO}, {_FEAT} select topic, {_LAYER} as layer from f")
def classify_layer(spark, d):
    x = _features(spark, d)
    for c in signals.FEATURES:
        if c not in x.columns:
            x = x.withColumn(c, F.lit(0.0))
    for c in (*signals.FLAGS, "causal"):
        x = x.withColumn(c, F.lit(False))
    return x.withColumn("ma_signal", F.lit(None).cast("string")).select("topic", signals.layer().alias("layer"))


_HITS = ", ".join(f"len(regexp_extract_all({_TEXT}, '{v}')) as {k}" for k, v in SECTORS.items())


@query(f"with {ART} select article_id, {_HITS} from art")
def sector_patterns(spark, d):
    t = text_col()
    return articles(spark, d).select("article_id", *(F.regexp_count(t, F.lit(v)).cast("bigint").alias(k) for k, v in SECTORS.items()))


# joins and aggregations


@query(f"with {ART}, {ANA} select a.article_id, a.topic as topic_article, n.steeps as steeps_analysis, s.group_name from art a left join ana n using (article_id) left join sources s on s.source_id = a.source")
def join_left_multi(spark, d):
    s = table(spark, d, "sources").select(F.col("source_id").alias("source"), "group_name")
    return articles(spark, d).join(analysis(spark, d), "article_id", "left").join(R.checked_broadcast(s), "source", "left").select("article_id", F.col("topic").alias("topic_article"), F.col("steeps").alias("steeps_analysis"), "group_name")


@query("with e as (select doc_id, row_number() over (order by doc_id) as rn from documents) select e.doc_id, v.label from e left join embeddings v on v.vec_id = e.doc_id")
def join_align_index(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "label"), "doc_id", "left").select("doc_id", "label")


@query("with p as (select a.vec_id, list_sum(list_transform(generate_series(1, len(a.embedding)), lambda i: cast(a.embedding[i] as double) * b.embedding[i])) / (sqrt(list_sum(list_transform(a.embedding, lambda x: pow(cast(x as double), 2)))) * sqrt(list_sum(list_transform(b.embedding, lambda x: pow(cast(x as double), 2))))) as s from embeddings a join embeddings b on a.vec_id % 50 = 0) select vec_id, greatest(1, count(*) filter (where round(s, 6) > 0.75) - 1) as covered from p group by vec_id")
def join_coverage_sim(spark, d):
    """How many vectors are as similar, for the query set of ids divisible by 50 against all rows."""
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    q = R.checked_broadcast(v.where("vec_id % 50 = 0").toDF("q", "eq"))
    near = v.crossJoin(q).groupBy(F.col("q").alias("vec_id")).agg((F.count_if(F.round(cosine(F.col("embedding"), F.col("eq")), 6) > 0.75) - 1).alias("n"))
    return near.select("vec_id", F.greatest(F.lit(1), "n").cast("bigint").alias("covered"))


_BASIC = f"with {SCO} "


@query(_BASIC + "select topic, lang, cast(sum(word_count) as bigint) as words, round(avg(score), 6) as tone, cast(min(ts) as varchar) as first_seen, round(max(importance), 6) as top, count(distinct source) as sources, min(source) as any_source from sco group by topic, lang")
def agg_sum_by(spark, d):
    g = scored(spark, d).groupBy("topic", "lang")
    return g.agg(F.sum("word_count").alias("words"), r6(F.avg("score"), "tone"), F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first_seen"), r6(F.max("importance"), "top"), F.count_distinct("source").alias("sources"), F.min("source").alias("any_source"))


@query(_BASIC + "select source, arg_min(title, (coalesce(cast(day as varchar), '9999'), article_id, title)) as first_title from sco where title is not null group by source")
def agg_first(spark, d):
    return scored(spark, d).where("title is not null").groupBy("source").agg(F.min_by("title", F.struct(F.coalesce(F.col("day").cast("string"), F.lit("9999")), "article_id", "title")).alias("first_title"))


@query("select language, count(*) as n from articles group by language order by n desc, language")
def agg_value_counts(spark, d):
    return table(spark, d, "articles").groupBy("language").agg(F.count("*").alias("n"))


@query(
    f"with {ART}, {ENT}, {ANA}, m as (select e.article_id, e.entity, n.score, e.source from ent e join ana n using (article_id)), t as (select entity from m group by entity order by count(*) desc, entity limit 30), k as (select * from m where entity in (select entity from t)) "
    "select a.entity as x, b.entity as y, count(*) as n, round(avg(a.score), 4) as tone, round(avg(cast(coalesce(a.score < 0, false) as int)), 6) as negative from k a join k b on a.article_id = b.article_id and a.source is not distinct from b.source and a.entity < b.entity group by all having count(*) >= 3"
)
def fi2_pair_tensions(spark, d):
    m = entities(spark, d).select("article_id", "entity", "source").join(analysis(spark, d).select("article_id", "score"), "article_id")
    top = m.groupBy("entity").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "entity").limit(30).select("entity")
    k = m.join(F.broadcast(top), "entity", "left_semi").select("article_id", "entity", "source", "score")
    a, b = k.alias("a"), k.alias("b")
    j = a.join(b, (F.col("a.article_id") == F.col("b.article_id")) & F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.entity") < F.col("b.entity")))
    g = j.groupBy(F.col("a.entity").alias("x"), F.col("b.entity").alias("y")).agg(F.count("*").alias("n"), F.round(F.avg("a.score"), 4).alias("tone"), r6(F.avg(F.coalesce(F.col("a.score") < 0, F.lit(False)).cast("double")), "negative"))
    return g.where("n >= 3")


@query(f"with {SCO}, f as (select 'tone' as kind, topic as name, round(avg(score), 6) as magnitude from sco group by topic union all select 'share', lang, round(count(*) / (select count(*) from sco), 6) from sco group by lang union all select 'importance', source, round(avg(importance) / 100, 6) from sco group by source) select kind, name, magnitude from f where magnitude is not null order by abs(magnitude) desc, kind, name limit 15")
def syn_findings(spark, d):
    s = scored(spark, d)
    n = s.agg(F.count("*").alias("n"))
    a = s.groupBy(F.col("topic").alias("name")).agg(r6(F.avg("score"), "magnitude")).select(F.lit("tone").alias("kind"), "name", "magnitude")
    b = s.groupBy(F.col("lang").alias("name")).agg(F.count("*").alias("c")).crossJoin(F.broadcast(n)).select(F.lit("share").alias("kind"), "name", r6(F.col("c") / F.col("n"), "magnitude"))
    c = s.groupBy(F.col("source").alias("name")).agg(r6(F.avg("importance") / 100, "magnitude")).select(F.lit("importance").alias("kind"), "name", "magnitude")
    return a.unionByName(b).unionByName(c).where("magnitude is not null").orderBy(F.abs("magnitude").desc(), "kind", "name").limit(15)


@query(f"with {SCO}, m as (select topic, lang, round(avg(score), 6) as s, count(*) as n from sco group by all having count(*) >= 5) select arg_min(topic || '/' || lang, (s, topic, lang)) as lowest, min(s) as low, arg_min(topic || '/' || lang, (-s, topic, lang)) as highest, max(s) as high from m")
def syn_summary(spark, d):
    m = scored(spark, d).groupBy("topic", "lang").agg(r6(F.avg("score"), "s"), F.count("*").alias("n")).where("n >= 5").withColumn("name", F.concat_ws("/", "topic", "lang"))
    return m.agg(F.min_by("name", F.struct("s", "topic", "lang")).alias("lowest"), F.min("s").alias("low"), F.min_by("name", F.struct(-F.col("s"), "topic", "lang")).alias("highest"), F.max("s").alias("high"))


@query(f"with {SCO}, g as (select source, day, " + ", ".join(f"avg({e}) as {e}" for e in EMOTIONS) + " from sco where day is not null group by all) select a.source, cast(a.day as varchar) as day, " + ", ".join(f"round(a.{e} - b.{e}, 4) as {e}" for e in EMOTIONS) + " from g a join g b on a.source = b.source and b.day = a.day - 7")
def emotion_trajectory(spark, d):
    g = scored(spark, d).where("day is not null").groupBy("source", "day").agg(*(F.avg(e).alias(e) for e in EMOTIONS))
    b = g.select("source", F.date_add("day", 7).alias("day"), *(F.col(e).alias(f"p_{e}") for e in EMOTIONS))
    return g.join(b, ["source", "day"]).select("source", F.col("day").cast("string").alias("day"), *(F.round(F.col(e) - F.col(f"p_{e}"), 4).alias(e) for e in EMOTIONS))


@query(f"with {ART}, s as (select topic, list_distinct(list(source)) as s from art where topic <> '-1' group by topic) select a.topic as a, b.topic as b, round(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))), 6) as j from s a join s b on a.topic < b.topic where len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) >= 0.001")
def topic_jaccard(spark, d):
    """Overlap of the sources of two topics."""
    s = articles(spark, d).where("topic <> '-1'").groupBy("topic").agg(F.collect_set("source").alias("s"))
    a, b = s.toDF("a", "sa"), s.toDF("b", "sb")
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", r6(X.jaccard(F.col("sa"), F.col("sb")), "j")).where("j >= 0.001")


@query(f"with {ART}, {ENT}, l as (select topic, entity, count(distinct article_id) as n from ent where topic <> '-1' group by all), r as (select *, row_number() over (partition by topic order by n desc, entity) as rk from l) select topic, entity, n, round(least(1, n / 10), 6) as strength from r where rk <= 10")
def graphrag_chain(spark, d):
    l = entities(spark, d).where("topic <> '-1'").groupBy("topic", "entity").agg(F.count_distinct("article_id").alias("n"))
    return R.topk_group(l, "topic", [F.desc("n"), F.col("entity")], 10).select("topic", "entity", "n", r6(F.least(F.lit(1.0), F.col("n") / 10), "strength"))


@query(f"with {ART}, g as (select t.topic, y.day from (select topic from art where day is not null and topic <> '-1' group by topic having count(distinct day) >= 7) t cross join (select distinct day from art where day is not null) y) select g.topic, cast(g.day as varchar) as day, count(a.article_id) as n from g left join art a on a.topic = g.topic and a.day = g.day group by all")
def topic_daily_obs(spark, d):
    a = articles(spark, d).where("day is not null").select("topic", "day")
    t = a.where("topic <> '-1'").groupBy("topic").agg(F.count_distinct("day").alias("k")).where("k >= 7").select("topic")
    grid = a.select("day").distinct().crossJoin(R.checked_broadcast(t))
    return grid.join(a.groupBy("topic", "day").agg(F.count("*").alias("n")), ["topic", "day"], "left").select("topic", F.col("day").cast("string").alias("day"), F.coalesce("n", F.lit(0)).alias("n"))


@query(f"with {ART} select source, topic, count(*) as n, min(article_id) as first_id from art where source is not null group by source, topic")
def source_topic(spark, d):
    return articles(spark, d).where("source is not null").groupBy("source", "topic").agg(F.count("*").alias("n"), F.min("article_id").alias("first_id"))


# windows


@query("with x as (select event_type, cast(ts as date) as day, count(*) as n, max(value) as v from events group by all) select event_type, cast(day as varchar) as day, cast(sum(n) over w as bigint) as total, round(last_value(case when v > 90 then v end ignore nulls) over (partition by event_type order by day rows unbounded preceding), 6) as last_high, row_number() over (partition by event_type order by n desc, day) <= 3 as top3, ntile(2) over w as half from x window w as (partition by event_type order by day)")
def win_cumsum(spark, d):
    x = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.max("value").alias("v"))
    w = W.partitionBy("event_type").orderBy("day")
    return x.select("event_type", F.col("day").cast("string").alias("day"), F.sum("n").over(w).alias("total"), r6(F.last(F.when(F.col("v") > 90, F.col("v")), True).over(w.rowsBetween(W.unboundedPreceding, 0)), "last_high"), (F.row_number().over(W.partitionBy("event_type").orderBy(F.desc("n"), "day")) <= 3).alias("top3"), F.ntile(2).over(w).cast("bigint").alias("half"))


@query(f"with {ART}, c as (select day, topic, count(*) as n from art where day is not null group by all), b as (select topic, sum(n) as n from c where day <= (select min(day) + 30 from c) group by topic), l as (select topic, n from c where day = (select max(day) from c)), u as (select topic, coalesce(l.n, 0) + 1e-10 as p, coalesce(b.n, 0) + 1e-10 as q from b full join l using (topic)) select round(sum(p / (select sum(p) from u) * ln((p / (select sum(p) from u)) / (q / (select sum(q) from u)))), 6) as kl from u")
def win_kl_baseline(spark, d):
    c = articles(spark, d).where("day is not null").groupBy("day", "topic").agg(F.count("*").alias("n"))
    c = c.withColumn("a", F.min("day").over(W.partitionBy())).withColumn("z", F.max("day").over(W.partitionBy()))
    u = c.groupBy("topic").agg((F.coalesce(F.sum(F.when(F.col("day") == F.col("z"), F.col("n"))), F.lit(0)) + 1e-10).alias("p"), (F.coalesce(F.sum(F.when(F.col("day") <= F.date_add("a", 30), F.col("n"))), F.lit(0)) + 1e-10).alias("q"), F.max((F.col("day") == F.col("z")) | (F.col("day") <= F.date_add("a", 30))).alias("k")).where("k")
    t = u.agg(F.sum("p").alias("sp"), F.sum("q").alias("sq"))
    return u.crossJoin(F.broadcast(t)).agg(r6(F.sum(F.col("p") / F.col("sp") * F.ln((F.col("p") / F.col("sp")) / (F.col("q") / F.col("sq")))), "kl"))


@query("select doc_id, n_chars from documents order by n_chars desc nulls last, doc_id limit 20")
def limit_head(spark, d):
    return table(spark, d, "documents").orderBy(F.col("n_chars").desc_nulls_last(), "doc_id").select("doc_id", "n_chars").limit(20)


@query(f"with {ANA} select article_id, round(importance, 6) as importance from ana where importance is not null order by importance desc, article_id limit 10")
def topk_nlargest(spark, d):
    return analysis(spark, d).where("importance is not null").orderBy(F.desc("importance"), "article_id").select("article_id", r6("importance", "importance")).limit(10)


@query("select source_id from sources union all select source from documents")
def set_union_all(spark, d):
    return table(spark, d, "sources").select("source_id").unionByName(table(spark, d, "documents").select(F.col("source").alias("source_id")))


@query("select distinct lang, source from documents")
def set_distinct(spark, d):
    return table(spark, d, "documents").select("lang", "source").distinct()


@query(f"with {ART}, s as (select topic, list_distinct(list(source)) as s from art group by topic) select a.topic as a, b.topic as b, len(list_distinct(list_concat(a.s, b.s))) as n from s a join s b on a.topic < b.topic")
def set_union_size(spark, d):
    s = articles(spark, d).groupBy("topic").agg(F.collect_set("source").alias("s"))
    return s.toDF("a", "sa").join(s.toDF("b", "sb"), F.col("a") < F.col("b")).select("a", "b", F.size(F.array_union("sa", "sb")).cast("bigint").alias("n"))


@query("with r as (select *, row_number() over (partition by article_id order by batch_no desc, seen_at desc, title desc, simhash desc) as rn from content_hashes) select article_id, title from r where rn = 1")
def upsert_replace(spark, d):
    return R.keep_last(table(spark, d, "content_hashes"), ["article_id"], [F.col(c) for c in ("batch_no", "seen_at", "title", "simhash")]).select("article_id", "title")


@query("select s.language, count(*) as n, round(avg(a.word_count), 6) as words from articles a join sources s on s.source_id = a.source where a.word_count > 10 group by s.language order by n desc, s.language limit 5")
def sql_adhoc(spark, d):
    return spark.sql("select s.language, count(*) as n, round(avg(a.word_count), 6) as words from {a} a join {s} s on s.source_id = a.source where a.word_count > 10 group by s.language order by n desc, s.language limit 5", a=table(spark, d, "articles"), s=table(spark, d, "sources"))


# series and graphs


@query(
    f"with {SCO}, {_SER}, z as (select *, row_number() over (partition by topic order by day) - 1 as t, count(*) over (partition by topic) as n, volume - avg(volume) over (partition by topic) as y from ser), k as (select topic, n, t, y, unnest(generate_series(2, cast(n // 2 as bigint))) as k from z), "
    "p as (select topic, n, k, pow(sum(y * cos(2 * pi() * k * t / n)), 2) + pow(sum(y * sin(2 * pi() * k * t / n)), 2) as p from k group by all), g as (select topic, max(n) as n, count(*) as m, max(p) / sum(p) as g from p group by topic) select topic, round(g, 6) as g, round(least(1, m * pow(1 - g, m - 1)), 6) as p from g"
)
def ts_seasonality(spark, d):
    """Fisher's test of the largest periodogram ordinate."""
    w = W.partitionBy("topic")
    z = _volumes(spark, d).withColumn("t", F.row_number().over(w.orderBy("day")) - 1).withColumn("n", F.count("*").over(w)).withColumn("y", F.col("value") - F.avg("value").over(w))
    k = z.select("topic", "n", "t", "y", F.explode(F.sequence(F.lit(2), F.floor(F.col("n") / 2).cast("int"))).alias("k"))
    angle = 2 * F.pi() * F.col("k") * F.col("t") / F.col("n")
    p = k.groupBy("topic", "k").agg((F.sum(F.col("y") * F.cos(angle)) ** 2 + F.sum(F.col("y") * F.sin(angle)) ** 2).alias("p"))
    g = p.groupBy("topic").agg(F.count("*").alias("m"), (F.max("p") / F.sum("p")).alias("g"))
    return g.select("topic", r6("g", "g"), r6(F.least(F.lit(1.0), F.col("m") * F.pow(1 - F.col("g"), F.col("m") - 1)), "p"))


@query(
    "with w as (select source, unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) as w from documents where text is not null and lang = 'en'), v as (select w from w group by w order by count(*) desc, w limit 300), c as (select s.source, v.w, (select count(*) from w x where x.source = s.source and x.w = v.w) + 1e-10 as n from (select distinct source from w) s cross join v), "
    "p as (select source, w, n / sum(n) over (partition by source) as p from c) select a.source as a, b.source as b, round(sum(a.p * ln(a.p / b.p) + b.p * ln(b.p / a.p)) / 2, 6) as kl from p a join p b on a.w = b.w and a.source < b.source group by all"
)
def kl_sym_frames(spark, d):
    """Symmetric divergence of the words of two sources over a common vocabulary."""
    w = table(spark, d, "documents").where("text is not null and lang = 'en'").select("source", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0))).alias("w"))
    v = F.broadcast(w.groupBy("w").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "w").limit(300).select("w"))
    n = w.join(v, "w", "left_semi").groupBy("source", "w").agg(F.count("*").alias("n"))
    grid = w.select("source").distinct().crossJoin(v).join(n, ["source", "w"], "left").withColumn("n", F.coalesce("n", F.lit(0)) + 1e-10)
    p = grid.select("source", "w", (F.col("n") / F.sum("n").over(W.partitionBy("source"))).alias("p"))
    a, b = p.toDF("a", "w", "pa"), p.toDF("b", "w", "pb")
    return a.join(b, "w").where("a < b").groupBy("a", "b").agg(r6(F.sum(F.col("pa") * F.ln(F.col("pa") / F.col("pb")) + F.col("pb") * F.ln(F.col("pb") / F.col("pa"))) / 2, "kl"))


# Seed words of five frames.
FRAME_SEEDS = {
    "economic": "economy gdp inflation market trade fiscal monetary budget growth recession unemployment investment stock bond currency export import",
    "security": "military defense security weapon nuclear army threat terrorism intelligence missile conflict war peace treaty sanctions alliance",
    "human_interest": "people community family health education social welfare poverty rights culture victim survivor refugee humanitarian crisis",
    "political": "government president parliament election party policy legislation democracy opposition vote reform minister congress senate diplomatic",
    "scientific": "research science technology data study discovery innovation ai climate energy environment experiment analysis evidence",
}


def frame_divergence(docs, vocabulary: int = 5000):
    """(topic, a, b, kl, strength, masses of five frames in a and b) of the TF-IDF distributions of each two sources of a topic; docs: (topic, source, text) in any language."""
    stop = StopWordsRemover.loadDefaultStopWords("english")
    w = docs.where("topic is not null and source is not null").select("topic", "source", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))).alias("w")).where(~F.col("w").isin(stop))
    tf = settle(w.groupBy("topic", "source", "w").agg(F.count("*").alias("tf")))
    n = tf.groupBy("topic").agg(F.count_distinct("source").alias("n")).where("n >= 2")
    v = tf.groupBy("topic", "w").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).join(F.broadcast(n), "topic").where("df <= 0.95 * n")
    v = v.withColumn("r", F.row_number().over(W.partitionBy("topic").orderBy(F.desc("total"), "w"))).where(F.col("r") <= vocabulary)
    x = tf.join(v, ["topic", "w"]).select("topic", "source", "w", (F.col("tf") * (F.ln((1 + F.col("n")) / (1 + F.col("df"))) + 1)).alias("s"))
    frames = {k: s.split() for k, s in FRAME_SEEDS.items()}

    def run(p):
        m = p.pivot(index="source", columns="w", values="s").fillna(0).sort_index()
        q = m.to_numpy()
        q = q / q.sum(1, keepdims=True) + 1e-10
        q /= q.sum(1, keepdims=True)
        log = np.log(q)
        cross = q @ log.T
        own = np.diag(cross)
        kl = (own[:, None] + own[None, :] - cross - cross.T) / 2
        mass = {k: q[:, m.columns.isin(s)].sum(1) for k, s in frames.items()}
        i, j = np.triu_indices(len(q), 1)
        out = {"topic": p["topic"].iloc[0], "a": m.index[i], "b": m.index[j], "kl": kl[i, j].round(6), "strength": np.minimum(1, kl[i, j] / 10).round(6)}
        return pd.DataFrame(out | {f"{k}_{s}": x[at].round(6) for k, x in mass.items() for s, at in (("a", i), ("b", j))})

    return x.groupBy("topic").applyInPandas(run, "topic string, a string, b string, kl double, strength double, " + ", ".join(f"{k}_{s} double" for k in frames for s in "ab"))


@query()
def kl_frames_topics(spark, d):
    """The divergence of sources by topic over all articles and the topic's vocabulary, with frames."""
    ship(spark)
    return frame_divergence(articles(spark, d).select("topic", "source", text_col().alias("text")))


@query(f"with {ART}, {ENT}, e as (select strftime(a.day, '%G-W%V') as week, a.entity as x, b.entity as y, count(*) as w from ent a join ent b on a.article_id = b.article_id and a.entity < b.entity where a.day is not null and b.day is not distinct from a.day group by all), n as (select week, count(distinct z) as n from (select week, x as z from e union all select week, y from e) group by week), m as (select week, count(*) as m from e group by week) select week, n as nodes, m as edges, round(2 * m / (n * (n - 1)), 6) as density, round(2 * m / n, 6) as degree from n join m using (week)")
def net_evolution(spark, d):
    """Density and mean degree of the weekly entity graphs."""
    x = entities(spark, d).where("day is not null").select("article_id", X.iso_week(F.col("day")).alias("week"), "entity").distinct()
    a, b = x.toDF("article_id", "week", "x"), x.toDF("article_id", "week", "y")
    e = a.join(b, ["article_id", "week"]).where("x < y").select("week", "x", "y").distinct()
    n = e.select("week", F.explode(F.array("x", "y")).alias("z")).groupBy("week").agg(F.count_distinct("z").alias("nodes"))
    return e.groupBy("week").agg(F.count("*").alias("edges")).join(n, "week").select("week", "nodes", "edges", r6(2 * F.col("edges") / (F.col("nodes") * (F.col("nodes") - 1)), "density"), r6(2 * F.col("edges") / F.col("nodes"), "degree"))


@query()
def ea1_trajectory(spark, d):
    """Slope, spread and class of the weekly co-occurrence rank of entities with ten mentions or more, weeks without mention 0."""
    m = I.having(entities(spark, d).where("day is not null"), "entity", 10).withColumn("week", X.iso_week(F.col("day")))
    m = settle(m.select("article_id", "entity", "week").distinct())
    a, b = m.toDF("article_id", "src", "week"), m.toDF("article_id", "dst", "week")
    e = a.join(b, ["article_id", "week"]).where("src <> dst").groupBy("week", "src", "dst").agg(F.count("*").cast("double").alias("weight"))
    # one graph whose nodes are (week, entity), so that all weeks iterate together
    joined = e.select(F.concat_ws("|", "week", "src").alias("src"), F.concat_ws("|", "week", "dst").alias("dst"), "weight")
    rank = graph.pagerank(joined, rounds=10).select(F.split_part("node", F.lit("|"), F.lit(1)).alias("week"), F.split_part("node", F.lit("|"), F.lit(2)).alias("entity"), "rank")
    weeks = m.select("week").distinct()
    grid = rank.select("entity").distinct().crossJoin(F.broadcast(weeks)).join(rank, ["entity", "week"], "left").withColumn("rank", F.coalesce("rank", F.lit(0.0)))
    x = grid.withColumn("i", F.row_number().over(W.partitionBy("entity").orderBy("week")) - 1)
    g = x.groupBy("entity").agg(F.round(F.coalesce(F.regr_slope("rank", "i"), F.lit(0.0)), 8).alias("slope"), r6(F.stddev_pop("rank") / (F.avg("rank") + 1e-10), "cv"), F.count_if(F.col("rank") > 0).alias("active"))
    kind = F.when(F.col("active") < 2, "plateau").when(F.col("cv") > 1, "burst").when((F.col("slope") > 0.01) & (F.col("cv") < 0.5), "rising").when(F.col("slope") < -0.01, "fading").otherwise("plateau")
    return g.select("entity", "slope", "cv", kind.alias("class"))


@query(f"with {ART}, x as (select article_id, topic, source, ts from art where ts is not null and topic <> '-1' and source is not null), ed as (select a.source as src, b.source as dst, cast(count(*) as double) as weight from x a join x b on a.topic = b.topic and a.source <> b.source and a.ts < b.ts and epoch(b.ts) - epoch(a.ts) <= 86400 group by all), {_PR} select node as source, round(rank, 6) as rank from r10")
def nf5_info_flow(spark, d):
    """Flow of topics between sources within a day, and the sources' rank in it."""
    from corpusmill.operators.relational import range_join

    x = articles(spark, d).where("ts is not null and topic <> '-1' and source is not null").select("article_id", "topic", "source", "ts")
    j = range_join(x, x, "topic", "ts", 24).where("a.source <> b.source and a.ts < b.ts")
    e = settle(j.groupBy(F.col("a.source").alias("src"), F.col("b.source").alias("dst")).agg(F.count("*").cast("double").alias("weight")))
    return graph.pagerank(e, rounds=10).select(F.col("node").alias("source"), r6("rank", "rank"))


@query()
def hdbscan(spark, d):
    """Dense groups of vectors by mutual reachability: components of the links shorter than the median core distance of each label.

    Equal vectors are one node with their number as weight: they count as neighbours of each other for
    the core distance (the fifth neighbour) and in its median, and are in one cluster if dense at all.
    """
    from corpusmill.operators.serving import l2_distance

    v = table(spark, d, "embeddings").select("vec_id", "label", "embedding")
    one = settle(v.where("vec_id is not null and label is not null and embedding is not null").groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count_distinct("vec_id").alias("n")))
    a, b = one.toDF("label", "ea", "a", "na"), one.toDF("label", "eb", "b", "nb")
    pairs = a.join(b, "label").select("label", "a", "na", "b", "nb", l2_distance(F.col("ea"), F.col("eb")).alias("dist"))
    near = F.sum(F.when(F.col("a") == F.col("b"), F.col("nb") - 1).otherwise(F.col("nb"))).over(W.partitionBy("label", "a").orderBy("dist", "b"))
    core = settle(pairs.withColumn("near", near).where("near >= 5").groupBy("label", "a", "na").agg(F.min("dist").alias("core")))
    cut = core.groupBy("label").agg(F.percentile("core", F.lit(0.5), F.col("na")).alias("cut"))
    dense = core.join(cut, "label").where("core <= cut")
    links = pairs.where("a < b or a = b and na > 1").join(dense.select("label", "a", "cut"), ["label", "a"]).join(dense.select("label", F.col("a").alias("b")), ["label", "b"]).where("dist <= cut")
    c = graph.components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    found = one.join(c, "node").select("label", "embedding", "component")
    return v.join(found, ["label", "embedding"], "left").select("vec_id", F.coalesce("component", F.lit(-1)).alias("cluster"))


@query(f"with {ANA} select sentiment_label, count(*) as n, round(avg(score), 6) as mean from ana where sentiment_label is not null group by sentiment_label")
def db_sentiment_share(spark, d):
    return analysis(spark, d).where("sentiment_label is not null").groupBy("sentiment_label").agg(F.count("*").alias("n"), r6(F.avg("score"), "mean"))


@query(f"with {ANA} select " + ", ".join(f"round(avg({e}), 6) as {e}" for e in EMOTIONS) + " from ana")
def db_emotion_avg(spark, d):
    return analysis(spark, d).agg(*(r6(F.avg(e), e) for e in EMOTIONS))


@query(f"with {SCO}, {_SER} select topic, cast(day as varchar) as day, volume from ser where topic in ('politics', 'world') and volume > 0")
def db_series_filter(spark, d):
    return I.daily_series(scored(spark, d)).where("topic in ('politics', 'world') and volume > 0").select("topic", F.col("day").cast("string").alias("day"), "volume")


_EPU_KEYS = "', '".join(EPU)


