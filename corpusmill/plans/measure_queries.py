"""Single measures, windows, aggregates and labels under their own names, pages written by hand, and the bounds of metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import markup as M
from corpusmill.operators import insights as I
from corpusmill.operators.serving import cosine as cosine_of
from corpusmill.plans import insight_queries as Q
from corpusmill.plans import series_queries
from corpusmill.plans.bindings import ANA, ART, articles, r6, registry
from corpusmill.plans.insight_queries import _HHI, _MA, _SER, ENT, SCO, _volumes, scored
from corpusmill.plans.survey_queries import _values
from corpusmill.plans.survey_queries import _place as place
from corpusmill.sources import files
from corpusmill.sources.tables import table

QUERIES, SQL, query = registry()
W = Window
_TEXT = "lower(coalesce(title, '') || ' ' || coalesce(body, ''))"


def _lower_text():
    return F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("body", F.lit(""))))


# ---- pages and configuration written by hand ----

PAGES = [
    (1, """<!DOCTYPE html><html><head><title>Old mill saved | Hoti Post</title><meta property="article:published_time" content="2025-01-03T08:00:00Z"><meta name="author" content="By Jane Roe"></head>
<body><nav><ul><li><a href="/home">Home</a></li></ul></nav><article><h1>Old mill saved</h1><p>The council voted &amp; the mill stays.</p><p>Work starts in May.</p><a href="https://hoti.example/a/2#c">More</a></article><script>var a = "<p>no</p>";</script></body></html>"""),
    (2, "<html><head><title>Wasser &ndash; Bericht</title></head><body><article><h1>Wasser &ndash; Bericht</h1><p>Der Bericht liegt vor.</p></article><a href='/b/3'>Weiter</a></body></html>"),
    (3, "<html><body><p>no title here</p></body></html>"),
]


@query(f"select id, title, published, author from {_values([(1, 'Old mill saved', '2025-01-03T08:00:00Z', 'Jane Roe'), (2, 'Wasser – Bericht', None, None), (3, '', None, None)], 'id, title, published, author')}")
def scan_html(spark, d):
    """Titles, dates and authors of whole pages read as files; the expected values were read off the pages by hand."""
    path = place(spark, "pages")
    spark.createDataFrame(PAGES, "id int, html string").repartition(1).select(F.concat(F.lit("<!-- "), F.col("id").cast("string"), F.lit(" -->"), F.replace("html", F.lit("\n"), F.lit(" "))).alias("value")).write.text(path)
    rows = files.scan_pages(spark, path).select(F.explode(F.filter(F.split("html", "\n"), lambda x: x != "")).alias("html"))
    return rows.select(F.regexp_extract("html", r"^<!-- (\d+) -->", 1).cast("int").alias("id"), F.coalesce(M.html_title(F.col("html")), F.lit("")).alias("title"), M.html_date(F.col("html")).alias("published"), M.html_author(F.col("html")).alias("author"))


@query(f"select id, title from {_values([(1, 'Old mill saved'), (2, 'Wasser – Bericht')], 'id, title')}")
def html_title_pages(spark, d):
    rows = spark.createDataFrame(PAGES[:2], "id int, html string")
    return rows.select("id", M.html_title(F.col("html")).alias("title"))


SITEMAP = """<?xml version="1.0"?><urlset><url><loc>https://hoti.example/a/1</loc><lastmod>2025-01-03</lastmod></url><url><loc>https://hoti.example/a/2?x=1&amp;y=2</loc></url><url><loc>https://hoti.example/a/3</loc><lastmod>2025-01-05T10:00:00+00:00</lastmod><priority>0.5</priority></url></urlset>"""


@query(f"select url, modified from {_values([('https://hoti.example/a/1', '2025-01-03'), ('https://hoti.example/a/2?x=1&y=2', None), ('https://hoti.example/a/3', '2025-01-05T10:00:00+00:00')], 'url, modified')}")
def scan_sitemap(spark, d):
    rows = spark.createDataFrame([(SITEMAP,)], "xml string")
    return rows.select(F.explode(M.feed_items(F.col("xml"))).alias("x")).select("x.url", F.col("x.published").alias("modified"))


CONFIG = '[{"id": "hoti", "url": "https://hoti.example", "every": 15}, {"id": "sogo", "every": 60, "extra": true}]'


@query(f"select * from {_values([('hoti', 'https://hoti.example', 15), ('sogo', None, 60)], 'id, url, every')}")
def scan_config_yaml(spark, d):
    """A small configuration (JSON is YAML too) as a dimension table."""
    return files.scan_config(spark, CONFIG, T.StructType([T.StructField("id", T.StringType()), T.StructField("url", T.StringType()), T.StructField("every", T.IntegerType())]))


# ---- measures of vectors and distributions ----


@query("select vec_id, round(list_sum(list_transform(generate_series(1, len(embedding)), lambda i: cast(embedding[i] as double) * embedding[len(embedding) + 1 - i])) / list_sum(list_transform(embedding, lambda x: pow(cast(x as double), 2))), 6) as cosine from embeddings")
def cosine(spark, d):
    """Cosine of each vector with itself reversed."""
    return table(spark, d, "embeddings").select("vec_id", r6(cosine_of(F.col("embedding"), F.reverse("embedding")), "cosine"))


@query(f"with {SCO}, p as (select topic, n / sum(n) over (partition by topic) as p from (select topic, source, count(*) as n from sco where source is not null group by all)) select topic, round(-sum(p * ln(p)), 6) as nats from p group by topic")
def entropy_nats(spark, d):
    return I.entropy(scored(spark, d).where("source is not null"), "topic", "source").select("topic", r6(F.col("bits") * F.ln(F.lit(2.0)), "nats"))


_DAYS = "c as (select event_type, cast(ts as date) as day, count(*) as y from events group by all), x as (select *, row_number() over (partition by event_type order by day) as t from c)"


def _event_days(spark, d):
    c = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("y"))
    return c.withColumn("t", F.row_number().over(W.partitionBy("event_type").orderBy("day")))


@query(f"with {_DAYS} select event_type, round(regr_r2(y, t), 6) as r2 from x group by event_type")
def r_squared(spark, d):
    return _event_days(spark, d).groupBy("event_type").agg(r6(F.regr_r2("y", "t"), "r2"))


@query(f"with {_DAYS} select event_type, round(exp(regr_intercept(ln(y), t)), 6) as start, round(regr_slope(ln(y), t), 6) as rate from x group by event_type")
def exp_model(spark, d):
    """Exponential growth by least squares on logarithms."""
    return _event_days(spark, d).groupBy("event_type").agg(r6(F.exp(F.regr_intercept(F.ln("y"), "t")), "start"), r6(F.regr_slope(F.ln("y"), "t"), "rate"))


# ---- windows over the daily series ----


@query(f"with {SCO}, {_SER}, {_MA} select topic, cast(day as varchar) as day, round(ma_short, 6) as ma_short, round(ma_long, 6) as ma_long from ma")
def win_ma_full(spark, d):
    """Means of full windows only."""
    return I.moving_averages(_volumes(spark, d), "topic", "value").select("topic", F.col("day").cast("string").alias("day"), r6("ma_short", "ma_short"), r6("ma_long", "ma_long"))


@query(f"with {SCO}, {_SER} select topic, cast(day as varchar) as day, round(cast({Q._GRAD.format('volume')} as double), 6) as velocity from ser window w as (partition by topic order by day)")
def win_gradient(spark, d):
    """Central differences, one-sided at the ends."""
    return I.gradient(_volumes(spark, d), "topic", "value").select("topic", F.col("day").cast("string").alias("day"), r6("velocity", "velocity"))


@query(Q.SQL["nf2_frame_shift"])
def win_lag_kl(spark, d):
    return Q.nf2_frame_shift(spark, d)


@query(f"with {SCO}, {_SER} select topic, cast(day as varchar) as day, volume - lag(volume) over (partition by topic order by day) as change from ser")
def win_diff(spark, d):
    w = W.partitionBy("topic").orderBy("day")
    return I.daily_series(scored(spark, d)).select("topic", F.col("day").cast("string").alias("day"), (F.col("volume") - F.lag("volume").over(w)).alias("change"))


@query(f"with {SCO}, {_SER}, r as (select topic, day, volume, row_number() over (partition by topic order by volume desc, day) as rank from ser) select topic, cast(day as varchar) as day, volume, cast(rank as integer) as rank from r where rank <= 3")
def win_rank_topn(spark, d):
    w = W.partitionBy("topic").orderBy(F.desc("volume"), "day")
    return I.daily_series(scored(spark, d)).withColumn("rank", F.row_number().over(w)).where("rank <= 3").select("topic", F.col("day").cast("string").alias("day"), "volume", "rank")


@query(f"with {SCO}, {_SER} select topic, arg_max(volume, day) as last, cast(max(day) as varchar) as day from ser group by topic")
def win_last_value(spark, d):
    """The last value of each series, as an aggregate that combines on the map side."""
    return I.daily_series(scored(spark, d)).groupBy("topic").agg(F.max_by("volume", "day").alias("last"), F.max("day").cast("string").alias("day"))


@query(f"with {SCO}, {_SER}, x as (select topic, day, volume, row_number() over (partition by topic order by day) - 1 as i from ser), g as (select topic, regr_slope(volume, i) as b, regr_intercept(volume, i) as a from x group by topic), r as (select topic, day, volume - (a + b * i) as r from x join g using (topic)), s as (select topic, stddev_pop(r) as s from r group by topic) select topic, cast(day as varchar) as day, round(r / s, 4) as z from r join s using (topic) where s > 0 and abs(r / s) > 3")
def win_resid_anomaly(spark, d):
    """Days more than three deviations off the linear trend."""
    x = I.daily_series(scored(spark, d)).withColumn("i", F.row_number().over(W.partitionBy("topic").orderBy("day")) - 1)
    g = x.groupBy("topic").agg(F.regr_slope("volume", "i").alias("b"), F.regr_intercept("volume", "i").alias("a"))
    r = x.join(g, "topic").select("topic", "day", (F.col("volume") - (F.col("a") + F.col("b") * F.col("i"))).alias("r"))
    z = r.join(r.groupBy("topic").agg(F.stddev_pop("r").alias("s")).where("s > 0"), "topic").withColumn("z", F.col("r") / F.col("s"))
    return z.where(F.abs("z") > 3).select("topic", F.col("day").cast("string").alias("day"), F.round("z", 4).alias("z"))


@query(f"with {SCO}, {_SER}, b as (select topic, min(day) as a, max(day) as z from ser group by topic) select topic, round(avg(volume) filter (where day <= a + cast((z - a) // 2 as integer)), 6) as first, round(avg(volume) filter (where day > a + cast((z - a) // 2 as integer)), 6) as second from ser join b using (topic) group by topic")
def win_first_half_split(spark, d):
    """Means of the two halves of each series' time."""
    s = I.daily_series(scored(spark, d))
    b = s.groupBy("topic").agg(F.min("day").alias("a"), F.max("day").alias("z"))
    first = F.col("day") <= F.date_add("a", F.floor(F.datediff("z", "a") / 2).cast("int"))
    return s.join(b, "topic").groupBy("topic").agg(r6(F.avg(F.when(first, F.col("volume"))), "first"), r6(F.avg(F.when(~first, F.col("volume"))), "second"))


# ---- aggregates and rows ----


def _agg(name: str, sql: str, column):
    """Aggregates of the scores by source, one query each."""

    def run(spark, d):
        return scored(spark, d).where("source is not null").groupBy("source").agg(column().alias("value"))

    run.__name__ = name
    query(f"with {SCO} select source, {sql} as value from sco where source is not null group by source")(run)


_agg("agg_mean_by", "round(avg(score), 6)", lambda: F.round(F.avg("score"), 6))
_agg("agg_min_by", "round(min(score), 6)", lambda: F.round(F.min("score"), 6))
_agg("agg_max_by", "round(max(score), 6)", lambda: F.round(F.max("score"), 6))
_agg("agg_nunique", "count(distinct topic)", lambda: F.count_distinct("topic"))


@query(f"with {ART}, r as (select source, article_id, row_number() over (partition by source order by article_id) as rn from art where source is not null) select source, article_id from r where rn <= 5")
def cap_rows(spark, d):
    """The first five articles of each source."""
    w = W.partitionBy("source").orderBy("article_id")
    return articles(spark, d).where("source is not null").select("source", "article_id").withColumn("rn", F.row_number().over(w)).where("rn <= 5").select("source", "article_id")


@query("select doc_id as id, title, lang, null as source_id from documents union all select null, title, null, source_id from content_hashes")
def concat_diff_schema(spark, d):
    """Rows of two tables with different columns; what one lacks is null."""
    a = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "title", "lang")
    return a.unionByName(table(spark, d, "content_hashes").select("title", "source_id"), allowMissingColumns=True)


@query(f"with {ART} select article_id, cast(date_trunc('day', ts) as varchar) as day, cast(date_trunc('week', ts) as varchar) as week from art where ts is not null")
def day_trunc(spark, d):
    text = lambda unit: F.date_format(F.date_trunc(unit, "ts"), "yyyy-MM-dd HH:mm:ss")
    return articles(spark, d).where("ts is not null").select("article_id", text("day").alias("day"), text("week").alias("week"))


SQL["day_trunc"] = f"with {ART} select article_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') as day, strftime(date_trunc('week', ts), '%Y-%m-%d %H:%M:%S') as week from art where ts is not null"


@query(f"with {ART}, f as (select topic, min(ts) as t0 from art where ts is not null and topic <> '-1' group by topic) select article_id, round((epoch(ts) - epoch(t0)) / 3600, 6) as lag from art join f using (topic) where ts is not null")
def lag_hours(spark, d):
    """Hours since the first article of the same topic."""
    a = articles(spark, d).where("ts is not null and topic <> '-1'").select("article_id", "topic", "ts")
    f = a.groupBy("topic").agg(F.min("ts").alias("t0"))
    return a.join(f, "topic").select("article_id", r6((F.unix_timestamp("ts") - F.unix_timestamp("t0")) / 3600, "lag"))


@query(f"with {ART}, {ENT}, e as (select a.entity as src, b.entity as dst, count(*) as weight from ent a join ent b on a.article_id = b.article_id and a.entity < b.entity group by all) select src, dst, weight from e where weight >= 3")
def filter_edges(spark, d):
    from corpusmill.plans.bindings import entities

    return I.cooccurrence(entities(spark, d), least=3).select(F.col("entity_a").alias("src"), F.col("entity_b").alias("dst"), F.col("weight").cast("bigint").alias("weight"))


@query(f"with {ART} select article_id, regexp_matches({_TEXT}, 'budget|haushalt|presupuesto|бюджет|예산') as hit from art")
def text_matches(spark, d):
    return articles(spark, d).select("article_id", _lower_text().rlike("budget|haushalt|presupuesto|бюджет|예산").alias("hit"))


@query(f"with {ART} select article_id, len(regexp_extract_all({_TEXT}, 'budget|haushalt|presupuesto|бюджет|예산')) as n from art")
def count_matches(spark, d):
    return articles(spark, d).select("article_id", F.regexp_count(_lower_text(), F.lit("budget|haushalt|presupuesto|бюджет|예산")).cast("bigint").alias("n"))


@query(f"with {ART} select article_id, '{{\"topic\":\"' || topic || '\",\"lang\":\"' || lang || '\"}}' as json from art")
def json_dump(spark, d):
    return articles(spark, d).select("article_id", F.to_json(F.struct("topic", "lang")).alias("json"))


@query("with h as (select distinct article_id, source_id, simhash from content_hashes where simhash <> 0), b as (select source_id, min(simhash) as base from h group by source_id) select article_id, simhash, round(1 - bit_count(xor(simhash, base)) / 64, 6) as similarity from h join b using (source_id)")
def simhash_sim(spark, d):
    """Similarity of each fingerprint to the smallest of its source."""
    h = table(spark, d, "content_hashes").where("simhash <> 0").select("article_id", "source_id", "simhash").distinct()
    b = h.groupBy("source_id").agg(F.min("simhash").alias("base"))
    return h.join(b, "source_id").select("article_id", "simhash", r6(1 - F.bit_count(F.col("simhash").bitwiseXOR(F.col("base"))) / 64, "similarity"))


@query("select distinct article_id, sha256(normalized_url) as key from seen_urls where normalized_url is not null")
def url_key(spark, d):
    return table(spark, d, "seen_urls").where("normalized_url is not null").select("article_id", F.sha2("normalized_url", 256).alias("key")).distinct()


@query(f"with {ART} select article_id, coalesce(nullif(lang, 'und'), 'en') as lang from art")
def article_lang(spark, d):
    return articles(spark, d).select("article_id", F.coalesce(F.nullif("lang", F.lit("und")), F.lit("en")).alias("lang"))


@query(f"with {ART} select article_id, coalesce(s.source_name, a.source, 'unknown') as source from art a left join (select source_id, min(source_name) as source_name from sources group by 1) s on s.source_id = a.source")
def article_source(spark, d):
    from corpusmill.operators.relational import checked_broadcast

    s = table(spark, d, "sources").groupBy(F.col("source_id").alias("source")).agg(F.min("source_name").alias("source_name"))
    return articles(spark, d).join(checked_broadcast(s), "source", "left").select("article_id", F.coalesce("source_name", "source", F.lit("unknown")).alias("source"))


@query(f"with {ART} select article_id, coalesce(strftime(ts, '%Y-%m-%d'), 'undated') as date from art")
def doc_date_string(spark, d):
    return articles(spark, d).select("article_id", F.coalesce(F.date_format("ts", "yyyy-MM-dd"), F.lit("undated")).alias("date"))


@query(f"with {ART} select article_id, trim(coalesce(body, '')) = '' as paywalled, case when trim(coalesce(body, '')) = '' then 'title' else 'body' end as used from art")
def paywall_flag(spark, d):
    wall = F.trim(F.coalesce("body", F.lit(""))) == ""
    return articles(spark, d).select("article_id", wall.alias("paywalled"), F.when(wall, "title").otherwise("body").alias("used"))


@query(f"with {ART} select article_id, regexp_extract_all(coalesce(title, ''), '\\S+') as words, len(list_filter(regexp_extract_all(coalesce(title, ''), '\\S+'), lambda w: length(w) <= 1 or regexp_full_match(w, '[0-9[:punct:]]+'))) as noise from art")
def entity_noise(spark, d):
    """Words of titles that can't be names: single characters, numbers and punctuation."""
    words = F.regexp_extract_all(F.coalesce("title", F.lit("")), F.lit(r"\S+"), F.lit(0))
    return articles(spark, d).select("article_id", words.alias("words"), F.size(F.filter(words, lambda w: (F.length(w) <= 1) | w.rlike(r"^[0-9\p{Punct}]+$"))).cast("bigint").alias("noise"))


# ---- labels ----


@query(f"with {ART}, {ENT}, {_HHI} select topic, case when hhi >= 0.25 then 'oligopoly' when hhi <= 0.1 then 'healthy' else 'moderate' end as class from hhi")
def hhi_class(spark, d):
    return Q.nf3_hhi(spark, d).select("topic", "class")


@query(f"select topic, grade from ({Q.SQL['nf4_media_health']})")
def health_grade(spark, d):
    return Q.nf4_media_health(spark, d).select("topic", "grade")


@query(f"select phase, count(*) as n from ({Q.SQL['ei5_hype']}) group by phase")
def hype_phase(spark, d):
    return Q.ei5_hype(spark, d).groupBy("phase").agg(F.count("*").alias("n"))


@query(f"select topic, case when not cyclic then 'none' when period <= 8 then 'weekly' when period <= 35 then 'monthly' else 'long' end as cycle from ({Q.SQL['tp4_cycle']})")
def cycle_type(spark, d):
    p = F.col("period")
    return Q.tp4_cycle(spark, d).select("topic", F.when(~F.col("cyclic"), "none").when(p <= 8, "weekly").when(p <= 35, "monthly").otherwise("long").alias("cycle"))


# ---- dashboard ----


@query(f"with {ANA} select cast(least(floor((score + 1) * 10), 19) as bigint) as bin, count(*) as n from ana where score is not null group by 1")
def db_sentiment_hist(spark, d):
    from corpusmill.plans.bindings import analysis

    bin_ = F.least(F.floor((F.col("score") + 1) * 10), F.lit(19)).cast("bigint")
    return analysis(spark, d).where("score is not null").groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))


@query(Q.SQL["mood_index"])
def db_mood(spark, d):
    return Q.mood_index(spark, d)


@query()
def db_burst_points(spark, d):
    """The bursts of the series that stand out, i.e. have a level above 0."""
    return series_queries.QUERIES["ts_kleinberg"](spark, d).where("level > 0")


# ---- bounds of metrics ----

#: Metric, its query, its column, and the bounds its values must keep.
BOUNDS = (
    ("divergence", "cl1_jsd", "jsd", 0, 0.693148), ("attention_gap", "cl2_attention_gap", "gap", 0, 1), ("tone_distance", "cl3_wasserstein", "distance", 0, 2), ("bubble_overlap", "cl4_filter_bubble", "overlap", 0, 1),
    ("frame_shift", "nf2_frame_shift", "kl", 0, 24), ("dominance", "nf3_hhi", "hhi", 0, 1), ("media_health", "nf4_media_health", "health", 0, 1), ("credibility", "nf6_credibility", "credibility", 0, 1), ("cycle_ratio", "tp4_cycle", "ratio", 0, 1000),
    ("policy_uncertainty", "ei1_epu", "share", 0, 1), ("sector_tone", "ei2_sector", "sentiment", -1, 1), ("prevalence", "ei4_narrative", "prevalence", 0, 1), ("hype_tone", "ei5_hype", "tone", -1, 1),
)


@query(" union all ".join(f"select '{name}' as metric, count(*) as n, count(*) filter (where {col} is null) as missing, count(*) filter (where {col} < {low} or {col} > {high}) as outside from ({Q.SQL[q]})" for name, q, col, low, high in BOUNDS))
def val_metrics(spark, d):
    """How many values of each metric are missing or outside its bounds."""
    parts = [
        Q.QUERIES[q](spark, d).agg(F.count("*").alias("n"), F.count_if(F.col(col).isNull()).alias("missing"), F.count_if((F.col(col) < low) | (F.col(col) > high)).alias("outside")).select(F.lit(name).alias("metric"), "n", "missing", "outside")
        for name, q, col, low, high in BOUNDS
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
