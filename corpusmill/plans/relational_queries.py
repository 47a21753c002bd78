"""Joins, aggregations, windows, ranking, sets and dashboards."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.operators import relational as R
from corpusmill.operators.insights import calendar
from corpusmill.plans.bindings import ANA, ART, EMOTIONS, ENT, analysis, articles, entities, r6, registry
from corpusmill.plans.insight_queries import SCO, scored
from corpusmill.sources.tables import table

QUERIES, SQL, query = registry()
W = Window

# joins


@query(f"with {ART}, {ANA} select a.article_id, a.source, n.sentiment_label, round(n.score, 6) as score, n.steeps from art a left join ana n using (article_id)")
def join_left_first(spark, d):
    right = table(spark, d, "article_analysis").select("article_id", "sentiment_label", "sentiment_score", "steeps_category", "importance_score", "emotion_joy", "emotion_trust")
    order = [F.col(c).desc_nulls_last() for c in ("importance_score", "sentiment_score", "emotion_joy", "emotion_trust")]
    return R.join_left_first(articles(spark, d), right, "article_id", order).select("article_id", "source", "sentiment_label", r6(F.col("sentiment_score").cast("double"), "score"), F.col("steeps_category").alias("steeps"))


@query(f"with {ART}, {ANA} select a.article_id, a.topic, n.sentiment_label, u.n as urls, h.n as hashes, s.group_name from art a left join ana n using (article_id) left join (select article_id, count(*) as n from seen_urls group by 1) u using (article_id) left join (select article_id, count(*) as n from content_hashes group by 1) h using (article_id) left join sources s on s.source_id = a.source")
def join_merge21(spark, d):
    count = lambda t, n: table(spark, d, t).groupBy("article_id").agg(F.count("*").alias(n))
    out = articles(spark, d).join(analysis(spark, d).select("article_id", "sentiment_label"), "article_id", "left").join(count("seen_urls", "urls"), "article_id", "left").join(count("content_hashes", "hashes"), "article_id", "left")
    dim = table(spark, d, "sources").select(F.col("source_id").alias("source"), "group_name")
    return out.join(R.checked_broadcast(dim), "source", "left").select("article_id", "topic", "sentiment_label", "urls", "hashes", "group_name")


@query(f"with {SCO} select article_id, topic, round(score, 6) as score from sco where score is not null")
def join_inner(spark, d):
    return scored(spark, d).where("score is not null").select("article_id", "topic", r6("score", "score"))


@query(f"with {ART} select article_id, source from art where source in (select source_id from sources where language = 'en')")
def join_semi(spark, d):
    en = table(spark, d, "sources").where("language = 'en'").select(F.col("source_id").alias("source"))
    return articles(spark, d).join(R.checked_broadcast(en), "source", "left_semi").select("article_id", "source")


@query("select distinct article_id from seen_urls where article_id not in (select article_id from articles where article_id is not null) and article_id is not null")
def join_anti_fk(spark, d):
    return table(spark, d, "seen_urls").where("article_id is not null").select("article_id").distinct().join(table(spark, d, "articles"), "article_id", "left_anti")


@query("with e as (select l_orderkey as k, l_partkey % 300 as p from lineitem), f as (select distinct k, p from e), g as (select a.p as a, b.p as b from (select distinct p from f) a join (select distinct p from f) b on a.p < b.p) select g.a, g.b from g anti join (select a.p as a, b.p as b from f a join f b on a.k = b.k and a.p < b.p) h on g.a = h.a and g.b = h.b")
def join_anti_edge(spark, d):
    """Pairs of groups without an edge; the groups are 300, so their cross pairs are few."""
    f = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_partkey") % 300).alias("p")).distinct()
    p = f.select("p").distinct()
    pairs = p.toDF("a").join(p.toDF("b"), F.col("a") < F.col("b"))
    return pairs.join(f.toDF("k", "a").join(f.toDF("k", "b"), "k").where("a < b").select("a", "b").distinct(), ["a", "b"], "left_anti")


@query(f"with {ART} select a.article_id, coalesce(s.source_name, 'Unknown') as name from art a left join sources s on s.source_id = a.source")
def join_lookup_map(spark, d):
    dim = table(spark, d, "sources").select(F.col("source_id").alias("source"), F.col("source_name").alias("name"))
    return R.join_lookup(articles(spark, d), dim, "source", "name", "Unknown").select("article_id", "name")


@query("with i as (select distinct l_orderkey as k, l_suppkey as s from lineitem) select a.s as a, b.s as b, count(*) as n from i a join i b on a.k = b.k and a.s < b.s group by all")
def join_self_pairs_unordered(spark, d):
    i = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("s")).distinct()
    return i.toDF("k", "a").join(i.toDF("k", "b"), "k").where("a < b").groupBy("a", "b").agg(F.count("*").alias("n"))


@query("select a.event_type as a, b.event_type as b, count(*) as n from (select distinct event_type, user_id from events) a join (select distinct event_type, user_id from events) b on a.user_id = b.user_id and a.event_type <> b.event_type group by all")
def join_self_pairs_ordered(spark, d):
    e = table(spark, d, "events").select("event_type", "user_id").distinct()
    return e.toDF("a", "user_id").join(e.toDF("b", "user_id"), "user_id").where("a <> b").groupBy("a", "b").agg(F.count("*").alias("n"))


@query(f"with {ART}, x as (select article_id, topic, source, ts from art where ts is not null and topic <> '-1') select a.source as from_source, b.source as to_source, count(*) as flows from x a join x b on a.topic = b.topic and a.source <> b.source and epoch(b.ts) - epoch(a.ts) between 0 and 21600 and (a.ts < b.ts or a.article_id < b.article_id) group by all")
def join_theta_sim_time(spark, d):
    """Articles of two sources on a topic within six hours, by direction: a range join on time buckets."""
    x = articles(spark, d).where("ts is not null and topic <> '-1'").select("article_id", "topic", "source", "ts")
    j = R.range_join(x, x, "topic", "ts", 6).where("a.source <> b.source and (a.ts < b.ts or a.article_id < b.article_id)")
    return j.groupBy(F.col("a.source").alias("from_source"), F.col("b.source").alias("to_source")).agg(F.count("*").alias("flows"))


@query(f"with {ART}, x as (select topic, source, article_id, row_number() over (partition by topic order by article_id) as rn from art where topic <> '-1') select a.topic, count(*) as n, count(distinct a.source) as sources from x a join x b on a.topic = b.topic and b.rn between a.rn + 1 and a.rn + 19 and a.source <> b.source group by a.topic")
def join_window_capped_pairs(spark, d):
    """Each entry with the 19 that follow it in its topic: collected by the window frame, no self-join."""
    w = W.partitionBy("topic").orderBy("article_id")
    x = articles(spark, d).where("topic <> '-1'").select("topic", "source", F.collect_list("source").over(w.rowsBetween(1, 19)).alias("nxt"))
    x = x.select("topic", "source", F.explode("nxt").alias("other")).where("source <> other")
    return x.groupBy("topic").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"))


@query(
    "with l as (select event_id, user_id, ts from events where event_type = (select min(event_type) from events)), r as (select user_id, ts, max(value) as value from events where event_type = (select max(event_type) from events) group by all) "
    "select l.event_id, round(r.value, 6) as value from l asof left join r on l.user_id = r.user_id and l.ts >= r.ts"
)
def join_asof(spark, d):
    """The last value of one event type at or before each event of another, by user."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "value", "event_type")
    ends = e.agg(F.min("event_type").alias("lo"), F.max("event_type").alias("hi"))
    left = e.join(F.broadcast(ends), F.col("event_type") == F.col("lo")).select("event_id", "user_id", "ts")
    right = e.join(F.broadcast(ends), F.col("event_type") == F.col("hi")).groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    return R.asof_join(left, right, "user_id", "ts", "value").select("event_id", r6("value", "value"))


@query(f"with {ART}, x as (select title, string_agg(distinct source, ',' order by source) as srcs from art where title is not null group by title) select s.source_id, count(*) as n from sources s join x on contains(x.srcs, s.source_id) group by s.source_id")
def join_contains_name(spark, d):
    x = articles(spark, d).where("title is not null").groupBy("title").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("srcs"))
    s = R.checked_broadcast(table(spark, d, "sources").select("source_id"))
    return x.join(s, F.contains("srcs", "source_id")).groupBy("source_id").agg(F.count("*").alias("n"))


@query(f"with {ART}, {ENT} select entity, count(distinct article_id) as articles, string_agg(distinct topic, ',' order by topic) as topics from ent group by entity having count(distinct article_id) >= 2")
def join_bipartite(spark, d):
    g = entities(spark, d).groupBy("entity").agg(F.count_distinct("article_id").alias("articles"), F.array_join(F.array_sort(F.collect_set("topic")), ",").alias("topics"))
    return g.where("articles >= 2")


# aggregations


@query(f"with {ART} select topic, lang, count(*) as n, count(distinct source) as sources, min(ts) is null as undated, max(word_count) as longest, round(avg(word_count), 6) as mean_words from art group by topic, lang")
def agg_count_by(spark, d):
    return articles(spark, d).groupBy("topic", "lang").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"), F.min("ts").isNull().alias("undated"), F.max("word_count").alias("longest"), r6(F.avg("word_count"), "mean_words"))


@query(f"with {ART}, c as (select source, topic, count(*) as n from art group by all), m as (select source, arg_min(topic, (-n, topic)) as topic from c group by source) select source, topic from m")
def agg_mode(spark, d):
    return R.mode_by(articles(spark, d), "source", "topic").where("source is not null")


SQL["agg_mode"] += " where source is not null"


@query(f"with {ART} select source, round(avg(cast(coalesce(author, '') = '' as int)), 6) as anonymous, round(avg(cast(coalesce(body, '') = '' as int)), 6) as empty from art group by source")
def agg_ratio(spark, d):
    rate = lambda c: F.round(F.avg((F.coalesce(c, F.lit("")) == "").cast("double")), 6)
    return articles(spark, d).groupBy("source").agg(rate("author").alias("anonymous"), rate("body").alias("empty"))


@query(f"with {ANA} select cast(least(49, floor((score + 1) * 25)) as integer) as bin, count(*) as n from ana where score is not null group by 1")
def agg_histogram(spark, d):
    return analysis(spark, d).where("score is not null").groupBy(F.least(F.lit(49), F.floor((F.col("score") + 1) * 25)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


@query(f"with {SCO} select source, " + ", ".join(f"cast(count(*) filter (where steeps = '{s}') as bigint) as n_{s.lower()}" for s in "STEPV") + " from sco group by source")
def agg_conditional_pivot(spark, d):
    return scored(spark, d).groupBy("source").agg(*(F.count_if(F.col("steeps") == s).alias(f"n_{s.lower()}") for s in "STEPV"))


@query(f"with {ART} select topic, string_agg(distinct source, ',' order by source) as sources from art group by topic")
def agg_collect(spark, d):
    return articles(spark, d).groupBy("topic").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


@query("with w as (select source, unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) as w from documents where text is not null), c as (select source, w, count(*) as n from w group by all), r as (select *, row_number() over (partition by source order by n desc, w) as rn from c) select source, string_agg(w, ' | ' order by rn) as label from r where rn <= 5 group by source")
def agg_top_term_join(spark, d):
    w = table(spark, d, "documents").where("text is not null").select("source", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0))).alias("w"))
    top = R.topk_group(w.groupBy("source", "w").agg(F.count("*").alias("n")), "source", [F.desc("n"), F.col("w")], 5)
    return top.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "w"))), lambda x: x.w), " | ").alias("label"))


@query("select l_returnflag as flag, l_linestatus as status, count(*) as n, round(sum(l_quantity), 2) as qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, round(avg(l_discount), 6) as disc from lineitem where l_shipdate <= date '1998-09-02' group by all")
def agg_pricing_summary(spark, d):
    li = table(spark, d, "lineitem").where("l_shipdate <= date '1998-09-02'")
    return li.groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), r6(F.avg("l_discount"), "disc"))


@query(f"with {ART}, c as (select topic, count(*) as n from art group by topic), t as (select sum(n) as t from c) select topic, n, round(n / t, 6) as share, n / t > case when topic = '-1' then 0.5 else 0.6 end as warning from c, t")
def topic_dist_gate(spark, d):
    c = articles(spark, d).groupBy("topic").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(W.partitionBy())
    return c.select("topic", "n", r6(share, "share"), (share > F.when(F.col("topic") == "-1", 0.5).otherwise(0.6)).alias("warning"))


@query("select source_id, count(*) as total, count(distinct article_id) as articles, cast(count(*) filter (where batch_no = 0) as bigint) as accepted, round(count(distinct article_id) / count(*), 6) as rate, count(distinct normalized_url) as urls from seen_urls group by source_id")
def crawl_report(spark, d):
    return table(spark, d, "seen_urls").groupBy("source_id").agg(F.count("*").alias("total"), F.count_distinct("article_id").alias("articles"), F.count_if(F.col("batch_no") == 0).alias("accepted"), r6(F.count_distinct("article_id") / F.count("*"), "rate"), F.count_distinct("normalized_url").alias("urls"))


@query(f"with {ART}, {ANA} select 'language' as what, lang as value, count(*) as n from art group by lang union all select 'sentiment', coalesce(sentiment_label, 'none'), count(*) from ana group by 2 union all select 'steeps', coalesce(steeps, 'none'), count(*) from ana group by 2")
def distribution_stats(spark, d):
    part = lambda df, what, c: df.groupBy(F.coalesce(c, F.lit("none")).alias("value")).agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "value", "n")
    a = analysis(spark, d)
    return part(articles(spark, d), "language", "lang").unionByName(part(a, "sentiment", "sentiment_label")).unionByName(part(a, "steeps", "steeps"))


# windows


@query("with x as (select event_type, cast(ts as date) as day, count(*) as n from events group by all) select event_type, cast(day as varchar) as day, n, round(avg(n) over (partition by event_type order by day rows between 6 preceding and current row), 6) as mean7, cast(sum(n) over (partition by event_type order by day) as bigint) as total, n - lag(n) over (partition by event_type order by day) as diff, first_value(n) over (partition by event_type order by day) as first_n from x")
def win_roll_mean_n(spark, d):
    x = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    w = W.partitionBy("event_type").orderBy("day")
    return x.select("event_type", F.col("day").cast("string").alias("day"), "n", r6(F.avg("n").over(w.rowsBetween(-6, 0)), "mean7"), F.sum("n").over(w).alias("total"), (F.col("n") - F.lag("n").over(w)).alias("diff"), F.first("n").over(w).alias("first_n"))


@query("with x as (select event_id, user_id, ts, epoch(ts) - epoch(lag(ts) over (partition by user_id order by ts, event_id)) as gap from events), s as (select *, sum(cast(coalesce(gap > 21600, true) as int)) over (partition by user_id order by ts, event_id) as s from x) select user_id, cast(s as bigint) as session, count(*) as n, cast(max(epoch(ts)) - min(epoch(ts)) as bigint) as seconds from s group by user_id, s")
def win_sessions(spark, d):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    x = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("gap", F.unix_micros("ts") - F.lag(F.unix_micros("ts")).over(w))
    s = x.withColumn("session", F.sum(F.coalesce(F.col("gap") > 21_600_000_000, F.lit(True)).cast("int")).over(w))
    return s.groupBy("user_id", "session").agg(F.count("*").alias("n"), F.round((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6).cast("bigint").alias("seconds"))


@query(f"with {ART}, c as (select topic, day, count(*) as n from art where day is not null group by all), h as (select topic, day, n, row_number() over (partition by topic order by day) as rn, count(*) over (partition by topic) as k from c) select topic, round(avg(n) filter (where rn > k - 3), 6) as last3, round(avg(n) filter (where rn <= greatest(k // 2, 1)), 6) as early, round(avg(n) filter (where rn > k - 3), 6) < 0.5 * round(avg(n) filter (where rn <= greatest(k // 2, 1)), 6) as declining from h group by topic")
def win_growth(spark, d):
    c = articles(spark, d).where("day is not null").groupBy("topic", "day").agg(F.count("*").alias("n"))
    h = c.withColumn("rn", F.row_number().over(W.partitionBy("topic").orderBy("day"))).withColumn("k", F.count("*").over(W.partitionBy("topic")))
    last3, early = F.avg(F.when(F.col("rn") > F.col("k") - 3, F.col("n"))), F.avg(F.when(F.col("rn") <= F.greatest(F.floor(F.col("k") / 2), F.lit(1)), F.col("n")))
    return h.groupBy("topic").agg(r6(last3, "last3"), r6(early, "early")).withColumn("declining", F.col("last3") < 0.5 * F.col("early"))


@query(f"with {ART}, {ENT}, c as (select topic, entity, count(*) as n from ent group by all), r as (select topic, n, row_number() over (partition by topic order by n desc, entity) as rk from c), t as (select * from r where rk <= 500), p as (select topic, rk, n / sum(n) over (partition by topic) as p, (1 / rk) / sum(1 / rk) over (partition by topic) as q, count(*) over (partition by topic) as k from t) select topic, round(1 - exp(-sum(p * ln(p / q))), 6) as deviation from p where k >= 5 group by topic")
def win_zipf(spark, d):
    c = entities(spark, d).groupBy("topic", "entity").agg(F.count("*").alias("n"))
    t = R.topk_group(c, "topic", [F.desc("n"), F.col("entity")], 500)
    w = W.partitionBy("topic")
    p = t.select("topic", (F.col("n") / F.sum("n").over(w)).alias("p"), ((1 / F.col("rank")) / F.sum(1 / F.col("rank")).over(w)).alias("q"), F.count("*").over(w).alias("k")).where("k >= 5")
    return p.groupBy("topic").agg(r6(1 - F.exp(-F.sum(F.col("p") * F.ln(F.col("p") / F.col("q")))), "deviation"))


@query(f"with {ART}, c as (select topic, day, count(*) as n from art where day is not null group by all), x as (select topic, n, row_number() over (partition by topic order by day) - 1 as t from c), f as (select *, regr_slope(n, t) over (partition by topic) as b, regr_intercept(n, t) over (partition by topic) as a from x), r as (select *, n - a - b * t as e from f), s as (select *, stddev_pop(e) over (partition by topic) as sd from r) select topic, cast(t as integer) as t, round(a + b * t, 6) as fitted, round(abs(e), 6) > round(2 * sd, 6) as anomaly from s where a is not null")
def win_linear_trend(spark, d):
    c = articles(spark, d).where("day is not null").groupBy("topic", "day").agg(F.count("*").alias("n"))
    w = W.partitionBy("topic")
    x = c.withColumn("t", F.row_number().over(w.orderBy("day")) - 1).withColumn("b", F.regr_slope("n", "t").over(w)).withColumn("a", F.regr_intercept("n", "t").over(w)).where("a is not null")
    x = x.withColumn("f", F.col("a") + F.col("b") * F.col("t")).withColumn("e", F.col("n") - F.col("f")).withColumn("sd", F.stddev_pop("e").over(w))
    return x.select("topic", "t", r6("f", "fitted"), (F.round(F.abs("e"), 6) > F.round(2 * F.col("sd"), 6)).alias("anomaly"))


@query(f"with {SCO}, e as (select day, topic, count(*) as n from sco where day is not null group by all), p as (select day, n / sum(n) over (partition by day) as p from e), h as (select day, -sum(p * ln(p)) as h from p group by day), z as (select day, h, avg(h) over w as m, stddev_samp(h) over w as sd, count(*) over w as k from h window w as (order by day rows between 30 preceding and 1 preceding)) select cast(day as varchar) as day, round(h, 6) + cast(0 as double) as entropy, round(case when k >= 2 and sd > 1e-9 then greatest(0, least(1, (h - m) / sd / 5)) else 0 end, 6) as spike from z")
def win_entropy_spike(spark, d):
    e = scored(spark, d).where("day is not null").groupBy("day", "topic").agg(F.count("*").alias("n"))
    h = e.select("day", (F.col("n") / F.sum("n").over(W.partitionBy("day"))).alias("p")).groupBy("day").agg((-F.sum(F.col("p") * F.ln("p"))).alias("h"))
    w = W.partitionBy().orderBy("day").rowsBetween(-30, -1)
    z = h.select("day", "h", F.avg("h").over(w).alias("m"), F.stddev_samp("h").over(w).alias("sd"), F.count("*").over(w).alias("k"))
    spike = F.when((F.col("k") >= 2) & (F.col("sd") > 1e-9), F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("h") - F.col("m")) / F.col("sd") / 5))).otherwise(0.0)
    return z.select(F.col("day").cast("string").alias("day"), (F.round("h", 6) + F.lit(0.0)).alias("entropy"), r6(spike, "spike"))


# ranking, sets


@query("select source_id, language, tz_name from sources order by language, tz_name, source_id limit 20")
def sort_multi(spark, d):
    return table(spark, d, "sources").orderBy("language", "tz_name", "source_id").select("source_id", "language", "tz_name").limit(20)


@query("select doc_id, rating from documents order by rating desc nulls last, doc_id limit 50")
def sort_nulls_last(spark, d):
    return table(spark, d, "documents").orderBy(F.col("rating").desc_nulls_last(), "doc_id").select("doc_id", "rating").limit(50)


@query(f"with {ANA} select article_id, round(abs(score), 6) as magnitude from ana where score is not null order by abs(score) desc, article_id limit 20")
def sort_abs_desc(spark, d):
    return analysis(spark, d).where("score is not null").orderBy(F.abs("score").desc(), "article_id").select("article_id", r6(F.abs("score"), "magnitude")).limit(20)


@query("with t as (select reviewer_id, count(*) as n from documents group by 1 order by n desc, reviewer_id limit 30) select d.doc_id from documents d join t using (reviewer_id)")
def topk_global(spark, d):
    docs = table(spark, d, "documents")
    top = docs.groupBy("reviewer_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reviewer_id").limit(30)
    return docs.join(F.broadcast(top.select("reviewer_id")), "reviewer_id", "left_semi").select("doc_id")


@query("with r as (select item_id, doc_id, row_number() over (partition by item_id order by n_chars desc nulls last, doc_id) as rank from documents) select item_id, doc_id, cast(rank as integer) as rank from r where rank <= 3")
def topk_group(spark, d):
    return R.topk_group(table(spark, d, "documents"), "item_id", [F.col("n_chars").desc_nulls_last(), F.col("doc_id")], 3).select("item_id", "doc_id", "rank")


@query("with c as (select event_type, cast(ts as date) as day, count(*) as n from events group by all) select event_type, cast(arg_min(day, (-n, day)) as varchar) as peak, max(n) as n from c group by event_type")
def argmax_first(spark, d):
    c = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return c.groupBy("event_type").agg(F.min_by("day", F.struct(-F.col("n"), "day")).cast("string").alias("peak"), F.max("n").alias("n"))


@query("select article_id from articles where article_id is not null union select article_id from article_analysis")
def set_union(spark, d):
    return table(spark, d, "articles").where("article_id is not null").select("article_id").union(table(spark, d, "article_analysis").select("article_id")).distinct()


@query("select 'u' as kind, source_id, batch_no, cast(null as bigint) as simhash from seen_urls union all select 'h', source_id, batch_no, simhash from content_hashes")
def set_union_missing(spark, d):
    u = table(spark, d, "seen_urls").select(F.lit("u").alias("kind"), "source_id", "batch_no")
    return u.unionByName(table(spark, d, "content_hashes").select(F.lit("h").alias("kind"), "source_id", "batch_no", "simhash"), allowMissingColumns=True)


@query("select article_id from articles intersect select article_id from article_analysis")
def set_intersect(spark, d):
    return table(spark, d, "articles").select("article_id").intersect(table(spark, d, "article_analysis").select("article_id"))


@query("select article_id from articles except select article_id from article_analysis")
def set_except(spark, d):
    return table(spark, d, "articles").select("article_id").subtract(table(spark, d, "article_analysis").select("article_id"))


@query("select batch_no, count(distinct source_id) = (select count(*) from sources) as complete from seen_urls group by batch_no")
def set_subset(spark, d):
    every = table(spark, d, "sources").agg(F.collect_set("source_id").alias("s"))
    return table(spark, d, "seen_urls").groupBy("batch_no").agg(F.collect_set("source_id").alias("g")).crossJoin(F.broadcast(every)).select("batch_no", (F.size(F.array_except("s", "g")) == 0).alias("complete"))


@query("with n as (select article_id, source_id, title from content_hashes where batch_no = 1), o as (select article_id, source_id, title from content_hashes where batch_no = 0), m as (select distinct * from o), k as (select distinct * from n) select article_id, source_id from m union all select article_id, source_id from k where article_id not in (select article_id from m)")
def upsert_ignore(spark, d):
    h = table(spark, d, "content_hashes").select("article_id", "source_id", "title", "batch_no")
    old, new = (h.where(F.col("batch_no") == b).drop("batch_no").distinct() for b in (0, 1))
    return R.upsert(old, new, "article_id", replace=False).select("article_id", "source_id")


@query("with r as (select *, row_number() over (partition by source_id, normalized_url order by batch_no desc, article_id desc, first_seen desc, url_hash desc) as rn from seen_urls) select source_id, normalized_url, article_id from r where rn = 1")
def scan_period_dedup(spark, d):
    return R.keep_last(table(spark, d, "seen_urls"), ["source_id", "normalized_url"], [F.col(c) for c in ("batch_no", "article_id", "first_seen", "url_hash")]).select("source_id", "normalized_url", "article_id")


# dashboards


@query(f"with {ART} select count(*) as n, count(distinct source) as sources, count(distinct lang) as langs, count(distinct day) as days, round(count(*) filter (where day is not null) / count(distinct day), 6) as per_day from art")
def db_overview(spark, d):
    return articles(spark, d).agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"), F.count_distinct("lang").alias("langs"), F.count_distinct("day").alias("days"), r6(F.count("day") / F.count_distinct("day"), "per_day"))


@query(f"with {ART} select a.source, coalesce(s.group_name, '?') as grp, coalesce(s.source_name, 'Unknown') as name, count(*) as n from art a left join sources s on s.source_id = a.source group by all")
def db_by_source(spark, d):
    dim = R.checked_broadcast(table(spark, d, "sources").select(F.col("source_id").alias("source"), "group_name", "source_name"))
    return articles(spark, d).groupBy("source").agg(F.count("*").alias("n")).join(dim, "source", "left").select("source", F.coalesce("group_name", F.lit("?")).alias("grp"), F.coalesce("source_name", F.lit("Unknown")).alias("name"), "n")


@query(f"with {ART} select coalesce(s.group_name, '?') as grp, count(*) as n from art a left join sources s on s.source_id = a.source group by 1")
def db_by_group(spark, d):
    return db_by_source(spark, d).groupBy("grp").agg(F.sum("n").alias("n"))


@query(f"with {ART} select case lang when 'en' then 'English' when 'ko' then 'Korean' when 'de' then 'German' when 'fr' then 'French' else lang end as name, count(*) as n from art group by 1")
def db_by_language(spark, d):
    names = F.create_map(*(F.lit(x) for kv in {"en": "English", "ko": "Korean", "de": "German", "fr": "French"}.items() for x in kv))
    return articles(spark, d).groupBy(F.coalesce(F.element_at(names, F.col("lang")), "lang").alias("name")).agg(F.count("*").alias("n"))


@query(f"with {ART} select cast(day as varchar) as day, count(*) as n from art where day is not null group by day")
def db_daily_volume(spark, d):
    return articles(spark, d).where("day is not null").groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query(f"with {ART} select topic, count(*) as n from art where topic <> '-1' group by topic order by n desc, topic limit 20")
def db_top_topics(spark, d):
    return articles(spark, d).where("topic <> '-1'").groupBy("topic").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "topic").limit(20)


@query(f"with {ART} select round(avg(cast(topic = '-1' as int)), 6) as share from art")
def db_outlier_pct(spark, d):
    return articles(spark, d).agg(r6(F.avg((F.col("topic") == "-1").cast("double")), "share"))


@query(f"with {ANA} select least(50, 1 + cast(floor(importance / 2) as integer)) as bin, count(*) as n from ana where importance is not null group by 1")
def db_prob_hist(spark, d):
    return analysis(spark, d).where("importance is not null").groupBy(F.least(F.lit(50), F.width_bucket("importance", F.lit(0.0), F.lit(100.0), F.lit(50))).cast("int").alias("bin")).agg(F.count("*").alias("n"))


@query(f"with {ANA} select coalesce(steeps, 'none') as steeps, count(*) as n from ana group by 1")
def db_steeps(spark, d):
    return analysis(spark, d).groupBy(F.coalesce("steeps", F.lit("none")).alias("steeps")).agg(F.count("*").alias("n"))


@query(f"with {ART}, t as (select topic from art where topic <> '-1' group by topic order by count(*) desc, topic limit 5) select topic, cast(day as varchar) as day, count(*) as n from art where topic in (select topic from t) and day is not null group by all")
def db_topic_trend(spark, d):
    a = articles(spark, d)
    top = a.where("topic <> '-1'").groupBy("topic").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "topic").limit(5)
    return a.where("day is not null").join(F.broadcast(top.select("topic")), "topic", "left_semi").groupBy("topic", F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query(f"with {SCO} select cast(day as varchar) as day, cast(count(*) filter (where sentiment_label = 'positive') as bigint) as positive, cast(count(*) filter (where sentiment_label = 'negative') as bigint) as negative, cast(count(*) filter (where sentiment_label = 'neutral') as bigint) as neutral from sco where day is not null group by day")
def db_sentiment_trend(spark, d):
    return scored(spark, d).where("day is not null").groupBy(F.col("day").cast("string").alias("day")).agg(*(F.count_if(F.col("sentiment_label") == x).alias(x) for x in ("positive", "negative", "neutral")))


@query(f"with {SCO} select source, " + ", ".join(f"round(avg({e}), 6) as {e}" for e in EMOTIONS) + " from sco group by source")
def db_emotion_heatmap(spark, d):
    return scored(spark, d).groupBy("source").agg(*(r6(F.avg(e), e) for e in EMOTIONS))


@query("select event_type, cast(ts as date) >= date '2024-01-10' as late, count(*) as n, cast(min(cast(ts as date)) as varchar) as first_day, cast(max(cast(ts as date)) as varchar) as last_day, cast(count(*) filter (where value > 50) as bigint) as high from events group by all")
def db_series_stats(spark, d):
    day = F.to_date("ts")
    return table(spark, d, "events").groupBy("event_type", (day >= F.lit("2024-01-10").cast("date")).alias("late")).agg(F.count("*").alias("n"), F.min(day).cast("string").alias("first_day"), F.max(day).cast("string").alias("last_day"), F.count_if(F.col("value") > 50).alias("high"))


@query("with w as (select unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) as word from documents where lang = 'en' and text is not null) select word, count(*) as n from w group by word order by n desc, word limit 30")
def db_top_words(spark, d):
    w = table(spark, d, "documents").where("lang = 'en'").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    return w.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(30)


@query(f"with {ART} select article_id, title, word_count from art where lang = 'en' and title ilike '%museum%' order by word_count desc nulls last, article_id limit 100")
def db_explorer(spark, d):
    return articles(spark, d).where("lang = 'en' and title ilike '%museum%'").orderBy(F.col("word_count").desc_nulls_last(), "article_id").select("article_id", "title", "word_count").limit(100)


@query(f"with {ART}, {ENT}, e as (select a.entity as x, b.entity as y from ent a join ent b on a.article_id = b.article_id and a.entity < b.entity group by all) select count(*) as edges, (select count(distinct z) from (select x as z from e union all select y from e)) as nodes from e")
def db_network_stats(spark, d):
    from corpusmill.operators.insights import cooccurrence

    e = cooccurrence(entities(spark, d))
    nodes = e.select(F.explode(F.array("entity_a", "entity_b")).alias("z")).agg(F.count_distinct("z").alias("nodes"))
    return e.agg(F.count("*").alias("edges")).crossJoin(nodes)


@query("with c as (select user_id, cast(ts as date) as day, count(*) as n from events group by all), b as (select min(day) as a, max(day) as z from c), g as (select u.user_id, d.day from (select distinct user_id from c) u cross join (select cast(unnest(generate_series(a, z, interval 1 day)) as date) as day from b) d) select g.user_id, cast(g.day as varchar) as day, coalesce(c.n, 0) as n from g left join c using (user_id, day)")
def daily_series_window(spark, d):
    c = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return calendar(c, "user_id").join(c, ["user_id", "day"], "left").select("user_id", F.col("day").cast("string").alias("day"), F.coalesce("n", F.lit(0)).alias("n"))
