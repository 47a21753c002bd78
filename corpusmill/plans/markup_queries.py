"""Page, feed and date extraction over pages made from the article table, streaming, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import markup as M
from corpusmill.plans.bindings import ART, articles, registry
from corpusmill.runtime import shared_dir
from corpusmill.sources import files, sinks
from corpusmill.sources.tables import table
from corpusmill.streaming import flows

QUERIES, SQL, query = registry()

# The articles as pages: the table's title, author, time and text in the markup of a news site.
_ESC = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
PAGE = (
    "'<html><head><title>' || " + _ESC.format("coalesce(title, '')") + " || ' | ' || source || '</title><meta property=\"article:published_time\" content=\"' || coalesce(cast(day as string), '') || '\"><meta name=\"author\" content=\"By ' || coalesce(author, '') || '\"></head><body><nav><a href=\"/home\">Home</a></nav><article><h1>' || "
    + _ESC.format("coalesce(title, '')") + " || '</h1><p>' || replace(" + _ESC.format("coalesce(body, '')") + ", '\\n', '</p><p>') || '</p><a href=\"' || url || '\">more</a><a href=\"/about\">About</a></article><script>var x = 1;</script></body></html>'"
)


def _pages(spark, d):
    return articles(spark, d).where("url is not null and source is not null").select("article_id", "title", "author", "body", "day", "url", "source", F.expr(PAGE).alias("html"))


_COL = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"


_HEAD = "trim(regexp_replace(coalesce(title, '') || ' | ' || source, '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))"


@query(
    f"with {ART}, p as (select article_id, author, day, string_split({_HEAD}, ' | ') as p from art where url is not null and source is not null) "
    "select article_id, trim(list_filter(p, lambda x: length(x) = list_max(list_transform(p, lambda y: length(y))))[1]) as title, cast(day as varchar) as published, nullif(trim(author), '') as author from p"
)
def html_title(spark, d):
    return _pages(spark, d).select("article_id", M.html_title(F.col("html")).alias("title"), M.html_date(F.col("html")).alias("published"), M.html_author(F.col("html")).alias("author"))


@query(f"with {ART} select article_id, array_to_string(list_filter(list_transform(string_split(coalesce(body, ''), chr(10)), lambda x: trim(regexp_replace(x, '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))), lambda x: x <> ''), chr(10) || chr(10)) as body from art where url is not null and source is not null")
def html_css_body(spark, d):
    return _pages(spark, d).select("article_id", M.html_body(F.col("html")).alias("body"))


@query(f"with {ART} select article_id, unnest(list_distinct([regexp_replace(url, '#.*$', ''), 'https://' || source || '/home', 'https://' || source || '/about'])) as link from art where url is not null and source is not null")
def html_links(spark, d):
    return _pages(spark, d).select("article_id", F.explode(M.html_links(F.col("html"), F.col("source"))).alias("link"))


@query(f"with {ART} select article_id, url, cast(day as varchar) as published from art where url is not null")
def scan_rss_xml(spark, d):
    item = F.concat(F.lit("<rss><channel><item><title><![CDATA[t]]></title><link>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</link><pubDate>"), F.coalesce(F.col("day").cast("string"), F.lit("")), F.lit("</pubDate></item></channel></rss>"))
    rows = articles(spark, d).where("url is not null").select("article_id", F.explode(M.feed_items(item)).alias("x"))
    return rows.select("article_id", "x.url", "x.published")


@query(f"with {ART} select distinct url, cast(last_day(make_date(cast(nullif(regexp_extract(url, '(?:^|\\D)((?:19|20)\\d{{2}})[-/]?(0[1-9]|1[0-2])(?:\\D|$)', 1), '') as bigint), cast(nullif(regexp_extract(url, '(?:^|\\D)((?:19|20)\\d{{2}})[-/]?(0[1-9]|1[0-2])(?:\\D|$)', 2), '') as bigint), 1)) as varchar) as until from art where url is not null")
def sitemap_date_infer(spark, d):
    return articles(spark, d).where("url is not null").select("url", M.sitemap_date(F.col("url")).cast("string").alias("until")).distinct()


@query("with e as (select event_type, cast(ts as date) as day, count(*) as n from events group by all) select event_type, cast(day as varchar) as day, n from e")
def stream_daily_volume(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return flows.daily_volume(e, "event_type").select("event_type", F.col("day").cast("string").alias("day"), "n")


@query("select distinct user_id from events")
def stream_first_seen(spark, d):
    """Distinct users through a file stream with its state store, run to the end of the input."""
    import uuid

    place = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).repartition(4, "user_id").write.parquet(f"{place}/in")
    rows = flows.read_stream(spark, f"{place}/in", spark.read.parquet(f"{place}/in").schema, 2)
    flows.run_available(flows.first_seen(rows, "user_id", keep="365 days").select("user_id"), f"{place}/out", f"{place}/state")
    return spark.read.parquet(f"{place}/out").distinct()


@query("select event_type, round(avg(value), 6) as mean, count(*) as n from events where ts >= timestamp '2024-01-10 00:00:00' and ts < timestamp '2024-01-24 00:00:00' group by event_type")
def stream_sliding_mean(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    m = flows.sliding_mean(e, "event_type", "value").where("until = timestamp '2024-01-24 00:00:00'")
    return m.select("event_type", F.round("mean", 6).alias("mean"), "n")


@query("select doc_id, lang, source from documents where text is not null")
def scan_jsonl(spark, d):
    """The documents written as JSON lines, with a malformed line among them, and read again."""
    import uuid

    place = f"{shared_dir(spark).rstrip('/')}/jsonl-{uuid.uuid4().hex}"
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "lang", "source")
    sinks.sink_jsonl(docs, place)
    spark.createDataFrame([("{broken",), ("",)], "value string").write.mode("append").text(place)
    return files.scan_jsonl(spark, place, docs.schema)


@query("select cast(first_seen as varchar) >= '2024-06-01' as recent, count(*) as n from seen_urls where substr(first_seen, 1, 10) >= '2024-01-01' group by 1")
def ttl_purge(spark, d):
    s = table(spark, d, "seen_urls").withColumn("at", F.to_timestamp(F.substring("first_seen", 1, 10)))
    kept = sinks.ttl_purge(s, "at", "2025-01-01 00:00:00", 366)
    return kept.groupBy((F.col("first_seen") >= "2024-06-01").alias("recent")).agg(F.count("*").alias("n"))


@query("with c as (select cast(unnest(generate_series(timestamp '2024-01-22', timestamp '2024-02-04', interval 1 day)) as date) as day), g as (select cast(ts as date) as day, count(distinct event_type) as f from events group by 1), r as (select c.day, coalesce(f, 0) as files, coalesce(f, 0) = (select count(distinct event_type) from events) as complete from c left join g on g.day = c.day) select cast(day as varchar) as day, cast(files as integer) as files, complete, round((select avg(cast(complete as int)) from r), 6) as ratio, (select avg(cast(complete as int)) from r) >= 0.45 as usable from r")
def window_availability(spark, d):
    inv = table(spark, d, "events").select(F.to_date("ts").alias("day"), F.col("event_type").alias("file")).distinct()
    need = [r[0] for r in inv.select("file").distinct().orderBy("file").limit(1001).collect()]
    if len(need) > 1000:
        raise ValueError("more than 1,000 kinds of files: they become the columns of a check")
    return files.window_availability(spark, inv, "2024-02-04", 14, need).select(F.col("day").cast("string").alias("day"), "files", "complete", "ratio", "usable")


@query("select doc_id, try_cast(rating as integer) as rating, try_cast(lang as bigint) as lang, cast(null as double) as score from documents")
def sink_coerce(spark, d):
    from pyspark.sql import types as T

    want = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("rating", T.IntegerType()), T.StructField("lang", T.LongType()), T.StructField("score", T.DoubleType())])
    return sinks.coerce(table(spark, d, "documents"), want)


@query("select language, count(*) as n, string_agg(source_id, ',' order by source_id) as ids from sources where language = 'en' group by language")
def run_query(spark, d):
    """Any SELECT with bound parameters over registered tables."""
    return spark.sql("select language, count(*) as n, array_join(array_sort(collect_list(source_id)), ',') as ids from {s} where language = :lang group by language", args={"lang": "en"}, s=table(spark, d, "sources"))


@query("select value, cast(ok as boolean) as ok from (values ('a', true)) t(value, ok)")
def sink_checksum(spark, d):
    """A table written twice with its manifest verified."""
    import uuid

    place = f"{shared_dir(spark).rstrip('/')}/manifest-{uuid.uuid4().hex}"
    sinks.sink_parquet(table(spark, d, "sources"), place)
    stored = sinks.manifest(spark, place)
    ok = sinks.verify_manifest(spark, place, stored).agg(F.bool_and("ok").alias("ok"))
    return ok.select(F.lit("a").alias("value"), "ok")
