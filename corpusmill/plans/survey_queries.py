"""Rows of the operator survey that need files, fixtures or several other queries: scans and sinks as
real round trips through the shared folder, text rules on texts written by hand, validation, signals
and syntheses."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import markup as M
from corpusmill.functions.clock import machine_instant
from corpusmill.operators import insights as I
from corpusmill.operators.relational import checked_broadcast
from corpusmill.plans import detail_queries, insight_queries, markup_queries
from corpusmill.plans.bindings import ANA, ART, EMOTIONS, analysis, articles, r6, registry
from corpusmill.plans.insight_queries import SCO, scored
from corpusmill.runtime import settle, shared_dir
from corpusmill.sources import files, sinks
from corpusmill.sources.tables import table

QUERIES, SQL, query = registry()
W = Window


def _place(spark, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


def _values(rows: list[tuple], names: str) -> str:
    """A fixture as a SQL table."""
    quoted = lambda v: "null" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return "(values " + ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows) + f") as fixture({names})"


# ---- scans ----


def _dated(spark, d) -> str:
    """The articles as a dataset partitioned by crawl date."""
    path = _place(spark, "dated")
    sinks.sink_parquet(articles(spark, d).where("day is not null").select("article_id", "source", F.col("day").alias("crawl_date")).repartition("crawl_date"), path, partition="crawl_date")
    return path


@query(f"with {ART} select cast(day as varchar) as day, count(*) as n from art where day between date '2024-09-01' and date '2024-09-30' group by day")
def scan_window(spark, d):
    return files.scan_window(spark, _dated(spark, d), "2024-09-01", "2024-09-30").groupBy(F.col("crawl_date").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query(f"with {ART} select article_id, source from art where day = (select max(day) from art)")
def scan_latest(spark, d):
    return files.scan_latest(spark, _dated(spark, d)).select("article_id", "source")


@query("select 'sources' as name, source_id as id from sources")
def scan_safe(spark, d):
    schema = T.StructType([T.StructField("source_id", T.StringType()), T.StructField("host", T.StringType())])
    found, missing = files.scan_safe(spark, f"{d}/sources.parquet", schema), files.scan_safe(spark, f"{d}/no_such_table.parquet", schema)
    return found.select(F.lit("sources").alias("name"), F.col("source_id").alias("id")).unionByName(missing.select(F.lit("missing").alias("name"), F.col("source_id").alias("id")))


# Crawl log lines written by hand: time, level, site, message.
LOG = [
    "2025-01-03 04:10:11 INFO [src_hoti] 48 urls discovered", "2025-01-03 04:10:15 ERROR [src_hoti] HTTP 403 Forbidden for /a/1", "2025-01-03 04:10:19 ERROR [src_hoti] HTTP 403 Forbidden for /a/2",
    "2025-01-03 04:11:02 WARNING [src_hoti] timed out after 30s", "2025-01-03 04:12:40 ERROR [src_tipor] HTTP 429 Too Many Requests", "2025-01-03 04:13:00 ERROR [src_tipor] connection reset by peer",
    "2025-01-03 04:13:09 INFO [src_tipor] done: 0 of 12", "a line that is no log line", "", "2025-01-03 04:15:00 ERROR [src_sogo] no article body found", "2025-01-03 04:15:31 ERROR [src_sogo] HTTP 500 Internal Server Error",
    "2025-01-03 04:16:02 ERROR [src_sogo] HTTP 502 Bad Gateway", "2025-01-03 04:17:44 WARNING [src_mapir] paywall detected", "2025-01-03 04:18:01 ERROR [src_mapir] SSL certificate has expired", "2025-01-03 04:19:00 INFO [src_mapir] done: 30 of 31",
]
LOG_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) ([A-Z]+) \[([a-z0-9_]+)\] (.*)$"
# Kinds of failures with the order in which one is named the main one.
FAILURES = [("blocked", "403|forbidden|paywall", 1), ("limited", "429|too many requests", 2), ("server", "http 5[0-9][0-9]", 3), ("network", "timed out|connection|ssl", 4), ("parse", "no article body", 5)]
_LOGGED = f"lg as (select regexp_extract(line, '{LOG_LINE}', 1) as at, regexp_extract(line, '{LOG_LINE}', 2) as level, regexp_extract(line, '{LOG_LINE}', 3) as site, regexp_extract(line, '{LOG_LINE}', 4) as message from {_values([(x,) for x in LOG], 'line')} where regexp_matches(line, '{LOG_LINE}'))"


def _logged(spark):
    path = _place(spark, "logs")
    spark.createDataFrame([(x,) for x in LOG], "value string").coalesce(1).write.text(path)
    return files.scan_log_lines(spark, path, LOG_LINE, ["at", "level", "site", "message"])


@query(f"with {_LOGGED} select * from lg")
def scan_log_lines(spark, d):
    return _logged(spark)


@query(
    f"with {_LOGGED}, h as (select site, kind, rank, count(*) as n from lg join {_values(FAILURES, 'kind, pattern, rank')} on regexp_matches(lower(message), pattern) group by all), "
    "s as (select site, cast(coalesce(max(try_cast(regexp_extract(message, 'done: (\\d+) of \\d+', 1) as integer)), -1) as integer) as done from lg group by site) "
    "select site, cast(sum(n) as bigint) as failures, arg_min(kind, rank) as main, any_value(done) as done from h join s using (site) group by site"
)
def failure_diagnosis(spark, d):
    """Failures by site from log lines: a taxonomy of patterns, the main kind by priority, and what the site reported as done (-1: nothing)."""
    lines = _logged(spark)
    kinds = spark.createDataFrame(FAILURES, "kind string, pattern string, rank int")
    hits = lines.join(F.broadcast(kinds), F.expr("lower(message) rlike pattern")).groupBy("site", "kind", "rank").agg(F.count("*").alias("n"))
    done = lines.groupBy("site").agg(F.coalesce(F.max(F.regexp_extract("message", r"done: (\d+) of \d+", 1).try_cast("int")), F.lit(-1)).alias("done"))
    return hits.groupBy("site").agg(F.sum("n").alias("failures"), F.min_by("kind", "rank").alias("main")).join(done, "site").select("site", "failures", "main", "done")


# An article list as an event database answers, with gaps, a repeated address and a foreign domain.
GDELT = """{"articles": [
 {"url": "https://news.fepen.example/a/1?utm_source=x", "title": "Bridge plan", "seendate": "20250103T041500Z", "domain": "news.fepen.example", "language": "English"},
 {"url": "https://news.fepen.example/a/2", "title": "Water report", "seendate": "20241201T000000Z", "domain": "news.fepen.example", "language": "English"},
 {"url": "https://news.fepen.example/a/2", "title": "Water report", "seendate": "20241201T000000Z", "domain": "news.fepen.example"},
 {"url": "https://other.example/b", "title": null, "seendate": "20250102T101112Z", "domain": "other.example", "language": "Spanish"},
 {"url": "", "title": "no address", "seendate": "20250102T101112Z", "domain": "news.fepen.example"},
 {"url": "https://fepen.example/c", "title": "No date", "domain": "fepen.example", "language": "French"}]}"""
GDELT_SCHEMA = "articles array<struct<url: string, title: string, seendate: string, domain: string, language: string>>"


@query(
    "with j as (select unnest(cast(json_extract('" + GDELT.replace("\n", "").replace("'", "''") + "', '$.articles') as json[])) as a), "
    "r as (select json_extract_string(a, '$.url') as url, json_extract_string(a, '$.title') as title, json_extract_string(a, '$.domain') as domain, try_strptime(json_extract_string(a, '$.seendate'), '%Y%m%dT%H%M%SZ') as seen from j) "
    "select distinct url, title, strftime(seen, '%Y-%m-%d %H:%M:%S') as seen from r where url <> '' and (domain = 'fepen.example' or domain like '%.fepen.example') and (seen is null or seen >= timestamp '2024-12-20')"
)
def scan_gdelt_json(spark, d):
    """Addresses of one site from an answer's article list: its domain and subdomains, not older than the horizon, undated ones kept."""
    path = _place(spark, "events")
    spark.createDataFrame([(GDELT.replace("\n", ""),)], "value string").write.text(path)
    a = spark.read.text(path).select(F.explode(F.from_json("value", GDELT_SCHEMA).getField("articles")).alias("a")).select("a.*")
    seen = machine_instant(F.col("seendate"))
    mine = (F.col("domain") == "fepen.example") | F.col("domain").endswith(".fepen.example")
    return a.where((F.col("url") != "") & mine & (seen.isNull() | (seen >= F.lit("2024-12-20").cast("timestamp")))).select("url", "title", F.date_format(seen, "yyyy-MM-dd HH:mm:ss").alias("seen")).distinct()


# ---- sinks ----

_SEEN = "select url_hash, source_id, batch_no from seen_urls"
SEEN_SCHEMA = T.StructType([T.StructField("url_hash", T.StringType()), T.StructField("source_id", T.StringType()), T.StructField("batch_no", T.IntegerType())])


@query(_SEEN)
def sink_parquet(spark, d):
    path = _place(spark, "sink")
    sinks.sink_parquet(table(spark, d, "seen_urls"), path, SEEN_SCHEMA)
    return spark.read.parquet(path)


@query(f"{_SEEN} union all {_SEEN}")
def sink_jsonl(spark, d):
    """Appended twice and read back under its schema."""
    path = _place(spark, "lines")
    for _ in range(2):
        sinks.sink_jsonl(table(spark, d, "seen_urls").select("url_hash", "source_id", "batch_no"), path)
    return files.scan_jsonl(spark, path, SEEN_SCHEMA)


@query(_SEEN)
def recompress(spark, d):
    source, target = _place(spark, "plain"), _place(spark, "zstd")
    table(spark, d, "seen_urls").select("url_hash", "source_id", "batch_no").write.option("compression", "none").parquet(source)
    sinks.recompress(spark, source, target, SEEN_SCHEMA)
    return spark.read.parquet(target)


@query(f"{_SEEN} where false")
def sink_empty(spark, d):
    """A table of no rows keeps its schema on disk."""
    path = _place(spark, "empty")
    sinks.sink_parquet(spark.createDataFrame([], SEEN_SCHEMA), path, SEEN_SCHEMA)
    return spark.read.parquet(path)


@query(f"with {ANA} select steeps as layer, count(*) as n from ana where steeps is not null group by steeps")
def idx_secondary(spark, d):
    """Signals laid out by layer and sorted by importance, so that filters on either read few files and row groups."""
    path = _place(spark, "signals")
    rows = analysis(spark, d).where("steeps is not null").select("article_id", F.col("steeps").alias("layer"), "importance")
    rows.repartition("layer").sortWithinPartitions("layer", "importance").write.partitionBy("layer").parquet(path)
    return spark.read.parquet(path).groupBy("layer").agg(F.count("*").alias("n"))


@query("select true as intact, 3 as columns, (select count(*) from seen_urls) as n, (select count(*) from seen_urls where url_hash is null or source_id is null) as incomplete")
def val_parquet_file(spark, d):
    """A written file against its manifest, its schema and its required columns."""
    path = _place(spark, "checked")
    sinks.sink_parquet(table(spark, d, "seen_urls"), path, SEEN_SCHEMA)
    intact = sinks.verify_manifest(spark, path, settle(sinks.manifest(spark, path))).agg(F.bool_and("ok").alias("intact"))
    rows = spark.read.parquet(path)
    counts = rows.agg(F.count("*").alias("n"), F.count_if(F.col("url_hash").isNull() | F.col("source_id").isNull()).alias("incomplete"))
    return intact.crossJoin(counts).select("intact", F.lit(len(rows.columns)).alias("columns"), "n", "incomplete")


@query(f"with {ART}, m as (select max(day) - 30 as cut from art) select day < (select cut from m) as archived, count(*) as n, bit_xor(hash_part) as digest from (select day, cast(('0x' || substr(sha256(article_id), 1, 15)) as bigint) as hash_part from art where day is not null) group by 1")
def retention(spark, d):
    """Partitions older than 30 days are archived, the archive is verified by its digest, and only then do they leave the dataset."""
    live, archive = _dated(spark, d), _place(spark, "archive")
    newest = spark.read.parquet(live).agg(F.max("crawl_date")).first()[0]
    cut = F.date_sub(F.lit(newest), 30)
    moved = sinks.archive_partitions(spark, live, archive, cut)
    part = F.conv(F.substring(F.sha2("article_id", 256), 1, 15), 16, 10).cast("bigint")
    digest = lambda df, name: df.agg(F.lit(name).alias("archived"), F.count("*").alias("n"), F.bit_xor(part).alias("digest")).where("n > 0")
    kept = spark.read.parquet(live) if moved >= 0 else None
    return digest(spark.read.schema("article_id string, source string, crawl_date date").parquet(archive), True).unionByName(digest(kept, False))


@query(f"with {SCO}, f as (select topic, round(avg(score), 4) as tone, count(*) as n from sco group by topic), r as (select *, row_number() over (order by abs(tone) desc, topic) as rank from f where tone is not null) select cast(rank as integer) as rank, '{{\"topic\":\"' || topic || '\",\"n\":' || n || '}}' as json, '- **' || topic || '**: ' || n || ' articles' as markdown from r where rank <= 10")
def sink_json_md(spark, d):
    """A report of the ten findings of the largest magnitude as JSON and as Markdown, written and read back."""
    f = scored(spark, d).groupBy("topic").agg(F.round(F.avg("score"), 4).alias("tone"), F.count("*").alias("n")).where("tone is not null").orderBy(F.abs("tone").desc(), "topic").limit(10)
    f = f.withColumn("rank", F.row_number().over(W.partitionBy().orderBy(F.abs("tone").desc(), "topic")))
    path = _place(spark, "report")
    f.select("rank", F.to_json(F.struct("topic", "n")).alias("json"), F.concat(F.lit("- **"), "topic", F.lit("**: "), F.col("n").cast("string"), F.lit(" articles")).alias("markdown")).coalesce(1).write.json(path)
    return spark.read.schema("rank int, json string, markdown string").json(path)


@query()
def file_inventory(spark, d):
    """Name and size of every table's files."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(d)
    return listed.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.col("length").alias("size"))


@query()
def status_report(spark, d):
    """Files and bytes by kind of file, and whether the expected tables are there."""
    listed = file_inventory(spark, d).withColumn("kind", F.regexp_extract("file", r"\.([^.]+)$", 1))
    return listed.groupBy("kind").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


EXPECTED = ("articles", "article_analysis", "seen_urls", "content_hashes", "sources", "documents", "embeddings", "no_such_table")


@query(f"select name, name <> 'no_such_table' as ok from {_values([(x,) for x in EXPECTED], 'name')}")
def val_files(spark, d):
    """Expected outputs that exist and hold at least 100 bytes, as a file or a folder."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(d)
    sizes = listed.groupBy(F.regexp_extract("path", r"/([a-z_]+)\.parquet(/[^/]*)?$", 1).alias("name")).agg(F.sum("length").alias("bytes"))
    return spark.createDataFrame([(x,) for x in EXPECTED], "name string").join(sizes, "name", "left").select("name", F.coalesce(F.col("bytes") >= 100, F.lit(False)).alias("ok"))


# ---- text rules ----

_HEAD200 = "coalesce(title, '') || ' ' || substr(coalesce(body, ''), 1, 200)"


@query(
    f"with {ART}, t as (select a.article_id, s.language as expected, {_HEAD200} as t from art a left join (select source_id, min(language) as language from sources group by 1) s on s.source_id = a.source), "
    "n as (select *, length(regexp_replace(t, '[^가-힣]', '', 'g')) as ko, length(regexp_replace(t, '[^А-яЁё]', '', 'g')) as ru, length(regexp_replace(t, '\\P{L}', '', 'g')) as letters from t) "
    "select article_id, case when length(trim(t)) < 10 or letters = 0 then coalesce(expected, 'en') when ko / letters > 0.3 then 'ko' when ru / letters > 0.3 then 'ru' when expected in ('ko', 'ru') then 'en' else coalesce(expected, 'en') end as lang from n"
)
def detect_language(spark, d):
    """Language by the scripts of title and lead; texts too short to tell, and Latin ones, take the source's language where that fits."""
    lang = table(spark, d, "sources").groupBy("source_id").agg(F.min("language").alias("expected"))
    t = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.substring(F.coalesce("body", F.lit("")), 1, 200))
    n = lambda p: F.regexp_count(F.col("t"), F.lit(p))
    rows = articles(spark, d).join(checked_broadcast(lang), F.col("source") == F.col("source_id"), "left").select("article_id", "expected", t.alias("t"))
    rows = rows.select("article_id", "expected", "t", n("[가-힣]").alias("ko"), n("[А-яЁё]").alias("ru"), n(r"\p{L}").alias("letters"))
    expected = F.coalesce("expected", F.lit("en"))
    by_script = F.when((F.length(F.trim("t")) < 10) | (F.col("letters") == 0), expected).when(F.col("ko") / F.col("letters") > 0.3, "ko").when(F.col("ru") / F.col("letters") > 0.3, "ru").when(expected.isin("ko", "ru"), "en").otherwise(expected)
    return rows.select("article_id", by_script.alias("lang"))


# Short lists of words that carry no content.
STOP_EN, STOP_KO = ("the", "and", "for", "with", "from", "that", "this", "are", "was", "has", "its", "not"), ("그리고", "하지만", "또한", "있다", "했다", "위해", "대해")


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


@query(f"with {ART} select article_id, list_filter(regexp_extract_all(lower(coalesce(body, '')), '[a-z]{{3,}}'), lambda w: w not in ({_quoted(STOP_EN)})) as tokens from art where lang = 'en'")
def tokenize_en(spark, d):
    words = F.regexp_extract_all(F.lower(F.coalesce("body", F.lit(""))), F.lit("[a-z]{3,}"), F.lit(0))
    return articles(spark, d).where("lang = 'en'").select("article_id", F.filter(words, lambda w: ~w.isin(*STOP_EN)).alias("tokens"))


_JOSA = "(은|는|이|가|을|를|에|에서|도|의|로|으로|와|과)$"


@query(f"with {ART}, w as (select article_id, list_transform(regexp_extract_all(coalesce(body, ''), '[가-힣]{{2,}}'), lambda w: case when length(w) > 2 then regexp_replace(w, '{_JOSA}', '') else w end) as w from art where lang = 'ko') select article_id, list_filter(w, lambda x: length(x) >= 2 and x not in ({_quoted(STOP_KO)})) as tokens from w")
def tokenize_ko(spark, d):
    """Hangul words without the particle at their end; the fallback of a morphological analyser."""
    words = F.regexp_extract_all(F.coalesce("body", F.lit("")), F.lit("[가-힣]{2,}"), F.lit(0))
    bare = F.transform(words, lambda w: F.when(F.length(w) > 2, F.regexp_replace(w, _JOSA, "")).otherwise(w))
    return articles(spark, d).where("lang = 'ko'").select("article_id", F.filter(bare, lambda w: (F.length(w) >= 2) & ~w.isin(*STOP_KO)).alias("tokens"))


# Values that scrapers left as structures in text columns, with what is wanted of them.
STRUCTURED = [(1, "plain words"), (2, '{"name": "Ana Ruiz", "url": "https://x.example"}'), (3, '["first", "second"]'), (4, '{"href": "https://x.example/a"}'), (5, "{broken"), (6, "[]"), (7, None), (8, '{"text": "quoted \\"here\\""}'), (9, '{"other": 1}'), (10, '[{"name": "Kim"}]')]


@query(
    f"with v as (select id, v, case when json_valid(v) and v similar to '[\\[{{].*' then cast(v as json) end as j from {_values(STRUCTURED, 'id, v')}), "
    "o as (select id, v, case when json_type(j) = 'ARRAY' then json_extract(j, '$[0]') else j end as j, j is not null as parsed from v) "
    "select id, case when not parsed then v when json_type(j) = 'VARCHAR' then json_extract_string(j, '$') else coalesce(json_extract_string(j, '$.name'), json_extract_string(j, '$.text'), json_extract_string(j, '$.href'), json_extract_string(j, '$.url'), '') end as clean from o"
)
def utf8_sanitize(spark, d):
    """Text of dictionaries and lists in string columns: name, text, href or url, or the first item; other texts stay."""
    v = F.col("v")
    one = F.when(v.startswith("["), F.try_element_at(F.from_json(v, "array<string>"), F.lit(1))).otherwise(v)
    rows = spark.createDataFrame(STRUCTURED, "id int, v string").withColumn("one", one).withColumn("parsed", F.from_json("v", "variant").isNotNull() if False else (v.startswith("[") & F.from_json(v, "array<string>").isNotNull()) | (v.startswith("{") & v.endswith("}")))
    part = lambda k: F.get_json_object("one", f"$.{k}")
    item = F.when(F.col("one").startswith("{"), F.coalesce(part("name"), part("text"), part("href"), part("url"), F.lit(""))).otherwise(F.coalesce("one", F.lit("")))
    return rows.select("id", F.when(F.coalesce("parsed", F.lit(False)), item).otherwise(v).alias("clean"))


# Bylines as local sites write them.
BYLINES = [
    (1, "[서울=연합] 김민수 기자 = 다리 계획이", "김민수"), (2, "박지영 특파원 bjy@news.example", "박지영"), (3, "기자의 눈", None), (4, "记者 王小明 报道", "王小明"), (5, "本报记者：李华", "李华"), (6, "編集部 田中太郎記者", "田中太郎"),
    (7, "文・佐藤花子", "佐藤花子"), (8, "By Jane Roe", None), (9, "", None), (10, None, None), (11, "이 기자 = 짧다", None), (12, "작성자: 최유진", "최유진"),
]
_KO_BYLINE = r"([가-힣]{2,4}) ?(?:기자|특파원|앵커)(?:[ =]|$)"
_KO_LABEL = r"(?:작성자|글쓴이) ?: ?([가-힣]{2,4})"
_ZH_BYLINE = r"(?:本报)?(?:记者|記者)[ ：:]([一-龥]{2,4})"
_JA_BYLINE = r"([一-龥]{3,5})記者|文・([一-龥]{3,5})"


@query(
    f"with v as (select * from {_values([b[:2] for b in BYLINES], 'id, t')}) select id, coalesce(nullif(regexp_extract(t, '{_KO_BYLINE}', 1), ''), nullif(regexp_extract(t, '{_KO_LABEL}', 1), ''), nullif(regexp_extract(t, '{_ZH_BYLINE}', 1), ''), nullif(regexp_extract(t, '{_JA_BYLINE}', 1), ''), nullif(regexp_extract(t, '{_JA_BYLINE}', 2), '')) as author from v"
)
def author_locale(spark, d):
    """Authors of Korean, Chinese and Japanese bylines; null where there is none."""
    found = lambda p, g=1: F.nullif(F.regexp_extract("t", p, g), F.lit(""))
    return spark.createDataFrame([b[:2] for b in BYLINES], "id int, t string").select("id", F.coalesce(found(_KO_BYLINE), found(_KO_LABEL), found(_ZH_BYLINE), found(_JA_BYLINE), found(_JA_BYLINE, 2)).alias("author"))


_BIDI = "[\\x{200e}\\x{200f}\\x{202a}-\\x{202e}\\x{2066}-\\x{2069}\\x{061c}]"


@query(f"with {ART} select article_id, regexp_replace(chr(8207) || coalesce(title, '') || chr(8236), '{_BIDI}', '', 'g') as title from art")
def strip_rtl(spark, d):
    """Titles without marks of writing direction; every title is given two for the purpose."""
    marked = F.concat(F.lit("‏"), F.coalesce("title", F.lit("")), F.lit("‬"))
    return articles(spark, d).select("article_id", F.regexp_replace(marked, _BIDI, "").alias("title"))


@query(f"with {ART}, p as (select article_id, string_split({markup_queries._HEAD}, ' | ') as p from art where url is not null and source is not null) select article_id, trim(list_filter(p, lambda x: length(x) = list_max(list_transform(p, lambda y: length(y))))[1]) as title, '' as body, true as title_only from p")
def html_title_only(spark, d):
    """What a page behind a wall still tells: its title; the body stays empty and is marked so."""
    return markup_queries._pages(spark, d).select("article_id", M.html_title(F.col("html")).alias("title"), F.lit("").alias("body"), F.lit(True).alias("title_only"))


@query(f"with {ART} select article_id, published_at as raw, strftime(x.ts, '%Y-%m-%d %H:%M:%S') as ts from (select distinct article_id, published_at, case when regexp_full_match(published_at, '\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d+)?(Z|[+-]\\d{{2}}:\\d{{2}})?') then try_strptime(substr(published_at, 1, 19), '%Y-%m-%dT%H:%M:%S') - to_minutes(coalesce(try_cast(regexp_extract(published_at, '([+-])(\\d{{2}}):(\\d{{2}})$', 1) || '1' as bigint), 0) * (coalesce(try_cast(regexp_extract(published_at, '([+-])(\\d{{2}}):(\\d{{2}})$', 2) as bigint), 0) * 60 + coalesce(try_cast(regexp_extract(published_at, '([+-])(\\d{{2}}):(\\d{{2}})$', 3) as bigint), 0))) end as ts from articles) x")
def parse_ts(spark, d):
    """ISO 8601 instants of published_at, read as UTC where no zone is written; null for everything else."""
    rows = table(spark, d, "articles").select("article_id", F.col("published_at").alias("raw")).distinct()
    iso = F.col("raw").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?$")
    zoned = F.when(F.col("raw").rlike(r"(Z|[+-]\d{2}:\d{2})$"), F.col("raw")).otherwise(F.concat("raw", F.lit("Z")))
    return rows.select("article_id", "raw", F.date_format(F.when(iso, machine_instant(zoned)), "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("select article_id, round(coalesce(case when isfinite(try_cast(trim(crawled_at) as double)) then try_cast(trim(crawled_at) as double) end, 0), 3) as value from (select distinct article_id, crawled_at from articles)")
def safe_float(spark, d):
    """Numbers in text, the default (0) for what isn't one, isn't finite or is null."""
    rows = table(spark, d, "articles").select("article_id", "crawled_at").distinct()
    v = F.trim("crawled_at").try_cast("double")
    return rows.select("article_id", F.round(F.coalesce(F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v), F.lit(0.0)), 3).alias("value"))


SERIES_IDS = [("topic_12_volume",), ("topic_-1_sentiment",), ("topic_7_burst_score",), ("volume_7",), ("topic_x_volume",), (None,)]


@query(f"select id, try_cast(regexp_extract(id, '^topic_(-?\\d+)_(.+)$', 1) as integer) as topic, nullif(regexp_extract(id, '^topic_(-?\\d+)_(.+)$', 2), '') as metric from {_values(SERIES_IDS, 'id')}")
def series_id_parse(spark, d):
    part = lambda g: F.nullif(F.regexp_extract("id", r"^topic_(-?\d+)_(.+)$", g), F.lit(""))
    return spark.createDataFrame(SERIES_IDS, "id string").select("id", part(1).try_cast("int").alias("topic"), part(2).alias("metric"))


@query(f"with {ART}, s as (select source, min(day) as first, max(day) as last, date_diff('day', min(day), max(day)) + 1 as days from art where day is not null and source is not null group by source) select source, case when days <= 8 then 'weekly-' || strftime(last, '%G-W%V') when days <= 35 then 'monthly-' || strftime(last, '%Y-%m') else 'quarterly-' || strftime(last, '%Y') || '-Q' || quarter(last) end as run from s")
def run_id(spark, d):
    """A label of the window that a source's articles span."""
    s = articles(spark, d).where("day is not null and source is not null").groupBy("source").agg(F.max("day").alias("last"), (F.datediff(F.max("day"), F.min("day")) + 1).alias("days"))
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), F.col("last")).cast("string"), F.lit("-W"), F.lpad(F.weekofyear("last").cast("string"), 2, "0"))
    quarter = F.concat(F.year("last").cast("string"), F.lit("-Q"), F.quarter("last").cast("string"))
    return s.select("source", F.when(F.col("days") <= 8, F.concat(F.lit("weekly-"), week)).when(F.col("days") <= 35, F.concat(F.lit("monthly-"), F.date_format("last", "yyyy-MM"))).otherwise(F.concat(F.lit("quarterly-"), quarter)).alias("run"))


_CAPS = "[A-Z][a-z]+(?: [A-Z][a-z]+)*"
_NAMES = f"nm as (select article_id, source, regexp_extract_all(coalesce(title, '') || '. ' || coalesce(body, ''), '{_CAPS}') as names from art)"


def _names(spark, d):
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(". "), F.coalesce("body", F.lit("")))
    return articles(spark, d).select("article_id", "source", F.regexp_extract_all(text, F.lit(_CAPS), F.lit(0)).alias("names"))


@query(f"with {ART}, {_NAMES} select article_id, unnest(names) as entity from nm")
def explode_entities_col(spark, d):
    return _names(spark, d).select("article_id", F.explode("names").alias("entity"))


@query(f"with {ART}, {_NAMES}, x as (select article_id, unnest(names) as e, generate_subscripts(names, 1) as i from nm), f as (select article_id, lower(e) as k, arg_min(e, i) as e from x group by all) select f.article_id, f.e as entity from f where not exists (select 1 from f g where g.article_id = f.article_id and g.k <> f.k and contains(g.k, f.k))")
def entity_dedup(spark, d):
    """Names of each article once, whatever their case, and only the longest of those that contain each other; the first spelling counts."""
    merged = F.aggregate(
        "names",
        F.array().cast("array<string>"),
        lambda kept, e: F.when(F.exists(kept, lambda k: F.contains(F.lower(k), F.lower(e))), kept).otherwise(F.array_append(F.filter(kept, lambda k: ~F.contains(F.lower(e), F.lower(k))), e)),
    )
    return _names(spark, d).select("article_id", F.explode(merged).alias("entity"))


@query(f"with {ART}, p as (select article_id, title, body, coalesce(length(trim(body)), 0) < 200 as cut from art) select article_id, case when cut then '' else body end as body, cut from p")
def body_blank_if_paywall(spark, d):
    """Bodies too short to be more than the teaser before a wall are blanked and marked."""
    cut = F.coalesce(F.length(F.trim("body")), F.lit(0)) < 200
    return articles(spark, d).select("article_id", F.when(cut, "").otherwise(F.col("body")).alias("body"), cut.alias("cut"))


TECH, FINANCE = ("A3", "F1"), ("A2", "B1")


@query(f"with {ART} select a.article_id, case when s.group_name in ({_quoted(TECH)}) then 'T' when s.group_name in ({_quoted(FINANCE)}) then 'E' else 'E' end as steeps from art a left join (select source_id, min(group_name) as group_name from sources group by 1) s on s.source_id = a.source")
def steeps_fallback(spark, d):
    """The class of an article without a scorer: by its source's group, economic by default."""
    g = table(spark, d, "sources").groupBy("source_id").agg(F.min("group_name").alias("g"))
    rows = articles(spark, d).join(checked_broadcast(g), F.col("source") == F.col("source_id"), "left")
    return rows.select("article_id", F.when(F.col("g").isin(*TECH), "T").when(F.col("g").isin(*FINANCE), "E").otherwise("E").alias("steeps"))


# ---- aggregations ----


@query("select article_id, source_id, first_seen, normalized_url from (select *, row_number() over (partition by article_id order by first_seen desc nulls last, batch_no desc nulls last, normalized_url desc nulls last, source_id desc nulls last) as rn from seen_urls) where rn = 1")
def agg_distinct_rows(spark, d):
    """The last row of each article: max_by combines on the map side, so that no key is gathered in one task."""
    u = table(spark, d, "seen_urls").select("article_id", "source_id", "first_seen", "batch_no", "normalized_url")
    order = F.struct(F.coalesce("first_seen", F.lit("")).alias("a"), F.coalesce("batch_no", F.lit(-1)).alias("b"), F.coalesce("normalized_url", F.lit("")).alias("c"), F.coalesce("source_id", F.lit("")).alias("d"))
    return u.groupBy("article_id").agg(F.max_by(F.struct("source_id", "first_seen", "normalized_url"), order).alias("x")).select("article_id", "x.*")


@query("select source_id, case when normalized_url is null then 'no address' when url_hash is null then 'no hash' when lower(url_hash) <> sha256(normalized_url) then 'mismatch' when url_hash <> lower(url_hash) then 'capitals' else 'ok' end as status, count(*) as n from seen_urls group by all")
def feed_health(spark, d):
    """State of the registered addresses by source: whether the hash is there and is the address's."""
    u, h = F.col("normalized_url"), F.col("url_hash")
    status = F.when(u.isNull(), "no address").when(h.isNull(), "no hash").when(F.lower(h) != F.sha2(u, 256), "mismatch").when(h != F.lower(h), "capitals").otherwise("ok")
    return table(spark, d, "seen_urls").groupBy("source_id", status.alias("status")).agg(F.count("*").alias("n"))


_GOALS = [("success", 0.8), ("unique", 0.95), ("bodies", 0.9)]


@query(
    f"with {ART}, u as (select source_id, count(*) as n, count(distinct article_id) as ids, count(distinct normalized_url) as urls from seen_urls group by source_id), a as (select source, count(*) as got, count(*) filter (where trim(coalesce(body, '')) <> '') as bodies from art group by source), "
    "m as (select source_id, least(1, coalesce(got, 0) / ids) as success, urls / n as uniq, case when got > 0 then bodies / got else 0 end as bodies from u left join a on a.source = u.source_id), "
    "x as (select source_id, 'success' as metric, success as value, 0.8 as goal from m union all select source_id, 'unique', uniq, 0.95 from m union all select source_id, 'bodies', bodies, 0.9 from m) "
    "select source_id, metric, round(value, 6) as value, value >= goal as met from x"
)
def success_metrics(spark, d):
    """By source: registered articles that were got, distinct addresses among the registered ones, articles with a body; each against its goal."""
    u = table(spark, d, "seen_urls").groupBy("source_id").agg(F.count("*").alias("n"), F.count_distinct("article_id").alias("ids"), F.count_distinct("normalized_url").alias("urls"))
    a = articles(spark, d).groupBy(F.col("source").alias("source_id")).agg(F.count("*").alias("got"), F.count_if(F.trim(F.coalesce("body", F.lit(""))) != "").alias("with_body"))
    m = u.join(a, "source_id", "left").select(
        "source_id",
        F.least(F.lit(1.0), F.coalesce("got", F.lit(0)) / F.col("ids")).alias("success"),
        (F.col("urls") / F.col("n")).alias("unique"),
        F.when(F.col("got") > 0, F.col("with_body") / F.col("got")).otherwise(0.0).alias("bodies"),
    )
    goals = F.create_map(*(x for k, v in _GOALS for x in (F.lit(k), F.lit(v))))
    return m.unpivot(["source_id"], ["success", "unique", "bodies"], "metric", "value").select("source_id", "metric", r6("value", "value"), (F.col("value") >= F.element_at(goals, F.col("metric"))).alias("met"))


# ---- countries ----

# Countries of the zones' places and of the languages.
ZONE_COUNTRY = {
    "America/New_York": "US", "America/Chicago": "US", "America/Sao_Paulo": "BR", "America/Bogota": "CO", "Asia/Seoul": "KR", "Asia/Kolkata": "IN", "Australia/Sydney": "AU",
    "Europe/Berlin": "DE", "Europe/Vienna": "AT", "Europe/London": "GB", "Europe/Paris": "FR", "Europe/Madrid": "ES", "Europe/Lisbon": "PT", "Europe/Moscow": "RU",
}
LANG_COUNTRY = {"en": "GB", "de": "DE", "fr": "FR", "es": "ES", "pt": "PT", "ko": "KR", "ru": "RU"}
_CTRY = (
    f"ctry as (select s.article_id, z.country from sco s join sources o on o.source_id = s.source join {_values(list(ZONE_COUNTRY.items()), 'zone, country').replace('fixture', 'z')} on z.zone = o.tz_name "
    f"union select s.article_id, l.country from sco s join {_values(list(LANG_COUNTRY.items()), 'lang, country').replace('fixture', 'l')} on l.lang = s.lang)"
)


def _countries(spark, d):
    """(article_id, country): the countries of an article's source and of its language."""
    zone = F.create_map(*(F.lit(x) for kv in ZONE_COUNTRY.items() for x in kv))
    lang = F.create_map(*(F.lit(x) for kv in LANG_COUNTRY.items() for x in kv))
    places = table(spark, d, "sources").select(F.col("source_id").alias("source"), F.try_element_at(zone, F.col("tz_name")).alias("home")).where("source is not null").dropDuplicates(["source"])
    rows = articles(spark, d).select("article_id", "source", "lang").join(checked_broadcast(places), "source", "left")
    both = F.array_compact(F.array_distinct(F.array("home", F.try_element_at(lang, F.col("lang")))))
    return rows.select("article_id", F.explode(both).alias("country"))


@query(
    f"with {SCO}, {_CTRY}, p as (select a.article_id, a.country as x, b.country as y from ctry a join ctry b on a.article_id = b.article_id and a.country < b.country) select x, y, count(distinct s.article_id) as n, round(avg(score), 6) as tone, "
    + ", ".join(f"round(avg({e}), 6) as {e}" for e in EMOTIONS) + " from p join sco s using (article_id) group by x, y having count(distinct s.article_id) >= 10"
)
def gi1_bri(spark, d):
    """Tone and emotions of the articles that two countries share, for pairs with at least ten of them.

    An article has few countries, so its pairs are formed from one array a row, not from a self-join.
    """
    found = _countries(spark, d).groupBy("article_id").agg(F.array_sort(F.collect_set("country")).alias("c")).where("size(c) >= 2")
    pairs = F.flatten(F.transform("c", lambda x, i: F.transform(F.slice("c", i + 2, F.size("c")), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    p = found.select("article_id", F.explode(pairs).alias("p")).select("article_id", "p.x", "p.y").join(scored(spark, d).select("article_id", "score", *EMOTIONS), "article_id")
    return p.groupBy("x", "y").agg(F.count_distinct("article_id").alias("n"), r6(F.avg("score"), "tone"), *(r6(F.avg(e), e) for e in EMOTIONS)).where("n >= 10")


@query(
    f"with {SCO}, {_CTRY}, b as (select country, count(distinct c.article_id) as n, avg(score) as tone from ctry c join sco using (article_id) group by country), "
    "k as (select country, steeps, count(*) as m from ctry join sco using (article_id) where steeps is not null group by all), h as (select country, -sum(m / t * log2(m / t)) as h from (select *, sum(m) over (partition by country) as t from k) group by country), "
    "g as (select a.country, count(distinct b.country) as deg from ctry a join ctry b on a.article_id = b.article_id and a.country <> b.country group by a.country) "
    "select country, round(0.25 * n / max(n) over () + 0.3 * (coalesce(tone, 0) + 1) / 2 + 0.2 * least(1, coalesce(h, 0) / log2(6)) + 0.25 * coalesce(deg, 0) / max(coalesce(deg, 0)) over (), 6) as power from b left join h using (country) left join g using (country)"
)
def gi2_soft_power(spark, d):
    """Weight of a country: visibility, tone, diversity of subjects and number of countries it is named with."""
    c = settle(_countries(spark, d))
    s = scored(spark, d).select("article_id", "score", "steeps")
    rows = c.join(s, "article_id")
    b = rows.groupBy("country").agg(F.count_distinct("article_id").alias("n"), F.avg("score").alias("tone"))
    h = I.entropy(rows, "country", "steeps").select("country", F.col("bits").alias("h"))
    sets = c.groupBy("article_id").agg(F.collect_set("country").alias("all"))
    deg = sets.where("size(all) > 1").select(F.explode("all").alias("country"), "all").select("country", F.explode("all").alias("other")).where("country <> other").groupBy("country").agg(F.count_distinct("other").alias("deg"))
    w = W.partitionBy()
    d0 = F.coalesce("deg", F.lit(0))
    p = 0.25 * F.col("n") / F.max("n").over(w) + 0.3 * (F.coalesce("tone", F.lit(0.0)) + 1) / 2 + 0.2 * F.least(F.lit(1.0), F.coalesce("h", F.lit(0.0)) / F.log2(F.lit(6))) + 0.25 * d0 / F.max(d0).over(w)
    return b.join(h, "country", "left").join(deg, "country", "left").select("country", r6(p, "power"))


@query(
    f"with pr as ({SQL['gi1_bri']}), ep as ({insight_queries.SQL['ei1_epu']}), se as ({insight_queries.SQL['ei2_sector']}), sm as (select day, max(sentiment) as top, count(*) as n from se group by day), bu as ({insight_queries.SQL['nf3_hhi']}) "
    "select 'crisis_pair' as alert, x || '-' || y as name, tone as magnitude from pr where tone < -0.05 and n >= 5 union all select 'policy_uncertainty', lang || ' ' || day, share from ep where share > 0.4 union all select 'sector_downturn', day, top from sm where top < 0 and n >= 2"
)
def fi4_alerts(spark, d):
    """Alerts from other metrics: pairs of countries with a bad tone, days of uncertain policy by language, days on which every sector is negative."""
    pairs = gi1_bri(spark, d).where("tone < -0.05 and n >= 5").select(F.lit("crisis_pair").alias("alert"), F.concat_ws("-", "x", "y").alias("name"), F.col("tone").alias("magnitude"))
    epu = insight_queries.ei1_epu(spark, d).where("share > 0.4").select(F.lit("policy_uncertainty").alias("alert"), F.concat_ws(" ", "lang", "day").alias("name"), F.col("share").alias("magnitude"))
    sectors = insight_queries.ei2_sector(spark, d).groupBy("day").agg(F.max("sentiment").alias("top"), F.count("*").alias("n")).where("top < 0 and n >= 2").select(F.lit("sector_downturn").alias("alert"), F.col("day").alias("name"), F.col("top").alias("magnitude"))
    return pairs.unionByName(epu, allowMissingColumns=True).unionByName(sectors, allowMissingColumns=True)


# ---- signals ----

_SIG = "sg as (select steeps as layer, topic, max(importance) as confidence, list_sort(list_distinct(list(article_id))) as ids, cast(min(day) as varchar) as detected from sco where steeps is not null and topic <> '-1' and importance is not null group by all)"


def _signals(spark, d):
    s = scored(spark, d).where("steeps is not null and topic <> '-1' and importance is not null")
    return s.groupBy(F.col("steeps").alias("layer"), "topic").agg(F.max("importance").alias("confidence"), F.array_sort(F.array_distinct(F.collect_list("article_id"))).alias("ids"), F.min("day").cast("string").alias("detected"))


@query(f"with {SCO}, {_SIG} select layer, topic, round(confidence, 6) as confidence, ids from sg")
def signals_dedup(spark, d):
    """One signal for each layer and topic: the greatest confidence, all article ids once. The ids are the result's own column, in one row by definition."""
    return _signals(spark, d).select("layer", "topic", r6("confidence", "confidence"), "ids")


@query(f"with {SCO}, {_SIG} select layer || '/' || topic as signal, layer, coalesce(len(ids), 0) as article_count, detected, round(confidence, 6) as confidence from sg union all select 'none', 'none', 0, null, null")
def idx_signals(spark, d):
    """The index of signals: number of articles (0 without a list), times as text."""
    none = spark.createDataFrame([("none", "none", None, None, None)], "signal string, layer string, ids array<string>, detected string, confidence double")
    rows = _signals(spark, d).select(F.concat_ws("/", "layer", "topic").alias("signal"), "layer", "ids", "detected", "confidence").unionByName(none)
    n = F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("bigint")
    return rows.select("signal", "layer", n.alias("article_count"), "detected", r6("confidence", "confidence"))


_CROSS = (
    f"cx as (select 'shared_sources' as analysis_type, cast(a as varchar) as source_series, cast(b as varchar) as target_series, j as strength, cast(null as double) as p_value, cast(null as integer) as lag from ({detail_queries.SQL['topic_jaccard']}) "
    f"union all select 'topic_entity', topic, entity, strength, null, null from ({detail_queries.SQL['graphrag_chain']}) "
    f"union all select 'agenda', cast(a as varchar), cast(b as varchar), coalesce(j, 0), null, null from ({detail_queries.SQL['topic_jaccard']}) where j >= 0.5)"
)


def _cross(spark, d):
    row = lambda df, kind, a, b, s: df.select(F.lit(kind).alias("analysis_type"), F.col(a).alias("source_series"), F.col(b).alias("target_series"), F.col(s).alias("strength"))
    shared = detail_queries.topic_jaccard(spark, d)
    rows = row(shared, "shared_sources", "a", "b", "j").unionByName(row(detail_queries.graphrag_chain(spark, d), "topic_entity", "topic", "entity", "strength")).unionByName(row(shared.where("j >= 0.5"), "agenda", "a", "b", "j"))
    return rows.withColumn("p_value", F.lit(None).cast("double")).withColumn("lag", F.lit(None).cast("int"))


@query(f"with {_CROSS} select * from cx")
def cross_union(spark, d):
    """What the cross-analyses found, in one table."""
    return _cross(spark, d)


@query(f"with {_CROSS} select analysis_type, count(*) as n from cx group by analysis_type")
def db_cross_types(spark, d):
    return _cross(spark, d).groupBy("analysis_type").agg(F.count("*").alias("n"))


@query(f"with {_CROSS} select * from cx order by strength desc, analysis_type, source_series, target_series limit 10")
def db_cross_top(spark, d):
    return _cross(spark, d).orderBy(F.desc("strength"), "analysis_type", "source_series", "target_series").limit(10)


@query(f"with {_CROSS}, t as (select source_series as topic, count(distinct target_series) as links, max(strength) as strongest from cx where analysis_type = 'shared_sources' group by 1), l as ({detail_queries.SQL['classify_layer']}) select l.topic, l.layer, coalesce(links, 0) as links, coalesce(strongest, 0) as strongest from l left join t on t.topic = l.topic")
def cross_features(spark, d):
    """The topics' layers with what the cross-analyses know of them."""
    t = _cross(spark, d).where("analysis_type = 'shared_sources'").groupBy(F.col("source_series").alias("topic")).agg(F.count_distinct("target_series").alias("links"), F.max("strength").alias("strongest"))
    return detail_queries.classify_layer(spark, d).join(t, "topic", "left").select("topic", "layer", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("strongest", F.lit(0.0)).alias("strongest"))


@query(detail_queries.SQL["classify_layer"])
def dual_pass(spark, d):
    """Layers by the pass over the bodies, which decides whatever the titles say."""
    return detail_queries.classify_layer(spark, d)


@query(f"with {SCO}, t as (select topic, count(*) filter (where score < 0) as bad, count(*) filter (where score > 0) as good from sco group by topic) select topic, bad, good, case when good = 0 and bad = 0 then 'none' when bad > good then 'conflict' else 'cooperation' end as label from t")
def spectrum_label(spark, d):
    """Conflict where a topic has more negative than positive articles."""
    t = scored(spark, d).groupBy("topic").agg(F.count_if(F.col("score") < 0).alias("bad"), F.count_if(F.col("score") > 0).alias("good"))
    return t.withColumn("label", F.when((F.col("good") == 0) & (F.col("bad") == 0), "none").when(F.col("bad") > F.col("good"), "conflict").otherwise("cooperation"))


# ---- validation ----

_STAGES = {
    "stage1": ("art", [("no_title", "coalesce(trim(title), '') = ''"), ("no_body", "coalesce(trim(body), '') = ''"), ("no_time", "ts is null"), ("no_language", "lang = 'und'"), ("word_count", "word_count is null or word_count < 0")]),
    "stage3": ("ana", [("score_range", "score is null or score < -1 or score > 1"), ("emotion_range", " or ".join(f"coalesce({e} < 0 or {e} > 1, true)" for e in EMOTIONS)), ("importance_range", "importance is null or importance < 0 or importance > 100"), ("steeps_code", "steeps is null or steeps not in ('S', 'T', 'E', 'P')"), ("label", "sentiment_label is null")]),
}


@query(f"with {ART}, {ANA} " + " union all ".join(f"select '{stage}' as stage, '{name}' as problem, count(*) filter (where {cond}) as n, count(*) as total from {rows}" for stage, (rows, checks) in _STAGES.items() for name, cond in checks))
def val_stages(spark, d):
    """Rows of the first and third stages' outputs that break a rule; each table is read once for all its rules."""
    parts = []
    for stage, (rows, checks) in _STAGES.items():
        df = articles(spark, d) if rows == "art" else analysis(spark, d)
        counts = df.agg(F.count("*").alias("total"), *(F.count_if(F.expr(cond)).alias(name) for name, cond in checks))
        parts.append(counts.unpivot(["total"], [name for name, _ in checks], "problem", "n").select(F.lit(stage).alias("stage"), "problem", "n", "total"))
    return parts[0].unionByName(parts[1])


@query(f"with {SCO}, {insight_queries._SER} select topic, count(*) as n, count(*) filter (where volume < 0) as negative, count(*) - count(distinct day) as repeated, date_diff('day', min(day), max(day)) + 1 - count(distinct day) as gaps from ser group by topic")
def val_stage5(spark, d):
    """Series without negative volumes, repeated days or gaps."""
    s = I.daily_series(scored(spark, d))
    return s.groupBy("topic").agg(F.count("*").alias("n"), F.count_if(F.col("volume") < 0).alias("negative"), (F.count("*") - F.count_distinct("day")).alias("repeated"), (F.datediff(F.max("day"), F.min("day")) + 1 - F.count_distinct("day")).cast("bigint").alias("gaps"))
