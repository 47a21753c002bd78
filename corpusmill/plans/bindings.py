"""The test tables in the roles that the analytic operators expect, in Spark and, as CTEs, in SQL.

articles: one row for each article (repeated rows are exact, so the columns a query doesn't use are
pruned before the shuffle); topic is the category in lower case ('' and null are
noise, '-1'), lang the main part of the label, ts the instant of the crawl in whole seconds, in
whatever form and zone it is written, null where the text fixes none, day its date in UTC. analysis: one row for each article, the one with the highest
importance. entities: capitalised words of the title, and of events the users.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions.clock import machine_instant
from corpusmill.runtime import BROADCAST_ROWS
from corpusmill.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
LANG = r"^(en|de|fr|es|pt|ko|ru)(?:$|[-_])"
EMOTIONS = ("joy", "trust", "fear", "surprise", "sadness", "disgust", "anger", "anticipation")
STEEPS = ("S", "T", "E", "P", "V")

_EDGES = r"^[\s\x{a0}]+|[\s\x{a0}]+$"
#: The instant of crawled_at, which programs write: epochs, compact, ISO with a zone, mail dates, and wall times of the source's zone.
ART = rf"""
    stamped as (
        select distinct a.*, z.tz_name, regexp_replace(replace(crawled_at, chr(160), ' '), '{_EDGES}', '', 'g') as c
        from articles a left join (select source_id, min(tz_name) as tz_name from sources group by source_id) z on a.source = z.source_id),
    clocked as (
        select *,
               case when regexp_full_match(c, '\d{{10}}(\.\d+)?') then make_timestamp(cast(substr(c, 1, 10) as bigint) * 1000000)
                    when regexp_full_match(c, '\d{{13}}') then make_timestamp(cast(c as bigint) * 1000)
                    when regexp_full_match(c, '\d{{16}}') then make_timestamp(cast(c as bigint))
                    when regexp_full_match(c, '\d{{8}}T\d{{6}}Z') then try_strptime(c, '%Y%m%dT%H%M%SZ')
                    when regexp_full_match(c, '\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}(:\d{{2}})?(\.\d+)? ?(Z|[+-]\d{{2}}:?\d{{2}})(\[[^\]]*\])?')
                        then try_strptime(substr(c, 1, 10) || ' ' || substr(c, 12, 5) || coalesce(nullif(regexp_extract(c, '^.{{16}}(:\d{{2}})', 1), ''), ':00'), '%Y-%m-%d %H:%M:%S')
                             - to_minutes(coalesce(try_cast(regexp_extract(c, ' ?([+-])(\d{{2}}):?(\d{{2}})(\[[^\]]*\])?$', 1) || '1' as bigint), 0)
                                          * (coalesce(try_cast(regexp_extract(c, ' ?([+-])(\d{{2}}):?(\d{{2}})(\[[^\]]*\])?$', 2) as bigint), 0) * 60 + coalesce(try_cast(regexp_extract(c, ' ?([+-])(\d{{2}}):?(\d{{2}})(\[[^\]]*\])?$', 3) as bigint), 0)))
                    when regexp_full_match(c, '[A-Z][a-z]{{2}}, \d{{1,2}} [A-Z][a-z]{{2}} \d{{4}} \d{{2}}:\d{{2}}:\d{{2}} (GMT|UTC|[+-]\d{{4}})')
                        then try_strptime(regexp_extract(c, ', (.*) \S+$', 1), '%d %b %Y %H:%M:%S')
                             - to_minutes(coalesce(try_cast(regexp_extract(c, '([+-])(\d{{2}})(\d{{2}})$', 1) || '1' as bigint), 0)
                                          * (coalesce(try_cast(regexp_extract(c, '([+-])(\d{{2}})(\d{{2}})$', 2) as bigint), 0) * 60 + coalesce(try_cast(regexp_extract(c, '([+-])(\d{{2}})(\d{{2}})$', 3) as bigint), 0)))
               end as fixed,
               case when tz_name is not null and regexp_full_match(c, '\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?')
                    then try_strptime(substr(c, 1, 10) || ' ' || substr(c, 12, 5) || coalesce(nullif(regexp_extract(c, '^.{{16}}(:\d{{2}})', 1), ''), ':00'), '%Y-%m-%d %H:%M:%S') end as wall
        from stamped),
    walled as (
        select *, case when wall is not null then (wall at time zone tz_name) at time zone 'UTC' end as w from clocked),
    art as (
        select article_id, url, title, body, source,
               coalesce(nullif(lower(trim(category)), ''), '-1') as topic, language,
               coalesce(nullif(regexp_extract(lower(language), '{LANG}', 1), ''), 'und') as lang,
               word_count, author, content_hash, ts, cast(ts as date) as day
        from (select *, date_trunc('second', coalesce(fixed,
                  case when (w at time zone 'UTC') at time zone tz_name = wall
                        and ((w - interval 60 minute) at time zone 'UTC') at time zone tz_name <> wall and ((w + interval 60 minute) at time zone 'UTC') at time zone tz_name <> wall
                        and ((w - interval 30 minute) at time zone 'UTC') at time zone tz_name <> wall and ((w + interval 30 minute) at time zone 'UTC') at time zone tz_name <> wall then w end)) as ts
              from walled))"""
ANA = """
    ana as (
        select article_id, sentiment_label, cast(sentiment_score as double) as score, steeps_category as steeps, cast(importance_score as double) as importance,
               """ + ", ".join(f"cast(emotion_{e} as double) as {e}" for e in EMOTIONS) + """
        from (select *, row_number() over (partition by article_id order by importance_score desc nulls last, sentiment_score desc nulls last, emotion_joy desc nulls last, emotion_trust desc nulls last) as rn from article_analysis)
        where rn = 1)"""  # fmt: skip
ENT = """
    ent as (
        select article_id, lang, source, topic, day, ts, unnest(list_distinct(regexp_extract_all(title, '[A-Z][a-z]{3,}'))) as entity from art where title is not null)"""


def registry() -> tuple[dict[str, Query], dict[str, str], Callable]:
    """(QUERIES, SQL, decorator) of a module: @query(sql) registers a function under its name."""
    queries: dict[str, Query] = {}
    sqls: dict[str, str] = {}

    def query(sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            queries[f.__name__] = f
            if sql is not None:
                sqls[f.__name__] = sql
            return f

        return add

    return queries, sqls, query


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each article. The zones of the sources, a small fixed dimension, are joined for the wall times only where ts or day are used."""
    zones = table(spark, folder, "sources").groupBy("source_id").agg(F.min("tz_name").alias("tz_name"))
    raw = table(spark, folder, "articles").join(_small(zones, folder), F.col("source") == F.col("source_id"), "left")
    ts = F.date_trunc("second", machine_instant(F.col("crawled_at"), F.col("tz_name")))
    return raw.select(
        "article_id", "url", "title", "body", "source",
        F.coalesce(F.nullif(F.lower(F.trim("category")), F.lit("")), F.lit("-1")).alias("topic"), "language",
        F.coalesce(F.nullif(F.regexp_extract(F.lower("language"), LANG, 1), F.lit("")), F.lit("und")).alias("lang"),
        "word_count", "author", "content_hash", ts.alias("ts"),
    ).dropDuplicates(["article_id"]).withColumn("day", F.to_date("ts"))


_measured: dict[tuple[str, str], bool] = {}


def _small(df: DataFrame, folder: str) -> DataFrame:
    """checked_broadcast, measured once for each application and folder."""
    key = df.sparkSession.sparkContext.applicationId, folder
    if key not in _measured:
        _measured[key] = df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(df) if _measured[key] else df


def analysis(spark: SparkSession, folder: str) -> DataFrame:
    w = Window.partitionBy("article_id").orderBy(*(F.col(c).desc_nulls_last() for c in ("importance_score", "sentiment_score", "emotion_joy", "emotion_trust")))
    rows = table(spark, folder, "article_analysis").withColumn("rn", F.row_number().over(w)).where("rn = 1")
    return rows.select("article_id", "sentiment_label", F.col("sentiment_score").cast("double").alias("score"), F.col("steeps_category").alias("steeps"), F.col("importance_score").cast("double").alias("importance"), *(F.col(f"emotion_{e}").cast("double").alias(e) for e in EMOTIONS))


def entities(spark: SparkSession, folder: str) -> DataFrame:
    found = F.array_distinct(F.regexp_extract_all("title", F.lit("[A-Z][a-z]{3,}"), F.lit(0)))
    return articles(spark, folder).select("article_id", "lang", "source", "topic", "day", "ts", F.explode(found).alias("entity"))


def r6(c, name: str):
    """Rounded to six digits, under a name."""
    return F.round(c, 6).alias(name)
