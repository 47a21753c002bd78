"""Queries of the general data problems and the flagship query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.instants import article_instants
from corpusmill.sources.tables import table


def agg_source_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    """Articles and mean sentiment by source and label; an article's repeated rows count once."""
    articles = table(spark, folder, "articles").select("article_id", "source").distinct()
    analysis = table(spark, folder, "article_analysis").select("article_id", "sentiment_label", "sentiment_score")
    joined = articles.join(analysis, "article_id")
    return joined.groupBy("source", "sentiment_label").agg(F.count("*").alias("n"), F.round(F.avg(F.col("sentiment_score").cast("double")), 6).alias("mean_score"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return article_instants(table(spark, folder, "articles"), table(spark, folder, "sources"))


QUERIES = {"agg_source_sentiment": agg_source_sentiment, "p2_found": p2_found}
SQL = {
    "agg_source_sentiment": """
        select a.source, b.sentiment_label, count(*) as n, round(avg(cast(b.sentiment_score as double)), 6) as mean_score
        from (select distinct article_id, source from articles) a join article_analysis b using (article_id)
        group by a.source, b.sentiment_label
    """,
}
