"""All queries outside the llm subpackage, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.plans import detail_queries, extra_queries, general, insight_queries, markup_queries, measure_queries, relational_queries, scalar_queries, series_queries, serving_queries, survey_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
for module in (general, scalar_queries, insight_queries, relational_queries, serving_queries, series_queries, markup_queries, detail_queries, extra_queries, survey_queries, measure_queries):
    QUERIES.update(module.QUERIES)
    SQL.update(module.SQL)
