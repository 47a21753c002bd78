"""Timestamps: hand cases, a brute-force comparison with zoneinfo and edge tables."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.operators.instants import article_instants, instant_dictionary, instant_text, normalise_instants, parse_instant

CASES = [
    ("2024-08-04T10:52:39Z", None, None, "2024-08-04T10:52:39+00:00"),
    ("20240707T105534Z", None, None, "2024-07-07T10:55:34+00:00"),
    ("1722561222.808", None, None, "2024-08-02T01:13:42.808000+00:00"),
    ("1726132106710 \t", None, None, "2024-09-12T09:08:26.710000+00:00"),
    ("2024-10-20T15:21:25.847421709Z", None, None, "2024-10-20T15:21:25.847421+00:00"),
    ("8/4/2024 5:25 AM", "America/New_York", "MDY", "2024-08-04T09:25:00+00:00"),
    ("8/4/2024 12:25 AM", "Europe/London", "DMY", "2024-04-07T23:25:00+00:00"),
    ("2024-06-10T14:20:25", "Asia/Seoul", "YMD", "2024-06-10T05:20:25+00:00"),
    ("Wed Mar 05 18:33:46 UTC 2025", "Europe/Moscow", "DMY", "2025-03-05T18:33:46+00:00"),
    ("Thu,\xa026 Sep 2024 06:46:09 +0100", None, None, "2024-09-26T05:46:09+00:00"),
    ("Apr 16, 2025 12:42 PM AEST", "Australia/Sydney", "DMY", "2025-04-16T02:42:00+00:00"),
    ("May 12, 2025 3:44 PM GMT-3", "America/Sao_Paulo", "DMY", "2025-05-12T18:44:00+00:00"),
    ("Nov 3, 2024 1:53 AM EDT", "America/New_York", "MDY", "2024-11-03T05:53:00+00:00"),
    ("2025년 1월 12일 오전 12:05", "Asia/Seoul", "YMD", "2025-01-11T15:05:00+00:00"),
    ("20 de fevereiro de 2025 às 10h56", "America/Sao_Paulo", "DMY", "2025-02-20T13:56:00+00:00"),
    ("18. Mai 2025, 15:57 Uhr", "Europe/Berlin", "DMY", "2025-05-18T13:57:00+00:00"),
    ("7 мая 2025 г., 04:03", "Europe/Moscow", "DMY", "2025-05-07T01:03:00+00:00"),
    ("2025-01-23T08:10:05+09:00[Asia/Seoul]", None, None, "2025-01-22T23:10:05+00:00"),
    ("2025.01.19. 04:25", "Asia/Seoul", "YMD", "2025-01-18T19:25:00+00:00"),
    ("2025-03-30 02:17:02", "Europe/Madrid", "DMY", None),  # skipped
    ("2024-10-27T01:51:39", "Europe/London", "DMY", None),  # twice
    ("2024-08-31", "Europe/London", "DMY", None),
    ("20240615", "Europe/London", "DMY", None),
    ("unknown", "Europe/London", "DMY", None),
    ("31/02/2024 10:00", "Europe/London", "DMY", None),
    ("13/13/2024 10:00", "Europe/London", "DMY", None),
    ("2024-06-10 25:20", "Europe/London", "DMY", None),
    ("3/4/2024 10:00", "Europe/London", None, None),
    ("", "Europe/London", "DMY", None),
    (None, "Europe/London", "DMY", None),
]


@pytest.mark.parametrize("raw,tz,order,want", CASES)
def test_cases(raw, tz, order, want):
    got = parse_instant(raw, tz, order)
    assert (got is None and want is None) or instant_text(got) == want


@settings(max_examples=300, deadline=None)
@given(st.datetimes(datetime(1990, 1, 1), datetime(2035, 1, 1)), st.sampled_from(["Europe/Berlin", "America/New_York", "Asia/Kolkata", "Australia/Sydney", "America/Sao_Paulo"]))
def test_round_trip(at, zone):
    at = at.replace(microsecond=0)
    local = at.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone))
    us = round(at.replace(tzinfo=timezone.utc).timestamp() * 1_000_000)
    assert parse_instant(local.isoformat(), None, None) == us
    assert parse_instant(local.strftime("%a, %d %b %Y %H:%M:%S %z"), None, None) == us
    assert parse_instant(str(us // 1_000_000 * 1000 + 7), None, None) == us + 7000 or us // 1_000_000 < 10**8
    other = local.replace(fold=1 - local.fold)
    twice_or_skipped = other.utcoffset() != local.utcoffset()
    naive = local.replace(tzinfo=None)
    for text in (naive.strftime("%Y-%m-%d %H:%M:%S"), naive.strftime("%d.%m.%Y %H:%M:%S"), naive.strftime("%d %B %Y, %H:%M:%S")):
        assert parse_instant(text, zone, "DMY") == (None if twice_or_skipped else us)


def articles(spark, rows):
    return spark.createDataFrame(rows, "article_id string, source string, published_at string, crawled_at string, tz_name string")


def test_articles_with_odd_rows(spark):
    sources = spark.createDataFrame([("s", "Europe/Paris", "DMY"), ("s", "Europe/Paris", "DMY"), (None, "Asia/Seoul", "YMD")], "source_id string, tz_name string, date_order string")
    rows = [
        ("a", "s", "05.06.2024 10:00", "2024-06-05T10:00:00+00:00", "clash"),
        ("a", "s", "05.06.2024 10:00", "2024-06-05T10:00:00+00:00", "clash"),
        ("b", None, "05.06.2024 10:00", "1717581600", None),
        ("c", "nowhere", None, " 2024-06-05T10:00:00+00:00", ""),
        (None, "s", "", "x" * 50_000, None),
    ]
    got = sorted(map(tuple, article_instants(articles(spark, rows), sources).collect()), key=str)
    assert got == [("a", "published_at", 1717574400000000), ("b", "crawled_at", 1717581600000000), ("c", "crawled_at", 1717581600000000)]
    assert article_instants(articles(spark, []), sources).count() == 0


def test_dictionary_is_incremental(spark, tmp_path):
    path = str(tmp_path / "dictionary")
    first = spark.createDataFrame([("1717581600", "", "")], "raw string, tz string, date_order string")
    second = spark.createDataFrame([("1717581600", "", ""), ("1717581601", "", "")], "raw string, tz string, date_order string")
    assert instant_dictionary(first, path).count() == 1
    assert instant_dictionary(second, path).count() == 2
    assert instant_dictionary(second, path).count() == 2


def test_normalise_keeps_rows_and_names(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "1717581600", "x"), (1, "1717581600", "x"), (2, None, "y")], "k int, raw string, tz string")
    got = normalise_instants(rows, F.col("raw"), F.lit("UTC"), F.lit("DMY"))
    assert got.columns == ["k", "raw", "tz", "epoch_us"] and got.count() == 3 and got.where("epoch_us is null").count() == 1


def test_instant_text():
    assert instant_text(0) == (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(0)).isoformat()
