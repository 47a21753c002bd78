"""Machine-written instants as expressions against the parser of the dictionary."""

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.clock import machine_instant
from corpusmill.operators.instants import parse_instant

FORMS = [
    ("1740929378895", None), ("1722875682", None), ("1737014837.258", None), ("1737014837.1234567", None), ("1724058138881219", None), ("1739752437 \t", None), (" 1726809834", None),
    ("20241005T152556Z", None), ("2024-10-27T00:51:17+00:00", None), ("2024-08-04T10:52:39.794864+00:00", None), ("2025-02-15T10:48:27.054570036Z", None), ("2025-05-04 20:13:34 +0300", None),
    ("2024-10-27T19:31:26+09:00[Asia/Seoul]", None), ("2024-12-18T16:56+09:00", None), ("2025-03-21T03:12-05:00", None), ("2024-09-13T14:49:00-04:00[America/New_York]", None),
    ("Tue, 22 Apr 2025 07:51:20 GMT", None), ("Wed, 8 Jan 2025 12:12:45 +0100", None), ("Sun, 11 Aug 2024 17:50:41 -0400", None), ("Sun, 23 Mar 2025 19:44:04 +0100", None),
    ("2025-04-21T12:55:48", "Europe/Berlin"), ("2024-06-12 14:52:50", "America/New_York"), ("2024-06-12 14:52:50.5", "Asia/Seoul"), ("2024-06-12 14:52", "Asia/Seoul"), ("2024-06-12 14:52:50", None),
    ("2025-03-30 02:30:00", "Europe/Berlin"), ("2024-10-27 02:30:00", "Europe/Berlin"), ("2024-10-27 03:00:00", "Europe/Berlin"), ("2024-10-27 01:59:59", "Europe/Berlin"), ("2025-03-09 02:00:00", "America/New_York"),
    ("2024-10-06 02:15:00", "Australia/Lord_Howe"), ("2024-02-30T10:00:00Z", None), ("unknown", None), ("", None), (None, None), ("2024-05-05", "Asia/Seoul"),
]


def test_machine_forms_equal_the_parser(spark):
    got = spark.createDataFrame([(i, a, z) for i, (a, z) in enumerate(FORMS)], "i int, raw string, zone string").select("i", F.unix_micros(machine_instant(F.col("raw"), F.col("zone"))).alias("us")).collect()
    for r in got:
        raw, zone = FORMS[r.i]
        assert r.us == (parse_instant(raw, zone, None) if raw else None), (raw, zone, r.us)


@pytest.mark.parametrize("raw", ["05.08.2024 18:25", "6/27/2024 5:23 AM", "May 20, 2025 8:06 PM BST"])
def test_other_forms_are_left_alone(spark, raw):
    assert spark.range(1).select(machine_instant(F.lit(raw), F.lit("Europe/Berlin")).alias("x")).first().x is None
