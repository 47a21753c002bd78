"""Instants of machine-written timestamps as column expressions: no Python, no shuffle.

For the forms that programs write (epochs, ISO 8601 with and without zone, compact, RFC 2822). What
people write (month names, numeric dates in local order, zone abbreviations) is read by
operators/instants.py, whose results these expressions equal on the forms they cover.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = r"^\d{10}(\.\d+)?$"
COMPACT = r"^\d{8}T\d{6}Z$"
ZONED = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2})(:\d{2})?(?:\.(\d+))? ?(Z|[+-]\d{2}:?\d{2})(\[[^\]]*\])?$"
WALL = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2})(:\d{2})?(?:\.(\d+))?$"
MAIL = r"^[A-Z][a-z]{2}, (\d{1,2}) ([A-Z][a-z]{2}) (\d{4}) (\d{2}:\d{2}:\d{2}) (GMT|UTC|[+-]\d{4})$"


def _part(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group)


def _offset(text: Column) -> Column:
    """±hh:mm of Z, GMT, ±hhmm or ±hh:mm."""
    plain = F.replace(text, F.lit(":"), F.lit(""))
    return F.when(text.rlike("^[+-]"), F.concat(F.substring(plain, 1, 3), F.lit(":"), F.substring(plain, 4, 2))).otherwise(F.lit("+00:00"))


def _iso(text: Column, pattern: str) -> Column:
    """YYYY-MM-DD HH:MM:SS.ffffff of a match; digits beyond microseconds are cut off."""
    seconds = F.coalesce(F.nullif(_part(text, pattern, 3), F.lit("")), F.lit(":00"))
    return F.concat(_part(text, pattern, 1), F.lit(" "), _part(text, pattern, 2), seconds, F.lit("."), F.rpad(F.substring(_part(text, pattern, 4), 1, 6), 6, "0"))


def wall_instant(wall: Column, zone: Column) -> Column:
    """The instant of a wall time (a timestamp read as UTC) in a zone; null where the zone skips it or passes it twice."""
    at = F.to_utc_timestamp(wall, zone)
    again = [F.from_utc_timestamp(at + F.expr(f"interval {m} minutes"), zone) == wall for m in (-60, -30, 30, 60)]
    return F.when((F.from_utc_timestamp(at, zone) == wall) & ~(again[0] | again[1] | again[2] | again[3]), at)


def machine_instant(raw: Column, zone: Column | None = None) -> Column:
    """The instant (timestamp) of raw; null where it fixes none, isn't in these forms, or needs a zone that is null. The session's zone must be UTC.

    The trimmed text is bound as the variable of a one-element transform: written out in every branch
    it would outgrow what can be compiled.
    """
    trimmed = F.regexp_replace(F.replace(raw, F.lit("\u00a0"), F.lit(" ")), r"^\s+|\s+$", "")
    return F.get(F.transform(F.array(trimmed), lambda t: _instant(t, zone)), F.lit(0))


def _instant(t: Column, zone: Column | None) -> Column:
    fraction = F.rpad(F.substring(F.regexp_extract(t, r"\.(\d+)$", 1), 1, 6), 6, "0")
    s = lambda a, n: F.substring(t, a, n)
    compact = F.concat(s(1, 4), F.lit("-"), s(5, 2), F.lit("-"), s(7, 2), F.lit(" "), s(10, 2), F.lit(":"), s(12, 2), F.lit(":"), s(14, 2), F.lit("+00:00"))
    month = F.lpad(((F.instr(F.lit("JanFebMarAprMayJunJulAugSepOctNovDec"), _part(t, MAIL, 2)) + 2) / 3).cast("int").cast("string"), 2, "0")
    mail = F.concat(_part(t, MAIL, 3), F.lit("-"), month, F.lit("-"), F.lpad(_part(t, MAIL, 1), 2, "0"), F.lit(" "), _part(t, MAIL, 4), _offset(_part(t, MAIL, 5)))
    found = (
        F.when(t.rlike(ZONED), F.concat(_iso(t, ZONED), _offset(_part(t, ZONED, 5))).try_cast("timestamp"))
        .when(t.rlike(EPOCH), F.timestamp_micros(s(1, 10).try_cast("bigint") * 1_000_000 + fraction.try_cast("bigint")))
        .when(t.rlike(r"^\d{13}$"), F.timestamp_micros(t.try_cast("bigint") * 1000))
        .when(t.rlike(r"^\d{16}$"), F.timestamp_micros(t.try_cast("bigint")))
        .when(t.rlike(COMPACT), compact.try_cast("timestamp"))
        .when(t.rlike(MAIL), mail.try_cast("timestamp"))
    )
    return found if zone is None else found.when(t.rlike(WALL) & zone.isNotNull(), wall_instant(_iso(t, WALL).try_cast("timestamp"), zone))
