"""Mixed timestamp texts to one UTC instant.

The distinct texts, each with the zone and date order it is to be read in, form a dictionary. Each
entry is parsed once, entries of earlier runs can be kept in a Parquet folder, and the instants are
joined back to the rows. Everything but the parser is DataFrame work; the parser runs on Arrow
batches of distinct values only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from datetime import date, datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.runtime import checked_broadcast, ship

# Month names and usual short forms of the languages read here.
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "en short": "jan feb mar apr may jun jul aug sep oct nov dec",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "de short": "jan feb mär apr mai jun jul aug sep okt nov dez",
    "de Austria": "jänner feber märz april mai juni juli august september oktober november dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "fr short": "janv févr mars avr mai juin juil août sept oct nov déc",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "es short": "ene feb mar abr may jun jul ago sept oct nov dic",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
    "pt short": "jan fev mar abr mai jun jul ago set out nov dez",
    "ru": "января февраля марта апреля мая июня июля августа сентября октября ноября декабря",
    "ru base": "январь февраль март апрель май июнь июль август сентябрь октябрь ноябрь декабрь",
    "ru short": "янв февр мар апр мая июн июл авг сент окт нояб дек",
}
# Zone abbreviations with one usual meaning, hours from UTC; used where the source's own zone has no such name.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "UT": 0, "Z": 0, "WET": 0, "WEST": 1, "CET": 1, "CEST": 2, "EET": 2, "EEST": 3, "MSK": 3,
    "EST": -5, "EDT": -4, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7, "BRT": -3, "COT": -5,
    "JST": 9, "KST": 9, "AEST": 10, "AEDT": 11, "ACST": 9.5, "ACDT": 10.5, "AWST": 8, "NZST": 12, "NZDT": 13,
}
# Markers of the two halves of the day.
MORNING, EVENING = ("am", "a.m.", "a. m.", "오전"), ("pm", "p.m.", "p. m.", "오후")

MONTH_OF = {name: i for names in MONTHS.values() for i, name in enumerate(names.split(), 1)}
CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{6})?\+00:00$"
#: Texts whose instant needs neither the source's zone nor its date order.
SELF_CONTAINED = r"^\s*(\d{9,11}(\.\d+)?|\d{13}|\d{15,20}|\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)? ?(Z|[+-]\d{2}:?\d{2})(\[[^\]]*\])?|\d{8}T\d{6}Z)\s*$"

_EPOCH_DAY = date(1970, 1, 1).toordinal()
_ISO = re.compile(r"(\d{4})([-/.])(\d{1,2})\2 ?(\d{1,2})\.?(?:[T ]|, ?)(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)? ?(.*)", re.S)
_COMPACT = re.compile(r"(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})?(?:[.,](\d+))? ?(Z|[+-]\d{2}:?\d{2})?")
_NUMERIC = re.compile(r"(\d{1,2})([./-]) ?(\d{1,2})\2 ?(\d{4})\.?,? (\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)? ?(.*)", re.S)
_DIGITS = re.compile(r"(-?\d+)(?:\.(\d+))?")
_OFFSET = re.compile(r"(?:UTC|GMT)?([+-])(\d{1,2})(?::?(\d{2}))?")
_TAIL = re.compile(r"(?:(am|pm|a\. ?m\.|p\. ?m\.|오전|오후)\b\.? ?)?(?:uhr ?|hs?\.? ?)?(.*)", re.I | re.S)
_TIME = re.compile(r"(?<!\d)(?:(오전|오후) ?)?(\d{1,2}) ?(?::|h|시 ?)(\d{2})(?!\d)분?(?: ?(?::|m|\bmin)? ?(?<=[:m])(\d{2})(?:[.,](\d+))?)?", re.I)
_KOREAN = re.compile(r"(\d{4})년 ?(\d{1,2})월 ?(\d{1,2})일")
_WORD = re.compile(r"\d+|[^\W\d_]+", re.U)


@lru_cache(maxsize=2048)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except Exception:
        return None


def _micros(y: int, mo: int, d: int, h: int, mi: int, s: int, frac: str | None) -> int | None:
    """Microseconds since 1970-01-01 of the wall time read as UTC; None if there is no such time."""
    try:
        days = date(y, mo, d).toordinal() - _EPOCH_DAY
    except ValueError:
        return None
    if h > 23 or mi > 59 or s > 59:
        return None
    return ((days * 24 + h) * 60 + mi) * 60_000_000 + s * 1_000_000 + (int((frac + "000000")[:6]) if frac else 0)


def _offsets(zone: ZoneInfo, wall: int) -> tuple[datetime, datetime]:
    at = datetime(1970, 1, 1) + timedelta(microseconds=wall)
    return at.replace(tzinfo=zone, fold=0), at.replace(tzinfo=zone, fold=1)


def _in_zone(wall: int, name: str | None) -> int | None:
    """The instant of a wall time; None where the zone is unknown, or skips the time or passes it twice."""
    zone = _zone(name) if name else None
    if zone is None:
        return None
    try:
        first, second = _offsets(zone, wall)
        a, b = first.utcoffset(), second.utcoffset()
    except (OverflowError, ValueError):
        return None
    return wall - round(a.total_seconds()) * 1_000_000 if a == b else None


@lru_cache(maxsize=4096)
def _zone_names(name: str, year: int) -> dict[str, int]:
    zone, found = _zone(name), {}
    if zone is not None and 1 < year < 9999:
        for month in range(1, 13):
            at = datetime(year, month, 15, tzinfo=zone)
            found.setdefault((at.tzname() or "").upper(), round(at.utcoffset().total_seconds()))
    return found


def _by_abbreviation(wall: int, word: str, tz: str | None, year: int) -> int | None:
    word = word.upper()
    if word in ("UTC", "Z", "UT"):
        return wall
    if tz and word in (names := _zone_names(tz, year)):
        return wall - names[word] * 1_000_000
    hours = ABBREVIATIONS.get(word)
    return None if hours is None else wall - round(hours * 3600) * 1_000_000


def _finish(wall: int | None, tail: str, tz: str | None, year: int) -> int | None:
    """Apply what stands behind the time: offset, region in brackets, abbreviation, or nothing."""
    if wall is None:
        return None
    tail = tail.strip()
    region = None
    if tail.endswith("]") and "[" in tail:
        tail, _, region = tail[:-1].rpartition("[")
        tail = tail.strip()
    if tail.startswith("(") and tail.endswith(")"):
        tail = tail[1:-1]
    if not tail:
        return _in_zone(wall, region or tz)
    if tail in ("Z", "z"):
        return wall
    m = _OFFSET.fullmatch(tail) or _OFFSET.fullmatch(tail.split("(")[0].strip())
    if m:
        hours, minutes = int(m[2]), int(m[3] or 0)
        if hours > 18 or minutes > 59:
            return None
        shift = (hours * 60 + minutes) * 60_000_000
        return wall - shift if m[1] == "+" else wall + shift
    if tail.isalpha():
        return _by_abbreviation(wall, tail, tz, year)
    return _in_zone(wall, tail) if "/" in tail and _zone(tail) else None


def _half_day(h: int, mark: str | None) -> int:
    """The hour of 24; 99, which no check passes, if it doesn't go with the mark."""
    if not mark:
        return h
    if not 1 <= h <= 12:
        return 99 if h > 12 or mark.lower() not in MORNING else h
    return h % 12 + (12 if mark.lower() in EVENING else 0)


def parse_instant(raw: str | None, tz: str | None, date_order: str | None) -> int | None:
    """Microseconds since 1970-01-01 UTC that a text fixes, or None.

    None, empty and blank texts, dates without a time of day, and wall times without zone that the
    zone skips or passes twice give None. Units not written are 0, digits beyond microseconds are cut.
    """
    if not raw:
        return None
    text = " ".join(raw.split())
    m = _DIGITS.fullmatch(text)
    if m:
        return _from_digits(m[1], m[2], tz)
    m = _ISO.fullmatch(text)
    if m:
        y, mo, d = int(m[1]), int(m[3]), int(m[4])
        mark, tail = _TAIL.fullmatch(m[9]).groups()
        return _finish(_micros(y, mo, d, _half_day(int(m[5]), mark), int(m[6]), int(m[7] or 0), m[8]), tail, tz, y)
    m = _COMPACT.fullmatch(text)
    if m:
        y = int(m[1])
        return _finish(_micros(y, int(m[2]), int(m[3]), int(m[4]), int(m[5]), int(m[6] or 0), m[7]), m[8] or "", tz, y)
    m = _NUMERIC.fullmatch(text)
    if m:
        a, b, y = int(m[1]), int(m[3]), int(m[4])
        if date_order is None:
            mo, d = (a, b) if b > 12 >= a else (b, a) if a > 12 >= b or a == b else (0, 0)
        else:
            mo, d = (a, b) if date_order == "MDY" else (b, a)
        mark, tail = _TAIL.fullmatch(m[9]).groups()
        return _finish(_micros(y, mo, d, _half_day(int(m[5]), mark), int(m[6]), int(m[7] or 0), m[8]), tail, tz, y)
    return _from_words(text, tz)


def _from_digits(whole: str, frac: str | None, tz: str | None) -> int | None:
    n = len(whole.lstrip("-"))
    if n in (12, 14) and not frac and whole[:2] in ("19", "20"):
        m = _COMPACT.fullmatch(whole)
        wall = _micros(int(m[1]), int(m[2]), int(m[3]), int(m[4]), int(m[5]), int(m[6] or 0), None) if m else None
        if wall is not None:
            return _in_zone(wall, tz)
    if not 9 <= n <= 20:
        return None
    power = 0 if n <= 11 else 3 if n <= 14 else 6 if n <= 17 else 9
    digits = int(whole + ((frac or "") + "0" * 9)[:9])
    scaled = digits // 10 ** (9 + power - 6) if digits >= 0 else -((-digits) // 10 ** (9 + power - 6))
    return scaled if abs(scaled) < 253_402_300_800_000_000 else None


def _from_words(text: str, tz: str | None) -> int | None:
    """Texts with a written month, in any order, or Korean dates."""
    t = _TIME.search(text)
    if t is None:
        return None
    before, after = text[: t.start()], text[t.end() :]
    mark, tail = _TAIL.fullmatch(after.strip()).groups()
    mark = t[1] or mark
    k = _KOREAN.search(before)
    year = month = day = None
    rest: list[str] = []
    if k:
        year, month, day = int(k[1]), int(k[2]), int(k[3])
    else:
        words = [(w, False) for w in _WORD.findall(before)]
        if not any(len(w) == 4 and w.isdigit() for w, _ in words):  # the year follows the time
            y = re.search(r"(?<!\d)(\d{4})$", tail)
            if y is None:
                return None
            year, tail = int(y[1]), tail[: y.start()].strip()
        for w, _ in words:
            if w.isdigit():
                if len(w) == 4 and year is None:
                    year = int(w)
                elif len(w) <= 2 and day is None:
                    day = int(w)
                else:
                    return None
            elif month is None and (found := MONTH_OF.get(w.lower())):
                month = found
            else:
                rest.append(w)
    if year is None or month is None or day is None:
        return None
    wall = _micros(year, month, day, _half_day(int(t[2]), mark), int(t[3]), int(t[4] or 0), t[5])
    return _finish(wall, tail, tz, year)


def _parse_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw, tz, order = (b.column(i).to_pylist() for i in range(3))
        got = [parse_instant(r, z or None, o or None) for r, z, o in zip(raw, tz, order, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(got, pa.int64())], names=["raw", "tz", "date_order", "epoch_us"])


DICTIONARY_SCHEMA = "raw string, tz string, date_order string, epoch_us bigint"


def instant_dictionary(distinct: DataFrame, path: str | None = None) -> DataFrame:
    """Instants of distinct (raw, tz, date_order). With path, entries found there aren't parsed again and new ones are appended."""
    spark = distinct.sparkSession
    ship(spark)
    keys = ["raw", "tz", "date_order"]
    if path is None:
        return distinct.select(*keys).mapInArrow(_parse_batches, DICTIONARY_SCHEMA)
    known = None
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    if fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
        known = spark.read.schema(DICTIONARY_SCHEMA).parquet(path)
        distinct = distinct.join(known, keys, "left_anti")
    distinct.select(*keys).mapInArrow(_parse_batches, DICTIONARY_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(DICTIONARY_SCHEMA).parquet(path)


def normalise_instants(rows: DataFrame, raw: Column, zone: Column, date_order: Column, dictionary_path: str | None = None) -> DataFrame:
    """rows with a column epoch_us (bigint): the instant that raw fixes, null if none.

    Nulls in any argument are allowed: a null zone leaves zone-less texts without instant, a null
    order reads only unambiguous numeric dates. Repeated rows stay repeated; an empty input gives an
    empty result; columns of rows named raw, tz, date_order or epoch_us come out unchanged unless
    named epoch_us, which is replaced.
    """
    plain = raw.rlike(SELF_CONTAINED)
    keyed = rows.drop("epoch_us").select(
        "*",
        raw.alias("_ts_raw"),
        F.when(plain, F.lit("")).otherwise(F.coalesce(zone, F.lit(""))).alias("_ts_tz"),
        F.when(plain, F.lit("")).otherwise(F.coalesce(date_order, F.lit(""))).alias("_ts_order"),
    )
    distinct = keyed.where(F.col("_ts_raw").rlike("[0-9]")).select(F.col("_ts_raw").alias("raw"), F.col("_ts_tz").alias("tz"), F.col("_ts_order").alias("date_order")).distinct()
    found = instant_dictionary(distinct, dictionary_path).where("epoch_us is not null")
    found = found.select(F.col("raw").alias("_ts_raw"), F.col("tz").alias("_ts_tz"), F.col("date_order").alias("_ts_order"), "epoch_us")
    return keyed.join(found, ["_ts_raw", "_ts_tz", "_ts_order"], "left").drop("_ts_raw", "_ts_tz", "_ts_order")


def article_instants(articles: DataFrame, sources: DataFrame, dictionary_path: str | None = None) -> DataFrame:
    """(article_id, field_name, epoch_us) of every published_at and crawled_at that fixes an instant but isn't written canonically.

    Articles whose source is null or unknown keep only texts that carry their own zone. Repeated rows count once.
    """
    spark: SparkSession = articles.sparkSession
    dim = sources.select(F.col("source_id").alias("_sid"), "tz_name", "date_order").dropDuplicates(["_sid"])
    values = articles.select(
        "article_id",
        F.col("source").alias("_src"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("raw_text")) for c in ("published_at", "crawled_at")])).alias("v"),
    ).select("article_id", "_src", "v.*")
    values = values.where(F.col("raw_text").isNotNull() & ~F.col("raw_text").rlike(CANONICAL) & F.col("raw_text").rlike("[0-9]"))
    values = values.join(checked_broadcast(dim), F.col("_src") == F.col("_sid"), "left").drop("_src", "_sid")
    out = normalise_instants(values, F.col("raw_text"), F.col("tz_name"), F.col("date_order"), dictionary_path)
    return out.where("epoch_us is not null").select("article_id", "field_name", "epoch_us").distinct()


def utc_text(epoch_us: Column) -> Column:
    """The one unambiguous form: YYYY-MM-DDTHH:MM:SS.ffffff+00:00."""
    at = F.timestamp_micros(epoch_us)
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def instant_text(epoch_us: int) -> str:
    return (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=epoch_us)).isoformat()
