"""Main body of web pages whose text mixes it with menus, notices, teasers and footers.

The method is composite text density. The markup is gone, so the tree is read from the lines: the
body, its sections (runs of lines between link text) and their lines. A node has characters, tags
(one for each line and each separator within it), link characters and link tags. What links mark in
a page is found without any list of words: text is link text where its pattern (letter case and
digits folded) comes back on many different pages of the same source, and where it is anchor text,
i.e. a headline without end or a row of short items. The composite density of a node is its
characters per tag, adjusted by the ratio of text to link text in it and in the body. The section
whose lines' densities sum highest is the start of the main body; the least density on the path from
it to the body is the threshold that sections must reach to belong to it. Unended lines at the end of
a section that are neither items of a list nor as dense as the main section leave it.

Bylines and subheadings come back in a source as furniture does, but hold another place: patterns of
short texts that stand nearly always directly before the main body, directly after it or inside it
are own text. These places are counted over all pages with the sections of a first reading; the
second reading is final. All counts are by source and over all pages; they count different contexts
(the longest line of the page), so copies of an article don't make its lines furniture.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.encoding import Dictionaries, repair, train_dictionaries
from corpusmill.llm.residue import LineSigns, has_slot, is_quiet, pack_signs, residue_of_signs
from corpusmill.runtime import checked_broadcast, settle, ship

#: Different pages of a source on which a pattern stands before it counts as coming back, and their share of its pages.
MIN_PAGES = 3
MIN_SHARE = 0.003
#: Letters from which an unended line is anchor text; subheadings are shorter. One Hangul syllable counts as three.
ANCHOR_LETTERS = 36
#: Shares of a pattern's places that make it own text: before, after or inside the body; and the share it may have elsewhere.
BEFORE, AFTER, INSIDE, ELSEWHERE = 0.65, 0.8, 0.65, 0.02

LOST = "�"
_chars = itemgetter(1)
_SEPARATORS = (" | ", " · ", " > ", " • ", " / ", " – ", " — ")
_ENDS = frozenset(".!?…。！？:;")
_CLOSERS = "\"”“»’'„)]� "
_QUOTED = frozenset("\"“„«‘([")
_TIMED = re.compile(r"\d{1,2}:\d\d \S|» ")
_LIST_ITEM = re.compile(r"[•–—*-] \S|\d+[.)] \S+ \(\d|.* \d+ ?: ?\d+ ")
_LABELLED = re.compile(r"[^:.!?]{2,30}?: ")
_HANGUL = re.compile(r"[가-힣]")
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[^\W\d_]+|0")


def is_ended(line: str) -> bool:
    """Whether a line ends as sentences do, or is quoted as a whole."""
    return line.rstrip(_CLOSERS)[-1:] in _ENDS or (line[0] in _QUOTED and line[-1] in _CLOSERS)


def pattern(low: str, ended: bool, tags: int) -> str:
    """What a line in lower case has in common with those that differ in digits, the order of short items or what follows a label."""
    if not low.isalpha():
        low = _DIGITS.sub("0", low)
    if ended or len(low) >= 160:
        return low
    if m := _LABELLED.match(low):
        return m[0]
    return " ".join(sorted(_WORDS.findall(low))) if tags >= 3 and len(low) < 120 else low


class Line(NamedTuple):
    """key: hash of the pattern; kinds: ANCHOR, ITEM, ENDED, NAMED, FIXED; packed and only: what problem 5 sees in it (LineSigns)."""

    key: int
    chars: int
    tags: int
    kinds: int
    packed: int
    only: int


ENDED, ANCHOR, ITEM, FIXED, NAMED = 1, 2, 4, 8, 16
_MARKS = re.compile("[|·>•/–—]")
_HAS_DIGIT = re.compile("[0-9]")


@lru_cache(maxsize=60_000)
def read_line(x: str, quiet: bool = False) -> Line:
    """Of a line with white space collapsed, not empty. FIXED: residue, never furniture; NAMED: may be a byline or subheading."""
    low = x.casefold()
    packed, only = pack_signs(x, low, quiet)
    ascii_ = x.isascii()
    weight = len(x) if ascii_ else len(x) + 2 * len(_HANGUL.findall(x))
    ended = is_ended(x)
    tags, split = 1, 0
    if _MARKS.search(x):
        found = [x.count(s) for s in _SEPARATORS]
        tags, split = 1 + sum(found), sum(found[:5])
    kinds = ENDED if ended else 0
    if packed & 1:
        kinds |= FIXED
    if not ended:
        item = _LIST_ITEM.match(x) is not None
        spaces = x.count(" ")
        if not packed & 1 and (split >= 2 or (weight >= ANCHOR_LETTERS and not item and spaces >= 3) or _TIMED.match(x) is not None):
            kinds |= ANCHOR
        elif spaces and not (_HAS_DIGIT.search(x) if ascii_ else _DIGITS.search(x)):
            kinds |= NAMED
        if item:
            kinds |= ITEM
    return Line(xxhash.xxh3_64_intdigest(pattern(low, ended, tags)) - (1 << 63), weight, tags, kinds, packed, only)


def read_lines(lines: list[str], at: list[int]) -> list[Line]:
    quiet = is_quiet("\n".join(lines))
    return [read_line(lines[i], quiet) for i in at]


def density(chars: float, tags: int, link_chars: float, link_tags: int, body_chars: float, body_links: float) -> float:
    """Characters per tag, times the logarithm of text and tags against link text to a base that grows with the node's link text."""
    if not chars:
        return 0.0
    base = math.log(chars / max(1, chars - link_chars) * link_chars + body_links / max(1, body_chars) * chars + math.e)
    ratio = chars / max(1, link_chars) * tags / max(1, link_tags)
    return chars / tags * math.log(max(ratio, 1.0)) / math.log(max(base, 1.0001))


def main_sections(chars: list[int], tags: list[int], kinds: list[int], link: list[bool], named: list[bool]) -> list[tuple[int, int]]:
    """(first, last) line of each section of the main body; none where everything is link text."""
    runs: list[tuple[int, int]] = []
    start = None
    for k, is_link in enumerate(link):
        if is_link:
            if start is not None:
                runs.append((start, k - 1))
                start = None
        elif start is None:
            start = k
    if start is not None:
        runs.append((start, len(link) - 1))
    if not runs:
        return []
    body, links = sum(chars), sum(c for c, x in zip(chars, link, strict=True) if x)
    root = density(body, sum(tags), links, sum(t for t, x in zip(tags, link, strict=True) if x), body, links)
    own = [density(c, t, 0, 0, body, links) for c, t in zip(chars, tags, strict=True)]
    dense = [density(sum(chars[a : b + 1]), sum(tags[a : b + 1]), 0, 0, body, links) for a, b in runs]
    top = max(range(len(runs)), key=lambda i: sum(own[runs[i][0] : runs[i][1] + 1]))
    threshold = min(dense[top], root)
    out = []
    for (a, b), d in zip(runs, dense, strict=True):
        if d >= threshold - 1e-9:
            while b >= a and not kinds[b] & (ENDED | ITEM | FIXED) and not named[b] and own[b] < dense[top]:
                b -= 1
            if b >= a:
                out.append((a, b))
    return out


@dataclass
class Page:
    """own: indexes of the lines of the main body; furniture: of the other non-empty lines."""

    lines: list[str]
    own: list[int]
    furniture: list[int]
    residue: bool

    def text(self, sep: str = "\n") -> str:
        return sep.join(self.lines[i] for i in self.own)


def read_page(body: str, back: frozenset[int] = frozenset(), named: frozenset[int] = frozenset()) -> Page:
    """The main body of one page, given the keys of the patterns that come back in its source and of those that are own text.

    residue: filler, an error message, a demand for scripts or slots stand in the place of a text.
    """
    lines = [" ".join(x.split()) for x in body.split("\n")]
    at = [i for i, x in enumerate(lines) if x]
    facts = read_lines(lines, at)
    kept = _kept(facts, back, named)
    own = [i for i, k in zip(at, kept, strict=True) if k]
    return Page(lines, own, [i for i, k in zip(at, kept, strict=True) if not k], residue_of_signs([(f.key, LineSigns(f.packed, f.only)) for f, k in zip(facts, kept, strict=True) if k]))


def _kept(facts: list[Line], back: frozenset[int], named: frozenset[int]) -> list[bool]:
    places = main_sections([f.chars for f in facts], [f.tags for f in facts], [f.kinds for f in facts], *_links([f.key for f in facts], [f.kinds for f in facts], back, named))
    kept = [False] * len(facts)
    for a, b in places:
        kept[a : b + 1] = [True] * (b - a + 1)
    return kept


def _links(keys: list[int], kinds: list[int], back: frozenset[int], named: frozenset[int]) -> tuple[list[bool], list[bool]]:
    """Which lines are link text, and which are bylines or subheadings that come back."""
    name = [bool(k & NAMED) and x in named for x, k in zip(keys, kinds, strict=True)]
    return [bool(k & ANCHOR) or (x in back and not n and not k & (ITEM | FIXED)) for x, k, n in zip(keys, kinds, name, strict=True)], name


# ---- over all pages ----


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most so many rows, as texts of any length are taken out of them."""
    for b in batches:
        for at in range(0, max(b.num_rows, 1), rows):
            yield b.slice(at, rows)


def unpack(text: bytes | None) -> list[str]:
    """The lines of a page's text as read_pages gives it."""
    return zstandard.decompress(text).decode().split("\n") if text else []


def _facts(docs: DataFrame, samples: DataFrame, body_col: str, source_col: str | None, carry: tuple[str, ...], title_col: str | None, with_text: bool, dictionaries: Dictionaries | None) -> DataFrame:
    """One settled row of each row of docs with the facts of its lines; texts are read and restored once, here."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(dictionaries or train_dictionaries(samples))
    n = len(carry)
    columns = [F.coalesce(F.col(source_col).cast("string"), F.lit("")) if source_col else F.lit(""), F.col(title_col).cast("string") if title_col else F.lit(None).cast("string")]
    rows = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)), columns[0].alias("src"), columns[1].alias("title"), F.col(body_col).alias("body"), F.monotonically_increasing_id().alias("rid"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = shared.value
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in slices(batches):
            slots, context, numbers, facts, text = [], [], [], [], []
            size = [0]
            for title, body in zip(b.column(n + 1).to_pylist(), b.column(n + 2).to_pylist(), strict=True):
                slots.append(title_col is not None and (has_slot(title) or has_slot(body)))
                lines = [" ".join(x.split()) for x in repair(body, d)[0].split("\n")] if body else []
                at = [i for i, x in enumerate(lines) if x]
                found = read_lines(lines, at)
                context.append(max(found, key=_chars).key if found else 0)
                numbers += at
                facts += found
                if with_text:
                    text.append(pack("\n".join(lines[i] for i in at).encode()) if at else b"")
                size.append(len(facts))
            ends = pa.array(size, pa.int32())
            cols = list(zip(*facts, strict=True)) or [[]] * 6
            lists = [pa.ListArray.from_arrays(ends, pa.array(c, k)) for c, k in zip((numbers, *cols), (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()), strict=True)]
            lists.append(pa.array(text, pa.binary()) if with_text else pa.nulls(len(slots), pa.binary()))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n + 1)), b.column(n + 3), pa.array(slots, pa.bool_()), pa.array(context, pa.int64()), *lists], names=names)

    fields = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carry)]
    rest = T._parse_datatype_string("src string, rid bigint, slot boolean, context bigint, at array<int>, key array<bigint>, chars array<int>, tags array<int>, kinds array<int>, packed array<bigint>, only array<int>, text binary")
    schema = T.StructType([*fields, *rest.fields])
    names = schema.names
    return settle(rows.mapInArrow(run, schema))


def _open_keys() -> Column:
    """The keys of a page that count as patterns, each once."""
    lines = F.filter(F.arrays_zip("key", "kinds"), lambda x: x["kinds"].bitwiseAND(F.lit(ANCHOR | ITEM | FIXED)) == 0)
    return F.array_distinct(F.transform(lines, lambda x: x["key"]))


def patterns_that_come_back(pages: DataFrame) -> DataFrame:
    """(src, key) of the patterns on at least MIN_PAGES different pages and MIN_SHARE of the different pages of the source."""
    total = pages.where("size(at) > 0").select("src", "context").distinct().groupBy("src").agg(F.count("*").alias("total"))
    found = pages.select("src", "context", F.explode(_open_keys()).alias("key")).distinct().groupBy("src", "key").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES)
    return settle(found.join(checked_broadcast(total), "src").where(F.col("n") >= MIN_SHARE * F.col("total")).select("src", "key"))


def _keys_among(pages: DataFrame, keys: DataFrame, column: str, exploded: Column) -> DataFrame:
    """(rid, src, column): of each page the keys (of the array exploded) that are in keys; pages without any are left out."""
    return pages.select("rid", "src", F.explode(exploded).alias("key")).join(checked_broadcast(keys), ["src", "key"]).groupBy("rid", "src").agg(F.collect_list("key").alias(column))


def named_patterns(pages: DataFrame) -> DataFrame:
    """(src, key) of the patterns of bylines and subheadings: NAMED ones that hold the place of own text on nearly all pages.

    pages: with the arrays key, chars, tags, kinds, back. Pages with a single line before (or after)
    the body say nothing about the place of that line.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 5_000):
            counts: Counter[tuple[str, int, int]] = Counter()
            for src, key, chars, tags, kinds, back in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                back = frozenset(back or ())
                sections = main_sections(chars, tags, kinds, *_links(key, kinds, back, frozenset()))
                if not sections or not back:
                    continue
                first, last, end = sections[0][0], sections[-1][1], len(key) - 1
                for k, (x, kind) in enumerate(zip(key, kinds, strict=True)):
                    if kind & NAMED and x in back:
                        if first <= k <= last:
                            counts[src, x, 0] += 1
                        elif k < first and first > 1:
                            counts[src, x, 1 if k == first - 1 else 3] += 1
                        elif k > last and last < end - 1:
                            counts[src, x, 2 if k == last + 1 else 3] += 1
            rows = list(zip(*((*k, n) for k, n in counts.items()), strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.string(), pa.int64(), pa.int32(), pa.int64()), strict=True)], names=["src", "key", "place", "n"])

    counted = pages.select("src", "key", "chars", "tags", "kinds", "back").mapInArrow(run, "src string, key bigint, place int, n bigint")
    by_place = [F.sum(F.when(F.col("place") == p, F.col("n")).otherwise(0)).alias(name) for p, name in enumerate(("inside", "before", "after", "away"))]
    n = counted.groupBy("src", "key").agg(*by_place).withColumn("n", F.col("inside") + F.col("before") + F.col("after") + F.col("away")).where("n >= 2")
    own = (
        ((F.col("before") >= BEFORE * F.col("n")) & (F.col("inside") + F.col("after") <= ELSEWHERE * F.col("n")))
        | ((F.col("after") >= AFTER * F.col("n")) & (F.col("inside") + F.col("before") <= ELSEWHERE * F.col("n")))
        | ((F.col("inside") >= INSIDE * F.col("n")) & (F.col("away") <= ELSEWHERE * F.col("n")))
    )
    return n.where(own).select("src", "key")


def foreign_sources(pages: DataFrame) -> DataFrame:
    """(src, foreign) of the sources most of whose pages have no word of the known languages: there, that is no sign of filler."""
    known = F.exists("packed", lambda x: x.bitwiseAND(F.lit(2)) > 0)
    return settle(pages.where("size(at) > 0").groupBy("src").agg(F.avg(known.cast("double")).alias("share")).where("share < 0.5").select("src", F.lit(True).alias("foreign")))


def read_pages(docs: DataFrame, samples: DataFrame, body_col: str = "body", source_col: str | None = "source", carry: tuple[str, ...] = (), title_col: str | None = None, with_text: bool = False, dictionaries: Dictionaries | None = None) -> DataFrame:
    """(c0, c1... carried columns, slot, at, kept, residue[, text]) of each row of docs.

    at: indexes of the non-empty lines (from 0), kept: whether each is own text, text: the lines,
    restored and compressed (unpack); all empty for null and empty bodies. residue: filler, an error message, a demand for
    scripts or slots stand in place of a text. slot: title or body have an open slot (with title_col).
    """
    facts = _facts(docs, samples, body_col, source_col, carry, title_col, with_text, dictionaries)
    back = settle(_keys_among(facts, patterns_that_come_back(facts), "back", _open_keys()))
    named = settle(named_patterns(facts.select("rid", "src", "key", "chars", "tags", "kinds").join(back.select("rid", "back"), "rid")))
    names = _keys_among(back, named, "named", F.col("back")).select("rid", "named")
    pages = facts.join(back.select("rid", "back").join(names, "rid", "left"), "rid", "left").join(checked_broadcast(foreign_sources(facts)), "src", "left")
    cols = [c for c in facts.columns if c.startswith("c") and c[1:].isdigit()]
    given = [*cols, "slot", "at", *(["text"] if with_text else [])]
    n = len(given)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            kept, residue = [], []
            for key, chars, tags, kinds, packed, only, back, named, foreign in zip(*(b.column(n + i).to_pylist() for i in range(9)), strict=True):
                mask = [False] * len(key)
                for a, z in main_sections(chars, tags, kinds, *_links(key, kinds, frozenset(back or ()), frozenset(named or ()))):
                    mask[a : z + 1] = [True] * (z - a + 1)
                kept.append(mask)
                residue.append(residue_of_signs([(x, LineSigns(p, o)) for x, p, o, m in zip(key, packed, only, mask, strict=True) if m], bool(foreign)))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.array(kept, pa.list_(pa.bool_())), pa.array(residue, pa.bool_())], names=[*given, "kept", "residue"])

    schema = T.StructType([*(facts.schema[c] for c in given), T.StructField("kept", T.ArrayType(T.BooleanType())), T.StructField("residue", T.BooleanType())])
    return pages.select(*given, "key", "chars", "tags", "kinds", "packed", "only", "back", "named", "foreign").mapInArrow(run, schema)


def body_lines(docs: DataFrame, samples: DataFrame, id_col: str = "article_id", body_col: str = "body", source_col: str | None = "source", dictionaries: Dictionaries | None = None) -> DataFrame:
    """Distinct (id, line_no int) of the non-empty lines outside the main body.

    Garbled lines are judged by their restored text. Null and empty bodies give no rows, as do pages
    on which filler, an error message or a demand for scripts stands in place of a text, and pages
    without any section that isn't link text. Line numbers start at 1 and count empty lines. Repeated
    rows count once; null sources are one source; other columns aren't read.
    """
    pages = read_pages(docs.where(F.col(body_col) != ""), samples, body_col, source_col, (id_col,), dictionaries=dictionaries)
    own = F.exists("kept", lambda x: x)
    lines = pages.where(~F.col("residue") & own).select(F.col("c0").alias(id_col), F.explode(F.filter(F.arrays_zip("at", "kept"), lambda x: ~x["kept"])).alias("x"))
    return lines.select(id_col, (F.col("x.at") + 1).cast("int").alias("line_no")).distinct()


def main_bodies(docs: DataFrame, samples: DataFrame, body_col: str = "body", source_col: str | None = "source") -> DataFrame:
    """docs with main_body: the lines of the page's own text, restored, joined by newlines.

    Null where body is null or residue stands in its place, '' where nothing is the page's own.
    Repeated rows stay and other columns but main_body are untouched.
    """
    docs = docs.drop("main_body")
    names = docs.columns
    pages = read_pages(docs, samples, body_col, source_col, tuple(names), with_text=True)
    at, n = names.index(body_col), len(names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            null = b.column(at).is_null().to_pylist()
            own = [None if x or r else "\n".join(t for t, k in zip(unpack(z), kept, strict=True) if k) for x, z, kept, r in zip(null, *(b.column(n + i).to_pylist() for i in range(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.array(own, pa.string())], names=[*names, "main_body"])

    schema = T.StructType([*docs.schema.fields, T.StructField("main_body", T.StringType())])
    return pages.select(*(f"c{i}" for i in range(n)), "text", "kept", "residue").mapInArrow(run, schema)
