"""Text garbled by a wrong character encoding.

For every suspicious value all candidate decodings (chains of "was read as X, really was Y") are
formed and compressed with a zstandard dictionary of each language, made from reference texts. The
chain with the least description length, its own cost included, is taken; if none beats the text as
it is, the text stays. Replacement characters mark text that is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import ship

#: Bytes that a step of a chain costs: little where the bytes had to be valid in a multi-byte code, more where any byte has a meaning.
STEP_COST = {"utf-8": 1, "euc-kr": 2, "cp949": 2}
OTHER_COST = 8
#: Reference text kept of each language, in bytes.
DICTIONARY_BYTES = 64_000
#: Reference texts that may be collected.
REFERENCE_ROWS = 100_000
LOST = "�"


def _charset(name: str) -> list[str]:
    """The character of each byte; bytes that the charset leaves undefined stand for the control of that number."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(name))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


READ_AS = ("latin-1", "cp1252", "mac_roman", "cp437", "cp850", "cp1251", "koi8-r", "cp866")
CHARS = {n: _charset(n) for n in READ_AS}
TO_BYTES = {n: {ord(c): b for b, c in reversed(list(enumerate(chars)))} for n, chars in CHARS.items()}
#: Characters to the Latin-1 character of their byte; those that the charset lacks to one that has none.
AS_LATIN = {n: {**{b: "\ufffe" for b in range(0x80, 0x100)}, **{c: chr(b) for c, b in t.items() if c > 0x7F}} for n, t in TO_BYTES.items()}
#: Really another charset than the one it was read in, other than UTF-8.
SINGLE = (("cp1252", "cp1251"), ("latin-1", "cp1251"), ("cp1252", "koi8-r"), ("latin-1", "koi8-r"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp1251", "cp866"), ("cp1252", "euc-kr"), ("cp1252", "cp949"))
CHAINS: tuple[tuple[tuple[str, str], ...], ...] = tuple(((n, "utf-8"),) for n in READ_AS) + tuple(
    ((a, "utf-8"), (b, "utf-8")) for a in ("cp1252", "latin-1") for b in ("cp1252", "latin-1", "cp1251")
) + tuple((p,) for p in SINGLE) + tuple((("cp1252", "utf-8"), p) for p in SINGLE[:3])

#: What texts of the languages here are written with; a decoding that yields anything else is chance.
_PLAUSIBLE = re.compile(r"[\x00-\x7f\xa0-\u017f\u0192\u02c6\u02dc\u0400-\u045f\u0490\u0491\u1100-\u11ff\u2010-\u2044\u20a0-\u20bf\u2100-\u21ff\u25a0-\u27bf\u3000-\u303f\u3130-\u318f\uac00-\ud7a3\uff00-\uffef\x80-\x9f]*")
_RUN = re.compile(r"[^\x00-\x7f]+")
_HANGUL, _CYRILLIC = re.compile(r"[가-힣]"), re.compile(r"[Ѐ-џ]")
_HIGH = re.compile(r"[¡-ÿ]{3}")
_CAPITAL_INSIDE = re.compile(r"[a-zà-öø-ÿа-яё][A-ZÀ-ÖØ-ÞА-ЯЁ]")
_CAPITALS = re.compile(r"[А-ЯЁ]{3}|[а-яё][А-ЯЁ]{2}")


def _utf8_gate(name: str) -> tuple[frozenset[str], re.Pattern[str]]:
    """Characters of frequent lead bytes, and a pattern of the characters of a two- or three-byte sequence."""
    c = CHARS[name]
    two, three, cont = (re.escape("".join(c[b] for b in r)) for r in (range(0xC2, 0xE0), range(0xE0, 0xF0), range(0x80, 0xC0)))
    # in cp866 the continuation bytes are letters: only the leads that aren't count there
    leads = (0xC2, 0xC3, 0xC4, 0xC5, 0xD0, 0xD1) + ((0xE2, 0xEA, 0xEB, 0xEC, 0xED) if name != "cp866" else ())
    return frozenset(c[b] for b in leads), re.compile(f"[{two}][{cont}]|[{three}][{cont}]{{2}}")


UTF8_GATES = {n: _utf8_gate(n) for n in READ_AS}


def _swap_table(read: str, real: str) -> dict[int, str]:
    """Character for character, where both charsets have one byte each; only plausible results."""
    out = {}
    for code, byte in TO_BYTES[read].items():
        try:
            new = bytes([byte]).decode(real)
        except UnicodeDecodeError:
            continue
        if code > 0x7F and _PLAUSIBLE.fullmatch(new):
            out[code] = new
    return out


SWAPS = {(a, b): _swap_table(a, b) for a, b in SINGLE if b not in ("euc-kr", "cp949")}


def _steps(text: str, chain: tuple[tuple[str, str], ...]) -> str:
    for read, real in chain:
        if (read, real) in SWAPS:
            sign, table = _CAPITALS if read in ("cp1251", "koi8-r") else _HIGH, SWAPS[read, real]
            new = "\n".join(x.translate(table) if sign.search(x) else x for x in text.split("\n"))
            if new == text:
                return text
            text = new
            continue
        table = AS_LATIN[read]

        def fix(m: re.Match[str], table=table, real=real) -> str:
            try:
                new = m[0].translate(table).encode("latin-1").decode(real)
            except UnicodeError:
                return m[0]
            return new if _PLAUSIBLE.fullmatch(new) else m[0]

        new = _RUN.sub(fix, text)
        if new == text:
            return text
        text = new
    return text


@dataclass
class Dictionaries:
    """Reference text of each language."""

    texts: dict[str, bytes]

    @lru_cache(maxsize=1)  # noqa: B019  one object lives as long as its worker
    def compressors(self) -> dict[str, zstandard.ZstdCompressor]:
        out = {}
        for name, raw in self.texts.items():
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=3)
            out[name] = zstandard.ZstdCompressor(level=3, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
        return out

    def __hash__(self) -> int:
        return id(self)

    @lru_cache(maxsize=1)  # noqa: B019
    def scripts(self) -> dict[str, list[str]]:
        """The languages written in each script."""
        out: dict[str, list[str]] = {}
        for name, raw in self.texts.items():
            out.setdefault(script(raw.decode("utf-8", "ignore")), []).append(name)
        return out

    def length(self, text: str, languages: list[str] | None = None) -> int:
        """The least compressed size over the languages, or over all."""
        raw = text.encode("utf-8", "surrogatepass")
        every = self.compressors()
        return min((len(every[n].compress(raw)) for n in languages or every), default=len(raw))


def reference_texts(samples: DataFrame, language_col: str = "language", text_col: str = "text", max_rows: int = REFERENCE_ROWS) -> list[tuple[str, str]]:
    """(language, text) of the clean reference texts, sorted; more than max_rows are an error, as a part of them would leave languages out."""
    rows = samples.where(F.col(text_col).isNotNull() & F.col(language_col).isNotNull()).select(language_col, text_col).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} reference texts: give a sample that holds every language")
    return sorted((r[0], r[1]) for r in rows)


def train_dictionaries(samples: DataFrame, language_col: str = "language", text_col: str = "text", limit_bytes: int = DICTIONARY_BYTES) -> Dictionaries:
    """From clean reference texts; of a language with more than limit_bytes, texts chosen by their hashes up to that size."""
    by_language: dict[str, list[bytes]] = {}
    for language, text in reference_texts(samples, language_col, text_col):
        by_language.setdefault(language, []).append((text + "\n").encode())
    out = {}
    for language, texts in by_language.items():
        if sum(map(len, texts)) > limit_bytes:
            size, chosen = 0, []
            for raw in sorted(texts, key=xxhash.xxh3_64_intdigest):
                if size + len(raw) <= limit_bytes:
                    size += len(raw)
                    chosen.append(raw)
            texts = sorted(chosen)
        out[language] = b"".join(texts)
    return Dictionaries({k: v for k, v in out.items() if len(v) >= 8})


def script(text: str) -> str:
    """The script of most letters outside ASCII, if these are many: ko, cyrillic or latin."""
    hangul, cyrillic = len(_HANGUL.findall(text)), len(_CYRILLIC.findall(text))
    if max(hangul, cyrillic) * 4 < len(text):
        return "latin"
    return "hangul" if hangul > cyrillic else "cyrillic"


def candidate_chains(text: str) -> list[tuple[tuple[str, str], ...]]:
    """Chains worth trying, by cheap signs in the text; nothing for ordinary text."""
    have = set(text)
    have = {c for c in have if c > "\x7f"}
    if not have:
        return []
    reads = [n for n, (leads, pattern) in UTF8_GATES.items() if not leads.isdisjoint(have) and pattern.search(text)]
    single: list[tuple[str, str]] = []
    if _HIGH.search(text):
        single += [p for p in SINGLE if p[0] in ("cp1252", "latin-1")]
    if any("Ѐ" <= c <= "џ" for c in have) and (_CAPITALS.search(text) or any(c in have for c in "ЂЃѓЉЊЌЋЏђљњќћџ")):
        single += [p for p in SINGLE if p[0] == "cp1251"]
        single += [p for p in SINGLE if p[0] == "koi8-r"]
    return [c for c in CHAINS if (c[0][1] == "utf-8" and c[0][0] in reads) or (len(c) == 1 and c[0] in single)]


def repair(text: str | None, dictionaries: Dictionaries) -> tuple[str | None, bool]:
    """(text with its encoding restored where possible, whether characters of it come from a wrong decoding).

    The same chain is applied to all lines; only lines it changes enter the comparison. None and ''
    come back unchanged. Chains are tried again on the result, for values garbled in several ways,
    until none saves anything; each pass shortens the description, so the passes end.
    """
    if not text or text.isascii():
        return text, False
    bad = LOST in text
    while True:
        best, gain = None, 0
        tried = {text}
        partly: dict[tuple, str] = {}
        controls = _controls(text)
        for chain in candidate_chains(text):
            for k in range(len(chain)):  # steps shared by chains are taken once
                if chain[: k + 1] not in partly:
                    partly[chain[: k + 1]] = _steps(partly[chain[:k]] if k else text, chain[k : k + 1])
            new = partly[chain]
            if new in tried:
                continue
            tried.add(new)
            old_lines, new_lines = text.split("\n"), new.split("\n")
            if len(old_lines) != len(new_lines):
                continue
            changed = [i for i, (a, b) in enumerate(zip(old_lines, new_lines, strict=True)) if a != b]
            languages = dictionaries.scripts().get(script("".join(new_lines[i] for i in changed)))
            if chain[-1][1] not in STEP_COST:  # any line can be read so: each must gain, or at least not look worse
                slack = 2 if chain[-1][0] in ("cp1252", "latin-1") else 0
                changed = [i for i in changed if _gains(old_lines[i], new_lines[i], dictionaries, slack, languages)]
                keep = set(changed)
                new = "\n".join(new_lines[i] if i in keep else x for i, x in enumerate(old_lines))
                if not changed:
                    continue
            if _controls(new) > controls:
                continue
            now = dictionaries.length("\n".join(old_lines[i] for i in changed), languages)
            then = dictionaries.length("\n".join(new_lines[i] for i in changed), languages) + sum(STEP_COST.get(real, OTHER_COST) for _, real in chain)
            if now - then > gain:
                best, gain = new, now - then
        if best is None:
            break
        text, bad = best, True
    return text, bad


def _gains(old: str, new: str, dictionaries: Dictionaries, slack: int, languages: list[str] | None) -> bool:
    """Short lines with words outside the dictionaries compress alike either way; slack lets them follow the rest of the text."""
    before, after = dictionaries.length(old, languages), dictionaries.length(new, languages)
    return after < before or (after <= before + slack and _odd_words(new) <= _odd_words(old))


def _odd_words(line: str) -> int:
    """Words with a capital after a small letter."""
    return len(_CAPITAL_INSIDE.findall(line))


def _controls(text: str) -> int:
    return sum("\x80" <= c <= "\x9f" or c == LOST for c in set(text))


def restored(docs: DataFrame, samples: DataFrame, columns: tuple[str, ...], dictionaries: Dictionaries | None = None) -> DataFrame:
    """docs with the columns restored where possible and <column>_garbled (boolean) for each.

    Null and empty values come out as they are, not garbled. A narrow map: no row moves, repeated
    rows stay, other columns are untouched; existing columns named <column>_garbled are replaced.
    """
    from pyspark.sql import types as T

    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(dictionaries or train_dictionaries(samples))
    docs = docs.drop(*(f"{c}_garbled" for c in columns))
    at = [docs.columns.index(c) for c in columns]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = shared.value
        for b in batches:
            arrays = list(b.columns)
            flags = []
            for i in at:
                fixed = [repair(t, d) for t in b.column(i).to_pylist()]
                arrays[i] = pa.array([t for t, _ in fixed], pa.string())
                flags.append(pa.array([x for _, x in fixed], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*arrays, *flags], names=[*b.schema.names, *(f"{c}_garbled" for c in columns)])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(f"{c}_garbled", T.BooleanType()) for c in columns)]))


def garbled_fields(docs: DataFrame, samples: DataFrame, id_col: str = "article_id", columns: tuple[str, ...] = ("title", "body")) -> DataFrame:
    """Distinct (id, field_name) of the garbled values."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(train_dictionaries(samples))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = shared.value
        for b in batches:
            ids, names = [], []
            for k, c in enumerate(columns, 1):
                for i, t in enumerate(b.column(k).to_pylist()):
                    if t and not t.isascii() and repair(t, d)[1]:
                        ids.append(i)
                        names.append(c)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int64())), pa.array(names, pa.string())], names=[id_col, "field_name"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, *columns).mapInArrow(run, f"`{id_col}` {kind}, field_name string").distinct()
