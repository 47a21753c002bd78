"""Template residue and error-page text.

Rules label what can be trusted: open template slots anywhere, and pages whose own text is nothing
but slots, filler, an error message or a demand for scripts. The labels then spread to near-duplicate
pages: own texts are reduced to classes of equal text (digits folded), a class's keys are the smallest
hashes of its five-word shingles, as many as leave no room for a similarity of 0.8 to a class without
any of them (a prefix filter, so no pair is lost), classes that share a key with a labelled class are
verified by the similarity of their shingles, and the labels follow these links until no class is
added, i.e. through the connected components of the labelled classes. Only the keys of the frontier of
newly labelled classes are joined with those of the pages in each round.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import checked_broadcast, settle, ship

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Blocks of a fingerprint's table keys; up to four differing bits leave at least two of six equal.
BLOCKS = 6
#: Own texts of more words aren't judged by the rules for error pages.
ERROR_PAGE_WORDS = 40

# Open slots of template languages and of editors.
SLOTS = (
    r"\{\{\{?[^{}\n]{1,60}\}?\}\}", r"\$\{[^{}\n]{1,60}\}", r"#\{[^{}\n]{1,60}\}", r"\{%[^%\n]{1,60}%\}", r"<%[^%\n]{1,60}%>", r"%%[A-Z][A-Z_]{1,40}%%", r"\[\[[^\[\]\n]{1,40}\]\]",
    r"<<[A-Za-z_.]{1,40}>>", r"__[A-Z][A-Z_]{1,40}__", r"@@[A-Z][A-Z_]{1,40}@@", r"%\([a-z_]{1,40}\)[sd]", r"\$[A-Z][A-Z_]{1,40}\$", r"\[object Object\]", r"\[(?:INSERT|ADD|YOUR|ENTER)\b[^\]\n]{0,40}\]",
    r"\{\d{1,2}\}", r"\bXX\.XX\.XX(?:XX)?\b", r"\bTODO: ?\w", r"(?:&lt;|<)(?:placeholder|insert [a-z ]{1,30}|your [a-z ]{1,30})(?:&gt;|>)",
)
# Filler, error messages and demands for scripts.
FILLER = (
    "text goes here", "sample text", "placeholder text", "lorem ipsum", "dummy text", "blindtext", "platzhaltertext", "texte à remplacer", "insérer ici le texte", "faux texte", "texto de relleno", "texto de prueba", "sustituir este texto", "escriba aquí el texto", "inserte aquí el texto", "texto provisório", "texto de exemplo", "inserir aqui o texto", "insira aqui o texto", "текст-заглушка", "текст заглушка", "здесь будет текст", "вставьте текст", "내용을 입력하세요", "본문을 입력하세요", "샘플 텍스트", "여기에 내용", "본문이 들어갑니다", "내용이 들어갑니다",
)
ERRORS = (
    "page not found", "the address may have changed", "bad gateway", "the server took too long", "access denied", "you do not have permission", "service temporarily unavailable", "please try again in", "something went wrong", "this article is no longer available", "internal server error", "gateway timeout",
    "seite nicht gefunden", "die adresse hat sich vielleicht geändert", "vorübergehend nicht erreichbar", "da ist etwas schiefgegangen", "zugriff verweigert", "dieser artikel ist nicht mehr", "der artikel ist nicht mehr", "kein zugriff",
    "page introuvable", "l’adresse a peut-être changé", "le serveur ne répond pas", "accès refusé", "cet article n’est plus disponible", "service indisponible",
    "página no encontrada", "puede que la dirección haya cambiado", "el servidor tardó demasiado", "acceso denegado", "ya no está disponible", "algo salió mal", "algo ha salido mal",
    "página não encontrada", "o endereço pode ter mudado", "serviço indisponível", "acesso negado", "não está mais disponível", "algo deu errado",
    "страница не найдена", "возможно, адрес изменился", "сервер не отвечает", "доступ запрещён", "доступ запрещен", "больше не доступ", "больше недоступ", "статья удалена", "материал удалён", "материал удален", "что-то пошло не так",
    "페이지를 찾을 수 없습니다", "주소가 바뀌었을 수", "서버가 응답하지 않습니다", "접근이 거부되었습니다", "삭제되었거나 없는 기사", "문제가 발생했습니다", "일시적인 오류",
)
SCRIPTS = (
    "enable javascript to continue", "switch on scripts", "scripts and cookies must be active", "checking your browser", "does not work without scripts", "<noscript>", "turn on javascript", "javascript is required",
    "schalten sie javascript ein", "nur mit aktiven skripten", "javascript aktivieren, um fortzufahren",
    "activer javascript pour continuer", "exige que les scripts",
    "necesita que permita los scripts", "active javascript para continuar", "active el javascript para continuar",
    "precisa que os scripts", "ative o javascript para continuar",
    "включите javascript, чтобы продолжить", "нужны скрипты",
    "스크립트를 허용해야", "계속하려면 javascript",
)
# Codes that stand alone on error pages.
CODES = r"(?:error|fehler|erreur|erro|ошибка|오류) ?\d+.*|[45]\d\d|kennung:? ?\d+|(?:ref|réf|code|reference|код|번호)\.? ?\d+|just a moment…?"

LOST = "�"


def _tolerant(text: str) -> str:
    return "".join(f"(?:{re.escape(c)}|{LOST}{{1,3}})" if c > "\x7f" else re.escape(c) for c in text)


SLOT = re.compile("|".join(f"(?:{s})" for s in SLOTS))
_CUES = (*FILLER, *ERRORS, *SCRIPTS)
_CUE = re.compile("|".join(map(_tolerant, _CUES)))
_CODE = re.compile(CODES)
_SLOT_MARK = re.compile(r"[{%\[<@$]|__|XX|TODO|&lt;")
_QUIET_MARKS = ("{", "%", "[", "<", "@", "$", "__", "XX", "TODO", "&lt;", LOST)
_WORDS = re.compile(r"[^\W_]+")
_DIGITS = re.compile(r"\d+")
_SENTENCE = re.compile(r"(?<=[.!?。])\s+")
# Function words; a longer Latin text without any is in no language.
FUNCTION_WORDS = frozenset(
    "the a of to in and for with at by on from was were is are that it has had said der die das den dem des ein eine einen und von zu zum zur im in für mit bei aus nach vor auf hat war wird wurde le la les un une des du de et à au aux en dans sur pour par avec a ont l d s qu que qui el los las y con por del al se su para lo en o os as um uma e do da dos das no na nos nas ao".split()
)

# The words of standard filler, and those of which each of its sentences has one.
LOREM_WORDS = frozenset(
    "lorem ipsum dolor sit amet consectetur consectetuer adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
_MARKS = (*_CUES, "dolor", "veniam", "cupidatat")


def has_slot(text: str | None) -> bool:
    return bool(text) and _SLOT_MARK.search(text) is not None and SLOT.search(text) is not None


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    """All marks at once; built in each process."""
    found = ahocorasick.Automaton()
    for m in _MARKS:
        found.add_word(m, m)
    found.make_automaton()
    return found


def has_mark(low: str) -> bool:
    """Whether a text in lower case may hold a cue."""
    return next(_automaton().iter(low), None) is not None or (LOST in low and _CUE.search(low) is not None)


def line_residue(line: str, low: str | None = None, marked: bool | None = None) -> bool:
    """Whether a line is nothing but slots, filler, an error message or a demand for scripts."""
    if not line or len(line) > 240:
        return False
    if _SLOT_MARK.search(line):
        if LOST not in line and not _WORDS.search(SLOT.sub(" ", line)):
            return True
        if line.startswith("TODO: ") and len(line) < 60:
            return True
    if line.count(LOST) * 4 > len(line):
        return False
    low = line.casefold() if low is None else low
    if len(low) < 140 and (has_mark(low) if marked is None else marked) and (sum(len(c) * low.count(c) for c in _CUES if c in low) * 5 >= len(low) or (LOST in low and _CUE.search(low))):
        return True  # the message is a good part of the line
    return _CODE.fullmatch(low) is not None


@dataclass(slots=True)
class LineSigns:
    """What the rules see in one line, as numbers that travel instead of the text.

    packed: whether the line is residue, whether it holds a function word or is mostly not Latin,
    whether its first sentence is a cue sentence, its words other than letters, different words (to
    three), words, cue sentences and sentences; counts stop at the widths of their fields, far beyond
    what the rules ask for. only: a hash of its one sentence if all its sentences are the same, else 0.
    """

    packed: int
    only: int

    residue = property(lambda self: bool(self.packed & 1))
    plain = property(lambda self: bool(self.packed & 2))
    first_cue = property(lambda self: bool(self.packed & 4))
    distinct = property(lambda self: self.packed >> 3 & 3)
    other = property(lambda self: self.packed >> 5 & 0xFFF)
    words = property(lambda self: self.packed >> 17 & 0xFFFF)
    cues = property(lambda self: self.packed >> 33 & 0x3FFF)
    sentences = property(lambda self: self.packed >> 47 & 0x7FFF)


def line_signs(line: str, quiet: bool = False) -> LineSigns:
    """The signs of a line with white space collapsed, not empty; its words are what white space parts.

    quiet: the text the line is from holds no mark of a cue and no mark of a slot.
    """
    return LineSigns(*pack_signs(line, line.casefold(), quiet))


def pack_signs(line: str, low: str, quiet: bool) -> tuple[int, int]:
    words = low.split(" ")
    n_words, other, distinct = len(words), 0, 0
    plain = not FUNCTION_WORDS.isdisjoint(words) or (not line.isascii() and (len(line.encode()) - len(line)) * 10 > len(line))
    if not plain:
        parts = _WORDS.findall(low)
        plain = not FUNCTION_WORDS.isdisjoint(parts)
        letters = [w for w in parts if w.isalpha()]
        n_words, other, distinct = len(parts), len(parts) - len(letters), len(set(letters))
    n = 1 + low.count(". ") + low.count("! ") + low.count("? ") + low.count("。 ")
    only = 0
    if n == 1:
        only = (xxhash.xxh3_64_intdigest(low) & 0x7FFFFFFF) or 1
    elif len(set(words)) * 2 <= len(words) and len(sentences := set(_SENTENCE.split(low))) == 1:
        only = (xxhash.xxh3_64_intdigest(sentences.pop()) & 0x7FFFFFFF) or 1
    packed = plain << 1 | min(distinct, 3) << 3 | min(other, 0xFFF) << 5 | min(n_words, 0xFFFF) << 17 | min(n, 0x7FFF) << 47
    if quiet:
        return packed | (len(line) <= 240 and _CODE.fullmatch(low) is not None), only
    marked = has_mark(low)
    if marked:
        found = [_cue_sentence(s) for s in _SENTENCE.split(line) if s]
        packed |= found[0] << 2 | min(sum(found), 0x3FFF) << 33
    return packed | line_residue(line, low, marked), only


def is_quiet(text: str) -> bool:
    """Whether no line of a text holds a mark of a cue or a slot, so that all are quiet."""
    return not any(m in text for m in _QUIET_MARKS) and not has_mark(text.casefold())


def residue_of_signs(signs: list[tuple[int, LineSigns]], foreign: bool = False) -> bool:
    """Whether a page's own lines, each a key of its text and its signs, are residue instead of an article. No lines: no.

    They are where the first two have a residue line and all are such lines or have few words; where
    they are one sentence at least three times; where they are at least eight Latin words, some of
    them different, without any function word, unless the source is foreign; and where cue sentences are more than half of all, or
    at least a third and the first of all.
    """
    if not signs:
        return False
    own = [s for _, s in signs]
    if not any(s.packed & (1 | 0x3FFF << 33) for s in own) and any(s.packed & 2 for s in own) and not (own[0].only and own[-1].only == own[0].only):
        return False  # nothing of what follows
    if any(s.residue for s in own[:2]) and (all(s.residue for s in own) or sum(s.words for s in own) <= ERROR_PAGE_WORDS):
        return True
    if own[0].only and all(s.only == own[0].only for s in own) and sum(s.sentences for s in own) >= 3:
        return True
    if not foreign and not any(s.plain for s in own):
        other = sum(s.other for s in own)
        n = sum(s.words for s in own) - other
        if n >= 8 and n >= 9 * other and max(max(s.distinct for s in own), len({k for k, _ in signs})) >= 3:
            return True
    cues, n = sum(s.cues for s in own), sum(s.sentences for s in own)
    return 2 * cues > n or (own[0].first_cue and 3 * cues >= n)


def residue_text(lines: list[str]) -> bool:
    """Whether a page's own lines are residue instead of an article. No lines: no."""
    return residue_of_signs([(hash(x), line_signs(" ".join(x.split()))) for x in lines if x.strip()])


def _cue_sentence(sentence: str) -> bool:
    """Whether cues are a good part of a sentence, or nearly all its words are standard filler."""
    if sentence.count(LOST) * 4 > len(sentence):
        return False
    low = sentence.casefold()
    if sum(len(c) * low.count(c) for c in _CUES if c in low) * 5 >= len(low) or (LOST in low and len(low) < 140 and _CUE.search(low) is not None):
        return True
    words = _WORDS.findall(low)
    return len(words) >= 4 and sum(w in LOREM_WORDS for w in words) * 4 >= 3 * len(words)


_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def normal_words(text: str) -> list[str]:
    return _WORDS.findall(_DIGITS.sub("0", text.casefold()))


@lru_cache(maxsize=200_000)
def _word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word)


def shingles(words: list[str], n: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct hashes of the word n-grams, sorted; of the whole text where it has fewer words."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_word_hash, words), np.uint64, len(words))
    n = min(n, len(words))
    m = len(words) - n + 1
    out = h[:m] * _MULT[0]
    for j in range(1, n):
        out = _join(out, h[j : j + m], j)
    return np.unique(out)


def simhash(features: np.ndarray) -> int:
    """The 64-bit fingerprint of hashes, signed; 0 for none."""
    return int(_fingerprints(features, np.array([0]))[0]) if len(features) else 0


def _fingerprints(features: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Fingerprints of the groups of hashes that begin at starts, none of them empty."""
    bits = np.unpackbits(features.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    size = np.diff(np.concatenate([starts, [len(features)]]))
    return np.packbits(2 * ones >= size[:, None], axis=1, bitorder="little").view(np.int64)[:, 0]


def batch_fingerprints(texts: list[list[str]], n: int = SHINGLE_WORDS, chunk: int = 200_000) -> list[int]:
    """simhash over the word n-grams of each text, all texts of a batch together; 0 for texts without words."""
    out = [0] * len(texts)
    for at, grams, starts in _grams(texts, n, chunk):
        for i, f in zip(at, _fingerprints(grams, starts).tolist(), strict=True):
            out[i] = f
    return out


def batch_prefixes(texts: list[list[str]], n: int = SHINGLE_WORDS, chunk: int = 200_000) -> tuple[np.ndarray, pa.ListArray]:
    """The number of distinct shingles of each text, and the smallest of them that are its keys.

    Two texts at SIMILARITY have at least that share of the larger one's shingles in common, so the
    smallest common one is among the size - ceil(SIMILARITY * size) + 1 smallest of both. Of the
    hashes 44 bits are used, so that one sort takes a part of the batch.
    """
    size = np.zeros(len(texts), np.int32)
    n_keys, keys = np.zeros(len(texts) + 1, np.int32), [np.zeros(0, np.int64)]
    for at, grams, starts in _grams(texts, n, chunk):
        group = np.repeat(np.arange(len(at), dtype=np.uint64), np.diff(np.concatenate([starts, [len(grams)]])))
        both = np.sort(group << np.uint64(44) | grams >> np.uint64(20))
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
        group = (both >> np.uint64(44)).astype(np.int64)
        found = np.bincount(group, minlength=len(at))
        used = found - np.ceil(SIMILARITY * found - 1e-9).astype(np.int64) + 1
        rank = np.arange(len(both)) - np.repeat(np.cumsum(found) - found, found)
        keys.append((both[rank < used[group]] & np.uint64((1 << 44) - 1)).view(np.int64))
        size[at], n_keys[np.array(at) + 1] = found, used
    return size, pa.ListArray.from_arrays(np.cumsum(n_keys, dtype=np.int32), np.concatenate(keys))


def _grams(texts: list[list[str]], n: int, chunk: int) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(texts, hashes of their word n-grams in turn, where each text's begin) of parts of a batch; texts without words are left out."""
    at, flat, sizes = [], [], []

    def grams() -> tuple[list[int], np.ndarray, np.ndarray]:
        h = np.array(flat, np.uint64)
        size = np.array(sizes)
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        span = np.minimum(size, n)  # shorter texts are one shingle
        count = size - span + 1
        starts = np.concatenate([[0], np.cumsum(count)[:-1]])
        pos = np.arange(count.sum()) - np.repeat(starts, count) + np.repeat(first, count)
        width = np.repeat(span, count)
        acc = h[pos] * _MULT[0]
        for j in range(1, n):
            use = np.nonzero(width > j)[0]
            acc[use] = _join(acc[use], h[pos[use] + j], j)
        return at, acc, starts

    for i, words in enumerate(texts):
        if words:
            at.append(i)
            flat.extend(map(_word_hash, words))
            sizes.append(len(words))
            if len(flat) >= chunk:
                yield grams()
                at, flat, sizes = [], [], []
    if at:
        yield grams()


def _join(acc: np.ndarray, h: np.ndarray, j: int) -> np.ndarray:
    acc = acc ^ (h + _MULT[j]) * _MULT[j]
    acc ^= acc >> np.uint64(31)
    return acc * _MULT[0]


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def table_keys(fingerprint: int) -> list[int]:
    """One key for each pair of the six blocks."""
    f = fingerprint & 0xFFFFFFFFFFFFFFFF
    edges = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    parts = [(f >> edges[i]) & ((1 << (edges[i + 1] - edges[i])) - 1) for i in range(BLOCKS)]
    return [k << 40 | parts[a] << 12 | parts[b] for k, (a, b) in enumerate(combinations(range(BLOCKS), 2))]


CLASS_SCHEMA = "class bigint, n_shingles int, prefix array<bigint>, n_words int, own binary"


def unpack_own(own: bytes) -> list[str]:
    """The words of a page's own text as page_classes gives it."""
    return zstandard.decompress(own).decode().split(" ")


def page_classes(docs: DataFrame, samples: DataFrame, id_col: str = "article_id", title_col: str = "title", body_col: str = "body", source_col: str | None = "source") -> DataFrame:
    """(id, slot, residue, class, n_shingles, prefix, n_words, own) of each row; own is the page's own text, compressed, as the words that are compared."""
    from pyspark.sql import types as T

    from corpusmill.llm.pagebody import read_pages, slices, unpack

    pages = read_pages(docs, samples, body_col, source_col, (id_col,), title_col, with_text=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in slices(batches):
            texts = [normal_words(" ".join(x for x, k in zip(unpack(text), kept, strict=True) if k)) if text else [] for text, kept in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            own = [" ".join(words) for words in texts]
            classes = pa.array([xxhash.xxh3_64_intdigest(x) - (1 << 63) if x else None for x in own], pa.int64())
            size, keys = batch_prefixes(texts)
            packed = pa.array([pack(x.encode()) if x else None for x in own], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), classes, pa.array(size), keys, pa.array([len(x) for x in texts], pa.int32()), packed], names=names)

    rest = T._parse_datatype_string("slot boolean, residue boolean, " + CLASS_SCHEMA)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *rest.fields])
    names = schema.names
    return pages.select("c0", "slot", "residue", "text", "kept").mapInArrow(run, schema)


def _class_prefixes(own: DataFrame) -> DataFrame:
    """(class, n_shingles, prefix) of (class, own), own as page_classes gives it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, keys = batch_prefixes([unpack_own(x) for x in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), keys], names=["class", "n_shingles", "prefix"])

    return own.select("class", "own").mapInArrow(run, "class bigint, n_shingles int, prefix array<bigint>")


def spread_labels(pages: DataFrame, texts) -> DataFrame:
    """(class) of all classes in the components of labelled ones.

    pages: settled page_classes; texts: a function that gives (class, own) of the classes in a
    DataFrame. The rounds end when no class is added.
    """
    pages = pages.where("class is not null")
    if "prefix" not in pages.columns:
        pages = settle(pages.join(_class_prefixes(texts(pages.select("class").distinct())), "class"))
    keyed = pages.select("class", "n_shingles", F.explode("prefix").alias("key"))
    labelled = settle(pages.where("residue").select("class").distinct())
    frontier = labelled
    while True:  # each round labels at least one more class
        near = keyed.join(checked_broadcast(frontier), "class", "left_semi").select("key", F.col("class").alias("from_class"), F.col("n_shingles").alias("from_n")).distinct()
        open_keys = keyed.join(checked_broadcast(labelled), "class", "left_anti")
        alike = F.least("n_shingles", "from_n") >= SIMILARITY * F.greatest("n_shingles", "from_n") - 1e-9
        pairs = open_keys.join(checked_broadcast(near), "key").where(alike).select("from_class", "class").distinct()
        pairs = settle(pairs)
        if pairs.isEmpty():
            break
        own = texts(pairs.select("class").union(pairs.select("from_class")).distinct())

        def similar(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = [jaccard(shingles(unpack_own(x)), shingles(unpack_own(y))) >= SIMILARITY for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0)], names=["class"]).filter(pa.array(keep, pa.bool_()))

        joined = pairs.join(own, "class").join(own.select(F.col("class").alias("from_class"), F.col("own").alias("from_own")), "from_class")
        fresh = settle(joined.select("class", "own", "from_own").mapInArrow(similar, "class bigint").distinct())
        if fresh.isEmpty():
            break
        frontier = fresh
        labelled = settle(labelled.union(frontier))
    return labelled


def residue_labels(docs: DataFrame, samples: DataFrame, id_col: str = "article_id", title_col: str = "title", body_col: str = "body", source_col: str | None = "source", trusted: Column | None = None) -> DataFrame:
    """(id, slot, seed, spread) of each row of docs: an open slot; a trusted label; the label after it has spread.

    trusted: a condition on the id column that says which rows' rule labels are trusted as seeds; all
    of them without it. What spreads from a part of the labels to the other pages that the rules would
    have named is the recall of the spread.
    """
    pages = page_classes(docs, samples, id_col, title_col, body_col, source_col)
    pages = settle(pages if trusted is None else pages.withColumn("residue", F.col("residue") & trusted))

    def texts(wanted: DataFrame) -> DataFrame:
        return settle(pages.join(checked_broadcast(wanted), "class", "left_semi").select("class", "own").dropDuplicates(["class"]))

    spread = spread_labels(pages, texts).withColumn("spread", F.lit(True))
    return pages.select(id_col, "slot", F.col("residue").alias("seed"), "class").join(checked_broadcast(spread), "class", "left").select(id_col, "slot", "seed", F.coalesce("spread", F.lit(False)).alias("spread"))


def residue_pages(docs: DataFrame, samples: DataFrame, id_col: str = "article_id", title_col: str = "title", body_col: str = "body", source_col: str | None = "source") -> DataFrame:
    """Distinct ids of the rows with an open slot, or with residue in place of a text.

    Null and empty titles and bodies have neither; a null id comes out as null if its row is a case;
    repeated rows count once; other columns aren't read; an empty table gives no rows.
    """
    return residue_labels(docs, samples, id_col, title_col, body_col, source_col).where("slot or spread").select(id_col).distinct()


def without_residue(docs: DataFrame, samples: DataFrame, id_col: str = "article_id", title_col: str = "title", body_col: str = "body", source_col: str | None = "source") -> DataFrame:
    """The rows of docs that are no cases; rows with a null id stay."""
    cases = settle(residue_pages(docs, samples, id_col, title_col, body_col, source_col).where(F.col(id_col).isNotNull()))
    return docs.join(checked_broadcast(cases), id_col, "left_anti")
