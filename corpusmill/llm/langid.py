"""Document and paragraph languages.

One interpolated Kneser-Ney character model of order five for each language, trained on clean
reference texts. All languages share sorted arrays of 64-bit n-gram hashes, with one row of log
probabilities for each n-gram (a column for each language) and one of back-off weights for each
context, so that one search serves all languages. A line's language is the one with the lowest
cross-entropy per character. Held-out parts of the reference texts calibrate both the confidence
(a temperature on the cross-entropy differences) and the cross-entropy from which a line is in none
of the languages.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.encoding import reference_texts
from corpusmill.llm.pagebody import LOST, is_ended, read_pages, slices, unpack
from corpusmill.runtime import ship

ORDER = 5
#: Letters from which a paragraph's language is judged on its own.
LEAST_LETTERS = 20
#: Confidence from which a paragraph counts as being in another language than its article.
SURE = 0.9
CHUNK = 1 << 19

# What languages are called in labels.
LABELS = {
    "en": "en eng english anglais englisch inglés ingles inglês английский 영어",
    "de": "de deu ger deutsch german allemand alemán aleman alemão немецкий 독일어",
    "fr": "fr fra fre français francais french französisch francés frances francês французский 프랑스어",
    "es": "es spa español espanol spanish castellano spanisch espagnol espanhol испанский 스페인어",
    "pt": "pt por português portugues portuguese portugiesisch portugais portugués португальский 포르투갈어",
    "ko": "ko kor 한국어 korean koreanisch coréen coreano корейский 조선말",
    "ru": "ru rus русский russian russisch russe ruso russo 러시아어",
}
LABEL_OF = {w: k for k, ws in LABELS.items() for w in ws.split()}

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def label_language(label: str | None) -> str | None:
    """The code a label names, in any spelling, with or without a region; None for missing and unusable labels."""
    if not label:
        return None
    text = label.strip().casefold()
    if text in LABEL_OF:
        return LABEL_OF[text]
    for sep in ("-", "_", " ", "("):
        head = text.split(sep)[0]
        if head in LABEL_OF:
            return LABEL_OF[head]
    return None


def _fold_table() -> np.ndarray:
    """Code point to what the models see: letters in lower case, everything else a space."""
    table = np.full(0x110000, 32, np.uint32)
    for a, b in ((0x41, 0x250), (0x370, 0x530), (0x1100, 0x1200), (0x1E00, 0x2000), (0x3040, 0x3100), (0x3130, 0x3190), (0x4E00, 0xA000), (0xAC00, 0xD7A4)):
        for c in range(a, b):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
    table[0x27] = table[0x2019] = 0x27
    table[10] = 10
    return table


_FOLD = _fold_table()
#: Script of a folded code point: 0 space, 1 Latin, 2 Cyrillic, 3 Hangul, 4 other.
N_SCRIPTS = 5


def _script(codes: np.ndarray) -> np.ndarray:
    out = np.full(len(codes), 4, np.int64)
    out[(codes <= 32)] = 0
    out[(codes > 32) & (codes < 0x250)] = 1
    out[(codes >= 0x400) & (codes < 0x530)] = 2
    out[((codes >= 0xAC00) & (codes < 0xD7A4)) | ((codes >= 0x1100) & (codes < 0x1200)) | ((codes >= 0x3130) & (codes < 0x3190))] = 3
    return out


_SIZES = np.array([2, 60, 40, 2000, 20000], float)


def fold(text: str) -> np.ndarray:
    """Folded code points; runs of spaces are one."""
    codes = _FOLD[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    if len(codes) < 2:
        return codes
    space = codes == 32
    before = np.empty(len(codes), bool)
    before[0] = False
    np.less_equal(codes[:-1], 32, out=before[1:])
    return codes[~(space & before)]


def _partial_hashes(codes: np.ndarray) -> list[np.ndarray]:
    """For n = 1 to ORDER the unmixed hash of the n-gram that ends at each position (shorter at the start)."""
    c = codes.astype(np.uint64) + np.uint64(1)
    sums = [c * _MULT[0]]
    for j in range(1, ORDER):
        nxt = sums[-1].copy()
        nxt[j:] += c[:-j] * _MULT[j]
        sums.append(nxt)
    return sums


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    return h * np.uint64(0xBF58476D1CE4E5B9)


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions in the sorted keys, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    at[keys[at] != wanted] = -1
    return at


class _KneserNey:
    """Counts and probabilities of one language, for training."""

    def __init__(self, texts: list[str]):
        self.counts: list[Counter] = [Counter() for _ in range(ORDER + 1)]
        self.script = np.full(N_SCRIPTS, 0.5)
        for t in texts:
            codes = fold("\n" + t + "\n")
            s = tuple(codes.tolist())
            np.add.at(self.script, _script(codes), 1)
            for i in range(len(s) - ORDER + 1):
                self.counts[ORDER][s[i : i + ORDER]] += 1
            for k in range(2, ORDER):  # n-grams at the start of a text have no predecessor and keep their raw count
                self.counts[k][s[:k]] += 1
        for k in range(ORDER - 1, 0, -1):
            for g in self.counts[k + 1]:
                self.counts[k][g[1:]] += 1
        self.script /= self.script.sum()
        self.total: list[dict] = [{} for _ in range(ORDER + 1)]
        self.gamma: list[dict] = [{} for _ in range(ORDER + 1)]
        self.discount = [0.0] * (ORDER + 1)
        for k in range(1, ORDER + 1):
            n1 = sum(c == 1 for c in self.counts[k].values())
            n2 = sum(c == 2 for c in self.counts[k].values())
            d = self.discount[k] = min(0.95, max(0.1, n1 / (n1 + 2 * n2) if n1 else 0.5))
            total, kinds = defaultdict(int), defaultdict(int)
            for g, c in self.counts[k].items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            self.total[k] = total
            self.gamma[k] = {h: d * kinds[h] / total[h] for h in total}
        self.memo: dict[tuple, float] = {}

    def base(self, code: int) -> float:
        s = int(_script(np.array([code]))[0])
        return float(self.script[s] / _SIZES[s])

    def p(self, g: tuple) -> float:
        if g not in self.memo:
            k = len(g)
            lower = self.p(g[1:]) if k > 1 else self.base(g[0])
            h = g[:-1]
            if h in self.total[k]:
                self.memo[g] = max(self.counts[k].get(g, 0) - self.discount[k], 0.0) / self.total[k][h] + self.gamma[k][h] * lower
            else:
                self.memo[g] = lower
        return self.memo[g]


class LanguageModels:
    """The sorted hash arrays of all languages, and the calibration."""

    def __init__(self, texts: dict[str, list[str]], calibrated: bool = True):
        self.languages = sorted(texts)
        kn = {name: _KneserNey(texts[name]) for name in self.languages}
        width = len(self.languages)
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        self.contexts: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(1, ORDER + 1):
            grams = sorted({g for m in kn.values() for g in m.counts[k]})
            rows = np.array([[math.log(m.p(g)) for m in kn.values()] for g in grams], np.float32).reshape(-1, width)
            self.grams.append(self._sorted(grams, rows, k))
            heads = sorted({h for m in kn.values() for h in m.gamma[k]})
            rows = np.array([[math.log(m.gamma[k].get(h, 1.0)) for m in kn.values()] for h in heads], np.float32).reshape(-1, width)
            self.contexts.append(self._sorted(heads, rows, k - 1) if k > 1 else (np.zeros(1, np.uint64), rows))
        self.base = np.array([[math.log(m.script[s] / _SIZES[s]) for m in kn.values()] for s in range(N_SCRIPTS)], np.float32)
        self.temperature, self.worst = 1.0, np.full(width, np.inf)
        if calibrated:
            self._calibrate(texts)

    @staticmethod
    def _sorted(grams: list[tuple], rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        if not grams:
            return np.zeros(0, np.uint64), rows
        codes = np.array(grams, np.uint64).reshape(len(grams), n)[:, ::-1] + np.uint64(1)
        h = _mixed((codes * _MULT[:n]).sum(1, dtype=np.uint64))
        order = np.argsort(h)
        return h[order], rows[order]

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of each code given the four before it, by language."""
        sums = _partial_hashes(codes)
        keys, rows = self.grams[ORDER - 1]
        at = _find(keys, _mixed(sums[ORDER - 1]))
        out = rows[np.maximum(at, 0)]
        left = np.nonzero(at < 0)[0]
        rest = np.zeros((len(left), len(self.languages)), np.float32)
        for k in range(ORDER - 1, 0, -1):
            # what failed is order k + 1: its context's weight, then order k
            ckeys, crows = self.contexts[k]
            ends = np.maximum(left - 1, 0)
            at = _find(ckeys, _mixed(sums[k - 1][ends]))
            known = np.nonzero((at >= 0) & (left > 0))[0]
            rest[known] += crows[at[known]]
            keys, rows = self.grams[k - 1]
            at = _find(keys, _mixed(sums[k - 1][left]))
            hit = at >= 0
            out[left[hit]] = rows[at[hit]] + rest[hit]
            miss = ~hit
            left, rest = left[miss], rest[miss]
            if not len(left):
                return out
        out[left] = self.base[_script(codes[left])] + rest + self.contexts[0][1][0]
        return out

    def line_scores(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sums of log probabilities by line and language, letters by line); lines hold no newline."""
        sums, letters = [], []
        part: list[str] = []
        size = 0
        for i, x in enumerate(lines):
            part.append(x)
            size += len(x) + 1
            if size >= CHUNK or i == len(lines) - 1:
                codes = fold("\n" + "\n".join(part) + "\n")
                marks = np.nonzero(codes == 10)[0]
                s = self.scores(codes)
                total = np.add.reduceat(s, marks[:-1] + 1, axis=0)
                total[np.diff(marks) == 1] = 0  # an empty line's slot would take the next one's first value
                sums.append(total)
                word = np.concatenate([[0], np.cumsum(codes > 32)])
                letters.append(word[marks[1:]] - word[marks[:-1]])
                part, size = [], 0
        if not sums:
            return np.zeros((0, len(self.languages)), np.float32), np.zeros(0, np.int64)
        return np.concatenate(sums), np.concatenate(letters)

    def judge(self, sums: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, -1 if in none; confidence) for rows of summed scores."""
        if not len(sums):
            return np.zeros(0, np.int64), np.zeros(0)
        best = sums.argmax(1)
        n = np.maximum(letters, 1)
        entropy = -sums[np.arange(len(sums)), best] / n
        z = (sums - sums.max(1, keepdims=True)).astype(np.float64) * self.temperature
        confidence = 1 / np.exp(z).sum(1)
        return np.where((letters > 0) & (entropy <= self.worst[best]), best, -1), confidence

    def _calibrate(self, texts: dict[str, list[str]]) -> None:
        """On held-out fifths: the temperature of least log loss on short pieces, and each language's worst usual entropy."""
        rows, truth, letters = [], [], []
        for fold_no in range(5):
            kept = {k: [t for i, t in enumerate(v) if i % 5 != fold_no] or v for k, v in texts.items()}
            held = [(k, t) for k, v in texts.items() for i, t in enumerate(v) if i % 5 == fold_no]
            pieces = [(k, t[j : j + 40]) for k, t in held for j in range(0, len(t), 40)]
            pieces = [(k, " ".join(t.split())) for k, t in pieces if len(t) >= 15]
            model = LanguageModels(kept, calibrated=False)
            if not pieces:
                continue
            s, n = model.line_scores([t for _, t in pieces])
            rows.append(s)
            letters.append(n)
            truth += [self.languages.index(k) for k, _ in pieces]
        if not rows:
            return
        s, n, y = np.concatenate(rows).astype(np.float64), np.concatenate(letters), np.array(truth)
        z = s - s.max(1, keepdims=True)

        def loss(t: float) -> float:
            return float((np.log(np.exp(z * t).sum(1)) - (z * t)[np.arange(len(y)), y]).mean())

        self.temperature = min((round(0.05 * i, 2) for i in range(2, 21)), key=loss)
        entropy = -s[np.arange(len(y)), y] / np.maximum(n, 1)
        for k in range(len(self.languages)):
            e = entropy[(y == k) & (n >= 10)]
            if len(e):
                self.worst[k] = e.mean() + 5 * e.std() + 0.25


def train_models(samples: DataFrame, language_col: str = "language", text_col: str = "text") -> LanguageModels:
    """From the fixed table of clean reference texts (reference_texts bounds it)."""
    texts: dict[str, list[str]] = {}
    for language, text in reference_texts(samples, language_col, text_col):
        texts.setdefault(language, []).append(text)
    return LanguageModels(texts)


def own_languages(pages: Iterable[tuple[list[int], list[bool], bytes | None, bool]], models: LanguageModels) -> Iterator[tuple[int, int, str, float, int]]:
    """(index of the page, line number or 0 for the whole, code, confidence, letters) of pages as read_pages gives them.

    Whole texts that are in none of the languages and lines that are too short or in none have no row.
    """
    at: list[tuple[int, int]] = []
    lines: list[str] = []
    for i, (numbers, kept, text, residue) in enumerate(pages):
        if numbers and not residue:
            whole = unpack(text)
            own = [k for k, x in enumerate(kept) if x]
            at += [(i, numbers[k] + 1) for k in own]
            lines += [whole[k] for k in own]
    if not lines:
        return
    sums, letters = models.line_scores(lines)
    code, sure = models.judge(sums, letters)
    rows = np.array([i for i, _ in at])
    prose = np.fromiter(map(is_ended, lines), bool, len(lines))  # bylines and subheadings aren't paragraphs
    code[np.fromiter((x.count(LOST) * 4 > len(x) for x in lines), bool, len(lines))] = -1  # too little is left to tell
    docs, at_doc = np.unique(rows, return_inverse=True)
    width = len(models.languages)
    judged = (code >= 0) & (letters >= LEAST_LETTERS) & prose
    lonely = ~np.isin(at_doc, at_doc[judged])  # without any such line all lines have a vote
    votes = np.nonzero((judged | lonely) & (code >= 0))[0]
    weight = np.zeros((len(docs), width))
    np.add.at(weight, (at_doc[votes], code[votes]), letters[votes])
    most = weight.argmax(1)
    agree = votes[code[votes] == most[at_doc[votes]]]
    total = np.zeros((len(docs), width))
    np.add.at(total, at_doc[agree], sums[agree])
    _, whole = models.judge(total, np.bincount(at_doc[agree], letters[agree], len(docs)))
    share = weight[np.arange(len(docs)), most] / np.maximum(weight.sum(1), 1)
    size = np.bincount(at_doc, letters, len(docs))
    known = weight.sum(1) > 0
    order = np.nonzero(judged & known[at_doc])[0]
    bounds = np.searchsorted(at_doc[order], np.arange(len(docs) + 1))
    for d in np.nonzero(known)[0]:
        yield int(docs[d]), 0, models.languages[most[d]], float(whole[d] * share[d]), int(size[d])
        for j in order[bounds[d] : bounds[d + 1]]:
            yield int(docs[d]), at[j][1], models.languages[code[j]], float(sure[j]), int(letters[j])


def _pages(docs: DataFrame, samples: DataFrame, body_col: str, source_col: str | None, carry: tuple[str, ...]) -> DataFrame:
    pages = read_pages(docs, samples, body_col, source_col if source_col in docs.columns else None, carry, with_text=True)
    return pages.select(*(f"c{i}" for i in range(len(carry))), "at", "kept", "text", "residue")


def document_languages(docs: DataFrame, samples: DataFrame, id_col: str = "article_id", body_col: str = "body", carry: tuple[str, ...] = (), source_col: str | None = "source") -> DataFrame:
    """(id, carried columns, line_no, lang_code, confidence, letters): line_no 0 for each document, else for each judged line of its own text.

    Null and empty bodies, pages with residue instead of a text and texts in none of the languages
    have no rows. Repeated rows stay; other columns aren't read.
    """
    from pyspark.sql import types as T

    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(train_models(samples))
    names = [id_col, *carry]
    n = len(names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2_000):
            found = list(own_languages(zip(*(b.column(n + i).to_pylist() for i in range(4)), strict=True), shared.value))
            cols = list(zip(*found, strict=True)) if found else [[]] * 5
            take = pa.array(cols[0], pa.int64())
            kinds = (pa.int32(), pa.string(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(take) for i in range(n)), *(pa.array(c, k) for c, k in zip(cols[1:], kinds, strict=True))], names=[*names, "line_no", "lang_code", "confidence", "letters"])

    extra = [T.StructField("line_no", T.IntegerType()), T.StructField("lang_code", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("letters", T.IntegerType())]
    return _pages(docs, samples, body_col, source_col, tuple(names)).mapInArrow(run, T.StructType([*(docs.schema[c] for c in names), *extra]))


def wrong_languages(docs: DataFrame, samples: DataFrame, id_col: str = "article_id", label_col: str = "language", body_col: str = "body", source_col: str | None = "source") -> DataFrame:
    """Distinct (id, line_no, lang_code): documents whose label is missing, unusable or wrong (line 0), and paragraphs in another language."""
    from pyspark.sql import types as T

    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(train_models(samples))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2_000):
            labels = b.column(1).to_pylist()
            rows, numbers, codes = [], [], []
            main = ""
            for i, line, code, sure, _ in own_languages(zip(*(b.column(2 + k).to_pylist() for k in range(4)), strict=True), shared.value):
                if line == 0:
                    main = code
                    case = label_language(labels[i]) != code
                else:
                    case = code != main and sure >= SURE
                if case:
                    rows.append(i)
                    numbers.append(line)
                    codes.append(code)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(codes, pa.string())], names=[id_col, "line_no", "lang_code"])

    schema = T.StructType([docs.schema[id_col], T.StructField("line_no", T.IntegerType()), T.StructField("lang_code", T.StringType())])
    return _pages(docs, samples, body_col, source_col, (id_col, label_col)).mapInArrow(run, schema).distinct()
