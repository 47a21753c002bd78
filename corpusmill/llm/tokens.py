"""Encoding a corpus with a public byte-level BPE tokenizer.

Frequent words are compiled once into a minimal acyclic transducer: an automaton whose equal suffixes
are shared and whose edges carry the number of words that sort before, so that a path yields the
word's rank and the rank its token ids. It is one flat file that executors receive once and
memory-map. Each Arrow batch looks up its distinct words together, byte position by byte position,
in numpy; words outside the lexicon are merged exactly by rank. The lexicon's size only changes
speed, never ids.
"""

from __future__ import annotations

import base64
import importlib.util
import os
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.runtime import ship, write_shared

# The split pattern the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for Java, whose classes need the Unicode flag for white space.
JAVA_PATTERN = r"(?U)" + PATTERN
VOCABULARY = "byte_bpe_50k.tiktoken"
LEXICON_WORDS = 50_000
#: Longer pieces are merged on the fly.
LONGEST_WORD = 40

_FILES: dict[str, Transducer] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    """The installed vocabulary file; CORPUSMILL_TOKENIZERS names another folder."""
    folder = os.environ.get("CORPUSMILL_TOKENIZERS")
    if not folder:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin) if spec else "/opt/tokenizers"
    return os.path.join(folder, name)


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Exact byte-pair merging, lowest rank first, leftmost among equals."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    parts = [word[i : i + 1] for i in range(len(word))]
    if len(parts) > 200:
        return _merge_long(parts, ranks)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _merge_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap and linked neighbours, for long pieces."""
    import heapq

    n = len(parts)
    left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i] if alive[i] else n
        if j >= n or parts[i] is not a or parts[j] is not b:
            continue
        parts[i] = a + b
        alive[j] = False
        right[i] = right[j]
        if right[i] < n:
            left[right[i]] = i
            if (r := ranks.get(parts[i] + parts[right[i]])) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[right[i]]))
        if left[i] >= 0 and (r := ranks.get(parts[left[i]] + parts[i])) is not None:
            heapq.heappush(heap, (r, left[i], parts[left[i]], parts[i]))
    return [ranks[p] for p, ok in zip(parts, alive, strict=True) if ok]


class Transducer:
    """Minimal acyclic automaton over bytes with word ranks on its edges and token ids by rank.

    Arrays: edge (state * 256 + byte, sorted), target (state), skip (words before), final (by state),
    start and ids (token ids of the word of each rank).
    """

    def __init__(self, edge: np.ndarray, target: np.ndarray, skip: np.ndarray, final: np.ndarray, start: np.ndarray, ids: np.ndarray):
        self.edge, self.target, self.skip, self.final, self.start, self.ids = edge, target, skip, final, start, ids

    @classmethod
    def compile(cls, words: list[bytes], outputs: list[list[int]]) -> Transducer:
        """From distinct words in byte order and their ids; equal suffixes end in one state (incremental minimisation)."""
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

        def freeze(node: list) -> int:
            sig = (node[0], tuple(node[1]))
            if sig not in register:
                register[sig] = len(states)
                states.append(sig)
            return register[sig]

        # path[i]: the still growing state after i bytes: [final, [(byte, frozen target)]]
        path: list[list] = [[False, []]]
        last = b""
        for w in words:
            common = 0
            while common < len(last) and common < len(w) and last[common] == w[common]:
                common += 1
            for i in range(len(last), common, -1):
                path[i - 1][1].append((last[i - 1], freeze(path.pop())))
            for _ in range(common, len(w)):
                path.append([False, []])
            path[-1][0] = True
            last = w
        for i in range(len(last), 0, -1):
            path[i - 1][1].append((last[i - 1], freeze(path.pop())))
        root = freeze(path[0])
        count = [0] * len(states)  # targets are frozen before their sources
        for s, (fin, edges) in enumerate(states):
            count[s] = fin + sum(count[t] for _, t in edges)
        edge, target, skip = [], [], []
        order = [root, *(s for s in range(len(states)) if s != root)]
        new = {s: i for i, s in enumerate(order)}
        for s in order:
            before = int(states[s][0])
            for byte, t in states[s][1]:
                edge.append(new[s] * 256 + byte)
                target.append(new[t])
                skip.append(before)
                before += count[t]
        final = np.array([states[s][0] for s in order], np.uint8)
        start = np.concatenate([[0], np.cumsum([len(o) for o in outputs])]).astype(np.int32)
        ids = np.array([i for o in outputs for i in o], np.int32)
        return cls(np.array(edge, np.int32), np.array(target, np.int32), np.array(skip, np.int32), final, start, ids)

    def to_bytes(self) -> bytes:
        arrays = [self.edge, self.target, self.skip, self.final, self.start, self.ids]
        head = struct.pack("<8sI", b"cmtrans1", len(arrays)) + b"".join(struct.pack("<cI", a.dtype.char.encode(), len(a)) for a in arrays)
        out = [head.ljust(128, b"\0")]
        for a in arrays:
            raw = a.tobytes()
            out.append(raw + b"\0" * (-len(raw) % 64))
        return b"".join(out)

    @classmethod
    def open(cls, path: str) -> Transducer:
        """Memory-mapped; pages are shared by all workers of a machine."""
        if path not in _FILES:
            m = np.memmap(path, np.uint8, "r")
            magic, n = struct.unpack_from("<8sI", m[:12].tobytes())
            if magic != b"cmtrans1":
                raise ValueError(f"{path} is no lexicon")
            at, arrays = 128, []
            for i in range(n):
                char, length = struct.unpack_from("<cI", m[12 + 5 * i : 17 + 5 * i].tobytes())
                dtype = np.dtype(char.decode())
                size = dtype.itemsize * length
                arrays.append(m[at : at + size].view(dtype))
                at += size + -size % 64
            _FILES[path] = cls(*arrays)
        return _FILES[path]

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """Ranks of the words, -1 for those outside; all words step through the automaton together."""
        rank = np.full(len(words), -1, np.int64)
        if not len(self.edge) or not words:
            return rank
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        active = np.nonzero((lengths > 0) & (lengths <= LONGEST_WORD))[0]
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        data = np.frombuffer(b"".join(words), np.uint8)
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        pos = 0
        while len(active):
            key = state[active] * 256 + data[starts[active] + pos]
            at = np.searchsorted(self.edge, key)
            at[at == len(self.edge)] = 0
            hit = self.edge[at] == key
            active, at = active[hit], at[hit]
            state[active] = self.target[at]
            total[active] += self.skip[at]
            pos += 1
            done = lengths[active] == pos
            ended = active[done]
            ended = ended[self.final[state[ended]] == 1]
            rank[ended] = total[ended]
            active = active[~done]
        return rank


def frequent_words(docs: DataFrame, text_col: str = "text", limit: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words of all documents, counted with map-side combining; limit bounds what comes to the driver."""
    words = docs.where(F.col(text_col).isNotNull()).select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(JAVA_PATTERN), F.lit(0))).alias("w"))
    words = words.where(F.octet_length("w").between(2, LONGEST_WORD))
    top = words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(limit)
    return [r[0] for r in top.select("w").collect()]


def publish_lexicon(spark: SparkSession, words: Iterable[str], vocabulary: str) -> str:
    """Compile the words, write the file to the shared folder and hand it to the executors; its name there."""
    ranks = load_ranks(vocabulary)
    ordered = sorted({w.encode() for w in words})
    data = Transducer.compile(ordered, [merge_word(w, ranks) for w in ordered]).to_bytes()
    name = f"lexicon-{xxhash.xxh3_64_hexdigest(data)}.bin"
    spark.sparkContext.addFile(write_shared(spark, name, data))
    return name


class Encoder:
    """Encodes texts in a worker with the mapped lexicon and exact merging for the rest."""

    def __init__(self, lexicon: Transducer, ranks: dict[bytes, int]):
        self.lexicon = lexicon
        self.split = regex.compile(PATTERN).findall
        self.unseen = lru_cache(maxsize=100_000)(lambda w: merge_word(w, ranks))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts; null and empty texts have no ids."""
        seen: dict[str, int] = {}
        flat: list[int] = []
        n_words = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                found = self.split(t)
                n_words[i] = len(found)
                flat += [seen.setdefault(w, len(seen)) for w in found]
        words = [w.encode() for w in seen]
        rank = self.lexicon.lookup(words)
        start, length = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        known = rank >= 0
        start[known] = self.lexicon.start[rank[known]]
        length[known] = self.lexicon.start[rank[known] + 1] - start[known]
        extra: list[int] = []
        for i in np.nonzero(~known)[0]:
            ids = self.unseen(words[i])
            start[i], length[i] = len(self.lexicon.ids) + len(extra), len(ids)
            extra += ids
        pool = np.concatenate([self.lexicon.ids, np.array(extra, np.int32)])
        use = np.array(flat, np.int64)
        lens = length[use]
        ends = np.cumsum(lens)
        ids = pool[np.repeat(start[use] - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)]
        per_word = np.concatenate([[0], ends])
        return np.concatenate([[0], per_word[np.cumsum(n_words)]]), ids


def _encoder(name: str, vocabulary: str) -> Encoder:
    return Encoder(Transducer.open(SparkFiles.get(name)), load_ranks(vocabulary))


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """(id, ids array<int>): the token ids of each text without special tokens, one row for each row of docs.

    Null and empty texts have the empty list. Strings of special tokens within a text are ordinary
    text. Repeated rows stay; other columns of docs are not read. No row moves: a narrow map.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = vocabulary or vocabulary_path()
    name = publish_lexicon(spark, frequent_words(docs, text_col, lexicon_words), vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, vocabulary)
        for b in batches:
            offsets, ids = encoder.encode(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def token_counts(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """docs with n_tokens (bigint), 0 for null and empty texts."""
    spark = docs.sparkSession
    ship(spark)
    vocabulary = vocabulary or vocabulary_path()
    name = publish_lexicon(spark, frequent_words(docs, text_col, lexicon_words), vocabulary)
    docs = docs.drop("n_tokens")
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, vocabulary)
        for b in batches:
            offsets, _ = encoder.encode(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.diff(offsets), pa.int64())], names=[*b.schema.names, "n_tokens"])

    from pyspark.sql import types as T

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType())]))
