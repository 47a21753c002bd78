"""Deduplicating new batches against all history.

Every accepted row leaves compact keys in an index of tables bucketed by key: the hash of its canonical
address, for rows without fingerprint the hash of its title, and for the others hashes of title pieces
(pairs of its rarest words), where the row's fingerprint travels along. The tables hold no body, so
the pieces of a title stand for the paragraphs. A new batch is hashed the same way and joined with
the index bucket by bucket; only rows that share a key are looked at, and nothing stored is hashed,
shuffled or rewritten again. Equal addresses and equal titles are full copies; shared title pieces
are partial coverage and are verified by Hamming distance inside the join and by the titles after it.
A batch's hashes are appended first and joined with those of the batches before it.

A pair of titles that differ by one typo and known labels keeps at least three of its four rarest
words, so it shares a piece; titles of fewer words have their two ends as pieces too. Which words are rare and which pieces many rows share is
counted over all rows. Pieces that a share of all rows have in common (recurring
titles) are refined with fingerprint bands: with at most 8 differing bits, of 9, 10, 11 or 12 bands
at least 1, 2, 3 or 4 stay equal, so all combinations of that many bands are keys and no pair is
lost, whatever the size of the group.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, reduce
from itertools import combinations
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.url import canonical_url
from corpusmill.runtime import read_file, settle, shared_dir, ship, write_file

MAX_BITS = 8
#: Keys that a task counts before it hands the counts on.
HELD_KEYS = 200_000
RAREST_WORDS = 4
#: Expected rows of a group up to which no bands, 1 of 9, 2 of 10, 3 of 11 bands are used; beyond, 4 of 12.
GROUP_LIMITS = (400, 16_000, 500_000, 16_000_000)
#: Buckets of a stored index, and how batch_duplicates chooses them.
BUCKETS, ROWS_A_BUCKET, MAX_BUCKETS = 64, 100_000, 16_384
#: Names of sources that may be collected.
SITE_NAMES = 100_000

# Labels that editors put before or behind a title.
LABELS = (
    "breaking", "breaking news", "update", "updated", "live", "live blog", "exclusive", "video", "watch", "photo", "photos", "in pictures", "gallery", "audio", "podcast", "opinion", "analysis", "just in", "developing", "corrected",
    "eilmeldung", "eil", "exklusiv", "aktualisiert", "fotos", "bilder", "liveticker", "kommentar",
    "direct", "en direct", "exclusif", "vidéo", "urgent", "mise à jour", "mis à jour",
    "última hora", "urgente", "en vivo", "en directo", "exclusiva", "exclusivo", "actualización", "actualizado", "vídeo", "fotogalería", "opinión",
    "ao vivo", "atualização", "atualizado", "opinião",
    "срочно", "эксклюзив", "обновлено", "обновление", "видео", "фото", "онлайн", "прямой эфир",
    "속보", "단독", "종합", "영상", "사진", "포토", "라이브", "업데이트", "동영상",
)
_LABEL = "|".join(re.escape(x) for x in sorted(LABELS, key=len, reverse=True))
_FRONT = re.compile(rf"^\s*(?:[\[(【<](?:{_LABEL})[\])】>]\s*[:–—-]?|(?:{_LABEL})\s*(?::|–|—|-(?=\s)|\|))\s*")
_BACK = re.compile(rf"\s*(?:[\[(【<](?:{_LABEL})[\])】>]|(?:–|—|-|\||:|»|·)\s*(?:{_LABEL}))\s*$")
_SITE_TAIL = re.compile(r"\s(?:\||»|·|–|—|-)\s*([^|»·]{2,40})$")
_PUNCT_TAIL = re.compile(r"[\s!.…?]+$")
_WORD = re.compile(r"[^\W_]+")


def core_title(title: str | None, sites: frozenset[str] = frozenset()) -> str:
    """The title in lower case without labels, site names and punctuation at the end; '' for null."""
    if not title:
        return ""
    text = unicodedata.normalize("NFKC", title).casefold()
    if any(c in text for c in "|»·–—-[](){}【】:!….?") or text[:1].isspace() or text[-1:].isspace():
        for _ in range(4):
            before = text
            text = _FRONT.sub("", text, count=1)
            text = _PUNCT_TAIL.sub("", text) or text
            text = _BACK.sub("", text, count=1)
            m = _SITE_TAIL.search(text)
            if m and (m[1].strip() in sites or (m[0].strip()[0] in "|»" and m.start() > 8)):
                text = text[: m.start()]
            if text == before:
                break
    return text


def letters(core: str) -> str:
    return "".join(_WORD.findall(core))


def same_title(a: str, b: str) -> bool:
    """Whether two cores are the same title but for spacing, punctuation, a short suffix or a typo (at most two edits)."""
    x, y = letters(a), letters(b)
    if x == y:
        return True
    if len(x) > len(y):
        x, y = y, x
    if len(x) < 12:
        return False
    if len(y) - len(x) <= 12 and (y.startswith(x) or y.endswith(x)):
        return True
    p = 0
    while p < len(x) and x[p] == y[p]:
        p += 1
    q = 0
    while q < len(x) - p and x[-1 - q] == y[-1 - q]:
        q += 1
    x, y = x[p : len(x) - q], y[p : len(y) - q]
    if len(y) - len(x) > 2:
        return False
    if len(y) <= 2:
        return True
    row = list(range(len(y) + 1))
    for i, cx in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, cy in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (cx != cy))
        if min(row) > 2:
            return False
    return row[-1] <= 2


@lru_cache(maxsize=200_000)
def _word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word)


def _mix(*parts: int) -> int:
    return xxhash.xxh3_64_intdigest(b"".join(p.to_bytes(8, "little") for p in parts))


class Rarity:
    """How many titles have each word, and the levels of the pieces that many rows share, in a form that goes to the executors.

    Words of one title and pieces of level 0 (at most GROUP_LIMITS[0] rows) aren't stored, as having no
    entry says the same of them. Words are kept as sorted hashes with their counts, 16 bytes each.
    """

    def __init__(self, titles: list[str | None], total: int, sites: frozenset[str]):
        """Counted over a list of titles, each of which stands for total / len(titles) rows; fit_rarity counts a table."""
        counts = Counter(w for t in titles for w in set(_WORD.findall(core_title(t, sites))))
        scale = total / max(1, len(titles))
        self._set(sites, {_word_hash(w): n for w, n in counts.items() if n > 1}, {}, self._level(scale))
        pieces = Counter(p for t in titles for p in self.pieces(core_title(t, sites)))
        self.levels = {p: lv for p, n in pieces.items() if n > 1 and (lv := self._level(n * scale)) > self.base}

    def _set(self, sites: frozenset[str], counts: dict[int, int] | tuple[np.ndarray, np.ndarray], levels: dict[int, int], base: int) -> None:
        hashes, n = (np.fromiter(counts, np.uint64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts))) if isinstance(counts, dict) else counts
        order = np.argsort(hashes)
        self.sites, self.hashes, self.counts, self.levels, self.base = sites, hashes[order], n[order], levels, base
        self._ranks: dict[str, tuple[int, int]] = {}

    @classmethod
    def counted(cls, sites: frozenset[str], words: tuple[np.ndarray, np.ndarray], pieces: dict[int, int]) -> Rarity:
        """Of counts over all rows: (hashes, counts) of the words of more than one title, and rows of pieces."""
        out = cls.__new__(cls)
        out._set(sites, words, {p: lv for p, n in pieces.items() if (lv := cls._level(n))}, 0)
        return out

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_ranks": {}}

    def __setstate__(self, state: dict) -> None:
        if isinstance(state["counts"], dict):  # of an index stored earlier: the words themselves
            self._set(state["sites"], {_word_hash(w): n for w, n in state["counts"].items()}, state["levels"], state["base"])
        else:
            self.__dict__.update(state)

    @staticmethod
    def _level(rows: float) -> int:
        return sum(rows > limit for limit in GROUP_LIMITS)

    def rank(self, word: str) -> tuple[int, int]:
        """The titles that have the word, 0 for one, and its hash."""
        found = self._ranks.get(word)
        if found is None:
            if len(self._ranks) >= HELD_KEYS:
                self._ranks.clear()
            h = _word_hash(word)
            at = int(np.searchsorted(self.hashes, np.uint64(h)))
            found = self._ranks[word] = (int(self.counts[at]) if at < len(self.hashes) and int(self.hashes[at]) == h else 0, h)
        return found

    def pieces(self, core: str, least: int = 0) -> list[int]:
        """The pieces of a title; pairs only of words that at least `least` titles have."""
        found = _WORD.findall(core)
        words = sorted(map(self.rank, set(found)))[:RAREST_WORDS]
        hashes = [h for n, h in words if n >= least]
        out = [_mix(min(a, b), max(a, b)) for a, b in combinations(hashes, 2)]
        if len(words) < RAREST_WORDS:  # an edit may touch all pairs of so few words, but not both ends of the title
            whole = "".join(found)
            out += [_mix(1, _word_hash(whole[:6])), _mix(2, _word_hash(whole[-6:]))]
        return out

    def keys(self, core: str, fingerprint: int) -> list[int]:
        out: list[int] = []
        for p in self.pieces(core):
            level = self.levels.get(p, self.base)
            if not level:
                out.append(p)
            else:
                out += banded(p, fingerprint, level)
        return out


@lru_cache(maxsize=8)
def _combos(level: int) -> list[tuple[int, ...]]:
    return list(combinations(range(MAX_BITS + level), level))


def banded(piece: int, fingerprint: int, level: int) -> list[int]:
    """Keys of the piece with every choice of `level` of MAX_BITS + level bands of the 64 bits."""
    n = MAX_BITS + level
    f = fingerprint & 0xFFFFFFFFFFFFFFFF
    edges = [64 * i // n for i in range(n + 1)]
    parts = [(f >> edges[i]) & ((1 << (edges[i + 1] - edges[i])) - 1) for i in range(n)]
    return [_mix(piece, *(c << 32 | parts[c] for c in combo)) for combo in _combos(level)]


def _digest(tag: str, text: str) -> bytes:
    return xxhash.xxh3_128_digest(tag + text)


COPY_SCHEMA = "key binary, article_id string"
PIECE_SCHEMA = "key bigint, rid bigint, simhash bigint"
TITLE_SCHEMA = "rid bigint, simhash bigint, article_id string, core string"


def _url_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = []
        for url, given in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            page = canonical_url(url)
            keys.append(_digest("u", page) if page else _digest("h", given.lower()) if given else None)
        out = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), b.column(0)], names=["key", "article_id"])
        yield out.filter(out.column(0).is_valid())


def url_keys(seen: DataFrame) -> DataFrame:
    """Full-copy keys of seen_urls: canonical address, or url_hash where there is no usable address. Null ids and rows without both are left out."""
    ship(seen.sparkSession)
    rows = seen.where("article_id is not null").select("article_id", "normalized_url", "url_hash")
    return rows.mapInArrow(_url_batches, COPY_SCHEMA)


def title_copy_keys(hashes: DataFrame, sites: frozenset[str]) -> DataFrame:
    """Full-copy keys of rows whose fingerprint is 0: the letters of the title."""
    ship(hashes.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [_digest("t", x) if (x := letters(core_title(t, sites))) else None for t in b.column(1).to_pylist()]
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), b.column(0)], names=["key", "article_id"])
            yield out.filter(out.column(0).is_valid())

    rows = hashes.where("simhash = 0 and article_id is not null and title is not null")
    return rows.select("article_id", "title").mapInArrow(run, COPY_SCHEMA)


def _tally(titles: DataFrame, keys: Callable[[str], Iterable[int]], more_than: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys (64 bits) that come up more than so often in all titles, and how often; summed up in each task and by a shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[int] = Counter()

        def out() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(np.fromiter(held, np.uint64, len(held)).view(np.int64)), pa.array(held.values(), pa.int64())], names=["key", "n"])
            held.clear()
            return found

        for b in batches:
            for t in b.column(0).to_pylist():
                held.update(keys(t))
                if len(held) > HELD_KEYS:
                    yield out()
        yield out()

    found = titles.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > more_than).toArrow()
    return found["key"].to_numpy().view(np.uint64), found["n"].to_numpy()


def fit_rarity(hashes: DataFrame, sites: frozenset[str]) -> Rarity:
    """Counted over the titles of all rows that get title pieces: first the words, then the pieces that may have more than GROUP_LIMITS[0] rows.

    No piece has more rows than either of its words, so pairs with a word of fewer needn't be counted. The
    driver receives the words of more than one title and the pieces beyond the limit.
    """
    spark = hashes.sparkSession
    ship(spark)
    titles = hashes.where("simhash <> 0 and article_id is not null and title is not null").select("title")
    words = _tally(titles, lambda t: map(_word_hash, set(_WORD.findall(core_title(t, sites)))), 1)
    shared = spark.sparkContext.broadcast(Rarity.counted(sites, words, {}))
    pieces = _tally(titles, lambda t: shared.value.pieces(core_title(t, sites), GROUP_LIMITS[0] + 1), GROUP_LIMITS[0])
    return Rarity.counted(sites, words, dict(zip(*(x.tolist() for x in pieces), strict=True)))


def piece_keys(hashes: DataFrame, rarity: Rarity) -> DataFrame:
    """Title-piece keys of rows with a fingerprint other than 0; rid stands for the article id."""
    spark = hashes.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(rarity)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = shared.value
        for b in batches:
            found = [r.keys(core_title(t, r.sites), s) for t, s in zip(b.column(2).to_pylist(), b.column(1).to_pylist(), strict=True)]
            n = np.fromiter(map(len, found), np.int64, len(found))
            at = pa.array(np.repeat(np.arange(len(found)), n))
            keys = np.array([k for f in found for k in f], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), *(b.column(i).take(at) for i in range(2))], names=["key", "rid", "simhash"])

    rows = hashes.where("simhash <> 0 and article_id is not null and title is not null")
    return rows.select(F.xxhash64("article_id").alias("rid"), "simhash", "title").mapInArrow(run, PIECE_SCHEMA)


def title_rows(hashes: DataFrame, sites: frozenset[str]) -> DataFrame:
    """(rid, simhash, article_id, core) of rows with a fingerprint other than 0."""
    ship(hashes.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([core_title(t, sites) for t in b.column(3).to_pylist()], pa.string())], names=["rid", "simhash", "article_id", "core"])

    rows = hashes.where("simhash <> 0 and article_id is not null and title is not null")
    return rows.select(F.xxhash64("article_id").alias("rid"), "simhash", "article_id", "title").mapInArrow(run, TITLE_SCHEMA)


def copy_pairs(new: DataFrame, stored: DataFrame) -> DataFrame:
    """(a, b) of article ids, a < b, of a new and a stored row with an equal full-copy key."""
    a, b = new.alias("a").hint("shuffle_hash"), stored.alias("b")
    found = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.article_id") != F.col("b.article_id")))
    return found.select(F.least("a.article_id", "b.article_id").alias("article_id_a"), F.greatest("a.article_id", "b.article_id").alias("article_id_b"))


def close_pairs(new: DataFrame, stored: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(ra, sa, rb, sb), each once, of new rows a and stored rows b that share a piece and differ in at most max_bits bits."""
    a, b = new.alias("a").hint("shuffle_hash"), stored.alias("b")
    on = (F.col("a.key") == F.col("b.key")) & (F.bit_count(F.col("a.simhash").bitwiseXOR(F.col("b.simhash"))) <= max_bits) & (F.col("a.rid") != F.col("b.rid"))
    return a.join(b, on).select(F.col("a.rid").alias("ra"), F.col("a.simhash").alias("sa"), F.col("b.rid").alias("rb"), F.col("b.simhash").alias("sb")).distinct()


def verified_pairs(close: DataFrame, new: DataFrame, stored: DataFrame) -> DataFrame:
    """The article ids of the close pairs whose titles are the same but for small edits; new and stored are title rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [same_title(x, y) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["x", "y"]).filter(pa.array(keep, pa.bool_()))

    a, b = (rows.select(*(F.col(c).alias(f"{c}_{x}") for c in ("rid", "simhash", "article_id", "core"))) for rows, x in ((new, "a"), (stored, "b")))
    # the fingerprints are compared as a plain condition, so that the stored side's buckets by rid can serve the join
    found = close.join(a, (F.col("ra") == F.col("rid_a")) & (F.col("sa").bitwiseXOR(F.col("simhash_a")) == 0)).join(b, (F.col("rb") == F.col("rid_b")) & (F.col("sb").bitwiseXOR(F.col("simhash_b")) == 0))
    found = found.where("article_id_a <> article_id_b").select("article_id_a", "article_id_b", "core_a", "core_b").mapInArrow(run, "x string, y string")
    return found.select(F.least("x", "y").alias("article_id_a"), F.greatest("x", "y").alias("article_id_b"))


def site_names(sources: DataFrame, max_names: int = SITE_NAMES) -> frozenset[str]:
    """Names of the sources as they may stand in titles; more than max_names are an error."""
    names = sources.select("source_name").distinct().limit(max_names + 1).collect()
    if len(names) > max_names:
        raise ValueError(f"more than {max_names} names of sources: they are held by every worker")
    return frozenset(" ".join(unicodedata.normalize("NFKC", r[0]).casefold().split()) for r in names if r[0])


class BatchIndex:
    """The stored index: three tables bucketed by their key and partitioned by batch, and the fitted rarity beside them.

    copies (full-copy keys) and pieces (title pieces with fingerprints) are bucketed by key, titles by
    the hash of the article id. A batch is hashed, moved once to its buckets and appended as a
    partition; nothing stored is read or rewritten for that. Its duplicates come from joining its
    partition with those of the batches of lower numbers, bucket by bucket: neither side is shuffled
    or sorted, whatever their sizes. All batches use one rarity, since it decides which pieces a title
    has; an index that exists is opened with its own.
    """

    TABLES = (("copies", "key", COPY_SCHEMA), ("pieces", "key", PIECE_SCHEMA), ("titles", "rid", TITLE_SCHEMA))

    def __init__(self, spark: SparkSession, path: str, rarity: Rarity | None = None, buckets: int = BUCKETS):
        ship(spark)
        self.spark, self.path = spark, path.rstrip("/")
        stored = read_file(spark, f"{self.path}/index.pickle")
        if stored is None:
            if rarity is None:
                raise ValueError("a new index needs a fitted rarity")
            stored = pickle.dumps((rarity, buckets))
            write_file(spark, f"{self.path}/index.pickle", stored)
        self.rarity, self.buckets = pickle.loads(stored)
        tag = xxhash.xxh3_64_hexdigest(self.path)
        self.names = {}
        for name, key, schema in self.TABLES:
            self.names[name] = f"corpusmill_{name}_{tag}"
            spark.sql(f"create table if not exists {self.names[name]} ({schema}, batch_no int) using parquet partitioned by (batch_no) clustered by ({key}) into {self.buckets} buckets location '{self.path}/{name}'")

    def stored(self, name: str) -> DataFrame:
        return self.spark.table(self.names[name])

    def append(self, batch: int, seen: DataFrame, hashes: DataFrame) -> None:
        sites = self.rarity.sites
        rows = {"copies": url_keys(seen).union(title_copy_keys(hashes, sites)), "pieces": piece_keys(hashes, self.rarity), "titles": title_rows(hashes, sites)}
        for name, key, _ in self.TABLES:
            moved = rows[name].repartition(self.buckets, key).distinct()  # the partitioning by the key serves distinct too
            moved.withColumn("batch_no", F.lit(batch).cast("int")).write.insertInto(self.names[name])
            self.spark.catalog.refreshTable(self.names[name])

    def duplicates(self, batch: int) -> DataFrame:
        """Distinct (article_id_a, article_id_b) of a batch's rows with those of all batches before it, verified."""
        new, old = ({name: self.stored(name).where(cond).drop("batch_no") for name in self.names} for cond in (F.col("batch_no") == batch, F.col("batch_no") < batch))
        close = close_pairs(new["pieces"], old["pieces"])
        return copy_pairs(new["copies"], old["copies"]).union(verified_pairs(close, new["titles"], old["titles"])).distinct()


def batch_duplicates(seen: DataFrame, hashes: DataFrame, sources: DataFrame, path: str | None = None) -> DataFrame:
    """Distinct (article_id_a, article_id_b), a < b: the same article in two different batches.

    The batches are taken in order: each is hashed, appended to the index and joined with what was
    there before. Null ids are left out; a null batch_no is a batch of its own, the first; null titles,
    addresses and fingerprints give no key of their kind; repeated rows count once; empty tables give
    no rows. path: where the index is kept; in the shared folder without it.
    """
    spark = seen.sparkSession
    seen, hashes = (x.withColumn("batch_no", F.coalesce(F.col("batch_no").cast("int"), F.lit(-1))) for x in (seen, hashes))
    sizes = {r[0]: r[1] for r in seen.select("batch_no").union(hashes.select("batch_no")).groupBy("batch_no").count().collect()}
    buckets = min(max(sum(sizes.values()) // ROWS_A_BUCKET, 6), MAX_BUCKETS)
    rarity = fit_rarity(hashes, site_names(sources))
    index = BatchIndex(spark, path or f"{shared_dir(spark).rstrip('/')}/batches-{uuid4().hex}", rarity, buckets)
    found = []
    for at, batch in enumerate(sorted(sizes)):
        index.append(batch, seen.where(F.col("batch_no") == batch), hashes.where(F.col("batch_no") == batch))
        if at:
            found.append(settle(index.duplicates(batch)))
    if not found:
        return spark.createDataFrame([], "article_id_a string, article_id_b string")
    return reduce(DataFrame.union, found).distinct()
