"""Batches, tokens, mixing and quality: brute force, exact comparison and held-out accuracy."""

import random

import numpy as np
import pytest

from corpusmill.llm.boosting import BoostedTrees
from corpusmill.llm.incremental import GROUP_LIMITS, BatchIndex, Rarity, banded, batch_duplicates, close_pairs, copy_pairs, core_title, fit_rarity, letters, piece_keys, same_title, site_names
from corpusmill.llm.mixing import mix_sources, rake
from corpusmill.llm.quality import CALIBRATION, CHECK, FEATURES, HOLDOUT, calibration_error, fit_quality, junk_probability, text_statistics, weak_labels
from corpusmill.llm.tokens import Encoder, Transducer, encode_corpus, load_ranks, merge_word, token_counts, vocabulary_path

SEEN = "url_hash string, normalized_url string, source_id string, article_id string, first_seen string, batch_no int, simhash string"
HASHES = "simhash bigint, article_id string, source_id string, title string, seen_at string, batch_no int, key string"


def brute_pairs(seen, hashes, sites):
    from corpusmill.functions.url import canonical_url

    out = set()
    add = lambda a, b: out.add((min(a, b), max(a, b)))
    for i, x in enumerate(seen):
        for y in seen[:i]:
            ux, uy = canonical_url(x[1]) or (x[0] or "").lower(), canonical_url(y[1]) or (y[0] or "").lower()
            if x[3] and y[3] and x[3] != y[3] and x[5] != y[5] and ux and ux == uy:
                add(x[3], y[3])
    for i, x in enumerate(hashes):
        for y in hashes[:i]:
            if not x[1] or not y[1] or x[1] == y[1] or x[5] == y[5] or x[3] is None or y[3] is None or x[0] is None or y[0] is None:
                continue
            a, b = core_title(x[3], sites), core_title(y[3], sites)
            if x[0] == 0 and y[0] == 0 and letters(a) and letters(a) == letters(b):
                add(x[1], y[1])
            if x[0] and y[0] and bin((x[0] ^ y[0]) & (2**64 - 1)).count("1") <= 8 and same_title(a, b):
                add(x[1], y[1])
    return out


def make_batches(rng, n=350):
    words = ["council", "museum", "bridge", "old", "mill", "report", "the", "of", "a", "water", "lamps", "night", "buses"]
    seen, hashes = [], []
    for i in range(n):
        if i and rng.random() < 0.4:
            base = rng.choice(hashes)
            f, title = base[0], base[3] or "x"
            if f:
                f &= 2**64 - 1
                for bit in rng.sample(range(64), rng.choice([0, 2, 8, 9])):
                    f ^= 1 << bit
                f = f - (1 << 64) if f >= 1 << 63 else f
            edit = rng.random()
            title = "[Breaking] " + title if edit < 0.2 else title + " | Hoti Post" if edit < 0.4 else title.upper() if edit < 0.6 else title[:5] + title[6:] if edit < 0.8 else title + "!"
        else:
            f = 0 if rng.random() < 0.2 else rng.getrandbits(64) - (1 << 63)
            title = "Morning briefing" if rng.random() < 0.3 else " ".join(rng.sample(words, 5)) + f" {rng.randrange(500)} N{rng.randrange(10**4)}"
        hashes.append((f, f"a{i}", "s", title, None, rng.randrange(5), "k"))
        page = rng.randrange(200)
        url = rng.choice(["https://x.example/p/{}", "http://www.X.example:80/p/{}/", "https://x.example/p/{}?utm_source=m#f"]).format(page)
        seen.append((None, url, "s", f"a{i}", None, rng.randrange(5), "z"))
    hashes += [(None, "n1", None, None, None, None, None), (5, None, None, "t", None, 1, None), (0, "n2", "s", "", None, 1, None)]
    seen += [("ABC", None, None, "n1", None, None, None), ("abc", "", None, "n2", None, 2, None), (None, None, None, None, None, None, None)]
    return seen + seen[:20], hashes + hashes[:20]


def test_batch_duplicates_against_brute_force(spark):
    seen, hashes = make_batches(random.Random(5))
    sources = spark.createDataFrame([("s", "Hoti Post"), (None, None)], "source_id string, source_name string")
    ds, dh = spark.createDataFrame(seen, SEEN), spark.createDataFrame(hashes, HASHES)
    want = brute_pairs([tuple(-1 if i == 5 and v is None else v for i, v in enumerate(r)) for r in seen], hashes, site_names(sources))
    assert {tuple(r) for r in batch_duplicates(ds, dh, sources).collect()} == want and len(want) > 50
    assert batch_duplicates(ds.limit(0), dh.limit(0), sources).count() == 0


@pytest.mark.parametrize("level", [1, 2, 3, 4])
def test_bands_lose_no_pair(level):
    rng = random.Random(level)
    for _ in range(40):
        f = rng.getrandbits(64)
        g = f
        for bit in rng.sample(range(64), 8):
            g ^= 1 << bit
        assert set(banded(7, f, level)) & set(banded(7, g, level))


def test_large_groups_give_the_same_pairs(spark):
    rng = random.Random(9)
    rows = []
    for i in range(120):
        f = rng.choice(rows)[0] ^ (1 << rng.randrange(63)) if rows and i % 2 else rng.getrandbits(63)
        rows.append((f, f"a{i}", "s", "Morning briefing", None, i % 7, None))
    df = spark.createDataFrame(rows, HASHES)
    small = Rarity([r[3] for r in rows], len(rows), frozenset())
    found = []
    for scale in (1, GROUP_LIMITS[0] + 1, GROUP_LIMITS[1] + 1):
        r = Rarity([x[3] for x in rows], len(rows) * scale, frozenset())
        keys = piece_keys(df, r)
        found.append({tuple(sorted((x.ra, x.rb))) for x in close_pairs(keys, keys).collect()})
    assert small.base == 0 and found[0] == found[1] == found[2] and len(found[0]) > 20


def test_rarity_is_counted_over_all_rows(spark):
    fill = spark.range(45_000).selectExpr("concat('n', id) as article_id", "concat('W', id div 2, ' the old V', id, ' mill U', id) as title")
    many = spark.range(GROUP_LIMITS[0] + 1).selectExpr("concat('a', id) as article_id", "'Breaking: Alfa bravo' as title")
    few = spark.range(GROUP_LIMITS[0]).selectExpr("concat('c', id) as article_id", "'gamma delta' as title")
    unused = spark.range(9).selectExpr("if(id < 5, null, concat('x', id)) as article_id", "if(id < 5, 'gamma delta', null) as title")
    df = fill.union(many).union(few).union(unused).selectExpr("1L as simhash", "*", "1 as batch_no")
    df = df.union(spark.createDataFrame([(0, "z", "gamma delta", 1)], df.schema))
    r = fit_rarity(df, frozenset())
    whole = Rarity([t for i, t in df.where("simhash <> 0").select("article_id", "title").collect() if i and t], 45_801, frozenset())
    assert r.base == 0 and r.levels == whole.levels == dict.fromkeys(whole.pieces("alfa bravo"), 1) and len(r.levels) == 3
    for title in ("w7 the old v15 mill u15", "gamma delta", "alfa gamma w3", "", "unheard of"):
        assert r.pieces(title) == whole.pieces(title)
    assert [r.rank(w)[0] for w in ("the", "w7", "v15", "alfa", "gamma", "unheard")] == [45_000, 2, 0, 401, 400, 0]


def test_rarity_of_an_earlier_index_is_read():
    titles = ["the old mill"] * 3 + ["an old bridge at the mill", "new"]
    r = Rarity(titles, 5, frozenset())
    old = Rarity.__new__(Rarity)
    old.__setstate__({"sites": frozenset(), "counts": {"the": 4, "old": 4, "mill": 4}, "levels": {}, "base": 0})
    assert [old.pieces(t) for t in titles] == [r.pieces(t) for t in titles]


def test_index_of_batches(spark, tmp_path):
    seen, hashes = make_batches(random.Random(6), 150)
    sites = frozenset(["hoti post"])
    rarity = Rarity([h[3] for h in hashes], len(hashes), sites)
    index = BatchIndex(spark, f"file://{tmp_path}/index", rarity, buckets=4)
    got = set()
    for batch in range(5):
        s = spark.createDataFrame([r for r in seen if r[5] == batch], SEEN)
        h = spark.createDataFrame([r for r in hashes if r[5] == batch], HASHES)
        index = BatchIndex(spark, index.path)  # opened again, with the stored rarity and buckets
        index.append(batch, s, h)
        got |= {tuple(r) for r in index.duplicates(batch).collect()}
    kept = [r for r in seen if r[5] is not None], [r for r in hashes if r[5] is not None]
    assert index.buckets == 4 and got == brute_pairs(*kept, sites) and len(got) > 20


def test_stored_side_is_not_moved(spark, tmp_path):
    index = BatchIndex(spark, f"file://{tmp_path}/index", Rarity([], 0, frozenset()), buckets=4)
    seen, hashes = make_batches(random.Random(7), 60)
    for batch in (0, 1):
        index.append(batch, spark.createDataFrame(seen, SEEN), spark.createDataFrame(hashes, HASHES))
    for join, table in ((copy_pairs, "copies"), (close_pairs, "pieces")):
        new, old = (index.stored(table).where(f"batch_no = {b}").drop("batch_no") for b in (1, 0))
        plan = join(new, old)._jdf.queryExecution().executedPlan().toString().split("\n")
        scans = [i for i, x in enumerate(plan) if "Scan parquet" in x and table in x]
        assert len(scans) == 2
        for at in scans:
            assert "Bucketed: true" in plan[at] and "batch_no" in plan[at].split("PartitionFilters")[1]
            depth = len(plan[at]) - len(plan[at].lstrip(" :+-"))
            above = []  # the ancestors of the scan
            for x in reversed(plan[:at]):
                d = len(x) - len(x.lstrip(" :+-"))
                if d < depth:
                    above.append(x)
                    depth = d
            join_at = next(i for i, x in enumerate(above) if "Join" in x)
            assert not any("Exchange" in x or "Sort " in x for x in above[:join_at]), "\n".join(plan)


def test_titles():
    sites = frozenset(["hoti post"])
    same = ["The museum opened – again", "[Breaking] The museum opened – again", "THE MUSEUM OPENED - AGAIN!", "The  museum opened – again | Hoti Post", "Live: The museum opened – again (photos)", "The musseum opened – again", "The museumopened – again"]
    for x in same:
        assert same_title(core_title(same[0], sites), core_title(x, sites)), x
    assert not same_title(core_title("The museum closed – again", sites), core_title(same[0], sites))
    assert core_title(None) == "" and letters(core_title("  ")) == ""


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(vocabulary_path())


def reference_ids(texts):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


TEXTS = ["", " ", "\n\n \t x  ", "<|endoftext|> it's 2024", "한국어 텍스트 " * 40, "ab" * 301 + "é" * 50, "🙂🙂 x\x85y\xa0z　", "The quick brown fox, isn't it? " * 30, "1234567 89", "Ünïcödé’s « test »"]


def test_encoder_matches_the_tokenizer(ranks):
    words = sorted({b" the", b"the", b" quick", b" brown", b"The", b" test", b" tests", b"test"})
    for lexicon in (Transducer.compile([], []), Transducer.compile(words, [merge_word(w, ranks) for w in words])):
        offsets, ids = Encoder(lexicon, ranks).encode(TEXTS)
        assert [list(ids[offsets[i] : offsets[i + 1]]) for i in range(len(TEXTS))] == reference_ids(TEXTS)


def test_transducer_is_a_minimal_perfect_map(tmp_path):
    rng = random.Random(4)
    words = sorted({bytes(rng.choices(b"abc", k=rng.randint(1, 7))) for _ in range(500)})
    t = Transducer.compile(words, [[i, i + 1] for i in range(len(words))])
    path = tmp_path / "lexicon.bin"
    path.write_bytes(t.to_bytes())
    t = Transducer.open(str(path))
    assert list(t.lookup(words)) == list(range(len(words)))
    others = [w for w in (bytes(rng.choices(b"abcd", k=rng.randint(0, 8))) for _ in range(300)) if w not in set(words)]
    assert (t.lookup(others) == -1).all()
    assert len(t.final) < len({w[:i] for w in words for i in range(len(w) + 1)})  # suffixes are shared


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, item_id bigint, ids string, n_tokens string")


def test_corpus_ids(spark):
    rows = [(i, t, "s", None, 1, "clash", "clash") for i, t in enumerate(TEXTS)] + [(99, None, None, None, None, None, None), (99, None, None, None, None, None, None), (None, "a", None, None, None, None, None)]
    d = docs(spark, rows)
    got = {(r.doc_id, tuple(r.ids)) for r in encode_corpus(d).collect()}
    assert got == {(i, tuple(x)) for i, x in enumerate(reference_ids(TEXTS))} | {(99, ()), (None, tuple(reference_ids(["a"])[0]))}
    assert encode_corpus(d).count() == len(rows) and encode_corpus(d.limit(0)).count() == 0
    assert {r.doc_id: r.n_tokens for r in token_counts(d).where("doc_id = 99").collect()} == {99: 0}


def test_rake_meets_the_margins():
    rng = np.random.default_rng(1)
    tokens = rng.integers(50, 500, 60).astype(float)
    source = np.arange(60) % 3
    lang, topic = np.arange(60) // 3 % 4, np.arange(60) // 12
    share, cap = np.array([0.5, 0.3, 0.2]), np.array([3.0, 4.0, 2.0])
    w, total = rake(tokens, source, [lang, topic], share, cap)
    assert (w <= cap[source] + 1e-9).all() and (w >= 0).all()
    assert np.allclose(np.bincount(source, w * tokens) / total, share, atol=1e-6)


def test_mix(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["red", "lamp", "works", "fine", "never"], k=rng.randint(3, 30))), rng.choice(["a"] * 8 + ["b", "c"]), rng.choice(["en", "EN", None]), rng.randrange(4), "", "") for i in range(2500)]
    rows += [(9001, None, "a", None, None, None, None), (9002, "", "a", None, None, None, None), (9003, "x y", "zz", None, None, None, None), (9004, "x y", None, None, None, None, None)]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 3), ("gone", 0.0, 2)], "source string, target_share double, max_repeats int")
    topics = spark.createDataFrame([(k, f"t{k % 2}") for k in range(3)], "item_id bigint, category string")
    mix = mix_sources(docs(spark, rows), targets, topics)
    records, shares = mix.records.collect(), {r.source: r for r in mix.shares.collect()}
    assert len(shares) == 4 and abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-9
    for name, share, cap in (("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 3)):
        assert abs(shares[name].actual_share - share) < 0.01
        assert max(r.copies for r in records if r.source == name) <= cap
    assert not {r.doc_id for r in records} & {9001, 9002, 9003, 9004}
    empty = mix_sources(docs(spark, rows).limit(0), targets, topics)
    assert empty.records.count() == 0 and {r.actual_share for r in empty.shares.collect()} == {0.0}


def test_boosting_learns_and_is_calibrated():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = BoostedTrees().fit(x[:2000], y[:2000]).calibrate(x[2000:2500], y[2000:2500])
    p = m.probability(x[2500:])
    assert ((p > 0.5) == y[2500:]).mean() > 0.95 and ((p >= 0) & (p <= 1)).all()


def test_statistics_of_hand_texts(spark):
    d = docs(spark, [(1, "One two, 3.\nfour", "s", None, None, None, None), (2, None, None, None, None, None, None), (3, " \n", None, None, None, None, None), (4, "x" * 200_000, None, None, None, None, None)])
    got = {r.doc_id: r for r in text_statistics(d).collect()}
    r = got[1]
    assert (r.n_words, r.n_lines, r.longest_word) == (4, 2, 4)
    assert r.mean_word_length == pytest.approx(13 / 4) and r.symbol_ratio == pytest.approx(2 / 13) and r.punctuated_line_share == 0.5
    assert all(got[i][f] == 0 for i in (2, 3) for f in FEATURES) and got[4].longest_word == 200_000
    assert text_statistics(d.limit(0)).count() == 0


def test_quality_model_on_other_texts(spark):
    rng = random.Random(11)
    subject, verb, tail = ["The kettle", "This lamp", "My tent", "The bag"], ["works", "broke", "leaks", "surprised me"], ["after a week.", "and I like it.", "in the rain.", "but it was cheap."]
    prose = [" ".join(f"{rng.choice(subject)} {rng.choice(verb)} {rng.choice(tail)}" for _ in range(rng.randint(1, 5))) for _ in range(200)]
    junk = ["; ".join(f"k{rng.randrange(99)}={rng.randrange(999)}" for _ in range(9)) for _ in range(60)] + ["\n".join(f"{rng.choice(['W', 'H'])} | {rng.randrange(900)} | cm" for _ in range(6)) for _ in range(60)]
    rows = [(i, t, "s", None, None, None, None) for i, t in enumerate(prose + junk)] + [(999, None, None, None, None, None, None)]
    p = {r.doc_id: r.p_junk for r in junk_probability(docs(spark, rows)).collect()}
    truth = {i: i >= len(prose) for i in range(len(prose + junk))}
    assert sum((p[i] > 0.5) == t for i, t in truth.items()) / len(truth) > 0.97 and p[999] == 0
    assert junk_probability(docs(spark, rows).limit(0)).count() == 0 and len(HOLDOUT) >= 100
    assert not {t for t, _ in CALIBRATION} & {t for t, _ in CHECK}
    few = fit_quality(text_statistics(docs(spark, rows).where('doc_id < 30')))  # too few of a class: CHECK teaches, CALIBRATION tells
    right, squared, gap = calibration_error(few, spark, CALIBRATION)
    assert right > 0.85 and squared < 0.12 and gap < 0.2


def test_calibration_settles_in_spite_of_outliers():
    import numpy as np

    rng = np.random.default_rng(0)
    raw, k = np.concatenate([rng.normal(-6, 1, 27), rng.normal(6, 1, 25), [-6.1, -5.6]]), np.concatenate([np.zeros(27), np.ones(27)])
    model = BoostedTrees()
    model.score = lambda x: x
    model.calibrate(raw, k)
    p = model.probability(raw)
    t = np.where(k > 0, 28 / 29, 1 / 29)
    q = lambda a: model.odd + (1 - 2 * model.odd) / (1 + np.exp(-a * raw))
    loss = lambda a: -(t * np.log(q(a)) + (1 - t) * np.log(1 - q(a))).sum()
    assert loss(model.scale) <= min(map(loss, np.linspace(0.02, 3, 300))) + 0.01 and ((p > 0.5) == (raw > 0)).all()


def test_signals_leave_a_part_to_the_trees(spark):
    import numpy as np

    x = np.array([[float(v) for v in r] for r in text_statistics(docs(spark, [(i, t, 's', None, None, None, None) for i, (t, _) in enumerate(HOLDOUT)])).orderBy('doc_id').select(*FEATURES).collect()])
    weak = weak_labels(x)
    truth = np.array([k for _, k in HOLDOUT])
    assert (weak < 0).mean() > 0.1 and (weak == truth)[weak >= 0].mean() > 0.95
