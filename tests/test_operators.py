"""Core operators: hand cases, brute force and invariants."""

import math
import random
import re
from collections import Counter
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import markup as M
from corpusmill.functions import text as X
from corpusmill.functions.url import canonical_url
from corpusmill.operators import cascade, graph, insights, kernels, quality, relational, serving, signals
from corpusmill.runtime import settle
from corpusmill.sources import files, sinks
from corpusmill.streaming import flows


def one(spark, expr, **cols):
    row = spark.createDataFrame([tuple(cols.values()) or (1,)], list(cols) or ["x"])
    return row.select(expr.alias("v")).collect()[0].v


@pytest.mark.parametrize(
    "url,want",
    [
        ("http://www.X.example:80/a/b/?utm_source=m&b=2&a=1#frag", "https://x.example/a/b?a=1&b=2"),
        ("https://x.example/%61%2Fb/../c/", "https://x.example/c"),
        ("HTTPS://user@X.example/", "https://x.example"),
        ("//x.example/a", "https://x.example/a"),
        ("ftp://x.example/a", ""),
        ("", ""),
        (None, ""),
        ("https://x.example/story?id=7&fbclid=z", "https://x.example/story?id=7"),
    ],
)
def test_canonical_url(url, want):
    assert canonical_url(url) == want
    assert canonical_url(want) == want


def test_text_expressions(spark):
    v = lambda e, **c: one(spark, e, **c)
    assert v(X.normalize_text(F.lit("<b>A &amp; B</b> http://x.example/y a@b.example ★\n\n\n\nC\t D "))) == "A & B  \n\nC D".replace("  \n", " \n")
    assert v(X.title_key(F.lit("[Breaking] The  Bridge opens | Hoti Post"))) == "the bridge opens"
    same, sure = X.titles_similar(F.lit("The bridge opens today in town"), F.lit("The bridge opens today in town!"))
    assert v(same) and v(sure) > 0.9
    same, _ = X.titles_similar(F.lit("The bridge opens"), F.lit("A museum closes its doors"))
    assert not v(same)
    assert v(F.levenshtein(F.lit("방앗간"), F.lit("방앗갓"))) == 1
    assert v(X.jaccard(F.array(), F.array())) == 1.0 and v(X.jaccard(F.array(F.lit("a")), F.array())) == 0.0
    assert v(X.paywall(F.lit("Subscribe to unlock this. " + "x" * 60))) and not v(X.paywall(F.lit("Prices per month rose. " * 10)))
    assert v(X.iso_week(F.lit(date(2024, 12, 30)))) == "2025-W01"
    assert v(X.list_text(F.lit("['a', 'b']"))) == ["a", "b"] and v(X.list_text(F.lit("a, b"))) == ["a", "b"]
    assert v(X.primary_script(F.lit("Привет мир"))) == "cyrillic" and v(X.primary_script(F.lit("ab"))) == "unknown"
    assert v(X.is_article_url(F.lit("https://x.example/a/b"))) and not v(X.is_article_url(F.lit("https://x.example/tag/b"))) and not v(X.is_article_url(F.lit(None).cast("string")))


def test_simhash_is_close_for_close_texts(spark):
    base = " ".join(f"word{i}" for i in range(200))
    rows = spark.createDataFrame([("a", base), ("b", base + " more"), ("c", " ".join(f"other{i}" for i in range(200))), ("d", "short"), ("e", None)], "k string, t string")
    got = {r.k: r.f for r in rows.select("k", X.simhash64(F.col("t")).alias("f")).collect()}
    dist = lambda x, y: bin((got[x] ^ got[y]) & (2**64 - 1)).count("1")
    assert dist("a", "b") <= 10 < dist("a", "c") and got["d"] == 0 and got["e"] == 0


PAGE = """<html><head><title>Short | The Bridge of Soro opens today</title><meta content="2024-05-06" property="article:published_time"><script type="application/ld+json">{"author": {"name": "By Ana Lopes"}}</script></head>
<body><nav><p>Home</p></nav><article><p>First &amp; last.</p><script>var x;</script><p>Second.</p></article><a href="/x">x</a><a href="https://y.example/z#a">y</a></body></html>"""


def test_markup(spark):
    h = F.lit(PAGE)
    assert one(spark, M.html_title(h)) == "The Bridge of Soro opens today"
    assert one(spark, M.html_date(h)) == "2024-05-06" and one(spark, M.html_author(h)) == "Ana Lopes"
    assert one(spark, M.html_body(h)) == "First & last.\n\nSecond."
    assert one(spark, M.html_links(h, F.lit("h.example"))) == ["https://h.example/x", "https://y.example/z"]
    feed = "<rss><item><title><![CDATA[A]]></title><link>https://a</link><pubDate>d</pubDate></item></rss><feed><entry><title>B</title><link href='https://b'/><updated>e</updated></entry></feed>"
    assert [tuple(x) for x in one(spark, M.feed_items(F.lit(feed)))] == [("https://a", "d", "A"), ("https://b", "e", "B")]
    assert one(spark, M.sitemap_date(F.lit("https://x/sitemap-2024-02.xml"))) == date(2024, 2, 29)
    assert one(spark, M.relative_time(F.lit("3시간 전"), F.lit("2024-01-01 12:00:00").cast("timestamp"))) == datetime(2024, 1, 1, 9)
    assert one(spark, M.strip_ruby(F.lit("<ruby>a<rt>b</rt></ruby>"))) == "a"


def test_bursts_and_changepoints():
    x = np.full(30, 5.0)
    assert kernels.bursts(x) == []
    x[10:16] = 50
    (a, b, level, score), *_ = kernels.bursts(x)
    assert a <= 12 and b >= 13 and level >= 1 and score > 0
    rng = np.random.default_rng(42)
    y = np.concatenate([rng.normal(10, 1, 20), rng.normal(30, 1, 20)])
    found, sig = kernels.changepoint_significance(y)
    assert found and abs(found[0] - 20) <= 5 and 0 <= sig <= 1
    assert kernels.changepoints(np.ones(3)) == []


def test_burst_states_are_optimal():
    rng = random.Random(1)
    from itertools import product

    for _ in range(5):
        x = np.array([rng.choice([0, 1, 2, 9]) for _ in range(6)], float)
        if x.sum() == 0:
            continue
        got = kernels.burst_states(x)
        k = max(2, 1 + math.ceil(math.log(max(x.max(), 1))))
        rate = x.mean() * 2.0 ** np.arange(k)

        def cost(path):
            c = path[0] * math.log(6)
            for i, j in zip(path, path[1:]):
                c += max(j - i, 0) * math.log(6)
            return c + sum(rate[s] - n * math.log(rate[s]) for s, n in zip(path, x))

        assert cost(list(got)) == pytest.approx(min(cost(p) for p in product(range(k), repeat=6)))


def test_stl_sums_and_finds_the_week():
    t = np.arange(56)
    y = 10 + 0.5 * t + np.where(t % 7 == 0, 5.0, 0)
    trend, season, rest = kernels.stl(y)
    assert np.allclose(trend + season + rest, y)
    assert season[14::7].mean() > season[15::7].mean() + 2
    for short in (np.array([7.0]), np.array([]), np.ones(5)):
        assert len(kernels.stl(short)[0]) == len(short)


def test_f_tail_and_granger():
    assert kernels.f_tail(4.964602743730, 1, 10) == pytest.approx(0.05, abs=1e-6)
    assert kernels.f_tail(2.866081402, 4, 20) == pytest.approx(0.05, abs=1e-6)
    rng = np.random.default_rng(3)
    cause = rng.normal(size=200)
    effect = np.concatenate([[0, 0], cause[:-2]]) + 0.1 * rng.normal(size=200)
    lag, p = kernels.granger(cause, effect)
    assert lag >= 2 and p < 1e-6 and kernels.granger(effect, cause)[1] > 1e-4


def test_stationarity():
    rng = np.random.default_rng(4)
    noise = rng.normal(size=300)
    assert kernels.is_stationary(noise) and not kernels.is_stationary(np.cumsum(noise)) and not kernels.is_stationary(noise[:4])


def test_dtw_against_recursion():
    from functools import lru_cache

    rng = random.Random(5)
    a, b = [rng.random() for _ in range(8)], [rng.random() for _ in range(6)]

    @lru_cache(None)
    def d(i, j):
        if i == 0 or j == 0:
            return 0.0 if i == j else math.inf
        return abs(a[i - 1] - b[j - 1]) + min(d(i - 1, j), d(i, j - 1), d(i - 1, j - 1))

    assert kernels.dtw(np.array(a), np.array(b)) == pytest.approx(d(8, 6))


def test_decay_kinds():
    t = np.arange(1, 20)
    flash = kernels.decay(np.concatenate([[200], 150 * np.exp(-0.8 * t)]))
    assert flash["kind"] == "flash" and flash["lam"] == pytest.approx(0.8, abs=0.01)
    slow = kernels.decay(np.concatenate([[200], 100 * t**-1.2]))
    assert slow["kind"] == "sustained" and slow["alpha"] == pytest.approx(1.2, abs=0.01)
    assert kernels.decay(np.array([5.0, 1])) is None


def test_wavelet_filter_is_orthonormal():
    h = kernels._db4()
    assert h.sum() == pytest.approx(math.sqrt(2)) and (h**2).sum() == pytest.approx(1)
    assert all((h[2 * k :] * h[: len(h) - 2 * k]).sum() == pytest.approx(0, abs=1e-9) for k in (1, 2, 3))
    assert len(kernels.wavelet_energy(np.arange(64.0))) == 4


def test_isolation_forest_and_nmf():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(200, 3)), [[9, 9, 9]]])
    s = kernels.isolation_scores(x)
    assert s.argmax() == 200 and s[200] > 0.6
    v = np.abs(rng.normal(size=(12, 3))) @ np.abs(rng.normal(size=(3, 20)))
    again = np.concatenate([kernels.isolation_scores(part, x) for part in np.array_split(x, 4)])
    assert np.allclose(s, again)
    w, h = kernels.nmf(v, 3)
    assert (w >= 0).all() and np.abs(v - w @ h).mean() < 0.1 * v.mean()


def test_forecast_follows_trend_and_weekday():
    t = np.arange(42)
    y = 10 + t + np.where(t % 7 == 3, 4, 0)
    fit, low, high = kernels.forecast(y)
    assert len(fit) == 49 and np.allclose(fit[:42], y, atol=0.1) and (low <= fit).all() and (fit <= high).all()


def test_cascade_is_sequential(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        f = rng.choice([0, *(r[4] for r in rows)]) if rows and rng.random() < 0.5 else rng.getrandbits(63)
        for bit in rng.sample(range(63), rng.choice([0, 4, 7])):
            f ^= 1 << bit
        rows.append((f"d{i:02d}", i, f"u{rng.randrange(45)}", rng.choice(["", f"t{rng.randrange(30)}"]), f))
    got = {r.id: (r.is_duplicate, r.level, r.match_id) for r in cascade.dedup_cascade(spark.createDataFrame(rows, "id string, seq long, url_key string, title_key string, simhash long")).collect()}
    urls, kept, want = {}, [], {}
    for i, seq, u, t, f in rows:
        if u in urls:
            want[i] = (True, 1, urls[u])
            continue
        urls[u] = i
        hit = next(((2, k[0]) for k in kept if t and k[3] == t), None) or next(((3, k[0]) for k in kept if f and bin((k[4] ^ f) & (2**64 - 1)).count("1") <= 10), None)
        if hit:
            want[i] = (True, *hit)
        else:
            want[i] = (False, 0, None)
            if f:
                kept.append((i, seq, u, t, f))
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}


def test_cascade_resolves_long_chains(spark):
    rng = random.Random(12)
    chain = [rng.getrandbits(63)]
    while len(chain) < 32:  # each is close to the one before it only
        f = chain[-1] ^ sum(1 << b for b in rng.sample(range(63), 9))
        if all(bin(f ^ x).count("1") > 10 for x in chain[:-1]):
            chain.append(f)
    rows = spark.createDataFrame([(f"d{i:02d}", i, f"u{i}", "", f) for i, f in enumerate(chain)], "id string, seq long, url_key string, title_key string, simhash long")
    got = {r.id: r.match_id for r in cascade.dedup_cascade(rows).collect()}
    assert got == {f"d{i:02d}": f"d{i - 1:02d}" if i % 2 else None for i in range(32)}


def test_fingerprint_pairs_lose_nothing(spark):
    rng = random.Random(8)
    fs = [rng.getrandbits(63) for _ in range(40)]
    fs += [f ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 12))) for f in fs]
    rows = spark.createDataFrame([(i, i, f) for i, f in enumerate(fs)], "id long, seq long, simhash long")
    want = {(i, j) for j in range(len(fs)) for i in range(j) if bin(fs[i] ^ fs[j]).count("1") <= 10}
    assert {(r.a, r.b) for r in cascade.fingerprint_pairs(rows).collect()} == want
    assert cascade.fingerprint_pairs(rows.limit(0)).count() == 0


def test_graph_algorithms(spark):
    e = spark.createDataFrame([("a", "b", 3.0), ("b", "a", 3.0), ("b", "c", 1.0), ("c", "b", 1.0), ("x", "y", 2.0), ("y", "x", 2.0), ("d", "c", 1.0)], "src string, dst string, weight double")
    c = {r.node: r.component for r in graph.components(e).collect()}
    assert c == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "x", "y": "x"}
    nodes = sorted(c)
    p = {n: 1 / 6 for n in nodes}
    out = {"a": {"b": 3}, "b": {"a": 3, "c": 1}, "c": {"b": 1}, "x": {"y": 2}, "y": {"x": 2}, "d": {"c": 1}}
    for _ in range(20):
        got = dict.fromkeys(nodes, 0.0)
        for s, ts in out.items():
            for t, w in ts.items():
                got[t] += p[s] * w / sum(ts.values())
        p = {n: 0.15 / 6 + 0.85 * (got[n] + (1 - sum(got.values())) / 6) for n in nodes}
    rank = {r.node: r.rank for r in graph.pagerank(e).collect()}
    assert rank == pytest.approx(p) and sum(rank.values()) == pytest.approx(1)
    assert {r.node: r.depth for r in graph.bfs_depth(e, spark.createDataFrame([("d",)], "node string")).collect()} == {"d": 0, "c": 1, "b": 2, "a": 3}
    assert graph.pagerank(e.limit(0)).count() == 0 and graph.components(e.limit(0)).count() == 0
    com = {r.node: r.community for r in graph.louvain(e.where("src <> 'd'")).collect()}
    assert com["x"] == com["y"] != com["a"]


def test_louvain_finds_planted_groups(spark):
    rng = random.Random(3)
    group = {f"n{i:02d}": i // 8 for i in range(32)}
    names = sorted(group)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[:i] if (group[a] == group[b] and rng.random() < 0.8) or rng.random() < 0.03]
    e = settle(spark.createDataFrame([(a, b, 1.0) for x, y in pairs for a, b in ((x, y), (y, x))], "src string, dst string, weight double"))
    found = graph.louvain(e)
    planted = spark.createDataFrame([(n, str(g)) for n, g in group.items()], "node string, community string")
    reached, wanted = (graph.modularity(e, c).first()[0] for c in (found, planted))
    m2, degree = 2 * len(pairs), {n: sum(n in p for p in pairs) for n in names}
    brute = sum((((a, b) in pairs or (b, a) in pairs) - degree[a] * degree[b] / m2) for a in names for b in names if group[a] == group[b]) / m2
    assert wanted == pytest.approx(brute) and reached >= wanted - 1e-9
    assert graph.louvain(e.limit(0)).count() == 0


def test_archived_partitions_are_verified_and_gone(spark, tmp_path):
    live, archive = f"file://{tmp_path}/live", f"file://{tmp_path}/archive"
    rows = spark.createDataFrame([(f"a{i}", f"2025-01-{1 + i % 9:02d}") for i in range(90)] + [(None, "2025-01-02")], "article_id string, d string").select("article_id", F.col("d").cast("date").alias("crawl_date"))
    sinks.sink_parquet(rows, live, partition="crawl_date")
    assert sinks.archive_partitions(spark, live, archive, F.lit("2025-01-05").cast("date")) == 4
    assert spark.read.parquet(live).agg(F.min("crawl_date").cast("string")).first()[0] == "2025-01-05" and spark.read.parquet(archive).count() == 41


def test_python_scorer_loads_once_a_partition(spark):
    from corpusmill.operators import scorers

    def load():
        state = {"batches": 0}

        def run(texts):
            state["batches"] += 1
            return texts.str.len().fillna(0).astype("int64") * 0 + state["batches"]

        return run

    scorers.register_python("counted", "long", load)
    got = spark.range(0, 1200, 1, 1).select(scorers.score("counted", F.lit("x")).alias("n")).agg(F.max("n")).first()[0]
    assert got == 3  # 500 rows a batch


def test_depth_has_no_limit(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(13)] + [(5, 2)], "src long, dst long")
    root = spark.createDataFrame([(0,)], "node long")
    assert {r.node: r.depth for r in graph.bfs_depth(e, root).collect()} == {i: i for i in range(14)}
    assert graph.bfs_depth(e, root, max_depth=3).count() == 4


def test_copies_of_vectors_form_one_cluster(spark, tmp_path):
    from corpusmill.plans.detail_queries import hdbscan

    rows = [(i, "x", [0.0, 0.0]) for i in range(12)] + [(20 + i, "x", [0.1, 0.0]) for i in range(12)]
    rows += [(50 + i, "x", [5.0 + 0.5 * i, 5.0 + i]) for i in range(30)] + [(99, "x", None), (100, None, [0.0, 0.0])]
    spark.createDataFrame(rows, "vec_id long, label string, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = dict(map(tuple, hdbscan(spark, str(tmp_path)).collect()))
    assert len(got) == len(rows) and {got[i] for i in (*range(12), *range(20, 32))} == {0} and got[99] == got[100] == -1


def test_frames_of_a_topic_in_any_language(spark):
    from corpusmill.plans.detail_queries import frame_divergence

    rows = [("t", "p", "market budget brücke"), ("t", "q", "army brücke treaty"), ("t", "r", "army lamp treaty"), ("u", "p", "alone")]
    got = {(r.topic, r.a, r.b): r for r in frame_divergence(spark.createDataFrame(rows, "topic string, source string, text string")).collect()}
    assert set(got) == {("t", "p", "q"), ("t", "p", "r"), ("t", "q", "r")}
    idf = {1: math.log(4 / 2) + 1, 2: math.log(4 / 3) + 1}
    s = [{"market": idf[1], "budget": idf[1], "brücke": idf[2]}, {"army": idf[2], "brücke": idf[2], "treaty": idf[2]}]
    words = ["market", "budget", "brücke", "army", "treaty", "lamp"]
    p, q = (np.array([x.get(w, 0) for w in words]) / sum(x.values()) + 1e-10 for x in s)
    p, q = p / p.sum(), q / q.sum()
    r = got["t", "p", "q"]
    assert r.kl == pytest.approx(((p - q) * np.log(p / q)).sum() / 2, abs=1e-5) and r.economic_a == pytest.approx(p[:2].sum(), abs=1e-5) and r.security_b == pytest.approx(q[3:5].sum(), abs=1e-5)


def test_every_document_gets_a_factor(spark, tmp_path):
    from corpusmill.plans.series_queries import nmf

    rng = random.Random(5)
    kinds = [["lamp", "light", "bulb", "switch"], ["tent", "rain", "camp", "pole"], ["чай", "чашка", "вода", "чайник"]]
    rows = [(i, "shop", " ".join(rng.choices(kinds[i % 3], k=6))) for i in range(60)] + [(99, "shop", None)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = dict(map(tuple, nmf(spark, str(tmp_path)).collect()))
    groups = [{got[i] for i in range(k, 60, 3)} for k in range(3)]
    assert set(got) == set(range(60)) and not groups[0] & groups[1] and not groups[0] & groups[2] and not groups[1] & groups[2]


def test_search(spark):
    docs = spark.createDataFrame([(1, "The café near the bridge"), (2, "Bridge and museum, bridge"), (3, None), (4, ""), (2, "bridge")], "id int, text string")
    i = serving.inverted_index(docs, "id", ["text"])
    assert {tuple(r) for r in i.where("term = 'bridge'").select("id", "tf").collect()} == {(1, 1), (2, 3)}
    assert [r.id for r in serving.fts_match(i, ["bridge", "cafe"]).collect()] == [1]
    assert [r.id for r in serving.fts_match(i, ["bridge"], none=["cafe"]).collect()] == [2]
    assert [r.id for r in serving.fts_rank(i, ["museum"], 5).collect()] == [2]
    assert one(spark, serving.snippet(F.lit("a b the Café c d"), "cafe", 4)) == "...b the <b>Café</b> c..."
    assert serving.fts_rank(i.limit(0), ["x"], 3).count() == 0


def test_tfidf_without_moving_or_broadcasting_terms(spark, tmp_path):
    rng = random.Random(3)
    words = [f"Wort{i}" for i in range(40)] + ["Été", "x", "다리", "a_b"]
    rows = [(rng.randrange(60), " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 30]))), rng.choice(["en", "ko"])) for _ in range(150)]
    rows += [(None, "Wort1 Wort2 wort3", "en"), (None, "wort3, Wort2", "en"), (900, None, "en"), (901, "", "en"), (902, "solo alone", "xx"), (903, "Wort1 Wort2", None)]
    spark.createDataFrame(rows, "id int, text string, lang string").write.parquet(f"{tmp_path}/docs")
    tf, n, df, total = {}, Counter(), Counter(), Counter()
    for i, text, g in rows:
        if text is not None and g is not None:
            n[g] += 1
            w = re.findall(r"\w{2,}", text.lower())
            tf.setdefault((g, i), Counter()).update(w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)])
    for (g, _), c in tf.items():
        for t, k in c.items():
            df[g, t] += 1
            total[g, t] += k
    known = set()
    for g in n:
        usable = [t for x, t in df if x == g and (1 if 0.95 * n[g] < 2 else 2) <= df[g, t] <= 0.95 * n[g]]
        known |= {(g, t) for t in sorted(usable, key=lambda t: (-total[g, t], t))[:100]}
    want = set()
    for (g, i), c in tf.items():
        s = {t: (1 + math.log(k)) * (math.log((1 + n[g]) / (1 + df[g, t])) + 1) for t, k in c.items() if (g, t) in known}
        scores = {t: round(x / math.sqrt(sum(y * y for y in s.values())), 6) for t, x in s.items()}
        want |= {(i, t, scores[t], k) for k, t in enumerate(sorted(scores, key=lambda t: (-scores[t], t))[:20], 1)}
    docs = spark.read.parquet(f"{tmp_path}/docs")
    got = serving.tfidf_top(docs, "id", "text", "lang", vocabulary=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan and plan.count("Exchange") == 1
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want) > 500
    joined = serving.tfidf_top(docs, "id", "text", "lang", vocabulary=100, max_terms=0)
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in joined.collect()} == want
    assert serving.tfidf_top(docs.limit(0), "id", "text", "lang").count() == 0


def test_knn_against_numpy(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(80, 5))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id int, embedding array<double>")
    got = {(r.query, r["rank"]): r.id for r in serving.vec_knn(df, df.where("vec_id % 50 = 0"), 3).collect()}
    for q in (0, 50):
        order = [int(j) for j in np.argsort(((v - v[q]) ** 2).sum(1)) if j != q][:3]
        assert [got[q, k] for k in (1, 2, 3)] == order


def test_relational(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1, 5, "x"), (1, 3, "y"), (3, 1, "z"), (None, 9, "n")], "k int, o int, v string")
    got = {(r.k, r.v, r.o) for r in relational.join_left_first(left, right, "k", [F.col("o")]).collect()}
    assert got == {(1, "a", 3), (2, None, None), (None, "c", None)}
    e = spark.createDataFrame([("u", 1, 10.0), ("u", 5, 20.0), ("w", 2, 5.0)], "k string, t int, value double")
    q = spark.createDataFrame([("u", 0), ("u", 1), ("u", 7), ("z", 1)], "k string, t int")
    assert {(r.k, r.t, r.value) for r in relational.asof_join(q, e, "k", "t", "value").collect()} == {("u", 0, None), ("u", 1, 10.0), ("u", 7, 20.0), ("z", 1, None)}
    m = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", None), ("b", None)], "k string, v string")
    assert {tuple(r) for r in relational.mode_by(m, "k", "v").collect()} == {("a", "x")}


def test_range_join_finds_each_pair_once(spark):
    rng = random.Random(10)
    rows = [(i, rng.choice("ab"), datetime(2024, 1, 1 + rng.randrange(3), rng.randrange(24), rng.randrange(60))) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp")
    got = sorted((r[0], r[1]) for r in relational.range_join(df, df, "k", "ts", 5).select(F.col("a.id"), F.col("b.id")).collect())
    want = sorted((i, j) for i, k, t in rows for j, m, u in rows if k == m and 0 <= (u - t).total_seconds() <= 5 * 3600)
    assert got == want


def test_quality(spark):
    df = spark.createDataFrame([(1, 0.5, [1.0, 2.0]), (1, 2.0, [1.0]), (None, float("nan"), None), (2, None, [0.0, 0.0])], "k int, s double, v array<double>")
    assert {tuple(r) for r in quality.check_ranges(df, {"s": (0, 1)}).collect()} == {("s", 2)}
    assert tuple(quality.check_keys(df, "k").collect()[0]) == (4, 1, 2, 1)
    assert tuple(quality.check_vectors(df, "v", 2).collect()[0]) == (4, 1, 1, 1)
    assert quality.check_schema(spark, df, T.StructType([T.StructField("k", T.LongType()), T.StructField("x", T.StringType())])).count() == 3
    assert {tuple(r) for r in quality.check_nulls(df, ["k", "v"]).collect()} == {("k", 1, 0.25), ("v", 1, 0.25)}


def test_insights_on_empty_and_null_rows(spark):
    schema = "article_id string, topic string, lang string, source string, day date, ts timestamp, score double, steeps string, entity string"
    empty = spark.createDataFrame([], schema)
    nulls = spark.createDataFrame([("a", None, None, None, None, None, None, None, None)] * 2, schema)
    for df in (empty, nulls):
        for f in (insights.topic_jsd, insights.attention_gap, insights.sentiment_wasserstein, insights.filter_bubble, insights.voice_dominance, insights.velocity, insights.agenda, insights.entity_reach, insights.entity_emergence, insights.cooccurrence, insights.daily_series):
            assert f(df).count() == 0, f.__name__


def test_wasserstein_against_numpy(spark):
    rng = np.random.default_rng(11)
    a, b = rng.normal(size=30), rng.normal(0.5, 1, 40)
    df = spark.createDataFrame([("t", "x", float(v)) for v in a] + [("t", "y", float(v)) for v in b], "topic string, lang string, score double")
    grid = np.sort(np.concatenate([a, b]))
    cdf = lambda s: np.searchsorted(np.sort(s), grid[:-1], side="right") / len(s)
    assert insights.sentiment_wasserstein(df).collect()[0].distance == pytest.approx(float((np.abs(cdf(a) - cdf(b)) * np.diff(grid)).sum()))


def test_signal_layers(spark):
    base = {"topic": "t", "n_sources": 3, "domains": 1, "span_days": 10, "zscore": 4.0, "burst": 3.5}
    got = signals.build_signals(spark.createDataFrame([tuple(base.values())], list(base))).collect()[0]
    assert got.layer == "L1_fad" and got.confidence == pytest.approx(0.6)
    five = {"topic": "t", "novelty": 0.85, "ood": 0.9, "domains": 4, "transition": 1, "changepoint": 0.95, "entropy_spike": 0.9, "network": 0.9, "n_sources": 5, "span_days": 30}
    got = signals.build_signals(spark.createDataFrame([tuple(five.values())], list(five))).collect()[0]
    assert got.layer == "L5_singularity" and got.confidence == pytest.approx(0.85) and 0.65 <= got.composite <= 1
    assert signals.build_signals(spark.createDataFrame([("t", 0.0)], "topic string, zscore double")).count() == 0


def test_files_and_sinks(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1, "b": "x"}\n\n{broken\n{"a": 2}\n')
    assert {tuple(r) for r in files.scan_jsonl(spark, str(path), schema).collect()} == {(1, "x"), (2, None)}
    assert files.scan_safe(spark, str(tmp_path / "none"), schema).count() == 0
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 3))], "a int, crawl_date date")
    sinks.sink_parquet(df, str(tmp_path / "p"), partition="crawl_date")
    assert files.scan_window(spark, str(tmp_path / "p"), "2024-01-01", "2024-01-02").count() == 1
    assert [r.a for r in files.scan_latest(spark, str(tmp_path / "p")).collect()] == [2]
    m = sinks.manifest(spark, str(tmp_path / "p")).cache()
    assert m.count() == 2 and sinks.verify_manifest(spark, str(tmp_path / "p"), m).where("ok").count() == 2
    with pytest.raises(ValueError):
        sinks.ttl_purge(df, "crawl_date", "2024-01-10", 3)
    got = sinks.coerce(spark.createDataFrame([("7", "x"), ("z", "y")], "a string, c string"), schema).collect()
    assert [tuple(r) for r in got] == [(7, None), (None, None)]
    log = tmp_path / "log.txt"
    log.write_text("site=a err=1\nnoise\nsite=b err=2\n")
    assert {tuple(r) for r in files.scan_log_lines(spark, str(log), r"site=(\w+) err=(\d)", ["site", "err"]).collect()} == {("a", "1"), ("b", "2")}
    assert files.scan_config(spark, '[{"a": 1}, {"b": "q"}]', schema).count() == 2
    (tmp_path / "page.html").write_text("<h1>x</h1>")
    assert files.scan_pages(spark, str(tmp_path / "page.html")).collect()[0].html == "<h1>x</h1>"


def test_streams_match_batches(spark, tmp_path):
    rng = random.Random(12)
    rows = [(i, rng.choice("ab"), datetime(2024, 1, 1 + i // 20, rng.randrange(24)), float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp, value double")
    src = str(tmp_path / "in")
    for n in range(5):
        df.where(F.col("id").between(20 * n, 20 * n + 19)).coalesce(1).write.mode("append").parquet(src)
    stream = flows.read_stream(spark, src, df.schema)
    flows.run_available(flows.daily_volume(stream, "k", late="0 seconds"), str(tmp_path / "out"), str(tmp_path / "state"))
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {tuple(r) for r in flows.daily_volume(df, "k").collect()}
    assert got <= want and len(got) >= 6
    flows.run_available(flows.first_seen(flows.read_stream(spark, src, df.schema), "k").select("k"), str(tmp_path / "o2"), str(tmp_path / "s2"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "o2")).collect()) == ["a", "b"]
    assert flows.sessions(df, "k").agg(F.sum("n")).collect()[0][0] == 100


def test_entry_points_are_consistent():
    import __spark_entry__ as e

    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q) and len(q) > 200
