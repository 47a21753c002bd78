"""Operators on article texts: brute force, round trips and edge rows."""

import random
import re
from collections import defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from corpusmill.llm.encoding import CHARS, Dictionaries, garbled_fields, repair, restored
from corpusmill.llm.langid import LanguageModels, document_languages, label_language, wrong_languages
from corpusmill.llm.pagebody import body_lines, main_bodies, read_page
from corpusmill.llm.repeated import frequent_lines, repeated_lines, without_repeated_lines
from corpusmill.llm.residue import batch_fingerprints, has_slot, jaccard, page_classes, residue_labels, residue_pages, residue_text, shingles, simhash, table_keys, without_residue

SAMPLES = {
    "en": ["The council approved the plan for the bridge after a long debate on Tuesday evening.", "Residents waited outside while the museum presented its report about the old mill."] * 4,
    "de": ["Der Gemeinderat billigte den Plan für die neue Brücke nach einer langen Debatte am Dienstagabend.", "Während draußen Anwohner warteten, stellte das Museum seinen Bericht über die alte Mühle vor."] * 4,
    "fr": ["Le conseil municipal a approuvé le projet de la nouvelle passerelle après un long débat mardi soir.", "Les habitants attendaient dehors pendant que le musée présentait son rapport sur le vieux moulin."] * 4,
    "ru": ["Совет одобрил план нового моста после долгих споров во вторник вечером.", "Жители ждали снаружи, пока музей представлял доклад о старой мельнице."] * 4,
    "ko": ["시의회는 긴 토론 끝에 화요일 저녁에 새 다리 계획을 승인했다.", "주민들이 밖에서 기다리는 동안 박물관은 낡은 방앗간 보고서를 발표했다."] * 4,
}
DICTIONARIES = Dictionaries({k: ("\n".join(v)).encode() for k, v in SAMPLES.items()})
ARTICLE = "article_id string, title string, body string, source string, language string, line_no string"


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame([(k, t) for k, v in SAMPLES.items() for t in v] + [(None, "x"), ("en", None)], "language string, text string")


def articles(spark, rows):
    return spark.createDataFrame(rows, ARTICLE)


def garble(text, read, real="utf-8"):
    return "".join(CHARS[read][b] for b in text.encode(real))


@pytest.mark.parametrize("language", ["de", "fr", "ru", "ko"])
@pytest.mark.parametrize("read", ["latin-1", "cp1252", "mac_roman", "cp437", "cp850", "cp1251", "koi8-r"])
def test_utf8_read_wrongly_is_restored(language, read):
    text = "\n".join(SAMPLES[language][:2])
    assert repair(garble(text, read), DICTIONARIES) == (text, True)


@pytest.mark.parametrize("read,real,language", [("cp1252", "cp1251", "ru"), ("latin-1", "koi8-r", "ru"), ("cp1251", "koi8-r", "ru"), ("koi8-r", "cp1251", "ru"), ("cp1252", "euc-kr", "ko")])
def test_other_charsets_are_restored(read, real, language):
    text = "\n".join(SAMPLES[language][:2])
    assert repair(garble(text, read, real), DICTIONARIES) == (text, True)


def test_twice_garbled_and_partly_garbled():
    text = SAMPLES["fr"][0]
    assert repair(garble(garble(text, "cp1252"), "cp1252"), DICTIONARIES) == (text, True)
    assert repair(text + "\n" + garble(text, "cp1252"), DICTIONARIES) == (text + "\n" + text, True)


def test_good_text_stays():
    for text in [t for v in SAMPLES.values() for t in v] + ["“Åsa Café” kept its naïve façade – ½ °C £5 ©", "L’HÔTEL « ÎLE DÂME » A FÊTÉ", "УТРЕННЕЕ ПИСЬМО – БЕСПЛАТНО", "шаг", ""]:
        assert repair(text, DICTIONARIES) == (text, False)
    assert repair(None, DICTIONARIES) == (None, False)
    assert repair("caf� noir", DICTIONARIES) == ("caf� noir", True)


def test_garbled_fields(spark, samples):
    bad = garble(SAMPLES["de"][0], "cp1252")
    docs = articles(spark, [("a", bad, "ok", None, None, ""), ("a", bad, "ok", None, None, ""), ("b", "x", "café " * 20_000 + bad, "s", "en", ""), (None, None, None, None, None, None), ("c", "", "", "", "", "")])
    assert sorted(map(tuple, garbled_fields(docs, samples).collect())) == [("a", "title"), ("b", "body")]
    assert garbled_fields(docs.limit(0), samples).count() == 0
    got = restored(docs, samples, ("title",)).where("title_garbled").select("title").distinct().collect()
    assert [r[0] for r in got] == [SAMPLES["de"][0]]


def brute_repeated(rows):
    total, where = defaultdict(set), defaultdict(set)
    key = lambda x: re.sub("[0-9]+", "0", " ".join(x.lower().split()))
    for a, _, body, source, _, _ in rows:
        total[source].add(a)
        for x in (body or "").split("\n"):
            if key(x):
                where[source, key(x)].add(a)
    return {(a, i) for a, _, body, source, _, _ in rows for i, x in enumerate((body or "").split("\n"), 1) if key(x) and len(where[source, key(x)]) >= 4 and len(where[source, key(x)]) * 50 >= len(total[source])}


def test_repeated_lines_against_brute_force(spark):
    rng = random.Random(1)
    pool = ["Share this", "share  THIS ", "Copyright 2024", "copyright 1999 ", "　Menu", "menu", "", "  ", "one off"]
    rows = []
    for i in range(400):
        source = rng.choice(["hot"] * 6 + ["s1", "s2", None, ""])
        body = rng.choice([None, "", "\n".join(rng.choices([*pool, f"text {rng.random()}"[:9], "x" * 5000], k=rng.randint(1, 8)))])
        rows.append((f"a{i}", None, body, source, None, "9"))
    rows += rows[:30]
    docs = articles(spark, rows)
    assert {tuple(r) for r in repeated_lines(docs).collect()} == brute_repeated(rows)
    clean = without_repeated_lines(docs)
    assert clean.count() == len(rows) and set(docs.columns) < set(clean.columns)
    drop = brute_repeated(rows)
    want = {(a, b and "\n".join(x for i, x in enumerate(b.split("\n"), 1) if (a, i) not in drop)) for a, _, b, *_ in rows}
    assert {(r.article_id, r.clean_body) for r in clean.collect()} == want
    assert repeated_lines(docs.limit(0)).count() == 0 and frequent_lines(docs.limit(0)).count() == 0


PAGE = "\n".join(["Home | News | Sport | Log in", "Hoti Post – staff report", SAMPLES["en"][0], "The background", SAMPLES["en"][1], "• Lamp – 3 €", "Read also: The council approved the tender for lamps", "The museum presented its long report about the old mill", "12 comments", "© 2024 Hoti Post – Imprint"])


def test_page_body():
    page = read_page(PAGE)
    assert [i + 1 for i in page.furniture] == [1, 7, 8, 9, 10] and not page.residue
    assert read_page("").own == [] and read_page("\n \n").furniture == []


def test_body_lines_edge_rows(spark, samples):
    rows = [("a", "t", PAGE, "s", "en", ""), ("a", "t", PAGE, "s", "en", ""), ("b", None, None, None, None, None), ("c", "", "", "", "", ""), (None, "t", "Home | News | Sport | Log in\n" + SAMPLES["en"][0], "s", "en", ""), ("e", "t", "404\nPage not found", "s", "en", "")]
    docs = articles(spark, rows)
    got = sorted(map(tuple, body_lines(docs, samples).collect()), key=str)
    assert got == sorted([("a", n) for n in (1, 7, 8, 9, 10)] + [(None, 1)], key=str)
    assert body_lines(docs.limit(0), samples).count() == 0
    main = {(r.article_id, r.main_body) for r in main_bodies(docs, samples).collect()}
    assert ("b", None) in main and ("c", "") in main and ("e", None) in main


WORDS_OF_NO_LIST = ["vamik", "torel", "ponda", "rusti", "gelom", "hadra", "sikep", "wolun", "befti", "jorma", "kuvel", "dinap"]


def unlisted_pages(rng, n=60):
    """Pages in a language of no reference text, with furniture of one site and random articles; (body, numbers of furniture lines)."""
    sentence = lambda: (" ".join(rng.choice(WORDS_OF_NO_LIST) + rng.choice("aeiou") * rng.randint(0, 2) for _ in range(rng.randint(9, 16))) + ".").capitalize()
    furniture = ["Zilga | Mopra | Heklo | Tuvas", "Nelfa gurto zipan melo.", "Vrota kesta!", "Dorpa 12 zemlik", "Gorna melfa", "© 2024 Zorba Kestel"]
    out = []
    for _ in range(n):
        above, below = rng.sample(furniture, rng.randint(0, 3)), rng.sample(furniture, rng.randint(0, 3))
        own = ["Per Zorba Kestel", sentence() + " " + sentence(), sentence(), "Hurda welma", sentence() + " " + sentence() + " " + sentence()]
        lines = above + own + below
        out.append(("\n".join(lines), [*range(1, len(above) + 1), *range(len(above) + len(own) + 1, len(lines) + 1)]))
    return out


def unlisted_rows(rng):
    return [(f"u{i}", "t", body, "zorba", None, " ".join(map(str, numbers))) for i, (body, numbers) in enumerate(unlisted_pages(rng))]


def test_pages_of_an_unlisted_language_are_cleaned(spark, samples):
    rows = unlisted_rows(random.Random(8))
    want = {(r[0], int(n)) for r in rows for n in r[5].split()}
    got = {tuple(r) for r in body_lines(articles(spark, rows), samples).collect()}
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.9 * len(got) and len(want) > 100
    copies = rows + [(f"c{i}", *rows[0][1:]) for i in range(90)]  # copies of an article don't make its lines furniture
    again = {tuple(r) for r in body_lines(articles(spark, copies), samples).collect()}
    assert {x for x in again if x[0] == "u0"} == {x for x in got if x[0] == "u0"}


def test_density_decides(spark, samples, monkeypatch):
    from corpusmill.llm import pagebody

    rows = [("p", PAGE), *((r[0], r[2]) for r in unlisted_rows(random.Random(8)))]
    before = {i: pagebody.read_page(body).furniture for i, body in rows}
    monkeypatch.setattr(pagebody, "density", lambda *_: 1.0)
    after = {i: pagebody.read_page(body).furniture for i, body in rows}
    assert sum(before[i] != after[i] for i in before) > len(before) / 4


def test_long_page_is_read_whole(spark, samples):
    body = "\n".join([f"{i} {SAMPLES['en'][0]}" for i in range(20_000)] + ["12 comments"])
    assert body_lines(articles(spark, [("a", "t", body, "s", "en", "")]), samples).collect()[0].line_no == 20_001


def test_slots_and_residue_rules():
    for slot in ("{{ headline }}", "${author.name}", "#{x}", "{% block a %}", "<%= t %>", "%%PLACE%%", "[[teaser]]", "<<name>>", "__SUB__", "@@DATE@@", "%(city)s", "$TITLE$", "[object Object]", "[INSERT QUOTE]", "{0}", "XX.XX.XXXX", "TODO: lead"):
        assert has_slot(f"Some text {slot} goes on"), slot
    for fine in ("the set {3, 5, 8}", "“[The bridge] will stay,” they said", "50 % of $5", "a_b __init__", None, ""):
        assert not has_slot(fine), fine
    assert residue_text(["Please enable JavaScript to continue."]) and residue_text(["Text goes here. Text goes here. Text goes here."])
    assert residue_text(["Dolvam ametra lupendis corvus magnor sitera fugis nonqua vestra tempora."])
    assert not residue_text([SAMPLES["en"][0] + " Page not found was the riddle."]) and not residue_text([])


def test_long_residue_lines_are_found():
    lorem = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua."
    more = " Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur."
    error = "Page not found on this server. The address may have changed or the page was removed by its editors some time ago. You can go back to the front page, use the search field above or look through the archive of the last years. Something went wrong? Write to the editors and tell them which link brought you to this place."
    assert residue_text([lorem]) and residue_text([lorem + more]) and residue_text([error]) and len(error) > 240
    assert not residue_text([" ".join(SAMPLES["en"]) + " Something went wrong, they said."])
    assert not residue_text(["�� ��� Podol ���� �� �� ��� �� ����. �� ��� ���. �� ��� Doker �� ���� �� ���� ����."])
    assert not residue_text(["Residents were access denied to the old mill on Tuesday evening after the council had approved the plan for the bridge, and the museum kept its report about the water to itself."])


def test_near_copies_of_residue_are_found(spark, samples):
    base = "Page not found. " + " ".join(f"word{i % 7}{chr(97 + i % 23)} stands in the text of this notice for the reader" for i in range(60))
    words = base.split()
    near = words.copy()
    near[400] = "changed"
    rows = [("seed", "t", "Page not found\nPlease try again in 5 minutes.", "s", "en", ""), ("real", "t", SAMPLES["en"][0] * 3, "s", "en", ""), ("slot", "{{ title }}", None, "s", "en", ""), ("slot", "{{ title }}", None, "s", "en", ""), ("n", None, None, None, None, None)]
    docs = articles(spark, rows)
    assert {r[0] for r in residue_pages(docs, samples).collect()} == {"seed", "slot"}
    assert {r[0] for r in without_residue(docs, samples).collect()} == {"real", "n"}
    assert residue_pages(docs.limit(0), samples).count() == 0
    a, b = shingles(words), shingles(near)
    assert jaccard(a, b) >= 0.8 and bin((simhash(a) ^ simhash(b)) & (2**64 - 1)).count("1") <= 8
    assert page_classes(docs, samples).where("class is null").count() == 3


def packed(spark, texts):
    return spark.createDataFrame([(i, zstandard.compress(t.encode())) for i, t in texts.items()], "class bigint, own binary")


def test_spread_from_a_part_of_the_labels(spark, samples):
    rng = random.Random(11)
    notice = "Page not found. The editors moved the page about the {} to the archive of the year {} and keep no address of it here for the readers of this site, who may look for it in the index of all pages or ask the desk."
    rows = [(f"e{i}", "t", notice.format("old mill", 1900 + i), "s", "en", "") for i in range(30)] + [(f"r{i}", "t", " ".join(rng.sample(SAMPLES["en"], 4)) + f" Part {rng.random()}.", "s", "en", "") for i in range(20)]
    docs = articles(spark, rows)
    got = residue_labels(docs, samples, trusted=F.col("article_id") == "e7").collect()
    assert {r.article_id for r in got if r.seed} == {"e7"} and {r.article_id for r in got if r.spread} == {f"e{i}" for i in range(30)}


def test_labels_spread_through_components(spark):
    from corpusmill.llm.residue import spread_labels

    rng = random.Random(2)
    text = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    chain = [text]
    for k in range(3):  # each differs a little from the one before
        nxt = chain[-1].copy()
        nxt[100 * k + 50] = f"new{k}"
        chain.append(nxt)
    other = [f"v{rng.randrange(10**6)}" for _ in range(400)]
    texts = {i: " ".join(t) for i, t in enumerate([*chain, other])}
    rows = [(i, i == 0, simhash(shingles(t.split()))) for i, t in texts.items()]
    pages = spark.createDataFrame(rows, "class bigint, residue boolean, simhash bigint")
    own = packed(spark, texts)
    got = {r[0] for r in spread_labels(pages, lambda wanted: own.join(wanted, "class", "left_semi")).collect()}
    near = {0}
    for i in range(1, 5):  # brute force over links
        near |= {j for j in texts for k in near if bin((rows[j][2] ^ rows[k][2]) & (2**64 - 1)).count("1") <= 4 and jaccard(shingles(texts[j].split()), shingles(texts[k].split())) >= 0.8}
    assert got == near and 4 not in got


def test_labels_reach_every_text_at_the_similarity(spark):
    from corpusmill.llm.residue import SIMILARITY, spread_labels

    rng = random.Random(21)
    texts, labelled = {}, set()
    for base in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([30, 100, 400]))]
        labelled.add(len(texts))
        texts[len(texts)] = words
        for share in (0.005, 0.01, 0.015, 0.02, 0.022, 0.03):
            near = words.copy()
            for at in rng.sample(range(len(words)), max(1, round(share * len(words)))):
                near[at] = f"n{rng.randrange(10**6)}"
            texts[len(texts)] = near
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [(i, j) for i in texts for j in texts if i != j and jaccard(sets[i], sets[j]) >= SIMILARITY]
    want = set(labelled)
    while more := {j for i, j in links if i in want} - want:
        want |= more
    pages = spark.createDataFrame([(i, i in labelled) for i in texts], "class bigint, residue boolean")
    own = packed(spark, {i: " ".join(t) for i, t in texts.items()})
    got = {r[0] for r in spread_labels(pages, lambda wanted: own.join(wanted, "class", "left_semi")).collect()}
    assert got == want and len(labelled) < len(want) < len(texts)


def test_labels_follow_long_chains(spark):
    from corpusmill.llm.residue import spread_labels

    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    own = {}
    for i in range(24):  # one link to the next, none to those after it
        own[i] = " ".join(words)
        words = [*words[5:], *(f"w{rng.randrange(10**6)}" for _ in range(5))]
    pages = spark.createDataFrame([(i, i == 0) for i in own], "class bigint, residue boolean")
    texts = packed(spark, own)
    assert spread_labels(pages, lambda wanted: texts.join(wanted, "class", "left_semi")).count() == 24


def test_batch_fingerprints_match_single_ones():
    rng = random.Random(13)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(rng.choice([0, 1, 4, 5, 6, 90]))] for _ in range(120)]  # no n-gram twice
    assert batch_fingerprints(texts, chunk=300) == [simhash(shingles(t)) for t in texts]
    assert batch_fingerprints([]) == []


def test_table_keys_lose_no_pair():
    rng = random.Random(3)
    for _ in range(200):
        f = rng.getrandbits(64)
        g = f
        for bit in rng.sample(range(64), 4):
            g ^= 1 << bit
        assert set(table_keys(f)) & set(table_keys(g))


def test_language_labels():
    assert [label_language(x) for x in ("en-US", "KO", "Deutsch", "ru_RU", "한국어", "fra", None, "", "auto", "zxx", "it")] == ["en", "ko", "de", "ru", "ko", "fr", None, None, None, None, None]


def test_language_models_on_held_out_text():
    m = LanguageModels(SAMPLES, calibrated=False)
    assert LanguageModels(SAMPLES).temperature > 0
    lines = ["The residents approved the report about the bridge.", "Das Museum billigte den Bericht über die Brücke.", "Les habitants ont approuvé le rapport du musée.", "Жители одобрили доклад музея.", "박물관은 새 다리 보고서를 승인했다.", ""]
    sums, letters = m.line_scores(lines)
    best, sure = m.judge(sums, letters)
    assert [m.languages[i] if i >= 0 else None for i in best] == ["en", "de", "fr", "ru", "ko", None]
    assert (sure[:5] > 0.5).all()
    m.worst[:] = 0.1
    assert (m.judge(sums, letters)[0] == -1).all()


def test_language_scores_match_direct_model():
    from corpusmill.llm.langid import ORDER, _KneserNey, fold

    m = LanguageModels(SAMPLES, calibrated=False)
    text = "The musée билет 다리 zq"
    sums, _ = m.line_scores([text])
    codes = tuple(fold("\n" + text + "\n").tolist())
    for j, name in enumerate(m.languages):
        kn = _KneserNey(SAMPLES[name])
        direct = 0.0
        for i in range(1, len(codes)):
            import math

            direct += math.log(kn.p(codes[max(0, i - ORDER + 1) : i + 1]))
        assert sums[0, j] == pytest.approx(direct, rel=0.03)


def test_wrong_languages(spark, samples):
    body = SAMPLES["en"][0] + "\n" + SAMPLES["en"][1] + "\n" + SAMPLES["de"][0]
    rows = [("a", "t", body, "s", "en-US", ""), ("b", "t", body, "s", "fr", ""), ("b", "t", body, "s", "fr", ""), ("c", "t", body, "s", None, ""), ("d", "t", None, "s", None, ""), ("e", "t", "", "s", "", ""), ("f", "t", "404\nPage not found", "s", None, ""), (None, None, body, None, "English", None)]
    docs = articles(spark, rows)
    got = sorted(map(tuple, wrong_languages(docs, samples).collect()), key=str)
    assert got == sorted([("a", 3, "de"), ("b", 0, "en"), ("b", 3, "de"), ("c", 0, "en"), ("c", 3, "de"), (None, 3, "de")], key=str)
    assert wrong_languages(docs.limit(0), samples).count() == 0
    every = document_languages(docs, samples, carry=("source",))
    assert every.where("line_no = 0").count() == 5 and every.where("confidence > 1 or confidence < 0").count() == 0
