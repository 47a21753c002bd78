"""Per-document text quality statistics and a classifier that tells prose from structural junk.

The statistics are built-in expressions, one narrow projection. The classifier is gradient-boosted
trees fitted on the statistics of a bounded sample of documents (train_rows) that rules label weakly
as prose or junk where independent signals agree, and calibrated on half of the hand-checked texts
below; the other half measures the calibration. What the signals leave undecided the trees decide.
Scoring is a narrow map over all documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.boosting import BoostedTrees
from corpusmill.runtime import ship

#: Documents the trees are fitted on, chosen by the hash of their id.
TRAIN_ROWS = 6_000

# Very common words by language.
COMMON_WORDS = {
    "en": "the a and or but of to in on for with at by from as is was it its this that i my we not has had when after than",
    "de": "der die das den dem des ein eine und oder von zu im in am auf für mit bei aus nach ist war es ich wir nicht hat seit als",
    "fr": "le la les un une des du de et ou à au en dans sur pour par avec ce il je ma ne pas est que qui a nous après",
    "es": "el la los las un una y o de del a al en con por para sin es se su mi me que no más muy como desde lo",
    "pt": "o a os as um uma e ou de do da em no na com por para sem é se meu que não mais muito como desde ao foi",
    "ru": "и в во не на я с что он она как а это но да у же за по из о от мы при или очень так до",
}
KOREAN_ENDINGS = "은|는|이|가|을|를|에|에서|도|의|로|으로|와|과|만|째|고|요|다|서|던|해"
_SPACE = r"[\s\x{a0}\x{3000}]+"
_COMMON = sorted({w for ws in COMMON_WORDS.values() for w in ws.split()})
_END = r"[.!?…。！？][\x{22}\x{27}”“’»)\]]*$"

FEATURES = (
    "n_words", "mean_word_length", "longest_word", "n_lines", "symbol_ratio", "digit_ratio", "separator_ratio", "letter_ratio", "punctuated_line_share",
    "short_line_share", "bullet_line_share", "common_word_share", "digit_word_share", "comma_rate", "distinct_word_share", "sentence_line_share",
)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, FEATURES...) of each row of docs.

    Counts are bigint, shares double between 0 and 1 (comma_rate may be above). Null, empty and blank
    texts have 0 everywhere. Repeated rows stay; other columns aren't read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col),
        text.alias("_t"),
        F.filter(F.split(F.lower(text), _SPACE), lambda w: w != "").alias("_w"),
        F.filter(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, rf"^{_SPACE}|{_SPACE}$", "")), lambda x: x != "").alias("_l"),
    )
    base = base.withColumn("_k", F.transform("_w", lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")))
    n, lines = F.size("_w").cast("double"), F.size("_l").cast("double")
    chars = F.length(F.regexp_replace("_t", _SPACE, "")).cast("double")
    korean = rf"^[가-힣]+({KOREAN_ENDINGS})$"
    line_words = lambda x: F.size(F.split(x, _SPACE))
    sentence = lambda x: x.rlike(_END) & (line_words(x) >= 3) & x.rlike(r"\p{L}{2}")
    total_len = F.aggregate("_l", F.lit(0.0), lambda acc, x: acc + F.length(x))
    return base.select(
        id_col,
        F.size("_w").cast("bigint").alias("n_words"),
        _share(chars, n).alias("mean_word_length"),
        F.coalesce(F.array_max(F.transform("_w", lambda w: F.length(w))), F.lit(0)).cast("bigint").alias("longest_word"),
        F.size("_l").cast("bigint").alias("n_lines"),
        _share(_count(F.col("_t"), r"[^\p{L}\p{N}\s\x{a0}\x{3000}]"), chars).alias("symbol_ratio"),
        _share(_count(F.col("_t"), r"[0-9]"), chars).alias("digit_ratio"),
        _share(_count(F.col("_t"), r"[|\t=#;/&$%*<>{}_~^\\]"), chars + _count(F.col("_t"), r"\t")).alias("separator_ratio"),
        _share(_count(F.col("_t"), r"\p{L}"), chars).alias("letter_ratio"),
        _share(F.size(F.filter("_l", lambda x: x.rlike(_END))).cast("double"), lines).alias("punctuated_line_share"),
        _share(F.size(F.filter("_l", lambda x: line_words(x) <= 4)).cast("double"), lines).alias("short_line_share"),
        _share(F.size(F.filter("_l", lambda x: x.rlike(r"^([-+*•–]|[0-9]+[.)])[\s\x{a0}]"))).cast("double"), lines).alias("bullet_line_share"),
        _share(F.size(F.filter("_k", lambda w: w.isin(*_COMMON) | ((w >= "가") & w.rlike(korean)))).cast("double"), n).alias("common_word_share"),
        _share(F.size(F.filter("_w", lambda w: w.rlike("[0-9]"))).cast("double"), n).alias("digit_word_share"),
        _share(_count(F.col("_t"), ","), n).alias("comma_rate"),
        _share(F.size(F.array_distinct("_k")).cast("double"), n).alias("distinct_word_share"),
        _share(F.aggregate(F.filter("_l", sentence), F.lit(0.0), lambda acc, x: acc + F.length(x)), total_len).alias("sentence_line_share"),
    )


# Hand-checked texts, none of which stands in the tables: the label says whether the greater part isn't prose.
HOLDOUT: tuple[tuple[str, int], ...] = (
    ("The kettle boils quickly and hardly makes a sound. I would buy it again.", 0),
    ("Good enough, I guess.", 0),
    ("Works as told, so far!", 0),
    ("ok since spring", 0),
    ("Could not ask for more, cheers", 0),
    ("not bad at all", 0),
    ("Very happy with the Rulo 440", 0),
    ("NEVER AGAIN. THE HANDLE CAME OFF AFTER TWO DAYS AND NOBODY ANSWERS MY MAILS.", 0),
    ("We had it for a year... then the motor gave up... we are still waiting for a new one...", 0),
    ("- The lid closes well.\n- The handle gets hot when it is full.\n- I would not take it along on a trip.", 0),
    ("The tent kept us dry for the whole week near the lake, which surprised everyone.\n12 cm\n30 W", 0),
    ("Ich habe lange gesucht und bin jetzt sehr zufrieden mit der Lampe. Sie ist leise und hell.", 0),
    ("Geht morgen zur Post.", 0),
    ("Das Kabel ist zu kurz, aber sonst macht das Gerät genau, was es soll.\nDie Farbe gefällt mir nicht.", 0),
    ("Très bien.", 0),
    ("La livraison a pris dix jours et la boîte était ouverte. Je ne suis pas content du tout.", 0),
    ("¡Ni una queja hasta hoy!", 0),
    ("La mochila es cómoda, aunque la cremallera se rompió a los pocos meses. No la compraría otra vez.", 0),
    ("A bateria dura pouco, mas o resto funciona muito bem. Recomendo para quem viaja.", 0),
    ("Ручка удобная, но чайник шумит, и мы его вернули.", 0),
    ("배송이 빨랐고 설명 그대로예요. 다음에도 여기서 살게요.", 0),
    ("좋아요!", 0),
    ("괜찮습니다", 0),
    ("만족", 0),
    ("Perfect fit for our small kitchen, and 3 of my neighbours bought one too.", 0),
    ("Is 4 stars too many? I think not: 20 minutes to set up, 2 years in use, 0 problems.", 0),
    ("kettle, toaster best, lamp cheap, tent sale, kettle 2025, lamp, toaster sale, tent best", 1),
    ("sofa billig, sofa 2025, regal günstig, tisch angebot, regal, tisch billig", 1),
    ("#luxo #nemira #potelo #savi #drota #kemo", 1),
    ("Width | 210 | cm\nWeight | 12 | kg\nPower | 800 | W\nColour | 4 | -", 1),
    ("12\t40\t33\n8\t91\t27\n66\t3\t18", 1),
    ("2025-02-11 08:14 id=5512 state=ok\n2025-02-11 08:15 id=5513 state=lost\n2025-02-12 10:01 id=5519 state=ok", 1),
    ("alpha=3; beta=71; gamma=9; delta=405; eps=12", 1),
    ("8f3a9c01d47be2566a0b91cc83f7e4d29a", 1),
    ("qwrtzplkjhgfdsaxcvbnmqpwoeirutzalskdjfhgqqwz", 1),
    ("x4$ k2% 9f&3 zz8 $p0 b/6 q%%1 h3h 7&a 2$f", 1),
    ("★★☆♥♫★▲▲★♥♫✓✓★☀", 1),
    ("!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!", 1),
    ("......................................", 1),
    ("* lamp x2\n* tent 40 €\n- kettle x1\n+ toaster\n• lamp 9 €\n- tent x7", 1),
    ("- sac x3\n- lampe 12 €\n* théière x2\n+ sac", 1),
    ("- 배낭 x2\n+ 주전자 19 €\n* 탁상등\n• 배낭 x4", 1),
    ("A1; B2; C3; D4; E5; F6; G7; H8", 1),
    ("GET /a/b 200 14ms\nGET /a/c 404 3ms\nPOST /a/d 201 40ms\nGET /a/b 200 11ms", 1),
    ("SKU 4411-2, SKU 4411-3, SKU 4419-9, SKU 5000-1, SKU 5000-2", 1),
    ("Nice lamp.\nwatt | 12\nvolt | 230\nheight | 40\nwidth | 22\nweight | 900\ncolour | red\ncable | 180", 1),
    ("dsfkjh weoiru xcmnvb qpwoe zmxncb alskdj qowieu ghfjdk tyruei", 1),
    ("рюкзак купить, рюкзак дешево, лампа скидка, лампа, чайник купить, чайник 2025", 1),
    ("My neighbour lent me hers for a weekend, and by Monday I had ordered one. It folds flat, it is quiet, and the child likes the colour.", 0),
    ("arrived late but fine", 0),
    ("Stitching came loose at the seam, seller paid me back within a day.", 0),
    ("First one leaked. Second one leaked too. Third one I did not open.", 0),
    ("WOULD BUY AGAIN, ONLY THE BOX WAS WET", 0),
    ("Sturdy... heavy... but it stands where you put it... no complaints from the dog either...", 0),
    ("1. Plug it in.\n2. Wait until the lamp turns green.\n3. Forget that it is there, because it makes no sound at all.", 0),
    ("The battery lasts for two days of walking with the screen on.\n7 V\n1.2 kg\n33 cm", 0),
    ("Nach drei Wochen im Regen ist das Zelt immer noch dicht, nur die Heringe haben sich verbogen.", 0),
    ("Nie wieder!", 0),
    ("tut was er soll", 0),
    ("Die Lampe flackert, wenn der Kühlschrank anspringt. Der Händler meinte, das sei normal. Ist es nicht.", 0),
    ("Un peu bruyant le matin, mais le café est chaud et la machine se nettoie toute seule.", 0),
    ("Rien à redire", 0),
    ("Mon fils l'a cassé en deux jours, ce qui n'est pas la faute du vendeur. Le service a été aimable.", 0),
    ("Cumple, y poco más.", 0),
    ("Se calienta demasiado en verano y la tapa no cierra bien; aun así la uso cada mañana.", 0),
    ("El envío tardó, pero el vendedor respondió a todas mis preguntas y me devolvió una parte del dinero.", 0),
    ("Podia ser mais leve", 0),
    ("O fecho partiu na segunda viagem e a loja não quis saber. Nunca mais compro lá.", 0),
    ("Уже третий год служит без нареканий, хотя дети роняли её не раз.", 0),
    ("Не советую", 0),
    ("Упаковка помялась, зато сам чайник целый и закипает за две минуты.", 0),
    ("가볍고 튼튼해서 산에 갈 때마다 챙깁니다. 색도 사진과 같습니다.", 0),
    ("소리가 조금 커요", 0),
    ("한 달 쓰고 고장 났는데 환불은 안 된다고 합니다. 다시는 안 삽니다.", 0),
    ("Bought 2, gave 1 away, kept 1, and after 14 months I still have no reason to write more than this.", 0),
    ("Is it loud? A bit. Is it ugly? Yes. Does it work? Every single day since May.", 0),
    ("lamp, desk, cheap, sale, lamp 2024, desk lamp, lamp best, chair, chair cheap", 1),
    ("mochila barata, mochila oferta, tienda, tienda 2024, hervidor, hervidor barato", 1),
    ("tente pas cher, tente promo, sac promo, lampe 2024, lampe, sac, réchaud promo", 1),
    ("чайник, чайник цена, лампа 2024, палатка скидка, палатка, лампа цена", 1),
    ("배낭 최저가, 배낭 2024, 텐트 할인, 텐트, 주전자 할인, 주전자", 1),
    ("#tent #lamp #sale #best #nova #kilo #deal", 1),
    ("size;colour;stock\n40;red;3\n41;blue;0\n42;red;17\n43;green;2", 1),
    ("name | qty | unit\nlamp | 3 | pc\ntent | 1 | pc\nrope | 20 | m", 1),
    ("4 8 15 16 23 42 108 7 7 1 0 3 99", 1),
    ("0.12\t0.88\t1.04\n0.19\t0.71\t1.22\n0.33\t0.69\t1.51", 1),
    ("07:14:02 WARN disk=91 node=a4\n07:14:09 INFO disk=90 node=a4\n07:15:41 WARN disk=93 node=b1", 1),
    ("[2024-05-01T10:00:00] rx=1200 tx=88\n[2024-05-01T10:00:30] rx=1408 tx=91", 1),
    ("width=40; height=12; depth=9; mass=1.4; code=B-77", 1),
    ("c29tZSBieXRlcyB0aGF0IG5vYm9keSByZWFkcw0KYWdhaW4=", 1),
    ("ZX-81-QL-16-KB-48-AY-3-8912", 1),
    ("jjjjjjjjjjjjjjjjjjjjjjjjjjjjjjjjjjjjjjjjjj", 1),
    ("lololololololololololololololololololololo", 1),
    ("ㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎㅎ", 1),
    ("mnbvcxzlkjhgfdsapoiuytrewqmnbvcxzlkjhgfdsa", 1),
    ("?????????????????????????????", 1),
    ("♦♦♦ ☆☆☆ ♦♦♦ ☆☆☆ ♦♦♦ ▼▼▼ ▼▼▼", 1),
    ("$$$ %% && ## @@ !! ** ^^ ~~ ++", 1),
    ("p0 q9 r8 s7 t6 u5 v4 w3 x2 y1 z0 a9 b8", 1),
    ("+ Seil 20 m\n+ Zelt x1\n- Lampe 12 €\n* Rucksack x2\n* Kocher 30 €", 1),
    ("• cuerda x2\n• tienda 80 €\n- linterna\n+ cuerda 5 €\n* hornillo", 1),
    ("+ палатка x1\n- лампа 900 ₽\n* верёвка x3\n• лампа x2", 1),
    ("{\"id\": 17, \"state\": \"ok\", \"tags\": [\"a\", \"b\"], \"n\": 4}", 1),
    ("<td>12</td><td>40</td><td>x</td><td>9</td>", 1),
    ("Fine.\nA | 1\nB | 2\nC | 3\nD | 4\nE | 5\nF | 6\nG | 7\nH | 8\nI | 9", 1),
    ("REF 1007 / REF 1008 / REF 1011 / REF 1019 / REF 1020 / REF 1044", 1),
    ("xkq wzv prtl bnm qqz kltr vvb zzpt mrrk ggf", 1),
    ("tent\nlamp\nrope\nstove\nmat\nbag\naxe\npan\ncup", 1),
)
#: Every second text calibrates; the others measure what the calibration is worth, and teach where too few documents do.
CALIBRATION, CHECK = HOLDOUT[::2], HOLDOUT[1::2]


def signals(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(votes for prose, votes for junk) of signals that look at different things: vocabulary, sentences, characters, length."""
    f = {n: x[:, i] for i, n in enumerate(FEATURES)}
    words, common, letters, sentences = f["n_words"], f["common_word_share"], f["letter_ratio"], f["sentence_line_share"]
    several, some = words >= 5, words >= 1
    prose = (
        several & (common >= 0.12),
        several & (sentences >= 0.6),
        some & (letters >= 0.75) & (f["separator_ratio"] == 0) & (f["longest_word"] <= 24) & (f["digit_ratio"] < 0.2),
        some & (words <= 6) & (f["n_lines"] == 1) & (f["longest_word"] <= 20) & (letters >= 0.6) & (f["digit_ratio"] < 0.25) & (f["comma_rate"] < 0.5),
    )
    junk = (
        several & (common <= 0.02),
        several & (sentences <= 0.1),
        some & ((letters < 0.6) | (f["digit_ratio"] > 0.2) | (f["separator_ratio"] > 0.05)),
        2 * (some & (f["longest_word"] > 24) & (words <= 3)),
    )
    return sum(v.astype(int) for v in prose), sum(v.astype(int) for v in junk)


def weak_labels(x: np.ndarray) -> np.ndarray:
    """1 junk or 0 prose where two signals say so and none the other, -1 undecided: those are for the trees."""
    prose, junk = signals(x)
    return np.where((junk >= 2) & (prose == 0), 1, np.where((prose >= 2) & (junk == 0), 0, -1))


def _matrix(rows: list) -> np.ndarray:
    return np.array([[float(v) for v in r] for r in rows], float).reshape(-1, len(FEATURES))


def _held(spark, texts: tuple[tuple[str, int], ...]) -> tuple[np.ndarray, np.ndarray]:
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    return _matrix(text_statistics(rows).orderBy("doc_id").select(*FEATURES).collect()), np.array([label for _, label in texts], float)


def fit_quality(stats: DataFrame, id_col: str = "doc_id", train_rows: int = TRAIN_ROWS) -> BoostedTrees:
    """Trees fitted on about train_rows weakly labelled rows of stats and calibrated on CALIBRATION.

    Where a class has under 20 rows, the texts of CHECK teach too; they never calibrate.
    """
    spark = stats.sparkSession
    total = stats.count()
    keep = min(1.0, train_rows / max(1, total))
    chosen = stats.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < max(1, int(keep * (1 << 20)))).select(*FEATURES).limit(2 * train_rows)
    x = _matrix(chosen.collect())
    x = x[np.lexsort(x.T)]
    y = weak_labels(x)
    x, y = x[y >= 0], y[y >= 0]
    if min((y == 0).sum(), (y == 1).sum()) < 20:
        taught, k = _held(spark, CHECK)
        x, y = np.concatenate([x, np.repeat(taught, 4, 0)]), np.concatenate([y, np.repeat(k, 4)])
    weight = np.where(y == 1, len(y) / max(1, 2 * (y == 1).sum()), 1.0)
    more = np.repeat(np.arange(len(y)), np.clip(np.round(weight), 1, 20).astype(int))  # junk counts as much as prose
    return BoostedTrees().fit(x[more], y[more].astype(float)).calibrate(*_held(spark, CALIBRATION))


def calibration_error(model: BoostedTrees, spark, texts: tuple[tuple[str, int], ...] = CHECK, bins: int = 5) -> tuple[float, float, float]:
    """(accuracy, mean squared error, expected calibration error) of the probabilities on hand-checked texts."""
    x, k = _held(spark, texts)
    p = model.probability(x)
    at = np.minimum((p * bins).astype(int), bins - 1)
    gap = sum(abs(p[at == b].mean() - k[at == b].mean()) * (at == b).mean() for b in range(bins) if (at == b).any())
    return float(((p >= 0.5) == k).mean()), float(((p - k) ** 2).mean()), float(gap)


def junk_probability(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(id, p_junk double): the calibrated probability that the greater part of the text isn't prose.

    0 for null, empty and blank texts. One row for each row of docs; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    stats = text_statistics(docs, id_col, text_col)
    model = spark.sparkContext.broadcast(fit_quality(stats, id_col, train_rows))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns[1:]], 1)
            p = np.where(x[:, 0] > 0, model.value.probability(x), 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=[id_col, "p_junk"])

    kind = docs.schema[id_col].dataType.simpleString()
    return stats.select(id_col, *FEATURES).mapInArrow(run, f"`{id_col}` {kind}, p_junk double")
