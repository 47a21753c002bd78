"""Insight metrics on articles: asymmetry, framing, entities, time, geography and economy.

Columns by role: article_id, topic, lang, source, day (date), ts (timestamp), score (sentiment),
steeps (frame), entity. Rows with a null in a role that a metric groups by are left out; every
metric gives an empty result on empty input. Topic '-1' is noise where a metric says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NOISE = "-1"


def having(df: DataFrame, key: str, least: int) -> DataFrame:
    """Rows of the keys that have at least `least` rows."""
    keys = df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select(key)
    return df.join(keys, key, "left_semi")


def calendar(df: DataFrame, key: str | list[str], day: str = "day", start: Column | None = None, end: Column | None = None) -> DataFrame:
    """(key, day) for every day between the first and last of all rows: one row of bounds, so the cross join is with a single row."""
    keys = [key] if isinstance(key, str) else key
    bounds = df.agg(F.coalesce(start, F.min(day)).alias("_a") if start is not None else F.min(day).alias("_a"), F.coalesce(end, F.max(day)).alias("_b") if end is not None else F.max(day).alias("_b")).where("_a is not null")
    return df.select(*keys).distinct().crossJoin(F.broadcast(bounds)).select(*keys, F.explode(F.sequence("_a", "_b")).alias(day))


def topic_jsd(articles: DataFrame, least: int = 50, window: int = 14, spike: float = 0.15) -> DataFrame:
    """Jensen-Shannon divergence (nats) of the topics of each two languages by day, with rolling mean and spikes."""
    rows = having(articles.where("day is not null and lang is not null and topic is not null"), "lang", least)
    counts = rows.groupBy("day", "lang", "topic").agg(F.count("*").alias("n"))
    share = counts.select("day", "lang", "topic", (F.col("n") / F.sum("n").over(Window.partitionBy("day", "lang"))).alias("p"))
    langs = share.select("day", "lang").distinct()
    a, b = langs.alias("a"), langs.alias("b")
    pairs = a.join(b, (F.col("a.day") == F.col("b.day")) & (F.col("a.lang") < F.col("b.lang"))).select(F.col("a.day").alias("day"), F.col("a.lang").alias("lang_a"), F.col("b.lang").alias("lang_b"))
    sides = [pairs.join(share.withColumnRenamed("lang", f"lang_{x}"), ["day", f"lang_{x}"]).select("day", "lang_a", "lang_b", "topic", (F.col("p") if x == "a" else F.lit(0.0)).alias("p"), (F.col("p") if x == "b" else F.lit(0.0)).alias("q")) for x in "ab"]
    both = sides[0].union(sides[1]).groupBy("day", "lang_a", "lang_b", "topic").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    m = (F.col("p") + F.col("q")) / 2
    term = F.when(F.col("p") > 0, F.col("p") * F.ln(F.col("p") / m)).otherwise(0.0) / 2 + F.when(F.col("q") > 0, F.col("q") * F.ln(F.col("q") / m)).otherwise(0.0) / 2
    out = both.groupBy("day", "lang_a", "lang_b").agg(F.sum(term).alias("jsd"))
    w = Window.partitionBy("lang_a", "lang_b").orderBy("day").rowsBetween(1 - window, 0)
    out = out.withColumn("rolling", F.avg("jsd").over(w))
    return out.withColumn("spike", F.col("jsd") - F.col("rolling") > spike)


def attention_gap(articles: DataFrame, blind: float = 0.005) -> DataFrame:
    """Share of each language's articles by topic: gap, extremes and blind spots."""
    rows = articles.where("lang is not null and topic is not null")
    per_lang = rows.groupBy("lang").agg(F.count("*").alias("total"))
    grid = rows.select("topic").distinct().crossJoin(F.broadcast(per_lang))
    att = grid.join(rows.groupBy("topic", "lang").agg(F.count("*").alias("n")), ["topic", "lang"], "left").select("topic", "lang", (F.coalesce("n", F.lit(0)) / F.col("total")).alias("att"))
    return att.groupBy("topic").agg(
        F.max("att").alias("most"),
        F.min("att").alias("least"),
        F.min_by("lang", F.struct(-F.col("att"), "lang")).alias("most_lang"),
        F.min_by("lang", F.struct("att", "lang")).alias("least_lang"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("att") < blind, F.col("lang")))), ",").alias("blind_spots"),
    ).withColumn("gap", F.col("most") - F.col("least"))


def sentiment_wasserstein(scored: DataFrame, least: int = 10) -> DataFrame:
    """First Wasserstein distance of the scores of each two languages by topic."""
    rows = scored.where("score is not null and lang is not null and topic is not null").select("topic", "lang", "score")
    size = rows.groupBy("topic", "lang").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    a, b = size.alias("a"), size.alias("b")
    pairs = a.join(b, (F.col("a.topic") == F.col("b.topic")) & (F.col("a.lang") < F.col("b.lang"))).select(F.col("a.topic").alias("topic"), F.col("a.lang").alias("lang_a"), F.col("b.lang").alias("lang_b"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"))
    steps = [pairs.join(rows.withColumnRenamed("lang", f"lang_{x}"), ["topic", f"lang_{x}"]).select("topic", "lang_a", "lang_b", "score", ((1 / F.col("na")) if x == "a" else (-1 / F.col("nb"))).alias("step")) for x in "ab"]
    at = steps[0].union(steps[1]).groupBy("topic", "lang_a", "lang_b", "score").agg(F.sum("step").alias("step"))
    w = Window.partitionBy("topic", "lang_a", "lang_b").orderBy("score")
    at = at.select("topic", "lang_a", "lang_b", F.abs(F.sum("step").over(w)).alias("gap"), (F.lead("score").over(w) - F.col("score")).alias("width"))
    return at.groupBy("topic", "lang_a", "lang_b").agg(F.coalesce(F.sum(F.col("gap") * F.col("width")), F.lit(0.0)).alias("distance"))


def filter_bubble(articles: DataFrame, least: int = 5) -> DataFrame:
    """Jaccard of the topics that each two languages cover with at least `least` articles."""
    covered = articles.where("lang is not null and topic is not null").groupBy("lang", "topic").agg(F.count("*").alias("n"))
    sets = covered.groupBy("lang").agg(F.collect_set(F.when(F.col("n") >= least, F.col("topic"))).alias("s"))
    a, b = sets.alias("a"), sets.alias("b")
    both, either = F.size(F.array_intersect("a.s", "b.s")), F.size(F.array_union("a.s", "b.s"))
    return a.join(b, F.col("a.lang") < F.col("b.lang")).select(F.col("a.lang").alias("lang_a"), F.col("b.lang").alias("lang_b"), F.when(either > 0, both / either).otherwise(0.0).alias("overlap"))


def frame_evolution(scored: DataFrame, frames: tuple[str, ...]) -> DataFrame:
    """Share of each frame among the framed articles, by topic and day."""
    rows = scored.where(F.col("steeps").isin(*frames) & F.col("day").isNotNull())
    return rows.groupBy("topic", "day").agg(*(F.avg((F.col("steeps") == f).cast("double")).alias(f"share_{f.lower()}") for f in frames), F.count("*").alias("total"))


def frame_shift(evolution: DataFrame, frames: tuple[str, ...], eps: float = 1e-10) -> DataFrame:
    """Kullback-Leibler divergence of the frames from the day before, both smoothed."""
    cols = [f"share_{f.lower()}" for f in frames]
    w = Window.partitionBy("topic").orderBy("day")
    total = sum((F.col(c) + eps for c in cols[1:]), F.col(cols[0]) + eps)
    now = evolution.select("topic", "day", F.array(*((F.col(c) + eps) / total for c in cols)).alias("q"))
    pairs = now.withColumn("p", F.lag("q").over(w)).where("p is not null")
    return pairs.select("topic", "day", F.aggregate(F.zip_with("p", "q", lambda x, y: x * F.ln(x / y)), F.lit(0.0), lambda a, x: a + x).alias("kl"))


def voice_dominance(mentions: DataFrame) -> DataFrame:
    """Herfindahl-Hirschman index of the entities of each topic, with the leading one."""
    counts = mentions.where("entity is not null and topic is not null").groupBy("topic", "entity").agg(F.count("*").alias("n"))
    share = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("topic")))
    out = share.groupBy("topic").agg(F.sum(F.col("share") ** 2).alias("hhi"), F.min_by("entity", F.struct(-F.col("n"), "entity")).alias("top"), F.max("share").alias("top_share"), F.count("*").alias("voices"), F.sum("n").alias("mentions"))
    return out.withColumn("class", F.when(F.col("hhi") >= 0.25, "oligopoly").when(F.col("hhi") <= 0.10, "healthy").otherwise("moderate"))


def entropy(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, bits, kinds): Shannon entropy of the values in each group."""
    counts = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))
    p = counts.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy(group)))
    return p.groupBy(group).agg((-F.sum(F.col("p") * F.log2("p"))).alias("bits"), F.count("*").alias("kinds"))


def media_health(scored: DataFrame, mentions: DataFrame, frames: int = 6) -> DataFrame:
    """Weighted diversity of sources and frames and dispersion of voices by topic, with a grade."""
    src = entropy(scored, "topic", "source").select("topic", F.when(F.col("kinds") > 1, F.col("bits") / F.log2("kinds")).otherwise(0.0).alias("s"))
    frm = entropy(scored, "topic", "steeps").select("topic", (F.col("bits") / F.log2(F.lit(frames))).alias("f"))
    out = src.join(frm, "topic", "left").join(voice_dominance(mentions).select("topic", "hhi"), "topic", "left")
    score = 0.4 * F.col("s") + 0.3 * F.coalesce("f", F.lit(0.0)) + 0.3 * (1 - F.coalesce("hhi", F.lit(0.0)))
    return out.select("topic", score.alias("health")).withColumn("grade", F.when(F.col("health") >= 0.7, "healthy").when(F.col("health") >= 0.4, "moderate").otherwise("poor"))


def source_credibility(articles: DataFrame) -> DataFrame:
    """Claims of each source in clusters (topic, day) of two or more sources, all of them corroborated."""
    rows = articles.where("day is not null and source is not null and topic <> '-1'").select("topic", "day", "source", "article_id")
    wide = rows.groupBy("topic", "day").agg(F.count_distinct("source").alias("n")).where("n >= 2").select("topic", "day")
    return rows.join(wide, ["topic", "day"], "left_semi").groupBy("source").agg(F.count("*").alias("claims"), F.count("*").alias("corroborated"), F.lit(1.0).alias("credibility"))


def entity_reach(mentions: DataFrame) -> DataFrame:
    """Languages and mentions of each entity by ISO week."""
    from corpusmill.functions.text import iso_week

    rows = mentions.where("day is not null and entity is not null").withColumn("week", iso_week(F.col("day")))
    return rows.groupBy("entity", "week").agg(F.count_distinct("lang").alias("n_langs"), F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"), F.count("*").alias("mentions"))


def entity_emergence(mentions: DataFrame, top: int = 1000, days: int = 14, least: float = 0.05) -> DataFrame:
    """Slope and acceleration of the cumulative mentions in the first `days` days of the most mentioned entities."""
    rows = mentions.where("day is not null and entity is not null").select("entity", "day")
    keep = rows.groupBy("entity").agg(F.count("*").alias("n"), F.min("day").alias("first")).orderBy(F.desc("n"), "entity").limit(top)
    daily = rows.groupBy("entity", "day").agg(F.count("*").alias("c"))
    grid = keep.select("entity", "first", F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("x")).withColumn("day", F.date_add("first", F.col("x")))
    y = F.sum(F.coalesce("c", F.lit(0))).over(Window.partitionBy("entity").orderBy("x"))
    cum = grid.join(daily, ["entity", "day"], "left").select("entity", "x", y.alias("y"))
    mid = (days - 1) / 2
    p1 = F.col("x") - F.lit(mid)
    second = sum((i - mid) ** 2 for i in range(days)) / days
    p2 = p1 * p1 - F.lit(second)
    s2 = sum(((i - mid) ** 2 - second) ** 2 for i in range(days))
    s1 = sum((i - mid) ** 2 for i in range(days))
    out = cum.groupBy("entity").agg((F.sum(p1 * F.col("y")) / s1).alias("slope"), (2 * F.sum(p2 * F.col("y")) / s2).alias("acceleration"))
    return out.withColumn("emerging", F.col("acceleration") >= least)


def cooccurrence(mentions: DataFrame, within: str = "article_id", least: int = 1) -> DataFrame:
    """(entity_a, entity_b, weight): pairs of different entities in the same unit; units that hold very many entities are the caller's to bound."""
    rows = mentions.where(F.col("entity").isNotNull()).select(F.col(within).alias("_u"), "entity").distinct()
    a, b = rows.alias("a"), rows.alias("b")
    pairs = a.join(b, (F.col("a._u") == F.col("b._u")) & (F.col("a.entity") < F.col("b.entity")))
    return pairs.groupBy(F.col("a.entity").alias("entity_a"), F.col("b.entity").alias("entity_b")).agg(F.count("*").alias("weight")).where(F.col("weight") >= least)


def hidden_connections(edges: DataFrame, least: float = 0.3) -> DataFrame:
    """Pairs without an edge whose neighbours' Jaccard is at least `least`."""
    both = edges.select("entity_a", "entity_b").union(edges.select("entity_b", "entity_a")).distinct().toDF("x", "y")
    degree = both.groupBy("x").agg(F.count("*").alias("n"))
    a, b = both.alias("a"), both.alias("b")
    shared = a.join(b, (F.col("a.y") == F.col("b.y")) & (F.col("a.x") < F.col("b.x"))).groupBy(F.col("a.x").alias("entity_a"), F.col("b.x").alias("entity_b")).agg(F.count("*").alias("shared"))
    shared = shared.join(edges.select("entity_a", "entity_b"), ["entity_a", "entity_b"], "left_anti")
    out = shared.join(degree.select(F.col("x").alias("entity_a"), F.col("n").alias("na")), "entity_a").join(degree.select(F.col("x").alias("entity_b"), F.col("n").alias("nb")), "entity_b")
    out = out.withColumn("jaccard", F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared")))
    return out.where(F.col("jaccard") >= least).select("entity_a", "entity_b", "jaccard")


def velocity(articles: DataFrame, hours: float = 72) -> DataFrame:
    """Mean lag in hours between the first articles of each two languages on a topic, by ordered pair."""
    first = articles.where("ts is not null and lang is not null").groupBy("topic", "lang").agg(F.min("ts").alias("t"))
    a, b = first.alias("a"), first.alias("b")
    later = (F.col("a.t") < F.col("b.t")) | ((F.col("a.t") == F.col("b.t")) & (F.col("a.lang") < F.col("b.lang")))
    lag = (F.unix_micros("b.t") - F.unix_micros("a.t")) / 3.6e9
    pairs = a.join(b, (F.col("a.topic") == F.col("b.topic")) & (F.col("a.lang") != F.col("b.lang")) & later).where(lag <= hours)
    return pairs.groupBy(F.col("a.lang").alias("leader"), F.col("b.lang").alias("follower")).agg(F.avg(lag).alias("lag_hours"), F.count("*").alias("topics"))


def agenda(articles: DataFrame) -> DataFrame:
    """Share of the topics that each language opens, and the mean lag of those that follow it."""
    first = articles.where("ts is not null and lang is not null and topic <> '-1'").groupBy("topic", "lang").agg(F.min("ts").alias("t"))
    w = Window.partitionBy("topic").orderBy("t", "lang")
    rank = first.withColumn("rank", F.row_number().over(w)).withColumn("lead", F.first("lang").over(w)).withColumn("t0", F.first("t").over(w)).withColumn("n", F.count("*").over(Window.partitionBy("topic"))).where("n >= 2")
    lag = (F.unix_micros("t") - F.unix_micros("t0")) / 3.6e9
    lead = rank.groupBy(F.col("lead").alias("lang")).agg(F.count_distinct("topic").alias("led"), F.avg(F.when(F.col("rank") > 1, lag)).alias("mean_lag_hours"))
    return rank.groupBy("lang").agg(F.count("*").alias("topics")).join(lead, "lang", "left").select("lang", "topics", F.coalesce("led", F.lit(0)).alias("led"), (F.coalesce("led", F.lit(0)) / F.col("topics")).alias("leader_score"), "mean_lag_hours")


def dft_cycles(series: DataFrame, key: str, least_days: int = 14, ratio: float = 3.0) -> DataFrame:
    """Dominant cycle of each daily series by the discrete Fourier transform of its detrended values."""
    w = Window.partitionBy(key)
    rows = series.withColumn("t", F.row_number().over(w.orderBy("day")) - 1).withColumn("n", F.count("*").over(w)).withColumn("y", F.col("value") - F.avg("value").over(w)).where(F.col("n") >= least_days)
    waves = rows.select(key, "n", "t", "y", F.explode(F.sequence(F.lit(1), F.floor(F.col("n") / 2).cast("int"))).alias("k"))
    angle = 2 * F.pi() * F.col("k") * F.col("t") / F.col("n")
    power = waves.groupBy(key, "n", "k").agg((F.sum(F.col("y") * F.cos(angle)) ** 2 + F.sum(F.col("y") * F.sin(angle)) ** 2).alias("power"))
    out = power.groupBy(key, "n").agg(F.min_by("k", F.struct(-F.round("power", 6), "k")).alias("k"), F.max("power").alias("top"), F.avg("power").alias("mean"))
    period = F.round(F.col("n") / F.col("k"), 1)
    kind = F.when(period.between(5, 9), "weekly").when(period.between(25, 35), "monthly").when(period.between(350, 380), "annual").otherwise(F.concat(F.lit("~"), F.round(period).cast("int").cast("string"), F.lit("d")))
    return out.select(key, period.alias("period"), (F.col("top") / F.col("mean")).alias("ratio"), kind.alias("kind")).withColumn("cyclic", F.col("ratio") >= ratio)


def keyword_share(articles: DataFrame, patterns: dict[str, str], text: Column) -> DataFrame:
    """Share of each language's articles that match its pattern, by day."""
    hit = F.lit(None).cast("boolean")
    for lang, pattern in patterns.items():
        hit = F.when(F.col("lang") == lang, text.rlike(pattern)).otherwise(hit)
    return articles.withColumn("_hit", hit).where("_hit is not null and day is not null").groupBy("lang", "day").agg(F.avg(F.col("_hit").cast("double")).alias("share"), F.count("*").alias("n"))


def gradient(series: DataFrame, key: str, value: str) -> DataFrame:
    """First and second numerical derivative at unit spacing: central inside, one-sided at the ends, 0 for single points."""
    w = Window.partitionBy(key).orderBy("day")

    def slope(c: str) -> Column:
        prev, nxt = F.lag(c).over(w), F.lead(c).over(w)
        return F.when(prev.isNull() & nxt.isNull(), 0.0).when(prev.isNull(), nxt - F.col(c)).when(nxt.isNull(), F.col(c) - prev).otherwise((nxt - prev) / 2)

    return series.withColumn("velocity", slope(value)).withColumn("acceleration", slope("velocity")).withColumn("early_warning", (F.col("velocity") > 0) & (F.col("acceleration") < 0))


def mood_index(scored: DataFrame, emotions: tuple[str, ...]) -> DataFrame:
    """Mean sentiment of each source and day, damped by the entropy of its mean emotions."""
    rows = scored.groupBy("source", F.coalesce(F.date_format("day", "yyyy-MM-dd"), F.lit("unknown")).alias("day")).agg(F.avg("score").alias("mean"), F.count("*").alias("n"), *(F.avg(e).alias(e) for e in emotions))
    total = sum((F.coalesce(e, F.lit(0.0)) for e in emotions[1:]), F.coalesce(emotions[0], F.lit(0.0)))
    p = F.filter(F.array(*(F.coalesce(e, F.lit(0.0)) / total for e in emotions)), lambda v: v > 0)
    h = -F.aggregate(p, F.lit(0.0), lambda a, v: a + v * F.log2(v))
    return rows.withColumn("mood", F.round(F.col("mean") * (1 - F.coalesce(F.when(total > 0, h), F.lit(0.0)) / 3), 4) + F.lit(0.0))


def daily_series(scored: DataFrame, emotions: tuple[str, ...] = ()) -> DataFrame:
    """Articles and mean sentiment of each topic and day, days without articles included, and of all topics as 'all'.

    Totals come from grouping sets, so the input is read once.
    """
    rows = scored.where("day is not null and topic is not null")
    agg = rows.groupingSets([["topic", "day"], ["day"]], "topic", "day").agg(F.grouping("topic").alias("_g"), F.count("*").alias("volume"), F.avg("score").alias("sentiment"))
    agg = agg.select(F.when(F.col("_g") == 1, "all").otherwise(F.col("topic")).alias("topic"), "day", "volume", "sentiment")
    return calendar(agg, "topic").join(agg, ["topic", "day"], "left").select("topic", "day", F.coalesce("volume", F.lit(0)).alias("volume"), "sentiment")


def moving_averages(series: DataFrame, key: str, value: str, short: int = 3, long: int = 14) -> DataFrame:
    """Means of the last rows once there are enough, and the direction of their difference."""
    w = Window.partitionBy(key).orderBy("day")

    def full(n: int) -> Column:
        frame = w.rowsBetween(1 - n, 0)
        return F.when(F.count(F.lit(1)).over(frame) == n, F.avg(value).over(frame))

    out = series.withColumn("ma_short", full(short)).withColumn("ma_long", full(long)).withColumn("_d", F.col("ma_short") - F.col("ma_long"))
    before = F.lag("_d").over(w)
    signal = F.when(F.col("_d").isNull() | before.isNull(), None).when((F.col("_d") > 0) & (F.col("_d") > before), "rising").when((F.col("_d") < 0) & (F.col("_d") < before), "declining").otherwise("neutral")
    return out.withColumn("ma_signal", signal).drop("_d")


def lead_lag(series: DataFrame, key: str, value: str, lags: int = 7, least: float = 0.1) -> DataFrame:
    """Normalised cross-correlation of each two series within +-lags days: the lag of the largest |r|."""
    w = Window.partitionBy(key)
    z = series.withColumn("m", F.avg(value).over(w)).withColumn("s", F.stddev_pop(value).over(w)).withColumn("n", F.count("*").over(w)).where("s > 0").select(key, "day", ((F.col(value) - F.col("m")) / F.col("s")).alias("z"), "n")
    a = z.select(F.col(key).alias("a"), "day", F.col("z").alias("za"), "n", F.explode(F.sequence(F.lit(-lags), F.lit(lags))).alias("lag")).withColumn("day", F.date_add("day", F.col("lag")))
    b = z.select(F.col(key).alias("b"), "day", F.col("z").alias("zb"))
    r = a.join(b, "day").where("a < b").groupBy("a", "b", "lag").agg((F.sum(F.col("za") * F.col("zb")) / F.max("n")).alias("r"))
    best = r.groupBy("a", "b").agg(F.min_by(F.struct("lag", "r"), F.struct(-F.round(F.abs("r"), 6), F.abs("lag"), "lag")).alias("x")).select("a", "b", "x.lag", "x.r")
    return best.where(F.abs("r") > least).withColumn("leader", F.when(F.col("lag") > 0, F.col("a")).when(F.col("lag") < 0, F.col("b")))


def kaplan_meier_median(spans: DataFrame, key: str, duration: str, event: str) -> DataFrame:
    """Median survival of each group: the first time at which the product of 1 - deaths / at risk is at most one half; else the longest time."""
    at = spans.groupBy(key, duration).agg(F.sum(F.col(event).cast("int")).alias("d"), F.count("*").alias("c"))
    w = Window.partitionBy(key).orderBy(F.desc(duration))
    at = at.withColumn("risk", F.sum("c").over(w))
    logs = F.when(F.col("d") == F.col("risk"), F.lit(-1e9)).otherwise(F.ln(1 - F.col("d") / F.col("risk")))
    s = at.withColumn("s", F.exp(F.sum(logs).over(Window.partitionBy(key).orderBy(duration))))
    return s.groupBy(key).agg(F.coalesce(F.min(F.when(F.col("s") <= 0.5 + 1e-12, F.col(duration))), F.max(duration)).alias("median"))
