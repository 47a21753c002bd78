"""Insight metrics over the article tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.operators import insights as I
from corpusmill.plans.bindings import ANA, ART, EMOTIONS, ENT, STEEPS, analysis, articles, entities, r6, registry

QUERIES, SQL, query = registry()

# Words of economic policy uncertainty, of sectors and of economic narratives.
EPU = {
    "en": "economy|economic|policy|regulation|uncertainty|uncertain|deficit|budget|federal reserve|congress|legislation|tariff|trade war",
    "ko": "경제|정책|규제|불확실|불안|재정|적자|금리|한은|한국은행|국회|입법|관세|무역",
    "de": "wirtschaft|politik|regulierung|unsicherheit|haushalt|defizit|zinsen|bundestag|gesetz|zoll",
    "es": "economía|económico|política|regulación|incertidumbre|déficit|presupuesto|legislación|arancel|comercio",
    "fr": "économie|économique|politique|réglementation|incertitude|déficit|budget|législation|tarif",
    "pt": "economia|econômico|política|regulamentação|incerteza|déficit|orçamento|legislação|tarifa",
    "ru": "экономика|экономический|политика|регулирование|неопределённость|дефицит|бюджет|законодательство|тариф|торговля",
}
SECTORS = {
    "energy": "oil|gas|solar|renewable|energy|petroleum|opec|nuclear power|wind power|coal|electricity|원유|석유|가스|태양광|에너지|신재생|원자력|전력|석탄|풍력",
    "technology": "artificial intelligence|semiconductor|chip|software|cloud|quantum|robot|blockchain|data center|cybersecurity|startup|인공지능|반도체|칩|소프트웨어|클라우드|양자|로봇|블록체인|데이터센터|스타트업",
    "healthcare": "pharmaceutical|vaccine|drug|hospital|medical|health|biotech|clinical trial|cancer|pandemic|therapy|제약|백신|의약품|병원|의료|건강|바이오|임상시험|식약처|팬데믹|치료",
    "financial": "bank|interest rate|stock|bond|market|investment|inflation|central bank|forex|credit|insurance|fintech|은행|금리|주식|채권|시장|투자|인플레이션|한은|중앙은행|환율|보험|핀테크",
    "manufacturing": "factory|supply chain|manufacturing|production|automobile|steel|shipbuilding|export|import|logistics|warehouse|공장|공급망|제조|생산|자동차|철강|조선|수출|수입|물류|창고",
}
NARRATIVES = {
    "recession": "recession|downturn|contraction|slowdown|불황|경기침체|위축|둔화",
    "inflation": "inflation|price surge|cost of living|cpi|인플레이션|물가|생활비|소비자물가",
    "bubble": "bubble|overvalued|speculation|crash|버블|거품|과대평가|투기",
    "growth": "growth|expansion|boom|recovery|gdp|성장|확장|호황|회복",
    "crisis": "crisis|collapse|meltdown|default|bailout|위기|붕괴|부도|구제금융",
}
SCO = f"{ART}, {ANA}, sco as (select art.*, ana.* exclude (article_id) from art join ana using (article_id))"
_FR = "', '".join(STEEPS)
_TEXT = "lower(coalesce(title, '') || ' ' || coalesce(body, ''))"


def text_col():
    return F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("body", F.lit(""))))


def scored(spark, d):
    return articles(spark, d).join(analysis(spark, d), "article_id")


JSD = f"""with {ART}, r as (select * from art where day is not null and lang in (select lang from art where day is not null group by lang having count(*) >= 50)),
    s as (select day, lang, topic, count(*) / sum(count(*)) over (partition by day, lang) as p from r group by day, lang, topic),
    l as (select distinct day, lang from s), g as (select a.day, a.lang as lang_a, b.lang as lang_b from l a join l b on a.day = b.day and a.lang < b.lang),
    t as (select g.day, lang_a, lang_b, u.topic, coalesce(x.p, 0) as p, coalesce(y.p, 0) as q from g
          join (select distinct day, topic from s) u on u.day = g.day left join s x on x.day = g.day and x.lang = lang_a and x.topic = u.topic left join s y on y.day = g.day and y.lang = lang_b and y.topic = u.topic),
    j as (select day, lang_a, lang_b, sum(case when p > 0 then p * ln(2 * p / (p + q)) else 0 end + case when q > 0 then q * ln(2 * q / (p + q)) else 0 end) / 2 as jsd from t group by all),
    w as (select *, avg(jsd) over (partition by lang_a, lang_b order by day rows between 13 preceding and current row) as rolling from j)"""


@query(JSD + " select cast(day as varchar) as day, lang_a, lang_b, round(jsd, 6) as jsd, round(rolling, 6) as rolling, round(jsd - rolling, 6) > 0.15 as spike from w")
def cl1_jsd(spark, d):
    return I.topic_jsd(articles(spark, d)).select(F.col("day").cast("string").alias("day"), "lang_a", "lang_b", r6("jsd", "jsd"), r6("rolling", "rolling"), (F.round(F.col("jsd") - F.col("rolling"), 6) > 0.15).alias("spike"))


@query(
    f"with {ART}, t as (select lang, count(*) as total from art group by lang), g as (select u.topic, t.lang, coalesce(n.n, 0) / total as att from (select distinct topic from art) u cross join t left join (select topic, lang, count(*) as n from art group by all) n on n.topic = u.topic and n.lang = t.lang) "
    "select topic, round(max(att) - min(att), 6) as gap, arg_min(lang, (-att, lang)) as most_lang, arg_min(lang, (att, lang)) as least_lang, coalesce(string_agg(lang, ',' order by lang) filter (where att < 0.005), '') as blind_spots from g group by topic"
)
def cl2_attention_gap(spark, d):
    return I.attention_gap(articles(spark, d)).select("topic", r6("gap", "gap"), "most_lang", "least_lang", "blind_spots")


@query(
    f"with {SCO}, r as (select topic, lang, score from sco where score is not null), n as (select topic, lang, count(*) as n from r group by all having count(*) >= 10), "
    "p as (select a.topic, a.lang as lang_a, b.lang as lang_b, a.n as na, b.n as nb from n a join n b on a.topic = b.topic and a.lang < b.lang), "
    "s as (select p.topic, lang_a, lang_b, score, 1 / na as step from p join r on r.topic = p.topic and r.lang = lang_a union all select p.topic, lang_a, lang_b, score, -1 / nb from p join r on r.topic = p.topic and r.lang = lang_b), "
    "u as (select topic, lang_a, lang_b, score, sum(step) as step from s group by all), "
    "v as (select *, abs(sum(step) over w) as gap, lead(score) over w - score as width from u window w as (partition by topic, lang_a, lang_b order by score)) "
    "select topic, lang_a, lang_b, round(coalesce(sum(gap * width), 0), 6) as distance from v group by all"
)
def cl3_wasserstein(spark, d):
    return I.sentiment_wasserstein(scored(spark, d)).select("topic", "lang_a", "lang_b", r6("distance", "distance"))


@query(
    f"with {ART}, c as (select lang, topic, count(*) as n from art group by all), s as (select lang, coalesce(list(topic) filter (where n >= 5), []) as s from c group by lang) "
    "select a.lang as lang_a, b.lang as lang_b, round(case when len(list_distinct(list_concat(a.s, b.s))) > 0 then len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) else 0 end, 6) as overlap from s a join s b on a.lang < b.lang"
)
def cl4_filter_bubble(spark, d):
    return I.filter_bubble(articles(spark, d)).select("lang_a", "lang_b", r6("overlap", "overlap"))


_EVO = f"evo as (select topic, day, " + ", ".join(f"avg(cast(steeps = '{f}' as int)) as share_{f.lower()}" for f in STEEPS) + f", count(*) as total from sco where steeps in ('{_FR}') and day is not null group by topic, day)"


@query(f"with {SCO}, {_EVO} select topic, cast(day as varchar) as day, " + ", ".join(f"round(share_{f.lower()}, 6) as share_{f.lower()}" for f in STEEPS) + ", total from evo")
def nf1_frame_evolution(spark, d):
    e = I.frame_evolution(scored(spark, d), STEEPS)
    return e.select("topic", F.col("day").cast("string").alias("day"), *(r6(f"share_{f.lower()}", f"share_{f.lower()}") for f in STEEPS), "total")


_EPS = " + ".join(f"share_{f.lower()} + 1e-10" for f in STEEPS)


@query(f"with {SCO}, {_EVO}, q as (select topic, day, " + ", ".join(f"(share_{f.lower()} + 1e-10) / ({_EPS}) as {f.lower()}" for f in STEEPS) + " from evo), p as (select *, " + ", ".join(f"lag({f.lower()}) over (partition by topic order by day) as p{f.lower()}" for f in STEEPS) + " from q) select topic, cast(day as varchar) as day, round(" + " + ".join(f"p{f.lower()} * ln(p{f.lower()} / {f.lower()})" for f in STEEPS) + ", 6) as kl from p where ps is not null")
def nf2_frame_shift(spark, d):
    e = I.frame_shift(I.frame_evolution(scored(spark, d), STEEPS), STEEPS)
    return e.select("topic", F.col("day").cast("string").alias("day"), r6("kl", "kl"))


_HHI = "hc as (select topic, entity, count(*) as n from ent group by all), hs as (select *, n / sum(n) over (partition by topic) as share from hc), hhi as (select topic, sum(share * share) as hhi, arg_min(entity, (-n, entity)) as top, max(share) as top_share, count(*) as voices, cast(sum(n) as bigint) as mentions from hs group by topic)"


@query(f"with {ART}, {ENT}, {_HHI} select topic, round(hhi, 6) as hhi, top, round(top_share, 6) as top_share, voices, mentions, case when hhi >= 0.25 then 'oligopoly' when hhi <= 0.1 then 'healthy' else 'moderate' end as class from hhi")
def nf3_hhi(spark, d):
    return I.voice_dominance(entities(spark, d)).select("topic", r6("hhi", "hhi"), "top", r6("top_share", "top_share"), "voices", "mentions", "class")


def _ent_sql(value: str, name: str) -> str:
    return f"{name} as (select topic, -sum(p * log2(p)) as bits, count(*) as kinds from (select topic, n / sum(n) over (partition by topic) as p from (select topic, {value}, count(*) as n from sco where {value} is not null group by all)) group by topic)"


@query(
    f"with {SCO}, {ENT}, {_HHI}, {_ent_sql('source', 'es')}, {_ent_sql('steeps', 'ef')}, h as (select es.topic, 0.4 * case when es.kinds > 1 then es.bits / log2(es.kinds) else 0 end + 0.3 * coalesce(ef.bits / log2(6), 0) + 0.3 * (1 - coalesce(hhi, 0)) as health from es left join ef using (topic) left join hhi using (topic)) "
    "select topic, round(health, 6) as health, case when health >= 0.7 then 'healthy' when health >= 0.4 then 'moderate' else 'poor' end as grade from h"
)
def nf4_media_health(spark, d):
    return I.media_health(scored(spark, d), entities(spark, d)).select("topic", r6("health", "health"), "grade")


@query(f"with {ART}, r as (select * from art where day is not null and topic <> '-1'), w as (select topic, day from r group by all having count(distinct source) >= 2) select source, count(*) as claims, count(*) as corroborated, 1.0 as credibility from r join w using (topic, day) group by source")
def nf6_credibility(spark, d):
    return I.source_credibility(articles(spark, d)).where("source is not null")


SQL["nf6_credibility"] = SQL["nf6_credibility"].replace("1.0 as credibility", "cast(1 as double) as credibility").replace("group by source", "where source is not null group by source")


@query(f"with {ART}, {ENT} select entity, strftime(day, '%G-W%V') as week, count(distinct lang) as n_langs, string_agg(distinct lang, ',' order by lang) as langs, count(*) as mentions from ent where day is not null group by entity, week")
def ea4_reach(spark, d):
    return I.entity_reach(entities(spark, d))


@query(
    f"with {ART}, {ENT}, k as (select entity, count(*) as n, min(day) as first from ent where day is not null group by entity order by n desc, entity limit 1000), g as (select entity, first, x, first + cast(x as integer) as day from k, (select unnest(generate_series(0, 13)) as x)), "
    "c as (select entity, day, count(*) as c from ent where day is not null group by all), y as (select g.entity, x - 6.5 as u, sum(coalesce(c.c, 0)) over (partition by g.entity order by x) as y from g left join c on c.entity = g.entity and c.day = g.day) "
    "select entity, round(sum(u * y) / 227.5, 6) as slope, round(2 * sum((u * u - 16.25) * y) / 2912, 6) as acceleration from y group by entity"
)
def ea3_emergence(spark, d):
    return I.entity_emergence(entities(spark, d)).select("entity", r6("slope", "slope"), r6("acceleration", "acceleration"))


_EDGE = "edge as (select a.entity as entity_a, b.entity as entity_b, count(*) as weight from (select distinct article_id, entity from ent) a join (select distinct article_id, entity from ent) b on a.article_id = b.article_id and a.entity < b.entity group by all)"


@query(f"with {ART}, {ENT}, {_EDGE} select entity_a, entity_b, weight from edge")
def cooc_edges(spark, d):
    return I.cooccurrence(entities(spark, d))


@query(
    f"with {ART}, {ENT}, {_EDGE}, big as (select * from edge where weight >= 2), bo as (select entity_a as x, entity_b as y from big union select entity_b, entity_a from big), dg as (select x, count(*) as n from bo group by x), "
    "sh as (select a.x as entity_a, b.x as entity_b, count(*) as s from bo a join bo b on a.y = b.y and a.x < b.x group by all) select entity_a, entity_b, round(s / (p.n + q.n - s), 6) as jaccard from sh join dg p on p.x = entity_a join dg q on q.x = entity_b "
    "where s / (p.n + q.n - s) >= 0.3 and not exists (select 1 from big e where e.entity_a = sh.entity_a and e.entity_b = sh.entity_b)"
)
def ea2_hidden(spark, d):
    return I.hidden_connections(I.cooccurrence(entities(spark, d), least=2)).select("entity_a", "entity_b", r6("jaccard", "jaccard"))


@query(f"with {ART}, {ENT}, {_EDGE} select entity_a, entity_b, case when weight >= 10 then 'located_in' else 'mentioned_with' end as relation, round(least(1, ln(1 + weight) / 10), 6) as strength from edge where weight >= 3")
def kg_edges(spark, d):
    e = I.cooccurrence(entities(spark, d), least=3)
    return e.select("entity_a", "entity_b", F.when(F.col("weight") >= 10, "located_in").otherwise("mentioned_with").alias("relation"), r6(F.least(F.lit(1.0), F.log1p("weight") / 10), "strength"))


@query(
    f"with {ART}, f as (select topic, lang, min(ts) as t from art where ts is not null group by all), p as (select a.lang as leader, b.lang as follower, (epoch_us(b.t) - epoch_us(a.t)) / 3.6e9 as lag from f a join f b on a.topic = b.topic and a.lang <> b.lang and (a.t < b.t or (a.t = b.t and a.lang < b.lang))) "
    "select leader, follower, round(avg(lag), 6) as lag_hours, count(*) as topics from p where lag <= 72 group by all"
)
def tp2_velocity(spark, d):
    return I.velocity(articles(spark, d)).select("leader", "follower", r6("lag_hours", "lag_hours"), "topics")


@query(
    f"with {ART}, f as (select topic, lang, min(ts) as t from art where ts is not null and topic <> '-1' group by all), r as (select *, row_number() over w as rank, first(lang) over w as lead, first(t) over w as t0, count(*) over (partition by topic) as n from f window w as (partition by topic order by t, lang)), k as (select * from r where n >= 2), "
    "l as (select lead as lang, count(distinct topic) as led, avg(case when rank > 1 then (epoch_us(t) - epoch_us(t0)) / 3.6e9 end) as lag from k group by lead) select k.lang, count(*) as topics, coalesce(any_value(led), 0) as led, round(coalesce(any_value(led), 0) / count(*), 6) as leader_score, round(any_value(lag), 6) as mean_lag_hours from k left join l on l.lang = k.lang group by k.lang"
)
def gi3_agenda(spark, d):
    return I.agenda(articles(spark, d)).select("lang", "topics", "led", r6("leader_score", "leader_score"), r6("mean_lag_hours", "mean_lag_hours"))


_SER = "dy as (select topic, day, count(*) as volume, avg(score) as sentiment from sco where day is not null group by grouping sets ((topic, day), (day))), da as (select coalesce(topic, 'all') as topic, day, volume, sentiment from dy), bd as (select min(day) as a, max(day) as b from da), ser as (select t.topic, g.day, coalesce(da.volume, 0) as volume, da.sentiment from (select distinct topic from da) t cross join (select cast(unnest(generate_series(a, b, interval 1 day)) as date) as day from bd) g left join da on da.topic = t.topic and da.day = g.day)"


@query(f"with {SCO}, {_SER} select topic, cast(day as varchar) as day, volume, round(sentiment, 6) as sentiment from ser")
def daily_series(spark, d):
    return I.daily_series(scored(spark, d)).select("topic", F.col("day").cast("string").alias("day"), "volume", r6("sentiment", "sentiment"))


def _volumes(spark, d):
    return I.daily_series(scored(spark, d)).select("topic", "day", F.col("volume").cast("double").alias("value"))


_MA = "ma as (select *, case when count(*) over s = 3 then avg(volume) over s end as ma_short, case when count(*) over l = 14 then avg(volume) over l end as ma_long from ser window s as (partition by topic order by day rows between 2 preceding and current row), l as (partition by topic order by day rows between 13 preceding and current row))"


@query(f"with {SCO}, {_SER}, {_MA}, x as (select *, round(ma_short - ma_long, 6) as d, round(lag(ma_short - ma_long) over (partition by topic order by day), 6) as b from ma) select topic, cast(day as varchar) as day, round(ma_short, 6) as ma_short, round(ma_long, 6) as ma_long, case when d is null or b is null then null when d > 0 and d > b then 'rising' when d < 0 and d < b then 'declining' else 'neutral' end as ma_signal from x")
def win_ma_cross(spark, d):
    m = I.moving_averages(_volumes(spark, d), "topic", "value")
    w = Window.partitionBy("topic").orderBy("day")
    diff = F.round(F.col("ma_short") - F.col("ma_long"), 6)
    m = m.withColumn("d", diff).withColumn("b", F.lag("d").over(w))
    signal = F.when(F.col("d").isNull() | F.col("b").isNull(), None).when((F.col("d") > 0) & (F.col("d") > F.col("b")), "rising").when((F.col("d") < 0) & (F.col("d") < F.col("b")), "declining").otherwise("neutral")
    return m.select("topic", F.col("day").cast("string").alias("day"), r6("ma_short", "ma_short"), r6("ma_long", "ma_long"), signal.alias("ma_signal"))


@query(
    f"with {SCO}, {_SER}, z as (select *, row_number() over (partition by topic order by day) - 1 as t, count(*) over (partition by topic) as n, volume - avg(volume) over (partition by topic) as y from ser), "
    "k as (select topic, n, t, y, unnest(generate_series(1, cast(n // 2 as bigint))) as k from z where n >= 14), p as (select topic, n, k, pow(sum(y * cos(2 * pi() * k * t / n)), 2) + pow(sum(y * sin(2 * pi() * k * t / n)), 2) as p from k group by all), "
    "b as (select topic, n, arg_min(k, (-round(p, 6), k)) as k, max(p) / avg(p) as ratio from p group by all) select topic, round(n / k, 1) as period, round(ratio, 6) as ratio, ratio >= 3 as cyclic from b"
)
def tp4_cycle(spark, d):
    return I.dft_cycles(_volumes(spark, d), "topic").select("topic", "period", r6("ratio", "ratio"), "cyclic")


@query(
    f"with {SCO}, {_SER}, z as (select topic, day, (volume - avg(volume) over (partition by topic)) / stddev_pop(volume) over (partition by topic) as z, count(*) over (partition by topic) as n, stddev_pop(volume) over (partition by topic) as s from ser), v as (select * from z where s > 0), "
    "r as (select a.topic as a, b.topic as b, l.lag, sum(a.z * b.z) / max(a.n) as r from v a cross join (select unnest(generate_series(-7, 7)) as lag) l join v b on b.day = a.day + cast(l.lag as integer) and a.topic < b.topic group by all), "
    "x as (select a, b, arg_min({'lag': lag, 'r': r}, (-round(abs(r), 6), abs(lag), lag)) as x from r group by all) select a, b, cast(x.lag as integer) as lag, round(x.r, 6) as r, case when x.lag > 0 then a when x.lag < 0 then b end as leader from x where abs(x.r) > 0.1"
)
def xcorr_lead(spark, d):
    return I.lead_lag(_volumes(spark, d), "topic", "value").select("a", "b", "lag", r6("r", "r"), "leader")


def _cases(patterns: dict[str, str], text: str) -> str:
    return "case lang " + " ".join(f"when '{k}' then regexp_matches({text}, '{v}')" for k, v in patterns.items()) + " end"


@query(f"with {ART}, m as (select lang, day, {_cases(EPU, _TEXT)} as hit from art) select lang, cast(day as varchar) as day, round(avg(cast(hit as int)), 6) as share, count(*) as n from m where hit is not null and day is not null group by lang, day")
def ei1_epu(spark, d):
    return I.keyword_share(articles(spark, d), EPU, text_col()).select("lang", F.col("day").cast("string").alias("day"), r6("share", "share"), "n")


_HITS = {k: f"len(regexp_extract_all({_TEXT}, '{v}'))" for k, v in SECTORS.items()}
_SEC = f"sec as (select *, {', '.join(f'{h} as h_{k}' for k, h in _HITS.items())} from sco), sct as (select *, case greatest({', '.join(f'h_{k}' for k in SECTORS)}) when 0 then null " + " ".join(f"when h_{k} then '{k}'" for k in SECTORS) + " end as sector from sec where day is not null and steeps = 'E'), sdy as (select sector, day, avg(score) as s, count(*) as n from sct where sector is not null group by all)"


def _sector_days(spark, d):
    t = text_col()
    rows = scored(spark, d).where("day is not null and steeps = 'E'").select("day", "score", *(F.regexp_count(t, F.lit(v)).alias(k) for k, v in SECTORS.items()))
    rows = rows.withColumn("top", F.greatest(*SECTORS))
    sector = F.when(F.col("top") == 0, None)
    for k in SECTORS:
        sector = sector.when(F.col(k) == F.col("top"), k)
    return rows.withColumn("sector", sector).where("sector is not null").groupBy("sector", "day").agg(F.avg("score").alias("s"), F.count("*").alias("n"))


@query(f"with {SCO}, {_SEC} select sector, cast(day as varchar) as day, round(s, 6) as sentiment, n from sdy")
def ei2_sector(spark, d):
    return _sector_days(spark, d).select("sector", F.col("day").cast("string").alias("day"), r6("s", "sentiment"), "n")


_GRAD = "case when lag({0}) over w is null and lead({0}) over w is null then 0 when lag({0}) over w is null then lead({0}) over w - {0} when lead({0}) over w is null then {0} - lag({0}) over w else (lead({0}) over w - lag({0}) over w) / 2 end"


@query(f"with {SCO}, {_SEC}, f as (select sector, day, s from sdy where s is not null), v as (select *, {_GRAD.format('s')} as v from f window w as (partition by sector order by day)), a as (select *, {_GRAD.format('v')} as a from v window w as (partition by sector order by day)) select sector, cast(day as varchar) as day, round(v, 6) as velocity, round(a, 6) as acceleration, round(v, 6) > 0 and round(a, 6) < 0 as early_warning from a")
def ei3_momentum(spark, d):
    g = I.gradient(_sector_days(spark, d).where("s is not null"), "sector", "s")
    return g.select("sector", F.col("day").cast("string").alias("day"), r6("velocity", "velocity"), r6("acceleration", "acceleration"), ((F.round("velocity", 6) > 0) & (F.round("acceleration", 6) < 0)).alias("early_warning"))


_NARR = "n as (" + " union all ".join(f"select '{k}' as narrative, day, score, regexp_matches({_TEXT}, '{v}') as hit from sco where day is not null" for k, v in NARRATIVES.items()) + "), nd as (select narrative, day, sum(cast(hit as int)) as matches, avg(cast(hit as int)) as prevalence, coalesce(avg(case when hit then score end), 0) as tone from n group by all)"


@query(f"with {SCO}, {_NARR} select narrative, cast(day as varchar) as day, cast(matches as bigint) as matches, round(prevalence, 6) as prevalence, round(tone, 6) as tone, round(avg(prevalence) over (partition by narrative order by day rows between 6 preceding and current row), 6) as rolling from nd")
def ei4_narrative(spark, d):
    t = text_col()
    flags = F.array(*(F.struct(F.lit(k).alias("narrative"), t.rlike(v).alias("hit")) for k, v in NARRATIVES.items()))
    rows = scored(spark, d).where("day is not null").select("day", "score", F.explode(flags).alias("x")).select("day", "score", "x.*")
    days = rows.groupBy("narrative", "day").agg(F.sum(F.col("hit").cast("int")).alias("matches"), F.avg(F.col("hit").cast("double")).alias("prevalence"), F.coalesce(F.avg(F.when(F.col("hit"), F.col("score"))), F.lit(0.0)).alias("tone"))
    w = Window.partitionBy("narrative").orderBy("day").rowsBetween(-6, 0)
    return days.select("narrative", F.col("day").cast("string").alias("day"), "matches", r6("prevalence", "prevalence"), r6("tone", "tone"), r6(F.avg("prevalence").over(w), "rolling"))


@query(
    f"with {SCO}, {ENT}, m as (select e.entity, e.day, s.score from ent e join sco s using (article_id) where e.day is not null), k as (select entity from m group by entity having count(*) >= 10), "
    "dd as (select entity, day, count(*) as c, avg(score) as s from m join k using (entity) group by all), x as (select *, row_number() over (partition by entity order by day) - 1 as i from dd), "
    "g as (select entity, coalesce(regr_slope(c, i), 0) as vs, avg(s) as tone from x group by entity) select entity, round(vs, 6) as volume_slope, round(tone, 6) as tone, case when round(vs, 6) > 0.1 and round(tone, 6) > 0.2 then 'rising' when round(vs, 6) < -0.05 then 'falling' when abs(round(vs, 6)) < 0.02 then 'stable' else 'mixed' end as phase from g"
)
def ei5_hype(spark, d):
    m = entities(spark, d).where("day is not null").select("article_id", "entity", "day").join(scored(spark, d).select("article_id", "score"), "article_id")
    dd = I.having(m, "entity", 10).groupBy("entity", "day").agg(F.count("*").alias("c"), F.avg("score").alias("s"))
    x = dd.withColumn("i", F.row_number().over(Window.partitionBy("entity").orderBy("day")) - 1)
    g = x.groupBy("entity").agg(F.round(F.coalesce(F.regr_slope("c", "i"), F.lit(0.0)), 6).alias("volume_slope"), r6(F.avg("s"), "tone"))
    phase = F.when((F.col("volume_slope") > 0.1) & (F.col("tone") > 0.2), "rising").when(F.col("volume_slope") < -0.05, "falling").when(F.abs("volume_slope") < 0.02, "stable").otherwise("mixed")
    return g.withColumn("phase", phase)


_EM = ", ".join(f"avg({e}) as {e}" for e in EMOTIONS)


@query(
    f"with {SCO}, g as (select source, coalesce(cast(day as varchar), 'unknown') as day, avg(score) as mean, count(*) as n, {_EM} from sco group by 1, 2), t as (select *, " + " + ".join(f"coalesce({e}, 0)" for e in EMOTIONS) + " as tot from g) "
    "select source, day, n, round(mean, 6) as mean, round(mean * (1 - coalesce(case when tot > 0 then -(" + " + ".join(f"case when coalesce({e}, 0) > 0 then {e} / tot * log2({e} / tot) else 0 end" for e in EMOTIONS) + ") end, 0) / 3), 4) + cast(0 as double) as mood from t"
)
def mood_index(spark, d):
    return I.mood_index(scored(spark, d), EMOTIONS).select("source", "day", "n", r6("mean", "mean"), "mood")


@query(f"with {SCO}, {ENT}, x as (select e.entity, e.lang, e.source, s.score from ent e join sco s using (article_id)) select entity, count(*) as mentions, round(avg(score), 6) as tone, round(avg(cast(coalesce(score < 0, false) as int)), 6) as negative, round(avg(cast(coalesce(score > 0, false) as int)), 6) as positive, count(distinct lang) as langs, count(distinct source) as sources from x group by entity having count(*) >= 10 order by mentions desc, entity limit 100")
def fi1_entity_profiles(spark, d):
    x = entities(spark, d).select("article_id", "entity", "lang", "source").join(scored(spark, d).select("article_id", "score"), "article_id")
    rate = lambda c: r6(F.avg(F.coalesce(c, F.lit(False)).cast("double")), "x")
    p = x.groupBy("entity").agg(F.count("*").alias("mentions"), r6(F.avg("score"), "tone"), rate(F.col("score") < 0).alias("negative"), rate(F.col("score") > 0).alias("positive"), F.count_distinct("lang").alias("langs"), F.count_distinct("source").alias("sources"))
    return p.where("mentions >= 10").orderBy(F.desc("mentions"), "entity").limit(100)


@query(f"with {SCO}, x as (select topic, article_id, title, round(0.4 * importance + 0.3 * abs(score) + 0.1 * least(word_count / 1000, 1) + 0.2 * least(importance * 1.5, 1), 6) as e from sco where topic <> '-1'), r as (select *, row_number() over (partition by topic order by e desc nulls last, article_id) as rn from x) select topic, article_id, e as evidence, rn as rank, substr(title, 1, 120) as preview from r where rn <= 5")
def fi3_evidence(spark, d):
    e = F.round(0.4 * F.col("importance") + 0.3 * F.abs("score") + 0.1 * F.least(F.col("word_count") / 1000, F.lit(1.0)) + 0.2 * F.least(F.col("importance") * 1.5, F.lit(1.0)), 6)
    x = scored(spark, d).where("topic <> '-1'").withColumn("evidence", e)
    rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.col("evidence").desc_nulls_last(), "article_id"))
    return x.withColumn("rank", rank).where("rank <= 5").select("topic", "article_id", "evidence", F.col("rank").cast("bigint").alias("rank"), F.substring("title", 1, 120).alias("preview"))


@query(
    f"with {SCO}, x as (select source, day, score, row_number() over (partition by source order by day) as rn from (select source, day, round(avg(score), 6) as score from sco where day is not null and score is not null group by all)), z as (select source, max(rn) as n, arg_max(score, rn) as last, avg(score) as m, stddev_pop(score) as sd from x group by source) "
    "select source, round(case when n < 3 or sd = 0 then 0 else abs((last - m) / sd) end, 6) as z from z"
)
def win_zscore_last(spark, d):
    days = scored(spark, d).where("day is not null and score is not null").groupBy("source", "day").agg(F.round(F.avg("score"), 6).alias("score"))
    z = days.groupBy("source").agg(F.count("*").alias("n"), F.max_by("score", "day").alias("last"), F.avg("score").alias("m"), F.stddev_pop("score").alias("sd"))
    return z.select("source", r6(F.when((F.col("n") < 3) | (F.col("sd") == 0), 0.0).otherwise(F.abs((F.col("last") - F.col("m")) / F.col("sd"))), "z"))


@query(
    "with s as (select user_id, cast(event_type as varchar) as k, datediff('day', cast(min(ts) as date), cast(max(ts) as date)) as t, max(ts) < timestamp '2024-01-28 00:00:00' as e from events group by user_id, event_type), a as (select k, t, sum(cast(e as int)) as d, count(*) as c from s group by all), r as (select *, sum(c) over (partition by k order by t desc) as risk from a), "
    "v as (select *, exp(sum(case when d = risk then -1e9 else ln(1 - d / risk) end) over (partition by k order by t)) as s from r) select k, cast(coalesce(min(case when s <= 0.5 + 1e-12 then t end), max(t)) as integer) as median from v group by k"
)
def km_median(spark, d):
    from corpusmill.sources.tables import table

    ev = table(spark, d, "events").groupBy("user_id", F.col("event_type").alias("k")).agg(F.datediff(F.max("ts"), F.min("ts")).alias("t"), (F.max("ts") < F.lit("2024-01-28 00:00:00").cast("timestamp_ntz")).alias("e"))
    return I.kaplan_meier_median(ev, "k", "t", "e")
