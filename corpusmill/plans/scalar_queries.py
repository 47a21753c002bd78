"""Scalar operators on text, addresses and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.plans.bindings import ANA, ART, EMOTIONS, analysis, articles, r6, registry
from corpusmill.runtime import checked_broadcast, ship
from corpusmill.sources.tables import table

QUERIES, SQL, query = registry()


def _lit(items) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


_NORM = "coalesce(body, '')"
for _n, _c in X.HTML_ENTITIES:
    _NORM = f"replace({_NORM}, '{_n}', '{_c.replace(chr(39), chr(39) * 2)}')"
for _p in (X.TAG, X.URL, X.EMAIL, X.DECORATION):
    _NORM = "regexp_replace(" + _NORM + ", '" + _p.replace("'", "''") + "', '', 'g')"
_NORM = _strip(f"regexp_replace(regexp_replace({_NORM}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '[ \\t]+', ' ', 'g')")


@query(f"with {ART} select article_id, md5({_NORM}) as clean, length({_NORM}) as n from art")
def normalize_text(spark, d):
    c = X.normalize_text(F.col("body"))
    return articles(spark, d).select("article_id", F.md5(c).alias("clean"), F.length(c).cast("bigint").alias("n"))


@query(f"with {ART} select article_id, case when coalesce(body, '') = '' then '' else sha256(lower(trim(regexp_replace(body, '\\s+', ' ', 'g')))) end as h from art")
def content_hash(spark, d):
    return articles(spark, d).select("article_id", X.content_hash(F.col("body")).alias("h"))


@query(f"with {ART} select article_id, coalesce(case when length(replace(body, ' ', '')) > 0 then length(regexp_replace(body, '[^가-힣ᄀ-ᇿ㄰-㆏]', '', 'g')) / length(replace(body, ' ', '')) >= 0.1 end, false) as korean from art")
def detect_ko_en(spark, d):
    return articles(spark, d).select("article_id", X.is_korean(F.col("body")).alias("korean"))


_SCRIPTS = (("cjk", "가-힣一-鿿぀-ヿ"), ("arabic", "؀-ۿ"), ("hebrew", "֐-׿"), ("cyrillic", "Ѐ-ӿ"), ("latin", "A-Za-zÀ-ɏ"))


@query(
    f"with {ART}, c as (select article_id, " + ", ".join(f"length(regexp_replace(coalesce(title, ''), '[^{p}]', '', 'g')) as {n}" for n, p in _SCRIPTS) + " from art), "
    "g as (select *, greatest(cjk, arabic, hebrew, cyrillic, latin) as top from c) "
    "select article_id, case when top < 5 then 'unknown' " + " ".join(f"when {n} = top then '{n}'" for n, _ in _SCRIPTS) + " end as script from g"
)
def primary_script(spark, d):
    return articles(spark, d).select("article_id", X.primary_script(F.col("title")).alias("script"))


_TOK = f"list_filter(string_split_regex(lower(coalesce(title, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: length(w) >= 2 and not list_contains({_lit(X.NEWS_STOPWORDS)}, w))"


@query(f"with {ART} select article_id, array_to_string({_TOK}, ' ') as words, len({_TOK}) as n from art")
def tokenize_other(spark, d):
    c = X.tokens(F.col("title"))
    return articles(spark, d).select("article_id", F.array_join(c, " ").alias("words"), F.size(c).cast("bigint").alias("n"))


@query(f"with {ART}, s as (select article_id, list_filter(string_split(regexp_replace(coalesce(body, ''), '([.!?。！？])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> '') as s from art) select article_id, cast(unnest(generate_series(0, len(s) - 1)) as integer) as i, unnest(s) as sentence from s where len(s) > 0")
def sentence_split(spark, d):
    return articles(spark, d).select("article_id", F.posexplode(X.sentences(F.col("body"))).alias("i", "sentence"))


@query(f"with {ART} select article_id, coalesce(nullif(len({_TOK.replace('title', 'body')}), 0), nullif(len({_TOK}), 0), 0) as n from art")
def word_count(spark, d):
    size = lambda c: F.nullif(F.size(X.tokens(F.col(c))).cast("bigint"), F.lit(0))
    return articles(spark, d).select("article_id", F.coalesce(size("body"), size("title"), F.lit(0)).alias("n"))


def _title_key(c: str) -> str:
    return f"trim(regexp_replace(lower(regexp_replace(regexp_replace(trim(coalesce({c}, '')), '{X.TITLE_LABEL}', ''), '{X.SITE_SUFFIX}', '')), '\\s+', ' ', 'g'))"


@query(f"with {ART} select article_id, {_title_key('title')} as k from art")
def title_normalize(spark, d):
    return articles(spark, d).select("article_id", X.title_key(F.col("title")).alias("k"))


@query(f"with {ART} select article_id, array_to_string(list_sort(list_distinct(string_split({_title_key('title')}, ' '))), ' ') as words from art")
def title_tokens(spark, d):
    return articles(spark, d).select("article_id", F.array_join(F.array_sort(F.array_distinct(F.split(X.title_key(F.col("title")), " "))), " ").alias("words"))


_WORDS3 = "list_filter(string_split_regex(lower(regexp_replace(coalesce(title, ''), '[^\\p{L}\\p{N}\\s]', ' ', 'g')), '\\s+'), lambda w: w <> '')"


@query(f"with {ART}, w as (select article_id, {_WORDS3} as w from art) select article_id, array_to_string(case when len(w) < 3 then w else list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 2), ' ')) end, '|') as grams from w")
def shingle(spark, d):
    return articles(spark, d).select("article_id", F.array_join(X.shingles(F.col("title")), "|").alias("grams"))


@query()
def simhash64(spark, d):
    ship(spark)
    return table(spark, d, "documents").select("doc_id", X.simhash64(F.col("text")).alias("fingerprint"))


@query("with h as (select distinct article_id, simhash from content_hashes) select a.article_id as a, b.article_id as b, cast(bit_count(xor(a.simhash, b.simhash)) as integer) as bits, round(1 - bit_count(xor(a.simhash, b.simhash)) / 64, 6) as sim from h a join (select article_id, simhash from h where simhash <> 0) b on a.simhash = b.simhash and a.article_id < b.article_id")
def hamming(spark, d):
    h = table(spark, d, "content_hashes").select("article_id", "simhash").distinct()
    a, b = h.alias("a"), h.where("simhash <> 0").alias("b")
    bits = X.hamming(F.col("a.simhash"), F.col("b.simhash"))
    return a.join(b, (F.col("a.simhash") == F.col("b.simhash")) & (F.col("a.article_id") < F.col("b.article_id"))).select(F.col("a.article_id").alias("a"), F.col("b.article_id").alias("b"), bits.alias("bits"), r6(1 - bits / 64, "sim"))


_PAIR = """
    t as (select article_id, title, row_number() over (partition by source, topic order by article_id, title) as rn, source, topic from (select distinct article_id, title, source, topic from art where title is not null)),
    p as (select a.article_id as a, b.article_id as b, a.title as x, b.title as y from t a join t b on a.source = b.source and a.topic = b.topic and b.rn = a.rn + 1)"""


def _next_titles(spark, d):
    from pyspark.sql import Window

    t = articles(spark, d).where("title is not null").select("article_id", "title", "source", "topic").distinct()
    w = Window.partitionBy("source", "topic").orderBy("article_id", "title")
    return t.where("source is not null").select(F.col("article_id").alias("a"), F.lead("article_id").over(w).alias("b"), F.col("title").alias("x"), F.lead("title").over(w).alias("y")).where("b is not null")


_J = "len(list_intersect(u, v)) / len(list_distinct(list_concat(u, v)))"


@query(f"with {ART}, {_PAIR}, s as (select a, b, list_distinct(string_split(lower(x), ' ')) as u, list_distinct(string_split(lower(y), ' ')) as v from p) select a, b, round({_J}, 6) as j from s")
def jaccard_sets(spark, d):
    u, v = (F.array_distinct(F.split(F.lower(c), " ")) for c in ("x", "y"))
    return _next_titles(spark, d).select("a", "b", r6(X.jaccard(u, v), "j"))


@query()
def levenshtein(spark, d):
    """Edits in characters; DuckDB counts bytes, so this is tested with hand cases."""
    return _next_titles(spark, d).select("a", "b", F.levenshtein("x", "y").alias("edits"))


@query()
def titles_similar(spark, d):
    """By words, edits in characters and prefix; DuckDB's edits are in bytes, so this is tested with hand cases."""
    same, sure = X.titles_similar(F.col("x"), F.col("y"))
    return _next_titles(spark, d).select("a", "b", same.alias("similar"), r6(sure, "confidence"))


_STRONG = " + ".join("cast(regexp_matches(coalesce(body, ''), '(?i)" + p.replace("'", "''") + "') as int)" for p in X.PAYWALL)


@query(f"with {ART} select article_id, length(coalesce(body, '')) < 50 or ({_STRONG}) >= 2 or (({_STRONG}) >= 1 and length(body) < 2000) as paywall from art")
def is_paywall_body(spark, d):
    return articles(spark, d).select("article_id", X.paywall(F.col("body")).alias("paywall"))


_PATH = "coalesce(nullif(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), ''), '/')"
_ARTICLE = f"coalesce(not regexp_matches(lower({_PATH}), '{X.ASSETS}') and not (" + " or ".join(f"contains(lower({_PATH}), '{p}')" for p in X.NO_ARTICLE_PATHS) + f") and len(list_filter(string_split(lower({_PATH}), '/'), lambda s: s <> '')) >= 2, false)"


@query(f"with {ART} select distinct url, {_ARTICLE} as ok from art where url is not null")
def is_article_url(spark, d):
    return articles(spark, d).where("url is not null").select("url", X.is_article_url(F.col("url")).alias("ok")).distinct()


_SECTION = f"list_filter(list_transform(list_filter(string_split(lower({_PATH}), '/'), lambda s: s <> '' and not list_contains({_lit(X.SECTION_PREFIXES)}, s)), lambda s: string_split(s, '_')[1]), lambda s: list_contains({_lit(X.SECTIONS)}, s))[1]"


@query(f"with {ART}, s as (select distinct url, {_SECTION} as k from art where url is not null) select url, case k " + " ".join(f"when '{k}' then '{v}'" for k, v in X.SECTIONS.items()) + " end as section from s")
def category_from_url(spark, d):
    return articles(spark, d).where("url is not null").select("url", X.section_of_url(F.col("url")).alias("section")).distinct()


@query(f"with {ART} select distinct url, regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)), '^.*@|:(80|443)$', '', 'g'), '^www\\.', '') as host from art where url is not null")
def url_normalize_lite(spark, d):
    return articles(spark, d).where("url is not null").select("url", X.url_host(F.col("url")).alias("host")).distinct()


@query()
def url_normalize(spark, d):
    """Full canonical addresses; an Arrow kernel, as SQL can't express it. Tested with hand cases."""
    import pyarrow as pa

    from corpusmill.functions.url import canonical_url

    ship(spark)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([canonical_url(u) for u in b.column(0).to_pylist()])], names=["normalized_url", "canonical"])

    return table(spark, d, "seen_urls").select("normalized_url").distinct().mapInArrow(run, "normalized_url string, canonical string")


_LEX = lambda ws: " + ".join(f"cast(contains(coalesce(body, ''), '{w}') as int)" for w in ws)


@query(
    f"with {ART}, c as (select article_id, {_LEX(X.POSITIVE_KO)} as p, {_LEX(X.NEGATIVE_KO)} as n from art), s as (select article_id, case when p + n > 0 then (p - n) / (p + n) else 0 end as s from c) "
    "select article_id, round(s, 6) as score, case when s > 0.1 then 'positive' when s < -0.1 then 'negative' else 'neutral' end as label from s"
)
def lexicon_sentiment_ko(spark, d):
    s = X.lexicon_score(F.col("body"))
    return articles(spark, d).select("article_id", r6(s, "score"), X.label_of_score(s, 0.1).alias("label"))


@query(f"with {ANA} select article_id, case when score > 0.05 then 'positive' when score < -0.05 then 'negative' else 'neutral' end as label from ana")
def sentiment_label_band(spark, d):
    return analysis(spark, d).select("article_id", X.label_of_score(F.col("score"), 0.05).alias("label"))


_ENTKEY = "trim(regexp_replace(regexp_replace(trim(author), '(?i)^(mr|mrs|ms|dr|prof|sir|president|chairman)\\.?\\s+', ''), '\\s+', ' ', 'g'))"


@query(f"with {ART} select distinct author, {_ENTKEY} as k, coalesce(length(author) between 2 and 50 and length(regexp_replace(author, '[^0-9]', '', 'g')) / length(author) <= 0.8, false) as ok from art where author is not null")
def entity_normalize(spark, d):
    return articles(spark, d).where("author is not null").select("author", X.entity_key(F.col("author")).alias("k"), X.entity_valid(F.col("author")).alias("ok")).distinct()


@query(f"with {ART} select a.article_id, strftime(day, '%G-W%V') as week, cast(date_trunc('month', day) as date) = date '2024-08-01' as august, cast(isodow(day) as integer) as dow from art a where day is not null")
def iso_week(spark, d):
    return articles(spark, d).where("day is not null").select("article_id", X.iso_week(F.col("day")).alias("week"), (F.trunc("day", "month") == F.lit("2024-08-01").cast("date")).alias("august"), (F.weekday("day") + 1).alias("dow"))


@query(f"with {ART} select topic, cast(datediff('day', cast(min(ts) as date), cast(max(ts) as date)) as integer) as days, cast(floor((epoch(max(ts)) - epoch(min(ts))) / 86400) as bigint) as whole, round((epoch(max(ts)) - epoch(min(ts))) / 3600, 6) as hours from art where ts is not null group by topic")
def days_span(spark, d):
    sec = F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))
    return articles(spark, d).where("ts is not null").groupBy("topic").agg(F.datediff(F.max("ts"), F.min("ts")).alias("days"), F.floor(sec / 86400).alias("whole"), F.round(sec / 3600, 6).alias("hours"))


@query(f"with {ART} select article_id from art where ts is null or ts >= timestamp '2024-09-01 00:00:00' - interval 24 hours")
def freshness_filter(spark, d):
    return articles(spark, d).where("ts is null or ts >= timestamp '2024-09-01 00:00:00' - interval 24 hours").select("article_id")


@query("select least(a.source_id, b.source_id) || '-' || greatest(a.source_id, b.source_id) as pair, count(*) as n from sources a join sources b on a.language = b.language and a.source_id < b.source_id group by all")
def pair_key(spark, d):
    s = table(spark, d, "sources").select("source_id", "language")
    a, b = s.alias("a"), s.alias("b")
    j = a.join(b, (F.col("a.language") == F.col("b.language")) & (F.col("a.source_id") < F.col("b.source_id")))
    return j.groupBy(X.pair_key(F.col("a.source_id"), F.col("b.source_id")).alias("pair")).agg(F.count("*").alias("n"))


@query("with w as (select unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) as word from documents where text is not null) select word, count(*) as n from w group by word")
def word_freq(spark, d):
    w = table(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    return w.groupBy("word").agg(F.count("*").alias("n"))


@query("select doc_id, array_to_string(list_filter(list_transform(string_split('[''' || source || ''', ''' || coalesce(lang, 'none') || ''']', ','), lambda x: regexp_replace(regexp_replace(trim(x), '^\\[?''|''\\]?$', '', 'g'), '[\\[\\]]', '', 'g')), lambda x: x <> ''), '|') as parts from documents")
def parse_list_string(spark, d):
    text = F.concat(F.lit("['"), "source", F.lit("', '"), F.coalesce("lang", F.lit("none")), F.lit("']"))
    return table(spark, d, "documents").select("doc_id", F.array_join(X.list_text(text), "|").alias("parts"))


@query(f"with {ART} select article_id, coalesce(nullif(trim(body), ''), title, '(empty)') = '(empty)' as nothing, length(coalesce(nullif(trim(body), ''), title, '(empty)')) as n, coalesce(trim(body), '') = '' as paywalled, coalesce(cast(day as varchar), '1970-01-01') as doc_date from art")
def select_doc_text(spark, d):
    text = F.coalesce(F.nullif(F.trim("body"), F.lit("")), "title", F.lit("(empty)"))
    return articles(spark, d).select("article_id", (text == "(empty)").alias("nothing"), F.length(text).cast("bigint").alias("n"), (F.coalesce(F.trim("body"), F.lit("")) == "").alias("paywalled"), F.coalesce(F.date_format("day", "yyyy-MM-dd"), F.lit("1970-01-01")).alias("doc_date"))


@query(f"with {ART} select article_id from art where trim(coalesce(title, '')) <> '' and trim(coalesce(url, '')) <> ''")
def required_fields(spark, d):
    return articles(spark, d).where("trim(coalesce(title, '')) <> '' and trim(coalesce(url, '')) <> ''").select("article_id")


# Rule ladders on numbers
_IMP = "round(greatest(0, least(100, 0.25 * 50 + 0.20 * least(100, 1000 * 2.0 / greatest(word_count, 1)) + 0.25 * 50 + 0.15 * coalesce(100 * exp(-0.0289 * greatest(0, (epoch(timestamp '2025-06-30 00:00:00') - epoch(ts)) / 3600)), 50) + 0.15 * 100 * abs(coalesce(score, 0)) - case when trim(coalesce(body, '')) = '' then 20 else 0 end)), 2)"


@query(f"with {ART}, {ANA} select article_id, {_IMP} as importance from art join ana using (article_id)")
def importance_score(spark, d):
    """Weights of authority, entity density, coverage, recency and sentiment; the time of judging is a parameter."""
    hours = F.greatest(F.lit(0), (F.unix_timestamp(F.lit("2025-06-30 00:00:00").cast("timestamp")) - F.unix_timestamp("ts")) / 3600)
    recency = F.coalesce(100 * F.exp(-0.0289 * hours), F.lit(50.0))
    score = 0.25 * 50 + 0.20 * F.least(F.lit(100.0), F.lit(2000.0) / F.greatest("word_count", F.lit(1))) + 0.25 * 50 + 0.15 * recency + 15 * F.abs(F.coalesce("score", F.lit(0.0)))
    score = score - F.when(F.trim(F.coalesce("body", F.lit(""))) == "", 20).otherwise(0)
    return articles(spark, d).join(analysis(spark, d), "article_id").select("article_id", F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)), 2).alias("importance"))


@query(f"with {ART}, {ANA} select article_id, round(0.4 * importance + 0.3 * abs(score) + 0.1 * least(word_count / 1000, 1) + 0.2 * least(importance * 1.5, 1), 6) as evidence from art join ana using (article_id)")
def evidence_score(spark, d):
    e = 0.4 * F.col("importance") + 0.3 * F.abs("score") + 0.1 * F.least(F.col("word_count") / 1000, F.lit(1.0)) + 0.2 * F.least(F.col("importance") * 1.5, F.lit(1.0))
    return articles(spark, d).join(analysis(spark, d), "article_id").select("article_id", r6(e, "evidence"))


@query(f"with {ANA} select article_id, round((anger + fear) / (trust + anticipation + 1e-6), 6) as ratio, (anger + fear) / (trust + anticipation + 1e-6) > 1 as conflict from ana")
def gi4_conflict(spark, d):
    r = (F.col("anger") + F.col("fear")) / (F.col("trust") + F.col("anticipation") + 1e-6)
    return analysis(spark, d).select("article_id", r6(r, "ratio"), (r > 1).alias("conflict"))


_E = ", ".join(EMOTIONS)


@query(f"with {ANA}, u as (select article_id, unnest([{_E}]) as v, unnest(generate_series(1, 8)) as i from ana), t as (select article_id, i, v, sum(v) over (partition by article_id) as s from u where v > 0) select article_id, round(-sum(v / s * log2(v / s)), 6) as bits, round(-sum(v / s * ln(v / s)), 6) as nats from t group by article_id")
def shannon_bits(spark, d):
    p = F.filter(F.array(*EMOTIONS), lambda v: v > 0)
    s = F.aggregate(p, F.lit(0.0), lambda a, v: a + v)
    rows = analysis(spark, d).withColumn("p", p).withColumn("s", s).where("s > 0")
    h = lambda log: -F.aggregate("p", F.lit(0.0), lambda a, v: a + v / F.col("s") * log(v / F.col("s")))
    return rows.select("article_id", r6(h(F.log2), "bits"), r6(h(F.ln), "nats"))


@query(f"with {ANA} select article_id, coalesce(greatest(0, least(1, score)), 0) as clamped, cast(coalesce(floor(importance), 0) as bigint) as whole from ana")
def clamp(spark, d):
    return analysis(spark, d).select("article_id", F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")), F.lit(0.0)).alias("clamped"), F.coalesce(F.floor("importance"), F.lit(0)).alias("whole"))


@query("select s.source_id, coalesce(n.group_name, '?') as grp, coalesce(n.source_name, 'Unknown') as name from (select distinct source as source_id from articles) s left join sources n using (source_id)")
def source_group_map(spark, d):
    s = table(spark, d, "articles").select(F.col("source").alias("source_id")).distinct()
    return s.join(checked_broadcast(table(spark, d, "sources").select("source_id", "group_name", "source_name")), "source_id", "left").select("source_id", F.coalesce("group_name", F.lit("?")).alias("grp"), F.coalesce("source_name", F.lit("Unknown")).alias("name"))
