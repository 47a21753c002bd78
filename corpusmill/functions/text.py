"""Text expressions on columns: cleaning, splitting, keys and simple recognisers. Null in, null out unless said."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Entities unescaped by expressions; the full HTML table needs a Python kernel.
HTML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
TAG, URL, EMAIL = r"<[^>]+>", r"(?i)https?://[^\s<>\"')\]]+", r"(?i)[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}"
DECORATION = "[~■●○★☆←-↙─-╿]+"
# News words left out of English tokens.
NEWS_STOPWORDS = (
    "said says say saying according reported reports reporting told tells telling added noted stated explained also would could may might new one two first last year years time day days people percent mr mrs ms "
    "reuters associated press ap copyright rights reserved photo image video file monday tuesday wednesday thursday friday saturday sunday january february march april june july august september october november december"
).split()
# Labels in front of titles, and the separators before a site's name.
TITLE_LABEL = r"(?i)^(?:\[속보\]|\[단독\]|\[Breaking\]|\[Exclusive\]|\[Update\]|속보|단독)\s*"
SITE_SUFFIX = r"(?s)\s*[|\-–—»:·•]\s*.{2,60}$"
# Imperative phrases of paywalls.
PAYWALL = (
    r"subscribe\s+to\s+(unlock|read|continue|access)", r"sign\s+in\s+to\s+(read|continue|access|view)", r"create\s+(an?\s+)?account\s+to", r"log\s+in\s+to\s+(read|continue|access)",
    r"this\s+(article|content|story)\s+is\s+(for\s+)?(subscribers?|members?)\s+only", r"register\s+to\s+(continue|read|access)", r"already\s+a\s+subscriber", r"start\s+your\s+(free\s+)?subscription",
    r"r[eé]serv[eé]\s+aux\s+abonn[eé]s", r"abonnez[\s-]vous", r"connectez[\s-]vous\s+pour", r"d[eé]j[aà]\s+abonn[eé]", r"acc[eé]dez\s+[aà]\s+(cet|l['’])", r"cr[eé]ez?\s+un\s+compte",
)
# URL path parts and the section they stand for.
SECTIONS = {
    "politics": "politics", "economy": "economy", "finance": "economy", "business": "business", "society": "society", "international": "international", "world": "international", "global": "international",
    "culture": "culture", "entertainment": "entertainment", "sports": "sports", "sport": "sports", "opinion": "opinion", "editorial": "opinion", "tech": "technology", "technology": "technology", "science": "science",
    "lifestyle": "lifestyle", "health": "health", "education": "education", "national": "national", "us": "us", "europe": "europe", "asia": "asia", "middleeast": "middleeast", "africa": "africa",
}
SECTION_PREFIXES = ("arti", "article", "articles", "news", "story", "stories", "arc", "outboundfeeds", "rss", "www", "en", "ko", "kr")
# Paths and endings of pages that are no articles.
ASSETS = r"\.(jpg|jpeg|png|gif|svg|webp|ico|css|js|json|xml|rss|atom|pdf|zip|tar|gz|mp3|mp4|avi|mov|woff|woff2|ttf|eot)$"
NO_ARTICLE_PATHS = ("/tag/", "/tags/", "/category/", "/categories/", "/author/", "/authors/", "/page/", "/search", "/login", "/signup", "/register", "/subscribe", "/about", "/contact", "/privacy", "/terms", "/sitemap", "/robots.txt", "/feed", "/rss", "/wp-admin", "/wp-login", "/wp-content")
# Korean words of good and bad news.
POSITIVE_KO = "좋 긍정 성장 증가 호조 상승 개선 발전 확대 활발 호황 강화 기대 성과 혁신 돌파 회복 안정 협력 합의 지원 투자 성공".split()
NEGATIVE_KO = "나쁘 부정 하락 감소 위기 악화 축소 침체 불안 갈등 위험 논란 비판 실패 손실 폭락 불황 긴장 제재 처벌 사망 피해 충돌".split()


def normalize_text(text: Column) -> Column:
    """Unescape, drop tags, addresses and decoration, collapse spaces, at most one empty line; '' for null."""
    out = F.coalesce(text, F.lit(""))
    for name, char in HTML_ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    for pattern in (TAG, URL, EMAIL, DECORATION):
        out = F.regexp_replace(out, pattern, "")
    out = F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), r"[ \t]+", " ")
    return F.regexp_replace(out, r"^\s+|\s+$", "")


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def content_hash(text: Column) -> Column:
    """SHA-256 of the text in lower case with white space collapsed; '' for null and empty."""
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(F.sha2(F.lower(collapse(text)), 256))


def is_korean(text: Column) -> Column:
    """At least a tenth of the characters other than spaces are Hangul."""
    n = F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.coalesce(F.when(n > 0, F.regexp_count(text, F.lit("[가-힣ᄀ-ᇿ㄰-㆏]")) / n >= 0.1), F.lit(False))


def primary_script(text: Column) -> Column:
    """cjk, arabic, hebrew, cyrillic or latin, whichever has most characters, the first on ties; unknown under five."""
    counts = [(n, F.regexp_count(F.coalesce(text, F.lit("")), F.lit(p))) for n, p in (("cjk", "[가-힣一-鿿぀-ヿ]"), ("arabic", "[؀-ۿ]"), ("hebrew", "[֐-׿]"), ("cyrillic", "[Ѐ-ӿ]"), ("latin", "[A-Za-zÀ-ɏ]"))]
    top = F.greatest(*(c for _, c in counts))
    out = F.when(top < 5, "unknown")
    for name, c in counts:
        out = out.when(c == top, name)
    return out


def tokens(text: Column, least: int = 2) -> Column:
    """Words of at least `least` characters in lower case, without the news words."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    stop = F.array(*map(F.lit, NEWS_STOPWORDS))
    return F.filter(words, lambda w: (F.length(w) >= least) & ~F.array_contains(stop, w))


def sentences(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?。！？])\s+"), lambda s: F.trim(s) != "")


def title_key(title: Column) -> Column:
    """The title without a label in front and a site's name behind, in lower case."""
    out = F.regexp_replace(F.trim(F.coalesce(title, F.lit(""))), TITLE_LABEL, "")
    return collapse(F.lower(F.regexp_replace(out, SITE_SUFFIX, "")))


def shingles(text: Column, n: int = 3) -> Column:
    """Word n-grams of the text in lower case without punctuation; its words where there are fewer."""
    words = F.filter(F.split(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}\s]", " ")), r"\s+"), lambda w: w != "")
    size = F.size(words)
    return F.when(size < n, words).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, F.lit(n)), " ")))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 1 if both are empty, 0 if one is."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / F.size(F.array_union(a, b)))


def titles_similar(a: Column, b: Column) -> tuple[Column, Column]:
    """(similar, confidence) of two titles by words, edits and prefix."""
    x, y = title_key(a), title_key(b)
    words = jaccard(F.array_distinct(F.split(x, " ")), F.array_distinct(F.split(y, " ")))
    longest = F.greatest(F.length(x), F.length(y))
    edit = F.levenshtein(x, y) / longest
    short, long = F.when(F.length(x) >= F.length(y), y).otherwise(x), F.when(F.length(x) >= F.length(y), x).otherwise(y)
    prefix = (F.length(short) > 10) & F.startswith(long, short) & (F.length(short) / F.length(long) > 0.7)
    empty = (x == "") | (y == "")
    same = F.when(empty, False).otherwise((x == y) | (words >= 0.8) | (edit < 0.2) | prefix)
    return same, F.when(empty, 0.0).when(x == y, 1.0).otherwise(F.greatest(words, 1 - edit))


def paywall(text: Column) -> Column:
    """Short texts, two imperative phrases, or one in a text of under 2000 characters; true for null."""
    strong = sum((F.coalesce(text.rlike("(?i)" + p).cast("int"), F.lit(0)) for p in PAYWALL[1:]), F.coalesce(text.rlike("(?i)" + PAYWALL[0]).cast("int"), F.lit(0)))
    n = F.length(F.coalesce(text, F.lit("")))
    return (n < 50) | (strong >= 2) | ((strong >= 1) & (n < 2000))


def url_path(url: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1), F.lit("")), F.lit("/"))


def url_host(url: Column) -> Column:
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#]*)", 1)), r"^.*@|:(80|443)$", "")
    return F.regexp_replace(host, r"^www\.", "")


def is_article_url(url: Column) -> Column:
    path = F.lower(url_path(url))
    named = F.lit(False)
    for p in NO_ARTICLE_PATHS:
        named = named | path.contains(p)
    return F.coalesce(~path.rlike(ASSETS) & ~named & (F.size(F.filter(F.split(path, "/"), lambda s: s != "")) >= 2), F.lit(False))


def section_of_url(url: Column) -> Column:
    """The section of the first path part that names one, or null."""
    names = F.create_map(*(F.lit(x) for kv in SECTIONS.items() for x in kv))
    parts = F.filter(F.split(F.lower(url_path(url)), "/"), lambda s: (s != "") & ~s.isin(*SECTION_PREFIXES))
    bases = F.transform(parts, lambda s: F.split_part(s, F.lit("_"), F.lit(1)))
    hits = F.filter(bases, lambda s: s.isin(*SECTIONS))
    return F.when(F.size(hits) > 0, F.element_at(names, F.get(hits, F.lit(0))))


def lexicon_score(text: Column) -> Column:
    """(positive - negative) / all over the distinct lexicon words the text contains, 0 without any."""
    t = F.coalesce(text, F.lit(""))
    pos = sum((t.contains(w).cast("int") for w in POSITIVE_KO[1:]), t.contains(POSITIVE_KO[0]).cast("int"))
    neg = sum((t.contains(w).cast("int") for w in NEGATIVE_KO[1:]), t.contains(NEGATIVE_KO[0]).cast("int"))
    return F.when(pos + neg > 0, (pos - neg) / (pos + neg)).otherwise(0.0)


def label_of_score(score: Column, band: float) -> Column:
    return F.when(score > band, "positive").when(score < -band, "negative").otherwise("neutral")


def entity_valid(name: Column) -> Column:
    """Two to fifty characters, at most four fifths of them digits."""
    n = F.length(name)
    return F.coalesce((n >= 2) & (n <= 50) & (F.regexp_count(name, F.lit("[0-9]")) / n <= 0.8), F.lit(False))


def entity_key(name: Column) -> Column:
    return collapse(F.regexp_replace(F.trim(name), r"(?i)^(mr|mrs|ms|dr|prof|sir|president|chairman)\.?\s+", ""))


def iso_week(day: Column) -> Column:
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def pair_key(a: Column, b: Column) -> Column:
    return F.concat_ws("-", F.least(a, b), F.greatest(a, b))


def list_text(text: Column) -> Column:
    """A list written as text (['a', 'b'] or a, b) as an array."""
    inner = F.regexp_replace(F.trim(text), r"^\[|\]$", "")
    return F.filter(F.transform(F.split(inner, ","), lambda x: F.regexp_replace(F.trim(x), r"^['\"]|['\"]$", "")), lambda x: x != "")


def simhash64(text: Column, least: int = 50) -> Column:
    """Charikar's fingerprint over the first eight bytes of the shingles' SHA-256, signed; 0 for texts of under `least` characters.

    An Arrow kernel: 64 bit counters would be 64 passes over an array as expressions.
    """

    @F.pandas_udf("bigint")
    def run(grams: pd.Series) -> pd.Series:
        return grams.map(_fingerprint)

    return F.when(F.length(F.coalesce(text, F.lit(""))) < least, F.lit(0).cast("bigint")).otherwise(run(shingles(text)))


def _fingerprint(grams) -> int:
    if grams is None or not len(grams):
        return 0
    raw = np.frombuffer(b"".join(hashlib.sha256(g.encode()).digest()[:8] for g in grams), np.uint8).reshape(-1, 8)
    ones = np.unpackbits(raw, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(raw)).tobytes(), "big", signed=True)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
