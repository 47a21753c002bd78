"""Fields of HTML pages, feeds and sitemaps, from their text, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHROME = "script|style|nav|aside|footer|header|form|noscript|iframe|figure"


# Named characters that pages write besides those of plain texts.
PAGE_ENTITIES = (("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"), ("&laquo;", "«"), ("&raquo;", "»"), ("&middot;", "·"), ("&copy;", "©"))


def _unescape(text: Column) -> Column:
    from corpusmill.functions.text import HTML_ENTITIES

    for name, char in (*PAGE_ENTITIES, *HTML_ENTITIES):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def plain(html: Column) -> Column:
    """Text without tags, unescaped, spaces collapsed."""
    return F.trim(F.regexp_replace(_unescape(F.regexp_replace(html, r"<[^>]*>", " ")), r"\s+", " "))


def _first(html: Column, pattern: str) -> Column:
    return F.nullif(plain(F.regexp_extract(html, pattern, 1)), F.lit(""))


def meta(html: Column, name: str) -> Column:
    """content of the meta tag whose name or property is name, attributes in either order."""
    tag = rf"(?is)<meta[^>]*(?:name|property)\s*=\s*[\"']{name}[\"'][^>]*content\s*=\s*[\"']([^\"']*)[\"']"
    back = rf"(?is)<meta[^>]*content\s*=\s*[\"']([^\"']*)[\"'][^>]*(?:name|property)\s*=\s*[\"']{name}[\"']"
    return F.coalesce(_first(html, tag), _first(html, back))


def html_title(html: Column) -> Column:
    """og:title, else the longest part of <title> at the first separator that occurs, else the first heading."""
    title = _first(html, r"(?is)<title[^>]*>(.*?)</title>")
    cut = F.split(title, r"\Q | \E")
    for sep in (" >> ", " :: ", " - ", " | "):
        parts = F.split(title, rf"\Q{sep}\E")
        cut = F.when(F.contains(title, F.lit(sep)), parts).otherwise(cut)
    longest = F.trim(F.element_at(F.array_sort(cut, lambda a, b: F.length(b) - F.length(a)), 1))
    out = F.coalesce(meta(html, "og:title"), longest)
    for level in range(1, 7):
        out = F.coalesce(out, _first(html, rf"(?is)<h{level}[^>]*>(.*?)</h{level}>"))
    return F.coalesce(out, F.lit(""))


def json_ld(html: Column, field: str) -> Column:
    block = F.regexp_extract(html, r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>", 1)
    return F.nullif(F.get_json_object(block, f"$.{field}"), F.lit(""))


def html_date(html: Column) -> Column:
    """Raw text of the publication date: meta tags, JSON-LD, then <time>."""
    out = meta(html, "article:published_time")
    for name in ("og:published_time", "datePublished", "date", "pubdate", "DC.date.issued"):
        out = F.coalesce(out, meta(html, name.replace(".", r"\.")))
    return F.coalesce(out, json_ld(html, "datePublished"), F.nullif(F.regexp_extract(html, r"(?is)<time[^>]*datetime\s*=\s*[\"']([^\"']*)", 1), F.lit("")))


def author_clean(name: Column) -> Column:
    """Without By and similar in front and a date behind."""
    out = F.regexp_replace(F.trim(name), r"(?i)^(?:by|author:|written by|von|par|por)(?:\s+|$)", "")
    return F.nullif(F.trim(F.regexp_replace(out, r"[,|–-]?\s*\d{1,4}[./-]\d{1,2}[./-]\d{1,4}.*$", "")), F.lit(""))


def html_author(html: Column) -> Column:
    byline = _first(html, r"(?is)<[^>]*class\s*=\s*[\"'][^\"']*(?:byline|author)[^\"']*[\"'][^>]*>(.*?)</")
    return author_clean(F.coalesce(meta(html, "author"), meta(html, "article:author"), json_ld(html, "author.name"), byline))


def html_body(html: Column) -> Column:
    """Text of the paragraphs of the article element, or of the page, without scripts, menus and the like."""
    core = F.regexp_replace(html, rf"(?is)<({_CHROME})\b[^>]*>.*?</\1>", " ")
    article = F.coalesce(F.nullif(F.regexp_extract(core, r"(?is)<article[^>]*>(.*?)</article>", 1), F.lit("")), F.nullif(F.regexp_extract(core, r"(?is)<main[^>]*>(.*?)</main>", 1), F.lit("")), core)
    paragraphs = F.regexp_extract_all(article, F.lit(r"(?is)<(?:p|h2|h3|li)\b[^>]*>(.*?)</(?:p|h2|h3|li)>"), F.lit(1))
    return F.array_join(F.filter(F.transform(paragraphs, plain), lambda x: x != ""), "\n\n")


def html_links(html: Column, host: Column) -> Column:
    """Distinct absolute link targets; relative ones get the host."""
    hrefs = F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*href\s*=\s*[\"']([^\"'#]+)"), F.lit(1))
    absolute = F.transform(hrefs, lambda h: F.when(h.rlike("^https?://"), h).when(h.startswith("/"), F.concat(F.lit("https://"), host, h)))
    return F.array_distinct(F.filter(absolute, lambda h: h.isNotNull()))


def feed_items(xml: Column) -> Column:
    """Array of (url, published, title) of RSS, Atom, sitemap and urlset texts."""
    blocks = F.regexp_extract_all(xml, F.lit(r"(?is)<(?:item|entry|url|sitemap)\b[^>]*>(.*?)</(?:item|entry|url|sitemap)>"), F.lit(1))

    def field(b: Column, names: str) -> Column:
        return F.nullif(plain(F.regexp_replace(F.regexp_extract(b, rf"(?is)<(?:\w+:)?(?:{names})\b[^>]*(?<!/)>(.*?)</", 1), r"<!\[CDATA\[|\]\]>", "")), F.lit(""))

    link = lambda b: F.coalesce(field(b, "link|loc"), F.nullif(F.regexp_extract(b, r"(?is)<link[^>]*href\s*=\s*[\"']([^\"']*)", 1), F.lit("")))
    return F.transform(blocks, lambda b: F.struct(link(b).alias("url"), field(b, "pubDate|published|updated|lastmod|publication_date|date").alias("published"), field(b, "title").alias("title")))


def embedded_article(html: Column) -> Column:
    """(title, body, published) of a page that carries its article as JSON in a script."""
    raw = F.regexp_extract(html, r"(?s)globalContent\s*=\s*(\{.*?\});", 1)
    schema = "headlines struct<basic:string>, content_elements array<struct<type:string,content:string>>, publish_date string"
    j = F.from_json(raw, schema)
    text = F.filter(j.content_elements, lambda e: e.type.isin("text", "header") & (F.coalesce(e.content, F.lit("")) != ""))
    return F.when(raw != "", F.struct(j.headlines.basic.alias("title"), F.array_join(F.transform(text, lambda e: plain(e.content)), "\n\n").alias("body"), j.publish_date.alias("published")))


def strip_ruby(html: Column) -> Column:
    """Without ruby annotations and bidirectional marks."""
    return F.regexp_replace(F.regexp_replace(html, r"(?is)<r[tp]\b[^>]*>.*?</r[tp]>|</?ruby[^>]*>", ""), "[‎‏‪-‮⁦-⁩]", "")


def sitemap_date(url: Column) -> Column:
    """Last day of the month that an address names as YYYY-MM or YYYYMM, or null."""
    y = F.regexp_extract(url, r"(?:^|\D)((?:19|20)\d{2})[-/]?(0[1-9]|1[0-2])(?:\D|$)", 1)
    m = F.regexp_extract(url, r"(?:^|\D)((?:19|20)\d{2})[-/]?(0[1-9]|1[0-2])(?:\D|$)", 2)
    return F.when(y != "", F.last_day(F.make_date(y.cast("int"), m.cast("int"), F.lit(1))))


def relative_time(text: Column, now: Column) -> Column:
    """Instants written as '3 hours ago', '3시간 전', 'vor 3 Stunden' or 'il y a 3 heures'; null for others."""
    n = F.regexp_extract(text, r"(\d+)", 1).cast("int")
    low = F.lower(text)
    ago = low.rlike(r"ago$|전$|^vor |^il y a |前$|^hace |^há ")
    unit = F.when(low.rlike(r"min|분|分"), 60).when(low.rlike(r"hour|시간|stunde|heure|hora|小时|時間"), 3600).when(low.rlike(r"week|주|woche|semaine|semana|周|週"), 604800).when(low.rlike(r"day|일|tag|jour|d[ií]a|天|日"), 86400)
    return F.when(ago & n.isNotNull(), F.timestamp_seconds(F.unix_timestamp(now) - n * unit))
