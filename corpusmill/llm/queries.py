"""Queries of the llm operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.encoding import garbled_fields
from corpusmill.llm.incremental import batch_duplicates
from corpusmill.llm.langid import wrong_languages
from corpusmill.llm.mixing import mix_sources
from corpusmill.llm.pagebody import body_lines
from corpusmill.llm.quality import COMMON_WORDS, FEATURES, KOREAN_ENDINGS, junk_probability, text_statistics
from corpusmill.llm.repeated import repeated_lines
from corpusmill.llm.residue import residue_pages
from corpusmill.llm.tokens import encode_corpus
from corpusmill.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return body_lines(table(spark, folder, "articles"), table(spark, folder, "lang_samples"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_lines(table(spark, folder, "articles"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return garbled_fields(table(spark, folder, "articles"), table(spark, folder, "lang_samples"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue_pages(table(spark, folder, "articles"), table(spark, folder, "lang_samples"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return batch_duplicates(table(spark, folder, "seen_urls"), table(spark, folder, "content_hashes"), table(spark, folder, "sources"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return wrong_languages(table(spark, folder, "articles"), table(spark, folder, "lang_samples"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(table(spark, folder, "documents"))


def _mix(spark: SparkSession, folder: str):
    return mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"), table(spark, folder, "items"))


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How often each used record goes into the mix."""
    return _mix(spark, folder).records


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and reached share of each source."""
    return _mix(spark, folder).shares


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return junk_probability(table(spark, folder, "documents")).where("p_junk > 0.5").select("doc_id").distinct()


def p10_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = text_statistics(table(spark, folder, "documents"))
    whole = {"n_words", "longest_word", "n_lines"}
    return stats.select("doc_id", *(f if f in whole else F.round(f, 6).alias(f) for f in FEATURES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p7_found": p7_found,
    "p8_ids": p8_ids,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_stats": p10_stats,
}
SQL: dict[str, str] = {
    "p3_found": r"""
        with a as (select distinct article_id, source, body from articles),
        lines as (
            select article_id, source, unnest(generate_series(1, len(string_split(body, chr(10))))) as line_no, unnest(string_split(body, chr(10))) as line
            from a where body is not null),
        norm as (
            select article_id, source, cast(line_no as integer) as line_no,
                   trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\s\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{85}]+', ' ', 'g')) as k
            from lines),
        freq as (
            select source, k from norm where k <> '' group by source, k
            having count(distinct article_id) >= 4
               and count(distinct article_id) >= 0.02 * (select count(distinct t.article_id) from a t where t.source is not distinct from norm.source))
        select distinct n.article_id, n.line_no from norm n join freq f on n.k = f.k and n.source is not distinct from f.source
    """,
}

_SPACE = r"[\s\x{a0}\x{3000}]+"
_END = r"[.!?…。！？][\x{22}\x{27}”“’»)\]]*$"
_COMMON = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted({w for ws in COMMON_WORDS.values() for w in ws.split()})) + "]"
_KOREAN = f"^[가-힣]+({KOREAN_ENDINGS})$"
SQL["p10_stats"] = rf"""
    with b as (
        select doc_id, coalesce(text, '') as t from documents),
    c as (
        select doc_id, t, length(regexp_replace(t, '{_SPACE}', '', 'g')) as chars,
               list_filter(string_split_regex(lower(t), '{_SPACE}'), lambda w: w <> '') as w,
               list_filter(list_transform(string_split(t, chr(10)), lambda x: regexp_replace(x, '^{_SPACE}|{_SPACE}$', '', 'g')), lambda x: x <> '') as l
        from b),
    d as (
        select *, len(w) as n, len(l) as nl,
               list_transform(w, lambda x: regexp_replace(x, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')) as k
        from c),
    e as (
        select *, length(regexp_replace(t, '[^\t]', '', 'g')) as tabs from d)
    select doc_id, cast(n as bigint) as n_words,
        round(case when n > 0 then chars / n else 0 end, 6) as mean_word_length,
        cast(coalesce(list_max(list_transform(w, lambda x: length(x))), 0) as bigint) as longest_word,
        cast(nl as bigint) as n_lines,
        round(case when chars > 0 then length(regexp_replace(t, '[\p{{L}}\p{{N}}\s\x{{a0}}\x{{3000}}]', '', 'g')) / chars else 0 end, 6) as symbol_ratio,
        round(case when chars > 0 then length(regexp_replace(t, '[^0-9]', '', 'g')) / chars else 0 end, 6) as digit_ratio,
        round(case when chars + tabs > 0 then length(regexp_replace(t, '[^|\t=#;/&$%*<>{{}}_~^\\]', '', 'g')) / (chars + tabs) else 0 end, 6) as separator_ratio,
        round(case when chars > 0 then length(regexp_replace(t, '\P{{L}}', '', 'g')) / chars else 0 end, 6) as letter_ratio,
        round(case when nl > 0 then len(list_filter(l, lambda x: regexp_matches(x, '{_END}'))) / nl else 0 end, 6) as punctuated_line_share,
        round(case when nl > 0 then len(list_filter(l, lambda x: len(string_split_regex(x, '{_SPACE}')) <= 4)) / nl else 0 end, 6) as short_line_share,
        round(case when nl > 0 then len(list_filter(l, lambda x: regexp_matches(x, '^([-+*•–]|[0-9]+[.)])[\s\x{{a0}}]'))) / nl else 0 end, 6) as bullet_line_share,
        round(case when n > 0 then len(list_filter(k, lambda x: list_contains({_COMMON}, x) or regexp_matches(x, '{_KOREAN}'))) / n else 0 end, 6) as common_word_share,
        round(case when n > 0 then len(list_filter(w, lambda x: regexp_matches(x, '[0-9]'))) / n else 0 end, 6) as digit_word_share,
        round(case when n > 0 then length(regexp_replace(t, '[^,]', '', 'g')) / n else 0 end, 6) as comma_rate,
        round(case when n > 0 then len(list_distinct(k)) / n else 0 end, 6) as distinct_word_share,
        round(case when nl > 0 then coalesce(list_sum(list_transform(list_filter(l, lambda x: regexp_matches(x, '{_END}') and len(string_split_regex(x, '{_SPACE}')) >= 3 and regexp_matches(x, '\p{{L}}{{2}}')), lambda x: length(x))), 0)
              / list_sum(list_transform(l, lambda x: length(x))) else 0 end, 6) as sentence_line_share
    from e
"""
