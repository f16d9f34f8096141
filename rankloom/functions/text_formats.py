"""Row-to-text encodings of the reference's text files and their parsers, as columns.

``*_line`` builds a file's line from row columns (K1-K8); ``parse_*`` gives the row columns of a
line (S5-S8).  Sinks and sources only add the file access.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Delimiters of the reference's text files.
WORD_DOC_SEP = "&#&#&"     # word&#&#&doc
TAB = "\t"                 # key<TAB>value
LINK_LIST_SEP = "@!#"      # a@!#b link list of a rank-state line
STATE_SEP = "##"           # page<TAB>##rank##links
EDGE_SEP = "#####"         # src#####dst
RANK_LINE_SEP = "   "      # page + three spaces + rank
RANK_REPORT = "%s has rank: %s."
# ---------------------------------------------------------------------------


def word_doc_key(word: Column | str, doc: Column | str) -> Column:
    """word&#&#&doc."""
    return F.concat_ws(WORD_DOC_SEP, F.col(word) if isinstance(word, str) else word,
                       (F.col(doc) if isinstance(doc, str) else doc).cast("string"))


def encode_links(links: Column | str) -> Column:
    """a@!#b."""
    return F.array_join(F.col(links) if isinstance(links, str) else links, LINK_LIST_SEP)


def decode_links(text: Column | str) -> Column:
    """F20 inverse of F19 (an empty string decodes to no links)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, F.lit(LINK_LIST_SEP), -1))


def rank_report(page: Column | str, rank: Column | str) -> Column:
    """'page has rank: r.'"""
    return F.format_string(RANK_REPORT, F.col(page) if isinstance(page, str) else page,
                           F.col(rank) if isinstance(rank, str) else rank)


def rank_line(page: Column | str, rank: Column | str) -> Column:
    """page + three spaces + rank."""
    return F.concat(F.col(page) if isinstance(page, str) else page, F.lit(RANK_LINE_SEP),
                    (F.col(rank) if isinstance(rank, str) else rank).cast("string"))


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def count_line(word: str = "word", doc: str = "doc", value: str = "n") -> Column:
    """K1: word&#&#&doc, two tabs, count or TF."""
    return F.concat(word_doc_key(word, doc), F.lit(TAB + TAB), _text(value))


def weight_line(word: str = "word", doc: str = "doc", value: str = "tfidf") -> Column:
    """K2: word&#&#&doc, a tab, TF-IDF."""
    return F.concat(word_doc_key(word, doc), F.lit(TAB), _text(value))


def score_line(doc: str = "doc", score: str = "score") -> Column:
    """K3: doc, a tab, score."""
    return F.concat(_text(doc), F.lit(TAB), _text(score))


def rank_state_line(page: str = "page", rank: Column | str = "rank", links: str = "links") -> Column:
    """K4: page, a tab, ##rank, and ##a@!#b where there are links; the rank prints as a float32."""
    tail = F.when(F.size(links) > 0, F.concat(F.lit(STATE_SEP), encode_links(links))).otherwise(F.lit(""))
    value = (F.col(rank) if isinstance(rank, str) else rank).cast("float")
    return F.concat(F.col(page), F.lit(TAB + STATE_SEP), _text(value), tail)


def ranked_page_line(page: str = "page", rank: Column | str = "rank") -> Column:
    """K5: page, two tabs, rank as a float32."""
    value = (F.col(rank) if isinstance(rank, str) else rank).cast("float")
    return F.concat(F.col(page), F.lit(TAB + TAB), _text(value))


def edge_line(src: str = "src", dst: str = "dst") -> Column:
    """K8: src#####dst."""
    return F.concat_ws(EDGE_SEP, src, dst)


def parse_edge(line: str = "value") -> list[Column]:
    """Src, dst (null where the separator is missing)."""
    parts = F.split(F.col(line), EDGE_SEP)
    return [F.get(parts, 0).alias("src"), F.get(parts, 1).alias("dst")]


def parse_term_weight(line: str = "value", value_type: str = "double") -> list[Column]:
    """Word, doc, value of a K1 or K2 line."""
    return [F.substring_index(line, WORD_DOC_SEP, 1).alias("word"),
            F.regexp_extract(line, "&#&#&([^\t]*)\t", 1).alias("doc"),
            F.regexp_extract(line, "\t+([^\t]*)$", 1).cast(value_type).alias("value")]


def parse_score(line: str = "value") -> list[Column]:
    """Doc, score of a K3 line; the score stands after the last tab."""
    return [F.regexp_extract(line, "(?s)^(.*)\t", 1).alias("doc"), F.substring_index(line, TAB, -1).cast("float").alias("score")]


def parse_rank_state(line: str = "value") -> list[Column]:
    """Page, rank, links of a K4 line."""
    kv = F.split(F.col(line), TAB, 2)
    parts = F.split(F.get(kv, 1), STATE_SEP)     # "", rank[, links]
    return [F.trim(F.get(kv, 0)).alias("page"), F.get(parts, 1).cast("double").alias("rank"),
            decode_links(F.coalesce(F.get(parts, 2), F.lit(""))).alias("links")]
