"""Tokenizer columns (F1, F2, C1) and query-word normalisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference for identical tokens.
#   * each line is split with the Java pattern  \s*\b\s*  and empty pieces
#     are dropped; no lower-casing, stemming or stop words;
#   * text is cut into lines first, at \r\n, \r or \n (a line reader's rule).
REFERENCE_TOKEN_PATTERN = r"\s*\b\s*"
LINE_BREAK_PATTERN = r"\r\n|\r|\n"
# ---------------------------------------------------------------------------

# The same split with the word boundary written out.  On JDK 17 a word character for \b is a letter, a
# decimal digit, '_', or a non-spacing mark that follows a letter or digit (with other marks between at
# most); JDK 19+ turned \b ASCII-only.  Spelling the boundary out keeps the tokens the same on whatever
# JDK the executors run.  Java's look-behind needs a bound on the marks in a row:
MAX_MARKS = 8
_BASE, _MARKS = r"[\p{L}\p{Nd}]", r"\p{Mn}{0,%d}" % MAX_MARKS
_AFTER_BASE = f"(?<={_BASE}{_MARKS})"
TOKEN_SPLIT_PATTERN = (
    r"\s*(?:"
    + _AFTER_BASE + r"(?![\p{L}\p{Nd}_\p{Mn}])"                  # a word ends after a letter, digit or its marks
    r"|(?<=_)(?![\p{L}\p{Nd}_])"                                 # or after '_'
    rf"|(?<!{_BASE}{_MARKS})(?<!_)(?=[\p{{L}}\p{{Nd}}_])"          # or begins
    r")\s*"
)


def split_lines(text: Column | str) -> Column:
    """ARRAY<STRING> of the lines of a text value."""
    return F.split(text, LINE_BREAK_PATTERN)


def split_tokens(line: Column | str, pattern: str = TOKEN_SPLIT_PATTERN) -> Column:
    """ARRAY<STRING> of the pieces of one line; may hold empty strings (drop them, C1)."""
    return F.split(line, pattern)


_SPACE = r"[ \t\x0B\f]"  # \s within a line


def text_tokens(text: Column | str, pattern: str = TOKEN_SPLIT_PATTERN) -> Column:
    r"""ARRAY<STRING> of the pieces of all lines of a text value; may hold empty strings (drop them, C1).

    What ``split_tokens`` gives line by line, in one pass: every boundary with the white space around it becomes a
    line break, as line breaks stay.  ``\s*B\s*`` is written as two cases that give the same matches: at a boundary, or at
    white space before one.  A boundary that follows white space ends the match before and is not taken again; a
    line break after a boundary goes with it, as the search moves on by one after an empty match.
    """
    boundary = pattern.removeprefix(r"\s*").removesuffix(r"\s*")
    marked = F.regexp_replace(text, F.lit(rf"{boundary}(?<!{_SPACE}){_SPACE}*[\r\n]?|{_SPACE}+{boundary}|[\r\n]"), F.lit("\n"))
    return F.split(marked, "\n")


_UNICODE_BOUNDARY: dict[str, bool] = {}


def token_split_pattern(spark) -> str:
    r"""The fastest split pattern that gives the reference's tokens on this cluster.

    ``\s*\b\s*`` itself when the executors' regex engine treats letters
    such as 'é' as word characters (JDK 17 and older), else the spelled-out
    boundary.  Decided once per application by splitting a probe string in a
    one-row Spark job, so it reflects the executors, not the driver.
    """
    from ..session import application_id

    key = application_id(spark)
    if key not in _UNICODE_BOUNDARY:
        probe = spark.range(1).select(F.split(F.lit("a\u00e9 b"), REFERENCE_TOKEN_PATTERN).alias("t")).first()["t"]
        _UNICODE_BOUNDARY[key] = [t for t in probe if t] == ["a\u00e9", "b"]
    return REFERENCE_TOKEN_PATTERN if _UNICODE_BOUNDARY[key] else TOKEN_SPLIT_PATTERN


def query_words(words: Iterable[str] | str, split_commas: bool = True) -> list[str]:
    """Normalise search words: a set, without empties.

    The reference passes the words through a comma-joined job setting, so a
    word holding ',' arrives as several words; ``split_commas`` keeps that.
    The list is a command-line argument, so it is small by construction.
    """
    if isinstance(words, str):
        words = [words]
    out: set[str] = set()
    for w in words:
        parts = w.split(",") if split_commas else [w]
        out.update(p for p in parts if p != "")
    return sorted(out)
