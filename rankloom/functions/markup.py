"""Wiki-line and HTML extraction columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Markup patterns of the page-line format
#   <title>T</title> <text ...>... [[target]] ...</text>
TITLE_PATTERN = r"<title>(.*?)</title>"
TEXT_PATTERN = r"<text+\s*[^>]*>(.*?)</text>"
LINK_PATTERN = r"\[\[(.*?)\]\]"
# Separator the all-titles form joins several titles of one line with.
TITLE_JOIN = ","
# ---------------------------------------------------------------------------

# Link pattern for raw HTML pages (the ``pages`` table); a parameter, not a
# reference value.
HREF_PATTERN = r'href="([^"]*)"'


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_title(line: Column | str) -> Column:
    """C4: the line holds a title element."""
    return _col(line).rlike(TITLE_PATTERN)


def first_title(line: Column | str) -> Column:
    """group 1 of the first title match ('' if none)."""
    return F.regexp_extract(_col(line), TITLE_PATTERN, 1)


def all_titles(line: Column | str) -> Column:
    """every title of the line, in order."""
    return F.regexp_extract_all(_col(line), F.lit(TITLE_PATTERN), F.lit(1))


def joined_titles(line: Column | str) -> Column:
    """All titles joined with ',' (tags stripped by taking group 1)."""
    return F.array_join(all_titles(line), TITLE_JOIN)


def first_text(line: Column | str) -> Column:
    """group 1 of the first text section ('' if none)."""
    return F.regexp_extract(_col(line), TEXT_PATTERN, 1)


def all_texts(line: Column | str) -> Column:
    """every text section of the line, in order."""
    return F.regexp_extract_all(_col(line), F.lit(TEXT_PATTERN), F.lit(1))


def links(c: Column | str, pattern: str = LINK_PATTERN) -> Column:
    """every link target in a string, in order, duplicates kept."""
    return F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(1))


def links_in_texts(line: Column | str) -> Column:
    """link targets of all text sections.

    Sections are joined with a newline, which ``.`` never matches, so no link
    can be formed across two sections.
    """
    return links(F.array_join(all_texts(line), "\n"))


def strip_spaces(c: Column | str) -> Column:
    """remove every space (used on link targets when asked)."""
    return F.replace(_col(c), F.lit(" "), F.lit(""))


def trim_key(c: Column | str) -> Column:
    """trim surrounding spaces of a page key."""
    return F.trim(_col(c))
