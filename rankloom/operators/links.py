"""Page lines and HTML pages -> titles, links and edges.

Three parsing rules, one per PageRank variant of the reference:

* ``first_section``: title = first title, links from the first text section
  only, title trimmed (``keep_uncited``);
* ``whole_line``: title = first title, links anywhere in the line
  (``all_nodes``);
* ``all_sections``: title = all titles joined with ',', links from every
  text section (``cited_only``).

Blank lines and lines without a title yield no page (the reference crashes
or invents an empty title on them).  Everything is a per-row projection; the
only wide steps are the distinct counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import markup as M
from ..functions.text_formats import encode_links

RULES = ("first_section", "whole_line", "all_sections")
RULE_OF_MODE = {"keep_uncited": "first_section", "all_nodes": "whole_line", "cited_only": "all_sections"}


def with_line_id(lines: DataFrame, line: str = "line") -> DataFrame:
    """``(line_id, line)``; keeps an existing ``line_id`` column, else numbers lines.

    ``monotonically_increasing_id`` may differ between two evaluations of one plan, so a caller
    that joins on it has to materialise the numbered rows first (``pagerank_lines`` does).
    """
    if "line_id" in lines.columns:
        return lines.select("line_id", F.col(line).alias("line"))
    return lines.select(F.monotonically_increasing_id().alias("line_id"), F.col(line).alias("line"))


def parse_pages(lines: DataFrame, rule: str = "whole_line", line: str = "line",
                strip_target_spaces: bool = False) -> DataFrame:
    """``(line_id, title, links ARRAY<STRING>)``: one row per page line.

    ``strip_target_spaces`` removes spaces inside link targets (F21; off by
    default so that ``[[New York]]`` meets the page ``New York``).
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    src = with_line_id(lines, line).filter(M.has_title("line"))  # no title, so null and blank lines go too
    if rule == "first_section":
        title = M.trim_key(M.first_title("line"))
        links = M.links(M.first_text("line"))
    elif rule == "whole_line":
        title = M.first_title("line")
        links = M.links("line")
    else:
        title = M.joined_titles("line")
        links = M.links_in_texts("line")
    if strip_target_spaces:
        links = F.transform(links, M.strip_spaces)
    return src.select("line_id", title.alias("title"), links.alias("links"))


def explode_links(pages: DataFrame, *cols: str, pos: bool = False) -> DataFrame:
    """One row per link of each page, ``cols`` kept; pages without links give none.

    Written as an outer explode plus a null filter (a link target is never
    null, so only empty lists drop out).  An inner explode makes the
    optimizer add ``size(links) > 0`` below it, which it pushes through the
    projection by copying the regex extraction, so the markup would be
    parsed twice per line.
    """
    gen = (F.posexplode_outer("links").alias("pos", "dst") if pos else F.explode_outer("links").alias("dst"))
    return pages.select(*cols, gen).filter(F.col("dst").isNotNull())


def page_edges(pages: DataFrame) -> DataFrame:
    """``(line_id, src, dst)``, one row per link; pages without links give none."""
    return explode_links(pages.withColumnRenamed("title", "src"), "line_id", "src")


def adjacency(pages: DataFrame) -> DataFrame:
    """``(title, out_degree, links_text)``: link list encoded as ``a@!#b``."""
    return pages.select("title", F.size("links").alias("out_degree"), encode_links("links").alias("links_text"))


def title_count(lines: DataFrame, line: str = "line") -> DataFrame:
    """One row ``(n)``: distinct first titles of the lines that have one."""
    t = with_line_id(lines, line).filter(M.has_title("line")).select(M.first_title("line").alias("t"))
    return t.agg(F.count_distinct("t").alias("n"))


def title_target_count(lines: DataFrame, line: str = "line") -> DataFrame:
    """One row ``(n)``: distinct values of every title and every link target."""
    values = F.explode(F.concat(M.all_titles(line), M.links(line))).alias("v")
    return lines.filter(F.col(line).isNotNull()).select(values).agg(F.count_distinct("v").alias("n"))


def line_count(lines: DataFrame) -> DataFrame:
    """One row ``(n)``: every line, blank ones included."""
    return lines.agg(F.count(F.lit(1)).alias("n"))


def html_titles(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """F11 on raw HTML: ``(page_id, title)``, first title element ('' when absent)."""
    return pages.select(F.col(key).alias("page_id"), M.first_title(html).alias("title"))


def html_links(pages: DataFrame, key: str = "page_id", html: str = "html",
               pattern: str = M.HREF_PATTERN) -> DataFrame:
    """F15/F20 on raw HTML: ``(page_id, pos, target)``, one row per link in page order."""
    return pages.select(F.col(key).alias("page_id"),
                        F.posexplode(M.links(html, pattern)).alias("pos", "target"))
