"""Text sinks in the reference's file formats (K1-K8).

Each writer is one line column (``functions.text_formats``) plus ``DataFrame.write.text``; the
numbers print in Java's shortest form (``1.30103``, ``0.3916490552587094``), as the reference's
writers do.  Sorted inputs keep their order across part files (range-partitioned sort), so no
single-partition funnel is needed; ``single_file=True`` asks for one file where a consumer needs it.

A folder that exists is an error, as for the reference's output formats; ``overwrite=True`` replaces it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..functions import text_formats as X


def _write(col: Column, df: DataFrame, path: str, single_file: bool = False, overwrite: bool = False) -> None:
    out = df.select(col.alias("value"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite" if overwrite else "errorifexists").text(path)


def write_counts(df: DataFrame, path: str, value: str = "n", ordered: bool = False, overwrite: bool = False) -> None:
    """K1: ``word&#&#&doc<TAB><TAB>value`` (counts or TF); ``ordered`` sorts by key."""
    df = df.orderBy("word", "doc") if ordered else df
    _write(X.count_line(value=value), df, path, overwrite=overwrite)


def write_weights(df: DataFrame, path: str, value: str = "tfidf", ordered: bool = False, overwrite: bool = False) -> None:
    """K2: ``word&#&#&doc<TAB>value`` (TF-IDF); ``ordered`` sorts by key."""
    df = df.orderBy("word", "doc") if ordered else df
    _write(X.weight_line(value=value), df, path, overwrite=overwrite)


def write_scores(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """K3: ``doc<TAB>score``."""
    _write(X.score_line(), df, path, overwrite=overwrite)


def write_rank_state(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """K4: ``page<TAB>##rank[##a@!#b]`` from ``(page, rank, links)``, rank as a float32."""
    _write(X.rank_state_line(), df, path, overwrite=overwrite)


def write_ranked_pages(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """K5: ``page<TAB><TAB>rank``, rank as a float32."""
    _write(X.ranked_page_line(), df, path, overwrite=overwrite)


def write_rank_lines(df: DataFrame, path: str, single_file: bool = False, overwrite: bool = False) -> None:
    """K6: ``page   rank`` (three spaces)."""
    _write(X.rank_line("page", "rank"), df, path, single_file, overwrite)


def write_rank_report(df: DataFrame, path: str, single_file: bool = False, overwrite: bool = False) -> None:
    """K7: ``page has rank: r.``"""
    _write(X.rank_report("page", "rank"), df, path, single_file, overwrite)


def write_edge_list(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """K8: ``src#####dst``."""
    _write(X.edge_line(), df, path, overwrite=overwrite)
