"""Text-file sources (S1-S9): folders of documents, page lines, edge lists and
the reference's key/value result files.  All are distributed scans; nothing
is read on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text_formats as X

# Suffix the reference appends to every document's file name.
DOC_SUFFIX = ".txt"


def _paths(paths: str | list[str]) -> list[str]:
    if isinstance(paths, str):
        return [p for p in paths.split(",") if p]
    return list(paths)


DOC_KEYS = {"path": "_metadata.file_path", "name": "_metadata.file_name"}


def read_text_docs(spark: SparkSession, paths: str | list[str], doc_suffix: str = "", key: str = "path") -> DataFrame:
    """``(doc, text)``, one row per line; ``doc`` = the file's ``key`` + ``doc_suffix``.

    ``key="path"`` keeps files of the same name in different folders apart; ``key="name"`` labels a
    document by its base name, as the reference's files do, and merges such files.
    Comma-separated paths are accepted like the reference's input argument.
    Pass ``key="name", doc_suffix=".txt"`` for the reference's document labels.
    """
    lines = spark.read.text(_paths(paths))
    return lines.select(F.concat(F.col(DOC_KEYS[key]), F.lit(doc_suffix)).alias("doc"), F.col("value").alias("text"))


def list_docs(spark: SparkSession, paths: str | list[str], doc_suffix: str = "",
              recursive: bool = True, key: str = "path") -> DataFrame:
    """``(doc)``, one row per non-empty file below the paths (files without tokens included).

    Uses the ``binaryFile`` source with only the path selected, so file
    contents are not read.  Spark's file scans skip zero-byte files; use
    :func:`count_files` for the reference's N, which counts those too.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
             .load(_paths(paths)).select("path"))
    label = F.col("path") if key == "path" else F.element_at(F.split("path", "/"), -1)
    return files.select(F.concat(label, F.lit(doc_suffix)).alias("doc"))


def count_files(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> int:
    """Number of files below the paths whose names match ``pattern``, zero-byte ones included.

    A scan of the names alone (a document is a file, so they are data and stay distributed).  Spark's scans pass over
    zero-byte files and names that begin with ``.`` or ``_``; the file system's own summary, one call per path, counts
    them too, and is used where this client reaches it and every name is asked for, as the reference does.  Give the
    result to the text operators as ``all_docs`` to use it as N.
    """
    if pattern == "*":
        try:
            return _summary_count(spark, _paths(paths))
        except Exception:  # no JVM in this client (Spark Connect)
            pass
    names = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
             .load(_paths(paths)).select("path"))
    return names.count()


def _summary_count(spark: SparkSession, paths: list[str]) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += int(path.getFileSystem(conf).getContentSummary(path).getFileCount())
    return total


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(line_id, line)`` for page-line files, blank lines kept."""
    return spark.read.text(_paths(paths)).select(F.monotonically_increasing_id().alias("line_id"),
                                                 F.col("value").alias("line"))


def read_edge_list(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(src, dst)`` from ``src#####dst`` lines (lines without the separator are dropped)."""
    return spark.read.text(_paths(paths)).select(*X.parse_edge()).filter(F.col("dst").isNotNull())


def read_term_weights(spark: SparkSession, paths: str | list[str], value_type: str = "double") -> DataFrame:
    """``(word, doc, value)`` from ``word&#&#&doc<TAB>[<TAB>]value`` lines."""
    return spark.read.text(_paths(paths)).filter("value != ''").select(*X.parse_term_weight(value_type=value_type))


def read_scores(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(doc, score)`` from ``doc<TAB>score`` lines."""
    return spark.read.text(_paths(paths)).filter("value != ''").select(*X.parse_score())


def read_rank_state(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(page, rank, links)`` from ``page<TAB>##rank[##a@!#b]`` lines; ``pagerank_run(initial_ranks=...)``
    goes on from it."""
    return spark.read.text(_paths(paths)).filter("value != ''").select(*X.parse_rank_state())


__all__ = ["DOC_SUFFIX", "count_files", "list_docs", "read_edge_list", "read_lines", "read_rank_state",
           "read_scores", "read_term_weights", "read_text_docs"]
