"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest (SHA-256 of the text in UTF-8 with A-Z
lowered), in a folder of the shared file system.  A batch takes one path, whether the index is empty or not: its rows are
reduced to one per digest, anti-joined with the index by a sort-merge join that does not move the index, the
digests that are new are appended, and every row's verdict is read back from the index by a second such join.

A copy group may hold a third of all rows, so rows are first aggregated by (digest, salt) and
only the at most ``SALTS`` rows of a digest meet in one place; rows find their group again by
(digest, salt), which spreads a hot group over ``SALTS`` keys.

Edge cases: a null text counts as empty; very long texts are digested whole.  Rows are judged by number, so ids may be
null or repeated: of equal texts in a batch the row with the largest id stays (null is smaller than any), of these
the first.  An empty batch gives no rows and appends nothing.  Columns other than the id and the text are not read,
whatever their names (``keep_one`` hands them through).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.bucketed import open_bucketed, table_name
from rankloom.session import delete_path, ensure_checkpoint_dir, path_exists

from .common import Scratch, ascii_lower, numbered, whole_text, without_ids

SALTS = 256
_SCHEMA = "digest binary, keep_id {id}, batch string, row long"


class DigestIndex:
    """A table ``(digest, keep_id, batch, row)`` in ``folder``, bucketed and sorted by digest: the row that stays, and the
    batch that brought it.

    A folder of an index that exists, also one of an earlier application, is gone on with; else an empty
    table is made.  Without a folder it is a new one in ``spark.checkpoint.dir``.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int | None = None, id_type: str = "long"):
        self.spark, self.folder = spark, (folder or f"{ensure_checkpoint_dir(spark)}/digests-{uuid.uuid4().hex}").rstrip("/")
        if path_exists(spark, f"{self.folder}/meta"):
            self.buckets, self.id_type = spark.read.parquet(f"{self.folder}/meta").first()
        else:
            self.buckets, self.id_type = buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), id_type
            spark.createDataFrame([(self.buckets, self.id_type)], "buckets int, id_type string").coalesce(1).write.parquet(f"{self.folder}/meta")
        self.path = f"{self.folder}/digests"
        open_bucketed(spark, self.path, _SCHEMA.format(id=self.id_type), self.buckets, ["digest"], ["digest"])

    @property
    def name(self) -> str:
        return table_name(self.path)

    def append(self, rows: DataFrame) -> None:
        """Add new digests; dealt by digest first, so that each task writes few bucket files."""
        (rows.select("digest", "keep_id", "batch", "row").repartition(self.buckets, "digest").write.format("parquet").mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name))

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.folder)


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.encode(ascii_lower(whole_text(text)), "UTF-8"), 256))


def _unknown(groups: DataFrame, index: DigestIndex) -> DataFrame:
    """The groups whose digest the index has not."""
    return groups.join(index.read().select("digest").hint("merge"), "digest", "left_anti")


def _judged(files: Scratch, rows: DataFrame, index: DigestIndex) -> DataFrame:
    """``rows(row, doc_id, digest)``, a written table, with keep_id, group_size and kept, after their digests joined the index."""
    batch = uuid.uuid4().hex
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    best = F.max(F.struct("doc_id", (-F.col("row")).alias("first"))).alias("best")
    parts = files(rows.groupBy("digest", "salt").agg(best, F.count("*").alias("group_size")))
    groups = files(parts.groupBy("digest").agg(F.max("best").alias("best"), F.sum("group_size").alias("group_size"))
                   .select("digest", F.col("best.doc_id").alias("keep_id"), F.lit(batch).alias("batch"), (-F.col("best.first")).alias("row"), "group_size"))
    index.append(files(_unknown(groups, index)))
    stays = index.read().select("digest", "keep_id", F.when(F.col("batch") == batch, F.col("row")).alias("kept_row"))
    verdict = groups.select("digest", "group_size").join(stays.hint("merge"), "digest")
    spread = files(parts.select("digest", "salt").join(verdict, "digest"))
    return (rows.join(spread, ["digest", "salt"])
            .select("row", "doc_id", "keep_id", "group_size", F.col("row").eqNullSafe(F.col("kept_row")).alias("kept"), "digest"))


def dedup(docs: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Judge a batch against the index and append its new digests.

    Returns, as a written table, one row per row of the batch: doc_id, keep_id (of the row that stays:
    the indexed one if the text was known), group_size (rows of the batch with that text), kept, digest.
    """
    with Scratch(docs.sparkSession) as files:
        rows = files(docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), _digest(text).alias("digest")))
        return files.keep(files(_judged(files, rows, index).drop("row")))


def _own_index(docs: DataFrame) -> DigestIndex:
    """An index of one run, deleted after it."""
    return DigestIndex(docs.sparkSession, id_type=docs.schema["doc_id"].dataType.simpleString())


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document, judged against an index that starts empty."""
    index = _own_index(docs)
    try:
        return dedup(docs, index).select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept",
                                         F.lower(F.hex("digest")).alias("text_sha256"))
    finally:
        index.drop()


def keep_one(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each text.

    Pass an index to go on from earlier batches: texts that it has go.
    """
    own = index or _own_index(docs)
    try:
        with Scratch(docs.sparkSession) as files:
            table, row = numbered(files, docs)
            rows = files(table.select(F.col(row).alias("row"), "doc_id", _digest("text").alias("digest")))
            dropped = files(_judged(files, rows, own).where("NOT kept").select(F.col("row").alias(row)))
            return without_ids(files.keep(table), files.keep(dropped), row).select(*docs.columns)
    finally:
        if index is None:
            own.drop()


SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS n, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
        row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST, n) AS place FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, h AS text_sha256 FROM g
"""
