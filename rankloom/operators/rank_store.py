"""PageRank state that outlives the application.

A store is a folder of the shared file system.  Creating it prepares the graph as :mod:`pagerank` does and writes the edge
shares bucketed by source, the pages bucketed by id, and the dictionary; each round's ranks are written bucketed by page,
with as many buckets.  A run that was ended anywhere goes on from the last round that is complete: the edges are
joined with the ranks bucket by bucket, without an exchange, and a round's only exchange carries the partial sums per target.

=========  =====================  ================================
edges      src, dst, w            bucketed and sorted by src
hot        src, salt, dst, w      by src and salt (hubs only)
hubs       src, salts             by src (hubs only)
nodes      page, w                by page; w: shares that uncited pages give
pages      id, value              plain
uncited    page                   plain; names of pages that are not in ``nodes`` (where :mod:`pagerank` keeps them apart)
ranks/k    page, rank             by page, after round k
rounds/k   round, total           one row, written when round k is complete
meta       one row of sizes
=========  =====================  ================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..bucketed import open_bucketed, table_name, write_bucketed
from ..session import Checkpoints, delete_path, path_exists
from ..tables import Tables
from .dictionary import Dictionary
from .pagerank import MODES, _first_round, _prepare, _round, _total, fixed_partitioning, uncited_rank, unpacked

_TABLES = {"edges": ("src long, dst long, w double", ["src"]), "hot": ("src long, salt int, dst long, w double", ["src", "salt"]),
           "hubs": ("src long, salts int", ["src"]), "nodes": ("page long, w double", ["page"])}
_META = "mode string, n long, buckets int, hubs long, uncited long"


class RankStore:
    def __init__(self, spark: SparkSession, folder: str):
        """Open a store, whichever application wrote it."""
        self.spark, self.folder = spark, folder.rstrip("/")
        self.meta = spark.read.schema(_META).parquet(f"{self.folder}/meta").first()

    @classmethod
    def create(cls, edges: DataFrame, folder: str, pages: DataFrame | None = None, *, mode: str = "all_nodes", n: int | None = None,
               partitions: int | None = None, hub_threshold: int | None = None) -> "RankStore":
        """Write the graph and the first round's ranks into a folder that does not exist yet; parameters as ``pagerank_run``'s."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        spark, folder = edges.sparkSession, folder.rstrip("/")
        if path_exists(spark, folder):
            raise FileExistsError(folder)
        with Checkpoints(spark) as files, Tables(spark) as tables:
            g = _prepare(files, tables, edges, pages, mode, n, partitions, hub_threshold, None, True)
            if not g.n:
                raise ValueError("a graph without pages")
            with fixed_partitioning(spark, g.parts):
                nodes = g.nodes.withColumn("w", F.lit(None).cast("double")) if g.entry is None else g.nodes.join(g.entry.select("page", "w"), "page", "left")
                for name, df in (("edges", g.cold), ("hot", g.hot), ("hubs", g.hubs), ("nodes", nodes)):
                    if df is not None:
                        keys = _TABLES[name][1]
                        write_bucketed(unpacked(df) if name in ("edges", "hot") else df, f"{folder}/{name}", g.parts, keys, keys)
                g.book.table.select("id", "value").write.parquet(f"{folder}/pages")
                apart, n_uncited = g.uncited_ranks(mode), 0
                if apart is not None:
                    apart.select("page").write.parquet(f"{folder}/uncited")
                    n_uncited = g.n_uncited
                first = _first_round(files.cut, g, mode)
                _write_round(folder, g.parts, 1, first, n_uncited * uncited_rank(mode, g.n))
            n_hubs = 0 if g.hubs is None else g.hubs.count()
            spark.createDataFrame([(mode, g.n, g.parts, n_hubs, n_uncited)], _META).coalesce(1).write.parquet(f"{folder}/meta")
        return cls(spark, folder)

    def _table(self, name: str) -> DataFrame | None:
        if name in ("hot", "hubs") and not self.meta.hubs:
            return None
        schema, keys = _TABLES[name]
        return open_bucketed(self.spark, f"{self.folder}/{name}", schema, self.meta.buckets, keys, keys)

    def _ids(self, number: int) -> DataFrame:
        return open_bucketed(self.spark, f"{self.folder}/ranks/{number}", "page long, rank double", self.meta.buckets, ["page"], ["page"])

    def rounds(self) -> list[tuple[int, float]]:
        """(round, total rank) of the complete rounds that are still stored, in order."""
        found = self.spark.read.schema("round int, total double").option("recursiveFileLookup", "true").parquet(f"{self.folder}/rounds")
        return sorted((r.round, r.total) for r in found.collect())  # the rounds kept: two at most

    def ranks(self) -> DataFrame:
        """``(page, rank)`` after the last complete round."""
        book = Dictionary(self.spark.read.schema("id long, value string").parquet(f"{self.folder}/pages"), 0)
        ranks = book.decode(self._ids(self.rounds()[-1][0]), "page")
        if not self.meta.uncited:
            return ranks
        return ranks.union(self.spark.read.schema("page string").parquet(f"{self.folder}/uncited").select("page", F.lit(self._uncited_rank()).alias("rank")))

    def _uncited_rank(self) -> float:
        return uncited_rank(self.meta["mode"], self.meta.n)

    def step(self, ranks: DataFrame) -> DataFrame:
        """The plan of one round over the stored graph (within ``fixed_partitioning`` of the store's buckets)."""
        entry = None
        if self.meta.uncited:
            entry = self._table("nodes").where("w IS NOT NULL").select("page", (F.col("w") * F.lit(self._uncited_rank())).alias("w"))
        return _round(self._table("edges"), self._table("hot"), self._table("hubs"), ranks, self.meta["mode"], entry)

    def advance(self, to_round: int, tol: float | None = None) -> int:
        """Go on until ``to_round`` rounds are done in all, or the total rank changes by at most ``tol``; gives the rounds done."""
        with fixed_partitioning(self.spark, self.meta.buckets):
            while True:
                done = self.rounds()
                last = done[-1][0]
                settled = tol is not None and len(done) > 1 and abs(done[-1][1] - done[-2][1]) <= tol
                if last >= to_round or settled:
                    return last
                self._discard(last + 1)  # what an ended run may have left of it
                _write_round(self.folder, self.meta.buckets, last + 1, self.step(self._ids(last)), (self.meta.uncited or 0) * self._uncited_rank())
                for number, _ in done[:-1]:
                    self._discard(number)

    def _discard(self, number: int) -> None:
        delete_path(self.spark, f"{self.folder}/rounds/{number}")
        self.spark.sql(f"DROP TABLE IF EXISTS {table_name(f'{self.folder}/ranks/{number}')}")
        delete_path(self.spark, f"{self.folder}/ranks/{number}")


def _write_round(folder: str, buckets: int, number: int, ranks: DataFrame, rest: float) -> None:
    """Write a round's ranks; ``rest``: the total rank of pages that are in no round."""
    # A round's plan ends dealt out by page into as many partitions as there are buckets.
    written = write_bucketed(ranks, f"{folder}/ranks/{number}", buckets, ["page"], ["page"], dealt=True)
    total = _total(written) + rest
    ranks.sparkSession.range(1).select(F.lit(number).alias("round"), F.lit(total).alias("total")).coalesce(1).write.parquet(f"{folder}/rounds/{number}")
