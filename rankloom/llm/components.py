"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is a few joins and aggregates over the edges, ended by a written table; nothing is collected
but one row of totals, which tells when the edges stopped changing.  Minima are materialised before they
are joined back, so both sides of that join come from plain exchanges and a hub's edges can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _star(files: Scratch, edges: DataFrame, large: bool) -> DataFrame:
    """One star step on ``(u, v)`` with u > v, no repeated rows; ``edges`` are deleted.

    large: every node links its larger neighbours to its least neighbour (or itself).
    small: every node links its smaller neighbours, and itself, to the least of them.
    """
    near = (edges.select(F.col("u").alias("n"), F.col("v").alias("x")).unionByName(edges.select(F.col("v").alias("n"), F.col("u").alias("x")))
            if large else edges.select(F.col("u").alias("n"), F.col("v").alias("x")))
    least = files(near.groupBy("n").agg(F.min("x").alias("m")).select("n", F.least("n", "m").alias("m")))
    linked = near.join(least, "n").select("n", F.col("x").alias("u"), F.col("m").alias("v"))
    out = linked.where("u > n") if large else linked.unionByName(least.select("n", F.col("n").alias("u"), F.col("m").alias("v")))
    out = files(out.where("u > v").select("u", "v").distinct())
    files.drop(edges)
    files.drop(least)
    return out


def _total(edges: DataFrame):
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of an edge, ``component`` the least node it can reach; a written
    table, which is the caller's.

    ``edges``: two columns of one ordered type; loops, both directions and repeated rows are allowed.
    """
    a, b = edges.columns
    with Scratch(edges.sparkSession) as files:
        now = files(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
        before = _total(now)
        while before[0]:
            now = _star(files, _star(files, now, True), False)
            after = _total(now)
            if after == before:
                break
            before = after
        # A star: every node other than the centre has the one edge to it.
        return files.keep(files(now.select(F.col("u").alias("node"), F.col("v").alias("component"))
                                .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())))
