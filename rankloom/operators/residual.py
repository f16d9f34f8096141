"""PageRank by residuals: only pages whose rank still moves are pushed.

The ranks that rounds without end would reach solve ``rank = base + 0.85 * sum of shares``.  Each page holds a rank
and a residual, at first 0 and its base.  A round takes the pages whose residual exceeds a bound: their residual
goes into their rank, and 0.85 times its shares into the residuals of the pages they link to.  What is missing
to the exact ranks, over all pages, is at most the sum of residuals / (1 - 0.85), so the run stops when that is ``error`` at
most.  Pages are pushed while they are over the bound ``error * (1 - 0.85) / pages / 2``: when none is, the run has stopped.

Pushes alone take about 14 rounds for a digit.  After every ``WINDOW`` rounds the last pushes are therefore weighted
anew (reduced rank extrapolation, GMRES): pushing ``c`` times what a round pushed changes the residuals by ``c`` times what the
round changed them by, so residuals for any weights are known without reading a link, and those weights are taken
that make them least, if that makes their sum less and wakes no page.  Residuals may then be negative.  Ranks that are too high by
that are shortened at the end: ranks times ``1 - e`` have residuals that are greater by ``e`` times what pages get from no rank (0.15 at least), so
with the least such ``e`` none is negative, and the sum of residuals bounds what is missing as before.

The base is 0.15; a page nobody links to has its 1/N in ``keep_uncited`` (as it keeps that) and no place in ``cited_only``.
The plan is that of :mod:`pagerank`: written edge shares by source, hubs salted, one exchange per round, which
carries partial sums for the targets of active pages only.  A page nobody links to is pushed in the first round and never
gets a residual again, so where :mod:`pagerank` keeps such pages apart, the state holds cited pages only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.weights import DAMPING, TELEPORT
from ..session import Checkpoints, free_shuffles
from ..tables import Tables
from .pagerank import MODES, _first_round, _Graph, _named, _prepare, _sums, fixed_partitioning, uncited_rank, unpacked


# Rounds whose pushes are weighted anew together.
WINDOW = 4
# Part of the sum of residuals that new weights leave at most.
WORTH = 0.5


@dataclass
class ResidualRun:
    ranks: DataFrame                # (page, rank)
    missing: float                  # the ranks are at most this much short, in total
    rounds: int
    active: list[int] = field(default_factory=list)  # pages pushed in each round


def _bases(cut, g: _Graph, mode: str) -> DataFrame:
    """``(page, base)``, by page, of the pages that rounds work on."""
    if g.entry is not None:  # they are all cited
        return g.nodes.select("page", F.lit(TELEPORT).alias("base"))
    cited = unpacked(g.cold).select(F.col("dst").alias("page"))
    if g.hot is not None:
        cited = cited.union(unpacked(g.hot).select(F.col("dst").alias("page")))
    cited = cited.distinct().withColumn("cited", F.lit(True))
    if mode == "cited_only":
        return cited.select("page", F.lit(TELEPORT).alias("base"))
    if mode == "all_nodes":
        return g.nodes.select("page", F.lit(TELEPORT).alias("base"))
    # What round 1 leaves an uncited page with is what it keeps.
    return _first_round(cut, g, mode).join(cited, "page", "left").select("page", F.when(F.col("cited"), TELEPORT).otherwise(F.col("rank")).alias("base"))


def _pushed(residual: str, bound: float) -> Column:
    """What a push takes from a page's residual."""
    return F.when(F.abs(residual) > bound, F.col(residual)).otherwise(0.0)


def _push(g: _Graph, state: DataFrame, bound: float, entry: DataFrame | None = None, was: str | None = None) -> DataFrame:
    """The state after the pages over ``bound`` are pushed; ``entry(page, w)``: what pages apart give at the same time.

    Columns of the state beside page, rank and residual are kept; ``was``: the name of one that gets the residual before.
    """
    earlier = [c for c in state.columns if c not in ("page", "rank", "residual")]
    pushed = _pushed("residual", bound)
    active = state.where(F.abs("residual") > bound)
    sums = _sums(g.cold, g.hot, g.hubs, active.select(F.col("page").alias("src"), F.col("residual").alias("rank")))
    got = F.coalesce("s", F.lit(0.0))
    state = state.join(sums, "page", "left")
    if entry is not None:
        state, got = state.join(entry, "page", "left"), got + F.coalesce("w", F.lit(0.0))
    return state.select(
        "page", (F.col("rank") + pushed).alias("rank"), (F.col("residual") - pushed + DAMPING * got).alias("residual"),
        *earlier, *([F.col("residual").alias(was)] if was else []))


@dataclass
class _Left:
    """What is left to push."""

    sum: float      # of the residuals
    size: float     # of their absolute values
    deepest: float  # the most that one is below 0
    active: int     # residuals over the bound

    @classmethod
    def of(cls, state: DataFrame, bound: float) -> "_Left":
        r = F.col("residual")
        got = state.agg(F.sum(r), F.sum(F.abs(r)), F.max(-r), F.count_if(F.abs(r) > bound)).first()
        return cls(got[0] or 0.0, got[1] or 0.0, max(0.0, got[2] or 0.0), got[3])

    def cut(self) -> float:
        """The part of the ranks to take away so that no residual is negative."""
        return self.deepest / (TELEPORT + self.deepest)

    def missing(self, given: float) -> float:
        """The most that ranks without that part are short of the exact ones; ``given``: what all pages get from no rank."""
        e = self.cut()
        return (e * given + (1 - e) * self.sum) / (1 - DAMPING)


def _solved(a: list[list[float]], b: list[float]) -> list[float]:
    """The solution of a small symmetric system, 0 for unknowns that hardly differ from others."""
    n = len(b)
    rows, order = [[*a[i], b[i]] for i in range(n)], []
    for i in range(n):
        if rows[i][i] <= 1e-14 * a[i][i]:
            continue
        order.append(i)
        for k in range(n):
            if k != i:
                f = rows[k][i] / rows[i][i]
                rows[k] = [x - f * y for x, y in zip(rows[k], rows[i])]
    return [rows[i][n] / rows[i][i] if i in order else 0.0 for i in range(n)]


def _weighted(state: DataFrame, was: list[str], bound: float) -> DataFrame:
    """The state with the pushes of the last rounds, which began with the residuals ``was``, weighted anew."""
    changes = [F.col(a) - F.col(b) for a, b in zip(was, [*was[1:], "residual"])]
    weight = F.when(F.col("rank") > 0, 1 / F.col("rank")).otherwise(1.0)  # residuals count in proportion to ranks
    pairs = [(i, j) for i in range(len(was)) for j in range(i, len(was))]
    sums = state.agg(*(F.sum(changes[i] * changes[j] * weight) for i, j in pairs), *(F.sum(c * F.col("residual") * weight) for c in changes)).first()
    a = [[0.0] * len(was) for _ in was]
    for (i, j), x in zip(pairs, sums):
        a[i][j] = a[j][i] = x or 0.0
    more = _solved(a, [x or 0.0 for x in sums[len(pairs):]])  # beyond once
    rank, residual = F.col("rank"), F.col("residual")
    for c, name, change in zip(more, was, changes):
        rank, residual = rank + F.lit(c) * _pushed(name, bound), residual - F.lit(c) * change
    return state.select("page", rank.alias("rank"), residual.alias("residual"))


def residual_pagerank(edges: DataFrame, pages: DataFrame | None = None, *, mode: str = "all_nodes", n: int | None = None, error: float = 1e-6,
                      partitions: int | None = None, hub_threshold: int | None = None, page_ids: bool = True) -> ResidualRun:
    """Ranks that are at most ``error`` short of the exact ones, summed over all pages; parameters as ``pagerank_run``'s.

    Like it, it plans its rounds with AQE off in the caller's session.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if not error > 0:
        raise ValueError("error must be positive")
    spark = edges.sparkSession
    with Checkpoints(spark) as files, Tables(spark) as tables:
        g = _prepare(files, tables, edges, pages, mode, n, partitions, hub_threshold, None, page_ids)
        if not g.n:
            return ResidualRun(spark.createDataFrame([], "page string, rank double"), 0.0, 0)
        run = ResidualRun(None, 0.0, 0)
        with fixed_partitioning(spark, g.parts):
            bases = _bases(files.cut, g, mode)
            written = files.cut(bases.select("page", F.lit(0.0).alias("rank"), F.col("base").alias("residual")).repartition(g.parts, "page"))
            pages, given = written.agg(F.count(F.lit(1)), F.coalesce(F.sum("residual"), F.lit(0.0))).first()
            entry = None
            if g.entry is not None and mode != "cited_only":
                pages += g.n_uncited
                entry = g.entry.select("page", (F.col("w") * F.lit(uncited_rank(mode, g.n))).alias("w"))
                given += DAMPING * (entry.agg(F.sum("w")).first()[0] or 0.0)
            bound = error * (1 - DAMPING) / max(1, pages, given / TELEPORT) / 2
            state, left, was = written, _Left.of(written, bound), []
            if g.entry is not None:  # the first round: every page is pushed, uncited ones for good
                run.active.append(pages)
                state = files.cut(_push(g, state, 0.0, entry))
                files.drop(written)
                written, left = state, _Left.of(state, bound)
            while left.active and left.missing(given) > error:
                # Pages apart or not, the first round of all is not weighted: what nobody links to is pushed once.
                name = f"was_{len(was)}" if run.active else None
                run.active.append(left.active)
                state = files.cut(_push(g, state, bound, was=name))
                files.drop(written)
                written, left = state, _Left.of(state, bound)
                was += [name] if name else []
                if len(was) == WINDOW:
                    free_shuffles(spark)
                    better = _weighted(state, was, bound)
                    then = _Left.of(better, bound)
                    state, was = state.select("page", "rank", "residual"), []
                    if then.size <= WORTH * left.size and then.active <= run.active[-1]:
                        state, left = better, then
            run.missing = left.missing(given)
            ranks = files.cut(state.select("page", (F.col("rank") * F.lit(1 - left.cut())).alias("rank")))
        run.ranks, run.rounds = _named(files, g, ranks, mode), len(run.active)
        return run
