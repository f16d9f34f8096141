"""PageRank over a link graph.

``rank = 0.15 + 0.85 * sum(rank(src) * share(src, dst))`` for a number of
synchronous rounds.  Three modes reproduce the reference's three programs;
they differ in N, duplicate links, pages nobody links to and stopping:

===============  ====================  ===============  =====================  ===========
mode             N (default)           duplicate links  page without inlinks   node set
===============  ====================  ===============  =====================  ===========
keep_uncited     distinct titles       weighted         keeps its rank (1/N)   pages+targets
all_nodes        titles + targets      weighted         0.15                   pages+targets
cited_only       given (line count)    removed          drops out              cited nodes
===============  ====================  ===============  =====================  ===========

A page line whose title repeats an earlier line's title contributes in round
1 with its own links; from round 2 one line stands for the title
(``all_nodes``: the first line with links; ``keep_uncited``: the last line).

Stopping: after ``iterations`` rounds, or earlier once the total rank of two rounds in a row
differs by at most ``tol``.  ``cited_only`` stops on an exactly repeated total by default, the
other two run all rounds.  ``iterations=None`` has no round limit.  :class:`PageRankRun` says
whether the run converged.

Execution plan, built for graphs much larger than memory:

* pages get dense integer ids (``dictionary.Dictionary``): the links are encoded once, when
  equal links are counted; rounds join, shuffle and sum longs, and only the final ranks are
  joined with the pages' names again (``page_ids=False`` keeps the names throughout);
* edge shares ``(src, dst, w)``, kept as ``(src, array of (dst, w))`` with up to about ``PACKED`` in a row, are computed once (multiplicity / out-degree; links of a plain edge table are shuffled by
  source once for both, where those of very many links of a source are counted apart) and written to the checkpoint folder hash-partitioned by
  ``src`` and sorted within partitions, one partition per ``EDGES_PER_PARTITION`` edges; every
  round's rank vector is checkpointed with the same partitioning, so the
  ``edges ⋈ ranks`` join moves nothing and a round's only shuffle carries
  partial sums per target (AQE is off inside the loop for that reason: an
  adaptive plan does not report its partitioning to the checkpoint);
* pages that no link cites do not take part in rounds of a plain edge table: their rank is known beforehand
  (0.15, 1/N, what they are given, or none, by mode), so what they give to each target is summed once, and rounds
  work on the links and ranks of cited pages (edges with page lines or ``pages``, but for ``cited_only``, or names for ids: all pages take part);
* sources whose out-degree exceeds one partition's fair share of edges ("hubs") are kept apart:
  their edges are spread by ``(src, salt)``, as many salts as they have fair shares, and in every
  round a hub's rank is copied to its salts and shuffled there.  No task holds a hub, nothing is
  broadcast and the number of hubs has no limit;
* contributions are summed per target with a map-side partial aggregate, so
  a target cited by everyone ships one partial sum per map task;
* round 1 is an ordinary round over a rank vector of 1/N; only when titles
  repeat does it use line-level shares (planned with AQE, which splits a hub
  line);
* each round's rank vector is cut from its lineage with a reliable ``checkpoint()`` into
  ``spark.checkpoint.dir``, so a lost executor costs one round, not the whole history; what a
  round has superseded is deleted, and when a run ends only its rank vector is left.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.weights import TELEPORT, damped
from ..session import Checkpoints, free_shuffles, parallelism
from ..tables import Tables, in_order
from .dictionary import NO_ID, Dictionary

MODES = ("keep_uncited", "all_nodes", "cited_only")
# Default tolerance: the total of cited_only has to repeat exactly, the others run all rounds.
TOL_OF_MODE = {"keep_uncited": None, "all_nodes": None, "cited_only": 0.0}
BY_MODE = "by mode"
# Edge shares per partition when the partition count is derived from the data
# (about 40 MB of (src, dst, w) rows).
EDGES_PER_PARTITION = 1_000_000
# Raw links per shuffle partition at most while the graph is prepared (AQE joins small partitions again).
LINKS_PER_PARTITION = 1_000_000
# Links of a source in one row of the packed shares, about.
PACKED = 4096
# Rounds whose shuffles may be on disk together, beside those of the round that runs.
ROUNDS_HELD = 4
# Groups of sources whose raw links are counted before they are dealt out by source.
SLOTS = 1 << 16


@dataclass
class PageRankRun:
    """Result of :func:`pagerank_run`: ranks plus bookkeeping."""

    ranks: DataFrame     # (page, rank)
    rounds: int          # rounds actually run
    n: int               # N used for the initial rank 1/N
    converged: bool      # stopped by the total-rank test
    hubs: int = 0        # sources spread over salts


@contextmanager
def _conf(spark, settings: dict[str, str]):
    """Set session settings inside the block and restore them after."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def fixed_partitioning(spark, parts: int):
    """Plan with AQE off and ``parts`` shuffle partitions inside the block.

    A checkpoint keeps the hash partitioning (and sort order) of the plan it
    materialises only when that plan is not adaptive; with a fixed partition
    count the checkpointed edge shares and every round's rank vector stay
    co-partitioned by page, so a round shuffles nothing but partial sums.
    Skew needs no AQE here: hubs are split off and targets are summed with a
    map-side partial aggregate.
    """
    return _conf(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(parts)})


def pagerank_run(edges: DataFrame, pages: DataFrame | None = None, *, mode: str = "all_nodes",
                 n: int | None = None, iterations: int | None = 10, tol: float | None | str = BY_MODE,
                 partitions: int | None = None, hub_threshold: int | None = None,
                 initial_ranks: DataFrame | None = None, page_ids: bool = True) -> PageRankRun:
    """Run PageRank and return ranks with the round count.

    While it runs it plans with AQE off, in the caller's session: other threads must not plan queries of
    that session meanwhile.

    Parameters
    ----------
    edges: ``(src, dst)`` links, duplicates meaningful; an optional
        ``line_id`` column names the page line each link comes from.
    pages: optional ``(title[, line_id])`` page rows, for pages without links;
        defaults to the sources of ``edges``.
    mode: one of ``keep_uncited``, ``all_nodes``, ``cited_only``.
    n: N for the initial rank 1/N (default per mode, see module doc).
    iterations: maximum number of rounds (I1/I2); ``None``: no limit, which needs a ``tol``.
    tol: stop once the total rank changes by at most ``tol`` between rounds
        (I3; ``0.0`` = exactly repeated total; ``None`` = never).  Default: ``TOL_OF_MODE``.
        The total is summed as DECIMAL(38,18), so the test does not depend on
        summation order.
    partitions: partitions of the edge and rank tables (default: one per
        ``EDGES_PER_PARTITION`` edges, at least the default parallelism).
    hub_threshold: out-degree above which a source is a hub (default: the
        number of distinct edges divided by ``partitions``).
    initial_ranks: ``(page, rank)`` to go on from, such as ``read_rank_state`` gives (S8): the first
        round is then an ordinary round over it, with one line per repeated title.
    page_ids: whether rounds work on integer ids of the pages.
    """
    tol = _stop(mode, iterations, tol)
    with Checkpoints(edges.sparkSession) as files, Tables(edges.sparkSession) as tables:
        return _run(files, tables, edges, pages, mode, n, iterations, tol, partitions, hub_threshold, initial_ranks, page_ids)


def _stop(mode: str, iterations: int | None, tol: float | None | str) -> float | None:
    """The tolerance of a run, whose parameters are checked."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    tol = TOL_OF_MODE[mode] if tol == BY_MODE else tol
    if iterations is None and tol is None:
        raise ValueError("a run without a round limit needs a tolerance")
    if iterations is not None and iterations < 1:
        raise ValueError("iterations must be >= 1")
    return tol


def _encoded(tables: Tables, e: DataFrame, mode: str, page_rows: DataFrame | None, initial_ranks: DataFrame | None, has_lines: bool, read=None):
    """The dictionary of all pages, and the three tables with ids in place of names, written: ``(k, src, dst, m)``, the links of each
    line with their multiplicity, ``(k, title)`` and ``(page, rank)``; ``read``: see ``_prepare``.

    Links are dealt out by source once, to be counted and for the source's id; those of busy slots are counted by line, source and target.
    """
    spark = e.sparkSession
    n_links, busy = _busy_slots(e)
    with _conf(spark, _many(spark, n_links)):
        names = e.select(F.col("src").alias("page")).union(e.select("dst"))
        if page_rows is not None:
            names = names.union(page_rows.select("title"))
        if initial_ranks is not None:
            names = names.union(initial_ranks.select("page"))
        book = Dictionary.of(tables, names)
        if page_rows is not None:
            page_rows = book.encode(page_rows, "title")
            page_rows = tables(page_rows if has_lines else page_rows.withColumn("k", F.col("title")))
        if initial_ranks is not None:
            initial_ranks = tables(book.encode(initial_ranks.select("page", "rank"), "page"))
        keys = ["k", "src", "dst"] if has_lines else ["src", "dst"]
        m = (F.lit(1).cast("long") if mode == "cited_only" else F.count(F.lit(1))).alias("m")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        lines_m = book.encode((e if busy is None else e.where(~busy)).repartition(parts, "src").groupBy(*keys).agg(m), "src")
        if busy is not None:
            lines_m = lines_m.unionByName(book.encode(tables(e.where(busy).groupBy(*keys).agg(m)), "src"))
        named = tables(lines_m)
        if read:
            read()
        free_shuffles(spark)  # before those by target are written
        lines_m = book.encode(named, "dst")
        lines_m = tables(lines_m if has_lines else lines_m.withColumn("k", F.col("src")))  # one line per source, known by it
        tables.drop(named)
        free_shuffles(spark)
    return book, lines_m, page_rows, initial_ranks


@dataclass
class _Graph:
    """Written tables that all rounds read; pages are ids where ``book`` is given."""

    nodes: DataFrame            # (page), by page
    cold: DataFrame | None      # (src, w ARRAY<(dst, w)>) of ordinary sources, by src
    hot: DataFrame | None       # (src, salt, w ARRAY<(dst, w)>) of hubs, by src and salt
    hubs: DataFrame | None      # (src, salts), by src
    lines_m: DataFrame | None   # (k, src, dst, m) of all lines, where titles may repeat
    start: DataFrame | None     # (page, rank) to go on from, by page
    n: int
    parts: int
    repeated: bool              # whether titles repeat
    n_hubs: int = 0
    book: Dictionary | None = None
    entry: DataFrame | None = None    # (page, w[, rank]), by page: shares that uncited pages give (rank: times their ranks in start)
    uncited: DataFrame | None = None  # (page[, rank]): names of pages that are in no table above
    n_uncited: int = 0

    def entering(self, mode: str, first: bool) -> DataFrame | None:
        """``(page, w)``: what uncited pages give in the first round, or in a later one."""
        if self.entry is None or not first and mode == "cited_only":
            return None
        if not first and mode == "all_nodes":
            given = F.col("w") * F.lit(TELEPORT)
        else:
            given = F.col("w") * F.lit(1.0 / self.n) if self.start is None else F.col("rank")
        return self.entry.select("page", given.alias("w"))

    def uncited_ranks(self, mode: str) -> DataFrame | None:
        """``(page, rank)`` of the uncited pages after a round, by name."""
        if self.uncited is None or mode == "cited_only":
            return None
        own = mode == "keep_uncited" and self.start is not None
        return self.uncited.select("page", (F.col("rank") if own else F.lit(uncited_rank(mode, self.n))).alias("rank"))


def uncited_rank(mode: str, n: int) -> float:
    """What a page that nobody links to has after a round, where no rank was given to it."""
    return TELEPORT if mode == "all_nodes" else 1.0 / n


def _many(spark, rows: int) -> dict[str, str]:
    """Settings for a shuffle of so many raw links."""
    return {"spark.sql.shuffle.partitions": str(max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-rows // LINKS_PER_PARTITION)))}


def _busy_slots(e: DataFrame) -> tuple[int, Column | None]:
    """The number of links, and (if there are any) which links' sources share a slot with over ``LINKS_PER_PARTITION`` links.

    A slot is a hash of the source, so a source of many links is in such a slot; what is counted is a row per slot.
    """
    slot = F.pmod(F.xxhash64("src"), F.lit(SLOTS))
    load = e.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    total, busy = load.agg(F.sum("n"), F.collect_list(F.when(F.col("n") > LINKS_PER_PARTITION, F.col("slot")))).first()
    return int(total or 0), slot.isin(busy) if busy else None


def _counted(tables: Tables, e: DataFrame, mode: str, parts: int, busy: Column | None) -> list[DataFrame]:
    """``(src, dst, m, deg, rows, first)`` of the distinct links: multiplicity, links and distinct links of the source, and a mark
    on one link of each source.

    Links are dealt out by source once, which serves the counts of links and of sources (and the join by source that
    follows); a source of many links is not one task's: links of busy slots are counted by source and target.
    """
    once = F.lit(1).cast("long") if mode == "cited_only" else F.count(F.lit(1))
    sums = {"deg": F.sum("m"), "rows": F.count(F.lit(1)), "least": F.min("dst")}
    first = F.col("dst").eqNullSafe(F.col("least")).alias("first")
    by_source = Window.partitionBy("src")
    m = (e if busy is None else e.where(~busy)).repartition(parts, "src").groupBy("src", "dst").agg(once.alias("m"))
    counted = [m.select("*", *(x.over(by_source).alias(c) for c, x in sums.items())).select("src", "dst", "m", "deg", "rows", first)]
    if busy is not None:
        m = tables(e.where(busy).groupBy("src", "dst").agg(once.alias("m")))
        degree = m.groupBy(F.col("src").alias("src_")).agg(*(x.alias(c) for c, x in sums.items()))
        counted.append(m.join(degree, F.col("src").eqNullSafe(F.col("src_"))).select("src", "dst", "m", "deg", "rows", first))
    return counted


def _salt() -> Column:
    """The salt of a link whose source has ``salts``."""
    return F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int")


def _packed(links: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``(*keys, w ARRAY<(dst, w)>)`` of ``links(*keys, dst, w, rows, salts)``, dealt out and sorted by the keys.

    Rounds read a row for many links.  A source's links are several rows where they are very many.
    """
    chunk = F.pmod(F.xxhash64("dst", F.lit(1)), F.greatest(F.lit(1), F.ceil(F.col("rows") / F.col("salts") / PACKED))).cast("int").alias("chunk")
    dealt = links.select(*keys, chunk, "dst", "w").repartition(parts, *keys)
    return dealt.groupBy(*keys, "chunk").agg(F.collect_list(F.struct("dst", "w")).alias("w")).select(*keys, "w").sortWithinPartitions(*keys)


def unpacked(links: DataFrame) -> DataFrame:
    """Packed shares with a row for each link."""
    if "dst" in links.columns:
        return links
    return links.select(*(c for c in links.columns if c != "w"), F.inline("w"))


def _prepare_cited(files: Checkpoints, tables: Tables, edges, mode, n, partitions, hub_threshold, initial_ranks) -> _Graph:
    """The graph of a plain edge table, with pages that nobody links to apart.

    A null page is a page.  Targets are numbered first; links are then shuffled by source, once, and leave that stage as shares whose
    source has its id, or is known to be uncited; what uncited pages give is summed by target, and only links of cited pages are
    shuffled again, to get the ids of their targets.
    """
    spark, cut = edges.sparkSession, files.cut
    e = edges.select("src", "dst")
    start = None
    if initial_ranks is not None:
        start = tables(initial_ranks.select("page", F.col("rank").cast("double").alias("rank")))
    with _conf(spark, {"spark.sql.adaptive.enabled": "true"}):
        n_links, busy = _busy_slots(e)
    many = _many(spark, n_links)
    with _conf(spark, many | {"spark.sql.adaptive.enabled": "true"}):
        # ---- ids of cited pages
        cited = tables(e.select(F.col("dst").alias("value")).distinct())
        book = Dictionary(*in_order(tables, cited.where("value IS NOT NULL"), ["value"], "id"))
        null_cited = not cited.where("value IS NULL").isEmpty()

        # ---- shares of all links
        known = book.table.select(F.col("value").alias("name_"), F.col("id").alias("id_"))
        own = F.col("id_").isNotNull() | (F.col("src").isNull() & F.lit(null_cited))
        w = F.col("m") / F.col("deg")
        given = []
        if start is not None:  # how often an uncited page is given, and the sum of its ranks
            held = start.groupBy("page").agg(F.count(F.lit(1)).alias("times"), F.sum("rank").alias("held"))
            of_null = held.where("page IS NULL").first()
            held = held.where("page IS NOT NULL").withColumnRenamed("page", "held_")
            if of_null:
                times, ranks = (F.when(F.col("src").isNull(), F.lit(of_null[c])).otherwise(F.col(c)) for c in ("times", "held"))
            else:
                times, ranks = F.col("times"), F.col("held")
            given = [(w * times).alias("given"), (w * ranks).alias("rank")]
        shares = None
        for links in _counted(tables, e, mode, int(many["spark.sql.shuffle.partitions"]), busy):
            links = links.join(known, F.col("src") == F.col("name_"), "left")
            if start is not None:
                links = links.join(held, F.col("src") == F.col("held_"), "left")
            # the name is needed of uncited pages only, once
            links = links.select(own.alias("own"), "first", F.coalesce("id_", F.lit(NO_ID)).alias("src"), F.when(F.col("first") & ~own, F.col("src")).alias("name"),
                                 "dst", "rows", w.alias("w"), *given)
            shares = links if shares is None else shares.unionByName(links)
        shares = tables(shares)
        free_shuffles(spark)
        own = F.col("own")
        stats = shares.agg(F.count(F.lit(1)).alias("edges"), F.count_if(own).alias("inner"), F.count_if("first").alias("sources"),
                           F.count_if(F.col("first") & ~own).alias("uncited")).first()
        n_edges, n_inner = stats["edges"], stats["inner"]
        if n is None:
            n = book.size + null_cited + stats["uncited"] if mode == "all_nodes" else stats["sources"]
        parts = int(partitions or max(parallelism(spark), -(-n_inner // EDGES_PER_PARTITION)))
        of_cited, of_all = (hub_threshold if hub_threshold is not None else x // parts for x in (n_inner, n_edges))
        hub = F.col("rows") > F.when(own, of_cited).otherwise(of_all)
        salts = F.when(own & hub, F.ceil(F.col("rows") / max(1, of_cited)) + 1).otherwise(1).cast("int")
        n_hubs, n_split = shares.where(F.col("first") & hub).agg(F.count(F.lit(1)), F.count_if(own)).first()

        # ---- shares of uncited pages become one row per target, those of cited pages get their targets' ids
        entry = shares.where(~own).groupBy("dst").agg(*([F.sum("w").alias("w")] if start is None else [F.sum("given").alias("w"), F.sum("rank").alias("rank")]))
        entry = book.encode(entry.where("w IS NOT NULL").withColumnRenamed("dst", "page"), "page")
        inner = book.encode(shares.where(own).select("src", "dst", "w", "rows", salts.alias("salts")), "dst")
        inner = tables(inner.withColumn("salt", _salt()))  # AQE may split a target of many links
        free_shuffles(spark)
        nodes = book.table.select(F.col("id").alias("page"))
        if null_cited:
            nodes = nodes.union(spark.range(1).select(F.lit(NO_ID).cast("long")))
        uncited, inner_start, n_uncited = shares.where(F.col("first") & ~own).select(F.col("name").alias("page")), None, stats["uncited"]
        if start is not None:
            named = start.join(known, F.col("page") == F.col("name_"), "left")
            named = named.select("page", "rank", F.when(F.col("page").isNull() & F.lit(null_cited), F.lit(NO_ID)).otherwise(F.col("id_")).alias("id"))
            uncited = tables(named.where("id IS NULL").select("page", "rank").repartition("page").sortWithinPartitions("page", F.desc("rank")))  # a page may be given twice
            inner_start = tables(named.where("id IS NOT NULL").select(F.col("id").alias("page"), "rank"))
            n_uncited = uncited.count()

    with fixed_partitioning(spark, parts):
        by = lambda df, *keys: cut(df.repartition(parts, *keys).sortWithinPartitions(*keys))
        graph = _Graph(by(nodes, "page"), None, None, None, None, None, n, parts, False, n_hubs, book, by(entry, "page"), uncited, n_uncited)
        if inner_start is not None:
            graph.start = by(inner_start, "page")
        if not n:
            return graph
        graph.cold = cut(_packed(inner.where("salts = 1"), parts, "src"))
        if n_split:
            graph.hubs = by(shares.where(F.col("first") & own & hub).select("src", salts.alias("salts")), "src")
            graph.hot = cut(_packed(inner.where("salts > 1"), parts, "src", "salt"))
        tables.drop(inner)
    return graph


def _prepare(files: Checkpoints, tables: Tables, edges, pages, mode, n, partitions, hub_threshold, initial_ranks, page_ids, read=None) -> _Graph:
    """The graph of ``edges`` and ``pages``; ``read()`` is called once these are not read again, where that is before the end."""
    if page_ids and (mode == "cited_only" or pages is None and "line_id" not in edges.columns):
        # Of cited_only's links it does not matter which line they are from, nor of its pages which have no links but for their number.
        if n is None and pages is not None:
            n = pages.select(F.struct("title").alias("title")).agg(F.count_distinct("title")).first()[0]
        return _prepare_cited(files, tables, edges, mode, n, partitions, hub_threshold, initial_ranks)
    spark, cut = edges.sparkSession, files.cut
    # k = the page line a link comes from; a plain edge table has one line per source.
    has_lines = "line_id" in edges.columns
    e = edges.select(F.col("line_id" if has_lines else "src").alias("k"), "src", "dst")

    page_rows = book = None
    if pages is not None:
        page_rows = pages.select(F.col("line_id" if has_lines else "title").alias("k"), "title")

    # ---- link multiplicity per page line (distinct links for cited_only): the
    #      pass over the raw links; everything below reads this copy.
    many = _many(spark, e.count())
    if page_ids:
        book, lines_m, page_rows, initial_ranks = _encoded(tables, e, mode, page_rows, initial_ranks, has_lines, read)
    else:
        if mode == "cited_only":
            lines_m = e.select("src", "dst").distinct().select(F.col("src").alias("k"), "src", "dst", F.lit(1).cast("long").alias("m"))
        else:
            lines_m = e.groupBy("k", "src", "dst").agg(F.count(F.lit(1)).alias("m"))
        with _conf(spark, many):
            lines_m = tables(lines_m)
    if page_rows is None:
        page_rows = lines_m.select("k", F.col("src").alias("title")).distinct()
    n_titles, repeated = None, False
    if has_lines or pages is not None:
        st = page_rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("title").alias("titles")).first()
        n_titles, repeated = int(st["titles"]), st["rows"] != st["titles"]

    # ---- multiplicities of rounds >= 2: one line per title when titles repeat
    m, kept = lines_m, None
    if mode != "cited_only" and repeated:
        if mode == "all_nodes":   # first line that has links
            keep = lines_m.groupBy("src").agg(F.min("k").alias("k"))
        else:                     # last line, with or without links
            keep = page_rows.groupBy("title").agg(F.max("k").alias("k"))
        with _conf(spark, many):
            m = kept = tables(lines_m.join(keep.select("k"), "k", "left_semi").select("src", "dst", "m"))
    m = m.select("src", "dst", "m")
    degree = tables(m.groupBy("src").agg(F.sum("m").alias("deg"), F.count(F.lit(1)).alias("rows")))
    dstats = degree.agg(F.sum("rows").alias("edges"), F.max("rows").alias("top"),
                        F.count(F.lit(1)).alias("sources")).first()
    n_edges, top = int(dstats["edges"] or 0), int(dstats["top"] or 0)
    if n_titles is None:
        n_titles = int(dstats["sources"])
    parts = int(partitions or max(parallelism(spark), -(-n_edges // EDGES_PER_PARTITION)))
    threshold = hub_threshold if hub_threshold is not None else n_edges // parts

    # ---- edge shares w = m / out-degree; a hub's edges get one of its salts
    salts = F.when(F.col("rows") > threshold, F.ceil(F.col("rows") / max(1, threshold)) + 1).otherwise(1)
    degree = degree.withColumn("salts", salts.cast("int"))
    with _conf(spark, many | {"spark.sql.adaptive.enabled": "true"}):  # a hub's rows may be split in this join
        shares = tables(m.join(degree, "src").select("src", "dst", (F.col("m") / F.col("deg")).alias("w"), "rows", "salts", _salt().alias("salt")))
    if kept is not None:
        tables.drop(kept)
    free_shuffles(spark)

    with fixed_partitioning(spark, parts):
        # ---- node set, hash-partitioned by page like every rank vector below
        nodes = page_rows.select(F.col("title").alias("page")).union(lines_m.select(F.col("dst").alias("page"))).distinct()
        nodes = cut(nodes.repartition(parts, "page"))
        if n is None:
            n = nodes.count() if mode == "all_nodes" else n_titles
        start = None
        if initial_ranks is not None:
            start = cut(initial_ranks.select("page", F.col("rank").cast("double").alias("rank")).repartition(parts, "page"))
        graph = _Graph(nodes, None, None, None, lines_m, start, n, parts, repeated, book=book)
        if not n:
            return graph
        graph.cold = cut(_packed(shares.where("salts = 1"), parts, "src"))
        if top > threshold:
            graph.hubs = cut(degree.where("salts > 1").select("src", "salts").repartition(parts, "src").sortWithinPartitions("src"))
            graph.n_hubs = graph.hubs.count()
            graph.hot = cut(_packed(shares.where("salts > 1"), parts, "src", "salt"))
        tables.drop(shares)
    return graph


def _run(files: Checkpoints, tables: Tables, edges, pages, mode, n, iterations, tol, partitions, hub_threshold, initial_ranks, page_ids, read=None) -> PageRankRun:
    spark, cut = edges.sparkSession, files.cut
    g = _prepare(files, tables, edges, pages, mode, n, partitions, hub_threshold, initial_ranks, page_ids, read)
    if not g.n:
        return PageRankRun(spark.createDataFrame([], "page string, rank double"), 0, 0, False)
    with fixed_partitioning(spark, g.parts):
        # ---- round 1: every page holds 1/N, or what it is given
        prev_total, rounds, converged = 0.0, 1, False
        rest = 0.0  # the total rank of the uncited pages
        if tol is not None:
            if g.start is not None:
                prev_total = _total(initial_ranks)
            apart = g.uncited_ranks(mode)
            rest = _total(apart) if apart is not None else 0.0
        ranks = _first_round(cut, g, mode)
        entry = g.entering(mode, first=False)
        free_shuffles(spark)
        while True:
            if tol is not None:
                total = _total(ranks) + rest
                converged, prev_total = abs(total - prev_total) <= tol, total
                if converged:
                    break
            if rounds == iterations:
                break
            # ---- rounds >= 2: one exchange each (the partial sums per target)
            rounds += 1
            before, ranks = ranks, cut(_round(g.cold, g.hot, g.hubs, ranks, mode, entry, g.nodes))
            files.drop(before)
            if rounds % ROUNDS_HELD == 0:
                free_shuffles(spark)
    return PageRankRun(_named(files, g, ranks, mode), rounds, g.n, converged, g.n_hubs)


def _named(files: Checkpoints, g: _Graph, ranks: DataFrame, mode: str) -> DataFrame:
    """A run's last table, with the pages' names; it outlives the run."""
    if g.book is not None:
        named, apart = g.book.decode(ranks, "page"), g.uncited_ranks(mode)
        before, ranks = ranks, files.cut(named if apart is None else named.union(apart))
        files.drop(before)
    return files.keep(ranks)


def _first_round(cut, g: _Graph, mode: str) -> DataFrame:
    entry = g.entering(mode, first=True)
    if g.start is not None:
        return cut(_round(g.cold, g.hot, g.hubs, g.start, mode, entry, g.nodes))
    if g.repeated and mode != "cited_only":
        # line-level shares join on the line key: let AQE split a hub line
        with _conf(g.nodes.sparkSession, {"spark.sql.adaptive.enabled": "true"}):
            return cut(_first_round_by_line(cut, g.lines_m, g.nodes, 1.0 / g.n, mode))
    return cut(_round(g.cold, g.hot, g.hubs, g.nodes.select("page", F.lit(1.0 / g.n).alias("rank")), mode, entry, g.nodes))


def _first_round_by_line(cut, lines_m: DataFrame, nodes: DataFrame, inv_n: float, mode: str) -> DataFrame:
    """Round 1 when titles repeat: each page line spends its own 1/N over its own links."""
    line_deg = cut(lines_m.groupBy("k").agg(F.sum("m").alias("deg")))
    sums = (lines_m.join(line_deg, "k")
            .groupBy("dst").agg((F.sum(F.col("m") / F.col("deg")) * F.lit(inv_n)).alias("s"))
            .withColumnRenamed("dst", "page"))
    uncited = F.lit(TELEPORT) if mode == "all_nodes" else F.lit(inv_n)
    return nodes.join(sums, "page", "left").select("page", F.coalesce(damped(F.col("s")), uncited).alias("rank"))


def _round(cold: DataFrame, hot: DataFrame | None, hubs: DataFrame | None, ranks: DataFrame,
           mode: str, entry: DataFrame | None = None, nodes: DataFrame | None = None) -> DataFrame:
    """One synchronous round over materialised edge shares, packed or ``(src, dst, w)``.

    ``entry(page, w)``: what pages add that are not in ``ranks`` (with ``nodes``, the pages that can have a sum).
    """
    sums = _sums(cold, hot, hubs, ranks.select(F.col("page").alias("src"), "rank"))
    fallback = F.lit(TELEPORT) if mode == "all_nodes" else F.col("rank")
    if entry is not None:
        none = F.lit(0.0)
        s = F.when(F.col("s").isNotNull() | F.col("w").isNotNull(), F.coalesce("s", none) + F.coalesce("w", none))
        pages = nodes if mode == "cited_only" else ranks
        both = pages.join(sums, "page", "left").join(entry, "page", "left")
        if mode == "cited_only":
            return both.select("page", damped(s).alias("rank")).where("rank IS NOT NULL")
        return both.select("page", F.coalesce(damped(s), fallback).alias("rank"))
    if mode == "cited_only":
        return sums.select("page", damped(F.col("s")).alias("rank"))
    return ranks.join(sums, "page", "left").select("page", F.coalesce(damped(F.col("s")), fallback).alias("rank"))


def _sums(cold: DataFrame, hot: DataFrame | None, hubs: DataFrame | None, src_ranks: DataFrame) -> DataFrame:
    """``(page, s)``: sums of the shares that ``src_ranks(src, rank)`` give to their targets."""
    def given(shares: DataFrame, of: DataFrame, *keys: str) -> DataFrame:
        links = unpacked(shares.join(of, [*keys]).drop(*keys))
        return links.select("dst", (F.col("rank") * F.col("w")).alias("c"))

    contrib = given(cold, src_ranks, "src")
    if hot is not None:
        copies = src_ranks.join(hubs, "src").select(
            "src", "rank", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        contrib = contrib.unionByName(given(hot, copies, "src", "salt"))
    return contrib.groupBy("dst").agg(F.sum("c").alias("s")).withColumnRenamed("dst", "page")


def total_rank(ranks: DataFrame) -> DataFrame:
    """One row ``(total)``: total rank, summed exactly (order-independent) as DECIMAL(38,18)."""
    return ranks.agg(F.sum(F.col("rank").cast("decimal(38,18)")).alias("total"))


def _total(ranks: DataFrame) -> float:
    return float(total_rank(ranks).first()["total"] or 0.0)


def pagerank(edges: DataFrame, pages: DataFrame | None = None, *, mode: str = "all_nodes",
             n: int | None = None, iterations: int | None = 10, tol: float | None | str = BY_MODE,
             partitions: int | None = None, hub_threshold: int | None = None,
             initial_ranks: DataFrame | None = None, must_converge: bool = False) -> DataFrame:
    """``(page, rank)`` in descending rank order (ties by page; O2).  See :func:`pagerank_run`, which also
    tells whether the run converged; with ``must_converge`` a run that a round limit stopped raises."""
    run = pagerank_run(edges, pages, mode=mode, n=n, iterations=iterations, tol=tol, partitions=partitions,
                       hub_threshold=hub_threshold, initial_ranks=initial_ranks)
    return _ordered(run, must_converge)


def _ordered(run: PageRankRun, must_converge: bool) -> DataFrame:
    if must_converge and run.n and not run.converged:
        raise RuntimeError(f"the total rank did not settle in {run.rounds} rounds")
    return run.ranks.orderBy(F.desc("rank"), F.asc("page"))


def pagerank_lines_run(lines: DataFrame, *, mode: str = "all_nodes", line: str = "line", iterations: int | None = 10,
                       tol: float | None | str = BY_MODE, n: int | None = None, strip_target_spaces: bool = False,
                       partitions: int | None = None, page_ids: bool = True) -> PageRankRun:
    """PageRank straight from page lines, with the reference's N for each mode.

    The lines are parsed once; links and pages both read the written copy, so numbers that lines
    without a ``line_id`` are given are the same in both.
    """
    from . import links as L

    tol, spark = _stop(mode, iterations, tol), lines.sparkSession
    if n is None:
        count = {"keep_uncited": lambda: L.title_count(lines, line), "all_nodes": lambda: L.title_target_count(lines, line),
                 "cited_only": lambda: L.line_count(lines)}[mode]
        n = count().first()["n"]
    with Checkpoints(spark) as files, Tables(spark) as tables:
        pages = tables(L.parse_pages(lines, L.RULE_OF_MODE[mode], line, strip_target_spaces))
        free_shuffles(spark)
        return _run(files, tables, L.page_edges(pages), pages.select("line_id", "title"), mode, n, iterations, tol, partitions, None, None,
                    page_ids, lambda: tables.drop(pages))


def pagerank_lines(lines: DataFrame, *, must_converge: bool = False, **settings) -> DataFrame:
    """``(page, rank)`` from page lines, in descending rank order; settings as :func:`pagerank_lines_run`."""
    return _ordered(pagerank_lines_run(lines, **settings), must_converge)


def contributions(edges: DataFrame, ranks: DataFrame, tables: Tables | None = None) -> DataFrame:
    """``(src, dst, c)``: each link's share of its source's rank (multiplicity-weighted).

    One join with the links, of two written tables (the caller's ``tables``, else deleted when the application
    ends), so AQE can split a hub's partition.
    """
    tables = tables or Tables(edges.sparkSession)
    m = tables(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m")))
    degree = m.groupBy("src").agg(F.sum("m").alias("deg"))
    unit = degree.join(ranks.select(F.col("page").alias("src"), "rank"), "src")
    unit = tables(unit.select("src", (F.col("rank") / F.col("deg")).alias("unit")))
    return m.join(unit, "src").select("src", "dst", (F.col("unit") * F.col("m")).alias("c"))


def rank_step(edges: DataFrame, ranks: DataFrame, mode: str = "all_nodes", tables: Tables | None = None) -> DataFrame:
    """One synchronous round from a given rank vector ``(page, rank)``."""
    sums = (contributions(edges, ranks, tables).groupBy("dst").agg(F.sum("c").alias("s"))
            .withColumnRenamed("dst", "page"))
    if mode == "cited_only":
        return sums.select("page", damped(F.col("s")).alias("rank"))
    fallback = F.lit(TELEPORT) if mode == "all_nodes" else F.col("rank")
    return ranks.join(sums, "page", "full").select(
        "page", F.coalesce(damped(F.col("s")), fallback).alias("rank"))
