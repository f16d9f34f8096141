"""PageRank modes against the fixture values, special cases, hub path and plan shape."""

import pytest
from pyspark.sql import functions as F

from rankloom.operators import links as L
from rankloom.operators import pagerank as PR
from test_links import SAMPLE, lines_df

SMALL_10 = {"3": 1.3443011530882782, "5": 0.7374813133059706, "1": 0.727160039753259,
            "2": 0.7017799382448006, "4": 0.7017799382448006}
SMALL_CITED_10 = {"3": 1.3153339555746044, "5": 0.7228011819406337, "1": 0.7122919206754441,
                  "2": 0.6872877945919419, "4": 0.6872877945919419}
SMALL_CITED_STOP = {"3": 1.6071354032386762, "5": 0.8687218395884738, "1": 0.8580776644199717,
                    "2": 0.8330325463764374, "4": 0.8330325463764374}

HAND = [("A", ["B", "B", "C"]), ("B", ["C", "F"]), ("C", ["A"]), ("D", ["A"]), ("E", [])]
HAND_EXPECTED = {  # mode -> rounds -> page -> rank (6 places); absent pages missing
    "keep_uncited": {1: dict(A=0.49, B=0.263333, C=0.291667, D=0.2, E=0.2, F=0.235),
                     10: dict(A=0.880048, B=0.643457, C=0.666872, D=0.2, E=0.2, F=0.420144)},
    "all_nodes": {1: dict(A=0.433333, B=0.244444, C=0.268056, D=0.15, E=0.15, F=0.220833),
                  10: dict(A=0.804586, B=0.600968, C=0.627739, D=0.15, E=0.15, F=0.402255)},
    "cited_only": {1: dict(A=0.49, B=0.235, C=0.32, F=0.235),
                   10: dict(A=0.661678, B=0.428106, C=0.608398, F=0.330292)},
}


def as_dict(df):
    return {r.page: r.rank for r in df.collect()}


def hand_lines(spark):
    return lines_df(spark, [f"<title>{t}</title> <text>{''.join('[[' + x + ']]' for x in ls)}</text>" for t, ls in HAND])


@pytest.mark.parametrize("mode,expected", [("keep_uncited", SMALL_10), ("all_nodes", SMALL_10),
                                           ("cited_only", SMALL_CITED_10)])
def test_small_graph_ten_rounds(spark, mode, expected):
    got = PR.pagerank_lines(lines_df(spark, SAMPLE), mode=mode)
    assert got.count() == 5
    for page, rank in as_dict(got).items():
        assert rank == pytest.approx(expected[page], abs=1e-9)
    order = [r.page for r in got.collect()]
    assert order[:2] == ["3", "5"] and set(order[3:]) == {"2", "4"}   # tie kept, ordered by page
    assert order[3:] == ["2", "4"]


def test_small_graph_exact_stop(spark):
    edges = L.page_edges(L.parse_pages(lines_df(spark, SAMPLE), "all_sections"))
    run = PR.pagerank_run(edges, mode="cited_only", n=9, iterations=1000)
    assert run.converged and run.rounds < 1000
    for page, rank in as_dict(run.ranks).items():
        assert rank == pytest.approx(SMALL_CITED_STOP[page], abs=1e-6)


@pytest.mark.parametrize("mode", PR.MODES)
@pytest.mark.parametrize("rounds", [1, 10])
def test_hand_graph(spark, mode, rounds):
    got = as_dict(PR.pagerank_lines(hand_lines(spark), mode=mode, iterations=rounds, n=5 if mode != "all_nodes" else None))
    want = HAND_EXPECTED[mode][rounds]
    assert set(got) == set(want)
    for p, r in want.items():
        assert round(got[p], 6) == pytest.approx(r, abs=1e-6)


@pytest.mark.parametrize("mode", PR.MODES)
def test_hub_path_gives_same_ranks(spark, mode):
    lines = hand_lines(spark)
    edges = L.page_edges(L.parse_pages(lines, L.RULE_OF_MODE[mode]))
    a = as_dict(PR.pagerank(edges, mode=mode, n=5))
    b = as_dict(PR.pagerank(edges, mode=mode, n=5, hub_threshold=0))   # every source is a hub
    c = as_dict(PR.pagerank(edges, mode=mode, n=5, hub_threshold=1))   # A and B are hubs
    assert a.keys() == b.keys() == c.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-12) and a[k] == pytest.approx(c[k], abs=1e-12)


def test_duplicate_title_lines(spark):
    # A appears twice: round 1 uses both lines; later rounds one line per title.
    lines = lines_df(spark, ["<title>A</title> <text>[[B]]</text>", "<title>A</title> <text>[[C]]</text>",
                             "<title>B</title> <text>[[A]]</text>", "<title>C</title> <text>[[A]]</text>"])
    r1 = as_dict(PR.pagerank_lines(lines, mode="all_nodes", iterations=1))
    # N = 3 (A, B, C); B and C each get 1/3 from one A line
    assert r1["B"] == pytest.approx(0.15 + 0.85 / 3) and r1["C"] == pytest.approx(0.15 + 0.85 / 3)
    r2 = as_dict(PR.pagerank_lines(lines, mode="all_nodes", iterations=2))
    assert r2["C"] == pytest.approx(0.15)   # the first line with links ([[B]]) stands for A from round 2
    k2 = as_dict(PR.pagerank_lines(lines, mode="keep_uncited", iterations=2))
    assert k2["B"] == pytest.approx(r1["B"])   # keep_uncited: the last line ([[C]]) stands for A; B keeps its rank


def test_modes_agree_without_special_cases(spark):
    # no duplicates, every node has in- and outlinks -> same ranks given the same N
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")], "src string, dst string")
    r = [as_dict(PR.pagerank(e, mode=m, n=3)) for m in PR.MODES]
    for k in r[0]:
        assert r[0][k] == pytest.approx(r[1][k]) and r[0][k] == pytest.approx(r[2][k])


def test_runs_until_it_converges(spark):
    edges = L.page_edges(L.parse_pages(lines_df(spark, SAMPLE), "all_sections"))
    run = PR.pagerank_run(edges, mode="cited_only", n=9, iterations=None)       # tol 0 by default
    assert run.converged and run.rounds > 100
    for page, rank in as_dict(run.ranks).items():
        assert rank == pytest.approx(SMALL_CITED_STOP[page], abs=1e-6)
    cut = PR.pagerank_run(edges, mode="cited_only", n=9, iterations=20)
    assert (cut.converged, cut.rounds) == (False, 20)
    with pytest.raises(RuntimeError, match="did not settle in 20 rounds"):
        PR.pagerank(edges, mode="cited_only", n=9, iterations=20, must_converge=True)
    with pytest.raises(ValueError):
        PR.pagerank(edges, mode="all_nodes", iterations=None)


def test_oracle_graph_tells_the_modes_apart(spark):
    """Dangling and uncited pages, and three different N, in the graph of the driver's queries."""
    from conftest import SF0001
    from rankloom.plans import inputs
    e = inputs.graph_edges(spark, SF0001)
    sources, targets = e.select("src").distinct(), e.select("dst").distinct()
    assert targets.subtract(sources).count() > 0 and sources.subtract(targets).count() > 0
    n = {sources.count(), sources.union(targets).distinct().count(), e.count()}
    assert len(n) == 3 and e.distinct().count() < e.count()


def test_stop_of_the_converge_query_is_clear_of_its_tolerance(spark, monkeypatch):
    from conftest import SF0001
    from rankloom.plans import catalog
    totals, real = [0.0], PR._total
    monkeypatch.setattr(PR, "_total", lambda r: (totals.append(real(r)), totals[-1])[1])
    run = catalog._converged(spark, SF0001)
    moved = [abs(b - a) for a, b in zip(totals, totals[1:])]
    assert moved[-1] < 0.95 * catalog.CONVERGE_TOL and moved[-2] > 1.05 * catalog.CONVERGE_TOL


def _folders(spark):
    import os
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {f for f in os.listdir(base) if f.startswith("rdd-")}


def test_only_the_returned_ranks_are_left(spark):
    before = _folders(spark)
    e = spark.createDataFrame([(f"p{i}", f"p{i * 7 % 50}") for i in range(300)] + [("hub", f"p{i}") for i in range(50)], "src string, dst string")
    run = PR.pagerank_run(e, mode="all_nodes", iterations=4, hub_threshold=10)
    assert run.hubs == 1 and len(_folders(spark) - before) == 1 and run.ranks.count() == 301
    lines = PR.pagerank_lines_run(hand_lines(spark), mode="keep_uncited", iterations=3)
    assert len(_folders(spark) - before) <= 2 and lines.ranks.count() == 6


def test_lines_without_numbers_are_numbered_once(spark):
    """Links and pages read the same written copy, also where a shuffle below may reorder lines."""
    from pyspark.sql import functions as F
    lines = hand_lines(spark).select("line").repartition(4).orderBy(F.rand())
    got = as_dict(PR.pagerank_lines(lines, mode="all_nodes"))
    assert got == pytest.approx(HAND_EXPECTED["all_nodes"][10], abs=1e-6)


def test_hub_partition_of_contributions_is_split(spark):
    """A third of the edges on one source: the one join with the links splits it."""
    star = spark.range(40000).selectExpr("'hub' as src", "concat('n', id) as dst")
    rest = spark.range(80000).selectExpr("concat('n', id) as src", "concat('n', (id * 7) % 80000) as dst")
    ranks = spark.range(80000).selectExpr("concat('n', id) as page", "1D as rank").union(spark.sql("select 'hub', 1D"))
    with PR._conf(spark, {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
                          "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                          "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        df = PR.contributions(star.union(rest), ranks)
        assert df.count() == 120000
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_empty_graph(spark):
    e = spark.createDataFrame([], "src string, dst string")
    for m in PR.MODES:
        assert PR.pagerank(e, mode=m).count() == 0


def test_rank_step_matches_first_round(spark):
    e = spark.createDataFrame([(s, d) for s, ls in HAND for d in ls], "src string, dst string")
    init = spark.createDataFrame([(t, 1 / 6) for t in "ABCD"], "page string, rank double")
    step = as_dict(PR.rank_step(e, init, "all_nodes"))
    full = as_dict(PR.pagerank(e, mode="all_nodes", iterations=1, n=6))
    for p in step:
        assert step[p] == pytest.approx(full[p])


def test_round_plan_shuffles_only_partial_sums(spark):
    """A round reads the checkpointed edge shares and rank vector as co-partitioned by page:
    the only Exchange is the one carrying partial sums per target, and the edge scan is not re-sorted."""
    with PR.fixed_partitioning(spark, 8):
        cold = (spark.createDataFrame([(f"p{i}", f"p{(i * 7 + 3) % 50}", 1.0) for i in range(50)],
                                      "src string, dst string, w double")
                .repartition(8, "src").sortWithinPartitions("src").checkpoint())
        ranks = spark.createDataFrame([(f"p{i}", 0.02) for i in range(50)], "page string, rank double") \
            .repartition(8, "page").checkpoint()
        for mode in PR.MODES:
            plan = PR._round(cold, None, None, ranks, mode)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1, plan
            assert "hashpartitioning(dst" in plan
            edge_scan_sorted = [l for l in plan.splitlines() if "Sort [src" in l]
            assert len(edge_scan_sorted) <= 1   # the rank side only (page -> src rename)


def test_default_threshold_finds_a_hub(spark):
    """A source linking to a third of the graph is split off by the default threshold and the
    hub path gives the same ranks as the plain path."""
    star = [("hub", f"n{i}") for i in range(0, 3000, 3)]                       # 1000 links from one page
    ring = [(f"n{i}", f"n{(i + 1) % 3000}") for i in range(3000)]              # everyone else: one link
    back = [(f"n{i}", "hub") for i in range(0, 3000, 7)]
    e = spark.createDataFrame(star + ring + back, "src string, dst string")
    run = PR.pagerank_run(e, mode="all_nodes", iterations=5, partitions=8)
    plain = PR.pagerank_run(e, mode="all_nodes", iterations=5, partitions=8, hub_threshold=10 ** 9)
    # 4429 edges / 8 partitions -> threshold 553 < 1000: the hub is spread over salts
    assert run.hubs == 1 and plain.hubs == 0
    a, b = as_dict(run.ranks), as_dict(plain.ranks)
    assert a.keys() == b.keys() and len(a) == 3001
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-12)


def test_session_settings_are_restored(spark):
    """PageRank plans its loop with AQE off; the caller's settings come back afterwards, even on error."""
    before = (spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions"))
    e = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    PR.pagerank(e, mode="all_nodes", iterations=3, partitions=3).collect()
    assert (spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")) == before
    with pytest.raises(RuntimeError):
        with PR.fixed_partitioning(spark, 5):
            assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
            raise RuntimeError("boom")
    assert (spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")) == before


@pytest.mark.parametrize("mode", PR.MODES)
def test_page_ids_give_the_same_ranks(spark, mode):
    lines = [f"<title>P{i % 40}</title> <text>[[P{i * 7 % 45}]][[Q{i % 3}]][[P{i * 7 % 45}]]</text>" for i in range(60)]
    lines = lines_df(spark, lines + ["<title>lonely</title> <text></text>", "no title [[P1]]"])
    plain, ids = (as_dict(PR.pagerank_lines_run(lines, mode=mode, iterations=6, page_ids=x).ranks) for x in (False, True))
    assert ids.keys() == plain.keys() and ids == pytest.approx(plain, abs=1e-12)
    edges = L.page_edges(L.parse_pages(lines, L.RULE_OF_MODE[mode])).select("src", "dst")
    start = spark.createDataFrame([("P1", 0.5), ("unknown", 0.25), ("Q1", 0.1)], "page string, rank double")
    plain, ids = (as_dict(PR.pagerank_run(edges, mode=mode, n=50, iterations=3, initial_ranks=start, page_ids=x).ranks) for x in (False, True))
    assert ids.keys() == plain.keys() and ids == pytest.approx(plain, abs=1e-12)


@pytest.mark.parametrize("mode", PR.MODES)
def test_rounds_exchange_no_names(spark, monkeypatch, mode):
    """With page ids every exchange of a round is keyed by longs, and no string column is read in it."""
    plans, real = [], PR._round

    def seen(*args):
        df = real(*args)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(PR, "_round", seen)
    e = spark.createDataFrame([(f"p{i}", f"p{i * 7 % 50}") for i in range(300)] + [("hub", f"p{i}") for i in range(50)], "src string, dst string")
    run = PR.pagerank_run(e, mode=mode, n=400, iterations=3, hub_threshold=10)
    assert len(plans) == 3 and run.hubs == 1 and run.ranks.schema["page"].dataType.simpleString() == "string"
    import re
    for p in plans:
        keys = re.findall(r"hashpartitioning\(([^)]*)\)", p)
        assert keys and all(re.match(r"(src|dst|page)#\d+L\b", k) for k in keys), p
        scanned = " ".join(re.findall(r"Scan ExistingRDD\[([^\]]*)\]", p))
        assert scanned and all(re.fullmatch(r"(src|dst|page)#\d+L|(w|rank)#\d+|(salt|salts)#\d+", c) for c in re.split("[, ]+", scanned)), scanned


def test_null_pages_keep_their_place(spark):
    e = spark.createDataFrame([("a", None), ("a", "b"), (None, "a"), ("b", "a")], "src string, dst string")
    with_ids, without = (as_dict(PR.pagerank_run(e, mode="cited_only", n=4, iterations=3, page_ids=x).ranks) for x in (True, False))
    assert set(without) <= set(with_ids) and with_ids["a"] >= without["a"]


def fixed_point(edges, mode, n):
    """The ranks of rounds without end, one page at a time."""
    links = sorted(set(edges)) if mode == "cited_only" else edges
    degree = {}
    for src, _ in links:
        degree[src] = degree.get(src, 0) + 1
    cited = {d for _, d in links}
    pages = cited if mode == "cited_only" else cited | set(degree)
    base = {p: 0.15 if p in cited or mode == "all_nodes" else 1 / n for p in pages}
    ranks = dict(base)
    for _ in range(400):
        new = dict(base)
        for src, dst in links:
            new[dst] += 0.85 * ranks.get(src, 0.0) / degree[src]
        ranks = new
    return ranks


@pytest.mark.parametrize("mode", PR.MODES)
def test_residual_ranks_are_within_their_error(spark, mode):
    from rankloom.operators.residual import residual_pagerank
    edges = [(f"p{i}", f"p{i * 7 % 50}") for i in range(120)] + [("hub", f"p{i}") for i in range(40)] + [("p3", "hub"), ("p3", "hub")]
    exact = fixed_point(edges, mode, 60)
    for error in (1.0, 1e-3):
        run = residual_pagerank(spark.createDataFrame(edges, "src string, dst string"), mode=mode, n=60, error=error, hub_threshold=10)
        got = as_dict(run.ranks)
        assert got.keys() == exact.keys() and run.missing <= error and run.rounds == len(run.active)
        short = [exact[p] - got[p] for p in exact]
        assert min(short) > -1e-9 and sum(short) <= run.missing + 1e-9


def test_active_pages_become_fewer(spark):
    """A fast-settling part and a slow cycle: the rounds end with the cycle alone."""
    from rankloom.operators.residual import residual_pagerank
    tree = [(f"t{i}", f"t{i // 2}") for i in range(1, 200) if i // 2 != i]
    cycle = [(f"c{i}", f"c{(i + 1) % 5}") for i in range(5)]
    run = residual_pagerank(spark.createDataFrame(tree + cycle, "src string, dst string"), error=1e-4)
    assert run.active[0] == 205 and run.active[-1] <= 5 and run.active == sorted(run.active, reverse=True)
    with pytest.raises(ValueError):
        residual_pagerank(spark.createDataFrame(cycle, "src string, dst string"), error=0)
    assert residual_pagerank(spark.createDataFrame([], "src string, dst string")).ranks.count() == 0


def test_residual_rounds_are_fewer_than_the_damping_allows(spark):
    """Pushes alone leave 0.85 of the residuals each round; pages and links in two parts, one of them cited in turns."""
    from rankloom.operators.residual import residual_pagerank
    edges = [(f"p{i}", f"s{i * k * k % 11}") for i in range(30) for k in (1, 3, 4)] + [(f"s{i}", f"p{i * k % 30}") for i in range(11) for k in (2, 3, 5, 7)]
    edges += [(f"r{i}", f"r{i * k % 13}") for i in range(13) for k in (2, 5, 6)] + [("p3", "end"), ("new", "p4")]
    exact, error = fixed_point(edges, "all_nodes", 60), 1e-7
    run = residual_pagerank(spark.createDataFrame(edges, "src string, dst string"), error=error)
    short = [exact[p] - r for p, r in as_dict(run.ranks).items()]
    assert len(short) == len(exact) and min(short) > -1e-12 and sum(short) <= run.missing + 1e-12 and run.missing <= error
    assert run.rounds == len(run.active) < 60  # 0.85 ** 60 * 55 pages is far from 1e-7


@pytest.mark.parametrize("mode", PR.MODES)
def test_rounds_hold_cited_pages_only(spark, monkeypatch, mode):
    """Pages nobody links to are in no round's links or ranks, and the ranks are those of rounds over all pages."""
    e = spark.createDataFrame([(f"o{i}", f"p{i % 7}") for i in range(40)] + [(f"p{i}", f"p{i * 3 % 7}") for i in range(7)] * 2 + [(None, "p1")], "src string, dst string")
    seen, real = [], PR._round

    def held(*args):
        seen.append((args[0].count(), args[3].count()))
        return real(*args)

    with monkeypatch.context() as m:
        m.setattr(PR, "_round", held)
        got = as_dict(PR.pagerank_run(e, mode=mode, n=50, iterations=2, partitions=2, hub_threshold=100).ranks)
    assert seen == [(7, 7)] * 2
    # Told all titles, a run keeps all pages in its rounds.
    every = PR.pagerank_run(e, e.select(F.col("src").alias("title")).distinct(), mode=mode, n=50, iterations=2, partitions=2)
    assert got == pytest.approx(as_dict(every.ranks), abs=1e-12)


def test_shuffles_of_raw_links_follow_their_number(spark):
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert PR._many(spark, 10) == {"spark.sql.shuffle.partitions": str(at_least)}
    assert PR._many(spark, 100 * PR.LINKS_PER_PARTITION + 1) == {"spark.sql.shuffle.partitions": "101"}


@pytest.mark.parametrize("mode", PR.MODES)
def test_raw_links_are_shuffled_by_source_once(spark, monkeypatch, mode):
    """No exchange of the preparation is keyed by source and target, and one is by the source's name."""
    import re
    plans, real = [], PR.Tables.__call__

    def seen(self, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(self, df)

    monkeypatch.setattr(PR.Tables, "__call__", seen)
    e = spark.createDataFrame([(f"p{i}", f"p{i * 7 % 50}") for i in range(300)], "src string, dst string")
    PR.pagerank_run(e, mode=mode, n=400, iterations=1)
    keys = [re.sub(r"#\d+L?", "", k) for p in plans for k in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", p)]
    assert [k for k in keys if "src" in k] == ["src"], keys


@pytest.mark.parametrize("mode", PR.MODES)
def test_links_of_busy_sources_are_counted_apart(spark, monkeypatch, mode):
    """Sources with more links than a partition may have, uncited, cited and null ones, give what they give otherwise."""
    e = [(f"o{i}", f"p{i % 7}") for i in range(40)] + [(f"p{i}", f"p{i * 3 % 7}") for i in range(7)] * 2
    e += [("hub", f"p{i % 30}") for i in range(90)] + [("p1", f"q{i}") for i in range(50)] + [(None, f"q{i}") for i in range(40)] + [("p2", None)]
    e = spark.createDataFrame(e, "src string, dst string")
    start = spark.createDataFrame([("hub", 0.5), ("hub", 0.25), ("p1", 2.0), (None, 0.125), ("o3", 1.0)], "page string, rank double")
    for ranks in (None, start):
        run = lambda: as_dict(PR.pagerank_run(e, mode=mode, n=50, iterations=3, initial_ranks=ranks, hub_threshold=20).ranks)
        plain = run()
        with monkeypatch.context() as m:
            m.setattr(PR, "LINKS_PER_PARTITION", 30)
            links, busy = PR._busy_slots(e)
            assert links == e.count() and {r.src for r in e.where(busy).collect()} == {"hub", "p1", None}
            assert run() == pytest.approx(plain, abs=1e-12)


@pytest.mark.parametrize("mode", PR.MODES)
def test_rounds_read_a_row_for_many_links(spark, monkeypatch, mode):
    """Shares are packed by source, in several rows where a source has very many links, and the ranks are the same."""
    e = spark.createDataFrame([(f"p{i}", f"p{i * k % 40}") for i in range(40) for k in (1, 3, 3, 7)] + [("hub", f"p{i}") for i in range(40)] + [("p5", "hub")], "src string, dst string")
    rows, real = [], PR._round

    def held(*args):
        rows.append(args[0].count() + (args[1].count() if args[1] is not None else 0))
        return real(*args)

    monkeypatch.setattr(PR, "_round", held)
    run = lambda: as_dict(PR.pagerank_run(e, mode=mode, n=50, iterations=2, partitions=2, hub_threshold=30).ranks)
    plain = run()
    links = e.distinct().count()
    assert all(41 <= n < links for n in rows), rows
    monkeypatch.setattr(PR, "PACKED", 1)
    assert run() == pytest.approx(plain, abs=1e-12)
    assert max(rows) > 60


def test_cited_only_rounds_over_page_lines_hold_cited_pages_only(spark, monkeypatch):
    """Links of pages nobody links to are summed once, as with plain edges, and the ranks are those of rounds over all pages."""
    lines = [f"<title>P{i}</title> <text>[[P{i * 3 % 7}]][[P{i * 3 % 7}]][[P{i % 2}]]</text>" for i in range(60)] + ["<title>lonely</title>"]
    lines = lines_df(spark, lines)
    seen, real = [], PR._round

    def held(*args):
        seen.append((PR.unpacked(args[0]).count(), args[3].count()))
        return real(*args)

    with monkeypatch.context() as m:
        m.setattr(PR, "_round", held)
        got = as_dict(PR.pagerank_lines(lines, mode="cited_only", iterations=3, partitions=2))
    cited = {f"P{i}" for i in range(7)}
    links = {(f"P{i}", f"P{k}") for i in range(7) for k in (i * 3 % 7, i % 2)}
    assert got.keys() == cited and seen == [(len(links), 7)] * 3
    edges = L.page_edges(L.parse_pages(lines, "all_sections")).select("src", "dst")
    every = as_dict(PR.pagerank_run(edges, mode="cited_only", n=61, iterations=3, page_ids=False).ranks)
    assert got == pytest.approx(every, abs=1e-12)


@pytest.mark.parametrize("mode", ["keep_uncited", "all_nodes"])
def test_tables_of_page_lines_go_once_they_are_read(spark, monkeypatch, mode):
    """When rounds begin, neither parsed pages nor links by name are on disk; a line's links are shuffled by source once."""
    import os
    import re
    lines = lines_df(spark, [f"<title>P{i % 40}</title> <text>[[P{i * 7 % 45}]][[Q{i % 3}]]</text>" for i in range(60)])
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    old, plans, left, call, first = set(os.listdir(base)), [], [], PR.Tables.__call__, PR._first_round

    def seen(self, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return call(self, df)

    def begun(cut, g, mode):
        for d in set(os.listdir(base)) - old:
            left.extend(spark.read.parquet(f"{base}/{d}/{t}").columns for t in os.listdir(f"{base}/{d}") if t.startswith("table-"))
        return first(cut, g, mode)

    monkeypatch.setattr(PR.Tables, "__call__", seen)
    monkeypatch.setattr(PR, "_first_round", begun)
    PR.pagerank_lines(lines, mode=mode, iterations=1)
    assert left and not [c for c in left if "links" in c or "w" in c]
    keys = [re.sub(r"#\d+L?", "", k) for p in plans for k in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", p)]
    assert keys.count("src") >= 1 and not [k for k in keys if "k, src" in k], keys
