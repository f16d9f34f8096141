"""Page-line parsing rules, node counts and HTML extraction."""


from rankloom.operators import links as L

SAMPLE = ["<title>1</title> <text>[[3]][[5]]</text>", "", "<title>2</title> <text>[[1]][[3]]</text>", "",
          "<title>3</title> <text>[[2]][[4]]</text>", "", "<title>4</title> <text>[[1]][[5]]</text>", "",
          "<title>5</title> <text>[[3]]</text>"]


def lines_df(spark, lines):
    return spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "line_id long, line string")


def parsed(spark, lines, rule, **kw):
    return [(r.title, list(r.links)) for r in L.parse_pages(lines_df(spark, lines), rule, **kw).orderBy("line_id").collect()]


def test_sample_graph_all_rules(spark):
    want = [("1", ["3", "5"]), ("2", ["1", "3"]), ("3", ["2", "4"]), ("4", ["1", "5"]), ("5", ["3"])]
    for rule in L.RULES:
        assert parsed(spark, SAMPLE, rule) == want
    e = L.page_edges(L.parse_pages(lines_df(spark, SAMPLE)))
    assert e.count() == 9


def test_node_counts(spark):
    df = lines_df(spark, SAMPLE)
    assert L.title_count(df).first().n == 5
    assert L.title_target_count(df).first().n == 5
    assert L.line_count(df).first().n == 9


def test_special_lines(spark):
    lines = [
        "no title here [[X]]",                                              # no page
        "<title>A</title> <text>[[B]]</text> [[OUT]] <text>[[C]]</text>",  # two sections, link outside
        "<title>A</title><title>Z</title> <text>[[D]]</text>",             # second title line for A, two titles
        "<title> New York </title> <text>[[New York]]</text>",
    ]
    assert parsed(spark, lines, "first_section") == [("A", ["B"]), ("A", ["D"]), ("New York", ["New York"])]
    assert parsed(spark, lines, "whole_line") == [("A", ["B", "OUT", "C"]), ("A", ["D"]), (" New York ", ["New York"])]
    assert parsed(spark, lines, "all_sections") == [("A", ["B", "C"]), ("A,Z", ["D"]), (" New York ", ["New York"])]
    assert parsed(spark, lines, "first_section", strip_target_spaces=True)[2] == ("New York", ["NewYork"])
    df = lines_df(spark, lines)
    assert L.title_count(df).first().n == 2              # first titles: A, A, " New York "
    assert L.title_target_count(df).first().n == 9       # A Z ' New York ' + X B OUT C D 'New York'


def test_empty_input(spark):
    df = spark.createDataFrame([], "line_id long, line string")
    assert L.parse_pages(df).count() == 0
    assert L.title_count(df).first().n == 0


def test_adjacency_encoding(spark):
    rows = L.adjacency(L.parse_pages(lines_df(spark, SAMPLE))).orderBy("title").collect()
    assert (rows[0].title, rows[0].out_degree, rows[0].links_text) == ("1", 2, "3@!#5")


def test_html_titles_and_links(spark):
    pages = spark.createDataFrame([(1, '<html><head><title>T1</title></head><a href="/x">x</a><a href="y">y</a></html>'),
                                   (2, "<html>no title</html>")], "page_id long, html string")
    assert {r.page_id: r.title for r in L.html_titles(pages).collect()} == {1: "T1", 2: ""}
    assert [(r.pos, r.target) for r in L.html_links(pages).orderBy("pos").collect()] == [(0, "/x"), (1, "y")]


def test_links_are_extracted_once_per_line(spark):
    """No inferred size(links) > 0 filter copies the regex extraction below the explode."""
    edges = L.page_edges(L.parse_pages(lines_df(spark, SAMPLE), "whole_line"))
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and "size(" not in plan
    assert edges.count() == 9


def test_page_lines_are_made_once(spark):
    """The optimizer copies the line's expression into no filter and no second projection."""
    from conftest import SF0001
    from rankloom.plans import catalog
    for name in ("wiki_parse_all", "wiki_parse_first", "node_count_union"):
        plan = catalog.QUERIES[name](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("CASE WHEN") == 1, plan
