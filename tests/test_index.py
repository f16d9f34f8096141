"""Dictionary, search index and top-k: against the plain operators, across sessions' catalogs, and plan shapes."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from rankloom.operators import text as T
from rankloom.operators.dictionary import NO_ID, Dictionary
from rankloom.operators.index import BLOCK_BITS, RANK_BITS, SPAN_BITS, SearchIndex, top_rows
from rankloom.tables import Tables, in_order


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def docs(spark):
    return T.documents(spark.read.parquet(f"{SF0001}/documents.parquet"))


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    """Small groups and spans, so that words have several of each."""
    return SearchIndex.build(docs, str(tmp_path_factory.mktemp("index") / "i"), group_docs=16, span_groups=4, buckets=16)


def test_numbers_in_order_are_dense(spark):
    with Tables(spark) as tables:
        df = spark.range(5000).selectExpr("id * 7919 % 5000 AS v", "'x' AS part_1").repartition(7)
        numbered, n = in_order(tables, df, [F.desc("v")], "no", first=3)
        assert n == 5000 and {(r.no, r.v) for r in numbered.collect()} == {(i + 3, 4999 - i) for i in range(5000)}
        empty, n = in_order(tables, df.limit(0), ["v"], "no")
        assert n == 0 and empty.count() == 0


def test_dictionary_round_trip(spark):
    df = spark.createDataFrame([("b", "a", 1), ("a", None, 2), ("é", "b", 3), ("b", "a", 1), ("", "Z", 4)], "src string, dst string, id long")
    with Tables(spark) as tables:
        book = Dictionary.of(tables, df.select("src").union(df.select("dst")))
        assert rows(book.table) == [(0, ""), (1, "Z"), (2, "a"), (3, "b"), (4, "é")] and book.size == 5
        coded = book.encode(df, "src", "dst")
        assert coded.columns == df.columns and rows(coded) == [(0, 1, 4), (2, NO_ID, 2), (3, 2, 1), (3, 2, 1), (4, 3, 3)]
        assert sorted(map(repr, book.decode(coded, "src", "dst").collect())) == sorted(map(repr, df.collect()))


def test_written_tables_are_deleted(spark, tmp_path):
    import os
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(base))
    with Tables(spark) as tables:
        a, b, c = (tables(spark.range(3)) for _ in range(3))
        tables.drop(a)
        kept = tables.keep(b)
        assert c.count() == 3
    new = set(os.listdir(base)) - before
    assert len(new) == 1 and len(os.listdir(f"{base}/{new.pop()}")) == 1 and kept.count() == 3
    before = set(os.listdir(base))
    with Tables(spark) as tables:
        assert tables(spark.range(2)).count() == 2
    assert set(os.listdir(base)) == before


def test_search_equals_the_search_over_texts(spark, docs, index):
    for words in (["the", "la", "und"], ["the,la", "the"], ["nothere"], [], [w.word for w in T.keyword_table(docs).limit(1200).collect()]):
        assert rows(index.search(words)) == rows(T.search(docs, words))
    assert rows(index.search()) == []
    kw = T.keyword_table(spark.read.parquet(f"{SF0001}/benchmark.parquet"))
    assert rows(index.search(keywords=kw)) == rows(T.search(docs, keywords=kw))
    assert rows(index.search(["the", "la"], keywords=kw)) == rows(T.search(docs, ["the", "la"], kw))


def check_tables(docs, index, group_docs, span_groups):
    counts = T.doc_word_count(docs)
    lexicon = index.table("lexicon")
    assert rows(lexicon.select("word", "df")) == rows(T.doc_frequency(counts))
    assert [r.word for r in lexicon.orderBy("word_id").collect()] == sorted(r.word for r in lexicon.collect())
    length = docs.groupBy("doc").agg(F.sum(F.octet_length("text")).alias("n"))
    groups = {}
    for r in index.table("documents").join(length, "doc").orderBy("doc_no").collect():
        groups.setdefault(r.doc_no >> RANK_BITS, []).append((r.doc_no & 0xFFFF, -r.n, r.doc))
    assert len(groups) > 1 and all([x[0] for x in g] == list(range(len(g))) and [x[1:] for x in g] == sorted(x[1:] for x in g) for g in groups.values())
    postings = index.table("postings")
    named = postings.withColumn("word_id", F.shiftright("slot", SPAN_BITS)).join(lexicon, "word_id").join(index.table("documents"), "doc_no")
    assert rows(named.select("word", "doc", "tf")) == rows(T.term_frequency(docs).select("word", "doc", "tf"))
    assert postings.where(f"(slot & ((1 << {SPAN_BITS}) - 1)) != (doc_no >> {RANK_BITS}) div {span_groups}").count() == 0
    bounds = postings.withColumn("block", F.shiftright("doc_no", BLOCK_BITS)).groupBy("slot", "block").agg(F.max("tf"), F.count("*"))
    assert rows(index.table("blocks")) == rows(bounds)


def test_index_tables(docs, index):
    check_tables(docs, index, 16, 4)
    assert index.meta.spans > 1


def test_groups_with_much_text_are_dealt_out(spark, docs, tmp_path):
    """Every group over the bound, and one document over many rows: the same tables."""
    lines = T.lines(docs).withColumnRenamed("line", "text")
    index = SearchIndex.build(lines, str(tmp_path / "i"), group_docs=64, span_groups=4, group_bytes=20_000)
    check_tables(lines, index, 64, 4)


def test_building_shuffles_texts_once_and_no_counts(spark, docs, monkeypatch):
    from rankloom.operators import index as module
    numbers = docs.select((F.col("doc") % 7).alias("group"), "doc", F.col("doc").alias("doc_no"))
    large = spark.createDataFrame([], "group long, parts int")
    with module._conf(spark, module._BY_GROUP | {"spark.sql.adaptive.enabled": "false"}):
        shown = plan(module._counts(docs.withColumn("group", F.col("doc") % 7), numbers, F.broadcast(large)))
    assert shown.count("Exchange hashpartitioning") == 2 and shown.count("hashpartitioning(group") == 2, shown


def test_a_search_reads_its_buckets_and_shuffles_no_postings(spark, index):
    one = plan(index.search(["the"]))
    assert "SelectedBucketsCount" in one and "SelectedBucketsCount: 16 out of 16" not in one
    kw = spark.createDataFrame([("the",), ("la",)], "word string")
    before = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan(index.search(keywords=kw))
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", before)
    # The one exchange that carries postings' columns is that of sums per document.
    assert "SortMergeJoin [slot" in shown
    lines = shown.splitlines()
    scan = next(i for i, x in enumerate(lines) if "doc_no#" in x and "FileScan" in x and "tf#" in x)
    while "SortMergeJoin [slot" not in lines[scan]:
        assert "Exchange" not in lines[scan]
        scan -= 1


def test_another_catalog_opens_the_files(spark, docs, index):
    for t in spark.catalog.listTables():
        if t.name.startswith("rankloom_"):
            spark.sql(f"DROP TABLE {t.name}")
    again = SearchIndex(spark, index.folder)
    assert rows(again.search(["the", "la"])) == rows(T.search(docs, ["the", "la"]))
    assert "SelectedBucketsCount" in plan(again.search(["the"]))
    with pytest.raises(FileExistsError):
        SearchIndex.build(docs, index.folder)


def ranked(docs, words, k):
    return [tuple(r) for r in T.rank_documents(docs, words, k=k).collect()]


@pytest.mark.parametrize("words", [["de", "of", "und", "is"], ["erthat", "the", "la"], ["nothere"]])
@pytest.mark.parametrize("k", [1, 1000])
def test_top_k_equals_the_full_ranking(docs, index, words, k):
    assert [tuple(r) for r in index.rank(words, k).collect()] == ranked(docs, words, k)


def test_top_k_skips_blocks(spark, tmp_path):
    """Few documents hold the word often: all other blocks stay below the threshold."""
    many = spark.range(4000).selectExpr("id AS doc", "concat(repeat('hot ', IF(id % 1000 = 3, 60, 1)), repeat('filler ', int(id % 5))) AS text")
    index = SearchIndex.build(many, str(tmp_path / "i"), group_docs=64, span_groups=8, buckets=8)
    found = index.top_k(spark.createDataFrame([(1, "hot"), (1, "filler"), (2, "hot"), (3, "none"), (None, "hot")], "query_id int, word string"), 2, seed_blocks=2)
    assert found.blocks > 110 and found.blocks_read <= 12
    for query, words in ((1, ["hot", "filler"]), (2, ["hot"])):
        assert [(r.doc, r.score) for r in found.rows.where(f"query_id = {query}").orderBy(F.desc("score"), "doc").collect()] == ranked(many, words, 2)
    assert {r.query_id for r in found.rows.collect()} == {1, 2}


def test_top_k_of_many_ties(spark, tmp_path):
    same = spark.range(3000).selectExpr("concat('d', 2999 - id) AS doc", "'a b' AS text")
    index = SearchIndex.build(same, str(tmp_path / "i"), group_docs=300)
    assert [tuple(r) for r in index.rank(["a"], 7).collect()] == ranked(same, ["a"], 7)


@pytest.mark.parametrize("broadcast_rows, in_list", [(100_000, 1000), (0, 1000), (0, 0), (100_000, 0)])
def test_batch_of_queries(spark, docs, index, monkeypatch, broadcast_rows, in_list):
    """Every way to join the chosen blocks gives the full rankings of all benchmark items."""
    from rankloom.operators import index as module
    monkeypatch.setattr(module, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(module, "MAX_IN_LIST", in_list)
    items = spark.read.parquet(f"{SF0001}/benchmark.parquet").where("item_id < 6")
    queries = T.tokens(T.documents(items, "item_id")).withColumnRenamed("doc", "query_id")
    found = index.top_k(queries, 5)
    got = {}
    for r in found.rows.orderBy("query_id", F.desc("score"), "doc").collect():
        got.setdefault(r.query_id, []).append((r.doc, r.score))
    want = {i.item_id: ranked(docs, [w.word for w in queries.where(f"query_id = {i.item_id}").collect() if "," not in w.word], 5) for i in items.collect()}
    comma = queries.where("word LIKE '%,%'").count()
    assert got == want or comma  # a comma splits a word list's words, not a table's
    if comma:
        tables = {i.item_id: T.search(docs, keywords=queries.where(f"query_id = {i.item_id}").select("word")) for i in items.collect()}
        assert got == {q: [tuple(r) for r in s.orderBy(F.desc("score"), "doc").limit(5).collect()] for q, s in tables.items()}


def test_top_rows_in_rounds(spark):
    """One key with many rows, dealt out over several rounds."""
    df = spark.range(30000).selectExpr("IF(id % 3 = 0, 1, id % 50) AS key", "float(id * 31 % 997) AS score", "id AS doc")
    with Tables(spark) as tables:
        got = top_rows(tables, tables(df), "key", "score", "doc", 4, chunk=10)
        data = {}
        for r in df.collect():
            data.setdefault(r.key, []).append((-r.score, r.doc))
        assert {k: [(-s, d) for s, d in sorted(v)[:4]] for k, v in data.items()} == {
            k: [(r.score, r.doc) for r in got.where(f"key = {k}").orderBy(F.desc("score"), "doc").collect()] for k in data}


def test_empty_and_awkward_documents(spark, tmp_path):
    empty = SearchIndex.build(spark.createDataFrame([], "doc string, text string"), str(tmp_path / "e"))
    assert rows(empty.search(["a"])) == [] and empty.rank(["a"], 3).count() == 0
    some = spark.createDataFrame([("a", None), ("b", "x x y"), ("b", "x"), (None, "x"), ("c", ""), ("d", "y " * 30000)], "doc string, text string")
    index = SearchIndex.build(some, str(tmp_path / "s"))
    assert index.meta.n_docs == 4 and rows(index.search(["x", "y"])) == rows(T.search(some.where("doc IS NOT NULL"), ["x", "y"]))


def test_tasks_follow_the_text(spark, tmp_path, monkeypatch):
    """Texts are counted in as many tasks as their bytes ask for, and the shares of one group are dealt out over them."""
    from rankloom.operators import index as X
    dealt, real = [], X._counts

    def counted(docs, numbers, large, tasks):
        rows = real(docs, numbers, large, tasks)
        dealt.append((tasks, len({r.p for r in rows.select(F.spark_partition_id().alias("p")).distinct().collect()})))
        return rows

    monkeypatch.setattr(X, "_counts", counted)
    monkeypatch.setattr(X, "TASK_BYTES", 100)
    docs = spark.range(64).selectExpr("id AS doc", "concat('the w', id % 5, ' and ', 'the x', id) AS text")
    index = X.SearchIndex.build(docs, str(tmp_path / "i"))
    assert dealt[0][0] >= 12 and dealt[0][1] > 1, dealt   # all documents are in one group
    assert {(r.doc, r.score) for r in index.search(["the", "w1"]).collect()} == {(r.doc, r.score) for r in T.search(docs, ["the", "w1"]).collect()}


def test_many_queries_keep_ties_of_each_block(spark, tmp_path, monkeypatch):
    """Dealt out by block, a block sends on its first k documents and what ties with them, and the result is a full ranking's."""
    from rankloom.operators import index as X
    monkeypatch.setattr(X, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(X, "BLOCK_BITS", 4)
    docs = spark.range(90).selectExpr("id AS doc", "concat(repeat('the ', int(id % 3) + 1), 'w', id % 5) AS text")
    index = X.SearchIndex.build(docs, str(tmp_path / "i"))
    sent, real = [], X.SearchIndex._scores
    monkeypatch.setattr(X.SearchIndex, "_scores", lambda *a: (sent.append(real(*a)), sent[-1])[1])
    counts = []
    monkeypatch.setattr(X.SearchIndex, "_threshold", (lambda real: lambda self, tables, scores, k: (counts.append(scores.count()), real(self, tables, scores, k))[1])(X.SearchIndex._threshold))
    queries = spark.createDataFrame([(0, "the"), (0, "w1"), (1, "w2"), (2, "the")], "query_id int, word string")
    got = {(r.query_id, r.pos, r.doc, r.score) for r in index.top_k(queries, 3, seed_blocks=1).rows.collect()}
    want = set()
    for q, words in ((0, ["the", "w1"]), (1, ["w2"]), (2, ["the"])):
        want |= {(q, i + 1, r.doc, r.score) for i, r in enumerate(T.rank_documents(docs, words, k=3).collect())}
    assert got == want and counts[-1] < 90 + 18 + 90


def test_single_rows_are_counted_without_an_aggregate(spark, docs, tmp_path):
    """No hash map of a task's words; documents of one row and of several stand side by side in an index."""
    from rankloom.operators import index as module
    numbers = docs.select((F.col("doc") % 7).alias("group"), "doc", F.col("doc").alias("doc_no"))
    large = F.broadcast(spark.createDataFrame([], "group long, parts int"))
    with module._conf(spark, module._BY_GROUP | {"spark.sql.adaptive.enabled": "false"}):
        shown = plan(module._counts(docs.withColumn("group", F.col("doc") % 7), numbers.withColumn("single", F.lit(True)), large))
    assert "Aggregate" not in shown and shown.count("Exchange hashpartitioning") == 2, shown
    mixed = docs.where("doc % 2 = 0").unionByName(T.lines(docs.where("doc % 2 = 1")).withColumnRenamed("line", "text"))
    check_tables(mixed, SearchIndex.build(mixed, str(tmp_path / "i"), group_docs=64, span_groups=4), 64, 4)


def test_postings_meet_documents_in_as_many_tasks_as_postings_need(spark, tmp_path, monkeypatch):
    """A small table of documents does not gather all postings in few tasks."""
    import re
    from rankloom.operators import index as module
    monkeypatch.setattr(module, "ROWS_PER_BUCKET", 20)
    few = spark.createDataFrame([(i, f"a b{i % 7} c{i}") for i in range(40)], "doc long, text string")
    index = SearchIndex.build(few, str(tmp_path / "i"))
    joined = index.table("postings").join(index.table("documents"), "doc_no")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert index.meta.documents_buckets == 6 and re.findall(r"hashpartitioning\(doc_no#\d+L, (\d+)\)", plan) in ([], ["6"]), plan
    assert joined.count() == 120 and index.table("documents").count() == 40
