"""Text chain: reference goldens, tokenizer cases, IDF integer division, edge cases, properties."""

import pytest
from pyspark.sql import functions as F

from rankloom.functions.tokenize import REFERENCE_TOKEN_PATTERN, TOKEN_SPLIT_PATTERN, query_words
from rankloom.operators import text as T

GOLDEN = [  # word, doc, n, tf, tfidf  (reference outputs)
    ("Hadoop", "file1.txt", 2, "1.30103", 0.3916490552587094),
    ("Hadoop", "file2.txt", 1, "1.0", 0.3010299956639812),
    ("an", "file2.txt", 1, "1.0", 0.47712125471966244),
    ("elephant", "file2.txt", 1, "1.0", 0.47712125471966244),
    ("is", "file1.txt", 1, "1.0", 0.3010299956639812),
    ("is", "file2.txt", 1, "1.0", 0.3010299956639812),
    ("yellow", "file1.txt", 1, "1.0", 0.3010299956639812),
    ("yellow", "file2.txt", 1, "1.0", 0.3010299956639812),
]


def test_doc_word_count_golden(sample_docs):
    rows = T.doc_word_count(sample_docs).orderBy("word", "doc").collect()
    assert [(r.word, r.doc, r.n) for r in rows] == [(w, d, n) for w, d, n, _, _ in GOLDEN]


def test_term_frequency_golden(sample_docs):
    rows = (T.term_frequency(sample_docs).select("word", "doc", F.col("tf").cast("string").alias("tf"))
            .orderBy("word", "doc").collect())
    assert [(r.word, r.doc, r.tf) for r in rows] == [(w, d, tf) for w, d, _, tf, _ in GOLDEN]
    assert dict(T.term_frequency(sample_docs).dtypes)["tf"] == "float"


def test_tfidf_golden_exact_digits(sample_docs):
    rows = T.tfidf(sample_docs).orderBy("word", "doc").collect()
    assert [(r.word, r.doc, r.tfidf) for r in rows] == [(w, d, x) for w, d, _, _, x in GOLDEN]


@pytest.mark.parametrize("words,expected", [
    (["Hadoop", "yellow"], [("file1.txt", "0.69267905"), ("file2.txt", "0.60206")]),
    (["Hadoop", "is"], [("file1.txt", "0.69267905"), ("file2.txt", "0.60206")]),
    (["Hadoop"], [("file1.txt", "0.39164907"), ("file2.txt", "0.30103")]),
])
def test_search_and_rank_golden(sample_docs, words, expected):
    ranked = T.rank_documents(sample_docs, words).select("doc", F.col("score").cast("string").alias("s")).collect()
    assert [(r.doc, r.s) for r in ranked] == expected
    got = {r.doc: r.s for r in T.search(sample_docs, words).select("doc", F.col("score").cast("string").alias("s")).collect()}
    assert got == dict(expected)


def test_search_without_words_is_empty(sample_docs):
    assert T.search(sample_docs, []).count() == 0
    assert T.search(sample_docs).count() == 0
    assert T.search(sample_docs, ["nothere"]).count() == 0


def test_query_words_config_round_trip():
    assert query_words(["a,b", "a", ""]) == ["a", "b"]
    assert query_words("x,y") == ["x", "y"]
    assert query_words(["a,b"], split_commas=False) == ["a,b"]


def test_search_keyword_table_equals_word_list(spark, sample_docs):
    kw = spark.createDataFrame([("Hadoop",), ("yellow",), ("yellow",), ("zzz",)], "word string")
    a = sorted(T.search(sample_docs, keywords=kw).collect())
    b = sorted(T.search(sample_docs, ["Hadoop", "yellow", "zzz"]).collect())
    assert a == b and len(a) == 2


TOKEN_CASES = [  # line, tokens (Spark split on JDK 17 with the reference pattern)
    ("foo, bar", ["foo", ",", "bar"]),
    ("foo - bar", ["foo", "-", "bar"]),
    ("foo. ", ["foo", ". "]),
    ("foo! ? bar", ["foo", "! ?", "bar"]),
    ("  foo", ["foo"]),
    ("   ", ["   "]),
    ("", []),
    ("don't x_y 3.14", ["don", "'", "t", "x_y", "3", ".", "14"]),
    ("café naïve", ["café", "naïve"]),
    ("日本 語", ["日本", "語"]),
    ("  , foo", ["  ,", "foo"]),
]


@pytest.mark.parametrize("line,expected", TOKEN_CASES)
def test_tokenizer_cases(spark, line, expected):
    docs = spark.createDataFrame([("d", line)], "doc string, text string")
    got = [r.word for r in T.tokens(docs).collect()]
    assert got == expected


def test_explicit_boundary_equals_reference_pattern_on_jdk17(spark):
    lines = [l for l, _ in TOKEN_CASES] + ["a b", "x__y--z", "A1b2 ,.;: q", "\tx\t", "ß1²³"]
    df = spark.createDataFrame([(l,) for l in lines], "l string")
    rows = df.select(F.split("l", REFERENCE_TOKEN_PATTERN).alias("a"), F.split("l", TOKEN_SPLIT_PATTERN).alias("b")).collect()
    for r in rows:
        assert [x for x in r.a if x] == [x for x in r.b if x]


def test_lines_are_tokenized_separately(spark):
    docs = spark.createDataFrame([("d", "foo.\r\n, bar\rbaz\n\n  \nqux")], "doc string, text string")
    assert [r.word for r in T.tokens(docs).collect()] == ["foo", ".", ",", "bar", "baz", "  ", "qux"]


@pytest.mark.parametrize("n,df,expected", [
    (2, 2, 0.3010299956639812), (2, 1, 0.47712125471966244),
    (1000, 602, 0.3010299956639812), (1000, 500, 0.47712125471966244),
])
def test_idf_integer_division(spark, n, df, expected):
    from rankloom.functions.weights import idf
    r = spark.createDataFrame([(n, df)], "n_docs long, df long").select(idf("n_docs", "df").alias("v")).first()
    assert r.v == expected


def test_corpus_size_counts_documents_without_tokens(spark):
    docs = spark.createDataFrame([("a", "x y"), ("b", ""), ("c", "   ,")], "doc string, text string")
    assert T.corpus_size(docs).first().n_docs == 3
    # N = 3, df(x) = 1 -> idf = log10(1 + 3) ; all_docs can add files without lines
    w = {r.word: r.idf for r in T.inverse_doc_frequency(docs).collect()}
    assert w["x"] == pytest.approx(0.6020599913279624)
    extra = docs.select("doc").union(docs.sparkSession.createDataFrame([("empty",)], "doc string"))
    w4 = {r.word: r.df for r in T.inverse_doc_frequency(docs, all_docs=extra).select("word", "n_docs", "df").collect()}
    assert T.inverse_doc_frequency(docs, all_docs=extra).first().n_docs == 4 and w4["x"] == 1


def test_rank_ties_one_per_score(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "a"), (4, "c")], "doc long, text string")
    all_rows = T.rank_documents(docs, ["a", "b"]).collect()
    one = T.rank_documents(docs, ["a", "b"], ties="one").collect()
    assert [r.doc for r in all_rows] == [1, 2, 3]
    assert [r.doc for r in one] == [2, 3]
    assert [r.doc for r in T.rank_documents(docs, ["a", "b"], k=2).collect()] == [1, 2]
    with pytest.raises(ValueError):
        T.rank_documents(docs, ["a"], ties="bad")


def test_properties_on_documents(spark):
    from conftest import SF0001
    docs = T.documents(spark.read.parquet(f"{SF0001}/documents.parquet"))
    toks = T.tokens(docs)
    per_doc_tokens = toks.groupBy("doc").agg(F.count(F.lit(1)).alias("t"))
    per_doc_counts = T.doc_word_count(docs).groupBy("doc").agg(F.sum("n").alias("t"))
    assert per_doc_tokens.exceptAll(per_doc_counts).count() == 0
    assert T.tfidf(docs).count() == T.term_frequency(docs).count()
    # permuting rows does not change results
    shuffled = docs.orderBy(F.rand(7))
    assert T.tfidf(shuffled).exceptAll(T.tfidf(docs)).count() == 0


def test_tfidf_shuffle_join_path_equals_broadcast_path(spark):
    from conftest import SF0001
    docs = T.documents(spark.read.parquet(f"{SF0001}/documents.parquet"))
    small = T.tfidf(docs)                                  # vocabulary broadcast
    big = T.tfidf(docs, broadcast_bytes=0)                 # forced shuffle join on word
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    big_plan = big._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in big_plan or "ShuffledHashJoin" in big_plan
    assert small.exceptAll(big).count() == 0 and big.exceptAll(small).count() == 0


def test_search_filter_sits_on_the_token_generator(spark, sample_docs):
    plan = T.term_frequency(sample_docs, words=["Hadoop"])._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    gens = [i for i, l in enumerate(lines) if "Generate explode(split(line" in l]
    assert gens
    for g in gens:   # the line printed right above each token generator is the query-word filter
        assert "Filter" in lines[g - 1] and "Hadoop" in lines[g - 1], "\n".join(lines[g - 2:g + 1])


def _count_tokenizing(monkeypatch, call):
    """Runs ``call`` and gives the number of token generators in all plans that it materialises or returns."""
    seen = []
    real = T._materialise
    monkeypatch.setattr(T, "_materialise", lambda df, tables=None: (seen.append(df), real(df, tables))[1])
    seen.append(call())
    return sum(df._jdf.queryExecution().optimizedPlan().toString().count("Generate explode(split(line") for df in seen)


def test_corpus_is_tokenized_once(spark, monkeypatch):
    """Vocabulary and join read the written postings (plain table scan, no spreading)."""
    from conftest import SF0001
    docs = T.documents(spark.read.parquet(f"{SF0001}/documents.parquet"))
    kw = spark.createDataFrame([("the",), ("la",)], "word string")
    for call in (lambda: T.tfidf(docs), lambda: T.search(docs, ["the", "la"]), lambda: T.search(docs, keywords=kw),
                 lambda: T.search(docs, keywords=kw, broadcast_bytes=0)):
        with monkeypatch.context() as m:
            assert _count_tokenizing(m, call) == 1


def test_long_word_list_is_a_join(spark, sample_docs):
    words = [f"w{i}" for i in range(T.MAX_IN_LIST)] + ["Hadoop"]
    plan = T.term_frequency(sample_docs, words=words)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and " IN (" not in plan
    assert sorted(T.search(sample_docs, words).collect()) == sorted(T.search(sample_docs, ["Hadoop"]).collect())


def test_words_and_keywords_together(spark, sample_docs):
    kw = spark.createDataFrame([("Hadoop",), ("an",)], "word string")
    assert sorted(T.search(sample_docs, ["Hadoop", "yellow"], kw).collect()) == sorted(T.search(sample_docs, ["Hadoop"]).collect())


def test_vocabulary_is_measured_in_bytes(spark):
    words = spark.createDataFrame([("日本語日本語",)], "word string")
    assert T._measured(words, T.ROW_BYTES + 17)[1] is False and T._measured(words, T.ROW_BYTES + 18)[1] is True


def test_hot_word_in_every_document_is_split(spark):
    """One word in every document: the shuffle join with the weights splits its partition."""
    docs = spark.range(30000).selectExpr("concat('d', id) as doc", "concat('hot w', id % 5000) as text")
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = T.tfidf(docs, broadcast_bytes=0)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_keyword_search_large_keyword_path(spark):
    from conftest import SF0001
    docs = T.documents(spark.read.parquet(f"{SF0001}/documents.parquet"))
    kw = T.keyword_table(spark.read.parquet(f"{SF0001}/benchmark.parquet"))
    small = T.search(docs, keywords=kw)
    large = T.search(docs, keywords=kw, broadcast_bytes=0)   # semi-join on postings, shuffle joins
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0 and small.count() > 0


def test_empty_corpus_and_null_text(spark):
    empty = spark.createDataFrame([], "doc string, text string")
    assert T.tfidf(empty).count() == 0
    assert T.search(empty, ["a"]).count() == 0
    assert T.corpus_size(empty).first().n_docs == 0
    docs = spark.createDataFrame([("a", None), ("b", "x x y")], "doc string, text string")
    assert T.corpus_size(docs).first().n_docs == 2          # a document without text still counts in N
    w = {r.word: r.idf for r in T.inverse_doc_frequency(docs).collect()}
    assert w["x"] == pytest.approx(0.47712125471966244)    # log10(1 + 2 div 1)
    assert [(r.doc, r.n) for r in T.doc_word_count(docs).orderBy("word").collect()] == [("b", 2), ("b", 1)]


def test_written_tables_go_with_the_callers_block(spark, sample_docs):
    import os
    from rankloom.tables import Tables
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(base))
    with Tables(spark) as tables:
        kw = spark.createDataFrame([("Hadoop",), ("yellow",)], "word string")
        assert T.tfidf(sample_docs, tables=tables).count() == 8
        assert T.search(sample_docs, keywords=kw, broadcast_bytes=0, tables=tables).count() == 2
        assert T.rank_documents(sample_docs, ["Hadoop"], tables=tables).count() == 2
        assert T.in_key_order(T.doc_word_count(sample_docs), tables).count() == 8
        assert len(os.listdir(tables.folder.removeprefix("file:"))) >= 6
    assert set(os.listdir(base)) == before


def test_a_session_without_the_cleaner_leaves_nothing(tmp_path):
    """Tables that lazy results still read go when the application ends."""
    import os
    import subprocess
    import sys
    import time
    code = f"""
import sys; sys.path.insert(0, {os.getcwd()!r})
from rankloom import local_session
from rankloom.operators import text as T
spark = local_session(2, extra={{"spark.checkpoint.dir": {str(tmp_path)!r}, "spark.cleaner.referenceTracking.cleanCheckpoints": "false"}})
docs = spark.createDataFrame([("a", "x y"), ("b", "x")], "doc string, text string")
import os
assert T.rank_documents(docs, ["x"]).count() == 2
assert [f for _, _, names in os.walk({str(tmp_path)!r}) for f in names]
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)
    until = time.time() + 60  # the JVM ends shortly after the client
    while (left := [f for _, _, names in os.walk(tmp_path) for f in names]) and time.time() < until:
        time.sleep(1)
    assert left == []


def test_row_counts_equal_counted_tokens(spark, monkeypatch):
    """Shared, null and single keys, null and long texts, every kind of white space and mark, on both boundary patterns."""
    import random
    from rankloom.functions import tokenize as K
    r = random.Random(1)
    chars = list("ab1_é中. ,-\t\n\r\x0b\f́́  \x85ः٣") + [" "] * 3 + ["\U0001d49c"]
    texts = ["".join(r.choice(chars) for _ in range(r.randint(0, 30))) for _ in range(400)]
    docs = spark.createDataFrame([(i if i % 3 else i // 9 if i % 2 else None, x) for i, x in enumerate(texts)] + [(None, None), (999, None)], "doc long, text string")
    docs = docs.repartition(2).localCheckpoint()
    for pattern in (K.REFERENCE_TOKEN_PATTERN, K.TOKEN_SPLIT_PATTERN):
        for longest in (T.ROW_TEXT, 20):
            with monkeypatch.context() as m:
                m.setattr(T, "token_split_pattern", lambda _: pattern)
                m.setattr(T, "ROW_TEXT", longest)
                counted = T.tokens(docs).groupBy("word", "doc").agg(F.count(F.lit(1)).alias("n"))
                same = lambda df: sorted(map(str, df.collect()))
                assert same(T.doc_word_count(docs)) == same(counted)


def test_postings_of_single_rows_are_not_shuffled(spark, sample_docs):
    plan = T.row_counts(sample_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    shown = T.term_frequency(sample_docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in shown and shown.count("Aggregate") == 1  # of long texts alone
