"""Sources and sinks: reference text formats, round trips, file-based document sets."""

import os

import pytest

from pyspark.sql import functions as F

from rankloom import sinks as K
from rankloom import sources as S
from rankloom.operators import pagerank as PR
from rankloom.operators import text as T


def read_lines(path):
    out = []
    for f in sorted(os.listdir(path)):
        if f.startswith("part-"):
            with open(os.path.join(path, f), encoding="utf-8") as fh:
                out += fh.read().splitlines()
    return out


def write_inputs(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "file1").write_text("Hadoop is yellow Hadoop\n")
    (d / "file2").write_text("yellow Hadoop is an elephant\n")
    return str(d)


def test_text_folder_to_reference_outputs(spark, tmp_path):
    docs = S.read_text_docs(spark, write_inputs(tmp_path), doc_suffix=".txt", key="name")
    out = str(tmp_path / "out")
    K.write_counts(T.doc_word_count(docs), out + "/wc", ordered=True)
    assert read_lines(out + "/wc")[:2] == ["Hadoop&#&#&file1.txt\t\t2", "Hadoop&#&#&file2.txt\t\t1"]
    K.write_counts(T.term_frequency(docs).orderBy("word", "doc"), out + "/tf", value="tf")
    assert read_lines(out + "/tf")[0] == "Hadoop&#&#&file1.txt\t\t1.30103"
    K.write_weights(T.tfidf(docs).orderBy("word", "doc"), out + "/tfidf")
    assert read_lines(out + "/tfidf")[0] == "Hadoop&#&#&file1.txt\t0.3916490552587094"
    K.write_scores(T.rank_documents(docs, ["Hadoop", "yellow"]), out + "/rank")
    assert read_lines(out + "/rank") == ["file1.txt\t0.69267905", "file2.txt\t0.60206"]


def test_term_weight_and_score_round_trip(spark, tmp_path, sample_docs):
    out = str(tmp_path / "w")
    K.write_weights(T.tfidf(sample_docs), out)
    back = S.read_term_weights(spark, out)
    want = T.tfidf(sample_docs).select("word", "doc", F.col("tfidf").alias("value"))
    assert back.exceptAll(want).count() == 0 and back.count() == 8
    K.write_counts(T.term_frequency(sample_docs), out + "tf", value="tf")
    tf = S.read_term_weights(spark, out + "tf", "float")
    assert tf.filter("word = 'Hadoop' and doc = 'file1.txt'").first().value == T.term_frequency(
        sample_docs).filter("word = 'Hadoop' and doc = 'file1.txt'").first().tf
    K.write_scores(T.search(sample_docs, ["Hadoop"]), out + "s")
    assert sorted(S.read_scores(spark, out + "s").collect()) == sorted(T.search(sample_docs, ["Hadoop"]).collect())


def test_file_listing_counts_empty_files(spark, tmp_path):
    d = write_inputs(tmp_path)
    (tmp_path / "in" / "empty").write_text("")
    docs = S.read_text_docs(spark, d)
    assert T.corpus_size(docs).first().n_docs == 2                   # lines only see two files
    (tmp_path / "in" / "blank").write_text("\n\n")
    listed = S.list_docs(spark, d, key="name")                                  # non-empty files, tokens or not
    assert sorted(r.doc for r in listed.collect()) == ["blank", "file1", "file2"]
    n = S.count_files(spark, d)                                     # the reference's N: every file
    assert n == 4
    idf = {r.word: r.idf for r in T.inverse_doc_frequency(docs, all_docs=n).collect()}
    assert idf["an"] == __import__("math").log10(1 + 4 // 1)
    idf3 = {r.word: r.idf for r in T.inverse_doc_frequency(docs, all_docs=listed).collect()}
    assert idf3["an"] == __import__("math").log10(1 + 3 // 1)


def test_rank_state_and_edge_list_round_trip(spark, tmp_path):
    state = spark.createDataFrame([("A", 0.25, ["B", "C"]), ("B", 0.5, [])], "page string, rank double, links array<string>")
    out = str(tmp_path / "state")
    K.write_rank_state(state, out)
    assert sorted(read_lines(out)) == ["A\t##0.25##B@!#C", "B\t##0.5"]
    back = sorted((r.page, r.rank, list(r.links)) for r in S.read_rank_state(spark, out).collect())
    assert back == [("A", 0.25, ["B", "C"]), ("B", 0.5, [])]
    edges = spark.createDataFrame([("A", "B"), ("A", "C")], "src string, dst string")
    K.write_edge_list(edges, str(tmp_path / "edges"))
    assert sorted(read_lines(str(tmp_path / "edges"))) == ["A#####B", "A#####C"]
    assert sorted(S.read_edge_list(spark, str(tmp_path / "edges")).collect()) == sorted(edges.collect())


def test_same_names_in_two_folders_are_two_documents(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "same").write_text("x y\n")
    paths = f"{tmp_path}/a,{tmp_path}/b"
    docs = S.read_text_docs(spark, paths)
    assert T.corpus_size(docs).first().n_docs == 2 == S.count_files(spark, paths)
    assert S.list_docs(spark, paths).distinct().count() == 2
    assert T.corpus_size(S.read_text_docs(spark, paths, key="name")).first().n_docs == 1


def test_sinks_refuse_an_existing_folder(spark, tmp_path):
    df = spark.createDataFrame([("d", 1.5)], "doc string, score float")
    out = str(tmp_path / "out")
    K.write_scores(df, out)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        K.write_scores(df, out)
    assert read_lines(out) == ["d\t1.5"]
    K.write_scores(df.withColumn("score", F.lit(2.0)), out, overwrite=True)
    assert read_lines(out) == ["d\t2.0"]


def test_scores_of_documents_with_quotes_and_tabs(spark, tmp_path):
    df = spark.createDataFrame([('"a" b', 1.5), ("x\ty", 2.5), ("", 0.5)], "doc string, score float")
    K.write_scores(df, str(tmp_path / "s"))
    assert sorted(S.read_scores(spark, str(tmp_path / "s")).collect()) == sorted(df.collect())


def test_rank_state_prints_float32(spark, tmp_path):
    df = spark.createDataFrame([("A", 1 / 3, ["B"]), ("B", 2e-4, [])], "page string, rank double, links array<string>")
    K.write_rank_state(df, str(tmp_path / "state"))
    assert sorted(read_lines(str(tmp_path / "state"))) == ["A\t##0.33333334##B", "B\t##2.0E-4"]


def test_resume_from_saved_state(spark, tmp_path):
    """Half of the rounds, the state in doubles as text, the other half: as all rounds at once."""
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("d", "a"), ("c", "x")], "src string, dst string")
    for mode in PR.MODES:
        half = PR.pagerank_run(e, mode=mode, iterations=5, tol=None).ranks
        lines = half.select(F.concat("page", F.lit("\t##"), F.col("rank").cast("string")).alias("value"))
        lines.write.text(str(tmp_path / mode))
        state = S.read_rank_state(spark, str(tmp_path / mode))
        went_on = {r.page: r.rank for r in PR.pagerank(e, mode=mode, iterations=5, tol=None, initial_ranks=state).collect()}
        at_once = {r.page: r.rank for r in PR.pagerank(e, mode=mode, iterations=10, tol=None).collect()}
        assert went_on == pytest.approx(at_once, abs=1e-12)


def test_rank_outputs(spark, tmp_path):
    p = tmp_path / "pages.txt"
    p.write_text("<title>1</title> <text>[[3]][[5]]</text>\n\n<title>2</title> <text>[[1]][[3]]</text>\n\n"
                 "<title>3</title> <text>[[2]][[4]]</text>\n\n<title>4</title> <text>[[1]][[5]]</text>\n\n"
                 "<title>5</title> <text>[[3]]</text>\n")
    lines = S.read_lines(spark, str(p))
    assert lines.count() == 9
    ranks = PR.pagerank_lines(lines, mode="all_nodes")
    want = 1.3443011530882782
    K.write_ranked_pages(ranks, str(tmp_path / "k5"))
    page, empty, rank = read_lines(str(tmp_path / "k5"))[0].split("\t")
    assert (page, empty) == ("3", "") and float(rank) == pytest.approx(want, abs=1e-6) and len(rank) <= 10  # float32 digits
    K.write_rank_lines(ranks, str(tmp_path / "k6"), single_file=True)
    page, rank = read_lines(str(tmp_path / "k6"))[0].split("   ")
    assert page == "3" and float(rank) == pytest.approx(want, abs=1e-9)
    K.write_rank_report(ranks, str(tmp_path / "k7"))
    line = read_lines(str(tmp_path / "k7"))[0]
    assert line.startswith("3 has rank: ") and line.endswith(".")
    assert float(line[len("3 has rank: "):-1]) == pytest.approx(want, abs=1e-9)


def test_cli_jobs_write_reference_outputs(spark, tmp_path):
    from rankloom.cli import run
    d = write_inputs(tmp_path)
    out = str(tmp_path / "cli")
    run(["wordcount", d, out + "/wc"], spark)
    assert read_lines(out + "/wc") == ["Hadoop&#&#&file1.txt\t\t2", "Hadoop&#&#&file2.txt\t\t1",
                                       "an&#&#&file2.txt\t\t1", "elephant&#&#&file2.txt\t\t1",
                                       "is&#&#&file1.txt\t\t1", "is&#&#&file2.txt\t\t1",
                                       "yellow&#&#&file1.txt\t\t1", "yellow&#&#&file2.txt\t\t1"]
    run(["termfrequency", d, out + "/tf"], spark)
    assert read_lines(out + "/tf")[0] == "Hadoop&#&#&file1.txt\t\t1.30103"
    run(["tfidf", d, out + "/tfidf"], spark)
    assert read_lines(out + "/tfidf")[:2] == ["Hadoop&#&#&file1.txt\t0.3916490552587094",
                                              "Hadoop&#&#&file2.txt\t0.3010299956639812"]
    run(["rank", d, out + "/rank", "Hadoop", "yellow"], spark)
    assert read_lines(out + "/rank") == ["file1.txt\t0.69267905", "file2.txt\t0.60206"]
    run(["search", d, out + "/search", "Hadoop"], spark)
    assert sorted(read_lines(out + "/search")) == ["file1.txt\t0.39164907", "file2.txt\t0.30103"]
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "input.txt").write_text("<title>1</title> <text>[[3]][[5]]</text>\n\n<title>2</title> <text>[[1]][[3]]</text>\n\n"
                                     "<title>3</title> <text>[[2]][[4]]</text>\n\n<title>4</title> <text>[[1]][[5]]</text>\n\n"
                                     "<title>5</title> <text>[[3]]</text>\n")
    run(["pagerank", str(pages), out + "/pr", "--mode", "all_nodes"], spark)
    page, rank = read_lines(out + "/pr")[0].split("   ")
    assert page == "3" and float(rank) == pytest.approx(1.3443011530882782, abs=1e-9)
    edges = tmp_path / "edges"
    edges.mkdir()
    (edges / "e.txt").write_text("1#####3\n1#####5\n2#####1\n2#####3\n3#####2\n3#####4\n4#####1\n4#####5\n5#####3\n")
    run(["pagerank", str(edges), out + "/pr_e", "--edges", "--mode", "cited_only", "--n", "9"], spark)
    first = read_lines(out + "/pr_e")[0]
    assert first.startswith("3 has rank: ") and first.endswith(".")
    assert float(first[len("3 has rank: "):-1]) == pytest.approx(1.3153339555746044, abs=1e-9)
