import hashlib
from collections import Counter, defaultdict

from rankloom.llm import exact_dedup


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    """Every row's verdict; of rows that are equal in id and text one is kept."""
    groups = defaultdict(list)
    for r in rows:
        groups[lowered(r.text)].append(r.doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.update((i, keep, len(ids), False, digest) for i in ids)
        out[keep, keep, len(ids), False, digest] -= 1
        out[keep, keep, len(ids), True, digest] += 1
    return +out


def test_documents_and_awkward_rows(documents, awkward, nothing):
    for df in (documents, awkward):
        assert Counter(map(tuple, exact_dedup.exact_dedup(df).collect())) == brute(df.collect())
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_rows_without_an_id_are_documents_of_their_own(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (5, "b"), (5, "b")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect()), key=repr)
    assert got == [(5, 5, 2, False), (5, 5, 2, True), (None, None, 2, False), (None, None, 2, True)]


def test_kelvin_sign_is_not_k(spark):
    df = spark.createDataFrame([(1, "\u212a"), (2, "k"), (3, "K"), (4, "É"), (5, "é")], "doc_id long, text string")
    assert {r.doc_id: r.keep_id for r in exact_dedup.exact_dedup(df).collect()} == {1: 1, 2: 3, 3: 3, 4: 4, 5: 5}


def test_index_persists_between_batches(spark, tmp_path):
    def batch(*rows):
        index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), buckets=5)  # as a later application opens it
        df = spark.createDataFrame(list(rows), "doc_id long, text string")
        out = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.dedup(df, index).collect()}
        assert index.buckets == 5
        spark.sql(f"DROP TABLE {index.name}")
        return out

    assert batch((1, "a"), (2, "A"), (3, "b")) == {1: (2, False), 2: (2, True), 3: (3, True)}
    assert batch((9, "a"), (8, "c"), (7, "C")) == {9: (2, False), 8: (8, True), 7: (8, False)}
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"))
    assert index.buckets == 5 and index.read().count() == 3
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {index.name}").collect()}
    assert described["Bucket Columns"] == "[`digest`]" and described["Sort Columns"] == "[`digest`]"
    index.drop()


def test_the_query_takes_the_sort_merge_anti_join(spark, documents, monkeypatch):
    """Also from an empty index; and the index side is not shuffled."""
    plans, real = [], exact_dedup._unknown

    def seen(groups, index):
        df = real(groups, index)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(exact_dedup, "_unknown", seen)
    exact_dedup.exact_dedup(documents).collect()
    exact_dedup.keep_one(documents).collect()
    assert len(plans) == 2
    for plan in plans:
        assert "SortMergeJoin" in plan and "LeftAnti" in plan and plan.count("Exchange hashpartitioning") == 1, plan
        assert "SelectedBucketsCount" in plan


def test_keep_one(awkward, nothing):
    out = exact_dedup.keep_one(awkward)
    assert out.columns == awkward.columns
    rows = out.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15]
    assert sum(r.doc_id is None for r in rows) == 1
    assert exact_dedup.keep_one(nothing).count() == 0


def test_no_tables_are_left(spark, documents):
    before = {t.name for t in spark.catalog.listTables()}
    exact_dedup.exact_dedup(documents).count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_hot_group_is_spread(spark):
    df = spark.range(6000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same', concat('t', id)) as text")
    out = exact_dedup.exact_dedup(df)
    assert out.where("group_size = 2000").count() == 2000 and out.where("kept").count() == 4001


def test_keep_one_with_null_and_repeated_ids(spark):
    rows = [(None, "a"), (None, "b"), (None, "A"), (5, "c"), (5, "d"), (5, "C"), (6, "d"), (None, "d"), (7, "e"), (None, None), (None, "")]
    out = exact_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((lowered(r.text), r.doc_id) for r in out if r.doc_id is not None) == [("c", 5), ("d", 6), ("e", 7)]
    assert sorted(lowered(r.text) for r in out if r.doc_id is None) == ["", "a", "b"]
    index = exact_dedup.DigestIndex(spark)
    try:
        def batch(*rows):
            return {tuple(r) for r in exact_dedup.keep_one(spark.createDataFrame(list(rows), "doc_id long, text string"), index).collect()}
        assert batch((1, "a"), (None, "b")) == {(1, "a"), (None, "b")}
        assert batch((None, "A"), (1, "c"), (2, "b"), (None, "d")) == {(1, "c"), (None, "d")}
    finally:
        index.drop()
