import pytest
from pyspark.sql import functions as F

from rankloom.llm import quality


@pytest.fixture(scope="module")
def larger(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_accuracy_on_labels_never_seen(larger):
    documents, labels = larger
    judged = quality.classify(documents).join(labels, "doc_id")
    table = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    good, bad = table.get((1, True), 0), table.get((0, False), 0)
    assert table.get((1, False), 0) <= 0.005 * (good + table.get((1, False), 0))
    assert bad >= 0.95 * (bad + table.get((0, True), 0))


def test_rows_and_columns(awkward, nothing):
    out = quality.classify(awkward)
    assert out.columns == ["doc_id", "votes", "posterior", "score", "kept"]
    assert out.count() == awkward.count() and out.where("score is null or posterior is null").count() == 0
    assert quality.classify(nothing).count() == 0


def test_keep_good_is_the_same_decision(documents, awkward, nothing):
    kept = quality.keep_good(documents)
    assert kept.schema == documents.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in quality.classify(documents).where("kept").collect())
    assert quality.keep_good(awkward).columns == awkward.columns
    assert quality.keep_good(nothing).count() == 0


def test_empty_texts_are_kept(awkward):
    empty = awkward.where(F.coalesce("text", F.lit("")).rlike(r"^\s*$"))
    assert quality.keep_good(empty).count() == empty.count() == 3


def test_votes():
    def named(text):
        data = text.encode()
        return {name: v for (name, *_), v in zip(quality.LABELLERS, quality.digits(quality.votes(data, data.split())))}
    clean = named("The committee met on Tuesday. It agreed on a plan for the harbour, and adjourned.")
    assert quality.BAD not in clean.values()
    assert named("of%%% the&&& this$$$ that### on*** in%%%")["odd_ends"] == quality.BAD
    assert named("ALL!! OF!! THIS!! IS!! SHOUTED!!")["shouting"] == quality.BAD
    assert named("home | about | news | contact | more | top")["bars"] == quality.BAD
    assert named("spam spam spam spam spam spam")["repeats"] == quality.BAD
    assert set(named("").values()) == {quality.ABSTAIN}


def test_expectation_maximisation_finds_known_rates():
    import numpy as np
    rng = np.random.default_rng(1)
    n, width = 40_000, len(quality.LABELLERS)
    bad = rng.random(n) < 0.2
    votes = np.where(rng.random((n, width)) < np.where(bad[:, None], 0.4, 0.02), quality.BAD, quality.GOOD)
    votes[rng.random((n, width)) < 0.1] = quality.ABSTAIN
    codes = votes @ 3 ** np.arange(width - 1, -1, -1)
    posterior, rates, prior = quality.estimate(dict(zip(*(x.tolist() for x in np.unique(codes, return_counts=True)))))
    assert abs(prior - 0.8) < 0.02
    assert np.abs(rates[:, 0, quality.BAD] - 0.4).max() < 0.05 and np.abs(rates[:, 1, quality.BAD] - 0.02).max() < 0.01
    right = np.mean([(posterior[c] < 0.5) == b for c, b in zip(codes.tolist(), bad)])
    assert right > 0.95


def test_the_sample_is_bounded_under_repeats(spark, monkeypatch):
    """Rows that are drawn together are one row of the sample."""
    seen, real = [], quality.train
    monkeypatch.setattr(quality, "train", lambda rows: (seen.append(len(rows)), real(rows))[1])
    same = spark.range(30000).selectExpr("cast(null as long) AS doc_id", "IF(id % 2 = 0, 'a good plain sentence of words. ', 'buy now!!! $$$ ') AS text")
    quality.fit(same, sample=64)
    other = spark.range(3000).selectExpr("id AS doc_id", "concat('some words of text number ', id) AS text")
    quality.fit(other, sample=64)
    assert seen[0] <= 2 and 30 <= seen[1] <= 80
