"""Every stage against a brute-force version on its own input, and the whole run."""

import corpus_pipeline
from rankloom.llm import quality

from . import test_exact_dedup, test_packing, test_secrets, test_simhash


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "secrets", "packing"]
    stages, docs = dict(corpus_pipeline.STAGES), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = stages["quality"](spark, docs, "")
    kept = {r.doc_id for r in quality.classify(docs).where("kept").collect()}
    assert out.columns == docs.columns and rows(out) == sorted(repr(tuple(r)) for r in docs.collect() if r.doc_id in kept)

    docs, out = out, stages["exact"](spark, out, "")
    kept = {i for i, keep, _, stays, _ in test_exact_dedup.brute(docs.collect()) if stays}
    assert rows(out) == sorted(repr(tuple(r)) for r in docs.collect() if r.doc_id in kept)

    docs, out = out, stages["near"](spark, out, "")
    own = docs.collect()
    groups = test_simhash.groups([test_simhash.fingerprint(r.text) for r in own])
    least = {g: min(r.doc_id for r, h in zip(own, groups) if h == g) for g in set(groups)}
    assert rows(out) == sorted(repr(tuple(r)) for r, g in zip(own, groups) if r.doc_id == least[g])

    docs, out = out, stages["secrets"](spark, out, "")
    before = {r.doc_id: r for r in docs.collect()}
    assert len(before) == out.count()
    changed = 0
    for r in out.collect():
        spans = [s.split(":") for s in test_secrets.brute(before[r.doc_id].text).split(",") if s]
        text, at, want = before[r.doc_id].text, 0, ""
        for _, a, b in spans:
            if int(a) >= at:
                want += text[at:int(a)] + "[secret]"
            at = max(at, int(b))
        assert r.text == want + text[at:] and r.n_chars == len(r.text)
        changed += bool(spans)
    assert changed

    test_packing.check(out)


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_awkward_and_empty_tables(spark, awkward, nothing):
    for docs in (awkward, nothing):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            if name != "packing":
                assert out.columns == docs.columns
                docs = out
        assert (out.count() > 0) == (n > 0)
