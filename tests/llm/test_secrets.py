import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rankloom.llm import secrets

PYTHON = (("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
          ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile(r"[0-9a-f]+"), 0, 32))


def brute(text):
    found = [(m.start(), n, m.end(), kind) for n, (kind, rule, group, least) in enumerate(PYTHON)
             for m in rule.finditer(text or "") if len(m[group]) >= least]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def ascii_only(text):
    """(?ai) folds the long s and the Kelvin sign; the rules don't."""
    return text.replace("ſ", "#").replace("\u212a", "#") if text else text


def check(df, rows):
    got = sorted((str(r.doc_id), r.spans) for r in df.collect())
    assert got == sorted((str(r.doc_id), brute(ascii_only(r.text))) for r in rows)


def test_documents_match_brute_force(documents):
    check(secrets.secret_spans(documents), documents.collect())


def test_awkward_rows(awkward, nothing):
    out = secrets.secret_spans(awkward)
    check(out, awkward.collect())
    for r in out.collect():
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
        assert r.n_assign + r.n_access + r.n_hex == len([s for s in r.spans.split(",") if s])
    assert secrets.secret_spans(nothing).count() == 0


def test_dropped_match_consumes_its_characters(spark):
    df = spark.createDataFrame([(1, "token=secret:abcdefgh"), (2, "token=x secret:abcdefgh")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.secret_spans(df).collect()}
    assert got == {1: "", 2: "assign:8:23"}


@pytest.mark.parametrize("pattern, query", [
    ("AKIA[A-Z0-9]+", [{"aki", "kia"}]),
    ("[0-9a-f]{32,}", None),
    ("(abcd|xyz)[0-9]*", [{"abc", "bcd"}, {"xyz"}]),
    ("a?bcd", [{"bcd"}]),           # abcd implies bcd
    ("ab.cd", None),
    ("(foo)+bar", [{"foo", "bar"}]),
    ("(foo|x)bar", [{"foo", "oob", "oba", "bar"}, {"xba", "bar"}]),
    ("foo(bar)*", [{"foo"}]),
])
def test_trigram_queries(pattern, query):
    got = secrets.trigram_query(pattern)
    assert got == query if query is None else sorted(map(sorted, got)) == sorted(map(sorted, query))


def test_candidates_hold_every_match(spark, documents):
    found = secrets.candidates(documents)
    ids = {r.doc_id: r.rules for r in found.collect()}
    for r in documents.collect():
        for n, (_, rule, group, least) in enumerate(PYTHON[:2]):
            if any(len(m[group]) >= least for m in rule.finditer(r.text)):
                assert ids[r.doc_id] >> n & 1


def test_rules_without_index_only(spark, documents):
    only = [r for r in secrets.RULES if r.kind == "hex"]
    assert secrets.candidates(documents, only) is None
    assert secrets.scan(documents, only).count() == documents.count()


def test_shuffled_candidates_give_the_same(monkeypatch, awkward):
    want = sorted(map(str, secrets.secret_spans(awkward).collect()))
    monkeypatch.setattr(secrets, "checked_broadcast", lambda df: df)
    assert sorted(map(str, secrets.secret_spans(awkward).collect())) == want


def test_redaction(awkward):
    out = secrets.redact(awkward)
    assert out.columns == awkward.columns and out.schema == awkward.schema
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[6].text == "[secret]' and token: short, [secret], [secret]x" and rows[6].n_chars == len(rows[6].text)
    assert rows[3].text is None and rows[3].n_chars is None and rows[1].found == "clash"
    assert not any(brute(ascii_only(r.text)) for r in out.collect())


def test_any_other_column_may_be_there(awkward):
    clash = {c: f"'{c}'" for c in ("__rules", "__key", "__found", "__clean", "found_spans", "clean_text", "text_chunks", "rules_of_row", "Key_Of_Row")}
    df = awkward.select("*", *(F.expr(v).alias(c) for c, v in clash.items()))
    out = secrets.redact(df)
    assert out.columns == df.columns
    want = {(r.doc_id, r.text, r.n_chars) for r in secrets.redact(awkward).collect()}
    assert {(r.doc_id, r.text, r.n_chars) for r in out.collect()} == want
    assert all(r[c] == c for r in out.collect() for c in clash)
    check(secrets.secret_spans(df), awkward.collect())


def masked(text):
    """Overlapping or touching-by-overlap spans are one mark."""
    out, at = [], 0
    for part in (p for p in brute(text).split(",") if p):
        a, b = map(int, part.split(":")[1:])
        if a >= at:
            out += [text[at:a], "[secret]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_a_text_with_very_many_secrets(spark):
    """Work that grows with the square of the secrets would take hours here."""
    rng = random.Random(1)
    parts = ["token=abcdefgh1", "AKIA" + "A" * 16, "0123456789abcdef" * 2, "api_key: " + "a1" * 20, "é\U0001f600 plain ", "\n"]
    text = " ".join(rng.choice(parts) for _ in range(100_000))
    short = [" ".join(rng.choice(parts) for _ in range(n)) for n in range(300)] + ["x" * n + "token=abcdefgh" + "é" * n for n in (1009, 1010, 1011, 1024, 2048)]
    df = spark.createDataFrame(list(enumerate([text, *short])), "doc_id long, text string")
    check(secrets.secret_spans(df), df.collect())
    assert {r.doc_id: r.text for r in secrets.redact(df).collect()} == {n: masked(t) for n, t in enumerate([text, *short])}


def test_no_python_worker(awkward):
    for df in (secrets.secret_spans(awkward), secrets.redact(awkward)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
