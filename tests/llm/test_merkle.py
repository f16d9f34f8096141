import hashlib

from pyspark.sql import functions as F

from rankloom.llm import merkle


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def tree(text):
    paragraphs, leaves, sections = [], [], []
    for section in text.split("\n\n"):
        own = []
        for paragraph in section.split("\n"):
            sentences = []
            for s in paragraph.split(". "):
                hashes = [sha(s[i:i + merkle.BLOCK]) for i in range(0, max(1, len(s)), merkle.BLOCK)]
                leaves += hashes
                sentences.append(sha("".join(hashes)))
            own.append(sha("".join(sentences)))
        paragraphs += own
        sections.append(sha("".join(own)))
    return "|".join([sha("".join(sections)), " ".join(p[:8] for p in paragraphs), " ".join(x[:8] for x in leaves)])


def likeness(a, b):
    if a.split("|")[0] == b.split("|")[0]:
        return 1.0
    x, y = (set(p.split("|")[2].split(" ")) for p in (a, b))
    return 2 * len(x & y) / (len(x) + len(y))


def brute(rows):
    rows = sorted(((r.doc_id, r.text or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), tree(r[1])))
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        k = len(text) // 3
        edited = text[:len(text) - k] + after[:k]
        a, b, c = tree(text), tree(edited), tree(after)
        yield (i, len(text), sha(edited), a, b, likeness(a, b), likeness(a, c))


def check(df):
    got = [tuple(r) for r in merkle.document_fingerprints(df).collect()]
    assert sorted(got, key=repr) == sorted(brute(df.collect()), key=repr)


def test_documents(documents):
    check(documents)


def test_awkward_rows(awkward, nothing):
    check(awkward)
    assert merkle.document_fingerprints(nothing).count() == 0


def test_one_document(spark):
    check(spark.createDataFrame([(7, "alone here")], "doc_id long, text string"))


def test_differing_locates_the_edited_paragraph(spark):
    df = spark.createDataFrame([("a\nb\nc", "a\nX\nc")], "x string, y string")
    row = df.select(merkle.differing(merkle.fingerprint(F.col("x")), merkle.fingerprint(F.col("y"))).alias("d")).first()
    assert row.d == [1]


def test_separators_are_told_apart(spark):
    texts = ["a\nb", "a\n\nb", "a. b", "a b", "a\nb\n", "", " ", "\n", "\n\n", ". "]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(merkle.fingerprint(F.col("text")).alias("p"))
    assert len({r.p.split("|")[0] for r in df.collect()}) == len(texts)


def test_native_plan(documents):
    plan = merkle.document_fingerprints(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
