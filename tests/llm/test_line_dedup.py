import hashlib
import random
from collections import defaultdict

from rankloom.llm import line_dedup
from rankloom.llm.line_dedup import similarity


def brute(rows):
    """(doc_id, line_no, line id, component, kept) by comparing all pairs of lines."""
    places = [(r.doc_id, n, line) for r in rows for n, line in enumerate((r.text or "").split("\n")) if line.strip(" ")]
    lines = sorted({line for _, _, line in places})
    parent = {x: x for x in lines}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            if 0.8 <= len(a) / len(b) <= 1.25 or min(len(a), len(b)) < 200:
                if similarity(a, b) >= 0.8:
                    parent[root(a)] = root(b)
    key = lambda x: hashlib.md5(x.encode()).hexdigest()
    groups = defaultdict(list)
    for x in lines:
        groups[root(x)].append(key(x))
    component = {k: min(g) for g in groups.values() for k in g}
    order = lambda p: (p[0] is not None, p[0] or 0, p[1])
    first = {}
    for p in sorted(places, key=order):
        first.setdefault(component[key(p[2])], (p[0], p[1]))
    return [(i, n, key(x), component[key(x)], first[component[key(x)]] == (i, n)) for i, n, x in places]


def check(df):
    got = sorted(map(repr, map(tuple, line_dedup.line_dedup(df).collect())))
    assert got == sorted(map(repr, brute(df.collect())))


def variants(seed, base, n, edits):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = base.split(" ")
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = "".join(rng.choice("abcdef") for _ in range(5))
        out.append(" ".join(words))
    return out


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_planted_variants(spark):
    texts = []
    for seed in range(6):
        base = prose(seed, 45)
        texts += variants(seed, base, 12, 3)
    texts = ["\n".join([t, prose(i + 50, 12), "short", "  ", ""]) for i, t in enumerate(texts)]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_large_group_of_variants(spark):
    texts = variants(1, prose(7, 60), 150, 4)
    check(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))


def test_awkward_rows(awkward, nothing):
    check(awkward)  # lines of 300,000 and 70,000 characters among them
    assert line_dedup.line_dedup(nothing).count() == 0


def test_dedup_text(spark):
    base = prose(3, 50)
    df = spark.createDataFrame([(1, base + "\nown line of one"), (2, "before it all\n" + base.replace("a", "a", 1) + "\n\n"), (3, "own line of one")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_text(df).collect()} == {1: base + "\nown line of one", 2: "before it all"}


def test_short_lines_are_alike_only_when_equal():
    assert similarity("abc", "abc") == 1 and similarity("abc", "abd") == 0 and similarity("", "a") == 0
    keys = line_dedup.signed(["abc", "abd", "abc", "x" * 50, "x" * 60])
    assert (keys[0] == keys[2]).all() and not (keys[0] == keys[1]).any()
    assert (keys[3] == keys[4]).all()  # one distinct shingle


def test_sketches_bound_what_differs(spark):
    lines = variants(4, prose(9, 40), 30, 6) + ["ab" * 200, "ab" * 150 + "c", "short", "x" * 3000]
    df = spark.createDataFrame([(hashlib.md5(x.encode()).digest(), x) for x in lines], "id binary, line string")
    sets = {x: {x[i:i + 8] for i in range(max(1, len(x) - 7))} for x in lines}
    found = {r.line: r for r in line_dedup.sketched(df).collect()}
    for x in lines:
        assert found[x].n == len(sets[x])
        for y in lines:
            bits = sum(((a ^ b) & (1 << 64) - 1).bit_count() for a, b in zip(found[x].sketch, found[y].sketch))
            assert bits <= len(sets[x] ^ sets[y])


def test_dedup_text_with_null_and_repeated_ids(spark):
    rows = [(None, "first line of it\nshared line here"), (None, "second line\nshared line here"), (5, "third line of it"), (5, "fourth and last\nsecond line")]
    out = line_dedup.dedup_text(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == [(5, "fourth and last"), (5, "third line of it"), (None, "first line of it\nshared line here"), (None, "second line")]


def test_lines_are_listed_once_with_their_places(spark):
    rows = [(7, "one line of it\n\nanother line"), (None, "one line of it"), (8, None), (9, "  \nlast line")]
    found = line_dedup.signatures(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    key = lambda x: hashlib.md5(x.encode()).digest()
    assert {(r.doc_id, r.line_no, bytes(r.id)) for r in found} == {(7, 0, key("one line of it")), (7, 2, key("another line")), (None, 0, key("one line of it")), (9, 1, key("last line"))}
    assert len(found) == 4 and sorted(r.n for r in found) == [0, 1, 1, 2]
    assert all(len(r.keys) == (line_dedup.BANDS if r.n else 0) for r in found)


def test_similarity_by_numbers_is_that_of_the_sets():
    sets = lambda x: {x[i:i + 8] for i in range(max(1, len(x) - 7))}
    lines = variants(2, prose(5, 30), 12, 5) + ["x" * 50, "é" * 9 + "abcdefgh", "\0" * 12, "Ā" * 9 + "abcdefghij", "short", "12345678"]
    for a in lines:
        for b in lines:
            assert similarity(a, b) == len(sets(a) & sets(b)) / len(sets(a) | sets(b))
    assert len(line_dedup._numbers("x" * 50)) == 1 and line_dedup._numbers("Ā" * 9) is None
