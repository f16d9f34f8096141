import random
import re

import numpy as np
import xxhash

from rankloom.llm import simhash
from rankloom.llm.common import Scratch
from rankloom.llm.components import components


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, bits=2):
    """Component number of every fingerprint, by comparing all pairs."""
    fps = np.array(fps, dtype=np.uint64)
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in np.nonzero(np.bitwise_count(fps ^ fps[i]) <= bits)[0]:
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def check(df):
    rows = df.collect()
    fps = [fingerprint(r.text) for r in rows]
    least = {}
    for r, g in zip(rows, groups(fps)):
        least[g] = min((x for x in (least.get(g), r.doc_id) if x is not None), default=None)
    want = [(r.doc_id, f"{f:016x}", least[g]) for r, f, g in zip(rows, fps, groups(fps))]
    assert sorted(map(repr, map(tuple, simhash.simhash_dedup(df).collect()))) == sorted(map(repr, want))


def test_documents(documents):
    check(documents)


def test_awkward_rows(awkward, nothing):
    check(awkward)
    assert simhash.simhash_dedup(nothing).count() == 0


def test_linked_texts(spark):
    words = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(60):  # chains of small edits, and unrelated texts
        own = list(words)
        for j in range(k % 12):
            own[(k * 7 + j) % 400] = f"e{j}"
        rows.append((100 - k, " ".join(own)))
    rows += [(200 + k, " ".join(random.Random(k).choices(words, k=50))) for k in range(40)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def linked(spark, fps, **more):
    df = spark.createDataFrame([(int(np.int64(np.uint64(f))),) for f in fps], "fp long")
    with Scratch(spark) as files:
        found = {r.node: r.component for r in components(simhash.links(files, df, **more)).collect()}
    signed = [int(np.int64(np.uint64(f))) for f in fps]
    want = {}
    for s, g in zip(signed, groups(fps, more.get("bits", 2))):
        want.setdefault(g, []).append(s)
    for members in want.values():
        assert {found.get(s, s) for s in members} == {min(members)}
    # Nothing else is linked.
    assert len({found.get(s, s) for s in signed}) == len(want)


def near(seed, centres, each, bits):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        base = rng.getrandbits(64)
        for _ in range(each):
            out.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(bits + 1))))
    return sorted(out)


def test_links_lose_no_pair(spark):
    linked(spark, near(1, 40, 8, 3))


def test_crowded_points(spark):
    fps = near(2, 2, 300, 4)
    linked(spark, fps)
    linked(spark, fps, crowd=2)
    linked(spark, fps, crowd=10_000)


def test_other_distances(spark):
    linked(spark, near(3, 20, 10, 4), bits=3)
    linked(spark, near(4, 20, 10, 3), bits=1)


def test_pivot_distances_bound_the_bits():
    rng = random.Random(5)
    refs = [r % (1 << 64) for r in simhash.references()]
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << n for n in rng.sample(range(64), rng.randrange(6)))
        assert max(abs((a ^ r).bit_count() - (b ^ r).bit_count()) for r in refs) <= (a ^ b).bit_count()


def test_keep_one(awkward, documents, nothing):
    for df in (awkward, documents):
        out = simhash.keep_one(df)
        assert out.schema == df.schema
        want = {r.component_id for r in simhash.simhash_dedup(df).collect() if r.doc_id is not None}
        assert {r.doc_id for r in out.collect() if r.doc_id is not None} == want
    assert simhash.keep_one(nothing).count() == 0


def test_components_of_a_path_a_hub_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 1000 + i) for i in range(500)] + [(7, 7), (9, 8), (8, 9)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {1000 + i: 5 for i in range(500)} | {5: 5, 8: 8, 9: 8}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_with_null_and_repeated_ids(spark):
    words = [random.Random(k).choices([f"w{i}" for i in range(400)], k=60) for k in range(6)]
    a, b, c, d, e, f = map(" ".join, words)
    rows = [(None, a), (None, a.upper()), (None, b), (1, c), (1, d), (1, c + " "), (2, d), (None, d), (3, e), (None, f)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = simhash.keep_one(df).collect()
    assert sorted((r.text.lower().strip(), r.doc_id) for r in out if r.doc_id is not None) == sorted([(c, 1), (d, 1), (e, 3)])
    assert sorted(r.text.lower() for r in out if r.doc_id is None) == sorted([a, b, f])
