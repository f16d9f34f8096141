import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from rankloom.llm import minhash as M

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall("[^\\x20\\x09-\\x0d]+", (text or "").translate(LOWER))
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for n, (doc, _) in enumerate(rows):
        ids = [x for x in (least.get(root(n)), doc) if x is not None]
        least[root(n)] = min(ids, default=None)
    return Counter((doc, len(sets[n]), least[root(n)], doc == least[root(n)]) for n, (doc, _) in enumerate(rows))


def check(df, percent=85):
    got = M.near_dedup(df, percent=percent).selectExpr("doc_id", "n_shingles", "component_id", "doc_id <=> component_id").collect()
    assert Counter(map(tuple, got)) == brute([(r.doc_id, r.text) for r in df.collect()], percent)


def test_documents(documents):
    check(documents)


def test_awkward_rows(spark, awkward, nothing):
    check(awkward)
    assert M.minhash_dedup(nothing).count() == 0
    assert M.minhash_dedup(awkward).columns == ["doc_id", "n_shingles", "component_id", "kept"]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(500)}"
    return words


@pytest.mark.parametrize("percent", [85, 70])
def test_groups_of_edited_copies(spark, percent):
    """Copies around the threshold of one text and of each other, with many that are linked to few or none."""
    rng = random.Random(percent)
    base = [f"b{rng.randrange(300)}" for _ in range(150)]
    rows = [(n, " ".join(edited(rng, base, rng.randrange(9)))) for n in range(220)]
    chain = base[:100]
    for n in range(220, 260):  # each a small step from the one before
        chain = edited(rng, chain, 1)
        rows.append((n, " ".join(chain)))
    rows += [(300 + n, " ".join(base[:n])) for n in range(4, 40)] + [(400, rows[0][1].upper()), (None, rows[1][1]), (None, "   "), (401, "b1  B2"), (402, "b1 b2 ")]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), percent)


def test_shingles_and_sketches():
    rng = random.Random(5)
    texts = [" ".join(f"x{rng.randrange(40)}" for _ in range(rng.randrange(300))) for _ in range(60)] + ["a b c", "A  b\tC", "a b c d e", ""]
    for text in texts:
        assert len(M.shingles(text)) == len(shingle_set(text))
    assert np.array_equal(M.shingles("a b c"), M.shingles("A  b\tC"))
    sets = [M.shingles(t) for t in texts if t]
    sketches = M.parity_sketches(sets, M.SKETCH)
    for a, b in combinations(range(len(sets)), 2):
        bits = sum(int(x ^ y).bit_count() for x, y in zip(sketches[a].view(np.uint64).tolist(), sketches[b].view(np.uint64).tolist()))
        assert bits <= len(np.setxor1d(sets[a], sets[b]))


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = np.sort(pool[:300]), np.sort(pool[100:])
        signed = M.signatures([a, b])
        errors.append(M.estimate(*signed) - 0.5)
        assert np.array_equal(signed[0], M.signatures([a])[0])
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_one_of_each_group_stays(spark, awkward, documents):
    both = awkward.select("doc_id", "text", "lang").unionByName(documents.select("doc_id", "text", "lang").where("doc_id > 100")).repartition(4)
    rows = [tuple(r) for r in both.collect()]
    kept = M.keep_one(both)
    assert kept.columns == both.columns
    left = [r.text for r in kept.collect()]
    sets = [shingle_set(t) for t in left]
    for a, b in combinations([s for s in sets if s], 2):
        assert 100 * len(a & b) < 85 * len(a | b)
    unlinked = [t for _, t, _ in rows if not shingle_set(t)]
    assert len([t for t in left if not shingle_set(t)]) == len(unlinked)
    alone = [t for n, (_, t, _) in enumerate(rows) if not any(100 * len(shingle_set(t) & shingle_set(o)) >= 85 * len(shingle_set(t) | shingle_set(o)) > 0
                                                              for m, (_, o, _) in enumerate(rows) if m != n)]
    assert not Counter(alone) - Counter(left)
