import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from rankloom.llm import resampling as R

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, words + [" ".join(p) for p in zip(words, words[1:])]


def brute(docs, target, percent=25):
    source, wanted = ([features(t) for t in texts] for texts in ([t for _, t in docs], target))
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (Counter(bucket(f) for _, fs in side for f in fs) for side in (source, wanted))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (S + 10000.0) / ((s[b] + 1.0) * (T + 10000.0))))
    rows = []
    for (doc, _), (words, fs) in zip(docs, source):
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for n, row in enumerate(able[:percent * len(able) // 100]):
        row[4] = n + 1
    return Counter(tuple(r[:5]) for r in rows)


def interned(texts):
    return list(R._portions(pa.array(texts, pa.string()), R.NGRAM, R.BUCKETS))


def spelled(found, n):
    return found.buffer[found.at[n]:found.at[n] + found.sizes[n]].tobytes().decode()


def test_documents(spark, documents):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [r.text for r in target.collect()])
    assert Counter(map(tuple, R.importance(documents, target).collect())) == want


def test_awkward_rows(spark, awkward, nothing):
    long = spark.createDataFrame([(50, "İx y9 " * 9, "a"), (50, "İx y9 " * 12, "a"), (None, "aa bb " * 30, "b"), (None, "aa bb " * 30, "b")], "doc_id long, text string, lang string")
    both = awkward.select("doc_id", "text").union(long.select("doc_id", "text")).repartition(4)
    target = spark.createDataFrame([("The quick brown fox", 1), (None, 2), ("", 3)], "text string, row int")
    for percent in (25, 100):
        want = brute([tuple(r) for r in both.collect()], [r.text for r in target.collect()], percent)
        assert Counter(map(tuple, R.importance(both, target, percent).collect())) == want
    assert R.importance(awkward, target).count() == awkward.count()
    assert R.importance(nothing, target).count() == 0
    no_target = R.importance(both, target.limit(0))
    assert Counter(map(tuple, no_target.collect())) == brute([tuple(r) for r in both.collect()], [])


def test_drawn_documents_keep_their_columns(spark, documents):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    clashing = documents.selectExpr("*", "1 AS row_number", "2 AS row", "3 AS rank", "4 AS part")
    drawn = R.resampled(clashing, target)
    assert drawn.columns == clashing.columns
    ids = {r.doc_id for r in R.importance(documents, target).where("rank IS NOT NULL").collect()}
    assert {r.doc_id for r in drawn.collect()} == ids and ids


def test_features_of_all_characters():
    texts = ["".join(chr(c) + random.Random(c).choice(" a.") for c in range(k, k + 300) if not 0xD800 <= c < 0xE000) for k in range(0, 0x3000, 300)] + ["", "A", "x" * 99 + " y"]
    (at, found), = interned(texts)
    got = [[] for _ in texts]
    for n, text in enumerate(at):
        got[text].append(spelled(found, n))
    assert [Counter(g) for g in got] == [Counter(features(t)[1]) for t in texts]


def test_hashes_are_xxh64():
    rng = random.Random(0)
    parts = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(0, 80)] * 3]
    starts = np.cumsum([0, *map(len, parts)])[:-1]
    sizes = np.array([len(p) for p in parts])
    found = R.Interned(np.frombuffer(b"".join(parts), np.uint8), starts, sizes)
    assert found.hashes.tolist() == [xxhash.xxh64_intdigest(p) for p in parts]


@pytest.mark.parametrize("key", [None, 0, 1 << 63])
def test_counts_even_if_keys_collide(key):
    """All features with one key: only the bytes tell them apart."""
    texts = ["a b a b c " * 5, "prefix prefixes prefix " + "z" * 40 + " " + "z" * 41 + " " + "z" * 40, "b a"]
    (at, found), = interned(texts)
    if key is not None:
        found = R.Interned(found.buffer, found.at, found.sizes, hashes=np.full(len(found.starts), key, np.uint64))
    got = Counter()
    for slot in found.taken:
        text = spelled(found, found.owner[slot])
        got[text] += found.count[slot]
        assert found.bucket[slot] == zlib.crc32(text.encode()) % R.BUCKETS
    assert got == sum((Counter(features(t)[1]) for t in texts), Counter())


@pytest.mark.parametrize("ngram", [1, 2, 3])
def test_pieces_and_portions_change_nothing(monkeypatch, ngram):
    rng = random.Random(3)
    texts = ["one two three. Two three four", "", "five", "a " * 50, "x" * 100, "é" * 70 + " " + "b" * 30 + "\n\n" + "c d. " * 9, "  ", "tail"]
    texts += ["".join(rng.choice("ab, ") for _ in range(rng.randrange(90))) for _ in range(60)]
    want = None
    for piece, portion in ((2 << 20, 200_000), (1, 200_000), (7, 200_000), (64, 1), (30, 7)):
        monkeypatch.setattr(R, "PIECE", piece)
        monkeypatch.setattr(R, "PORTION", portion)
        got = Counter()
        single = Counter()
        for at, found in R._portions(pa.array(texts), ngram, R.BUCKETS):
            got.update((text, spelled(found, n)) for n, text in enumerate(at.tolist()))
            single.update(at[:found.single].tolist())
        want = want or got
        assert got == want
        assert single == Counter({n: len(WORD.findall(t)) for n, t in enumerate(texts) if WORD.findall(t)})


def test_long_text_in_pieces():
    text = " ".join(str(n % 5000) for n in range(900_000))
    found = interned([text])
    assert len(found) > 2 and sum(len(at) for at, _ in found) == 2 * 900_000 - 1
