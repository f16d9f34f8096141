import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from rankloom.llm import packing, vocabulary

OWN = Tokenizer.from_file(vocabulary.byte_bpe_path())


def ids(text):
    return OWN.encode(text or "", add_special_tokens=False).ids + [2]


def check(df, length=1024):
    rows = packing.pack(df, length).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
        assert 1 <= r.length <= length
    for placed in sequences.values():  # gapless from 0
        at = 0
        for offset, size in sorted(placed):
            assert offset == at
            at += size
        assert at <= length
    copies = defaultdict(list)
    for r in df.collect():
        copies[r.doc_id].append(r.text)
    assert set(docs) == set(copies)
    for i, texts in copies.items():
        want = []
        for text in texts:
            own = np.array(ids(text), "<u4")
            first = len(own) % length or length
            cuts = [0, *range(first, len(own) + 1, length)]
            want += [(n, a, b - a, zlib.crc32(own[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in docs[i]) == sorted(want)
    total = sum(r.length for r in rows)
    return len(sequences), -(-total // length)


def test_documents(documents):
    used, least = check(documents)
    assert used <= least * 1.05 + 1


def test_awkward_rows(awkward, nothing):
    check(awkward)
    assert packing.pack(nothing).count() == 0


def test_short_sequences(awkward, documents):
    check(awkward, 16)
    check(documents, 128)


def expanded(counts, length):
    """Every piece's place by the runs."""
    runs = sorted(packing.best_fit(counts, length))
    places = defaultdict(list)
    for k, (size, rank, each, first, offset) in enumerate(runs):
        after = runs[k + 1][1] if k + 1 < len(runs) and runs[k + 1][0] == size else counts[size]
        assert after > rank
        places[size] += [(first + n // each, offset + n % each * size) for n in range(after - rank)]
    return places


def decreasing(counts, length):
    """Best-fit decreasing, piece by piece."""
    gaps = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            fit = min((g for g in gaps if g >= size), default=None)
            if fit is None:
                gaps.append(length - size)
            else:
                gaps[gaps.index(fit)] -= size
    return sorted(gaps)


@pytest.mark.parametrize("seed", range(30))
def test_runs_are_best_fit_decreasing(seed):
    rng = random.Random(seed)
    length = rng.choice([8, 20, 64])
    counts = {s: rng.randrange(1, 40) for s in rng.sample(range(1, length + 1), rng.randrange(1, min(9, length)))}
    used = defaultdict(list)
    for size, places in expanded(counts, length).items():
        assert len(places) == counts[size]
        for sequence, offset in places:
            used[sequence].append((offset, size))
    for placed in used.values():
        at = 0
        for offset, size in sorted(placed):
            assert offset == at
            at += size
        assert at <= length
    assert sorted(length - sum(s for _, s in p) for p in used.values()) == decreasing(counts, length)


def test_encoder_is_the_tokenizer():
    encode = vocabulary.encoder(vocabulary.byte_bpe_path())
    rng = random.Random(3)
    texts = ["", " ", "<|endoftext|>", "a<|endoftext|>b", "a" * 3000, "'s 'S it's", "\r\n\t x\u00a0y\u3000z\u2028"]
    texts += ["".join(chr(c) for c in range(k, k + 256) if not 0xD800 <= c < 0xE000) for k in range(0, 0x11000, 256)]
    texts += ["".join(rng.choice("ab '\ns1é中\u0301\U0001f600") for _ in range(40)) for _ in range(500)]
    for text in texts:
        assert encode(text).tolist() == OWN.encode(text, add_special_tokens=False).ids, repr(text[:50])


def test_many_rows_of_one_length_without_ids(spark):
    """They are dealt out over many tasks, and packed all the same."""
    from rankloom.llm.common import Scratch
    from pyspark.sql import functions as F
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    df = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same text again").alias("text")).repartition(4)
    with Scratch(spark) as files:
        placed, _, _, counts = packing.ranked(files, files(packing.pieces(df).withColumn("row", F.monotonically_increasing_id())))
        parts = [r["count"] for r in placed.groupBy("part").count().collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(counts) == 1 and len(parts) > 2 and max(parts) < 2000
    size = len(ids("the same text again"))
    assert packing.pack(df).select("sequence_id").distinct().count() == -(-4000 // (1024 // size))
