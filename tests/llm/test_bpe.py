import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from rankloom.llm import bpe, vocabulary

LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.read_ranks(vocabulary.ranks_path()), special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(vocabulary.ranks_path(), public_tokenizers.PATTERN)


def check(df):
    got = sorted(map(repr, map(tuple, bpe.round_trip(df).collect())))
    want = []
    for r in df.collect():
        ids = LIBRARY.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(map(repr, want))


def test_documents(documents):
    check(documents)


def test_awkward_rows(awkward, nothing):
    check(awkward)
    assert bpe.round_trip(nothing).count() == 0


def test_all_characters(codec):
    texts = ["".join(chr(c) for c in range(k, k + 512) if not 0xD800 <= c < 0xE000) for k in range(0, 0x30000, 512)]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("alphabet, longest", [("ab", 300), ("aA -\n'st", 80), ("the quick", 120), ("-=_*", 200), ("éñ中ß", 60), (" \n\t", 100)])
def test_random_texts(codec, alphabet, longest):
    rng = random.Random(alphabet)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(400)]
    texts += [c * n for c in alphabet for n in (1, 2, 3, 5, 17, 255, 4096)]
    lists = codec.encode(texts)
    for text, ids in zip(texts, lists):
        assert ids.tolist() == LIBRARY.encode_ordinary(text)
    assert codec.decode(lists) == [t.encode() for t in texts]


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "KEEP_WORDS", 5)
    monkeypatch.setattr(bpe, "PORTION_BYTES", 7)
    own = bpe.Codec(vocabulary.ranks_path(), public_tokenizers.PATTERN)
    for text in ("one two three four", "five six seven eight nine ten eleven", "one two"):
        assert own.encode([text])[0].tolist() == LIBRARY.encode_ordinary(text)


def test_encode_then_decode_as_tables(spark, awkward):
    encoded = bpe.encode_documents(awkward)
    got = sorted((str(r.doc_id), bytes(r.bytes)) for r in bpe.decode_documents(encoded).collect())
    assert got == sorted((str(r.doc_id), (r.text or "").encode()) for r in awkward.collect())


def round_trips(codec, texts):
    """Ids as the library's and bytes as the texts', taken run by run as the query does."""
    ids, data = [[] for _ in texts], [[] for _ in texts]
    for run in codec.runs(texts):
        for (n, x), b in zip(run, codec.decode([x for _, x in run])):
            ids[n].append(x)
            data[n].append(b)
    for text, x, b in zip(texts, ids, data):
        assert b"".join(b) == text.encode()
        assert np.array_equal(np.concatenate([np.zeros(0, np.uint32), *x]), np.array(LIBRARY.encode_ordinary(text), np.uint32))


def test_runs_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "RUN_CHARS", 40)
    monkeypatch.setattr(bpe, "RUN_WORDS", 3)
    monkeypatch.setattr(bpe, "DECODE_IDS", 5)
    own = bpe.Codec(vocabulary.ranks_path(), public_tokenizers.PATTERN)
    round_trips(own, ["", "short", "a text of more than forty characters, read a few words at a time é中", "", "x" * 100, "one two three four five", " "])


def test_a_very_long_text(codec):
    rng = random.Random(9)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    round_trips(codec, [" ".join(rng.choice(words) for _ in range(4_000_000))])  # 22 MB


def test_a_batch_dense_in_tokens(codec):
    """Every character is several tokens."""
    rng = random.Random(10)
    round_trips(codec, ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(2000)) for _ in range(600)])


def test_a_long_varied_word(codec):
    rng = random.Random(11)
    round_trips(codec, ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))])


def test_decode_any_ids(codec):
    rng = random.Random(1)
    lists = [np.array([rng.randrange(50256) for _ in range(n)], np.uint32) for n in (0, 1, 50, 3000)]
    assert codec.decode(lists) == [LIBRARY.decode_bytes(x.tolist()) for x in lists]
