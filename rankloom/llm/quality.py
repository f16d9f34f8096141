"""Quality classifier from weak labels.

1. Overlapping heuristic labellers vote good, bad or nothing on every document.
2. Expectation-maximisation estimates, over all documents, how often each labeller says what about good
   and about bad documents (Dawid and Skene's model).  It works on the counts of vote patterns, of
   which there are at most 3 ** labellers whatever the input, and gives every pattern its posterior.
3. A linear scorer over hashed features (words, word shapes, word ends, repeats) is trained on the
   posteriors of a sample of at most about ``SAMPLE`` documents, drawn by a hash of the id.
4. Every document is scored on its whole text; it is kept at a score (probability of being
   good) of ``THRESHOLD`` or more.

No labelled rows are used; the tests hold the result against the ``labels`` table.

Edge cases: a null text is the empty text; a document without words, or a corpus where nothing is
voted bad, is kept with the score of the corpus prior.  Repeated and null ids are scored row by row; very long texts
whole.  No ties arise: every row has its own verdict, a score at the threshold is kept.  An
empty table gives no rows.  Extra columns pass through ``keep_good`` untouched.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, whole_text

HASH_BITS = 18
SAMPLE = 4096
THRESHOLD = 0.5
FEW_WORDS = 4
ABSTAIN, GOOD, BAD = 0, 1, 2

_LETTERS = bytes(b for b in range(256) if chr(b).isalpha() or b >= 128)
_CAPITALS = bytes(range(65, 91))
_PLAIN = _LETTERS + b"0123456789 \t\n\r\x0b\x0c.,;:!?'\"()-"
_SHOUTED = re.compile(rb"!!(?=\s|\Z)")
_BARS = re.compile(rb"(?<!\S)[|/\-_=*#>~+]+(?!\S)")
# Shape of a byte: A, a (also bytes of other letters), 0, or the byte itself.
_SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))


def measures(data: bytes, words: list[bytes]) -> tuple[float, ...]:
    """Shares, from 0 to 1, that the labellers look at."""
    n, low = len(words), data.lower().split()
    lasts = bytes([w[-1] for w in words])
    same, like = (list(map(operator.eq, x, x[1:])) for x in (words, low))
    letters = len(data) - len(data.translate(None, _LETTERS))
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    odd = len(data.translate(None, _PLAIN))
    return (odd / len(data),
            len(lasts.translate(None, _PLAIN)) / n,
            capitals / max(1, letters),
            len(_SHOUTED.findall(data)) / n,
            len(_BARS.findall(data)) / n,
            sum(same) / n,
            sum(map(operator.or_, [False, *like], [*like, False])) / n,
            len(set(words)) / n,
            sum(map(lasts.count, b".!?")) / n)


# Per measure: at or above the first bound bad, at or below the second good, between them no vote.  Where
# the bounds are the other way round, low is bad.  The last number is the fewest words for a vote.
LABELLERS = (
    ("symbols", 0.10, 0.03, 1),
    ("odd_ends", 0.30, 0.10, 3),
    ("capitals", 0.50, 0.15, 5),
    ("shouting", 0.30, 0.05, 3),
    ("bars", 0.15, 0.03, 5),
    ("repeats", 0.25, 0.05, 5),
    ("runs", 0.40, 0.08, 5),
    ("variety", 0.15, 0.40, 60),
    ("sentences", 0.005, 0.03, 60),
)


def votes(data: bytes, words: list[bytes]) -> int:
    """The labellers' votes as one number, a base-3 digit each."""
    code = 0
    seen = measures(data, words) if words else ()
    for (_, bad, good, least), x in zip(LABELLERS, seen):
        low = bad < good
        vote = BAD if (x <= bad if low else x >= bad) else GOOD if (x >= good if low else x <= good) else ABSTAIN
        code = code * 3 + (vote if len(words) >= least else ABSTAIN)
    return code


def digits(code: int) -> list[int]:
    return [code // 3 ** k % 3 for k in range(len(LABELLERS) - 1, -1, -1)]


def features(data: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature numbers and their weights: shares of the words, smaller where there are few words, so
    that a short text's score stays near the bias."""
    counts = Counter(words)
    counts.update(b"\0s" + s for s in data.translate(_SHAPE).split())
    counts.update(b"\0e" + w[-3:] for w in words)
    counts[b"\0r"] = sum(a == b for a, b in zip(words, words[1:]))
    crc = zlib.crc32
    at = np.fromiter((crc(w) & (1 << HASH_BITS) - 1 for w in counts), np.int64, len(counts))
    return at, np.fromiter(counts.values(), np.float64, len(counts)) / (len(words) + FEW_WORDS)


@dataclass
class Model:
    """Posteriors by vote pattern, and the trained scorer."""

    posterior: dict[int, float]
    rates: np.ndarray        # labeller x class (bad, good) x vote; of those that vote
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, data: bytes, words: list[bytes]) -> float:
        if not words:
            return self.prior
        at, share = features(data, words)
        return float(1 / (1 + np.exp(-np.clip(self.weights[at] @ share + self.bias, -30, 30))))


def estimate(patterns: dict[int, int], rounds: int = 200, tolerance: float = 1e-9) -> tuple[dict[int, float], np.ndarray, float]:
    """Expectation-maximisation over pattern counts: posterior of good, vote rates, prior of good.

    A labeller that does not vote says nothing about the class.  Labellers are taken to say bad of more bad
    documents than of good ones when it starts; a small count is added to every rate, so that
    no vote is impossible.
    """
    codes = sorted(patterns)
    n = np.array([patterns[c] for c in codes], float)
    seen = np.array([digits(c) for c in codes], int).reshape(len(codes), len(LABELLERS))
    rates = np.array([[[1.0, 0.6, 0.4], [1.0, 0.97, 0.03]]] * len(LABELLERS))  # nothing said: no evidence
    prior = 0.8
    good = np.full(len(codes), prior)
    for _ in range(rounds):
        logs = np.log(rates)[np.arange(len(LABELLERS)), :, seen].sum(axis=1)  # pattern x class
        odds = logs[:, 1] - logs[:, 0] + np.log(prior / (1 - prior))
        now = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        moved, good = np.abs(now - good).max(initial=0), now
        prior = float(np.clip((n @ good + 1) / (n.sum() + 2), 1e-4, 1 - 1e-4))
        for vote in (GOOD, BAD):
            has = (seen == vote).T * n
            rates[:, 1, vote] = has @ good + 0.5
            rates[:, 0, vote] = has @ (1 - good) + 0.5
        rates[:, :, GOOD:] /= rates[:, :, GOOD:].sum(axis=2, keepdims=True)
        if moved < tolerance:
            break
    return dict(zip(codes, good.tolist())), rates, prior


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 300, rate: float = 2.0, decay: float = 1e-6) -> tuple[np.ndarray, float]:
    """Logistic regression on (feature numbers, shares, target) by AdaGrad over the whole sample."""
    weights, bias = np.zeros(1 << HASH_BITS), 0.0
    if not rows:
        return weights, bias
    at = np.concatenate([r[0] for r in rows])
    share = np.concatenate([r[1] for r in rows]).astype(float)
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    target = np.array([r[2] for r in rows])
    used, at = np.unique(at, return_inverse=True)
    w, g2, b2 = np.zeros(len(used)), np.full(len(used), 1e-8), 1e-8
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[at] * share, len(rows)) + bias, -30, 30)))
        error = (p - target) / len(rows)
        g = np.bincount(at, error[row] * share, len(used)) + decay * w
        g2 += g * g
        w -= rate * g / np.sqrt(g2)
        b2 += error.sum() ** 2
        bias -= 0.2 * error.sum() / np.sqrt(b2)
    weights[used] = w
    return weights, float(bias)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text"))


def _parsed(value: str) -> tuple[bytes, list[bytes]]:
    data = value.encode("utf-8", "surrogatepass")
    return data, data.split()


def fit(docs: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text") -> Model:
    """Votes of all documents, their model, and the scorer trained on the sample."""
    def vote(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([votes(*_parsed(t.as_py())) for t in batch.column(0)], pa.int32())], names=["pattern"])

    counted = map_arrow(_texts(docs, key, text).select("text"), vote, "pattern int").groupBy("pattern").count().collect()
    patterns = {r["pattern"]: r["count"] for r in counted}
    posterior, rates, prior = estimate(patterns)
    share = min(1.0, sample / max(1, sum(patterns.values())))

    def extract(batches):
        for batch in batches:
            parsed = [_parsed(t.as_py()) for t in batch.column(1)]
            rows = [features(*p) for p in parsed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([votes(*p) for p in parsed], pa.int32()), pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32()))], names=["draw", "pattern", "at", "share"])

    # A 32-bit draw per document; its share of them is the sample.
    draw = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 32))
    sampled = _texts(docs, key, text).withColumn("draw", draw).where(F.col("draw") < int(share * (1 << 32))).select("draw", "text")
    # Rows that draw alike, such as repeats, are one row of the sample, and a quarter over the expected size is its bound.
    sampled = sampled.groupBy("draw").agg(F.min("text").alias("text")).orderBy("draw").limit(sample + sample // 4)
    drawn = map_arrow(sampled, extract, "draw long, pattern int, at array<int>, share array<float>").toArrow()
    rows = []
    for batch in drawn.to_batches():
        draws, codes = batch.column("draw").to_pylist(), batch.column("pattern").to_pylist()
        at, shares = batch.column("at"), batch.column("share")
        rows += [(draws[i], codes[i], at[i].values.to_numpy(), shares[i].values.to_numpy()) for i in range(batch.num_rows)]
    rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
    weights, bias = train([(at, share, posterior[code]) for _, code, at, share in rows])
    return Model(posterior, rates, weights, bias, prior)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, pattern, posterior, score)`` per input row."""
    def run(batches):
        for batch in batches:
            parsed = [_parsed(t.as_py()) for t in batch.column(1)]
            codes = [votes(*p) for p in parsed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(codes, pa.int32()), pa.array([model.posterior.get(c) for c in codes], pa.float64()),
                 pa.array([model.score(*p) for p in parsed], pa.float64())], names=schema.names)

    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField("pattern", T.IntegerType()),
                           T.StructField("posterior", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return map_arrow(_texts(docs, key, text), run, schema)


def classify(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, votes (one letter per labeller: g, b or -), posterior, score, kept."""
    judged = score(docs, fit(docs))
    letters = F.concat(*(F.element_at(F.array(F.lit("-"), F.lit("g"), F.lit("b")),
                                      (F.floor(F.col("pattern") / 3 ** k) % 3 + 1).cast("int")) for k in range(len(LABELLERS) - 1, -1, -1)))
    return judged.select("doc_id", letters.alias("votes"), "posterior", "score", (F.col("score") >= threshold).alias("kept"))


def keep_good(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, as they are; rows do not move."""
    model, at = fit(docs), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            good = [model.score(*_parsed(t.as_py() or "")) >= threshold for t in batch.column(at)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return map_arrow(docs, run, docs.schema)
