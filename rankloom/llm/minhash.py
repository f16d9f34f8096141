"""MinHash near-dedup with min-max hashing.

A text's A-Z are lowered and its words are runs of characters other than space and U+0009-U+000D; its set holds the
distinct shingles of ``SHINGLE`` words (fewer words: the whole sequence).  Documents whose sets have a Jaccard
similarity of ``PERCENT`` hundredths or more are linked, and linked documents form components.

1. Signature.  A shingle is a 64-bit number made of its words' XXH64.  Under each of ``PERMUTATIONS`` permutations both
   the least and the greatest value of the set are kept: two unbiased coordinates for one hash evaluation, of lower
   variance than two independent minima.  ``BANDS`` bands of ``ROWS`` coordinates give the bucket keys; a
   pair at the threshold shares a key with probability 1 - (1 - 0.85 ** 6) ** 32 = 0.9999997.
2. Equal sets are one node (128-bit digest).  A set so small that one shingle more or less takes it below the
   threshold can equal others, not resemble them, and gets no keys.
3. Buckets.  Each node of a bucket is held against the bucket's pivot, the node with most documents: no pairs within
   a bucket.  A pair is passed over if sizes or parity sketches (see ``sketches``) show that the sets differ in too many shingles.
4. Each node's nearest pivot is confirmed on the full sets, and what is confirmed goes to union-find.  In buckets whose
   nodes are not all in one component by then, nodes of different components meet under the same test of sizes and
   sketches, and the few pairs that pass are confirmed on the full sets too.  No bucket is cut short.

Full sets are made from the texts of the nodes in question only, found again by the texts' MD5.

Edge cases.  A null or empty text, or one without words, has an empty set and is linked with nothing; its component is
its own id.  Very long texts are shingled whole.  Rows with equal ids are rows of their own, with one answer each;
``component_id`` is the least id of the component that is not null, null if it has none.  Ties between pivots go to the
least row.  An empty table gives no rows.  Columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, checked_broadcast, map_arrow, numbered, whole_text, without_ids
from .components import components
from .sketches import differing_bits, may_reach, parity_sketches, side

SHINGLE, PERCENT = 5, 85
PERMUTATIONS, BANDS, ROWS = 96, 32, 6  # 2 * PERMUTATIONS = BANDS * ROWS
SKETCH = 1024  # bits
PORTION = 200_000  # shingles signed at a time, but a text is never cut
KEEP_WORDS = 100_000  # hashes of words that a worker keeps

_rng = np.random.default_rng(13)
_PLACES = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)  # shingles of 64 words at most
_FACTORS = _rng.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Hashes(dict):
    """Word -> XXH64; starts anew when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEEP_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_words = _Hashes()


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text, as sorted 64-bit numbers."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))], np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += hashes[k:k + n] * _PLACES[k]
    return np.unique(_mixed(total))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """``len(sets) x 2 * PERMUTATIONS``: the least values under each permutation, then the greatest; no set is empty."""
    sizes = np.array([len(x) for x in sets])
    firsts = np.cumsum(sizes) - sizes
    values = (np.concatenate(sets) >> _U(32)).astype(np.uint32)
    out = np.empty((len(sets), 2 * PERMUTATIONS), np.uint32)
    for n in range(PERMUTATIONS):
        permuted = values * _FACTORS[n]
        out[:, n] = np.minimum.reduceat(permuted, firsts)
        out[:, PERMUTATIONS + n] = np.maximum.reduceat(permuted, firsts)
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """The similarity that two signatures show."""
    return float(np.mean(a == b))


def band_keys(signed: np.ndarray) -> np.ndarray:
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signed), 1))
    rows = signed.reshape(len(signed), BANDS, ROWS).astype(np.uint64)
    for row in range(ROWS):
        keys = _mixed(keys * _U(0x9E3779B97F4A7C15) + rows[:, :, row])
    return keys.view(np.int64)


def _portions(texts, size: int):
    """``(first, sets)`` of consecutive texts."""
    first, sets, total = 0, [], 0
    for n, text in enumerate(texts):
        sets.append(shingles(text.as_py(), size))
        total += len(sets[-1])
        if total >= PORTION:
            yield first, sets
            first, sets, total = n + 1, [], 0
    if sets:
        yield first, sets


def least_size(percent: int) -> int:
    """Sets of this size and over can resemble a different set: n of n + 1 is enough."""
    return -(-percent // (100 - percent))


def signed_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with its column ``text`` replaced by ``n``, ``digest`` (null: empty set), ``keys`` (null: none) and ``sketch``."""
    others = [c for c in docs.columns if c != "text"]
    schema = T.StructType([*(docs.schema[c] for c in others), *T.StructType.fromDDL("n long, digest binary, keys array<long>, sketch array<long>").fields])

    def run(batches):
        for batch in batches:
            for first, sets in _portions(batch.column(len(others)), size):
                rows = len(sets)
                ns = np.array([len(x) for x in sets])
                digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
                able = np.flatnonzero(ns >= least_size(percent))
                keys, sketch = np.zeros((0, BANDS), np.int64), np.zeros((0, SKETCH // 64), np.int64)
                if len(able):
                    kept = [sets[n] for n in able]
                    keys, sketch = band_keys(signatures(kept)), parity_sketches(kept, SKETCH)
                has = np.zeros(rows, bool)
                has[able] = True

                def lists(values):
                    ends = np.concatenate([[0], np.cumsum(has * values.shape[1])]).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()), mask=pa.array(~has))

                yield pa.RecordBatch.from_arrays([*(c.slice(first, rows) for c in batch.columns[:-1]), pa.array(ns, pa.int64()), pa.array(digests, pa.binary()),
                                                  lists(keys), lists(sketch)], names=schema.names)

    return map_arrow(docs.select(*others, whole_text().alias("text")), run, schema)


def _confirmed(files: Scratch, pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose full sets reach the threshold."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t.as_py(), size).view(np.int64) for t in batch.column(1)], pa.list_(pa.int64()))],
                                             names=["md5", "shingles"])

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", "md5"), "node")
    wanted = files(wanted)
    texts = docs.select("md5", "text").join(checked_broadcast(wanted.select("md5")), "md5", "left_semi").dropDuplicates(["md5"])
    sets = files(map_arrow(texts, run, "md5 binary, shingles array<long>").join(wanted, "md5").select("node", "shingles"))
    both = (pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    out = files(both.where(common * 100 >= (F.size("sa") + F.size("sb") - common) * percent).select("a", "b"))
    files.drop(sets)
    return out


def node_components(files: Scratch, nodes: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(node, component)`` of the nodes that are linked to another; ``nodes``: a written table of node, docs, n, md5, keys, sketch;
    ``docs``: md5 and text."""
    rows = nodes.where("keys IS NOT NULL").select("node", "docs", F.explode("keys").alias("key"))
    pivots = rows.groupBy("key").agg(F.max(F.struct("docs", (-F.col("node")).alias("first"))).alias("top"), F.min("node").alias("low"), F.max("node").alias("high"))
    pivots = files(pivots.where("low < high").select("key", (-F.col("top.first")).alias("pivot")))
    members = files(rows.select("node", "key").join(pivots, "key"))
    stars = members.where("node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    near = may_reach(percent, SKETCH)
    tested = files(stars.join(side(nodes, "a", SKETCH), "a").join(side(nodes, "b", SKETCH), "b").where(near).select("a", "b", differing_bits(SKETCH).alias("bits")))
    # One pivot of a node will do here: what that leaves apart meets again below.
    nearest = files(tested.groupBy("a").agg(F.min(F.struct("bits", "b")).alias("x")).select("a", F.col("x.b").alias("b")))
    groups = components(_confirmed(files, nearest, nodes, docs, size, percent))
    own = members.select("key", "node").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = own.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    own = files(own.join(several, "key").join(nodes.select("node", "n", "sketch"), "node"))
    a, b = (side(own, name, SKETCH, "node", "key", F.col("component").alias(name + "c")) for name in "ab")
    met = a.join(b, "key").where((F.col("a") < F.col("b")) & (F.col("ac") != F.col("bc")) & near)
    more = _confirmed(files, files(met.select("a", "b").distinct()), nodes, docs, size, percent)
    return components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))


def near_dedup(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, linked)`` per input row, a written table; ``linked``: whether it has words and so a set."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.unhex(F.md5(F.encode(whole_text(text), "UTF-8"))).alias("md5"))
    with Scratch(docs.sparkSession) as files:
        rows = files(signed_documents(docs.select("doc_id", "md5", "text"), size, percent).withColumn("row", F.monotonically_increasing_id()))
        nodes = files(rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("node"), F.count("*").alias("docs"), F.min("doc_id").alias("least"),
                                                                             F.min(F.struct("md5", "n", "keys", "sketch")).alias("own"))
                      .select("digest", "node", "docs", "least", "own.*"))
        groups = node_components(files, nodes, docs, size, percent)
        label = files(nodes.select("digest", "node", "least").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node")))
        least = label.groupBy("component").agg(F.min("least").alias("component_id"))
        label = files(label.join(least, "component").select("digest", "component_id"))
        found = rows.select("doc_id", "n", "digest").join(label, "digest", "left")
        own = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return files.keep(files(found.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), F.col("digest").isNotNull().alias("linked"))))


def minhash_dedup(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return near_dedup(docs).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component, with all its columns: that with the least id (null after any), of these the first; rows
    without words stay.  Rows are judged by number, so ids may be null or repeated."""
    with Scratch(docs.sparkSession) as files:
        table, row = numbered(files, docs)
        order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
        judged = near_dedup(table.select(order.alias("place"), "text"), percent=percent, key="place")
        dropped = files(judged.where("doc_id.row != component_id.row").select(F.col("doc_id.row").alias(row)))
        return without_ids(files.keep(table), files.keep(dropped), row).select(*docs.columns)


# All pairs that share a shingle are counted; equal sets and links are followed to the least id.
SQL = f"""
WITH RECURSIVE texts AS MATERIALIZED (
  SELECT row_number() OVER () AS n, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT n, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {SHINGLE} + 2), lambda k: array_to_string(w[k:k + {SHINGLE} - 1], ' ')) END) AS shingle FROM texts),
sizes AS (SELECT n, count(*) AS size FROM shingles GROUP BY n),
common AS (SELECT x.n AS a, y.n AS b, count(*) AS shared FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.n <> y.n GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes p ON p.n = a JOIN sizes q ON q.n = b WHERE 100 * shared >= {PERCENT} * (p.size + q.size - shared)),
reach AS (SELECT n, n AS other FROM texts UNION SELECT reach.n, links.b FROM reach JOIN links ON links.a = reach.other),
least AS (SELECT reach.n, min(doc_id) AS component_id FROM reach JOIN texts ON texts.n = reach.other GROUP BY reach.n)
SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM texts JOIN least USING (n) LEFT JOIN sizes USING (n)
"""
