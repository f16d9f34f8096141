"""Target-distribution importance resampling over hashed n-grams.

A document's features are all runs of 1 to ``NGRAM`` consecutive words, repeats counted; a feature belongs to the
bucket CRC-32 of its UTF-8 bytes modulo ``BUCKETS``.  How much more often the target texts use a bucket than
all documents do is its gain; a document's weight is the mean gain of its features, and documents are drawn without
replacement by weight plus Gumbel noise (the highest scores win).

Interning.  Each portion of a batch has its n-grams interned in an open-addressed NumPy table: XXH64 of a feature's
bytes is its key, a slot is looked for by linear probing, for all features at once, and a feature takes a slot only
if its bytes equal those of the slot's owner.  A slot holds its owner, bucket and count, so CRC-32 is
worked out once per distinct feature, and counts and gains are gathered by the occurrences' slot ids.

Two passes over the texts: bucket counts (one row per bucket and task), then weights.  Only bucket counts come
to the driver, at most ``BUCKETS`` numbers for each side.  Ranks come from one range-partitioned sort of narrow rows
and the row counts of its partitions.

Edge cases.  A null or empty text, or one without words, has no features and weight 0; it is scored, but as it has under
``MIN_WORDS`` words never drawn.  Very long texts are cut between words into pieces of ``PIECE`` bytes, which
changes no count.  Ties in the score go to the smaller id (null first), then to either row.  Repeated rows are documents of their own.
A null id draws noise as an empty one.  An empty table gives no rows, an empty target table zero target counts.  Columns
other than the id and the text are not read, whatever their names (``resampled`` hands them through).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, map_arrow, numbered, whole_text

NGRAM, BUCKETS, MIN_WORDS, PERCENT, SEED = 2, 10_000, 20, 25, 7
PORTION = 200_000  # words interned at a time
PIECE = 2 << 20  # bytes whose words are looked for at a time

# Bytes of a word: digits, a-z (A-Z are lowered first), and all bytes of characters beyond ASCII.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True

_U = np.uint64
# Fixed values of XXH64: its five primes.
_P1, _P2, _P3, _P4, _P5 = (_U(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
SHORT = 32  # longer features take XXH64's striped form and go to the library


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


class Words:
    """The words of a piece of texts in one buffer, lowered and one space apart."""

    def __init__(self, lowered: np.ndarray, inside: np.ndarray, offsets: np.ndarray, first: int = 0, skip: int = 0):
        """``lowered``: bytes of texts one after another, text ``first + n`` from ``offsets[n]`` on; ``inside``: whether they
        are a word's; the first ``skip`` words are only the context of those that follow."""
        edge = np.zeros(len(lowered) + 1, bool)  # a text begins here
        edge[offsets] = True
        edge[-1] = True
        starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1] | edge[1:-1]])[:len(inside)])
        ends = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]])[:len(inside)] | edge[1:])) + 1
        self.skip, self.sizes, self.firsts = skip, ends - starts, starts
        self.text = first + np.searchsorted(offsets[1:], starts, "right")
        # What stays in the buffer: words, and the byte after each (a blank then) unless another text's word is there.
        blank = np.zeros(len(lowered) + 1, bool)
        blank[ends] = True
        blank = blank[:-1] & ~inside
        self.buffer = np.where(inside, lowered, np.uint8(32))[inside | blank]
        taken = self.sizes + np.concatenate([blank, [False]])[ends]
        self.starts = np.cumsum(taken) - taken

    def features(self, first: int, last: int, ngram: int = NGRAM):
        """Start, size and text of every feature that ends with a word of ``first:last``."""
        parts = []
        for n in range(1, ngram + 1):
            tails = np.arange(max(first, n - 1), min(last, len(self.starts)))
            heads = tails - n + 1
            same = self.text[heads] == self.text[tails]
            heads, tails = heads[same], tails[same]
            parts.append((self.starts[heads], self.starts[tails] + self.sizes[tails] - self.starts[heads], self.text[heads]))
        return tuple(np.concatenate(p) for p in zip(*parts))


def pieces(column: pa.Array, ngram: int = NGRAM):
    """The words of an Arrow column of texts without nulls: whole texts of ``PIECE`` bytes together, longer texts cut between words."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1)
        lowered = _LOWER[data[offsets[first]:offsets[last]]]
        inside = _IN_WORD[lowered]
        if last > first + 1 or len(lowered) <= PIECE:
            yield Words(lowered, inside, offsets[first:last + 1] - offsets[first], first)
        else:
            at, begin, skip = 0, 0, 0
            while at < len(lowered):
                end = min(at + PIECE, len(lowered))
                while end < len(lowered) and inside[end]:  # to the end of the word
                    tail = inside[end:end + PIECE]
                    end += len(tail) if tail.all() else int(np.argmin(tail))
                words = Words(lowered[begin:end], inside[begin:end], np.array([0, end - begin]), first, skip)
                yield words
                skip = min(ngram - 1, len(words.firsts))
                begin, at = (begin + int(words.firsts[-skip]) if skip else end), end
        first = last


class Interned:
    """Features of a portion in an open-addressed table: ``slot`` per feature; per slot ``owner``, ``bucket`` and ``count``."""

    def __init__(self, buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray, buckets: int = BUCKETS, hashes=None):
        self.starts, self.sizes = starts, sizes
        # The slice of the buffer that these features span, and the eight bytes from each of its places on.
        low, high = (int(starts.min()), int((starts + sizes).max())) if len(starts) else (0, 0)
        self.buffer = np.concatenate([buffer[low:high], np.zeros(16, np.uint8)])
        self.at = starts - low
        self.eight = np.empty(len(self.buffer) - 8, "<u8")
        for k in range(8):
            n = len(self.eight[k::8])
            self.eight[k::8] = self.buffer[k:k + 8 * n].view("<u8")
        self.hashes = self.xxh64() if hashes is None else hashes
        self._insert()
        self.taken = np.flatnonzero(self.owner >= 0)
        own = self.owner[self.taken]
        view, crc = memoryview(self.buffer), zlib.crc32
        crcs = [crc(view[a:b]) for a, b in zip(self.at[own].tolist(), (self.at[own] + sizes[own]).tolist())]
        self.bucket = np.zeros(len(self.owner), np.int64)
        self.bucket[self.taken] = np.array(crcs, np.int64) % buckets
        self.count = np.bincount(self.slot, minlength=len(self.owner))

    def xxh64(self) -> np.ndarray:
        """XXH64 (seed 0) of all features, in step."""
        h = _P5 + self.sizes.astype(np.uint64)
        long = np.flatnonzero(self.sizes >= SHORT)
        rest = np.flatnonzero(self.sizes < SHORT)
        for lane in range(SHORT // 8):
            has = rest[self.sizes[rest] >= 8 * (lane + 1)]
            if not len(has):
                break
            h[has] = _rotated(h[has] ^ (_rotated(self.eight[self.at[has] + 8 * lane] * _P2, 31) * _P1), 27) * _P1 + _P4
        left = self.sizes & 7
        place = self.at + (self.sizes & ~7)
        four = rest[left[rest] >= 4]
        h[four] = _rotated(h[four] ^ ((self.eight[place[four]] & _U(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
        place = place + (left & 4)
        left = left & 3
        for k in range(3):
            has = rest[left[rest] > k]
            h[has] = _rotated(h[has] ^ (self.buffer[place[has] + k].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> _U(33))) * _P2
        h = (h ^ (h >> _U(29))) * _P3
        h ^= h >> _U(32)
        view, digest = memoryview(self.buffer), xxhash.xxh64_intdigest
        for n in long.tolist():
            h[n] = digest(view[self.at[n]:self.at[n] + self.sizes[n]])
        return h

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether features ``a[n]`` and ``b[n]`` have equal bytes."""
        sizes = self.sizes[a]
        same = sizes == self.sizes[b]
        todo, lane = np.flatnonzero(same & (sizes < SHORT)), 0
        while len(todo):
            differ = self.eight[self.at[a[todo]] + lane] ^ self.eight[self.at[b[todo]] + lane]
            short = np.maximum(8 - (sizes[todo] - lane), 0)  # bytes of these eight that are not the feature's
            wrong = (differ << (_U(8) * short.astype(np.uint64))) != 0
            same[todo[wrong]] = False
            lane += 8
            todo = todo[~wrong & (sizes[todo] > lane)]
        for n in np.flatnonzero(same & (sizes >= SHORT) & (a != b)).tolist():
            i, j, size = self.at[a[n]], self.at[b[n]], sizes[n]
            same[n] = np.array_equal(self.buffer[i:i + size], self.buffer[j:j + size])
        return same

    def _insert(self) -> None:
        n = len(self.starts)
        bits = max(4, int(2 * n).bit_length())  # never over half full
        mask = (1 << bits) - 1
        self.owner = np.full(1 << bits, -1, np.int64)
        self.slot = (self.hashes >> _U(64 - bits)).astype(np.int64)
        looking = np.arange(n)
        while len(looking):
            slots = self.slot[looking]
            free = self.owner[slots] < 0
            self.owner[slots[free]] = looking[free]  # of several, one becomes the owner
            owners = self.owner[slots]
            found = self.hashes[owners] == self.hashes[looking]
            keyed = np.flatnonzero(found)
            found[keyed] = self._equal(owners[keyed], looking[keyed])
            looking = looking[~found]
            self.slot[looking] = (self.slot[looking] + 1) & mask


def _portions(column: pa.Array, ngram: int, buckets: int):
    """``(text of each feature, interned features)``, a portion at a time."""
    for words in pieces(column, ngram):
        for first in range(words.skip, len(words.starts), PORTION):
            starts, sizes, text = words.features(first, first + PORTION, ngram)
            interned = Interned(words.buffer, starts, sizes, buckets)
            interned.single = min(PORTION, len(words.starts) - first)  # the features of one word come first
            yield text, interned


def bucket_counts(texts: DataFrame, ngram: int = NGRAM, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """``(bucket, n)``: features of all texts in each bucket."""
    def run(batches):
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, interned in _portions(batch.column(0), ngram, buckets):
                totals += np.bincount(interned.bucket[interned.taken], interned.count[interned.taken], buckets).astype(np.int64)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], names=["bucket", "n"])

    return map_arrow(texts.select(whole_text(text).alias("text")), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _vector(counts: DataFrame, buckets: int) -> np.ndarray:
    """At most ``buckets`` rows, as floats (whole numbers below 2 ** 53)."""
    out = np.zeros(buckets)
    for bucket, n in counts.collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A gain per bucket, in thousandths, from the two sides' counts."""
    buckets = len(source)
    return np.floor(1000 * np.log((target + 1) * (source.sum() + buckets) / ((source + 1) * (target.sum() + buckets)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, ngram: int = NGRAM, text: str = "text") -> DataFrame:
    """``n_words``, ``n_features`` and ``weight`` of each row's text, in its place."""
    buckets, others = len(gain), [c for c in docs.columns if c != text]
    schema = T.StructType([*(docs.schema[c] for c in others), *T.StructType.fromDDL("n_words long, n_features long, weight long").fields])

    def run(batches):
        for batch in batches:
            rows = batch.num_rows
            total, n, words = (np.zeros(rows, np.int64) for _ in range(3))
            for at, interned in _portions(batch.column(len(others)), ngram, buckets):
                by_slot = gain[interned.bucket].astype(np.float64)  # sums stay whole below 2 ** 53
                total += np.bincount(at, by_slot[interned.slot], rows).astype(np.int64)
                n += np.bincount(at, minlength=rows)
                words += np.bincount(at[:interned.single], minlength=rows)
            found = [words, n, np.where(n > 0, total // np.maximum(n, 1), 0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(x) for x in found)], names=schema.names)

    return map_arrow(docs.select(*others, whole_text(text).alias("text")), run, schema)


def _noise(seed: int):
    """Gumbel noise in thousandths, from the id."""
    spelled = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(spelled, "UTF-8"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _ranked(files: Scratch, docs: DataFrame, target: DataFrame, percent: int, min_words: int, ngram: int, buckets: int, seed: int) -> DataFrame:
    """``(doc_id, row, n_features, weight, score, rank)`` of ``docs(doc_id, row, text)``, whose ``row`` numbers need not last."""
    gain = gains(_vector(bucket_counts(docs, ngram, buckets), buckets), _vector(bucket_counts(target, ngram, buckets), buckets))
    scored = files(weights(docs, gain, ngram).withColumn("score", F.col("weight") + _noise(seed)))
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    dealt = (scored.where(F.col("n_words") >= min_words).orderBy(F.desc("score"), F.asc("doc_id"), F.asc("row"))
             .select("*", F.spark_partition_id().alias("part"), place.alias("at")))
    dealt = files(dealt)
    starts, total = [], 0
    for part, n in sorted(tuple(r) for r in dealt.groupBy("part").count().collect()):  # a row per partition
        starts.append((part, total))
        total += n
    starts = docs.sparkSession.createDataFrame(starts, "part int, start long")
    rank, columns = F.col("start") + F.col("at") + 1, ["doc_id", "row", "n_features", "weight", "score"]
    able = dealt.join(F.broadcast(starts), "part").select(*columns, F.when(rank <= percent * total // 100, rank).alias("rank"))
    return files(able.unionByName(scored.where(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank"))))


def importance(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, ngram: int = NGRAM, buckets: int = BUCKETS,
               seed: int = SEED) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` over a written table, one row per input row; ``rank`` is null for rows not drawn."""
    with Scratch(docs.sparkSession) as files:
        rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
        return files.keep(_ranked(files, rows, target, percent, min_words, ngram, buckets, seed)).drop("row")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, ngram: int = NGRAM, buckets: int = BUCKETS,
              seed: int = SEED) -> DataFrame:
    """The drawn documents, with all their columns."""
    with Scratch(docs.sparkSession) as files:
        table, row = numbered(files, docs)
        ranks = _ranked(files, table.select("doc_id", F.col(row).alias("row"), "text"), target, percent, min_words, ngram, buckets, seed)
        drawn = files.keep(files(ranks.where("rank IS NOT NULL").select(F.col("row").alias(row))))
        return files.keep(table).join(drawn, row, "left_semi").select(*docs.columns)


# The same result by plain grouping of the features' texts; CRC-32 is folded over the bytes of each distinct feature.
SQL = f"""
WITH crc_table AS (
  SELECT list(list_reduce([CAST(i AS BIGINT)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM range(256) AS t(i)),
texts AS (
  SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS n, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', item_id, row_number() OVER (), coalesce(text, '') FROM benchmark),
worded AS MATERIALIZED (
  SELECT side, id, n, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
features AS MATERIALIZED (
  SELECT side, n, feature, count(*) AS times FROM (
    SELECT side, n, unnest(w) AS feature FROM worded
    UNION ALL SELECT side, n, unnest(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) FROM worded)
  GROUP BY ALL),
hashed AS MATERIALIZED (
  SELECT feature, xor(list_reduce([4294967295] || list_transform(range(octet_length(encode(feature))),
      lambda k: CAST('0x' || substr(hex(encode(feature)), CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT feature FROM features), crc_table),
placed AS MATERIALIZED (SELECT side, n, bucket, sum(times) AS times FROM features JOIN hashed USING (feature) GROUP BY ALL),
counts AS (
  SELECT bucket, coalesce(sum(times) FILTER (side = 'd'), 0) AS s, coalesce(sum(times) FILTER (side = 'b'), 0) AS t FROM placed GROUP BY bucket),
sums AS (SELECT CAST(sum(s) AS DOUBLE) AS s_all, CAST(sum(t) AS DOUBLE) AS t_all FROM counts),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (s_all + {BUCKETS}) / ((CAST(s AS DOUBLE) + 1) * (t_all + {BUCKETS})))) AS BIGINT) AS gain FROM counts, sums),
summed AS (SELECT n, sum(times) AS n_features, sum(times * gain) AS total FROM placed JOIN gain USING (bucket) WHERE side = 'd' GROUP BY n),
scored AS (
  SELECT id AS doc_id, n, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
    CAST(coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM worded LEFT JOIN summed USING (n) WHERE side = 'd'),
noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST(h AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS FIRST) AS place,
    count(*) OVER (PARTITION BY n_words >= {MIN_WORDS}) AS able FROM noisy)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {MIN_WORDS} AND place <= {PERCENT} * able // 100 THEN place END AS rank FROM ranked
"""
