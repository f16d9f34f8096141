"""Best-fit packing of documents into token sequences, bulk-synchronously.

1. Every text becomes token ids; documents longer than a sequence are cut into full pieces, the
   remainder first.  Only lengths and checksums leave the tokenizing task.
2. Pieces are range-sorted by length (ties spread by a hash, so one common length is many tasks'
   work) and get their rank within their length from per-partition counts.
3. Rounds go through the lengths from long to short.  A round places all pieces of one length at
   once: a successor search over the sorted gap sizes finds the smallest gaps that fit; pieces go
   there by rank, the rest move on to the next gap; pieces without a gap open sequences.  Then the
   gaps are updated and the next round begins.  This is best-fit decreasing, exactly.
   A changed method: the rounds run on the driver (``best_fit``), over the histogram of lengths, not as
   distributed sweeps over range-sorted gaps.
4. Pieces and gaps are kept as runs of equal size (length, first rank, how many), so a round works
   on at most one run per size and split, whatever the number of documents; every piece finds its place
   from its own rank by a search in the rounds' runs, in parallel.

Edge cases: a null text is the empty text, a document of the end id alone.  Repeated or null ids are
documents of their own (their pieces cannot be told apart by id).  Very long texts are encoded whole and cut.  Pieces
of one length are ranked by a hash of their row.  An empty table gives no rows; columns other than the id and the text
are not read, whatever their names.
Texts that spell the end-of-text token get its id, as the tokenizer's file says.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, map_arrow, whole_text
from .vocabulary import byte_bpe_path, encoder

LENGTH, END_ID = 1024, 2


def pieces(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, vocabulary: str | None = None,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document."""
    path = vocabulary or byte_bpe_path()

    def run(batches):
        encode = encoder(path)
        for batch in batches:
            rows = []
            for row, value in enumerate(batch.column(1)):
                ids = np.append(encode(value.as_py()), end_id).astype("<u4")
                first = len(ids) % length or length
                ends = range(first, len(ids) + 1, length)
                rows += [(row, n, end - (size := first if n == 0 else length), size, zlib.crc32(ids[end - size:end].tobytes()))
                         for n, end in enumerate(ends)]
            row, number, start, size, crc = (np.array(x) for x in zip(*rows)) if rows else [np.zeros(0, int)] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(size, pa.int64()), pa.array(crc, pa.int64())], names=schema.names)

    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField("piece", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))])
    return map_arrow(docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text")), run, schema)


def ranked(files: Scratch, rows: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray, dict[int, int]]:
    """Range-sorted pieces, a written table, with ``part`` and ``at`` (row number in it); per (part, length)
    what to add to ``at`` to get the rank among all pieces of that length; pieces per length.

    The counts that come back are one row per length and partition that holds it, and since the
    partitions are ranges these are at most partitions + lengths.
    """
    order = ["length", F.xxhash64("row")]  # a common length is many tasks' work, whatever the ids
    placed = files(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    counts = sorted(tuple(r) for r in placed.groupBy("part", "length").count().collect())
    total: dict[int, int] = {}
    keys, adds, first, last = [], [], 0, None
    for part, size, n in counts:
        first = 0 if part != last else first
        keys.append(part << 32 | size)
        adds.append(total.get(size, 0) - first)
        total[size] = total.get(size, 0) + n
        first, last = first + n, part
    return placed, np.array(keys, np.int64), np.array(adds, np.int64), total


def best_fit(counts: dict[int, int], length: int) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(size, first rank, pieces per sequence, first sequence, offset)`` of best-fit decreasing.

    ``counts``: pieces of each size.  The pieces of a run fill consecutive sequences.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap size: runs (first sequence, sequences)
    sizes: list[int] = []                        # gap sizes in order
    runs, opened = [], 0

    def add(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, n))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect_left(sizes, size)
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(at)
            else:
                gap, first, n = length, opened, -(-left // (length // size))
                opened += n
            each = gap // size
            full = min(n, left // each)
            placed = full * each
            runs.append((size, rank, each, first, length - gap))
            if full < n and placed < left:  # one sequence takes the last few
                rest = left - placed
                add(gap - rest * size, first + full, 1)
                placed, used = left, full + 1
            else:
                used = full
            add(gap - each * size, first, full)
            add(gap, first + used, n - used)
            rank, left = rank + placed, left - placed
    return runs


def pack(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, vocabulary: str | None = None,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    with Scratch(docs.sparkSession) as files:
        found = files(pieces(docs, length, end_id, vocabulary, key, text).withColumn("row", F.monotonically_increasing_id()))
        placed, keys, adds, counts = ranked(files, found)
        files.keep(placed)
    runs = np.array(best_fit(counts, length), np.int64).reshape(-1, 5)
    # Searched by size and rank together: sizes take the high bits.
    first = runs[:, 0] << 44 | runs[:, 1]
    order = np.argsort(first)
    runs, first = runs[order], first[order]

    def run(batches):
        for batch in batches:
            part, at, size = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("part", "at", "length"))
            rank = at + adds[np.searchsorted(keys, part << 32 | size)] if len(at) else at
            found = runs[np.searchsorted(first, size << 44 | rank, side="right") - 1] if len(at) else runs[:0]
            n = rank - found[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in schema.names[:5]), pa.array(found[:, 3] + n // found[:, 2], pa.int64()),
                 pa.array(found[:, 4] + n % found[:, 2] * size, pa.int64())], names=schema.names)

    schema = T.StructType([*placed.schema.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return map_arrow(placed, run, schema)
