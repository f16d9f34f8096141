"""Fuzzy line dedup by MinHash.

A line is what stands between two line feeds; blank lines are left alone.  Two lines are alike when their
sets of character shingles (``SHINGLE`` code points; a shorter line is its own only shingle) have a
Jaccard similarity of ``SIMILARITY`` or more.  Lines that are alike, directly or over others, form a
component; of a component the first line (least doc_id, then line number) is kept.

1. The lines are listed once, as their places and ids; a line gets a MinHash signature of ``BANDS * ROWS`` numbers, and from it one key per band.  A pair at the
   threshold shares a key with probability 1 - (1 - 0.8 ** 3) ** 10 = 0.9992, at 0.9 with 0.999998.
2. Keys that at least two different lines share are buckets; rows are shuffled by their key once, for the buckets, their
   members and pivots alike.  The lines in buckets get parity sketches (see ``sketches``) of their whole shingle sets.  Every
   other member of a bucket is held against its pivot, the line with the most occurrences: no pairs within a bucket.  (Of
   edited copies the unedited line is the most frequent, and nearest to all.)
3. Each line's nearest pivot of those that sizes and sketches let through is compared exactly, by the shingle sets of the
   two texts, and what is alike goes to union-find.
4. In buckets whose members are not all in one component by then, members of different components meet under the
   same test of sizes and sketches; the few pairs that pass are compared exactly, and union-find ends it.

Lines are known by their MD5 (128 bits), their texts are fetched only for sketches and exact comparison, by the same
shuffle at any size.

Edge cases: a null or empty text has no lines; very long lines are signed whole; equal lines are one line, and ties between
pivots go to the greatest id; an empty table gives no rows; carriage returns belong to their line.  Repeated ids count as further
lines with the same place; of two lines in the same place both are kept or dropped together.  A null id
comes before all others.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, map_arrow, numbered, whole_text
from .components import components
from .sketches import differing_bits, may_reach, parity_sketches, side

SHINGLE, SIMILARITY = 8, 0.8
BANDS, ROWS = 10, 3
SKETCH = 1024  # bits
PORTION = 1 << 17  # code points signed at a time: arrays that stay in a core's cache

_rng = np.random.default_rng(7)
_FACTORS = _rng.integers(1, 1 << 31, BANDS * ROWS, dtype=np.uint32) * 2 + 1
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hashed_shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit number for each shingle of each line, where each line's begin, and how many it has; the only
    shingle of a line that is shorter than one is the line."""
    sizes = np.array([len(x) for x in lines], np.int64)
    chars = np.frombuffer(("".join(lines) + "\0" * (SHINGLE - 1)).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    short = sizes < SHINGLE
    n = np.where(short, sizes, sizes - SHINGLE + 1)
    firsts, ends = np.cumsum(n) - n, np.cumsum(sizes)
    chars += np.uint64(1)
    for step in (1, 2, 4):  # each time two neighbouring numbers become one, until they are of SHINGLE code points
        both = chars[:-step] * np.uint64(pow(int(_BASE), step, 1 << 64))
        both += chars[step:]
        chars = both
    used = np.ones(len(chars), bool)  # positions near a line's end reach over it and are not used
    used[(ends[~short, None] - np.arange(1, SHINGLE)).ravel()] = False
    hashed = _mixed(chars[used])
    for i in np.nonzero(short)[0]:
        hashed[firsts[i]:firsts[i] + n[i]] = np.uint64(int.from_bytes(hashlib.blake2b(lines[i].encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))
    return hashed, firsts, n


def distinct(hashed: np.ndarray, firsts: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """The set of each line's numbers, sorted."""
    hashed = hashed.copy()
    for a, size in zip(firsts, n):
        hashed[a:a + size].sort()
    new = np.ones(len(hashed), bool)
    new[1:] = hashed[1:] != hashed[:-1]
    new[firsts] = True
    return np.split(hashed[new], np.cumsum(np.add.reduceat(new, firsts, dtype=np.int64))[:-1])


def signed(lines: list[str]) -> np.ndarray:
    """``len(lines) x BANDS`` keys."""
    hashed, firsts, _ = hashed_shingles(lines)
    hashed = (hashed >> np.uint64(32)).astype(np.uint32)
    least = np.empty((BANDS * ROWS, len(lines)), np.uint32)
    under = np.empty_like(hashed)
    for i, factor in enumerate(_FACTORS):
        np.minimum.reduceat(np.multiply(hashed, factor, out=under), firsts, out=least[i])
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], len(lines), 1)
    for row in range(ROWS):
        keys = _mixed(keys * _BASE + least[row::ROWS])
    keys = np.ascontiguousarray(keys.T)
    return keys.view(np.int64)


def _numbers(line: str) -> np.ndarray | None:
    """The shingles of a line, each its code points as the bytes of one number: distinct ones, sorted.  None for a line
    that is shorter than one or has code points over 255."""
    try:
        held = np.frombuffer(line.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        return None
    if len(held) < SHINGLE:
        return None
    found = np.sort(np.lib.stride_tricks.sliding_window_view(held, SHINGLE).copy().view("<u8").ravel())
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def similarity(a: str, b: str) -> float:
    """Exact Jaccard similarity of the shingle sets."""
    sa, sb = _numbers(a), _numbers(b)
    if sa is not None and sb is not None:
        both = np.sort(np.concatenate([sa, sb]))
        common = int(np.count_nonzero(both[1:] == both[:-1]))
    else:
        sa, sb = ({x[i:i + SHINGLE] for i in range(max(1, len(x) - SHINGLE + 1))} for x in (a, b))
        common = len(sa & sb)
    return common / (len(sa) + len(sb) - common)


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, line_no, line, id)`` of every line that is not blank."""
    lines = docs.select(F.col(key).alias("doc_id"), F.posexplode(F.split(whole_text(text), "\n", -1)).alias("line_no", "line"))
    return lines.where(F.trim("line") != "").withColumn("id", F.unhex(F.md5(F.col("line").cast("binary"))))


def _portions(lines, size=len):
    """Runs of consecutive lines, at most about ``PORTION`` code points together."""
    portion, total = [], 0
    for line in lines:
        portion.append(line)
        total += size(line)
        if total >= PORTION:
            yield portion
            portion, total = [], 0
    if portion:
        yield portion


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, line_no, id, keys, n)`` of every line that is not blank.  ``keys`` and ``n``, a line's occurrences
    in its batch, stand where the batch has it first, else none and 0."""
    def places(column):
        for row, value in enumerate(column):
            for number, line in enumerate(value.as_py().split("\n")):
                if line.strip(" "):
                    yield row, number, line

    def run(batches):
        for batch in batches:
            counts = Counter(line for _, _, line in places(batch.column(1)))
            for portion in _portions(places(batch.column(1)), size=lambda place: len(place[2])):
                n = np.array([counts.pop(line, 0) for _, _, line in portion], np.int64)
                new = [line for (_, _, line), times in zip(portion, n) if times]
                keys = signed(new).ravel() if new else np.zeros(0, np.int64)
                offsets = np.concatenate([[0], np.cumsum((n > 0) * BANDS)])
                ids = [hashlib.md5(line.encode("utf-8", "surrogatepass")).digest() for _, _, line in portion]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([row for row, _, _ in portion])), pa.array([number for _, number, _ in portion], pa.int32()),
                                                  pa.array(ids, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys)), pa.array(n)],
                                                 names=["doc_id", "line_no", "id", "keys", "n"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField("line_no", T.IntegerType()), T.StructField("id", T.BinaryType()),
                           T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("n", T.LongType())])
    return map_arrow(docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text")), run, schema)


def sketched(lines: DataFrame) -> DataFrame:
    """``lines(id, line)`` with the number of their distinct shingles ``n`` and their ``sketch``."""
    def run(batches):
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for portion in _portions(rows, size=lambda row: len(row[1])):
                hashed, firsts, n = hashed_shingles([line for _, line in portion])
                sets = distinct(hashed, firsts, n)
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in portion], pa.binary()), pa.array([line for _, line in portion]),
                                                  pa.array([len(x) for x in sets], pa.int64()), pa.array(list(parity_sketches(sets, SKETCH)), pa.list_(pa.int64()))],
                                                 names=["id", "line", "n", "sketch"])

    return map_arrow(lines.select("id", "line"), run, "id binary, line string, n long, sketch array<long>")


def _alike(files: Scratch, pairs: DataFrame, lines: DataFrame, similar: float) -> DataFrame:
    """The ``pairs`` of line ids ``(a, b)``, with their further columns, whose similarity is ``similar`` or more."""
    columns = pairs.columns

    def run(batches):
        for batch in batches:
            a, b = batch.column("ta").to_pylist(), batch.column("tb").to_pylist()
            yield batch.select(columns).filter(pa.array([similarity(x, y) >= similar for x, y in zip(a, b)], pa.bool_()))

    named = lambda c: lines.select(F.col("id").alias(c), F.col("line").alias("t" + c))
    met = pairs.join(named("a"), "a").join(named("b"), "b").select(*columns, "ta", "tb")
    return files(map_arrow(met, run, pairs.schema))


def line_components(docs: DataFrame, similar: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, component)`` of the lines that are alike some other line, a written table."""
    with Scratch(docs.sparkSession) as files:
        return _line_components(files, files(signatures(docs, key, text)), docs, similar, key, text)


def _line_components(files: Scratch, signs: DataFrame, docs: DataFrame, similar: float, key: str, text: str) -> DataFrame:
    # A bucket's lines are told apart by a 64-bit hash of the id.
    bucket, h = Window.partitionBy("key"), F.xxhash64("id")
    rows = signs.where("n > 0").select("id", "n", F.explode("keys").alias("key"))
    rows = rows.withColumn("several", F.min(h).over(bucket) < F.max(h).over(bucket)).where("several")
    # A line signed in several batches has the same keys in each: its occurrences add up in each of its buckets.
    rows = rows.groupBy("key", "id").agg(F.sum("n").alias("times"))
    members = files(rows.select("key", "id", F.max(F.struct("times", "id")).over(bucket)["id"].alias("pivot")))
    known = files(members.select("id").distinct())
    files.free_shuffles()
    texts = occurrences(docs, key, text).select("id", "line").join(known, "id", "left_semi")
    lines = files(sketched(texts.dropDuplicates(["id"])))
    stars = members.where("id != pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    near = may_reach(similar * 100, SKETCH)
    tested = files(stars.join(side(lines, "a", SKETCH, "id"), "a").join(side(lines, "b", SKETCH, "id"), "b").where(near)
                   .select("a", "b", differing_bits(SKETCH).alias("bits")))
    files.free_shuffles()
    # One pivot of a line will do here: what that leaves apart meets again below.
    nearest = tested.groupBy("a").agg(F.min(F.struct("bits", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    groups = components(_alike(files, nearest, lines, similar))
    own = (members.select("key", "id").join(groups.select(F.col("node").alias("id"), "component"), "id", "left")
           .withColumn("component", F.coalesce("component", "id")))
    several = own.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    own = files(own.join(several, "key").join(lines.select("id", "n", "sketch"), "id"))
    a, b = (side(own, name, SKETCH, "id", "key", F.col("component").alias(name + "c")) for name in "ab")
    met = a.join(b, "key").where((F.col("a") < F.col("b")) & (F.col("ac") != F.col("bc")) & near)
    more = _alike(files, files(met.select("a", "b", "ac", "bc").distinct()), lines, similar)
    # Components so far are known by their least lines: only those that meet are joined.
    joined = components(more.select("ac", "bc")).withColumnRenamed("component", "least")
    alone = joined.join(groups.select("node"), "node", "left_anti").select("node", "least")
    groups = groups.join(joined.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("least", "component"))
    return files.keep(files(groups.union(alone).toDF("id", "component")))


def line_dedup(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """One row per line that is not blank: doc_id, line_no, line_id, component_id, kept."""
    with Scratch(docs.sparkSession) as files:
        signs = files(signatures(docs))
        with Scratch(docs.sparkSession) as passing:
            groups = _line_components(passing, signs, docs, similar, "doc_id", "text")
            passing.free_shuffles()
        # Lines alike another are few: their component and its first place are worked out first; any other line
        # is its own component, kept where it stands first.
        first = signs.groupBy("id").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
        first = files(first.join(groups, "id", "left"))
        labelled = first.where("component IS NOT NULL")
        best = labelled.groupBy("component").agg(F.min("first").alias("best"))
        alike = labelled.select("id", "component").join(best, "component")
        verdict = files(first.select("id", "first").join(alike, "id", "left")
                        .select("id", F.coalesce("component", "id").alias("component"), F.coalesce("best", "first").alias("best")))
        kept = F.struct("doc_id", "line_no").eqNullSafe(F.col("best"))
        lines = files.keep(files(signs.join(verdict, "id").select("doc_id", "line_no", "id", "component", kept.alias("kept"))))
    hexed = lambda c: F.lower(F.hex(c))
    return lines.select("doc_id", "line_no", hexed("id").alias("line_id"), hexed("component").alias("component_id"), "kept")


def dedup_text(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """``(doc_id, text)``: each document that has lines, without the lines that are dropped; blank lines go too.

    Documents are known by row number, so ids may be null or repeated.
    """
    with Scratch(docs.sparkSession) as files:
        table, row = numbered(files, docs)
        place = F.struct(F.col("doc_id").alias("id"), F.col(row).alias("row")).alias("doc_id")
        table = files.keep(table).select(place, "text")
        judged = line_dedup(table, similar).where("kept").select(F.col("doc_id.row").alias("row"), "line_no")
        lines = occurrences(table).select(F.col("doc_id.row").alias("row"), F.col("doc_id.id").alias("doc_id"), "line_no", "line")
        kept = lines.join(judged, ["row", "line_no"], "left_semi")
        listed = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
        return kept.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.array_join(listed, "\n").alias("text")).select("doc_id", "text")
