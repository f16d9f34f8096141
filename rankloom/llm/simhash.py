"""SimHash near-dedup with pivot distance tables.

Fingerprint: a text's A-Z are lowered, its words are runs of characters other than space and
U+0009-U+000D; each shingle of ``SHINGLE`` words (fewer words: the whole sequence) gives its XXH64
with seed 42; a bit of the 64 is set where over half of the shingles have it.  No words: zero.

Links (at most ``BITS`` differing bits) are found on distinct fingerprints only:

* The 64 bits form ``BITS + 2`` blocks.  A pivot table has, per fingerprint, its Hamming distances to
  many reference fingerprints within each block (the difference of the distances to a reference
  and to the reference with that block inverted gives the same number).
* Two fingerprints that differ in d bits have distances to a reference that differ by d at most.  So
  of a linked pair's blocks at least two keep all their distances: the pair meets in an equi-join
  on the distances of some pair of blocks.  Pairs that meet are discarded when a distance to one of the
  whole references differs by more than ``BITS``, and survivors are verified by their bits.
* A meeting point with over ``CROWD`` fingerprints (near copies of one text) is not paired: each
  member names the values one bit away in the blocks that are not shared, and itself; members that
  name the same value are at most two bits apart, and every two members that are two bits apart, or
  fewer, name a common value.  They are linked to the least of them, which keeps the components whole
  at a linear cost. (``BITS`` other than 2 pair within crowds instead.)

Edge cases: a null or empty text, or one without words, has fingerprint zero and is linked like any
other.  Rows with equal ids are one row each; ``component_id`` is the least non-null id of the
component, null if it has none.  Very long texts are shingled whole.  No ties arise: a bit that is set in just half of
the shingles is 0.  An empty table gives no rows; columns other than the id and the text are not read, whatever their names
(``keep_one`` hands them through).
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, map_arrow, numbered, whole_text, without_ids
from .components import components

SHINGLE, BITS, SEED = 3, 2, 42
REFERENCES = 16
CROWD = 16


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of one text as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[:-shingle] + 1).tolist()]
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())]
    h = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, dtype=np.int64)
    for part in range(0, len(h), 65536):
        counts += np.unpackbits(h[part:part + 65536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp)``, a row for each input row, fp signed."""
    def run(batches):
        for batch in batches:
            fps = [text_fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField("fp", T.LongType())])
    return map_arrow(docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text")), run, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def references(n: int = REFERENCES) -> list[int]:
    return [_signed(xxhash.xxh64_intdigest(str(i), SEED)) for i in range(n)]


def blocks(bits: int = BITS) -> list[int]:
    """Masks of ``bits + 2`` blocks that share the 64 bits evenly."""
    n = bits + 2
    edges = [64 * i // n for i in range(n + 1)]
    return [_signed(sum(1 << b for b in range(lo, hi))) for lo, hi in zip(edges, edges[1:])]


def _distance(fp: Column, ref: int, mask: int = -1) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(ref)).bitwiseAND(F.lit(mask)))


def _meeting_points(fps: DataFrame, bits: int, n_refs: int) -> DataFrame:
    """``(kept, point, fp)``: a row for each fingerprint and two blocks, ``point`` their distances, hashed.

    A collision of the hash only lets further pairs meet.
    """
    masks, refs = blocks(bits), references(n_refs)
    table = fps.select("fp", *(F.array(*(_distance(F.col("fp"), r, m) for r in refs)).alias(f"d{i}") for i, m in enumerate(masks)))
    rows = F.array(*(F.struct(F.lit(n).alias("kept"), F.xxhash64(F.lit(n), f"d{i}", f"d{j}").alias("point"))
                     for n, (i, j) in enumerate(combinations(range(len(masks)), 2))))
    return table.select("fp", F.explode(rows).alias("at")).select("at.kept", "at.point", "fp")


def links(files: Scratch, fps: DataFrame, bits: int = BITS, n_refs: int = REFERENCES, crowd: int = CROWD) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints with the components of all links of <= ``bits`` bits.

    ``fps``: one written column ``fp`` without repeats.
    """
    points = files(_meeting_points(fps, bits, n_refs))
    sizes = files(points.groupBy("kept", "point").agg(F.count("*").alias("members")).where("members > 1"))
    met = files(points.join(sizes, ["kept", "point"]))
    few = met if bits != 2 else met.where(F.col("members") <= crowd)
    a, b = few.select("kept", "point", F.col("fp").alias("a")), few.select("kept", "point", F.col("fp").alias("b"))
    refs = references(n_refs)
    apart = F.greatest(*(F.abs(_distance(F.col("a"), r) - _distance(F.col("b"), r)) for r in refs))
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = a.join(b, ["kept", "point"]).where((F.col("a") < F.col("b")) & (apart <= bits) & (differing <= bits)).select("a", "b")
    if bits != 2:
        return files(pairs.distinct())
    return files(pairs.unionByName(_crowd_links(files, met.where(F.col("members") > crowd), bits)).distinct())


def _crowd_links(files: Scratch, members: DataFrame, bits: int) -> DataFrame:
    """Star edges among the members of crowded points, as described above."""
    masks = blocks(bits)
    free = []
    for i, j in combinations(range(len(masks)), 2):
        shared = (masks[i] | masks[j]) & (1 << 64) - 1
        free.append(F.array(F.lit(0).cast("long"), *(F.lit(_signed(1 << n)) for n in range(64) if not shared >> n & 1)))
    flips = reduce(lambda other, n: F.when(F.col("kept") == n, free[n]).otherwise(other), range(len(free) - 1), free[-1])
    named = members.select("kept", "point", "fp", F.explode(flips).alias("flip")).select(
        "kept", "point", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    stars = files(named.groupBy("kept", "point", "value").agg(F.min("fp").alias("centre"), F.count("*").alias("n")).where("n > 1"))
    return (named.join(stars, ["kept", "point", "value"]).where("fp != centre").select(F.col("centre").alias("a"), F.col("fp").alias("b")))


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)`` per input row, a written table."""
    with Scratch(docs.sparkSession) as files:
        rows = files(fingerprints(docs, shingle, key, text))
        nodes = files(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
        groups = components(links(files, nodes.select("fp"), bits))
        # A fingerprint without a link is its own component.
        labelled = files(nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp")))
        least = files(labelled.groupBy("component").agg(F.min("least").alias("component_id")))
        label = files(labelled.join(least, "component").select("fp", "component_id"))
        return files.keep(files(rows.join(label, "fp").select("doc_id", "fp", "component_id")))


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return near_dedup(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: that with the least id (null after any), of these the first.

    Rows are judged by number, so ids may be null or repeated.
    """
    with Scratch(docs.sparkSession) as files:
        table, row = numbered(files, docs)
        order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
        judged = near_dedup(table.select(order.alias("place"), "text"), key="place")
        dropped = files(judged.where("doc_id.row != component_id.row").select(F.col("doc_id.row").alias(row)))
        return without_ids(files.keep(table), files.keep(dropped), row).select(*docs.columns)
