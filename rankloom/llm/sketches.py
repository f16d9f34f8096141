"""Parity sketches: whether two sets may be alike, from a few longs each.

Bit n of a sketch is the parity of the set's members that fall to n.  The sketches of two sets differ in at most as many bits
as the sets differ in members; where so many members differ that bits are crowded, the number of differing bits that a
pair at the threshold shows on average, and ``SIGMAS`` standard deviations more, is the limit.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGMAS = 7
SETS = 512  # sets whose bits are counted at a time


def parity_sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """``len(sets) x size // 64`` longs, of sets of distinct 64-bit numbers."""
    out = np.empty((len(sets), size // 64), "<i8")
    for first in range(0, len(sets), SETS):
        part = sets[first:first + SETS]
        owner = np.repeat(np.arange(len(part)), [len(x) for x in part])
        bits = np.bincount(owner * size + (np.concatenate(part) % np.uint64(size)).astype(np.int64), minlength=len(part) * size) & 1
        out[first:first + SETS] = np.packbits(bits.reshape(len(part), size).astype(np.uint8), axis=1, bitorder="little").view("<i8")
    return out


def side(nodes: DataFrame, name: str, size: int, node: str = "node", *more) -> DataFrame:
    """The columns node, n (members) and sketch of a table as one side of a pair: name, name + "n", name + "0", ...; and columns ``more``."""
    return nodes.select(F.col(node).alias(name), F.col("n").alias(name + "n"), *(F.col("sketch")[i].alias(f"{name}{i}") for i in range(size // 64)), *more)


def differing_bits(size: int) -> Column:
    """Bits that differ between the sketches of the sides ``a`` and ``b``."""
    return functools.reduce(lambda x, y: x + y, (F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(size // 64)))


def may_reach(percent: float, size: int) -> Column:
    """Whether the sides ``a`` and ``b`` may have a Jaccard similarity of ``percent`` hundredths, by members and sketches."""
    most = F.floor((F.col("an") + F.col("bn")) * (100 - percent) / (100 + percent) + 1e-6)  # members that may be in one set only
    shown = (1 - F.pow(F.lit(1 - 2 / size), most)) * (size / 2)
    limit = F.least(most.cast("double"), shown + SIGMAS * F.sqrt(size / 4 * (1 - F.pow(F.lit(1 - 4 / size), most))))
    return (F.least("an", "bn") * 100 >= F.greatest("an", "bn") * percent - 1e-6) & (differing_bits(size) <= limit)
