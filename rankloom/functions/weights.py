"""Weight columns of the text chain (F6-F9) and PageRank arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# PageRank damping, rank = 0.15 + 0.85 * sum of shares.
DAMPING = 0.85
TELEPORT = 0.15


def log_tf(n: Column | str) -> Column:
    """float32(1 + log10(n))."""
    return (F.lit(1.0) + F.log10(F.col(n) if isinstance(n, str) else n)).cast("float")


def float_text_to_double(c: Column | str) -> Column:
    """a float32 printed in shortest decimal form and read back as a double.

    ``1.30103f`` becomes the double ``1.30103``, not ``1.3010300397872925``;
    this is what makes TF-IDF digits equal the reference's.
    """
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("float").cast("string").cast("double")


def idf(n_docs: str, df: str) -> Column:
    """log10(1 + N div df), with integer (floor) division of two longs."""
    return F.log10(F.lit(1) + F.expr(f"`{n_docs}` div `{df}`"))


def damped(share_sum: Column) -> Column:
    """0.15 + 0.85 * sum."""
    return F.lit(TELEPORT) + F.lit(DAMPING) * share_sum
