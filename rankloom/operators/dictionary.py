"""Dense integer ids for pages and words.

A dictionary numbers the distinct values of a column from 0 in their order, so that ids sort as the values do.  It is
made once by a range-partitioned sort; joins, shuffles and sums that follow then carry longs instead of strings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import Tables, in_order

NO_ID = -1  # stands for a null value


@dataclass
class Dictionary:
    table: DataFrame  # (id long, value), a written table
    size: int

    @classmethod
    def of(cls, tables: Tables, values: DataFrame) -> "Dictionary":
        """The dictionary of a table of one column; nulls get no entry."""
        value = values.columns[0]
        distinct = values.select(F.col(value).alias("value")).where(F.col("value").isNotNull()).distinct()
        numbered, size = in_order(tables, distinct, ["value"], "id")
        return cls(numbered, size)

    def encode(self, df: DataFrame, *columns: str) -> DataFrame:
        """``df`` with the values of ``columns`` replaced by their ids, nulls by ``NO_ID``.

        A join of plain exchanges for each column, so AQE can split a value that many rows have.
        """
        for c in columns:
            side = self.table.select(F.col("id").alias(f"{c}_id_"), F.col("value").alias(f"{c}_value_"))
            others = [F.coalesce(f"{c}_id_", F.lit(NO_ID)).alias(c) if x == c else F.col(x) for x in df.columns]
            df = df.join(side, F.col(c) == F.col(f"{c}_value_"), "left").select(*others)
        return df

    def decode(self, df: DataFrame, *columns: str) -> DataFrame:
        """``df`` with ids replaced by their values again."""
        for c in columns:
            side = self.table.select(F.col("id").alias(f"{c}_id_"), F.col("value").alias(f"{c}_value_"))
            others = [F.col(f"{c}_value_").alias(c) if x == c else F.col(x) for x in df.columns]
            df = df.join(side, F.col(c) == F.col(f"{c}_id_"), "left").select(*others)
        return df
