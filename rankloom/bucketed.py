"""Bucketed tables in a folder of the shared file system, which any later application can open again."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession


def table_name(path: str) -> str:
    """The catalog name under which a folder's table is known."""
    return f"rankloom_{hashlib.md5(path.encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, buckets: int, keys: list[str], order: list[str], dealt: bool = False) -> DataFrame:
    """Write ``df`` bucketed by ``keys`` and sorted by ``order`` within a bucket, and give the table.

    The rows are dealt out by the keys first (unless ``dealt`` says that they are), so each bucket is one file.
    """
    spark, name = df.sparkSession, table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # a name left by a folder that is gone
    rows = df if dealt else df.repartition(buckets, *keys)
    rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*order).option("path", path).mode("error").saveAsTable(name)
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str, schema: str, buckets: int, keys: list[str], order: list[str]) -> DataFrame:
    """The table in a folder, made known to this session's catalog if need be."""
    name = table_name(path)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({', '.join(keys)}) SORTED BY ({', '.join(order)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
