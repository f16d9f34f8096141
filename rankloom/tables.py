"""Written tables: where a result is read more than once, or lineage has to end.

A table is Parquet in the folder that the cluster names in ``spark.checkpoint.dir``, so a lost executor costs a
re-read, unread columns are not read, and the planner sees true sizes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import delete_path, ensure_checkpoint_dir


def _folder_until_exit(spark: SparkSession, path: str) -> None:
    """Make a folder that is deleted when the application ends, whatever the session's cleaner does."""
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext in this client
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(path)
    files = path.getFileSystem(sc._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)  # has no effect on a folder that does not exist yet


class Tables:
    """The written tables of one run: ``tables(df)`` writes ``df`` and gives it read back.

    When the block ends the tables are deleted, but for those given to ``keep``: a lazy result still reads
    them, and they go when the application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.held, self.kept = spark, None, {}, False

    def __enter__(self) -> "Tables":
        return self

    def __exit__(self, *error) -> None:
        if self.folder and not self.kept:
            delete_path(self.spark, self.folder)
            return
        for path in self.held:
            delete_path(self.spark, path)

    def path(self, kind: str = "table") -> str:
        """The name of a folder for the caller to write; it is not deleted before the application ends."""
        self.kept = True
        return self._path(kind)

    def _path(self, kind: str) -> str:
        if self.folder is None:
            self.folder = f"{ensure_checkpoint_dir(self.spark)}/tables-{uuid.uuid4().hex}"
            _folder_until_exit(self.spark, self.folder)
        return f"{self.folder}/{kind}-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame) -> DataFrame:
        path = self._path("table")
        df.write.parquet(path)
        self.held[path] = out = self.spark.read.schema(df.schema).parquet(path)
        return out

    def keep(self, df: DataFrame) -> DataFrame:
        self.held, self.kept = {path: x for path, x in self.held.items() if x is not df}, True
        return df

    def drop(self, df: DataFrame) -> None:
        for path in [path for path, x in self.held.items() if x is df]:
            delete_path(self.spark, path)
            del self.held[path]


def in_order(tables: Tables, df: DataFrame, order: list, name: str, first: int = 0) -> tuple[DataFrame, int]:
    """``df`` with its rows' numbers in the given order, dense from ``first``, and the number of rows.

    One range-partitioned sort into a written table; of each partition only its number of rows comes to the
    driver.  Rows that are equal in the order are numbered as they come.
    """
    placed = tables(df.orderBy(*order).withColumn("part_", F.spark_partition_id())
                    .withColumn("at_", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    starts, total = [], first
    for part, n in sorted(tuple(r) for r in placed.groupBy("part_").count().collect()):  # a row per partition
        starts.append((part, total))
        total += n
    starts = df.sparkSession.createDataFrame(starts, "part_ int, start_ long")
    out = placed.join(F.broadcast(starts), "part_").select((F.col("start_") + F.col("at_")).alias(name), *df.columns)
    return out, total - first
