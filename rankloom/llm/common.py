"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import rankloom
from rankloom.session import application_id, delete_path, ensure_checkpoint_dir

# A side is broadcast only after its rows were counted, and only up to this many
# narrow rows (ids and small numbers, a few MB); beyond it the join shuffles.
BROADCAST_ROWS = 100_000

# SQL spelling of "lower-case A-Z only": other letters stay as they are.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written tables of one operator, in the folder that the cluster names in ``spark.checkpoint.dir``.

    ``files(df)`` writes ``df`` as Parquet and gives it read back: lineage ends there, a lost executor
    costs a re-read, and the planner sees true sizes.  (A checkpointed DataFrame would carry its plan's size
    estimate and constraints along, and these multiply in loops until planning takes longer than the work.)
    When the block ends the tables are deleted, but for those given to ``keep``, which a lazy result
    still reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.tables = spark, ensure_checkpoint_dir(spark), {}

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *error) -> None:
        for path in self.tables:
            delete_path(self.spark, path)

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/llm-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.tables[path] = out = self.spark.read.schema(df.schema).parquet(path)
        return out

    def keep(self, df: DataFrame) -> DataFrame:
        self.tables = {path: x for path, x in self.tables.items() if x is not df}
        return df

    def free_shuffles(self) -> None:
        """Have the driver collect its garbage: Spark deletes a shuffle's files when its plan is collected, which may be
        hours after the tables made of it were written.  Of the last plan that ran something is held until the next one runs:
        to be called after one more table was written."""
        gc.collect()
        try:
            self.spark.sparkContext._jvm.System.gc()
        except Exception:  # no SparkContext in this client: the server collects in its own time
            pass

    def drop(self, df: DataFrame) -> None:
        for path in [path for path, x in self.tables.items() if x is df]:
            delete_path(self.spark, path)
            del self.tables[path]


_shipped: set[str] = set()


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)``, with this package sent to the executors once per application."""
    spark = df.sparkSession
    app = application_id(spark)
    if app not in _shipped:
        home = os.path.dirname(os.path.abspath(rankloom.__file__))
        if not os.path.isdir(home):  # already running from a shipped archive
            return df.mapInArrow(run, schema)
        made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="rankloom-"), "rankloom"), "zip",
                                   root_dir=os.path.dirname(home), base_dir=os.path.basename(home))
        spark.sparkContext.addPyFile(made)  # the driver serves the file; executors need no shared folder
        _shipped.add(app)
    return df.mapInArrow(run, schema)


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint when ``df`` (materialised, narrow) is counted at or under ``rows``."""
    return F.broadcast(df) if df.count() <= rows else df


def ascii_lower(text: Column) -> Column:
    """A-Z lowered; every other character kept, unlike ``lower``."""
    return F.translate(text, UPPER, LOWER)


def whole_text(name: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def free_name(columns: list[str], name: str) -> str:
    """``name``, with as many underscores after it as make it differ from all ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(files: Scratch, docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` as a written table with a number for each row, and that column's name (none of ``docs``).

    Written, as rows that are read again from their source need not get the same numbers.
    """
    name = free_name(docs.columns, "row_number")
    return files(docs.withColumn(name, F.monotonically_increasing_id())), name


def without_ids(docs: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in ``dropped`` (one materialised column ``key``).

    Null keys are never dropped. Texts stay where they are while ``dropped`` is small enough to
    be broadcast, else both sides are shuffled on the key.
    """
    return docs.join(checked_broadcast(dropped.select(key)), key, "left_anti").select(*docs.columns)
