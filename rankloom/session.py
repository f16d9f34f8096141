"""Session helpers: a tuned local session for tests/bench, and checkpoint-dir handling.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it.  A private checkpoint folder is created only
for a local master where that setting is missing (tests, bench).
"""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this engine wants.  AQE re-plans joins and
# coalesces small shuffles at runtime; skew-join splitting guards the
# word-keyed and page-keyed joins against hot keys.
#
# Static broadcast joins are off: the planner's size estimate for exploded /
# aggregated text is a guess (10x low on the postings at sf0.1).  AQE still
# turns a join into a broadcast when a side's *measured* shuffle output is
# under its threshold, so only checked sizes are broadcast.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PageRank checkpoints one rank vector per round; delete a round's files
    # once nothing references it, so long runs do not fill the folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "rankloom", extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or (os.cpu_count() if cores == "*" else cores))
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (default parallelism), or the shuffle partition
    count where the session exposes no SparkContext (Spark Connect)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # no SparkContext in this client
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def application_id(spark: SparkSession) -> str:
    """Identifier of the running application (a cache key for per-application probes)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # no SparkContext in this client
        return spark.conf.get("spark.app.id", "default")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only where none is configured.

    Order: an already active ``SparkContext`` checkpoint dir, then the session's
    ``spark.checkpoint.dir`` setting (the shared folder a cluster names), then
    — for a local master only — a fresh private folder under the system temp dir.
    A non-local session without ``spark.checkpoint.dir`` is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns spark.checkpoint.dir
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="rankloom-ckpt-"))
    return sc.getCheckpointDir()


class Checkpoints:
    """Checkpoints of one run: ``cut`` writes one, ``drop`` deletes it, and when the block ends all go
    that were not given to ``keep``, whatever the session's cleaner does."""

    def __init__(self, spark: SparkSession):
        ensure_checkpoint_dir(spark)
        self.spark, self.held = spark, []

    def __enter__(self) -> "Checkpoints":
        return self

    def __exit__(self, *error) -> None:
        for df in list(self.held):
            self.drop(df)

    def cut(self, df):
        df = df.checkpoint()
        self.held.append(df)
        return df

    def keep(self, df):
        self.held = [x for x in self.held if x is not df]
        return df

    def drop(self, df) -> None:
        self.keep(df)
        delete_checkpoint(df)


def delete_checkpoint(df) -> None:
    """Delete the files of a checkpointed DataFrame.  PySpark has no public call for it; a client that
    cannot reach the JVM (Spark Connect) leaves them to the server's cleaner."""
    jdf = getattr(df, "_jdf", None)
    if jdf is None:
        return
    file = jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        delete_path(df.sparkSession, file.get())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if this client can reach it."""
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext in this client
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage: Spark deletes a shuffle's files when its plan is collected, which may be
    hours after the tables made of it were written."""
    gc.collect()
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # no SparkContext in this client: the server collects in its own time
        pass


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file of the shared file system exists."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(path.getFileSystem(sc._jsc.hadoopConfiguration()).exists(path))
