"""Session construction and shared-folder lookup."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  AQE re-plans joins from runtime sizes
# (broadcast when a side turns out small, skew split when a key is hot) and
# coalesces the shuffle partitions of small stages.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "stockroom", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests.  On a cluster, pass ``master=None``
    and let spark-submit decide; shuffle partitions then stay as configured."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local temporary folder is created only when the session has none and
    runs on one machine (master ``local``).  On a cluster each executor would
    write to its own disk, so there the setting is required.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="stockroom-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder, one per call."""
    return f"{_own_scratch(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _own_scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/stockroom/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, name: str, within: str | None = None) -> DataFrame:
    """``df`` written once to scratch and read back: every later reader sees
    the same rows, also if ``df`` would not give them twice, and a lost
    executor loses nothing.  ``within`` is a scratch folder of the caller,
    who removes it; else ``clear_scratch`` does."""
    path = f"{within}/{name}-{uuid.uuid4().hex[:12]}" if within else scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to scratch.  Frames that were
    built on it (verdicts, trigger runs of the registered queries) end here."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
