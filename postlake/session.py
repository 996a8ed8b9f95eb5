"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options every postlake job relies on.

    All stored timestamps are UTC instants, so the session zone must be UTC. Adaptive
    execution supplies coalescing, runtime broadcast and skew-join splitting.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


@cache
def _local_base() -> str:
    """One folder per process. The setting itself cannot be changed in a running session."""
    return tempfile.mkdtemp(prefix="postlake-")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path below ``spark.checkpoint.dir``.

    Every executor must be able to read it, so a machine-local folder is only acceptable
    when the session itself is local (tests, the bench).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


# Folders that this process made below the shared folder and has not cleared.
_handed_out: list[str] = []


def clear_scratch(spark: SparkSession) -> None:
    """Delete every folder that this process got from ``shared_dir``, once the results that read them are consumed.

    The job that builds results owns what they stage: call this at its end.
    """
    jvm = spark.sparkContext._jvm
    while _handed_out:
        folder = jvm.org.apache.hadoop.fs.Path(_handed_out.pop())
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For results that several branches of a later plan read: they scan the stored columns they
    need instead of repeating the work, and a lost executor costs a re-read only. The folder
    stays until the job calls ``clear_scratch``.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
