"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "subledger") -> SparkSession:
    """Local session with the settings the tests and bench use (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this must already be set to shared storage: a folder of one machine would break
    every later read, so an unset value is an error there. Only a local session (tests) that has
    none gets a scratch folder under /tmp, recorded on the session, so every later call agrees.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="subledger-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table; deleted when the process ends
    (if the session still lives then)."""
    if not _SCRATCH:
        atexit.register(_clean_scratch)
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append((spark, path))
    return path


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a fresh :func:`scratch_path` and read back: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope():
    """Delete on leaving what operators wrote to scratch paths inside the scope: use it around a query whose result
    has been read or written by then. Tables of earlier scopes and of outer code stay."""
    mark = len(_SCRATCH)
    try:
        yield
    finally:
        mine = _SCRATCH[mark:]
        del _SCRATCH[mark:]
        for spark, path in mine:
            remove_path(spark, path)


def scratch_result(spark: SparkSession, name: str, build) -> DataFrame:
    """What ``build()`` returns, as a scratch table; what it wrote itself on the way is deleted."""
    path = scratch_path(spark, name)
    with scratch_scope():
        build().write.parquet(path)
    return spark.read.parquet(path)


def _clean_scratch() -> None:
    for spark, path in _SCRATCH:
        try:
            if spark.sparkContext._jsc is None:  # stopped: its file systems are out of reach
                continue
            remove_path(spark, path)
        except Exception:  # the JVM is gone already
            return


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder (any file system Spark knows); a missing one is fine."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
