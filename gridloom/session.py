"""Session helpers: a configured local session for tests/bench, and the shared
scratch folder every job writes intermediate tables to."""
from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "gridloom") -> SparkSession:
    """A session for jobs, tests and the benchmark.

    What the submitter has set (master, partitions, memory, ...) stays; only
    settings that are absent are filled in. Arguments are explicit requests.
    """
    from pyspark import SparkConf

    given = SparkConf()
    active = SparkSession.getActiveSession()
    defaults = {
        "spark.master": os.environ.get("GRIDLOOM_MASTER", "local[8]"),
        "spark.app.name": app,
        "spark.sql.shuffle.partitions": os.environ.get("GRIDLOOM_SHUFFLE_PARTITIONS", "8"),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("GRIDLOOM_DRIVER_MEMORY", "16g"),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if log_dir := os.environ.get("GRIDLOOM_EVENT_LOG_DIR"):  # offline stage metrics in a scratch folder
        defaults |= {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    if given.contains("spark.master") and not given.get("spark.master").startswith("local"):
        # On a cluster, partitions and memory are the submitter's or Spark's own defaults.
        for name in ("spark.sql.shuffle.partitions", "spark.driver.memory"):
            defaults.pop(name)
    wanted = {}
    if master:
        wanted["spark.master"] = master
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    b = SparkSession.builder
    for name, value in defaults.items():
        if not given.contains(name) and not (active and active.conf.get(name, None)):
            b = b.config(name, value)
    for name, value in wanted.items():
        b = b.config(name, value)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session that has none gets a folder here: on a cluster every
    executor would write to a temporary folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = os.path.join(tempfile.gettempdir(), "gridloom-checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (never a machine-local one on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/gridloom-scratch/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Actions in here leave no shuffle files: else those of every step stay until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Cut lineage by writing Parquet to the shared folder and reading it back.

    Survives executor loss: the result lives in shared storage, not in
    executor memory (no ``localCheckpoint``). What was shuffled for it goes.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "stage")
    with shuffles_removed(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
