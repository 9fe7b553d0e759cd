"""Versioned snapshots (S8-S11, F14): one directory per version,
``<root>/<name>/version=<n>``.

A publication is written to an attempt folder of its own and renamed to the
next free version. The rename refuses an existing target, so two writers never
share a version, and a write that fails leaves nothing that a reader or the
next writer could meet. Readers take the highest version whose write carries
Spark's ``_SUCCESS`` marker.
"""
from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_VERSION = "version="


class SnapshotError(ValueError):
    """A document failed validation; nothing was published."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _versions(spark: SparkSession, root: str, name: str) -> dict[int, bool]:
    """Every version of a snapshot and whether its write was committed."""
    folder = _path(spark, f"{root.rstrip('/')}/{name}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return {}
    found = {}
    for entry in fs.listStatus(folder):
        label = entry.getPath().getName()
        if label.startswith(_VERSION):
            found[int(label[len(_VERSION):])] = fs.exists(_path(spark, f"{entry.getPath()}/_SUCCESS"))
    return found


def latest_version(spark: SparkSession, root: str, name: str) -> int | None:
    return max((v for v, committed in _versions(spark, root, name).items() if committed), default=None)


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to a path that must not exist; False where it does."""
    fs = spark._jvm.org.apache.hadoop.fs
    src = _path(spark, source)
    context = fs.FileContext.getFileContext(src.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(src, _path(spark, target), options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def commit(spark: SparkSession, attempt: str, folder: str) -> int:
    """Rename a written attempt to the next free version of a folder."""
    root, _, name = folder.rstrip("/").rpartition("/")
    version = max(_versions(spark, root, name), default=0) + 1
    while not _rename(spark, attempt, f"{folder.rstrip('/')}/{_VERSION}{version}"):
        version += 1
    return version


def attempt_path(folder: str) -> str:
    return f"{folder.rstrip('/')}/_attempt-{uuid.uuid4().hex}"


def mark_complete(spark: SparkSession, folder: str) -> None:
    """Leave the marker that tells a whole version from one that failed."""
    marker = _path(spark, f"{folder.rstrip('/')}/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, True).close()


def version_path(spark: SparkSession, folder: str, version: int | None = None) -> str:
    """The path of a committed version, the latest one if none is named."""
    root, _, name = folder.rstrip("/").rpartition("/")
    found = _versions(spark, root, name)
    version = max((v for v, whole in found.items() if whole), default=None) if version is None else version
    if version is None or not found.get(version):
        raise SnapshotError(f"{folder} has no committed version{'' if version is None else f' {version}'}")
    return f"{folder.rstrip('/')}/{_VERSION}{version}"


def drop_older(spark: SparkSession, folder: str, keep: int) -> None:
    """Delete the committed versions of a folder before the ``keep`` newest."""
    root, _, name = folder.rstrip("/").rpartition("/")
    whole = sorted(v for v, committed in _versions(spark, root, name).items() if committed)
    for version in whole[:max(0, len(whole) - max(1, keep))]:
        path = _path(spark, f"{folder.rstrip('/')}/{_VERSION}{version}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def publish(doc: DataFrame, root: str, name: str, checks: DataFrame | None = None) -> int:
    """Validate then write ``doc`` (one row) as the next version.

    ``checks`` is a one-row DataFrame with a boolean column ``ok`` and an
    optional ``reason``; a false or missing ``ok`` raises before any write.
    """
    spark = doc.sparkSession
    if checks is not None:
        row = checks.first()
        if row is None or not row["ok"]:
            reason = row["reason"] if row is not None and "reason" in row.asDict() else "no result"
            raise SnapshotError(f"refusing to publish {name}: {reason}")
    folder = f"{root.rstrip('/')}/{name}"
    attempt = attempt_path(folder)
    doc.coalesce(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(attempt)
    return commit(spark, attempt, folder)


def read_latest(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """Rows of the highest committed version, or None before the first one."""
    v = latest_version(spark, root, name)
    return None if v is None else spark.read.parquet(f"{root.rstrip('/')}/{name}/{_VERSION}{v}")


def readiness(spark: SparkSession, root: str, name: str) -> DataFrame:
    """one row ``status, version, generated_at`` ('ok' or 'not_ready')."""
    v = latest_version(spark, root, name)
    if v is None:
        return spark.createDataFrame([("not_ready", None, None)], "status string, version int, generated_at string")
    doc = spark.read.parquet(f"{root.rstrip('/')}/{name}/{_VERSION}{v}")
    return doc.select(F.lit("ok").alias("status"), F.lit(v).cast("int").alias("version"),
                      F.col("generated_at").cast("string").alias("generated_at")).limit(1)
