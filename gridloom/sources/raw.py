"""Raw (ODS) scans and layer persistence."""
from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom.sources import snapshot as SN

BOM = "﻿"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every column text, structural errors fail the read.

    No schema is given: columns are matched by header name (an explicit
    schema would map them by position). Empty and quoted-empty cells are NULL.
    """
    df = (spark.read.option("header", True).option("mode", "FAILFAST")
          .option("inferSchema", False).option("encoding", "UTF-8").csv(path))
    return clean_header(df)


def clean_header(df: DataFrame) -> DataFrame:
    """Strip a UTF-8 byte-order mark from header names."""
    names = [c.lstrip(BOM) for c in df.columns]
    return df if names == df.columns else df.toDF(*names)


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """Header CSV; with ``bom`` the first header name carries a UTF-8 BOM the
    way some producers export it (used to exercise :func:`clean_header`)."""
    if bom and df.columns:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    # Blank cells ("  ") must survive the round trip; NULL is written empty.
    (df.write.mode("overwrite").option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


# Upper bound of rows per output file: keeps files of a partitioned layer
# (e.g. one month written by many tasks) splittable and evenly sized.
MAX_RECORDS_PER_FILE = 20_000_000


#: Versions of a layer that stay: the newest, and the one that a reader may still hold.
KEEP_VERSIONS = 2


def write_layer(df: DataFrame, root: str, layer: str, name: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, keep: int = KEEP_VERSIONS) -> str:
    """The next version of one table of a layer (S3/S4); the path of the version.

    The rows go to an attempt folder that is renamed when it is whole, so a
    write that fails or is killed leaves the layer as it was, and a reader of
    the version before goes on during a rerun. Versions older than the ``keep``
    newest are deleted then.
    """
    folder = f"{root.rstrip('/')}/{layer}/{name}"
    attempt = SN.attempt_path(folder)
    w = (df.write.format(fmt).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
         .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(attempt)
    version = SN.commit(df.sparkSession, attempt, folder)
    SN.drop_older(df.sparkSession, folder, keep)
    return SN.version_path(df.sparkSession, folder, version)


def read_layer(spark: SparkSession, root: str, layer: str, name: str,
               fmt: str = "parquet", version: int | None = None) -> DataFrame:
    """A committed version of a table, the latest one if none is named."""
    return spark.read.format(fmt).load(SN.version_path(spark, f"{root.rstrip('/')}/{layer}/{name}", version))


def write_document(doc: DataFrame, path: str) -> None:
    """The ``payload`` of a one-row document as one UTF-8 text file."""
    doc.select("payload").coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("wholetext", True).text(path).withColumnRenamed("value", "payload")


def write_report(report: DataFrame, path: str) -> None:
    """A report as one CSV file with a header."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A report with its types; a header of other names or a value that does not fit fails the read."""
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("mode", "FAILFAST").csv(path))


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments (S6) as schema metadata. Parquet keeps them, ORC does not."""
    return df.select(*[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments
                       else F.col(c) for c in df.columns])


def write_typed_orc(df: DataFrame, path: str, comments: Mapping[str, str]) -> None:
    """Typed table stored as ORC, replaced as a whole, with its schema and column comments beside the data."""
    typed = with_comments(df, comments)
    typed.write.mode("overwrite").orc(path)
    # Spark's readers skip names that begin with an underscore.
    (df.sparkSession.createDataFrame([(typed.schema.json(),)], "value string").coalesce(1)
     .write.mode("overwrite").text(f"{path.rstrip('/')}/{SCHEMA_SIDECAR}"))


#: Folder of the schema beside the data of a typed table.
SCHEMA_SIDECAR = "_schema"


class SchemaError(ValueError):
    """The files of a table do not hold what its schema says."""


def read_typed_orc(spark: SparkSession, path: str) -> DataFrame:
    """A table of :func:`write_typed_orc` with its column comments; files of another schema are refused."""
    text = spark.read.text(f"{path.rstrip('/')}/{SCHEMA_SIDECAR}").first()["value"]
    schema = StructType.fromJson(json.loads(text))
    stored = spark.read.orc(path).schema
    if [(f.name, f.dataType) for f in stored] != [(f.name, f.dataType) for f in schema]:
        raise SchemaError(f"{path} holds {stored.simpleString()}, not {schema.simpleString()}")
    return spark.read.schema(schema).orc(path)
