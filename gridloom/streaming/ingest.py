"""Incremental landing of raw session files (Structured Streaming).

New CSV files under a directory are read as text columns, classified with the
same rule as the batch job, and appended to the DWD classified table, one
partition per micro-batch. ``foreachBatch`` is at-least-once; writing each
batch to its own ``batch=<id>`` partition in overwrite mode makes a replayed
batch replace its earlier attempt, so the table stays exact. Deduplication and
the rollups stay batch operations over the landed table (exact duplicates may
arrive in different files and batches).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridloom.functions import columns as C
from gridloom.operators import sessions as S


def raw_stream(spark: SparkSession, path: str, columns: Sequence[str] = S.RAW_SESSION_COLUMNS,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Text columns of every new header CSV file under ``path``; a file whose header
    names other columns, or the same in another order, fails the query."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    r = spark.readStream.schema(schema).option("header", True).option("mode", "FAILFAST") \
        .option("enforceSchema", False)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)


def land_batch(batch: DataFrame, batch_id: int, target: str,
               century_years: Sequence[str] = C.DEFAULT_CENTURY_YEARS) -> None:
    classified = S.classify(S.type_sessions(batch, century_years))
    (classified.write.mode("overwrite").partitionBy("is_valid")
     .parquet(f"{target.rstrip('/')}/batch={batch_id}"))


def start(spark: SparkSession, source: str, target: str, checkpoint: str,
          century_years: Sequence[str] = C.DEFAULT_CENTURY_YEARS, available_now: bool = True) -> StreamingQuery:
    """Start the landing query; ``available_now`` processes what is there and stops."""
    w = (raw_stream(spark, source).writeStream
         .foreachBatch(lambda df, bid: land_batch(df, bid, target, century_years))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """All landed batches (``is_valid`` typed back to boolean)."""
    return spark.read.parquet(target).withColumn("is_valid", F.col("is_valid").cast("boolean"))
