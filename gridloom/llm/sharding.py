"""Contiguous byte-balanced shards from global prefix sums.

Rows are range-partitioned in their global order, each partition becomes a
block whose total is summed once, and a running sum over the block totals (one
row per partition) gives every block its global offset. A row's global byte
offset is the block's offset plus the running sum inside the block, so no task
ever sees more than one partition. The byte axis is cut at equal targets: a row
goes to the shard that holds its middle byte. The law is ``bytes``.

Defined results: a null text has no bytes (size 8, crc 0); rows order by
doc_id (nulls first), size, crc, so repeated rows stay adjacent and may be
swapped among themselves without a change of the result; an empty table gives
an empty assignment; a row larger than a target may leave a shard empty; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.common import text_bytes
from gridloom.session import materialize

#: Bytes that each row costs besides its text.
ROW_OVERHEAD = 8
ORDER = ("doc_id", "size", "text_crc32")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size and crc of each row; the text stays behind."""
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text_bytes()).cast("long").alias("text_crc32"))


def with_offsets(rows: DataFrame, size: str, order: tuple[str, ...]) -> DataFrame:
    """Add ``start`` (bytes before the row), ``rank`` (rows before it) and ``total`` bytes.

    The block of a row is fixed by writing the range-partitioned rows once, so
    a recomputed partition cannot move rows between blocks.
    """
    blocks = materialize(rows.repartitionByRange(*order).withColumn("block", F.spark_partition_id()))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (blocks.groupBy("block").agg(F.sum(size).alias("bytes"), F.count("*").alias("rows"))
               .select("block",
                       F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("block_start"),
                       F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("block_rank"),
                       F.sum("bytes").over(Window.orderBy("block").rowsBetween(
                           Window.unboundedPreceding, Window.unboundedFollowing)).alias("total")))
    inside = Window.partitionBy("block").orderBy(*order)
    running = F.coalesce(F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    position = F.row_number().over(inside) - 1
    # One row per partition of the write: the broadcast side is bounded by the number of tasks.
    return (blocks.select("*", running.alias("_running"), position.alias("_position"))
            .join(F.broadcast(offsets), "block")
            .select(*rows.columns, (F.col("block_start") + F.col("_running")).alias("start"),
                    (F.col("block_rank") + F.col("_position")).cast("long").alias("rank"), "total"))


def shard_by_bytes(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    cut = F.expr(f"least(cast((2 * start + size) * {shards} div (2 * total) as int), {shards - 1})")
    placed = with_offsets(sizes(docs), "size", ORDER).select(*ORDER, "rank", cut.alias("shard"))
    # One row per shard.
    first = placed.groupBy("shard").agg(F.min("rank").alias("first_rank"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("first_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
