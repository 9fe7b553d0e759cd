"""Salvage on the archives that the writer makes, and their size."""
import os

import pytest
from pyspark.sql import functions as F

from gridloom.llm import warc


def _parts(path):
    return sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-"))


@pytest.fixture()
def pages(spark):
    return spark.range(600).select(F.col("id").alias("page_id"), F.concat(F.lit("http://x/"), "id").alias("url"),
                                   F.concat(F.lit("<p>"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 5)).alias("html"))


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 0.999])
def test_a_damaged_byte_costs_one_record(spark, pages, tmp_path, share):
    path = str(tmp_path / "warc")
    warc.write_archives(pages.coalesce(1), path)
    whole = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    assert len(whole) == 600 and {r.kind for r in whole.values()} == {"record"}
    (file,) = _parts(path)
    data = bytearray(open(file, "rb").read())
    # A byte of a payload or of the first version line.
    at = int(share * len(data))
    at = at if share == 0 else data.find(b"<p>", at if share < 0.9 else at - 900) + 40
    data[at] ^= 0x01
    hurt = str(tmp_path / "hurt")
    os.mkdir(hurt)
    open(os.path.join(hurt, "part-0.txt"), "wb").write(bytes(data))
    back = warc.read_archives(spark, hurt).collect()
    records = {r.page_id: r for r in back if r.kind == "record"}
    gaps = [r for r in back if r.kind == "gap"]
    (lost,) = set(whole) - set(records)
    assert len(records) == 599 and len(gaps) == 1
    assert (gaps[0].offset, gaps[0].length) == (whole[lost].offset, whole[lost].length)
    assert gaps[0].offset <= at < gaps[0].offset + gaps[0].length
    assert all(records[i].payload == whole[i].payload and records[i].offset == whole[i].offset for i in records)


def test_long_pages_make_more_archives(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 64_000)
    path = str(tmp_path / "warc")
    warc.write_archives(pages.coalesce(1), path)
    sizes = [os.path.getsize(f) for f in _parts(path)]
    assert len(sizes) > 3 and max(sizes) < 3 * 64_000
    assert warc.read_archives(spark, path).filter("kind = 'record'").count() == 600


def test_few_copies_move_no_payload(spark, pages):
    rows = warc.with_record_types(pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 1000).limit(3)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert rows.filter("record_type = 'revisit'").count() == 3
