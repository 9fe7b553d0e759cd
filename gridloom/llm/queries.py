"""One registered query per corpus operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import (collision_search, decontaminate, filter_audit, html_text, merkle, mixing, near_dup, pii,
                          quality_model, quality_rules, rlz, sharding, warc)
from gridloom.llm.common import table
from gridloom.llm.oracles import ORACLES  # noqa: F401
from gridloom.session import scratch_path

SHARDS = 24


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measurements, failure bits and the verdict of the current policy."""
    entries = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          "base_failed", "kept", "failed", "policy")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 contiguous shards of near equal bytes."""
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and benchmark item that it holds, with the edits between them."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per copy of a document in the mix, with the weight of its source and its place in the order of the mix."""
    mixed = mixing.mix_with_plan(table(spark, sf_dir, "documents"))
    return mixing.positions(mixed.select(
        "row.doc_id", "row.source", mixing.tokens("row.text").alias("n_tokens"), "epoch",
        F.col("mix_block").alias("block"), "source_plan.exponent", "source_plan.share", "source_plan.weight",
        "source_plan.passes"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path, payloads=False).filter("kind = 'record'")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a model of the labels outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.train(docs, table(spark, sf_dir, "labels")))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document, and whether it stands for the class."""
    found = near_dup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("is_kept"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document after repeated 13-word windows are removed."""
    return rlz.remove_duplicate_spans(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the plain personal data of every document, and all spans."""
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether the row after tampering still verifies."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth vector."""
    return collision_search.search(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes and loses at each step of every order, by language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_sharding, op3_decontamination, op4_mixing, op5_warc,
                            op6_quality_classifier, op7_html_extraction, op8_order_minhash, op9_substring_dedup,
                            op10_pii, op11_merkle_manifest, op12_collision_search,
                            op13_filter_audit)}
