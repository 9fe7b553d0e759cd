"""Temperature mixing of sources with budgeted block permutations.

Source i holds the token share p_i and gets the weight p_i**a / sum(p**a). The
exponent a is the smallest in [0, 1] under which neither the entropy of the
weights passes the target nor a source is repeated more often than the limit
allows; both fall as a grows, so a is found by bisection (sixteen cuts a job).

Within a source, a hash deals documents to blocks of about ``BLOCK_DOCS`` and
orders them inside the block; the blocks in turn form a permutation of the
source. A source takes as many whole passes as its budget holds and then the
permutation's documents up to the budget. That cut is one (block, key) pair per
source, so the texts are never shuffled: each row finds its number of copies
from a table with one row per source.

The order of the mix follows from its copies without their texts. Every pass over
a source permutes its blocks anew, by a hash of pass and block, and spreads them
over its part of the mix; a copy's place among all copies is counted by prefix
sums. So blocks stay whole, the sources are interleaved, and every stretch of the
mix holds them at about their weights.

Defined results: a null source is a source of its own; documents without words
count zero tokens and are taken with the pass they fall in; a source without
any token is taken once; equal rows share a key and are taken together, so a
cut may pass the budget by one document and its equals; an empty table gives
an empty mix; columns of the input are kept as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.sharding import with_offsets
from gridloom.session import materialize

#: Share of the largest possible entropy (all sources alike) that the weights may reach.
TARGET_ENTROPY = 0.998
#: Passes over a source, at most.
REPETITION_LIMIT = 2.0
BLOCK_DOCS = 1024
SEED = 17
#: Cuts of the bracket per job, and jobs: 16**6 steps of the exponent.
GRID, ROUNDS = 16, 6
#: A table with one row per source is broadcast up to this many rows (some 100 bytes each).
BROADCAST_SOURCES = 50_000


def tokens(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _source_key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))


def _order_key() -> Column:
    return F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def find_exponent(totals: DataFrame, target_entropy: float, limit: float) -> float:
    """Smallest exponent that keeps both limits; ``totals`` has one row per source.

    Only aggregates over sources reach the driver: sixteen rows a round.
    """
    logs = totals.filter("tokens > 0").select(F.log("tokens").alias("t"))
    few = logs.agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).first()
    if few.n < 2 or few.lo == few.hi:
        return 1.0
    most = target_entropy * math.log(few.n)

    def fits(row) -> bool:
        entropy = math.log(row.z) - row.a * row.s / row.z
        # Passes relative to the source that is taken exactly once.
        return entropy <= most and math.exp((1 - row.a) * (few.hi - few.lo)) <= limit

    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        cuts = [low + (high - low) * i / GRID for i in range(GRID)]
        x = F.col("t") - F.lit(few.hi)
        grid = logs.select("t", F.explode(F.array(*map(F.lit, cuts))).alias("a"))
        rows = sorted(grid.groupBy("a").agg(F.sum(F.exp(F.col("a") * x)).alias("z"),
                                            F.sum(F.exp(F.col("a") * x) * x).alias("s")).collect())
        good = [row.a for row in rows if fits(row)]
        if good and good[0] == cuts[0]:
            return cuts[0]
        high = good[0] if good else high
        low = max(c for c in cuts if c < high)
    return high


def plan(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, limit: float = REPETITION_LIMIT,
         budget: int | None = None) -> tuple[DataFrame, int]:
    """One row per source: tokens, weight, passes, and where its last pass is cut.

    Without a budget, the mix is as large as it must be to take every document
    once: the source with the least weight per token gets one pass, all others
    at least one. Returns the table and its number of rows.
    """
    rows = materialize(docs.select(_source_key("source").alias("mix_source"), tokens().alias("tokens"),
                                   _order_key().alias("mix_key")))
    totals = materialize(rows.groupBy("mix_source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")))
    n = totals.count()
    a = find_exponent(totals, target_entropy, limit)
    scale = totals.filter("tokens > 0").agg(
        F.max("tokens").alias("top"), F.sum("tokens").alias("all")).first()
    top, whole = float(scale.top or 1), float(scale.all or 1)
    share = F.pow(F.col("tokens") / F.lit(top), F.lit(a))
    z = totals.filter("tokens > 0").agg(F.sum(share).alias("z")).first().z or 1.0
    weight = F.when(F.col("tokens") > 0, share / F.lit(z)).otherwise(F.lit(0.0))
    # Weight per token falls with the size of the source, so the largest one is taken least often.
    size = F.lit(float(budget) if budget is not None else top * z)
    passes = F.when(F.col("tokens") > 0, F.col("weight") * size / F.col("tokens")).otherwise(F.lit(1.0))
    # A pass short of a whole one by rounding error only is a whole one.
    whole_passes = F.floor(F.col("passes") + F.lit(1e-9))
    sources = (totals.withColumn("weight", weight).withColumn("passes", passes)
               .withColumn("full", whole_passes.cast("long"))
               .withColumn("rest", F.greatest(F.lit(0), F.round((F.col("passes") - F.col("full")) * F.col("tokens"))).cast("long"))
               .withColumn("blocks", F.ceil(F.col("docs") / F.lit(BLOCK_DOCS)).cast("long"))
               .withColumn("exponent", F.lit(a)).withColumn("share", F.col("tokens") / F.lit(whole)))
    dealt = (rows.join(_small(sources.select("mix_source", "blocks", "rest"), n), "mix_source")
             .withColumn("mix_block", _block()))
    order = Window.partitionBy("mix_source").orderBy("mix_block").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (dealt.groupBy("mix_source", "mix_block", "rest").agg(F.sum("tokens").alias("tokens"))
            .withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0)))
            .filter("before < rest AND before + tokens >= rest")
            .select("mix_source", "mix_block", "before"))
    # One block per source is read row by row.
    inside = Window.partitionBy("mix_source").orderBy("mix_key").rangeBetween(Window.unboundedPreceding, -1)
    last = (dealt.join(_small(cuts, n), ["mix_source", "mix_block"])
            .withColumn("at", F.col("before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
            .filter("at < rest").groupBy("mix_source", F.col("mix_block").alias("cut_block"))
            .agg(F.max("mix_key").alias("cut_key")))
    return materialize(sources.join(last, "mix_source", "left")), n


def _block() -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED + 1), F.col("mix_key")), F.col("blocks"))


def mix_with_plan(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, limit: float = REPETITION_LIMIT,
                  budget: int | None = None) -> DataFrame:
    """``row`` (a struct of all columns of docs), ``epoch``, ``mix_block`` and ``source_plan``, per copy taken."""
    sources, n = plan(docs, target_entropy, limit, budget)
    side = sources.select("mix_source", "blocks", F.struct(
        "full", "cut_block", "cut_key", "exponent", "share", "weight", "passes").alias("source_plan"))
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       _source_key("source").alias("mix_source"), _order_key().alias("mix_key"))
    cut, key = F.col("source_plan.cut_block"), F.col("source_plan.cut_key")
    in_last = (F.col("mix_block") < cut) | ((F.col("mix_block") == cut) & (F.col("mix_key") <= key))
    copies = F.col("source_plan.full") + F.coalesce(in_last, F.lit(False)).cast("long")
    return (kept.join(_small(side, n), "mix_source").withColumn("mix_block", _block())
            .select("row", "mix_block", "source_plan",
                    F.posexplode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("epoch", "_")).drop("_"))


def positions(copies: DataFrame) -> DataFrame:
    """Add ``position``, from 0 on without a gap, to copies (doc_id, source, epoch, block, passes, ...) of a mix."""
    # Where a block begins in its pass, and the pass in the mix; a last pass may be a part of one.
    place = F.pmod(F.xxhash64(F.lit(SEED + 2), F.col("epoch"), _source_key("source"), F.col("_block")), F.lit(1 << 40)) / F.lit(1 << 40)
    length = F.greatest(F.least(F.lit(1.0), F.col("passes") - F.col("epoch")), F.lit(0.0))
    rows = materialize(copies.withColumnRenamed("block", "_block").select(
        "*", F.lit(1).cast("long").alias("_one"), ((F.col("epoch") + place * length) / F.col("passes")).alias("_time"),
        _source_key("source").alias("_source"), F.xxhash64(F.lit(SEED + 3), F.col("epoch"), F.col("doc_id")).alias("_row")))
    order = ("_time", "_source", "epoch", "_block", "_row", "doc_id")
    kept = [F.col("_block" if c == "block" else c).alias(c) for c in copies.columns]
    return with_offsets(rows, "_one", order).drop("block").select(*kept, F.col("rank").alias("position"))


def mix(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, limit: float = REPETITION_LIMIT,
        budget: int | None = None) -> DataFrame:
    """The rows of docs with all their columns, each as often as its source's budget takes it."""
    return mix_with_plan(docs, target_entropy, limit, budget).select("row.*")
