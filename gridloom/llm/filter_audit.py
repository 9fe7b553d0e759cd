"""What each filter removes in every order of the filters, from one pass over the texts.

Every document gets a mask of the filters that it fails, and documents are
counted by part and mask. In an order of the filters a document is removed at
the first step whose filter is in its mask. Orders are ranked by their Lehmer
code, that is in lexicographic order, so all orders that begin alike are one
interval of ranks: a mask is removed at a step by the orders that begin with
filters outside the mask and one inside it, which are a few intervals. The
count of a mask is added where such an interval begins and taken off where it
ends; a running sum over the ranks then gives the removals of all orders.

Texts never leave the scan: a row is a digest, the label of its document and
the mask. Counts by digest are pre-aggregated before each shuffle, so a text
that a third of all rows share is a few rows of each task.

Defined results: a null text is empty and a null language is the part with the
empty name; equal texts under one doc_id are both first; a row with a null
doc_id is no one's copy, and no one's original; several label rows of a doc_id
count as one that has each mark which one of them has; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.session import materialize

FILTERS = "ABCDE"
#: Orders of the filters.
ORDERS = factorial(len(FILTERS))
WORD = r"[^\x20\x09-\x0D]+"
MARKS = "#$%&*|"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def _count(text: Column, chars: str) -> Column:
    """Number of characters of text that are in chars."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def failed_alone(text: Column) -> Column:
    """Bits of the filters that judge a text by itself: few words, few distinct words, capitals, marks."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n_words = F.size(words)
    fails = {"A": n_words < 100,
             "B": F.lit(100) * F.size(F.array_distinct(words)) < F.lit(80) * n_words,
             "C": F.lit(100) * _count(text, _UPPER) > F.lit(10) * F.length(text),
             "D": _count(text, MARKS) > 0}
    return sum((F.when(fails[k], F.lit(bit(k))).otherwise(F.lit(0)) for k in fails), F.lit(0))


def marks(labels: DataFrame) -> DataFrame:
    """One row per labelled doc_id: good and toxic."""
    return labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents, and labelled ones, of each part and set of failed filters."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.sha2(text, 256).alias("digest"),
                       failed_alone(text).alias("fails"))
    rows = rows.join(marks(labels), "doc_id", "left").fillna(0, ["good", "toxic"])
    cell = ("digest", "part", "good", "toxic")
    # A cell counts its rows and those of its least doc_id; the digest's least one tells which of them are first.
    ids = rows.groupBy(*cell, "doc_id").agg(F.count("*").alias("n"), F.first("fails").alias("fails"))
    cells = ids.groupBy(*cell).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("low"), F.min_by("n", "doc_id").alias("at_low"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.first("fails").alias("fails"))
    # A digest has a cell for each part and pair of marks at most.
    least = F.min("low").over(Window.partitionBy("digest"))
    first = F.col("unnamed") + F.when(F.col("low") == least, F.col("at_low")).otherwise(0)
    split = cells.withColumn("first", first).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("fails").alias("mask"), F.col("first").alias("n")),
            F.struct((F.col("fails") + bit("E")).alias("mask"), (F.col("n") - F.col("first")).alias("n")))).alias("of"))
    n = F.col("of.n")
    return split.groupBy("part", F.col("of.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def lehmer_rank(order: str) -> int:
    """Rank of the first order, among all in lexicographic order, that begins with the given filters."""
    rest, rank = list(FILTERS), 0
    for letter in order:
        rank += rest.index(letter) * factorial(len(rest) - 1)
        rest.remove(letter)
    return rank


def removal_intervals() -> Iterator[tuple[int, int, int, int]]:
    """(mask, step, start, stop): orders start to stop - 1 remove the mask at that step."""
    for mask in range(1 << len(FILTERS)):
        outside = [k for k in FILTERS if not mask & bit(k)]
        for step in range(1, len(FILTERS) + 1):
            for before in permutations(outside, step - 1):
                for letter in (k for k in FILTERS if mask & bit(k)):
                    start = lehmer_rank("".join(before) + letter)
                    yield mask, step, start, start + factorial(len(FILTERS) - step)


def orders() -> Iterator[tuple[int, str, int, str, int]]:
    """(rank, filter_order, step, letter, bit) of every step of every order."""
    for order in permutations(FILTERS):
        name = "".join(order)
        for step, letter in enumerate(order, 1):
            yield lehmer_rank(name), name, step, letter, bit(letter)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step: what is kept, removed, redundant and lost there."""
    spark = docs.sparkSession
    # Both tables are fixed by the number of filters: 840 intervals and 600 steps.
    intervals = F.broadcast(spark.createDataFrame(list(removal_intervals()), "mask int, step int, start int, stop int"))
    steps = F.broadcast(spark.createDataFrame(list(orders()),
                                              "rank int, filter_order string, step int, letter string, bit int"))
    # A row per part and mask, read three times below; the texts are read once.
    counts = materialize(mask_counts(docs, labels))
    measures = ("n", "good", "toxic")

    def end(at: str, sign: int) -> Column:
        return F.struct(F.col(at).alias("rank"), *[(F.lit(sign) * F.col(m)).alias(m) for m in measures])

    ends = counts.join(intervals, "mask").select("part", "step", F.explode(F.array(end("start", 1), end("stop", -1)))
                                                 .alias("at")).select("part", "step", "at.*")
    # Every rank takes part, with nothing where no interval begins or ends.
    blank = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
                                                    .alias("step"))
    blank = blank.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("rank"),
                         *[F.lit(0).cast("long").alias(m) for m in measures])
    jumps = ends.unionByName(blank).groupBy("part", "step", "rank").agg(*[F.sum(m).alias(m) for m in measures])
    upto = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = jumps.select("part", "step", "rank", F.sum("n").over(upto).alias("removed"),
                           F.sum("good").over(upto).alias("good_lost"), F.sum("toxic").over(upto).alias("toxic_lost"))
    # Documents of the part, those that fail a filter, and those that fail it alone.
    alone = [F.sum(F.when(F.col("mask") == bit(k), F.col("n")).otherwise(0)).alias(f"alone_{k}") for k in FILTERS]
    fails = [F.sum(F.when(F.col("mask").bitwiseAND(bit(k)) != 0, F.col("n")).otherwise(0)).alias(f"fails_{k}")
             for k in FILTERS]
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"), *alone, *fails)

    def own(kind: str) -> Column:
        return F.coalesce(*[F.when(F.col("letter") == k, F.col(f"{kind}_{k}")) for k in FILTERS])

    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return (removed.join(steps, ["rank", "step"]).join(parts, "part")
            .select("part", "filter_order", "step", (F.col("total") - F.sum("removed").over(so_far)).alias("kept"),
                    "removed", (own("fails") - F.col("removed")).alias("redundant"),
                    own("alone").alias("unique_fails"), "good_lost", "toxic_lost",
                    F.sum("removed").over(Window.partitionBy("part", "letter")).alias("shapley")))
