"""The mix against its plan computed plainly, and the order of its copies."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridloom.llm import mixing, queries

SMALL = "/root/testdata/sf0.01"


def plain_exponent(tokens, target, limit):
    """The smallest exponent that keeps the entropy and the repetition, by plain bisection."""
    held = [t for t in tokens if t]
    total = sum(held)

    def good(a):
        raw = [(t / total) ** a for t in held]
        weights = [r / sum(raw) for r in raw]
        entropy = -sum(w * math.log(w) for w in weights)
        per_token = [w / t for w, t in zip(weights, held)]
        return entropy <= target * math.log(len(held)) + 1e-12 and max(per_token) / min(per_token) <= limit + 1e-12

    if good(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if good(middle) else (middle, high)
    return high


def test_copies_follow_the_plan(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    copies = queries.op4_mixing(spark, SMALL).collect()
    held = docs.select("doc_id", "source", mixing.tokens().alias("n"), mixing._order_key().alias("key")).collect()
    tokens, size = Counter(), Counter()
    for r in held:
        tokens[r.source] += r.n
        size[r.source] += 1
    a = copies[0].exponent
    assert a == pytest.approx(plain_exponent(tokens.values(), mixing.TARGET_ENTROPY, mixing.REPETITION_LIMIT), abs=1e-5)
    top = max(tokens.values())
    raw = {s: (t / top) ** a for s, t in tokens.items()}
    whole = sum(raw.values())
    blocks = {(r.doc_id, r.source): r.block for r in copies}
    want = Counter()
    for s in tokens:
        passes = raw[s] / whole * top * whole / tokens[s]  # the largest source is taken once
        full = math.floor(passes + 1e-9)
        rest, before = round((passes - full) * tokens[s]), 0
        for r in sorted((r for r in held if r.source == s), key=lambda r: (blocks[r.doc_id, s], r.key)):
            want[r.doc_id] += full + (before < rest)
            before += r.n
    got = Counter(r.doc_id for r in copies)
    differ = [d for d in want if want[d] != got[d]]
    assert len(differ) <= len(tokens)  # the exponent is bisected to 1e-7, which may move a cut by a document


def test_order_of_the_mix(spark):
    rows = [(i, "w " * (1 + i % 7), "big" if i % 4 else "small") for i in range(9000)] + [(9000, None, None), (9001, "", "big")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    mixed = mixing.mix_with_plan(docs, target_entropy=2.0, limit=2.5).select(
        "row.doc_id", "row.source", "epoch", F.col("mix_block").alias("block"), "source_plan.passes")
    out = sorted(mixing.positions(mixed).collect(), key=lambda r: r.position)
    assert [r.position for r in out] == list(range(len(out)))
    assert Counter((r.doc_id, r.epoch) for r in out) == Counter((r.doc_id, r.epoch) for r in mixed.collect())
    runs = [(r.source, r.epoch, r.block) for r in out]
    assert len({*runs}) == 1 + sum(x != y for x, y in zip(runs, runs[1:]))  # a block of a pass stays together
    passes = defaultdict(list)
    for s, e, b in dict.fromkeys(runs):
        passes[s, e].append(b)
    assert passes["big", 0] != sorted(passes["big", 0]) or passes["small", 0] != passes["small", 1][:len(passes["small", 0])]
    half = Counter(r.source for r in out[:len(out) // 2])
    whole = Counter(r.source for r in out)
    for s in ("big", "small"):
        assert 0.25 < half[s] / whole[s] < 0.75  # sources are interleaved
    assert mixing.positions(mixed.filter("false")).count() == 0
