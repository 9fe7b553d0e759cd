"""Near-duplicates against a plain edit distance over all pairs."""

import os
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridloom.llm import components, near_dup
from tests.llm.test_operators import prose, words


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def within(a, b, band):
    """Whether at most band edits lie between two sequences, by the whole table of distances, a row at a time."""
    codes = {w: i for i, w in enumerate({*a, *b})}
    b = np.array([codes[w] for w in b])
    step = np.arange(len(b) + 1)
    row = step.copy()
    for i, w in enumerate(a, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (b != codes[w]))])
        row = np.minimum.accumulate(new - step) + step
        if row.min() > band:
            return False
    return row[-1] <= band


def linked_pairs(texts):
    """All pairs of unlike texts whose edits are at most a fifth of the longer one.

    Such pairs of four words or more share a pair of neighbouring words; shorter ones have no edits.
    """
    held = defaultdict(list)
    for i, t in texts.items():
        held[t].append(i)
    texts = {min(ids): words(t) for t, ids in held.items()}
    grams = {i: Counter(zip(w, w[1:])) for i, w in texts.items()}
    index, shared = defaultdict(list), Counter()
    for i in sorted(grams):
        for g in grams[i]:
            for other in index[g]:
                shared[other, i] += min(grams[i][g], grams[other][g])
            index[g].append(i)
    out = []
    for (a, b), n in shared.items():
        longer = max(len(texts[a]), len(texts[b]))
        band = longer // 5
        if n >= longer - 1 - 2 * band and abs(len(texts[a]) - len(texts[b])) <= band and within(texts[a], texts[b], band):
            out.append((a, b))
    return out


def named(texts, links):
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    first = {}
    for i in sorted(texts):
        links = [*links, (first.setdefault(texts[i] or "", i), i)]
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {i: find(i) for i in texts}


def edited(base, edits, rng):
    out = list(base)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = f"new{rng.random()}"
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, f"more{rng.random()}")
    return out


def test_classes_equal_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rng = random.Random(2)
    base = prose(150, 50).split()
    for n in range(60):  # a large group, with members beyond their leader's reach
        texts[100000 + n] = " ".join(edited(base, rng.randrange(12), rng))
    for n, (size, edits) in enumerate([(100, 3), (200, 6), (50, 2), (60, 6), (61, 8), (20, 2), (10, 1), (400, 40)]):
        one = prose(size, 900 + n).split()
        texts[200000 + 2 * n], texts[200001 + 2 * n] = " ".join(one), " ".join(edited(one, edits, rng))
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    want = named(texts, linked_pairs(texts))
    assert {r.doc_id: r.class_id for r in near_dup.classes(rows).collect()} == want
    assert sorted(r.doc_id for r in near_dup.keep_one(rows).collect()) == sorted(set(want.values()))


def test_pairs_of_the_table_meet(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    links = linked_pairs(texts)
    got = {r.doc_id: r.class_id for r in near_dup.classes(docs).collect()}
    assert len(links) >= 60 and sum(got[a] == got[b] for a, b in links) >= 0.98 * len(links)
    assert all(got[i] >= c for i, c in named(texts, links).items())  # nothing else is linked


def test_unlike_members_of_large_buckets(spark, monkeypatch):
    """Many texts share a passage; a few of them are edits of one another, and all pairs go through blocks."""
    rng = random.Random(4)
    passage = prose(60, 7)
    texts = {n: passage + " " + prose(90, 1000 + n) for n in range(150)}
    for n in range(0, 40, 2):
        texts[1000 + n] = " ".join(edited(texts[n].split(), 6, rng))
    monkeypatch.setattr(near_dup, "BLOCK_MEMBERS", 16)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert {r.doc_id: r.class_id for r in near_dup.classes(rows).collect()} == named(texts, linked_pairs(texts))


def test_links_of_a_large_group_of_near_copies(spark, monkeypatch):
    """Each near copy shares some thirty buckets with the others; few of their links are needed to name its class."""
    rng = random.Random(6)
    base, other = prose(150, 60).split(), prose(150, 61).split()
    texts = {n: " ".join(edited(base, rng.randrange(12), rng)) for n in range(120)}
    texts |= {500 + n: " ".join(edited(other, rng.randrange(14), rng)) for n in range(60)}
    real, counts = near_dup.components, []

    def counted(links):
        counts.append(links.count())
        return real(links)

    monkeypatch.setattr(near_dup, "components", counted)
    rows = spark.createDataFrame([*texts.items(), (900, texts[3]), (901, texts[3])], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.class_id for r in near_dup.classes(rows).collect()}
    assert got == named({**texts, 900: texts[3], 901: texts[3]}, linked_pairs(texts))
    assert counts and max(counts) <= 4 * len(texts)


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in folders for _, _, files in os.walk(top.getPath()) for f in files if f.startswith("shuffle_")}


def test_steps_leave_no_shuffle_files(spark):
    """Else the shuffles of all steps lie on the disk together until the driver collects its garbage."""
    rng = random.Random(8)
    base = prose(150, 80).split()
    texts = {n: " ".join(edited(base, rng.randrange(12), rng)) for n in range(40)}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    before = shuffle_files(spark)
    found = near_dup.classes(rows)
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:  # executors delete them a little later
        time.sleep(0.2)
    assert not left
    assert {r.doc_id: r.class_id for r in found.collect()} == named(texts, linked_pairs(texts))


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    """Chains, stars, loops and double links, in both directions."""
    rng = random.Random(seed)
    links = [(n + 1, n) for n in range(0, 24)] + [(100, 101 + n) for n in range(20)] + [(7, 7), (-3, 100), (-3, 100), (200, 200)]
    links += [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(45)]
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    rows = spark.createDataFrame(links, "u long, v long").repartition(4)
    got = [(r.node, r.component) for r in components.components(rows).collect()]
    assert sorted(got) == sorted(named({n: f"t{n}" for n in nodes}, [x for x in links if x[0] != x[1]]).items())


def test_one_id_with_several_texts(spark):
    x, y, z = prose(80, 1), prose(80, 2), prose(80, 3)
    near = " ".join(edited(y.split(), 3, random.Random(1)))
    rows = spark.createDataFrame([(5, x), (5, y), (7, near), (3, x), (5, z), (9, z), (None, x)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.class_id or 0) for r in near_dup.classes(rows).collect())
    assert got == [(0, 0), (3, 3), (5, 3), (5, 5), (5, 5), (7, 5), (9, 5)]
    kept = sorted(((r.doc_id or 0), r.text) for r in near_dup.keep_one(rows).collect())
    assert kept == sorted([(0, x), (3, x), (5, y), (5, z)])


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(150):
        a = [rng.randrange(4) for _ in range(rng.randrange(12))]
        b = [rng.randrange(4) for _ in range(rng.randrange(12))]
        real = plain_distance(a, b)
        for band in (0, 1, 3, 20):
            want = real if real <= band else band + 1
            assert near_dup.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64), band) == want


@pytest.mark.parametrize("seed", range(4))
def test_edit_distance_of_many_edits(seed):
    rng = random.Random(seed)
    for size, edits in [(30, 5), (120, 20), (300, 70), (300, 300), (1, 1), (40, 0)]:
        a = [rng.randrange(50) for _ in range(size)]
        b = list(a)
        for _ in range(edits):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = [rng.randrange(50)] * rng.randrange(2)
        real = plain_distance(a, b)
        for band in (real - 1, real, real + 5, 2 * real):
            if band >= 0:
                got = near_dup.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64), band)
                assert got == (real if real <= band else band + 1)


@pytest.mark.parametrize("size, share, least", [(8, 0.875, 0.9), (20, 0.8, 0.9), (60, 0.8, 0.9), (100, 0.8, 0.85),
                                                (300, 0.8, 0.9), (100, 0.85, 0.95), (300, 0.9, 0.99)])
def test_sketches_meet_at_the_stated_similarity(size, share, least):
    import pandas as pd
    rng = random.Random(size)
    pairs = []
    for n in range(200):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(size)]
        pairs.append((" ".join(base), " ".join(edited(base, int((1 - share) * size + 1e-9), rng))))
    keys = [near_dup.sketch_batch(pd.Series([p[k].encode() for p in pairs]))["keys"] for k in range(2)]
    met = sum(bool(set(a) & set(b)) for a, b in zip(*keys))
    assert met >= least * len(pairs)
