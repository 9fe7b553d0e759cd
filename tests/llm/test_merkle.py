"""The manifest against a plain Merkle tree, and on awkward rows."""

import hashlib
import zlib

import pytest

from gridloom.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, key string, at int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    given = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha(*given)


def tree(nodes, fanout=16):
    """The root of a list of digests, and for each its steps: (siblings before, siblings after) up to the root."""
    steps = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, owners = [], []
        for lo in range(0, len(nodes), fanout):
            run = nodes[lo:lo + fanout]
            for k, members in enumerate(under[lo:lo + fanout]):
                for i in members:
                    steps[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            up.append(sha(*run))
            owners.append([i for members in under[lo:lo + fanout] for i in members])
        nodes, under = up, owners
    return nodes[0], steps


def brute(rows):
    """doc_id, leaf, subroot, root, proof, folded root, verified of (doc_id, source, lang, n_chars, text) rows."""
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        held = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = (held, *tree([leaf(*r) for r in held]))
    root, above = tree([trees[s][1] for s in names]) if names else (None, [])
    out = []
    for s, up in zip(names, above):
        held, subroot, steps = trees[s]
        for r, own in zip(held, steps):
            path = own + up
            now = leaf(*r)
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                now = leaf(*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            for a, b in path:
                now = sha(a, now, b)
            out.append((r[0], leaf(*r), subroot, root, sha(*[a + b for a, b in path]), now, now == root))
    return sorted(out, key=repr)


def found(docs):
    return sorted([tuple(r) for r in merkle.manifest(docs).collect()], key=repr)


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [256, 1], [257, 16, 3, 1], [5000] + [1] * 20])
def test_manifest_equals_a_plain_tree(spark, sizes):
    rows = [(i * 37 % 10007, f"s{k}", "en", i, f"Text {i} OF {k}") for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "x", "y", 1) for r in rows], DOCS).repartition(5)
    assert found(docs) == brute(rows)


def test_awkward_rows(spark):
    long = "Ünï Code " * 60000
    rows = [(1, None, "en", 3, "ABC"), (None, "a", None, None, "DEF"), (2, "", "en", 0, ""), (3, "a", "en", None, None),
            (4, "é", "de", 9, long), (4, "é", "de", 9, long), (4, "é", "de", 10, "other"), (5, "z", "x", -1, "AbC dEf"),
            (6, None, "fr", 1, "X"), (12, "ｚ", "x", 1, "Ａ not ascii"), (None, None, None, None, None)]
    rows += [(i, "s" if i % 2 else None, "en", i, f"T{i}") for i in range(100, 160)]
    docs = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "x", "y", 1) for r in rows], DOCS)
    assert found(docs) == brute(rows)
    assert merkle.manifest(docs.filter("false")).count() == 0


def test_only_changed_rows_fail(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wrong = {r.doc_id for r in merkle.manifest(docs).collect() if not r.verified}
    assert wrong == {r.doc_id for r in docs.collect()
                     if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in r.text or "")}
