"""The filter audit against a walk through every order, and on awkward rows."""

import re
from collections import Counter
from itertools import permutations

from gridloom.llm import filter_audit

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, digest string, n int, good int"


def masks(docs, labels):
    low = {}
    for d in docs:
        if d[0] is not None:
            low[d[1] or ""] = min(low.get(d[1] or "", d[0]), d[0])
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                  "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                  "E": doc_id is not None and text in low and low[text] < doc_id}
        yield lang or "", {k for k, v in failed.items() if v}, doc_id in good, doc_id in toxic


def brute(docs, labels):
    held = list(masks(docs, labels))
    out = {}
    for part in {h[0] for h in held}:
        own = [h[1:] for h in held if h[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, k in enumerate(order, 1):
                gone = [h for h in left if k in h[0]]
                left = [h for h in left if k not in h[0]]
                shapley[k] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(k in h[0] for h in own) - len(gone), sum(h[0] == {k} for h in own),
                    sum(h[1] for h in gone), sum(h[2] for h in gone), k]
        for key, row in out.items():
            if key[0] == part:
                row[6] = shapley[row[6]]
    return {k: tuple(v) for k, v in out.items()}


def found(spark, docs, labels):
    frame = spark.createDataFrame([(i, t, g, "s", 1, "x", "y", 1, 2) for i, t, g in docs], DOCS).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(frame, marks).collect()
    out = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"],
                                                       r["good_lost"], r["toxic_lost"], r["shapley"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_every_order(spark):
    many = " ".join(f"w{i}" for i in range(120))
    docs = [(1, many, "en"), (2, many, "en"), (3, many, "de"), (3, many, "en"), (None, many, "en"), (1, many, "fr"),
            (4, None, "en"), (5, "", "en"), (6, "", None), (7, "AB # cd", "en"), (8, "AB " * 200, ""), (9, many + " %", "en"),
            (10, many.upper(), "de"), (11, "a b " * 150, "de"), (12, "Ünï X" * 40000, "en"), (0, "AB # cd", "xx")]
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, None), (4, None, 1), (7, 1, 1), (99, 1, 1), (None, 1, 1), (9, 1, 0)]
    assert found(spark, docs, labels) == brute(docs, labels)
    assert found(spark, [], labels) == {}
    assert found(spark, docs[:1], []) == brute(docs[:1], [])


def test_intervals_cover_every_order_once():
    for mask in range(1, 32):
        covered = Counter(r for m, _, a, b in filter_audit.removal_intervals() if m == mask for r in range(a, b))
        assert covered == Counter(range(filter_audit.ORDERS))
    ranks = [filter_audit.lehmer_rank("".join(p)) for p in permutations("ABCDE")]
    assert ranks == list(range(120))
