"""Base spans against plain patterns, and texts that must not take long."""

import hashlib
import random
import re
import time

import pytest

from gridloom.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain_spans(text):
    out = {}
    for kind, pattern in PLAIN.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                    or (kind == "card" and 16 <= len(digits) <= 19 and luhn(digits))
                    or (kind == "phone" and 8 <= len(digits) <= 15)):
                out[kind].append(m.span())
    return out


def digest(found):
    listed = ",".join(f"{k}:{s}:{e}" for k in PLAIN for s, e in found[k])
    return hashlib.sha256(listed.encode()).hexdigest()


def test_base_spans_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in pii.find_personal_data(docs).collect():
        want = plain_spans(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(want[k]) for k in PLAIN)
        assert r.base_sha256 == digest(want)
        listed = {tuple(x.split(":")) for x in r.spans.split(",") if x}
        assert {(k, str(s), str(e)) for k in PLAIN for s, e in want[k]} <= listed


def test_base_spans_of_odd_texts():
    rng = random.Random(8)
    parts = ["a", "b1", "@", "@", ".", "..", "-", "_", "%", " ", "  ", "1", "192", "168", "255", "256", "4111", "1111", "+",
             "+1", "555", "(", ")", "\n", "é", "x.y", "0"]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 30)))
        base, every = pii.spans(text)
        assert base == plain_spans(text)
        assert all(set(base[k]) <= set(every[k]) for k in PLAIN)


@pytest.mark.parametrize("part", ["a", "_", "-", "1", "one ", "@", "a@", "1.", "one dot ", "a dot ", "a_dot_", "x at y dot ",
                                  "a at b ", "dot ", "+1 ", "( ", " ", "plus ", "а", "a.b@c.de ", "one.1.1.1 "])
def test_long_runs_take_time_in_proportion(part):
    """400,000 characters of one part, with a sign or word behind it that makes the searches look back."""
    for tail in (" dot x", "@", "(at) one"):
        before = time.process_time()
        pii.spans(part * (400000 // len(part)) + tail)
        assert time.process_time() - before < 8


def test_spans_held_in_order():
    held = pii.Spans([(5, 9), (12, 20)])
    assert held.hold((5, 9)) and held.hold((13, 15)) and not held.hold((8, 13)) and not held.hold((0, 2))
    assert held.touch((8, 10)) and held.touch((0, 6)) and not held.touch((9, 12)) and not held.touch((20, 30))
    held.take_in((4, 10))
    held.take_in((30, 31))
    held.take_in((25, 40))
    assert held.listed() == [(4, 10), (12, 20), (25, 40)]
