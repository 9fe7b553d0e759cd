"""Decontamination of scripts without spaces, of short items, and against a plain walk over all windows."""
import random

import numpy as np
import pytest

from gridloom.llm import decontaminate as D
from gridloom.llm.common import CHUNK_BYTES

HAN = "".join(chr(0x4E00 + 37 * i % 5000) for i in range(4000))


def plain_words(text):
    """The words of a text, one character at a time."""
    def inside(c, ranges):
        return any(lo <= ord(c) <= hi for lo, hi in ranges)

    words, run = [], ""
    for c in text.lower() + " ":
        own = inside(c, D._UNSPACED) and not inside(c, D._MARKS)
        if own or inside(c, D._MARKS) or (ord(c) < 128 and not c.isalnum()):
            words += [run] * bool(run) + [c] * own
            run = ""
        else:
            run += c
    return words


def least_edits(item, words):
    """Edit distance of the item to the run of words that is nearest to it, by the plain table."""
    row = [0] * (len(words) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (v != w)))
        row = new
    return min(row)


@pytest.mark.parametrize("text", ["", "plain words, two-part", "東京タワー。高い", "a東b 京", "ภาษาไทย word", "x" * 9 + "𠀀y𠀁", "– … ’ é",
                                  "Ａｂ！ｃ、々〇・ｶﾅ", "東", "end東", "\U0001F600 東\U0001F600"])
def test_words(text):
    chunk = D.words_of([text, "next 京"])
    own = [bytes(chunk.data[a:b]).decode() for a, b in zip(chunk.first, chunk.end)]
    assert own[:chunk.word_at[1]] == plain_words(text)
    assert own[chunk.word_at[1]:] == ["next", "京"]


def edited(words, edits, rng):
    out = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = f"w{rng.randrange(10**9)}"
        elif kind == 1:
            out.insert(at, f"w{rng.randrange(10**9)}")
        else:
            del out[at]
    return out


def test_passages_without_spaces_are_found():
    rng = random.Random(3)
    items = [(i, HAN[60 * i:60 * i + 12 + 4 * i]) for i in range(10)]
    ready = D.prepare(items)
    lead, trail = HAN[2000:2400], HAN[2500:2800]
    texts = [lead + t + trail for _, t in items]
    texts += [lead + "".join(c for j, c in enumerate(t) if j != len(t) // 2) + trail for _, t in items]
    texts += [lead + trail, "".join(rng.sample(HAN, 500))]
    found = [[m["item_id"] for m in ms] for ms in D.find(texts, ready)]
    assert found == [[i] for i in range(10)] * 2 + [[], []]


def test_short_items_are_exact_runs(spark):
    items = [(1, "Blue!"), (2, "two words"), (3, "three little words"), (4, "and four short words"), (5, "東京"), (6, " .. "),
             (7, "two, WORDS"), (None, "three little words"), (8, None)]
    texts = ["the blue sky", "two words and two words", "two other words", "three little, words!", "(and) four short words.",
             "私は東京にいる", "東 京", "bluewords", "", None, "words two"]
    want = [{1}, {2, 7}, set(), {3, None}, {4}, {5}, {5}, set(), set(), set(), set()]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = D.leaks(docs, bench).collect()
    assert [{r.item_id for r in found if r.doc_id == d} for d in range(len(texts))] == want
    assert len(found) == sum(map(len, want)) and all(r.edits == 0 for r in found)
    assert {(r.doc_id, r.item_id): r.end_word for r in found}[1, 2] == 2
    assert sorted(r.doc_id for r in D.keep_clean(docs, bench).collect()) == [d for d, w in enumerate(want) if not w]


def test_equals_a_plain_walk_over_all_pairs():
    rng = random.Random(11)
    common = [f"c{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(common) + str(rng.randrange(9)) for _ in range(n)))
             for i, n in enumerate([1, 2, 3, 4, 5, 6, 7, 9, 12, 14, 20, 33, 60, 120])]
    texts = []
    for i in range(120):
        body = [rng.choice(common) + str(rng.randrange(9)) for _ in range(rng.randrange(1, 200))]
        own = items[i % len(items)][1].split()
        at = rng.randrange(len(body))
        texts.append(" ".join(body[:at] + edited(own, rng.randrange(int(len(own) * 0.25) + 1), rng) + body[at:]))
    found = [{(m["item_id"], m["edits"]) for m in ms} for ms in D.find(texts, D.prepare(items))]
    for text, got in zip(texts, found):
        near = {(i, least_edits(t.split(), text.split())) for i, t in items}
        assert got == {(i, e) for i, e in near if e <= D.edits_allowed(len(items[i][1].split()))}


def _long_texts():
    """Twenty items, and texts of several chunks that hold them with as many edits as are allowed."""
    rng = random.Random(5)
    common = [f"c{i}" for i in range(20000)]
    items = [(i, " ".join(rng.choice(common) for _ in range(8 + 4 * i))) for i in range(20)]
    texts = []
    for _, text in items:
        body = [rng.choice(common) for _ in range(10000)]
        own = text.split()
        body[5000:5000] = edited(own, D.edits_allowed(len(own)), rng)
        texts.append(" ".join(body))
    return items, texts


def test_windows_of_several_chunks_walk_together(monkeypatch):
    items, texts = _long_texts()
    ready = D.prepare(items)
    alone = [D.find([t], ready)[0] for t in texts]
    assert [[m["item_id"] for m in ms] for ms in alone] == [[i] for i in range(20)]
    assert sum(map(len, texts)) > 2 * CHUNK_BYTES
    calls = []
    moves = D._moves
    monkeypatch.setattr(D, "_moves", lambda *a: calls.append(1) or moves(*a))
    for bound in ("WALKED", "WAITING"):
        monkeypatch.setattr(D, bound, 1 << 26, raising=False)
    assert D.find(texts, ready) == alone
    # One pass of a class for every 64 steps, whatever the number of embeddings, chunks and texts.
    assert len(calls) == sum(int(max(s.max() for _, s in c.steps)) // 64 + 1 for c in ready.classes)
    # Small runs of windows, and texts that do not wait, find the same.
    monkeypatch.setattr(D, "WALKED", 1)
    monkeypatch.setattr(D, "WAITING", 1)
    assert D.find(texts[:4], ready) == alone[:4]


def test_keys_equal_plain_walks():
    rng = np.random.default_rng(2)
    words = np.concatenate([rng.integers(1, 1 << 62, 300).astype(np.uint64), np.zeros(200, np.uint64)])
    steps = D._sampled(60, 18, 2)
    starts = np.array([0, 1, 2, 40, 41, 41, 180, 299])
    want = []
    for embedding, sample in steps:
        keys = []
        for at in starts.tolist():
            key = 0
            for step in range(int(sample.max()) + 1):
                if step in sample:
                    key = (key ^ int(words[at])) * int(D._KEY_BASE) % (1 << 64)
                seed = D.mix(np.array([embedding * 1_000_003 + step // 64 + 1], np.uint64))
                at += int(D.mix(words[at:at + 1] ^ seed)[0]) >> step % 64 & 1
            keys.append(key)
        want.append(keys)
    assert D._keys(words, starts, steps).tolist() == want
