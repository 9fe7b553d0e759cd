"""Benchmark passages in documents by CGK embedding and bit-sampling LSH.

Items and documents are sequences of words in lower case without punctuation;
each character of a script that is written without spaces is a word of its own.
A CGK walk turns a sequence into a string whose Hamming distance follows the
edit distance: at each step a random bit of the current word decides whether
the walk moves on or reads the word again. Windows of a document and items
that differ by few edits agree in most steps, so samples of a few steps collide
often. An item of length n meets windows of any start; the walk of a window
needs no length, as samples come from steps that both walks take inside the
item. Repetitions (embedding, sample) are added until the measured collision
rate of edited items reaches the target recall. Items that do not reach it, or
are too long for such walks, meet every stretch that shares enough word triples
with them, which loses no match. Every candidate is then checked by exact edit
distance against the item.

Windows are embedded only where a leak is possible: an item of n words within d
edits shares at least n - 2 - 3 d of its word triples with its window, so
stretches with fewer triples of any item are passed over. That loses no match.

The items are a stated query set. They are taken in blocks of bounded size, and
each block goes over all documents without a shuffle.

Items of fewer than ``MIN_ITEM_WORDS`` words allow no edit, so they are looked up
as exact runs of words.

Defined results: null and empty documents match nothing; items without a word
match nothing; an item of one or two words is found in every document that
holds it, so a benchmark of such items rejects much; a null item_id is
reported as null; equal items are all reported; a document row is judged by its
own text, repeated rows repeat their matches; no items or no documents give an
empty result; columns other than doc_id, text, item_id are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import _WINDOW_BASE, Chunk, _spans, bound_batches, mix, slices

#: Share of an item's words that may be edited.
MAX_EDITS = 0.15
#: Chance to find a window with that many edits.
TARGET_RECALL = 0.995
#: Shorter items are exact runs.
MIN_ITEM_WORDS = 5
#: Bytes of items that go over the documents together.
BLOCK_BYTES = 4 << 20
#: Steps that a sample reads, samples taken from one embedding, repetitions at most.
SAMPLED, PER_EMBEDDING, MOST = 4, 6, 240
#: Items from this length on go by their triples alone, as longer walks drift apart.
LONG_ITEM_WORDS = 256
#: Items that go by their triples and are looked up together.
EXACT_ITEMS = 64
#: Words that walks read together at most, over all embeddings, and words of texts that wait for their walks.
WALKED, WAITING = 1 << 22, 1 << 17
TRIPLE = 3

_TRIPLE_BASE = 0x94D049BB133111EB
_KEY_BASE = np.uint64(0x9FB21C651E98DF25)

# Words are runs of ASCII letters and digits and of all other letters' bytes.
_BREAK = np.ones(256, bool)
_BREAK[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


# Code points of scripts without spaces between words (Thai to Tibetan, Myanmar, Khmer, kana, bopomofo,
# Han with its iteration mark and zero, and their compatibility forms), and of their punctuation.
_UNSPACED = [(0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x312F), (0x31F0, 0x31FF),
             (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)]
_MARKS = [(0x3000, 0x3004), (0x3008, 0x303F), (0x30FB, 0x30FB), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40),
          (0xFF5B, 0xFF65)]


def _within(points: np.ndarray, ranges: list[tuple[int, int]]) -> np.ndarray:
    low, high = np.array(ranges).T
    at = np.searchsorted(low, points, side="right") - 1
    return (at >= 0) & (points <= high[at])


class Words(Chunk):
    """A chunk whose words end at each character of a script without spaces."""

    def __init__(self, texts: list[bytes]):
        super().__init__(texts, space=_BREAK)
        lead = np.flatnonzero(self.data >= 0xE0)
        if not len(lead):
            return
        size = np.where(self.data[lead] >= 0xF0, 4, 3)
        point = self.data[lead].astype(np.int64) & np.where(size == 4, 7, 15)
        for k in range(1, 4):
            more = self.data[np.minimum(lead + k, len(self.data) - 1)].astype(np.int64) & 63
            point = np.where(k < size, point << 6 | more, point)
        mark = _within(point, _MARKS)
        own = _within(point, _UNSPACED) & ~mark
        if not (mark.any() or own.any()):
            return
        for k in range(3):  # all marks have three bytes
            self.in_word[lead[mark] + k] = False
        edge = np.diff(self.in_word.astype(np.int8), prepend=0, append=0)
        begins = edge[:-1] == 1
        begins[lead[own]] = True
        after = lead[own] + size[own]
        after = after[after < len(self.data)]
        begins[after] |= self.in_word[after]
        self.first = np.flatnonzero(begins)
        stops = np.flatnonzero(edge == -1)
        run_end = stops[np.searchsorted(stops, self.first, side="right")]
        self.end = np.minimum(run_end, np.append(self.first[1:], len(self.data)))
        self.word_at = np.concatenate([np.searchsorted(self.first, self.doc_at), [len(self.first)]])
        self.doc = np.repeat(np.arange(self.n), np.diff(self.word_at))


def words_of(texts: list[str]) -> Words:
    return Words([t.lower().encode("utf-8", "replace") for t in texts])


def edits_allowed(n: int) -> int:
    return int(MAX_EDITS * n)


@dataclass
class Class:
    """Items of similar length: their sampled steps and the keys of all repetitions."""

    steps: list[tuple[int, np.ndarray]]
    keys: list[np.ndarray]
    items: list[np.ndarray]


@dataclass
class Items:
    """A block of items, ready to be looked up."""

    ids: list[int | None]
    words: list[np.ndarray]
    classes: list[Class]
    exact: list[tuple[np.ndarray, np.ndarray]]
    triples: np.ndarray
    likely: np.ndarray
    span: int
    least_triples: int
    #: Items that are exact runs: their length, the sorted hashes of their words together, and their places in ``runs``.
    short: list[tuple[int, np.ndarray, np.ndarray]]
    runs: list[tuple[int | None, np.ndarray]]


def _moves(words: np.ndarray, embeddings: int, step: int) -> np.ndarray:
    """Random bits of each word for 64 steps of every embedding, a row each."""
    seeds = np.arange(embeddings).astype(np.uint64) * np.uint64(1_000_003) + np.uint64(step // 64 + 1)
    return mix(words ^ mix(seeds)[:, None])


def _keys(words: np.ndarray, starts: np.ndarray, steps: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """One key per repetition and start, from the symbols that its walk reads at the sampled steps. The starts ascend."""
    embedding, samples = np.array([e for e, _ in steps]), np.array([sample for _, sample in steps])
    embeddings, last = int(embedding.max()) + 1, int(samples.max())
    # The words that walks from these starts may read, each once; the array ends in padding.
    n = np.append(np.minimum(np.diff(starts), last + 1), last + 1)
    place = np.cumsum(n) - n
    near = np.repeat(starts - place, n) + np.arange(n.sum())
    own = words[np.minimum(near, len(words) - 1)]
    # All embeddings walk together, each over its own row of bits.
    row = np.arange(embeddings)[:, None] * len(own)
    at = place + row
    keys = np.zeros((len(steps), len(starts)), np.uint64)
    for step in range(last + 1):
        if step % 64 == 0:
            bits = _moves(own, embeddings, step).ravel()
        reads = np.flatnonzero((samples == step).any(axis=1))
        if len(reads):
            keys[reads] = (keys[reads] ^ own[at[embedding[reads]] - row[embedding[reads]]]) * _KEY_BASE
        if step < last:
            at += (bits[at] >> np.uint64(step % 64) & np.uint64(1)).view(np.int64)
    return keys


def _together(starts: np.ndarray, steps: list[tuple[int, np.ndarray]]) -> Iterator[np.ndarray]:
    """The starts in runs whose walks read ``WALKED`` words at most."""
    reach = (max(e for e, _ in steps) + 1) * (max(int(sample.max()) for _, sample in steps) + 1)
    size = max(1, WALKED // reach)
    for i in range(0, len(starts), size):
        yield starts[i:i + size]


def _sampled(lo: int, count: int, number: int) -> list[tuple[int, np.ndarray]]:
    """Steps before the walk of a lo-word item can leave it: it takes two steps a word on average."""
    rng = np.random.default_rng(1000 * number + lo)
    last = max(SAMPLED, int(1.5 * lo))
    return [(i // PER_EMBEDDING, np.sort(rng.choice(last, min(SAMPLED, last), replace=False))) for i in range(count)]


def _flat(words: list[np.ndarray], padding: int) -> tuple[np.ndarray, np.ndarray]:
    """All sequences in one array, each followed by padding; and their starts."""
    pad = np.zeros(padding, np.uint64)
    flat = np.concatenate([x for w in words for x in (w, pad)])
    sizes = np.array([len(w) + padding for w in words])
    return flat, np.cumsum(sizes) - sizes


def _edited(words: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The sequence with as many random edits as are allowed, and other words after its end."""
    out = words.tolist()
    for _ in range(edits_allowed(len(words))):
        at, kind = int(rng.integers(len(out))), int(rng.integers(3))
        new = int(rng.integers(1, 1 << 62))
        if kind == 0:
            out[at] = new
        elif kind == 1:
            out.insert(at, new)
        else:
            del out[at]
    return np.array([*out, *rng.integers(1, 1 << 62, 2 * len(words)).tolist()], np.uint64)


def _repetitions(words: list[np.ndarray], lo: int) -> list[tuple[int, np.ndarray]] | None:
    """As many repetitions as edited items need to collide with the target probability, or None when none suffice."""
    rng = np.random.default_rng(lo)
    most = MOST // PER_EMBEDDING
    trial = _sampled(lo, MOST, 1)
    some = [words[i] for i in rng.choice(len(words), 200)]
    edited = [_edited(w, rng) for w in some]
    pad = max(map(len, some))
    plain, at = _flat(some, pad)
    other, other_at = _flat(edited, pad)
    hits = _keys(plain, at, trial) == _keys(other, other_at, trial)
    # The chance to miss is averaged over pairs, as far edits collide less than near ones. For each it is
    # the share of draws of that many trial embeddings that hold no colliding one, which has no bias.
    blank = most - hits.reshape(most, PER_EMBEDDING, -1).any(axis=1).sum(axis=0)
    missed = np.ones(len(some))
    for embeddings in range(1, most + 1):
        missed *= np.maximum(blank - embeddings + 1, 0) / (most - embeddings + 1)
        # A tenth of the misses that the target allows, and two standard errors for pairs that the trial did not draw.
        if missed.mean() + 2 * missed.std() / len(missed) ** 0.5 <= (1 - TARGET_RECALL) / 10:
            return _sampled(lo, embeddings * PER_EMBEDDING, 2)
    return None


def prepare(rows: list[tuple[int | None, str | None]]) -> Items | None:
    """A block of (item_id, text), or None when no item has a word."""
    chunk = words_of([text or "" for _, text in rows])
    hashes = chunk.word_hashes()
    every = [hashes[a:b].copy() for a, b in zip(chunk.word_at[:-1], chunk.word_at[1:])]
    kept = [(rows[i][0], w) for i, w in enumerate(every) if len(w) >= MIN_ITEM_WORDS]
    runs = [(rows[i][0], w) for i, w in enumerate(every) if 0 < len(w) < MIN_ITEM_WORDS]
    short = _short(runs)
    if not kept:
        return Items([], [], [], [], np.zeros(0, np.uint64), np.zeros(0, bool), 0, 0, short, runs) if runs else None
    ids, words = [k[0] for k in kept], [k[1] for k in kept]
    lengths = np.array([len(w) for w in words])
    classes, unsure, lo = [], [], MIN_ITEM_WORDS
    while lo <= lengths.max():
        hi = max(lo + 1, lo * 3 // 2)
        own = np.flatnonzero((lengths >= lo) & (lengths < hi))
        if len(own):
            members = [words[i] for i in own]
            shortest = int(lengths[own].min())
            steps = _repetitions(members, shortest) if shortest < LONG_ITEM_WORDS else None
            if steps is None:
                unsure += own.tolist()
            else:
                flat, at = _flat(members, 4 * hi)
                keys, items = [], []
                for k in np.hstack([_keys(flat, some, steps) for some in _together(at, steps)]):
                    order = np.argsort(k, kind="stable")
                    keys.append(k[order])
                    items.append(own[order])
                classes.append(Class(steps, keys, items))
        lo = hi
    exact = [_by_triple(words, unsure[i:i + EXACT_ITEMS]) for i in range(0, len(unsure), EXACT_ITEMS)]
    triples = np.unique(np.concatenate([_triples(w)[0] for w in words]))
    likely = np.zeros(1 << 20, bool)
    likely[(triples >> np.uint64(44)).astype(np.int64)] = True
    return Items(ids, words, classes, exact, triples, likely,
                 max(n + edits_allowed(n) for n in lengths.tolist()),
                 min(n - TRIPLE + 1 - TRIPLE * edits_allowed(n) for n in lengths.tolist()), short, runs)


def _short(runs: list[tuple[int | None, np.ndarray]]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    out = []
    for n in sorted({len(w) for _, w in runs}):
        own = np.array([i for i, (_, w) in enumerate(runs) if len(w) == n])
        keys = np.concatenate([_spans(runs[i][1], np.array([0]), np.array([n]), _WINDOW_BASE) for i in own])
        order = np.argsort(keys, kind="stable")
        out.append((n, keys[order], own[order]))
    return out


def _find_runs(chunk: Chunk, hashes: np.ndarray, items: Items, out: list[list[dict]]) -> None:
    """Adds the first run of each short item in each text."""
    for n, known, owners in items.short:
        starts, keys = chunk.windows(hashes, n)
        lo = np.searchsorted(known, keys)
        hi = np.searchsorted(known, keys, side="right")
        hit = np.flatnonzero(lo < hi)
        _, once = np.unique(chunk.doc[starts[hit]] * len(known) + lo[hit], return_index=True)
        for h in hit[once].tolist():
            start, text = int(starts[h]), int(chunk.doc[starts[h]])
            for i in owners[lo[h]:hi[h]].tolist():
                item_id, words = items.runs[i]
                if np.array_equal(hashes[start:start + n], words):
                    out[text].append({"item_id": item_id, "item_words": n, "edits": 0,
                                      "end_word": start + n - int(chunk.word_at[text])})


def _triples(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = np.arange(max(0, len(words) - TRIPLE + 1))
    return _spans(words, start, start + TRIPLE, _TRIPLE_BASE), start


def _by_triple(words: list[np.ndarray], items: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct triples of some items in order, and the item of each."""
    own = [np.unique(_triples(words[i])[0]) for i in items]
    keys, owners = np.concatenate(own), np.repeat(items, [len(k) for k in own])
    order = np.argsort(keys, kind="stable")
    return keys[order], owners[order]


def _possible(words: np.ndarray, items: Items) -> np.ndarray:
    """Starts of windows with enough triples of items to hold a match; triples may cross texts, which only adds some."""
    keys, _ = _triples(words)
    maybe = np.flatnonzero(items.likely[(keys >> np.uint64(44)).astype(np.int64)])
    found = np.searchsorted(items.triples, keys[maybe])
    found = items.triples[np.minimum(found, len(items.triples) - 1)] == keys[maybe]
    hit = np.zeros(len(words) + 1, np.int64)
    hit[maybe[found] + 1] = 1
    total = np.cumsum(hit)
    last = np.minimum(np.arange(len(words)) + items.span - TRIPLE + 1, len(words))
    return np.flatnonzero(total[last] - total[:len(words)] >= max(1, items.least_triples))


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the item to any run of words of the text, and where that run ends."""
    ramp = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, w in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != w))
        row = np.minimum.accumulate(new - ramp) + ramp
    end = int(np.argmin(row))
    return int(row[end]), end


def _candidates(words: np.ndarray, starts: np.ndarray, items: Items) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, item) pairs that collide in a repetition."""
    for group in items.classes:
        for some in _together(starts, group.steps):
            found = []
            for keys, known, owners in zip(_keys(words, some, group.steps), group.keys, group.items):
                lo = np.searchsorted(known, keys)
                hit = np.flatnonzero(known[np.minimum(lo, len(known) - 1)] == keys)
                if len(hit):
                    lo = lo[hit]
                    n = np.searchsorted(known, keys[hit], side="right") - lo
                    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    found.append(np.repeat(hit, n) * len(items.words) + owners[np.repeat(lo, n) + offset])
            if found:
                start, item = np.divmod(np.unique(np.concatenate(found)), len(items.words))
                yield some[start], item


def _exact_candidates(words: np.ndarray, texts_at: np.ndarray, items: Items) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, item) pairs at both ends of every stretch with enough triples of an item that goes by them."""
    if not items.exact:
        return
    keys, _ = _triples(words)
    at = np.minimum(np.searchsorted(items.triples, keys), len(items.triples) - 1)
    place = np.flatnonzero(items.triples[at] == keys)
    keys = keys[place]
    size = np.array([len(w) for w in items.words])
    edits = np.array([edits_allowed(n) for n in size.tolist()])
    for known, owners in items.exact:
        lo = np.searchsorted(known, keys)
        n = np.searchsorted(known, keys, side="right") - lo
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item, start = owners[np.repeat(lo, n) + offset], np.repeat(place, n)
        order = np.lexsort((start, item))
        item, start = item[order], start[order]
        # Triples of an item in the longest run that it may match, from each of them on.
        row = item * (2 * len(words) + items.span) + start
        count = np.searchsorted(row, row + size[item] + edits[item] - TRIPLE, side="right") - np.arange(len(row))
        enough = count >= size[item] - TRIPLE + 1 - TRIPLE * edits[item]
        item, start = item[enough], start[enough]
        # Such a run begins at most its length before the first triple, in the same text.
        text_at = texts_at[np.searchsorted(texts_at, start, side="right") - 1]
        yield np.concatenate([np.maximum(start - size[item], text_at), start]), np.concatenate([item, item])


def find(texts: list[str], items: Items) -> list[list[dict]]:
    """Matches of each text: item, its words, edit distance and the word after the matching run."""
    out: list[list[dict]] = [[] for _ in texts]
    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
    for lo, hi in slices(texts):
        chunk = words_of(texts[lo:hi])
        if not len(chunk.doc):
            continue
        hashes = chunk.word_hashes()
        _find_runs(chunk, hashes, items, out[lo:hi])
        starts = _possible(hashes, items) if items.words else np.zeros(0, np.int64)
        docs, at = np.unique(chunk.doc[starts], return_index=True)
        for d, own in zip(docs.tolist(), np.split(starts, at[1:])):
            words = hashes[chunk.word_at[d]:chunk.word_at[d + 1]].copy()
            waiting.append((lo + d, words, own - chunk.word_at[d]))
        # Few windows are left of a chunk, so those of several are walked together.
        if sum(len(words) for _, words, _ in waiting) >= WAITING:
            _find_edited(waiting, items, out)
            waiting = []
    if waiting:
        _find_edited(waiting, items, out)
    return out


def _find_edited(texts: list[tuple[int, np.ndarray, np.ndarray]], items: Items, out: list[list[dict]]) -> None:
    """Adds the matches of texts, given with their place, their words and the starts of their possible windows."""
    # Each text is followed by padding, so that no walk leaves it.
    flat, at = _flat([words for _, words, _ in texts], 2 * items.span)
    moved = np.concatenate([starts + a for (_, _, starts), a in zip(texts, at)])
    pairs = [*_candidates(flat, moved, items), *_exact_candidates(flat, at, items)]
    if not sum(len(p[0]) for p in pairs):
        return
    start = np.concatenate([p[0] for p in pairs])
    item = np.concatenate([p[1] for p in pairs])
    order = np.lexsort((start, item))
    start, item = start[order], item[order]
    # Colliding windows of one item that overlap are one stretch, aligned once.
    size = np.array([len(w) for w in items.words])
    owner = np.searchsorted(at, start, side="right") - 1
    split = np.ones(len(start), bool)
    split[1:] = (item[1:] != item[:-1]) | (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + size[item[1:]])
    first = np.flatnonzero(split)
    last = np.append(first[1:], len(start)) - 1
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for a, b in zip(first, last):
        i, o = int(item[a]), int(owner[a])
        n = len(items.words[i])
        d = edits_allowed(n)
        lo = max(int(at[o]), int(start[a]) - d)
        hi = min(int(at[o]) + len(texts[o][1]), int(start[b]) + n + 2 * d)
        distance, end = align(items.words[i], flat[lo:hi])
        if distance <= d:
            found = (distance, lo + end - int(at[o]))
            best[o, i] = min(best.get((o, i), found), found)
    for (o, i), (distance, end) in sorted(best.items()):
        out[texts[o][0]].append({"item_id": items.ids[i], "item_words": len(items.words[i]),
                                 "edits": distance, "end_word": end})


MATCHES = "array<struct<item_id: long, item_words: long, edits: long, end_word: long>>"


def matches(text: Column, items: Items) -> Column:
    """Matches of a block of items in each text."""
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(find(["" if t is None else t for t in texts], items), dtype=object)

    return F.pandas_udf(run, MATCHES)(text)


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of ``BLOCK_BYTES``, one block at a time on the driver."""
    rows, size = [], 0
    for row in benchmark.select("item_id", "text").sort("item_id", "text").toLocalIterator():
        rows.append((row.item_id, row.text))
        size += len(row.text or "") + 8
        if size >= BLOCK_BYTES:
            if ready := prepare(rows):
                yield ready
            rows, size = [], 0
    if rows and (ready := prepare(rows)):
        yield ready


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document and benchmark item that it holds."""
    out = None
    for items in item_blocks(benchmark):
        found = (bound_batches(docs).select("doc_id", F.explode(matches(F.col("text"), items)).alias("m")).select("doc_id", "m.*"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        empty = F.from_json(F.lit("[]"), MATCHES)
        out = docs.select("doc_id", F.explode(empty).alias("m")).select("doc_id", "m.*")
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark passage, with all their columns; no shuffle."""
    for items in item_blocks(benchmark):
        docs = bound_batches(docs).filter(F.size(matches(F.col("text"), items)) == 0)
    return docs
