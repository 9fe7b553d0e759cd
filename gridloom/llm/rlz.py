"""Substring dedup by relative Lempel-Ziv parsing against reference blocks.

Documents are cut into blocks of consecutive doc_ids, a few megabytes each.
Every block is a reference for all later ones (and for its own later
documents). The index of a block maps its 13-word windows to their first
position; the parse of a document takes at each word the position that the
window has in the smallest reference, extends the factor while the following
windows sit at the following reference positions, and starts the next factor
where they do not. Windows that reach over a factor boundary are looked up like
all others, so no match is lost there. Factors of at least 13 words are
duplicate spans.

The index is never in one place. A block asks hash buckets about its distinct
keys, one row per (block, bucket) with packed keys, and gets one packed answer
per row. Repeated keys are merged inside the block before the shuffle, so a
passage of every document costs one entry per block. Two rounds keep the
shuffle small. The first asks about the anchors only: of the eight 6-word
groups in a window the one with the least hash, about a fifth of the positions.
Equal windows have equal anchors, so a window whose anchor occurs in one
document alone cannot repeat. The second round asks about the windows that are
left, by 64 bits of hash and 32 bits of a second one.

Defined results: a null or empty text has no words and nothing removed (digest
of the empty string); documents of fewer than 13 words are kept whole; rows
with one doc_id count as the same document, so they never remove each other's
words; a null doc_id is larger than all others; an empty table gives an empty
result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import Chunk, _spans, bound_batches, mix, slices, text_bytes

WINDOW = 13
#: Words of an anchor; a window holds WINDOW - ANCHOR + 1 = 8 of them, a power of two.
ANCHOR = 6
#: Bytes of text in a reference block, on average.
BLOCK_BYTES = 8 << 20

_CHECK_BASE = 0xA24BAED4963EE407
_LAST = np.iinfo(np.int64).max


class Block:
    """Word hashes of all documents of a block, in order of doc_id."""

    def __init__(self, docs: pa.Table):
        ids = [_LAST if i is None else i for i in docs.column("doc_id").to_pylist()]
        texts = docs.column("text").to_pylist()
        # The rows of a shuffled block come in any order; every pass must see the same one.
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.texts = [texts[i] for i in order]
        self.ids = np.array([ids[i] for i in order], np.int64)
        hashes, counts = [], []
        for lo, hi in slices(self.texts):
            chunk = Chunk(self.texts[lo:hi])
            hashes.append(chunk.word_hashes())
            counts.append(np.diff(chunk.word_at))
        self.words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.word_at = np.concatenate([[0], np.cumsum(self.counts)])
        self.owner = np.repeat(self.ids, self.counts)
        row = np.repeat(np.arange(len(self.ids)), self.counts)
        n = max(0, len(row) - WINDOW + 1)
        #: Positions at which a window starts.
        self.starts = np.flatnonzero(row[WINDOW - 1:] == row[:n]) if n else np.zeros(0, np.int64)

    def anchors(self) -> np.ndarray:
        """The least 6-word hash of each window."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        first = np.arange(len(self.words) - ANCHOR + 1)
        least = mix(_spans(self.words, first, first + ANCHOR, _CHECK_BASE))
        step = 1
        while step < WINDOW - ANCHOR + 1:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        return least[self.starts]

    def keys(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = starts + WINDOW
        wide = _spans(self.words, starts, ends, 0xD1342543DE82EF95)
        return wide, (_spans(self.words, starts, ends, _CHECK_BASE) >> np.uint64(32)).astype(np.uint32)

    def shared_inside(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of the windows, the key index of each window, and whether two documents share the key."""
        distinct, index = np.unique(keys, return_inverse=True)
        owner = self.owner[self.starts]
        low = np.full(len(distinct), _LAST, np.int64)
        high = np.full(len(distinct), np.iinfo(np.int64).min, np.int64)
        np.minimum.at(low, index, owner)
        np.maximum.at(high, index, owner)
        return distinct, index, low < high


def _bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted keys; a bucket is an equal slice of the hash range."""
    of = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    return np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64))


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_pylist([dict(zip(schema.names, row)) for row in rows], schema=schema)


_ASK = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()),
                  ("checks", pa.binary()), ("places", pa.binary())])
_ANSWER = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("known", pa.binary()), ("references", pa.binary())])
_ASK_DDL = "block int, bucket int, keys binary, checks binary, places binary"
_ANSWER_DDL = "block int, bucket int, known binary, references binary"


def _block_of(docs: pa.Table) -> int:
    return docs.column("block")[0].as_py()


def ask_anchors(buckets: int):
    def run(docs: pa.Table) -> pa.Table:
        block = Block(docs)
        distinct = np.unique(block.anchors())
        edges = _bucket_edges(distinct, buckets)
        return _rows(_ASK, [(_block_of(docs), b, distinct[lo:hi].tobytes(), b"", b"")
                            for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])) if lo < hi])

    return run


def answer_anchors(asks: pa.Table) -> pa.Table:
    """A bit per key: another block has it."""
    parts = [np.frombuffer(k, np.uint64) for k in asks.column("keys").to_pylist()]
    every = np.sort(np.concatenate(parts))
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    rows = []
    for block, bucket, keys in zip(asks.column("block").to_pylist(), asks.column("bucket").to_pylist(), parts):
        rows.append((block, bucket, np.packbits(_member(keys, shared)).tobytes(), b""))
    return _rows(_ANSWER, rows)


def _member(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return among[at] == keys


def _known(answers: pa.Table, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The answered bits in order of the asked keys, and the references of the set ones."""
    bits = np.zeros(edges[-1], bool)
    references = np.full(edges[-1], -1, np.int64)
    columns = (answers.column(c).to_pylist() for c in ("bucket", "known", "references"))
    for bucket, packed, refs in zip(*columns):
        lo, hi = edges[bucket], edges[bucket + 1]
        bits[lo:hi] = np.unpackbits(np.frombuffer(packed, np.uint8), count=hi - lo).astype(bool)
        if refs:
            references[lo + np.flatnonzero(bits[lo:hi])] = np.frombuffer(refs, np.int64)
    return bits, references


def _candidates(block: Block, answers: pa.Table, buckets: int) -> np.ndarray:
    """Start positions of windows whose anchor occurs in two documents or more."""
    distinct, index, shared = block.shared_inside(block.anchors())
    known, _ = _known(answers, _bucket_edges(distinct, buckets))
    return block.starts[(shared | known)[index]] if len(index) else block.starts


class Windows:
    """Candidate windows of a block: distinct keys in order, and their first position."""

    def __init__(self, block: Block, starts: np.ndarray, buckets: int):
        self.starts = starts
        keys, checks = block.keys(starts)
        order = np.lexsort((starts, checks, keys))
        k, c = keys[order], checks[order]
        new = np.ones(len(order), bool)
        new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        self.keys, self.checks, self.places = k[new], c[new], starts[order][new]
        self.index = np.empty(len(order), np.int64)
        self.index[order] = np.cumsum(new) - 1
        self.edges = _bucket_edges(self.keys, buckets)


def ask_windows(buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _ASK.empty_table()
        block = Block(docs)
        w = Windows(block, _candidates(block, answers, buckets), buckets)
        return _rows(_ASK, [(_block_of(docs), b, w.keys[lo:hi].tobytes(), w.checks[lo:hi].tobytes(),
                             w.places[lo:hi].astype(np.uint32).tobytes())
                            for b, (lo, hi) in enumerate(zip(w.edges[:-1], w.edges[1:])) if lo < hi])

    return run


def answer_windows(asks: pa.Table) -> pa.Table:
    """For each key that a smaller block has: that block and the position there."""
    blocks = asks.column("block").to_pylist()
    parts = [np.frombuffer(x, np.uint64) for x in asks.column("keys").to_pylist()]
    keys = np.concatenate(parts)
    checks = np.concatenate([np.frombuffer(x, np.uint32) for x in asks.column("checks").to_pylist()])
    places = np.concatenate([np.frombuffer(x, np.uint32) for x in asks.column("places").to_pylist()]).astype(np.int64)
    sizes = np.array([len(p) for p in parts])
    owner = np.repeat(np.array(blocks, np.int64), sizes)
    order = np.lexsort((owner, checks, keys))
    new = np.ones(len(order), bool)
    k, c = keys[order], checks[order]
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    reference = np.full(len(keys), -1, np.int64)
    earlier = owner[first] < owner[order]
    reference[order[earlier]] = (owner[first] << 32 | places[first])[earlier]
    rows, ends = [], np.cumsum(sizes)
    for block, bucket, lo, hi in zip(blocks, asks.column("bucket").to_pylist(), ends - sizes, ends):
        own = reference[lo:hi]
        rows.append((block, bucket, np.packbits(own >= 0).tobytes(), own[own >= 0].tobytes()))
    return _rows(_ANSWER, rows)


def _references(block: Block, w: Windows, answers: pa.Table, number: int) -> np.ndarray:
    """Reference position of the window at each word, or -1: a smaller block's, else a smaller document's here."""
    out = np.full(len(block.words), -1, np.int64)
    if len(w.starts):
        _, far = _known(answers, w.edges)
        far = far[w.index]
        here = w.places[w.index]
        near = np.where(block.owner[here] < block.owner[w.starts], np.int64(number) << 32 | here, -1)
        out[w.starts] = np.where(far >= 0, far, near)
    return out


_FACTORS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()),
                      ("ref_block", pa.int64()), ("ref_word", pa.int64())])
_FACTORS_DDL = "doc_id long, start long, n_words long, ref_block long, ref_word long"
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
_KEPT_DDL = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _factors(block: Block, reference: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each factor: windows at consecutive reference positions."""
    has = reference >= 0
    follows = np.zeros(len(has), bool)
    follows[1:] = has[1:] & has[:-1] & (reference[1:] == reference[:-1] + 1)
    first = np.flatnonzero(has & ~follows)
    ends = np.flatnonzero(has & ~np.append(follows[1:], False))
    return first, ends


def _parse(docs: pa.Table, answers: list[pa.Table], buckets: int) -> tuple[Block, np.ndarray, np.ndarray, np.ndarray]:
    block = Block(docs)
    w = Windows(block, _candidates(block, answers[0], buckets), buckets)
    reference = _references(block, w, answers[1], _block_of(docs))
    return block, reference, *_factors(block, reference)


def _split(answers: pa.Table) -> list[pa.Table]:
    rounds = np.array(answers.column("round").to_pylist(), np.int64)
    return [answers.filter(pa.array(rounds == r)) for r in (1, 2)]


def list_factors(buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _FACTORS.empty_table()
        block, reference, first, last = _parse(docs, _split(answers), buckets)
        row = np.searchsorted(block.word_at, first, side="right") - 1
        ids = block.ids[row]
        return pa.table([pa.array(ids, mask=ids == _LAST), first - block.word_at[row], last - first + WINDOW,
                         reference[first] >> 32, reference[first] & 0xFFFFFFFF], schema=_FACTORS)

    return run


def remove_factors(buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _KEPT.empty_table()
        block, _, first, last = _parse(docs, _split(answers), buckets)
        step = np.zeros(len(block.words) + 1, np.int64)
        np.add.at(step, first, 1)
        np.add.at(step, last + WINDOW, -1)
        kept = np.cumsum(step[:-1]) == 0
        digests, removed = [], []
        for text, lo, hi in zip(block.texts, block.word_at[:-1], block.word_at[1:]):
            own = kept[lo:hi]
            digests.append(hashlib.sha256(b" ".join(compress(text.split(), own.tolist()))).hexdigest())
            removed.append(int(hi - lo - own.sum()))
        return pa.table([pa.array(block.ids, mask=block.ids == _LAST), block.counts, removed, digests], schema=_KEPT)

    return run


def with_blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, text in bytes, and the block of consecutive doc_ids; and the number of blocks."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))
    ids = docs.select(F.col("doc_id").cast("double").alias("id")).filter("id IS NOT NULL")
    cuts = sorted(set(ids.approxQuantile("id", [i / n for i in range(1, n)], 0.1 / n))) if n > 1 else []
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"),
                         F.col("doc_id").cast("double").alias("id"))
    bins = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="id", outputCol="bin", handleInvalid="keep") \
        if cuts else None
    cut = bins.transform(narrow) if bins else narrow.withColumn("bin", F.lit(0.0))
    # A null doc_id comes after all others.
    last = F.lit(len(cuts) + 1)
    return cut.select("doc_id", "text", F.coalesce(F.col("bin").cast("int"), last).alias("block")), n


def _run(docs: DataFrame, last, ddl: str) -> DataFrame:
    cut, buckets = with_blocks(bound_batches(docs))
    blocks = cut.groupBy("block")
    known = (blocks.applyInArrow(ask_anchors(buckets), _ASK_DDL)
             .groupBy("bucket").applyInArrow(answer_anchors, _ANSWER_DDL))
    windows = blocks.cogroup(known.groupBy("block")).applyInArrow(ask_windows(buckets), _ASK_DDL)
    found = windows.groupBy("bucket").applyInArrow(answer_windows, _ANSWER_DDL)
    answers = known.withColumn("round", F.lit(1)).unionByName(found.withColumn("round", F.lit(2)))
    return blocks.cogroup(answers.groupBy("block")).applyInArrow(last(buckets), ddl)


def factors(docs: DataFrame) -> DataFrame:
    """The factors of at least 13 words: document, first word, words, reference block and word there."""
    return _run(docs, list_factors, _FACTORS_DDL)


def remove_duplicate_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of docs."""
    return _run(docs, remove_factors, _KEPT_DDL)
