"""Helpers shared by the text operators: table access, word hashing in numpy.

Words are maximal runs of bytes other than ``\\x20`` and ``\\x09``-``\\x0D`` of
the UTF-8 text, so a word never depends on the locale or on Unicode tables. A
chunk of documents is hashed at once: word and window hashes are differences
of one running polynomial sum, so no Python loop runs over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass takes together.
CHUNK_BYTES = 1 << 19

_WORD_BASE = 0x9E3779B97F4A7C15
_WINDOW_BASE = 0xD1342543DE82EF95
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that one Arrow batch hands to a Python worker; texts may be long.
BATCH_ROWS = 512


def bound_batches(df: DataFrame) -> DataFrame:
    """The same rows, in a session whose Arrow batches hold ``BATCH_ROWS`` rows at most."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(name, "0"))
    if not 0 < now <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def text_bytes(col: str = "text") -> Column:
    """UTF-8 bytes of a text column; a null text counts as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def unused(name: str, df: DataFrame) -> str:
    """A column name that df does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            up = np.full(size, base, np.uint64)
            down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            have = np.cumprod(up), np.cumprod(down)
        _powers[base] = have
    return have[0][:n], have[1][:n]


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of each values[start:end], equal for equal contents."""
    up, down = _power(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values.astype(np.uint64) * up[:len(values)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Chunk:
    """Word table of several texts: ``first`` and ``last`` byte, ``doc`` index of each word.

    ``word_at[d]:word_at[d + 1]`` are the words of text d.
    """

    def __init__(self, texts: list[bytes], data: bytes | None = None, space: np.ndarray = SPACE):
        self.n = len(texts)
        joined = b"\n".join(texts) if data is None else data
        self.data = np.frombuffer(joined, np.uint8)
        lengths = np.fromiter((len(t) for t in texts), np.int64, self.n)
        self.doc_at = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] if self.n else np.zeros(0, np.int64)
        self.doc_end = self.doc_at + lengths
        self.in_word = ~space[self.data]
        edge = np.diff(self.in_word.astype(np.int8), prepend=0, append=0)
        self.first = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.word_at = np.concatenate([np.searchsorted(self.first, self.doc_at), [len(self.first)]])
        self.doc = np.repeat(np.arange(self.n), np.diff(self.word_at))

    def word_hashes(self) -> np.ndarray:
        return _spans(self.data + np.uint64(1), self.first, self.end, _WORD_BASE)

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start positions and hashes of all runs of k words within one text."""
        if len(hashes) < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        start = np.flatnonzero(self.doc[k - 1:] == self.doc[:len(self.doc) - k + 1])
        return start, _spans(hashes, start, start + k, _WINDOW_BASE)

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum over the bytes of each text."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.doc_end] - total[self.doc_at]

    def per_doc_words(self, values: np.ndarray) -> np.ndarray:
        """Sum over the words of each text."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[self.word_at[1:]] - total[self.word_at[:-1]]

    def covered(self, starts: np.ndarray, k: int) -> np.ndarray:
        """Whether each word lies in one of the k-word windows that begin at starts."""
        step = np.zeros(len(self.doc) + 1, np.int32)
        np.add.at(step, starts, 1)
        np.add.at(step, starts + k, -1)
        return np.cumsum(step[:-1]) > 0


def slices(texts: list[bytes], target: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of about target bytes; a longer text is a range of its own."""
    at, size = 0, 0
    for i, text in enumerate(texts):
        if i > at and size + len(text) > target:
            yield at, i
            at, size = i, 0
        size += len(text) + 1
    if at < len(texts):
        yield at, len(texts)
