"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one bit per failed rule; a policy is a named, versioned bit mask, so a new
policy or an ablation reads the ledger only and never the texts again.

Defined results: a null or empty text has no words and fails ``few_words``
only; repeated rows give repeated ledger rows; an empty table gives an empty
ledger; columns of the input other than ``doc_id`` and ``text`` are ignored, so
their names cannot clash. Ratios are compared in integers, so ties are exact.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import Chunk, bound_batches, slices, text_bytes, unused

#: Words of a window that counts as repeated inside one text.
REPEAT_WINDOW = 8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_lower", "n_exclaim", "n_symbol_words")
MEASURES_TYPE = ", ".join(f"{m} long" for m in MEASURES)

# The bytes of the symbol class.
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A failed rule sets its bit. ``sql`` is the failure over the measurements."""

    bit: int
    name: str
    sql: str


#: Bits are never reused: a retired rule keeps its number.
RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "symbol_words", "5 * n_symbol_words > n_words"),
    Rule(4, "duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(5, "upper_case", "n_upper > n_lower"),
    Rule(6, "exclamations", "10 * n_exclaim > n_words"),
    Rule(7, "word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)"),
)
BASE_RULES = ("few_words", "repeated_words")


def mask_of(*names: str) -> int:
    return sum(1 << rule.bit for rule in RULES if rule.name in names)


@dataclass(frozen=True)
class Policy:
    """A document is rejected when any rule of the mask has failed."""

    version: str
    mask: int


POLICIES = {
    "base": Policy("base", mask_of(*BASE_RULES)),
    "v1": Policy("v1", mask_of(*BASE_RULES, "symbols", "duplicate_lines")),
    "v2": Policy("v2", mask_of(*(rule.name for rule in RULES))),
}
CURRENT = POLICIES["v2"]


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _class(SYMBOLS)
_UPPER, _LOWER = _class(bytes(range(65, 91))), _class(bytes(range(97, 123)))


def _duplicate_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    seen: set[bytes] = set()
    n = again = 0
    for line in text.split(b"\n"):
        if line.strip():
            n += 1
            if line in seen:
                again += 1
            seen.add(line)
    return n, again


def _repeated(chunk: Chunk) -> np.ndarray:
    """Words in windows that occur twice or more in their own text."""
    start, key = chunk.windows(chunk.word_hashes(), REPEAT_WINDOW)
    if not len(start):
        return np.zeros(chunk.n, np.int64)
    owner = chunk.doc[start]
    order = np.lexsort((key, owner))
    same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(start), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return chunk.per_doc_words(chunk.covered(start[twice], REPEAT_WINDOW))


def measure_texts(texts: list[bytes]) -> dict[str, np.ndarray]:
    chunk = Chunk(texts)
    data = chunk.data
    symbol = _SYMBOL[data]
    lines = np.array([_duplicate_lines(t) for t in texts], np.int64).reshape(-1, 2)
    in_symbols = np.concatenate([[0], np.cumsum(symbol)])
    return {
        "n_words": np.diff(chunk.word_at),
        "word_chars": chunk.per_doc(chunk.in_word & ((data & 0xC0) != 0x80)),
        "n_symbols": chunk.per_doc(symbol),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": _repeated(chunk),
        "n_lines": lines[:, 0],
        "n_upper": chunk.per_doc(_UPPER[data]),
        "n_lower": chunk.per_doc(_LOWER[data]),
        "n_exclaim": chunk.per_doc(data == ord("!")),
        "n_symbol_words": chunk.per_doc_words(in_symbols[chunk.end] > in_symbols[chunk.first]),
    }


def measure_batch(texts: pd.Series) -> pd.DataFrame:
    """All measurements of a batch of UTF-8 texts, a few megabytes at a time."""
    whole = texts.tolist()
    parts = [measure_texts(whole[lo:hi]) for lo, hi in slices(whole)] or [measure_texts([])]
    return pd.DataFrame({m: np.concatenate([p[m] for p in parts]) for m in MEASURES})


def measured(texts: Column) -> Column:
    return F.pandas_udf(measure_batch, MEASURES_TYPE)(texts)


def failure_bits(struct: str) -> Column:
    """All rules over a struct of measurements, as one long."""
    out = F.lit(0).cast("long")
    for rule in RULES:
        sql = re.sub(r"\b(n_[a-z_]+|word_chars)\b", rf"`{struct}`.\1", rule.sql)
        out = out.bitwiseOR(F.when(F.expr(sql), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return out


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: measurements and ``failed``, the bits of all failed rules. No shuffle."""
    return (bound_batches(docs).select("doc_id", measured(text_bytes()).alias("m"))
            .select("doc_id", "m.*", failure_bits("m").alias("failed")))


def rejected(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask)) != 0


def apply_policy(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """``base_failed`` and ``kept`` by the versioned policy, from the bits alone."""
    base = rejected(POLICIES["base"])
    return entries.withColumns({
        "base_failed": base,
        "kept": ~(base | rejected(policy)),
        "policy": F.lit(policy.version),
    })


def ablations(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those it alone rejects.

    The texts are reduced to one row per distinct bit pattern first (at most
    2**rules rows), and only patterns are expanded by rule. ``fails_any`` and
    ``fails_all`` are the bitwise or and and over all documents.
    """
    patterns = (entries.select(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("bits"), "n_words")
                .groupBy("bits").agg(F.count("*").alias("docs"), F.sum("n_words").alias("words")))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                      for r in RULES if policy.mask >> r.bit & 1])
    own = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    return (patterns.select("bits", "docs", "words", F.inline(rules))
            .groupBy("rule", "bit").agg(
                F.sum(F.when(own, F.col("docs")).otherwise(0)).alias("failed_docs"),
                F.sum(F.when(alone, F.col("docs")).otherwise(0)).alias("only_this_docs"),
                F.sum(F.when(alone, F.col("words")).otherwise(0)).alias("only_this_words"),
                F.expr("bit_or(bits)").alias("fails_any"),
                F.expr("bit_and(bits)").alias("fails_all")))


def keep_good(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The documents that the policy keeps, with all their columns, in one pass without a shuffle."""
    m = unused("_measured", docs)
    mask = policy.mask | POLICIES["base"].mask
    return (bound_batches(docs).withColumn(m, measured(text_bytes()))
            .filter(failure_bits(m).bitwiseAND(F.lit(mask)) == 0).drop(m))
