"""Near-duplicate classes by Order MinHash and banded alignment.

Exact copies collapse to one node. Each sketch of a text picks the ``PICKED``
occurrence-labelled 5-word shingles of least hash and hashes them in text order,
so texts with the same shingles in another order get other sketches. Texts with
an equal sketch share a bucket and are candidates. A pair is linked when a banded
alignment of their words shows that edits (words added, dropped or replaced) are
at most a fifth of the longer text, that is at an edit similarity of 0.8 or more.
Before the alignment stand only tests that cannot refuse such a pair: an edit
changes one word and three 3-word shingles at most, and the length by one.

An edit breaks five shingles, so a text of n words with n / 5 scattered edits
keeps a third of them. Sketches are as many as find nine of ten such pairs of
100 words or more; pairs at 0.85 and above are found nearly always. Texts of up
to ``SHORT`` words have too few 5-word shingles left for that and are sketched by
2-word shingles; those near the boundary have both kinds, so that a pair always
has one in common.

No bucket is expanded into pairs of texts. Small buckets compare all pairs. In a
larger one every member meets the leader of the bucket, which is another one in
each bucket of a text. Near copies share most of their buckets, so a text would be
linked to one leader after the other: first each text is aligned in the largest of
its buckets only, and of the other pairs those follow whose texts are in different
classes by then. What is not in the leader's class after that is open: open
members are compared with all members of the bucket, block by block, without their
texts: by the least hashes of their words, and where those agree as often as they
do in linked texts, by an alignment of the words as 32 bits of hash each, in the
first bucket that the pair shares. Linked texts share two thirds of their words,
counted with their repetitions, so a pair agrees less often with probability 0.005.
A passage that many texts share leaves their other words unlike, so they do not agree.

Joins that carry texts are always sort-merge joins: what is small enough to
broadcast on a small corpus is not on a large one.

Defined results: null and empty texts are copies of one another; texts without
a whole shingle use all their words as one, texts without a word link to equal
texts only; rows with a null doc_id get a null class; every row is judged by
its own text, also where one doc_id has several, and its class is the smallest
doc_id of the class; an empty table gives an empty result; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import Chunk, bound_batches, mix, slices, text_bytes, unused
from gridloom.llm.components import components
from gridloom.session import materialize

SHINGLE = 5
#: Least share of the longer text that is left unedited.
SIMILARITY = 0.8
#: Sketches per text, and shingles that each picks.
SKETCHES, PICKED = 48, 2
#: Texts of up to SHORT words have sketches of their own, by shorter shingles.
SHORT, SHORT_SHINGLE, SHORT_SKETCHES = 60, 2, 16
#: Least hashes of the words of a text, half a byte each, and how many an open pair shares at least: fewer than that
#: have a probability of 0.005 where 2/3 of the words are shared (and 1/16 of the other halves of bytes).
MARKS, AGREE = 384, 241
#: Words of the shingles that bound the edits of a pair from below.
BOUND_SHINGLES = (1, 3)
#: Buckets up to this size compare all their pairs.
SMALL_BUCKET = 8
#: Members of a large bucket that one task compares with as many open ones.
BLOCK_MEMBERS = 512
#: Hash values that the sketches of one text hold at a time.
_WIDE = 1 << 20

_LABEL = np.uint64(0xD6E8FEB86659FD93)
_SEEDS = mix(np.arange(1, MARKS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(chunk: Chunk, k: int) -> list[np.ndarray]:
    """Hashes of the k-word shingles of each text in order; the words of a shorter text are one shingle."""
    words = chunk.word_hashes()
    start, keys = chunk.windows(words, k)
    at = np.searchsorted(chunk.doc[start], np.arange(chunk.n + 1)) if len(start) else np.zeros(chunk.n + 1, np.int64)
    out = []
    for d in range(chunk.n):
        own = keys[at[d]:at[d + 1]]
        lo, hi = chunk.word_at[d], chunk.word_at[d + 1]
        if not len(own) and hi > lo:
            whole = np.uint64(hi - lo)
            for w in words[lo:hi]:
                whole = mix(np.array([whole]) ^ w)[0]
            own = np.array([whole], np.uint64)
        out.append(own)
    return out


def labelled(keys: np.ndarray) -> np.ndarray:
    """Hash of each shingle and of its number among the equal shingles before it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if new.all():
        return mix(keys)
    first = np.flatnonzero(new)
    nth = np.empty(len(keys), np.uint64)
    nth[order] = np.arange(len(keys)) - first[np.cumsum(new) - 1]
    with np.errstate(over="ignore"):
        return mix(keys + nth * _LABEL)


def picks(labels: np.ndarray, count: int, picked: int = PICKED) -> np.ndarray:
    """The least shingles of each of count sketches, in text order.

    Labels are hashes already, so a product with an odd number orders them anew.
    """
    out = np.empty((count, picked), np.uint64)
    step = max(1, _WIDE // len(labels))
    for lo in range(0, count, step):
        hi = min(lo + step, count)
        hashes, each = labels[None, :] * _SEEDS[lo:hi, None], np.arange(hi - lo)
        at = np.empty((hi - lo, picked), np.int64)
        for k in range(picked):
            # A text of fewer shingles picks its last one again.
            at[:, k] = hashes.argmin(axis=1) if k < len(labels) else at[:, k - 1]
            hashes[each, at[:, k]] = ~np.uint64(0)
        out[lo:hi] = labels[np.sort(at, axis=1)]
    return out


def sketch_keys(picked: np.ndarray, kind: int) -> np.ndarray:
    """Signed 64-bit keys of picked shingles, an array of texts by sketches by picks."""
    key = np.broadcast_to(_SEEDS[:picked.shape[1]] ^ np.uint64(kind), picked.shape[:2])
    for k in range(PICKED):
        key = mix(key ^ picked[:, :, k])
    return key.view(np.int64)


def _slot(keys: np.ndarray) -> np.ndarray:
    """Half of each key; 0 stands for none."""
    return keys.view(np.uint64).astype(np.uint32) | np.uint32(1)


#: Shingle length, sketches and word counts of the two kinds of sketches.
_KINDS = ((SHINGLE, SKETCHES, SIMILARITY * SHORT, float("inf")), (SHORT_SHINGLE, SHORT_SKETCHES, 1, SHORT))


def sketch_batch(texts: pd.Series) -> pd.DataFrame:
    whole = texts.tolist()
    sizes, keys = [], [[] for _ in whole]
    slots = np.zeros((len(whole), SKETCHES + SHORT_SKETCHES), np.uint32)
    for lo, hi in slices(whole):
        chunk = Chunk(whole[lo:hi])
        words = np.diff(chunk.word_at)
        sizes += words.tolist()
        for kind, (length, count, fewest, most) in enumerate(_KINDS):
            own = np.flatnonzero((words >= max(1, fewest)) & (words <= most))
            if not len(own):
                continue
            runs = shingles(chunk, length)
            found = sketch_keys(np.array([picks(labelled(runs[d]), count) for d in own]), kind)
            slots[lo + own, kind * SKETCHES:kind * SKETCHES + count] = _slot(found)
            for d, key in zip(own.tolist(), found.tolist()):
                keys[lo + d] += key
    return pd.DataFrame({"keys": keys, "words": sizes, "slots": [row.tobytes() for row in slots]})


def compact_batch(texts: pd.Series) -> pd.DataFrame:
    """The marks of texts that have words, two in a byte, and the words as 32 bits of hash each."""
    whole, marks, codes = texts.tolist(), [], []
    for lo, hi in slices(whole):
        chunk = Chunk(whole[lo:hi])
        words = chunk.word_hashes().astype(np.uint32)
        for d, run in enumerate(shingles(chunk, 1)):
            least = picks(labelled(run), MARKS, 1)[:, 0] >> np.uint64(40) if len(run) else np.zeros(MARKS, np.uint64)
            half = least & np.uint64(15)
            marks.append((half[::2] | half[1::2] << np.uint64(4)).astype(np.uint8).tobytes())
            codes.append(words[chunk.word_at[d]:chunk.word_at[d + 1]].tobytes())
    return pd.DataFrame({"marks": marks, "codes": codes})


def edit_distance(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Edits between two word sequences, or band + 1 when they are more than the band allows.

    The table of distances is filled column by column, and of each column only
    the rows within the band. A column is held as two bit vectors: the rows whose
    distance is one more, and one less, than that of the row above.
    """
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > band:
        return band + 1
    places: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << 2 * band + 1) - 1  # bit r of a column j is row j - band + r; what lies outside counts as farther
    middle, last = 1 << band, 1 << 2 * band
    more, less, here = full ^ ((middle << 1) - 1), 0, 0  # here: the distance on the main diagonal
    for j, w in enumerate(b.tolist(), 1):
        more, less = more >> 1 | last, less >> 1
        same = places.get(w, 0)
        if same:
            same = (same >> j - band - 1 if j > band else same << band + 1 - j) & full
        level = ((same & more) + more ^ more | same | less) & full  # no farther than the row above, a column before
        if not level & middle:
            here += 1
            if here > 2 * band:
                return band + 1
        right, back = (less | full ^ (level | more)) << 1 | 1, (level & more) << 1
        more, less = (back | ~(level | right)) & full, level & right
    below = ((1 << n - m) - 1) << band + 1
    found = here + (more & below).bit_count() - (less & below).bit_count()
    return found if found <= band else band + 1


def _linked(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> bool:
    """Whether two texts, as their words and labelled shingles in order of hash, are near-duplicates."""
    longer = max(len(a[0]), len(b[0]))
    band = int((1 - SIMILARITY) * longer + 1e-9)
    if abs(len(a[0]) - len(b[0])) > band:
        return False
    for k, left, right in zip(BOUND_SHINGLES, a[1:], b[1:]):
        least = longer - k + 1 - k * band
        if least > 0 and len(np.intersect1d(left, right, assume_unique=True)) < least:
            return False
    return edit_distance(a[0], b[0], band) <= band


def _bounded(words: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words, and their labelled shingles of each bound in order of hash."""
    out = [words.copy()]
    for k in BOUND_SHINGLES:
        runs = np.zeros(max(0, len(words) - k + 1), np.uint64)
        for i in range(k):
            runs = mix(runs ^ words[i:len(runs) + i])
        out.append(np.unique(labelled(runs)))
    return tuple(out)


def _prepared(texts: list[bytes]) -> list[tuple[np.ndarray, ...]]:
    out = []
    for lo, hi in slices(texts):
        chunk = Chunk(texts[lo:hi])
        words = chunk.word_hashes()
        out += [_bounded(words[chunk.word_at[d]:chunk.word_at[d + 1]]) for d in range(chunk.n)]
    return out


def linked_batch(left: pd.Series, right: pd.Series) -> pd.Series:
    out = np.zeros(len(left), bool)
    for lo in range(0, len(left), 256):
        a, b = left[lo:lo + 256].tolist(), right[lo:lo + 256].tolist()
        # A leader comes in many pairs; each text is hashed once.
        texts = list(dict.fromkeys([*a, *b]))
        ready = dict(zip(texts, _prepared(texts)))
        out[lo:lo + 256] = [_linked(ready[x], ready[y]) for x, y in zip(a, b)]
    return pd.Series(out)


def _copy_key() -> Column:
    return F.unhex(F.md5(text_bytes()))


_SKETCH = "keys array<long>, words long, slots binary"


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, copy key and sketches of every row, written once without the texts."""
    parts = F.pandas_udf(sketch_batch, _SKETCH)
    return materialize(docs.select("doc_id", _copy_key().alias("copy"), parts(text_bytes()).alias("s"))
                       .select("doc_id", "copy", "s.*"))


def distinct_texts(rows: DataFrame) -> DataFrame:
    """copy, low (its least doc_id) and node of every text; a node is a doc_id, or made up where the id has one already."""
    low = rows.filter("doc_id IS NOT NULL").groupBy("copy").agg(F.min("doc_id").alias("low"))
    low = materialize(low)
    owner = low.groupBy("low").agg(F.min("copy").alias("owner"), F.count("*").alias("n")).filter("n > 1").select("low", "owner")
    spare = -F.shiftrightunsigned(F.xxhash64("copy"), 1) - 1
    return low.join(owner, "low", "left").select("copy", "low", F.when(
        F.col("owner").isNull() | (F.col("owner") == F.col("copy")), F.col("low")).otherwise(spare).alias("node"))


def _length_fits() -> Column:
    return F.least("a_words", "b_words") >= F.lit(SIMILARITY) * F.greatest("a_words", "b_words") - F.lit(1e-6)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links u, v of the pairs a, b whose texts are near-duplicates."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    near = F.pandas_udf(linked_batch, "boolean")
    return (pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
            .filter(near(F.col("a_text"), F.col("b_text"))).select(F.col("a").alias("u"), F.col("b").alias("v")))


def _first_pairs(members: DataFrame) -> DataFrame:
    """All pairs of small buckets, and each member with its leader in large ones; n is the size of the largest one."""
    small = members.filter(F.col("n") <= SMALL_BUCKET)
    left = small.select("key", "n", F.col("node").alias("a"), F.col("words").alias("a_words"))
    right = small.select("key", F.col("node").alias("b"), F.col("words").alias("b_words"))
    pairs = left.join(right, "key").filter("a < b")
    led = members.filter((F.col("n") > SMALL_BUCKET) & (F.col("node") != F.col("leader"))).select(
        F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"),
        F.col("words").alias("a_words"), F.col("leader_words").alias("b_words"), "n")
    found = pairs.select("a", "b", "a_words", "b_words", "n").unionByName(led).filter(_length_fits())
    return found.groupBy("a", "b").agg(F.max("n").alias("n"))


def _largest(pairs: DataFrame) -> DataFrame:
    """Of the pairs of each text the one in its largest bucket, with the least texts among equals."""
    best = F.max(F.struct("n", F.bitwise_not("a").alias("a"), F.bitwise_not("b").alias("b"))).alias("best")
    ends = pairs.withColumn("node", F.col("a")).unionByName(pairs.withColumn("node", F.col("b")))
    return ends.groupBy("node").agg(best).select(
        F.bitwise_not("best.a").alias("a"), F.bitwise_not("best.b").alias("b")).distinct()


def _apart(pairs: DataFrame, tried: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs that are not tried yet and whose texts are in different classes."""
    for side in ("a", "b"):
        own = parts.select(F.col("node").alias(side), F.col("component").alias(f"{side}_part"))
        pairs = pairs.join(own, side, "left").withColumn(f"{side}_part", F.coalesce(f"{side}_part", side))
    return pairs.filter("a_part <> b_part").select("a", "b").join(tried, ["a", "b"], "left_anti")


def _linked_first(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links u, v that join the classes of all linked pairs, without those that classes have already."""
    tried = materialize(_largest(pairs))
    parts = components(_verified(tried, texts))
    return _stars(parts).unionByName(_verified(materialize(_apart(pairs, tried, parts)), texts))


def _stars(parts: DataFrame) -> DataFrame:
    """A link u, v of every node with the least one of its class."""
    return parts.filter("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))


_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _agreeing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether texts on the left and on the right, as rows of marks, share AGREE marks or more."""
    out = np.empty((len(left), len(right)), bool)
    columns = right.T.copy()
    for lo in range(0, len(left), 64):
        same = np.zeros((len(left[lo:lo + 64]), len(right)), np.uint16)
        for x, y in zip(left[lo:lo + 64].T, columns):
            same += x[:, None] == y[None, :]
        out[lo:lo + 64] = same >= AGREE
    return out


def _link_open(group: pa.Table) -> pa.Table:
    """Links of open members of a bucket to one block of its members, if others do not link them already."""
    is_open, waits = (group.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("open", "waits"))
    nodes, parts, words = (group.column(c).to_numpy() for c in ("node", "component", "words"))
    marks = np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint8).reshape(group.num_rows, -1)
    marks = np.concatenate([marks & 15, marks >> 4], axis=1)
    openers, targets = np.flatnonzero(is_open), np.flatnonzero(~is_open)
    near = _agreeing(marks[openers], marks[targets])
    near &= parts[openers][:, None] != parts[targets][None, :]
    # Two open members meet twice, as either may be the target.
    near &= ~waits[targets][None, :] | (nodes[openers][:, None] < nodes[targets][None, :])
    near &= (np.minimum(words[openers][:, None], words[targets][None, :])
             >= SIMILARITY * np.maximum(words[openers][:, None], words[targets][None, :]) - 1e-6)
    i, j = np.nonzero(near)
    i, j = openers[i], targets[j]
    # A pair meets in many buckets and is aligned in the first. Where that is a small one, it has been aligned already.
    slots = np.frombuffer(b"".join(group.column("slots").to_pylist()), np.uint32).reshape(group.num_rows, -1)
    here = _slot(group.column("key").to_numpy()[:1])[0]
    first = np.zeros(len(i), bool)
    for lo in range(0, len(i), 1 << 16):
        left, right = slots[i[lo:lo + (1 << 16)]], slots[j[lo:lo + (1 << 16)]]
        at = ((left == right) & (left > 0)).argmax(axis=1)
        first[lo:lo + (1 << 16)] = left[np.arange(len(at)), at] == here
    codes, ready, root, links = group.column("codes"), {}, {}, []

    def prepared(x: int) -> tuple[np.ndarray, ...]:
        if x not in ready:
            ready[x] = _bounded(np.frombuffer(codes[x].as_py(), np.uint32).astype(np.uint64))
        return ready[x]

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in zip(i[first].tolist(), j[first].tolist()):
        x, y = find(parts[a]), find(parts[b])
        if x != y and _linked(prepared(a), prepared(b)):
            links.append((nodes[a], nodes[b]))
            root[x] = y
    return pa.Table.from_pylist([{"u": int(a), "v": int(b)} for a, b in links], schema=_LINKS)


def _open_links(members: DataFrame, parts: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of members of large buckets that are in another class than their leader so far."""
    large = members.filter(F.col("n") > SMALL_BUCKET).select("key", "node", "words", "leader", "n")
    known = large.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    led = parts.select(F.col("node").alias("leader"), F.col("component").alias("led"))
    known = known.join(led, "leader", "left").select("key", "node", "words", "n", "component", (
        F.col("component") != F.coalesce("led", "leader")).alias("open"))
    known = materialize(known)
    # Members and open ones are cut into blocks; a task compares one block of each.
    cut = (known.groupBy("key").agg(F.sum(F.col("open").cast("long")).alias("waiting")).filter("waiting > 0")
           .select("key", F.ceil(F.col("waiting") / F.lit(BLOCK_MEMBERS)).cast("int").alias("visits")))
    asked = known.join(cut, "key").withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK_MEMBERS)).cast("int"))
    asked = asked.withColumn("waits", F.col("open")).join(texts.select("node", "marks", "codes", "slots"), "node")

    def own(count: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(count)).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    kept = ("key", "node", "words", "component", "waits", "marks", "codes", "slots")
    targets = asked.select(*kept, F.lit(False).alias("open"), own("blocks").alias("block"), each("visits").alias("visit"))
    openers = asked.filter("open").select(*kept, "open", each("blocks").alias("block"), own("visits").alias("visit"))
    links = targets.unionByName(openers).groupBy("key", "block", "visit").applyInArrow(_link_open, "u long, v long")
    return links.distinct()


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, copy key and class_id of every row of docs."""
    rows = sketches(bound_batches(docs).select("doc_id", "text"))
    nodes = materialize(distinct_texts(rows))
    # One row per distinct text, of its smallest doc_id.
    chosen = materialize(rows.join(nodes.withColumnRenamed("low", "doc_id"), ["copy", "doc_id"])
                         .dropDuplicates(["copy", "doc_id"]))
    keyed = chosen.select("node", "words", F.explode("keys").alias("key"))
    order = F.xxhash64("key", "node")
    buckets = (keyed.groupBy("key").agg(F.count("*").alias("n"), F.min_by("node", order).alias("leader"),
                                        F.min_by("words", order).alias("leader_words")).filter("n > 1"))
    members = materialize(keyed.join(buckets, "key"))
    # The texts are shuffled once, and only those that share a bucket are written.
    wanted = chosen.select("copy", "doc_id", "node", "slots").join(members.select("node").distinct(), "node", "left_semi")
    texts = materialize(docs.select("doc_id", _copy_key().alias("copy"), text_bytes().alias("text"))
                        .join(wanted.hint("merge"), ["copy", "doc_id"])
                        .dropDuplicates(["copy", "doc_id"])
                        .select("node", "text", "slots", F.pandas_udf(compact_batch, "marks binary, codes binary")("text").alias("c"))
                        .select("node", "text", "slots", "c.*"))
    first = components(_linked_first(materialize(_first_pairs(members)), texts))
    found = _stars(first).unionByName(_open_links(members, first, texts))
    named = nodes.join(components(found), "node", "left").select("copy", "low", F.coalesce("component", "node").alias("component"))
    named = materialize(named)
    least = named.groupBy("component").agg(F.min("low").alias("class_id"))
    named = named.join(least, "component").select("copy", "class_id")
    return rows.select("doc_id", "copy").join(named, "copy", "left").withColumn(
        "class_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stand for their class, with all columns: one row of each; null doc_ids stay."""
    key = unused("_copy", docs)
    found = classes(docs)
    kept = found.filter("doc_id = class_id").select("doc_id", F.col("copy").alias(key)).distinct()
    named = docs.withColumn(key, _copy_key())
    stay = named.join(kept.hint("merge"), ["doc_id", key], "left_semi").dropDuplicates(["doc_id", key])
    return stay.unionByName(named.filter("doc_id IS NULL")).select(*[F.col(f"`{c}`") for c in docs.columns])
