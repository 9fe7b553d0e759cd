"""Merkle manifest of a document table: a root, and a proof for every row.

Every row is a leaf, every source a tree with a fanout of 16, and the roots of
the sources form one more tree. Levels are built by a slot pivot: conditional
aggregates spread the children of a parent into 16 columns. Concatenating the
columns gives the parent's digest; leaving the own column out gives a child's
siblings. Going down again, each child takes over the steps of its parent and
puts its own siblings before them, so a leaf ends up with its whole proof and no
table is joined with anything but the level above it.

The position of a leaf in its source comes from a range partitioning by source
and doc_id, written once: its place in the partition, and the rows of the source
in earlier partitions. So a source of any size is spread over all tasks. Texts
never leave the scan; a row is its digest and, where tampering is tried, the
digest of the changed row. A table of n rows takes log16(n) levels, each a
sixteenth of the one below.

Defined results: a null doc_id sorts first and is never tampered with; rows of
one source and doc_id are ordered by their digests, so equal rows may swap places;
a source of one row is its own subroot; an empty table gives an empty result;
columns other than those of the leaf are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.session import materialize

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows whose doc_id has a checksum divisible by this are tampered with.
TAMPER_EVERY = 5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SLOTS = [f"c{i}" for i in range(FANOUT)]


def leaf_digest(**changed: Column) -> Column:
    """Digest of the fields of a row, each with its length in bytes before it, or a dash if null."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """key (of the source), source, doc_id, leaf, and tampered: the digest after tampering, null where nothing changes."""
    lowered = F.translate("text", _UPPER, _UPPER.lower())
    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0
    # The null source is the empty key and sorts first; the others keep their order behind a mark.
    return docs.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("key"), "doc_id",
                       leaf_digest().alias("digest"),
                       F.when(chosen & (lowered != F.col("text")), leaf_digest(text=lowered)).alias("tampered"))


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``at``, the place of a row among those of its key in the given order, and ``size``, the rows of its key."""
    rows = materialize(rows)  # the range partitioning reads its input twice
    blocks = materialize(rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
                         .withColumn("place", F.monotonically_increasing_id()))
    # One row per key and partition that holds it. Places count up by one inside a partition.
    block = F.shiftright("place", 33)
    held = blocks.groupBy("key", block.alias("block")).agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("key", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                       F.sum("n").over(Window.partitionBy("key")).alias("size"))
    return blocks.withColumn("block", block).join(held, ["key", "block"]).select(
        *[c for c in rows.columns], (F.col("before") + F.col("place") - F.col("first")).alias("at"), "size")


def _hashed(parts: list[Column]) -> Column:
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), 256)


def pivot(nodes: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """The parents of nodes (key, at, size, digest, carried columns), with a column per child.

    A key with a single node gives one row as well, whose digest is that node's:
    the tree of the key ends there.
    """
    own = F.struct("digest", *carried)
    spread = [F.max(F.when(F.col("at") % FANOUT == i, own)).alias(c) for i, c in enumerate(_SLOTS)]
    parents = nodes.groupBy("key", F.floor(F.col("at") / FANOUT).alias("at"), "size").agg(*spread)
    alone = F.col("size") == 1
    digest = F.when(alone, F.col("c0.digest")).otherwise(_hashed([F.col(f"{c}.digest") for c in _SLOTS]))
    return parents.select("key", "at", F.ceil(F.col("size") / FANOUT).alias("size"), alone.alias("alone"), *_SLOTS,
                          digest.alias("digest"))


def levels(nodes: DataFrame, carried: tuple[str, ...] = ()) -> list[DataFrame]:
    """The parents of each level from the lowest up, until every key has one node; all are written."""
    out = [materialize(pivot(nodes, carried))]
    while not (more := out[-1].filter("size > 1")).isEmpty():
        out.append(materialize(pivot(more.select("key", "at", "size", "digest"))))
    return out


def _children(parents: DataFrame, above: tuple[str, ...]) -> DataFrame:
    """key, at, child and steps of every child of parents (key, at, alone, slots, steps).

    A step is the text to the left and to the right of a node in what its parent
    hashes; a node that is alone in its tree takes no step.
    """
    def joined(slots: list[str]) -> Column:
        return F.concat(F.lit(""), *[F.coalesce(F.col(f"{c}.digest"), F.lit("")) for c in slots])

    each = [F.when(F.col(c).isNotNull(), F.struct(
        (F.col("at") * FANOUT + i).alias("at"), F.col(c).alias("child"),
        F.struct(joined(_SLOTS[:i]).alias("left"), joined(_SLOTS[i + 1:]).alias("right")).alias("step")))
        for i, c in enumerate(_SLOTS)]
    rows = parents.select("key", "alone", "steps", *above, F.explode(F.array_compact(F.array(*each))).alias("of"))
    steps = F.when(F.col("alone"), F.col("steps")).otherwise(F.concat(F.array("of.step"), "steps"))
    return rows.select("key", F.col("of.at").alias("at"), F.col("of.child").alias("child"), steps.alias("steps"), *above)


_NO_STEPS = "array<struct<left:string,right:string>>"


def proofs(built: list[DataFrame], tops: DataFrame | None, above: tuple[str, ...] = ()) -> DataFrame:
    """key, at, child, steps and the columns above of every node that the lowest level was built from.

    ``tops`` holds the steps from the root of each key's tree on, and the columns
    above; without it the tree is the whole and its root the only further column.
    """
    path = None
    for level in reversed(built):
        top = level.filter("size = 1")
        if tops is None:
            top = top.select("*", F.array().cast(_NO_STEPS).alias("steps"), F.col("digest").alias("root"))
        else:
            top = top.join(tops, "key")
        if path is not None:
            inner = level.filter("size > 1").join(path.select("key", "at", "steps", *above), ["key", "at"])
            top = top.unionByName(inner)
        path = _children(top, above)
    return path


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, digest of the proof, and the root that follows from the row after tampering."""
    rows = positions(leaves(docs), ["doc_id", "digest"])
    sources = levels(rows, ("doc_id", "tampered"))
    subroots = [level.filter("size = 1").select("key", "digest") for level in sources]
    named = subroots[0]
    for more in subroots[1:]:
        named = named.unionByName(more)
    # The sources are the leaves of one more tree.
    whole = levels(positions(named.select(F.lit("").alias("key"), F.col("key").alias("name"), "digest"), ["name"]),
                   ("name",))
    tops = proofs(whole, None, ("root",)).select(
        F.col("child.name").alias("key"), "steps", F.col("child.digest").alias("subroot"), "root")
    found = proofs(sources, tops, ("subroot", "root"))
    siblings = F.transform("steps", lambda s: F.concat(s["left"], s["right"]))
    folded = F.aggregate("steps", F.coalesce("child.tampered", "child.digest"),
                         lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))
    return (found.select(F.col("child.doc_id").alias("doc_id"), F.col("child.digest").alias("leaf"), "subroot", "root",
                         F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
