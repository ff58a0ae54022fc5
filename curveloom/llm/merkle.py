"""A Merkle manifest of a dataset, built level by level through sibling-shift self-joins.

The rows of each language are the leaves of a tree, and the trees' roots those of a top tree.  On every
level each node is sent to the computed places of its siblings (the index XOR 1 in a binary tree, all other
slots of its run otherwise) and joined there by equality; nodes in slot zero, which then know their whole
run, emit the parents.  Digests are kept as bytes and hashed as lowercase hex text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from curveloom.llm.positions import positions
from curveloom.llm.tables import stored

ARITY = 8
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a row is tampered with when this divides the checksum of its id
TAMPERED_OF = 3


def text_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def digest_of(digests: Column) -> Column:
    """Digest of the hex text of concatenated digests."""
    return F.unhex(F.sha2(text_of(digests), 256))


def _field(value: Column) -> Column:
    held = value.cast("string")
    return F.when(held.isNull(), "-").otherwise(F.concat(F.octet_length(held).cast("string"), F.lit(":"), held))


def leaf_of(**changed: Column) -> Column:
    """Digest of a row of documents, with some columns ``changed``."""
    return F.unhex(F.sha2(F.concat(*(_field(changed.get(c, F.col(c))) for c in LEAF_COLUMNS)), 256))


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes(tree, idx, n, digest)`` with left and right (the digests of siblings in lower and higher slots), parent."""
    slot = F.pmod("idx", F.lit(arity))
    if arity == 2:
        places = F.array(F.col("idx").bitwiseXOR(F.lit(1)))
    else:
        base = F.col("idx") - slot
        places = F.array(*(base + F.pmod(slot + F.lit(shift), F.lit(arity)) for shift in range(1, arity)))
    sent = nodes.select("tree", F.explode(places).alias("idx"), slot.alias("from"), F.col("digest").alias("sent"))
    met = nodes.join(sent, ["tree", "idx"], "left").groupBy("tree", "idx", "n", "digest").agg(
        *(F.max(F.when(F.col("from") == s, F.col("sent"))).alias(f"s{s}") for s in range(arity))
    )
    none = F.unhex(F.lit(""))
    side = lambda keep: F.concat(*(F.coalesce(F.when(keep(s), F.col(f"s{s}")), none) for s in range(arity)))
    met = met.select("tree", "idx", "n", "digest", side(lambda s: slot > s).alias("left"), side(lambda s: slot < s).alias("right"))
    return met.withColumn("parent", F.when(slot == 0, digest_of(F.concat("digest", "right"))))


def _built(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees from the leaves up, each with siblings; and (tree, digest) of the trees' roots."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    levels, tops = [], nodes.where("n = 1").select("tree", "digest")
    while most > 1:
        level = stored(_with_siblings(nodes.where("n > 1"), arity), "level")
        levels.append(level)
        nodes = level.where("parent IS NOT NULL").select(
            "tree", F.floor(F.col("idx") / arity).cast("long").alias("idx"), F.ceil(F.col("n") / arity).cast("long").alias("n"),
            F.col("parent").alias("digest"),
        )
        tops = tops.union(nodes.where("n = 1").select("tree", "digest"))
        most = -(-most // arity)
    return levels, tops


def _paths(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """(tree, idx, path, top) of the nodes of the lowest level; trees of one node are left out.

    ``tops`` has (tree, path, top) of the trees' roots; ``path`` lists (left, right) of a node and all above it.
    """
    above = None
    for level in reversed(levels):
        own = level.withColumn("own", F.struct("left", "right"))
        paths = own.where(F.col("n") <= arity).join(tops, "tree")
        if above is not None:
            inner = own.where(F.col("n") > arity).withColumn("up", F.floor(F.col("idx") / arity).cast("long"))
            paths = paths.unionByName(inner.join(above.withColumnRenamed("idx", "up"), ["tree", "up"]).drop("up"))
        above = paths.select("tree", "idx", F.concat(F.array("own"), "path").alias("path"), "top")
        if level is not levels[0]:
            above = stored(above, "paths")
    return above


@dataclass
class Manifest:
    """``root`` in hex (None without rows), and per row doc_id, tree, idx, leaf, changed, subroot, path."""

    root: str | None
    entries: DataFrame


def manifest(docs: DataFrame, changed: Column | None = None, arity: int = ARITY) -> Manifest:
    """The trees of ``docs`` by lang, leaves by doc_id (NULL first; ties by digest).

    ``changed`` may give another digest of a row, kept beside its leaf for a later check.  A path lists the
    siblings (left, right) from the leaf up to the root of the top tree.  Any column may be NULL; NULL is a
    language of its own, before all others.  Rows that repeat are leaves of their own.  Other columns are not read.
    """
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("+"), "lang")).alias("tree"),
            leaf_of().alias("leaf"), (F.lit(None).cast("binary") if changed is None else changed).alias("changed"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "leaves",
    )
    placed = stored(positions(rows, "tree", ["doc_id", "leaf", "row"]), "nodes")
    levels, tops = _built(placed.select("tree", "idx", "n", F.col("leaf").alias("digest")), arity)
    subroots = stored(
        positions(stored(tops, "tops").withColumn("all", F.lit("")), "all", ["tree"])
        .select("tree", "idx", "n", F.col("digest").alias("subroot")),
        "subroots",
    )
    upper, root = _built(subroots.select(F.lit("").alias("tree"), "idx", "n", F.col("subroot").alias("digest")), arity)
    found = root.first()
    no_path = F.array().cast("array<struct<left:binary,right:binary>>")
    if upper:
        start = root.select("tree", no_path.alias("path"), F.col("digest").alias("top"))
        tops = subroots.join(_paths(upper, start, arity).select("idx", "path"), "idx").select(
            "tree", "path", F.col("subroot").alias("top"))
    else:
        tops = subroots.select("tree", no_path.alias("path"), F.col("subroot").alias("top"))
    tops = stored(tops, "trees")
    single = placed.where("n = 1").join(tops, "tree")
    entries = single.select("doc_id", "tree", "idx", "leaf", "changed", F.col("top").alias("subroot"), "path")
    if levels:
        whole = placed.where("n > 1").join(_paths(levels, tops, arity), ["tree", "idx"])
        entries = entries.union(whole.select("doc_id", "tree", "idx", "leaf", "changed", F.col("top").alias("subroot"), "path"))
    return Manifest(found["digest"].hex() if found else None, entries)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda acc, step: digest_of(F.concat(step["left"], acc, step["right"])))


def tamper_check(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Rows whose id's checksum is divisible by three are tampered with: A-Z in the text become small.  The
    folded root is made from that leaf and the original siblings.  A NULL text or doc_id stays as it is,
    and a text without A-Z still verifies.  No documents give no rows.
    """
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(TAMPERED_OF)) == 0
    lowered = leaf_of(text=F.translate("text", CAPITALS, SMALL))
    held = manifest(docs, F.when(tampered, lowered), arity)
    siblings = F.aggregate("path", F.unhex(F.lit("")), lambda acc, step: F.concat(acc, step["left"], step["right"]))
    again = folded(F.coalesce("changed", "leaf"), F.col("path"))
    return held.entries.select(
        "doc_id", text_of(F.col("leaf")).alias("leaf"), text_of(F.col("subroot")).alias("subroot"),
        F.lit(held.root).cast("string").alias("root"), text_of(digest_of(siblings)).alias("proof_sha256"),
        text_of(again).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
