"""Groups of documents with similar SpotSigs sets, found without comparing all pairs.  Only built-in functions.

Sets are partitioned by their length, so that only sets whose lengths allow the likeness meet, and
within a length range by the rarest signatures of each set, of which similar sets share at least one.
What meets is compared through the size bound and then by the exact Jaccard likeness.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from curveloom.llm.components import components
from curveloom.llm.minhash import _blocks, _named, _unsettled
from curveloom.llm.spotsigs import signatures
from curveloom.llm.tables import discard, stored

PERCENT = 80


def alike(a: Column, b: Column, percent: int) -> Column:
    """Whether two signature sets have a Jaccard likeness of ``percent`` or more; sizes that rule it out go first."""
    shared = F.size(F.array_intersect(a, b))
    sizes = F.size(a) + F.size(b)
    bound = F.least(F.size(a), F.size(b)) * 100 >= F.greatest(F.size(a), F.size(b)) * percent
    return F.when(bound, shared * 100 >= (sizes - shared) * percent).otherwise(F.lit(False))


def _members(sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, set_id, size, pivot): sets that share a length range and one of their rarest signatures.

    A set of n signatures shares at least ``percent`` of them with a similar one, so one of its rarest
    n - percent * n / 100 + 1 is shared.  Lengths of similar sets differ by less than one range; each
    set is in its own range and the next, so sets of neighbouring ranges meet in the upper one.
    """
    listed = sets.select("set_id", F.explode("spots").alias("spot"))
    held = listed.groupBy("spot").agg(F.count("*").alias("n"))
    ranked = listed.join(held, "spot").groupBy("set_id").agg(F.sort_array(F.collect_list(F.struct("n", "spot"))).alias("ranked"))
    length = F.size("ranked")
    prefix = F.slice("ranked", 1, length - F.ceil(length * percent / 100).cast("int") + 1)
    # a little wider than the likeness allows, so that rounding never puts two ranges between similar sets
    span = F.floor(F.log(length.cast("double")) / math.log(100 / percent * (1 + 1e-9)))
    # a signature of one set alone leads to no other
    rows = ranked.select(
        "set_id", span.alias("span"), F.explode(F.filter(prefix, lambda s: s["n"] > 1)["spot"]).alias("spot")
    ).select("set_id", "spot", F.explode(F.array(F.col("span"), F.col("span") + 1)).alias("span"))
    rows = stored(rows.select("set_id", F.concat_ws(":", "spot", F.col("span").cast("string")).alias("bucket")), "spot-buckets")
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size"), F.min("set_id").alias("pivot")).where("size > 1")
    members = stored(rows.join(shared, "bucket"), "spot-members")
    discard(rows)
    return members


def _set_components(sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of all linked sets.

    Every set of a bucket meets the bucket's smallest one, which joins most of a group of near
    copies; where a bucket still holds several components, each set outside the largest one then
    meets all others in blocks, and a block hands on components, not pairs.
    """
    members = _members(sets, percent)
    stars = members.where(F.col("set_id") != F.col("pivot")).select(
        F.col("set_id").alias("a"), F.col("pivot").alias("b")
    ).distinct()
    first, second = sets.toDF("a", "spots_a"), sets.toDF("b", "spots_b")
    links = stored(
        stars.join(first, "a").join(second, "b").where(alike(F.col("spots_a"), F.col("spots_b"), percent)).select("a", "b"),
        "spot-links",
    )
    roots = stored(components(links), "spot-roots")
    blocks = _named(_blocks(_unsettled(members, roots)), roots).join(sets, "set_id")
    place = ["bucket", "i", "j"]
    asked = blocks.where("side = 0").select(*place, F.col("root").alias("a"), F.col("spots").alias("spots_a"))
    others = blocks.where("side = 1").select(*place, F.col("root").alias("b"), F.col("spots").alias("spots_b"))
    more = (
        asked.join(others, place)
        .where((F.col("a") != F.col("b")) & alike(F.col("spots_a"), F.col("spots_b"), percent))
        .select("a", "b").distinct()
    )
    found = stored(components(links.union(stored(more, "spot-links"))), "spot-roots")
    for table in (members, links, roots):
        discard(table)
    return found


def similar_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_signatures, group_id, kept.

    Documents whose signature sets have a Jaccard likeness of ``percent`` or more are linked, and
    group_id is the smallest doc_id that links reach.  Copies are one set.  A text without a
    signature (NULL, empty, only common words) is alone.  Rows that repeat a doc_id are documents of
    their own with that id.  A NULL doc_id keeps its row; its group has an id only beside documents
    with one, and kept is then false, else both are NULL.  Other columns are not read; no documents
    give no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        signatures(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("spots"),
    )
    rows = stored(
        rows.withColumn("set_id", F.when(F.size("spots") > 0, F.sha2(F.array_join("spots", ""), 256))), "spots"
    )
    sets = stored(rows.where("set_id IS NOT NULL").groupBy("set_id").agg(F.any_value("spots").alias("spots")), "spot-sets")
    named = _named(rows.select("doc_id", F.size("spots").cast("long").alias("n_signatures"), "set_id"), _set_components(sets, percent))
    lowest = named.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("lowest"))
    group = F.coalesce("lowest", "doc_id")
    return named.join(lowest, "root", "left").select(
        "doc_id", "n_signatures", group.alias("group_id"),
        F.when(group.isNotNull(), F.col("doc_id").eqNullSafe(group)).alias("kept"),
    )
