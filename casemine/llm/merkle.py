"""Merkle manifest of a dataset, with an inclusion proof for every row.

Every row is a leaf; the leaves of a group (say, a source), in the order of
their ids, make a tree in which runs of ``fan`` consecutive nodes become their
parent, and the groups' roots make one tree on top.

A node is labelled with the interval of leaf ranks that it covers, [lo, hi).
A parent's interval contains its children's, so ancestors are attached by a
containment join, level by level from the top: nodes of a level are bucketed by
the width of that level's intervals, a node meets the parent whose interval
contains its own, and what the parent's interval holds beside the node's own is
covered by the siblings.  A path thus travels down once per parent, not once per
leaf and level; the rows of a level are a third of those below it.

Leaf ranks come from a range partitioning over (group, id), so a group that
holds most of the rows is spread like any other; no node has more than ``fan``
children, and every level is a table in the shared folder.  Only the height of
the tallest tree reaches the driver.

Edge cases: null fields hash as ``-``; rows without id come first in their
group, rows with one id are ordered by leaf hash and stay single rows, also
where they are equal in everything; a row without a group makes the group that
comes first; a null id counts as not tampered with; empty and very long texts are
hashed like others; an empty table gives an empty result; other columns are not
read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import row_number_within
from .common import cut

FAN = 3
_LEAF = "struct<id:string,fresh:string>"
_KIDS = f"array<struct<lo:long,hi:long,digest:string,leaf:{_LEAF}>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(c: Column) -> Column:
    """A value as ``length in bytes : value``, null as ``-``."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def _joined(kids: Column, keep=None) -> Column:
    """The digests of some children, left to right."""
    return F.array_join(F.transform(kids if keep is None else F.filter(kids, keep), lambda k: k["digest"]), "")


def _bucket(width: int) -> Column:
    return F.expr(f"lo div {width}L").alias("bucket")


def _rise(nodes: DataFrame, width: int, fan: int) -> DataFrame:
    """Parents of the nodes whose tree has more than one on their level: runs
    of ``fan`` neighbours, which lie in one interval of ``width`` ranks."""
    kid = F.struct("lo", "hi", "digest", "leaf")
    kids = F.col("kids")
    return (nodes.where(F.col("size") > width // fan).groupBy("tree", _bucket(width))
            .agg(F.first("size").alias("size"), F.array_sort(F.collect_list(kid)).cast(_KIDS).alias("kids"))
            .select("tree", "size", "kids", kids[0]["lo"].alias("lo"), F.element_at(kids, -1)["hi"].alias("hi"),
                    digest(_joined(kids)).alias("digest"), F.lit(None).cast(_LEAF).alias("leaf")))


def build(leaves: DataFrame, fan: int = FAN) -> list[DataFrame]:
    """Levels of the forest over ``leaves`` (tree, rank from 0, size of the
    tree, digest, leaf: what a leaf carries); level 0 are the leaves themselves."""
    level = cut(leaves.select("tree", "size", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest",
                              F.col("leaf").cast(_LEAF).alias("leaf")))
    tallest = level.agg(F.max("size")).first()[0] or 0
    levels, width = [level], 1
    while width < tallest:
        width *= fan
        level = cut(_rise(level, width, fan))
        levels.append(level)
    return levels


def tops(levels: Sequence[DataFrame], fan: int = FAN) -> DataFrame:
    """(tree, digest) of every tree's root: the node alone on its level."""
    alone = [level.where(F.col("size") <= fan ** k).select("tree", "digest") for k, level in enumerate(levels)]
    return reduce(DataFrame.unionByName, alone)


def attach(levels: Sequence[DataFrame], roots: DataFrame, fan: int = FAN) -> DataFrame:
    """(lo, hi, digest, leaf, path, subroot) of every leaf; ``path`` lists, from
    the leaf's level up, what stands to the left and to the right of its ancestor
    there.  ``roots``: (tree, subroot, path above that)."""
    known = None  # (tree, lo, hi, path, subroot) of the nodes one level up
    for k in range(len(levels) - 1, 0, -1):
        level, width = levels[k], fan ** k
        first = level.where(F.col("size") <= width).select("tree", "lo", "hi").join(roots, "tree")
        known = first if known is None else known.select(*first.columns).unionByName(first)
        a, p = (d.withColumn("bucket", _bucket(width)) for d in (level, known))
        a, p = a.alias("a"), p.alias("p")
        within = ((F.col("a.tree") == F.col("p.tree")) & (F.col("a.bucket") == F.col("p.bucket"))
                  & (F.col("p.lo") <= F.col("a.lo")) & (F.col("a.hi") <= F.col("p.hi")))
        kids = a.join(p, within).select("a.tree", "a.kids", "p.path", "p.subroot", F.explode("a.kids").alias("kid"))
        # the parent's interval without the kid's own: its siblings
        beside = F.struct(
            _joined(F.col("kids"), lambda x: x["hi"] <= F.col("kid.lo")).alias("left"),
            _joined(F.col("kids"), lambda x: x["lo"] >= F.col("kid.hi")).alias("right"))
        known = kids.select("tree", "kid.lo", "kid.hi", "kid.digest", "kid.leaf", "subroot",
                            F.concat(F.array(beside), F.col("path")).alias("path"))
    alone = levels[0].where("size = 1").join(roots, "tree").select(
        "tree", "lo", "hi", "digest", "leaf", "subroot", "path")
    return alone if known is None else known.unionByName(alone)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda below, at: digest(at["left"], below, at["right"]))


def manifest(docs: DataFrame, fields: Sequence[str], group: str, doc_id: str = "doc_id",
             changed: Column | None = None, today: dict[str, Column] | None = None, fan: int = FAN) -> DataFrame:
    """Per row ``doc_id, leaf, subroot, root``, its ``path`` (left and right
    digests from the leaf up), and ``folded_root``: where the row as it is today
    leads to.  Where ``changed``, ``today`` gives the fields that differ now, as
    columns of ``docs``."""
    changed = F.coalesce(changed, F.lit(False)) if changed is not None else F.lit(False)
    leaf, today = digest(*[field(F.col(c)) for c in fields]), today or {}
    fresh = F.when(changed, digest(*[field(today.get(c, F.col(c))) for c in fields])).otherwise(leaf)
    rows = cut(docs.select(F.col(group).cast("string").alias("group"), F.col(doc_id).cast("long").alias("id"),
                           leaf.alias("digest"), fresh.alias("fresh")))
    ranked = row_number_within(rows, ["group"], [F.col("id").asc_nulls_first(), F.col("digest").asc()],
                               name="n", size_name="size")
    leaves = ranked.select("group", field(F.col("group")).alias("tree"), (F.col("n") - 1).alias("rank"), "size",
                           "digest", F.struct(F.col("id").cast("string").alias("id"), "fresh").alias("leaf"))
    levels = build(leaves, fan)

    # one tree over the groups' roots, in the order of the groups
    groups = leaves.where("rank = 0").select("group", "tree").join(tops(levels, fan), "tree")
    over = row_number_within(groups, [], [F.col("group").asc_nulls_first()], name="n", size_name="size")
    above = build(over.select(F.lit("").alias("tree"), (F.col("n") - 1).alias("rank"), "size", "digest",
                              F.struct(F.col("tree").alias("id"), F.lit(None).alias("fresh")).alias("leaf")), fan)
    top = tops(above, fan).first()
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    start = tops(above, fan).select("tree", F.col("digest").alias("subroot"), no_path.alias("path"))
    roots = cut(attach(above, start, fan).select(F.col("leaf.id").alias("tree"), F.col("digest").alias("subroot"), "path"))

    return attach(levels, roots, fan).select(
        F.col("leaf.id").cast("long").alias("doc_id"), F.col("digest").alias("leaf"), "subroot",
        F.lit(top["digest"] if top else None).cast("string").alias("root"), "path",
        fold(F.col("leaf.fresh"), F.col("path")).alias("folded_root"))


def proof(path: Column) -> Column:
    """Digest of a path's siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), ""))
