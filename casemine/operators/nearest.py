"""The k nearest members of a group on the (x, y) plane, exactly.

Cases at one place are folded first: of a place's cases only the k + 1 smallest
ids can be anyone's neighbour there (ties go by id), so a place that holds a third
of all cases is one row.

Places lie in a pyramid of square grids over the plane, each level halving the
cells.  A place takes the finest cell around it that holds k + 1 ids: its own
scale, fine where cases are dense, coarse where they are sparse.  All its nearest
lie no farther than that cell's farthest member, so it meets just the cells of
this level that the circle touches (at most five a side), by an equi-join.  A
place whose cell is coarse has at most k others in the next finer one, so a dense
cell is only asked by a bounded number of places on each level: the number of
pairs grows in proportion to the places, however they are spread.  Cells with
very many places are dealt over tasks (``skew.py``).

Nothing but the plane's bounding box and the depth of the grid, which follows the
densest spot, reaches the driver.
Edge cases: rows without group, place or id are left out; ids are unique; groups
of fewer than k + 1 cases give as many neighbours as there are; an empty table
gives an empty result; all cases in one place are each other's at distance 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .broadcast import join_small
from .skew import salted_join

DEPTHS = range(8, 49, 4)  # halvings of the plane's side that are tried
CELL_PLACES = 8           # places in a finest cell at most, unless they are closer than that


def places(points: DataFrame, group: str, k: int, case_id: str = "case_id") -> DataFrame:
    """(place, grp, x, y, ids): every place of a group with its k + 1 smallest ids."""
    rows = points.select(F.col(group).alias("grp"), F.col("x").cast("double").alias("x"),
                         F.col("y").cast("double").alias("y"), F.col(case_id).alias("id")).dropna()
    # the limit is applied before the shuffle too, so hot places don't travel
    few = rows.withColumn("r", F.row_number().over(Window.partitionBy("grp", "x", "y").orderBy("id"))).where(F.col("r") <= k + 1)
    return few.groupBy("grp", "x", "y").agg(F.array_sort(F.collect_list("id")).alias("ids")) \
        .select(place_key("grp", "x", "y").alias("place"), "grp", "x", "y", "ids")


def place_key(group: str, x: str, y: str) -> Column:
    return F.concat_ws(" ", F.col(x).cast("double").cast("string"), F.col(y).cast("double").cast("string"),
                       F.col(group).cast("string"))


def _cell_key(level: Column, cx: Column, cy: Column) -> Column:
    return F.concat_ws(" ", level, cx, cy, F.col("grp").cast("string"))


def _square(c: Column) -> Column:
    return c * c


def _fine(c: Column, start: float, side: float, depth: int) -> Column:
    """The finest cell of a coordinate."""
    cell = F.floor((c - F.lit(start)) / F.lit(side) * F.lit(float(1 << depth)))
    return F.greatest(F.least(cell, F.lit((1 << depth) - 1)), F.lit(0)).cast("long")


def grid_depth(locs: DataFrame, x0: float, y0: float, side: float) -> int:
    """Halvings after which dense spots are split up (one count each)."""
    for depth in DEPTHS:
        cell = [_fine(F.col("x"), x0, side, depth).alias("cx"), _fine(F.col("y"), y0, side, depth).alias("cy")]
        if (locs.groupBy("grp", *cell).count().agg(F.max("count")).first()[0] or 0) <= CELL_PLACES:
            break
    return depth


def candidates(locs: DataFrame, k: int, depth: int | None = None) -> DataFrame:
    """(place, dist2, ids): every place with the places that may hold one of its
    nearest, itself among them.  ``depth``: levels of the grid (default: as many
    as the densest spot needs)."""
    box = locs.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if box[0] is None:
        return locs.select("place", F.lit(0.0).alias("dist2"), "ids")
    x0, x1, y0, y1 = box
    side = max(x1 - x0, y1 - y0) or 1.0
    depth = grid_depth(locs, x0, y0, side) if depth is None else depth

    def fine(c: Column, start: float) -> Column:
        return _fine(c, start, side, depth)

    def at_level(c: Column, level: Column) -> Column:
        return F.floor(c / F.pow(F.lit(2.0), F.lit(depth) - level)).cast("long")  # whole numbers below 2^depth

    levels = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    cells = locs.select("place", "grp", "x", "y", "ids", levels).withColumn("cell", _cell_key(
        F.col("level"), at_level(fine(F.col("x"), x0), F.col("level")), at_level(fine(F.col("y"), y0), F.col("level"))))
    full = cells.groupBy("cell").agg(
        F.sum(F.size("ids")).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"),
        F.max("y").alias("y1")).where(F.col("n") >= k + 1).drop("n")

    # the finest full cell of every place, and how far its members are at most
    finest = salted_join(cells.select("place", "level", "cell"), full, "cell").groupBy("place").agg(
        F.max_by(F.struct("level", "x0", "x1", "y0", "y1"), "level").alias("at"))
    far = (_square(F.greatest(F.col("x") - F.col("at.x0"), F.col("at.x1") - F.col("x")))
           + _square(F.greatest(F.col("y") - F.col("at.y0"), F.col("at.y1") - F.col("y"))))
    asks = locs.select("place", "grp", "x", "y").join(finest, "place", "left").select(
        "place", "grp", "x", "y", F.coalesce("at.level", F.lit(0)).alias("level"), far.alias("far2"))
    reach = F.sqrt("far2") * F.lit(1 + 1e-9) + F.lit(side * 1e-9)

    def span(c: Column, start: float) -> Column:
        low, high = (at_level(fine(edge, start), F.col("level")) for edge in (c - reach, c + reach))
        # a group of fewer than k + 1 cases: its one cell of level 0
        return F.explode(F.when(F.col("far2").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(low, high)))

    met = (asks.withColumn("cx", span(F.col("x"), x0)).withColumn("cy", span(F.col("y"), y0))
           .select(_cell_key(F.col("level"), F.col("cx"), F.col("cy")).alias("cell"), F.col("place").alias("asker"),
                   F.col("x").alias("ax"), F.col("y").alias("ay"), "far2"))
    pairs = salted_join(cells.select("cell", "x", "y", "ids"), met, "cell")
    dist2 = _square(F.col("x") - F.col("ax")) + _square(F.col("y") - F.col("ay"))
    return pairs.select(F.col("asker").alias("place"), dist2.alias("dist2"), "ids", "far2").where(
        F.col("far2").isNull() | (F.col("dist2") <= F.col("far2"))).drop("far2")


def related(points: DataFrame, group: str, k: int, case_id: str = "case_id", depth: int | None = None) -> DataFrame:
    """(case_id, rank, related_id, dist2): the k nearest other cases of the same
    group, nearest first, ties by id."""
    ensure_checkpoint_dir(points.sparkSession)
    locs = places(points, group, k, case_id).checkpoint(eager=True)
    # k + 1 places hold k + 1 ids at least: those of the nearest places suffice
    order = Window.partitionBy("place").orderBy("dist2", F.col("ids")[0])
    near = candidates(locs, k, depth).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    each = F.transform("ids", lambda i: F.struct(F.col("dist2"), i.alias("id")))
    lists = near.groupBy("place").agg(F.slice(F.array_sort(F.flatten(F.collect_list(each))), 1, k + 1).alias("near"))
    rows = points.select(F.col(case_id).alias("id"), place_key(group, "x", "y").alias("place")).where(
        F.col(group).isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("id").isNotNull())
    mine = join_small(rows, lists.checkpoint(eager=True), "place", "inner")
    others = F.slice(F.filter("near", lambda n: n["id"] != F.col("id")), 1, k)
    return mine.select("id", F.posexplode(others).alias("pos", "n")).select(
        F.col("id").alias(case_id), (F.col("pos") + 1).alias("rank"), F.col("n.id").alias("related_id"),
        F.col("n.dist2").alias("dist2"))
