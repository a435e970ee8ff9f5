"""Grid-keyed spatial joins: ordinary equi-joins Catalyst can plan.

Every polygon picks the grid level whose cells are at least as large as its box
and registers in the at most four cells it touches; every point looks into one
cell of each level in use. Large and small polygons thus cost the same, and the
join key is a column pair. Nothing is broadcast: sizes are estimated from files,
before rows are copied to their cells, so the joins ask for a merge. Dense cells
are split by adaptive skew handling.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotweave.functions import geometry as g

#: Cell size grows by this factor per level; coarsest level.
GROWTH, TOP = 4, 12


def _level(box: Column, cell: float) -> Column:
    extent = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])
    return F.least(F.greatest(F.ceil(F.log(F.greatest(extent / cell, F.lit(1e-9))) / F.log(F.lit(float(GROWTH)))), F.lit(0)), F.lit(TOP)).cast("int")


def _size(level: Column, cell: float) -> Column:
    return F.lit(cell) * F.pow(F.lit(float(GROWTH)), level)


def _cells(box: Column, size: Column) -> Column:
    """Cells a box touches, as structs (cx, cy)."""
    def axis(lo: Column, hi: Column) -> Column:
        return F.sequence(F.floor(lo / size), F.floor(hi / size))

    return F.flatten(F.transform(axis(box["xmin"], box["xmax"]), lambda x: F.transform(axis(box["ymin"], box["ymax"]), lambda y: F.struct(x.alias("cx"), y.alias("cy")))))


def keyed_polygons(polygons: DataFrame, cell: float) -> DataFrame:
    """Adds level, cx, cy; one row per touched cell. Needs ``bbox``."""
    box = F.col("bbox")
    at = polygons.where(box.isNotNull()).withColumn("level", _level(box, cell))
    return at.withColumn("_c", F.explode(_cells(box, _size(F.col("level"), cell)))).withColumns({"cx": F.col("_c.cx"), "cy": F.col("_c.cy")}).drop("_c")


def levels_of(polygons: DataFrame, cell: float) -> list[int]:
    """Levels in use (at most TOP + 1 values)."""
    return sorted(r[0] for r in polygons.where("bbox is not null").select(_level(F.col("bbox"), cell).alias("l")).distinct().collect())


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float, levels: list[int] | None = None,
                       exact: Callable[[Column, Column, Column], Column] | None = g.within, by: Sequence[str] = (), narrow_points: bool = False) -> DataFrame:
    """Pairs of ``points`` (x, y, …) and ``polygons`` (bbox, rings, …) with the
    point strictly inside and equal ``by`` columns. Other column names must not
    clash. Either the polygons stand in every cell they touch and a point looks
    into its own, or, with ``narrow_points``, a polygon stands in the cell of its
    lower left corner and a point looks into four: the side with less to carry is
    copied. A pair meets in one cell either way."""
    levels = (levels_of(polygons, cell) if levels is None else levels) or [0]
    near = ((0, 0), (0, -1), (-1, 0), (-1, -1)) if narrow_points else ((0, 0),)

    def cell_of(c: str, level: int, step: int) -> Column:
        return F.floor(F.col(c) / (cell * GROWTH**level)) + step

    looks = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), cell_of("x", k, i).alias("cx"), cell_of("y", k, j).alias("cy")) for k in levels for i, j in near]))
    keyed = points.where("x is not null and y is not null").withColumn("_k", looks).withColumns({c: F.col(f"_k.{c}") for c in ("level", "cx", "cy")}).drop("_k")
    box, x, y = F.col("bbox"), F.col("x"), F.col("y")
    if narrow_points:
        size = _size(F.col("level"), cell)
        at = polygons.where(box.isNotNull()).withColumn("level", _level(box, cell))
        standing = at.withColumns({"cx": F.floor(box["xmin"] / size), "cy": F.floor(box["ymin"] / size)})
    else:
        standing = keyed_polygons(polygons, cell)
    pairs = keyed.join(standing.hint("merge"), ["level", "cx", "cy", *by])
    pairs = pairs.where((x > box["xmin"]) & (x < box["xmax"]) & (y > box["ymin"]) & (y < box["ymax"]))
    if exact is not None:
        pairs = pairs.where(exact(x, y, F.col("rings")))
    return pairs.drop("level", "cx", "cy")


def boxes_meet(left: DataFrame, right: DataFrame, cell: float, by: Sequence[str] = ()) -> DataFrame:
    """Pairs whose boxes overlap with positive area. Both sides need ``bbox``
    (renamed ``l_bbox`` and ``r_bbox`` in the result). A pair is kept only in the
    cell that holds the lower left corner of the shared box, at the coarser of
    the two levels, so it appears once."""
    a_levels, b_levels = levels_of(left, cell), levels_of(right, cell)
    every = sorted({*a_levels, *b_levels}) or [0]

    def keyed(df: DataFrame, name: str) -> DataFrame:
        box = F.col(name)
        df = df.withColumnRenamed("bbox", name).where(box.isNotNull()).withColumn(f"_{name}", _level(box, cell))
        at = F.explode(F.array_compact(F.array(*[F.when(F.lit(k) >= F.col(f"_{name}"), F.lit(k)) for k in every])))
        df = df.withColumn("level", at)
        return df.withColumn("_c", F.explode(_cells(box, _size(F.col("level"), cell)))).withColumns({"cx": F.col("_c.cx"), "cy": F.col("_c.cy")}).drop("_c")

    pairs = keyed(left, "l_bbox").join(keyed(right, "r_bbox").hint("merge"), ["level", "cx", "cy", *by])
    a, b, size = F.col("l_bbox"), F.col("r_bbox"), _size(F.col("level"), cell)
    meet = (F.greatest(a["xmin"], b["xmin"]) < F.least(a["xmax"], b["xmax"])) & (F.greatest(a["ymin"], b["ymin"]) < F.least(a["ymax"], b["ymax"]))
    here = (F.floor(F.greatest(a["xmin"], b["xmin"]) / size) == F.col("cx")) & (F.floor(F.greatest(a["ymin"], b["ymin"]) / size) == F.col("cy"))
    own = F.col("level") == F.greatest("_l_bbox", "_r_bbox")
    return pairs.where(own & meet & here).drop("level", "cx", "cy", "_l_bbox", "_r_bbox")
