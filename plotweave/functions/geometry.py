"""Geometry as column expressions over ``rings array<array<struct<x,y>>>``.

Rings of all parts of a geometry stand in one array, closed; with the even-odd
rule over all of them, holes and multipolygons need no special case. WKB enters
and leaves through Arrow batches (``decode``, ``encode``); predicates, areas,
projection and tiles stay in the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotweave.functions import kernels, overlay, wkb
from plotweave.functions.kernels import A1, A2, E, RADIUS, SCALE

_XY = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS = T.ArrayType(T.ArrayType(_XY))
BOX = T.StructType([T.StructField(c, T.DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")])


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Rings of a rectangle, counter-clockwise."""
    def p(x: Column, y: Column) -> Column:
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    return F.array(F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0)))


def bbox(rings: Column) -> Column:
    """Struct xmin, ymin, xmax, ymax; NULL without vertices."""
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    box = F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))
    return F.when(F.size(points) > 0, box)


def within(x: Column, y: Column, rings: Column) -> Column:
    """Strictly inside: odd crossings and on no edge. One pass over the vertices
    of each ring, which remembers the one before."""
    def number(c: Column, n: str) -> Column:
        return c.cast("double").alias(n)

    start = F.struct(F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"), F.lit(False).alias("odd"), F.lit(False).alias("on"))

    def step(a: Column, p: Column) -> Column:
        off = (p["x"] - a["x"]) * (y - a["y"]) - (p["y"] - a["y"]) * (x - a["x"])
        hit = ((a["y"] > y) != (p["y"] > y)) & ((off > 0) == (p["y"] > a["y"])) & (off != 0)
        on = (off == 0) & x.between(F.least(a["x"], p["x"]), F.greatest(a["x"], p["x"])) & y.between(F.least(a["y"], p["y"]), F.greatest(a["y"], p["y"]))
        first = a["x"].isNull()
        return F.struct(number(p["x"], "x"), number(p["y"], "y"), F.when(first, False).otherwise(a["odd"] != hit).alias("odd"), F.when(first, False).otherwise(a["on"] | on).alias("on"))

    ring = F.transform(rings, lambda r: F.aggregate(r, start, step, lambda a: F.struct(a["odd"].alias("odd"), a["on"].alias("on"))))
    both = F.struct(F.lit(False).alias("odd"), F.lit(False).alias("on"))
    return F.aggregate(ring, both, lambda a, r: F.struct((a["odd"] != r["odd"]).alias("odd"), (a["on"] | r["on"]).alias("on")), lambda a: a["odd"] & ~a["on"])


def _shoelace(points: Column) -> Column:
    """Signed area of one ring, one pass; taken from its first vertex (large
    coordinates would cost digits)."""
    def number(c: Column, n: str) -> Column:
        return c.cast("double").alias(n)

    nothing = F.lit(None)
    start = F.struct(number(F.lit(0), "s"), number(nothing, "x0"), number(nothing, "y0"), number(nothing, "x"), number(nothing, "y"))

    def step(a: Column, p: Column) -> Column:
        x, y = p["x"] - F.coalesce(a["x0"], p["x"]), p["y"] - F.coalesce(a["y0"], p["y"])
        cross = F.coalesce(a["x"] * y - x * a["y"], F.lit(0.0))
        return F.struct(number(a["s"] + cross, "s"), number(F.coalesce(a["x0"], p["x"]), "x0"), number(F.coalesce(a["y0"], p["y"]), "y0"), number(x, "x"), number(y, "y"))

    return F.aggregate(points, start, step, lambda a: a["s"] / 2)


def area(rings: Column, projected=lambda ring: ring) -> Column:
    """Planar area. Rings that turn like the first add, others (holes) subtract,
    as writers wind holes against their outer ring."""
    signed = F.transform(rings, lambda r: _shoelace(projected(r)))
    return F.abs(F.aggregate(signed, F.lit(0.0), lambda a, v: a + v))


def utm_zone(lon: Column) -> Column:
    """Zone of a longitude, 1 to 60."""
    return F.least(F.greatest(F.floor((lon + 180) / 6) + 1, F.lit(1)), F.lit(60)).cast("int")


def utm_points(points: Column, zone: Column) -> Column:
    """Points (x: longitude, y: latitude) as easting and northing in metres
    (northern false origin). Each step of the series is an array of its own, so
    no part is computed twice."""
    def start(p: Column) -> Column:
        phi, lam = F.radians(p["y"]), F.radians(p["x"] - (zone * 6 - 183))
        t = F.sinh(F.atanh(F.sin(phi)) - E * F.atanh(E * F.sin(phi)))
        return F.struct(t.alias("t"), F.cos(lam).alias("c"), F.sin(lam).alias("s"))

    def angles(q: Column) -> Column:
        return F.struct(F.atan2(q["t"], q["c"]).alias("xi"), F.asinh(q["s"] / F.sqrt(q["t"] * q["t"] + q["c"] * q["c"])).alias("eta"))

    def series(q: Column) -> Column:
        east, north = q["eta"], q["xi"]
        for j, a in ((2, A1), (4, A2)):
            east = east + a * F.cos(j * q["xi"]) * F.sinh(j * q["eta"])
            north = north + a * F.sin(j * q["xi"]) * F.cosh(j * q["eta"])
        return F.struct((500000 + SCALE * RADIUS * east).alias("x"), (SCALE * RADIUS * north).alias("y"))

    return F.transform(F.transform(F.transform(points, start), angles), series)


def utm(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """Easting and northing of one point."""
    p = F.get(utm_points(F.array(F.struct(lon.alias("x"), lat.alias("y"))), zone), F.lit(0))
    return p["x"], p["y"]


def utm_area(rings: Column, zone: Column) -> Column:
    """Area in square metres in a UTM zone."""
    return area(rings, lambda ring: utm_points(ring, zone))


def frame_zone(df: DataFrame, box: str = "bbox") -> DataFrame:
    """One row ``zone``, for use as a scalar subquery: the UTM zone of the
    frame's middle longitude."""
    b = F.col(box)
    return df.agg(utm_zone((F.min(b["xmin"]) + F.max(b["xmax"])) / 2).alias("zone"))


def total_bounds(df: DataFrame, box: str = "bbox") -> DataFrame:
    b = F.col(box)
    return df.agg(F.min(b["xmin"]).alias("xmin"), F.min(b["ymin"]).alias("ymin"), F.max(b["xmax"]).alias("xmax"), F.max(b["ymax"]).alias("ymax"))


def overlaps(box: Column, xmin, ymin, xmax, ymax) -> Column:
    """Bounding boxes meet (edges included); nested fields push down to Parquet."""
    return (box["xmin"] <= xmax) & (box["xmax"] >= xmin) & (box["ymin"] <= ymax) & (box["ymax"] >= ymin)


def covers(outer: Column, xmin, ymin, xmax, ymax) -> Column:
    return (outer["xmin"] <= xmin) & (outer["ymin"] <= ymin) & (outer["xmax"] >= xmax) & (outer["ymax"] >= ymax)


def quadkey(x: Column, y: Column, zoom: int) -> Column:
    digits = [(F.shiftright(x, i).bitwiseAND(1) + 2 * F.shiftright(y, i).bitwiseAND(1)).cast("string") for i in range(zoom - 1, -1, -1)]
    return F.concat(*digits) if digits else F.lit("")


def tile_xy(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    n = float(1 << zoom)
    phi = F.radians(F.least(F.greatest(lat, F.lit(-85.051129)), F.lit(85.051129)))
    x = F.floor((lon + 180) / 360 * n)
    y = F.floor((1 - F.log(F.tan(phi) + 1 / F.cos(phi)) / F.lit(3.141592653589793)) / 2 * n)
    top = F.lit(int(n) - 1)
    return F.least(F.greatest(x, F.lit(0)), top).cast("int"), F.least(F.greatest(y, F.lit(0)), top).cast("int")


def quadkeys_for_bounds(bounds: DataFrame, zoom: int) -> DataFrame:
    """Distinct quadkeys that cover the boxes (xmin, ymin, xmax, ymax). The upper
    edges are pulled in by 1e-11 degrees, so a box that ends on a tile edge
    doesn't take the next tile."""
    eps = 1e-11
    x0, y1 = tile_xy(F.col("xmin"), F.col("ymin"), zoom)
    x1, y0 = tile_xy(F.greatest(F.col("xmin"), F.col("xmax") - eps), F.greatest(F.col("ymin"), F.col("ymax") - eps), zoom)
    tiles = bounds.select(F.explode(F.sequence(x0, x1)).alias("x"), y0.alias("y0"), y1.alias("y1")).select("x", F.explode(F.sequence("y0", "y1")).alias("y"))
    return tiles.select(quadkey(F.col("x"), F.col("y"), zoom).alias("quadkey")).distinct()


def boundary_tiles(bounds: DataFrame, step: float) -> DataFrame:
    """tile, xmin, ymin, xmax, ymax: a grid from the lower left corner, at least
    one tile a side, the last ones cut at the bounds; ``tile`` orders by column."""
    nx = F.greatest(F.ceil((F.col("xmax") - F.col("xmin")) / step), F.lit(1))
    ny = F.greatest(F.ceil((F.col("ymax") - F.col("ymin")) / step), F.lit(1))
    grid = bounds.select("*", ny.alias("ny"), F.explode(F.sequence(F.lit(0).cast("bigint"), nx - 1)).alias("ix"))
    grid = grid.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("ny") - 1)).alias("iy"))
    x0, y0 = F.col("xmin") + F.col("ix") * step, F.col("ymin") + F.col("iy") * step
    return grid.select(
        (F.col("ix") * F.col("ny") + F.col("iy")).alias("tile"), x0.alias("xmin"), y0.alias("ymin"),
        F.least(F.col("xmax"), x0 + step).alias("xmax"), F.least(F.col("ymax"), y0 + step).alias("ymax"),
    )


def geojson_rings(c: Column) -> Column:
    """Rings of a GeoJSON Polygon or MultiPolygon text."""
    kind = F.get_json_object(c, "$.type")
    coordinates = F.get_json_object(c, "$.coordinates")
    one = F.from_json(coordinates, "array<array<array<double>>>")
    many = F.flatten(F.from_json(coordinates, "array<array<array<array<double>>>>"))

    def points(rings: Column) -> Column:
        return F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))))

    return F.when(kind == "Polygon", points(one)).when(kind == "MultiPolygon", points(many))


# Arrow batches: whole columns as flat arrays, no row is touched alone unless its
# geometry has several rings


def _rings(blobs: pa.Array) -> wkb.Rings:
    return wkb.read(blobs.to_pylist())


@F.arrow_udf(RINGS)
def decode(blobs: pa.Array) -> pa.Array:
    r = _rings(blobs)
    points = pa.StructArray.from_arrays([pa.array(r.xy[:, 0]), pa.array(r.xy[:, 1])], ["x", "y"])
    rings = pa.ListArray.from_arrays(pa.array(r.start, pa.int32()), points)
    count = np.bincount(r.geom, minlength=r.n_geoms)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)], pa.int32()), rings, mask=pa.array(count == 0))


def rings_of(column: pa.Array) -> wkb.Rings:
    """Flat arrays of a column of rings."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rings = column.flatten()
    points = rings.flatten()
    count = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    size = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False)
    xy = np.stack([pc.struct_field(points, k).to_numpy(zero_copy_only=False) for k in (0, 1)], axis=1) if len(points) else np.empty((0, 2))
    return wkb.Rings(xy.astype(float), np.r_[0, np.cumsum(size)].astype(np.int64), np.repeat(np.arange(len(column)), count), len(column))


@F.arrow_udf(T.BinaryType())
def encode(rings: pa.Array) -> pa.Array:
    """WKB of rings: each outer ring with its holes, by nesting."""
    return pa.array(kernels.write(rings_of(rings)), pa.binary())


@F.arrow_udf(BOX)
def box_of(blobs: pa.Array) -> pa.Array:
    """Struct xmin, ymin, xmax, ymax; NULL without polygons."""
    b = _rings(blobs).bounds()
    return pa.StructArray.from_arrays([pa.array(b[:, k]) for k in range(4)], ["xmin", "ymin", "xmax", "ymax"], mask=pa.array(np.isnan(b[:, 0])))


@F.arrow_udf(_XY)
def representative_point(blobs: pa.Array) -> pa.Array:
    """A point inside: the middle of the widest span at the height half-way
    between the vertex heights around the centre; NULLs without area."""
    p = kernels.inner_points(_rings(blobs))
    none = np.isnan(p[:, 0])
    return pa.StructArray.from_arrays([pa.array(p[:, k], mask=none) for k in (0, 1)], ["x", "y"])


@F.arrow_udf(T.BinaryType())
def clean(blobs: pa.Array) -> pa.Array:
    """Polygonal part, closed, without repeated vertices; rings that cross
    themselves are rebuilt by the even-odd rule; nothing left gives NULL."""
    return pa.array(kernels.cleaned(_rings(blobs)), pa.binary())


@F.arrow_udf(T.BinaryType())
def snap(blobs: pa.Array, grid: pa.Array) -> pa.Array:
    """Vertices on a grid, collapsed rings dropped."""
    return pa.array(kernels.cleaned(kernels.snapped(_rings(blobs), grid.to_numpy(zero_copy_only=False))), pa.binary())


def clip(geometry: Column, boundary: bytes) -> Column:
    """The part of each geometry inside one boundary (a small driver-side blob)."""
    @F.arrow_udf(T.BinaryType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        clipper = overlay.Clipper((overlay.polygons([boundary]) or [None])[0])
        for blobs in batches:
            yield pa.array(kernels.clipped(_rings(blobs), clipper), pa.binary())

    return run(geometry)


def shared(a: Column, b: Column, zone: Column | int = 0) -> Column:
    """Struct area (that two WKB geometries share) and base (area of the first),
    in square metres of a UTM zone, or in units of the coordinates for zone 0."""
    return _shared(a, b, F.lit(zone) if isinstance(zone, int) else zone)


@F.arrow_udf(T.StructType([T.StructField("area", T.DoubleType()), T.StructField("base", T.DoubleType())]))
def _shared(a: pa.Array, b: pa.Array, zone: pa.Array) -> pa.Array:
    z = pc.fill_null(zone, 0).to_numpy(zero_copy_only=False).astype(float)
    left, right = (kernels.projected(kernels.closed(_rings(x)), z) for x in (a, b))
    return pa.StructArray.from_arrays([pa.array(kernels.shared_areas(left, right)), pa.array(kernels.areas(left))], ["area", "base"])


def crs_code(name: str) -> int:
    """0 for degrees, a UTM zone (negative: south), 100 for web Mercator."""
    code = int(re.sub(r"\D", "", name.rpartition(":")[2]) or 0)
    if code in (4326, 4269, 84, 0):
        return 0
    if code in (3857, 900913):
        return 100
    for base, sign in ((32600, 1), (26900, 1), (32700, -1)):
        if 1 <= code - base <= 60:
            return sign * (code - base)
    raise ValueError(f"reference system not known: {name}")


@F.arrow_udf(T.BinaryType())
def to_degrees(blobs: pa.Array, code: pa.Array) -> pa.Array:
    """Geometries of a UTM zone or of web Mercator in longitudes and latitudes."""
    r = kernels.closed(_rings(blobs))
    which = code.to_numpy(zero_copy_only=False)[r.vertex_geom()] if len(r.xy) else np.zeros(0)
    return pa.array(kernels.write(wkb.Rings(kernels.degrees(r.xy, which), r.start, r.geom, r.n_geoms)), pa.binary())
