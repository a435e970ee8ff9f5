"""Readers, sinks and geometry conversions as named queries: inputs are written
to the shared folder, or made as text, from the fixture tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotweave.fixtures import blobs, rectangles, view
from plotweave.functions import geometry as g
from plotweave.functions import scalars as sc
from plotweave.functions import overlay, wkb
from plotweave.operators.conflate import with_rings
from plotweave.operators.spatial_join import points_in_polygons
from plotweave.plans import profile
from plotweave.plans.catalogue import _IN_BASE, _NUM, _utm_sql, query
from plotweave.session import shared_path
from plotweave.sources import attributes, footprints, sinks
from plotweave.sources.parcels import standardize
from plotweave.sources.tables import table

# the lattice as a place near 41 degrees north
_DEGREES = ("-88d + x0 / 4096 AS x0", "41d + y0 / 4096 AS y0", "w / 4096 AS w", "h / 4096 AS h")


@query("""SELECT sid AS id, height, floors, kind FROM (SELECT *, CASE WHEN k % 4 = 0 THEN NULL ELSE k % 9 + 0.5e0 END AS height, CASE WHEN k % 5 = 0 THEN NULL ELSE cast(k % 6 AS DOUBLE) END AS floors,
  CASE WHEN k % 3 = 0 THEN 'house' END AS kind FROM fx_base) WHERE x0 <= 60 AND x0 + w >= 9 AND y0 <= 40 AND y0 + h >= 5""")
def overture_read(s: SparkSession, d: str) -> DataFrame:
    """A primary layer with a box column: the box filter reaches the scan."""
    base = view(s, d, "fx_base")
    layer = blobs(base).select(
        F.col("sid").alias("id"), F.when(F.col("k") % 4 != 0, F.col("k") % 9 + 0.5).alias("height"), F.when(F.col("k") % 5 != 0, (F.col("k") % 6).cast("string")).alias("num_floors"),
        F.when(F.col("k") % 3 == 0, "house").alias("class"), F.struct(F.col("x0").alias("xmin"), F.col("y0").alias("ymin"), (F.col("x0") + F.col("w")).alias("xmax"), (F.col("y0") + F.col("h")).alias("ymax")).alias("bbox"),
        "geometry")
    path = f"{shared_path(s, 'overture')}.parquet"
    layer.write.parquet(path)
    got = footprints.read_overture(s, path, (9.0, 5.0, 60.0, 40.0))
    return got.select(F.col("StructureID").alias("id"), F.col("Height_OVT").alias("height"), F.col("Stories_OVT").alias("floors"), F.col("OvertureClass").alias("kind"))


# GeoJSON texts both engines write alike: coordinates are multiples of 1/8
_RING = "concat('[[', x0, ',', y0, '],[', x0 + w, ',', y0, '],[', x0 + w, ',', y0 + h, '],[', x0, ',', y0 + h, '],[', x0, ',', y0, ']]')"


def _features(df: DataFrame, properties: str) -> DataFrame:
    ring = F.expr(_RING)
    shape = F.concat(F.lit('{"type":"Polygon","coordinates":['), ring, F.lit("]}"))
    return df.withColumns({"shape": shape, "value": F.concat(F.lit('{"type":"Feature","properties":'), F.expr(properties), F.lit(',"geometry":'), shape, F.lit("}"))})


@query("SELECT mid, w * h AS area FROM fx_extra")
def geojson_shapes(s: SparkSession, d: str) -> DataFrame:
    return _features(view(s, d, "fx_extra"), "'{}'").select("mid", g.area(g.geojson_rings(F.col("shape"))).alias("area"))


@query("""SELECT height, round(sum(w * h), 6) AS area, count(*) AS n FROM fx_extra WHERE x0 <= 100 AND x0 + w >= 20 AND y0 <= 60 AND y0 + h >= 8 GROUP BY height""")
def microsoft_tile(s: SparkSession, d: str) -> DataFrame:
    """Feature lines to the footprint schema; -1 is unknown; sliced by a box."""
    lines = _features(view(s, d, "fx_extra"), """concat('{"height":', coalesce(height, -1.0), ',"confidence":-1}')""").select("value")
    path = shared_path(s, "tile")
    lines.write.text(path)
    raw = footprints.read_json_lines(s, path)
    got = footprints.standardize_microsoft(raw.where(g.overlaps(g.box_of("geometry"), *map(F.lit, (20.0, 8.0, 100.0, 60.0)))), "corvane")
    shaped = got.select(F.col("Height_MS").alias("height"), g.area(g.decode("geometry")).alias("a"))
    return shaped.groupBy("height").agg(F.round(F.sum("a"), 6).alias("area"), F.count(F.lit(1)).alias("n"))


_TAGS = {
    "building": "CASE o_orderkey % 4 WHEN 0 THEN 'house' WHEN 1 THEN o_orderstatus END", "levels": "CASE o_orderkey % 3 WHEN 0 THEN '2' WHEN 1 THEN 'two' WHEN 2 THEN ' 3.5 ' END",
    "height": "CASE o_orderkey % 5 WHEN 0 THEN '12 m' WHEN 1 THEN '40 ft' WHEN 2 THEN 'tall' WHEN 3 THEN '7.25' END",
    "flats": "CASE o_orderkey % 6 WHEN 0 THEN '8' WHEN 1 THEN 'x' END", "units": "CASE o_orderkey % 2 WHEN 1 THEN '4' END", "name": "CASE o_orderkey % 7 WHEN 0 THEN 'Hall' END",
}


@query(f"""WITH t AS (SELECT o_orderkey, {", ".join(f"{e} AS {c}" for c, e in _TAGS.items())} FROM orders)
SELECT cast(o_orderkey AS VARCHAR) AS osmid, building AS kind, CASE WHEN regexp_matches(trim(levels), '{_NUM}') THEN TRY_CAST(trim(levels) AS DOUBLE) END AS levels,
  CASE o_orderkey % 5 WHEN 0 THEN 12e0 WHEN 1 THEN 12.192e0 WHEN 3 THEN 7.25e0 END AS height, coalesce(TRY_CAST(flats AS DOUBLE), TRY_CAST(units AS DOUBLE)) AS units, name FROM t""")
def osm_standardize(s: SparkSession, d: str) -> DataFrame:
    """Tags to the tag schema; the first unit tag that is a number counts."""
    raw = table(s, d, "orders", "o_orderkey", "o_orderstatus").select("o_orderkey", *[F.expr(e).alias(c) for c, e in _TAGS.items()])
    raw = raw.select(F.col("o_orderkey").alias("osmid"), "building", F.col("levels").alias("building:levels"), "height", F.col("flats").alias("building:flats"), "units", "name",
                     F.lit(wkb.polygon([(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)])).alias("geometry"))
    got = attributes.standardize_osm(raw)
    return got.select(F.col("OSMID").alias("osmid"), F.col("OSM_StructureType").alias("kind"), F.col("Stories_OSM").alias("levels"), F.round("Height_OSM", 9).alias("height"),
                      F.col("Units_OSM").alias("units"), F.col("BuildingName_OSM").alias("name"))


@query("""SELECT event_id, cast(user_id AS VARCHAR) AS fd_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS stories, event_id % 64 + 0.5e0 AS x, event_id % 32 - 0.25e0 AS y
FROM (SELECT *, event_id % 5 AS tile, min(event_id % 5) OVER (PARTITION BY user_id) AS first FROM events)
WHERE tile = first AND event_id % 4 <> 3 AND event_id % 64 + 0.5e0 < 50 AND event_id % 32 - 0.25e0 > 2""")
def inventory_standardize(s: SparkSession, d: str) -> DataFrame:
    """Tiles of point features: properties as JSON, points as JSON or text, ids of
    earlier tiles dropped, only points inside the boundary."""
    t = table(s, d, "events", "event_id", "user_id", "value").withColumns({"px": F.col("event_id") % 64 + 0.5, "py": F.col("event_id") % 32 - 0.25})
    number = F.when(F.col("event_id") % 3 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    json = F.to_json(F.struct(F.lit("Point").alias("type"), F.array("px", "py").alias("coordinates")))
    shape = F.when(F.col("event_id") % 4 == 3, "POINT EMPTY").when(F.col("event_id") % 4 == 1, F.format_string("POINT (%s %s)", "px", "py")).otherwise(json)
    raw = t.select((F.col("event_id") % 5).alias("tile"), F.to_json(F.struct(F.col("user_id").alias("fd_id"), number.alias("num_story"))).alias("properties"), shape.alias("geometry"), F.col("event_id").alias("ordinal"))
    ring = g.rectangle(F.lit(-1.0), F.lit(2.0), F.lit(50.0), F.lit(99.0))
    got = attributes.standardize_inventory(raw, ring)
    return got.select(F.col("ordinal").alias("event_id"), "fd_id", F.col("num_story").alias("stories"), "x", "y")


@query("""WITH r AS (SELECT 2024 - n_regionkey % 3 AS y, n_nationkey AS ordinal, CASE WHEN n_nationkey % 4 = 0 THEN NULL WHEN n_nationkey % 4 = 1 THEN -1e0 ELSE 2 + n_nationkey / 10e0 END AS v
  FROM nation WHERE length(n_name) > 5)
SELECT v AS size, 'ACS ' || y || ' B25010_001E' AS label FROM r WHERE v > 0 ORDER BY y DESC, ordinal LIMIT 1""")
def household_size(s: SparkSession, d: str) -> DataFrame:
    """The latest year with a positive size of the place."""
    n = table(s, d, "nation")
    v = F.when(F.col("n_nationkey") % 4 == 0, None).when(F.col("n_nationkey") % 4 == 1, "-1").otherwise((2 + F.col("n_nationkey") / 10).cast("string"))
    rows = n.select((2024 - F.col("n_regionkey") % 3).alias("year"), F.col("n_nationkey").alias("ordinal"), F.when(F.length("n_name") > 5, "Corvane city, Illinois").otherwise("Other town").alias("NAME"), v.alias("value"))
    size, label = attributes.household_size(rows, "Corvane")
    return s.createDataFrame([(size, label)], "size double, label string").where("label is not null")


@query(f"""WITH q AS (SELECT oid, -88e0 + x0 / 4096 AS x0, 41e0 + y0 / 4096 AS y0, w / 4096 AS w, h / 4096 AS h FROM fx_osm),
c AS (SELECT oid, {", ".join(f"{_utm_sql(x, y)[i]} AS {n}{k}" for k, (x, y) in enumerate((("x0", "y0"), ("x0 + w", "y0"), ("x0 + w", "y0 + h"), ("x0", "y0 + h"))) for i, n in enumerate("en"))} FROM q)
SELECT oid, round(abs((e2 - e0) * (n3 - n1) - (e3 - e1) * (n2 - n0)) / 2) AS area_m2 FROM c""")
def parcel_area(s: SparkSession, d: str) -> DataFrame:
    """Areas of a standardised parcel layer, in the UTM zone of its frame."""
    lots = blobs(view(s, d, "fx_osm").selectExpr("oid", *_DEGREES)).select(F.col("oid").alias("PIN"), "geometry")
    got = standardize(lots, {}, "lots")
    return got.select(F.col("ParcelID").cast("bigint").alias("oid"), F.round("ParcelArea_m2").alias("area_m2"))


@query("SELECT sid, round(x0 / 4096, 9) AS x, round(y0 / 4096, 9) AS y, round((x0 + w) / 4096, 9) AS x1, round((y0 + h) / 4096, 9) AS y1 FROM fx_base")
def reprojection(s: SparkSession, d: str) -> DataFrame:
    """A layer in UTM metres comes back in degrees."""
    rings = rectangles(view(s, d, "fx_base").selectExpr("sid", *_DEGREES))
    metres = g.encode(F.transform("rings", lambda r: g.utm_points(r, F.lit(16))))
    box = rings.select("sid", g.box_of(g.to_degrees(metres, F.lit(g.crs_code("EPSG:32616")))).alias("b"))
    return box.select("sid", F.round(F.col("b.xmin") + 88, 9).alias("x"), F.round(F.col("b.ymin") - 41, 9).alias("y"), F.round(F.col("b.xmax") + 88, 9).alias("x1"), F.round(F.col("b.ymax") - 41, 9).alias("y1"))


@query("SELECT oid, st, w * h AS area FROM fx_osm WHERE x0 <= 80 AND x0 + w >= 4 AND y0 <= 50 AND y0 + h >= 3")
def vector_read(s: SparkSession, d: str) -> DataFrame:
    """A vector file with a feature a line, cut by a box."""
    path = f"{shared_path(s, 'lots')}.geojsonl"
    _features(view(s, d, "fx_osm"), """concat('{"oid":', oid, ',"st":"', st, '"}')""").select("value").write.text(path)
    got = attributes.read_vector(s, path, (4.0, 3.0, 80.0, 50.0))
    return got.select(F.col("oid").cast("bigint").alias("oid"), "st", g.area(g.decode("geometry")).alias("area"))


@query("SELECT k % 3 AS part, sid, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM fx_base WHERE k % 3 < 2")
def geoparquet_tables(s: SparkSession, d: str) -> DataFrame:
    """Tables written by part as GeoParquet, read again together."""
    rows = blobs(view(s, d, "fx_base")).where("k % 3 < 2").select((F.col("k") % 3).alias("part"), (F.col("k") % 3).cast("string").alias("city_slug"), "sid", "geometry")
    where = shared_path(s, "geo")
    folders = {str(p): f"{where}/{p}_structures.parquet" for p in range(2)}
    sinks.write_geoparquet(rows, folders, "city_slug")
    box = s.read.parquet(*folders.values()).select("part", "sid", g.box_of("geometry").alias("b"))
    return box.select("part", "sid", F.col("b.xmin").alias("x0"), F.col("b.ymin").alias("y0"), F.col("b.xmax").alias("x1"), F.col("b.ymax").alias("y1"))


# a frame with a hole: the tiles of a grid that touch what is left of it
@query("""WITH t AS (SELECT n_nationkey % 5 * 10 + c AS ix, r AS iy FROM nation, (SELECT unnest(range(10)) AS c), (SELECT unnest(range(20)) AS r) WHERE n_nationkey < 5),
b AS (SELECT ix * 20 + iy AS tile, 1 + ix * 2e0 AS x0, 1 + iy * 2e0 AS y0 FROM t WHERE ix < 20)
SELECT tile FROM b WHERE NOT (x0 >= 10 AND x0 + 2 <= 31 AND y0 >= 10 AND y0 + 2 <= 30)""")
def tiles_on_boundary(s: SparkSession, d: str) -> DataFrame:
    def ring(x0, y0, x1, y1):
        return np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)], dtype=float)

    boundary = overlay.to_wkb([ring(1, 1, 41, 41), ring(10, 10, 31, 30)])
    box = table(s, d, "region").where("r_regionkey = 0").selectExpr("1d AS xmin", "1d AS ymin", "41d AS xmax", "41d AS ymax")
    shape = g.encode(g.rectangle(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")))
    return g.boundary_tiles(box, 2.0).withColumn("part", g.clip(shape, boundary)).where("part is not null").select("tile")


@query("SELECT count(*) AS n FROM fx_tags")
def row_count(s: SparkSession, d: str) -> DataFrame:
    return profile.row_count(view(s, d, "fx_tags"))


@query("""SELECT c_custkey, nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END, '') AS name, coalesce(CASE WHEN c_custkey % 4 = 0 THEN 3e0 END, CASE WHEN c_custkey % 5 = 0 THEN 7e0 END) AS units FROM customer""")
def nested_fields(s: SparkSession, d: str) -> DataFrame:
    """Members of structs, empty ones missing; the first tag that is a number."""
    c = F.col("c_custkey")
    t = table(s, d, "customer", "c_custkey", "c_name").select(
        "c_custkey", F.struct(F.when(c % 3 == 0, "").otherwise(F.col("c_name")).alias("primary")).alias("names"),
        F.when(c % 4 == 0, "3").otherwise("none").alias("building:flats"), F.when(c % 5 == 0, " 7 ").alias("units"))
    return t.select("c_custkey", sc.nested_text(F.col("names.primary")).alias("name"), sc.first_number(t, attributes.UNIT_TAGS).alias("units"))


@query(f"""WITH n AS (SELECT e.mid, count(*) AS c FROM fx_extra e JOIN fx_base b ON {_IN_BASE.format(x="(e.x0 + 0.25e0)", y="(e.y0 + 0.25e0)")} GROUP BY e.mid)
SELECT mid, coalesce(c, 0) AS holders FROM fx_extra LEFT JOIN n USING (mid)""")
def point_lookup(s: SparkSession, d: str) -> DataFrame:
    """How many polygons hold each point, none included."""
    points = view(s, d, "fx_extra").selectExpr("mid", "x0 + 0.25d AS x", "y0 + 0.25d AS y")
    pairs = points_in_polygons(points, with_rings(blobs(view(s, d, "fx_base")).select("sid", "geometry")), 4.0, narrow_points=True)
    return points.select("mid").join(pairs.select("mid", "sid"), "mid", "left").groupBy("mid").agg(F.count("sid").alias("holders"))
