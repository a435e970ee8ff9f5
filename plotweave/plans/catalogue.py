"""The reference's operators as named queries with SQL that stands on its own:
Spark runs generic geometry, the SQL closed forms of the lattice shapes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotweave.fixtures import blobs, rectangles, view, with_views
from plotweave.functions import geometry as g
from plotweave.functions import rules
from plotweave.functions import scalars as sc
from plotweave.functions.text import entity_key, label_key, strip_ws
from plotweave.operators import conflate as cf
from plotweave.operators.conflate import CITY
from plotweave.operators.spatial_join import boxes_meet
from plotweave.plans import profile
from plotweave.plans.pipeline import Inputs, build_cities
from plotweave.schema import OUTPUT
from plotweave.sources.attributes import standardize_inventory
from plotweave.sources.footprints import tile_urls
from plotweave.sources.parcels import standardize
from plotweave.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
CELL = 4.0


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = with_views(sql)
        return f

    return register


# scalars

_SLUG = "coalesce(nullif(lower(regexp_replace(regexp_replace({}, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')), ''), 'place')"


@query(f"""SELECT c_custkey, {_SLUG.format("concat_ws('_', nullif(c_name, ''), nullif(c_mktsegment, ''))")} AS slug FROM customer""")
def slugify_names(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "customer", "c_custkey", "c_name", "c_mktsegment").select("c_custkey", sc.slugify(F.col("c_name"), F.col("c_mktsegment")).alias("slug"))


@query("""SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'Texas' WHEN 1 THEN 'Texas' WHEN 2 THEN 'Illinois' WHEN 3 THEN trim(n_name)
  ELSE 'ZZ' END AS state FROM nation""")
def state_name_lookup(s: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey") % 5
    code = F.when(k == 0, "TX").when(k == 1, " tx ").when(k == 2, "Il").when(k == 3, F.col("n_name")).otherwise("ZZ")
    return table(s, d, "nation").select("n_nationkey", sc.state_name(code).alias("state"))


_NUM = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DIRTY = "CASE o_orderkey % 8 WHEN 0 THEN concat(' ', o_orderkey, ' ') WHEN 1 THEN '3d' WHEN 2 THEN '1_0' WHEN 3 THEN '1,000' WHEN 4 THEN '' WHEN 5 THEN 'nan' WHEN 6 THEN '-2.5e1' ELSE o_orderpriority END"


@query(f"""WITH t AS (SELECT o_orderkey, trim({_DIRTY}) AS v FROM orders)
SELECT o_orderkey, CASE WHEN regexp_matches(v, '{_NUM}') THEN TRY_CAST(v AS DOUBLE) END AS number FROM t""")
def safe_numeric(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select("o_orderkey", sc.safe_number(F.expr(_DIRTY)).alias("number"))


_HEIGHT = "CASE o_orderkey % 6 WHEN 0 THEN o_orderpriority WHEN 1 THEN concat(o_orderkey % 50, ' FT') WHEN 2 THEN concat(o_orderkey % 50, '.5 m') WHEN 3 THEN '1.2.3' WHEN 4 THEN '-5 ft' ELSE concat(o_orderkey % 9, '''') END"


@query(f"""WITH t AS (SELECT o_orderkey, lower(trim({_HEIGHT})) AS v FROM orders),
p AS (SELECT *, regexp_extract(v, '^([0-9.]+)\\s*(m|meter|meters|ft|feet|'')?', 1) AS n, regexp_extract(v, '^([0-9.]+)\\s*(m|meter|meters|ft|feet|'')?', 2) AS u FROM t)
SELECT o_orderkey, round(CASE WHEN regexp_matches(n, '{_NUM}') THEN TRY_CAST(n AS DOUBLE) * (CASE WHEN u IN ('ft', 'feet', '''') THEN 0.3048e0 ELSE 1e0 END) END, 9) AS height FROM p""")
def parse_height(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select("o_orderkey", F.round(sc.height_m(F.expr(_HEIGHT)), 9).alias("height"))


_PLACE = "concat(CASE n_nationkey % 3 WHEN 0 THEN 'City of ' WHEN 1 THEN 'St. ' ELSE '' END, n_name, ' village, ', r_name)"


@query(f"""SELECT n_nationkey, trim(regexp_replace(regexp_replace(split_part(lower({_PLACE}), ',', 1), '\\b(city|town|village|borough|municipality|cdp)\\b', '', 'g'), '[^a-z0-9]+', ' ', 'g')) AS place
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def place_name(s: SparkSession, d: str) -> DataFrame:
    n, r = table(s, d, "nation"), table(s, d, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", sc.place_name(F.expr(_PLACE)).alias("place"))  # region: five rows


# written by hand: the first line that fits decides
_TYPE_CASE = """CASE
  WHEN regexp_matches(lower({0}), 'condo') THEN 'condo'
  WHEN regexp_matches(lower({0}), 'apart|res3|multi.?family') THEN 'apartment'
  WHEN regexp_matches(lower({0}), '[hm]otel|res4') THEN 'hotel'
  WHEN regexp_matches(lower({0}), 'garage|parking') THEN 'garage'
  WHEN regexp_matches(lower({0}), 'barn|farm_auxiliary|agric|stable|greenhouse') THEN 'barn'
  WHEN regexp_matches(lower({0}), 'mobile|res2|manufactured') THEN 'mobile_home'
  WHEN regexp_matches(lower({0}), 'school|college|university|edu') THEN 'education'
  WHEN regexp_matches(lower({0}), 'hospital|clinic|medical|nursing|res6') THEN 'healthcare'
  WHEN regexp_matches(lower({0}), 'warehouse|wholesale|com2') THEN 'warehouse'
  WHEN regexp_matches(lower({0}), 'factory|ind') THEN 'industrial'
  WHEN regexp_matches(lower({0}), 'retail|office|com') THEN 'commercial'
  WHEN regexp_matches(lower({0}), 'church|civic|public|government|religious') THEN 'public'
  WHEN regexp_matches(lower({0}), 'house|detached|terrace|res') THEN 'residential'
  ELSE 'unknown' END"""
_SINGLE = "'house|detached|terrace|res[12]|mobile'"


@query(f"SELECT k, tag, {_TYPE_CASE.format('tag')} AS structure_type FROM fx_tags")
def structure_type(s: SparkSession, d: str) -> DataFrame:
    return view(s, d, "fx_tags").select("k", "tag", rules.structure_type(F.col("tag")).alias("structure_type"))


_RAW = "CASE WHEN trim(coalesce(tag, '')) <> '' THEN tag WHEN trim(coalesce(cls, '')) <> '' THEN cls WHEN trim(coalesce(occ, '')) <> '' THEN occ END"
_RAW_FROM = "CASE WHEN trim(coalesce(tag, '')) <> '' THEN 'osm' WHEN trim(coalesce(cls, '')) <> '' THEN 'overture_class' WHEN trim(coalesce(occ, '')) <> '' THEN 'nsi_occtype' END"


@query(f"""SELECT k, {_RAW} AS raw, {_RAW_FROM} AS raw_source, coalesce(h_osm, h_ovt, h_ms) AS height,
  CASE WHEN h_osm IS NOT NULL THEN 'osm' WHEN h_ovt IS NOT NULL THEN 'overture' WHEN h_ms IS NOT NULL THEN 'microsoft' END AS height_source FROM fx_tags""")
def coalesce_source(s: SparkSession, d: str) -> DataFrame:
    df = view(s, d, "fx_tags")
    raw, raw_from = sc.first_with_source(df, [("tag", "osm"), ("cls", "overture_class"), ("missing", "overture_subtype"), ("occ", "nsi_occtype")], "string")
    h, h_from = sc.first_with_source(df, [("h_osm", "osm"), ("h_ovt", "overture"), ("h_ms", "microsoft")], "double")
    return df.select("k", raw.alias("raw"), raw_from.alias("raw_source"), h.alias("height"), h_from.alias("height_source"))


_H = "coalesce(h_osm, h_ovt, h_ms)"
_EST = f"CASE WHEN {_H} IS NOT NULL THEN least(greatest(round_even({_H} / 3.05e0, 0), 1e0), 200e0) END"


@query(f"""SELECT k, {_EST} AS estimate, coalesce(s_osm, s_ovt, s_nsi, {_EST}) AS stories,
  CASE WHEN s_osm IS NOT NULL THEN 'osm' WHEN s_ovt IS NOT NULL THEN 'overture' WHEN s_nsi IS NOT NULL THEN 'nsi' WHEN {_H} IS NOT NULL THEN 'height_estimate' END AS stories_source
FROM fx_tags""")
def stories_estimate(s: SparkSession, d: str) -> DataFrame:
    df = view(s, d, "fx_tags").withColumn("estimate", sc.stories_from_height(F.coalesce("h_osm", "h_ovt", "h_ms")))
    v, f = sc.first_with_source(df, [("s_osm", "osm"), ("s_ovt", "overture"), ("s_nsi", "nsi"), ("estimate", "height_estimate")], "double")
    return df.select("k", "estimate", v.alias("stories"), f.alias("stories_source"))


_UNITS = "coalesce(u_osm, u_nsi)"
_INFER = f"({_UNITS} IS NULL AND {_TYPE_CASE.format('(' + _RAW + ')')} IN ('residential', 'mobile_home') AND regexp_matches(lower(coalesce({_RAW}, '')), {_SINGLE}))"


@query(f"""SELECT k, CASE WHEN {_INFER} THEN 1e0 ELSE {_UNITS} END AS units,
  CASE WHEN {_INFER} THEN 'inferred_single_family' WHEN u_osm IS NOT NULL THEN 'osm' WHEN u_nsi IS NOT NULL THEN 'nsi' END AS units_source FROM fx_tags""")
def units_inference(s: SparkSession, d: str) -> DataFrame:
    df = view(s, d, "fx_tags")
    raw, _ = sc.first_with_source(df, [("tag", "osm"), ("cls", "overture_class"), ("occ", "nsi_occtype")], "string")
    u, f = sc.first_with_source(df, [("u_osm", "osm"), ("u_nsi", "nsi")], "double")
    df = df.select("k", raw.alias("raw"), u.alias("u"), f.alias("f"))
    infer = rules.single_family(F.col("u"), rules.structure_type(F.col("raw")), F.col("raw"))
    return df.select("k", F.when(infer, 1.0).otherwise(F.col("u")).alias("units"), F.when(infer, "inferred_single_family").otherwise(F.col("f")).alias("units_source"))


@query("""WITH t AS (SELECT l_partkey, sum(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS am, sum(CASE WHEN l_linenumber = 2 THEN l_quantity END) AS pm,
  sum(CASE WHEN l_linenumber = 3 THEN l_quantity END) AS emp FROM lineitem GROUP BY l_partkey)
SELECT l_partkey, CASE WHEN am IS NULL AND pm IS NULL THEN NULL ELSE coalesce(am, 0) + coalesce(pm, 0) END AS both_times,
  greatest(am, pm, nullif(coalesce(emp, 0e0), 0e0)) AS occupants FROM t""")
def occupants(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "lineitem", "l_partkey", "l_linenumber", "l_quantity")
    part = {n: F.sum(F.when(F.col("l_linenumber") == k, F.col("l_quantity"))).alias(n) for n, k in (("am", 1), ("pm", 2), ("emp", 3))}
    t = t.groupBy("l_partkey").agg(*part.values())
    return t.select("l_partkey", sc.sum_either(F.col("am"), F.col("pm")).alias("both_times"),
                    rules.people(F.col("am"), F.col("pm"), F.col("emp"), F.lit(None).cast("double")).alias("occupants"))


# predicates and joins


@query("""SELECT sid, (x0 >= 8 AND y0 >= 4 AND x0 + w <= 64 AND y0 + h <= 24) AS covered FROM fx_base
WHERE x0 <= 64 AND x0 + w >= 8 AND y0 <= 24 AND y0 + h >= 4""")
def bbox_filter(s: SparkSession, d: str) -> DataFrame:
    df = rectangles(view(s, d, "fx_base"))
    area = F.struct(*[F.lit(v).alias(n) for n, v in (("xmin", 8.0), ("ymin", 4.0), ("xmax", 64.0), ("ymax", 24.0))])
    b = F.col("bbox")
    return df.where(g.overlaps(b, 8.0, 4.0, 64.0, 24.0)).select("sid", g.covers(area, b["xmin"], b["ymin"], b["xmax"], b["ymax"]).alias("covered"))


@query("SELECT pid, px, py FROM fx_pts WHERE px > 2 AND px < 42 AND py > 2 AND py < 22 AND NOT (px >= 12 AND px <= 22 AND py >= 6 AND py <= 12)")
def pip_within_boundary(s: SparkSession, d: str) -> DataFrame:
    def ring(x0, y0, x1, y1):
        return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))])

    boundary = F.array(ring(2, 2, 42, 22), ring(12, 6, 22, 12))  # with a hole
    return view(s, d, "fx_pts").where(g.within(F.col("px"), F.col("py"), boundary)).select("pid", "px", "py")


_IN_BASE = "{x} > b.x0 AND {x} < b.x0 + b.w AND {y} > b.y0 AND {y} < b.y0 + b.h AND NOT (b.lcut AND {x} >= b.x0 + 1 AND {y} >= b.y0 + 1)"


@query(f"""SELECT sid AS id, 'overture' AS source, NULL::DOUBLE AS height FROM fx_base
UNION ALL SELECT mid, 'microsoft', height FROM fx_extra e
WHERE NOT EXISTS (SELECT 1 FROM fx_base b WHERE {_IN_BASE.format(x="(e.x0 + 0.25e0)", y="(e.y0 + 0.25e0)")})""")
def footprint_merge(s: SparkSession, d: str) -> DataFrame:
    base = blobs(view(s, d, "fx_base")).select(F.col("sid").alias("StructureID"), F.lit("overture").alias("FootprintSource"), "geometry")
    extra = blobs(view(s, d, "fx_extra")).select(F.col("mid").alias("StructureID"), F.lit("microsoft").alias("FootprintSource"), F.col("height").alias("Height_MS"), "geometry")
    return cf.merge_footprints(base, extra, cell=CELL).select(F.col("StructureID").alias("id"), F.col("FootprintSource").alias("source"), F.col("Height_MS").alias("height"))


def _base(s: SparkSession, d: str) -> DataFrame:
    return blobs(view(s, d, "fx_base")).select(F.col("sid").alias("StructureID"), "geometry")


@query("""WITH m AS (SELECT p.sid, o.oid, o.st, row_number() OVER (PARTITION BY p.sid ORDER BY length(cast(o.oid AS VARCHAR)), o.oid) AS n
  FROM fx_base_pt p JOIN fx_osm o ON p.px > o.x0 AND p.px < o.x0 + o.w AND p.py > o.y0 AND p.py < o.y0 + o.h)
SELECT b.sid, cast(m.oid AS VARCHAR) AS osmid, m.st AS tag FROM fx_base b LEFT JOIN m ON m.sid = b.sid AND m.n = 1""")
def osm_attach(s: SparkSession, d: str) -> DataFrame:
    osm = blobs(view(s, d, "fx_osm")).select(F.col("oid").cast("string").alias("OSMID"), F.col("st").alias("OSM_StructureType"), "geometry")
    return cf.attach_osm(_base(s, d), osm, CELL).select(F.col("StructureID").alias("sid"), F.col("OSMID").alias("osmid"), F.col("OSM_StructureType").alias("tag"))


@query(f"""WITH j AS (SELECT b.sid, p.* FROM fx_base b JOIN fx_pts p ON {_IN_BASE.format(x="p.px", y="p.py")}),
a AS (SELECT sid, arg_min(cast(pid AS VARCHAR), (pid, q, e)) AS first_id, count(pid) AS records, median(q) AS stories, sum(n) AS units, sum(q) AS employed FROM j GROUP BY sid),
f AS (SELECT sid, f, row_number() OVER (PARTITION BY sid ORDER BY count(*) DESC, f) AS r FROM j GROUP BY sid, f)
SELECT b.sid, a.first_id, a.records, f.f AS occupancy, a.stories, cast(a.units AS DOUBLE) AS units, a.employed
FROM fx_base b LEFT JOIN a ON a.sid = b.sid LEFT JOIN f ON f.sid = b.sid AND f.r = 1""")
def inventory_attach(s: SparkSession, d: str) -> DataFrame:
    points = view(s, d, "fx_pts").select(
        F.col("pid").cast("string").alias("fd_id"), F.col("f").alias("occtype"), F.col("q").alias("num_story"), F.col("n").cast("double").alias("resunits"),
        F.col("q").alias("empnum"), F.struct("pid", "q", "e").alias("ordinal"), F.col("px").alias("x"), F.col("py").alias("y"),
    )
    out = cf.attach_inventory(_base(s, d), points, cell=CELL)
    return out.select(F.col("StructureID").alias("sid"), F.col("NSI_FD_ID").alias("first_id"), F.col("NSI_RecordCount").alias("records"), F.col("NSI_OccType").alias("occupancy"),
                      F.col("NSI_NumStory").alias("stories"), F.col("NSI_ResUnits").alias("units"), F.col("NSI_EmpNum").alias("employed"))


@query("""WITH c AS (SELECT sid, px AS cx, py AS cy FROM fx_base_pt),
m AS (SELECT c.sid, cast(o.oid AS VARCHAR) AS parcel, CASE WHEN o.oid % 7 = 0 THEN NULL ELSE o.w * o.h END AS area,
  row_number() OVER (PARTITION BY c.sid ORDER BY CASE WHEN o.oid % 7 = 0 THEN NULL ELSE o.w * o.h END NULLS LAST, cast(o.oid AS VARCHAR)) AS n
  FROM c JOIN fx_osm o ON c.cx > o.x0 AND c.cx < o.x0 + o.w AND c.cy > o.y0 AND c.cy < o.y0 + o.h)
SELECT c.sid, m.parcel, m.area, CASE WHEN m.parcel IS NOT NULL THEN 'representative_point_within' END AS method FROM c LEFT JOIN m ON m.sid = c.sid AND m.n = 1""")
def parcel_attach(s: SparkSession, d: str) -> DataFrame:
    base = _base(s, d)
    parcels = blobs(view(s, d, "fx_osm")).select(F.col("oid").cast("string").alias("ParcelID"), F.expr("CASE WHEN oid % 7 = 0 THEN NULL ELSE w * h END").alias("ParcelArea_m2"), F.lit("lots").alias("ParcelSource"), "geometry")
    out = cf.attach_parcels(base, parcels, cell=CELL)
    return out.select(F.col("StructureID").alias("sid"), F.col("ParcelID").alias("parcel"), F.col("ParcelArea_m2").alias("area"), F.col("ParcelMatchMethod").alias("method"))


# an L is its lower bar and the post on it
_SHARED = """WITH bars AS (
  SELECT sid, lcut, w * h AS whole, x0, y0, x0 + w AS x1, CASE WHEN lcut THEN y0 + 1 ELSE y0 + h END AS y1 FROM fx_base
  UNION ALL SELECT sid, lcut, w * h, x0, y0 + 1, x0 + 1, y0 + h FROM fx_base WHERE lcut),
size AS (SELECT sid, sum((x1 - x0) * (y1 - y0)) AS base FROM bars GROUP BY sid),
p AS (SELECT b.sid, o.oid, sum((least(b.x1, o.x0 + o.w) - greatest(b.x0, o.x0)) * (least(b.y1, o.y0 + o.h) - greatest(b.y0, o.y0))) AS area
  FROM bars b JOIN fx_osm o ON least(b.x1, o.x0 + o.w) > greatest(b.x0, o.x0) AND least(b.y1, o.y0 + o.h) > greatest(b.y0, o.y0) GROUP BY b.sid, o.oid)"""


@query(f"""{_SHARED}, r AS (SELECT p.*, base, row_number() OVER (PARTITION BY p.sid ORDER BY area DESC, oid) AS n FROM p JOIN size ON size.sid = p.sid WHERE area / base >= 0.05e0)
SELECT sid, oid, round(area, 9) AS overlap_area, round(area / base, 9) AS overlap_ratio FROM r WHERE n = 1""")
def best_overlap(s: SparkSession, d: str) -> DataFrame:
    base = blobs(view(s, d, "fx_base")).select("sid", "geometry")
    got = cf.best_overlap(base, blobs(view(s, d, "fx_osm")).select("oid", "geometry"), ["oid"], key="sid", least_ratio=0.05, cell=CELL, metres=False)
    return got.select("sid", "oid", F.round("overlap_area", 9).alias("overlap_area"), F.round("overlap_ratio", 9).alias("overlap_ratio"))


# the lattice near 41 degrees north: shares of an area survive the projection to
# a few millionths, so they are compared in steps no lattice share lies beside
@query(f"""{_SHARED} SELECT p.sid, cast(floor(max(area) / any_value(base) * 1000 + 0.37e0) AS BIGINT) AS share FROM p JOIN size ON size.sid = p.sid GROUP BY p.sid""")
def best_overlap_metres(s: SparkSession, d: str) -> DataFrame:
    small = ("-88d + x0 / 65536 AS x0", "41d + y0 / 65536 AS y0", "w / 65536 AS w", "h / 65536 AS h")
    base = blobs(view(s, d, "fx_base").selectExpr("sid", "lcut", "1 / 65536d AS notch", *small)).select("sid", "geometry")
    got = cf.best_overlap(base, blobs(view(s, d, "fx_osm").selectExpr("oid", *small)).select("oid", "geometry"), ["oid"], key="sid", cell=CELL / 65536)
    return got.select("sid", F.floor(F.col("overlap_ratio") * 1000 + 0.37).alias("share"))


@query("""SELECT b.sid, count(*) AS n FROM fx_base b JOIN fx_extra e ON least(b.x0 + b.w, e.x0 + e.w) > greatest(b.x0, e.x0)
  AND least(b.y0 + b.h, e.y0 + e.h) > greatest(b.y0, e.y0) GROUP BY b.sid""")
def box_pairs(s: SparkSession, d: str) -> DataFrame:
    pairs = boxes_meet(rectangles(view(s, d, "fx_base")).select("sid", "bbox"), rectangles(view(s, d, "fx_extra")).select("mid", "bbox"), CELL)
    return pairs.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))


# geometry


@query("SELECT sid, CASE WHEN lcut THEN w * h - (w - 1) * (h - 1) ELSE w * h END AS area FROM fx_base")
def polygon_area(s: SparkSession, d: str) -> DataFrame:
    return rectangles(view(s, d, "fx_base")).select("sid", g.area(F.col("rings")).alias("area"))


@query("SELECT min(x0) AS xmin, min(y0) AS ymin, max(x0 + w) AS xmax, max(y0 + h) AS ymax FROM fx_base")
def total_bounds(s: SparkSession, d: str) -> DataFrame:
    return g.total_bounds(rectangles(view(s, d, "fx_base")))


def _utm_sql(lon: str, lat: str) -> tuple[str, str]:
    """Easting and northing in zone 16 by the series in powers of the distance
    from the meridian (another way than the operator's; the two differ by a
    hundred-millionth, so areas are compared to the square metre)."""
    e2 = 0.0066943799901413165
    f, ep = f"radians({lat})", e2 / (1 - e2)
    n = f"(6378137e0 / sqrt(1e0 - {e2} * sin({f}) * sin({f})))"
    t, c = f"(tan({f}) * tan({f}))", f"({ep} * cos({f}) * cos({f}))"
    a = f"(cos({f}) * radians({lon} + 87e0))"
    arc = [1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256 - 175 * e2**4 / 16384, 3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024 + 420 * e2**4 / 16384, 15 * e2**2 / 256 + 45 * e2**3 / 1024 + 525 * e2**4 / 16384, 35 * e2**3 / 3072 + 175 * e2**4 / 12288]
    k = [f"{v:.20f}e0" for v in arc]
    m = f"(6378137e0 * ({k[0]} * {f} - {k[1]} * sin(2 * {f}) + {k[2]} * sin(4 * {f}) - {k[3]} * sin(6 * {f})))"
    east = f"0.9996e0 * {n} * ({a} + (1 - {t} + {c}) * pow({a}, 3) / 6 + (5 - 18 * {t} + {t} * {t} + 72 * {c} - 58 * {ep}) * pow({a}, 5) / 120)"
    north = f"0.9996e0 * ({m} + {n} * tan({f}) * (pow({a}, 2) / 2 + (5 - {t} + 9 * {c} + 4 * {c} * {c}) * pow({a}, 4) / 24 + (61 - 58 * {t} + {t} * {t} + 600 * {c} - 330 * {ep}) * pow({a}, 6) / 720))"
    return f"({east})", f"({north})"


def _utm_area_sql() -> str:
    u = "(1e0 / 4096)"
    corners = [("x0", "y0"), ("x0 + w", "y0"), ("x0 + w", f"y0 + {u}"), (f"x0 + {u}", f"y0 + {u}"), (f"x0 + {u}", "y0 + h"), ("x0", "y0 + h"), ("x0 + w", "y0 + h")]
    cte = ", ".join(f"{_utm_sql(x, y)[i]} AS {n}{k}" for k, (x, y) in enumerate(corners) for i, n in enumerate("en"))

    def shoelace(ks: tuple[int, ...]) -> str:
        return " + ".join(f"((e{a} - e0) * (n{b} - n0) - (e{b} - e0) * (n{a} - n0))" for a, b in zip(ks, (*ks[1:], ks[0])))

    return f"""WITH q AS (SELECT sid, lcut, -88e0 + x0 / 4096 AS x0, 41e0 + y0 / 4096 AS y0, w / 4096 AS w, h / 4096 AS h FROM fx_base),
c AS (SELECT sid, lcut, {cte} FROM q)
SELECT sid, round(CASE WHEN lcut THEN {shoelace((0, 1, 2, 3, 4, 5))} ELSE {shoelace((0, 1, 6, 5))} END / 2) AS area_m2 FROM c"""


@query(_utm_area_sql())
def utm_area(s: SparkSession, d: str) -> DataFrame:
    df = view(s, d, "fx_base").selectExpr("sid", "lcut", "-88d + x0 / 4096 AS x0", "41d + y0 / 4096 AS y0", "w / 4096 AS w", "h / 4096 AS h", "1 / 4096d AS notch")
    df = rectangles(df)
    return df.withColumn("zone", g.frame_zone(df).scalar()).select("sid", F.round(g.utm_area(F.col("rings"), F.col("zone"))).alias("area_m2"))


@query("""WITH b AS (SELECT r_regionkey, -90e0 + r_regionkey AS xmin, 40e0 AS ymin, -90e0 + r_regionkey + 0.3e0 AS xmax, 40.1e0 + r_regionkey * 0.05e0 AS ymax FROM region),
n AS (SELECT *, greatest(ceil((xmax - xmin) / 0.08e0), 1)::BIGINT AS nx, greatest(ceil((ymax - ymin) / 0.08e0), 1)::BIGINT AS ny FROM b),
t AS (SELECT *, unnest(range(nx * ny)) AS tile FROM n)
SELECT tile, round(xmin + (tile // ny) * 0.08e0, 9) AS xmin, round(ymin + (tile % ny) * 0.08e0, 9) AS ymin,
  round(least(xmax, xmin + (tile // ny) * 0.08e0 + 0.08e0), 9) AS xmax, round(least(ymax, ymin + (tile % ny) * 0.08e0 + 0.08e0), 9) AS ymax FROM t""")
def tile_grid(s: SparkSession, d: str) -> DataFrame:
    b = table(s, d, "region").selectExpr("-90d + r_regionkey AS xmin", "40d AS ymin", "-90d + r_regionkey + 0.3d AS xmax", "40.1d + r_regionkey * 0.05d AS ymax")
    return g.boundary_tiles(b, 0.08).select("tile", *[F.round(c, 9).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


def _quad_sql() -> str:
    n = 512
    x = f"cast(floor((({{0}}) + 180e0) / 360e0 * {n}) AS BIGINT)"
    y = f"cast(floor((1e0 - ln(tan(radians({{0}})) + 1e0 / cos(radians({{0}}))) / pi()) / 2e0 * {n}) AS BIGINT)"
    digits = " || ".join(f"cast(((x >> {i}) & 1) + 2 * ((y >> {i}) & 1) AS VARCHAR)" for i in range(8, -1, -1))
    return f"""WITH b AS (SELECT -90e0 + r_regionkey AS x0, 40e0 AS y0, -88.5e0 + r_regionkey AS x1, 41.3e0 AS y1 FROM region),
r AS (SELECT {x.format("x0")} AS xa, {x.format("x1")} AS xb, {y.format("y1")} AS ya, {y.format("y0")} AS yb FROM b),
c AS (SELECT ya, yb, unnest(range(xa, xb + 1)) AS x FROM r), t AS (SELECT x, unnest(range(ya, yb + 1)) AS y FROM c)
SELECT DISTINCT {digits} AS quadkey FROM t"""


@query(_quad_sql())
def quadkeys(s: SparkSession, d: str) -> DataFrame:
    b = table(s, d, "region").selectExpr("-90d + r_regionkey AS xmin", "40d AS ymin", "-88.5d + r_regionkey AS xmax", "41.3d AS ymax")
    return g.quadkeys_for_bounds(b, 9)


@query("""WITH t AS (SELECT event_id, CASE WHEN user_id % 11 = 0 THEN NULL ELSE user_id END AS fd_id, event_id % 7 AS tile FROM events)
SELECT event_id, fd_id, tile FROM (SELECT *, min(tile) OVER (PARTITION BY fd_id) AS first FROM t) WHERE fd_id IS NULL OR tile = first""")
def tile_dedup(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "events").selectExpr("event_id", "CASE WHEN user_id % 11 = 0 THEN NULL ELSE user_id END AS fd_id", "event_id % 7 AS tile")
    return cf.dedup_across_tiles(t)


@query("SELECT event_id, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_properties(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events", "event_id", "props").select("event_id", F.from_json("props", "k bigint").alias("p")).select("event_id", "p.*")


_LINKS = "SELECT c_custkey AS id, cast(1000000 + c_custkey AS VARCHAR) AS u, c_custkey % 512 AS x, 185 + c_custkey % 40 AS y FROM customer"
_KEY9 = " || ".join(f"cast(((x >> {i}) & 1) + 2 * ((y >> {i}) & 1) AS VARCHAR)" for i in range(8, -1, -1))


@query(f"""WITH l AS ({_LINKS}), k AS (SELECT {_KEY9} AS quadkey, CASE WHEN id % 5 = 0 THEN NULL ELSE 'u' || (id % 900) END AS url FROM l),
q AS ({_quad_sql().replace("WITH b AS", "SELECT * FROM (WITH b AS").rstrip() + ")"})
SELECT DISTINCT url AS "Url" FROM k WHERE url IS NOT NULL AND quadkey IN (SELECT quadkey FROM q)""")
def tile_links(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "customer", "c_custkey")
    x, y = (F.col("c_custkey") % 512).cast("int"), (185 + F.col("c_custkey") % 40).cast("int")
    links = c.select(g.quadkey(x, y, 9).alias("QuadKey"), F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("u"), (F.col("c_custkey") % 900).cast("string"))).alias("Url"))
    b = table(s, d, "region").selectExpr("-90d + r_regionkey AS xmin", "40d AS ymin", "-88.5d + r_regionkey AS xmax", "41.3d AS ymax")
    return tile_urls(links, b, 9)


# sources, unions, profiles


@query("""SELECT cast(o_orderkey AS VARCHAR) AS "ParcelID", o_orderpriority AS "ParcelAddress", o_orderstatus AS "ParcelLandUse", NULL::VARCHAR AS "ParcelZoning",
  NULL::VARCHAR AS "ParcelOwner", o_totalprice AS "ParcelAssessedValue", cast(year(o_orderdate) AS DOUBLE) AS "ParcelYearBuilt", 'county' AS "ParcelSource" FROM orders""")
def parcel_standardize(s: SparkSession, d: str) -> DataFrame:
    raw = table(s, d, "orders").select(
        F.col("o_orderkey").alias("APN"), F.col("o_orderpriority").alias("Situs Addr"), F.col("o_orderstatus").alias("UseCode"),
        F.col("o_totalprice").alias("TOTAL_VALUE"), F.year("o_orderdate").alias("built-year"), F.lit(None).cast("binary").alias("geometry"),
    )
    return standardize(raw, {"field_map": {"parcel_address": "situs_addr"}}, "county").drop("ParcelArea_m2", "geometry")


@query("SELECT c_custkey AS id, 'c' AS city, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, 's', NULL FROM supplier")
def union_cities(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("c").alias("city"), F.col("c_acctbal").alias("balance"))
    b = table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("s").alias("city"))
    return a.unionByName(b, allowMissingColumns=True)


# attached columns besides those of the fixture, in SQL both engines read
_ATTACHED = {
    "OvertureID": "CASE WHEN k % 3 = 0 THEN sid END", "MicrosoftID": "CASE WHEN k % 3 = 1 THEN concat('msft_', k) END", "OSMID": "CASE WHEN k % 5 = 1 THEN cast(k AS string) END",
    "NSI_FD_ID": "CASE WHEN k % 4 = 0 THEN concat('f', k) END", "NSI_RecordCount": "CASE WHEN k % 4 = 0 THEN cast(k % 7 AS bigint) END",
    "BuildingName_OSM": "CASE k % 7 WHEN 0 THEN 'Hall' WHEN 1 THEN ' ' END", "BuildingName_OVT": "CASE WHEN k % 3 = 0 THEN concat('B', k) END",
    "OvertureSubtype": "CASE WHEN k % 6 = 2 THEN 'civic' END", "NSI_DamageCategory": "CASE WHEN k % 2 = 0 THEN 'RES' END",
    "NSI_Pop2AM": "CASE WHEN k % 4 = 0 THEN cast(k % 6 AS double) END", "NSI_Pop2PM": "CASE WHEN k % 3 = 0 THEN cast(k % 5 AS double) END",
    "NSI_EmpNum": "CASE WHEN k % 5 = 0 THEN 3e0 END", "NSI_Students": "CASE WHEN k % 10 = 0 THEN 2e0 END", "CBFIPS": "concat('0100', k % 9)",
    "ParcelID": "CASE WHEN k % 2 = 0 THEN concat('P', k) END", "ParcelAddress": "concat(k, ' Oak St')", "ParcelLandUse": "CASE WHEN k % 2 = 0 THEN 'R1' END", "ParcelZoning": "'Z'",
    "ParcelOwner": "cast(NULL AS string)", "ParcelAssessedValue": "k * 10e0", "ParcelYearBuilt": "1900e0 + k % 100", "ParcelArea_m2": "k * 2e0",
    "ParcelSource": "CASE WHEN k % 2 = 0 THEN 'county' END", "ParcelMatchMethod": "CASE WHEN k % 2 = 0 THEN 'representative_point_within' END",
    "FootprintArea_m2": "k * 1.5e0", "Confidence_MS": "CASE WHEN k % 3 = 1 THEN (k % 11) / 8e0 END", "HasParts": "k % 2 = 0",
}


def _final(s: SparkSession, d: str) -> DataFrame:
    """The 44 columns over the tag fixture; two cities by key."""
    t = view(s, d, "fx_tags").select(
        F.col("sid").alias("StructureID"), F.col("k"), F.lit("overture").alias("FootprintSource"), F.col("tag").alias("OSM_StructureType"), F.col("cls").alias("OvertureClass"),
        F.col("occ").alias("NSI_OccType"), F.col("h_osm").alias("Height_OSM"), F.col("h_ovt").alias("Height_OVT"), F.col("h_ms").alias("Height_MS"),
        F.col("s_osm").alias("Stories_OSM"), F.col("s_ovt").alias("Stories_OVT"), F.col("s_nsi").alias("NSI_NumStory"), F.col("u_osm").alias("Units_OSM"), F.col("u_nsi").alias("NSI_ResUnits"),
        *[F.expr(e).alias(c) for c, e in _ATTACHED.items()],
    )
    city = F.when(F.col("k") % 2 == 0, "Corvane").otherwise("Tessaly")
    return rules.finalize(t, city, "IL", household=2.5, household_source="ACS 2024 B25010_001E")


_CLEAN = {c: f"trim(coalesce({c}, '')) <> ''" for c in ("tag", "cls", "occ", '"OvertureSubtype"', '"NSI_DamageCategory"', '"BuildingName_OSM"')}
_FINAL = f"""t AS (SELECT *, {_H} AS hm, {_EST} AS est, {", ".join(f'{e} AS "{c}"' for c, e in _ATTACHED.items())} FROM fx_tags),
r AS (SELECT *, CASE WHEN {_CLEAN["tag"]} THEN tag WHEN {_CLEAN["cls"]} THEN cls WHEN {_CLEAN['"OvertureSubtype"']} THEN "OvertureSubtype" WHEN {_CLEAN["occ"]} THEN occ
    WHEN {_CLEAN['"NSI_DamageCategory"']} THEN "NSI_DamageCategory" END AS raw,
  CASE WHEN {_CLEAN["tag"]} THEN 'osm' WHEN {_CLEAN["cls"]} THEN 'overture_class' WHEN {_CLEAN['"OvertureSubtype"']} THEN 'overture_subtype' WHEN {_CLEAN["occ"]} THEN 'nsi_occtype'
    WHEN {_CLEAN['"NSI_DamageCategory"']} THEN 'nsi_damage_category' END AS raw_from FROM t),
u AS (SELECT *, {_TYPE_CASE.format("coalesce(raw, '')")} AS typ FROM r),
v AS (SELECT *, (u_osm IS NULL AND u_nsi IS NULL AND typ IN ('residential', 'mobile_home') AND regexp_matches(lower(coalesce(raw, '')), {_SINGLE})) AS single,
  greatest("NSI_Pop2AM", "NSI_Pop2PM", nullif(coalesce("NSI_EmpNum", 0e0) + coalesce("NSI_Students", 0e0), 0e0)) AS ppl FROM u),
w AS (SELECT *, CASE WHEN single THEN 1e0 ELSE coalesce(u_osm, u_nsi) END AS num FROM v),
final AS (SELECT sid AS "StructureID", CASE WHEN k % 2 = 0 THEN 'Corvane' ELSE 'Tessaly' END AS "City", 'Illinois' AS "State", 'USA' AS "Country", 'overture' AS "FootprintSource",
  "OvertureID", "MicrosoftID", "OSMID", "NSI_FD_ID", "NSI_RecordCount", typ AS "StructureType", raw AS "StructureTypeRaw", raw_from AS "StructureTypeSource",
  CASE WHEN {_CLEAN['"BuildingName_OSM"']} THEN "BuildingName_OSM" ELSE "BuildingName_OVT" END AS "BuildingName",
  CASE WHEN {_CLEAN['"BuildingName_OSM"']} THEN 'osm' WHEN "BuildingName_OVT" IS NOT NULL THEN 'overture' END AS "BuildingNameSource",
  num AS "NumUnits", CASE WHEN single THEN 'inferred_single_family' WHEN u_osm IS NOT NULL THEN 'osm' WHEN u_nsi IS NOT NULL THEN 'nsi' END AS "NumUnitsSource",
  coalesce(s_osm, s_ovt, s_nsi, est) AS "NumStories",
  CASE WHEN s_osm IS NOT NULL THEN 'osm' WHEN s_ovt IS NOT NULL THEN 'overture' WHEN s_nsi IS NOT NULL THEN 'nsi' WHEN est IS NOT NULL THEN 'height_estimate' END AS "NumStoriesSource",
  hm AS "HeightM", CASE WHEN h_osm IS NOT NULL THEN 'osm' WHEN h_ovt IS NOT NULL THEN 'overture' WHEN h_ms IS NOT NULL THEN 'microsoft' END AS "HeightSource",
  coalesce(ppl, CASE WHEN typ IN ('residential', 'condo', 'apartment', 'mobile_home') THEN num * 2.5e0 END) AS "OccupantCount",
  CASE WHEN ppl IS NOT NULL THEN 'nsi_max_2am_2pm_emp_students' WHEN typ IN ('residential', 'condo', 'apartment', 'mobile_home') AND num IS NOT NULL THEN 'num_units_x_census_household_size' END AS "OccupantCountMethod",
  "NSI_Pop2AM", "NSI_Pop2PM", "NSI_EmpNum", "NSI_Students", "CBFIPS", "ParcelID", "ParcelAddress", "ParcelLandUse", "ParcelZoning", "ParcelOwner", "ParcelAssessedValue", "ParcelYearBuilt",
  "ParcelArea_m2", "ParcelSource", "ParcelMatchMethod", "FootprintArea_m2", "Confidence_MS", "HasParts", 2.5e0 AS "CensusAvgHouseholdSize", 'ACS 2024 B25010_001E' AS "CensusSource"
FROM w)"""
_CHECKED = [c for c in OUTPUT if c != "geometry"]  # the shapes have queries of their own


@query(f"WITH {_FINAL} SELECT * FROM final")
def finalize_structures(s: SparkSession, d: str) -> DataFrame:
    return _final(s, d).select(*_CHECKED)


@query(f"""WITH {_FINAL} {" UNION ALL ".join(
    f"(SELECT '{c}' AS column_name, {c!r} || '' AS c0, \"{c}\" AS label, count(*) AS n FROM final GROUP BY \"{c}\" ORDER BY n DESC, label NULLS LAST LIMIT 20)".replace(f", {c!r} || '' AS c0", "")
    for c in profile.SOURCES if c in _CHECKED)}""")
def profile_sources(s: SparkSession, d: str) -> DataFrame:
    return profile.label_counts(_final(s, d), [c for c in profile.SOURCES if c in _CHECKED])


@query(f"""WITH {_FINAL} SELECT DISTINCT "City", "State" FROM final""")
def distinct_places(s: SparkSession, d: str) -> DataFrame:
    return profile.places(_final(s, d))


@query("SELECT sid, px AS x, py AS y FROM fx_base_pt")
def rep_point(s: SparkSession, d: str) -> DataFrame:
    p = g.representative_point("geometry")
    return blobs(view(s, d, "fx_base")).select("sid", p.alias("p")).select("sid", "p.x", "p.y")


@query("""WITH c AS (SELECT oid, greatest(x0, 1e0) AS a, greatest(y0, 1e0) AS b, least(x0 + w, 30.5e0) AS c, least(y0 + h, 20.25e0) AS d FROM fx_osm)
SELECT oid, round((c - a) * (d - b), 9) AS area FROM c WHERE c > a AND d > b""")
def clip(s: SparkSession, d: str) -> DataFrame:
    from plotweave.functions import wkb

    window = wkb.polygon([(1.0, 1.0), (30.5, 1.0), (30.5, 20.25), (1.0, 20.25), (1.0, 1.0)])
    got = blobs(view(s, d, "fx_osm")).select("oid", g.clip(F.col("geometry"), window).alias("geometry")).where("geometry is not null")
    return got.select("oid", F.round(g.area(g.decode("geometry")), 9).alias("area"))


@query("SELECT sid, CASE WHEN lcut THEN w * h - (w - 1) * (h - 1) ELSE w * h END AS area FROM fx_base")
def clean_geometry(s: SparkSession, d: str) -> DataFrame:
    got = blobs(view(s, d, "fx_base")).select("sid", g.snap(g.clean("geometry"), F.lit(1e-9)).alias("geometry"))
    return got.select("sid", F.round(g.area(g.decode("geometry")), 6).alias("area"))


def delivered_inputs(s: SparkSession, d: str) -> tuple[Inputs, DataFrame]:
    """The delivered tables as pipeline inputs of many cities: one footprint per
    structure (the latest delivery), tags from the deliveries labelled so, all
    inventory points, all lots; and the cities, as the structures name them."""
    t = table(s, d, "structures").where("geometry is not null").withColumn("key", entity_key(F.col("StructureID"))).where("key is not null")
    t = t.withColumns({"City": F.initcap(strip_ws(F.col("City"))), "State": sc.state_name(F.col("State"))})
    t = t.withColumn(CITY, sc.slugify(F.col("City"), F.col("State")))
    latest = t.groupBy("key").agg(F.max(F.struct("observed_at", "record_id", "geometry", "OvertureID", "MicrosoftID", "HeightM", "Confidence_MS", "StructureTypeRaw", CITY, "City", "State")).alias("m")).select("key", "m.*")
    common = [F.col("key").alias("StructureID"), "OvertureID", "MicrosoftID", "geometry", CITY]
    first = latest.where("key not like 'msft%'").select(*common, F.lit("overture").alias("FootprintSource"), F.col("HeightM").alias("Height_OVT"), F.col("StructureTypeRaw").alias("OvertureClass"))
    second = latest.where("key like 'msft%'").select(*common, F.lit("microsoft").alias("FootprintSource"), F.col("HeightM").alias("Height_MS"), "Confidence_MS")
    tags = t.where(label_key(F.col("StructureTypeSource")) == "osm").select(
        F.concat(F.lit("w"), "record_id").alias("OSMID"), F.col("StructureTypeRaw").alias("OSM_StructureType"), F.col("NumStories").alias("Stories_OSM"),
        F.col("NumUnits").alias("Units_OSM"), "geometry", CITY)
    nsi = standardize_inventory(table(s, d, "nsi").withColumn("ordinal", F.col("row_id")))
    cities = latest.groupBy(CITY).agg(F.max("City").alias("City"), F.max("State").alias("State"))
    cities = cities.select("*", F.lit("USA").alias("Country"), F.lit(2.5).alias("household"), F.lit("ACS 2024 B25010_001E").alias("household_source"))
    return Inputs(first, second, tags, nsi, table(s, d, "parcels")), cities


@query()
def city_pipeline(s: SparkSession, d: str) -> DataFrame:
    """Stages 6-10 over the delivered tables, city by city in one plan, all 44
    columns."""
    inputs, cities = delivered_inputs(s, d)
    return build_cities(inputs, cities).drop("geometry", CITY)
