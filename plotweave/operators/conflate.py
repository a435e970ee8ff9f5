"""Conflation of footprint sources and attribute tables.

Frames carry ``geometry`` (WKB) at rest. ``prepared`` adds rings, box and the
representative point once; the joins move only narrow (id, point) or (id, rings)
projections and come back to the base by its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotweave.functions import geometry as g
from plotweave.functions.scalars import sum_either
from plotweave.functions.text import real
from plotweave.operators.spatial_join import boxes_meet, points_in_polygons
from plotweave.session import cut
from plotweave.schema import FOOTPRINT, NSI, NSI_ATTACHED, OSM, PARCEL, PARCEL_ATTACHED, ensure_columns, project

#: Grid cell in degrees, near the extent of a building with its lot.
CELL_DEG = 0.0005
#: Tables of several cities carry this column; rows of different cities don't meet.
CITY = "city_slug"


def city_of(*tables: DataFrame) -> list[str]:
    return [CITY] if all(CITY in t.columns for t in tables) else []


def whole(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """The columns of a schema, and the city's where there is one."""
    return project(df, schema | {c: "string" for c in city_of(df)})


def with_rings(df: DataFrame) -> DataFrame:
    """Rings and box in place of the geometry, decoded once: the grid levels are
    looked up before the join, so the table is cut here."""
    return cut(df.withColumns({"rings": g.decode("geometry"), "bbox": g.box_of("geometry")}).drop("geometry"))


def inner_points(df: DataFrame, key: str = "StructureID") -> DataFrame:
    """key, x, y of each geometry's representative point."""
    p = g.representative_point("geometry")
    return df.select(key, *city_of(df), p.alias("p")).select(key, *city_of(df), F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def shapes_of(df: DataFrame, key: str = "StructureID") -> DataFrame:
    """key, rings, bbox and representative point (x, y): what the joins need,
    decoded once."""
    p = g.representative_point("geometry")
    out = df.select(key, *city_of(df), g.decode("geometry").alias("rings"), g.box_of("geometry").alias("bbox"), p.alias("p"))
    return out.select(key, *city_of(df), "rings", "bbox", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in a total order, by a combinable ``min``: a key
    that holds many rows is reduced before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    ordered = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("_row"))
    return df.groupBy(*keys).agg(F.min(ordered).alias("_m")).select(*keys, F.col("_m._row.*"))


def nulls_last(c: Column) -> Column:
    """Sort key: NULLs behind every number."""
    return F.coalesce(real(c), F.lit(float("inf")))


def coalesce_onto(base: DataFrame, attributes: DataFrame, key: str, schema: dict[str, str]) -> DataFrame:
    """Left join; a joined value wins, the base's own value is the fallback."""
    base = ensure_columns(base, schema)
    new = attributes.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in schema])
    joined = base.join(new, base[key] == new["_key"], "left")
    return joined.select(*[
        F.coalesce(F.col(f"_{c}").cast(schema[c]), F.col(c).cast(schema[c])).alias(c) if c in schema else F.col(c) for c in base.columns
    ])


def merge_footprints(overture: DataFrame, microsoft: DataFrame, add_unmatched: bool = True, cell: float = CELL_DEG) -> DataFrame:
    """All first-source rows and those second-source rows whose
    representative point lies in none of them. Without ``add_unmatched`` only
    places (cities) without a first source take the second, and take all of it."""
    overture, microsoft = whole(overture, FOOTPRINT), whole(microsoft, FOOTPRINT)
    by = city_of(overture, microsoft)
    if not add_unmatched:
        if by:
            return overture.unionByName(microsoft.join(overture.select(*by).distinct(), by, "left_anti"))
        return microsoft if overture.isEmpty() else overture
    polygons = with_rings(overture.select("geometry", *by))
    covered = points_in_polygons(inner_points(microsoft.select("StructureID", "geometry", *by)), polygons, cell, by=by, narrow_points=True).select("StructureID", *by).distinct()
    return overture.unionByName(microsoft.join(covered, ["StructureID", *by], "left_anti"))


def attach_osm(base: DataFrame, osm: DataFrame, cell: float = CELL_DEG, shapes: DataFrame | None = None) -> DataFrame:
    """Attributes of the first tag polygon that holds the base's
    representative point; ties go to the lowest OSMID. ``shapes`` (of
    ``shapes_of``) spares decoding a base that has been attached to before."""
    attributes = {c: t for c, t in OSM.items() if c != "geometry"}
    by = city_of(base, osm)
    polygons = with_rings(whole(osm, OSM))
    points = (inner_points(base) if shapes is None else shapes).select("StructureID", *by, "x", "y")
    pairs = points_in_polygons(points, polygons.drop(*[c for c in city_of(polygons) if not by]), cell, by=by, narrow_points=True)
    first = first_per_key(pairs.select("StructureID", *attributes), "StructureID", [F.col("OSMID").isNull(), F.length("OSMID"), F.col("OSMID")])
    return coalesce_onto(base, first, "StructureID", attributes)


def aggregate_inventory(joined: DataFrame, key: str = "StructureID") -> DataFrame:
    """A1: the 13 grouped outputs. ``ordinal`` decides the first id."""
    def total(c: str) -> Column:
        return F.sum(real(F.col(c)))

    am = sum_either(real(F.col("pop2amu65")), real(F.col("pop2amo65")))
    pm = sum_either(real(F.col("pop2pmu65")), real(F.col("pop2pmo65")))
    return joined.groupBy(key).agg(
        F.min_by("fd_id", F.when(F.col("fd_id").isNotNull(), F.col("ordinal"))).alias("NSI_FD_ID"),
        F.count("fd_id").alias("NSI_RecordCount"),
        F.mode("occtype", True).alias("NSI_OccType"), F.mode("st_damcat", True).alias("NSI_DamageCategory"), F.mode("cbfips", True).alias("CBFIPS"),
        F.median(real(F.col("num_story"))).alias("NSI_NumStory"),
        total("resunits").alias("NSI_ResUnits"), total("empnum").alias("NSI_EmpNum"), total("students").alias("NSI_Students"), total("sqft").alias("NSI_Sqft"),
        F.sum(am).alias("NSI_Pop2AM"), F.sum(pm).alias("NSI_Pop2PM"), total("val_struct").alias("NSI_ValStruct"),
    )


def attach_inventory(base: DataFrame, nsi: DataFrame, cell: float = CELL_DEG, shapes: DataFrame | None = None) -> DataFrame:
    """Inventory points (x, y) in base polygons, reduced per structure; a
    point in overlapping footprints counts in each."""
    points = ensure_columns(nsi, NSI)
    if "ordinal" not in points.columns:
        points = points.withColumn("ordinal", F.struct(F.length("fd_id"), F.col("fd_id")))
    by = city_of(base, points)
    polygons = (with_rings(base.select("StructureID", "geometry", *by)) if shapes is None else shapes).select("StructureID", *by, "rings", "bbox")
    joined = points_in_polygons(points.select(*NSI, *by, "ordinal", "x", "y"), polygons, cell, by=by)
    return coalesce_onto(base, aggregate_inventory(joined.select("StructureID", *NSI, "ordinal")), "StructureID", NSI_ATTACHED)


def attach_parcels(base: DataFrame, parcels: DataFrame, cell: float = CELL_DEG, shapes: DataFrame | None = None) -> DataFrame:
    """The smallest parcel around the representative point, areas unknown
    last, then the lower ParcelID."""
    by = city_of(base, parcels)
    polygons = with_rings(whole(parcels, PARCEL))
    points = (inner_points(base) if shapes is None else shapes).select("StructureID", *by, "x", "y")
    pairs = points_in_polygons(points, polygons.drop(*[c for c in city_of(polygons) if not by]), cell, by=by, narrow_points=True)
    columns = [c for c in PARCEL if c != "geometry"]
    first = first_per_key(pairs.select("StructureID", *columns), "StructureID", [nulls_last(F.col("ParcelArea_m2")), F.col("ParcelID").isNull(), F.col("ParcelID")])
    first = first.withColumn("ParcelMatchMethod", F.when(F.col("ParcelSource").isNotNull(), "representative_point_within"))
    return coalesce_onto(base, first, "StructureID", PARCEL_ATTACHED)


def best_overlap(base: DataFrame, candidates: DataFrame, columns: Sequence[str], key: str = "StructureID", least_ratio: float = 0.0,
                 cell: float = CELL_DEG, candidate_key: str | None = None, metres: bool = True) -> DataFrame:
    """Per base polygon the candidate that shares the most area with it:
    key, columns, overlap_area, overlap_ratio (of the base's area; a base without
    area has ratio 0). Areas are square metres in the UTM zone of the base's
    middle, or in units of the coordinates without ``metres``. Ties go to the
    lower candidate key."""
    keep = list(dict.fromkeys([*columns, candidate_key or columns[0]]))
    by = city_of(base, candidates)
    a = cut(base.select(key, *by, g.box_of("geometry").alias("bbox"), F.col("geometry").alias("l_geometry")))
    b = cut(candidates.select(*keep, *by, g.box_of("geometry").alias("bbox"), F.col("geometry").alias("r_geometry")))
    zone = g.frame_zone(a).scalar() if metres else F.lit(0)
    pairs = boxes_meet(a, b, cell, by).withColumn("_s", g.shared(F.col("l_geometry"), F.col("r_geometry"), zone))
    ratio = F.coalesce(F.col("_s.area") / F.nullif(F.col("_s.base"), F.lit(0.0)), F.lit(0.0))
    good = pairs.select(key, *keep, F.col("_s.area").alias("overlap_area"), ratio.alias("overlap_ratio")).where((F.col("overlap_area") > 0) & (F.col("overlap_ratio") >= least_ratio))
    return first_per_key(good, key, [-F.col("overlap_area"), F.col(keep[-1] if candidate_key else columns[0])]).select(key, *columns, "overlap_area", "overlap_ratio")


def dedup_across_tiles(features: DataFrame, tile: str = "tile", key: str = "fd_id") -> DataFrame:
    """An id belongs to the first tile it occurs in; repeats inside that tile
    stay, rows without id all stay. By aggregation and join, so a frequent id
    isn't gathered in one window."""
    first = features.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min(tile).alias("_t"))
    joined = features.join(first, F.col(key) == F.col("_k"), "left")
    return joined.where(F.col("_k").isNull() | (F.col(tile) == F.col("_t"))).drop("_k", "_t")
