"""City pipelines: one plan from sources to the 44-column table, for one city or
for many at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotweave.config import PipelineConfig, full_state, resolve_source, slug
from plotweave.functions import geometry as g
from plotweave.functions import overlay, rules
from plotweave.operators import conflate as cf
from plotweave.operators.conflate import CITY
from plotweave.schema import FOOTPRINT, NSI, OSM, OUTPUT, PARCEL, PARCEL_ATTACHED, empty
from plotweave.session import cut, stored
from plotweave.sources import attributes, footprints, parcels, remote, sinks

#: Public services of the reference's defaults.
NSI_URL = "https://nsi.sec.usace.army.mil/nsiapi/structures?fmt=fc"
#: A frame wider than this has no fitting zone: each shape takes its own.
WIDEST_DEG = 18.0
POINTS = NSI | {"x": "double", "y": "double"}
CITIES = f"{CITY} string, City string, State string, Country string, household double, household_source string"


@dataclass
class Inputs:
    """Standardised tables, of one city, or of many with the column ``city_slug``
    (tables without it are shared by all)."""

    overture: DataFrame
    microsoft: DataFrame
    osm: DataFrame
    nsi: DataFrame
    parcels: DataFrame
    household: float | None = None
    household_source: str | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in ("overture", "microsoft", "osm", "nsi", "parcels")}


@dataclass
class Connectors:
    """What reaches outside. Anything left out is simply not available."""

    geocode: Callable[[str], DataFrame] | None = None
    osm: Callable[[bytes], DataFrame] | None = None
    census: Callable[[int, str], list] | None = None
    microsoft: Callable | None = None
    overture: Callable | None = None
    nsi_transport: str | None = None
    nsi_url: str = NSI_URL

    @classmethod
    def public(cls, spark: SparkSession) -> Connectors:
        """The public services, each asked only if its source is switched on."""
        return cls(remote.geocoder(spark), remote.buildings(spark), remote.household_sizes(), footprints.download_microsoft(spark))


def areas(shapes: DataFrame) -> DataFrame:
    """Key and FootprintArea_m2 in the UTM zone of the frame's middle, city
    by city."""
    by, b = cf.city_of(shapes), F.col("bbox")
    low, high = F.min(b["xmin"]), F.max(b["xmax"])
    frame = shapes.groupBy(*by).agg(F.when(high - low <= WIDEST_DEG, g.utm_zone((low + high) / 2)).alias("zone"))
    zoned = shapes.join(frame, by) if by else shapes.withColumn("zone", frame.scalar())
    zone = F.coalesce("zone", g.utm_zone((b["xmin"] + b["xmax"]) / 2))
    return zoned.select("StructureID", *by, g.utm_area(F.col("rings"), zone).alias("FootprintArea_m2"))


def build_city(inputs: Inputs, city: str, state: str, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Stages 6-10 for one city. An empty base still has the schema."""
    spark = inputs.overture.sparkSession
    name = slug(city, full_state(state), config.country)
    keyed = Inputs(**{n: t.withColumn(CITY, F.lit(name)) for n, t in inputs.tables().items()})
    cities = spark.createDataFrame([(name, city, full_state(state), config.country, inputs.household, inputs.household_source)], CITIES)
    return build_cities(keyed, cities, config).drop(CITY)


def build_cities(inputs: Inputs, cities: DataFrame, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Stages 6-10 for all cities in one plan: merge, attach, finalize. ``cities``
    has a row per city (a short list of names); the result carries ``city_slug``
    besides the 44 columns. Structures are keyed by city and id inside."""
    def key(df: DataFrame) -> DataFrame:
        return df.withColumn("StructureID", F.concat_ws("\n", CITY, "StructureID"))

    base = stored(key(cf.merge_footprints(inputs.overture, inputs.microsoft, config.add_microsoft_unmatched)), "base")
    shapes = cut(cf.shapes_of(base))  # every join starts here, none from another's result
    if config.match_mode == "overlap":
        base = attach_by_overlap(base, inputs, config)
    else:
        base = cf.attach_osm(base, inputs.osm, shapes=shapes)
    base = cf.attach_inventory(base, inputs.nsi, shapes=shapes)
    if config.match_mode != "overlap":
        base = cf.attach_parcels(base, inputs.parcels, shapes=shapes)
    base = base.drop("FootprintArea_m2").join(areas(shapes).drop(CITY), "StructureID", "left").join(F.broadcast(cities), CITY, "left")
    base = base.withColumn("StructureID", F.element_at(F.split("StructureID", "\n", 2), -1))
    whole = rules.finalize(base, F.col("City"), F.col("State"), F.col("Country"), F.col("household"), F.col("household_source"), keep=[CITY])
    return whole


def attach_by_overlap(base: DataFrame, inputs: Inputs, config: PipelineConfig) -> DataFrame:
    """Optional matching mode: tags and parcels by the best polygon overlap above
    the configured ratios; parcels get their own match label."""
    tags = [c for c in OSM if c != "geometry"]
    lots = [c for c in PARCEL if c != "geometry"]
    best = cf.best_overlap(base, inputs.osm, tags, least_ratio=config.osm_overlap_ratio_threshold)
    base = cf.coalesce_onto(base, best, "StructureID", {c: OSM[c] for c in tags})
    best = cf.best_overlap(base, inputs.parcels, lots, least_ratio=config.parcel_overlap_ratio_threshold)
    best = best.withColumn("ParcelMatchMethod", F.when(F.col("ParcelSource").isNotNull(), "best_polygon_overlap"))
    return cf.coalesce_onto(base, best, "StructureID", PARCEL_ATTACHED)


def load_inputs(spark: SparkSession, city: str, state: str, config: PipelineConfig, connectors: Connectors, parcel_source: Any = None) -> Inputs:
    """Stages 1-5 and the reads of 7-9."""
    name = slug(city, full_state(state), config.country)
    source = resolve_source(config.boundary_sources, city, state, config.country)
    boundary = attributes.city_boundary(spark, city, state, config.country, source, connectors.geocode)
    if boundary is None:
        return Inputs(*(empty(spark, s) for s in (FOOTPRINT, FOOTPRINT, OSM, POINTS, PARCEL)))
    bounds = attributes.bounds_of(boundary)
    size, label = attributes.load_household_size(spark, city, state, config, connectors.census)
    extra = {"download": connectors.overture} if connectors.overture else {}
    lots = resolve_source(config.parcel_sources, city, state, config.country, parcel_source)
    return Inputs(
        footprints.load_overture(spark, name, bounds, boundary, config, **extra),
        footprints.load_microsoft(spark, name, bounds, boundary, config, connectors.microsoft),
        attributes.load_osm(spark, config, (lambda: connectors.osm(boundary)) if connectors.osm else None),
        load_inventory(spark, boundary, bounds, config, connectors),
        parcels.load(spark, lots, (lots or {}).get("name", name), name, bounds, boundary, config), size, label,
    )


def load_inventory(spark: SparkSession, boundary: bytes, bounds: tuple, config: PipelineConfig, connectors: Connectors) -> DataFrame:
    """One request per tile that meets the boundary."""
    import json

    if not config.use_nsi or not config.download_missing:
        return empty(spark, POINTS)
    box = spark.createDataFrame([bounds], "xmin double, ymin double, xmax double, ymax double")
    grid = g.boundary_tiles(box, config.nsi_tile_size_deg)
    shape = g.encode(g.rectangle(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")))
    meets = grid.withColumn("part", g.clip(shape, boundary)).where("part is not null")
    tiles = [[t.tile, t.xmin, t.ymin, t.xmax, t.ymax] for t in meets.orderBy("tile").collect()]  # a city's few tiles
    if not tiles:
        return empty(spark, POINTS)
    remote.register(spark)
    options = {"url": connectors.nsi_url, "tiles": json.dumps(tiles), "timeout": str(config.request_timeout_sec)}
    if connectors.nsi_transport:
        options["transport"] = connectors.nsi_transport
    raw = spark.read.format("tile_features").options(**options).load()
    return attributes.standardize_inventory(raw, g.decode(F.lit(boundary)))


def build_city_structures(spark: SparkSession, city: str, state: str, config: PipelineConfig, parcel_source: Any = None,
                          connectors: Connectors | None = None, write: bool = True) -> DataFrame:
    """Reads, builds and (by default) writes one city."""
    return _run(spark, [(city, state, parcel_source)], config, connectors, write, master=False)


def build_many_cities(spark: SparkSession, cities: Iterable[Mapping[str, Any] | tuple[str, str]], config: PipelineConfig, connectors: Connectors | None = None) -> DataFrame:
    """Every city's table and the combined one."""
    places = []
    for c in cities:
        c = dict(zip(("city", "state"), c)) if isinstance(c, tuple) else dict(c)
        places.append((c["city"], c["state"], c.get("parcel_source", c.get("parcels"))))
    return _run(spark, places, config, connectors, write=True, master=True) if places else empty(spark, OUTPUT)


def _run(spark: SparkSession, places: list[tuple[str, str, Any]], config: PipelineConfig, connectors: Connectors | None, write: bool, master: bool) -> DataFrame:
    """Loads the sources place by place (lists of files and requests), then builds
    all places in one plan and writes every city's table."""
    config.ensure_dirs()
    connectors = connectors or Connectors.public(spark)
    loaded, rows = {n: [] for n in ("overture", "microsoft", "osm", "nsi", "parcels")}, []
    for city, state, source in places:
        name = slug(city, full_state(state), config.country)
        one = load_inputs(spark, city, state, config, connectors, source)
        for n, t in one.tables().items():
            loaded[n].append(t.withColumn(CITY, F.lit(name)))
        rows.append((name, city, full_state(state), config.country, one.household, one.household_source))
    # each source is fetched and standardised once
    inputs = Inputs(**{n: stored(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ts), n) for n, ts in loaded.items()})
    progress = {(n, r[0]): r[1] for n, t in inputs.tables().items() for r in t.groupBy(CITY).count().collect()}
    for name, *_ in rows:
        print(f"{name}: " + ", ".join(f"{progress.get((n, name), 0)} {n} rows" for n in inputs.tables()))
    out = build_cities(inputs, spark.createDataFrame(rows, CITIES), config)
    if not write:
        return out.drop(CITY)
    counts = sinks.write_cities(out, config.output_dir, [r[0] for r in rows])
    for name, *_ in rows:
        print(f"{name}: {counts.get(name, 0)} structures")
    paths = [str(sinks.city_path(config.output_dir, r[0])) for r in rows]
    if not master:
        return spark.read.parquet(*paths)
    return spark.read.parquet(sinks.write_master(spark.read.parquet(*paths), config.output_dir))
