"""Attribute sources: tag polygons, inventory points, household sizes, boundaries."""

from __future__ import annotations

import codecs
import json
import os
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotweave.config import STATE_FIPS, PipelineConfig, full_state
from plotweave.functions import geometry as g
from plotweave.functions import overlay
from plotweave.functions.scalars import first_number, height_m, place_name, safe_number
from plotweave.operators.conflate import dedup_across_tiles
from plotweave.operators.near import with_point
from plotweave.schema import NSI, OSM, empty, ensure_columns, project
from plotweave.sources import files

_NEXT_OBJECT = re.compile(r"[ \t\r\n,]*")
UNIT_TAGS = ("building:flats", "residential:units", "building:units", "units")
CENSUS_YEARS = (2024, 2023, 2022, 2021, 2020)


def standardize_osm(raw: DataFrame) -> DataFrame:
    """The tag schema from a table with OSM tag columns."""
    def tag(name: str):
        return F.col(f"`{name}`") if name in raw.columns else F.lit(None)

    key = F.coalesce(tag("osmid").cast("string"), tag("id").cast("string"), F.substring(F.sha1("geometry"), 1, 12))
    out = raw.select(
        key.alias("OSMID"), tag("building").cast("string").alias("OSM_StructureType"), safe_number(tag("building:levels")).alias("Stories_OSM"),
        height_m(tag("height")).alias("Height_OSM"), first_number(raw, UNIT_TAGS).alias("Units_OSM"), tag("name").cast("string").alias("BuildingName_OSM"),
        g.clean("geometry").alias("geometry"),
    )
    return project(out.where("geometry is not null"), OSM)


def load_osm(spark: SparkSession, config: PipelineConfig, read: Callable[[], DataFrame] | None) -> DataFrame:
    """Any failure of the reader leaves an empty table."""
    if not config.use_osm or read is None:
        return empty(spark, OSM)
    try:
        return standardize_osm(read())
    except Exception as e:  # the source is optional
        print(f"tags skipped: {e}")
        return empty(spark, OSM)


def standardize_inventory(features: DataFrame, boundary_rings=None) -> DataFrame:
    """Inventory points: fields or GeoJSON ``properties``, numbers coerced, ids
    of earlier tiles dropped, x and y, only points inside the boundary."""
    df = features
    if "properties" in df.columns:
        p = F.from_json("properties", "map<string,string>")
        df = df.withColumns({c: F.try_element_at(p, F.lit(c)) for c in NSI if c not in df.columns})
    df = ensure_columns(df, NSI)
    df = df.withColumns({c: safe_number(F.col(c)) if t == "double" else F.col(c).cast("string") for c, t in NSI.items()})
    df = with_point(df.withColumn("geometry", F.col("geometry").cast("string")), "geometry", "x", "y").where("x is not null and y is not null")
    if "tile" in df.columns:
        df = dedup_across_tiles(df)
    if boundary_rings is not None:
        df = df.where(g.within(F.col("x"), F.col("y"), boundary_rings))
    keep = [c for c in ("tile", "ordinal") if c in df.columns]
    return df.select(*NSI, "x", "y", *keep)


def household_size(rows: DataFrame, city: str) -> tuple[float | None, str | None]:
    """Average household size of a place and its label: the latest year with a
    positive value, the first row in it. ``rows``: year, ordinal, NAME, value."""
    value = safe_number(F.col("value"))
    target = place_name(F.lit(city))
    hit = rows.where((place_name(F.col("NAME")) == target) & (value > 0)).orderBy(F.desc("year"), "ordinal").select("year", value.alias("v")).first()
    return (float(hit.v), f"ACS {hit.year} B25010_001E") if hit else (None, None)


def census_rows(spark: SparkSession, payloads: dict[int, list[list[str]]]) -> DataFrame:
    """Table of the yearly answers (header row, then rows); short ones are left out."""
    out = []
    for year, rows in payloads.items():
        if rows and len(rows) > 1 and {"NAME", "B25010_001E"} <= set(rows[0]):
            name, value = rows[0].index("NAME"), rows[0].index("B25010_001E")
            out += [(year, i, r[name], None if r[value] is None else str(r[value])) for i, r in enumerate(rows[1:])]
    return spark.createDataFrame(out, "year int, ordinal int, NAME string, value string")


def load_household_size(spark: SparkSession, city: str, state: str, config: PipelineConfig, fetch: Callable[[int, str], list] | None) -> tuple[float | None, str | None]:
    fips = STATE_FIPS.get(full_state(state).lower())
    if not config.use_census or fetch is None or not fips:
        return None, None
    payloads = {}
    for year in CENSUS_YEARS:
        try:
            payloads[year] = fetch(year, fips)
        except Exception:  # noqa: S112  (the next year may answer)
            continue
    return household_size(census_rows(spark, payloads), city) if payloads else (None, None)


# boundaries


def normalize_boundary(df: DataFrame) -> bytes | None:
    """One cleaned blob of a boundary table: all rings together. Parts that
    overlap are united by the even-odd rebuild of their sum, never cancelled."""
    got = [r[0] for r in df.select(g.clean("geometry").alias("geometry")).where("geometry is not null").collect()]  # a city's few parts
    regions = [r for r in overlay.polygons(got) if r]
    if not regions:
        return None
    if len(regions) == 1:
        return overlay.to_wkb(regions[0])
    return overlay.to_wkb(overlay.united(regions))


def read_boundary(spark: SparkSession, source: dict | str) -> bytes | None:
    source = {"path": source} if isinstance(source, str) else dict(source)
    if "path" not in source:
        raise ValueError("a boundary source needs a local 'path'")
    path = os.path.expanduser(str(source["path"]))
    if not files.exists(path):
        raise FileNotFoundError(f"boundary file not found: {path}")
    return normalize_boundary(read_vector(spark, path, crs=source.get("crs")))


def read_vector(spark: SparkSession, path: str, bounds: tuple[float, float, float, float] | None = None, crs: str | None = None) -> DataFrame:
    """Parquet (WKB ``geometry``) or GeoJSON (collection or lines) as a table, in
    degrees. ``bounds`` keeps what meets a box: it reaches the scan of Parquet
    with a ``bbox`` column. ``crs`` is used where the file names none (EPSG:4326,
    a UTM zone or web Mercator)."""
    if path.lower().endswith((".parquet", ".geoparquet")):
        df, known = spark.read.parquet(path), footer_crs(spark, path)
        if bounds is not None and "bbox" in df.columns and (known or crs) in (None, "EPSG:4326"):
            df = df.where(g.overlaps(F.col("bbox"), *[F.lit(float(v)) for v in bounds]))
    else:
        df, known = read_geojson(spark, path)
    zone = g.crs_code(known or crs or "EPSG:4326")
    if zone:
        df = df.withColumn("geometry", g.to_degrees(F.col("geometry"), F.lit(zone)))
    if bounds is not None:
        df = df.where(g.overlaps(g.box_of("geometry"), *[F.lit(float(v)) for v in bounds]))
    return df


def footer_crs(spark: SparkSession, path: str) -> str | None:
    """The reference system a GeoParquet file names, as EPSG:code."""
    try:
        system, where = pafs.FileSystem.from_uri(path if ":/" in path else f"file://{os.path.abspath(path)}")
        info = system.get_file_info(where)
        if info.type == pafs.FileType.Directory:
            where = next(f.path for f in system.get_file_info(pafs.FileSelector(where)) if f.path.endswith(".parquet"))
        geo = json.loads((pq.read_metadata(where, filesystem=system).metadata or {}).get(b"geo", b"{}"))
        got = (geo.get("columns", {}).get(geo.get("primary_column", "geometry"), {}).get("crs") or {}).get("id") or {}
        return f"EPSG:{got['code']}" if got.get("authority") == "EPSG" else None
    except (OSError, ValueError, StopIteration, pa.ArrowException, AttributeError):
        return None


def read_geojson(spark: SparkSession, path: str) -> tuple[DataFrame, str | None]:
    """Features and the file's reference system. Files with a feature a line are
    read line by line; a file that opens as one collection is cut into features
    as it streams through its task."""
    first = spark.read.text(path).where("trim(value) <> ''").limit(1).collect()
    head = first[0].value.lstrip() if first else ""
    lines = False
    if head:
        try:
            lines = json.loads(head).get("type") not in ("FeatureCollection",)
        except (ValueError, AttributeError):
            lines = False
    known = None
    if lines:
        features = spark.read.text(path).where("trim(value) <> ''").select(F.col("value").alias("f"))
    else:
        files_of = spark.read.format("binaryFile").load(path).select("path")
        features = files_of.mapInPandas(_split_collections, "f string")
        named = features.where("f like '{\"crs\":%'").limit(1).collect()
        if named:
            text = str(json.loads(named[0].f)["crs"])
            found = re.search(r"EPSG:+([0-9]+)", text)
            known = f"EPSG:{found[1]}" if found else None
        features = features.where("f not like '{\"crs\":%'")
    parsed = features.withColumn("p", F.from_json(F.get_json_object("f", "$.properties"), "map<string,string>"))
    names = sorted(r[0] for r in parsed.select(F.explode(F.map_keys("p"))).distinct().collect())  # field names of one layer
    geometry = g.encode(g.geojson_rings(F.coalesce(F.get_json_object("f", "$.geometry"), F.col("f"))))
    return parsed.select(*[F.try_element_at(F.col("p"), F.lit(n)).alias(n) for n in names if n != "geometry"], geometry.alias("geometry")), known


def _split_collections(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The features of collections, read piece by piece."""
    for pdf in batches:
        for path in pdf["path"]:
            system, where = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
            with system.open_input_stream(where) as stream:
                rows = []
                decoder = codecs.getincrementaldecoder("utf-8")("replace")
                for f in feature_texts(decoder.decode(b) for b in iter(lambda: stream.read(1 << 20), b"")):
                    rows.append(f)
                    if len(rows) >= 2_000:
                        yield pd.DataFrame({"f": rows})
                        rows = []
                yield pd.DataFrame({"f": rows})


def feature_texts(pieces: Iterator[str]) -> Iterator[str]:
    """Texts of the objects in the array ``features`` of a document that comes in
    pieces; a ``crs`` member before it comes first, a lone feature as it is."""
    decoder, text, inside = json.JSONDecoder(), "", False
    for piece in pieces:
        text += piece
        if not inside:
            at = re.search(r'"features"\s*:\s*\[', text)
            if not at:
                continue
            crs = re.search(r'"crs"\s*:\s*(?=\{)', text[: at.start()])
            if crs:
                yield '{"crs":' + json.dumps(decoder.raw_decode(text, crs.end())[0]) + "}"
            text, inside = text[at.end() :], True
        at = 0
        while (start := _NEXT_OBJECT.match(text, at).end()) < len(text) and text[start] == "{":
            try:
                _, end = decoder.raw_decode(text, start)
            except ValueError:  # the object goes on in the next piece
                break
            yield text[start:end]
            at = end
        text = text[at:]
    if not inside and text.strip():
        yield text


def bounds_of(boundary: bytes) -> tuple[float, float, float, float]:
    import numpy as np

    pts = np.concatenate(overlay.polygons([boundary])[0])
    return float(pts[:, 0].min()), float(pts[:, 1].min()), float(pts[:, 0].max()), float(pts[:, 1].max())


def city_boundary(spark: SparkSession, city: str, state: str, country: str, source: dict | str | None, geocode: Callable[[str], DataFrame] | None = None) -> bytes | None:
    """The given source, else ``geocode("city, State, country")``."""
    if source is not None:
        return read_boundary(spark, source)
    if geocode is None:
        raise ValueError(f"no boundary source for {city}, {state}, and no geocoder")
    return normalize_boundary(geocode(f"{city}, {full_state(state)}, {country}"))
