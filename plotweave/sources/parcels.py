"""Parcel layers: column resolution, standardising and reading."""

from __future__ import annotations

import os
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotweave.config import PARCEL_ALIASES, PARCEL_COLUMNS, PARCEL_NUMBERS, PARCEL_SPELLINGS, PipelineConfig, source_digest
from plotweave.functions import geometry as g
from plotweave.functions.scalars import field_name, safe_number
from plotweave.schema import PARCEL, empty, project
from plotweave.session import cut
from plotweave.sources import files, remote
from plotweave.sources.attributes import read_vector


def find_column(columns: list[str], source: Mapping[str, Any], canonical: str) -> str | None:
    """The column that holds a canonical field: names configured in the source
    (field map first, canonical or snake spelling, acronyms whole or spelled
    out) before the known aliases; compared without case and signs, the last of
    equal columns wins."""
    fields = source.get("field_map") or {}
    configured = next((v for m in (fields, source) for k in PARCEL_SPELLINGS[canonical] if (v := m.get(k))), [])
    names = [*(configured if isinstance(configured, (list, tuple)) else [configured]), *PARCEL_ALIASES[canonical]]
    lookup = {field_name(c): c for c in columns}
    return next((lookup[k] for n in names if (k := field_name(n)) in lookup), None)


def standardize(raw: DataFrame, source: Mapping[str, Any], name: str) -> DataFrame:
    """The parcel schema: resolved fields, numbers coerced, area in the UTM zone
    of the frame. Geometry is cleaned; fields nobody holds are NULL."""
    columns = {}
    for canonical in PARCEL_COLUMNS:
        found = find_column([c for c in raw.columns if c != "geometry"], source, canonical)
        c = F.col(f"`{found}`") if found else F.lit(None)
        columns[canonical] = safe_number(c) if canonical in PARCEL_NUMBERS else c.cast("string")
    df = raw.select(*[c.alias(n) for n, c in columns.items()], F.lit(name).alias("ParcelSource"), g.clean("geometry").alias("geometry"))
    df = df.withColumn("rings", g.decode("geometry")).withColumn("bbox", g.bbox(F.col("rings")))
    df = df.withColumn("zone", g.frame_zone(df).scalar())
    return project(df.withColumn("ParcelArea_m2", g.utm_area(F.col("rings"), F.col("zone"))).drop("rings", "bbox", "zone"), PARCEL)


def read_arcgis(spark: SparkSession, source: Mapping[str, Any], bounds: tuple) -> DataFrame:
    """Features of a service as a table: a column per property, WKB geometry."""
    remote.register(spark)
    options = {k: str(v) for k, v in source.items() if k in ("url", "where", "out_fields", "page_size", "timeout", "transport", "pages_per_task")}
    raw = spark.read.format("arcgis_features").options(**options, bounds=",".join(map(str, bounds))).load()
    return features_table(raw)


def features_table(raw: DataFrame) -> DataFrame:
    p = raw.withColumn("p", F.from_json("properties", "map<string,string>"))
    names = sorted(r[0] for r in p.select(F.explode(F.map_keys("p"))).distinct().collect())  # field names of one layer
    return p.select(*[F.try_element_at(F.col("p"), F.lit(n)).alias(n) for n in names if n != "geometry"], g.encode(g.geojson_rings(F.col("geometry"))).alias("geometry"))


def load(spark: SparkSession, source: Mapping[str, Any] | None, name: str, slug: str, bounds: tuple, boundary: bytes, config: PipelineConfig) -> DataFrame:
    """Parcels of a city. A path wins over a url; a missing file or any failure
    of a service gives an empty table. Answers of a service are kept under the
    slug and a digest of the source, so a changed source is read anew."""
    if not config.use_parcels or source is None:
        return empty(spark, PARCEL)
    if source.get("path"):
        path = os.path.expanduser(str(source["path"]))
        if not files.exists(path):
            print(f"parcels skipped: no file at {path}")
            return empty(spark, PARCEL)
        raw = read_vector(spark, path, bounds, source.get("crs"))
        return standardize(raw.withColumn("geometry", g.clip(F.col("geometry"), boundary)), source, name)
    if not source.get("url"):
        return empty(spark, PARCEL)
    kept = files.join(config.raw_dir, f"parcels_{slug}_{source_digest(source)}.parquet")
    if files.exists(kept):
        return spark.read.parquet(str(kept))
    if not config.download_missing:
        return empty(spark, PARCEL)
    try:
        raw = cut(read_arcgis(spark, source, bounds))
    except Exception as e:  # the source is optional; pages already read are dropped
        print(f"parcels skipped: {e}")
        return empty(spark, PARCEL)
    out = standardize(raw.withColumn("geometry", g.clip(F.col("geometry"), boundary)), source, name)
    if config.cache_remote_parcels and not out.isEmpty():
        out.write.mode("overwrite").parquet(str(kept))
        return spark.read.parquet(str(kept))
    return out
