"""Building footprints: primary Parquet layers and GeoJSON-lines tiles."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile
from collections.abc import Callable
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotweave.config import PipelineConfig
from plotweave.functions import geometry as g
from plotweave.functions.scalars import nested_text, safe_number
from plotweave.schema import FOOTPRINT, empty, project
from plotweave.sources import files, remote

Bounds = tuple[float, float, float, float]
#: Public index of the secondary footprints' tiles.
MICROSOFT_LINKS = "https://minedbuildings.z5.web.core.windows.net/global-buildings/dataset-links.csv"


# state sidecars


def write_state(path: str | Path, bounds: Bounds, **extra: object) -> None:
    box = dict(zip(("xmin", "ymin", "xmax", "ymax"), bounds))
    state = {"last_run": datetime.now(timezone.utc).isoformat(), **extra, "bbox": box, "output": str(path)}
    files.write_text(f"{path}.state", json.dumps(state, indent=2))


def state_covers(path: str | Path, bounds: Bounds) -> bool:
    """The sidecar's box holds the bounds; missing or malformed ones don't."""
    try:
        box = json.loads(files.read_text(f"{path}.state"))["bbox"]
        return box["xmin"] <= bounds[0] and box["ymin"] <= bounds[1] and box["xmax"] >= bounds[2] and box["ymax"] >= bounds[3]
    except (OSError, ValueError, KeyError, TypeError):
        return False


# primary footprints


def read_overture(spark: SparkSession, path: str | Path, bounds: Bounds | None = None, boundary: bytes | None = None) -> DataFrame:
    """The footprint schema from a Parquet layer. Only known columns are read;
    the box filter reaches the scan when the file has a ``bbox`` column."""
    if not files.exists(path):
        return empty(spark, FOOTPRINT)
    raw = spark.read.parquet(str(path))
    if bounds is not None and "bbox" in raw.columns:
        raw = raw.where(g.overlaps(F.col("bbox"), *[F.lit(float(v)) for v in bounds]))
    has = set(raw.columns)

    def pick(name: str, c=None):
        return c if c is not None and name in has else (F.col(name) if name in has else F.lit(None))

    geometry = g.clip(F.col("geometry"), boundary) if boundary is not None else g.clean("geometry")
    key = F.coalesce(pick("id").cast("string"), F.concat(F.lit("ovt_"), F.substring(F.sha1("geometry"), 1, 12)))
    name = nested_text(F.col("names.primary")) if "names" in has else F.lit(None)
    parts = F.col("has_parts") if "has_parts" in has else F.lit(None)
    out = raw.select(
        key.alias("StructureID"), F.lit("overture").alias("FootprintSource"), key.alias("OvertureID"), name.alias("BuildingName_OVT"),
        safe_number(pick("height")).alias("Height_OVT"), safe_number(pick("num_floors")).alias("Stories_OVT"),
        pick("subtype").alias("OvertureSubtype"), pick("class").alias("OvertureClass"), parts.alias("HasParts"), geometry.alias("geometry"),
    )
    return project(out.where("geometry is not null"), FOOTPRINT)


def download_overture(bounds: Bounds, path: files.Location, config: PipelineConfig) -> None:
    """Calls the public download command, which writes to the driver's disk; for
    other places the file is moved there. Partial output is removed on failure."""
    local = path if isinstance(path, Path) else Path(tempfile.mkdtemp(prefix="plotweave-download-")) / "buildings.parquet"
    local.parent.mkdir(parents=True, exist_ok=True)
    command = [sys.executable, "-m", "overturemaps", "download", "--bbox=" + ",".join(map(str, bounds)), "-f", "geoparquet", "--type=building", "-o", str(local)]
    if config.overture_release:
        command += ["--release", config.overture_release]
    env = dict(os.environ)
    try:
        import certifi

        env |= {"SSL_CERT_FILE": certifi.where(), "REQUESTS_CA_BUNDLE": certifi.where()}
    except ImportError:
        pass
    try:
        subprocess.run(command, check=True, env=env)
        if local is not path:
            files.upload(local, path)
    except (OSError, subprocess.CalledProcessError):
        local.unlink(missing_ok=True)
        files.remove(f"{path}.state")
        raise
    write_state(path, bounds, release=config.overture_release, type="building")


def overture_path(slug: str, bounds: Bounds, config: PipelineConfig, download: Callable = download_overture) -> files.Location | None:
    """City file, else the general file if its state covers the bounds, else a
    download if allowed; a failed download is reported and skipped."""
    city = files.join(config.raw_dir, f"overture_{slug}.parquet")
    if files.exists(city):
        return city
    general = files.join(config.data_dir, "overture_buildings.parquet")
    if files.exists(general) and state_covers(general, bounds):
        return general
    if config.download_missing:
        try:
            download(bounds, city, config)
            return city
        except Exception as e:  # the source is optional
            print(f"primary footprints skipped: {e}")
    return None


def load_overture(spark: SparkSession, slug: str, bounds: Bounds, boundary: bytes, config: PipelineConfig, download: Callable = download_overture) -> DataFrame:
    path = overture_path(slug, bounds, config, download) if config.use_overture else None
    return read_overture(spark, path, bounds, boundary) if path else empty(spark, FOOTPRINT)


# secondary footprints


def read_remote_csv(spark: SparkSession, url: str, transport: str | None = None) -> DataFrame:
    """A CSV behind a url, everything as text; fetched by one task."""
    lines = remote.url_lines(spark.createDataFrame([(url,)], "Url string"), transport)
    head = lines.orderBy("line").first()
    if head is None:
        return spark.createDataFrame([], "QuadKey string, Url string")
    names = [n.strip().strip('"') for n in head.value.split(",")]
    row = F.from_csv("value", ", ".join(f"`{n}` string" for n in names))
    return lines.where("line > 0").select(row.alias("r")).select("r.*")


def json_lines(raw: DataFrame) -> DataFrame:
    """height, confidence and WKB geometry of GeoJSON features in ``value``."""
    raw = raw.where("trim(value) <> ''")
    p = F.coalesce(F.get_json_object("value", "$.properties"), F.col("value"))
    rings = g.geojson_rings(F.get_json_object("value", "$.geometry"))
    return raw.select(safe_number(F.get_json_object(p, "$.height")).alias("height"), safe_number(F.get_json_object(p, "$.confidence")).alias("confidence"), g.encode(rings).alias("geometry"))


def read_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """GeoJSON lines (``.gz`` too)."""
    return json_lines(spark.read.text(path))


def tile_urls(links: DataFrame, bounds: DataFrame, zoom: int) -> DataFrame:
    """Distinct urls of the tiles that cover the bounds; ``links`` has QuadKey, Url."""
    keys = g.quadkeys_for_bounds(bounds, zoom).withColumnRenamed("quadkey", "QuadKey")
    return links.join(keys, "QuadKey").where("Url is not null").select("Url").distinct()


def standardize_microsoft(raw: DataFrame, slug: str) -> DataFrame:
    """The footprint schema; -1 means unknown. Ids number the distinct rows by
    their geometry's digest, so the same data get the same ids in any order;
    equal footprints are told apart by their number in it."""
    df = raw.withColumn("geometry", g.clean("geometry")).where("geometry is not null")
    for c in ("height", "confidence"):
        df = df.withColumn(c, F.nullif(safe_number(F.col(c)), F.lit(-1.0)) if c in raw.columns else F.lit(None).cast("double"))
    digest = F.substring(F.sha1("geometry"), 1, 16)
    grouped = df.withColumn("digest", digest).groupBy("digest", "geometry", "height", "confidence").agg(F.count(F.lit(1)).alias("n"))
    rows = grouped.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    key = F.concat(F.lit(f"msft_{slug}_"), F.col("digest"), F.when(F.col("at") > 1, F.concat(F.lit("_"), F.col("at"))).otherwise(F.lit("")))
    return project(
        rows.select(key.alias("StructureID"), F.lit("microsoft").alias("FootprintSource"), key.alias("MicrosoftID"), F.lit(False).alias("HasParts"),
                    F.col("height").alias("Height_MS"), F.col("confidence").alias("Confidence_MS"), "geometry"),
        FOOTPRINT,
    )


def load_microsoft(spark: SparkSession, slug: str, bounds: Bounds, boundary: bytes, config: PipelineConfig, fetch: Callable | None = None) -> DataFrame:
    """City file as it is, else the general file for listed slugs (clipped, if
    anything is left), else ``fetch(bounds, path)``, whose errors propagate."""
    if not config.use_microsoft:
        return empty(spark, FOOTPRINT)
    city = files.join(config.raw_dir, f"microsoft_{slug}.parquet")
    if files.exists(city):
        return standardize_microsoft(spark.read.parquet(str(city)), slug)
    general = files.join(config.data_dir, "microsoft_buildings.parquet")
    if slug in config.generic_microsoft_cache_slugs and files.exists(general):
        part = spark.read.parquet(str(general)).withColumn("geometry", g.clip(F.col("geometry"), boundary)).where("geometry is not null")
        if not part.isEmpty():
            return standardize_microsoft(part, slug)
    if not config.download_missing or fetch is None:
        return empty(spark, FOOTPRINT)
    fetch(bounds, boundary, city, config)
    return standardize_microsoft(spark.read.parquet(str(city)), slug) if files.exists(city) else empty(spark, FOOTPRINT)


def store_microsoft(raw: DataFrame, boundary: bytes, bounds: Bounds, path: files.Location) -> None:
    """Features sliced by box, clipped, cleaned and kept as the city's file with
    a state sidecar (K3)."""
    raw = raw.where(g.overlaps(g.box_of("geometry"), *[F.lit(float(v)) for v in bounds])).withColumn("geometry", g.clip(F.col("geometry"), boundary))
    raw.where("geometry is not null").write.mode("overwrite").parquet(str(path))
    write_state(path, bounds)


def download_microsoft(spark: SparkSession, links: str = MICROSOFT_LINKS, transport: str | None = None) -> Callable:
    """The fetch of ``load_microsoft``: the index of links names the tiles over
    the bounds, tasks read a tile each, and what lies in the boundary is kept."""
    def fetch(bounds: Bounds, boundary: bytes, path: files.Location, config: PipelineConfig) -> None:
        box = spark.createDataFrame([bounds], "xmin double, ymin double, xmax double, ymax double")
        urls = tile_urls(read_remote_csv(spark, links, transport), box, config.microsoft_zoom)
        store_microsoft(json_lines(remote.url_lines(urls, transport)), boundary, bounds, path)

    return fetch
