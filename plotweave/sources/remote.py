"""Remote feature services as Spark data sources (one partition per page range
or tile). Answers come through ``transport``, an option naming an importable
``module:function(url, params, body, timeout) -> dict``; the default uses the
standard library, tests give their own. Texts behind urls are read line by line
by the tasks, packed or not."""

from __future__ import annotations

import gzip
import importlib
import io
import json
import urllib.parse
import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from plotweave.functions import geometry as g
from plotweave.functions import wkb
from plotweave.session import cut

#: Rows of a page where a source names none.
PAGE_ROWS = 2_000


def http_json(url: str, params: dict | None, body: dict | None, timeout: float) -> dict:
    if params:
        url = f"{url}?{urllib.parse.urlencode(params)}"
    data = None if body is None else json.dumps(body).encode()
    request = urllib.request.Request(url, data=data, headers={"Content-Type": "application/json"} if data else {})
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return json.load(answer)


def transport_of(options: dict):
    name = options.get("transport")
    if not name:
        return http_json
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def open_url(url: str, timeout: float = 120) -> io.BufferedIOBase:
    """A stream of the bytes behind a url, unpacked if they are gzipped."""
    stream = io.BufferedReader(urllib.request.urlopen(url, timeout=timeout))
    return gzip.GzipFile(fileobj=stream) if stream.peek(2)[:2] == b"\x1f\x8b" else stream


def url_lines(urls: DataFrame, transport: str | None = None, batch: int = 2_000) -> DataFrame:
    """line, value of the texts behind the column ``Url``, one task a url.
    ``transport`` names a ``module:function(url) -> stream``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch = transport_of({"transport": transport}) if transport else open_url
        for pdf in batches:
            for url in pdf["Url"]:
                lines: list[tuple[int, str]] = []
                for n, line in enumerate(io.TextIOWrapper(fetch(url), encoding="utf-8", errors="replace")):
                    lines.append((n, line.rstrip("\r\n")))
                    if len(lines) >= batch:
                        yield pd.DataFrame(lines, columns=["line", "value"])
                        lines = []
                yield pd.DataFrame(lines, columns=["line", "value"])

    spread = urls.select("Url").repartition(max(urls.sparkSession.sparkContext.defaultParallelism, 1), "Url")
    return spread.mapInPandas(run, "line bigint, value string")


class PageRange(InputPartition):
    def __init__(self, start: int, stop: int | None):
        self.start, self.stop = start, stop


class ArcGISReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        url = self.options["url"].rstrip("/")
        self.url = url if url.endswith("/query") else f"{url}/query"
        self.page = int(self.options.get("page_size", PAGE_ROWS))
        self.key = self.options.get("order_by", "")

    def _params(self, **more: object) -> dict:
        xmin, ymin, xmax, ymax = map(float, self.options["bounds"].split(","))
        box = {"xmin": xmin, "ymin": ymin, "xmax": xmax, "ymax": ymax, "spatialReference": {"wkid": 4326}}
        return {
            "f": "geojson", "where": self.options.get("where", "1=1"), "outFields": self.options.get("out_fields", "*"), "returnGeometry": "true",
            "geometry": json.dumps(box), "geometryType": "esriGeometryEnvelope", "inSR": 4326, "outSR": 4326, "spatialRel": "esriSpatialRelIntersects",
        } | more

    def _ask(self, **more: object) -> dict:
        return transport_of(self.options)(self.url, self._params(**more), None, float(self.options.get("timeout", 120)))

    def _key(self) -> str:
        """The layer's object id field."""
        if not self.key:
            try:
                self.key = transport_of(self.options)(self.url.removesuffix("/query"), {"f": "json"}, None, float(self.options.get("timeout", 120))).get("objectIdField") or "OBJECTID"
            except Exception:  # layers that don't describe themselves
                self.key = "OBJECTID"
        return self.key

    def partitions(self) -> list[InputPartition]:
        """Page ranges if the service counts, else one run to the end."""
        try:
            count = int(self._ask(returnCountOnly="true", f="json")["count"])
        except Exception:
            return [PageRange(0, None)]
        span = self.page * max(1, int(self.options.get("pages_per_task", 10)))
        return [PageRange(a, min(count, a + span)) for a in range(0, count, span)] or [PageRange(0, 0)]

    def read(self, part: PageRange) -> Iterator[tuple]:
        at = part.start
        while part.stop is None or at < part.stop:
            size = self.page if part.stop is None else min(self.page, part.stop - at)
            # a stable order, so pages fetched side by side neither repeat nor miss rows
            answer = self._ask(resultRecordCount=size, resultOffset=at, orderByFields=self._key())
            batch = answer.get("features", [])
            for f in batch:
                yield json.dumps(f.get("properties") or {}), json.dumps(f.get("geometry"))
            at += len(batch)
            if not batch or (len(batch) < size and not answer.get("exceededTransferLimit")):
                return


class ArcGISFeatures(DataSource):
    """``format("arcgis_features")``: properties and geometry as JSON texts."""

    @classmethod
    def name(cls) -> str:
        return "arcgis_features"

    def schema(self) -> str:
        return "properties string, geometry string"

    def reader(self, schema) -> DataSourceReader:
        return ArcGISReader(self.options)


class Tile(InputPartition):
    def __init__(self, number: int, box: list[float]):
        self.number, self.box = number, box


class TileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [Tile(int(n), box) for n, *box in json.loads(self.options["tiles"])]

    def read(self, tile: Tile) -> Iterator[tuple]:
        x0, y0, x1, y1 = tile.box
        ring = [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]
        body = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}
        try:
            answer = transport_of(self.options)(self.options["url"], None, body, float(self.options.get("timeout", 90)))
        except Exception as e:  # a tile that fails is skipped
            print(f"tile {tile.number} skipped: {e}")
            return
        for f in answer.get("features", []):
            yield tile.number, json.dumps(f.get("properties") or {}), json.dumps(f.get("geometry"))


class TileFeatures(DataSource):
    """``format("tile_features")``: a POST per tile; tile, properties, geometry."""

    @classmethod
    def name(cls) -> str:
        return "tile_features"

    def schema(self) -> str:
        return "tile bigint, properties string, geometry string"

    def reader(self, schema) -> DataSourceReader:
        return TileReader(self.options)


# public services


def geocoder(spark: SparkSession, transport: str | None = None, url: str = "https://nominatim.openstreetmap.org/search"):
    """``geocode(query)``: a table with the polygon of the best answer."""
    def geocode(query: str) -> DataFrame:
        answer = transport_of({"transport": transport})(url, {"q": query, "format": "geojson", "polygon_geojson": 1, "limit": 1}, None, 60)
        found = [(json.dumps(f["geometry"]),) for f in answer.get("features", []) if f.get("geometry")]
        if not found:
            raise ValueError(f"no place called {query}")
        return spark.createDataFrame(found, "shape string").select(g.encode(g.geojson_rings(F.col("shape"))).alias("geometry"))

    return geocode


def household_sizes(transport: str | None = None, url: str = "https://api.census.gov/data/{year}/acs/acs5"):
    """``fetch(year, state code)``: the yearly answer, header row first."""
    return lambda year, fips: transport_of({"transport": transport})(url.format(year=year), {"get": "NAME,B25010_001E", "for": "place:*", "in": f"state:{fips}"}, None, 90)


def _closed_rings(lines: list[list[list[float]]]) -> list[list[list[float]]]:
    """Rings from pieces of outlines that meet end to end."""
    out, left = [], [list(x) for x in lines if len(x) > 1]
    while left:
        ring = left.pop()
        while ring[0] != ring[-1]:
            k = next((k for k, x in enumerate(left) if ring[-1] in (x[0], x[-1])), None)
            if k is None:
                break
            piece = left.pop(k)
            ring += piece[1:] if piece[0] == ring[-1] else piece[-2::-1]
        if ring[0] == ring[-1] and len(ring) > 3:
            out.append(ring)
    return out


def element_feature(e: dict) -> tuple[str, str, str] | None:
    """(id, tags, GeoJSON) of a building element with its outline."""
    def line(points: list[dict] | None) -> list[list[float]]:
        return [[p["lon"], p["lat"]] for p in points or [] if p]

    if e.get("type") == "way":
        rings = _closed_rings([line(e.get("geometry"))])
    else:
        members = e.get("members", [])
        rings = _closed_rings([line(m.get("geometry")) for m in members if m.get("role") != "inner"]) + _closed_rings([line(m.get("geometry")) for m in members if m.get("role") == "inner"])
    # rings are read by the even-odd rule, so inner ones may follow the outer ones
    return (str(e["id"]), json.dumps(e.get("tags") or {}), json.dumps({"type": "Polygon", "coordinates": rings})) if rings else None


OSM_TAGS = ("building", "building:levels", "height", "building:flats", "residential:units", "building:units", "units", "name")


def buildings(spark: SparkSession, transport: str | None = None, url: str = "https://overpass-api.de/api/interpreter", step: float = 0.05):
    """``read(boundary)``: tag table of the buildings that meet the boundary's
    box, a request per tile of ``step`` degrees, asked by the tasks."""
    def read(boundary: bytes) -> DataFrame:
        corners = wkb.read([boundary]).bounds()[0]
        box = spark.createDataFrame([tuple(map(float, corners))], "xmin double, ymin double, xmax double, ymax double")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ask = transport_of({"transport": transport})
            for pdf in batches:
                for t in pdf.itertuples():
                    area = f"({t.ymin},{t.xmin},{t.ymax},{t.xmax})"
                    query = f'[out:json][timeout:180];(way["building"]{area};relation["building"]{area};);out tags geom;'
                    got = [f for e in ask(url, {"data": query}, None, 200).get("elements", []) if (f := element_feature(e))]
                    yield pd.DataFrame(got, columns=["osmid", "tags", "shape"])

        tiles = g.boundary_tiles(box, step).repartition(spark.sparkContext.defaultParallelism, "tile")
        found = tiles.mapInPandas(run, "osmid string, tags string, shape string").groupBy("osmid").agg(F.min(F.struct("tags", "shape")).alias("m"))
        tags = F.from_json("m.tags", "map<string,string>")
        return cut(found.select("osmid", *[F.try_element_at(tags, F.lit(t)).alias(t) for t in OSM_TAGS], g.encode(g.geojson_rings(F.col("m.shape"))).alias("geometry")))

    return read


def register(spark: SparkSession) -> None:
    for source in (ArcGISFeatures, TileFeatures):
        spark.dataSource.register(source)
