"""Sources, sinks, pipeline, command line and stream over local files."""

import gzip
import io
import json
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from plotweave import cli
from plotweave.config import PipelineConfig
from plotweave.functions import geometry as g
from plotweave.functions import kernels, overlay, wkb
from plotweave.plans import pipeline, profile
from plotweave.schema import OUTPUT
from plotweave.sources import attributes, footprints, parcels, remote, sinks

X0, Y0 = -90.0, 40.0


def ring(x, y, w, h=None):
    h = w if h is None else h
    x, y = X0 + x * 1e-4, Y0 + y * 1e-4
    w, h = w * 1e-4, h * 1e-4
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def box(*a):
    return bytearray(wkb.polygon(ring(*a)))


def geojson(*a):
    return {"type": "Polygon", "coordinates": [[list(p) for p in ring(*a)]]}


def answer(url, params, body, timeout):
    """A service of 5 parcels, 2 a page, that counts; and inventory tiles."""
    if body is not None:
        x, y = X0 + 1.5e-4, Y0 + 1.5e-4
        f = {"type": "Feature", "properties": {"fd_id": 7, "occtype": "RES1", "num_story": "2", "resunits": 1, "pop2amu65": 3}, "geometry": {"type": "Point", "coordinates": [x, y]}}
        return {"features": [f]}
    if params.get("returnCountOnly"):
        return {"count": 5}
    feats = [{"type": "Feature", "properties": {"APN": i, "Total_Value": f"{i}00", "SitusAddr": f"{i} Elm"}, "geometry": geojson(i * 10, 0, 9)} for i in range(5)]
    at = params["resultOffset"]
    return {"features": feats[at : at + params["resultRecordCount"]]}


def broken(url, params, body, timeout):
    raise OSError("down")


@pytest.fixture()
def config(spark, tmp_path):
    c = PipelineConfig(
        data_dir=tmp_path / "data", output_dir=tmp_path / "out", raw_dir=tmp_path / "raw", cache_dir=tmp_path / "cache",
        boundary_sources={"corvane_illinois_usa": {"path": str(tmp_path / "boundary.geojson")}},
        parcel_sources={"corvane": {"url": "http://x/layer", "page_size": 2, "pages_per_task": 1, "transport": "test_pipeline:answer"}},
    )
    c.ensure_dirs()
    (tmp_path / "boundary.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"n": 1}, "geometry": geojson(0, 0, 100)}]}))
    ovt = [("o1", 4.0, "3", box(1, 1, 3)), ("o2", None, None, box(90, 90, 30)), ("o3", None, None, box(500, 500, 3))]
    df = spark.createDataFrame(ovt, "id string, height double, num_floors string, geometry binary").withColumn("names", F.struct(F.lit("").alias("primary")))
    df.write.parquet(str(c.raw_dir / "overture_corvane_illinois_usa.parquet"))
    lines = [{"type": "Feature", "properties": {"height": h, "confidence": -1}, "geometry": geojson(*a)} for h, a in ((5.5, (20, 20, 2)), (-1, (1.5, 1.5, 1)))]
    (tmp_path / "tile.jsonl").write_text("\n".join(map(json.dumps, lines)))
    boundary = attributes.read_boundary(spark, str(tmp_path / "boundary.geojson"))
    footprints.store_microsoft(footprints.read_json_lines(spark, str(tmp_path / "tile.jsonl")), boundary, attributes.bounds_of(boundary), c.raw_dir / "microsoft_corvane_illinois_usa.parquet")
    return c


def test_city(spark, config):
    osm = lambda boundary: spark.createDataFrame([("w1", "house", "2", "20 ft", box(0, 0, 9))], "osmid string, building string, `building:levels` string, height string, geometry binary")
    census = lambda year, fips: [["NAME", "B25010_001E"], ["Corvane city, Illinois", "0" if year == 2024 else "2.5"]]
    connectors = pipeline.Connectors(osm=osm, census=census, nsi_transport="test_pipeline:answer")
    out = pipeline.build_many_cities(spark, [("Corvane", "IL")], config, connectors)
    rows = {r.StructureID: r for r in out.collect()}
    assert out.columns == list(OUTPUT) and len(rows) == 3  # the covered second-source box is gone, the far one clipped away
    o1 = rows["o1"]
    assert (o1.OSMID, o1.StructureType, o1.NumStories, o1.NSI_FD_ID, o1.ParcelID, o1.ParcelMatchMethod) == ("w1", "residential", 2.0, "7", "0", "representative_point_within")
    assert o1.HeightM == pytest.approx(6.096) and o1.OccupantCount == 3.0 and o1.CensusSource == "ACS 2023 B25010_001E"
    ms = next(r for k, r in rows.items() if k.startswith("msft_corvane"))
    assert (ms.HeightM, ms.HeightSource, ms.Confidence_MS) == (5.5, "microsoft", None)
    assert rows["o2"].FootprintArea_m2 == pytest.approx(rows["o1"].FootprintArea_m2 / 9 * 100, rel=1e-3)  # clipped to 10 x 10
    assert {r.label: r.n for r in profile.label_counts(out, ["HeightSource"]).collect()} == {"osm": 1, "microsoft": 1, None: 1}
    assert len(list(config.raw_dir.glob("parcels_*"))) == 1
    path = config.output_dir / "corvane_illinois_usa_structures.parquet"
    assert all(b"geo" in pq.read_schema(f).metadata for f in Path(path).glob("*.parquet"))
    overlap = PipelineConfig(**{**config.__dict__, "match_mode": "overlap"})
    again = pipeline.build_city_structures(spark, "Corvane", "IL", overlap, connectors=connectors, write=False)
    assert {r.ParcelMatchMethod for r in again.collect()} == {"best_polygon_overlap", None}


def test_services(spark, config):
    source = dict(config.parcel_sources["corvane"])
    bounds = (X0, Y0, X0 + 0.01, Y0 + 0.01)
    assert parcels.read_arcgis(spark, source, bounds).count() == 5
    reader = remote.ArcGISReader({"url": "http://x", "bounds": "0,0,1,1", "page_size": "2", "transport": "test_pipeline:answer"})
    assert len(list(reader.read(remote.PageRange(0, None)))) == 5
    boundary = bytes(box(0, 0, 100))
    down = parcels.load(spark, source | {"transport": "test_pipeline:broken"}, "n", "s", bounds, boundary, config)
    assert down.count() == 0
    assert parcels.load(spark, {"path": "/nowhere.parquet"}, "n", "s", bounds, boundary, config).count() == 0
    assert parcels.find_column(["own", "PIN", "pin"], {}, "ParcelID") == "pin"
    assert parcels.find_column(["x", "PIN"], {"field_map": {"parcel_id": ["nope", "x"]}}, "ParcelID") == "x"
    assert parcels.find_column(["x"], {}, "ParcelID") is None


def test_resolution(spark, tmp_path):
    c = PipelineConfig(data_dir=tmp_path, raw_dir=tmp_path / "raw", output_dir=tmp_path, cache_dir=tmp_path)
    c.ensure_dirs()
    bounds = (0.0, 0.0, 1.0, 1.0)

    def fail(*a):
        raise OSError("no network")

    assert footprints.overture_path("x", bounds, c, fail) is None
    general = tmp_path / "overture_buildings.parquet"
    general.write_text("")
    footprints.write_state(general, (-1, -1, 2, 2))
    assert footprints.overture_path("x", bounds, c, fail) == general
    footprints.write_state(general, (0.5, 0, 2, 2))
    assert not footprints.state_covers(general, bounds) and not footprints.state_covers(tmp_path / "none", bounds)
    with pytest.raises(FileNotFoundError):
        attributes.read_boundary(spark, "/nowhere")
    with pytest.raises(ValueError):
        attributes.read_boundary(spark, {"url": "x"})
    two = spark.createDataFrame([(box(0, 0, 2),), (box(1, 1, 2),), (None,)], "geometry binary")
    united = overlay.polygons([attributes.normalize_boundary(two)])[0]
    assert overlay._inside(X0 + 1.5e-4, Y0 + 1.5e-4, united)  # the shared part isn't cancelled
    assert attributes.normalize_boundary(two.limit(0)) is None


def test_ids_do_not_depend_on_the_order(spark):
    df = spark.createDataFrame([(1.0, box(0, 0, 1)), (2.0, box(5, 5, 1)), (1.0, box(0, 0, 1))], "height double, geometry binary")
    a = sorted(map(tuple, footprints.standardize_microsoft(df, "c").select("StructureID", "Height_MS").collect()))
    b = sorted(map(tuple, footprints.standardize_microsoft(df.orderBy(F.desc("height")), "c").select("StructureID", "Height_MS").collect()))
    assert a == b and len({i for i, _ in a}) == 3


def test_cli():
    places, c = cli.configure(["--place", "Corvane, IL", "--place", "A, B, TX", "--no-download", "--no-nsi", "--parcel-source", "a=b.parquet"])
    assert places == [("Corvane", "IL"), ("A, B", "TX")] and not c.download_missing and not c.use_nsi and c.use_osm
    assert c.parcel_sources == {"a": {"path": "b.parquet"}}
    with pytest.raises(SystemExit):
        cli.configure([])


def test_stream(spark, tmp_path):
    from plotweave.streaming.inventory import follow, totals

    base = spark.createDataFrame([("a", box(0, 0, 3))], "StructureID string, geometry binary")
    for k in range(2):
        spark.createDataFrame([(f"{k}", X0 + 1e-4, Y0 + 1e-4), (f"x{k}", 0.0, 0.0)], "fd_id string, x double, y double").write.parquet(str(tmp_path / f"in/{k}"))
        follow(spark, str(tmp_path / "in/*"), "fd_id string, x double, y double", base, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert [(r.StructureID, r.NSI_RecordCount) for r in totals(spark, str(tmp_path / "out")).collect()] == [("a", 2)]


def test_entry(spark, tiny):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_uri_paths(spark, config):
    """A path with a scheme means the same file."""
    plain = config.raw_dir / "overture_corvane_illinois_usa.parquet"
    assert footprints.read_overture(spark, f"file://{plain}").count() == footprints.read_overture(spark, plain).count() == 3
    stores = PipelineConfig(**{**config.__dict__, **{d: f"file://{getattr(config, d)}" for d in ("data_dir", "raw_dir", "output_dir", "cache_dir")}})
    assert str(stores.raw_dir).startswith("file:///")
    assert footprints.overture_path("corvane_illinois_usa", (0, 0, 1, 1), stores, None) == f"file://{plain}"
    footprints.write_state(f"{stores.raw_dir}/x", (0, 0, 2, 2))
    assert footprints.state_covers(config.raw_dir / "x", (0.5, 0.5, 1, 1))
    out = pipeline.build_many_cities(spark, [("Corvane", "IL")], stores, pipeline.Connectors(nsi_transport="test_pipeline:answer"))
    assert out.count() == 3 and (config.output_dir / "structures_master.parquet").is_dir()


def many(url, params=None, body=None, timeout=None):
    """All public services for two cities that share a street."""
    if "nominatim" in url:
        assert params["q"] in ("Corvane, Illinois, USA", "Tessaly, Illinois, USA")
        x = 0 if params["q"].startswith("Corvane") else 60
        return {"features": [{"geometry": geojson(x, 0, 100)}]}
    if "overpass" in url:
        corner = lambda p: {"lon": p[0], "lat": p[1]}
        square = [corner(p) for p in ring(68, 8, 6)]
        house = {"type": "way", "id": 5, "tags": {"building": "house", "building:levels": "2"}, "geometry": square}
        halves = {"type": "relation", "id": 6, "tags": {"building": "barn"}, "members": [{"role": "outer", "geometry": square[:3]}, {"role": "outer", "geometry": square[2:]}]}
        return {"elements": [house, halves, {"type": "node", "id": 1}]}
    if "census" in url:
        assert params["in"] == "state:17"
        return [["NAME", "B25010_001E"], ["Corvane city, Illinois", "2.5"], ["Tessaly village, Illinois", "3"]]
    return answer(url, params, body, timeout)


# the tile of zoom 9 that holds the test area
QUADS = ("032000002",)


def tiles(url):
    """The index of links and a packed tile."""
    if url.endswith(".csv"):
        return io.BytesIO(("Location,QuadKey,Url\n" + "\n".join(f"Here,{q},http://x/{q}.csv.gz" for q in QUADS) + "\nFar,000000000,http://x/far.csv.gz\n").encode())
    rows = [{"type": "Feature", "properties": {"height": 7.0, "confidence": 0.5}, "geometry": geojson(30, 30, 5)}, {"type": "Feature", "properties": {"height": -1}, "geometry": geojson(900, 900, 5)}]
    return gzip.GzipFile(fileobj=io.BytesIO(gzip.compress("\n".join(map(json.dumps, rows)).encode())))


def test_microsoft_download(spark, config):
    bounds, boundary = (X0, Y0, X0 + 0.01, Y0 + 0.01), bytes(box(0, 0, 100))
    fetch = footprints.download_microsoft(spark, "http://x/links.csv", "test_pipeline:tiles")
    links = footprints.read_remote_csv(spark, "http://x/links.csv", "test_pipeline:tiles")
    assert links.columns == ["Location", "QuadKey", "Url"] and links.count() > 1
    got = footprints.load_microsoft(spark, "elsewhere", bounds, boundary, config, fetch).collect()
    assert [(r.Height_MS, r.Confidence_MS) for r in got] == [(7.0, 0.5)]
    assert footprints.state_covers(config.raw_dir / "microsoft_elsewhere.parquet", bounds)
    assert footprints.load_microsoft(spark, "elsewhere", bounds, boundary, config).count() == 1  # from the file
    assert footprints.load_microsoft(spark, "nowhere", bounds, boundary, config).count() == 0


def test_many_cities_in_one_plan(spark, tmp_path):
    """Overlapping cities: a structure may stand in both, matches stay apart."""
    c = PipelineConfig(data_dir=tmp_path / "d", output_dir=tmp_path / "o", raw_dir=tmp_path / "r", cache_dir=tmp_path / "c", use_microsoft=False,
                       parcel_sources={"corvane": {"path": str(tmp_path / "lots.geojson")}})
    c.ensure_dirs()
    both = [("o1", box(70, 10, 3)), ("o2", box(5, 5, 3)), ("o3", box(140, 10, 3))]
    for s in ("corvane", "tessaly"):
        spark.createDataFrame(both, "id string, geometry binary").write.parquet(str(c.raw_dir / f"overture_{s}_illinois_usa.parquet"))
    lots = {"type": "FeatureCollection", "crs": {"properties": {"name": "urn:ogc:def:crs:EPSG::4326"}}, "features": [{"type": "Feature", "properties": {"APN": 1}, "geometry": geojson(60, 0, 30)}]}
    (tmp_path / "lots.geojson").write_text(json.dumps(lots, indent=1))
    connectors = pipeline.Connectors(remote.geocoder(spark, "test_pipeline:many"), remote.buildings(spark, "test_pipeline:many"), remote.household_sizes("test_pipeline:many"), nsi_transport="test_pipeline:answer")
    out = pipeline.build_many_cities(spark, [("Corvane", "IL"), {"city": "Tessaly", "state": "Illinois"}], c, connectors)
    rows = {(r.City, r.StructureID): r for r in out.collect()}
    assert set(rows) == {("Corvane", "o1"), ("Corvane", "o2"), ("Tessaly", "o1"), ("Tessaly", "o3")} and out.columns == list(OUTPUT)
    a, b = rows["Corvane", "o1"], rows["Tessaly", "o1"]
    assert (a.OSMID, b.OSMID, a.StructureType, a.NumStories) == ("5", "5", "residential", 2.0)
    assert (a.ParcelID, b.ParcelID) == ("1", None)  # the lots are Corvane's
    assert (a.CensusAvgHouseholdSize, b.CensusAvgHouseholdSize, a.OccupantCount, b.OccupantCount) == (2.5, 3.0, 2.5, 3.0)
    assert a.FootprintArea_m2 == pytest.approx(b.FootprintArea_m2)
    for name, n in (("corvane_illinois_usa_structures", 2), ("structures_master", 4)):
        found = list((c.output_dir / f"{name}.parquet").glob("*.parquet"))
        assert sum(pq.read_metadata(f).num_rows for f in found) == n and all(b"geo" in pq.read_schema(f).metadata for f in found)
    again = pipeline.build_many_cities(spark, [("Corvane", "IL")], c, connectors)
    assert again.count() == 2 and sum(pq.read_metadata(f).num_rows for f in (c.output_dir / "structures_master.parquet").glob("*.parquet")) == 2
    assert pipeline.build_many_cities(spark, [], c).count() == 0


def test_vectors(spark, tmp_path):
    """Collections, lines, lone features, GeoParquet; systems; boxes."""
    feats = [{"type": "Feature", "properties": {"n": i, "t": 'a "{" é'}, "geometry": geojson(i * 10, 0, 5)} for i in range(5)]
    (tmp_path / "whole.geojson").write_text(json.dumps({"type": "FeatureCollection", "name": "x", "features": feats}))
    (tmp_path / "pretty.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": feats}, indent=2))
    (tmp_path / "lines.geojsonl").write_text("\n".join(map(json.dumps, feats)))
    (tmp_path / "one.geojson").write_text(json.dumps(feats[0], indent=2))
    for name, n in (("whole.geojson", 5), ("pretty.geojson", 5), ("lines.geojsonl", 5), ("one.geojson", 1)):
        df = attributes.read_vector(spark, str(tmp_path / name))
        assert {(r.n, r.t) for r in df.collect()} == {(str(i), 'a "{" é') for i in range(n)}
    near = (X0, Y0, X0 + 12e-4, Y0 + 1e-3)
    assert attributes.read_vector(spark, str(tmp_path / "whole.geojson"), near).count() == 2
    pieces = list(attributes.feature_texts(iter([c for c in json.dumps({"type": "FeatureCollection", "features": feats})])))
    assert [json.loads(p) for p in pieces] == feats
    # a UTM layer and a layer that names no system
    zone = kernels.utm(np.array(ring(0, 0, 10)), np.full(5, 15))
    (tmp_path / "utm.geojson").write_text(json.dumps({"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::32615"}},
                                                      "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [zone.tolist()]}}]}))
    got = wkb.read([attributes.read_vector(spark, str(tmp_path / "utm.geojson")).first().geometry])
    assert np.allclose(got.xy, np.array(ring(0, 0, 10)), atol=1e-10)
    table = pa.table({"geometry": pa.array([bytes(wkb.polygon(zone))], pa.binary())})
    pq.write_table(table, tmp_path / "bare.parquet")
    got = wkb.read([attributes.read_vector(spark, str(tmp_path / "bare.parquet"), crs="EPSG:32615").first().geometry])
    assert np.allclose(got.xy, np.array(ring(0, 0, 10)), atol=1e-10)
    meta = json.dumps({"primary_column": "geometry", "columns": {"geometry": {"crs": {"id": {"authority": "EPSG", "code": 32615}}}}})
    pq.write_table(table.replace_schema_metadata({b"geo": meta.encode()}), tmp_path / "named.parquet")
    assert attributes.footer_crs(spark, str(tmp_path / "named.parquet")) == "EPSG:32615"
    assert attributes.read_vector(spark, str(tmp_path / "named.parquet"), near).count() == 1
    web = np.stack([np.radians(-90.0) * 6378137.0 * np.ones(1), 6378137.0 * np.arcsinh(np.tan(np.radians(40.0))) * np.ones(1)], axis=1)
    assert np.allclose(kernels.degrees(web, np.array([100])), [[-90, 40]])
    with pytest.raises(ValueError):
        g.crs_code("EPSG:2277")
