"""Geometry kernels: properties and brute force."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plotweave.functions import geometry as g
from plotweave.functions import overlay, wkb
from plotweave.operators import near
from plotweave.operators.spatial_join import boxes_meet, points_in_polygons
from plotweave.operators.conflate import with_rings


def square(x, y, w, h=None):
    h = w if h is None else h
    return np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)], float)


def star(seed, n=7):
    rng = np.random.default_rng(seed)
    a = np.sort(rng.random(n)) * 2 * np.pi
    c, r = rng.random(2) * 2, 0.3 + rng.random(n)
    p = np.c_[c[0] + r * np.cos(a), c[1] + r * np.sin(a)]
    return np.vstack([p, p[:1]])


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(0, 10_000))
def test_shared_area(a, b):
    x, y = [star(a)], [star(b, 6)]
    if overlay.crosses_itself(x) or overlay.crosses_itself(y):
        return
    area = overlay.shared_area(x, y)
    assert area == pytest.approx(overlay.shared_area(y, x), abs=1e-9)
    clipped = overlay.Clipper(y).clip(x)
    assert area == pytest.approx(sum(abs(overlay.signed_area(r)) for r in clipped), abs=1e-9)
    assert area <= min(overlay.region_area(x), overlay.region_area(y)) + 1e-9
    assert overlay._inside(*overlay.inner_point(x), x)
    turned = [np.vstack([x[0][3:-1], x[0][:4]])[::-1]]
    assert overlay.region_area(turned) == pytest.approx(overlay.region_area(x))


def test_holes_and_repair():
    ring = [square(0, 0, 4), square(1, 1, 2)]
    assert overlay.region_area(ring) == 12
    assert overlay.shared_area(ring, [square(0.5, 0.5, 2)]) == pytest.approx(1.75)
    back = overlay.polygons([overlay.to_wkb(ring)])[0]
    assert overlay.region_area(back) == 12 and len(back) == 2
    bow = overlay.repaired([np.array([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)], float)])
    assert overlay.region_area(bow) == pytest.approx(2)
    assert overlay.inner_point([square(0, 0, 2, 4)]) == (1, 2)
    assert overlay.to_wkb([]) is None and overlay.polygons([None, b"", b"\x01\x03"]) == [None] * 3
    both = overlay.united([[square(0, 0, 2)], [square(1, 1, 2)]])
    assert sum(abs(overlay.signed_area(r)) for r in both) == pytest.approx(7)


def test_sweep_against_brute_force():
    rng = np.random.default_rng(0)
    blobs = [None, b"x" * 30] + [overlay.to_wkb([star(i)]) for i in range(30)]
    blobs += [wkb.multipolygon(*(wkb.polygon(square(x, x, 1).tolist()) for x in (0, 2)))]
    blobs += [wkb.polygon([(179.9, 0), (-179.9, 0), (-179.9, 1), (179.9, 1), (179.9, 0)])]
    px, py = np.r_[rng.random(400) * 4 - 1, 179.95, -179.95], np.r_[rng.random(400) * 4 - 1, 0.5, 0.5]
    rings = wkb.read(blobs)
    got = set(zip(*(v.tolist() for v in wkb.sweep_inside(px, py, rings, chunk=500))))
    want = set()
    for k, region in enumerate(overlay.polygons(blobs)):
        if region is None or k == len(blobs) - 1:
            continue
        want |= {(p, k) for p in range(400) if overlay._inside(px[p], py[p], region)}
    assert got == want | {(400, len(blobs) - 1), (401, len(blobs) - 1)}
    edge = wkb.sweep_inside(np.array([0.0, 0.5, 0.5]), np.array([0.5, 0.0, 0.5]), wkb.read([wkb.polygon(square(0, 0, 1).tolist())]))
    assert edge[0].tolist() == [2]  # edges are outside


def test_reader_knows_dialects():
    flat = wkb.polygon(square(0, 0, 1).tolist())
    import struct

    big = b"\x00" + struct.pack(">II", 3, 1) + struct.pack(">I", 5) + b"".join(struct.pack(">dd", *p) for p in square(0, 0, 1))
    z = b"\x01" + struct.pack("<II", 1003, 1) + struct.pack("<I", 5) + b"".join(struct.pack("<ddd", *p, 9) for p in square(0, 0, 1))
    srid = b"\x01" + struct.pack("<III", 3 | 0x20000000, 4326, 1) + flat[9:]
    point = b"\x01" + struct.pack("<Idd", 1, 1, 2)
    mixed = b"\x01" + struct.pack("<II", 7, 2) + point + flat
    for blob in (flat, big, z, srid, mixed):
        assert overlay.region_area(overlay.polygons([blob])[0]) == 1
    assert overlay.polygons([point, flat[:-3], wkb.polygon([(0, 0), (math.nan, 1), (1, 1), (0, 0)])]) == [None] * 3


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000), st.integers(0, 60), st.sampled_from([1, 3, 16]))
def test_pairs_within(seed, n, bucket):
    rng = np.random.default_rng(seed)
    v = near.unit_vectors(rng.random(n) * 0.001 - 180, rng.random(n) * 0.001)
    v[: n // 3] = v[: n // 3][:1] if n >= 3 else v[: n // 3]  # a heap of equal points
    r = near.chord(30)
    i, j = near.pairs_within(v, r, bucket)
    want = {(a, b) for a in range(n) for b in range(a + 1, n) if np.linalg.norm(v[a] - v[b]) <= r}
    assert sorted(zip(i.tolist(), j.tolist())) == sorted(want)


def test_leaves_cover_every_pair():
    rng = np.random.default_rng(3)
    v = near.unit_vectors(rng.random(500) * 0.01, rng.random(500) * 0.01)
    r = near.chord(40)
    who, leaf, own = near.KDSplits(v[::5], 16).leaves(v, np.full(500, r))
    assert np.bincount(who[own], minlength=500).tolist() == [1] * 500
    held = {(w, x) for w, x in zip(who.tolist(), leaf.tolist())}
    home = dict(zip(who[own].tolist(), leaf[own].tolist()))
    i, j = near.pairs_within(v, r)
    assert len(i) and all((b, home[a]) in held and (a, home[b]) in held for a, b in zip(i.tolist(), j.tolist()))


def test_points_of_all_notations(spark):
    texts = ['{"type":"Point","coordinates":[-71.5,44.1]}', '{"coordinates": [-71.5, 44.1, 15.0], "type": "Point"}', "POINT (-71.5 44.1)", "SRID=4326;Point(-71.5  44.1)",
             '{"type":"Feature","properties":{"z":[6,1]},"geometry":{"type":"Point","coordinates":[-71.5,44.1]}}',
             "", None, "null", "POINT EMPTY", '{"type":"Point","coordinates":[]}', "POINT (1 95)", "{broken"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [(r[0], r[1]) for r in near.with_point(df, "t").orderBy("i").select("lon", "lat").collect()]
    assert got == [(-71.5, 44.1)] * 5 + [(None, None)] * 7


@pytest.mark.parametrize("cell", [0.3, 1.0, 50.0])
def test_grid_joins_do_not_depend_on_the_cell(spark, cell):
    blobs = [(i, bytearray(overlay.to_wkb([star(i) * (1 if i % 3 else 6)]))) for i in range(40)]
    rng = np.random.default_rng(5)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.random((150, 2)) * 6 - 1)]
    polygons = with_rings(spark.createDataFrame(blobs, "id int, geometry binary"))
    points = spark.createDataFrame(pts, "p int, x double, y double")
    got = {(r.p, r.id) for r in points_in_polygons(points, polygons.select("id", "rings", "bbox"), cell).collect()}
    regions = overlay.polygons([bytes(b) for _, b in blobs])
    assert got == {(p, i) for p, x, y in pts for i, r in enumerate(regions) if overlay._inside(x, y, r)}
    pairs = boxes_meet(polygons.select(F.col("id").alias("a"), "bbox"), polygons.select(F.col("id").alias("b"), "bbox"), cell).select("a", "b").collect()
    box = [(r[0][:, 0].min(), r[0][:, 1].min(), r[0][:, 0].max(), r[0][:, 1].max()) for r in regions]
    want = sorted((i, j) for i, a in enumerate(box) for j, b in enumerate(box) if max(a[0], b[0]) < min(a[2], b[2]) and max(a[1], b[1]) < min(a[3], b[3]))
    assert sorted((r.a, r.b) for r in pairs) == want


def test_no_nested_loops(spark):
    polygons = with_rings(spark.createDataFrame([(1, bytearray(overlay.to_wkb([square(0, 0, 1)])))], "id int, geometry binary")).select("id", "rings", "bbox")
    plan = points_in_polygons(spark.createDataFrame([(1, 0.5, 0.5)], "p int, x double, y double"), polygons, 1.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = points_in_polygons(spark.createDataFrame([(1, 0.5, 0.5)], "p int, x double, y double"), polygons.limit(0), 1.0)
    assert none.count() == 0


def test_small_estimates_are_not_broadcast(spark):
    """What a table's files promise says little of its rows in the cells."""
    box = F.struct(*[F.lit(v).alias(c) for c, v in (("xmin", 0.0), ("ymin", 0.0), ("xmax", 1.0), ("ymax", 1.0))])
    polygons = spark.range(1).select("id", box.alias("bbox"), g.rectangle(*map(F.lit, (0.0, 0.0, 1.0, 1.0))).alias("rings"))
    points = spark.range(1).selectExpr("id AS p", "0.5D AS x", "0.5D AS y")
    joins = points_in_polygons(points, polygons, 1.0), boxes_meet(polygons.select("id", "bbox"), polygons.select(F.col("id").alias("b"), "bbox"), 1.0)
    assert all("Broadcast" not in j._jdf.queryExecution().executedPlan().toString() and j.count() == 1 for j in joins)


def test_utm_and_tiles(spark):
    df = spark.createDataFrame([(-87.6, 41.85, 0.001)], "x double, y double, d double")
    rings = g.rectangle(F.col("x"), F.col("y"), F.col("x") + F.col("d"), F.col("y") + F.col("d"))
    got = df.select(g.utm_area(rings, F.lit(16)).alias("a"), *[c.alias(n) for n, c in zip("en", g.utm(F.lit(-87.0), F.lit(0.0), F.lit(16)))]).first()
    assert got.a == pytest.approx(111.07 * 82.97, rel=2e-3) and (got.e, got.n) == (500000, 0)
    east, north = df.select(*g.utm(F.lit(-75.0), F.lit(40.5), F.lit(18))).first()  # central meridian: scaled meridian arc
    assert east == 500000 and north == pytest.approx(0.9996 * 4484944.0, abs=500)
    one = spark.createDataFrame([(-180.0, -85.0, 180.0, 85.0)], "xmin double, ymin double, xmax double, ymax double")
    assert sorted(r[0] for r in g.quadkeys_for_bounds(one, 1).collect()) == ["0", "1", "2", "3"]
    tile = spark.createDataFrame([(0.0, 0.0, 0.1, 0.05)], "xmin double, ymin double, xmax double, ymax double")
    assert [tuple(r) for r in g.boundary_tiles(tile, 0.08).orderBy("tile").collect()] == [(0, 0.0, 0.0, 0.08, 0.05), (1, 0.08, 0.0, 0.1, 0.05)]
