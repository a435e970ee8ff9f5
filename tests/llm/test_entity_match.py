"""Matching two footprint sources: planted twins, neighbours and shifts."""

import numpy as np
from pyspark.sql import functions as F

from plotweave.functions import wkb
from plotweave.llm import entity_match as em

M = 1 / em.DEGREE_M
COLUMNS = "OvertureID string, MicrosoftID string, geometry binary, ParcelAddress string, ParcelID string, CBFIPS string, State string, FootprintArea_m2 double, id string, cell int"


def house(lon, lat, w, h):
    dx, dy = w / 2 * M / np.cos(np.radians(lat)), h / 2 * M
    return bytearray(wkb.polygon([(lon - dx, lat - dy), (lon + dx, lat - dy), (lon + dx, lat + dy), (lon - dx, lat + dy), (lon - dx, lat - dy)]))


def planted(seed=0, n=120, lon=-90.1, lat=40.1, shift=(4.0, -3.0), prefix=""):
    """A terrace of houses 9 m apart with garages behind, and their twins."""
    rng = np.random.default_rng(seed)
    rows, truth = [], set()
    for i in range(n):
        x, y, number = 9.0 * (i % 40), 60.0 * (i // 40), 2 * i
        for kind, dy, w in (("h", 0.0, 8.6), ("g", 9.0, 4.5)):
            o, m = f"o{prefix}{kind}{i}", f"m{prefix}{kind}{i}"
            address = f"{number} Oak Street, Town" if rng.random() > 0.2 else None
            other = f" {number}  OAK ST." if rng.random() > 0.2 else None
            area = w * w
            at = lambda dx, dy: (lon + dx * M / np.cos(np.radians(lat)), lat + dy * M)
            if rng.random() < 0.85:
                rows.append((o, None, house(*at(x, y + dy), w, w), address, f"P{i}", "1", "S", area))
            if rng.random() < 0.85:
                e = rng.normal(0, 0.5, 2)
                blob = None if rng.random() < 0.05 else house(*at(x + shift[0] + e[0], y + dy + shift[1] + e[1]), w * 1.02, w)
                rows.append((None, m, blob, other, f"P-{i}" if rng.random() > 0.3 else None, "1", "S", area * rng.uniform(0.85, 1.15)))
    ids = {r[0] or r[1] for r in rows}
    truth = {(f"m{x[1:]}", x) for x in ids if x[0] == "o" and f"m{x[1:]}" in ids}
    return rows, truth


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], COLUMNS)
    return {(r.microsoftid, r.overtureid): r for r in em.matches(df).collect()}


def test_planted(spark):
    a, ta = planted()
    b, tb = planted(1, lon=-180.0, lat=60.0, shift=(-3.5, 4.0), prefix="z")  # over the antimeridian
    extra = [(None, None, a[0][2], None, None, None, None, 1.0), ("lone", " ", None, None, None, None, None, None), ("o_nan", None, bytearray(b"junk" * 9), "1 X St", None, None, None, float("nan"))]
    rows = a + b + extra + a[:50]  # repeated deliveries
    got = run(spark, rows)
    truth = ta | tb
    hits = len(truth & set(got))
    assert hits / len(got) > 0.97 and hits / len(truth) > 0.93
    assert all(0 < r.confidence < 1 for r in got.values())
    assert len({k[0] for k in got}) == len({k[1] for k in got}) == len(got)


def test_heap(spark):
    """A third of all records in one place cost one comparison."""
    rows, truth = planted(2, 40)
    rows += [(f"heap{i}", None, house(-90.2, 40.2, 8, 8), None, None, None, None, 64.0) for i in range(400)]
    rows += [(None, f"peak{i}", house(-90.2 + 4 * M / np.cos(np.radians(40.2)), 40.2 - 3 * M, 8, 8), None, None, None, None, 64.0) for i in range(400)]
    got = run(spark, rows)
    assert ("peak0", "heap0") in got and len(truth & set(got)) / len(truth) > 0.85


def test_heap_members(spark):
    """All members of two heaps are paired, once each, with and without location."""
    rows, truth = planted(2, 40)
    east, south = 4 * M / np.cos(np.radians(40.2)), 3 * M
    rows += [(f"heap{i:02}", None, house(-90.2, 40.2, 8, 8), None, None, None, None, 64.0) for i in range(30)]
    rows += [(None, f"peak{i:02}", house(-90.2 + east, 40.2 - south, 8, 8), None, None, None, None, 64.0) for i in range(20)]
    rows += [(f"row{i}", None, house(-90.3, 40.3 + i * 9 * M, 8, 8), None, "L9", None, "S", 70.0) for i in range(4)]
    rows += [(None, f"sor{i}", None, None, "L-9", None, "S", 70.0) for i in range(6)]
    got = set(run(spark, rows))
    assert {k for k in got if k[0].startswith("peak")} == {(f"peak{i:02}", f"heap{i:02}") for i in range(20)}
    assert {k for k in got if k[0].startswith("sor")} == {(f"sor{i}", f"row{i}") for i in range(4)}
    assert len({k[0] for k in got}) == len({k[1] for k in got}) == len(got)
    assert len(truth & got) / len(truth) > 0.85


def test_heap_members_told_apart(spark):
    """Members whose ids are in another order meet by their parcel or address."""
    rows, truth = planted(2, 40)
    east, south = 4 * M / np.cos(np.radians(40.2)), 3 * M
    for i in range(20):
        parcel, address = (f"H{i}", None) if i % 2 else (None, f"{i + 1} Elm Street")
        rows.append((f"heap{i:02}", None, house(-90.2, 40.2, 8, 8), address, parcel, None, None, 64.0))
        rows.append((None, f"peak{19 - i:02}", house(-90.2 + east, 40.2 - south, 8, 8), address, parcel, None, None, 64.0))
    got = set(run(spark, rows))
    assert {k for k in got if k[0].startswith("peak")} == {(f"peak{19 - i:02}", f"heap{i:02}") for i in range(20)}
    assert len(truth & got) / len(truth) > 0.85


def test_empty(spark):
    assert spark.createDataFrame([], COLUMNS).transform(em.matches).count() == 0


def test_address_key(spark):
    same = ["106 Oak Street, Town", "  106  OAK ST.", "Oak Street 106, Town", "oak st 106"]
    df = spark.createDataFrame([(x,) for x in [*same, None, "Oak Street", "106", ""]], "a string")
    got = [r[0] for r in df.select(em.address_key(F.col("a"))).collect()]
    assert got == ["106 oak st"] * 4 + [None] * 4


def test_centres():
    ring = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    hole = [(0, 0), (0, 2), (2, 2), (2, 0), (0, 0)]
    two = wkb.multipolygon(wkb.polygon(ring), wkb.polygon([(x + 8, y) for x, y in ring]))
    lon, lat, area = em.centres([wkb.polygon(ring), None, two, wkb.polygon(ring, hole)])
    assert lon[[0, 2]].tolist() == [2, 6] and lat[0] == 2 and np.isnan(lon[1])
    assert np.isclose(lon[3], (16 * 2 - 4 * 1) / 12) and np.isclose(area[2] / area[0], 2)


def test_labelled_pairs_set_the_confidence(spark):
    rows, truth = planted(4, 60)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], COLUMNS)
    known = spark.createDataFrame([(o, m, k % 4 > 0) for k, (m, o) in enumerate(sorted(truth))], "overtureid string, microsoftid string, same boolean")
    got = em.matches(df, known).collect()
    trust = {r.rule: r.confidence for r in got}
    hits = [r for r in got if r.rule == "cell+address" and (r.microsoftid, r.overtureid) in truth]
    same = sum(k % 4 > 0 for k, (m, o) in enumerate(sorted(truth)) if (m, o) in {(r.microsoftid, r.overtureid) for r in hits})
    assert trust["cell+address"] == round((same + 1) / (len(hits) + 2), 6)


def test_numbers_in_pieces(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "cast(id AS string) AS id").join(spark.range(3).selectExpr("id AS g", "333L + if(id = 0, 1, 0) AS n"), "g")
    got = em.ranked(df, ["g"], "n", "id", piece_rows=50).groupBy("g").agg(F.min("nth").alias("a"), F.max("nth").alias("b"), F.count_distinct("nth").alias("c")).collect()
    assert sorted((r.g, r.a, r.b, r.c) for r in got) == [(0, 1, 334, 334), (1, 1, 333, 333), (2, 1, 333, 333)]
