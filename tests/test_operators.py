"""Proximity, drift, filling and conflation on small cases with known answers."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotweave.functions import overlay, wkb
from plotweave.operators import conflate as cf
from plotweave.operators import drift, impute, near, skew
from plotweave.operators.spatial_join import points_in_polygons
from plotweave.schema import FOOTPRINT, NSI, OSM, PARCEL, empty

D = 1 / 111_195  # about a metre in degrees of latitude


def box(x, y, w, h=None):
    h = w if h is None else h
    return bytearray(wkb.polygon([(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]))


# p2


def spatial_tables(spark, nsi, structures, parcels):
    return (
        spark.createDataFrame(nsi, "fd_id string, geometry string, leaf string"),
        spark.createDataFrame(structures, "StructureID string, geometry binary, kind string"),
        spark.createDataFrame(parcels, "ParcelID string, geometry binary, own int"),
    )


def point(x, y):
    return json.dumps({"type": "Point", "coordinates": [x, y]})


def test_nearby(spark):
    nsi = [("a", point(0, 0), None), ("b", point(0, 5 * D), None), ("b", point(0, 5 * D), None), ("c", point(0, 12 * D), None), ("d", point(0, 0), None),
           (None, point(0, 0), None), (" ", point(0, 0), None), ("e", "POINT EMPTY", None), ("f", None, None),
           ("w", point(179.99999, 10), None), ("v", "POINT (-179.99999 10)", None)]
    hole = bytearray(overlay.to_wkb([np.array([(-5, -5), (5, -5), (5, 5), (-5, 5), (-5, -5)]) * D, np.array([(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]) * D]))
    structures = [("OVT_1 ", hole, "x"), ("ovt_1", hole, "x"), ("s2", box(-2 * D, 4 * D, 4 * D), "x"), (None, box(0, 0, 1), "x"), ("s3", None, "x"), ("s4", bytearray(b"junk"), "x")]
    parcels = [("P1", box(-20 * D, -20 * D, 40 * D), 1), ("P2", box(-20 * D, -20 * D, 40 * D), 1), ("P1", box(-20 * D, -20 * D, 40 * D), 1), (None, box(0, 0, 1), 1), ("P3", box(-3 * D, -3 * D, 100 * D), 1)]
    got = {tuple(r) for r in near.nearby(*spatial_tables(spark, nsi, structures, parcels)).collect()}
    assert got == {
        ("near", "a", "b"), ("near", "a", "d"), ("near", "b", "d"), ("near", "v", "w"),
        ("structure", "b", "s2"),
        *{("parcel", q, p) for p in "abcd" for q in ("P1", "P2", "P3")},
        ("lot", "P1", "ovt_1"), ("lot", "P2", "ovt_1"), ("lot", "P1", "s2"), ("lot", "P2", "s2"), ("lot", "P3", "s2"),
    }


def test_nearby_empty(spark):
    assert near.nearby(*spatial_tables(spark, [], [], [])).count() == 0


def test_nearby_dense(spark, monkeypatch):
    """Many leaves give what one leaf gives."""
    rng = np.random.default_rng(1)
    nsi = [(f"n{i:03}", point(*(rng.random(2) * 60 * D)), None) for i in range(200)]
    structures = [(f"s{i}", box(*(rng.random(2) * 60 * D), 8 * D), "x") for i in range(60)]
    parcels = [(f"P{i}", box(*(rng.random(2) * 60 * D), 25 * D), 1) for i in range(20)]
    tables = spatial_tables(spark, nsi, structures, parcels)
    one = sorted(map(tuple, near.nearby(*tables).collect()))
    monkeypatch.setattr(near, "LEAF_OBJECTS", 12)
    assert sorted(map(tuple, near.nearby(*tables).collect())) == one and len(one) > 200


def test_hot_place(spark, monkeypatch):
    """A third of all points in one place: classes stay small, members are joined in pieces."""
    nsi = [(f"n{i:03}", point(0, 0) if i % 3 == 0 else point(i * D, 3 * D), None) for i in range(90)]
    tables = spatial_tables(spark, nsi, [(f"s{i}", box(-D, -D, 2 * D), "x") for i in range(8)], [("P", box(-2 * D, -2 * D, 9 * D), 1)])
    plain = sorted(map(tuple, near.nearby(*tables).collect()))
    monkeypatch.setattr(near, "PIECE", 4)
    assert sorted(map(tuple, near.nearby(*tables).collect())) == plain
    assert sum(r[0] == "near" for r in plain) >= 435 and sum(r[0] == "structure" for r in plain) == 240 and sum(r[0] == "lot" for r in plain) == 8
    pairs = near.near_classes(*tables).where("class_a = 'n000' and relation in ('structure', 'parcel')").collect()
    assert {(r.relation, r.class_b, r.n_a, r.n_b) for r in pairs} == {("structure", "s0", 30, 8), ("parcel", "P", 30, 1)}
    assert {(r.set, r["class"], r["count"]) for r in near.class_members(*tables).groupBy("set", "class").count().collect()} == {(0, "n000", 30), (1, "s0", 8)}


def test_sweep_of_many_vertices():
    """A polygon of 100,000 vertices among small ones, against a formula."""
    a = np.linspace(0, 2 * np.pi, 100_000)
    r = 1 + 0.3 * np.sin(7 * a)
    ring = np.stack([r * np.cos(a), r * np.sin(a)], axis=1)
    ring[-1] = ring[0]
    rng = np.random.default_rng(4)
    p = rng.random((20_000, 2)) * 3 - 1.5
    small = [box(*(rng.random(2) * 2 - 1), 0.05) for _ in range(300)]
    got_p, got_g = wkb.sweep_inside(p[:, 0], p[:, 1], wkb.read([wkb.polygon(ring), *small]), chunk=5_000)
    angle, away = np.arctan2(p[:, 1], p[:, 0]), np.hypot(p[:, 0], p[:, 1])
    clear = np.abs(away - (1 + 0.3 * np.sin(7 * angle))) > 1e-6
    inside = np.zeros(len(p), dtype=bool)
    inside[got_p[got_g == 0]] = True
    assert (inside == (away < 1 + 0.3 * np.sin(7 * angle)))[clear].all()
    want = sum(((p > (b := wkb.read([s]).bounds()[0])[:2]) & (p < b[2:])).all(axis=1).sum() for s in small)
    assert (got_g > 0).sum() == want > 200


# p3


def feeds(spark, files):
    """files: (file_id, feed, vintage, [records])"""
    head = spark.createDataFrame([(i, f, v) for i, f, v, _ in files], "file_id long, feed string, vintage int")
    rows = [(n, i, json.dumps(r) if not isinstance(r, str) else r) for i, _, _, rs in files for n, r in enumerate(rs)]
    return head, spark.createDataFrame(rows, "row_id long, file_id long, payload string").withColumn("feed", F.lit("clash"))


def test_drift(spark):
    def r(i, **more):
        return {"last_sale": 100_000 + i, "sale_year": 2001, "mail_line": "PO Box 1", "objectid": i, "remarks": None} | more

    a = [r(i, APN=4_000_000 + i, addr=f"{i} Oak St", assessed_value=200_000 + i, year_built=1950) for i in range(1, 8)]
    b = [r(i, apn=f"400-000{i}", situsaddr={"no": i, "street": "Oak St"}, market_value="$200,001" if i != 2 else "N/A", yr_built=None) for i in range(1, 8)]
    c = [r(i, apn=f"400-000{i}", addr=f"{i} Oak St", market_value=200_001.0, constr="1950-01-01") for i in range(1, 8)] + ["[1]", "{broken", None]
    head, raw = feeds(spark, [(3, "f", 202001, a), (1, "f", 202002, b), (2, "f", 202105, c), (9, "f", 202201, []), (4, None, 202001, a), (5, "g", None, a)])
    raw = raw.where("payload is not null")
    got = {(x.file_id, x.field, x.drift) for x in drift.changes(head, raw).collect()}
    assert got == {
        (1, "ParcelID", "renamed"), (1, "ParcelID", "retyped"), (1, "ParcelAddress", "renamed"), (1, "ParcelAddress", "retyped"),
        (1, "ParcelAssessedValue", "renamed"), (1, "ParcelAssessedValue", "retyped"), (1, "ParcelYearBuilt", "removed"),
        (2, "ParcelAddress", "renamed"), (2, "ParcelAddress", "retyped"), (2, "ParcelAssessedValue", "retyped"), (2, "ParcelYearBuilt", "added"),
        *{(9, f, "removed") for f in drift.FIELDS},
    }
    table = {(x.file_id, x.ParcelID, x.ParcelAddress, x.ParcelAssessedValue, x.ParcelYearBuilt) for x in drift.unified(head, raw).where("row_id = 0").collect()}
    assert (1, "4000001", "1 Oak St", 200_001.0, None) in table and (2, "4000001", "1 Oak St", 200_001.0, 1950) in table
    assert drift.changes(head.limit(0), raw.limit(0)).count() == 0


def test_tokens():
    known = drift.vocabulary(drift.GRAPH)
    tokens = lambda name: drift.tokens(name, known)
    assert tokens("totalAppraisal") == ["total", "appraisal"] and tokens("actyrblt") == ["act", "yr", "blt"]
    assert tokens("SITUSADDR") == ["situs", "addr"] and tokens("eff_dt_bld") == ["eff", "dt", "bld"]


HELD_OUT = (
    ("kavelnr", "woonplek", "taxwaarde", "bouwjr"), ("Grundstk", "Anschrift", "Schaetzung", "Baujahr"), ("cadastre", "domicilio", "avaluo", "edificado"),
    ("plotref", "where", "worth", "erected"), ("tomt_nr", "gata", "varde", "byggd"), ("gush", "rehov", "shovi", "shnat"), ("c_101", "c_102", "c_103", "c_104"), ("lote", "endereco", "preco_base", "ano"),
)


def test_names_nobody_listed(spark):
    """Recall and precision on field names that share no token with the graph:
    shapes and kinds alone carry the scores."""
    known = set(drift.vocabulary(drift.GRAPH))
    assert sum(bool(known & set(drift.tokens(n, sorted(known)))) for names in HELD_OUT for n in names) <= 3
    files, want = [], set()
    for f, names in enumerate(HELD_OUT):
        for v in range(4):
            use = HELD_OUT[(f + v) % len(HELD_OUT)]
            records = [{use[0]: f"{v + 1}0{i}-55{i}-0{i}", use[1]: f"{i + 3} Oak Lane", use[2]: [210_000 + i, f"${i + 2}10,500"][v % 2], use[3]: 1950 + i,
                        "mail_line": f"PO Box {i}", "owner": "A. Weber", "remarks": "none", "objectid": i} for i in range(1, 9)]
            files.append((f * 10 + v, f"feed{f}", 202001 + v, records))
            if v:
                want |= {(f * 10 + v, field, "renamed") for field in drift.FIELDS} | {(f * 10 + v, "ParcelAssessedValue", "retyped")}
    got = {(r.file_id, r.field, r.drift) for r in drift.changes(*feeds(spark, files)).collect()}
    assert len(got & want) / len(want) > 0.9 and len(got & want) / len(got) > 0.9


def test_long_object_keeps_its_members(spark):
    """The members of an object of 10 KB, and of every shape it comes in."""
    long = {"no": 1, "street": "Oak St", "note": "x" * 10_000}
    head, raw = feeds(spark, [(1, "f", 202001, [{"place": long}, {"place": {"no": 2, "street": "Elm St", "zip": "1"}}, {"place": [1, 2]}])])
    row = drift.signatures(raw).first()
    assert row["columns"][0].members == ["no", "note", "street", "zip"] and row["columns"][0].kind == "object"
    assert [(r.field, r.key) for r in drift.correspondences(raw).collect()] == [("ParcelAddress", "place")]


def test_unsettled_scores_are_an_error():
    node = {"name": "a", "token": {"built": 1.0}, "kind": {"number": 1.0}, "shape": {"year": 1.0}, "member": {}}
    assert drift.Flooding().match([node]) == {"ParcelYearBuilt": 0}
    with pytest.raises(RuntimeError):
        drift.Flooding(most=1).match([node])


# p4


def test_filled_cells(spark):
    m = impute.METHODS[0]
    rows = [
        (1, "010", 2.0, 10.0, m, 100.0), (2, "10.0", None, None, "tbd", 100.0), (3, "10", 999.0, 0.0, None, 100.0), (4, "10", 5.0, 0.0, m, 900.0),
        (5, None, None, None, None, 1.0), (6, "77", None, None, None, 1.0), (7, "10", float("nan"), 60_000.0, m, 890.0),
    ]
    df = spark.createDataFrame(rows, "record_id long, CBFIPS string, NumStories double, OccupantCount double, OccupantCountMethod string, FootprintArea_m2 double")
    df = df.withColumns({c: F.lit(None).cast("double") for c in ("HeightM", "NumUnits")}).withColumns({"block": F.lit("x"), "field": F.lit("y")})
    got = {(r.record_id, r.field): r for r in impute.filled_cells(df).collect()}
    assert set(got) == {(2, "NumStories"), (3, "NumStories"), (7, "NumStories"), (2, "OccupantCount"), (3, "OccupantCount"), (7, "OccupantCount"),
                        (2, "OccupantCountMethod"), (3, "OccupantCountMethod")}
    assert all(r.was_filled and r.donor_record_id in (1, 4) for r in got.values())
    assert got[2, "NumStories"].donor_record_id == 1 and got[7, "NumStories"].donor_record_id == 4  # the alike footprint
    table = {r.record_id: r for r in impute.filled_table(df).collect()}
    assert table[2].NumStories == 2.0 and table[1].NumStories_filled_from is None and len(table) == 7
    assert impute.filled_cells(df.limit(0)).count() == 0


def test_hot_block(spark):
    """One block with most rows: all gaps filled, donors stay a short list."""
    df = spark.range(4000).selectExpr(
        "id AS record_id", "if(id % 3 = 0, '7', cast(1000 + id % 50 AS string)) AS CBFIPS", "if(id % 4 = 0, null, cast(1 + id % 9 AS double)) AS NumStories",
        "cast(id % 100 AS double) AS OccupantCount", f"'{impute.METHODS[1]}' AS OccupantCountMethod", "cast(50 + id % 977 AS double) AS FootprintArea_m2",
        "cast(null AS double) AS HeightM", "cast(null AS double) AS NumUnits")
    got = impute.filled_cells(df).groupBy("field").count().collect()
    assert {r.field: r["count"] for r in got} == {"NumStories": 1000}


def test_frequent_prediction(spark, monkeypatch):
    """A third of all rows without any predictor, in one block: same result either way."""
    df = spark.range(900).selectExpr(
        "id AS record_id", "if(id % 3 = 0, '7', cast(1000 + id % 49 AS string)) AS CBFIPS", "if(id % 2 = 0, null, cast(1 + id % 9 AS double)) AS NumStories",
        "cast(id % 100 AS double) AS OccupantCount", f"'{impute.METHODS[1]}' AS OccupantCountMethod", "if(id % 3 = 0, null, cast(50 + id % 977 AS double)) AS FootprintArea_m2",
        "cast(null AS double) AS HeightM", "cast(null AS double) AS NumUnits")
    # sums in another order move the last digits of a distance
    rows = lambda: sorted((r.record_id, r.field, r.value, r.donor_record_id, round(r.distance, 9)) for r in impute.filled_cells(df).collect())
    plain = rows()
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    monkeypatch.setattr(impute, "FEW_BLOCKS", 3)
    assert rows() == plain and len(plain) == 450


def test_nearest_donor_of_all(spark, monkeypatch):
    """Every donor is searched, also with an outlier and with blocks in ranges."""
    df = spark.range(3000).selectExpr(
        "id AS record_id", "if(id % 3 = 0, '7', cast(10 + id % 5 AS string)) AS CBFIPS",
        "if(id % 4 = 0, null, if(id = 1, 200D, cast(1 + id * 7 % 5 AS double))) AS NumStories", "cast(id % 50 AS double) AS OccupantCount",
        f"'{impute.METHODS[1]}' AS OccupantCountMethod", "if(id % 11 = 0, null, exp(cast(id * 7919 % 3001 AS double) / 400)) AS FootprintArea_m2",
        "if(id % 2 = 0, null, cast(3 + id * 31 % 17 AS double)) AS HeightM", "cast(null AS double) AS NumUnits")
    seen = {}
    whole = impute.nearest_donors

    def watch(guesses, ranges):
        seen.update(split=ranges is not None, rows=guesses.collect())
        return whole(guesses, ranges)

    monkeypatch.setattr(impute, "nearest_donors", watch)
    for hot in (20_000, 300):
        monkeypatch.setattr(impute, "HOT_ROWS", hot)
        got = impute.filled_cells(df).collect()
        assert seen["split"] == (hot == 300) and len(got) == 750
        donors = {}
        for r in seen["rows"]:
            if r.d:
                donors.setdefault(tuple(r.group), []).append((r.guess, r.d.record_id))
        at = {r.record_id: r.distance for r in got}
        want = {}
        for r in seen["rows"]:
            if r.asked:
                want.setdefault(tuple(r.group), set()).add(min((abs(g - r.guess), g, i) for g, i in donors[tuple(r.group)])[::2])
        blocks = {r.record_id: r.CBFIPS for r in df.collect()}
        for r in got:
            assert (at[r.record_id], r.donor_record_id) in want[int(blocks[r.record_id]), r.field]
        assert max(len(v) for v in donors.values()) > 600 and len({r.donor_record_id for r in got}) > 300


def test_predictions_against_least_squares(spark):
    """Values, donors and distances from a regression of its own in NumPy."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(240):
        area, height = float(np.exp(rng.normal(5, 0.6))), None if rng.random() < 0.3 else float(np.exp(rng.normal(2, 0.4)))
        stories = None if rng.random() < 0.3 else float(max(1, round(area / 90 + rng.normal(0, 0.7))))
        rows.append((i, str(1 + i % 3), stories, 5.0, impute.METHODS[0], area, height, None))
    df = spark.createDataFrame(rows, "record_id long, CBFIPS string, NumStories double, OccupantCount double, OccupantCountMethod string, FootprintArea_m2 double, HeightM double, NumUnits double")
    got = {r.record_id: (float(r.value), r.donor_record_id, r.distance) for r in impute.filled_cells(df).where("field = 'NumStories'").collect()}
    known = [r for r in rows if r[2] is not None]
    overall = np.mean([r[2] for r in known])
    mean = {b: (sum(r[2] for r in known if r[1] == b) + impute.SHRINK * overall) / (sum(r[1] == b for r in known) + impute.SHRINK) for b in "123"}

    def x(r):
        return [1.0, mean[r[1]], np.log(r[5]), 0.0, np.log(r[6]) if r[6] else 0.0, float(r[6] is None), 0.0, 1.0]

    a, y = np.array([x(r) for r in known]), np.array([r[2] for r in known])
    k = a.shape[1]
    beta = np.linalg.solve(a.T @ a + 1e-3 * (np.trace(a.T @ a) / k + 1) * np.eye(k), a.T @ y)
    guess = {r[0]: float(np.dot(x(r), beta)) for r in rows}
    assert len(got) == 240 - len(known) > 40
    for i, (value, donor, away) in got.items():
        best = min((abs(guess[r[0]] - guess[i]), guess[r[0]], r[0], r[2]) for r in known if r[1] == rows[i][1])
        assert away == pytest.approx(best[0], abs=1e-9) and (donor, value) == (best[2], best[3])


def test_twin_is_the_donor(spark):
    """A recipient like exactly one donor copies it, whatever the outliers."""
    df = spark.range(400).selectExpr(
        "id AS record_id", "'7' AS CBFIPS", "if(id % 2 = 0, if(id = 0, 200D, cast(1 + (id div 2) % 9 AS double)), null) AS NumStories",
        "1D AS OccupantCount", f"'{impute.METHODS[1]}' AS OccupantCountMethod", "exp(cast(id div 2 AS double) / 50) AS FootprintArea_m2",
        "cast(null AS double) AS HeightM", "cast(null AS double) AS NumUnits")
    got = impute.filled_cells(df).where("field = 'NumStories'").collect()
    assert len(got) == 200 and all(r.donor_record_id == r.record_id - 1 and r.distance == 0 for r in got)


# conflation


def footprints(spark, rows):
    return spark.createDataFrame(rows, "StructureID string, geometry binary, x string")


def test_merge(spark):
    a = footprints(spark, [("a", box(0, 0, 2), "")])
    b = footprints(spark, [("in", box(0.5, 0.5, 0.5), ""), ("out", box(5, 5, 1), ""), ("none", None, "")])
    ids = lambda df: sorted(r.StructureID for r in df.collect())
    assert ids(cf.merge_footprints(a, b, cell=1.0)) == ["a", "none", "out"]
    assert ids(cf.merge_footprints(a, b, add_unmatched=False)) == ["a"]
    assert ids(cf.merge_footprints(empty(spark, FOOTPRINT), b, add_unmatched=False)) == ["in", "none", "out"]
    assert cf.merge_footprints(empty(spark, FOOTPRINT), empty(spark, FOOTPRINT)).columns == list(FOOTPRINT)


def test_attach(spark):
    base = footprints(spark, [("a", box(0, 0, 2), "k"), ("b", box(9, 9, 1), "k"), ("c", box(1, 1, 2), "k")]).withColumn("Height_OSM", F.lit(7.0))
    osm = spark.createDataFrame([("10", "house", None, box(-1, -1, 9)), ("9", "barn", 3.0, box(-1, -1, 9))], "OSMID string, OSM_StructureType string, Height_OSM double, geometry binary")
    got = {r.StructureID: r for r in cf.attach_osm(base, osm, 2.0).collect()}
    assert (got["a"].OSMID, got["a"].Height_OSM, got["b"].OSMID, got["b"].Height_OSM, got["a"].x) == ("9", 3.0, None, 7.0, "k")
    nsi = spark.createDataFrame(
        [("2", "B", 1.0, None, 0.5, 0.5), ("1", "A", 4.0, 3.0, 1.5, 1.5), (None, "A", None, None, 1.6, 1.6), ("3", "B", 2.0, 1.0, 2.0, 0.5)],
        "fd_id string, occtype string, num_story double, resunits double, x double, y double")
    got = {r.StructureID: r for r in cf.attach_inventory(base, nsi, 2.0).collect()}
    a, c, b = got["a"], got["c"], got["b"]
    assert (a.NSI_FD_ID, a.NSI_RecordCount, a.NSI_OccType, a.NSI_NumStory, a.NSI_ResUnits) == ("1", 2, "A", 2.5, 3.0)  # the point on the edge is out
    assert (c.NSI_FD_ID, c.NSI_RecordCount, b.NSI_RecordCount) == ("1", 1, None)
    parcels = spark.createDataFrame([("P1", 9.0, "s", box(-1, -1, 5)), ("P2", None, "s", box(-1, -1, 5)), ("P0", 9.0, None, box(-1, -1, 5))], "ParcelID string, ParcelArea_m2 double, ParcelSource string, geometry binary")
    got = {r.StructureID: r for r in cf.attach_parcels(base, parcels, 2.0).collect()}
    assert (got["a"].ParcelID, got["a"].ParcelMatchMethod, got["b"].ParcelID) == ("P0", None, None)
    for attach, schema in ((cf.attach_osm, OSM), (cf.attach_parcels, PARCEL)):
        assert attach(base, empty(spark, schema)).count() == 3
    assert cf.attach_inventory(base, empty(spark, NSI | {"x": "double", "y": "double"})).count() == 3


def test_either_side_may_be_copied(spark):
    """Random boxes of all sizes and points: both keyings give the brute-force pairs."""
    rng = np.random.default_rng(8)
    boxes = [(i, *(rng.random(2) * 40 - 20), float(10 ** rng.uniform(-2, 1.3))) for i in range(150)]
    pts = [(k, *map(float, rng.random(2) * 40 - 20)) for k in range(300)]
    polygons = cf.with_rings(spark.createDataFrame([(i, box(float(x), float(y), w)) for i, x, y, w in boxes], "i int, geometry binary"))
    points = spark.createDataFrame(pts, "k int, x double, y double")
    want = sorted((k, i) for k, px, py in pts for i, x, y, w in boxes if x < px < x + w and y < py < y + w)
    for narrow in (False, True):
        got = sorted((r.k, r.i) for r in points_in_polygons(points, polygons, 0.5, narrow_points=narrow).collect())
        assert got == want and len(want) > 300


def test_best_overlap(spark):
    base = footprints(spark, [("a", box(0, 0, 2), ""), ("b", box(10, 10, 1), "")])
    cand = spark.createDataFrame([(2, box(1, 0, 2)), (1, box(-1, 0, 2)), (3, box(0, 0, 0.5)), (4, box(2, 0, 2))], "oid int, geometry binary")
    got = [tuple(r) for r in cf.best_overlap(base, cand, ["oid"], cell=1.0, metres=False).collect()]
    assert got == [("a", 1, 2.0, 0.5)]
    assert cf.best_overlap(base, cand, ["oid"], least_ratio=0.6, cell=1.0, metres=False).count() == 0


def test_best_overlap_in_metres(spark):
    base = footprints(spark, [("a", box(3.0, 40.0, 20 * D), "")])
    cand = spark.createDataFrame([(1, box(3.0 + 10 * D, 40.0, 20 * D)), (2, None)], "oid int, geometry binary")
    got = cf.best_overlap(base, cand, ["oid"]).first()
    assert got.overlap_area == pytest.approx(10 * 20 * np.cos(np.radians(40)), rel=5e-3) and got.overlap_ratio == pytest.approx(0.5, abs=1e-6)


def test_tile_dedup(spark):
    df = spark.createDataFrame([(0, "a", 1), (0, "a", 2), (1, "a", 3), (1, None, 4), (2, None, 5), (2, "b", 6)], "tile int, fd_id string, n int")
    assert sorted(r.n for r in cf.dedup_across_tiles(df).collect()) == [1, 2, 4, 5, 6]


@pytest.mark.parametrize("name", ["footprint_merge", "inventory_attach", "parcel_attach", "best_overlap", "osm_attach"])
def test_join_plans(spark, tiny, name):
    from plotweave.registry import QUERIES

    plan = QUERIES[name](spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and all("=" in line for line in plan.splitlines() if "Join Inner" in line)
