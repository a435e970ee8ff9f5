"""Fusion of repeated records."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plotweave.llm import best_record as br

COLUMNS = ("record_id long, StructureID string, NumStories double, NumStoriesSource string, NumUnits double, NumUnitsSource string, "
           "StructureTypeRaw string, StructureTypeSource string, observed_at timestamp, entity string, field int")  # fmt: skip
T = [None, *(datetime(2020, 1, d) for d in range(1, 10))]
NAN = float("nan")


def rows(spark, data):
    return spark.createDataFrame([(*r, "clash", 1) for r in data], COLUMNS)


def test_cells(spark):
    df = rows(spark, [
        (1, "A ", 3.0, "nsi", NAN, "osm", " ", "osm", T[5]),
        (2, "\ta", 201.0, "osm", 2.0, "legacy", "barn", None, T[1]),
        (3, "a", 4.0, "N-S I", 0.0, "osm", "Barn ", "?", T[9]),
        (4, "a", 5.0, "nsi", 2.0, None, "barn", "", T[9]),
        (5, "b", 1.0, "osm", 1.0, "osm", "x", "osm", T[1]),
        (6, None, 1.0, "osm", 1.0, "osm", "x", "osm", T[1]), (7, "  ", 1.0, "osm", 1.0, "osm", "x", "osm", T[1]), (8, "  ", 1.0, "osm", 1.0, "osm", "x", "osm", T[1]),
        (9, "c", 2.0, "osm", None, None, None, None, T[0]), (10, "c", 3.0, "O S_M", None, None, None, None, T[1]), (11, "c", 3.0, "osm", None, None, None, None, T[1]),
    ])
    assert {tuple(r) for r in br.best_cells(df).collect()} == {
        ("a", "NumStories", 3), ("a", "NumUnits", 4), ("a", "StructureTypeSource", 3), ("c", "NumStories", 10)}
    assert br.best_cells(df.limit(0)).count() == 0 and br.best_records(df.limit(0)).count() == 0


def test_votes_can_outvote(spark):
    df = rows(spark, [(i, "a", v, s, None, None, None, None, T[t]) for i, v, s, t in ((1, 9.0, "osm", 5), (2, 2.0, "overture", 5), (3, 2.0, "overture", 4), (4, 2.0, "overture", 6), (5, 2.0, "overture", 7), (6, 2.0, "nsi", 7))])
    voted = br.best_records(df).first()
    assert (voted.NumStories, voted.NumStories_from, voted.n_rows, voted.NumUnits) == ("2.0", 5, 6, None)
    assert br.best_cells(df).first().record_id == 1  # the steep limit doesn't count heads


def test_hot_entity(spark):
    df = spark.range(9000).select(
        F.col("id").alias("record_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("StructureID"),
        F.lit(2.0).alias("NumStories"), F.lit("osm").alias("NumStoriesSource"), F.lit(1.0).alias("NumUnits"), F.lit("nsi").alias("NumUnitsSource"),
        F.lit("barn").alias("StructureTypeRaw"), F.lit("osm").alias("StructureTypeSource"), F.lit(None).cast("timestamp").alias("observed_at"),
    )
    got = {(r.structureid, r.field): r.record_id for r in br.best_cells(df).collect()}
    assert got["hot", "NumStories"] == 0 and len(got) == 3 * 501


def test_decay_decides(spark):
    """Three old osm rows against two recent nsi rows: the half-life decides."""
    df = rows(spark, [(i, "a", v, s, None, None, None, None, datetime(y, 1, 1)) for i, v, s, y in ((1, 9.0, "osm", 2001), (2, 9.0, "osm", 2001), (3, 9.0, "osm", 2001), (4, 2.0, "nsi", 2020), (5, 2.0, "nsi", 2021))])
    pick = lambda h: br.best_records(df, half_life_days=h).first().NumStories
    assert (pick(730.0), pick(36_500.0)) == ("2.0", "9.0")
    with pytest.raises(ValueError):
        br.best_records(df, half_life_days=3.0)
    assert br.best_cells(df).first().record_id == 1


def test_votes_are_summed(spark):
    """The best row's vote outweighs all others together, and equal rows add up."""
    data = [(i, "a", float(1 + i % 3), "nsi", None, None, None, None, T[1 + i % 2]) for i in range(40)]
    df = br.keyed(rows(spark, data), F.lower("StructureID"))
    best = df.join(br.best_rows(df, br.structure_fields()), "_entity")
    votes = br.long_rows(best, br.structure_fields(), br.steep_votes(best)).where("vote is not null").groupBy("same").agg(F.sum("vote").alias("v")).orderBy(F.desc("v")).collect()
    assert votes[0].v >= 1 > sum(r.v for r in votes[1:]) and votes[0].same == "2.0"  # record 1: the latest time, smallest id


def test_hot_entities_are_summed_in_place(spark, monkeypatch):
    data = [(i, "hot" if i % 3 else f"s{i % 40}", float(1 + i % 7), ("osm", "nsi", None)[i % 3], 1.0, "osm", "barn", "osm", T[i % 9]) for i in range(600)]
    df = rows(spark, data)
    plain = sorted(map(tuple, br.best_cells(df).collect()))
    monkeypatch.setattr(br, "HOT_ROWS", 100)
    assert sorted(map(tuple, br.best_cells(df).collect())) == plain and ("hot", "NumStories") in {r[:2] for r in plain}
