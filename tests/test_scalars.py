"""Scalars, configuration and rules against the quirks they must keep."""

import pytest
from pyspark.sql import functions as F

from plotweave import config
from plotweave.functions import rules, scalars
from plotweave.functions.text import block_number, entity_key, not_blank
from plotweave.schema import OUTPUT, empty


def values(spark, expression, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_safe_number(spark):
    got = values(spark, scalars.safe_number, [" 12 ", "3d", "1_0", "1,000", "", None, "0x10", "nan", "-2.5e1", ".5", "+7."])
    assert got == [12.0, None, None, None, None, None, None, None, -25.0, 0.5, 7.0]
    assert values(spark, scalars.safe_number, ["inf", "-Infinity"]) == [float("inf"), float("-inf")]


def test_height(spark):
    got = values(spark, scalars.height_m, ["12' 6\"", "10,5", "-5 ft", "1.2.3 m", ".", "30 FT", " 4 m", "abc", None, "7 feet"])
    assert got[0] == pytest.approx(3.6576) and got[5] == pytest.approx(9.144) and got[9] == pytest.approx(2.1336)
    assert got[1] == 10.0 and got[6] == 4.0 and [got[i] for i in (2, 3, 4, 7, 8)] == [None] * 5


def test_names(spark):
    assert values(spark, scalars.place_name, ["Kansas City, Missouri", "St. Paul city", None]) == ["kansas", "st paul", None]
    assert values(spark, scalars.slugify, ["Chicago, Illinois!", "", None, "--"]) == ["chicago_illinois", "place", "place", "place"]
    assert values(spark, scalars.state_name, ["il", " TX ", "Ohio ", "ZZ", None]) == ["Illinois", "Texas", "Ohio", "ZZ", None]
    assert config.slug("St. Louis", None, "MO") == "st_louis_mo" and config.slug() == "place"
    assert config.full_state(" ny ") == "New York" and len(config.STATE_FIPS) == 51


def test_rounding_is_half_even(spark):
    got = values(spark, scalars.stories_from_height, [3.05 * 2.5, 3.05 * 3.5, 0.1, 9999.0, None], "double")
    assert got == [2.0, 4.0, 1.0, 200.0, None]


def test_structure_types(spark):
    raw = ["kindergarten", "restaurant", "RES5", "GOV1", None, "multi-family", "Condo house", "windmill", "COM6"]
    assert values(spark, rules.structure_type, raw) == [
        "industrial", "residential", "residential", "unknown", "unknown", "apartment", "condo", "industrial", "commercial"]


def test_first_with_source(spark):
    df = spark.createDataFrame([(" ", "x", 1.0), (None, None, float("nan")), (" a ", "x", None)], "a string, b string, n double")
    v, s = scalars.first_with_source(df, [("a", "A"), ("gone", "G"), ("b", "B")], "string")
    n, m = scalars.first_with_source(df, [("n", "N")], "double")
    assert [tuple(r) for r in df.select(v, s, n, m).collect()] == [("x", "B", 1.0, "N"), (None, None, None, None), (" a ", "A", None, None)]
    v, s = scalars.first_with_source(df, [("gone", "G")], "double")
    assert df.select(v, s).first()[0] is None


def test_text_keys(spark):
    assert values(spark, block_number, ["060010400001049", "60010400001049.0", " 7 ", "", None, "x1", "1.5"]) == [60010400001049, 60010400001049, 7, None, None, None, None]
    assert values(spark, entity_key, ["\tOVT_a ", "", "  ", None]) == ["ovt_a", None, None, None]
    assert values(spark, not_blank, ["a", "\t\n ", None]) == [True, False, False]


def test_config():
    assert config.parse_place("Washington, D.C., DC") == ("Washington, D.C.", "DC")
    assert config.parse_parcel_source("a=http://b=c") == ("a", {"url": "http://b=c"})
    for bad in ("nowhere", "x,"):
        with pytest.raises(ValueError):
            config.parse_place(bad)
    sources = {"chicago_illinois_usa": "/p", "chicago": {"url": "u"}}
    assert config.resolve_source(sources, "Chicago", "IL") == {"path": "/p"}
    assert config.resolve_source({"Chicago, IL": "HTTP://x"}, "Chicago", "IL") == {"url": "HTTP://x"}
    assert config.resolve_source({}, "Chicago", "IL") is None
    assert config.source_digest({"b": 1, "a": "x"}) == config.source_digest({"a": "x", "b": 1}) != config.source_digest({"a": "y", "b": 1})


def test_finalize(spark):
    base = spark.createDataFrame(
        [("a", "house", None, 0.0, None, 2.0), ("b", None, None, None, 3.0, None), ("c", "apartments", 4.0, None, None, None)],
        "StructureID string, OSM_StructureType string, Units_OSM double, NSI_Pop2AM double, NSI_EmpNum double, NSI_Students double",
    )
    rows = {r.StructureID: r for r in rules.finalize(base, "Corvane", "IL", household=2.5, household_source="s").collect()}
    assert list(rows["a"].asDict()) == list(OUTPUT) and len(OUTPUT) == 44
    assert (rows["a"].NumUnits, rows["a"].NumUnitsSource, rows["a"].OccupantCount) == (1.0, "inferred_single_family", 2.0)
    assert rows["b"].OccupantCount == 3.0 and rows["b"].StructureType == "unknown"
    assert (rows["c"].OccupantCount, rows["c"].OccupantCountMethod) == (10.0, "num_units_x_census_household_size")
    none = rules.finalize(base, "x", "IL", household=0)
    assert none.where("StructureID = 'c'").first().OccupantCount is None
    assert rules.finalize(empty(spark, {"StructureID": "string"}), "x", "y").columns == list(OUTPUT)
    plan = rules.finalize(base, "x", "IL")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
