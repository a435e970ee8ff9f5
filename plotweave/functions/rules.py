"""Structure type rules and the derived attributes D1-D13."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotweave.config import full_state
from plotweave.functions.scalars import first_with_source, stories_from_height
from plotweave.functions.text import real
from plotweave.schema import OUTPUT, ensure_columns

# Pattern and type, the first pattern that occurs decides.
TYPE_RULES = (
    (r"condo|condominium", "condo"),
    (r"apart|res3|multi.?family|multifamily", "apartment"),
    (r"hotel|motel|res4", "hotel"),
    (r"garage|garages|parking", "garage"),
    (r"barn|farm_auxiliary|agric|stable|greenhouse", "barn"),
    (r"mobile|res2|manufactured", "mobile_home"),
    (r"school|college|university|edu", "education"),
    (r"hospital|clinic|medical|nursing|res6", "healthcare"),
    (r"warehouse|wholesale|com2", "warehouse"),
    (r"industrial|factory|ind", "industrial"),
    (r"retail|office|commercial|com", "commercial"),
    (r"church|civic|public|government|religious", "public"),
    (r"house|detached|semidetached|terrace|residential|res1|res", "residential"),
)
SINGLE_FAMILY = r"house|detached|semidetached|terrace|res1|res2|mobile"

# Where each attribute may come from, best first, and its label.
NAME_SOURCES = (("BuildingName_OSM", "osm"), ("BuildingName_OVT", "overture"))
TYPE_SOURCES = (
    ("OSM_StructureType", "osm"), ("OvertureClass", "overture_class"), ("OvertureSubtype", "overture_subtype"),
    ("NSI_OccType", "nsi_occtype"), ("NSI_DamageCategory", "nsi_damage_category"),
)
HEIGHT_SOURCES = (("Height_OSM", "osm"), ("Height_OVT", "overture"), ("Height_MS", "microsoft"))
STORY_SOURCES = (("Stories_OSM", "osm"), ("Stories_OVT", "overture"), ("NSI_NumStory", "nsi"), ("Stories_EstFromHeight", "height_estimate"))
UNIT_SOURCES = (("Units_OSM", "osm"), ("NSI_ResUnits", "nsi"))


def structure_type(raw: Column) -> Column:
    """One of the rule labels, ``unknown`` without a match or value."""
    text = F.lower(F.coalesce(raw, F.lit("")))
    out = F.lit("unknown")
    for pattern, label in reversed(TYPE_RULES):
        out = F.when(text.rlike(pattern), label).otherwise(out)
    return out


def single_family(units: Column, kind: Column, raw: Column) -> Column:
    return units.isNull() & kind.isin("residential", "mobile_home") & F.lower(F.coalesce(raw, F.lit(""))).rlike(SINGLE_FAMILY)


def people(am: Column, pm: Column, employed: Column, students: Column) -> Column:
    """Largest of morning, afternoon and workers plus students (zero counts as
    missing for the last only); NULL if nothing is known."""
    outside = F.nullif(F.coalesce(employed, F.lit(0.0)) + F.coalesce(students, F.lit(0.0)), F.lit(0.0))
    return F.greatest(am, pm, outside)


def finalize(base: DataFrame, city: Column | str, state: Column | str, country: Column | str = "USA",
             household: Column | float | None = None, household_source: Column | str | None = None,
             keep: Sequence[str] = ()) -> DataFrame:
    """The 44-column table from a base with attached attributes (D1-D13). What
    differs by city may be a column; ``keep`` names further columns to carry."""
    def as_column(v: Column | str) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    df = base.withColumns({c: real(F.col(c)) for c, t in base.dtypes if t == "double"})
    name, name_from = first_with_source(df, NAME_SOURCES, "string")
    raw, raw_from = first_with_source(df, TYPE_SOURCES, "string")
    height, height_from = first_with_source(df, HEIGHT_SOURCES, "double")
    df = df.withColumns({
        "City": as_column(city), "State": F.lit(full_state(state)) if isinstance(state, str) else state, "Country": as_column(country),
        "BuildingName": name, "BuildingNameSource": name_from, "StructureTypeRaw": raw, "StructureTypeSource": raw_from,
        "HeightM": height, "HeightSource": height_from,
    })
    df = df.withColumns({"StructureType": structure_type(F.col("StructureTypeRaw")), "Stories_EstFromHeight": stories_from_height(F.col("HeightM"))})
    stories, stories_from = first_with_source(df, STORY_SOURCES, "double")
    units, units_from = first_with_source(df, UNIT_SOURCES, "double")
    df = df.withColumns({"NumStories": stories, "NumStoriesSource": stories_from, "_units": units, "_units_from": units_from})
    infer = single_family(F.col("_units"), F.col("StructureType"), F.col("StructureTypeRaw"))
    df = ensure_columns(df, {c: "double" for c in ("NSI_Pop2AM", "NSI_Pop2PM", "NSI_EmpNum", "NSI_Students")})
    df = df.withColumns({
        "NumUnits": F.when(infer, 1.0).otherwise(F.col("_units")),
        "NumUnitsSource": F.when(infer, "inferred_single_family").otherwise(F.col("_units_from")),
        "_people": people(F.col("NSI_Pop2AM"), F.col("NSI_Pop2PM"), F.col("NSI_EmpNum"), F.col("NSI_Students")),
    })
    size = as_column(household).cast("double")
    size = F.when(size != 0, size)
    census = F.when(F.col("StructureType").isin("residential", "condo", "apartment", "mobile_home"), F.col("NumUnits") * size)
    df = df.withColumns({
        "OccupantCount": F.coalesce(F.col("_people"), census),
        "OccupantCountMethod": F.when(F.col("_people").isNotNull(), "nsi_max_2am_2pm_emp_students").when(census.isNotNull(), "num_units_x_census_household_size"),
        "CensusAvgHouseholdSize": as_column(household).cast("double"), "CensusSource": as_column(household_source).cast("string"),
    })
    return ensure_columns(df, OUTPUT).select(*[F.col(c).cast(t).alias(c) for c, t in OUTPUT.items()], *keep)
