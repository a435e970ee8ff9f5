"""Fixed schemas and the tolerant projection onto them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _schema(text: str) -> dict[str, str]:
    return dict(p.split() for p in text.replace("\n", " ").split(",") if p.strip())


FOOTPRINT = _schema("""StructureID string, FootprintSource string, OvertureID string, MicrosoftID string, BuildingName_OVT string,
    Height_OVT double, Stories_OVT double, OvertureSubtype string, OvertureClass string, HasParts boolean, Height_MS double,
    Confidence_MS double, geometry binary""")
OSM = _schema("""OSMID string, OSM_StructureType string, Stories_OSM double, Height_OSM double, Units_OSM double, BuildingName_OSM string,
    geometry binary""")
NSI = _schema("""fd_id string, occtype string, st_damcat string, cbfips string, num_story double, resunits double, empnum double,
    students double, sqft double, pop2amu65 double, pop2amo65 double, pop2pmu65 double, pop2pmo65 double, val_struct double""")
NSI_ATTACHED = _schema("""NSI_FD_ID string, NSI_RecordCount bigint, NSI_OccType string, NSI_DamageCategory string, CBFIPS string,
    NSI_NumStory double, NSI_ResUnits double, NSI_EmpNum double, NSI_Students double, NSI_Sqft double, NSI_Pop2AM double,
    NSI_Pop2PM double, NSI_ValStruct double""")
PARCEL = _schema("""ParcelID string, ParcelAddress string, ParcelLandUse string, ParcelZoning string, ParcelOwner string,
    ParcelAssessedValue double, ParcelYearBuilt double, ParcelArea_m2 double, ParcelSource string, geometry binary""")
PARCEL_ATTACHED = {c: t for c, t in PARCEL.items() if c != "geometry"} | {"ParcelMatchMethod": "string"}
#: The 44 columns of the result, in order.
OUTPUT = _schema("""StructureID string, City string, State string, Country string, FootprintSource string, OvertureID string,
    MicrosoftID string, OSMID string, NSI_FD_ID string, NSI_RecordCount bigint, StructureType string, StructureTypeRaw string,
    StructureTypeSource string, BuildingName string, BuildingNameSource string, NumUnits double, NumUnitsSource string,
    NumStories double, NumStoriesSource string, HeightM double, HeightSource string, OccupantCount double,
    OccupantCountMethod string, NSI_Pop2AM double, NSI_Pop2PM double, NSI_EmpNum double, NSI_Students double, CBFIPS string,
    ParcelID string, ParcelAddress string, ParcelLandUse string, ParcelZoning string, ParcelOwner string,
    ParcelAssessedValue double, ParcelYearBuilt double, ParcelArea_m2 double, ParcelSource string, ParcelMatchMethod string,
    FootprintArea_m2 double, Confidence_MS double, HasParts boolean, CensusAvgHouseholdSize double, CensusSource string,
    geometry binary""")


def ensure_columns(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """``df`` with every column of ``schema``; missing ones are typed NULLs."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in schema.items() if c not in df.columns})


def project(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly the columns of ``schema``, in order and type."""
    return ensure_columns(df, schema).select(*[F.col(c).cast(t).alias(c) for c, t in schema.items()])


def empty(spark: SparkSession, schema: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in schema.items()))
