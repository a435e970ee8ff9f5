"""Coverage profiles of a result table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Provenance columns, as the result carries them.
SOURCES = ("FootprintSource", "StructureTypeSource", "BuildingNameSource", "NumUnitsSource", "NumStoriesSource", "HeightSource", "OccupantCountMethod", "ParcelSource", "ParcelMatchMethod")


def label_counts(df: DataFrame, columns: Sequence[str] = SOURCES, top: int = 20) -> DataFrame:
    """column_name, label, n: the most frequent labels of each column, NULL
    among them; ties by label, NULL last. One pass over the table; the counts
    are then ranked column by column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("label")) for c in columns])
    counts = df.select(F.inline(cells)).groupBy("column_name", "label").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("n"), F.asc_nulls_last("label")))
    return counts.withColumn("rank", rank).where(F.col("rank") <= top).drop("rank")


def places(df: DataFrame) -> DataFrame:
    return df.select("City", "State").distinct()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def preview(df: DataFrame, columns: Sequence[str], rows: int = 100) -> DataFrame:
    """The first rows of a projection, as notebooks show them."""
    return df.select(*[c for c in columns if c in df.columns]).limit(rows)
