"""Inventory points as a stream: an extension, the reference has no streams.

New point files of a folder are attached to a footprint table batch by batch;
each batch appends narrow (StructureID, point) matches, and the totals are an
ordinary aggregation over them. A restarted query goes on from its checkpoint,
and a batch that runs twice overwrites its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plotweave.operators import conflate as cf
from plotweave.operators.spatial_join import levels_of, points_in_polygons
from plotweave.schema import NSI


def follow(spark: SparkSession, folder: str, schema: str, base: DataFrame, out: str, checkpoint: str, cell: float = cf.CELL_DEG) -> StreamingQuery:
    """Attaches the points (columns of ``schema``, with x and y) of every new
    Parquet file under ``folder``; runs until the files at hand are done."""
    polygons = cf.with_rings(base.select("StructureID", "geometry")).drop("geometry")
    levels = levels_of(polygons, cell)

    def attach(batch: DataFrame, number: int) -> None:
        pairs = points_in_polygons(batch, polygons, cell, levels)
        pairs.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(attach).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def totals(spark: SparkSession, out: str) -> DataFrame:
    """The attached inventory columns from all batches so far."""
    rows = spark.read.parquet(out)
    missing = {c: F.lit(None).cast(t) for c, t in NSI.items() if c not in rows.columns}
    return cf.aggregate_inventory(rows.withColumns(missing).withColumn("ordinal", F.struct("batch", "fd_id")))
