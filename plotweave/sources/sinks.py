"""Sinks: GeoParquet tables of cities and the combined table.

Spark's Parquet writer can't set the ``geo`` key of the footer, so tasks write
their files themselves, batch by batch, and report their names. Files of failed
or repeated attempts aren't reported and are removed; the finished folder then
takes the place of the old one.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotweave.operators.conflate import CITY
from plotweave.sources import files


def geo_metadata(column: str = "geometry", kinds: Sequence[str] = ("Polygon", "MultiPolygon")) -> str:
    """The ``geo`` footer value of GeoParquet 1.1 for WKB. A reference system left
    out means longitude and latitude."""
    return json.dumps({"version": "1.1.0", "primary_column": column, "columns": {column: {"encoding": "WKB", "geometry_types": list(kinds), "edges": "planar"}}})


def uri(path: files.Location) -> str:
    text = str(path)
    return text if ":/" in text else f"file://{os.path.abspath(text)}"


def write_geoparquet(df: DataFrame, folders: dict[str, files.Location], column: str | None = None) -> dict[str, int]:
    """Writes the rows to the folder their ``column`` names (all to the one folder
    without it, and without that column) and returns the rows of each."""
    run = uuid.uuid4().hex
    targets = {k: f"{uri(p).rstrip('/')}.{run}" for k, p in folders.items()}
    only = next(iter(folders), "")
    meta = geo_metadata().encode()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{uuid.uuid4().hex}.parquet"
        writers: dict[str, pq.ParquetWriter] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = pc.unique(table[column]).to_pylist() if column else [only]
            for k in keys:
                part = table.filter(pc.equal(table[column], k)).drop_columns([column]) if column else table
                if k not in writers:
                    system, where = pafs.FileSystem.from_uri(targets[k])
                    system.create_dir(where, recursive=True)
                    schema = part.schema.with_metadata({b"geo": meta})
                    writers[k] = pq.ParquetWriter(f"{where}/{name}", schema, filesystem=system, compression="zstd")
                writers[k].write_table(part.cast(writers[k].schema), row_group_size=100_000)
                rows[k] = rows.get(k, 0) + part.num_rows
        for w in writers.values():
            w.close()
        yield pa.RecordBatch.from_pydict({"key": list(writers), "file": [name] * len(writers), "n": [rows[k] for k in writers]}, schema=_REPORT)

    done: dict[str, set[str]] = {k: set() for k in folders}
    counts = dict.fromkeys(folders, 0)
    for r in df.mapInArrow(write, "key string, file string, n bigint").collect():  # a row per file
        done[r.key].add(r.file)
        counts[r.key] += r.n
    for k, path in folders.items():
        system, where = pafs.FileSystem.from_uri(targets[k])
        if not done[k]:  # an empty table still has a schema
            system.create_dir(where, recursive=True)
            nothing = pa.schema([(c, {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[t]) for c, t in df.drop(*([column] if column else [])).dtypes])
            pq.write_table(nothing.empty_table().replace_schema_metadata({b"geo": meta}), f"{where}/part-none.parquet", filesystem=system)
        else:
            for info in system.get_file_info(pafs.FileSelector(where)):
                if info.base_name not in done[k]:
                    system.delete_file(info.path)
        final = pafs.FileSystem.from_uri(uri(path))[1]
        if system.get_file_info(final).type == pafs.FileType.Directory:
            system.delete_dir(final)
        system.move(where, final)
    return counts


_REPORT = pa.schema([("key", pa.string()), ("file", pa.string()), ("n", pa.int64())])


def city_path(folder: files.Location, slug: str) -> files.Location:
    return files.join(folder, f"{slug}_structures.parquet")


def write_cities(df: DataFrame, folder: files.Location, slugs: Sequence[str]) -> dict[str, int]:
    """K1: ``{slug}_structures.parquet`` of every city. Rows are spread by city
    and id, so a large city is written by many tasks."""
    spread = df.repartitionByRange(F.col(CITY), F.col("StructureID")).sortWithinPartitions(CITY, "StructureID")
    return write_geoparquet(spread, {s: city_path(folder, s) for s in slugs}, CITY)


def write_master(every: DataFrame, folder: files.Location) -> str:
    """K2: all cities in one table, in the order of state, city and id; ranges of
    that order are written by different tasks, whatever the size of a city."""
    path = files.join(folder, "structures_master.parquet")
    spread = every.repartitionByRange("State", "City", "StructureID").sortWithinPartitions("State", "City", "StructureID")
    write_geoparquet(spread, {"": path})
    return str(path)

