"""Joins in which a few keys may hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key is hot above both bounds; at most ``SHARE`` keys can be.
HOT_ROWS, SHARE = 20_000, 200


def hot_keys(counts: DataFrame, key: str | list[str], n: str = "n") -> list[int]:
    """Digests of the keys that hold more than ``HOT_ROWS`` rows and one row in
    ``SHARE``. ``counts`` has a row per key with its number of rows."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return [r[0] for r in counts.where(F.col(n) > max(HOT_ROWS, total // SHARE)).select(_digest(key)).collect()]


def _digest(key: str | list[str]) -> Column:
    return F.xxhash64(*([key] if isinstance(key, str) else key))


def join_spread(rows: DataFrame, table: DataFrame, key: str | list[str], hot: list[int]) -> DataFrame:
    """Inner join with a ``table`` of one row per key. Rows of hot keys stay where
    they are: their few table rows are broadcast. Digests only decide which way a
    row takes."""
    if not hot:
        return rows.join(table, key)
    few = _digest(key).isin(hot)
    return rows.where(~few).join(table.where(~few), key).unionByName(rows.where(few).join(F.broadcast(table.where(few)), key))


def ranked(rows: DataFrame, group: list[str], n: str, order: str, piece_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``nth``, a row's number in its group (from 1). Groups of ``n`` rows
    are numbered in pieces of about ``piece_rows``, cut by the hash of ``order``
    and sorted by it inside; the pieces' sizes are added up."""
    piece = F.pmod(F.xxhash64(order), F.ceil(F.col(n) / F.lit(piece_rows)))
    rows = rows.withColumn("_piece", piece)
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*group, "_piece").agg(F.count(F.lit(1)).alias("_size"))
    sizes = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    nth = F.row_number().over(Window.partitionBy(*group, "_piece").orderBy(order))
    return rows.withColumn("_nth", nth).join(sizes, [*group, "_piece"]).withColumn("nth", F.col("_nth") + F.col("_offset")).drop("_nth", "_offset", "_piece")
