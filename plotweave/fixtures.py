"""Spatial views derived from the business tables, in SQL both engines read.

A lattice of pitch 4 with coordinates in eighths: doubles are exact, so results
can be compared bit by bit.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotweave.functions import geometry as g
from plotweave.sources.tables import table

VIEWS: dict[str, str] = {
    "fx_base": """SELECT concat('ovt_', cast(p_partkey AS string)) AS sid, p_partkey AS k, p_type, p_size,
  cast((p_partkey % 64) * 4 AS double) AS x0, cast(floor(p_partkey / 64) * 4 AS double) AS y0,
  cast(2 + p_size % 2 AS double) AS w, cast(2 + p_size % 2 AS double) AS h, (p_size % 5 = 0) AS lcut FROM part""",
    "fx_base_pt": """SELECT sid, k, x0 + (CASE WHEN lcut THEN 0.5e0 ELSE w / 2 END) AS px,
  y0 + (CASE WHEN lcut THEN (1 + h) / 2 ELSE h / 2 END) AS py FROM fx_base""",
    "fx_extra": """SELECT concat('msft_', cast(c_custkey AS string)) AS mid,
  cast((c_custkey % 64) * 4 AS double) + (CASE c_nationkey % 3 WHEN 0 THEN 0.5e0 WHEN 1 THEN 1.25e0 ELSE 3.25e0 END) AS x0,
  cast(floor(c_custkey / 64) * 4 AS double) + (CASE c_nationkey % 3 WHEN 0 THEN 0.5e0 WHEN 1 THEN 1.25e0 ELSE 3.25e0 END) AS y0,
  0.5e0 AS w, 0.5e0 AS h,
  nullif(cast(CASE WHEN c_custkey % 4 = 0 THEN -1 ELSE c_nationkey END AS double), -1e0) AS height FROM customer""",
    "fx_osm": """SELECT o_orderkey AS oid,
  cast((o_custkey % 64) * 4 AS double) + (CASE WHEN o_orderkey % 4 = 0 THEN 3e0 ELSE -0.5e0 END) AS x0,
  cast(floor(o_custkey / 64) * 4 AS double) + (CASE WHEN o_orderkey % 4 = 0 THEN 3e0 ELSE -0.5e0 END) AS y0,
  CASE WHEN o_orderkey % 4 = 0 THEN 0.75e0 ELSE 1.75e0 + (o_orderkey % 5) * 0.25e0 END AS w,
  CASE WHEN o_orderkey % 4 = 0 THEN 0.75e0 ELSE 3e0 - (o_orderkey % 3) * 0.25e0 END AS h,
  o_orderstatus AS st, o_orderpriority AS pr FROM orders""",
    "fx_pts": """SELECT l_orderkey * 8 + l_linenumber AS pid, l_orderkey,
  cast((l_partkey % 64) * 4 AS double) + (l_orderkey % 16) * 0.25e0 + 0.125e0 AS px,
  cast(floor(l_partkey / 64) * 4 AS double) + (l_suppkey % 16) * 0.25e0 + 0.125e0 AS py,
  l_quantity AS q, l_returnflag AS f, l_extendedprice AS e, l_linenumber AS n FROM lineitem""",
    "fx_tags": """SELECT k, sid, CASE p_size % 7 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN lower(p_type) ELSE
    CASE k % 9 WHEN 0 THEN 'house' WHEN 1 THEN 'Apartments' WHEN 2 THEN 'kindergarten' WHEN 3 THEN 'RES1-1SNB'
      WHEN 4 THEN 'GOV1' WHEN 5 THEN 'multi-family' WHEN 6 THEN 'mobile home' WHEN 7 THEN 'COM4' ELSE 'residential' END END AS tag,
  CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN 'garage' ELSE ' ' END AS cls,
  CASE p_size % 4 WHEN 0 THEN NULL ELSE 'RES1' END AS occ,
  CASE p_size % 4 WHEN 0 THEN cast(p_size AS double) END AS h_osm,
  CASE p_size % 4 WHEN 1 THEN cast(p_size AS double) / 2 END AS h_ovt,
  CASE p_size % 4 WHEN 2 THEN cast(p_size AS double) * 1.525e0 END AS h_ms,
  CASE p_size % 5 WHEN 0 THEN cast(p_size % 3 + 1 AS double) END AS s_osm,
  CASE p_size % 6 WHEN 1 THEN cast(p_size % 4 + 1 AS double) END AS s_ovt,
  CASE p_size % 8 WHEN 3 THEN 2.5e0 END AS s_nsi,
  CASE p_size % 9 WHEN 4 THEN cast(p_size % 5 AS double) END AS u_osm,
  CASE p_size % 10 WHEN 5 THEN cast(p_size AS double) END AS u_nsi FROM fx_base""",
}
BASES = {"part", "customer", "orders", "lineitem"}


def needed(name: str) -> list[str]:
    """The views ``name`` rests on, itself last."""
    out: list[str] = []
    for other in re.findall(r"\bfx_\w+", VIEWS[name]):
        out += [v for v in needed(other) if v not in out]
    return [*out, name]


def with_views(sql: str) -> str:
    """SQL text with the fixture views it uses as common table expressions."""
    names: list[str] = []
    for name in re.findall(r"\bfx_\w+", sql):
        names += [v for v in needed(name) if v not in names]
    head = ",\n".join(f"{n} AS (\n{VIEWS[n]})" for n in names)
    if not head:
        return sql
    return f"WITH {head},\n{sql.lstrip()[4:].lstrip()}" if sql.lstrip().startswith("WITH") else f"WITH {head}\n{sql}"


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    tables = {b: table(spark, folder, b) for b in BASES if re.search(rf"\b{b}\b", " ".join(VIEWS[v] for v in needed(name)))}
    sql = with_views(f"SELECT * FROM {name}")
    for b in tables:
        sql = re.sub(rf"\bFROM {b}\b", f"FROM {{{b}}}", sql)
    return spark.sql(sql, **tables)


def rectangles(df: DataFrame) -> DataFrame:
    """Adds rings and bbox from x0, y0, w, h; ``lcut`` rows are L-shaped, with bars
    as wide as ``notch`` (1 where there is no such column)."""
    x0, y0, x1, y1 = F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h")
    rings = g.rectangle(x0, y0, x1, y1)
    if "lcut" in df.columns:
        def p(x, y):
            return F.struct(x.alias("x"), y.alias("y"))

        u = F.col("notch") if "notch" in df.columns else F.lit(1.0)
        cut = F.array(F.array(p(x0, y0), p(x1, y0), p(x1, y0 + u), p(x0 + u, y0 + u), p(x0 + u, y1), p(x0, y1), p(x0, y0)))
        rings = F.when(F.col("lcut"), cut).otherwise(rings)
    out = df.withColumn("rings", rings)
    return out.withColumn("bbox", g.bbox(F.col("rings")))


def blobs(df: DataFrame) -> DataFrame:
    """Adds the shapes as WKB ``geometry``."""
    return rectangles(df).withColumn("geometry", g.encode("rings")).drop("rings", "bbox")
