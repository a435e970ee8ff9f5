"""Named queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plotweave.llm import best_record, canonical, entity_match, leakage, sentences, tokens
from plotweave.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": lambda s, d: best_record.best_cells(table(s, d, "structures")),
    "p1_records": lambda s, d: best_record.best_records(table(s, d, "structures")),
    "p5_found": lambda s, d: entity_match.matches(table(s, d, "structures")).select("microsoftid", "overtureid"),
    "p5_matches": lambda s, d: entity_match.matches(table(s, d, "structures")),
    "p6_found": lambda s, d: canonical.typed_rows(table(s, d, "structures"), table(s, d, "structure_types")),
    "p6_report": lambda s, d: canonical.type_report(table(s, d, "structures"), table(s, d, "structure_types")),
    "p7_ids": lambda s, d: tokens.encode_corpus(table(s, d, "documents")),
    "p8_found": lambda s, d: leakage.leaks(table(s, d, "documents"), table(s, d, "eval_items")),
    "p9_found": lambda s, d: sentences.sentence_units(table(s, d, "documents")),
    "p8_report": lambda s, d: leakage.leak_report(table(s, d, "documents"), table(s, d, "eval_items")),
}

_KEY = r"lower(regexp_replace(StructureID, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g'))"


def _label(c: str) -> str:
    return rf"coalesce(lower(regexp_replace({c}, '[\s_-]+', '', 'g')), '')"


def _order(c: str, names: list[str]) -> str:
    return f"CASE {_label(c)} " + " ".join(f"WHEN '{n}' THEN {k}" for k, n in enumerate(names, 1)) + f" ELSE {len(names) + 1} END"


SQL: dict[str, str] = {
    "p1_found": f"""
WITH s AS (SELECT *, {_KEY} AS k FROM structures WHERE {_KEY} <> ''),
many AS (SELECT k FROM s GROUP BY k HAVING count(*) > 1),
votes AS (
  SELECT k, 'NumStories' AS field, record_id, observed_at, {_order("NumStoriesSource", ["osm", "overture", "nsi", "heightestimate"])} AS r
  FROM s WHERE NumStories BETWEEN 1 AND 200 AND NOT isnan(NumStories)
  UNION ALL
  SELECT k, 'NumUnits', record_id, observed_at, {_order("NumUnitsSource", ["osm", "nsi", "inferredsinglefamily"])}
  FROM s WHERE NumUnits >= 1 AND NOT isnan(NumUnits)
  UNION ALL
  SELECT k, 'StructureTypeSource', record_id, observed_at,
    {_order("StructureTypeSource", ["osm", "overtureclass", "overturesubtype", "nsiocctype", "nsidamagecategory"])}
  FROM s WHERE regexp_matches(StructureTypeRaw, '[^\\s\\x{{a0}}]')
)
SELECT k AS structureid, field, record_id FROM (
  SELECT *, row_number() OVER (PARTITION BY k, field ORDER BY r, observed_at DESC NULLS LAST, record_id) AS n
  FROM votes SEMI JOIN many USING (k)
) WHERE n = 1""",
    "p1_records": rf"""
WITH s AS (SELECT *, {_KEY} AS k, (epoch(TIMESTAMP '2100-01-01') - floor(epoch(coalesce(observed_at, TIMESTAMP '1900-01-01')))) / 86400e0 AS age FROM structures WHERE {_KEY} <> ''),
votes AS (
  SELECT k, 'NumStories' AS field, record_id, observed_at, age, cast(NumStories AS VARCHAR) AS same, cast(NumStories AS VARCHAR) AS value, NumStoriesSource AS label,
    {_order("NumStoriesSource", ["osm", "overture", "nsi", "heightestimate"])} AS r
  FROM s WHERE NumStories BETWEEN 1 AND 200 AND NOT isnan(NumStories)
  UNION ALL
  SELECT k, 'NumUnits', record_id, observed_at, age, cast(NumUnits AS VARCHAR), cast(NumUnits AS VARCHAR), NumUnitsSource, {_order("NumUnitsSource", ["osm", "nsi", "inferredsinglefamily"])}
  FROM s WHERE NumUnits >= 1 AND NOT isnan(NumUnits)
  UNION ALL
  SELECT k, 'StructureTypeSource', record_id, observed_at, age,
    lower(regexp_replace(regexp_replace(StructureTypeRaw, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g'), '\s+', ' ', 'g')), StructureTypeRaw, StructureTypeSource,
    {_order("StructureTypeSource", ["osm", "overtureclass", "overturesubtype", "nsiocctype", "nsidamagecategory"])}
  FROM s WHERE regexp_matches(StructureTypeRaw, '[^\s\x{{a0}}]')
), sums AS (
  SELECT k, field, same, round(ln(greatest(sum(pow(4e0, -r) * pow(2e0, -age / 730e0)), 1e-300)), 9) AS score,
    arg_max(struct_pack(r := r, t := observed_at, id := record_id, v := value, l := label), (-r, coalesce(observed_at, TIMESTAMP '1800-01-01'), -record_id)) AS best
  FROM votes GROUP BY k, field, same
), won AS (
  SELECT *, row_number() OVER (PARTITION BY k, field ORDER BY score DESC, best.r, best.t DESC NULLS LAST, best.id) AS n FROM sums
), n AS (SELECT k, count(*) AS c FROM s GROUP BY k)
SELECT k AS structureid, max(c) AS n_rows, {", ".join(
    f"max(CASE WHEN field = '{f}' THEN best.v END) AS {f}, max(CASE WHEN field = '{f}' THEN best.l END) AS {f}_label, max(CASE WHEN field = '{f}' THEN best.id END) AS {f}_from"
    for f in ("NumStories", "NumUnits", "StructureTypeSource"))}
FROM n JOIN won USING (k) WHERE won.n = 1 GROUP BY k""",
}
