"""Named queries of the core and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plotweave.operators import drift, impute, near
from plotweave.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": lambda s, d: near.nearby(table(s, d, "nsi"), table(s, d, "structures"), table(s, d, "parcels")),
    "p2_classes": lambda s, d: near.near_classes(table(s, d, "nsi"), table(s, d, "structures"), table(s, d, "parcels")),
    "p2_members": lambda s, d: near.class_members(table(s, d, "nsi"), table(s, d, "structures"), table(s, d, "parcels")),
    "p3_found": lambda s, d: drift.changes(table(s, d, "parcel_files"), table(s, d, "parcel_raw")).select("file_id", "field", "drift"),
    "p3_report": lambda s, d: drift.changes(table(s, d, "parcel_files"), table(s, d, "parcel_raw")),
    "p3_parcels": lambda s, d: drift.unified(table(s, d, "parcel_files"), table(s, d, "parcel_raw")),
    "p4_found": lambda s, d: impute.filled_cells(table(s, d, "structures")).select("record_id", "field"),
    "p4_filled": lambda s, d: impute.filled_table(table(s, d, "structures")),
}
# independent of the matcher: the names seen in the test feeds, by hand
_HELD = r"""
WITH v AS (
  SELECT r.file_id, u.key AS key, json_type(r.payload, '$."' || u.key || '"') AS t,
    lower(regexp_replace(u.key, '[^A-Za-z0-9]', '', 'g')) AS n
  FROM parcel_raw r, unnest(json_keys(r.payload)) AS u(key)
), k AS (
  SELECT file_id, key,
    CASE WHEN n IN ('acct', 'apn', 'parcelid', 'parid', 'pin', 'strap', 'taxid', 'foliono', 'mapblklot', 'propid') THEN 'ParcelID'
         WHEN n IN ('addr', 'fulladdress', 'locline1', 'physaddr', 'premise', 'propertyaddress', 'siteaddress', 'situsaddr') THEN 'ParcelAddress'
         WHEN n IN ('assessed', 'assessedvalue', 'avtotal', 'certval', 'jv', 'marketvalue', 'totalvalue', 'totalappraisal') THEN 'ParcelAssessedValue'
         WHEN n IN ('actyrblt', 'builtyear', 'constr', 'yearbuilt', 'yrbuilt', 'effdtbld') THEN 'ParcelYearBuilt' END AS field,
    CASE WHEN t IN ('OBJECT', 'ARRAY') THEN 'object' WHEN t IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT') THEN 'number' ELSE 'text' END AS kind
  FROM v WHERE t <> 'NULL'
), c AS (
  SELECT file_id, field, key, kind, count(*) AS c FROM k WHERE field IS NOT NULL GROUP BY ALL
), held AS (
  SELECT file_id, field, any_value(key) AS key, arg_min(kind, (-c, kind)) AS kind FROM c GROUP BY ALL
)"""
_LINE = r""", line AS (
  SELECT f.file_id, x.field, h.key, h.kind,
    lag(h.key) OVER w AS key0, lag(h.kind) OVER w AS kind0, row_number() OVER w AS nth
  FROM parcel_files f CROSS JOIN (VALUES ('ParcelID'), ('ParcelAddress'), ('ParcelAssessedValue'), ('ParcelYearBuilt')) x(field)
  LEFT JOIN held h ON h.file_id = f.file_id AND h.field = x.field
  WINDOW w AS (PARTITION BY f.feed, x.field ORDER BY f.vintage)
)"""
SQL: dict[str, str] = {
    "p3_found": _HELD + _LINE + r"""
SELECT file_id, field, 'added' AS drift FROM line WHERE nth > 1 AND key0 IS NULL AND key IS NOT NULL
UNION ALL SELECT file_id, field, 'removed' FROM line WHERE nth > 1 AND key0 IS NOT NULL AND key IS NULL
UNION ALL SELECT file_id, field, 'renamed' FROM line WHERE nth > 1 AND key0 <> key
UNION ALL SELECT file_id, field, 'retyped' FROM line WHERE nth > 1 AND kind0 <> kind""",
    "p3_report": _HELD + _LINE + r"""
SELECT file_id, field, 'added' AS drift, NULL::VARCHAR AS before, key AS after FROM line WHERE nth > 1 AND key0 IS NULL AND key IS NOT NULL
UNION ALL SELECT file_id, field, 'removed', key0, NULL FROM line WHERE nth > 1 AND key0 IS NOT NULL AND key IS NULL
UNION ALL SELECT file_id, field, 'renamed', key0, key FROM line WHERE nth > 1 AND key0 <> key
UNION ALL SELECT file_id, field, 'retyped', kind0, kind FROM line WHERE nth > 1 AND kind0 <> kind""",
    "p3_parcels": _HELD + r""", w AS (
  SELECT file_id, max(CASE WHEN field = 'ParcelID' THEN key END) AS k1, max(CASE WHEN field = 'ParcelAddress' THEN key END) AS k2,
    max(CASE WHEN field = 'ParcelAssessedValue' THEN key END) AS k3, max(CASE WHEN field = 'ParcelYearBuilt' THEN key END) AS k4 FROM held GROUP BY file_id
), x AS (
  SELECT r.row_id, r.file_id, f.feed, f.vintage, json_extract_string(r.payload, '$."' || k1 || '"') AS id, json_extract_string(r.payload, '$."' || k2 || '"') AS place,
    json_extract_string(r.payload, '$."' || k3 || '"') AS worth, json_extract_string(r.payload, '$."' || k4 || '"') AS built
  FROM parcel_raw r LEFT JOIN w ON w.file_id = r.file_id LEFT JOIN parcel_files f ON f.file_id = r.file_id
)
SELECT row_id, file_id, feed, vintage, nullif(regexp_replace(id, '[^0-9A-Za-z]', '', 'g'), '') AS "ParcelID",
  nullif(trim(CASE WHEN place LIKE '{%' THEN concat_ws(' ', json_extract_string(place, '$.no'), json_extract_string(place, '$.street')) ELSE place END), '') AS "ParcelAddress",
  TRY_CAST(regexp_replace(worth, '(?i)[$,\s]|usd', '', 'g') AS DOUBLE) AS "ParcelAssessedValue",
  TRY_CAST(nullif(regexp_extract(built, '(1[5-9][0-9][0-9]|20[0-9][0-9])', 1), '') AS INTEGER) AS "ParcelYearBuilt"
FROM x""",
    "p4_found": r"""
WITH s AS (
  SELECT record_id, TRY_CAST(regexp_extract(CBFIPS, '^\s*\+?([0-9]+)(\.0*)?\s*$', 1) AS BIGINT) AS b,
    coalesce(NOT isnan(NumStories) AND NumStories BETWEEN 1 AND 200, false) AS u1,
    coalesce(OccupantCountMethod IN ('nsi_max_2am_2pm_emp_students', 'num_units_x_census_household_size'), false) AS u3,
    coalesce(NOT isnan(OccupantCount) AND OccupantCount BETWEEN 0 AND 50000, false) AND (OccupantCount <> 0 OR u3) AS u2
  FROM structures
), cells AS (
  SELECT record_id, b, 'NumStories' AS field, u1 AS u FROM s WHERE b IS NOT NULL
  UNION ALL SELECT record_id, b, 'OccupantCount', u2 FROM s WHERE b IS NOT NULL
  UNION ALL SELECT record_id, b, 'OccupantCountMethod', u3 FROM s WHERE b IS NOT NULL
)
SELECT record_id, field FROM cells c WHERE NOT u AND EXISTS (SELECT 1 FROM cells d WHERE d.b = c.b AND d.field = c.field AND d.u)""",
}

from plotweave.plans import catalogue, source_queries  # noqa: E402, F401  (register the reference's operators)

QUERIES |= catalogue.QUERIES
SQL |= catalogue.SQL
