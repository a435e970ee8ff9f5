"""One table out of files whose schema drifts, with every change reported.

Each file's fields are profiled (names, kinds of values, shapes, nesting) by one
partially combined aggregation over all its records; the profile is as small as
the schema. Similarity flooding then matches every file's schema graph to the
canonical one: both graphs link columns to name tokens, value kinds, value
shapes and nested members; equal or kindred neighbours pass their score on to
the columns and back until the scores settle, and a consistent one-to-one choice
is read off. The canonical graph also has nodes for fields that aren't wanted
(sale, mailing, owner …), so that look-alikes find their own home.

Files whose profiles agree (shares of kinds and shapes in ``STEPS``) are matched
once; the comparison with the preceding vintage only sees four small rows a file
(a feed has at most one file a month). Scores that don't settle are an error, not
a result.

Defined results: payloads that aren't JSON objects are skipped; a field is held
by a file when some record has a non-NULL value for it; JSON true/false count
as text, arrays as objects; a file without records holds nothing; files without
feed or vintage take no part; the first vintage of a feed has no changes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotweave.session import stored

FIELDS = ("ParcelID", "ParcelAddress", "ParcelAssessedValue", "ParcelYearBuilt")

# The canonical schema graph. Tokens, shapes and kinds of each
# wanted field, then of the neighbours that files mix in.
GRAPH: dict[str, dict[str, tuple[str, ...]]] = {
    "ParcelID": {
        "token": ("parcel", "par", "apn", "pin", "pid", "prop", "property", "account", "acct", "tax", "folio", "strap", "map", "blk", "lot", "geo", "id", "no", "number", "key"),
        "shape": ("code",), "kind": ("number", "text"), "member": ()},
    "ParcelAddress": {
        "token": ("site", "situs", "property", "address", "addr", "full", "location", "loc", "line", "phys", "physical", "premise", "premises", "street"),
        "shape": ("street",), "kind": ("text", "object"), "member": ("no", "number", "street", "name", "city", "zip")},
    "ParcelAssessedValue": {
        "token": ("assessed", "assessment", "total", "market", "appraised", "appraisal", "value", "val", "av", "jv", "just", "cert", "land", "improvement", "tax"),
        "shape": ("money",), "kind": ("number", "text"), "member": ()},
    "ParcelYearBuilt": {
        "token": ("year", "yr", "built", "blt", "build", "bld", "constr", "construction", "constructed", "eff", "act", "dt", "date"),
        "shape": ("year",), "kind": ("number", "text"), "member": ()},
    "sale price": {"token": ("last", "sale", "sold", "price", "deed"), "shape": ("money",), "kind": ("number", "text"), "member": ()},
    "sale year": {"token": ("sale", "sold", "year", "last", "deed"), "shape": ("year",), "kind": ("number", "text"), "member": ()},
    "mail": {"token": ("mail", "mailing", "line", "address", "addr", "po", "box"), "shape": ("box",), "kind": ("text",), "member": ()},
    "owner": {"token": ("owner", "taxpayer", "name"), "shape": ("words",), "kind": ("text",), "member": ()},
    "remarks": {"token": ("remarks", "remark", "note", "notes", "comment"), "shape": ("words",), "kind": ("text",), "member": ()},
    "row number": {"token": ("object", "objectid", "oid", "fid", "row", "id"), "shape": ("small",), "kind": ("number",), "member": ()},
}
#: Steps of a share that are told apart.
STEPS = 4
SHAPES = ("code", "street", "money", "year", "box", "small", "words")
KINDS = ("number", "text", "object")
Graph = dict[str, dict[str, tuple[str, ...]]]

# Shape tests over the text form of a value (Java and Python regex agree on them).
_TESTS = {
    "street": r"(?i)^\s*(\d{1,6}\s+[a-z].*|\{.*""" + '"street".*)$',
    "box": r"(?i)^\s*p\.?\s*o\.?\s*box",
    "year": r"(?i)^\s*(c\.?\s*|ca\.?\s*)?(1[5-9]|20)\d\d([-/.]\d\d?[-/.]\d\d?.*|[.]0+)?\s*$",
    "money": r"(?i)^\s*[$€£]?\s*\d{1,3}(,\d{3})+([.]\d+)?\s*(usd)?\s*$|^\s*[$€£]\s*\d+([.]\d+)?\s*$|^\s*\d{4,9}([.]\d+)?\s*(usd)?\s*$",
    "code": r"^\s*[A-Za-z]{0,3}\d{2,}([-. /]\d+)+\s*$|^\s*\d{6,14}\s*$",
    "small": r"^\s*\d{1,4}\s*$",
    "words": r"^\s*[A-Za-z][A-Za-z .,&'-]*$",
}


def vocabulary(graph: Graph) -> list[str]:
    return sorted({t for g in graph.values() for t in g["token"]}, key=lambda t: (-len(t), t))


def tokens(name: str, known: list[str]) -> list[str]:
    """Name parts: camel case, separators, and runs of known tokens."""
    parts = re.findall(r"[a-z]+|\d+", re.sub(r"(?<=[a-z])(?=[A-Z])", "_", name).lower())
    out: list[str] = []
    for part in parts:
        cut: list[str] | None = _segment(part, known) if part not in known else [part]
        out += cut or [part]
    return out


def _segment(part: str, known: list[str]) -> list[str] | None:
    """The split of a run into known tokens with the fewest pieces."""
    best: list[list[str] | None] = [[]] + [None] * len(part)
    for end in range(1, len(part) + 1):
        for t in known:
            head = end - len(t)
            if head >= 0 and best[head] is not None and part.startswith(t, head) and (best[end] is None or len(best[head]) + 1 < len(best[end])):
                best[end] = best[head] + [t]
    return best[-1]


def kinship(a: str, b: str) -> float:
    """Likeness of two tokens: equal, prefix, or shared trigrams."""
    if a == b:
        return 1.0
    if len(a) > 2 and len(b) > 2 and (a.startswith(b) or b.startswith(a)):
        return 0.7
    x, y = ({f"^{t}$"[i : i + 3] for i in range(len(t))} for t in (a, b))
    return 0.6 * len(x & y) / max(len(x | y), 1) if len(x & y) > 1 else 0.0


class Flooding:
    """Matches one profile at a time to the canonical graph."""

    WEIGHT = {"token": 1.0, "shape": 0.9, "kind": 0.15, "member": 0.5}

    def __init__(self, graph: Graph = GRAPH, eps: float = 1e-4, most: int = 10_000, floor: float = 0.25):
        self.eps, self.most, self.floor = eps, most, floor
        self.graph, self.nodes, self.known = graph, tuple(graph), vocabulary(graph)
        self.own = {}
        for label in self.WEIGHT:
            values = sorted({t for g in graph.values() for t in g[label]})
            links = np.array([[t in g[label] for t in values] for g in graph.values()], dtype=float)
            self.own[label] = values, links
        self.memo: dict[tuple[str, str], np.ndarray] = {}

    def start(self, columns: list[dict]) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """label -> (links column x value, links canonical x value, first scores)."""
        out = {}
        for label in self.WEIGHT:
            seen: dict[str, int] = {}
            weight = []
            for i, c in enumerate(columns):
                for t, w in c[label].items():
                    weight.append((i, seen.setdefault(t, len(seen)), w))
            links = np.zeros((len(columns), len(seen)))
            for i, j, w in weight:
                links[i, j] = w
            values, own = self.own[label]
            first = np.array([self.likeness(label, t) for t in seen]).reshape(len(seen), len(values))
            out[label] = links, own, first
        return out

    def likeness(self, label: str, t: str) -> np.ndarray:
        """First scores of a value with all canonical values of its kind."""
        row = self.memo.get((label, t))
        if row is None:
            if len(self.memo) > 50_000:
                self.memo.clear()
            values = self.own[label][0]
            alike = kinship if label in ("token", "member") else lambda a, b: float(a == b)
            row = self.memo[label, t] = np.array([alike(t, u) for u in values])
        return row

    def match(self, columns: list[dict]) -> dict[str, int]:
        """Canonical field -> column, for the wanted fields that are held."""
        if not columns:
            return {}
        graph = self.start(columns)
        base = np.zeros((len(columns), len(self.nodes)))
        for label, (links, own, first) in graph.items():
            part = links @ first @ own.T
            if label == "token":  # the share of a name's tokens that the field knows
                part = (links @ np.stack([np.max(np.where(own[k] > 0, first, 0), axis=1, initial=0) for k in range(len(self.nodes))], axis=1)) / np.maximum(links.sum(axis=1, keepdims=True), 1)
            base += self.WEIGHT[label] * np.minimum(part, 1)
        score = base.copy()
        values = {label: first.copy() for label, (_, _, first) in graph.items()}
        steps = []  # what stays the same from round to round
        for label, (links, own, first) in graph.items():
            fan = np.maximum(links.sum(axis=1, keepdims=True), 1) * np.maximum(own.sum(axis=1), 1)
            back = np.maximum(links.sum(axis=0)[:, None], 1) * np.maximum(own.sum(axis=0), 1)
            if links.shape[1]:
                steps.append((label, links, own, self.WEIGHT[label] / fan, 0.5 * (first > 0) / back, first))
        for _ in range(self.most):
            new = base + score
            for label, links, own, out, _, _ in steps:
                new += out * (links @ values[label] @ own.T)
            for label, links, own, _, back, first in steps:
                got = first + values[label] + back * (links.T @ score @ own)
                values[label] = got / max(got.max(), 1e-12)
            new /= max(new.max(), 1e-12)
            moved = np.abs(new - score / max(score.max(), 1e-12)).max()
            score = new
            if moved < self.eps:
                break
        else:
            raise RuntimeError(f"scores did not settle in {self.most} rounds for {[c['name'] for c in columns]}")
        # consistent choice: best pair first, each column and each field once; what
        # could be either goes to the wanted field
        pairs = sorted(((round(score[i, k] * base[i, k], 9), -i, -k) for i in range(len(columns)) for k in range(len(self.nodes))), reverse=True)
        used: set[int] = set()
        got: dict[str, int] = {}
        for _, i, k in pairs:
            i, k = -i, -k
            shaped = sum(columns[i]["shape"].get(x, 0.0) for x in self.graph[self.nodes[k]]["shape"])
            if i in used or self.nodes[k] in got or base[i, k] < self.floor or shaped < 0.3:
                continue
            used.add(i)
            got[self.nodes[k]] = i
        return {f: i for f, i in got.items() if f in FIELDS}


def profiles(raw: DataFrame) -> DataFrame:
    """file_id, key and the profile of its values (partially combined)."""
    # spelled as SQL because variant_explode is a table function
    v = raw.sparkSession.sql(
        """SELECT file_id, key,
             CASE WHEN t LIKE 'OBJECT%' OR t LIKE 'ARRAY%' THEN 'object'
                  WHEN t IN ('BIGINT', 'DOUBLE', 'FLOAT') OR t LIKE 'DECIMAL%' THEN 'number' WHEN t = 'VOID' THEN NULL ELSE 'text' END AS kind,
             cast(value AS string) AS value, t
           FROM (SELECT r.file_id, e.key, e.value, schema_of_variant(e.value) AS t
                 FROM {raw} r, LATERAL variant_explode(try_parse_json(r.payload)) e WHERE r.file_id IS NOT NULL)""",
        raw=raw.select("file_id", "payload").where(F.col("payload").rlike(r"^\s*\{")),
    )
    is_a = {s: F.coalesce(F.col("value").rlike(p), F.lit(False)) for s, p in _TESTS.items()}
    is_a["money"] = is_a["money"] & ~is_a["year"]
    return v.groupBy("file_id", "key").agg(
        F.count("kind").alias("held"),
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"k_{k}") for k in KINDS],
        *[F.count(F.when(is_a[s] & F.col("kind").isNotNull(), 1)).alias(f"s_{s}") for s in SHAPES],
        F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("kind") == "object", F.json_object_keys("value")))))).alias("members"),
    )


def signatures(raw: DataFrame) -> DataFrame:
    """file_id, signature (digest), columns: each file's fields with the kind of
    most values and the shares of kinds and shapes in steps."""
    def share(c: str) -> Column:
        return F.round(F.col(c) / F.col("held") * STEPS).cast("int").alias(c)

    most = F.greatest(*[f"k_{k}" for k in KINDS])
    kind = F.coalesce(*[F.when(F.col(f"k_{k}") == most, k) for k in KINDS])
    fields = profiles(raw).where("held > 0").select("file_id", "key", kind.alias("kind"), *[share(f"k_{k}") for k in KINDS], *[share(f"s_{x}") for x in SHAPES], "members")
    files = fields.groupBy("file_id").agg(F.sort_array(F.collect_list(F.struct(*[c for c in fields.columns if c != "file_id"]))).alias("columns"))
    return files.withColumn("signature", F.md5(F.to_json("columns")))


def correspondences(raw: DataFrame, graph: Graph = GRAPH) -> DataFrame:
    """file_id, field, key, kind of every canonical field a file holds."""
    files = stored(signatures(raw), "signatures")
    one = files.groupBy("signature").agg(F.min_by("columns", "file_id").alias("columns"))
    # signatures are small and matching them isn't: a fixed number of tasks, which adaptive execution leaves alone
    spark = raw.sparkSession
    one = one.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), F.xxhash64("signature"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flood = Flooding(graph)
        for pdf in batches:
            out = []
            for signature, columns in zip(pdf["signature"], pdf["columns"]):
                nodes = [{
                    "name": c["key"], "token": dict.fromkeys(tokens(c["key"], flood.known), 1.0),
                    "kind": {k: c[f"k_{k}"] / STEPS for k in KINDS if c[f"k_{k}"]},
                    "shape": {x: c[f"s_{x}"] / STEPS for x in SHAPES if c[f"s_{x}"]},
                    "member": {str(m).lower(): 1.0 for m in c["members"]},
                } for c in columns]
                out += [(signature, field, columns[i]["key"], columns[i]["kind"]) for field, i in flood.match(nodes).items()]
            yield pd.DataFrame(out, columns=["signature", "field", "key", "kind"])

    found = one.mapInPandas(run, "signature string, field string, key string, kind string")
    return files.select("file_id", "signature").join(found, "signature").drop("signature")


def changes(files: DataFrame, raw: DataFrame, graph: Graph = GRAPH) -> DataFrame:
    """file_id, field, drift, before, after: differences from the preceding
    vintage of the feed."""
    held = correspondences(raw, graph).groupBy("file_id").agg(*[
        F.max(F.when(F.col("field") == f, F.struct("key", "kind"))).alias(f) for f in FIELDS
    ])
    line = files.where("feed is not null and vintage is not null").select("file_id", "feed", "vintage").join(held, "file_id", "left")
    w = Window.partitionBy("feed").orderBy("vintage", "file_id")
    line = line.select("file_id", F.row_number().over(w).alias("nth"), *FIELDS, *[F.lag(f).over(w).alias(f"was_{f}") for f in FIELDS]).where("nth > 1")

    def report(f: str) -> Column:
        now, was = F.col(f), F.col(f"was_{f}")
        both = now.isNotNull() & was.isNotNull()

        def case(when: Column, drift: str, a: Column, b: Column) -> Column:
            return F.when(when, F.struct(F.lit(f).alias("field"), F.lit(drift).alias("drift"), a.alias("before"), b.alias("after")))

        nothing = F.lit(None).cast("string")
        return F.array(
            case(was.isNull() & now.isNotNull(), "added", nothing, now["key"]),
            case(was.isNotNull() & now.isNull(), "removed", was["key"], nothing),
            case(both & (was["key"] != now["key"]), "renamed", was["key"], now["key"]),
            case(both & (was["kind"] != now["kind"]), "retyped", was["kind"], now["kind"]),
        )

    cases = F.filter(F.concat(*[report(f) for f in FIELDS]), lambda c: c.isNotNull())
    return line.select("file_id", F.inline(cases))


def unified(files: DataFrame, raw: DataFrame) -> DataFrame:
    """One parcel table over all files: casts, then a plain projection.

    ParcelID keeps its digits, addresses become ``no street``, money and years
    become numbers; what can't be read becomes NULL.
    """
    keys = correspondences(raw).groupBy("file_id").agg(*[F.max(F.when(F.col("field") == f, F.col("key"))).alias(f"k_{f}") for f in FIELDS])
    rows = raw.select("row_id", "file_id", "payload").join(keys, "file_id", "left").withColumn("m", F.from_json("payload", "map<string,string>"))
    at = {f: F.try_element_at(F.col("m"), F.col(f"k_{f}")) for f in FIELDS}
    street = F.concat_ws(" ", F.get_json_object(at["ParcelAddress"], "$.no"), F.get_json_object(at["ParcelAddress"], "$.street"))
    address = F.when(at["ParcelAddress"].startswith("{"), street).otherwise(at["ParcelAddress"])
    value = F.regexp_replace(at["ParcelAssessedValue"], r"(?i)[$,\s]|usd", "").try_cast("double")
    year = F.nullif(F.regexp_extract(at["ParcelYearBuilt"], r"(1[5-9]\d\d|20\d\d)", 1), F.lit("")).cast("int")
    feeds = files.select("file_id", "feed", "vintage")
    return rows.join(feeds, "file_id", "left").select(
        "row_id", "file_id", "feed", "vintage",
        F.nullif(F.regexp_replace(at["ParcelID"], r"[^0-9A-Za-z]", ""), F.lit("")).alias("ParcelID"),
        F.nullif(F.trim(address), F.lit("")).alias("ParcelAddress"),
        value.alias("ParcelAssessedValue"), year.alias("ParcelYearBuilt"),
    )
