"""Points near other points, and the regions that hold them.

Locations become unit vectors on the sphere. A bounded sample of them fits k-d
splits (``KDSplits``); every object goes to the leaf of its own vector and, as a
halo copy, to every leaf its radius reaches into. One shuffle brings a leaf's
points and regions together; there a local k-d tree answers the radius search by
chord length and a plane sweep over the polygons' edges finds containing
regions. A pair is reported only by the leaf that owns its first member.

Equal points and equal footprints are searched once, as a class with a
representative: ``Classes`` holds the pairs of classes and who belongs to them,
so a third of all rows in one place neither overloads a leaf nor is compared
pairwise. ``nearby`` lists key pairs, as its relation asks; there the members of
large classes are joined in salted pieces.

Defined results: rows without key or usable geometry take no part; points on a
polygon's edge are outside; regions over the antimeridian and points on either
side of it are handled; a structure stands on a parcel when every corner, those
of holes too, lies inside; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotweave.functions import wkb
from plotweave.functions.text import entity_key, not_blank
from plotweave.session import stored

EARTH_M = 6_371_008.8
#: Sampled objects that fit the k-d splits: at least so many, and so many a leaf
#: (they only balance the leaves).
SPLIT_SAMPLE, SAMPLES_PER_LEAF = 40_000, 8
#: Objects a leaf should hold, and the most leaves (2.4 MB of shipped splits).
LEAF_OBJECTS, MOST_LEAVES = 6_000, 1 << 18
#: Members of a class that are joined in one piece.
PIECE = 5_000


def unit_vectors(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    a, b = np.radians(lon), np.radians(lat)
    return np.stack([np.cos(b) * np.cos(a), np.cos(b) * np.sin(a), np.sin(b)], axis=1)


def chord(metres: float, radius: float = EARTH_M) -> float:
    """Straight distance between unit vectors of points so far apart on the sphere."""
    return 2 * math.sin(min(metres / (2 * radius), math.pi / 2))


class KDSplits:
    """Implicit binary tree; node i has children 2i+1 and 2i+2."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.depth = max(0, math.ceil(math.log2(max(leaves, 1))))
        n = (1 << self.depth) - 1
        self.dim, self.at = np.zeros(n, dtype=np.int8), np.zeros(n)
        parts = [sample]
        for level in range(self.depth):
            nxt = []
            for k, pts in enumerate(parts):
                node = (1 << level) - 1 + k
                if len(pts) > 1:
                    d = int(np.argmax(np.ptp(pts, axis=0)))
                    self.dim[node], self.at[node] = d, np.median(pts[:, d])
                else:
                    self.dim[node], self.at[node] = 0, pts[0, 0] if len(pts) else 0.0
                left = pts[:, self.dim[node]] <= self.at[node]
                nxt += [pts[left], pts[~left]]
            parts = nxt

    def leaves(self, v: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(object, leaf, own) of every leaf within ``radius`` of each vector."""
        who, node, own = np.arange(len(v)), np.zeros(len(v), dtype=np.int64), np.ones(len(v), dtype=bool)
        for _ in range(self.depth):
            x, t, r = v[who, self.dim[node]], self.at[node], radius[who]
            left, right = x - r <= t, x + r > t
            side = x <= t
            who = np.r_[who[left], who[right]]
            own = np.r_[(own & side)[left], (own & ~side)[right]]
            node = np.r_[2 * node[left] + 1, 2 * node[right] + 2]
        return who, node, own


def pairs_within(v: np.ndarray, r: float, bucket: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of vectors at most ``r`` apart: a k-d tree of equal
    buckets, joined with itself level by level."""
    n = len(v)
    if n < 2:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    depth = max(0, math.ceil(math.log2(max(1, n / bucket))))
    size = -(-n // (1 << depth))
    total = size << depth
    order = np.arange(n)
    bounds = np.minimum(np.arange((1 << depth) + 1) * size, n)
    for level in range(depth):
        ends = bounds[:: 1 << (depth - level)]
        node = np.repeat(np.arange(1 << level), np.diff(ends))
        pts = v[order]
        live = np.flatnonzero(np.diff(ends) > 0)
        wide = np.zeros(1 << level, dtype=np.int64)
        lo, hi = np.minimum.reduceat(pts, ends[live]), np.maximum.reduceat(pts, ends[live])
        wide[live] = np.argmax(hi - lo, axis=1)
        order = order[np.lexsort((pts[np.arange(n), wide[node]], node))]
    pts = np.full((total, 3), np.nan)
    pts[:n] = v[order]
    boxes = []
    for level in range(depth + 1):
        b = pts.reshape(1 << level, -1, 3)
        with np.errstate(all="ignore"):
            boxes.append((np.fmin.reduce(b, axis=1), np.fmax.reduce(b, axis=1)))
    a, b = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    for level in range(1, depth + 1):
        a2 = np.concatenate([2 * a, 2 * a, 2 * a + 1, 2 * a + 1])
        b2 = np.concatenate([2 * b, 2 * b + 1, 2 * b, 2 * b + 1])
        lo, hi = boxes[level]
        ok = a2 <= b2
        a, b = a2[ok], b2[ok]
        gap = np.maximum(np.maximum(lo[a] - hi[b], lo[b] - hi[a]), 0)
        ok = (gap**2).sum(axis=1) <= r * r  # NaN (empty bucket) is never near
        a, b = a[ok], b[ok]
    cells = pts.reshape(1 << depth, size, 3)
    out_i, out_j = [], []
    step = max(1, 1_000_000 // (size * size))
    for k in range(0, len(a), step):
        p, q = a[k : k + step], b[k : k + step]
        d = ((cells[p][:, :, None, :] - cells[q][:, None, :, :]) ** 2).sum(axis=3)
        w, i, j = np.nonzero(d <= r * r)
        i, j = p[w] * size + i, q[w] * size + j
        ok = i < j
        out_i.append(order[i[ok]])
        out_j.append(order[j[ok]])
    i, j = np.concatenate(out_i), np.concatenate(out_j)
    return np.minimum(i, j), np.maximum(i, j)


_NUM = r"([-+]?[0-9]*[.]?[0-9]+(?:[eE][-+]?[0-9]+)?)"


def with_point(df: DataFrame, c: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Adds longitude and latitude of a point written as GeoJSON geometry or
    feature, WKT or EWKT; NULL when it is empty, malformed or off the globe.

    The text is parsed in a projection of its own: as its result is used more
    than once, Catalyst keeps the projections apart and parses once."""
    text = F.col(c)
    wkt = rf"(?i)^\s*(?:SRID\s*=\s*[0-9]+\s*;)?\s*POINT\s*(?:Z|M|ZM)?\s*\(\s*({_NUM[1:-1]}\s+{_NUM[1:-1]})(?:\s+[^)]*)?\)\s*$"
    inner = F.coalesce(F.get_json_object(text, "$.coordinates"), F.get_json_object(text, "$.geometry.coordinates"))
    json = text.rlike(r"^\s*\{")
    digits = F.when(json, F.translate(inner, "[] ", "")).otherwise(F.regexp_replace(F.regexp_extract(text, wkt, 1), r"\s+", ","))
    df = df.withColumn("_xy", F.split(digits, ","))
    df = df.withColumns({"_lon": F.get("_xy", F.lit(0)).try_cast("double"), "_lat": F.get("_xy", F.lit(1)).try_cast("double")})
    x, y = F.col("_lon"), F.col("_lat")
    ok = (F.abs(x) <= 360) & (F.abs(y) <= 90)
    turn = F.when(x > 180, x - 360).when(x < -180, x + 360).otherwise(x)
    return df.withColumns({lon: F.when(ok, turn), lat: F.when(ok, y)}).drop("_xy", "_lon", "_lat")


def point_reps(points: DataFrame, key: Column, geometry: str) -> tuple[DataFrame, DataFrame]:
    """(representatives: rep, gid, n, lon, lat; members: gid, rep, n, key of shared places)."""
    # equal texts first: repeated deliveries are parsed once
    texts = points.select(key.alias("key"), F.col(geometry).alias("_text")).where("key is not null and _text is not null").distinct()
    each = with_point(texts, "_text").select("key", "lon", "lat").where("key is not null and lon is not null and lat is not null").distinct()
    return _classes(stored(each.withColumn("gid", F.xxhash64("lon", "lat")), "points"), ["lon", "lat"])


def region_reps(regions: DataFrame, key: Column, geometry: Column) -> tuple[DataFrame, DataFrame]:
    each = regions.select(key.alias("key"), geometry.alias("geometry")).where("key is not null and geometry is not null and octet_length(geometry) > 20").distinct()
    return _classes(stored(each.withColumn("gid", F.xxhash64("geometry")), "regions"), ["geometry"])


def _classes(each: DataFrame, place: list[str]) -> tuple[DataFrame, DataFrame]:
    reps = each.groupBy("gid", *place).agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("n"))
    shared = stored(reps.where("n > 1").select("gid", "rep", "n", *place), "shared")
    return reps, each.join(shared, ["gid", *place]).select("gid", "rep", "n", "key")


def caps(rings: wkb.Rings) -> tuple[np.ndarray, np.ndarray]:
    """Unit vector and chord radius of a cap around each geometry (NaN: none).
    On the sphere no point of a degree box is farther from its middle than half
    its height plus half its width."""
    box = rings.unwrapped().bounds()
    half = np.radians((box[:, 2:] - box[:, :2]) / 2)
    mid = (box[:, :2] + box[:, 2:]) / 2
    reach = np.minimum(half.sum(axis=1) + 1e-9, np.pi)
    return unit_vectors(mid[:, 0], mid[:, 1]), 2 * np.sin(reach / 2) + 1e-12


_OUT = "leaf int, kind int, own boolean, rep string, gid long, n long, lon double, lat double, geometry binary"
_COLS = [c.split()[0] for c in _OUT.split(", ")]


def _to_leaves(objects: DataFrame, kind: int, splits: KDSplits, reach: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if kind == 0:
                v = unit_vectors(pdf["lon"].to_numpy(), pdf["lat"].to_numpy())
                r, usable = np.full(len(pdf), reach), np.ones(len(pdf), dtype=bool)
                pdf = pdf.assign(geometry=None)
            else:
                v, r = caps(wkb.read(pdf["geometry"].tolist()))
                usable = np.isfinite(r)
                pdf = pdf.assign(lon=np.nan, lat=np.nan)
            keep = np.flatnonzero(usable)
            who, leaf, own = splits.leaves(v[keep], r[keep])
            out = pdf.iloc[keep[who]].assign(leaf=leaf.astype(np.int32), kind=np.int32(kind), own=own)
            yield out[_COLS]

    return objects.mapInPandas(run, _OUT)


_PAIRS = "relation string, a string, a_gid long, a_n long, b string, b_gid long, b_n long"


def _search(radius: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kind, own = pdf["kind"].to_numpy(), pdf["own"].to_numpy(dtype=bool)
        rep, gid, n = pdf["rep"].to_numpy(), pdf["gid"].to_numpy(), pdf["n"].to_numpy()
        out = []

        def add(relation: str, a: np.ndarray, b: np.ndarray) -> None:
            out.append(pd.DataFrame({"relation": relation, "a": rep[a], "a_gid": gid[a], "a_n": n[a], "b": rep[b], "b_gid": gid[b], "b_n": n[b]}))

        p = np.flatnonzero(kind == 0)
        lon, lat = pdf["lon"].to_numpy()[p], pdf["lat"].to_numpy()[p]
        i, j = pairs_within(unit_vectors(lon, lat), radius)
        i, j = p[i], p[j]
        swap = np.array([x > y for x, y in zip(rep[i], rep[j])], dtype=bool)
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        mine = own[i]
        add("near", i[mine], j[mine])
        shared = p[own[p] & (n[p] > 1)]
        add("near", shared, shared)
        home = p[own[p]]
        hx, hy = pdf["lon"].to_numpy()[home], pdf["lat"].to_numpy()[home]
        geometry = pdf["geometry"].to_numpy()
        lots = np.flatnonzero(kind == 2)
        lot_rings = wkb.read(list(geometry[lots]))
        structures = np.flatnonzero(kind == 1)
        a, g = wkb.sweep_inside(hx, hy, wkb.read(list(geometry[structures])))
        add("structure", home[a], structures[g])
        a, g = wkb.sweep_inside(hx, hy, lot_rings)
        add("parcel", home[a], lots[g])
        mine = structures[own[structures]]
        corners = wkb.read(list(geometry[mine]))
        vg = corners.vertex_geom()
        if len(vg) and len(lots):
            a, g = wkb.sweep_inside(corners.xy[:, 0], corners.xy[:, 1], lot_rings)
            pair, hits = np.unique(vg[a] * len(lots) + g, return_counts=True)
            full = hits == np.bincount(vg, minlength=len(mine))[pair // len(lots)]
            pair = pair[full]
            add("lot", lots[pair % len(lots)], mine[pair // len(lots)])
        return pd.concat(out, ignore_index=True)

    return run


@dataclass(frozen=True)
class Classes:
    """``pairs``: relation, a, a_gid, a_n, b, b_gid, b_n of representatives and
    sizes; ``members``: set (0 points, 1 structures, 2 parcels), gid, rep, n, key
    of the classes with several keys."""

    pairs: DataFrame
    members: DataFrame

    def expanded(self) -> DataFrame:
        """relation, key_a, key_b of all keys."""
        relation = F.col("relation")
        raw = self._side(self.pairs, "a", F.when(relation == "lot", 2).otherwise(0))
        raw = self._side(raw, "b", F.when(relation == "near", 0).when(relation == "parcel", 2).otherwise(1))
        kept = raw.where((relation != "near") | (F.col("a") != F.col("b")))
        return kept.select("relation", F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b")).distinct()

    def _side(self, df: DataFrame, c: str, which: Column) -> DataFrame:
        """Members in place of representatives. A class of many members meets
        them in pieces, so no task gets all of them."""
        pieces = F.ceil(F.col("n") / F.lit(PIECE)).cast("int")
        m = self.members.select("set", "gid", "rep", F.pmod(F.xxhash64("key"), pieces).cast("int").alias("piece"), F.col("key").alias("_key"))
        one = df.where(F.col(f"{c}_n") == 1)
        many = df.where(F.col(f"{c}_n") > 1).select(
            *[F.col(x) for x in df.columns if x != c], F.col(c).alias("rep"), F.col(f"{c}_gid").alias("gid"), which.cast("int").alias("set"),
            F.explode(F.sequence(F.lit(0), F.ceil(F.col(f"{c}_n") / F.lit(PIECE)).cast("int") - 1)).alias("piece"))
        many = many.join(m, ["set", "gid", "rep", "piece"]).withColumn(c, F.col("_key"))
        return one.unionByName(many.select(*one.columns))


def fitted_splits(points: DataFrame, regions: list[DataFrame]) -> KDSplits:
    """Splits from a hash sample of representatives. Vectors are computed where
    the rows lie; only they reach the driver."""
    total = points.count() + sum(r.count() for r in regions)
    leaves = min(MOST_LEAVES, -(-total // LEAF_OBJECTS))
    share = min(1.0, max(SPLIT_SAMPLE, SAMPLES_PER_LEAF * leaves) / max(total, 1))

    def some(df: DataFrame) -> DataFrame:
        return df.where(F.pmod(F.xxhash64("gid"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))

    def middles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            v, r = caps(wkb.read(pdf["geometry"].tolist()))
            yield pd.DataFrame(v[np.isfinite(r)], columns=["x", "y", "z"])

    a, b = F.radians("lon"), F.radians("lat")
    got = some(points).select((F.cos(b) * F.cos(a)).alias("x"), (F.cos(b) * F.sin(a)).alias("y"), F.sin(b).alias("z"))
    for r in regions:
        got = got.unionByName(some(r).select("geometry").mapInPandas(middles, "x double, y double, z double"))
    return KDSplits(got.toPandas().to_numpy(float).reshape(-1, 3), leaves)


def _sets(nsi: DataFrame, structures: DataFrame, parcels: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    fd_id = F.when(not_blank(F.col("fd_id")), F.col("fd_id"))
    parcel_id = F.when(not_blank(F.col("ParcelID")), F.col("ParcelID"))
    return [
        point_reps(nsi, fd_id, "geometry"), region_reps(structures, entity_key(F.col("StructureID")), F.col("geometry")),
        region_reps(parcels, parcel_id, F.col("geometry")),
    ]


def _members(sets: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    parts = [m.select(F.lit(kind).alias("set"), "*") for kind, (_, m) in enumerate(sets)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def classes(nsi: DataFrame, structures: DataFrame, parcels: DataFrame, metres: float = 6.0) -> Classes:
    """Searches the three tables class by class."""
    sets = _sets(nsi, structures, parcels)
    splits, radius = fitted_splits(sets[0][0], [sets[1][0], sets[2][0]]), chord(metres)
    objects = None
    for kind, (reps, _) in enumerate(sets):
        part = _to_leaves(reps, kind, splits, radius * (1 + 1e-9))
        objects = part if objects is None else objects.unionByName(part)
    return Classes(stored(objects.groupBy("leaf").applyInPandas(_search(radius), _PAIRS), "pairs"), _members(sets))


def nearby(nsi: DataFrame, structures: DataFrame, parcels: DataFrame, metres: float = 6.0) -> DataFrame:
    """p2_found: near, structure, parcel and lot pairs over whole tables."""
    return classes(nsi, structures, parcels, metres).expanded()


def near_classes(nsi: DataFrame, structures: DataFrame, parcels: DataFrame, metres: float = 6.0) -> DataFrame:
    """p2_classes: pairs of representatives with the sizes of their classes."""
    pairs = classes(nsi, structures, parcels, metres).pairs
    return pairs.groupBy("relation", F.col("a").alias("class_a"), F.col("b").alias("class_b")).agg(F.max("a_n").alias("n_a"), F.max("b_n").alias("n_b"))


def class_members(nsi: DataFrame, structures: DataFrame, parcels: DataFrame) -> DataFrame:
    """p2_members: set, class and key of every key that shares its place."""
    return _members(_sets(nsi, structures, parcels)).select("set", F.col("rep").alias("class"), "gid", "key")
