"""Vectorised WKB polygons in NumPy.

``read`` turns a batch of WKB blobs into flat arrays. Blobs of equal length and
header (nearly all footprints) are decoded by one array view; anything else goes
through a general reader that knows both byte orders, Z/M and SRID flags,
polygons, multipolygons and collections (only their polygons count).

Defined results: NULL, empty, truncated and non-polygon blobs have no rings.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class Rings:
    """Vertices of all rings; ``start`` has one entry more than ``geom``."""

    xy: np.ndarray
    start: np.ndarray
    geom: np.ndarray
    n_geoms: int

    def vertex_geom(self) -> np.ndarray:
        return np.repeat(self.geom, np.diff(self.start))

    def bounds(self) -> np.ndarray:
        """xmin, ymin, xmax, ymax of each geometry; NaN where there is none."""
        out = np.full((self.n_geoms, 4), np.nan)
        if len(self.xy):
            vg = self.vertex_geom()
            first = np.flatnonzero(np.r_[True, np.diff(vg) != 0])
            at = vg[first]
            out[at, :2] = np.minimum.reduceat(self.xy, first)
            out[at, 2:] = np.maximum.reduceat(self.xy, first)
        return out

    def unwrapped(self) -> Rings:
        """Longitudes continued over the antimeridian: each vertex within 180
        degrees of its ring's first one."""
        xy = self.xy.copy()
        if len(xy):
            base = np.repeat(xy[self.start[:-1], 0], np.diff(self.start))
            xy[:, 0] -= 360 * np.round((xy[:, 0] - base) / 360)
        return Rings(xy, self.start, self.geom, self.n_geoms)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Edges (x0, y0, x1, y1) and their geometry; rings are closed if needed."""
        if not len(self.xy):
            return np.empty((0, 4)), np.empty(0, dtype=np.int64)
        last = np.zeros(len(self.xy), dtype=bool)
        last[self.start[1:] - 1] = True
        nxt = np.arange(len(self.xy)) + 1
        nxt[last] = self.start[:-1]
        e = np.hstack([self.xy, self.xy[nxt]])
        real = (e[:, :2] != e[:, 2:]).any(axis=1)
        return e[real], self.vertex_geom()[real]


def _layout(b: bytes) -> list[tuple[int, int, int, str]]:
    """(offset, points, doubles a point, byte order) of every polygon ring."""
    out: list[tuple[int, int, int, str]] = []

    def walk(at: int) -> int:
        order = "<" if b[at] == 1 else ">"
        (kind,) = struct.unpack_from(order + "I", b, at + 1)
        at += 5
        if kind & 0x20000000:
            at += 4
        flags, base = kind >> 28, kind & 0x0FFFFFFF
        dims = 2 + bool(flags & 8) + bool(flags & 4) if base < 1000 else 2 + (base // 1000 in (1, 3)) + (base // 1000 in (2, 3))
        base %= 1000
        if base == 1:
            return at + 8 * dims
        (n,) = struct.unpack_from(order + "I", b, at)
        at += 4
        if base == 2:
            return at + 8 * dims * n
        for _ in range(n):
            if base == 3:
                (k,) = struct.unpack_from(order + "I", b, at)
                at += 4
                if at + 8 * dims * k > len(b):
                    raise ValueError("truncated")
                if k > 2:
                    out.append((at, k, dims, order))
                at += 8 * dims * k
            elif base in (4, 5, 6, 7):
                at = walk(at)
            else:
                raise ValueError("kind")
        return at

    try:
        walk(0)
    except (struct.error, ValueError, IndexError):
        return []
    return out


def read(blobs: Sequence[bytes | None]) -> Rings:
    groups: dict[int, list[int]] = defaultdict(list)
    for i, b in enumerate(blobs):
        if isinstance(b, (bytes, bytearray, memoryview)) and len(b) > 20:
            groups[len(b)].append(i)
    xy: list[np.ndarray] = []
    size: list[np.ndarray] = []
    geom: list[np.ndarray] = []

    def alone(i: int, rings: list[tuple[int, int, int, str]], b: bytes) -> None:
        for at, k, dims, order in rings:
            xy.append(np.frombuffer(b, order + "f8", k * dims, at).reshape(k, dims)[:, :2].astype(float))
            size.append(np.array([k]))
            geom.append(np.array([i]))

    for length, where in groups.items():
        left = where
        while len(left) > 3:
            flat = np.frombuffer(b"".join(bytes(blobs[i]) for i in left), dtype=np.uint8).reshape(len(left), length)
            rings = _layout(flat[0].tobytes())
            head = np.ones(length, dtype=bool)
            for at, k, dims, _ in rings:
                head[at : at + 8 * dims * k] = False
            same = (flat[:, head] == flat[0, head]).all(axis=1)
            ids = np.array(left)[same]
            if rings:
                parts = [np.ascontiguousarray(flat[same, at : at + 8 * dims * k]).view(order + "f8").reshape(len(ids), k, dims)[:, :, :2] for at, k, dims, order in rings]
                xy.append(np.concatenate(parts, axis=1).astype(float).reshape(-1, 2))
                size.append(np.tile([k for _, k, _, _ in rings], len(ids)))
                geom.append(np.repeat(ids, len(rings)))
            left = [i for i, s in zip(left, same) if not s]
        for i in left:
            alone(i, _layout(bytes(blobs[i])), bytes(blobs[i]))
    if not xy:
        return Rings(np.empty((0, 2)), np.zeros(1, dtype=np.int64), np.empty(0, dtype=np.int64), len(blobs))
    pts, sizes, geoms = np.concatenate(xy), np.concatenate(size), np.concatenate(geom)
    start = np.r_[0, np.cumsum(sizes)]
    bad = np.unique(np.repeat(geoms, sizes)[~np.isfinite(pts).all(axis=1)])
    order = np.argsort(geoms, kind="stable")
    if len(bad):
        order = order[~np.isin(geoms[order], bad)]
    if len(bad) or not (np.diff(geoms) >= 0).all():
        pts = pts[spans(start[order], start[order + 1])[1]]
        sizes, geoms = sizes[order], geoms[order]
        start = np.r_[0, np.cumsum(sizes)]
    return Rings(pts, start.astype(np.int64), geoms.astype(np.int64), len(blobs))


def polygon(*rings: Sequence[tuple[float, float]]) -> bytes:
    """WKB of one polygon (for tests and writers)."""
    return b"\x01" + struct.pack("<II", 3, len(rings)) + b"".join(
        struct.pack("<I", len(r)) + np.asarray(r, dtype="<f8").tobytes() for r in rings
    )


def multipolygon(*polygons: bytes) -> bytes:
    return b"\x01" + struct.pack("<II", 6, len(polygons)) + b"".join(polygons)


def spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, member) of the ranges lo[i]..hi[i], flattened."""
    n = np.maximum(hi - lo, 0)
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def sweep_inside(px: np.ndarray, py: np.ndarray, rings: Rings, chunk: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """(point, geometry) of every point strictly inside a geometry.

    Plane sweep from west to east over points and edges: an edge is alive between
    its ends and meets the points there, so a point sees the edges its vertical
    line crosses and no others. Those above it decide by parity, geometry by
    geometry; points on an edge are out. The sweep goes on in steps of about
    ``chunk`` meetings, whatever the number of vertices of a polygon.
    """
    r = rings.unwrapped()
    box = r.bounds()
    ids = np.arange(len(px))
    if len(box) and np.nanmax(np.abs(box[:, [0, 2]]), initial=0) > 180:  # regions over the antimeridian
        px, py, ids = np.r_[px, px + 360, px - 360], np.tile(py, 3), np.tile(ids, 3)
    order = np.argsort(px, kind="stable")
    sx, sy = px[order], py[order]
    edges, eg = r.edges()
    # the points of an edge's west-east range
    lo = np.searchsorted(sx, np.minimum(edges[:, 0], edges[:, 2]), side="left")
    hi = np.searchsorted(sx, np.maximum(edges[:, 0], edges[:, 2]), side="right")
    live = np.flatnonzero(hi > lo)
    live = live[np.argsort(lo[live], kind="stable")]
    births = lo[live]
    alive = np.zeros(len(sx) + 1, dtype=np.int64)
    np.add.at(alive, lo[live], 1)
    np.add.at(alive, hi[live], -1)
    meetings = np.cumsum(np.cumsum(alive)[:-1])
    out_p, out_g = [], []
    active = np.empty(0, dtype=np.int64)
    at = born = 0
    while at < len(sx):
        done = meetings[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(meetings, done + chunk, side="right")))
        new = int(np.searchsorted(births, end, side="left"))
        active = np.r_[active[hi[active] > at], live[born:new]]
        born = new
        e, p = spans(np.maximum(lo[active], at), np.minimum(hi[active], end))
        e = active[e]
        g, y = eg[e], sy[p]
        ok = (y >= box[g, 1]) & (y <= box[g, 3])
        e, p, g, y = e[ok], p[ok], g[ok], y[ok]
        x, (x0, y0, x1, y1) = sx[p], edges[e].T
        cross = (x1 - x0) * (y - y0) - (y1 - y0) * (x - x0)
        on = (cross == 0) & (y >= np.minimum(y0, y1)) & (y <= np.maximum(y0, y1))
        above = ((x0 <= x) != (x1 <= x)) & ((cross < 0) == (x1 > x0))
        pair, which = np.unique(p * r.n_geoms + g, return_inverse=True)
        inside = (np.bincount(which, above, len(pair)) % 2 == 1) & (np.bincount(which, on, len(pair)) == 0)
        out_p.append(ids[order[pair[inside] // r.n_geoms]])
        out_g.append(pair[inside] % r.n_geoms)
        at = end
    if not out_p:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(out_p).astype(np.int64), np.concatenate(out_g).astype(np.int64)
