"""Polygon kernels in NumPy: repair, clip, shared area, interior point.

A geometry is a list of rings (arrays of closed vertices) under the even-odd
rule. Regions that need rebuilding are cut into horizontal slabs between all
vertex and crossing heights; inside a slab no edges cross, so the region is a
row of trapezoids there, and trapezoids between the same pair of edges are
joined across slabs. The result covers the same points as an exact overlay but
may be cut into more parts than other libraries give.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from plotweave.functions import wkb

Region = list  # of (n, 2) arrays


def polygons(blobs: Sequence[bytes | None]) -> list[Region | None]:
    """Rings of each blob, or None."""
    r = wkb.read(blobs)
    out: list[Region | None] = [None] * len(blobs)
    for k, g in enumerate(r.geom):
        if out[g] is None:
            out[g] = []
        ring = r.xy[r.start[k] : r.start[k + 1]]
        out[g].append(ring if (ring[0] == ring[-1]).all() else np.vstack([ring, ring[:1]]))
    return out


def signed_area(ring: np.ndarray) -> float:
    p = ring - ring[0]
    return float((p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]).sum() / 2)


def _inside(x: float, y: float, region: Region) -> bool:
    n = 0
    for r in region:
        x0, y0, x1, y1 = r[:-1, 0], r[:-1, 1], r[1:, 0], r[1:, 1]
        hit = (y0 > y) != (y1 > y)
        n += int((x < (x1[hit] - x0[hit]) * (y - y0[hit]) / (y1[hit] - y0[hit]) + x0[hit]).sum())
    return n % 2 == 1


def _ring_point(ring: np.ndarray) -> tuple[float, float]:
    """A point of the ring itself (for nesting tests)."""
    x, y = (ring[0] + ring[1]) / 2
    return float(x), float(y)


def oriented(region: Region) -> list[tuple[np.ndarray, int]]:
    """(ring, depth): outer rings counter-clockwise, holes clockwise."""
    out = []
    for k, ring in enumerate(region):
        depth = 0
        if len(region) > 1:
            x, y = _ring_point(ring)
            depth = sum(_inside(x, y, [other]) for j, other in enumerate(region) if j != k)
        if (signed_area(ring) > 0) == bool(depth % 2):
            ring = ring[::-1]
        out.append((ring, depth))
    return out


def region_area(region: Region) -> float:
    return sum(signed_area(r) for r, _ in oriented(region))


def parts(region: Region) -> list[Region]:
    """Each outer ring with its holes."""
    if len(region) == 1:
        return [region]
    nested = oriented(region)
    outers = [(r, d, [r]) for r, d in nested if d % 2 == 0]
    for r, d in nested:
        if d % 2:
            x, y = _ring_point(r)
            home = next((o for o in outers if o[1] == d - 1 and _inside(x, y, [o[0]])), None)
            if home:
                home[2].append(r)
    return [rs for _, _, rs in outers]


def to_wkb(region: Sequence) -> bytes | None:
    """Polygon or multipolygon; holes go to the outer ring around them."""
    rings = [np.asarray(r, dtype=float) for r in region if len(r) > 3]
    if not rings:
        return None
    if len(rings) == 1:
        return wkb.polygon(rings[0] if signed_area(rings[0]) > 0 else rings[0][::-1])
    pieces = [wkb.polygon(*rs) for rs in parts(rings)]
    return None if not pieces else pieces[0] if len(pieces) == 1 else wkb.multipolygon(*pieces)


def inner_point(region: Region) -> tuple[float, float] | None:
    """Middle of the widest inside span of all parts, taken half-way between the
    vertex heights around the middle of the part."""
    best = None
    for part in parts(region):
        ys = np.unique(np.concatenate([r[:, 1] for r in part]))
        if len(ys) < 2:
            continue
        mid = (ys[0] + ys[-1]) / 2
        y = (ys[ys <= mid].max() + ys[ys > mid].min()) / 2
        for a, b in _spans(part, y):
            if b > a and (best is None or b - a > best[0]):
                best = b - a, float(a + b) / 2, float(y)
    return None if best is None else best[1:]


def _spans(region: Region, y: float) -> list[tuple[float, float]]:
    xs = []
    for r in region:
        x0, y0, x1, y1 = r[:-1, 0], r[:-1, 1], r[1:, 0], r[1:, 1]
        hit = (y0 > y) != (y1 > y)
        xs += ((x1[hit] - x0[hit]) * (y - y0[hit]) / (y1[hit] - y0[hit]) + x0[hit]).tolist()
    xs.sort()
    return list(zip(xs[::2], xs[1::2]))


def snapped(region: Region, grid: float) -> Region:
    return [np.round(r / grid) * grid for r in region]


def _distinct(ring: np.ndarray) -> np.ndarray:
    return ring[np.r_[True, (ring[1:] != ring[:-1]).any(axis=1)]]


def _tidy(ring: np.ndarray) -> np.ndarray | None:
    ring = _distinct(ring)
    return ring if len(ring) > 3 and signed_area(ring) != 0 else None


def _edges(region: Region) -> np.ndarray:
    return np.concatenate([np.hstack([r[:-1], r[1:]]) for r in region]) if region else np.empty((0, 4))


def _near_pairs(a: np.ndarray, b: np.ndarray, chunk: int = 1_000_000):
    """Index pairs of edges whose boxes meet, some at a time: the edges of ``b``
    in order of their lower ends are met by a sweep."""
    low, high = np.minimum(b[:, 1], b[:, 3]), np.maximum(b[:, 1], b[:, 3])
    order = np.argsort(low, kind="stable")
    low, tall = low[order], float((high - low[np.argsort(order)]).max(initial=0))
    bottom, top = np.minimum(a[:, 1], a[:, 3]), np.maximum(a[:, 1], a[:, 3])
    first, last = np.searchsorted(low, bottom - tall, side="left"), np.searchsorted(low, top, side="right")
    done = np.cumsum(last - first)
    at = 0
    while at < len(a):
        end = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + chunk, side="right")))
        i, j = wkb.spans(first[at:end], last[at:end])
        i, j = i + at, order[j]
        ok = (high[j] >= bottom[i]) & (np.maximum(a[i, 0], a[i, 2]) >= np.minimum(b[j, 0], b[j, 2])) & (np.minimum(a[i, 0], a[i, 2]) <= np.maximum(b[j, 0], b[j, 2]))
        yield i[ok], j[ok]
        at = end


def _crossings(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Heights where edges of ``a`` properly cross edges of ``b``."""
    out = [np.empty(0)]
    for i, j in _near_pairs(a, b):
        ax, ay, bx, by = a[i].T
        cx, cy, dx, dy = b[j].T
        den = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
        with np.errstate(all="ignore"):
            t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / den
            u = ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / den
        ok = (den != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        out.append((ay + t * (by - ay))[ok])
    return np.concatenate(out)


def crosses_itself(region: Region) -> bool:
    e = _edges(region)
    return len(_crossings(e, e)) > 0


def _build(regions: Sequence[Region], keep) -> Region:
    """Trapezoids of the points for which ``keep(inside flags)`` holds, joined
    upwards along equal edges."""
    edges = [_edges(r) for r in regions]
    every = np.concatenate(edges)
    owner = np.repeat(np.arange(len(edges)), [len(e) for e in edges])
    ys = np.unique(np.concatenate([every[:, 1], every[:, 3], _crossings(every, every)]))
    done: Region = []
    growing: dict[tuple[int, int], tuple[list, list]] = {}
    for low, high in zip(ys[:-1], ys[1:]):
        mid = (low + high) / 2
        on = np.flatnonzero((every[:, 1] > mid) != (every[:, 3] > mid))
        x0, y0, x1, y1 = every[on].T
        at = [(x1 - x0) * (y - y0) / (y1 - y0) + x0 for y in (low, mid, high)]
        order = np.argsort(at[1], kind="stable")
        flags = [False] * len(edges)
        left, now = None, {}
        for k in order:
            was = keep(flags)
            flags[owner[on[k]]] ^= True
            new = keep(flags)
            if new and not was:
                left = k
            elif was and not new and left is not None and at[1][k] > at[1][left]:
                now[int(on[left]), int(on[k])] = (at[0][left], at[0][k], at[2][left], at[2][k])
        nxt: dict[tuple[int, int], tuple[list, list]] = {}
        for pair, (a, b, c, d) in now.items():
            lefts, rights = growing.pop(pair, ([(a, low)], [(b, low)]))
            nxt[pair] = [*lefts[:1], (c, high)], [*rights[:1], (d, high)]
        done += [_close(*g) for g in growing.values()]
        growing = nxt
    done += [_close(*g) for g in growing.values()]
    return [r for r in done if r is not None]


def _close(lefts: list, rights: list) -> np.ndarray | None:
    return _tidy(np.array([*rights, *reversed(lefts), rights[0]], dtype=float))


def repaired(region: Region) -> Region:
    rings = [r for r in map(_distinct, region) if len(r) > 3]
    if rings and crosses_itself(rings):
        return _build([rings], lambda f: f[0])
    return [r for r in rings if signed_area(r) != 0]


def united(regions: Sequence[Region]) -> Region:
    """Points in any of the regions."""
    return _build([repaired(r) for r in regions], any)


def convex(region: Region) -> bool:
    if len(region) != 1:
        return False
    d = np.diff(region[0], axis=0)
    turn = d[:, 0] * np.roll(d[:, 1], -1) - d[:, 1] * np.roll(d[:, 0], -1)
    return bool((turn >= 0).all() or (turn <= 0).all())


def cut_convex(ring: np.ndarray, window: np.ndarray) -> np.ndarray | None:
    """Sutherland-Hodgman: the part of ``ring`` inside a convex, counter-clockwise window."""
    pts = [tuple(p) for p in ring[:-1].tolist()]
    w = window.tolist()
    for (ax, ay), (bx, by) in zip(w[:-1], w[1:]):
        out = []
        side = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for x, y in pts]
        for k, (p, s) in enumerate(zip(pts, side)):
            q, t = pts[k - 1], side[k - 1]
            if (s >= 0) != (t >= 0):
                f = t / (t - s)
                out.append((q[0] + f * (p[0] - q[0]), q[1] + f * (p[1] - q[1])))
            if s >= 0:
                out.append(p)
        pts = out
        if len(pts) < 3:
            return None
    return _tidy(np.array([*pts, pts[0]]))


class Clipper:
    """Clips regions to one boundary; untouched ones pass through."""

    def __init__(self, boundary: Region | None):
        self.region = boundary or []
        self.edges = _edges(self.region)
        self.box = (self.edges[:, :2].min(axis=0), self.edges[:, :2].max(axis=0)) if len(self.edges) else None
        self.convex = convex(self.region) if self.region else False
        if self.convex and signed_area(self.region[0]) < 0:
            self.region = [self.region[0][::-1]]

    def clip(self, region: Region) -> Region:
        region = repaired(region)
        if self.box is None or not region:
            return []
        pts = np.concatenate(region)
        if (pts.max(axis=0) <= self.box[0]).any() or (pts.min(axis=0) >= self.box[1]).any():
            return []
        e = _edges(region)
        near = self.edges[
            (np.maximum(self.edges[:, 0], self.edges[:, 2]) >= pts[:, 0].min()) & (np.minimum(self.edges[:, 0], self.edges[:, 2]) <= pts[:, 0].max())
            & (np.maximum(self.edges[:, 1], self.edges[:, 3]) >= pts[:, 1].min()) & (np.minimum(self.edges[:, 1], self.edges[:, 3]) <= pts[:, 1].max())
        ]
        if not len(near):  # all in or all out
            return region if _inside(*pts[0], self.region) else []
        if self.convex and len(region) == 1 and convex(region):
            one = cut_convex(region[0], self.region[0])
            return [] if one is None else [one]
        return _build([region, self.region], lambda f: f[0] and f[1]) if len(e) else []


def _fan(region: Region, origin: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Signed triangles origin-edge whose signed sum is the region."""
    out = []
    for ring, _ in oriented(region):
        for p, q in zip(ring[:-1] - origin, ring[1:] - origin):
            s = p[0] * q[1] - p[1] * q[0]
            if s:
                a, b = (p, q) if s > 0 else (q, p)
                out.append((np.array([(0.0, 0.0), a, b, (0.0, 0.0)]), 1 if s > 0 else -1))
    return out


def shared_area(a: Region, b: Region) -> float:
    """Area of the intersection: convex pairs directly, others as the signed sum
    over pairs of fan triangles."""
    pa, pb = np.concatenate(a), np.concatenate(b)
    if (pa.max(axis=0) <= pb.min(axis=0)).any() or (pb.max(axis=0) <= pa.min(axis=0)).any():
        return 0.0
    if convex(a) and convex(b):
        window = b[0] if signed_area(b[0]) > 0 else b[0][::-1]
        one = cut_convex(a[0], window)
        return 0.0 if one is None else abs(signed_area(one))
    origin = np.minimum(pa.min(axis=0), pb.min(axis=0)) - 1e-3 * (np.ptp(pa, axis=0) + 1e-12)
    total = 0.0
    for s, i in _fan(a, origin):
        for t, j in _fan(b, origin):
            one = cut_convex(s, t)
            if one is not None:
                total += i * j * abs(signed_area(one))
    return max(total, 0.0)
