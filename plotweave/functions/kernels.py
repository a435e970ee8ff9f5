"""Polygon kernels over whole batches: geometries with one ring are stacked by
their number of vertices and worked on together; the others go one by one
through ``overlay``."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

from plotweave.functions import overlay, wkb

#: Array cells of a chunk; vertices up to which all pairs of edges are compared.
CHUNK, FEW = 2_000_000, 48

# WGS 84 and the order-2 Krueger series.
E, RADIUS, A1, A2, SCALE = 0.08181919084262157, 6367449.14582, 8.377318206e-4, 7.608527773e-7, 0.9996


def closed(r: wkb.Rings) -> wkb.Rings:
    """Rings end where they begin."""
    if not len(r.xy):
        return r
    first, last = r.xy[r.start[:-1]], r.xy[r.start[1:] - 1]
    gap = (first != last).any(axis=1)
    if not gap.any():
        return r
    xy = np.insert(r.xy, r.start[1:][gap], first[gap], axis=0)
    return wkb.Rings(xy, np.r_[0, np.cumsum(np.diff(r.start) + gap)], r.geom, r.n_geoms)


def stacks(r: wkb.Rings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(geometries, vertices m x n x 2) of the geometries with one ring."""
    one = np.flatnonzero(np.bincount(r.geom, minlength=r.n_geoms)[r.geom] == 1)
    size = np.diff(r.start)[one]
    for n in np.unique(size):
        rings = one[size == n]
        yield r.geom[rings], r.xy[r.start[rings][:, None] + np.arange(n)]


def regions(r: wkb.Rings, which: Sequence[int] | np.ndarray) -> Iterator[tuple[int, overlay.Region]]:
    """The rings of the named geometries (those that have any), one by one."""
    lo, hi = np.searchsorted(r.geom, which), np.searchsorted(r.geom, which, side="right")
    for g, a, b in zip(which, lo, hi):
        if b > a:
            yield int(g), [r.xy[r.start[k] : r.start[k + 1]] for k in range(a, b)]


def doubled_areas(p: np.ndarray) -> np.ndarray:
    """Twice the signed area of each stacked ring."""
    q = p - p[:, :1]
    return (q[:, :-1, 0] * q[:, 1:, 1] - q[:, 1:, 0] * q[:, :-1, 1]).sum(axis=1)


def write(r: wkb.Rings) -> list[bytes | None]:
    """WKB of each geometry, outer rings counter-clockwise."""
    out: list[bytes | None] = [None] * r.n_geoms
    done = np.zeros(r.n_geoms, dtype=bool)
    for ids, p in stacks(r):
        done[ids] = True
        if p.shape[1] < 4:
            continue
        p = np.where((doubled_areas(p) > 0)[:, None, None], p, p[:, ::-1])
        head = np.frombuffer(wkb.polygon(p[0])[:13], dtype=np.uint8)
        body = np.ascontiguousarray(p, dtype="<f8").reshape(len(p), -1).view(np.uint8)
        flat, length = np.hstack([np.tile(head, (len(p), 1)), body]).tobytes(), 13 + body.shape[1]
        for k, i in enumerate(ids.tolist()):
            out[i] = flat[k * length : (k + 1) * length]
    for i, region in regions(r, np.flatnonzero(~done)):
        out[i] = overlay.to_wkb(region)
    return out


def crosses(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """z of the cross product."""
    return a[..., 0] * b[..., 1] - a[..., 1] * b[..., 0]


def sound(p: np.ndarray) -> np.ndarray:
    """Stacked rings without repeated vertices, area 0, or edges that cross."""
    d = np.diff(p, axis=1)
    ok = (d != 0).any(axis=2).all(axis=1) & (doubled_areas(p) != 0)
    e = d.shape[1]
    step = max(1, CHUNK // (e * e))
    for k in range(0, len(p), step):
        q, s = p[k : k + step, :-1], d[k : k + step]
        den = crosses(s[:, :, None], s[:, None])
        w = q[:, None] - q[:, :, None]
        with np.errstate(all="ignore"):
            t, u = crosses(w, s[:, None]) / den, crosses(w, s[:, :, None]) / den
            ok[k : k + step] &= ~((den != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)).any(axis=(1, 2))
    return ok


def cleaned(r: wkb.Rings) -> list[bytes | None]:
    """WKB of each geometry, repaired where it needs to be."""
    r = closed(r)
    fine = np.zeros(r.n_geoms, dtype=bool)
    for ids, p in stacks(r):
        if 4 <= p.shape[1] <= FEW:
            fine[ids[sound(p)]] = True
    out = write(only(r, fine))
    for i, region in regions(r, np.flatnonzero(~fine)):
        out[i] = overlay.to_wkb(overlay.repaired(region))
    return out


def only(r: wkb.Rings, which: np.ndarray) -> wkb.Rings:
    """The rings of the marked geometries; the others have none."""
    keep = which[r.geom]
    size = np.diff(r.start)
    return wkb.Rings(r.xy[np.repeat(keep, size)], np.r_[0, np.cumsum(size[keep])], r.geom[keep], r.n_geoms)


def snapped(r: wkb.Rings, grid: np.ndarray) -> wkb.Rings:
    step = grid[r.vertex_geom()][:, None]
    return wkb.Rings(np.round(r.xy / step) * step, r.start, r.geom, r.n_geoms)


def inner_points(r: wkb.Rings) -> np.ndarray:
    """n x 2 points inside, NaN where there is none: middle of the widest span at
    the height half-way between the vertex heights around the centre's."""
    r = closed(r)
    out = np.full((r.n_geoms, 2), np.nan)
    done = np.zeros(r.n_geoms, dtype=bool)
    for ids, p in stacks(r):
        done[ids] = True
        x, y = p[..., 0], p[..., 1]
        mid = ((y.min(axis=1) + y.max(axis=1)) / 2)[:, None]
        low = np.where(y <= mid, y, -np.inf).max(axis=1)
        high = np.where(y > mid, y, np.inf).min(axis=1)
        h = ((low + high) / 2)[:, None]
        x0, y0, x1, y1 = x[:, :-1], y[:, :-1], x[:, 1:], y[:, 1:]
        hit = (y0 > h) != (y1 > h)
        with np.errstate(all="ignore"):
            at = np.sort(np.where(hit, (x1 - x0) * (h - y0) / (y1 - y0) + x0, np.inf), axis=1)
            at = at[:, : at.shape[1] // 2 * 2]
            wide = at[:, 1::2] - at[:, ::2]
        wide = np.where(np.isfinite(wide), wide, 0)
        best = wide.argmax(axis=1)
        row = np.arange(len(p))
        ok = wide[row, best] > 0
        out[ids[ok], 0] = ((at[:, ::2] + at[:, 1::2])[row, best] / 2)[ok]
        out[ids[ok], 1] = h[ok, 0]
    for i, region in regions(r, np.flatnonzero(~done)):
        out[i] = overlay.inner_point(region) or (np.nan, np.nan)
    return out


def utm(xy: np.ndarray, zone: np.ndarray) -> np.ndarray:
    """Easting and northing of longitudes and latitudes (northern origin)."""
    phi, lam = np.radians(xy[:, 1]), np.radians(xy[:, 0] - (zone * 6 - 183))
    t = np.sinh(np.arctanh(np.sin(phi)) - E * np.arctanh(E * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arcsinh(np.sin(lam) / np.hypot(t, np.cos(lam)))
    east, north = eta.copy(), xi.copy()
    for j, a in ((2, A1), (4, A2)):
        east += a * np.cos(j * xi) * np.sinh(j * eta)
        north += a * np.sin(j * xi) * np.cosh(j * eta)
    return np.stack([500000 + SCALE * RADIUS * east, SCALE * RADIUS * north], axis=1)


def degrees(xy: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Longitudes and latitudes of eastings and northings (code: a UTM zone,
    negative in the south, or 100 for web Mercator)."""
    out = np.empty_like(xy)
    web = code == 100
    out[web, 0] = np.degrees(xy[web, 0] / 6378137.0)
    out[web, 1] = np.degrees(np.arctan(np.sinh(xy[web, 1] / 6378137.0)))
    at = ~web
    zone = np.abs(code[at])
    north = np.where(code[at] < 0, xy[at, 1] - 10_000_000.0, xy[at, 1])
    # start on the sphere, then undo what the projection gets wrong
    guess = np.stack([(xy[at, 0] - 500000) / 85000.0 + zone * 6 - 183, np.degrees(north / (SCALE * RADIUS))], axis=1)
    goal = np.stack([xy[at, 0], north], axis=1)
    for _ in range(30):
        miss = goal - utm(guess, zone)
        guess[:, 1] = np.clip(guess[:, 1] + np.degrees(miss[:, 1] / (SCALE * RADIUS)), -89.9, 89.9)
        guess[:, 0] += np.degrees(miss[:, 0] / (SCALE * RADIUS * np.cos(np.radians(guess[:, 1]))))
        if np.abs(miss).max(initial=0) < 1e-7:
            break
    out[at] = guess
    return out


def projected(r: wkb.Rings, zone: np.ndarray) -> wkb.Rings:
    """Vertices in metres of each geometry's zone; zone 0 leaves them alone."""
    z = zone[r.vertex_geom()] if len(r.xy) else np.zeros(0)
    xy, at = r.xy.copy(), z > 0
    xy[at] = utm(xy[at], z[at])
    return wkb.Rings(xy, r.start, r.geom, r.n_geoms)


def _edge_part(p: np.ndarray, q: np.ndarray, count_shared: bool) -> np.ndarray:
    """Integral of x dy - y dx, halved, over the parts of the edges of ``p``
    inside ``q``; edges both have (in the same direction) count if asked for."""
    a, d, b, e = p[:, :-1], np.diff(p, axis=1), q[:, :-1], np.diff(q, axis=1)
    den = crosses(d[:, :, None], e[:, None])
    w = b[:, None] - a[:, :, None]
    with np.errstate(all="ignore"):
        t, u = crosses(w, e[:, None]) / den, crosses(w, d[:, :, None]) / den
        t = np.where((den != 0) & (t > 0) & (t < 1) & (u >= 0) & (u <= 1), t, 1.0)
    cuts = np.sort(np.concatenate([np.zeros((*t.shape[:2], 1)), t, np.ones((*t.shape[:2], 1))], axis=2), axis=2)
    mid = a[:, :, None] + ((cuts[..., 1:] + cuts[..., :-1]) / 2)[..., None] * d[:, :, None]
    x, y = mid[..., 0, None], mid[..., 1, None]
    x0, y0 = b[:, None, None, :, 0], b[:, None, None, :, 1]
    ex, ey = e[:, None, None, :, 0], e[:, None, None, :, 1]
    off = ex * (y - y0) - ey * (x - x0)
    up = (y0 > y) != (y0 + ey > y)
    inside = (up & ((off > 0) == (ey > 0)) & (off != 0)).sum(axis=3) % 2 == 1
    long2 = ex * ex + ey * ey
    reach = ((q.max(axis=1) - q.min(axis=1)).max(axis=1) * 1e-9)[:, None, None, None]
    along = (x - x0) * ex + (y - y0) * ey
    on = (np.abs(off) <= reach * np.sqrt(long2)) & (along >= 0) & (along <= long2) & (np.abs(den) <= 1e-9 * np.sqrt((d**2).sum(axis=2)[:, :, None] * (e**2).sum(axis=2)[:, None]))[:, :, None]
    same = (d[:, :, None] * e[:, None]).sum(axis=3)[:, :, None] > 0
    inside = np.where(on.any(axis=3), (on & same).any(axis=3) & count_shared, inside)
    return (np.where(inside, np.diff(cuts, axis=2), 0).sum(axis=2) * crosses(a, d)).sum(axis=1) / 2


def shared_stacks(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Areas of the intersections of stacked simple rings, pair by pair: by
    Green's theorem over the parts of either boundary inside the other ring."""
    origin = p[:, :1].copy()
    p, q = p - origin, q - origin
    p = np.where((doubled_areas(p) > 0)[:, None, None], p, p[:, ::-1])
    q = np.where((doubled_areas(q) > 0)[:, None, None], q, q[:, ::-1])
    step = max(1, CHUNK // (p.shape[1] * q.shape[1] * max(p.shape[1], q.shape[1])))
    parts = [_edge_part(p[k : k + step], q[k : k + step], True) + _edge_part(q[k : k + step], p[k : k + step], False) for k in range(0, len(p), step)]
    return np.maximum(np.concatenate(parts), 0) if parts else np.zeros(0)


def areas(r: wkb.Rings) -> np.ndarray:
    out = np.zeros(r.n_geoms)
    done = np.zeros(r.n_geoms, dtype=bool)
    for ids, p in stacks(r):
        done[ids], out[ids] = True, np.abs(doubled_areas(p)) / 2
    for i, region in regions(r, np.flatnonzero(~done)):
        out[i] = abs(overlay.region_area(region))
    return out


def shared_areas(a: wkb.Rings, b: wkb.Rings) -> np.ndarray:
    """Area that each pair of geometries shares."""
    n = a.n_geoms
    out, done = np.zeros(n), np.zeros(n, dtype=bool)
    slot = np.full(n, -1)
    for qs, q in stacks(b):
        if q.shape[1] > FEW:
            continue
        slot[:] = -1
        slot[qs] = np.arange(len(qs))
        for ps, p in stacks(a):
            both = slot[ps] >= 0
            if p.shape[1] <= FEW and both.any():
                ids = ps[both]
                out[ids], done[ids] = shared_stacks(p[both], q[slot[ids]]), True
    rest = np.flatnonzero(~done)
    left, right = dict(regions(a, rest)), dict(regions(b, rest))
    for i in left.keys() & right.keys():
        out[i] = overlay.shared_area(left[i], right[i])
    return out


def clipped(r: wkb.Rings, clipper: overlay.Clipper) -> list[bytes | None]:
    """WKB of the part of each geometry inside the clipper's boundary. Geometries
    that none of its edges come near are in or out as their first vertex is."""
    r = closed(r)
    if clipper.box is None or not len(r.xy):
        return [None] * r.n_geoms
    box = r.bounds()
    with np.errstate(invalid="ignore"):
        meets = (box[:, :2] < clipper.box[1]).all(axis=1) & (box[:, 2:] > clipper.box[0]).all(axis=1)
    e = clipper.edges
    low, high = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    near = np.zeros(r.n_geoms, dtype=bool)
    live = np.flatnonzero(meets)
    step = max(1, CHUNK // max(len(e), 1))
    for k in range(0, len(live), step):
        b = box[live[k : k + step], None]
        near[live[k : k + step]] = ((high >= b[..., :2]) & (low <= b[..., 2:])).all(axis=2).any(axis=1)
    far = np.flatnonzero(meets & ~near)
    first = r.xy[r.start[np.searchsorted(r.geom, far)]]
    where, _ = wkb.sweep_inside(first[:, 0], first[:, 1], wkb.read([overlay.to_wkb(clipper.region)]))
    inside = np.zeros(r.n_geoms, dtype=bool)
    inside[far[where]] = True
    out = cleaned(only(r, inside))
    for i, region in regions(r, np.flatnonzero(near)):
        out[i] = overlay.to_wkb(clipper.clip(region))
    return out
