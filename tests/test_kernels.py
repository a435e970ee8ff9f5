"""Batch kernels against the one-by-one ones and against plain sampling."""

import numpy as np
import pytest

from plotweave.functions import kernels, overlay, wkb


def star(rng, n, at=(0.0, 0.0), size=1.0):
    """A simple ring around a centre, mostly not convex."""
    a = (np.arange(n) + 0.8 * rng.random(n)) / n * 2 * np.pi
    r = size * (0.2 + rng.random(n))
    xy = np.stack([at[0] + r * np.cos(a), at[1] + r * np.sin(a)], axis=1)
    return np.vstack([xy, xy[:1]])


def rings(regions):
    return wkb.read([None if r is None else overlay.to_wkb(r) for r in regions])


def test_shared_areas():
    rng = np.random.default_rng(3)
    a = [[star(rng, rng.integers(4, 9))] for _ in range(60)]
    b = [[star(rng, rng.integers(4, 9), rng.random(2))] for _ in range(60)]
    want = [overlay.shared_area(x, y) for x, y in zip(a, b)]
    assert np.allclose(kernels.shared_areas(rings(a), rings(b)), want, atol=1e-9) and sum(w > 0 for w in want) > 30
    grid = np.stack(np.meshgrid(*[np.linspace(-2, 2, 401)] * 2), axis=-1).reshape(-1, 2)
    for x, y, w in list(zip(a, b, want))[:5]:
        inside = [set(wkb.sweep_inside(grid[:, 0], grid[:, 1], rings([r]))[0].tolist()) for r in (x, y)]
        assert len(inside[0] & inside[1]) * 1e-4 == pytest.approx(w, abs=0.02)


def test_shared_edges():
    """Equal, touching, nested and crossing boxes and an L, in every order of vertices."""
    def box(x, y, w, h=None):
        h = w if h is None else h
        return np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)], dtype=float)

    el = np.array([(0, 0), (3, 0), (3, 1), (1, 1), (1, 3), (0, 3), (0, 0)], dtype=float)
    cases = [(box(0, 0, 2), box(0, 0, 2), 4), (box(0, 0, 2), box(2, 0, 2), 0), (box(0, 0, 2), box(0, 2, 2), 0), (box(0, 0, 2), box(0.5, 0.5, 1), 1), (box(0, 0, 2), box(1, 0, 2), 2),
             (box(0, 0, 2), box(0, 0, 1), 1), (el, box(1, 1, 2), 0), (el, box(0, 0, 3), 5), (el, el, 5), (el, box(0.5, 0.5, 2), 1.75), (box(0, 0, 2), box(5, 5, 1), 0)]
    for f in (lambda r: r, lambda r: r[::-1]):
        for g in (lambda r: r, lambda r: r[::-1]):
            for x, y, want in cases:
                p, q = f(x)[None], g(y)[None]
                assert kernels.shared_stacks(p, q)[0] == pytest.approx(want, abs=1e-12)
                assert kernels.shared_stacks(q + 1e6, p + 1e6)[0] == pytest.approx(want, abs=1e-6)


def test_clean_and_points():
    rng = np.random.default_rng(5)
    bow = np.array([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)], dtype=float)
    hole = [star(rng, 12, size=4.0), star(rng, 5, size=0.3)]
    regions = [[star(rng, rng.integers(4, 12), rng.random(2) * 9)] for _ in range(80)] + [[bow], hole, None, [np.array([(0, 0), (1, 1), (2, 2), (0, 0)], dtype=float)]]
    blobs = [None if r is None else (wkb.polygon(*r)) for r in regions]
    got = kernels.cleaned(wkb.read(blobs))
    want = [None if r is None else overlay.to_wkb(overlay.repaired(r)) for r in overlay.polygons(blobs)]
    assert got == want and got[-1] is got[-2] is None
    points = kernels.inner_points(wkb.read(got))
    for blob, p in zip(got, points):
        if blob is None:
            assert np.isnan(p).all()
        else:
            assert len(wkb.sweep_inside(p[:1], p[1:], wkb.read([blob]))[0]) == 1
    single = [r for r in overlay.polygons(got) if r is not None and len(r) == 1]
    assert np.allclose([overlay.inner_point(r) for r in single], kernels.inner_points(rings(single)))


def test_widest_part_gives_the_point():
    two = overlay.to_wkb([star(np.random.default_rng(1), 9), np.array([(10, 0), (19, 0), (19, 1), (10, 1), (10, 0)], dtype=float)])
    assert kernels.inner_points(wkb.read([two])).tolist() == [[14.5, 0.5]]


def test_clipped():
    rng = np.random.default_rng(7)
    boundary = [star(rng, 10, size=5.0)]
    clipper = overlay.Clipper(boundary)
    regions = [[star(rng, 7, rng.random(2) * 12 - 6, 0.5)] for _ in range(120)]
    got = kernels.clipped(rings(regions), clipper)
    whole = sum(overlay.shared_area(r, boundary) for r in regions)
    assert kernels.areas(wkb.read(got)).sum() == pytest.approx(whole, rel=1e-9) and 20 < sum(b is None for b in got) < 100


def test_many_vertices_are_cleaned():
    """Candidate edges come from a sweep: 20,000 edges need no table of all pairs."""
    a = np.linspace(0, 2 * np.pi, 20_000)
    ring = np.stack([np.cos(a), np.sin(a)], axis=1)
    ring[-1] = ring[0]
    assert kernels.areas(wkb.read(kernels.cleaned(wkb.read([wkb.polygon(ring)]))))[0] == pytest.approx(np.pi, rel=1e-6)
    brute = np.random.default_rng(2).random((300, 4))
    i, j = (np.concatenate(x) for x in zip(*overlay._near_pairs(brute, brute, 500)))
    boxes = [np.minimum(brute[:, :2], brute[:, 2:]), np.maximum(brute[:, :2], brute[:, 2:])]
    meet = (boxes[0][:, None] <= boxes[1][None]).all(axis=2) & (boxes[1][:, None] >= boxes[0][None]).all(axis=2)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(meet))))
