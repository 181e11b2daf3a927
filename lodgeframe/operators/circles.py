"""Numpy kernels of one tile: points within a circle around each place, and the nearest one.

A tile's places and points are turned so that the tile's middle is the third axis. Two points
are then at least as far apart as their first two coordinates say, and the third ones
add at most what they span. Points are sorted by bands of the second coordinate and by the
first one inside a band, so a circle meets one run of points in each band: the run's middle
lies wholly inside and is added up from running sums, only the points at its two ends are
compared. Bands are as many as the root of the points asks for.
"""

from __future__ import annotations

import numpy as np

from lodgeframe.functions.geo import DEG_TO_RAD, EARTH_RADIUS_M

LEAST_BANDS, MOST_BANDS = 4, 96     # bands across a circle
STEP = 2_000                        # places searched at once
PAIRS = 2_000_000                   # pairs compared at once
# Chords this much (relative) around the radius are decided by the distance formula.
CLOSE = 1e-8


def on_sphere(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    p, q = lat * DEG_TO_RAD, lon * DEG_TO_RAD
    return np.column_stack([np.cos(p) * np.cos(q), np.cos(p) * np.sin(q), np.sin(p)])


def turned(xyz: np.ndarray) -> np.ndarray:
    """Axes with the middle of ``xyz`` as the third."""
    middle = xyz.mean(axis=0)
    size = np.linalg.norm(middle)
    third = middle / size if size > 1e-6 else np.array([0.0, 0.0, 1.0])
    first = np.cross(third, np.eye(3)[np.argmin(np.abs(third))])
    first /= np.linalg.norm(first)
    return np.column_stack([first, np.cross(third, first), third])


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Metres between rows (lat, lon): the arithmetic of ``haversine_from_parts``."""
    p, q = a * DEG_TO_RAD, b * DEG_TO_RAD
    s1, s2 = (np.sin((p[:, i] - q[:, i]) / 2.0) for i in (0, 1))
    h = np.clip(s1 * s1 + np.cos(p[:, 0]) * np.cos(q[:, 0]) * s2 * s2, 0.0, 1.0)
    return 2.0 * EARTH_RADIUS_M * np.arctan2(np.sqrt(h), np.sqrt(1.0 - h))


def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, .. n[0] numbers, then those of the next."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


def batches(who: np.ndarray, start: np.ndarray, end: np.ndarray):
    """(who, point) of all runs, ``PAIRS`` or a run at once."""
    n = np.maximum(end - start, 0)
    has = n > 0
    who, start, n = who[has], start[has], n[has]
    group = np.cumsum(n) // PAIRS
    for a, b in zip(*(np.searchsorted(group, np.unique(group), side) for side in ("left", "right"))):
        yield np.repeat(who[a:b], n[a:b]), ranges(start[a:b], n[a:b])


class Points:
    """Points (``at`` in turned axes, ``spot`` lat and lon, ``m`` rows each) in bands for one radius."""

    def __init__(self, at: np.ndarray, spot: np.ndarray, m: np.ndarray, radius_m: float):
        self.radius = radius_m
        # The longest chord; circles of half the globe or more hold all that is on it.
        self.c = 2.0 * np.sin(min(radius_m / (2.0 * EARTH_RADIUS_M), np.pi / 2))
        across = min(MOST_BANDS, max(LEAST_BANDS, int(np.ceil(np.sqrt(len(at) / 8)))))
        self.h = 2.0 * self.c / across
        self.low = at[:, 1].min()
        band = np.floor((at[:, 1] - self.low) / self.h).astype(np.int64)
        order = np.lexsort((at[:, 0], band))
        self.at, self.spot, band = at[order], spot[order], band[order]
        self.before = np.concatenate([[0], np.cumsum(m[order])])
        self.m = m[order]
        self.bands, rank = np.unique(band, return_inverse=True)
        self.start = np.concatenate([np.searchsorted(band, self.bands), [len(band)]])
        self.left, self.right = self.at[:, 0].min(), self.at[:, 0].max()
        self.pad = self.c + 0.01 * (self.right - self.left)
        self.span = self.right - self.left + 4 * self.pad
        self.key = rank * self.span + (self.at[:, 0] - self.left)
        self.slack = 1e-9 * self.c + 8 * np.finfo(float).eps * (2 + abs(self.key[-1]))
        self.far = (CLOSE * self.c + 1e-14) * self.c

    def met(self, at: np.ndarray, reach) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place, rank, least, most): bands with points within ``reach`` of each place, and how
        far they are from it in the second coordinate."""
        first, last = (np.floor((at[:, 1] - self.low + s * (reach + self.slack)) / self.h) for s in (-1, 1))
        first, last = np.maximum(first, 0), np.minimum(last, self.bands[-1])
        # Only bands that hold points are met, however many lie between.
        a = np.searchsorted(self.bands, first)
        n = np.maximum(np.searchsorted(self.bands, last, "right") - a, 0)
        who, rank = np.repeat(np.arange(len(at)), n), ranges(a, n)
        low = self.low + self.bands[rank] * self.h - at[who, 1]
        high = low + self.h
        least = np.maximum(0.0, np.maximum(low, -high) - self.slack)
        return who, rank, least, np.maximum(np.abs(low), np.abs(high)) + self.slack

    def find(self, rank: np.ndarray, u: np.ndarray, side: str) -> np.ndarray:
        u = np.clip(u, self.left - self.pad, self.right + self.pad)
        return np.searchsorted(self.key, rank * self.span + (u - self.left), side)

    def chord2(self, at: np.ndarray, who: np.ndarray, point: np.ndarray) -> np.ndarray:
        d = at[who] - self.at[point]
        return np.einsum("ij,ij->i", d, d)

    def counts(self, at: np.ndarray, spot: np.ndarray) -> np.ndarray:
        """Rows within the radius of each place."""
        depth = max(at[:, 2].max() - self.at[:, 2].min(), self.at[:, 2].max() - at[:, 2].min(), 0.0)
        c2 = self.c * self.c
        who, rank, least, most = self.met(at, self.c)
        u = at[who, 0]
        outer = np.sqrt(np.maximum(c2 - least * least, 0.0)) + self.slack
        inner = np.sqrt(np.maximum(c2 - depth * depth - most * most, 0.0)) - self.slack
        a, d = self.find(rank, u - outer, "left"), self.find(rank, u + outer, "right")
        b, e = self.find(rank, u - inner, "left"), self.find(rank, u + inner, "right")
        none = inner <= 0
        b[none] = e[none] = d[none]
        total = np.bincount(who, self.before[e] - self.before[b], len(at))
        for i, j in batches(np.concatenate([who, who]), np.concatenate([a, e]), np.concatenate([b, d])):
            chord2 = self.chord2(at, i, j)
            inside = chord2 <= c2
            close = np.nonzero(np.abs(chord2 - c2) <= self.far)[0]
            inside[close] = distance(spot[i[close]], self.spot[j[close]]) <= self.radius
            total += np.bincount(i, self.m[j] * inside, len(at))
        return total.astype(np.int64)

    def nearest(self, at: np.ndarray, spot: np.ndarray) -> np.ndarray:
        """Lat and lon of the nearest point of each place; NaN without one about the radius."""
        best = np.full(len(at), self.c * self.c + self.far)
        # Bounds: the points next to the place in its own bands, then in all bands in reach.
        for reach in (np.full(len(at), self.h), None):
            who, rank, least, _ = self.met(at, np.sqrt(best) if reach is None else reach)
            use = least * least <= best[who]
            who, rank = who[use], rank[use]
            k = self.find(rank, at[who, 0], "left")
            for j in (k - 1, k):
                held = (j >= self.start[rank]) & (j < self.start[rank + 1])
                np.minimum.at(best, who[held], self.chord2(at, who[held], j[held]))
        bound = best * (1 + CLOSE) + 1e-30
        who, rank, least, _ = self.met(at, np.sqrt(bound))
        reach2 = bound[who] - least * least
        use = reach2 >= 0
        who, rank, reach = who[use], rank[use], np.sqrt(reach2[use]) + self.slack
        u = at[who, 0]
        out = np.full((len(at), 2), np.nan)
        least_d = np.full(len(at), np.inf)
        for i, j in batches(who, self.find(rank, u - reach, "left"), self.find(rank, u + reach, "right")):
            near = self.chord2(at, i, j) <= bound[i]
            i, j = i[near], j[near]
            d = distance(spot[i], self.spot[j])
            order = np.lexsort((d, i))
            i, j, d = i[order], j[order], d[order]
            first = np.concatenate([[True], i[1:] != i[:-1]])[:len(i)]
            i, j, d = i[first], j[first], d[first]
            nearer = d < least_d[i]
            least_d[i[nearer]], out[i[nearer]] = d[nearer], self.spot[j[nearer]]
        return out


def search(places: np.ndarray, kind: np.ndarray, spot: np.ndarray, m: np.ndarray,
           specs: list[tuple[int, float]], nearest: tuple[int, float] | None):
    """(counts per place and spec, lat and lon of the nearest point) of one tile.

    ``places`` and ``spot`` hold lat and lon; ``specs`` lists (kind, radius in metres).
    """
    places, back = np.unique(places[:, 0] + 1j * places[:, 1], return_inverse=True)
    places = np.column_stack([places.real, places.imag])
    xyz = on_sphere(places[:, 0], places[:, 1])
    axes = turned(xyz)
    at, points = xyz @ axes, on_sphere(spot[:, 0], spot[:, 1]) @ axes
    counts = np.zeros((len(specs), len(places)), dtype=np.int64)
    near = np.full((len(places), 2), np.nan)
    made: dict[tuple[int, float], Points] = {}

    def held(spec: tuple[int, float]) -> Points | None:
        if spec not in made:
            own = kind == spec[0]
            if not own.any():
                return None
            made[spec] = Points(points[own], spot[own], m[own], spec[1])
        return made[spec]

    for s in range(0, len(places), STEP):
        here = slice(s, s + STEP)
        for i, spec in enumerate(specs):
            if (p := held(spec)) is not None:
                counts[i, here] = p.counts(at[here], places[here])
        if nearest is not None and (p := held(nearest)) is not None:
            near[here] = p.nearest(at[here], places[here])
    return counts[:, back], near[back]
