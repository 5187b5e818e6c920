"""Weighted minwise signatures by throwing darts.

Each element of a weighted set owns an endless strip: its weight by the axis of
ranks. Darts fall on the strip with one dart per unit of area on average, each
aimed at one of K coordinates. An element's darts count up to its weight, and a
coordinate keeps the dart of the lowest rank over all elements. As darts depend
on the element only, two sets agree in a coordinate with the probability of
their weighted Jaccard similarity. Darts are needed only up to the rank at
which all coordinates have one: about K (ln K + 2) of them, however large the
set is.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from tollstats.llm.tokens import BASE, mix

COORDINATES = 144
BANDS = 24
# Ranks are cut at 0, 2^-12, 2^-11, ..., 1, 2, 3, ...; weights at 0, 1, 2, ...
HALVINGS = 12
# More darts in one unit of area than these are as good as impossible (below 1e-13).
MOST_DARTS = 15
BLOCK = 1 << 16

_STEP = np.uint64(0xD1B54A32D192ED03)


def _edge(cell: int) -> float:
    """Lower rank of a cell."""
    return 0.0 if cell == 0 else 2.0 ** (cell - 1 - HALVINGS) if cell <= HALVINGS else float(cell - HALVINGS)


@lru_cache(maxsize=4096)
def _limits(cell: int) -> np.ndarray:
    """A uniform 64-bit number above the n-th limit means more than n darts in this cell."""
    area = _edge(cell + 1) - _edge(cell)
    term, total, limits = np.exp(-area), 0.0, []
    for n in range(MOST_DARTS):
        total += term
        term *= area / (n + 1)
        limits.append(min(total, 1.0 - 2.0**-53))
    return (np.array(limits) * 2.0**64).astype(np.uint64)


def signature(elements: np.ndarray, weights: np.ndarray, k: int = COORDINATES) -> np.ndarray | None:
    """The darts kept by the k coordinates, as 64-bit numbers; None for a set without weight."""
    parts = np.ceil(weights).astype(np.int64)
    total = float(weights.sum())
    if total <= 0:
        return None
    strip = np.repeat(np.arange(len(elements)), parts)
    unit = np.arange(len(strip)) - np.repeat(np.cumsum(parts) - parts, parts)
    whole = np.minimum(weights[strip] - unit, 1.0)
    strips = mix(elements[strip] + (unit.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE))
    kept = np.zeros(k, dtype=np.uint64)
    ranks = np.full(k, np.inf)
    reach = k * (np.log(k) + 2.0) / total
    cell = 0
    while cell == 0 or not np.isfinite(ranks).all():
        last = cell + 1
        while _edge(last) < reach and (last - cell) * min(len(strips), BLOCK) < BLOCK * 16:
            last += 1
        for at in range(0, len(strips), BLOCK):
            _throw(strips[at : at + BLOCK], whole[at : at + BLOCK], cell, last, kept, ranks)
        cell = last
    return kept


def _throw(
    strips: np.ndarray, whole: np.ndarray, first: int, last: int, kept: np.ndarray, ranks: np.ndarray
) -> None:
    """Darts of all strips in cells first..last-1; the best of each coordinate goes to kept and ranks."""
    cells = np.arange(first, last)
    limits = np.stack([_limits(c) for c in cells])
    seeds = mix(cells.astype(np.uint64) + np.uint64(1))
    draws = mix(strips[:, None] ^ seeds[None, :])
    row, column = np.nonzero(draws > limits[None, :, 0])
    if not len(row):
        return
    base = draws[row, column]
    darts = (base[:, None] > limits[column]).sum(axis=1)
    which = np.repeat(np.arange(len(row)), darts)
    number = np.arange(len(which)) - np.repeat(np.cumsum(darts) - darts, darts)
    dart = mix(base[which] + (number.astype(np.uint64) + np.uint64(1)) * _STEP)
    height = mix(dart ^ _STEP)
    inside = (height >> np.uint64(11)) * 2.0**-53 < whole[row[which]]
    dart, column = dart[inside], column[which][inside]
    edges = np.array([_edge(c) for c in range(first, last + 1)])
    low, width = edges[column], np.diff(edges)[column]
    rank = low + width * ((dart & np.uint64(0xFFFFFFFF)) * 2.0**-32)
    coordinate = ((dart >> np.uint64(32)) % np.uint64(len(kept))).astype(np.int64)
    order = np.argsort(-rank, kind="stable")
    coordinate, rank, dart = coordinate[order], rank[order], dart[order]
    best, values = np.full(len(kept), np.inf), np.zeros(len(kept), dtype=np.uint64)
    best[coordinate] = rank  # the last, hence lowest, rank of each coordinate stays
    values[coordinate] = dart
    better = best < ranks
    ranks[better] = best[better]
    kept[better] = values[better]


def band_hashes(kept: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One number per band of coordinates; bands of different places never share numbers by design."""
    rows = kept.reshape(bands, -1)
    total = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows.shape[1]):
        total = total * np.uint64(BASE) + rows[:, i]
    return mix(total).view(np.int64)


def short_signature(kept: np.ndarray) -> bytes:
    """One byte per coordinate: unequal darts share it once in 256 times."""
    return (kept & np.uint64(0xFF)).astype(np.uint8).tobytes()
