"""DartMinHash signatures of weighted sets (Christiani, 2020).

Every element owns a region weight x rank in which darts lie at random, on average one per unit of
area, their number and places hashed from the element and the cell. A set sees the darts below its
elements' weights. Each dart names one of ``k`` coordinates; a coordinate keeps the dart of lowest rank.
Two sets agree in a coordinate with the probability of their weighted Jaccard similarity.

Ranks are opened level by level, each ``STEP`` times as far as the last, until every coordinate of a
set has a dart. That takes some ``k log k`` darts whatever the size of the set.
"""

from __future__ import annotations

import numpy as np

from meterline.llm.batches import mixed

FIRST_RANK = 2.0**-8
STEP = 3.0
UNIT = 2.0**-53
SHIFT = np.uint64(11)


def _poisson_bounds(mean: float) -> np.ndarray:
    """Cumulative Poisson probabilities on the scale of 64-bit hashes."""
    most = int(mean + 12 * mean**0.5 + 24)
    steps = np.log(mean) - np.log(np.arange(1, most + 1))
    return np.cumsum(np.exp(np.concatenate(([-mean], -mean + np.cumsum(steps)))))


def _weight_cell(number: int) -> tuple[float, float]:
    """[0, 1), [1, 2), [2, 4), [4, 8) ..."""
    return (0.0, 1.0) if number == 0 else (2.0 ** (number - 1), 2.0**number)


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, sets: int, k: int) -> np.ndarray:
    """(sets, k) dart hashes. ``elements`` are hashes, ``owner`` the set of each; empty sets get zeros."""
    best = np.zeros((sets, k), dtype=np.uint64).reshape(-1)
    rank_of = np.full(sets * k, np.inf)
    left = np.full(sets, k)
    left[np.setdiff1d(np.arange(sets), owner)] = 0
    low, high, level = 0.0, FIRST_RANK, 0
    cells = 1 + int(np.ceil(np.log2(max(1.0, weights.max(initial=1.0)))))
    while (left > 0).any():
        open_rows = np.flatnonzero(left[owner] > 0)
        for cell in range(cells):
            bottom, top = _weight_cell(cell)
            rows = open_rows if cell == 0 else open_rows[weights[open_rows] > bottom]
            if not len(rows):
                continue
            key = mixed(elements[rows] ^ mixed(np.array([level * 64 + cell + 1], dtype=np.uint64)))
            bounds = _poisson_bounds((top - bottom) * (high - low))
            counts = np.searchsorted(bounds, (key >> SHIFT) * UNIT, side="right")
            hit = np.repeat(np.arange(len(rows)), counts)
            if not len(hit):
                continue
            nth = np.arange(len(hit)) - np.repeat(np.cumsum(counts) - counts, counts)
            dart = mixed(key[hit] + (nth + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
            height = bottom + (mixed(dart + np.uint64(1)) >> SHIFT) * UNIT * (top - bottom)
            seen = height < weights[rows[hit]]
            dart, hit = dart[seen], hit[seen]
            rank = low + (mixed(dart + np.uint64(2)) >> SHIFT) * UNIT * (high - low)
            place = owner[rows[hit]] * k + (mixed(dart + np.uint64(3)) % np.uint64(k)).astype(np.int64)
            np.minimum.at(rank_of, place, rank)
            first = rank_of[place] == rank
            best[place[first]] = dart[first]
        left = np.where(left > 0, np.isinf(rank_of.reshape(sets, k)).sum(axis=1), 0)
        low, high, level = high, high * STEP, level + 1
    return best.reshape(sets, k)
