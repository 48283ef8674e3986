"""DartMinHash: sketches of weighted sets from hashed darts.

Over the plane of weight and rank, each element has its own stream of darts, one per unit of area on
average, at places that a hash of the element fixes. A set sees the darts below its elements' weights.
Every dart belongs to one of k coordinates; a coordinate of the sketch is the dart of the lowest rank.
Two sets agree in a coordinate with the probability of their weighted Jaccard similarity.

Only ranks up to ``t / total weight`` are looked at, which gives t = k ln k + 2k darts on average; for
the few sets that leave a coordinate without a dart, the bound is doubled until none does. The plane
is cut into regions [2^v - 1, 2^(v+1) - 1) x [2^r - 1, 2^(r+1) - 1), each into rectangles of area one, so
the work follows the darts and not the weights. After T. Christiani, "DartMinHash: Fast Sketching for
Weighted Sets", 2020.
"""

from __future__ import annotations

import math

import numpy as np

from profilespark.llm.shingles import mix

#: Upper ends of the uniform draws that give 0, 1, 2, ... darts in a rectangle (Poisson of mean 1).
_POISSON = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(18)])
_UNIT = float(2**-53)


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * _UNIT


def _repeat(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every one of counts copies: the index it is of, and its number among the copies."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def _darts(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Darts of ranks in [low, high) (per set) under the elements' weights: owner, dart id, rank."""
    out = []
    v = 0
    while (wide := weight > 2**v - 1).any():
        r = 0
        while (reach := wide & (high[owner] > 2**r - 1)).any():
            # Rectangles of width 2^(v - r) and height 2^(r - v): 2^r of them along the weight, 2^v along the rank.
            at = np.flatnonzero(reach & (low[owner] < 2**(r + 1) - 1))
            if len(at):
                width, height = 2.0**(v - r), 2.0**(r - v)
                n_w = np.minimum(2**r, np.ceil((weight[at] - (2**v - 1)) / width)).astype(np.int64)
                n_r = np.minimum(2**v, np.ceil((high[owner[at]] - (2**r - 1)) / height)).astype(np.int64)
                of, cell = _repeat(n_w * n_r)
                at, w, k = at[of], cell // n_r[of], cell % n_r[of]
                seed = mix(element[at] + np.uint64((v * 64 + r + 1) * 0x9E3779B97F4A7C15 % 2**64) + (w.astype(np.uint64) << np.uint64(32)) + k.astype(np.uint64))
                n = np.searchsorted(_POISSON, _uniform(seed), side="right")
                of, number = _repeat(n)
                at, dart = at[of], mix(seed[of] + (number.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
                place = 2**v - 1 + (w[of] + _uniform(mix(dart ^ np.uint64(0xA5A5A5A5A5A5A5A5)))) * width
                rank = 2**r - 1 + (k[of] + _uniform(mix(dart ^ np.uint64(0x5A5A5A5A5A5A5A5A)))) * height
                seen = (place < weight[at]) & (rank < high[owner[at]]) & (rank >= low[owner[at]])
                out.append((owner[at][seen], dart[seen], rank[seen]))
            r += 1
        v += 1
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def sketch(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n_sets: int, k: int) -> np.ndarray:
    """Sketches, n_sets x k dart ids, of weighted sets given as (set number, element hash, positive weight).

    A set without elements has zeros.
    """
    total = np.bincount(owner, weights=weight, minlength=n_sets)
    ids = np.zeros((n_sets, k), np.uint64)
    best = np.full((n_sets, k), np.inf)
    t = k * math.log(k) + 2 * k
    low, high = np.zeros(n_sets), np.where(total > 0, t / np.maximum(total, 1e-300), 0.0)
    open_ = total > 0
    weight = weight.astype(np.float64)
    while open_.any():
        part = open_[owner]
        of, dart, rank = _darts(owner[part], element[part], weight[part], low, high)
        slot = of * k + (mix(dart ^ np.uint64(0x0123456789ABCDEF)) % np.uint64(k)).astype(np.int64)
        flat_best, flat_ids = best.reshape(-1), ids.reshape(-1)
        np.minimum.at(flat_best, slot, rank)
        first = rank == flat_best[slot]
        flat_ids[slot[first]] = dart[first]
        low, high = high.copy(), high * 2
        open_ = open_ & np.isinf(best).any(axis=1)
    return ids


def bands(ids: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band of ``rows`` coordinates, different for every band."""
    n, k = ids.shape
    out = np.zeros((n, k // rows), np.uint64)
    for j in range(k // rows):
        h = np.full(n, np.uint64(j + 1))
        for c in range(j * rows, (j + 1) * rows):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + ids[:, c])
        out[:, j] = h
    return out
