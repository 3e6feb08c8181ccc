"""DartMinHash signatures: weighted minwise hashing by thrown darts.

Every element of the universe owns a plane of weight x rank on which a fixed
random rain of darts (a Poisson process, one dart per unit of area) has
fallen; the rain depends only on the element's hash.  A weighted set owns, of
each of its elements, the strip of weights below the element's weight.  Each
dart also names one of the signature's coordinates.  The signature holds, per
coordinate, the dart of lowest rank that lies in the set's strips.  Two sets
pick the same dart for a coordinate with a probability equal to their weighted
Jaccard similarity, sum of minima / sum of maxima.

The darts of a set are thrown in rank order, up to a rank below which about
k ln k + 2k of them are expected, so the work is the number of elements plus
the number of darts, not their product with the signature's length; a set that
leaves a coordinate empty is thrown again with the rank doubled.

The strip of weights is cut at 1, 2, 4, ...: a region's darts are the arrivals
of one process whose rate is the region's width, and a dart above the
element's own weight does not count.
"""

from __future__ import annotations

import numpy as np

from curato.llm.common import mix64

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _uniform(h: np.ndarray) -> np.ndarray:
    """(0, 1] numbers from hashes."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)


def _throw(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, limit: np.ndarray,
           k: int, seed: int, best: np.ndarray) -> None:
    """Lower ``best`` (sets x k; rank in the high and dart in the low 32 bits)
    by all darts of the sets' elements below each set's rank limit."""
    flat = best.reshape(-1)
    region, low, width = 0, 0.0, 1.0
    who, what, heavy = owner, element, weight
    while len(who):
        base = mix64(what, seed * 64 + region + 1)
        rank, alive, number = np.zeros(len(who)), np.arange(len(who)), 0
        while len(alive):
            number += 1
            dart = mix64(base[alive], number)
            rank[alive] -= np.log(_uniform(dart)) / width
            alive_now = rank[alive] < limit[who[alive]]
            alive, dart = alive[alive_now], dart[alive_now]
            hit, thrown = alive, mix64(dart, 3)
            if width > 1 or (heavy[alive] < width).any():
                height = low + width * _uniform(mix64(dart, 5))
                inside = height <= heavy[alive]
                hit, thrown = alive[inside], thrown[inside]
            # Positive floats order like their bits, so the low rank wins.
            bits = rank[hit].astype(np.float32).view(np.uint32).astype(np.uint64)
            slot = who[hit] * k + ((thrown >> np.uint64(32)) % np.uint64(k)).astype(np.int64)
            np.minimum.at(flat, slot, bits << np.uint64(32) | (thrown & np.uint64(0xFFFFFFFF)))
        region, low = region + 1, low + width
        width = low
        above = heavy > low
        who, what, heavy = who[above], what[above], heavy[above]


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, sets: int, k: int,
               seed: int = 1) -> np.ndarray:
    """(sets, k) signatures of weighted sets given as (set number, element
    hash, weight > 0) rows.  A set without elements keeps the empty mark in all
    coordinates."""
    best = np.full((sets, k), _EMPTY, dtype=np.uint64)
    total = np.bincount(owner, weights=weight, minlength=sets)
    limit = np.where(total > 0, (k * np.log(k) + 2 * k) / np.maximum(total, 1e-300), 0.0)
    open_ = total > 0
    while open_.any():
        rows = open_[owner]
        _throw(owner[rows], element[rows], weight[rows], limit, k, seed, best)
        open_ &= (best == _EMPTY).any(1)
        best[open_] = _EMPTY
        limit = limit * 2
    return best


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates, different for each band."""
    sets, k = signature.shape
    bands = k // rows
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (sets, bands))
    for j in range(rows):
        key = mix64(key ^ signature[:, j:bands * rows:rows], j + 1)
    return key.view(np.int64)
