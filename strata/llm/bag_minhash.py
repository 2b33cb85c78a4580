"""BagMinHash: signatures of multisets whose agreement is the weighted Jaccard similarity.

Every element has a Poisson process of points in time for each unit of
weight, the same in every multiset; a point also names one of the signature's
components. Of the points that lie below an element's weight, a component
keeps the earliest. Two multisets agree in a component if its earliest point
is shared, which has the probability (sum of minima) / (sum of maxima).

Weights are discretised to whole numbers (here counts). Their units are
grouped in blocks of doubling width, [0,1), [1,2), [2,4), ...; a block has one
process of its whole rate, whose points are spread over its units, so a heavy
element costs a few processes and those of its points above its weight are
thinned out. Processes run only up to a time by which all components of the
multiset will almost surely have a point (about size log size points in all,
not size times elements); the few multisets with an empty component run again
to twice that time, so signatures don't depend on it.
"""

from __future__ import annotations

import numpy as np
import xxhash

SIZE = 125
WINDOW = 5
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_A, _B, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def times(x: np.uint64, k: int) -> np.uint64:
    """k times x, modulo 2**64."""
    return np.uint64(int(x) * k & 0xFFFFFFFFFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers (the finaliser of splitmix64)."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def shingles(text: str, window: int = WINDOW) -> np.ndarray:
    """Hashes of the runs of ``window`` words of a text, repeats included; a shorter text with words is one run."""
    words = text.encode("utf-8", "replace").split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - window + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(window, len(h))):
        out = mixed(out ^ h[i : i + n])
    return out


def numbered(elements: np.ndarray) -> np.ndarray:
    """A multiset as a sorted set: the k-th time of an element becomes an element of its own, so the
    intersection of two such sets has the size of the multisets' overlap."""
    x = np.sort(elements)
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.empty(0, np.int64)
    times = np.arange(len(x)) - np.repeat(first, np.diff(np.append(first, len(x))))
    return np.sort(mixed(x ^ (times.astype(np.uint64) * _B))) if len(x) else x


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], size: int = SIZE) -> np.ndarray:
    """Signatures (rows of ``size`` 64-bit numbers) of non-empty multisets, given as (elements, weights)."""
    out = np.full((len(bags), size), EMPTY)
    total = np.array([w.sum() for _, w in bags], np.float64)
    end = (np.log(size) + 4) / total
    todo = np.arange(len(bags))
    while len(todo):
        out[todo] = EMPTY
        processes(out, [bags[i] for i in todo], todo, end[todo], size)
        todo = todo[(out[todo] == EMPTY).any(axis=1)]
        end[todo] *= 2
    return out


def processes(out: np.ndarray, bags: list[tuple[np.ndarray, np.ndarray]], rows: np.ndarray, end: np.ndarray, size: int) -> None:
    """Run the processes of all elements of the multisets up to their ends; lower the components in ``out``."""
    element = np.concatenate([e for e, _ in bags])
    weight = np.concatenate([w for _, w in bags]).astype(np.int64)
    owner = np.repeat(np.arange(len(bags)), [len(e) for e, _ in bags])
    flat, low, width, block = out.reshape(-1), 0, 1, 0
    while len(element):  # the blocks [0,1), [1,2), [2,4), ... of those elements that reach them
        seed = mixed(element ^ times(_A, block + 1))
        time, live, k = np.zeros(len(seed)), np.arange(len(seed)), 0
        while len(live):
            draw = mixed(seed[live] + times(_B, k))
            time[live] -= np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (size * width)
            live_end = time[live] < end[owner[live]]
            live, draw = live[live_end], draw[live_end]
            second = mixed(draw)
            unit = low + ((second >> np.uint64(32)) * np.uint64(width) >> np.uint64(32)).astype(np.int64)
            inside = unit < weight[live]
            component = ((second & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
            point = (time[live].astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (draw & np.uint64(0xFFFFFFFF))
            np.minimum.at(flat, (rows[owner[live]] * size + component)[inside], point[inside])
            k += 1
        low, width, block = low + width, max(1, low + width), block + 1
        more = weight > low
        element, weight, owner = element[more], weight[more], owner[more]


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """Hashes of ``rows`` neighbouring components each, the band's number included."""
    n = signature.shape[1] // rows
    parts = signature[:, : n * rows].reshape(len(signature), n, rows)
    out = np.broadcast_to(np.arange(n, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        out = mixed(out ^ parts[:, :, i])
    return out
