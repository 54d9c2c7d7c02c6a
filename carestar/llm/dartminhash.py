"""Weighted signatures of word shingles by DartMinHash, in numpy.

Darts are thrown into the plane of weight and rank: for each element the plane is cut into
cells, dyadic in both directions, and a hash of element and cell gives the number of darts in
it (Poisson in the area) and each dart's place and coordinate. An element's darts below its
weight take part; each coordinate keeps the one of lowest rank. Two weighted sets keep the same
dart with a probability of their weighted Jaccard similarity.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash

SHINGLE = 5
FIRST_RANK = 0.25
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= 1 << 18:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(words: list[str], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of runs of five words, and how often each occurs. Fewer words than five
    are one run; no words, no run."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    coded = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    total = np.full(n, min(len(words), SHINGLE), np.uint64)
    for k in range(min(SHINGLE, len(words))):
        total = (total + coded[k : k + n]) * _GOLDEN
        total ^= total >> np.uint64(29)
    return np.unique(mixed(total), return_counts=True)


def weighted_jaccard(a, b) -> float:
    """Sum of smaller over sum of larger counts of two (values, counts); 1 for two empty sets."""
    (va, ca), (vb, cb) = a, b
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    least = np.minimum(ca[ia], cb[ib]).sum()
    most = ca.sum() + cb.sum() - least
    return float(least / most) if most else 1.0


class DartSignature:
    def __init__(self, bands: int = 32, rows: int = 5):
        self.bands, self.rows, self.k = bands, rows, bands * rows
        self.darts = self.k * math.log(self.k) + 2 * self.k
        self.tables: dict[float, np.ndarray] = {}

    def _poisson(self, area: float) -> np.ndarray:
        """Cumulative Poisson probabilities, for counts by inversion."""
        if area not in self.tables:
            most = int(area + 12 * math.sqrt(area) + 20)
            logs = [n * math.log(area) - area - math.lgamma(n + 1) for n in range(most)]
            self.tables[area] = np.cumsum(np.exp(logs))
        return self.tables[area]

    def _thrown(self, values, counts, tops):
        """Owner, rank and identity of all darts of elements with ranks up to their ``tops``."""
        owners, ranks, marks = [], [], []
        nu, low_w = 0, 0.0
        while len(high := np.flatnonzero(counts > low_w)):
            width_w = 1.0 if nu == 0 else low_w
            rho, low_r = 0, 0.0
            while len(high := high[tops[high] > low_r]):
                width_r = FIRST_RANK if rho == 0 else low_r
                salt = np.array([64 * nu + rho + 1], np.uint64) * _GOLDEN
                cell = mixed(values[high] + salt)
                share = (cell >> np.uint64(11)).astype(np.float64) * 2.0**-53
                n = np.searchsorted(self._poisson(width_w * width_r), share)
                many = np.repeat(np.arange(len(high)), n)
                nth = np.arange(len(many)) - np.repeat(np.cumsum(n) - n, n)
                dart = mixed(cell[many] ^ mixed((nth + 1).astype(np.uint64)))
                owner = high[many]
                rank = low_r + width_r * (dart >> np.uint64(24)).astype(np.float64) * 2.0**-40
                keep = rank <= tops[owner]
                if nu:
                    at = (mixed(dart) >> np.uint64(11)).astype(np.float64) * 2.0**-53
                    keep &= low_w + width_w * at <= counts[owner]
                owners.append(owner[keep])
                ranks.append(rank[keep])
                marks.append(dart[keep])
                rho, low_r = rho + 1, low_r + width_r
            nu, low_w = nu + 1, low_w + width_w
        return np.concatenate(owners), np.concatenate(ranks), np.concatenate(marks)

    def signatures(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """A row for each (values, counts), none of them empty: the dart that each of the k
        coordinates keeps. Where a coordinate got none, twice the ranks are tried."""
        kept = np.zeros((len(sets), self.k), np.uint64)
        tops = np.array([self.darts / counts.sum() for _, counts in sets])
        todo = np.arange(len(sets))
        while len(todo):
            sizes = [len(sets[i][0]) for i in todo]
            group = np.repeat(np.arange(len(todo)), sizes)
            owners, ranks, marks = self._thrown(
                np.concatenate([sets[i][0] for i in todo]),
                np.concatenate([sets[i][1] for i in todo]),
                tops[todo][group],
            )
            place = ((marks & np.uint64(0xFFFFFF)).astype(np.int64) * self.k) >> 24
            slot = group[owners] * self.k + place
            lowest = np.full(len(todo) * self.k, np.inf)
            np.minimum.at(lowest, slot, ranks)
            first = ranks == lowest[slot]
            found = np.zeros(len(todo) * self.k, np.uint64)
            found[slot[first]] = marks[first]
            full = np.isfinite(lowest).reshape(-1, self.k).all(axis=1)
            kept[todo[full]] = found.reshape(-1, self.k)[full]
            todo = todo[~full]
            tops[todo] *= 2
        return kept

    def band_keys(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """A key for each band of each set, computed for about 100,000 elements at a time."""
        out = np.zeros((len(sets), self.bands), np.uint64)
        out += mixed(np.arange(1, self.bands + 1).astype(np.uint64) * _GOLDEN)
        at = 0
        while at < len(sets):
            end, elements = at, 0
            while end < len(sets) and (end == at or elements < 100_000):
                elements += len(sets[end][0])
                end += 1
            kept = self.signatures(sets[at:end]).reshape(end - at, self.bands, self.rows)
            for r in range(self.rows):
                out[at:end] = mixed(out[at:end] + kept[:, :, r])
            at = end
        return out.view(np.int64)
