"""A robust-pruned directed proximity graph over the vectors of one shard, in numpy.

Points are inserted in batches of doubling size. For each point a greedy beam
search on the graph so far proposes neighbours; relaxed distance pruning keeps a
neighbour only if no kept one is closer to it by the factor ``alpha``, so edges
stay diverse; reverse edges are added and overfull lists are pruned the same way.
All steps work on whole batches. Distances are squared Euclidean ones of unit
vectors, which order like cosine.
"""

from __future__ import annotations

import numpy as np

DEGREE = 28
BUILD_BEAM = 48
ALPHA = 1.2
BATCH = 256


class GraphIndex:
    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 5):
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.x = np.ascontiguousarray(unit, np.float32)
        self.n, self.degree, self.beam, self.alpha = len(vectors), degree, beam, np.float32(alpha * alpha)
        self.edges = np.full((self.n, degree), -1, np.int32)
        self.entry = int(np.argmin(((self.x - self.x.mean(axis=0)) ** 2).sum(axis=1)))
        order = np.random.default_rng(seed).permutation(self.n).astype(np.int32)
        order = order[order != self.entry]
        at = 0
        while at < len(order):
            batch = order[at : at + min(BATCH, max(1, at))]
            self._insert(batch)
            at += len(batch)
        # A second look at every point, now that the graph is whole.
        for at in range(0, len(order), BATCH):
            self._insert(order[at : at + BATCH])

    def _distance(self, a: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of rows ``a`` to the points of each row of ``ids``; -1 is infinitely far."""
        d = 2 - 2 * np.einsum("bd,bkd->bk", a, self.x[ids])
        return np.where(ids >= 0, d, np.inf).astype(np.float32)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: none) and squared distances of the ``beam`` nearest points found, nearest first."""
        q = np.ascontiguousarray(queries, np.float32)
        b = len(q)
        line = np.arange(b)
        ids = np.full((b, beam), -1, np.int32)
        far = np.full((b, beam), np.inf, np.float32)
        open_ = np.zeros((b, beam), bool)
        seen = np.zeros((b, self.n), bool)
        ids[:, 0], open_[:, 0], seen[:, self.entry] = self.entry, True, True
        far[:, 0] = self._distance(q, ids[:, :1])[:, 0]
        active = line
        while len(active):
            first = open_[active].argmax(axis=1)  # lists are sorted: the nearest point not yet expanded
            going = open_[active, first]
            active, first = active[going], first[going]
            if not len(active):
                break
            open_[active, first] = False
            near = self.edges[ids[active, first]]
            new = (near >= 0) & ~seen[active[:, None], near]
            near = np.where(new, near, -1)
            r, c = np.nonzero(new)
            seen[active[r], near[r, c]] = True
            all_far = np.concatenate([far[active], self._distance(q[active], near)], axis=1)
            all_ids = np.concatenate([ids[active], near], axis=1)
            all_open = np.concatenate([open_[active], new], axis=1)
            top = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            far[active] = np.take_along_axis(all_far, top, 1)
            ids[active] = np.take_along_axis(all_ids, top, 1)
            open_[active] = np.take_along_axis(all_open, top, 1)
        return ids, far

    def _prune(self, points: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Diverse neighbours for each of ``points`` out of its row of candidates ``ids`` (-1 or repeated: none)."""
        order = np.sort(ids, axis=1)
        order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
        ids = np.where(order == points[:, None], -1, order)
        far = self._distance(self.x[points], ids)
        by = np.argsort(far, axis=1, kind="stable")
        ids, far = np.take_along_axis(ids, by, 1), np.take_along_axis(far, by, 1)
        x = self.x[ids]
        between = 2 - 2 * np.matmul(x, x.transpose(0, 2, 1))
        out = np.full((len(points), self.degree), -1, np.int32)
        left = ids >= 0
        line = np.arange(len(points))
        for k in range(self.degree):
            first = left.argmax(axis=1)
            has = left[line, first]
            if not has.any():
                break
            out[has, k] = ids[line, first][has]
            left &= self.alpha * between[line, first] > far
            left[line, first] = False
        return out

    def _insert(self, points: np.ndarray) -> None:
        found, _ = self.search(self.x[points], self.beam)
        kept = self._prune(points, np.concatenate([found, self.edges[points]], axis=1))
        self.edges[points] = kept
        source = np.repeat(points, self.degree)[kept.ravel() >= 0]
        target = kept.ravel()[kept.ravel() >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        heads, start, count = np.unique(target, return_index=True, return_counts=True)
        width = 16  # reverse edges of one point that are worked in at once
        place = np.arange(len(target)) - np.repeat(start, count)
        for wave in range(int(place.max(initial=-1)) // width + 1):
            take = place // width == wave
            rows = np.searchsorted(heads, target[take])
            added = np.full((len(heads), width), -1, np.int32)
            added[rows, place[take] % width] = source[take]
            some = np.unique(rows)
            lists = np.concatenate([self.edges[heads[some]], added[some]], axis=1)
            fits = np.array([len(set(x.tolist()) - {-1}) for x in lists]) <= self.degree
            for i in np.flatnonzero(fits):
                flat = list(dict.fromkeys(v for v in lists[i].tolist() if v >= 0))
                self.edges[heads[some[i]]] = flat + [-1] * (self.degree - len(flat))
            over = np.flatnonzero(~fits)
            for at in range(0, len(over), BATCH):
                part = over[at : at + BATCH]
                self.edges[heads[some[part]]] = self._prune(heads[some[part]].astype(np.int32), lists[part])
