"""External induced sorting of suffixes with their common prefixes, for one shard.

A shard is a run of segments, each ended by the sentinel 0. Suffixes are typed L or S, the
leftmost S of each run (LMS) are sorted by recursion over the names of the substrings
between them, and all others are induced: first L from LMS, then S from L. Induced suffixes
wait in a queue of tuples (first symbol, order of the inducer, position, common prefix with
the one before) that keeps only a part in memory and the rest in sorted runs on disk. The
queue gives them back one range of first symbols at a time, so the memory in use is that of
a range (or of the most frequent symbol), not that of the shard.

Common prefixes are carried through every step: two induced neighbours share one symbol more
than their inducers, whose common prefix is the least one between them; those of sorted
LMS suffixes follow from the recursion's, in names, and the names' own.
"""

from __future__ import annotations

import bisect
import tempfile
from collections.abc import Iterator

import numpy as np

#: Bytes in the first symbol of a suffix, no more than an integer of 64 bits holds. Symbols of several bytes spread the
#: suffixes over more ranges and tell more of them apart; order is the same.
SYMBOL_BYTES = 7
#: Arrays below this many bytes stay in memory.
IN_MEMORY = 1 << 23
SAMPLE = 1 << 14
CHUNK = 1 << 18


def scratch(n: int, dtype) -> np.ndarray:
    """An array of ``n``; a large one lies in an unnamed file of the task, which goes with the task however it ends."""
    if n * np.dtype(dtype).itemsize <= IN_MEMORY:
        return np.zeros(n, dtype)
    return np.memmap(tempfile.TemporaryFile(), dtype=dtype, mode="w+", shape=(n,))


class RangeMinimum:
    """Least value of any stretch of an array, of at most ``widest`` values, by a table of powers of two."""

    def __init__(self, values: np.ndarray, widest: int | None = None):
        n = len(values)
        narrow = np.int32 if n and int(values.max()) < 1 << 31 else values.dtype
        self.rows = np.empty((max(1, (n if widest is None else min(n, widest)).bit_length()), n), narrow)
        self.rows[0] = values
        for j in range(1, len(self.rows)):
            half = 1 << (j - 1)
            self.rows[j] = self.rows[j - 1]
            np.minimum(self.rows[j - 1][: n - half], self.rows[j - 1][half:], out=self.rows[j][: n - half])

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of the values at ``first`` to ``last``, both included."""
        level = np.frexp(last - first + 1)[1] - 1
        return np.minimum(self.rows[level, first], self.rows[level, last - (np.int64(1) << level) + 1])

    @staticmethod
    def once(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """``least`` for stretches that are asked once: the table goes no further than the widest of them."""
        return RangeMinimum(values, int((last - first).max()) + 1).least(first, last)


class SuffixQueue:
    """A priority queue of tuples (symbol, order, position, common prefix), least symbol and order first.

    It gives back one range of symbols at a time. A push is sorted and of higher orders than those before it, so the
    tuples of a range need only a stable sort by symbol. What exceeds ``memory`` tuples goes to disk as a sorted run.
    """

    def __init__(self, memory: int, ends: list[int]):
        self.memory, self.ends = memory, np.array(ends, np.int64)
        self.waiting: list[list[np.ndarray]] = [[] for _ in ends]
        self.size = 0

    def push(self, rows: np.ndarray) -> None:
        edges = np.searchsorted(rows[:, 0], self.ends)
        low = 0
        for i in np.flatnonzero(np.diff(edges, prepend=0)).tolist():
            self.waiting[i].append(rows[low : edges[i]])
            low = int(edges[i])
        self.size += len(rows)
        if self.size > self.memory:
            self._spill()

    def _spill(self) -> None:
        """Move all tuples in memory to a file, range by range; the ranges keep views of it."""
        kept = np.memmap(tempfile.TemporaryFile(), dtype=np.int64, mode="w+", shape=(self.size, 4))
        at = 0
        for parts in self.waiting:
            start = at
            fresh = [p for p in parts if not isinstance(p, np.memmap)]
            for p in fresh:
                kept[at : at + len(p)] = p
                at += len(p)
            if fresh:
                parts[:] = [p for p in parts if isinstance(p, np.memmap)] + [kept[start:at]]
        self.size = 0

    def pop(self, i: int) -> np.ndarray:
        """All tuples of range ``i``, in order; later pushes must not belong to it."""
        parts, self.waiting[i] = self.waiting[i], []
        self.size -= sum(len(p) for p in parts if not isinstance(p, np.memmap))
        rows = np.concatenate([np.asarray(p) for p in parts]) if parts else np.empty((0, 4), np.int64)
        return rows[np.argsort(rows[:, 0], kind="stable")]


class Text:
    """Symbols of a level, read forward or with their order reversed."""

    def __init__(self, symbols: np.ndarray, top: int, reverse: bool = False):
        self.symbols, self.top, self.reverse = symbols, top, reverse

    def reversed(self) -> Text:
        return Text(self.symbols, self.top, not self.reverse)

    def at(self, positions: np.ndarray) -> np.ndarray:
        found = np.asarray(self.symbols[positions], np.int64)
        return self.top - found if self.reverse else found

    def splitters(self, memory: int) -> list[int]:
        """Upper ends of ranges of symbols with at most about ``memory`` suffixes each, at least some 8 ranges."""
        n = len(self.symbols)
        sample = np.sort(self.at(np.arange(0, n, max(1, n // SAMPLE))))
        step = max(1, int(len(sample) * min(memory, max(4096, n // 8)) / max(n, 1)))
        return [*(int(v) for v in np.unique(sample[step::step]) if v > sample[0]), self.top + 1]

    def runs(self, positions: np.ndarray) -> np.ndarray:
        """How often the first symbol of each suffix stands there in a row; sentinels stand alone."""
        out = np.ones(len(positions), np.int64)
        symbol = self.at(positions)
        active = np.flatnonzero(symbol)
        while len(active):
            active = active[self.at(positions[active] + out[active]) == symbol[active]]
            out[active] += 1
        return out

    def equal_run(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Common prefix of suffixes that begin with a run of the same symbol and go on to different sides of it."""
        out = np.ones(len(one), np.int64)
        symbol, active = self.at(one), np.arange(len(one))
        while len(active):
            k = out[active]
            same = (self.at(one[active] + k) == symbol[active]) & (self.at(two[active] + k) == symbol[active])
            active = active[same]
            out[active] += 1
        return out


def _junction(text: Text, pos: np.ndarray, lcp: np.ndarray, symbol: np.ndarray, second: np.ndarray) -> None:
    """Fill in the common prefix of neighbours of one symbol where the first kind of suffix ends and the second begins."""
    at = np.flatnonzero((symbol[1:] == symbol[:-1]) & second[1:] & ~second[:-1]) + 1
    if len(at):
        lcp[at] = text.equal_run(pos[at - 1], pos[at])


def induce(text: Text, target: np.ndarray, count: int, seeds: np.ndarray, seed_lcp: np.ndarray, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the ``count`` suffixes marked by ``target``, sorted, with their common prefixes; ``seeds`` are sorted.

    Every suffix that is induced begins with a symbol not less than its inducer's, and of one symbol the induced come
    before the seeds.
    """
    ends = text.splitters(memory)
    queue = SuffixQueue(memory, ends)
    out, out_lcp, done, base, seed_at = scratch(count, np.int64), scratch(count, np.int64), 0, 0, 0
    for turn, below in enumerate(ends):
        waiting = queue.pop(turn)
        seed_end = bisect.bisect_left(range(len(seeds)), below, lo=seed_at, key=lambda i: int(text.at(seeds[i : i + 1])[0]))
        own = np.asarray(seeds[seed_at:seed_end])
        m, k = len(waiting), len(waiting) + len(own)
        if not k:
            continue
        pos, symbol = [waiting[:, 2], own], [waiting[:, 0], text.at(own)]
        follows, outside = [np.full(k, -1)], []
        frontier, at, size, depth = np.arange(k), np.concatenate(pos), k, 0
        while len(frontier):
            # Predecessors of the suffixes found last: inside the range they join it, beyond it they go to the queue.
            before = at - 1
            wanted = before >= 0
            wanted[wanted] = target[before[wanted]]
            before, by = before[wanted], frontier[wanted]
            first = text.at(before)
            inside = first < below
            outside.append((first[~inside], before[~inside], by[~inside]))
            at, depth = before[inside], depth + 1
            pos.append(at)
            symbol.append(first[inside])
            follows.append(by[inside])
            frontier = np.arange(size, size + len(at))
            size += len(at)
        pos, symbol, follows = np.concatenate(pos), np.concatenate(symbol), np.concatenate(follows)
        kind = np.ones(size, np.int64)  # 0: from the queue, 1: induced inside the range, 2: seed
        kind[:m], kind[m:k] = 0, 2
        group = (np.unique(symbol, return_inverse=True)[1] * 3 + kind) * size
        key = np.arange(size)
        order = np.argsort(group + key)
        rank = np.empty(size, np.int64)
        rank[order] = np.arange(size)
        for _ in range(depth - 1):  # a suffix that is n steps from the queue or a seed is in its place after n turns
            key[k:] = rank[follows[k:]]
            order = np.argsort(group + key, kind="stable")
            rank[order] = np.arange(size)
        pos_sorted, symbol_sorted, kind_sorted = pos[order], symbol[order], kind[order]
        lcp = np.zeros(size, np.int64)
        same = np.flatnonzero(symbol_sorted[1:] == symbol_sorted[:-1]) + 1
        lcp[same] = 1
        from_queue, from_seed = same[kind_sorted[same] == 0], same[(kind_sorted[same] == 2) & (kind_sorted[same - 1] == 2)]
        lcp[from_queue] = waiting[order[from_queue], 3]
        lcp[from_seed] = seed_lcp[seed_at + order[from_seed] - m]
        _junction(text, pos_sorted, lcp, symbol_sorted, kind_sorted == 2)
        pairs = same[(kind_sorted[same] == 1) & (kind_sorted[same - 1] == 1)]
        if len(pairs):
            one, two = rank[follows[order[pairs - 1]]], rank[follows[order[pairs]]]
            for _ in range(depth - 1):
                lcp[pairs] = 1 + RangeMinimum.once(lcp, one + 1, two)
        first, before, by = (np.concatenate(c) for c in zip(*outside))
        if len(first):
            by = rank[by]
            order = np.lexsort((by, first))
            first, before, by = first[order], before[order], by[order]
            shared = np.ones(len(first), np.int64)
            near = np.flatnonzero(first[1:] == first[:-1]) + 1
            if len(near):
                shared[near] = 1 + RangeMinimum.once(lcp, by[near - 1] + 1, by[near])
            queue.push(np.stack([first, base + by, before, shared], axis=1))
        found = kind_sorted != 2
        n = int(found.sum())
        out[done : done + n], out_lcp[done : done + n] = pos_sorted[found], lcp[found]
        done, base, seed_at = done + n, base + size, seed_end
    return out, out_lcp


def _types(symbols: np.ndarray) -> np.ndarray:
    """True where a suffix is S: less than the one that follows. Sentinels are S."""
    n = len(symbols)
    out, after, last = scratch(n, np.bool_), 0, True
    for end in range(n, 0, -CHUNK):
        start = max(0, end - CHUNK)
        here = np.asarray(symbols[start:end], np.int64)
        step = np.append(here[1:], after) - here
        if end == n:
            step[-1] = 1
        # The next place from here on where the symbol changes decides; behind the chunk the type of its first suffix.
        change = np.where(step != 0, np.arange(len(step)), len(step))
        change = np.minimum.accumulate(change[::-1])[::-1]
        out[start:end] = np.where(change < len(step), step[np.minimum(change, len(step) - 1)] > 0, last)
        after, last = int(here[0]), bool(out[start])
    return out


def _where(n: int, mask) -> np.ndarray:
    """Places where ``mask(start, end)`` holds, in order."""
    parts = [np.flatnonzero(mask(a, min(n, a + CHUNK))) + a for a in range(0, n, CHUNK)]
    total = sum(map(len, parts))
    out, at = scratch(total, np.int64), 0
    for p in parts:
        out[at : at + len(p)] = p
        at += len(p)
    return out


def _descending(pos: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same suffixes from the last to the first."""
    back = np.zeros(len(lcp), lcp.dtype) if len(lcp) < CHUNK else scratch(len(lcp), lcp.dtype)
    back[1:] = lcp[:0:-1]
    return pos[::-1], back


def _induce_both(text: Text, small: np.ndarray, seeds: np.ndarray, seed_lcp: np.ndarray, memory: int):
    """Sorted L suffixes and sorted S suffixes (sentinels left out), each with common prefixes."""
    n = len(text.symbols)
    large, other = scratch(n, np.bool_), scratch(n, np.bool_)
    counts = [0, 0]
    for a in range(0, n, CHUNK):
        s = np.asarray(small[a : a + CHUNK])
        large[a : a + CHUNK], other[a : a + CHUNK] = ~s, s & (np.asarray(text.symbols[a : a + CHUNK]) != 0)
        counts = [counts[0] + int((~s).sum()), counts[1] + int(other[a : a + CHUNK].sum())]
    ls = induce(text, large, counts[0], seeds, seed_lcp, memory)
    down = induce(text.reversed(), other, counts[1], *_descending(*ls), memory)
    return ls, _descending(*down)


def _merged(text: Text, ls: tuple[np.ndarray, np.ndarray], ss: tuple[np.ndarray, np.ndarray], memory: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in order with common prefixes, one range of first symbols at a time."""
    at = [0, 0]
    for below in text.splitters(memory):
        ends = [bisect.bisect_left(range(len(p)), below, lo=a, key=lambda i, p=p: int(text.at(p[i : i + 1])[0])) for (p, _), a in zip((ls, ss), at)]
        pos = np.concatenate([p[a:e] for (p, _), a, e in zip((ls, ss), at, ends)])
        lcp = np.concatenate([c[a:e] for (_, c), a, e in zip((ls, ss), at, ends)])
        second = np.arange(len(pos)) >= ends[0] - at[0]
        at = ends
        if len(pos):
            symbol = text.at(pos)
            order = np.lexsort((second, symbol))
            pos, lcp, symbol, second = pos[order], lcp[order], symbol[order], second[order]
            lcp[0] = 0
            lcp[1:][symbol[1:] != symbol[:-1]] = 0
            _junction(text, pos, lcp, symbol, second)
            yield pos, lcp


def _least_between(keep: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Common prefixes of the kept rows with the kept row before, from those of all rows."""
    at = np.flatnonzero(keep)
    if not len(at):
        return lcp[:0]
    starts = np.append(0, at[:-1] + 1)
    return np.minimum.reduceat(lcp[: at[-1] + 1], starts)


def _sorted_lms(text: Text, small: np.ndarray, lms: np.ndarray, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """LMS suffixes in order (sentinels left out) with common prefixes."""
    symbol, run = text.at(lms), text.runs(lms)
    # Seeds stand for the ends of substrings here: the run of their first symbol, which a larger one follows, so long runs come first.
    turn = np.lexsort((-run, symbol))
    seeds, first, ends = lms[turn], symbol[turn], run[turn]
    shared = np.zeros(len(seeds), np.int64)
    shared[1:] = np.where((first[1:] == first[:-1]) & (first[1:] != 0), ends[1:], 0)
    _, (pos, lcp) = _induce_both(text, small, seeds, shared, memory)
    is_lms = np.zeros(len(pos), bool)
    before = pos - 1
    is_lms[before >= 0] = ~small[before[before >= 0]]
    shared = _least_between(is_lms, lcp)
    pos = pos[is_lms]
    if not len(pos):
        return pos, shared
    index = np.searchsorted(lms, pos)
    length = lms[index + 1] - pos + run[index + 1]
    new = np.ones(len(pos), bool)
    new[1:] = (shared[1:] < length[1:]) | (length[1:] != length[:-1])
    if new.all():
        return pos, shared
    reduced = scratch(len(lms), np.int64)
    reduced[index] = np.cumsum(new)
    between = RangeMinimum(np.concatenate([[0], shared[new]]))  # at a name: with the name before
    index, names = sort_suffixes(reduced, memory)
    shared = np.zeros(len(index), np.int64)
    for a in range(1, len(index), CHUNK):
        one, two, same = index[a - 1 : a + CHUNK - 1], index[a : a + CHUNK], names[a : a + CHUNK]
        one, two = one[: len(two)], two[: len(one)]
        x, y = reduced[one + same], reduced[two + same]
        differ = np.flatnonzero(x != y)
        part = lms[two + same] - lms[two]
        part[differ] += between.least(x[differ] + 1, y[differ])
        shared[a : a + CHUNK] = part
    return lms[index], shared


def _levels(symbols: np.ndarray, memory: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    n = len(symbols)
    top = max((int(symbols[a : a + CHUNK].max()) for a in range(0, n, CHUNK)), default=0)
    text = Text(symbols, top)
    small = _types(symbols)
    # A suffix before the first place has no predecessor, so place 0 is never LMS.
    lms = _where(n, lambda a, b: small[a:b] & ~np.append(True if a == 0 else small[a - 1], small[a : b - 1]))
    seeds, shared = _sorted_lms(text, small, lms, memory)
    ends = lms[text.at(lms) == 0]
    seeds, shared = np.concatenate([ends, seeds]), np.concatenate([np.zeros(len(ends), np.int64), shared])
    yield from _merged(text, *_induce_both(text, small, seeds, shared, memory), memory)


def sort_suffixes(symbols: np.ndarray, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes of segments of ``symbols`` (each ended by 0) in order, with their common prefixes in symbols.

    The sentinels themselves are left out; equal suffixes are neighbours, in no particular order.
    """
    n = int((np.asarray(symbols) != 0).sum())
    pos, lcp, at = scratch(n, np.int64), scratch(n, np.int64), 0
    for p, c in _levels(symbols, memory):
        pos[at : at + len(p)], lcp[at : at + len(p)] = p, c
        at += len(p)
    return pos, lcp


def packed(data: np.ndarray, width: int) -> np.ndarray:
    """Symbols of ``width`` neighbours each from codes (byte + 1, sentinels 0), cut off at the segment's end."""
    n = len(data)
    out = scratch(n, np.int64)
    for a in range(0, n, CHUNK):
        here = np.asarray(data[a : a + CHUNK + width - 1], np.int64)
        m = min(CHUNK, n - a)
        symbol, inside = np.zeros(m, np.int64), np.ones(m, bool)
        for j in range(width):
            code = np.zeros(m, np.int64)
            part = here[j : j + m]
            code[: len(part)] = part
            inside &= code != 0
            symbol = symbol * 257 + np.where(inside, code, 0)
        out[a : a + m] = symbol
    return out


def repeated_groups(data: np.ndarray, length: int, memory: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``positions, group starts`` of suffixes that share their first ``length`` bytes with another, range by range."""
    width = min(SYMBOL_BYTES, length)
    least = length - width + 1
    for pos, lcp in _levels(packed(data, width), memory):
        joined = lcp >= least
        member = joined.copy()
        member[:-1] |= joined[1:]
        if member.any():
            at = np.flatnonzero(member)
            yield pos[at], np.flatnonzero(~joined[at])
