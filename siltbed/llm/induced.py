"""External induced sorting of suffixes with their common-prefix values.

The text is a row of pieces, each closed by ``END``, which is less than every symbol
and equal to none, not even to another end. Suffixes are classified from the right:
S if less than the suffix after, else L; an S after an L is sampled. One induction
sorts the substrings between samples, which are named; neighbouring names are named
again, pair by pair, until samples differ or agree on ``depth`` symbols. From the
sorted samples two scans then induce the order of all suffixes: each suffix that a
scan pops pushes the one before it.

A scan's priority queue pops by first symbol, then by arrival, so it is a run of
tuples per symbol, appended at the end and popped whole; beyond a number of tuples
the runs go to disk. A tuple is a suffix's place and the prefix it shares with the
tuple pushed before: one more than the least value scanned between the two. Values
stop at ``depth``; suffixes that agree on so many symbols may come in any order.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

END = 0
SYMBOLS = 257           # bytes plus one, and the end
MEMORY = 4_000_000      # tuples a queue holds before it spills
_TUPLE = np.dtype([("place", np.int32), ("common", np.int16)])


class TupleQueue:
    """Runs of tuples per symbol, in memory up to a number of tuples and else on disk."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.total, self.spilled = memory, 0, 0
        self.held: dict[int, list[np.ndarray]] = {}
        self.files: dict[int, tempfile._TemporaryFileWrapper] = {}

    def push(self, symbol: int, place: np.ndarray, common: np.ndarray) -> None:
        run = np.empty(len(place), _TUPLE)
        run["place"], run["common"] = place, common
        self.held.setdefault(symbol, []).append(run)
        self.total += len(run)
        if self.total > self.memory:
            for key, runs in self.held.items():
                file = self.files.get(key) or self.files.setdefault(key, tempfile.TemporaryFile())
                for one in runs:
                    file.write(one.tobytes())
            self.held, self.spilled, self.total = {}, self.spilled + self.total, 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """Everything that arrived for a symbol since its last pop, oldest first."""
        runs = self.held.pop(symbol, [])
        self.total -= sum(map(len, runs))
        if symbol in self.files:
            with self.files.pop(symbol) as file:
                file.seek(0)
                runs.insert(0, np.frombuffer(file.read(), _TUPLE))
        all_ = np.concatenate(runs) if len(runs) > 1 else runs[0] if runs else np.empty(0, _TUPLE)
        return all_["place"].astype(np.int64), all_["common"].astype(np.int64)


class _Scan:
    """One direction of the induction: what it pops pushes its predecessor of one type."""

    def __init__(self, sorter: Sorter, small: bool):
        self.text, self.is_s, self.small, self.depth = sorter.text, sorter.is_s, small, sorter.depth
        self.queue = TupleQueue(sorter.memory)
        # Least common prefix scanned since the last push for a symbol; -1 before the first.
        self.least = np.full(SYMBOLS, -1, np.int64)

    def feed(self, symbol: int, place: np.ndarray, common: np.ndarray) -> None:
        """Scan suffixes of ``symbol``; ``common`` is shared with the one scanned before."""
        if not len(place):
            return
        before = place - 1
        byte = np.where(before >= 0, self.text[before], END)
        if self.small:
            fits = (byte != END) & (byte <= symbol) & self.is_s[before]
        else:
            fits = (byte >= symbol) & (byte != END) & ~self.is_s[before]
        at = np.flatnonzero(fits)
        low = common.min()
        if not len(at):
            self.least = np.minimum(self.least, low)
            return
        to = byte[at]
        order = np.argsort(to, kind="stable")
        at, to = at[order], to[order]
        first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        least = np.minimum(self.least, low)
        for a, b in zip(first, np.r_[first[1:], len(to)]):
            own, target = at[a:b], int(to[a])
            last = int(own[-1])
            between = np.minimum.reduceat(common[:last + 1], np.r_[0, own[:-1] + 1])
            between[0] = min(between[0], self.least[target])
            self.queue.push(target, before[own], np.minimum(between + 1, self.depth))
            least[target] = common[last + 1:].min() if last + 1 < len(common) else self.depth
        self.least = least


class Sorter:
    """Sorted suffixes of pieces, from the symbols ``text`` (bytes plus one, ``END`` after each piece)."""

    def __init__(self, text: np.ndarray, depth: int, memory: int = MEMORY):
        self.text, self.depth, self.memory = text, depth, memory
        n = len(text)
        turn = np.flatnonzero(np.r_[text[:-1] != text[1:], True])   # last place of each run of a symbol
        length = np.diff(np.r_[-1, turn])
        self.is_s = np.repeat(text[turn] < np.append(text[1:], END)[turn], length)
        self.is_s[text == END] = True
        self.run = np.repeat(turn, length) - np.arange(n) + 1       # of the same symbol from here on
        sampled = self.is_s.copy()
        sampled[1:] &= ~self.is_s[:-1]
        sampled[:1] = False
        sampled[text == END] = True
        self.samples = np.flatnonzero(sampled)
        # Prefix sums of a random polynomial tell whether two stretches are equal.
        rng = np.random.default_rng(12345)
        value = rng.integers(1, 1 << 63, SYMBOLS, np.uint64) | np.uint64(1)
        base = np.uint64(0x9E3779B97F4A7C15)
        power = np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)
        self.sums = np.r_[np.uint64(0), np.cumsum(value[text] * power, dtype=np.uint64)]
        self.power = power

    def _same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether stretches at ``a`` < ``b`` agree: one is shifted onto the other."""
        a, b = np.minimum(a, b), np.maximum(a, b)
        left, right = self.sums[a + length] - self.sums[a], self.sums[b + length] - self.sums[b]
        shift = np.where(b > a, self.power[np.maximum(b - a - 1, 0)], np.uint64(1))
        return left * shift == right

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of two suffixes, up to the depth and before an end."""
        ends = np.flatnonzero(self.text == END)
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.depth, np.minimum(ends[np.searchsorted(ends, a)] - a, ends[np.searchsorted(ends, b)] - b))
        while (going := low < high).any():
            middle = (low + high + 1) // 2
            same = self._same(a, b, middle)
            low, high = np.where(going & same, middle, low), np.where(going & ~same, middle - 1, high)
        return low

    def _induce(self, seeds: np.ndarray, shared: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """Runs of sorted suffixes from sorted samples (any order within a symbol will do
        for sorting substrings), greatest first: places with what each shares with the
        one given before it."""
        first = self.text[seeds]
        bounds = np.searchsorted(first, np.arange(SYMBOLS + 1))
        rising, sorted_l = _Scan(self, small=False), TupleQueue(self.memory)
        for c in range(SYMBOLS):
            last = None
            while len((popped := rising.queue.pop(c))[0]):
                place, common = popped
                rising.feed(c, place, common)
                sorted_l.push(c, place, common)
                last = int(place[-1])
            place, common = seeds[bounds[c]:bounds[c + 1]], shared[bounds[c]:bounds[c + 1]].copy()
            if len(place):
                # An L and an S of one symbol share the shorter run of it.
                common[0] = 0 if last is None else min(self.run[last], self.run[place[0]], self.depth)
                rising.feed(c, place, common)
        falling = _Scan(self, small=True)
        for c in range(SYMBOLS - 1, END, -1):
            last = None
            while len((popped := falling.queue.pop(c))[0]):
                place, common = popped
                falling.feed(c, place, common)
                yield place, common
                last = int(place[-1])
            place, common = sorted_l.pop(c)
            if len(place):
                seam = 0 if last is None else min(self.run[last], self.run[place[-1]], self.depth)
                place, common = place[::-1], np.r_[seam, common[:0:-1]]
                falling.feed(c, place, common)
                yield place, common

    def _sorted_samples(self) -> np.ndarray:
        """Samples in order of their suffixes, ends first."""
        at, n = self.samples, len(self.samples)
        is_end = self.text[at] == END
        # Sort the substrings from sample to sample by one induction from unsorted samples.
        loose = at[np.argsort(self.text[at], kind="stable")]
        sampled = np.zeros(len(self.text), bool)
        sampled[at] = True
        runs = [place[sampled[place]] for place, _ in self._induce(loose, np.zeros(n, np.int64))]
        order = np.concatenate(runs)[::-1] if runs else np.empty(0, np.int64)
        rank_of = np.searchsorted(at, order)
        length = np.append(at[1:], len(self.text)) - at + 1         # up to the next sample, itself included
        name = np.zeros(n, np.int64)
        if len(order):
            a, b = rank_of[:-1], rank_of[1:]
            same = length[a] == length[b]
            same &= self._same(at[a], at[b], np.where(same, length[a], 0))
            name[rank_of] = np.cumsum(np.r_[True, ~same])
        # Name pairs of neighbouring names, up to the end of the piece.
        stop = np.flatnonzero(is_end)[np.searchsorted(np.flatnonzero(is_end), np.arange(n))]
        step = 1
        while True:
            used, count = np.unique(name, return_counts=True)
            several = (count[np.searchsorted(used, name)] > 1) & ~is_end
            reach = np.minimum(np.arange(n) + step, stop)
            if not (several & (reach < stop) & (at[reach] - at < self.depth)).any():
                return at[np.argsort(name, kind="stable")]
            after = np.where(np.arange(n) + step <= stop, name[reach], 0)
            name = np.unique(name * (n + 2) + after, return_inverse=True)[1]
            step *= 2

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes but the ends, greatest first, with what each shares with the one before."""
        if not (self.text != END).any():
            return
        seeds = self._sorted_samples()
        shared = np.r_[0, self._shared(seeds[:-1], seeds[1:])] if len(seeds) else np.empty(0, np.int64)
        yield from self._induce(seeds, shared)


def repeated(text: np.ndarray, depth: int, memory: int = MEMORY) -> np.ndarray:
    """For each place of ``text`` whether its first ``depth`` symbols, all in one piece,
    also start elsewhere."""
    found, before = np.zeros(len(text), bool), None
    for place, common in Sorter(text, depth, memory).runs():
        equal = common >= depth
        whole = place if before is None else np.r_[before, place]
        pairs = equal[1:] if before is None else equal
        found[whole[:-1][pairs]] = True
        found[whole[1:][pairs]] = True
        before = place[-1]
    return found


def symbols(pieces: list[bytes]) -> np.ndarray:
    """Pieces as one text, and an end after each."""
    raw = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int16) + 1
    return np.insert(raw, np.cumsum([len(p) for p in pieces]), END)
