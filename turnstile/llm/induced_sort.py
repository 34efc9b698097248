"""Suffixes and their common prefixes by external induced sorting.

The suffixes of a text that start where it begins to rise (the *seeds*) are sorted by recursion on the names of the
stretches between them; two sweeps induce all others from these. A sweep visits suffixes in order and sends each one's
predecessor to a priority queue, as a tuple (symbol, position, common prefix): tuples leave it by symbol and, for equal
symbols, in the order in which they came, which is the order of the suffixes. A tuple's common prefix with the one before it
under its symbol is one more than the least common prefix that the sweep has passed between their two sources.

The queue keeps sorted runs and writes them to disk when they pass ``budget`` tuples; arrays of the text's length that pass it
are maps of files too, so that memory is bounded by the budget and a batch. Files are unlinked as soon as they are
made: they belong to the running task alone, like Spark's own spill files, and go with it. Work inside a
sweep goes batch by batch in numpy: a batch is a slice of one symbol's tuples, or all tuples of a range of rare symbols, whose order
is settled by repeated sorting on their sources' places.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Tuples that a queue holds in memory, and symbols of an array in memory.
BUDGET = 16_000_000
BATCH = 1 << 16
#: Type of common prefixes; a cap stays below its end.
PREFIX = np.int16


def array(n: int, dtype, budget: int) -> np.ndarray:
    """Room for ``n`` values, in a file beyond ``budget``."""
    if n <= budget:
        return np.empty(n, dtype)
    return np.memmap(tempfile.TemporaryFile(), dtype, "w+", shape=(n,))


def _on_disk(x: np.ndarray) -> np.ndarray:
    out = array(len(x), x.dtype, 0)
    out[:] = x
    return out


class Queue:
    """Tuples (symbol, position, common prefix) by symbol, then by arrival. A push is sorted by symbol already."""

    def __init__(self, budget: int):
        self.budget = budget
        self.runs: list[list] = []  # [symbols, positions, prefixes, next place, on disk], by arrival
        self.held = 0

    def push(self, symbols: np.ndarray, positions: np.ndarray, prefixes: np.ndarray) -> None:
        if not len(symbols):
            return
        self.runs.append([symbols, positions, prefixes, 0, False])
        self.held += len(symbols)
        while len(self.runs) > 1 and not self.runs[-2][4] and self._left(-2) < 2 * self._left(-1):
            self._merge(len(self.runs) - 2)
        if self.held > self.budget:
            first = next(i for i, run in enumerate(self.runs) if not run[4])
            self._merge(first)
            self.runs[first] = [*map(_on_disk, self.runs[first][:3]), 0, True]
            self.held = 0

    def _left(self, i: int) -> int:
        return len(self.runs[i][0]) - self.runs[i][3]

    def _merge(self, first: int) -> None:
        rest = [[x[run[3] :] for x in run[:3]] for run in self.runs[first:]]
        joined = [np.concatenate(x) for x in zip(*rest, strict=True)]
        order = np.argsort(joined[0], kind="stable")
        self.runs[first:] = [[*(x[order] for x in joined), 0, False]]

    def pop(self, below: int, most: int | None = None) -> list[np.ndarray]:
        """The tuples of symbols under ``below``; at most ``most`` if only one such symbol is left."""
        parts, room = [], most
        for run in self.runs:
            at = run[3]
            upto = at + int(np.searchsorted(run[0][at:], below))
            if room is not None:
                upto = min(upto, at + room)
                room -= upto - at
            if upto > at:
                parts.append([np.asarray(x[at:upto]) for x in run[:3]])
                run[3] = upto
                if not run[4]:
                    self.held -= upto - at
        self.runs = [run for run in self.runs if run[3] < len(run[0])]
        if not parts:
            return [np.zeros(0, np.int64)] * 3
        if len(parts) == 1:
            return parts[0]
        joined = [np.concatenate(x) for x in zip(*parts, strict=True)]
        if most is not None:  # of one symbol: they are in order
            return joined
        order = np.argsort(joined[0], kind="stable")
        return [x[order] for x in joined]

    def sorted_blocks(self, most: int):
        """All tuples in order, in blocks of whole symbols of about ``most``."""
        while self.runs:
            share = max(1, most // len(self.runs))
            below = min(int(run[0][min(run[3] + share, len(run[0])) - 1]) for run in self.runs) + 1
            yield self.pop(below)


class _Least:
    """Least value of any stretch of an array."""

    def __init__(self, x: np.ndarray):
        levels, span = [x], 1
        while span * 2 <= len(x):
            low = levels[-1]
            levels.append(np.minimum(low[:-span], low[span:]))
            span *= 2
        self.offset = np.cumsum([0, *map(len, levels)])[:-1]
        self.flat = np.concatenate(levels)

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.frexp((last - first + 1).astype(np.float32))[1] - 1
        start = self.offset[level]
        return np.minimum(self.flat[start + first], self.flat[start + last + 1 - (1 << level)])


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap) -> np.ndarray:
    """Symbols that the suffixes at ``a`` and ``b`` share, ``cap`` at most."""
    out = np.zeros(len(a), PREFIX)
    cap = np.broadcast_to(np.asarray(cap, PREFIX), out.shape)
    at = np.flatnonzero((cap > 0) & (a != b))
    out[a == b] = cap[a == b]
    n = len(text)
    while len(at):
        x, y = a[at] + out[at], b[at] + out[at]
        at, x, y = (z[(x < n) & (y < n)] for z in (at, x, y))
        at = at[text[x] == text[y]]
        out[at] += 1
        at = at[out[at] < cap[at]]
    return out


class _Sweep:
    """One sweep over ``text`` by rising symbol: under each symbol the induced suffixes, then the seeds."""

    def __init__(self, text, induced, seeds, seed_prefix, sigma: int, cap: int, keep_seeds: bool, budget: int, batch: int):
        self.text, self.induced, self.seeds, self.seed_prefix, self.cap = text, induced, seeds, seed_prefix, cap
        self.keep_seeds, self.batch = keep_seeds, batch
        self.queue = Queue(budget)
        # For the last tuple of each symbol its batch and the least common prefix after it there; and the least of any number
        # of last batches, as a list of falling batches and rising values (at most ``cap`` of them).
        self.last_batch, self.after = np.full(sigma, -1), np.full(sigma, cap, PREFIX)
        self.batches, self.least_from = [], []
        self.n_batches = 0
        n_induced, n_seeds = np.zeros(sigma, np.int64), np.zeros(sigma, np.int64)
        for i in range(0, len(text), BATCH):
            n_induced += np.bincount(text[i : i + BATCH][induced[i : i + BATCH]], minlength=sigma)
        for i in range(0, len(seeds), BATCH):
            n_seeds += np.bincount(text[seeds[i : i + BATCH]], minlength=sigma)
        self.up_to = np.cumsum(n_induced + n_seeds)
        self.seeds_to = np.cumsum(n_seeds)
        size = int(n_induced.sum()) + (len(seeds) if keep_seeds else 0)
        self.positions, self.prefixes, self.made = array(size, np.int64, budget), array(size, PREFIX, budget), 0

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        low, sigma = 0, len(self.up_to)
        while low < sigma:
            done = int(self.up_to[low - 1]) if low else 0
            low = int(np.searchsorted(self.up_to, done, side="right"))  # past symbols without suffixes
            if low >= sigma:
                break
            high = int(np.searchsorted(self.up_to, done + self.batch, side="right"))
            if high > low:
                self.together(low, high)
            else:
                self.one(low)
            low = max(high, low + 1)
        return self.positions, self.prefixes

    def _seeds(self, low: int, high: int) -> slice:
        return slice(int(self.seeds_to[low - 1]) if low else 0, int(self.seeds_to[high - 1]))

    def _keep(self, positions: np.ndarray, prefixes: np.ndarray) -> None:
        upto = self.made + len(positions)
        self.positions[self.made : upto], self.prefixes[self.made : upto] = positions, prefixes
        self.made = upto

    def _predecessors(self, positions: np.ndarray) -> np.ndarray:
        """Places of those whose predecessor is to be induced."""
        return np.flatnonzero((positions > 0) & self.induced[positions - 1])

    def _sent(self, prefixes: np.ndarray, at: np.ndarray, symbols: np.ndarray):
        """For predecessors sent from the places ``at``: their order by symbol, common prefixes in that order, and of each
        symbol the least common prefix after its last one."""
        least = _Least(prefixes)
        order = np.argsort(symbols, kind="stable")
        s, i = symbols[order], at[order]
        again = np.zeros(len(s), bool)
        again[1:] = s[1:] == s[:-1]
        first = np.zeros(len(s), np.int64)
        first[1:][again[1:]] = i[:-1][again[1:]] + 1
        value = least.of(first, i)
        alone = s[~again]
        value[~again] = np.minimum(value[~again], self._passed(alone))
        last = np.ones(len(s), bool)
        last[:-1] = ~again[1:]
        after = np.full(int(last.sum()), self.cap, PREFIX)
        some = i[last] + 1 < len(prefixes)
        after[some] = least.of(i[last][some] + 1, np.full(int(some.sum()), len(prefixes) - 1))
        return order, np.minimum(value + 1, self.cap), (s[last], after)

    def _passed(self, symbols: np.ndarray) -> np.ndarray:
        """Least common prefix that the sweep has passed since the last tuple of each symbol."""
        out = self.after[symbols]
        if self.batches:
            place = np.searchsorted(np.array(self.batches), self.last_batch[symbols], side="right")
            least = np.append(np.array(self.least_from, PREFIX), PREFIX(self.cap))
            out = np.minimum(out, least[place])
        return out

    def _pass(self, least: int, symbols: np.ndarray, after: np.ndarray) -> None:
        """A batch is over: its least common prefix, and what followed the last tuple of its symbols."""
        while self.least_from and self.least_from[-1] >= least:
            self.least_from.pop(), self.batches.pop()
        self.least_from.append(least), self.batches.append(self.n_batches)
        self.last_batch[symbols], self.after[symbols] = self.n_batches, after
        self.n_batches += 1

    def _send(self, positions: np.ndarray, prefixes: np.ndarray, least: int = 0) -> None:
        """A batch, in order: the predecessors of symbol ``least`` and more go to the queue."""
        at = self._predecessors(positions)
        before = positions[at] - 1
        symbols = self.text[before]
        if least:
            out = symbols >= least
            at, before, symbols = at[out], before[out], symbols[out]
        order, value, (of, after) = self._sent(prefixes, at, symbols)
        self._pass(int(prefixes.min()), of, after)
        self.queue.push(symbols[order], before[order], value)

    def one(self, symbol: int) -> None:
        last = None
        while len((items := self.queue.pop(symbol + 1, self.batch))[0]):
            positions, prefixes = items[1], items[2].copy()
            if last is None:
                prefixes[0] = 0
            last = positions[-1:]
            self._keep(positions, prefixes)
            self._send(positions, prefixes)
        part = self._seeds(symbol, symbol + 1)
        for i in range(part.start, part.stop, self.batch):
            some = slice(i, min(i + self.batch, part.stop))
            positions, prefixes = np.asarray(self.seeds[some]), np.array(self.seed_prefix[some])
            if i == part.start:
                prefixes[0] = 0 if last is None else common_prefix(self.text, last, positions[:1], self.cap)[0]
            if self.keep_seeds:
                self._keep(positions, prefixes)
            self._send(positions, prefixes)

    def together(self, low: int, high: int) -> None:
        """All symbols from ``low`` to below ``high``, which have a batch of suffixes at most."""
        items = self.queue.pop(high)
        part = self._seeds(low, high)
        seeds = np.asarray(self.seeds[part])
        waited, fixed = len(items[1]), len(items[1]) + len(seeds)
        positions, sources, depths = [np.concatenate([items[1], seeds])], [], []
        offset, total = 0, fixed
        while True:  # what the range sends to itself
            at = self._predecessors(positions[-1])
            before = positions[-1][at] - 1
            inside = self.text[before] < high
            if not inside.any():
                break
            sources.append(offset + at[inside])
            positions.append(before[inside])
            depths.append(len(positions) - 1)
            offset, total = total, total + len(positions[-1])
        depth = np.repeat(np.array([0, *depths]), list(map(len, positions)))
        source = np.concatenate([np.zeros(fixed, np.int64), *sources])
        positions = np.concatenate(positions)
        symbols = self.text[positions].astype(np.int64)
        n = len(positions)
        kind = np.ones(n, np.int64)  # under a symbol: what waited, what the range sends itself, seeds
        kind[:waited], kind[waited:fixed] = 0, 2
        key, place = (symbols * 3 + kind) * (n + 1), np.arange(n)
        rank = np.empty(n, np.int64)
        rank[np.argsort(key + place)] = np.arange(n)
        # After round d what is d steps from its first source is in order; other symbols' places stay.
        moving, some = np.flatnonzero(depth), np.arange(n)
        for d in range(1, len(depths) + 1):
            moving = moving[depth[moving] >= d]
            place[moving] = rank[source[moving]]
            marked = np.zeros(high - low, bool)
            marked[symbols[moving] - low] = True
            some = some[marked[symbols[some] - low]]
            rank[some[np.argsort(key[some] + place[some])]] = np.sort(rank[some])
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        positions, kind, symbols = positions[order], kind[order], symbols[order]
        prefixes = np.empty(n, PREFIX)
        prefixes[rank[:waited]] = items[2]
        prefixes[rank[waited:fixed]] = self.seed_prefix[part]
        starts = np.ones(n, bool)
        starts[1:] = symbols[1:] != symbols[:-1]
        prefixes[starts] = 0
        # Neighbours inside the range, and a first seed after induced suffixes, are compared.
        meet = (kind == 1) & ~starts
        meet[1:] |= (kind[1:] == 2) & (kind[:-1] != 2) & ~starts[1:]
        meet = np.flatnonzero(meet)
        prefixes[meet] = common_prefix(self.text, positions[meet - 1], positions[meet], self.cap)
        shown = slice(None) if self.keep_seeds else kind != 2
        self._keep(positions[shown], prefixes[shown])
        self._send(positions, prefixes, high)


def _rising(text: np.ndarray, budget: int) -> np.ndarray:
    """Whether each suffix is smaller than the next one (the last counts as such), from the end, block by block."""
    n = len(text)
    out = array(n, bool, budget)
    out[n - 1] = True
    step = max(BATCH, budget)
    for stop in range(n - 1, 0, -step):
        start = max(0, stop - step)
        here, after = text[start:stop].astype(np.int64), text[start + 1 : stop + 1].astype(np.int64)
        differs = np.where(here != after, np.arange(stop - start), stop - start)
        nearest = np.minimum.accumulate(differs[::-1])[::-1]
        less = np.append(here < after, out[stop])
        out[start:stop] = less[nearest]
    return out


def _names(text: np.ndarray, rising: np.ndarray, seeds: np.ndarray, sigma: int, budget: int) -> tuple[np.ndarray, int]:
    """Names, by rank, of the stretches from each seed to the next one, both ends included; the last is a single symbol."""
    k = len(seeds)
    base = 2 * sigma
    group, size = array(k, np.int64, budget), array(k, np.int32, budget)
    group[:] = 0
    size[:-1], size[-1] = seeds[1:] - seeds[:-1] + 1, 1
    active = None  # all
    offset = 0
    while True:
        n_active = k if active is None else len(active)
        width = 1
        while k * base ** (width + 1) < 2**62 and width < 8:
            width += 1
        queue = Queue(budget)
        for i in range(0, n_active, BATCH):
            j = np.arange(i, min(i + BATCH, n_active)) if active is None else np.asarray(active[i : i + BATCH])
            key = np.array(group[j])
            for step in range(offset, offset + width):
                inside = step < size[j]
                at = np.where(inside, seeds[j] + step, 0)
                key = key * base + np.where(inside, 2 * text[at].astype(np.int64) + rising[at], 0)
            order = np.argsort(key, kind="stable")
            queue.push(key[order], j[order], np.zeros(len(j), np.int8))
        offset += width
        left, whole = [], base**width
        start_of, start_at, seen = -1, 0, 0  # the group being refined, and where it began among the active ones
        for key, j, _ in queue.sorted_blocks(BATCH * 4):
            old = key // whole
            place = np.arange(seen, seen + len(key))
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            begins = np.ones(len(key), bool)
            begins[1:] = old[1:] != old[:-1]
            begins[0] = old[0] != start_of
            begun = np.where(begins, place, -1)
            if not begins[0]:
                begun[0] = start_at
            begun = np.maximum.accumulate(begun)
            first = np.maximum.accumulate(np.where(new, place, -1))
            group[j] = old + first - begun
            tied = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1
            left.append(j[tied & (size[j] > offset)])
            start_of, start_at, seen = int(old[-1]), int(begun[-1]), seen + len(key)
        rest = np.concatenate([np.zeros(0, np.int64), *left])
        if not len(rest):
            break
        active = array(len(rest), np.int64, budget)
        active[:] = np.sort(rest)
    # From places in the order to names without gaps.
    present = array(k, np.int8, budget)
    present[:] = 0
    for i in range(0, k, BATCH):
        present[group[i : i + BATCH]] = 1
    name = array(k, np.int64, budget)
    np.cumsum(present, out=name, dtype=np.int64)
    for i in range(0, k, BATCH):
        group[i : i + BATCH] = name[group[i : i + BATCH]] - 1
    return group, int(name[-1])


def sort_suffixes(text: np.ndarray, sigma: int, cap: int, budget: int = BUDGET, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the suffixes in order, symbols that each shares with the one before it, ``cap`` at most).

    ``text`` holds symbols from 0 to ``sigma`` - 1; its last symbol is 0 and stands nowhere else."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, PREFIX)
    rising = _rising(text, budget)
    starts = []
    for i in range(1, n, BATCH):
        upto = min(i + BATCH, n)
        starts.append(i + np.flatnonzero(rising[i:upto] & ~rising[i - 1 : upto - 1]))
    seeds = array(sum(map(len, starts)), np.int64, budget)
    np.concatenate(starts, out=seeds)
    del starts
    names, distinct = _names(text, rising, seeds, sigma, budget)
    if distinct == len(seeds):
        order = array(len(seeds), np.int64, budget)
        order[names] = np.arange(len(seeds))
        shared = np.zeros(len(seeds), PREFIX)
    else:
        order, shared = sort_suffixes(names, distinct, cap, budget, batch)
    # Common prefixes in names to common prefixes in symbols: whole equal stretches, then the two that differ.
    seed_prefix = array(len(seeds), PREFIX, budget)
    seed_prefix[0] = 0
    for i in range(1, len(seeds), BATCH):
        a, b, equal = order[i - 1 : i - 1 + BATCH], order[i : i + BATCH], shared[i : i + BATCH].astype(np.int64)
        a = a[: len(b)]
        x, y = seeds[a + equal], seeds[b + equal]
        whole = np.minimum(x - seeds[a], cap).astype(PREFIX)
        seed_prefix[i : i + BATCH] = whole + common_prefix(text, x, y, cap - whole)
    falling = array(n, bool, budget)
    np.logical_not(rising, out=falling)
    sorted_seeds = array(len(seeds), np.int64, budget)
    sorted_seeds[:] = seeds[order]
    del names, order, shared, seeds
    larger, larger_prefix = _Sweep(text, falling, sorted_seeds, seed_prefix, sigma, cap, False, budget, batch).run()
    del falling, sorted_seeds, seed_prefix
    # The other way round: symbols mirrored, the falling suffixes are the seeds, the largest first.
    mirrored = array(n, text.dtype, budget)
    np.subtract(text.dtype.type(sigma - 1), text, out=mirrored)
    rising[n - 1] = False
    back = array(len(larger), PREFIX, budget)
    if len(larger):
        back[0], back[1:] = 0, larger_prefix[:0:-1]
    down, down_prefix = _Sweep(mirrored, rising, larger[::-1], back, sigma, cap, True, budget, batch).run()
    positions, prefixes = array(n, np.int64, budget), array(n, PREFIX, budget)
    positions[0], prefixes[0] = n - 1, 0
    positions[1:] = down[::-1]
    prefixes[1:2], prefixes[2:] = 0, down_prefix[:0:-1]
    return positions, prefixes
