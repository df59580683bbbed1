"""Suffix sorting by external recursive induction, with common-prefix values.

Sorted suffixes that start a rise (S*) induce all others: an ascending and then a
descending scan hand each suffix that is reached on to the one on its left, by a
priority queue of (symbol, time of arrival).  Its tuples carry a position, the least
common prefix met since the tuple before, and what is needed to go on from there;
they wait in memory up to a budget and beyond it in sorted runs on disk.  Symbols
are scanned in ranges of at most about a block of suffixes; a symbol that has more
streams through in blocks.  So alphabets of any size, as recursion makes them, and
strings of any length go the same way.

The order of the S* suffixes comes from the same induction: it sorts the pieces
between them, the pieces are named, and the string of names is sorted recursively.
The recursion hands back prefixes in names; each is turned into symbols by the
place where those names end, and only the first differing piece is compared.

Text, types, names, orders and prefixes are arrays of a Store, which maps those
beyond the budget from files, so memory does not grow with the string.  Files lie
in the executor's own spill folder, as Spark's do, unlinked as soon as they are open.
"""

from __future__ import annotations

import os
import tempfile
from array import array
from collections.abc import Callable, Iterator

import numpy as np

#: Bytes of memory for one sort, and most suffixes in a block.
MEMORY, BLOCK = 64 << 20, 1 << 16
#: Symbols up to which each is a range of its own.
SMALL = 512
#: Bytes that a part of a queue weighs besides its tuples.
PART = 128

_BARE = np.dtype([("symbol", "<u4"), ("pos", "<u4")])
_FULL = np.dtype([("symbol", "<u4"), ("pos", "<u4"), ("batch", "<u4"), ("lcp", "<i2"), ("post", "<i2")])


def spill_file():
    """An unlinked file in the first of the executor's spill folders; it goes with the process, however that ends."""
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    fd, path = tempfile.mkstemp(prefix="millrace-", dir=folder if folder and os.path.isdir(folder) else None)
    os.unlink(path)
    return os.fdopen(fd, "w+b", buffering=0)


class Store:
    """Arrays of a sort: in memory while the budget lasts, mapped from files beyond it."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.left = memory, memory // 2
        self.block = max(64, min(BLOCK, memory // 400))

    def array(self, n: int, dtype) -> np.ndarray:
        size = n * np.dtype(dtype).itemsize
        if size <= self.left or not n:
            self.left -= size
            return np.zeros(n, dtype)
        with spill_file() as f:
            f.truncate(size)
            return np.asarray(np.memmap(f, dtype, "r+", shape=(n,)))

    def give_back(self, *arrays: np.ndarray) -> None:
        """Their memory may be used again; the caller keeps no reference."""
        for x in arrays:
            if x.flags.owndata:
                self.left += x.nbytes


class Queue:
    """Tuples by range of symbols, and inside a range by arrival; `last` has the last symbol of each range."""

    def __init__(self, dtype, memory: int, last: np.ndarray):
        self.dtype, self.memory, self.last = dtype, memory, last
        self.ready: list[list[np.ndarray]] = [[] for _ in last]
        self.disk: list[array | None] = [None] * len(last)  # place and number of tuples of each part on disk
        self.held, self.file, self.size, self.spilled = 0, None, 0, 0

    def push(self, tuples: np.ndarray, symbol: np.ndarray) -> None:
        """Tuples sorted by symbol."""
        n = len(tuples)
        if not n:
            return
        a, b = (int(x) for x in np.searchsorted(self.last, (symbol[0], symbol[-1])))
        self.held += tuples.nbytes + min(b - a + 1, n) * PART
        if a == b:
            self.ready[a].append(tuples)
        elif b - a < n:
            at = 0
            for r, end in enumerate(np.searchsorted(symbol, self.last[a : b + 1], "right").tolist(), a):
                if end > at:
                    self.ready[r].append(tuples[at:end])
                    at = end
        else:
            where = np.searchsorted(self.last, symbol)
            cuts = np.flatnonzero(where[1:] != where[:-1]) + 1
            for at, end in zip([0, *cuts.tolist()], [*cuts.tolist(), n], strict=True):
                self.ready[where[at]].append(tuples[at:end])
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = spill_file()
        self.file.seek(self.size * self.dtype.itemsize)
        every = [x for parts in self.ready for x in parts]
        self.file.write(np.concatenate(every).data)
        for r, parts in enumerate(self.ready):
            if parts:
                n = sum(map(len, parts))
                if self.disk[r] is None:
                    self.disk[r] = array("Q")
                self.disk[r].extend((self.size, n))
                self.size += n
                parts.clear()
        self.spilled += self.held
        self.held = 0

    def pull(self, r: int, block: int) -> Iterator[np.ndarray]:
        """What waits in a range, in blocks, with what is pushed there meanwhile."""
        at = 0
        while True:
            disk = self.disk[r]
            if disk is not None and at < len(disk):
                place, n = disk[at], disk[at + 1]
                k = min(n, block)
                yield np.frombuffer(os.pread(self.file.fileno(), k * self.dtype.itemsize, place * self.dtype.itemsize), self.dtype)
                if k < n:
                    disk[at], disk[at + 1] = place + k, n - k
                else:
                    at += 2
                continue
            parts, n = self.ready[r], 0
            while n < len(parts) and (n == 0 or sum(map(len, parts[:n])) < block):
                n += 1 if n < 64 else len(parts) - n
            if not n:
                break
            got = parts[0] if n == 1 else np.concatenate(parts[:n])
            del parts[:n]
            self.held -= got.nbytes + n * PART
            for lo in range(0, len(got), block):
                yield got[lo : lo + block]
        self.disk[r] = None

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


class Least:
    """Range minima of an array by a table of powers of two."""

    def __init__(self, x: np.ndarray):
        rows, k = [x], 1
        while 2 * k <= len(x):
            row = rows[-1].copy()
            np.minimum(rows[-1][:-k], rows[-1][k:], out=row[:-k])
            rows.append(row)
            k *= 2
        self.n, self.table = len(x), np.concatenate(rows)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least of x[a..b], both included, a <= b."""
        k = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        base = k.astype(np.int64) * self.n
        return np.minimum(self.table[base + a], self.table[base + b - (1 << k.astype(np.int64)) + 1])


class Level:
    """A string that ends in its only 0, its types, its S* suffixes and its ranges of symbols."""

    def __init__(self, t: np.ndarray, n_symbols: int, depth: int, store: Store):
        self.t, self.n, self.k, self.depth, self.store, self.block = t, len(t), n_symbols, depth, store, store.block
        self.up = store.array(self.n, np.uint8)  # 1 where the suffix is smaller than the next one
        self._types()
        self.stars = store.array(self.n // 2 + 1, np.uint32)
        self.n_stars = 0
        counts = store.array(n_symbols, np.int64)
        for lo in range(0, self.n, self.block):
            hi = min(self.n, lo + self.block)
            rise = self.up[lo:hi] > np.append(self.up[lo - 1] if lo else 1, self.up[lo : hi - 1])
            found = np.flatnonzero(rise) + lo
            self.stars[self.n_stars : self.n_stars + len(found)] = found
            self.n_stars += len(found)
            symbol, n = np.unique(t[lo:hi], return_counts=True)
            counts[symbol] += n
        self._ranges(counts)
        store.give_back(counts)

    def _types(self) -> None:
        self.up[self.n - 1] = kind = 1
        for hi in range(self.n - 1, 0, -self.block):
            lo = max(0, hi - self.block)
            x, y = self.t[lo:hi], self.t[lo + 1 : hi + 1]
            ahead = np.where(x != y, np.arange(hi - lo), hi - lo)
            ahead = np.minimum.accumulate(ahead[::-1])[::-1]
            self.up[lo:hi] = np.append(x < y, kind)[ahead]
            kind = int(self.up[lo])

    def _ranges(self, counts: np.ndarray) -> None:
        """Ranges of symbols with about a block of suffixes, or one symbol, if it has more than a block or the alphabet is small."""
        first, total, before = [], 0, True
        for lo in range(0, self.k, self.block):
            n = counts[lo : lo + self.block]
            ends = total + np.cumsum(n)
            part = np.append(total, ends[:-1]) // self.block
            heavy = (n > self.block) | (self.k <= SMALL)
            fresh = heavy | np.append(before, heavy[:-1])
            fresh[1:] |= part[1:] != part[:-1]
            fresh[0] |= lo > 0
            first.append(np.flatnonzero(fresh) + lo)
            total, before = int(ends[-1]), bool(heavy[-1])
        self.first = np.concatenate(first)
        self.last = np.append(self.first[1:], self.k) - 1
        n_falls, n_rises = np.zeros(len(self.first), np.int64), np.zeros(len(self.first), np.int64)
        for lo in range(0, self.n, self.block):
            symbol = self.t[lo : lo + self.block][self.up[lo : lo + self.block] == 0]
            n_falls += np.bincount(self.range_of(symbol), minlength=len(self.first))
        for lo in range(0, self.n_stars, self.block):
            n_rises += np.bincount(self.range_of(self.t[self.stars[lo : min(lo + self.block, self.n_stars)]]), minlength=len(self.first))
        self.n_falls, self.n_rises = n_falls, n_rises

    def range_of(self, symbol: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, symbol, "right") - 1

    def is_star(self, pos: np.ndarray) -> np.ndarray:
        return (pos > 0) & (self.up[pos] == 1) & (self.up[np.maximum(pos, 1) - 1] == 0)

    def run_length(self, pos: np.ndarray) -> np.ndarray:
        """How often the first symbol of a suffix repeats, up to depth."""
        return self.matching(pos, pos + 1, np.full(len(pos), self.depth - 1)) + 1

    def matching(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many symbols agree from two different places on; the end agrees with nothing."""
        out = np.zeros(len(x), np.int64)
        live = np.flatnonzero(most > 0)
        x, y, k = x[live].astype(np.int64), y[live].astype(np.int64), 0
        most = most[live]
        while len(live):
            same = (y < self.n) & (x < self.n)
            same[same] = self.t[x[same]] == self.t[y[same]]
            live, x, y, most, k = live[same], x[same] + 1, y[same] + 1, most[same], k + 1
            out[live] = k
            going = most > k
            live, x, y, most = live[going], x[going], y[going], most[going]
        return out


class Pass:
    """One scan of a level: hands suffixes on to the falling ones on their left, or, descending, to the rising ones.

    `seeds(range)` yields blocks of (positions, prefixes) of the suffixes that
    come after the induced ones of the same symbol; `sink` gets blocks of positions,
    prefixes with the suffix before, and whether they are seeds.  Without prefixes
    only the order counts.
    """

    def __init__(self, level: Level, down: bool, prefixes: bool, sink: Callable):
        self.level, self.down, self.prefixes, self.sink = level, down, prefixes, sink
        self.want, self.block = int(down), level.block
        self.dtype = _FULL if prefixes else _BARE
        last = level.k - 1 - level.first[::-1] if down else level.last
        self.queue = Queue(self.dtype, level.store.memory // 4, last)
        self.least, self.n_batches = np.zeros(1024, np.int16), 0  # of the prefixes of each block that was scanned

    def key(self, symbol: np.ndarray) -> np.ndarray:
        symbol = symbol.astype(np.int64)
        return self.level.k - 1 - symbol if self.down else symbol

    def run(self, seeds: Callable) -> None:
        n = len(self.level.first)
        for q, last in enumerate(self.queue.last.tolist()):
            one = last == (int(self.queue.last[q - 1]) if q else -1) + 1
            (self._stream if one else self._together)(q, last, seeds(n - 1 - q if self.down else q))
        self.queue.close()

    # ---- prefixes between tuples that arrived in different blocks

    def _between(self, batch0, post0, batch1, pre1) -> np.ndarray:
        """Least prefix from a tuple's parent, after which `post0` was the least of its block, to that of a later block, up to which it was pre1."""
        out = np.minimum(post0, pre1)
        far = np.flatnonzero(batch1 > batch0 + 1)
        if len(far):
            a, b = batch0[far] + 1, batch1[far] - 1
            at = int(a.min())
            out[far] = np.minimum(out[far], Least(self.least[at : int(b.max()) + 1])(a - at, b - at))
        return out

    def _resolve(self, got: np.ndarray, before: np.void | None) -> np.ndarray:
        """Prefix of each tuple with the one before it; 0 for the first of a symbol."""
        out = np.zeros(len(got), np.int16)
        if before is not None:
            got = np.concatenate([np.array([before], self.dtype), got])
            out = np.zeros(len(got), np.int16)
        a, b = got[:-1], got[1:]
        batch0, batch1 = a["batch"].astype(np.int64), b["batch"].astype(np.int64)
        value = b["lcp"].copy()
        apart = np.flatnonzero(batch0 != batch1)
        value[apart] = self._between(batch0[apart], a["post"][apart], batch1[apart], value[apart])
        out[1:] = np.where(a["symbol"] == b["symbol"], np.minimum(value + 1, self.level.depth), 0)
        return out if before is None else out[1:]

    # ---- scanning

    def scan(self, pos: np.ndarray, lcp: np.ndarray, least: int) -> None:
        """Hand on to the left what has the symbol `least` or a larger one; the others were handled."""
        level = self.level
        at = np.flatnonzero(pos > 0)
        left = pos[at].astype(np.int64) - 1
        ok = level.up[left] == self.want
        at, left = at[ok], left[ok]
        key = self.key(level.t[left])
        ok = key >= least
        if not ok.all():
            at, left, key = at[ok], left[ok], key[ok]
        sort = (key << 32 | np.arange(len(key))).astype(np.uint64)
        sort.sort()
        index = (sort & np.uint64(0xFFFFFFFF)).astype(np.int64)
        out = np.empty(len(at), self.dtype)
        key = (sort >> np.uint64(32)).astype(np.int64)
        out["symbol"], out["pos"] = key, left[index]
        if self.prefixes:
            at = at[index]
            if len(at):
                value = np.minimum.accumulate(lcp)[at]
                twin = np.flatnonzero(key[1:] == key[:-1])
                value[twin + 1] = Least(lcp)(at[twin] + 1, at[twin + 1])
                out["lcp"], out["batch"] = value, self.n_batches
                out["post"] = np.append(np.minimum.accumulate(lcp[::-1])[::-1], level.depth)[at + 1]
            if self.n_batches == len(self.least):
                self.least = np.concatenate([self.least, np.zeros_like(self.least)])
            self.least[self.n_batches] = lcp.min(initial=level.depth)
            self.n_batches += 1
        self.queue.push(out, key)

    def _stream(self, q: int, last: int, seeds: Iterator) -> None:
        """A range of one symbol, block by block."""
        end, before = None, None
        for got in self.queue.pull(q, self.block):
            lcp = self._resolve(got, before) if self.prefixes else np.zeros(len(got), np.int16)
            pos = got["pos"]
            self.sink(pos, lcp, np.zeros(len(pos), bool))
            self.scan(pos, lcp, last)
            before, end = got[-1], int(pos[-1])
        for pos, lcp in seeds:
            lcp = lcp.copy()
            if end is None:
                lcp[0] = 0
            elif before is not None and self.prefixes:
                # an induced suffix and a seed of one symbol share the shorter of their runs
                lcp[0] = self.level.run_length(np.array([end, pos[0]])).min()
            before, end = None, int(pos[-1])
            self.sink(pos, lcp, np.ones(len(pos), bool))
            self.scan(pos, lcp, last)

    def _together(self, q: int, hi: int, seeds: Iterator) -> None:
        """A range of several symbols at once, with what they induce among themselves."""
        level, lo = self.level, int(self.queue.last[q - 1]) + 1 if q else 0
        got = list(self.queue.pull(q, self.block))
        got = np.concatenate(got) if got else np.zeros(0, self.dtype)
        got = got[np.argsort(got["symbol"], kind="stable")]
        given = [(p, x) for p, x in seeds]
        seed_pos = np.concatenate([p for p, _ in given]).astype(np.int64) if given else np.zeros(0, np.int64)
        pos = np.concatenate([got["pos"].astype(np.int64), seed_pos])
        if not len(pos):
            return
        n_got = len(got)
        symbol = np.concatenate([got["symbol"].astype(np.int64), self.key(level.t[seed_pos])])
        # by symbol: what waited, what is induced here in the order of its parents, seeds
        kind = np.repeat([0, 2], [n_got, len(seed_pos)])
        parts, fresh, total = [(pos, symbol, kind, np.arange(len(pos)))], np.arange(len(pos)), len(pos)
        while len(fresh):
            left = parts[-1][0] - 1
            ok = left >= 0
            ok[ok] = level.up[left[ok]] == self.want
            fresh, left = fresh[ok], left[ok]
            key = self.key(level.t[left])
            ok = key <= hi
            if not ok.any():
                break
            parts.append((left[ok], key[ok], np.ones(int(ok.sum()), np.int64), fresh[ok]))
            fresh = np.arange(total, total + len(parts[-1][0]))
            total += len(fresh)
        pos, symbol, kind, parent = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, levels = self._order(symbol, kind, parent)
        lcp = np.zeros(len(pos), np.int16)
        if self.prefixes:
            known = np.concatenate([self._resolve(got, None), *[x for _, x in given]])
            lcp = self._prefixes(pos, symbol, kind, order, levels, known)
        self.sink(pos[order], lcp, kind[order] == 2)
        self.scan(pos[order], lcp, hi + 1)

    @staticmethod
    def _order(symbol, kind, parent) -> tuple[np.ndarray, list]:
        """Suffixes of a range in order, and by doubling the rank of their first symbols with the ancestor beyond those.

        What waited and seeds have ranks of their own; what they induced here is told apart by the chain of its ancestors.
        """
        n = len(symbol)
        index = np.arange(n)
        code = symbol * 4 + kind
        order = np.argsort(code, kind="stable")
        fresh = (code[order] != np.append(-1, code[order[:-1]])) | (kind[order] != 1)
        levels, up = [], parent
        while True:
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh) - 1
            if fresh.all():
                return order, levels
            levels.append((rank, up))
            pair = rank << 21 | rank[up]  # a range has two blocks of suffixes at most
            sort = (pair << 21 | index).astype(np.uint64)
            sort.sort()
            order = (sort & np.uint64((1 << 21) - 1)).astype(np.int64)
            fresh = np.append(True, pair[order[1:]] != pair[order[:-1]])
            up = up[up]

    def _prefixes(self, pos, symbol, kind, order, levels, known) -> np.ndarray:
        """Prefix of each suffix of a range with the one before it; known: of those not induced here, in their own order."""
        n, depth = len(known), self.level.depth
        out = np.zeros(len(order), np.int64)
        at = np.flatnonzero(symbol[order[1:]] == symbol[order[:-1]]) + 1
        x, y = order[at - 1], order[at]
        size = np.zeros(len(at), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            rank, up = levels[k]
            same = np.flatnonzero(rank[x] == rank[y])
            size[same] += 1 << k
            x[same], y[same] = up[x[same]], up[y[same]]
        # now two that differ in their first symbol, or in how they came here
        alike = symbol[x] == symbol[y]
        own = np.flatnonzero(alike & (kind[x] == kind[y]))
        if len(own):
            size[own] += Least(known)(x[own] + 1, y[own])
        late = np.flatnonzero(alike & (kind[x] == 0) & (kind[y] == 1))
        size[late] += 1  # their parents are of different ranges
        seam = np.flatnonzero(alike & (kind[x] != 2) & (kind[y] == 2))
        if len(seam):
            size[seam] += np.minimum(self.level.run_length(pos[x[seam]]), self.level.run_length(pos[y[seam]]))
        out[at] = np.minimum(size, depth)
        return out.astype(np.int16)


class Slices:
    """Seeds from arrays in scan order; n: how many each range has. Reversed arrays are read from the end."""

    def __init__(self, pos: np.ndarray, lcp: np.ndarray, n: np.ndarray, block: int, reverse: bool = False):
        self.pos, self.lcp, self.n, self.block, self.reverse = pos, lcp, n, block, reverse
        self.at = len(pos) if reverse else 0

    def __call__(self, r: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        left = int(self.n[r])
        while left:
            k = min(left, self.block)
            left -= k
            if self.reverse:
                self.at -= k
                after = self.lcp[self.at + 1 : self.at + k + 1]
                after = after if len(after) == k else np.append(after, np.int16(0))
                yield self.pos[self.at : self.at + k][::-1], after[::-1]
            else:
                self.at += k
                yield self.pos[self.at - k : self.at], self.lcp[self.at - k : self.at]


def induce(level: Level, rising: Callable, prefixes: bool, sink: Callable) -> None:
    """From the S* suffixes in order (`rising`) all suffixes, descending, to sink(positions, prefixes with the larger one before)."""
    n_low = int(level.n_falls.sum())
    low, low_lcp, at = level.store.array(n_low, np.uint32), level.store.array(n_low, np.int16), 0

    def keep(pos, lcp, seed):
        nonlocal at
        if seed.any():
            pos, lcp = pos[~seed], lcp[~seed]
        low[at : at + len(pos)], low_lcp[at : at + len(pos)] = pos, lcp
        at += len(pos)

    Pass(level, False, prefixes, keep).run(rising)
    Pass(level, True, prefixes, lambda pos, lcp, seed: sink(pos, lcp)).run(Slices(low, low_lcp, level.n_falls, level.block, reverse=True))
    sink(np.array([level.n - 1]), np.zeros(1, np.int16))  # the end, which nothing induces
    level.store.give_back(low, low_lcp)


def sorted_pieces(level: Level) -> np.ndarray:
    """The S* suffixes ordered by the pieces up to the next one."""
    waiting = Queue(_BARE, level.store.memory // 4, level.last)
    for lo in range(0, level.n_stars, level.block):
        pos = level.stars[lo : min(lo + level.block, level.n_stars)]
        out = np.empty(len(pos), _BARE)
        out["symbol"], out["pos"] = level.t[pos], pos
        out = out[np.argsort(out["symbol"], kind="stable")]
        waiting.push(out, np.ascontiguousarray(out["symbol"]))

    def unsorted(r: int):
        for x in waiting.pull(r, level.block):
            yield x["pos"], np.zeros(len(x), np.int16)

    out, at = level.store.array(level.n_stars, np.uint32), level.n_stars

    def keep(pos, lcp):
        nonlocal at
        pos = pos[level.is_star(pos.astype(np.int64))]
        at -= len(pos)
        out[at : at + len(pos)] = pos[::-1]

    induce(level, unsorted, False, keep)
    waiting.close()
    return out


def same_pieces(level: Level, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two S* suffixes agree up to the next S* suffix of both, or for the whole depth."""
    same, live, k = np.ones(len(a), bool), np.arange(len(a)), 0
    while len(live) and k <= level.depth:
        x, y = a[live] + k, b[live] + k
        equal = level.t[x] == level.t[y]
        if k:
            end = level.is_star(x)
            equal &= end == level.is_star(y)
        else:
            end = np.zeros(len(live), bool)
        same[live[~equal]] = False
        live, k = live[equal & ~end], k + 1
    return same


def star_order(level: Level) -> tuple[np.ndarray, np.ndarray]:
    """The S* suffixes in order of their first `depth` symbols, and the prefix of each with the one before."""
    store, block, m = level.store, level.block, level.n_stars
    pieces = sorted_pieces(level)
    names, kinds = store.array(level.n // 2 + 1, np.uint32), 0  # by half the position, as S* suffixes are never neighbours
    alike = store.array(m, np.uint8)
    for lo in range(0, m, block):
        hi = min(m, lo + block)
        b = pieces[lo:hi].astype(np.int64)
        a = np.append(pieces[lo - 1] if lo else 0, b[:-1]).astype(np.int64)
        same = same_pieces(level, a, b)
        if lo == 0:
            same[0] = True  # the first has the first name
        alike[lo:hi] = same
        name = kinds + np.cumsum(~same)
        names[b >> 1], kinds = name, int(name[-1])
    kinds += 1
    need = -(-level.depth // 2)  # names that cover the depth, as a piece has two symbols at least
    if kinds == m or need <= 1:
        order, prefix = store.array(m, np.uint32), store.array(m, np.int16)
        place = store.array(level.n // 2 + 1, np.uint32)
        for lo in range(0, m, block):
            hi = min(m, lo + block)
            place[level.stars[lo:hi] >> 1] = np.arange(lo, hi)
        for lo in range(0, m, block):
            hi = min(m, lo + block)
            order[lo:hi], prefix[lo:hi] = place[pieces[lo:hi] >> 1], alike[lo:hi]
        prefix[0] = 0
        store.give_back(place, pieces, alike, names)
    else:
        inner = store.array(m, np.uint32)
        for lo in range(0, m, block):
            hi = min(m, lo + block)
            inner[lo:hi] = names[level.stars[lo:hi] >> 1]
        store.give_back(pieces, alike, names)
        del pieces, alike, names
        order, prefix = collect(inner, kinds, need, store)
        store.give_back(inner)
    out, lcp = store.array(m, np.uint32), store.array(m, np.int16)
    for lo in range(0, m, block):
        hi = min(m, lo + block)
        b = order[lo:hi].astype(np.int64)
        a = np.append(order[lo - 1] if lo else b[0], b[:-1]).astype(np.int64)
        n = prefix[lo:hi].astype(np.int64)
        x, y = level.stars[a].astype(np.int64), level.stars[b].astype(np.int64)
        over_x, over_y = level.stars[np.minimum(a + n, m - 1)].astype(np.int64), level.stars[np.minimum(b + n, m - 1)].astype(np.int64)
        over = np.minimum(over_x - x, over_y - y)
        rest = np.where(over < level.depth, level.depth - over, 0)
        if lo == 0:
            rest[0] = over[0] = 0
        out[lo:hi] = y
        lcp[lo:hi] = np.minimum(over + level.matching(x + over, y + over, rest), level.depth)
    store.give_back(order, prefix)
    return out, lcp


def sort_into(t: np.ndarray, n_symbols: int, depth: int, store: Store, sink: Callable) -> None:
    """All suffixes in descending order of their first `depth` symbols, in blocks, to sink(positions, prefixes with the one before)."""
    if len(t) == 1:
        sink(np.zeros(1, np.int64), np.zeros(1, np.int16))
        return
    level = Level(t, n_symbols, depth, store)
    stars, lcp = star_order(level)
    induce(level, Slices(stars, lcp, level.n_rises, level.block), True, sink)
    store.give_back(stars, lcp, level.up, level.stars)


def collect(t: np.ndarray, n_symbols: int, depth: int, store: Store) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes ascending, prefix of each with the one before) as arrays of the store."""
    n = len(t)
    order, lcp, at = store.array(n, np.uint32), store.array(n + 1, np.int16), n

    def keep(pos, prefix):
        nonlocal at
        lcp[at - len(pos) + 1 : at + 1] = prefix[::-1]
        order[at - len(pos) : at] = pos[::-1]
        at -= len(pos)

    sort_into(t, n_symbols, depth, store, keep)
    lcp[0] = 0
    return order, lcp[:n]


def sort_suffixes(t: np.ndarray, n_symbols: int, depth: int, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order of their first `depth` symbols, common prefix of each with the one before, up to depth).

    The string must end in 0, which occurs nowhere else.
    """
    if len(t) == 0 or len(t) >= 1 << 32 or np.flatnonzero(t == 0).tolist() != [len(t) - 1]:
        raise ValueError("the string must end in its only 0")
    return collect(t, n_symbols, depth, Store(memory))
