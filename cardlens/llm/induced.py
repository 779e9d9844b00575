"""External induced sorting: the suffixes of a text in order, with the lengths of their common prefixes.

A suffix is of the smaller kind (S) if it is smaller than the one behind it, else of the larger kind (L). The
leftmost S suffixes after an L (the anchors) are sorted first: their stretches up to the next anchor are named
by rank, and if names repeat, the text of the names is sorted by the same means. Everything else is induced.
One sweep goes up: whoever comes out of the priority queue puts the suffix in front of it back in, if that is
an L. One sweep goes down and does the same with S.

What waits is a tuple (symbol, position, common prefix with the tuple before it under that symbol). The queue
keeps tuples by ranges of symbols, in the order in which they came, which is that of the suffixes behind them; what
exceeds the memory given goes to a file. The common prefix of two tuples is one symbol more than the
least common prefix among the suffixes between those that induced them; the sweep keeps those minima in a stack. Where
two neighbours were not induced side by side (the first of a symbol, the first of the other kind), the text is
compared. Tuples, names, orders and prefixes live in memory up to a bound and in files beyond it; symbols are mapped.
"""

from __future__ import annotations

import os
import tempfile
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np

_MOST = np.iinfo(np.uint16).max
# Kinds of a tuple, in their order under one symbol: out of the queue, induced inside the range, seed.
_QUEUED, _INSIDE, _SEED = 0, 1, 2


class Scratch:
    """Where one sort keeps its data: ``memory`` bytes of queues, and files without a name in ``folder`` (they
    vanish with the task, however it ends). Arrays over an eighth of ``memory`` are mapped files."""

    def __init__(self, folder: str | None = None, memory: int = 64 << 20, block: int = 1 << 16):
        self.folder, self.memory, self.block = folder, memory, block
        self.held = self.spilled = 0

    def file(self):
        return tempfile.TemporaryFile(dir=self.folder)

    def array(self, n: int, kind: str) -> np.ndarray:
        if n * np.dtype(kind).itemsize <= self.memory // 8:
            return np.zeros(n, kind)
        with self.file() as file:
            return np.memmap(file, kind, "w+", shape=n)


class _Queues:
    """First in, first out for each range of symbols. ``bounds`` holds the first symbol of every range."""

    def __init__(self, scratch: Scratch, bounds: np.ndarray, kind: np.dtype):
        self._scratch, self._bounds, self._kind, self._file = scratch, bounds, kind, None
        self._pieces: list[deque] = [deque() for _ in bounds]
        self._size = 0

    def push(self, tuples: np.ndarray) -> None:
        """``tuples`` in ascending ranges."""
        cuts = np.append(np.searchsorted(tuples["symbol"], self._bounds), len(tuples))
        for r in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            self._pieces[r].append(tuples[cuts[r]:cuts[r + 1]].copy())
        self._scratch.held += tuples.nbytes
        self._size += tuples.nbytes
        if self._scratch.held > self._scratch.memory and self._size > self._scratch.memory // 4:
            self._spill()

    def _spill(self) -> None:
        self._file = self._file or self._scratch.file()
        end = self._file.seek(0, os.SEEK_END)
        for pieces in self._pieces:
            fresh = []
            while pieces and isinstance(pieces[-1], np.ndarray):
                fresh.append(pieces.pop())
            if fresh:
                data = np.concatenate(fresh[::-1])
                data.tofile(self._file)
                pieces.append((end, len(data)))
                end += data.nbytes
                self._scratch.held -= data.nbytes
                self._scratch.spilled += data.nbytes
                self._size -= data.nbytes
        self._file.flush()

    def pop(self, r: int, limit: int | None = None, last: bool = False) -> np.ndarray:
        """The first (``last``: the last) ``limit`` tuples of a range, or all, in the order they came."""
        pieces, found, need = self._pieces[r], [], limit
        while pieces and need != 0:
            piece = pieces.pop() if last else pieces.popleft()
            count = piece[1] if isinstance(piece, tuple) else len(piece)
            take = count if need is None else min(count, need)
            if take < count:
                head, tail = self._cut(piece, 0, count - take if last else take), self._cut(piece, count - take if last else take, count)
                (pieces.append if last else pieces.appendleft)(head if last else tail)
                piece = tail if last else head
            found.append(self._read(piece))
            need = None if need is None else need - take
        return np.concatenate(found[::-1] if last else found) if found else np.empty(0, self._kind)

    def _cut(self, piece, a: int, b: int):
        return (piece[0] + a * self._kind.itemsize, b - a) if isinstance(piece, tuple) else piece[a:b]

    def _read(self, piece) -> np.ndarray:
        if isinstance(piece, tuple):
            return np.frombuffer(os.pread(self._file.fileno(), piece[1] * self._kind.itemsize, piece[0]), self._kind)
        self._scratch.held -= piece.nbytes
        self._size -= piece.nbytes
        return piece

    def close(self) -> None:
        if self._file:
            self._file.close()
        self._scratch.held -= self._size
        self._size = 0


class _Text:
    """The symbols of one level. The last is 0 and occurs nowhere else. ``start``: where each symbol begins in
    the text that is sorted (None: this is that text); ``root`` is the level of that text."""

    def __init__(self, scratch: Scratch, symbols: np.ndarray, n: int, start: np.ndarray | None, root: _Text | None):
        self.scratch, self.symbols, self.n, self.start, self.root = scratch, symbols, n, start, root or self
        self.per = 8 // symbols.itemsize
        # ``symbols`` has eight bytes of zeros behind the text, so that eight bytes can be read from any symbol.
        self.words = np.ndarray(n, "<u8", symbols, 0, (symbols.itemsize,))
        top = int(max(symbols[a:a + (1 << 22)].max() for a in range(0, n, 1 << 22)))
        counts = np.zeros(top + 1, np.int64)
        for a in range(0, n, 1 << 22):
            part = np.bincount(symbols[a:min(n, a + (1 << 22))])
            counts[:len(part)] += part
        self.block = max(scratch.block, n >> 9)
        before = np.cumsum(counts) - counts
        large = counts > self.block
        first = np.append(True, np.diff(before // self.block) > 0) | large | np.append(False, large[:-1])
        self.bounds = np.flatnonzero(first)
        self.ends = np.append(self.bounds[1:], top + 1)
        at = "<u4" if n < 1 << 32 else "<i8"
        self.kind = np.dtype([("at", at), ("symbol", "<u4"), ("common", "<u4")], align=True)

    def anchors(self) -> np.ndarray:
        """Positions of the leftmost S suffixes, ascending; the last symbol is one."""
        out, filled = self.scratch.array(self.n // 2 + 1, "<i8"), self.n // 2 + 1
        smaller = True
        for lo in range((self.n - 1) // (1 << 22) * (1 << 22), -1, -(1 << 22)):
            hi = min(self.n, lo + (1 << 22))
            x = self.symbols[lo:hi]
            y = self.symbols[lo + 1:hi + 1]  # behind the last symbol stands a zero
            at = np.arange(hi - lo)
            decided = np.where(x != y, at, hi - lo)
            nearest = np.minimum.accumulate(decided[::-1])[::-1]
            is_s = np.append(x < y, smaller)[nearest]
            kinds = is_s if hi == self.n else np.append(is_s, smaller)
            found = np.flatnonzero(kinds[1:] & ~kinds[:-1]) + lo + 1
            out[filled - len(found):filled] = found
            filled -= len(found)
            smaller = bool(is_s[0])
        return out[filled:]

    def common(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Symbols of the whole text that the suffixes at ``a`` and ``b`` begin with alike, ``most`` at most."""
        if self.start is not None:
            a, b = self.start[a], self.start[b]
        root, a, b = self.root, a.astype(np.int64), b.astype(np.int64)
        found, live, done = np.full(len(a), most), np.arange(len(a)), 0
        while len(live) and done < most:
            differ = root.words[a[live] + done] ^ root.words[b[live] + done]
            ends = differ != 0
            low = differ[ends]
            low &= ~low + np.uint64(1)
            found[live[ends]] = done + (np.frexp(low.astype(float))[1] - 1) // (64 // root.per)
            live = live[~ends]
            done += root.per
        return np.minimum(found, most)

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the ``length`` symbols at ``a`` and ``b`` are alike."""
        alike, live, done, bits = np.ones(len(a), bool), np.arange(len(a)), 0, 64 // self.per
        while len(live):
            left = length[live] - done
            differ = self.words[a[live] + done] ^ self.words[b[live] + done]
            differ <<= (np.maximum(self.per - left, 0) * bits).astype(np.uint64)
            alike[live[differ != 0]] = False
            live = live[(differ == 0) & (left > self.per)]
            done += self.per
        return alike


class _Sweep:
    """One pass over the ranges of symbols, up (L is induced) or down (S is induced)."""

    def __init__(self, text: _Text, seeds: _Queues, up: bool, most: int | None):
        self._text, self._seeds, self._up, self._most = text, seeds, up, most
        self._turn = 1 if up else -1
        self._queue = _Queues(text.scratch, text.bounds, text.kind)
        self._rank = 0  # tuples that came out so far
        self._previous = -1  # the position of the last of them
        if most is not None:
            self._last = text.scratch.array(len(text.ends) and int(text.ends[-1]), "<i8")  # 1 + rank of the last to induce a symbol
            # Ranks at which the least common prefix from there on begins, and that prefix.
            self._minima = (np.empty(0, np.int64), np.empty(0, np.uint16))

    def run(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Tuples in order, the largest last (``up``) or first, with whether each is a seed, the symbol in
        front, and whether the suffix in front was induced."""
        text = self._text
        for r in range(len(text.bounds))[::self._turn]:
            lo, hi = int(text.bounds[r]), int(text.ends[r])
            if hi - lo > 1:
                queued, seeds = self._queue.pop(r), self._all_seeds(r)
                if len(queued) + len(seeds):
                    yield self._batch(queued, seeds, lo, hi)
                continue
            # One symbol: what it induces of itself comes behind what waits already.
            while len(queued := self._queue.pop(r, text.block)):
                yield self._batch(queued, queued[:0], 0, 0)
            for seeds in self._some_seeds(r):
                yield self._batch(seeds[:0], seeds, 0, 0)
        self._queue.close()
        self._seeds.close()

    def _some_seeds(self, r: int) -> Iterator[np.ndarray]:
        behind = 0  # seeds are read backwards on the way down; a common prefix then belongs to the one before
        while len(seeds := self._seeds.pop(r, self._text.block, last=not self._up)):
            if not self._up:
                seeds = seeds[::-1].copy()
                first = int(seeds["common"][-1])
                seeds["common"][1:] = seeds["common"][:-1].copy()
                seeds["common"][0], behind = behind, first
            yield seeds

    def _all_seeds(self, r: int) -> np.ndarray:
        found = list(self._some_seeds(r))
        return np.concatenate(found) if found else np.empty(0, self._text.kind)

    def _ahead(self, at: np.ndarray, symbol: np.ndarray, seed: np.ndarray | bool) -> tuple[np.ndarray, np.ndarray]:
        """The symbol in front of each suffix, and whether that suffix is induced."""
        ahead = self._text.symbols[np.maximum(at, 1) - 1].astype(np.int64)
        ahead = np.where(at > 0, ahead, symbol)
        further = ahead > symbol if self._up else ahead < symbol
        return ahead, (at > 0) & (further | ((ahead == symbol) & np.logical_not(seed)))

    def _batch(self, queued: np.ndarray, seeds: np.ndarray, lo: int, hi: int):
        """Put a range, or tuples of one symbol, in order; hand on what they induce. Inside the range ``lo`` to
        ``hi`` (none if equal) the induced join in at once."""
        known = np.concatenate([queued, seeds])
        at, symbol = known["at"].astype(np.int64), known["symbol"].astype(np.int64)
        kind = np.repeat(np.array([_QUEUED, _SEED]), [len(queued), len(seeds)])
        common = known["common"].astype(np.int64)
        ahead, induces = self._ahead(at, symbol, kind == _SEED)
        order = None
        if hi > lo:
            parts, size = [(at, symbol, kind, common, ahead, induces, np.full(len(at), -1))], len(at)
            start = 0
            while True:  # what the last part induces inside the range, until that is nothing
                a, _, _, _, f, g, _ = parts[-1]
                inner = np.flatnonzero(g & (f >= lo) & (f < hi))
                if not len(inner):
                    break
                new_at, new_symbol = a[inner] - 1, f[inner]
                new_ahead, new_induces = self._ahead(new_at, new_symbol, False)
                parts.append((new_at, new_symbol, np.full(len(inner), _INSIDE), np.zeros(len(inner), np.int64), new_ahead, new_induces, inner + start))
                start, size = size, size + len(inner)
            at, symbol, kind, common, ahead, induces, parent = map(np.concatenate, zip(*parts))
            order = self._order(symbol, kind, parent)
            at, symbol, kind, common, ahead, induces = (x[order] for x in (at, symbol, kind, common, ahead, induces))
        on = np.flatnonzero(induces if hi == lo else induces & ((ahead < lo) | (ahead >= hi)))
        if self._most is None:
            on = on[np.argsort(ahead[on], kind="stable")]
            given = 0
        else:
            common = self._completed(at, symbol, kind, common)
            on, given = self._carried(on, at, ahead, common.astype(np.uint16))
        out = np.empty(len(on), self._text.kind)
        out["at"], out["symbol"], out["common"] = at[on] - 1, ahead[on], given
        self._queue.push(out)
        tuples = np.empty(len(at), self._text.kind)
        tuples["at"], tuples["symbol"], tuples["common"] = at, symbol, common
        return tuples, kind == _SEED, ahead, induces

    def _order(self, symbol: np.ndarray, kind: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """By symbol, kind and then by turn; those induced inside have the turn of whoever induced them."""
        key = self._turn * symbol * 4 + kind
        order = np.argsort(key, kind="stable")
        rank = np.empty(len(key), np.int64)
        rank[order] = np.arange(len(key))
        inner = np.flatnonzero(kind == _INSIDE)
        if len(inner):
            # All of one symbol begin with the same rank; then the ranks of their parents part them, until nothing moves.
            by_key = inner[np.argsort(key[inner], kind="stable")]
            starts = np.flatnonzero(np.append(True, np.diff(key[by_key]) != 0))
            rank[by_key] = np.repeat(rank[by_key[starts]], np.diff(np.append(starts, len(by_key))))
            tied = by_key
            while len(tied):
                tied = tied[np.lexsort((rank[parent[tied]], rank[tied]))]
                group, turn = rank[tied], rank[parent[tied]]
                opens = np.append(True, np.diff(group) != 0)
                parts = opens | np.append(True, np.diff(turn) != 0)
                i = np.arange(len(tied))
                moved = group + np.maximum.accumulate(np.where(parts, i, 0)) - np.maximum.accumulate(np.where(opens, i, 0))
                rank[tied] = moved
                alone = parts & np.append(parts[1:], True)
                tied = tied[~alone]
            order[rank] = np.arange(len(key))
        return order

    def _completed(self, at: np.ndarray, symbol: np.ndarray, kind: np.ndarray, common: np.ndarray) -> np.ndarray:
        """Common prefixes with the one before; where none was carried along, the text is compared."""
        before = np.append(self._previous, at[:-1])
        loose = kind == _INSIDE
        loose[1:] |= (symbol[1:] != symbol[:-1]) | (kind[1:] != kind[:-1])
        loose[0] = loose[0] or self._previous < 0 or (self._last_symbol, self._last_kind) != (symbol[0], kind[0])
        loose = np.flatnonzero(loose)
        if self._previous < 0:
            common[0], loose = 0, loose[1:]
        common[loose] = self._text.common(before[loose], at[loose], self._most)
        self._previous, self._last_symbol, self._last_kind = int(at[-1]), int(symbol[-1]), int(kind[-1])
        return common

    def _carried(self, on: np.ndarray, at: np.ndarray, ahead: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of a batch that induce, by symbol, with the common prefixes of what they induce."""
        ranks, values = self._minima
        if len(on):
            on = on[np.argsort(ahead[on], kind="stable")]
            symbol = ahead[on]
            first = np.append(True, symbol[1:] != symbol[:-1])
            least = np.empty(len(on), np.int64)
            inner = np.flatnonzero(~first)
            least[inner] = _range_minima(common, on[inner - 1] + 1, on[inner])
            heads = np.flatnonzero(first)
            found = np.searchsorted(ranks, self._last[symbol[heads]] - 1, "right")  # the first rank behind
            old = np.append(values, _MOST)[found]
            least[heads] = np.minimum(old, np.minimum.accumulate(common)[on[heads]])
            tails = np.append(heads[1:], len(on)) - 1
            self._last[symbol[tails]] = self._rank + on[tails] + 1
            start, to = self._text.start, at[on]
            width = 1 if start is None else start[to] - start[to - 1]
            least = np.minimum(least + width, self._most)
        else:
            least = np.empty(0, np.int64)
        from_here = np.minimum.accumulate(common[::-1])[::-1]
        record = np.append(from_here[:-1] < from_here[1:], True)
        kept = values < from_here[0]
        self._minima = (
            np.append(ranks[kept], self._rank + np.flatnonzero(record)), np.append(values[kept], from_here[record]),
        )
        self._rank += len(common)
        return on, least


def _range_minima(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``min(values[a:b + 1])`` for each pair, from minima over powers of two."""
    if not len(a):
        return np.empty(0, values.dtype)
    width = np.frexp((b - a + 1).astype(float))[1] - 1
    table = [values]
    for k in range(int(width.max())):
        longer = table[-1].copy()
        np.minimum(longer[:-(1 << k)], longer[1 << k:], out=longer[:-(1 << k)])
        table.append(longer)
    table = np.stack(table)
    return np.minimum(table[width, a], table[width, b + 1 - (1 << width)])


def _seeds(text: _Text, positions: Iterable[tuple[np.ndarray, np.ndarray | int]]) -> _Queues:
    queues = _Queues(text.scratch, text.bounds, text.kind)
    for at, common in positions:
        seeds = np.empty(len(at), text.kind)
        seeds["at"], seeds["symbol"], seeds["common"] = at, text.symbols[at], common
        queues.push(seeds[np.argsort(seeds["symbol"], kind="stable")])
    return queues


def _both_sweeps(text: _Text, seeds: _Queues, most: int | None):
    """The batches of the way down, after a way up from the sorted (or only parted) anchors."""
    larger = _Queues(text.scratch, text.bounds, text.kind)
    for tuples, seed, _, _ in _Sweep(text, seeds, True, most).run():
        larger.push(tuples[~seed])
    yield from _Sweep(text, larger, False, most).run()


def _blocks(n: int, size: int = 1 << 20) -> Iterator[slice]:
    return (slice(a, min(n, a + size)) for a in range(0, n, size))


def _names(text: _Text, anchors: np.ndarray) -> tuple[np.ndarray, int]:
    """The rank of each anchor's stretch up to the next anchor, equal ones alike, and how many there are."""
    scratch, m = text.scratch, len(anchors)
    number = scratch.array(text.n // 2 + 1, "<i8")  # anchors are never neighbours
    for part in _blocks(m):
        number[anchors[part] >> 1] = np.arange(part.start, part.stop)
    names = scratch.array(m + 2, "<u4")  # eight bytes of zeros behind the last
    later, later_size, name = None, 0, 0
    seeds = _seeds(text, ((anchors[part], 0) for part in _blocks(m)))
    for tuples, seed, ahead, _ in _both_sweeps(text, seeds, None):
        at = tuples["at"][~seed & (ahead > tuples["symbol"])].astype(np.int64)
        if not len(at):
            continue
        j = number[at >> 1]
        size = anchors[j + 1] - anchors[j] + 1
        before = np.append(at[0] if later is None else later, at[:-1])
        alike = np.append(later_size, size[:-1]) == size
        alike[alike] = text.same(before[alike], at[alike], size[alike])
        steps = np.cumsum(~alike)
        names[j] = name + steps  # from the largest on
        later, later_size, name = int(at[-1]), int(size[-1]), name + int(steps[-1])
    for part in _blocks(m - 1):
        names[part] = name + 1 - names[part]
    return names, name + 1


def _sorted(text: _Text, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes from the largest to the smallest, with the common prefix of each and the one before it."""
    scratch, anchors = text.scratch, text.anchors()
    m = len(anchors)
    order, common = scratch.array(m, "<i8"), scratch.array(m, "<u2")
    if m > 1:
        names, different = _names(text, anchors)
        if different == m:
            for part in _blocks(m):
                order[names[part]] = np.arange(part.start, part.stop)
            for part in _blocks(m):
                here, before = anchors[order[part]], anchors[order[max(part.start - 1, 0):part.stop - 1]]
                common[max(part.start, 1):part.stop] = text.common(before, here[-len(before):] if len(before) else here[:0], most)
        else:
            start = anchors
            if text.start is not None:
                start = scratch.array(m, "<i8")
                for part in _blocks(m):
                    start[part] = text.start[anchors[part]]
            end = m
            for at, shared in _sorted(_Text(scratch, names, m, start, text.root), most):
                order[end - len(at):end] = at[::-1]
                # What a suffix shares with the larger one before it belongs to the larger one here.
                stop = min(m, end + 1)
                common[end - len(at) + 1:stop] = shared[::-1][:stop - (end - len(at) + 1)]
                end -= len(at)
        del names
    seeds = _seeds(text, ((anchors[order[part]], common[part]) for part in _blocks(m)))
    previous = None
    for tuples, _, _, _ in _both_sweeps(text, seeds, most):
        previous = tuples["at"][-1:].astype(np.int64)
        yield tuples["at"].astype(np.int64), tuples["common"].astype(np.int64)
    yield np.array([text.n - 1]), np.zeros(1 if previous is not None else 1, np.int64)


def sorted_suffixes(symbols: np.ndarray, scratch: Scratch, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The suffixes of ``symbols`` from the largest to the smallest in batches: positions, and how many symbols
    each has in common with the suffix before it, ``most`` at most (below 65535).

    ``symbols`` is an array of unsigned bytes or 16-bit numbers, mapped or not, whose last entry is 0 and which
    holds no other 0. It is read, never changed. An array of one symbol has one suffix.
    """
    if not 0 < most < _MOST:
        raise ValueError(f"most must lie between 0 and {_MOST}, not {most}")
    n, width = len(symbols), symbols.itemsize
    padded = scratch.array(n + 8 // width, f"<u{width}")
    for part in _blocks(n):
        padded[part] = symbols[part]
    return _sorted(_Text(scratch, padded, n, None, None), most)
