"""Byte-level BPE: texts to token ids by a table of merge ranks, and back.

The text is cut by a pattern, and each match is merged on its own. Within a match a segment tree over byte
positions holds, at every node, the leftmost of the lowest pair ranks below it. Its root names the next
merge; a merge changes three leaves, each an update of logarithmic cost. Matches of any length are thus
encoded in ``n log n``, and the result is that of taking the lowest, leftmost pair again and again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from cardlens.llm.common import Remembered, as_strings, joined, kept, listed, packed_words, slices, split

_NONE = 1 << 62  # no pair, or a pair that has no rank
_POSITION_BITS = 40


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file at ``path``: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one match."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    width = 1 << (n - 1).bit_length()  # leaves: the pair that starts at each byte; the last has none
    tree = [_NONE] * (2 * width)
    for i in range(n - 1):
        rank = ranks.get(piece[i:i + 2])
        if rank is not None:
            tree[width + i] = rank << _POSITION_BITS | i  # the smallest key is the lowest rank, leftmost
    for i in range(width - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left < right else right

    def update(leaf: int, key: int) -> None:
        i = leaf + width
        tree[i] = key
        i >>= 1
        while i:
            left, right = tree[2 * i], tree[2 * i + 1]
            key = left if left < right else right
            if tree[i] == key:
                return
            tree[i] = key
            i >>= 1

    def pair(start: int, end: int) -> int:
        rank = ranks.get(piece[start:end])
        return _NONE if rank is None else rank << _POSITION_BITS | start

    after = list(range(1, n + 1))  # where the token that starts here ends, and the next one starts
    before = list(range(-1, n - 1))
    mask = (1 << _POSITION_BITS) - 1
    while tree[1] < _NONE:
        at = tree[1] & mask
        gone = after[at]
        end = after[gone]
        after[at] = end
        update(gone, _NONE)
        if end < n:
            before[end] = at
            update(at, pair(at, after[end]))
        else:
            update(at, _NONE)
        if at:
            update(before[at], pair(before[at], end))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:after[at]]])
        at = after[at]
    return ids


class Merges:
    """Merges many matches side by side: every step of ``merge`` is one step on arrays, a row a match.

    Tokens are held by their ids; ``keys`` lists, in order, each pair of ids that joins to a token.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self._byte = np.array([ranks[bytes([b])] for b in range(256)])
        self._base = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left * self._base + right] = rank
        self._keys = np.array(sorted(pairs) or [-1], np.int64)
        self._ranks = np.array([pairs[k] for k in sorted(pairs)] or [0], np.int64)

    def _pair(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The keys of the pairs that start at byte ``at``: rank, then position."""
        wanted = left * self._base + right
        found = np.minimum(np.searchsorted(self._keys, wanted), len(self._keys) - 1)
        return np.where(self._keys[found] == wanted, self._ranks[found] << 8 | at, _NONE)

    def merge(self, pieces: list[bytes], width: int) -> list[bytes]:
        """The packed ids of matches of at most ``width`` bytes, a power of two up to 128."""
        size = np.array([len(p) for p in pieces])
        packed = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        token = self._byte[packed]
        places = np.arange(width)
        alive = places < size[:, None]
        tree = np.full((len(pieces), 2 * width), _NONE, np.int64)
        paired = self._pair(token[:, :-1], token[:, 1:], places[:-1])
        tree[:, width:2 * width - 1] = np.where(alive[:, 1:], paired, _NONE)
        level = width // 2
        while level:
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
            level //= 2
        after = np.tile(np.arange(1, width + 2), (len(pieces), 1))
        before = np.tile(np.arange(-1, width), (len(pieces), 1))
        row = np.flatnonzero(tree[:, 1] < _NONE)
        while len(row):
            best = tree[row, 1]
            at = best & 255
            gone = after[row, at]
            end = after[row, gone]
            token[row, at] = joined = best >> 8
            after[row, at] = end
            before[row, end] = at
            alive[row, gone] = False
            tree[row, width + gone] = _NONE
            right = self._pair(joined, token[row, np.minimum(end, width - 1)], at)
            tree[row, width + at] = np.where(end < size[row], right, _NONE)
            first = before[row, at]
            has = np.flatnonzero(first >= 0)
            behind = first[has]
            tree[row[has], width + behind] = self._pair(token[row[has], behind], joined[has], behind)
            for rows, node in ((row, width + gone), (row, width + at), (row[has], width + behind)):
                node = node >> 1
                while node[0] if len(node) else 0:  # all are leaves, so all reach the root together
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                    node = node >> 1
            row = row[tree[row, 1] < _NONE]
        whole = token[alive].astype("<u4").tobytes()
        ends = (np.cumsum(alive.sum(axis=1)) * 4).tolist()
        return [whole[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """Encodes texts to packed little-endian unsigned 32-bit ids; remembers matches and words, within a bound.

    Text between two spaces is a unit of its own wherever both its ends are not white space: no
    alternative of the pattern reaches across. Such units are looked up whole. A text that has any other
    unit is cut by the pattern from its start to its end. ``pattern`` must have that property.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, limit: int = 40_000, words: int = 120_000):
        self.ranks = ranks
        # The white space of Unicode; the engine's own class also takes four control characters for it.
        self._find = regex.compile(
            pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
            .replace(r"\S", r"\P{White_Space}")
        ).findall
        self._space = regex.compile(r"\p{White_Space}").match
        self._merges = Merges(ranks)
        self.tokens = Tokens(ranks)
        self._matches = Remembered(limit)
        self._words = Remembered(words)

    def _learn(self, matches: dict[str, str], known: dict[str, bytes]) -> None:
        """Encode matches, those of like length together; ``known`` gets the ids under the name of each."""
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for name, match in matches.items():
            piece = match.encode()
            rank = self.ranks.get(piece)
            if rank is not None:
                known[name] = rank.to_bytes(4, "little")
            elif len(piece) > 128:
                known[name] = np.array(merge(piece, self.ranks), "<u4").tobytes()
            else:
                by_width.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append((name, piece))
        for width, group in by_width.items():
            step = (1 << 19) // width
            for i in range(0, len(group), step):
                part = group[i:i + step]
                known.update(zip([n for n, _ in part], self._merges.merge([p for _, p in part], width)))

    def _cut(self, word: str) -> list[str]:
        if word[-1] in ",.!?;:" and word[:-1].isalpha():
            return [f" {word[:-1]}", word[-1]]
        return self._find(f" {word}")

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text, packed. A unit is looked up once, however often the texts hold it."""
        words, matches = self._words, self._matches
        texts = as_strings(texts)
        ends, numbers, units = split(texts)
        units = listed(units)
        later = np.ones(len(numbers), bool)
        later[ends[:-1]] = False  # the first unit of a text has no space in front
        later_units = np.zeros(len(units), bool)
        later_units[numbers[later]] = True
        words.age()
        matches.age()
        new = words.unknown({u for u, it in zip(units, later_units.tolist()) if it})
        unsafe = {w for w in new if not w or self._space(w[0]) or self._space(w[-1])}
        new -= unsafe
        alone = {w: f" {w}" for w in new if w.isalpha()}
        cuts = {w: self._cut(w) for w in new - alone.keys()}

        # Texts with an unsafe unit are cut as a whole; of the others the first unit is.
        odd_unit = np.fromiter((u in unsafe for u in units), bool, len(units))
        odd = np.append(0, np.cumsum(odd_unit[numbers] & later))
        first = [units[n] for n in numbers[ends[:-1]].tolist()]
        several = (ends[1:] - ends[:-1] > 1).tolist()
        unsafe_text = (odd[ends[1:]] > odd[ends[:-1]]).tolist()
        whole = {
            i: self._find(texts[i].as_py()) for i, (u, more, bad) in enumerate(zip(first, several, unsafe_text))
            if more and (bad or not u or self._space(u[-1]))
        }
        starts = [None if i in whole else self._find(u) for i, u in enumerate(first)]
        wanted = matches.unknown(set().union(*cuts.values(), *whole.values(), *filter(None, starts)))
        self._learn({m: m for m in wanted}, matches)
        self._learn(alone, words)
        words.update((w, b"".join(map(matches.__getitem__, cut))) for w, cut in cuts.items())

        none = [it and u not in unsafe for u, it in zip(units, later_units.tolist())]
        packed = [words[u] if it else b"" for u, it in zip(units, none)]
        begins = np.insert(ends[1:] - np.cumsum(np.ones(len(first), np.int64)), 0, 0)
        rest = packed_words(packed, numbers[later], begins, 4)
        get = matches.__getitem__
        return [
            b"".join(map(get, whole[i])) if i in whole else b"".join(map(get, starts[i])) + rest[i]
            for i in range(len(first))
        ]


def _encoder(ranks: dict[bytes, int], pattern: str) -> Encoder:
    key = "byte bpe", pattern, len(ranks), hash(frozenset(ranks.items()))
    return kept(key, lambda: Encoder(ranks, pattern))


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``: the ids of the whole text as packed little-endian unsigned 32-bit integers.

    A null text is empty and has no ids. Every row of ``df`` comes back once with its columns; a column
    that is already called ``out`` is an error. ``ranks`` holds every single byte, so any text can be
    encoded; the table, of the size of a vocabulary, goes to the workers once.
    """
    if out in df.columns:
        raise ValueError(f"there is a column {out!r} already")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the ranks lack a byte")
    table = df.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(table.value, pattern)
        for batch in slices(batches, text, 4 << 20):
            packed = encoder.encode(pa.compute.fill_null(batch[text], ""))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(packed, pa.binary())], [*batch.schema.names, out])

    return df.mapInArrow(run, schema)


class Tokens:
    """The bytes of every token in one array, to decode many ids at once."""

    def __init__(self, ranks: dict[bytes, int]):
        by_id = {rank: token for token, rank in ranks.items()}
        listed = [by_id.get(i) for i in range(max(by_id, default=-1) + 1)]
        self._missing = np.array([t is None for t in listed] or [True])
        self._sizes = np.array([len(t or b"") for t in listed] or [0], np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._bytes = np.frombuffer(b"".join([t or b"" for t in listed]), np.uint8)

    def decode(self, packed: list[bytes | None]) -> list[bytes]:
        """The bytes that each list of packed ids stands for. An id without a token is an error."""
        packed = [p or b"" for p in packed]
        ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
        lost = ids >= len(self._missing)
        if lost.any() or self._missing[ids].any():
            raise KeyError(int(ids[lost][0] if lost.any() else ids[self._missing[ids]][0]))
        sizes = self._sizes[ids]
        whole = joined(self._bytes, self._starts[ids], sizes).tobytes()
        bounds = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum([len(p) // 4 for p in packed])).astype(np.int64)].tolist()
        return [whole[a:b] for a, b in zip(bounds, bounds[1:])]


def encode_and_decode(
    df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``text`` is replaced by ``ids``, packed, and ``decoded``, the bytes
    that these ids stand for. One worker a task does both, and the text is not sent back.

    Every row comes back once with its other columns, rows that repeat a document included; a column that is already called
    ``ids`` or ``decoded`` is an error. A null text has no ids and no bytes, a text of any length is encoded whole, and an
    empty table stays empty.
    """
    others = [f for f in df.schema.fields if f.name != text]
    if {ids, decoded} & {f.name for f in others} or ids == decoded:
        raise ValueError(f"there is a column {ids!r} or {decoded!r} already")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the ranks lack a byte")
    table = df.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([*others, T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(table.value, pattern)
        for batch in slices(batches, text, 4 << 20):
            packed = encoder.encode(pa.compute.fill_null(batch[text], ""))
            columns = [batch[f.name] for f in others]
            columns += [pa.array(packed, pa.binary()), pa.array(encoder.tokens.decode(packed), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Replace ``ids``, packed as ``encode`` packs them, by the bytes they stand for, in ``out``.

    Null ids give no bytes. An id without a token is an error.
    """
    kept = [f for f in df.schema.fields if f.name != ids]
    if out in [f.name for f in kept]:
        raise ValueError(f"there is a column {out!r} already")
    table = df.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([*kept, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(table.value)
        for batch in slices(batches, ids, 1 << 20):
            whole = tokens.decode(batch[ids].to_pylist())
            columns = [batch[f.name] for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(whole, pa.binary())], [f.name for f in kept] + [out])

    return df.mapInArrow(run, schema)
