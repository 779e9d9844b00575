"""What several operators of this package share."""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 (binds pa.compute)
from pyspark.sql import DataFrame, SparkSession

from cardlens.session import shared_path

_WORD = re.compile(r"\w+")
_SIGNS = ",.!?;:()[]\"'-"  # may stand around a word without changing its terms


def materialize(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there, on storage that
    survives lost executors, and it is computed once however often it is read."""
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so (case does not tell names apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``max_bytes`` in each; a longer value stands alone."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


class Terms(dict):
    """Word -> the int32 numbers of its normalised terms, as bytes, remembered up to ``limit`` words.

    A term is a run of letters and digits in lower case. ``number`` gives a term's number, from 1; any other term
    has 0. Texts are cut at spaces, and each different word of them is looked up once; ASCII words that are one
    term between signs are looked up all together, and only the others are remembered.
    """

    def __init__(self, number: dict[str, int], limit: int = 250_000):
        super().__init__()
        self._number, self._limit = number, limit
        self._terms = pa.array(list(number), pa.string())
        self._numbers = np.append(np.fromiter(number.values(), np.int32, len(number)), np.int32(0))

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self._limit:
            self.clear()
        value = b"".join([self._number.get(t, 0).to_bytes(4, "little") for t in (_cut(word) if word else ())])
        self[word] = value
        return value

    def ids(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The numbers of each text's terms. No term reaches over white space, so a space parts words as well as any."""
        ends, numbers, words = split(as_strings(texts))
        compute = pa.compute
        inner = compute.ascii_trim(words, _SIGNS)
        plain = compute.and_(compute.string_is_ascii(words), compute.ascii_is_alnum(inner)).to_numpy(zero_copy_only=False)
        found = compute.fill_null(compute.index_in(compute.ascii_lower(inner), self._terms), -1).to_numpy(zero_copy_only=False)
        others = [self[w] for w in listed(words.filter(pa.array(~plain)))]
        sizes = np.ones(len(words), np.int64)
        sizes[~plain] = np.fromiter(map(len, others), np.int64, len(others)) // 4
        values = np.zeros(int(sizes.sum()), "<i4")
        starts = np.cumsum(sizes) - sizes
        values[starts[plain]] = self._numbers[found[plain]]
        odd = np.repeat(~plain, sizes)
        values[odd] = np.frombuffer(b"".join(others), "<i4")
        own = sizes[numbers]
        whole = joined(values, starts[numbers], own)
        bounds = np.append(0, np.cumsum(own))[ends].tolist()
        return [whole[a:b] for a, b in zip(bounds, bounds[1:])]


class Remembered(dict):
    """What was met lately, in two generations of about ``limit`` entries: the entries here and older ones."""

    def __init__(self, limit: int):
        super().__init__()
        self._limit = limit
        self._older: dict[str, bytes] = {}

    def age(self) -> None:
        """Past the limit, the entries become the older ones."""
        if len(self) > self._limit:
            self._older = dict(self)
            self.clear()

    def unknown(self, wanted: set[str]) -> set[str]:
        """Those of ``wanted`` that have to be learnt; the others are entries until the next ``age``."""
        missing = wanted - self.keys()
        again = self._older.keys() & missing
        self.update((w, self._older[w]) for w in again)
        return missing - again


def joined(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that start at ``starts``, one after the other."""
    before = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def as_strings(texts: list[str] | pa.Array) -> pa.Array:
    return texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string())


def listed(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()  # to_pylist is much slower


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Texts cut at spaces: where the words of each begin, the number of each word, and the different words."""
    cut = pa.compute.split_pattern(texts, " ")
    ends = np.append(0, np.cumsum(pa.compute.list_value_length(cut).to_numpy(zero_copy_only=False)))
    coded = cut.flatten().dictionary_encode()
    return ends, coded.indices.to_numpy(), coded.dictionary


def packed_words(packed: list[bytes], numbers: np.ndarray, ends: np.ndarray, width: int) -> list[bytes]:
    """Of each text the packed ids of its words, by the numbers of the words; ``packed`` holds each word's."""
    sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // width
    ids = np.frombuffer(b"".join(packed), f"<u{width}")
    own = sizes[numbers]
    whole = joined(ids, (np.cumsum(sizes) - sizes)[numbers], own).tobytes()
    bounds = (np.append(0, np.cumsum(own))[ends] * width).tolist()
    return [whole[a:b] for a, b in zip(bounds, bounds[1:])]


_KEPT: list[tuple[object, object]] = []


def kept(key: object, make: Callable[[], object]) -> object:
    """``make()``, kept from task to task of a Python worker until something is asked for under another key:
    a worker holds the memory of one operator at a time, however many it has served."""
    if not _KEPT or _KEPT[0][0] != key:
        _KEPT.clear()  # before the new one grows
        _KEPT.append((key, make()))
    return _KEPT[0][1]


def forget() -> None:
    """Let go of what is ``kept``. For operators that keep nothing themselves, but whose workers served another."""
    _KEPT.clear()


def give_back() -> None:
    """Hand memory that was freed back to the system: the C library of Linux keeps it for the worker otherwise."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim:
        trim(0)


def known_terms(number: dict[str, int]) -> Terms:
    """The ``Terms`` of a vocabulary (0: any other term), as ``kept`` keeps them."""
    return kept(("terms", len(number), hash(frozenset(number.items()))), lambda: Terms(number))


def _cut(word: str) -> list[str]:
    low = word.lower()
    if low.isalnum():
        return [low]
    return [low[:-1]] if low[-1] in ",.!?;:" and low[:-1].isalnum() else _WORD.findall(low)


def terms(text: str) -> list[str]:
    """The normalised terms of a text, as ``Terms`` cuts them."""
    return [t for word in text.split() for t in _cut(word)]
