"""Byte strings that occur twice, found by suffix arrays of shards and removed.

A string of ``least`` bytes that repeats may lie in any two texts, so texts are dealt to shards by what they
hold. Of every such string the leftmost of its smallest substrings of ``2 * least / 5`` bytes (by hash) is its
marker; equal strings have equal markers. A text falls into pieces, each of which holds the strings of one
marker; pieces whose marker occurs once are left out, equal pieces are sent once with a note that they are
several, and all pieces of a marker meet in one shard. A shard's suffixes are sorted by ``induced``: a string
is a repeat if its suffix shares ``least`` bytes with a neighbour, or if its piece is several.

Every string starts in exactly one piece, so a shard never compares a string with itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlens.llm.common import give_back, kept, materialize, slices
from cardlens.llm.induced import Scratch, sorted_suffixes
from cardlens.operators.joins import lookup_join
from cardlens.session import CHECKPOINT_DIR

# Starts of strings looked at together; a text of any length is cut in blocks of so many.
_BLOCK = 1 << 17
_POSITION = np.uint64((1 << 18) - 1)
# Raw bytes up to which markers are broadcast: a hashed relation of such short rows has four times that and more,
# and the driver builds it beside what it collected.
_MARKER_BYTES = 32 << 20
# An odd factor for the rolling hash, and one to mix its bits.
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


@dataclass(frozen=True)
class Settings:
    """``shard``: bytes of pieces sorted together (a marker's pieces stay together). ``hot``: bytes from which
    the pieces of one marker are too many for a shard; their strings are then counted by 128-bit hashes.
    ``memory``: bytes a sort holds in its queues before they go to files. ``block``: tuples handled at once."""

    shard: int = 8 << 20
    hot: int = 16 << 20
    memory: int = 64 << 20
    block: int = 1 << 16


class _Markers:
    """Cuts a text in runs of string starts that have one marker."""

    def __init__(self, least: int):
        self.gram = max(1, 2 * least // 5)
        self.window = least - self.gram + 1
        size = _BLOCK + least
        self._powers = np.multiply.accumulate(np.append(np.uint64(1), np.full(size, _BASE, np.uint64)))
        self._inverse = np.multiply.accumulate(np.append(np.uint64(1), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)))

    def cut(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each run its first start and the hash of its marker."""
        least = self.gram + self.window - 1
        starts, markers = [], []
        for begin in range(0, len(text) - least + 1, _BLOCK):
            data = np.frombuffer(text, np.uint8, min(_BLOCK + least - 1, len(text) - begin), begin).astype(np.uint64) + np.uint64(1)
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(data * self._powers[:len(data)], out=sums[1:])
            grams = (sums[self.gram:] - sums[:-self.gram]) * self._inverse[:len(data) - self.gram + 1]
            grams ^= grams >> np.uint64(32)
            grams *= np.uint64(_MIX)
            grams ^= grams >> np.uint64(29)
            # The smallest hash, the leftmost of equal ones: a hash's low bits give way to its position.
            least_of = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
            reach = 1
            while 2 * reach <= self.window:
                least_of = np.minimum(least_of[:-reach], least_of[reach:])
                reach *= 2
            if rest := self.window - reach:
                least_of = np.minimum(least_of[:-rest], least_of[rest:])
            at = (least_of & _POSITION).astype(np.int64)
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            starts.append(first + begin)
            markers.append(grams[at[first]])
        return np.concatenate(starts), np.concatenate(markers).view(np.int64)


def _add_markers(least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        markers = kept(("markers", least), lambda: _Markers(least))
        for batch in slices(batches, "bytes"):
            cuts = [markers.cut(t.as_buffer().to_pybytes()) for t in batch["bytes"]]
            ends = pa.array(np.cumsum([0] + [len(s) for s, _ in cuts]), pa.int32())
            if cuts:
                yield pa.RecordBatch.from_arrays(
                    [batch["digest"], pa.compute.binary_length(batch["bytes"]).cast(pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate([s for s, _ in cuts]), pa.int64())),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate([m for _, m in cuts]), pa.int64()))],
                    ["digest", "n_bytes", "starts", "markers"],
                )

    return run


def _take_pieces(least: int):
    """The pieces of each text; the bytes of one that this task has sent before are left out."""
    names = ["marker", "piece", "digest", "start", "bytes"]
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for batch in slices(batches, "bytes"):
            for digest, text, parts in zip(batch["digest"].to_pylist(), batch["bytes"].to_pylist(), batch["parts"].to_pylist()):
                for part in parts:
                    piece = text[part["start"]:part["stop"] + least - 1]
                    key = xxhash.xxh3_128_digest(piece)
                    new = key not in sent
                    if new:
                        if len(sent) >= 200_000:
                            sent.clear()
                        sent.add(key)
                        held += len(piece)
                    rows.append((part["marker"], key, digest, part["start"], piece if new else None))
                    if held > 2 << 20 or len(rows) >= 20_000:
                        yield flush()
                        rows, held = [], 0
        if rows:
            yield flush()

    return run


def repeated_starts(pieces: list[bytes], several: list[bool], least: int, scratch: Scratch) -> list[np.ndarray]:
    """For each piece the runs (first, behind the last) of starts of strings that occur twice, in ``pieces``
    or, where a piece is ``several``, in copies of it."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    wide = any(max(p, default=0) > 253 for p in pieces)
    # 0 ends the text, 1 ends a piece, bytes come two higher.
    symbols = scratch.array(int(sizes.sum()) + len(pieces) + 1, "<u2" if wide else "u1")
    for a, piece in zip(begin.tolist(), pieces):
        symbols[a:a + len(piece)] = np.frombuffer(piece, np.uint8)
        symbols[a:a + len(piece)] += 2
        symbols[a + len(piece)] = 1
    twice = scratch.array(len(symbols) + 1, "?")
    before = len(symbols)  # a place of its own
    for at, common in sorted_suffixes(symbols, scratch, least):
        found = common >= least
        twice[at[found]] = True
        twice[np.append(before, at[:-1])[found]] = True
        before = int(at[-1])
    out = []
    for a, size, many in zip(begin.tolist(), sizes.tolist(), several):
        starts = max(0, size - least + 1)
        if many:
            out.append(np.array([[0, starts]] if starts else [], np.int64).reshape(-1, 2))
            continue
        edges = np.flatnonzero(np.diff(twice[a:a + starts].astype(np.int8), prepend=0, append=0))
        out.append(edges.reshape(-1, 2))
    return out


def _packed(runs: np.ndarray) -> bytes:
    return np.ascontiguousarray(runs, "<i8").tobytes()


def _sort_shards(least: int, settings: Settings, folder: str | None):
    """Pieces in order of their markers -> the runs of each piece that has any."""

    def shard(pieces: list[tuple[bytes, bytes, bool]]) -> list[tuple[bytes, bytes]]:
        scratch = Scratch(folder, settings.memory, settings.block)
        runs = repeated_starts([p[1] for p in pieces], [p[2] for p in pieces], least, scratch)
        give_back()
        return [(p[0], _packed(r)) for p, r in zip(pieces, runs) if len(r)]

    def result(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], ["piece", "runs"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, group, marker, held = [], [], None, 0
        for batch in slices(batches, "bytes"):
            for own, *piece in zip(*(batch[c].to_pylist() for c in ("marker", "piece", "bytes", "many"))):
                if own != marker:
                    waiting += group  # a marker's pieces never part
                    group, marker = [], own
                    if held >= settings.shard:
                        yield result(shard(waiting))
                        waiting, held = [], 0
                group.append(tuple(piece))
                held += len(piece[1])
        if waiting or group:
            yield result(shard(waiting + group))

    return run


def _hash_strings(least: int):
    """Each start of a string in each piece, with the string's hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", 1 << 14):
            for piece, data, many in zip(*(batch[c].to_pylist() for c in ("piece", "bytes", "many"))):
                for a in range(0, len(data) - least + 1, 10_000):
                    at = range(a, min(a + 10_000, len(data) - least + 1))
                    hashes = [xxhash.xxh3_128_digest(data[i:i + least]) for i in at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes, pa.binary()), pa.array([piece] * len(at), pa.binary()), pa.array(at, pa.int64()),
                         pa.array([many] * len(at))], ["string", "piece", "at", "many"],
                    )

    return run


def _pack_starts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = []
        for starts in batch["starts"].to_pylist():
            starts = np.sort(np.array(starts, np.int64))
            new = np.flatnonzero(np.append(True, np.diff(starts) > 1))
            runs.append(_packed(np.stack([starts[new], starts[np.append(new[1:], len(starts)) - 1] + 1], axis=1)))
        yield pa.RecordBatch.from_arrays([batch["piece"], pa.array(runs, pa.binary())], ["piece", "runs"])


def _merge_runs(least: int):
    """Runs of starts, by text, as spans of bytes (first, behind the last) that do not touch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for parts in batch["parts"].to_pylist():
                runs = np.concatenate([np.frombuffer(p["runs"], "<i8").reshape(-1, 2) + p["start"] for p in parts])
                runs = runs[np.argsort(runs[:, 0], kind="stable")] + [0, least - 1]
                ends = np.maximum.accumulate(runs[:, 1])
                new = np.flatnonzero(np.append(True, runs[1:, 0] > ends[:-1]))
                spans.append(_packed(np.stack([runs[new, 0], ends[np.append(new[1:], len(runs)) - 1]], axis=1)))
            yield pa.RecordBatch.from_arrays([batch["digest"], pa.array(spans, pa.binary())], ["digest", "spans"])

    return run


def _folder(spark: SparkSession) -> str | None:
    """Where a sort's files go: the shared folder, if it is mounted; else where the executor spills."""
    root = urlparse(spark.conf.get(CHECKPOINT_DIR, None) or "")
    return root.path if root.path and root.scheme in ("", "file") else None


def _bytes(text: str) -> Column:
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def _digest(data: Column) -> Column:
    return F.unhex(F.sha2(data, 256))


def find_repeats(df: DataFrame, least: int = 400, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``digest`` (SHA-256) and ``spans`` of each different text that holds a byte covered by a string of
    ``least`` bytes that starts anywhere else too. ``spans`` are pairs of 64-bit numbers, first byte and the
    one behind the last, ascending, packed.

    Equal texts are looked at once; one that occurs twice is a repeat as a whole, if it is long enough. Equal
    pieces travel once, so a passage that all texts share does not pile up; where the different pieces of a
    marker exceed ``settings.hot`` all the same, their strings are counted one by one by hash. Null and shorter texts
    have no spans, nor has an empty table. Texts may be of any length and hold any bytes.
    """
    spark, folder = df.sparkSession, _folder(df.sparkSession)
    data = df.select(_bytes(text).alias("bytes")).where(F.octet_length("bytes") >= least)
    data = data.select(_digest(F.col("bytes")).alias("digest"), "bytes")
    schema = "digest binary, n_bytes long, starts array<long>, markers array<long>"
    cut = data.mapInArrow(_add_markers(least), schema).groupBy("digest").agg(
        *(F.first(c).alias(c) for c in ("n_bytes", "starts", "markers")), F.count("*").alias("copies")
    )
    cut = materialize(spark, cut, "markers")

    counts = cut.select(F.explode("markers").alias("marker")).groupBy("marker").agg(F.count("*").alias("n"))
    shared = materialize(spark, counts.where("n > 1").select("marker"), "shared-markers")
    behind = F.slice("starts", F.lit(2), F.size("starts"))
    stops = F.concat(behind, F.array(F.col("n_bytes") - (least - 1)))
    parts = cut.select("digest", F.inline(F.arrays_zip(F.col("starts").alias("start"), stops.alias("stop"), F.col("markers").alias("marker"))))
    parts = lookup_join(parts, shared, "marker", ["digest", "start"], "left_semi", _MARKER_BYTES)
    wanted = materialize(
        spark, parts.groupBy("digest").agg(F.collect_list(F.struct("start", "stop", "marker")).alias("parts")), "wanted-parts"
    )
    texts = lookup_join(data, wanted.select("digest"), "digest", ["digest"], "left_semi")
    texts = texts.groupBy("digest").agg(F.first("bytes").alias("bytes")).join(wanted.hint("merge"), "digest")
    places = texts.mapInArrow(_take_pieces(least), "marker long, piece binary, digest binary, start long, bytes binary")
    places = materialize(spark, places, "pieces")

    pieces = places.groupBy("marker", "piece").agg(F.first("bytes", ignorenulls=True).alias("bytes"), (F.count("*") > 1).alias("many"))
    pieces = materialize(spark, pieces, "different-pieces")
    by_marker = pieces.groupBy("marker").agg(F.count("*").alias("n"), F.sum(F.octet_length("bytes")).alias("size"))
    by_marker = materialize(spark, by_marker.where((F.col("n") == 1) | (F.col("size") > settings.hot)), "odd-markers")
    hot = by_marker.where(F.col("n") > 1).select("marker")
    # A marker with one piece needs no sorting: its strings are repeats if the piece is several.
    usual = lookup_join(pieces, by_marker.select("marker"), "marker", ["piece"], "left_anti", _MARKER_BYTES)
    alone = lookup_join(pieces.where("many"), by_marker.where("n = 1").select("marker"), "marker", ["piece"], "left_semi", _MARKER_BYTES)
    several = alone.select("piece", F.octet_length("bytes").alias("size"))
    found = usual.repartition("marker").sortWithinPartitions("marker").mapInArrow(
        _sort_shards(least, settings, folder), "piece binary, runs binary"
    ).unionByName(several.select("piece", _whole(F.col("size").cast("long") - (least - 1)).alias("runs")))
    if not hot.isEmpty():
        strings = lookup_join(pieces, hot, "marker", ["piece"], "left_semi")
        strings = strings.mapInArrow(_hash_strings(least), "string binary, piece binary, at long, many boolean")
        strings = materialize(spark, strings, "hot-strings")
        twice = strings.groupBy("string").agg(F.count("*").alias("n"), F.max("many").alias("many")).where("n > 1 OR many")
        starts = lookup_join(strings, twice.select("string"), "string", ["piece", "at"], "left_semi")
        starts = starts.groupBy("piece").agg(F.collect_list("at").alias("starts"))
        found = found.unionByName(starts.mapInArrow(_pack_starts, "piece binary, runs binary"))
    found = materialize(spark, found, "repeats")

    runs = lookup_join(places.select("digest", "start", "piece"), found, "piece", ["digest", "start"]).select("digest", "start", "runs")
    copied = cut.where("copies > 1").select("digest", F.lit(0).cast("long").alias("start"), _whole(F.col("n_bytes") - (least - 1)).alias("runs"))
    by_text = runs.unionByName(copied).groupBy("digest").agg(F.collect_list(F.struct("start", "runs")).alias("parts"))
    return materialize(spark, by_text.mapInArrow(_merge_runs(least), "digest binary, spans binary"), "spans")


def _whole(stop: Column) -> Column:
    """One run from 0 to ``stop``, packed."""
    little = F.concat(*(F.substring(F.unhex(F.lpad(F.hex(stop), 16, "0")), i, 1) for i in range(8, 0, -1)))
    return F.concat(F.lit(bytes(8)), little)


def _without(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "kept"):
        spans = [np.frombuffer(s or b"", "<i8").reshape(-1, 2).tolist() for s in batch["spans"].to_pylist()]
        kept_bytes = batch["kept"]
        if any(spans):
            texts = kept_bytes.to_pylist()
            for i, own in enumerate(spans):
                if own:
                    ends = [0] + [b for _, b in own]
                    starts = [a for a, _ in own] + [len(texts[i])]
                    texts[i] = b"".join([texts[i][a:b] for a, b in zip(ends, starts)])
            kept_bytes = pa.array(texts, pa.binary())
        listed = pa.array([[{"start": a, "stop": b} for a, b in own] for own in spans], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_bytes"], listed, kept_bytes], ["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(
    df: DataFrame, least: int = 400, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (of the text), ``spans`` (an array of start, stop: the bytes that go) and ``kept``
    (the bytes that stay, in order) of every row.

    A byte goes if a string of ``least`` bytes over it starts anywhere else too, in this text or another; all
    such strings are judged on the input. Strings never cross texts. Rows that repeat are rows like others, so
    all of a text that occurs twice goes if it is long enough; a row with a null id keeps it; a null
    text is empty and stays so. Spans may cut a character in two, so ``kept`` is binary. Other columns are left out.
    """
    found = find_repeats(df, least, text, settings)
    rows = df.select(F.col(doc_id).alias("doc_id"), _bytes(text).alias("kept"))
    rows = rows.select("doc_id", F.octet_length("kept").cast("long").alias("n_bytes"), "kept", _digest(F.col("kept")).alias("digest"))
    judged = lookup_join(rows, found, "digest", ["doc_id", "digest"], "left").select("doc_id", "n_bytes", "kept", "spans")
    kind = df.schema[doc_id].dataType.simpleString()
    return judged.mapInArrow(_without, f"doc_id {kind}, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
