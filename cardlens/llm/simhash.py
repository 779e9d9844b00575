"""SimHash near-duplicates: fingerprints of word shingles, linked by deletion-variant signatures.

Two fingerprints that differ in at most ``k`` of 64 bits are found without comparing all. The bits are cut
into so few segments that, however the differences fall, one segment holds at most one: ``k // 2 + 1`` of
them. Each fingerprint is indexed, for every segment, under the variants of that segment in which one bit is
a wildcard. Two segments that differ in at most one bit share a variant, so an equality join of the variants
brings every wanted pair together, and the bit distance verifies it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cardlens.llm.common import forget, materialize, slices
from cardlens.llm.components import connected_components
from cardlens.operators.joins import lookup_join, shuffle_join

BITS = 64
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# For each byte, its eight bits as eight counters in the bytes of one number.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(texts: list[str], shingle: int = 4, seed: int = 42) -> np.ndarray:
    """The fingerprint of each text, as unsigned 64-bit numbers.

    A-Z are lower-cased; words lie between ASCII white space; shingles of ``shingle`` words, repeats
    included, are joined by spaces and hashed (XXH64); a shorter text is one shingle, and one without words
    has fingerprint 0. A bit is set if it is set in more than half of the hashes.
    """
    digest, hashes, counts = xxhash.xxh64_intdigest, [], []
    for text in texts:
        words = text.encode().translate(_LOWER).split()
        line = b" ".join(words)
        if len(words) <= shingle:
            found = [digest(line, seed)] if words else []
        else:
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = [0, *ends[:len(words) - shingle].tolist()]
            found = [digest(line[a:b], seed) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
        hashes += found
        counts.append(len(found))
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        sizes = np.array(counts)[some]
        first = np.cumsum(sizes) - sizes
        # Up to 255 hashes fit a byte counter, so a text is summed in blocks of that many.
        blocks = -(-sizes // 255)
        start = np.repeat(first, blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks))
        spread = _SPREAD[np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)]
        summed = np.add.reduceat(spread, start, axis=0).view(np.uint8).reshape(-1, BITS)
        ones = np.add.reduceat(summed.astype(np.int64), np.cumsum(blocks) - blocks, axis=0)
        out[some] = np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def add_fingerprints(df: DataFrame, text: str = "text", shingle: int = 4, out: str = "fingerprint") -> DataFrame:
    """``df`` without its text and with ``out``, the fingerprint as a signed long. A null text has no words."""
    from pyspark.sql import types as T

    kept = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, text, 1 << 20):
            found = fingerprints([t or "" for t in batch[text].to_pylist()], shingle).view(np.int64)
            columns = [batch[f.name] for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], [f.name for f in kept] + [out])

    return df.mapInArrow(run, schema)


def segments(bits: list[int], max_bits: int) -> list[list[int]]:
    """``bits`` in so many runs that, of ``max_bits`` of them, at most one falls into some run."""
    n = max_bits // 2 + 1
    cuts = [round(len(bits) * i / n) for i in range(n + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:])]


def _variants(bits: list[int], max_bits: int) -> Column:
    """The variants of ``fp`` within ``bits``: the wildcard's bit, and the rest of its segment."""
    variants = []
    for segment in segments(bits, max_bits):
        for wild in segment:
            kept = sum(1 << bit for bit in segment if bit != wild)
            signed = kept - (1 << BITS) if kept >> (BITS - 1) else kept
            rest = F.col("fp").bitwiseAND(F.lit(signed))
            variants.append(F.struct(F.lit(wild).alias("wild"), rest.alias("rest")))
    return F.inline(F.array(*variants))


def _spanning_edges(members: np.ndarray, max_bits: int, block: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected among ``members``: a breadth-first search over blocks.

    A member that has been reached is compared with those not reached yet, so a dense cluster takes few
    comparisons; memory is bounded by ``block``, and there are fewer links than members.
    """
    left = members
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            node, front = front[0], front[1:]
            near = np.zeros(len(left), bool)
            for i in range(0, len(left), block):
                near[i:i + block] = np.bitwise_count(left[i:i + block] ^ node) <= max_bits
            if near.any():
                reached = left[near]
                yield np.full(len(reached), node), reached
                front = np.concatenate([front, reached])
                left = left[~near]


def _verify_runs(key: np.ndarray, fp: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within each run of equal keys: short runs all at once, long ones each by a search."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    long = sizes > 64
    for at, n in zip(starts[long], sizes[long]):
        yield from _spanning_edges(fp[at:at + n], max_bits)
    ends = np.repeat(np.where(long, starts, starts + sizes), sizes)  # of each row's run; 0 ahead in a long one
    row = np.arange(len(key))
    step = 1
    while True:
        row = row[row + step < ends[row]]
        if not len(row):
            return
        near = np.bitwise_count(fp[row] ^ fp[row + step]) <= max_bits
        yield fp[row[near]], fp[row[near] + step]
        step += 1


def _search(indexed: DataFrame, max_bits: int, most: int | None) -> DataFrame:
    """Links ``a``, ``b`` among the fingerprints that share a signature, with ``wild`` null.

    A signature shared by more than ``most`` fingerprints is left open: each of them comes back as ``b``
    beside the signature, ``a``, and its wildcard. No more than ``most`` rows of a signature are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []  # rows of the signature that may go on in the next batch
        opened = None  # the signature of which rows have been left open

        def rows(a: np.ndarray, b: np.ndarray, wild: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), wild], ["a", "b", "wild"])

        def settle(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            key, fp, wild = map(np.concatenate, zip(*parts))
            leave = key == opened if opened is not None else np.zeros(len(key), bool)
            if most is not None:
                _, at, n = np.unique(key, return_inverse=True, return_counts=True)
                leave |= n[at] > most
            if leave.any():
                yield rows(key[leave], fp[leave], pa.array(wild[leave]))
                key, fp = key[~leave], fp[~leave]
            for a, b in _verify_runs(key, fp, max_bits) if len(key) else ():
                if len(a):
                    yield rows(a, b, pa.nulls(len(a), pa.int32()))

        for batch in batches:
            if not batch.num_rows:
                continue
            key, fp, wild = batch["signature"].to_numpy(), batch["fp"].to_numpy().view(np.uint64), batch["wild"].to_numpy()
            last = np.searchsorted(key, key[-1])  # rows are sorted by signature
            if last or held and held[0][0][0] != key[-1]:
                yield from settle([*held, (key[:last], fp[:last], wild[:last])])
                held = []
            held.append((key[last:], fp[last:], wild[last:]))
            if most is not None and sum(len(k) for k, *_ in held) > most:
                opened = key[-1]
                yield from settle(held)
                held = []
        if held:
            yield from settle(held)

    together = indexed.repartition("signature").sortWithinPartitions("signature")
    return together.mapInArrow(run, "a long, b long, wild int")


def links(distinct: DataFrame, max_bits: int = 4, most: int = 100_000) -> DataFrame:
    """Links ``a``, ``b`` among the different fingerprints ``fp`` that connect exactly what is connected by
    distances of at most ``max_bits``. Not every pair of a cluster is listed, but none is lost to its component.

    The fingerprints of a signature that more than ``most`` share are indexed again, under that signature
    and the variants of their remaining bits, which fewer share by far. Only what is alike in those bits
    too stays together, eight bytes a fingerprint, and a cluster that dense is searched in few comparisons.
    """
    bits = list(range(BITS))
    index = distinct.select("fp", _variants(bits, max_bits)).select("wild", F.xxhash64("wild", "rest").alias("signature"), "fp")
    first = materialize(distinct.sparkSession, _search(index, max_bits, most), "links")
    found = first.where("wild IS NULL").select("a", "b")
    opened = first.where("wild IS NOT NULL")
    if not opened.isEmpty():
        for segment in segments(bits, max_bits):
            others = [b for b in bits if b not in segment]
            again = opened.where(F.col("wild").isin(segment)).select(F.col("a").alias("parent"), F.col("b").alias("fp"))
            again = again.select("parent", "fp", _variants(others, max_bits))
            again = again.select("wild", F.xxhash64("parent", "wild", "rest").alias("signature"), "fp")
            found = found.unionByName(_search(again, max_bits, None).select("a", "b"))
    return found.distinct()


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``doc_id``, ``key`` (a hash of the text), ``fingerprint`` (a signed long), ``component`` (the smallest
    fingerprint that is reachable by links) and ``component_id`` (the smallest doc id reachable).

    One row comes back for every row of ``df``, repeated ones included; other columns are left out. Equal
    fingerprints are one node, so copies are linked without being paired. Null doc ids count for no
    minimum; a component without any other has a null ``component_id``. An empty table has an empty result.
    """
    spark = df.sparkSession
    narrow = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    marked = materialize(spark, add_fingerprints(narrow, "text", shingle), "fingerprints")
    classes = materialize(
        spark, marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first")), "fingerprint-classes"
    )
    nodes = connected_components(links(classes.select("fp"), max_bits))
    placed = classes.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    places = materialize(
        spark,
        shuffle_join(placed, smallest, "component", ["fp"]).select(F.col("fp").alias("fingerprint"), "component", "component_id"),
        "fingerprint-components",
    )
    return lookup_join(marked, places, "fingerprint", ["doc_id", "key"]).select(
        "doc_id", "key", "fingerprint", "component", "component_id"
    )


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``df`` with the smallest doc id of their component, all columns as they are.

    One row of each component stays; of rows that repeat its doc id and text, one. Where all ids of a
    component are null, the row with the smallest text hash stays.
    """
    spark = df.sparkSession
    found = near_duplicates(df, doc_id, text, shingle, max_bits)
    same = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("key").cast("string")).alias("same")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    rows = materialize(spark, found.select("component", order.alias("order"), same), "near-duplicates")
    first = rows.groupBy("component").agg(F.min("order").alias("first"))
    counted = rows.groupBy("component", "same", "order").agg(F.count("*").alias("n"))
    # A component may hold most of the rows: they are spread where they meet its first.
    judged = shuffle_join(counted, first, "component", ["same"])
    judged = materialize(
        spark, judged.select("same", F.col("order").eqNullSafe(F.col("first")).alias("stays"), "n"),
        "judged",
    )
    own = F.concat_ws(":", F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("-")), F.xxhash64(text).cast("string"))
    keyed = df.select(F.struct("*").alias("row"), own.alias("same"))
    # Most rows stay, so those that go are what is looked up.
    stay = lookup_join(keyed, judged.where("NOT stays OR n > 1").select("same"), "same", ["same"], "left_anti")
    repeated = judged.where("stays AND n > 1").select("same")
    if not repeated.isEmpty():
        copies = lookup_join(keyed, repeated, "same", ["same"], "left_semi")
        stay = stay.unionByName(copies.groupBy("same").agg(F.first("row").alias("row")))
    return stay.select("row.*")
