"""Benchmark passages in documents, word for word or paraphrased, by latent semantic retrieval.

The benchmark's items are cut into passages. A term weighs by its inverse frequency in the passages of all
documents. A randomised SVD of the TF-IDF matrix of the benchmark's passages gives the space they span: its
products and sums are made where the passages lie, and only matrices as wide as the rank come together. The
rank is that of the passages, so the space holds every passage whole; a large benchmark is cut into blocks.
Overlapping windows of every document are folded into that space. A window is a candidate for a passage if its
cosine is at least what a window of its length has that holds most of the passage, even if only the lightest
terms are left. A candidate stands if the longest common subsequence of the item and a stretch of the document
covers most of the item, and most of the item's answer, its last sentence, too.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardlens.llm.common import Terms, known_terms, slices, terms

PASSAGE = 32  # terms
BLOCK = 16  # windows begin at every block
SPAN = 5  # blocks of a window: it holds any passage whole that half as many other terms were put into
WIDE = 256  # columns that are summed in one row
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")


@dataclass(frozen=True)
class Settings:
    oversample: int = 16
    common: float = 0.7  # part of the item, and of its answer, in the longest common subsequence
    block_bytes: int = 1 << 20  # benchmark text that is searched for in one pass over the documents
    block_passages: int = 512  # and about how many passages of it; the rank follows them
    seed: int = 11


def answer_of(text: str) -> list[str]:
    """The terms of the last sentence; of a single sentence, the last quarter, three terms at least."""
    sentences = [s for s in (terms(part) for part in _SENTENCE_END.split(text)) if s]
    if len(sentences) > 1:
        return sentences[-1]
    whole = sentences[0] if sentences else []
    return whole[-max(3, len(whole) // 4):]


def passages(items: list[list[int]]) -> list[tuple[int, list[int]]]:
    """Item number and terms of each passage; what is left at an item's end joins the passage before it
    only if it is short."""
    out = []
    for number, ids in enumerate(items):
        n = max(1, round(len(ids) / PASSAGE + 0.25))
        cuts = [round(len(ids) * i / n) for i in range(n + 1)]
        out += [(number, ids[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]
    return out


def lcs(pattern: list[int], text: list[int]) -> int:
    """The length of the longest common subsequence, a machine word's worth of positions at a time."""
    where: dict[int, int] = {}
    for i, t in enumerate(pattern):
        where[t] = where.get(t, 0) | 1 << i
    full = (1 << len(pattern)) - 1
    row = full
    for t in text:
        hit = where.get(t)
        if hit:
            both = row & hit
            row = ((row + both) | (row - both)) & full
    return len(pattern) - row.bit_count()


def randomised_svd(rows: DataFrame, width: int, rank: int, oversample: int, seed: int) -> np.ndarray:
    """The leading right singular vectors (``width`` x at most ``rank``) of a sparse matrix.

    ``rows`` has ``terms array<int>`` and ``weights array<double>``, one row of the matrix each. Two passes,
    each summed per column of the matrix in the tasks: the range of the matrix is sampled with a random test
    matrix and one power step, and the small Gram matrix in that range is diagonalised.
    """
    many = min(rank + oversample, width)
    test = np.random.default_rng(seed).standard_normal((width, many)).astype(np.float32)

    def project(basis: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for r in batch.to_pylist():
                    index, weight = np.array(r["terms"], int), np.array(r["weights"])
                    if len(index):
                        image = weight @ basis[index]
                        for t, w in zip(r["terms"], weight):
                            total[t] = total.get(t, 0) + w * image
            for part in range(0, basis.shape[1], WIDE):
                if total:
                    values = [v[part:part + WIDE].tolist() for v in total.values()]
                    yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array([part] * len(total), pa.int32()), pa.array(values)], ["term", "part", "v"])

        sums = [F.sum(F.get("v", F.lit(i))).alias(f"c{i}") for i in range(min(WIDE, basis.shape[1]))]
        summed = rows.mapInArrow(run, "term int, part int, v array<double>").groupBy("term", "part").agg(F.array(*sums).alias("v"))
        out = np.zeros((width, basis.shape[1]))
        for r in summed.toLocalIterator():  # as many rows as terms in a block of the benchmark, for each part
            n = min(WIDE, basis.shape[1] - r["part"])
            out[r["term"], r["part"]:r["part"] + n] = r["v"][:n]
        return out

    basis, _ = np.linalg.qr(project(test))
    gram = basis.T @ project(basis)
    values, turn = np.linalg.eigh((gram + gram.T) / 2)
    keep = [i for i in np.argsort(values)[::-1][:rank] if values[i] > 1e-9 * max(values.max(), 1e-30)]
    return (basis @ turn[:, keep]).astype(np.float32)


@dataclass
class Index:
    """What a task needs to search for a block of the benchmark."""

    settings: Settings
    number: dict[str, int]  # term -> its row, from 1; 0 is any other term
    fold: np.ndarray  # weight of each term times its latent vector
    mass: np.ndarray  # squared weight of each term
    item_ids: list
    items: list[list[int]]
    answers: list[list[int]]
    words: list[frozenset[int]]  # the terms of each item
    latent: np.ndarray  # unit vectors of the passages
    of_item: np.ndarray
    least: np.ndarray  # least product of a passage's unit vector and a window that holds ``common`` of its terms
    least_mass: float  # least sum of squared weights of a window that holds ``common`` of a passage's terms

    def search(self, texts: list[str] | pa.Array, known: Terms) -> Iterator[tuple[int, int, float, float]]:
        """Text number, item number, cosine and common part of every finding."""
        packed = known.ids(texts)
        sizes = np.array([len(p) for p in packed])
        blocks = np.maximum(1, -(-sizes // BLOCK))
        first = np.cumsum(blocks) - blocks
        ids = np.concatenate(packed) if len(packed) else np.empty(0, int)
        hit = np.flatnonzero(ids)
        if not len(hit):
            return
        starts = np.cumsum(sizes) - sizes
        text_of = np.searchsorted(starts + sizes, hit, side="right")
        block_of = first[text_of] + (hit - starts[text_of]) // BLOCK
        n = int(blocks.sum())
        held = np.bincount(block_of, self.mass[ids[hit]], n)
        owner = np.repeat(np.arange(len(texts)), blocks)
        joins = [np.append(owner[k:] == owner[:max(n - k, 0)], np.zeros(min(k, n), bool)) for k in range(1, SPAN)]
        window = held + sum(np.append(held[k:], np.zeros(min(k, n))) * j for k, j in enumerate(joins, 1))
        wanted = window >= self.least_mass
        bounds = np.searchsorted(block_of, np.arange(n + 1))
        for i in range(0, n, 2048):
            at = i + np.flatnonzero(wanted[i:i + 2048])
            if len(at):
                yield from self._near(at, i, ids, hit, bounds, joins, owner, first, starts, sizes)

    def _near(self, at, base, ids, hit, bounds, joins, owner, first, starts, sizes) -> Iterator[tuple[int, int, float, float]]:
        end = min(base + 2048 + SPAN - 1, len(owner))
        edges = bounds[base:end + 1]
        # The terms of a block one after the other, of all blocks that have so many at once.
        counts = np.diff(edges)
        order = np.argsort(-counts, kind="stable")
        begins, total = edges[:-1][order], np.zeros((len(order), self.fold.shape[1]), np.float32)
        for j in range(counts.max(initial=0)):
            more = int((counts > j).sum())
            total[:more] += self.fold[ids[hit[begins[:more] + j]]]
        sums = np.zeros((len(order) + SPAN - 1, self.fold.shape[1]), np.float32)
        sums[order] = total
        folded = sums[at - base]
        for k, join in enumerate(joins, 1):
            folded += sums[at - base + k] * join[at, None]
        product = folded @ self.latent.T
        near = [x.tolist() for x in np.nonzero(product >= self.least)]
        norms = np.maximum(np.linalg.norm(folded, axis=1), 1e-12)
        # Windows of one text that are near one item and overlap are looked into at once.
        runs: dict[tuple[int, int], list[list[float]]] = {}
        for w, p, cosine in zip(*near, (product[near[0], near[1]] / norms[near[0]]).tolist()):
            text, item = int(owner[at[w]]), int(self.of_item[p])
            begin = int(at[w] - first[text]) * BLOCK
            seen = runs.setdefault((text, item), [])
            if seen and begin <= seen[-1][1]:
                seen[-1][1:] = begin + SPAN * BLOCK, max(seen[-1][2], cosine)
            else:
                seen.append([begin, begin + SPAN * BLOCK, cosine])
        for (text, item), seen in runs.items():
            whole = ids[starts[text]:starts[text] + sizes[text]]
            for begin, stop, cosine in seen:
                common = self._common(whole, begin, stop, item)
                if common is not None:
                    yield text, item, cosine, common

    def _common(self, ids: np.ndarray, begin: int, stop: int, item: int) -> float | None:
        """The part of the item in the best stretch of the document that meets ``begin`` to ``stop``, or None.

        A stretch begins at a term of the item; those of long items begin at every eighth of the item only, and
        are longer by as much.
        """
        wanted, answer, words = self.items[item], self.answers[item], self.words[item]
        n, need = len(wanted), self.settings.common
        step = max(1, n // 8)
        length = n + max(4, n // 2) + step - 1
        low = max(0, begin - length)
        low -= low % step
        near = ids[low:stop + length].tolist()
        at = [i for i, t in enumerate(near) if t in words]
        least = _most(n, need)
        found, last = None, -1
        for k in range(len(at) - least + 1):  # fewer terms of the item cannot have so long a subsequence
            a = at[k] - at[k] % step
            if a == last or at[k + least - 1] >= a + length:
                continue
            last = a
            stretch = near[a:a + length]
            if sum(map(set(stretch).__contains__, wanted)) < least:
                continue
            part = lcs(wanted, stretch) / n
            if part >= need and (found is None or part > found) and lcs(answer, stretch) >= need * len(answer):
                found = part
                if part == 1:
                    break
        return found


def _most(n: int, need: float) -> int:
    """How many of ``n`` terms are the part ``need`` of them, or more."""
    return math.ceil(n * need - 1e-9)


def _frequencies(documents: DataFrame, text: str, number: dict[str, int]) -> tuple[np.ndarray, int]:
    """In how many passages of all documents each term occurs, and the number of passages."""
    vocabulary = documents.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_terms(vocabulary.value)
        width = len(vocabulary.value) + 1
        total, count = np.zeros(width, np.int64), 0
        for batch in slices(batches, text, 4 << 20):
            packed = known.ids(pa.compute.fill_null(batch[text], ""))
            sizes = np.array([len(p) for p in packed], int)
            ids = np.concatenate(packed) if packed else np.empty(0, np.int32)
            many = -(-sizes // PASSAGE)
            within = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            passage = np.repeat(np.cumsum(many) - many, sizes) + within // PASSAGE
            hit = ids > 0
            seen = np.unique(passage[hit].astype(np.int64) * width + ids[hit])
            total += np.bincount(seen % width, minlength=width)
            count += int(many.sum())
        total[0] = count
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["term", "n"])

    summed = documents.select(text).mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(len(number) + 1, np.int64)
    for r in summed.toLocalIterator():  # as many rows as terms in a block of the benchmark
        out[r["term"]] = r["n"]
    return out, int(out[0])


def build_index(documents: DataFrame, text: str, items: list[tuple], settings: Settings) -> Index:
    """The index of ``items`` (id, text) with term weights taken from all documents."""
    spark = documents.sparkSession
    cut = [terms(t) for _, t in items]
    number = {t: i + 1 for i, t in enumerate(sorted({t for c in cut for t in c}))}
    ids = [[number[t] for t in c] for c in cut]
    frequency, count = _frequencies(documents, text, number)
    weight = np.log((count + 1) / (np.maximum(frequency, 1))) + 0.01
    weight[0] = 0
    parts = passages(ids)
    counts = [Counter(p) for _, p in parts]
    norms = [math.sqrt(sum((weight[t] * n) ** 2 for t, n in c.items())) for c in counts]
    # Unit rows, so that passages of light terms are not lost in the noise of the others.
    sparse = [(sorted(c), [float(weight[t]) * c[t] / norm for t in sorted(c)]) for c, norm in zip(counts, norms)]
    frame = spark.createDataFrame(sparse, "terms array<int>, weights array<double>")
    vectors = randomised_svd(frame, len(number) + 1, len(parts), settings.oversample, settings.seed)
    latent = np.stack([np.array(w, np.float32) @ vectors[np.array(t)] for t, w in sparse])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)

    def lightest(values: Iterable[float]) -> float:
        ordered = sorted(values)
        return 0.999 * sum(ordered[:_most(len(ordered), settings.common)])

    return Index(
        settings, number, (vectors * weight[:, None]).astype(np.float32), weight**2, [i for i, _ in items], ids,
        [[number[t] for t in answer_of(t_)] for _, t_ in items], [frozenset(i) for i in ids], latent,
        np.array([i for i, _ in parts]),
        np.array([lightest(float(weight[t]) ** 2 * c[t] for t in p) / norm for (_, p), c, norm in zip(parts, counts, norms)], np.float32),
        min(lightest(float(weight[t]) ** 2 for t in p) for _, p in parts),
    )


def _indexes(documents: DataFrame, benchmark: DataFrame, text: str, settings: Settings) -> Iterator[Index]:
    """An index for each block of the benchmark."""
    asked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").rlike(r"(?U)\w"))
    about = F.greatest(F.lit(1), F.round(F.regexp_count("text", F.lit(r"(?U)\w+")) / PASSAGE + 0.25))
    size = asked.agg(F.sum(F.octet_length("text")).alias("n"), F.sum(about).cast("long").alias("passages")).first()
    count = max(-(-(size["n"] or 0) // settings.block_bytes), -(-(size["passages"] or 0) // settings.block_passages))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, count)))
    for number in range(count):
        items = [tuple(r) for r in asked.where(block == number).distinct().orderBy("item_id", "text").collect()]
        items = [(i, t) for i, t in items if terms(t)]
        if items:
            yield build_index(documents, text, items, settings)


def find_leaks(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``doc_id``, ``item_id``, ``cosine`` and ``common`` (part of the item found) for every benchmark item
    that a document holds.

    ``benchmark`` has item_id and text. It is searched for in blocks of about ``block_bytes`` or ``block_passages``, each with one
    index that goes to the tasks; every document is held against every block. Items without a term, and
    null or empty documents, match nothing. Rows that repeat a document are each reported; an empty table
    on either side gives no rows. Other columns play no part.
    """
    schema = "doc_id long, item_id long, cosine double, common double"
    given = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run_with(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = known_terms(shared.value.number)
            for batch in slices(batches, "text", 4 << 20):
                ids = batch["doc_id"].to_pylist()
                rows = [(ids[t], shared.value.item_ids[i], c, part) for (t, i), (c, part) in sorted(_best(shared.value, batch["text"], known).items())]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "item_id", "cosine", "common"])

        return run

    found = documents.sparkSession.createDataFrame([], schema)
    for index in _indexes(given, benchmark, "text", settings):
        found = found.unionByName(given.mapInArrow(run_with(documents.sparkSession.sparkContext.broadcast(index)), schema))
    return found


def _best(index: Index, texts: pa.Array, known: Terms) -> dict[tuple[int, int], tuple[float, float]]:
    """Cosine and common part of the best finding of each item in each text."""
    best: dict[tuple[int, int], tuple[float, float]] = {}
    for text, item, cosine, common in index.search(pa.compute.fill_null(texts, ""), known):
        best[text, item] = max(best.get((text, item), (0.0, 0.0)), (cosine, common))
    return best


def drop_leaks(documents: DataFrame, benchmark: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The documents that hold no benchmark item, all columns as they are. Each row is judged where it is read."""

    def run_with(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = known_terms(shared.value.number)
            for batch in slices(batches, text, 4 << 20):
                leaked = {t for t, _ in _best(shared.value, batch[text], known)}
                yield batch.take(pa.array([i for i in range(batch.num_rows) if i not in leaked], pa.int64()))

        return run

    kept = documents
    for index in _indexes(documents, benchmark, text, settings):
        kept = kept.mapInArrow(run_with(documents.sparkSession.sparkContext.broadcast(index)), documents.schema)
    return kept
