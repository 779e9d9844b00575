"""A byte-level convolutional network that tells good text from bad, trained and run in numpy.

A text is its UTF-8 bytes, cut into chunks that overlap and cover it to its end. Learned filters slide over
a chunk, whose channels are the embedding of each byte and a flag that says whether the four bytes from here
on stood a little earlier already; the strongest response of each filter is kept (max pooling) and a small dense
layer turns the responses into the chunk's probability. The text's score is the mean over its chunks, each
counted by its bytes. Nothing but the bytes of the text goes into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cardlens.llm.common import forget, slices, unused

CHUNK, STEP = 256, 192
WIDTH, STRIDE = 8, 2
PLACES = (CHUNK - WIDTH) // STRIDE + 1
EMBED, FILTERS, HIDDEN = 6, 24, 16
LOOK_BACK = 32  # bytes within which four bytes count as repeated


def chunks(text: bytes) -> np.ndarray:
    """The chunks of a text, a row each, padded with zero bytes; an empty text has one."""
    n = 1 + max(0, -(-(len(text) - CHUNK) // STEP))
    padded = np.zeros(CHUNK + (n - 1) * STEP, np.uint8)
    padded[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


def repeats(x: np.ndarray) -> np.ndarray:
    """Whether the four bytes from each place on occurred in the ``LOOK_BACK`` bytes before it; 0 in padding."""
    wide = x.astype(np.uint32)
    four = wide[:, :-3] | wide[:, 1:-2] << 8 | wide[:, 2:-1] << 16 | wide[:, 3:] << 24
    flag = np.zeros(x.shape, bool)
    for lag in range(1, LOOK_BACK + 1):
        flag[:, lag:-3] |= four[:, lag:] == four[:, :-lag]
    return flag & (x > 0)


def windows(flags: np.ndarray) -> np.ndarray:
    """The flags of each window as the bits of one byte."""
    pairs = flags[:, ::2] + 2 * flags[:, 1::2].astype(np.uint8)
    n = PLACES
    return pairs[:, :n] + 4 * pairs[:, 1:n + 1] + 16 * pairs[:, 2:n + 2] + 64 * pairs[:, 3:n + 3]


_BITS = (np.arange(256)[:, None] >> np.arange(WIDTH) & 1).astype(np.float32)


@dataclass
class Network:
    """The learned numbers. ``dense`` and ``out`` have their biases in the last row."""

    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # WIDTH x EMBED x FILTERS
    again: np.ndarray  # WIDTH x FILTERS, the filters' taps on the flags
    dense: np.ndarray  # FILTERS + 1 x HIDDEN
    out: np.ndarray  # HIDDEN + 1

    @staticmethod
    def fresh(seed: int) -> Network:
        rng = np.random.default_rng(seed)
        scaled = lambda shape, n: (rng.standard_normal(shape) / np.sqrt(n)).astype(np.float32)
        return Network(
            scaled((256, EMBED), 1), scaled((WIDTH, EMBED, FILTERS), WIDTH * EMBED), scaled((WIDTH, FILTERS), WIDTH),
            scaled((FILTERS + 1, HIDDEN), FILTERS), scaled(HIDDEN + 1, HIDDEN),
        )

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.again, self.dense, self.out]

    def tables(self) -> list[np.ndarray]:
        """The response to every window of flags and, for each two neighbouring taps, to every pair of bytes:
        look-ups replace the products."""
        taps = np.einsum("be,tef->tbf", self.embed, self.filters)
        pairs = [(taps[t][:, None] + taps[t + 1][None]).reshape(-1, FILTERS) for t in range(0, WIDTH, 2)]
        return [_BITS @ self.again, *pairs]

    def head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(pooled @ self.dense[:-1] + self.dense[-1])
        return hidden, 1 / (1 + np.exp(-np.clip(hidden @ self.out[:-1] + self.out[-1], -30, 30)))

    def train_step(self, x: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        """The gradients of the mean cross entropy over the chunks ``x``."""
        taps = np.einsum("be,tef->tbf", self.embed, self.filters)
        flags = repeats(x)
        z = (_BITS @ self.again)[windows(flags)]
        for t in range(WIDTH):
            z += taps[t][x[:, t:t + STRIDE * PLACES:STRIDE]]
        best = z.argmax(axis=1)  # chunks x FILTERS
        top = np.take_along_axis(z, best[:, None], 1)[:, 0]
        pooled = np.maximum(top, 0)
        hidden, p = self.head(pooled)
        error = ((p - wanted) / len(x)).astype(np.float32)
        d_out = np.append(hidden.T @ error, error.sum()).astype(np.float32)
        d_hidden = error[:, None] * self.out[:-1] * (1 - hidden**2)
        d_dense = np.vstack([pooled.T @ d_hidden, d_hidden.sum(axis=0)])
        d_top = (d_hidden @ self.dense[:-1].T) * (top > 0)
        # Only the window that won in the pooling has a gradient.
        at = np.arange(len(x))[:, None, None], best[:, :, None] * STRIDE + np.arange(WIDTH)  # chunks x FILTERS x WIDTH
        window = x[at]
        d_again = np.einsum("nft,nf->tf", flags[at].astype(np.float32), d_top)
        d_filters = np.einsum("nfte,nf->tef", self.embed[window], d_top)
        by_byte = np.einsum("nf,tef->nfte", d_top, self.filters).reshape(-1, EMBED)
        d_embed = np.stack([np.bincount(window.ravel(), by_byte[:, e], 256) for e in range(EMBED)], axis=1)
        return [d_embed, d_filters, d_again, d_dense, d_out]


def fit(texts: list[str], good: list[int], epochs: int = 10, max_chunks: int = 24_000, batch: int = 256, seed: int = 7) -> Network:
    """Train on labelled texts. Each chunk learns its text's label; both labels weigh the same.

    If the texts have more than ``max_chunks`` chunks, as many are drawn at random from all of them.
    """
    rng = np.random.default_rng(seed)
    cut = [chunks(t.encode()) for t in texts]
    wanted = np.repeat(np.array(good, np.float32), [len(c) for c in cut]) if cut else np.empty(0, np.float32)
    net = Network.fresh(seed)
    if len(np.unique(wanted)) < 2:
        return net_without_labels(wanted)
    # As many chunks of either label, so that the threshold does not depend on how many were labelled bad.
    sides = [np.flatnonzero(wanted == side) for side in (0, 1)]
    each = min(max_chunks // 2, max(map(len, sides)))
    chosen = np.concatenate([rng.permutation(np.resize(rng.permutation(s), max(each, 1))) for s in sides])
    x = np.concatenate(cut)[chosen]
    y = wanted[chosen]
    # A quarter of the chunks are cut short, so that a short text is judged by what it says.
    short = rng.permutation(len(x))[:len(x) // 4]
    x[short] *= np.arange(CHUNK) < rng.integers(3, 96, len(short))[:, None]
    means = [np.zeros_like(a) for a in net.arrays()]
    squares = [np.zeros_like(a) for a in net.arrays()]
    step, steps = 0, epochs * -(-len(x) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            part = order[i:i + batch]
            step += 1
            rate = 0.01 * (1 - 0.9 * step / steps)
            for a, g, m, s in zip(net.arrays(), net.train_step(x[part], y[part]), means, squares):  # Adam
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                a -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def net_without_labels(wanted: np.ndarray) -> Network:
    """Without two labels to tell apart there is nothing to learn: every text is as good as the labels, or 0.5."""
    net = Network.fresh(0)
    share = float(np.clip(wanted.mean(), 0.01, 0.99)) if len(wanted) else 0.5
    net.out[:-1] = 0
    net.out[-1] = np.log(share / (1 - share))
    return net


def score(texts: list[str], net: Network, tables: list[np.ndarray] | None = None, block: int = 128) -> np.ndarray:
    """The probability of each text that it is good."""
    tables = tables or net.tables()
    encoded = [t.encode() for t in texts]
    cut = [chunks(t) for t in encoded]
    x = np.concatenate(cut) if cut else np.empty((0, CHUNK), np.uint8)
    pooled = np.empty((len(x), FILTERS), np.float32)
    for i in range(0, len(x), block):
        part = x[i:i + block]
        pairs = part[:, ::2].astype(np.int32) * 256 + part[:, 1::2]
        z = tables[0][windows(repeats(part))]
        for t, table in enumerate(tables[1:]):
            z += table[pairs[:, t:t + PLACES]]
        pooled[i:i + block] = z.max(axis=1)
    _, p = net.head(np.maximum(pooled, 0))
    out = np.empty(len(texts))
    at = 0
    for i, (text, c) in enumerate(zip(encoded, cut)):
        weight = np.full(len(c), CHUNK)
        weight[-1] = max(1, len(text) - (len(c) - 1) * STEP)
        out[i] = np.average(p[at:at + len(c)], weights=weight)
        at += len(c)
    return out


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from the training; a null id, which no label names, is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, per_label: int = 1500, max_bytes: int = 32 << 20) -> Network:
    """Fit a network on a bounded sample of the labelled documents.

    ``labels`` has doc_id and quality (1 good, 0 bad; others and nulls count for nothing). Rows that are held
    out are never read. Of each label, the ``per_label`` documents with the smallest hash of their id are
    taken, whole, as long as they add up to ``max_bytes`` of text; a longer one is passed over. Only the
    sample comes to the driver.
    """
    usable = labels.where(~held_out() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("other")
    ).where("quality = other")  # contradicting labels say nothing
    rank = F.xxhash64("doc_id")
    drawn = [usable.where(F.col("quality") == side).orderBy(rank, "doc_id").limit(per_label) for side in (0, 1)]
    sample = drawn[0].unionByName(drawn[1]).select("doc_id", "quality")  # at most 2 * per_label rows
    found = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    # A document id that repeats counts once, with its smallest text.
    found = found.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))
    sized = found.select("*", F.octet_length("text").alias("bytes")).where(F.col("bytes") <= max_bytes // 16)
    rows, held = [], 0
    for row in sized.orderBy(F.xxhash64("doc_id"), "doc_id").toLocalIterator():
        if held + row["bytes"] <= max_bytes:
            held += row["bytes"]
            rows.append(row)
    return fit([r["text"] for r in rows], [r["quality"] for r in rows])


def add_score(df: DataFrame, net: Network, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with ``out``, the probability that its whole text is good, between 0 and 1.

    A null text is scored as an empty one; a text of any length is scored whole, chunk by chunk. Every row comes back
    once, so rows that repeat a document repeat its score; an empty table stays empty. A column that is already
    called ``out`` is an error.
    """
    if out in df.columns:
        raise ValueError(f"there is a column {out!r} already")
    model = df.sparkSession.sparkContext.broadcast(net)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        tables = model.value.tables()
        for batch in slices(batches, text, 1 << 20):
            found = score([t or "" for t in batch[text].to_pylist()], model.value, tables)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def keep_good(df: DataFrame, net: Network, least: float = 0.3, text: str = "text") -> DataFrame:
    """The rows whose text scores ``least`` or more (exactly ``least`` stays), with the columns they came with, whatever
    their names. Rows that repeat a document are judged alike; null texts are judged as empty ones."""
    name = unused(df.columns, "score")
    return add_score(df, net, text, name).where(F.col(name) >= least).drop(name)
