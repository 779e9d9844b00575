"""Token ids of a corpus as flat binary files that can be memory-mapped.

A part is three files: ``.ids`` holds the ids of its documents one after the other, unsigned 16-bit
integers if the vocabulary allows and else 32-bit; ``.offsets`` holds where each document starts and where
the last one ends, and ``.docs`` holds the document ids, both as 64-bit integers. All are little-endian. The
parts follow each other in ascending document id. A manifest, a Parquet table with one row a part, gives each
part's file, its documents and ids, and its bases: the prefix sums over the parts before it.
"""

from __future__ import annotations

import os
import re
import string
import sys
import uuid
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlens.llm.common import Remembered, as_strings, kept, listed, packed_words, slices, split, unused

_MANIFEST = "part int, file string, documents long, ids long, first_document long, first_id long, width int"
# Latin letters that no normalisation of Unicode composes or splits; signs and digits that may follow them.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_SIGNS = string.digits + string.punctuation
_LETTERS_FIRST = re.compile(f"({_LETTERS.pattern})([{re.escape(_SIGNS)}].*)?", re.DOTALL).fullmatch
# Stands for a null document id in a ``.docs`` file.
NO_ID = -(2**63)


class WordEncoder:
    """Encodes texts with a tokenizer that never joins text across a space or a line feed and drops both.

    Such a text's ids are those of its words in a row, so each word is encoded once and remembered. Past
    ``limit`` words those in memory become the older ones, and only what is met again is carried over, so
    common words stay and rare ones go. If the tokenizer also keeps a run of Latin letters as it is but for its case, spells it
    byte by byte and parts it from a sign or digit behind it, which is tried out on a probe, a word's first letters and
    the rest are encoded on their own, and the letters go to the tokenizer's model at once.
    """

    def __init__(self, tokenizer: str, limit: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(tokenizer)
        self.vocabulary = self._tokenizer.get_vocab_size()
        self.width = 2 if self.vocabulary <= 1 << 16 else 4
        self._known = Remembered(limit)
        self._rests = Remembered(limit // 2)  # what stands behind the letters
        self._spelled: dict[int, str] = {}  # the character that stands for each byte of a run of letters
        self._parts_letters = self._keeps_letters()

    def _keeps_letters(self) -> bool:
        normalizer, cutter = self._tokenizer.normalizer, self._tokenizer.pre_tokenizer
        if normalizer is None or cutter is None or self._tokenizer.post_processor is not None:
            return False

        def cut(text: str) -> list[str]:
            return [p for p, _ in cutter.pre_tokenize_str(normalizer.normalize_str(text))]

        for letter in filter(_LETTERS.fullmatch, map(chr, range(256))):
            raw, spelled = letter.lower().encode(), cut(letter)
            if len(spelled) != 1 or len(spelled[0]) != len(raw):
                return False
            self._spelled.update(zip(raw, spelled[0]))
        letters = "".join(filter(_LETTERS.fullmatch, map(chr, range(256))))
        return cut(letters) == [self._spell(letters)] and all(
            cut(f"{run}{sign}{run}")[0] == self._spell(run) for run in ("az", "é") for sign in _SIGNS
        )

    def _spell(self, run: str) -> str:
        return run.lower() if run.isascii() else run.lower().encode().decode("latin-1").translate(self._spelled)

    def _learn_letters(self, runs: set[str]) -> None:
        known, spell = self._known, self._spell
        tokenize, pack = self._tokenizer.model.tokenize, self._pack
        for run in runs:
            known[run] = pack([t.id for t in tokenize(spell(run))])

    def _learn(self, words: list[str], known: dict[str, bytes]) -> None:
        found = self._tokenizer.encode_batch_fast(words, add_special_tokens=False)
        pack = self._pack
        known.update((w, pack(e.ids)) for w, e in zip(words, found))

    def _pack(self, ids: list[int]) -> bytes:
        numbers = array("H" if self.width == 2 else "I", ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        return numbers.tobytes()

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text, packed. A word is looked up once, however often the texts hold it."""
        ends, numbers, words = split(pa.compute.replace_substring(as_strings(texts), "\n", " "))
        words = listed(words)
        self._known.age()
        self._rests.age()
        new = self._known.unknown(set(words))
        if self._parts_letters:
            letters = set(filter(_LETTERS.fullmatch, new))
            cut = {w: parts.groups("") for w, parts in ((w, _LETTERS_FIRST(w)) for w in new - letters) if parts}
            self._learn_letters(letters | self._known.unknown({run for run, _ in cut.values()}))
            self._learn(list(self._rests.unknown({rest for _, rest in cut.values()})), self._rests)
            self._known.update((w, self._known[run] + self._rests[rest]) for w, (run, rest) in cut.items())
            new -= letters | cut.keys()
        self._learn(list(new), self._known)
        return packed_words(list(map(self._known.__getitem__, words)), numbers, ends, self.width)


def _encoder(tokenizer: str) -> WordEncoder:
    return kept(("words", tokenizer), lambda: WordEncoder(tokenizer))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def read_array(path: str, kind: str, start: int, stop: int) -> np.ndarray:
    """Numbers ``start`` to ``stop`` of a flat file: mapped where the store is mounted, else read."""
    store, name = _open(path)
    if stop <= start:
        return np.empty(0, kind)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(name, kind, "r")[start:stop]
    width = np.dtype(kind).itemsize
    with store.open_input_file(name) as file:
        return np.frombuffer(file.read_at((stop - start) * width, start * width), kind)


def write_token_files(
    df: DataFrame, path: str, tokenizer: str, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode the documents, write them to ``path`` in ascending id and return the manifest.

    ``tokenizer`` is the file of a tokenizer as ``WordEncoder`` describes; its content goes to the tasks.
    ``end_id`` is put behind each document. A null text is empty; null ids come first; documents of one id
    keep the order of the input, and copies of a row are all kept. Other columns are left out. Rows are dealt
    to the tasks by ranges of id and then of a number of the row, so one task holds one range of the output
    and rows that repeat an id are spread too. A task writes under a name of its own and hands that name over with its result, so
    files of failed or repeated attempts are never read. An empty table has an empty manifest.
    """
    with open(tokenizer, encoding="utf-8") as file:
        content = df.sparkSession.sparkContext.broadcast(file.read())
    row = unused([doc_id, text], "row")
    ordered = (
        df.select(F.col(doc_id).cast("long").alias(doc_id), text, F.monotonically_increasing_id().alias(row))
        .repartitionByRange(doc_id, row).sortWithinPartitions(doc_id, row).select(doc_id, text)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        end = b"" if end_id is None else end_id.to_bytes(encoder.width, "little")
        part = TaskContext.get().partitionId()
        store, root = _open(path)
        name = f"{root}/part-{part:05d}-{uuid.uuid4().hex}"
        documents, offsets = [], [0]
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{name}.ids") as out:
            for batch in slices(batches, text, 4 << 20):
                documents += [NO_ID if d is None else d for d in batch[doc_id].to_pylist()]
                for ids in encoder.encode(pa.compute.fill_null(batch[text], "")):
                    out.write(ids + end)
                    offsets.append(offsets[-1] + (len(ids) + len(end)) // encoder.width)
        for kind, numbers in (("offsets", offsets), ("docs", documents)):
            with store.open_output_stream(f"{name}.{kind}") as out:
                out.write(np.array(numbers, "<i8").tobytes())
        if documents:
            row = [part, name.rpartition("/")[2], len(documents), offsets[-1], encoder.width]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32()))],
                ["part", "file", "documents", "ids", "width"],
            )

    # One row a part comes to the driver, whatever the number of documents.
    parts = sorted(map(tuple, ordered.mapInArrow(run, "part int, file string, documents long, ids long, width int").collect()))
    bases = zip(accumulate((p[2] for p in parts), initial=0), accumulate((p[3] for p in parts), initial=0))
    manifest = [(*p[:4], *base, p[4]) for p, base in zip(parts, bases)]
    spark = df.sparkSession
    spark.createDataFrame(manifest, _MANIFEST).coalesce(1).write.parquet(f"{path}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str, documents_per_task: int = 4096) -> DataFrame:
    """The documents of ``path``: doc_id, start (ids before it in the whole corpus), ids (packed, 32 bits)."""
    runs = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("documents") - 1, F.lit(documents_per_task).cast("long"))).alias("begin")
    )
    schema = "doc_id long, start long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                stop = min(r["begin"] + documents_per_task, r["documents"])
                name = f"{path}/{r['file']}"
                offsets = read_array(f"{name}.offsets", "<i8", r["begin"], stop + 1)
                documents = read_array(f"{name}.docs", "<i8", r["begin"], stop).tolist()
                ids = read_array(f"{name}.ids", f"<u{r['width']}", int(offsets[0]), int(offsets[-1]))
                local = (offsets - offsets[0]).tolist()
                for i in range(0, len(documents), 256):
                    ends = local[i:i + 257]
                    some = documents[i:i + 256]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([None if d == NO_ID else d for d in some], pa.int64()),
                            pa.array(offsets[i:i + len(some)] + r["first_id"], pa.int64()),
                            pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                        ],
                        ["doc_id", "start", "ids"],
                    )

    # The rows of ``runs`` are few and small, but each stands for thousands of documents: deal them out.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(tasks, "part", "begin").mapInArrow(run, schema)


