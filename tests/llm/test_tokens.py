"""Token files and byte-level BPE against the libraries' own encoders."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cardlens.llm import byte_bpe, token_files
from odd import docs_of, odd_rows  # noqa: F401 (fixtures)

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)


PIECES = [" ", "  ", "\n", "\t", "\x1c", "\x85", "　", "a", "Bc", "é", "1", "²", "Ⅷ", "'s", "'ll", "!", "?", "中", "🙂", "_", "the", "ing."]
texts = st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PIECES), max_size=30).map("".join), st.text("abctheing ", max_size=300))


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4))
def test_byte_bpe_equals_the_library(encoder, reference, some):
    some = [t.encode("utf-8", "replace").decode() for t in some]
    expected = [np.array(reference.encode_ordinary(t), "<u4").tobytes() for t in some]
    assert encoder.encode(some) == expected


def test_a_long_match_is_merged_as_the_library_does(ranks, reference):
    for text in ("ab" * 4000, "the" * 1500, "xyzzy"):
        assert byte_bpe.merge(text.encode(), ranks) == reference.encode_ordinary(text)


def test_encode_and_decode_frames(spark, docs_of, odd_rows, ranks, reference):
    df = docs_of(odd_rows)
    encoded = byte_bpe.encode(df, ranks, public_tokenizers.PATTERN)
    assert encoded.columns == [*df.columns, "ids"]
    for row in encoded.collect():
        assert np.frombuffer(row["ids"], "<u4").tolist() == reference.encode_ordinary(row["text"] or "")
    decoded = byte_bpe.decode(encoded, ranks).collect()
    assert len(decoded) == len(odd_rows)
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in decoded)
    both = byte_bpe.encode_and_decode(df, ranks, public_tokenizers.PATTERN)
    assert both.columns == [*(c for c in df.columns if c != "text"), "ids", "decoded"]
    rows_of = lambda frame, *columns: sorted(tuple(map(str, (r[c] for c in columns))) for r in frame.collect())
    assert rows_of(both, "doc_id", "ids") == rows_of(encoded, "doc_id", "ids")
    assert sorted(bytes(r["decoded"]) for r in both.collect()) == sorted(bytes(r["decoded"]) for r in decoded)
    assert byte_bpe.encode(df.limit(0), ranks, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.encode(df, ranks, public_tokenizers.PATTERN, out="score")


@settings(max_examples=150, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4))
def test_word_encoder_equals_the_library(some):
    some = [t.encode("utf-8", "replace").decode() for t in some]
    with open(WORDS, encoding="utf-8") as file:
        ours = token_files._encoder(file.read())
    library = test_word_encoder_equals_the_library.library
    expected = [np.array(library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in some]
    assert ours.encode(some) == expected


test_word_encoder_equals_the_library.library = Tokenizer.from_file(WORDS)


def test_token_files_round_trip(spark, docs_of, odd_rows, tmp_path):
    df = docs_of(odd_rows)
    manifest = token_files.write_token_files(df, str(tmp_path / "t"), WORDS, end_id=1).orderBy("part").collect()
    library = Tokenizer.from_file(WORDS)
    start, seen = 0, []
    for row in sorted(token_files.read_token_files(spark, str(tmp_path / "t"), 2).collect(), key=lambda r: r["start"]):
        assert row["start"] == start
        start += len(row["ids"]) // 4
        seen.append((row["doc_id"], zlib.crc32(row["ids"])))
    assert [d for d, _ in seen] == sorted((d for d, _ in odd_rows), key=lambda d: (d is not None, d or 0))
    expected = [
        (d, zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()))
        for d, t in odd_rows
    ]
    assert sorted(seen, key=str) == sorted(expected, key=str)
    ends = [(m["first_document"] + m["documents"], m["first_id"] + m["ids"]) for m in manifest]
    assert [(m["first_document"], m["first_id"]) for m in manifest] == [(0, 0), *ends[:-1]]
    assert ends[-1] == (len(odd_rows), start)


def test_token_files_of_an_empty_table(spark, docs_of, tmp_path):
    token_files.write_token_files(docs_of([]), str(tmp_path / "e"), WORDS)
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_words_forgotten_in_between_are_encoded_alike():
    texts = ["one two three, four", "two 5ive naïve one.", "", "  gap\ttab ", "one two three, four", "six seven one"]
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    for make in (
        lambda limit: byte_bpe.Encoder(ranks, public_tokenizers.PATTERN, limit),
        lambda limit: token_files.WordEncoder(tokenizer, limit),
    ):
        short = make(1)
        assert [short.encode([t])[0] for t in texts] == make(10**6).encode(texts)
