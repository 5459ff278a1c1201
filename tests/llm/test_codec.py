"""Byte-level BPE against the tokenizer library, with chunks far shorter than the texts."""

from __future__ import annotations

import base64
import hashlib
import random

import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from shelflens.llm import bpe_codec, queries

RANKS, PATTERN = public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN
SIGNS = [
    " ", " ", "  ", "\n", "\t", " ", "　", "\x1c", "'s", "'ll", "'r", "'", "a", "word", "é", "中文",
    "7", "٣", "42", "!", "...", "\U0001f600", "é", "՘", "࢏", "\U00011de0", "<|endoftext|>", "\x00",
]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("library", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts():
    rng = random.Random(11)
    mixed = ["".join(rng.choices(SIGNS, k=rng.randint(0, 400))) for _ in range(60)]
    runs = [c * n for c in ("a", " ", "\n", "!", "中", "ab ", "1") for n in (63, 64, 65, 200, 1000)]
    between = ["x " * 40 + " " * n + "y" * 90 + "'ll'" + "z" * n for n in (20, 64, 130, 500)]
    return [None, "", " ", *mixed, *runs, *between, mixed[0], mixed[0]]


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (200, 50), (32_768, 512)])
def test_ids_and_bytes(spark, library, chunk, overlap):
    texts = _texts()
    rows = [(None if i == 3 else i, t, "x", -1) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string, chunk int").repartition(4)
    found = bpe_codec.encode(frame, RANKS, PATTERN, chunk=chunk, overlap=overlap)
    got = {r.doc_id: list(r.ids) for r in found.collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t, _, _ in rows}
    bytes_of = {r.doc_id: bytes(r.decoded) for r in bpe_codec.decode(found, RANKS, PATTERN).collect()}
    assert bytes_of == {i: (t or "").encode() for i, t, _, _ in rows}


def test_digests(spark, library):
    texts = _texts()[:12]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    digests = bpe_codec.codec_digests(bpe_codec.encode(frame, RANKS, PATTERN), RANKS, PATTERN)
    for r in digests.collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_very_long_texts(spark, library):
    """Runs beyond any chunk, and beyond what the engine's stack holds."""
    words = "".join(random.Random(1).choices(["word", " ", "  ", "\n", "don't ", "中"], k=200_000))
    texts = [words, "ab" * 150_000, " " * 1_200_000 + "x", words + " " * 70_000 + words]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = bpe_codec.encode(frame, RANKS, PATTERN)
    got = {r.doc_id: list(r.ids) for r in found.collect()}
    assert got[0] == library.encode_ordinary(words)
    assert got[1] == library.encode_ordinary(texts[1])
    assert got[2] == [*library._encode_single_piece(" " * 1_199_999), *library.encode_ordinary(" x")]
    assert library.decode_bytes(got[3]) == texts[3].encode() and got[3][:100] == got[0][:100]
    assert [bytes(r.decoded) for r in bpe_codec.decode(found, RANKS, PATTERN).orderBy("doc_id").collect()] == [
        t.encode() for t in texts
    ]


def test_chunks_meet(spark):
    """Neighbours are stitched inside the overlap; where they cannot be, they become one chunk."""
    text = "one two three " * 40 + "x" * 300 + " four five" * 40
    narrow = spark.createDataFrame([(1, text)], "doc_id long, text string")
    chunks = bpe_codec.chunked(narrow, 64, 16).cache()
    assert chunks.count() == len(text) // 64 and chunks.agg(F.sum("own")).first()[0] == len(text)
    links = bpe_codec.stitched(chunks, RANKS, PATTERN, 16).orderBy("chunk").collect()
    assert all(r.loose for r in links)
    assert all(0 <= r.end - (i + 1) * 64 < 16 for i, r in enumerate(links) if r.end is not None)
    merged = bpe_codec._merged(chunks, spark.createDataFrame(links)).collect()
    assert len(merged) == 1 + sum(r.end is not None for r in links)
    assert all(r.text == text[r.start:r.start + len(r.text)] and r.own <= len(r.text) for r in merged)


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert bpe_codec.codec_digests(bpe_codec.encode(empty, RANKS, PATTERN), RANKS, PATTERN).collect() == []
    ids = spark.createDataFrame([(1, None), (2, []), (3, [0, 1, 50_255])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in bpe_codec.decode(ids, RANKS, PATTERN).collect()}
    assert got[1] is None and bytes(got[2]) == b"" and bytes(got[3])[:2] == b'!"'
    for bad in (-1, 50_256):
        with pytest.raises(Exception, match="not in the ranks"):
            bpe_codec.decode(spark.createDataFrame([(1, [bad])], "k int, ids array<int>"), RANKS, PATTERN).collect()
    with pytest.raises(ValueError):
        bpe_codec.encode(empty, RANKS, PATTERN, chunk=100, overlap=100)
