"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text of up to `CHUNK_BYTES` is encoded where it lies.  A longer one is cut into
chunks that overlap, dealt over the tasks and pre-tokenised apart.  A chunk may
begin inside a pre-token, so its first boundaries can be wrong; but what follows
a boundary does not depend on what lies before it.  So the first boundary in the
overlap that two neighbours share is where they resynchronise: there the texts
are stitched, every chunk is left with whole pre-tokens, and the pieces are
encoded in parallel.  Neighbours that share no boundary (a run of one class
longer than the overlap) are merged and tried again, as often as needed.
Only boundaries are compared across chunks; a task holds a chunk, not a text,
until a document's ids are put together.

Ids are those of the tiktoken library for the same ranks and pattern, without
special tokens.  Decoding concatenates the bytes of the ids.

The pattern must be one that depends on nothing before a match (no lookbehind, no
anchors) and names characters by \\s, \\p{L}, \\p{N}, their negations, and ASCII.

Defined cases: a null text is empty; an empty text has no ids and decodes to no
bytes; texts of any length are encoded whole; repeated rows are encoded each; a
row without an id is kept; an empty table gives an empty result; null ids decode to null;
an id outside the ranks fails the job.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from ..staging import stage
from . import textarrays as ta

CHUNK = 32_768  # characters
CHUNK_BYTES = CHUNK
OVERLAP = 512
#: Characters that decide a boundary may lie this far behind it (the longest contraction).
AHEAD = 4
#: Pieces longer than this are encoded one pre-token at a time.
LONG_PIECE = 1 << 18
SLICE_BYTES = 2 << 20
_BLOCK = 1 << 19


class _Signs(dict):
    """Maps a character to one that stands for its class, as the tokenizer's own engine sees it."""

    def __init__(self) -> None:
        super().__init__((c, c) for c in range(128))
        single = {bytes([i]): i for i in range(256)}
        self._probes = [
            (tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={}), ord(sign))
            for name, sign in ((r"\s", "\n"), (r"\p{L}", "a"), (r"\p{N}", "0"))
        ]

    def __missing__(self, char: int) -> int:
        text = chr(char)
        self[char] = next((sign for probe, sign in self._probes if probe.encode_ordinary(text)), ord("!"))
        return self[char]


class Codec:
    """Ranks and pattern, ready to encode and decode."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._pattern = regex.compile(pattern)
        self._signs = _Signs()
        known = np.zeros(max(ranks.values(), default=-1) + 1, bool)
        self._sizes = np.zeros(len(known), np.int64)
        held = [b""] * len(known)
        for token, rank in ranks.items():
            known[rank], self._sizes[rank], held[rank] = True, len(token), token
        self._known = known
        self._begins = np.concatenate([[0], np.cumsum(self._sizes)])
        self._bytes = np.frombuffer(b"".join(held), np.uint8)

    def boundaries(self, text: str) -> np.ndarray:
        """Where each pre-token of the text begins."""
        return np.fromiter((m.start() for m in self._pattern.finditer(text.translate(self._signs))), np.int64)

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= LONG_PIECE:
            return np.array(self._encoding.encode_ordinary(text), np.int32)
        # The engine's stack does not hold very long runs; pre-tokens can be encoded without it.
        spans = (m.span() for m in self._pattern.finditer(text.translate(self._signs)))
        found = [np.array(self._encoding._encode_single_piece(text[a:b]), np.int32) for a, b in spans]
        return np.concatenate([np.zeros(0, np.int32), *found])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, one after another, and where those of each id begin."""
        if len(ids) and not (ids.min() >= 0 and ids.max() < len(self._known) and self._known[ids].all()):
            raise ValueError("an id is not in the ranks")
        begins = np.concatenate([[0], np.cumsum(self._sizes[ids])]).astype(np.int64)
        out = np.empty(begins[-1], np.uint8)
        at = 0
        for start in range(0, len(ids), _BLOCK):
            block = ids[start:start + _BLOCK]
            sizes = self._sizes[block]
            ends = np.cumsum(sizes)
            place = np.arange(ends[-1]) + np.repeat(self._begins[block] - (ends - sizes), sizes)
            out[at:at + len(place)] = self._bytes[place]
            at += len(place)
        return out, begins


@lru_cache(maxsize=2)
def _codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """`doc_id`, `ids` (array of int) for every row."""
    if not 0 < AHEAD < overlap < chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    narrow = docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )
    long = F.octet_length("text") > chunk
    schema = T.StructType([narrow.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for batch in batches:
            for part in ta.slices(batch, 1, SLICE_BYTES):
                ids = [codec.encode(text) for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids)], names=schema.names)

    short = narrow.where(~long).mapInArrow(whole, schema)
    return short.unionByName(_encode_long(narrow.where(long), ranks_path, pattern, chunk, overlap))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *parts])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _encode_long(narrow: DataFrame, ranks_path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    chunks = stage(chunked(narrow, chunk, overlap), "chunks")
    done = []
    while True:
        links = stage(stitched(chunks, ranks_path, pattern, overlap), "links")
        done.append(_encoded(chunks, links.where("NOT loose"), ranks_path, pattern))
        if links.where("loose").isEmpty():
            break
        chunks = stage(_merged(chunks, links.where("loose")), "chunks")
    pieces = done[0]
    for more in done[1:]:
        pieces = pieces.unionByName(more)
    together = pieces.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("parts")
    )
    return together.select("doc_id", F.flatten(F.col("parts.ids")).alias("ids"))


def chunked(narrow: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """A row per chunk, dealt out: `row` (a number for the text), `doc_id`, `chunk`, `start`, `own` (characters
    before the next chunk begins), `text` (own characters and the overlap)."""
    schema = T.StructType([
        T.StructField("row", T.LongType()), narrow.schema["doc_id"], T.StructField("chunk", T.LongType()),
        T.StructField("start", T.LongType()), T.StructField("own", T.LongType()), T.StructField("text", T.StringType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py()
                # The last chunk takes the remainder, so none is shorter than the overlap.
                starts = range(0, max(len(text) // chunk, 1) * chunk, chunk)
                ends = [*starts[1:], len(text)]
                for first in range(0, len(starts), 64):
                    of, to = starts[first:first + 64], ends[first:first + 64]
                    same = pa.array([i] * len(of))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(same), batch.column(1).take(same),
                         pa.array(range(first, first + len(of)), pa.int64()), pa.array(of, pa.int64()),
                         pa.array([b - a for a, b in zip(of, to, strict=True)], pa.int64()),
                         pa.array([text[a:b + overlap] for a, b in zip(of, to, strict=True)], pa.string())],
                        names=schema.names,
                    )

    numbered = narrow.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return numbered.mapInArrow(cut, schema).repartition("row", "chunk")


def stitched(chunks: DataFrame, ranks_path: str, pattern: str, overlap: int) -> DataFrame:
    """Per chunk, in characters of the whole text: `begin` and `end` of the whole pre-tokens it is left with
    (`end` null: to the end of the text), `run` (chunks of one run must be merged), and whether its text has
    neighbours that do not meet (`loose`)."""
    schema = "row long, chunk long, head array<long>, tail array<long>"

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for batch in batches:
            heads, tails = [], []
            for start, own, text in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                at = codec.boundaries(text)
                heads.append(start + at[at < overlap])
                tails.append(start + at[(at >= own) & (at <= len(text) - AHEAD)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                names=["row", "chunk", "head", "tail"],
            )

    one_text = Window.partitionBy("row")
    in_order = one_text.orderBy("chunk")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    met = chunks.select("row", "chunk", "start", "own", "text").mapInArrow(ends, schema).select(
        "row", "chunk",
        F.array_min(F.array_intersect("tail", F.lead("head").over(in_order))).alias("end"),
        F.lead("chunk").over(in_order).isNull().alias("last"),
    )
    return met.select(
        "row", "chunk", "end",
        F.coalesce(F.lag("end").over(in_order), F.lit(0)).alias("begin"),
        F.coalesce(F.count("end").over(before), F.lit(0)).alias("run"),
        F.max(F.col("end").isNull() & ~F.col("last")).over(one_text).alias("loose"),
    )


def _encoded(chunks: DataFrame, links: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """`row`, `doc_id`, `chunk`, `ids` of the whole pre-tokens of each chunk."""
    schema = T.StructType([
        T.StructField("row", T.LongType()), chunks.schema["doc_id"], T.StructField("chunk", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in (3, 4, 5, 6))
            ids = [
                codec.encode(text[begin - start:None if end is None else end - start])
                for start, text, begin, end in zip(*columns, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), _lists(ids)], names=schema.names)

    cut = chunks.join(links, ["row", "chunk"]).select("row", "doc_id", "chunk", "start", "text", "begin", "end")
    return cut.mapInArrow(pieces, schema)


def _merged(chunks: DataFrame, links: DataFrame) -> DataFrame:
    """Chunks that did not meet their neighbours, as one chunk each run."""
    parts = F.array_sort(F.collect_list(F.struct("chunk", "own", "text")))
    runs = chunks.join(links.select("row", "chunk", "run"), ["row", "chunk"]).groupBy("row", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("chunk").alias("chunk"), F.min("start").alias("start"),
        F.sum("own").alias("own"), parts.alias("parts"),
    )
    own = F.transform(
        F.slice("parts", 1, F.size("parts") - 1), lambda p: F.substring(p["text"], F.lit(1), p["own"].cast("int"))
    )
    return runs.select(
        "row", "doc_id", "chunk", "start", "own",
        F.concat(F.array_join(own, ""), F.element_at("parts", -1)["text"]).alias("text"),
    )


def decode(rows: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """The rows with `decoded` (the bytes) in place of the ids."""
    others = [c for c in rows.columns if c != ids_col]
    narrow = rows.select(*others, rows[ids_col].cast("array<int>").alias(ids_col))
    schema = T.StructType([*[narrow.schema[c] for c in others], T.StructField("decoded", T.BinaryType())])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for batch in batches:
            lists = batch.column(len(others))
            start = 0
            counts = np.diff(lists.offsets.to_numpy())
            within = np.concatenate([[0], np.cumsum(counts)])
            while start < len(lists):
                end = max(int(np.searchsorted(within, within[start] + _BLOCK, side="right")) - 1, start + 1)
                part = lists.slice(start, end - start)
                ids = part.flatten().to_numpy(zero_copy_only=False)
                data, begins = codec.decode(ids)
                lengths = begins[np.concatenate([[0], np.cumsum(counts[start:end])])]
                nulls = part.is_null().to_numpy(zero_copy_only=False)
                held = [
                    None if null else data[a:b].tobytes()
                    for a, b, null in zip(lengths[:-1], lengths[1:], nulls, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(start, end - start) for i in range(len(others))), pa.array(held, pa.binary())],
                    names=schema.names,
                )
                start = end

    return narrow.mapInArrow(raw, schema)


def codec_digests(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """`doc_id`, `n_tokens`, `ids_sha256`, `decoded_sha256`: the ids, and the bytes they decode to."""
    digests = encoded.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
    )
    return decode(digests, ranks_path, pattern).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )
