"""Packing by power-of-two decomposition.

Each document's ids are cut into pieces whose lengths are powers of two: as many
of the longest as fit, then the binary digits of the rest, longest first.  A
piece is a sequence of its own and sequences of one length form a bucket, so no
sequence crosses documents and none is padded.  A document is read and cut in
one task: there is no shuffle and nothing to combine.

Defined cases: a null text is empty; an empty text is its end id alone, a
piece of length one; very long texts give as many longest pieces as they need;
a marker of the vocabulary inside a text is the marker's id, as the tokenizer
has it; repeated rows are packed each; an empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from . import textarrays as ta

SEQUENCE = 2048
END_ID = 1
#: Bytes of words and ids that a task remembers; beyond that it begins anew.
CACHE_BYTES = 16 << 20
#: Bytes of text encoded at once: what a slice needs beside its text is many times that.
SLICE_BYTES = 2 << 20
#: A single space between two characters that are not white space.  Byte-level BPE
#: always starts a new word at such a space, so the parts can be encoded apart.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Parts that begin or end with white space, or are empty.
_RAGGED = rf"^\z|^{_SPACE}|{_SPACE}\z"
#: Words of Latin letters, with or without these signs behind, are single words to the tokenizer too.
_SIGNS = ".,;:!?"
_LETTERS = r"[A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+"
_SIMPLE = rf"^{_LETTERS}[{_SIGNS}]*\z"
#: A line break between two such words is a word of its own.
_TWO_LINES = rf"^{_LETTERS}[{_SIGNS}]*\n{_LETTERS}[{_SIGNS}]*\z"


def _byte_signs() -> dict[int, int]:
    """Byte-level BPE writes every byte as a printable character: itself, or the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in plain)}


_BYTE_SIGNS = _byte_signs()


def piece_lengths(total: int, longest: int) -> list[int]:
    """Powers of two, none above `longest`, that add up to `total`, descending."""
    whole, rest = divmod(total, longest)
    return [longest] * whole + [1 << i for i in range(rest.bit_length() - 1, -1, -1) if rest >> i & 1]


class WordEncoder:
    """Ids of texts, encoding each different word once while it is remembered.

    The words are remembered as an Arrow array, found again by Arrow's own
    hash lookup: no Python text is made of a word that is known.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # A text that holds one of the vocabulary's own markers is encoded whole: the marker is no word.
        self._markers = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._model = self._tokenizer.model
        self._signs: dict[str, list[int]] = {}
        self._cache_bytes = cache_bytes
        self.forget()

    def forget(self) -> None:
        self._words = pa.array([], pa.string())
        self._starts, self._ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text."""
        marked = np.zeros(len(texts), bool)
        for marker in self._markers:
            marked |= _flags(pc.match_substring(texts, marker))
        if not marked.any():
            return self._encode_unmarked(texts)
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        plain = np.flatnonzero(~marked)
        for at, ids in zip(plain, self._encode_unmarked(texts.take(pa.array(plain))), strict=True):
            out[at] = ids
        for at in np.flatnonzero(marked):
            out[at] = self._ids_of([texts[int(at)].as_py()])[1]
        return out

    def _encode_unmarked(self, texts: pa.Array) -> list[np.ndarray]:
        if self._words.nbytes + self._starts.nbytes + self._ids.nbytes > self._cache_bytes:
            self.forget()
        cut = pc.split_pattern(texts, " ")
        bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy()
        first = np.zeros(len(code), bool)
        first[bounds[:-1]] = True
        # White space beside a space: such texts are cut only where that is safe.
        ragged = _flags(pc.match_substring_regex(words, _RAGGED))
        texts_of = np.repeat(np.arange(len(texts)), np.diff(bounds))
        careful = np.zeros(len(texts), bool)
        careful[texts_of[ragged[code]]] = True
        careful &= np.diff(bounds) > 1
        after_space = ~first & ~careful[texts_of]
        used = np.zeros(len(words), bool)
        used[code[after_space]] = True
        place = pc.fill_null(pc.index_in(words, value_set=self._words), -1).to_numpy().astype(np.int64)
        fresh = np.flatnonzero(used & (place < 0))
        place[fresh] = len(self._words) + np.arange(len(fresh))
        self._learn(words.take(pa.array(fresh)))
        ids, sizes = self._gather(place[code[after_space]])
        rest = np.split(ids, np.cumsum(np.bincount(texts_of[after_space], sizes, len(texts)).astype(np.int64))[:-1])
        apart = [
            [x if not i else " " + x for i, x in enumerate(_CUT.split(texts[t].as_py()))] if careful[t]
            else [words[int(code[bounds[t]])].as_py()]
            for t in range(len(texts))
        ]
        flat_sizes, flat = self._ids_of(list(chain.from_iterable(apart)))
        ends = np.concatenate([[0], np.cumsum(flat_sizes)])[np.cumsum([0, *map(len, apart)])]
        return [np.concatenate([flat[ends[t]:ends[t + 1]], rest[t]]) for t in range(len(texts))]

    def _learn(self, words: pa.Array) -> None:
        """Remember the words with their ids as they are after a space."""
        simple = _flags(pc.match_substring_regex(words, _SIMPLE))
        two = _flags(pc.match_substring_regex(words, _TWO_LINES))
        sizes, parts, at = np.zeros(len(words), np.int64), [], []

        def held(places: np.ndarray, found: list[list[int]]) -> None:
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            sizes[places] = lengths
            parts.append(np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())))
            at.append(places)

        one = np.flatnonzero(simple)
        held(one, self._simple(words.take(pa.array(one)), "\u0120"))
        pairs = np.flatnonzero(two)
        if len(pairs):
            lines = pc.split_pattern(words.take(pa.array(pairs)), "\n").flatten()
            even = np.arange(0, len(lines), 2)
            left = self._simple(lines.take(pa.array(even)), "\u0120")
            right = self._simple(lines.take(pa.array(even + 1)), "")
            held(pairs, [a + self._known("\n") + b for a, b in zip(left, right, strict=True)])
        odd = np.flatnonzero(~simple & ~two)
        if len(odd):
            lengths, ids = self._ids_of([" " + w for w in words.take(pa.array(odd)).to_pylist()])
            sizes[odd] = lengths
            parts.append(ids)
            at.append(odd)
        # From the order of the kinds back to that of the words.
        order = np.concatenate(at)
        flat = np.concatenate(parts)
        begins = np.zeros(len(words), np.int64)
        begins[order] = np.cumsum(sizes[order]) - sizes[order]
        self._ids = np.concatenate([self._ids, flat[_spans(begins, sizes)]])
        self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes)])
        self._words = pa.concat_arrays([self._words, words])

    def _simple(self, words: pa.Array, lead: str) -> list[list[int]]:
        """Ids of letters with or without signs behind, `lead` before them."""
        stems = pc.utf8_rtrim(words, _SIGNS)
        tokenize = self._model.tokenize
        written = [
            lead + (s if s.isascii() else s.encode().decode("latin-1").translate(_BYTE_SIGNS)) for s in stems.to_pylist()
        ]
        ids = [[t.id for t in tokenize(w)] for w in written]
        lengths = pc.utf8_length(stems).to_numpy()
        for i in np.flatnonzero(lengths < pc.utf8_length(words).to_numpy()).tolist():
            ids[i] = ids[i] + self._known(words[i].as_py()[lengths[i]:])
        return ids

    def _known(self, signs: str) -> list[int]:
        if signs not in self._signs:
            self._signs[signs] = self._ids_of([signs])[1].tolist()
        return self._signs[signs]

    def _ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        found = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return sizes, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, sizes = self._starts[at], self._starts[at + 1] - self._starts[at]
        return self._ids[_spans(starts, sizes)], sizes


def _flags(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(bool)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of every span, one span after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _pieces(
    batches: Iterator[pa.RecordBatch], encoder: WordEncoder, longest: int, end_id: int, names: list[str],
) -> Iterator[pa.RecordBatch]:
    """A batch of pieces per slice of the documents (id, text)."""
    # A worker goes from stage to stage and keeps what it freed unless told otherwise.
    pool = pa.default_memory_pool()
    pool.release_unused()
    for batch in batches:
        for part in ta.slices(batch, 1, SLICE_BYTES):
            rows: list[int] = []
            start, length, total, held = [], [], [], []
            for row, ids in enumerate(encoder.encode(part.column(1).fill_null(""))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                at = 0
                for size in piece_lengths(len(ids), longest):
                    rows.append(row)
                    start.append(at)
                    length.append(size)
                    total.append(len(ids))
                    held.append(ids[at:at + size].tobytes())
                    at += size
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(rows, pa.int64())), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(total, pa.int64()), pa.array(held, pa.binary())],
                names=names,
            )
            pool.release_unused()


def pack(
    docs: DataFrame, tokenizer: str, longest: int = SEQUENCE, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row per piece: `doc_id`, `start`, `length`, `ids` (little-endian unsigned 32-bit), `doc_tokens`,
    `bucket` (the length's power), `sequence_id`, `offset` (always 0: a piece is a whole sequence).

    `tokenizer` is the path of a byte-level BPE file of the tokenizers library.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    schema = T.StructType([
        narrow.schema["doc_id"],
        *[T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens")],
        T.StructField("ids", T.BinaryType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        yield from _pieces(batches, encoder, longest, end_id, schema.names)
        encoder.forget()

    pieces = narrow.mapInArrow(cut, schema)
    return pieces.select(
        "doc_id", "start", "length", "ids", "doc_tokens",
        F.log2(F.col("length").cast("double")).cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "bucket",
    )
