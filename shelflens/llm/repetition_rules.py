"""Quality rules by repetition coverage.

For several n, rolling hashes over the words of a text find every n-gram that
occurs twice or more in it; what counts is the share of the text's word
characters that lie inside such n-grams, and inside lines that repeat an
earlier line.  One pass over the texts, no shuffle: a text is judged alone.

Defined cases: a null text is empty; an empty text has no words and fails the
base rule; repeated rows are judged alike; further columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from . import textarrays as ta

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
REPEAT_WINDOW = 5


@dataclass(frozen=True)
class RepetitionLimits:
    """Largest share of word characters allowed inside repeated n-grams and lines.

    A fifth, as in the base rule: one heading or line that a short text shows
    twice is no reason to drop it.
    """

    ngrams: dict[int, float] = field(default_factory=lambda: dict.fromkeys(range(5, 11), 0.20))
    lines: float = 0.30
    min_words: int = 10
    max_repeat_words_pct: int = 20


#: Limits that fall with n, so that a longer n-gram can reject what the base rule and the 5-grams keep.
FALLING = RepetitionLimits(ngrams={5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}, lines=0.20)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(column: pa.Array, limits: RepetitionLimits) -> dict[str, np.ndarray]:
    """Counts and coverage shares of each text."""
    data, offsets = ta.utf8(column)
    texts = len(offsets) - 1
    starts, ends, doc = ta.words(data, offsets)
    chars = ta.characters(data)
    sizes = chars[ends] - chars[starts]
    out = {
        "n_words": np.bincount(doc, minlength=texts),
        "word_chars": np.bincount(doc, sizes, texts).astype(np.int64),
        "n_symbols": np.bincount(ta.owners(offsets, np.flatnonzero(_SYMBOLS[data])), minlength=texts),
    }
    total = np.maximum(out["word_chars"], 1)
    salt = ta.mix(np.arange(texts, dtype=np.uint64) + np.uint64(1))

    # Lines: those with a word that equal an earlier line of the same text.
    line_start, line_end, line_doc = ta.lines(data, offsets)
    first_word = np.searchsorted(starts, line_start)
    after_word = np.searchsorted(starts, line_end)
    filled = np.flatnonzero(after_word > first_word)
    keys = ta.span_hashes(data, line_start[filled], line_end[filled]) ^ salt[line_doc[filled]]
    again = np.ones(len(filled), bool)
    again[np.unique(keys, return_index=True)[1]] = False
    dup = filled[again]
    out["n_dup_lines"] = np.bincount(line_doc[dup], minlength=texts)
    word_sizes = np.concatenate([[0], np.cumsum(sizes)])
    dup_chars = word_sizes[after_word[dup]] - word_sizes[first_word[dup]]
    out["dup_line_share"] = np.bincount(line_doc[dup], dup_chars, texts) / total

    # N-grams: words inside one that the text holds twice or more.
    items = ta.span_hashes(data, starts, ends)
    out["n_repeat_words"] = np.zeros(texts, np.int64)
    for n, hashes in ta.window_hashes(items, sorted({*limits.ngrams, REPEAT_WINDOW})):
        share = np.zeros(texts)
        if len(hashes):
            whole = np.flatnonzero(doc[: len(hashes)] == doc[n - 1:])
            found = whole[ta.repeated(ta.mix(hashes[whole]) ^ salt[doc[whole]])]
            if len(found):
                inside = ta.covered(len(items), found, n)
                share = np.bincount(doc[inside], sizes[inside], texts) / total
                if n == REPEAT_WINDOW:
                    out["n_repeat_words"] = np.bincount(doc[inside], minlength=texts)
        if n in limits.ngrams:
            out[f"dup_{n}gram_share"] = share
    out["base_failed"] = (out["n_words"] < limits.min_words) | (
        100 * out["n_repeat_words"] > limits.max_repeat_words_pct * out["n_words"]
    )
    out["kept"] = ~out["base_failed"] & (out["dup_line_share"] <= limits.lines)
    for n, most in limits.ngrams.items():
        out["kept"] &= out[f"dup_{n}gram_share"] <= most
    return out


def repetition_report(
    docs: DataFrame, limits: RepetitionLimits = RepetitionLimits(), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: id, counts, coverage shares, `base_failed`, `kept`."""
    shares = ["dup_line_share", *(f"dup_{n}gram_share" for n in sorted(limits.ngrams))]
    verdicts = ["base_failed", "kept"]
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    schema = T.StructType(
        [narrow.schema["doc_id"]]
        + [T.StructField(c, T.LongType()) for c in COUNTS]
        + [T.StructField(c, T.DoubleType()) for c in shares]
        + [T.StructField(c, T.BooleanType()) for c in verdicts]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ta.slices(batch, 1):
                found = measure(part.column(1), limits)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)]
                    + [pa.array(found[c].astype(np.int64)) for c in COUNTS]
                    + [pa.array(found[c].astype(np.float64)) for c in shares]
                    + [pa.array(found[c]) for c in verdicts],
                    names=schema.names,
                )

    return narrow.mapInArrow(judge, schema)


def keep_by_repetition(
    docs: DataFrame, limits: RepetitionLimits = RepetitionLimits(), text_col: str = "text",
) -> DataFrame:
    """The documents that pass, all columns as they were."""
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ta.slices(batch, at):
                yield part.filter(pa.array(measure(part.column(at), limits)["kept"]))

    return docs.mapInArrow(keep, docs.schema)
