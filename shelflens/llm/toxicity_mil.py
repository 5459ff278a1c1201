"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the bag has a label.  A sentence's
probability is logistic in its hashed features (whole words, and the five-byte
runs inside words, which catch inflected forms); a document's is the noisy-or
of its sentences: 1 - prod(1 - p).  The weights are learned from document labels
through the noisy-or, so that blame falls on the sentences that explain the
label, and the same weights then point at the offending sentences.

Learning uses at most `sample` labelled documents per label, those with the
smallest id hashes; it runs in one task over that bounded sample.  Scoring is
one pass over all whole texts; what is sent to the tasks is the weight vector,
whose size is fixed by `bits`.

Defined cases: null and empty texts have no sentence and score 0; labels that
are null or neither 0 nor 1, and rows labelled both ways, are not learned from;
without examples of both labels every score is 0; a null id is never held out
nor learned from; repeated rows are scored alike, and of an id with several texts
the one with the smallest hash is learned from; texts of any length are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import textarrays as ta

BITS = 18
SAMPLE = 3000
RUN = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, and text number of each sentence with content."""
    cuts = np.flatnonzero(_ENDS[data]) + 1
    bounds = np.unique(np.concatenate([offsets, cuts]))
    starts, ends = bounds[:-1], bounds[1:]
    if not len(starts):
        return starts, ends, starts
    filled = np.add.reduceat(_LETTER[_LOWER[data]].astype(np.int64), starts) > 0
    starts, ends = starts[filled], ends[filled]
    return starts, ends, ta.owners(offsets, starts)


def features(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and the number of the sentence each stands in, once per place."""
    low = _LOWER[data]
    inside = _LETTER[low]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    last[begins[1:] - 1] = inside[begins[1:] - 1]
    word_at, word_end = np.flatnonzero(first), np.flatnonzero(last) + 1
    whole = ta.span_hashes(low, word_at, word_end)
    runs = np.zeros(len(data), np.int64)
    np.cumsum(inside, out=runs)
    word_of = np.cumsum(first)
    at = np.arange(max(len(data) - RUN + 1, 0))
    ok = inside[at] & (runs[at + RUN - 1] - runs[at] == RUN - 1) & (word_of[at] == word_of[at + RUN - 1])
    at = at[ok]
    part = ta.span_hashes(low, at, at + RUN) ^ np.uint64(0x5851F42D4C957F2D)
    places = np.concatenate([word_at, at])
    hashed = (np.concatenate([whole, part]) >> np.uint64(64 - bits)).astype(np.int64)
    return hashed, np.searchsorted(starts, places, side="right") - 1


def _log_none(z: np.ndarray) -> np.ndarray:
    """log(1 - sigmoid(z))"""
    return -np.logaddexp(0.0, z)


class NoisyOr:
    """Sentence weights with a noisy-or over the sentences of a document."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.bits = len(weights).bit_length() - 1

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Score per text; first byte, end, text number and probability of each sentence."""
        starts, ends, doc = sentences(data, offsets)
        hashed, sentence = features(data, offsets, starts, self.bits)
        z = self.bias + np.bincount(sentence, self.weights[hashed], len(starts))
        none = np.bincount(doc, _log_none(z), len(offsets) - 1)
        return -np.expm1(none), starts, ends, doc, np.exp(-np.logaddexp(0.0, -z))


def fit_noisy_or(texts: pa.Array, labels: np.ndarray, bits: int = BITS, epochs: int = 12, rate: float = 0.3,
                 penalty: float = 1e-4, evidence: float = 4.5, seed: int = 5) -> NoisyOr:
    """Adaptive gradient steps on the documents' log-likelihood, documents in batches.

    Used are the features that toxic documents of the sample hold more often
    than others, by `evidence` standard errors of the difference: a noisy-or
    needs causes, and the many features without a say would drown them in long texts.
    The leak of a sentence without any starts low, for the same reason.
    """
    data, offsets = ta.utf8(texts)
    starts, _, doc = sentences(data, offsets)
    hashed, sentence = features(data, offsets, starts, bits)
    size = 1 << bits
    pairs = np.unique(doc[sentence] * size + hashed)
    toxic = labels[pairs // size] == 1
    with_toxic = np.bincount(pairs[toxic] % size, minlength=size)
    with_clean = np.bincount(pairs[~toxic] % size, minlength=size)
    n_toxic, n_clean = (labels == 1).sum(), (labels != 1).sum()
    share = (with_toxic + with_clean + 1) / (len(labels) + 2)
    error = np.sqrt(share * (1 - share) * (1 / n_toxic + 1 / n_clean))
    keep = ((with_toxic / n_toxic - with_clean / n_clean) > evidence * error)[hashed]
    hashed, sentence = hashed[keep], sentence[keep]
    order = np.argsort(sentence, kind="stable")
    hashed, sentence = hashed[order], sentence[order]
    first_sentence = np.searchsorted(doc, np.arange(len(labels) + 1))
    first_feature = np.searchsorted(sentence, np.arange(len(starts) + 1))
    weights, speed = np.zeros(size), np.full(size, 1e-3)
    bias, bias_speed = -8.0, 1e-3
    random = np.random.default_rng(seed)
    balance = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    for _ in range(epochs):
        for chosen in np.array_split(random.permutation(len(labels)), max(1, len(labels) // 64)):
            held = np.concatenate([np.arange(first_sentence[d], first_sentence[d + 1]) for d in chosen] or [[]]).astype(int)
            if not len(held):
                continue
            counts = first_feature[held + 1] - first_feature[held]
            local = np.repeat(np.arange(len(held)), counts)
            at = np.arange(counts.sum()) + np.repeat(first_feature[held] - (np.cumsum(counts) - counts), counts)
            own = hashed[at]
            z = bias + np.bincount(local, weights[own], len(held))
            place = np.searchsorted(np.sort(chosen), doc[held])
            back = np.argsort(chosen)
            total = -np.expm1(np.bincount(place, _log_none(z), len(chosen)))
            total = np.clip(total, 1e-6, 1.0)
            y = labels[chosen][back]
            # d log-likelihood / dz of a sentence: p (1 - P) / P where the label is 1, else -p.
            pull = np.where(y == 1, (1 - total) / total, -1.0) * balance[chosen][back]
            step = np.exp(-np.logaddexp(0.0, -z)) * pull[place]
            used, inverse = np.unique(own, return_inverse=True)
            gradient = np.bincount(inverse, step[local], len(used)) / len(chosen) - penalty * weights[used]
            speed[used] += gradient**2
            weights[used] += rate * gradient / np.sqrt(speed[used])
            flat = step.sum() / len(chosen)
            bias_speed += flat**2
            bias += 0.1 * rate * flat / np.sqrt(bias_speed)
    return NoisyOr(weights.astype(np.float32), float(bias))


def held_out(id_col: Column) -> Column:
    """Rows whose label must not be learned."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> NoisyOr:
    """Weights learned from at most `sample` documents of each label outside the held-out fold."""
    label = labels[label_col].cast("int")
    known = (
        labels.select(labels[id_col].alias("_id"), label.alias("y"))
        .where(F.col("_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("_id")))
        .groupBy("_id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top")
    )
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(docs[id_col].alias("_doc"), docs[text_col].cast("string").alias("text"))
    bag = texts.join(chosen, F.col("_doc") == F.col("_id")).groupBy("_id").agg(
        # An id with several texts is learned from one of them, the same in every run.
        F.min(F.struct(F.xxhash64("text").alias("order"), "text"))["text"].alias("text"), F.min("y").alias("y")
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=pa.schema([("text", pa.string()), ("y", pa.int32())]))
        table = table.combine_chunks()
        y = table["y"].to_numpy().astype(np.int64)
        if not 0 < y.sum() < len(y):
            return
        model = fit_noisy_or(table["text"].chunk(0), y, bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.astype("<f4").tobytes()]), pa.array([model.bias])], names=["weights", "bias"]
        )

    row = (
        bag.select("text", F.col("y").cast("int").alias("y"), "_id").repartition(1).sortWithinPartitions("_id")
        .select("text", "y").mapInArrow(fit, "weights binary, bias double").first()
    )
    if row is None:
        return NoisyOr(np.zeros(1 << bits, np.float32), -float("inf"))
    return NoisyOr(np.frombuffer(row["weights"], "<f4"), row["bias"])


def score_documents(
    docs: DataFrame, model: NoisyOr, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """`doc_id`, `score`, and the byte span and probability of the sentence most to blame (null without one)."""
    known = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    schema = T.StructType([
        narrow.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("worst_start", T.LongType()),
        T.StructField("worst_end", T.LongType()), T.StructField("worst_score", T.DoubleType()),
    ])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = NoisyOr(*known.value)
        for batch in batches:
            for part in ta.slices(batch, 1):
                data, offsets = ta.utf8(part.column(1))
                scores, starts, ends, doc, p = own.score(data, offsets)
                order = np.lexsort((starts, -p, doc))
                top = order[np.unique(doc[order], return_index=True)[1]]
                at = np.full(part.num_rows, -1)
                at[doc[top]] = top
                none = at < 0
                pick = lambda x: pa.array(
                    np.zeros(len(at), x.dtype) if not len(x) else x[np.maximum(at, 0)], mask=none
                )
                shift = offsets[:-1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores),
                     pa.array(np.where(none, 0, (starts[at] if len(starts) else 0) - shift), mask=none),
                     pa.array(np.where(none, 0, (ends[at] if len(ends) else 0) - shift), mask=none), pick(p)],
                    names=schema.names,
                )

    return narrow.mapInArrow(score, schema)


def offending_sentences(
    docs: DataFrame, model: NoisyOr, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """`doc_id`, `sentence`, `score` for every sentence with a probability of `least` or more."""
    known = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    schema = T.StructType([
        narrow.schema["doc_id"], T.StructField("sentence", T.StringType()), T.StructField("score", T.DoubleType()),
    ])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = NoisyOr(*known.value)
        for batch in batches:
            for part in ta.slices(batch, 1):
                data, offsets = ta.utf8(part.column(1))
                _, starts, ends, doc, p = own.score(data, offsets)
                at = np.flatnonzero(p >= least)
                found = [data[a:b].tobytes().decode().strip() for a, b in zip(starts[at], ends[at], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc[at])), pa.array(found, pa.string()), pa.array(p[at])],
                    names=schema.names,
                )

    return narrow.mapInArrow(locate, schema)
