"""SimHash near-duplicates by pivot distance tables.

A fingerprint takes the majority of each bit over the XXH64 values of a text's
word shingles.  Two fingerprints link at `max_distance` or fewer differing bits.

Pairs are found through Hamming distances to reference fingerprints.  One base
reference and, for each two-bit segment, the base with that segment flipped:
the difference of these two distances is the distance inside the segment.  A
link changes the distances of at most `max_distance` segments, so of
`max_distance + 2` groups of segments two at least are the same on both sides:
every pair of groups makes one key.  Within a key, pairs whose distances to any
reference (further random ones included) differ by more than `max_distance` are
discarded, and what is left is verified.

Only a spanning forest of the links of a key leaves its task, never all pairs.
A key shared by more than `bucket_rows` fingerprints is handled exactly another
way: every fingerprint is written under itself and all values half the distance
away; two share a value just when they link, and no value gathers more than the
number of such neighbours.

Defined cases: null and empty texts have fingerprint zero, which links like any
other; texts with fewer words than a shingle give one shingle; copies and
repeated rows share a fingerprint, which stands for them once; a group whose
ids are all null has a null component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from ..staging import stage
from . import textarrays as ta
from .components import connected_components

BITS = 64
SEED = 42
SEGMENT = 2
BUCKET_ROWS = 4096
_random = np.random.default_rng(11)
BASE = _random.integers(0, 1 << 63, dtype=np.uint64)
_FLIPS = np.array([0b11 << i for i in range(0, BITS, SEGMENT)], np.uint64)
#: The base, the base with one segment flipped (32), and 15 random references.
REFERENCES = np.concatenate([[BASE], BASE ^ _FLIPS, _random.integers(0, 1 << 63, 15, dtype=np.uint64)])


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits of the shingles' hashes (as an unsigned number)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - n + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends[n - 1:].tolist(), strict=True)], np.uint64
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `text_key` (hash of the text) and `fingerprint` (64 bits in a long) per row."""
    text = docs[text_col].cast("string")
    narrow = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    schema = T.StructType([
        narrow.schema["doc_id"], T.StructField("text_key", T.LongType()), T.StructField("fingerprint", T.LongType()),
    ])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ta.slices(batch, 2):
                found = [fingerprint(t, shingle) for t in part.column(2).to_pylist()]
                marks = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(marks)], names=schema.names
                )

    return narrow.mapInArrow(mark, schema)


def reference_distances(marks: np.ndarray) -> np.ndarray:
    """Table of Hamming distances: a row per fingerprint, a column per reference."""
    return np.bitwise_count(marks[:, None] ^ REFERENCES[None, :]).astype(np.int8)


def table_keys(distances: np.ndarray, max_distance: int) -> np.ndarray:
    """One key for each pair of segment groups, from the distances alone."""
    segments = len(_FLIPS)
    inside = (SEGMENT - (distances[:, 1:segments + 1] - distances[:, :1])) // 2
    groups = np.array_split(np.arange(segments), max_distance + 2)
    keys = []
    for number, pair in enumerate(combinations(groups, 2)):
        columns = np.concatenate(pair)
        weights = (SEGMENT + 1) ** np.arange(len(columns), dtype=np.int64)
        keys.append(inside[:, columns].astype(np.int64) @ weights + number * (SEGMENT + 1) ** len(columns))
    return np.stack(keys, 1)


def _keyed(marks: DataFrame, max_distance: int) -> DataFrame:
    """`key`, `fingerprint` rows, one for each pair of segment groups."""
    each = comb(max_distance + 2, 2)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint64)
            keys = table_keys(reference_distances(values), max_distance)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(values.view(np.int64), each))], names=["key", "fingerprint"]
            )

    return marks.mapInArrow(emit, "key long, fingerprint long")


def _forest(marks: np.ndarray, max_distance: int) -> Iterator[tuple[int, int]]:
    """Links that connect what the links among `marks` connect: discard by references, then verify."""
    table = reference_distances(marks).astype(np.int16)
    label = np.arange(len(marks))
    for i in range(1, len(marks)):
        near = np.abs(table[:i] - table[i]).max(axis=1) <= max_distance
        left = np.flatnonzero(near)
        left = left[np.bitwise_count(marks[left] ^ marks[i]) <= max_distance]
        if len(left):
            groups, first = np.unique(label[left], return_index=True)
            for j in left[first]:
                yield int(marks[j]), int(marks[i])
            label[np.isin(label, groups)] = i
            label[i] = i


def _links_in_buckets(buckets: DataFrame, max_distance: int) -> DataFrame:
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for members in batch.column(0):
                marks = np.array(members.as_py(), np.int64).view(np.uint64)
                found += _forest(np.unique(marks), max_distance)
            ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    return buckets.mapInArrow(link, "a long, b long")


def _links_by_midpoints(marks: DataFrame, max_distance: int) -> DataFrame:
    """Exact links of very large buckets: values within half the distance, shared."""
    bits = [1 << i if i < 63 else -(1 << 63) for i in range(BITS)]
    flips = [0]
    for size in range(1, max_distance // 2 + 1):
        for chosen in combinations(bits, size):
            value = 0
            for bit in chosen:
                value ^= bit
            flips.append(value)
    spread = F.array(*[F.lit(x).cast("long") for x in flips])
    near = marks.select(
        "fingerprint", F.explode(F.transform(spread, lambda x: x.bitwiseXOR(F.col("fingerprint")))).alias("middle")
    )
    least = near.groupBy("middle").agg(F.min("fingerprint").alias("a"))
    return (
        near.join(least, "middle").where("fingerprint != a")
        .select("a", F.col("fingerprint").alias("b")).distinct()
    )


def fingerprint_classes(
    marks: DataFrame, max_distance: int = 2, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """`fingerprint`, `component` (a fingerprint of the class) for fingerprints that link to another.

    `marks` has one column, `fingerprint`.  Those without a link are not returned.
    """
    if max_distance < 0 or max_distance % 2:
        raise ValueError("max_distance must be an even number of bits")
    single = stage(marks.distinct(), "fingerprints")
    keyed = _keyed(single, max_distance)
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(keyed.join(sizes, "key"), "shared-keys")
    buckets = shared.where(F.col("n") <= bucket_rows).groupBy("key").agg(F.collect_list("fingerprint").alias("members"))
    large = shared.where(F.col("n") > bucket_rows).select("fingerprint").distinct()
    links = _links_in_buckets(buckets.select("members"), max_distance).union(_links_by_midpoints(large, max_distance))
    return connected_components(links).select(F.col("node").alias("fingerprint"), "component")


def _with_class(marked: DataFrame, max_distance: int, bucket_rows: int) -> DataFrame:
    """`fingerprint`, `component` for every fingerprint of the table."""
    classes = fingerprint_classes(marked.select("fingerprint"), max_distance, bucket_rows)
    # Counted before the join, so that a much copied text is one row here.
    return (
        marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
        .join(classes, "fingerprint", "left")
        .select("fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component"))
    )


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_distance: int = 2, bucket_rows: int = BUCKET_ROWS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits), `component_id` (smallest id reachable) per row."""
    marked = stage(fingerprints(docs, shingle, id_col, text_col), "marked")
    classed = stage(_with_class(marked, max_distance, bucket_rows), "classed")
    named = classed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    labels = classed.select("fingerprint", "component").join(named, "component")
    return marked.join(labels, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 3, max_distance: int = 2, bucket_rows: int = BUCKET_ROWS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row of each class stays: the smallest id, then the smallest text hash; columns as they were."""
    marked = stage(fingerprints(docs, shingle, id_col, text_col), "marked")
    classed = _with_class(marked, max_distance, bucket_rows)
    kept = (
        marked.groupBy("doc_id", "text_key", "fingerprint").agg(F.count(F.lit(1)).alias("n"))
        .join(classed.select("fingerprint", "component"), "fingerprint")
        .groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("kept"))
        .select(F.col("kept.doc_id").alias("_id"), F.col("kept.text_key").alias("_key"))
    )
    held = docs.select(
        F.struct("*").alias("row"), docs[id_col].alias("_id"),
        F.xxhash64(docs[text_col].cast("string")).alias("_key"),
    )
    return _first_of_equal(held.alias("d").join(
        kept.alias("k"), F.col("d._id").eqNullSafe(F.col("k._id")) & (F.col("d._key") == F.col("k._key"))
    ).select("row", "d._id", "d._key"))


def _first_of_equal(held: DataFrame) -> DataFrame:
    """One of the rows that agree in id and text."""
    order = Window.partitionBy("_id", "_key").orderBy(F.xxhash64("row"))
    return held.withColumn("_place", F.row_number().over(order)).where("_place = 1").select("row.*")
