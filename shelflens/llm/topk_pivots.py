"""Exact top-k by inner product with a table of pivot distances.

Vectors are lifted to a sphere (one more component makes all candidates equally
long), where the largest inner product is the smallest distance.  Distances of
queries and candidates to the pivots are computed once per block; the largest
difference over all pivots is a lower bound of a pair's distance.  A few queries
go together: candidates are evaluated in the order of the least of their bounds,
for each query until all bounds ahead lie beyond its k-th best distance: the rest
cannot be better, and the result is exact.

Queries and candidates are cut into blocks of bounded size by hash of the id;
each pair of blocks is one group, so a group never grows with the table.

Defined cases: vectors without an id, null, or with null or non-finite components take
no part; rows with equal id and vector count once; a vector is no candidate of
queries with its own id; only vectors of the same length are compared; with
fewer than k candidates all are returned; an empty table gives an empty result.
A vector whose scaled length is 2**31 or more could have products beyond 64 bits:
the job fails and says so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from ..staging import stage

PIVOTS = 32
QUERY_ROWS = 512
CANDIDATE_ROWS = 2048
STEP = 512
#: Queries whose bounds are compared and whose candidates are evaluated in one go.
TOGETHER = 32
#: Scaled vectors below this length have inner products of less than 63 bits.
LONGEST = 2.0**31


def quantised(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """`vec_id`, `dim`, `v` (64-bit whole numbers, floor of scale times component), for vectors that take part."""
    v = vectors[vector_col]
    sound = v.isNotNull() & ~F.exists(
        F.coalesce(v, F.expr("array()")),
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")),
    )
    narrow = vectors.where(sound & vectors[id_col].isNotNull()).select(vectors[id_col].alias("vec_id"), v.cast("array<double>").alias("x"))
    schema = T.StructType([
        narrow.schema["vec_id"], T.StructField("dim", T.IntegerType()), T.StructField("v", T.BinaryType()),
    ])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1)
            sizes = np.diff(x.offsets.to_numpy())
            scaled = np.floor(scale * np.asarray(x.flatten(), np.float64))
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            if np.abs(scaled).max(initial=0) >= LONGEST / max(sizes.max(initial=1), 1) ** 0.5 and any(
                float(np.hypot.reduce(scaled[a:b])) >= LONGEST for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a
            ):
                raise ValueError("a vector is so long that its inner products can exceed 64 bits")
            whole = scaled.astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes.astype(np.int32)),
                 pa.array([whole[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                names=schema.names,
            )

    return narrow.mapInArrow(pack, schema).distinct()


def _matrix(blobs: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<i8").reshape(len(blobs), dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number inner products; in doubles where these are exact, which is faster."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[-1]
    if largest < 2.0**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray,
    pivot_ids: np.ndarray, pivots: np.ndarray, radius2: float, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its number, and ids and scores of the best k of the block that can be in its top k.

    `radius2`: at least the largest squared length of any candidate.
    """
    radius = radius2**0.5 or 1.0
    slack = 1e-4 * radius
    squares = lambda m: (m.astype(np.float64) ** 2).sum(axis=1)
    lift = lambda m: np.sqrt(np.maximum(radius2 - squares(m), 0))
    length = np.sqrt(squares(queries))
    # A query stretched to the radius keeps its ranking.
    stretch = radius / np.where(length > 0, length, 1)
    to_pivots = _products(queries, pivots)
    query_table = np.sqrt(np.maximum(2 * radius2 - 2 * stretch[:, None] * to_pivots, 0)).astype(np.float32)
    row_table = np.sqrt(np.maximum(
        2 * radius2 - 2 * (_products(rows, pivots) + np.outer(lift(rows), lift(pivots))), 0
    )).astype(np.float32)
    columns = np.ascontiguousarray(row_table.T)
    largest = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * rows.shape[1]
    kind = np.float64 if largest < 2.0**52 else np.int64
    exact, asked, none = rows.astype(kind), queries.astype(kind), _none(kind)

    def reach(some: slice, kth: np.ndarray) -> np.ndarray:
        """The distance beyond which no candidate scores `kth`; no limit where there is no k-th score yet."""
        far = np.sqrt(np.maximum(2 * radius2 - 2 * stretch[some] * kth.astype(np.float64), 0)) + slack
        return np.where((kth > none) & (length[some] > 0), far, np.inf)

    for first in range(0, len(queries), TOGETHER):
        some = slice(first, first + TOGETHER)
        own = ids == query_ids[some, None]
        bounds, apart = np.zeros(own.shape, np.float32), np.empty(own.shape, np.float32)
        for p in range(len(pivots)):
            np.subtract(columns[p], query_table[some, p, None], out=apart)
            np.abs(apart, out=apart)
            np.maximum(bounds, apart, out=bounds)
        bounds[own] = np.inf
        # The pivots are rows too: the k-th best of them is a first limit.
        others = np.where(pivot_ids == query_ids[some, None], none, to_pivots[some].astype(kind))
        limit = reach(some, _kth(others, k, none))
        order = np.argsort(bounds.min(axis=0), kind="stable")
        bounds, own = bounds[:, order], own[:, order]
        cuts = [0]
        while cuts[-1] < len(rows):
            cuts.append(min(len(rows), cuts[-1] + (STEP << (len(cuts) - 1))))
        # The least bound of what lies behind each cut.
        ahead = np.minimum.accumulate(np.minimum.reduceat(bounds, cuts[:-1], axis=1)[:, ::-1], axis=1)[:, ::-1]
        scores = np.full(own.shape, none, kind)
        kth = np.full(len(own), none, kind)
        for at, (start, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            going = np.flatnonzero(ahead[:, at] <= limit)
            if not len(going):
                break
            found = asked[some][going] @ exact[order[start:end]].T
            found[own[going, start:end]] = none
            scores[going, start:end] = found
            kth[going] = _kth(scores[going, :end], k, none)
            limit = np.minimum(limit, reach(some, kth))
        which, place = np.nonzero((scores >= kth[:, None]) & (scores > none))
        best, best_id = scores[which, place].astype(np.int64), ids[order[place]]
        ranked = np.lexsort((best_id, -best, which))
        ends = np.searchsorted(which[ranked], np.arange(len(own) + 1))
        for q, (start, end) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            top = ranked[start:min(end, start + k)]
            yield first + q, best_id[top], best[top]


def _none(kind: type) -> float | int:
    """Less than any score."""
    return -np.inf if kind is np.float64 else np.iinfo(np.int64).min


def _kth(scores: np.ndarray, k: int, none: float | int) -> np.ndarray:
    """The k-th largest of every row of scores; `none` where there are fewer."""
    n = scores.shape[1]
    return np.partition(scores, n - k, axis=1)[:, n - k] if n >= k else np.full(len(scores), none, scores.dtype)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, pivots: int = PIVOTS,
    query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score` of each query's best k; ties to the smaller id.

    `is_query` is a condition over `vec_id`.
    """
    table = stage(quantised(vectors, scale, id_col, vector_col).withColumn("is_query", F.coalesce(is_query, F.lit(False))), "vectors")
    spark = table.sparkSession
    by_dim = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "vec_id", "v")
    chosen = {}
    for row in table.withColumn("n", F.row_number().over(by_dim)).where(F.col("n") <= pivots).collect():
        chosen.setdefault(row["dim"], []).append((row["vec_id"], bytes(row["v"])))
    kind = table.schema["vec_id"].dataType
    lengths = table.mapInArrow(_squared_lengths, "dim int, is_query boolean, square double")
    sizes = lengths.groupBy("dim").agg(
        F.max("square").alias("radius2"), F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")
    )
    facts = {r["dim"]: r for r in sizes.collect()}
    spread = sizes.select(
        "dim", F.ceil(F.col("n") / candidate_rows).cast("int").alias("row_blocks"),
        F.ceil(F.col("q") / query_rows).cast("int").alias("query_blocks"),
    )
    known = spark.sparkContext.broadcast((chosen, {d: float(r["radius2"]) for d, r in facts.items()}))

    # Every query goes to each block of rows, every row to each block of queries.
    block = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.greatest(n, F.lit(1))).cast("int")
    placed = table.join(spread, "dim").where("query_blocks > 0")
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = placed.withColumn("row_block", block(F.col("row_blocks"))).withColumn("query_block", up_to("query_blocks"))
    queries = placed.where("is_query").withColumn("query_block", block(F.col("query_blocks"))).withColumn("row_block", up_to("row_blocks"))
    columns = ["dim", "row_block", "query_block", "vec_id", "v"]
    dealt = rows.select(*columns, F.lit(False).alias("asks")).union(queries.select(*columns, F.lit(True).alias("asks")))
    out = T.StructType([
        T.StructField("query_id", kind), T.StructField("query_key", T.LongType()),
        T.StructField("vec_id", kind), T.StructField("score", T.LongType()),
    ])

    def search(group: pa.Table) -> pa.Table:
        dim = group["dim"][0].as_py()
        asks = group["asks"].to_numpy().astype(bool)
        ids = group["vec_id"].to_numpy()
        blobs = np.array(group["v"].to_pylist(), object)
        pivot_rows, radius2 = known.value[0][dim], known.value[1][dim]
        pivot_ids = np.array([i for i, _ in pivot_rows], ids.dtype)
        pivot_matrix = _matrix([b for _, b in pivot_rows], dim)
        found = [(ids[:0], np.zeros(0, np.int64), ids[:0], np.zeros(0, np.int64))]
        if asks.any() and not asks.all():
            query_ids, query_blobs = ids[asks], blobs[asks]
            for q, best, scores in search_block(
                query_ids, _matrix(query_blobs, dim), ids[~asks], _matrix(blobs[~asks], dim),
                pivot_ids, pivot_matrix, radius2, k,
            ):
                key = hash_of(query_blobs[q])
                found.append((np.full(len(best), query_ids[q], ids.dtype), np.full(len(best), key), best, scores))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=out.names)

    # As many tasks as groups: a group is little data but much work, so small ones must not be put together.
    groups = sum(-(-r["n"] // candidate_rows) * -(-r["q"] // query_rows) for r in facts.values())
    keys = ["dim", "row_block", "query_block"]
    per_block = dealt.repartition(max(groups, 1), *keys).groupBy(*keys).applyInArrow(search, out)
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (
        per_block.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def hash_of(blob: bytes) -> int:
    """Tells queries of equal id and different vectors apart."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(blob)).astype(np.int64))


def _squared_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        squares = [float((np.frombuffer(v, "<i8").astype(np.float64) ** 2).sum()) for v in batch.column("v").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("dim"), batch.column("is_query"), pa.array(squares, pa.float64())],
            names=["dim", "is_query", "square"],
        )
