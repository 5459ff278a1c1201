"""Centroid clustering with whole-number distances, in JVM expressions.

Components are scaled and floored to whole numbers once and staged.  A round is
one scan: `zip_with` and `aggregate` give the squared distance of a vector to
each centroid of a literal array, `array_min` over (distance, number) chooses,
and column sums per cluster, pre-aggregated in the tasks, give the next
centroids.  Only sums cross the shuffle: a row per cluster and task, whatever
the size of a cluster.  The driver holds the centroids (k rows) and nothing else.

Everything is exact: sums and distances are 64-bit whole numbers, and a centroid
is the floor of its vectors' mean.

Defined cases: vectors that are null, of another length, or with null or non-finite
components take no part; equal rows count each; a vector without an id takes
part, and starts a centroid only if there are too few others; ties go to the
smaller cluster number; a cluster without vectors keeps its centroid; with fewer
than k vectors there are as many centroids as vectors; an empty table gives an
empty result.  A vector whose scaled length exceeds 2**30 has no exact 64-bit
distance: the job fails and says so.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..staging import stage, unstage

Centroids = list[list[int]]
LONGEST = 2.0**30


@dataclass(frozen=True)
class Clustering:
    """`rows`: `vec_id`, `cluster`, `distance` (squared) per vector; `centroids`: the final ones by number."""

    rows: DataFrame
    centroids: Centroids


def whole_vectors(vectors: DataFrame, dim: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """`vec_id`, `v` (floor of scale times component) of the vectors that take part."""
    v = vectors[vector_col]
    sound = v.isNotNull() & (F.size(v) == dim) & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    )
    narrow = vectors.where(sound).select(vectors[id_col].alias("vec_id"), v.cast("array<double>").alias("x"))
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, x: s + (scale * x) * (scale * x)))
    whole = F.transform("x", lambda x: F.floor(scale * x).cast("long"))
    fits = F.when(length <= LONGEST, whole).otherwise(
        F.raise_error(F.lit("a vector is too long for exact 64-bit distances")).cast("array<bigint>")
    )
    return narrow.select("vec_id", fits.alias("v"))


def starting_centroids(whole: DataFrame, k: int, seed: str) -> Centroids:
    """The k vectors with the smallest SHA-256 of `seed:id`, in that order; equal hashes by vector."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = whole.select(place.alias("place"), "v").orderBy(F.col("place").asc_nulls_last(), "v").limit(k)
    return [list(row.v) for row in first.collect()]


def assign(whole: DataFrame, centroids: Centroids) -> DataFrame:
    """The vectors with `distance` to their nearest centroid and its number as `cluster`."""
    nearest = F.array_min(F.transform(
        _literal(centroids),
        lambda c, i: F.struct(squared_distance(F.col("v"), c).alias("distance"), i.alias("cluster")),
    ))
    return whole.withColumn("nearest", nearest).select("vec_id", "v", "nearest.cluster", "nearest.distance")


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0).cast("long"), lambda s, d: s + d)


def moved(assigned: DataFrame, centroids: Centroids) -> Centroids:
    """Each centroid at the floor of its vectors' mean; one without vectors stays."""
    dim = len(centroids[0])
    sums = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dim)]
    )
    after = list(centroids)
    for row in sums.collect():
        after[row.cluster] = [row[f"s{i}"] // row.n for i in range(dim)]
    return after


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: str = "1",
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> Clustering:
    """`rounds` times assignment and update, then a last assignment."""
    if k < 1 or dim < 1:
        raise ValueError("k and dim must be positive")
    whole = stage(whole_vectors(vectors, dim, scale, id_col, vector_col), "whole-vectors")
    centroids = starting_centroids(whole, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(assign(whole, centroids), centroids)
    rows = stage(assign(whole, centroids).select("vec_id", "cluster", "distance"), "clusters")
    unstage(whole)
    return Clustering(rows, centroids)


def clustering_report(found: Clustering) -> DataFrame:
    """The rows with `cluster_inertia`, `inertia` and `centroid_sha256` (of the components joined by commas)."""
    per_cluster = [0] * len(found.centroids)
    for row in found.rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect():
        per_cluster[row.cluster] = row.s
    sums = ", ".join(f"{s}L" for s in per_cluster)
    names = ", ".join(f"'{_sha256(c)}'" for c in found.centroids)
    return found.rows.select(
        "vec_id", "cluster", "distance",
        F.expr(f"array({sums})")[F.col("cluster")].cast("long").alias("cluster_inertia"),
        F.lit(sum(per_cluster)).cast("long").alias("inertia"),
        F.expr(f"array({names})")[F.col("cluster")].cast("string").alias("centroid_sha256"),
    )


def _sha256(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def _literal(centroids: Centroids) -> Column:
    """The centroids as one constant, an array of arrays."""
    listed = ", ".join("array(" + ", ".join(f"{x}L" for x in c) + ")" for c in centroids)
    return F.expr(f"array({listed})").cast("array<array<bigint>>")
