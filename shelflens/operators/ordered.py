"""Global order without a single-task sort: running totals, ranks, quantiles, top-k.

A window without `PARTITION BY` sends every row to one task.  Here the rows are
range-partitioned into slices, the slices are totalled (one row per slice), and
each slice adds up its own rows on top of what the slices before it hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..staging import stage


def value_counts(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Distinct key combinations and how often each occurs.

    Counted before the shuffle, so a value that fills a third of the table
    crosses the network as one row per task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def running_total(
    df: DataFrame,
    order: Sequence[Column],
    weight: str,
    group: Sequence[str] = (),
    out: str = "running",
    total_out: str = "total",
) -> DataFrame:
    """Add `out`, the sum of `weight` up to and including the row, and `total_out`.

    `order` must tell the rows of a group apart: count repeated values first.
    The frame is ROWS.  The slices are written down before they are totalled,
    so both passes see the same cut points.
    """
    group = list(group)
    slices = stage(
        df.repartitionByRange(*[F.col(g) for g in group], *order)
        .withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    per_slice = slices.groupBy(*group, "_slice").agg(F.sum(weight).alias("_sum"))
    # One row per slice and group held by it: no more than the shuffle partitions
    # plus the number of groups.  No broadcast is forced: the window needs the
    # rows by (group, slice) anyway, and that is what the join uses.
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = per_slice.select(
        *group,
        "_slice",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_sum").over(whole).alias(total_out),
    )
    within = (
        Window.partitionBy(*group, "_slice").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        slices.join(offsets, [*group, "_slice"])
        .withColumn(out, F.col("_before") + F.sum(weight).over(within))
        .drop("_slice", "_before")
    )


def average_ranks(counts: DataFrame, value: str, n: str, group: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """Average rank of each distinct value, ties sharing the mean of their places.

    `counts` holds one row per value (and group) with its number of rows `n`.
    """
    ranked = running_total(counts, [F.col(value)], n, group)
    return ranked.select(
        *group,
        value,
        n,
        "total",
        (F.col("running") - F.col(n) + (F.col(n) + 1) / 2.0).alias(out),
    )


def exact_quantile(df: DataFrame, value: str, q: float, group: Sequence[str] = (), out: str = "quantile") -> DataFrame:
    """Exact quantile with linear interpolation, one row per group (nulls left out).

    `percentile` keeps every distinct value of a group in the memory of one
    task; this reads the two neighbours off the running counts.
    """
    counts = value_counts(df.where(F.col(value).isNotNull()), [*group, value])
    ran = running_total(counts, [F.col(value)], "n", group)
    place = F.lit(float(q)) * (F.col("total") - 1)
    before = F.col("running") - F.col("n")

    def at(position: Column) -> Column:
        return F.max(F.when((before <= position) & (position < F.col("running")), F.col(value)))

    found = ran.groupBy(*group).agg(
        at(F.floor(place)).alias("_low"),
        at(F.ceil(place)).alias("_high"),
        F.max(place - F.floor(place)).alias("_share"),
    )
    return found.select(
        *group,
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias(out),
    )


def top_share_threshold(df: DataFrame, value: str, k: Column) -> DataFrame:
    """One row about the first `k` rows by descending `value` (nulls last).

    `k` is an expression over `total`, the number of all rows.  Columns:
    `smallest` (smallest non-null value among the k), `kth` (value of the k-th
    row, null when it is a null), `above` (rows strictly before `kth`), `k`.
    """
    ran = running_total(value_counts(df, [value]), [F.col(value).desc_nulls_last()], "n")
    before = F.col("running") - F.col("n")
    holds_kth = (before < F.col("k")) & (F.col("k") <= F.col("running"))
    return ran.withColumn("k", k).agg(
        F.min(F.when(before < F.col("k"), F.col(value))).alias("smallest"),
        F.max(F.when(holds_kth, F.col(value))).alias("kth"),
        F.max(F.when(holds_kth, before)).alias("above"),
        F.max("k").alias("k"),
    )
