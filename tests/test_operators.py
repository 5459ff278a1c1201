"""Operators against brute force on small tables, with hot keys, ties and nulls."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelflens.operators import association, imputation
from shelflens.operators.association import correlation_ratio, spearman
from shelflens.operators.dedup import best_row_per_id
from shelflens.operators.metrics import regression_metrics
from shelflens.operators.ordered import average_ranks, exact_quantile, running_total, top_share_threshold, value_counts
from shelflens.operators.split import split_part


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows share one value in each column; some are unknown."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        x = 0 if i % 3 == 0 else rng.choice([None, rng.randint(0, 40)])
        y = 100 if i % 3 == 1 else rng.choice([None, rng.randint(50, 5000)])
        c = "hot" if i % 3 == 2 else rng.choice([None, f"c{rng.randint(0, 25)}"])
        rows.append((i, x, y, c))
    return rows


@pytest.fixture(scope="module")
def table(spark, skewed):
    return spark.createDataFrame(skewed, "id long, x int, y int, c string").repartition(7)


def frame(skewed):
    return pd.DataFrame(skewed, columns=["id", "x", "y", "c"]).astype({"x": "float", "y": "float"})


def test_running_total(spark, table, skewed):
    counts = value_counts(table.where("y is not null"), ["y"])
    got = {r.y: (r.running, r.total) for r in running_total(counts, [F.col("y").desc()], "n").collect()}
    ys = [r[2] for r in skewed if r[2] is not None]
    assert got == {y: (sum(1 for v in ys if v >= y), len(ys)) for y in set(ys)}


def test_running_total_by_group(spark):
    rows = [(g, v, w) for g in ("a", "b", "c") for v, w in zip(range(50), range(100, 150))]
    df = spark.createDataFrame(rows, "g string, v int, w long")
    got = {(r.g, r.v): r.running for r in running_total(df, [F.col("v")], "w", ["g"]).collect()}
    assert got == {(g, v): sum(100 + i for i in range(v + 1)) for g, v, _ in rows}


def test_average_ranks(table, skewed):
    counts = value_counts(table.where("x is not null"), ["x"])
    got = {r.x: r["rank"] for r in average_ranks(counts, "x", "n").collect()}
    xs = frame(skewed)["x"].dropna()
    assert got == dict(zip(xs.astype(int), xs.rank()))


@pytest.mark.parametrize("q", [0.0, 0.5, 0.8, 1.0])
def test_exact_quantile(table, skewed, q):
    got = exact_quantile(table, "y", q).first().quantile
    assert got == pytest.approx(frame(skewed)["y"].quantile(q))


def test_exact_quantile_without_values(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert exact_quantile(empty, "v", 0.8).first().quantile is None


@pytest.mark.parametrize("k, smallest, kth, above", [(1, 9, 9, 0), (3, 5, 5, 1), (5, 1, 1, 4), (6, 1, None, 5)])
def test_top_share_threshold(spark, k, smallest, kth, above):
    df = spark.createDataFrame([(v,) for v in (5, 9, 5, 5, 1, None, None)], "v int")
    row = top_share_threshold(df, "v", F.lit(k)).first()
    assert (row.smallest, row.kth, row.above) == (smallest, kth, above)


def test_spearman(table, skewed):
    pdf = frame(skewed)
    known = pdf[["x", "y"]].dropna()
    row = spearman(table.withColumn("one", F.lit(1)), [("x", "y"), ("one", "y")]).orderBy("a").collect()
    assert row[0].a == "one" and row[0].rho is None and row[0].distinct_a == 1
    assert row[1].rho == pytest.approx(known["x"].rank().corr(known["y"].rank()))
    assert (row[1].rows, row[1].distinct_a) == (len(known), pdf["x"].nunique())


def test_spearman_of_unknown_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "y int, x double")
    row = spearman(df, [("x", "y")]).first()
    assert (row.rho, row.rows, row.distinct_a) == (None, 0, 0)


def test_correlation_ratio(spark):
    """By hand: y is 1, 3 in a and 5, 7 in b; around the mean 4 the groups' means 2 and 6 give 16 of 20."""
    rows = [("a", 1, "k"), ("a", 3, "k"), ("b", 5, "k"), ("b", 7, "k"), (None, 90, "k"), ("c", None, "k")]
    table = spark.createDataFrame(rows, "c string, y int, k string")
    found = {r.feature: r for r in correlation_ratio(table, ["c", "k"], "y").collect()}
    assert found["c"].eta == pytest.approx(0.894427191)
    assert found["c"].n_unique == 3
    assert found["k"].eta is None and found["k"].n_unique == 1


def test_correlation_ratio_of_constant_measure(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1)], "c string, y int")
    assert correlation_ratio(df, ["c"], "y").first().eta is None


def best(spark, rows):
    columns = "id long, reviews_count long, quantity_sold double, availability int, price long, source_file string"
    df = spark.createDataFrame(rows, columns)
    return {
        parts: sorted(best_row_per_id(df.repartition(parts)).collect(), key=lambda r: (r.id is None, r.id))
        for parts in (1, 5)
    }


def test_best_row_per_id(spark):
    rows = [
        (1, 5, 1.0, 1, 10, "a"), (1, 6, None, None, None, "b"),
        (2, None, 3.0, 1, 10, "a"), (2, None, 3.0, None, 99, "b"),
        (3, 1, 1.0, 1, 5, "b"), (3, 1, 1.0, 1, 5, "a"),
        (None, 1, 1.0, 1, 1, "a"), (None, 2, 1.0, 1, 1, "a"),
    ] + [(7, i, 0.0, 1, 1, "hot") for i in range(300)]
    found = best(spark, rows)
    assert found[1] == found[5]
    assert [(r.id, r.reviews_count, r.source_file) for r in found[1]] == [
        (1, 6, "b"), (2, None, "a"), (3, 1, "a"), (7, 299, "hot"), (None, 2, "a"),
    ]


def test_best_row_without_ranking_columns(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a")], "id int, source_file string")
    assert [r.source_file for r in best_row_per_id(df).collect()] == ["a"]


def test_hot_id_is_cut_down_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1)], "id int, price int")
    plan = best_row_per_id(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")
    assert plan.count("WindowGroupLimit") == 2


def test_split(spark):
    df = spark.range(20000).select("id", split_part(F.col("id")).alias("part"))
    shares = {r.part: r["count"] / 20000 for r in df.groupBy("part").count().collect()}
    assert shares["holdout"] == pytest.approx(0.30, abs=0.02)
    assert shares["test"] == pytest.approx(0.14, abs=0.02)
    assert shares["train"] == pytest.approx(0.56, abs=0.02)
    again = spark.range(20000).repartition(3).select("id", split_part(F.col("id")).alias("part"))
    assert df.exceptAll(again).count() == 0


def metrics(spark, rows):
    df = spark.createDataFrame(rows, "y double, p double")
    return df.agg(*[c.alias(n) for n, c in regression_metrics("y", "p").items()]).first()


def test_metrics(spark):
    row = metrics(spark, [(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)])
    assert (row.mae, row.rmse, row.r2) == (pytest.approx(1.0), pytest.approx((5 / 3) ** 0.5), pytest.approx(1 - 5 / 8))
    assert metrics(spark, [(1.0, 1.0)]).r2 is None
    assert metrics(spark, [(1.0, 1.0), (1.0, 1.0)]).r2 == 1.0
    assert metrics(spark, [(1.0, 2.0), (1.0, 1.0)]).r2 == 0.0


def test_medians_and_modes(spark):
    df = spark.createDataFrame(
        [(1.0, None, "b"), (2.0, None, "a"), (3.0, None, "a"), (10.0, None, "b"), (None, None, None)],
        "n double, void double, c string",
    )
    assert {r.feature: r.median for r in imputation.medians(df, ["n", "void"]).collect()}["n"] == 2.5
    counts = imputation.category_counts(df, ["c"])
    assert {r.feature: r["mode"] for r in imputation.modes(counts).collect()} == {"c": "a"}


def test_rank_correlations(spark):
    """All pairs at once against each pair alone, with gaps, ties, a constant and signed zeros."""
    rng = random.Random(9)
    rows = []
    for i in range(200):
        gap, other = i % 7 == 0, i % 5 == 0
        rows.append((
            rng.randint(0, 5), None if gap else rng.random(), None if gap else rng.randint(0, 3),
            None if other else float(i % 11), 3, rng.choice([0.0, -0.0, 1.5]), None,
        ))
    names = ["a", "b", "c", "d", "constant", "zero", "none"]
    df = spark.createDataFrame(rows, "a int, b double, c long, d double, constant int, zero double, none double").repartition(3)
    got = {(r.a, r.b): r.rho for r in association.rank_correlations(df, names).collect()}
    pairs = [(x, y) for i, x in enumerate(names) for y in names[i:]]
    want = {(r.a, r.b): r.rho for r in association.spearman(df, pairs).collect()}
    assert got.keys() == want.keys()
    for pair, rho in want.items():
        assert got[pair] == (None if rho is None else pytest.approx(rho)), pair


def test_rankings_are_shared(spark):
    """Without gaps a row is unfolded once per column; columns with the same gaps share their rankings."""
    whole = spark.createDataFrame([(i, i * i, -i) for i in range(20)], "a int, b int, c int")
    assert set(association.rank_contexts(whole, ["a", "b", "c"]).values()) == {(c, None) for c in "abc"}
    gaps = whole.withColumns({"b": F.when(F.col("a") > 3, F.col("b")), "c": F.when(F.col("a") > 3, F.col("c"))})
    found = association.rank_contexts(gaps, ["a", "b", "c"])
    assert set(found.values()) == {("a", None), ("a", "b"), ("b", None), ("c", None)}
    assert found["a", "c"] == ("a", "b") and found["c", "a"] == ("c", None)
