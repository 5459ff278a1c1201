"""How strongly columns go together: rank correlation and correlation ratio."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..staging import stage
from .encoding import look_up
from .ordered import average_ranks, value_counts


def spearman(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Spearman correlation of each pair, over the rows where both are known.

    Columns: `a`, `b`, `rho` (null when either side is constant or nothing is
    known), `rows`, `distinct_a` (distinct values of `a` wherever it is known).

    All pairs go through one pass: each row is unfolded into its pairs and
    equal value pairs are counted before the shuffle, which collapses the many
    rows a frequent value has.  Ranks come from the counts.  Only the rank of
    `y` is joined to the value pairs; they are then summed by `x` (per task
    first, so a frequent `x` stays cheap) and its rank is joined to one row per
    value.  A `y` that goes with very many `x` is a skewed join partition,
    which adaptive execution splits.
    """
    counts = stage(_pair_counts(df, pairs), "pairs")
    known = counts.where(F.col("y").isNotNull())
    # Ranks always average (total + 1) / 2, so deviations need no second pass.
    off = F.col("rank") - (F.col("total") + 1) / 2.0
    x_side = average_ranks(known.groupBy("pair", "x").agg(F.sum("n").alias("n")), "x", "n", ["pair"])
    y_side = average_ranks(known.groupBy("pair", "y").agg(F.sum("n").alias("n")), "y", "n", ["pair"])
    x_off = x_side.select("pair", "x", "n", "total", off.alias("dx"))
    y_off = y_side.select("pair", "y", "n", off.alias("dy"))
    by_x = known.join(y_off.drop("n"), ["pair", "y"]).groupBy("pair", "x").agg(
        F.sum(F.col("n") * F.col("dy")).alias("dy")
    )
    y_sums = y_off.groupBy("pair").agg(F.sum(F.col("n") * F.col("dy") * F.col("dy")).alias("yy"))
    sums = (
        x_off.join(by_x, ["pair", "x"]).groupBy("pair").agg(
            F.sum(F.col("dx") * F.col("dy")).alias("xy"),
            F.sum(F.col("n") * F.col("dx") * F.col("dx")).alias("xx"),
            F.max("total").alias("rows"),
        )
        .join(y_sums, "pair")
    )
    spread = F.col("xx") * F.col("yy")
    rho = F.when(spread > 0, F.col("xy") / (F.sqrt("xx") * F.sqrt("yy")))
    distinct = counts.groupBy("pair", "x").agg(F.count(F.lit(1)).alias("_n")).groupBy("pair").agg(
        F.count(F.lit(1)).alias("distinct_a")
    )
    names = _named_pairs(df, pairs)
    # One row per pair on every side.
    return (
        names.join(sums, "pair", "left").join(distinct, "pair", "left")
        .select(
            "a", "b", rho.alias("rho"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
            F.coalesce("distinct_a", F.lit(0)).alias("distinct_a"),
        )
    )


def _pair_counts(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Value pairs (`x` known) of every column pair with their number of rows."""
    unfolded = F.array(*[
        F.struct(
            F.lit(i).alias("pair"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")
        )
        for i, (a, b) in enumerate(pairs)
    ])
    rows = df.select(F.inline(unfolded)).where(F.col("x").isNotNull())
    return rows.groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("n"))


def _named_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """The pairs by number, as the unfolded rows refer to them."""
    named = F.array(*[
        F.struct(F.lit(i).alias("pair"), F.lit(a).alias("a"), F.lit(b).alias("b")) for i, (a, b) in enumerate(pairs)
    ])
    return df.sparkSession.range(1).select(F.inline(named))


def rank_contexts(df: DataFrame, columns: Sequence[str]) -> dict[tuple[str, str], tuple[str, str | None]]:
    """For each ordered pair of columns (a, b): a's values, and the column whose gaps cut them.

    A pair is ranked over the rows where both are known.  Where b is known
    wherever a is, that is a's own ranking (None); columns with the same gaps
    cut alike and share one ranking, named by the first of them.
    """
    pairs = [(a, b) for a in columns for b in columns if a != b]
    if not pairs:
        return {(a, a): (a, None) for a in columns}
    cut = df.selectExpr(*[f"count_if({_name(a)} IS NOT NULL AND {_name(b)} IS NULL)" for a, b in pairs]).first()
    cuts = {pair: cut[i] > 0 for i, pair in enumerate(pairs)} | {(a, a): False for a in columns}
    alike = {b: next(c for c in columns if not cuts[b, c] and not cuts[c, b]) for b in columns}
    return {(a, b): (a, alike[b] if cuts[a, b] else None) for a in columns for b in columns}


def rank_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spearman correlation of all pairs of columns: `a`, `b` (not before `a`), `rho`.

    Each column is ranked once, and once more for every set of other gaps that
    cuts it: a row is unfolded into its rankings, not into its pairs.  Ranks
    come from value counts and go back to the rows in one join; then a single
    aggregation, summed in the tasks, adds up the products of all pairs.
    """
    contexts = rank_contexts(df, columns)
    rankings = {context: f"r{i}" for i, context in enumerate(dict.fromkeys(contexts.values()))}
    values = []
    for (column, cut_by), name in rankings.items():
        value = F.col(column).cast("double") + F.lit(0.0)  # no negative zero
        values.append((value if cut_by is None else F.when(F.col(cut_by).isNotNull(), value)).alias(name))
    table = stage(df.select(F.monotonically_increasing_id().alias("_row"), *values), "rankings")
    names = list(rankings.values())
    long = table.unpivot(["_row"], names, "feature", "value").where(F.col("value").isNotNull())
    ranks = average_ranks(value_counts(long, ["feature", "value"]), "value", "n", ["feature"])
    # Ranks always average (total + 1) / 2.
    off = ranks.select("feature", "value", (F.col("rank") - (F.col("total") + 1) / 2.0).alias("off"))
    found = look_up(table, "_row", names, off, F.col("off"), kind="double")
    # Hundreds of small expressions: as text they reach the JVM in one call each.
    wide = found.selectExpr(*[f"try_element_at(found, '{n}') AS {n}" for n in names])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    sides = {(a, b): (rankings[contexts[a, b]], rankings[contexts[b, a]]) for a, b in pairs}
    products = list(dict.fromkeys([*sides.values(), *[(n, n) for n in names]]))
    sums = wide.selectExpr(*[f"sum({x} * {y}) AS {x}_{y}" for x, y in products])
    rhos = [
        f"CASE WHEN {x}_{x} > 0 AND {y}_{y} > 0 THEN {x}_{y} / (sqrt({x}_{x}) * sqrt({y}_{y})) END" for x, y in sides.values()
    ]
    cells = sums.selectExpr(f"posexplode(array({', '.join(rhos)})) AS (pair, rho)")
    first, second = (F.element_at(F.lit([pair[i] for pair in pairs]), F.col("pair") + 1) for i in (0, 1))
    return cells.select(first.alias("a"), second.alias("b"), "rho")


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def correlation_ratio(df: DataFrame, features: Sequence[str], measure: str) -> DataFrame:
    """Correlation ratio (eta) of each categorical column with a measure.

    Columns: `feature`, `eta` (null without rows, with a single category or
    when the measure is constant), `n_unique` (distinct known values, whether
    or not the measure is known there).

    Category means and squared deviations are kept per task before the shuffle
    on (feature, value), so a category of any size is a few numbers per task.
    """
    y = F.col(measure).cast("double")
    long = df.select(measure, *[F.col(c).cast("string").alias(c) for c in features]).unpivot(
        [measure], list(features), "feature", "value"
    ).where(F.col("value").isNotNull())
    groups = stage(
        long.groupBy("feature", "value").agg(
            F.count(y).alias("n"),
            F.avg(y).alias("mean"),
            (F.var_pop(y) * F.count(y)).alias("within"),
        ),
        "categories",
    )
    measured = groups.where("n > 0")
    means = measured.groupBy("feature").agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("overall")
    )
    # One row per column of the table: small however many rows there are.
    off = F.col("mean") - F.col("overall")
    sums = (
        measured.join(F.broadcast(means), "feature").groupBy("feature").agg(
            F.sum(F.col("n") * off * off).alias("between"),
            F.sum("within").alias("within"),
            F.count(F.lit(1)).alias("categories"),
        )
    )
    total = F.col("between") + F.col("within")
    eta = F.when((F.col("categories") > 1) & (total > 0), F.sqrt(F.col("between") / total))
    unique = groups.groupBy("feature").agg(F.count(F.lit(1)).alias("n_unique"))
    listed = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in features])).alias("feature"))
    return (
        listed.join(unique, "feature", "left").join(sums, "feature", "left")
        .select("feature", eta.alias("eta"), F.coalesce("n_unique", F.lit(0)).alias("n_unique"))
    )
