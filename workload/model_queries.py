"""Split, imputation, metrics and the price forest."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from shelflens.operators import imputation
from shelflens.operators.split import split_part
from shelflens.plans import price_model
from shelflens.staging import stage

from . import tree_sql
from .registry import products, query

_BUCKET = "CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) % 10000"
_ID = "CAST(id AS VARCHAR)"
PART = f"""CASE WHEN {_BUCKET.format(key=_ID)} < 3000 THEN 'holdout'
    WHEN {_BUCKET.format(key=_ID + " || '|dev'")} < 2000 THEN 'test' ELSE 'train' END"""
_SPLIT = f"split AS (SELECT *, {PART} AS part FROM products WHERE price >= 0)"

_NUMERIC = ("reviews_count", "log_quantity_sold", "rating_average", "star_5_percent", "star_1_percent")
_CATEGORICAL = ("primary_category_path", "brand_or_author", "brand_name", "categories", "category",
                "badges_new_has_authentic_badge", "is_top_brand", "name", "current_seller")


@query("split_counts", f"""
WITH {_SPLIT} SELECT part, COUNT(*) AS "rows", CAST(SUM(id) AS BIGINT) AS ids FROM split GROUP BY part""")
def split_counts(spark, sf_dir):
    rows = products(spark, sf_dir).where("price >= 0").select("id", split_part(F.col("id")).alias("part"))
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"))


@query("imputation_values", f"WITH {_SPLIT} " + " UNION ALL ".join(
    [f"""SELECT '{c}' AS feature, CAST(round((SELECT quantile_cont(CAST({c} AS DOUBLE), CAST(0.5 AS DOUBLE))
      FROM split WHERE part = 'train'), 6) AS VARCHAR) AS value""" for c in _NUMERIC]
    + [f"""SELECT '{c}' AS feature, (SELECT CAST({c} AS VARCHAR) FROM split WHERE part = 'train' AND {c} IS NOT NULL
      GROUP BY {c} ORDER BY COUNT(*) DESC, CAST({c} AS VARCHAR) LIMIT 1) AS value""" for c in _CATEGORICAL]
))
def imputation_values(spark, sf_dir):
    table = price_model.model_table(products(spark, sf_dir))
    train = table.where("part = 'train'").drop("part")
    values = price_model.imputation_values(train, list(_NUMERIC), list(_CATEGORICAL))
    number = F.round(F.when(F.col("feature").isin(*_NUMERIC), F.col("value")).cast("double"), 6).cast("string")
    return values.select("feature", F.coalesce(number, "value").alias("value"))


@query("regression_metrics", f"""
WITH {_SPLIT}, logged AS (SELECT *, ln(1 + CAST(price AS DOUBLE)) AS log_price FROM split),
means AS (SELECT brand_name, AVG(log_price) AS mean FROM logged WHERE part = 'train' GROUP BY brand_name),
guessed AS (
  SELECT part, CAST(price AS DOUBLE) AS y, exp(coalesce(mean, (SELECT AVG(log_price) FROM logged WHERE part = 'train'))) - 1 AS p
  FROM logged LEFT JOIN means ON logged.brand_name = means.brand_name WHERE part <> 'train')
SELECT part, COUNT(*) AS "rows", round(AVG(abs(y - p)), 4) AS mae, round(sqrt(AVG((y - p) * (y - p))), 4) AS rmse,
  round(1 - SUM((y - p) * (y - p)) / (VAR_POP(y) * COUNT(*)), 6) AS r2
FROM guessed GROUP BY part""")
def regression_metrics(spark, sf_dir):
    """Evaluation of a plain predictor: the brand's mean log price."""
    places = {"mae": 4, "rmse": 4, "r2": 6}
    return price_model.evaluate(_plain(spark, sf_dir)).withColumns({c: F.round(c, n) for c, n in places.items()})


def _plain(spark, sf_dir):
    """Every row outside the training part with the brand's mean as its predicted price."""
    table = price_model.model_table(products(spark, sf_dir))
    train = table.where("part = 'train'")
    means = train.groupBy("brand_name").agg(F.avg("log_price").alias("mean"))
    return table.where("part <> 'train'").join(means, "brand_name", "left").select(
        "id", "part", F.col("price").alias("actual_price"),
        F.expm1(F.coalesce("mean", train.agg(F.avg("log_price")).scalar())).alias("predicted_price"),
    )


_GUESSED = f"""{_SPLIT}, logged AS (SELECT *, ln(1 + CAST(price AS DOUBLE)) AS log_price FROM split),
means AS (SELECT brand_name, AVG(log_price) AS mean FROM logged WHERE part = 'train' GROUP BY brand_name),
guessed AS (
  SELECT id, part, price AS actual_price,
    exp(coalesce(mean, (SELECT AVG(log_price) FROM logged WHERE part = 'train'))) - 1 AS predicted_price
  FROM logged LEFT JOIN means ON logged.brand_name = means.brand_name WHERE part <> 'train')"""


@query("plain_holdout_predictions", f"""
WITH {_GUESSED} SELECT id, actual_price, round(predicted_price, 4) AS predicted_price FROM guessed WHERE part = 'holdout'""")
def plain_holdout_predictions(spark, sf_dir):
    """The holdout's rows with the plain predictor's prices."""
    return _plain(spark, sf_dir).where("part = 'holdout'").select(
        "id", "actual_price", F.round("predicted_price", 4).alias("predicted_price")
    )


@query("plain_actual_vs_predicted", f"""
WITH {_GUESSED}, points AS (
  SELECT ln(1 + CAST(actual_price AS DOUBLE)) AS log_actual, ln(1 + predicted_price) AS log_predicted
  FROM guessed WHERE part = 'holdout')
SELECT round(log_actual, 6) AS log_actual, round(log_predicted, 6) AS log_predicted,
  round((SELECT least(MIN(log_actual), MIN(log_predicted)) FROM points), 6) AS diagonal_from,
  round((SELECT greatest(MAX(log_actual), MAX(log_predicted)) FROM points), 6) AS diagonal_to
FROM points""")
def plain_actual_vs_predicted(spark, sf_dir):
    points = price_model.actual_vs_predicted(_plain(spark, sf_dir).where("part = 'holdout'"))
    return points.select(*[F.round(c, 6).alias(c) for c in points.columns])


def _numbered(ordered):
    """The rows with their place in the order they come in (a handful: one per feature)."""
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return ordered.withColumn("place", place)


_WEIGHTS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM split WHERE {c} IS NOT NULL" for c in _CATEGORICAL
)
_KNOWN = f"{_SPLIT}, weights AS ({_WEIGHTS}), known AS (SELECT feature, COUNT(*) AS n FROM weights GROUP BY feature)"


def _known(spark, sf_dir):
    """Known values per feature: a slot per category, weighed by its rows, rolled up."""
    table = price_model.model_table(products(spark, sf_dir))
    counts = imputation.category_counts(table, list(_CATEGORICAL))
    rolled = price_model.importance_by_feature(
        counts.select(F.col("feature").alias("original_feature"), F.col("n").cast("double").alias("importance"))
    )
    return rolled


def _as_counts(ordered):
    return _numbered(ordered).select(
        F.col("original_feature").alias("feature"), F.col("importance").cast("long").alias("n"), "place"
    )


@query("known_values", f"""
WITH {_KNOWN} SELECT *, CAST(row_number() OVER (ORDER BY n DESC, feature) AS INTEGER) AS place FROM known""")
def known_values(spark, sf_dir):
    return _as_counts(_known(spark, sf_dir))


@query("known_values_bars", f"""
WITH {_KNOWN} SELECT *, CAST(row_number() OVER (ORDER BY n, feature DESC) AS INTEGER) AS place FROM known""")
def known_values_bars(spark, sf_dir):
    return _as_counts(price_model.importance_bars(_known(spark, sf_dir)))


# ---- the forest on the real price, in a form that SQL can grow too ----
# One-hot slots, no bagging and a cut between any two values: every tree is the same greedy tree.

TREE_NUMERIC, TREE_CATEGORICAL = ("reviews_count", "name_has_combo"), ("brand_name", "is_top_brand", "badges_new_has_authentic_badge")
TREE_DEPTH = 3
_TREE_VIEW = _SPLIT.replace("SELECT *,", "SELECT *, CASE WHEN name LIKE '%combo%' THEN 1 ELSE 0 END AS name_has_combo,")
_TREE = f"{_TREE_VIEW}, {tree_sql.tree(TREE_NUMERIC, TREE_CATEGORICAL, TREE_DEPTH)}"

_FORESTS: dict = {}


def _forest(spark, sf_dir):
    """The forest and its table; one fit per application and folder."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _FORESTS:
        table = price_model.model_table(products(spark, sf_dir), features=(*TREE_NUMERIC, *TREE_CATEGORICAL))
        table = stage(table, "price_table")
        model = price_model.fit_price_model(
            table.where("part = 'train'"), trees=3, depth=TREE_DEPTH, encoding="one_hot", bagging=False, bins=128
        )
        _FORESTS[key] = model, table
    return _FORESTS[key]


def _forest_predictions(spark, sf_dir):
    model, table = _forest(spark, sf_dir)
    return price_model.predict(model, table.where("part <> 'train'"))


def _priced(predictions):
    return predictions.withColumn("predicted_price", F.round("predicted_price", 4))


@query("holdout_predictions", f"""
WITH {_TREE} SELECT id, actual_price, round(predicted_price, 4) AS predicted_price FROM predicted WHERE part = 'holdout'""")
def holdout_predictions(spark, sf_dir):
    """The holdout's rows with the forest's prices."""
    return _priced(_forest_predictions(spark, sf_dir)).where("part = 'holdout'").select("id", "actual_price", "predicted_price")


@query("forest_holdout_predictions", f"""
WITH {_TREE} SELECT id, part, {", ".join((*TREE_NUMERIC, *TREE_CATEGORICAL))}, actual_price,
  round(predicted_price, 4) AS predicted_price
FROM predicted JOIN (SELECT * EXCLUDE (part) FROM split) USING (id)""")
def forest_holdout_predictions(spark, sf_dir):
    """Every row the forest was not grown on, with its features as they were."""
    return _priced(_forest_predictions(spark, sf_dir))


def _points(where):
    return f"""points AS (SELECT ln(1 + CAST(actual_price AS DOUBLE)) AS log_actual, ln(1 + predicted_price) AS log_predicted
  FROM predicted WHERE {where})
SELECT round(log_actual, 6) AS log_actual, round(log_predicted, 6) AS log_predicted,
  round((SELECT least(MIN(log_actual), MIN(log_predicted)) FROM points), 6) AS diagonal_from,
  round((SELECT greatest(MAX(log_actual), MAX(log_predicted)) FROM points), 6) AS diagonal_to
FROM points"""


def _rounded_points(predictions):
    points = price_model.actual_vs_predicted(predictions)
    return points.select(*[F.round(c, 6).alias(c) for c in points.columns])


@query("actual_vs_predicted", f"WITH {_TREE}, {_points("part = 'holdout'")}")
def actual_vs_predicted(spark, sf_dir):
    return _rounded_points(_forest_predictions(spark, sf_dir).where("part = 'holdout'"))


@query("forest_actual_vs_predicted", f"WITH {_TREE}, {_points("part <> 'train'")}")
def forest_actual_vs_predicted(spark, sf_dir):
    return _rounded_points(_forest_predictions(spark, sf_dir))


_ERRORS = """COUNT(*) AS "rows", round(AVG(abs(actual_price - predicted_price)), 4) AS mae,
  round(sqrt(AVG((actual_price - predicted_price) * (actual_price - predicted_price))), 4) AS rmse,
  round(1 - SUM((actual_price - predicted_price) * (actual_price - predicted_price)) / (VAR_POP(CAST(actual_price AS DOUBLE)) * COUNT(*)), 6) AS r2"""
_PLACES = {"mae": 4, "rmse": 4, "r2": 6}


@query("forest_metrics", f"WITH {_TREE} SELECT part, {_ERRORS} FROM predicted WHERE part <> 'train' GROUP BY part")
def forest_metrics(spark, sf_dir):
    """MAE, RMSE and R2 of the forest on the real price, per part."""
    found = price_model.evaluate(_forest_predictions(spark, sf_dir))
    return found.withColumns({c: F.round(c, n) for c, n in _PLACES.items()})


@query("forest_evaluation", f"""
WITH {_TREE} SELECT part, {_ERRORS}, TRUE AS all_positive, TRUE AS importances_add_up
FROM predicted WHERE part <> 'train' GROUP BY part""")
def forest_evaluation(spark, sf_dir):
    """The errors, and what must hold of any forest's predictions and importances; grown anew at every call."""
    _FORESTS.pop((spark.sparkContext.applicationId, sf_dir), None)
    importances = price_model.feature_importance(*_forest(spark, sf_dir)).agg(F.sum("importance").alias("total"))
    scored = stage(_forest_predictions(spark, sf_dir), "scored")
    positive = scored.groupBy("part").agg(F.min(F.col("predicted_price") > 0).alias("all_positive"))
    return price_model.evaluate(scored).join(positive, "part").select(
        "part", "rows", *[F.round(c, n).alias(c) for c, n in _PLACES.items()], "all_positive",
        (F.abs(importances.select("total").scalar() - 1) < 1e-9).alias("importances_add_up"),
    )


def _importances(spark, sf_dir):
    return price_model.feature_importance(*_forest(spark, sf_dir))


def _rounded_importances(ordered):
    return _numbered(ordered).withColumn("importance", F.round("importance", 5))


_FALLING = f"""
WITH {_TREE} SELECT original_feature, round(importance, 5) AS importance,
  CAST(row_number() OVER (ORDER BY importance DESC, original_feature) AS INTEGER) AS place FROM importances"""
_RISING = f"""
WITH {_TREE} SELECT original_feature, round(importance, 5) AS importance,
  CAST(row_number() OVER (ORDER BY importance, original_feature DESC) AS INTEGER) AS place FROM importances"""


@query("feature_importance", _FALLING)
def feature_importance(spark, sf_dir):
    return _rounded_importances(_importances(spark, sf_dir))


@query("importance_bars", _RISING)
def importance_bars(spark, sf_dir):
    return _rounded_importances(price_model.importance_bars(_importances(spark, sf_dir)))


@query("forest_feature_importance", f"""{_FALLING.replace("SELECT original_feature,", "SELECT (SELECT MAX(node) FROM cuts) AS last_cut, original_feature,")}""")
def forest_feature_importance(spark, sf_dir):
    """Importances, and the heap number of the last cut of the tree itself."""
    model, _ = _forest(spark, sf_dir)
    return _rounded_importances(_importances(spark, sf_dir)).withColumn("last_cut", F.lit(_last_cut(model)).cast("long"))


def _last_cut(model) -> int:
    """The largest heap number of a cut (1 is the root) in the first tree."""
    tree = model.pipeline.stages[-1].trees[0]._call_java("rootNode")

    def last(node, number):
        if node.subtreeDepth() == 0:
            return 0
        return max(number, last(node.leftChild(), 2 * number), last(node.rightChild(), 2 * number + 1))

    return last(tree, 1)


@query("forest_importance_bars", _RISING)
def forest_importance_bars(spark, sf_dir):
    return _rounded_importances(price_model.importance_bars(_importances(spark, sf_dir)))


# ---- one-hot slots without the driver ----

_SLOT_COLUMNS = ("brand_name", "is_top_brand", "category", "current_seller", "badges_new_has_authentic_badge")
_SLOTS = f"""{_SPLIT}, counts AS ({" UNION ALL ".join(
    f"SELECT {i} AS col, '{c}' AS feature, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n FROM split "
    f"WHERE part = 'train' AND {c} IS NOT NULL GROUP BY {c}" for i, c in enumerate(_SLOT_COLUMNS)
)}), numbered AS (
  SELECT col, feature, value, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1 AS number,
    count(*) OVER (PARTITION BY feature) AS width FROM counts)"""


def _one_hot(spark, sf_dir):
    table = price_model.model_table(products(spark, sf_dir), features=_SLOT_COLUMNS)
    table = stage(table, "slot_table")
    return price_model.fit_layout(table.where("part = 'train'"), kind="one_hot"), table


@query("one_hot_slots", f"WITH {_SLOTS} SELECT feature, value, number, width FROM numbered")
def one_hot_slots(spark, sf_dir):
    """Each category's number among the slots of its column, and the number of slots."""
    layout, _ = _one_hot(spark, sf_dir)
    width = F.create_map(*[F.lit(x) for item in layout.slots.items() for x in item])
    return layout.entries.select("feature", "value", "number", width[F.col("feature")].cast("long").alias("width"))


@query("one_hot_rows", f"""
WITH {_SLOTS}, modes AS (SELECT feature, arg_min(value, number) AS value FROM numbered GROUP BY feature),
widths AS (SELECT col, feature, max(width) AS width FROM numbered GROUP BY col, feature),
places AS (SELECT feature, coalesce(sum(width) OVER (ORDER BY col ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "from",
  sum(width) OVER () AS size FROM widths),
long AS ({" UNION ALL ".join(
    f"SELECT id, '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), (SELECT value FROM modes WHERE feature = '{c}')) AS value "
    f"FROM split WHERE part <> 'train'" for c in _SLOT_COLUMNS
)})
SELECT id, CAST(max(size) AS BIGINT) AS size, string_agg(CAST(CAST("from" + number AS BIGINT) AS VARCHAR), ' ' ORDER BY "from") AS slots
FROM long JOIN places USING (feature) LEFT JOIN numbered USING (feature, value) GROUP BY id""")
def one_hot_rows(spark, sf_dir):
    """The slots set for every row outside the training part; a value the training rows lack sets none."""
    layout, table = _one_hot(spark, sf_dir)
    rows = price_model.feature_slots(layout, table.where("part <> 'train'"))
    slots = F.nullif(F.array_join(F.col("features.indices").cast("array<string>"), " "), F.lit(""))
    return rows.select("id", F.col("features.size").cast("long").alias("size"), slots.alias("slots"))
