"""Price prediction: features, split, random forest, evaluation, importances."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, StringType

from ..functions.names import name_features
from ..operators import imputation
from ..operators.encoding import as_vectors, category_numbers, dense, look_up, one_hot
from ..operators.metrics import regression_metrics
from ..operators.split import split_part
from ..schema import MODEL_FEATURES
from ..staging import stage, unstage
from . import screening

TARGET = "price"

# ---- fixed values: the forest ----
TREES, DEPTH, SEED = 300, 30, 42  # 30 is the deepest tree the library grows

FOLDS = 5  # parts of the training rows whose category means leave each other out
PRIOR_ROWS = 5.0  # rows of the overall mean that every category mean is mixed with


ENCODINGS = ("target_mean", "one_hot")


@dataclass(frozen=True)
class Layout:
    """How a row becomes a feature vector: numbers first, then the columns of categories.

    `fills` holds a fill value and `slots` the number of slots per feature.
    `entries` says what a category stands for: `feature`, `value` and, one-hot,
    its `number` among the column's slots; otherwise `total` and `n` of its log
    prices and `folds`, the same for each training fold.
    """

    encoding: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    fills: dict
    slots: dict[str, int]
    entries: DataFrame | None = None
    overall: float = 0.0


@dataclass(frozen=True)
class PriceModel:
    """A fitted forest and the layout of its feature vectors."""

    pipeline: PipelineModel
    layout: Layout


def add_name_features(products: DataFrame) -> DataFrame:
    """Sizes and keywords read from the name, where there is one."""
    return products.withColumns(name_features(F.col("name"))) if "name" in products.columns else products


def selected_features(products: DataFrame, key: str = "id", target: str = TARGET) -> tuple[str, ...]:
    """Columns whose association with the target reaches the threshold, on the training rows alone.

    One name per column comes to the driver.
    """
    train = products.where(F.col(target) >= 0).where(split_part(F.col(key)) == "train")
    chosen = screening.selected_features(screening.association_table(train, target))
    return tuple(sorted(row.feature for row in chosen.collect()))


def model_table(
    products: DataFrame, key: str = "id", features: tuple[str, ...] = MODEL_FEATURES, target: str = TARGET
) -> DataFrame:
    """Key, features, target, `log_price` and split part of the rows with a valid target."""
    rows = add_name_features(products).where(F.col(target) >= 0)
    present = [c for c in features if c in rows.columns]
    return rows.select(
        F.col(key), *present, target,
        F.log1p(F.col(target).cast("double")).alias("log_price"),
        split_part(F.col(key)).alias("part"),
    )


def feature_kinds(table: DataFrame, key: str = "id", target: str = TARGET) -> tuple[list[str], list[str]]:
    """Numeric and categorical (text or flag) feature columns."""
    left_out = {key, target, "log_price", "part"}
    fields = [f for f in table.schema.fields if f.name not in left_out]
    categorical = [f.name for f in fields if isinstance(f.dataType, (StringType, BooleanType))]
    return [f.name for f in fields if f.name not in categorical], categorical


def imputation_values(train: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Fill value per feature, as text: median of numbers, most frequent category."""
    middle = imputation.medians(train, numeric).select("feature", F.col("median").cast("string").alias("value"))
    common = imputation.modes(imputation.category_counts(train, categorical))
    return middle.unionByName(common.select("feature", F.col("mode").alias("value")))


def _filled(table: DataFrame, numeric, categorical, fills: dict) -> DataFrame:
    as_double = {c: F.col(c).cast("double") for c in numeric}
    as_text = {c: F.col(c).cast("string") for c in categorical}
    return table.withColumns({**as_double, **as_text}).fillna(fills)


def _fold(key: str):
    return F.pmod(F.xxhash64(key), F.lit(FOLDS)).cast("int")


def category_means(filled: DataFrame, categorical: list[str], key: str) -> DataFrame:
    """`feature`, `value`, `total`, `n`, `folds`: log price summed per category, and per category and fold."""
    long = filled.select(_fold(key).alias("fold"), "log_price", *categorical).unpivot(
        ["fold", "log_price"], categorical, "feature", "value"
    )
    per_fold = long.groupBy("feature", "value", "fold").agg(F.sum("log_price").alias("total"), F.count(F.lit(1)).alias("n"))
    entry = F.struct("fold", F.struct("total", "n").alias("held"))
    return per_fold.groupBy("feature", "value").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), F.map_from_entries(F.collect_list(entry)).alias("folds"),
    )


def _vectors(layout: Layout, table: DataFrame, fold: str | None = None) -> DataFrame:
    """The filled table with its `features`; with `fold`, a category's mean comes from the rows of other folds."""
    numbers = [F.col(c) for c in layout.numeric]
    if not layout.categorical:
        return table.withColumn("features", dense(numbers))
    if layout.encoding == "one_hot":
        answer = F.col("number")
    else:
        total, n = F.col("total"), F.col("n")
        if fold is not None:
            held = F.try_element_at("folds", F.col(fold))
            total, n = total - F.coalesce(held["total"], F.lit(0.0)), n - F.coalesce(held["n"], F.lit(0))
        answer = (total + PRIOR_ROWS * layout.overall) / (n + PRIOR_ROWS)
    carry = [] if fold is None else [fold]
    found = look_up(table, "_row", layout.categorical, layout.entries, answer, carry)
    joined = table.join(found, "_row", "left")
    if layout.encoding == "one_hot":
        widths = {c: layout.slots[c] for c in layout.categorical}
        return joined.withColumn("features", one_hot(numbers, widths, F.col("found"))).drop("found")
    means = [F.coalesce(F.try_element_at("found", F.lit(c)), F.lit(layout.overall)) for c in layout.categorical]
    return joined.withColumn("features", dense([*numbers, *means])).drop("found")


def fit_layout(train: DataFrame, key: str = "id", kind: str = "target_mean") -> Layout:
    """Fill values and encoding learned from the training rows."""
    if kind not in ENCODINGS:
        raise ValueError(f"unknown encoding {kind!r}")
    numeric, categorical = feature_kinds(train, key)
    counts = stage(imputation.category_counts(train, categorical), "category_counts") if categorical else None
    fills: dict = {r.feature: r.median for r in imputation.medians(train, numeric).collect()} if numeric else {}
    numeric = [c for c in numeric if fills.get(c) is not None]
    fills = {c: fills[c] for c in numeric}
    modes = {r.feature: r["mode"] for r in imputation.modes(counts).collect()} if categorical else {}
    categorical = [c for c in categorical if c in modes]
    if not numeric and not categorical:
        raise ValueError("no feature is known anywhere")
    fills.update(modes)
    widths, entries, overall = dict.fromkeys(categorical, 1), None, 0.0
    if categorical and kind == "one_hot":
        # One number per column comes to the driver, no category.
        widths = {r.feature: r["count"] for r in counts.groupBy("feature").count().collect()}
        entries = stage(category_numbers(counts), "category_numbers")
    elif categorical:
        filled = _filled(train, numeric, categorical, fills)
        entries = stage(category_means(filled, categorical, key), "category_means")
        overall = train.agg(F.avg("log_price")).first()[0] or 0.0
    slots = {**dict.fromkeys(numeric, 1), **{c: widths[c] for c in categorical}}
    return Layout(kind, tuple(numeric), tuple(categorical), fills, slots, entries, overall)


def _numbered(layout: Layout, table: DataFrame) -> DataFrame:
    return _filled(table.withColumn("_row", F.monotonically_increasing_id()), layout.numeric, layout.categorical, layout.fills)


def feature_slots(layout: Layout, table: DataFrame) -> DataFrame:
    """The rows with `features`: the stored form of their vector (`size`, `indices`, `values`)."""
    numbered = stage(_numbered(layout, table), "numbered")  # the numbers must not change between the reads
    return _vectors(layout, numbered).drop("_row")


def fit_price_model(
    train: DataFrame,
    key: str = "id",
    trees: int = TREES,
    depth: int = DEPTH,
    encoding: str = "target_mean",
    fit_rows: int | None = None,
    seed: int = SEED,
    bagging: bool = True,
    bins: int = 32,
) -> PriceModel:
    """Impute, encode and fit a forest on the log of the price.

    `train` is read several times; pass a table.  `encoding` is one of

    * `target_mean`: a category becomes the mean log price of its rows, mixed
      with the overall mean and, for training rows, taken from other folds than
      their own.
    * `one_hot`: every category gets a slot; unseen values set none.

    Both are grouped and joined on the cluster whatever the number of
    categories.  Without `bagging` every tree sees every row once, so all trees
    are the same.  A numeric column with up to `bins` values is cut between any
    two of them, others between `bins` quantiles.

    `fit_rows` bounds the labelled rows the forest is grown on (those with the
    smallest hash of the key); fill values and category means use all rows.
    """
    layout = fit_layout(train, key, encoding)
    table = train
    if fit_rows is not None:
        table = table.orderBy(F.xxhash64(key), key).limit(fit_rows)
    numbered = stage(_numbered(layout, table).withColumn("_fold", _fold(key)), "numbered")
    rows = _vectors(layout, numbered, "_fold").select("log_price", "features")
    forest = RandomForestRegressor(
        labelCol="log_price", predictionCol="predicted_log", numTrees=trees, maxDepth=depth, maxBins=bins,
        minInstancesPerNode=1, featureSubsetStrategy="all", bootstrap=bagging, seed=seed, cacheNodeIds=True,
        maxMemoryInMB=1024,
    )
    encoded = stage(as_vectors(rows, "features"), "encoded")
    model = PriceModel(Pipeline(stages=[forest]).fit(encoded), layout)
    unstage(numbered)
    unstage(encoded)
    return model


def predict(model: PriceModel, table: DataFrame) -> DataFrame:
    """Rows with `actual_price` and `predicted_price`, inputs as they were.

    Filled and encoded copies of the inputs stay inside.
    """
    layout = model.layout
    inputs = [*layout.numeric, *layout.categorical]
    kept = table.withColumns({f"_{c}": F.col(c) for c in inputs})
    numbered = stage(_numbered(layout, kept), "to_predict")
    scored = model.pipeline.transform(as_vectors(_vectors(layout, numbered), "features"))
    others = [c for c in table.columns if c not in inputs and c not in (TARGET, "log_price")]
    return scored.select(
        *others,
        *[F.col(f"_{c}").alias(c) for c in inputs],
        F.col(TARGET).alias("actual_price"),
        F.expm1("predicted_log").alias("predicted_price"),
    )


def evaluate(predictions: DataFrame) -> DataFrame:
    """Errors on the price scale, per split part."""
    metrics = regression_metrics("actual_price", "predicted_price")
    return predictions.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), *[value.alias(name) for name, value in metrics.items()]
    ).orderBy("part")


def feature_importance(model: PriceModel, like: DataFrame) -> DataFrame:
    """Importance per original feature, the slots of a category added up."""
    weights = model.pipeline.stages[-1].featureImportances
    features, ends = list(model.layout.slots), list(accumulate(model.layout.slots.values()))
    known = zip(weights.indices, weights.values) if hasattr(weights, "indices") else enumerate(weights.toArray())
    # One row per slot that carries any weight, and one per feature so that none is missing.
    slots = [(features[bisect_right(ends, int(i))], float(w)) for i, w in known] + [(c, 0.0) for c in features]
    return importance_by_feature(like.sparkSession.createDataFrame(slots, "original_feature string, importance double"))


def importance_by_feature(slots: DataFrame) -> DataFrame:
    """Importances of slots (`original_feature`, `importance`) added up per feature, largest first."""
    return slots.groupBy("original_feature").agg(F.sum("importance").alias("importance")).orderBy(
        F.col("importance").desc(), "original_feature"
    )


def importance_bars(importance: DataFrame) -> DataFrame:
    """Importances from the smallest up, as bars are drawn."""
    return importance.orderBy("importance", F.col("original_feature").desc())


def actual_vs_predicted(predictions: DataFrame) -> DataFrame:
    """Log of actual and predicted price, with the ends of the diagonal."""
    points = predictions.select(
        F.log1p(F.col("actual_price").cast("double")).alias("log_actual"),
        F.log1p("predicted_price").alias("log_predicted"),
    )
    points = stage(points, "points")  # both ends and points: the model is asked once
    ends = points.agg(F.struct(
        F.least(F.min("log_actual"), F.min("log_predicted")).alias("low"),
        F.greatest(F.max("log_actual"), F.max("log_predicted")).alias("high"),
    ).alias("ends")).scalar()
    return points.withColumns({"diagonal_from": ends["low"], "diagonal_to": ends["high"]})
