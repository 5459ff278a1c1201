"""Categories as numbers: looked up by join, whatever the number of categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .ordered import running_total


def category_numbers(counts: DataFrame) -> DataFrame:
    """`feature`, `value`, `number`: the categories of each feature from 0, most frequent first, then by value.

    A running count over slices: no task sees all categories of a feature.
    """
    ran = running_total(counts.withColumn("_one", F.lit(1)), [F.col("n").desc(), F.col("value")], "_one", ["feature"])
    return ran.select("feature", "value", (F.col("running") - 1).alias("number"))


def look_up(
    table: DataFrame, row: str, columns: Sequence[str], entries: DataFrame, found: Column, carry: Sequence[str] = (),
    kind: str = "string",
) -> DataFrame:
    """`row`, `found`: per row a map from column to what its value stands for; values without an entry are left out.

    `entries` holds `feature`, `value` (of type `kind`) and what `found` is made of; `found` may also use the columns in `carry`.
    The columns are unfolded once and joined once, and a row's answers are put together by task before they are
    shuffled if the entries are small enough for Spark to broadcast.
    """
    alike = table.select(row, *carry, *[F.col(c).cast(kind).alias(c) for c in columns])
    long = alike.unpivot([row, *carry], list(columns), "feature", "value").where(F.col("value").isNotNull())
    answers = long.join(entries, ["feature", "value"]).select(row, F.struct("feature", found.alias("found")).alias("_entry"))
    return answers.groupBy(row).agg(F.map_from_entries(F.collect_list("_entry")).alias("found"))


def dense(values: Sequence[Column]) -> Column:
    """A dense vector as the library stores it."""
    return _vector(1, F.lit(None), F.lit(None), F.array(*values))


def one_hot(numbers: Sequence[Column], slots: Mapping[str, int], found: Column) -> Column:
    """A sparse vector: the numbers, then a slot for each category of each column (`slots`: their count by column).

    `found` maps a column to its category's number; a column without one has no slot set.
    """
    begin, at = len(numbers), []
    for column, width in slots.items():
        at.append(F.try_element_at(found, F.lit(column)) + begin)
        begin += width
    set_slots = F.array_compact(F.array(*at)).cast("array<int>")
    return _vector(
        0, F.lit(begin),
        F.concat(F.array(*[F.lit(i) for i in range(len(numbers))]).cast("array<int>"), set_slots),
        F.concat(F.array(*numbers).cast("array<double>"), F.array_repeat(F.lit(1.0), F.size(set_slots))),
    )


def _vector(kind: int, size: Column, indices: Column, values: Column) -> Column:
    return F.struct(
        F.lit(kind).cast("tinyint").alias("type"), size.cast("int").alias("size"),
        indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"),
    )


def as_vectors(df: DataFrame, column: str) -> DataFrame:
    """The stored form in `column` as the library's vector type.

    SQL has no cast to it; Arrow hands the batches over as they are, no row is touched in Python.
    """
    schema = T.StructType([
        T.StructField(f.name, VectorUDT() if f.name == column else f.dataType, f.nullable) for f in df.schema.fields
    ])
    return df.mapInArrow(lambda batches: batches, schema)
