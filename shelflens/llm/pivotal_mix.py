"""Mixing sources to target weights by pivotal dependent rounding.

A source that is to give `target` of its `source_size` words asks for
target / source_size copies of each document: a whole part, and a probability
of one copy more.  Two documents at a time trade probability, in proportion to
their sizes so that the expected words stay what they were, until one of the
two is 0 or 1; the other meets the next document.  What is left of a chunk is
one fractional document; such residuals are combined in a tree whose nodes take
a bounded number of them, and the last one of a source is drawn.  So a source's
words miss its target by less than one of its smaller documents.

Chunks are cut by hash, so a source that holds a third of all rows is many
chunks; equal rows are counted before the shuffle and numbered after it.
Randomness comes from hashes of ids and texts alone: reruns agree.

Defined cases: a null source is a source of its own, ordered last; a null or
empty text has size 0 and is taken 0 times; a source whose texts are all empty
has target 0; rows that repeat are separate documents; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from ..operators.ordered import running_total
from ..staging import stage

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MOST_COPIES = 2.0
CHUNK_ROWS = 2048
FAN_IN = 256
WORD = r"[^\x20\x09-\x0D]+"
_UNIT = "name string, none boolean, doc_id {id}, text_key long, copy int, size long, share double, chunk long, more int"


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row per document: `name`, `none` (its source), `doc_id`, `text_key`, `copy`, `size`.

    `copy` numbers rows that agree in all else, from 1.
    """
    text = docs[text_col].cast("string")
    source = docs[source_col].cast("string")
    return (
        docs.select(
            F.coalesce(source, F.lit("")).alias("name"), source.isNull().alias("none"),
            docs[id_col].alias("doc_id"), F.xxhash64(text).alias("text_key"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
        .groupBy("name", "none", "doc_id", "text_key", "size").agg(F.count(F.lit(1)).cast("int").alias("n"))
        .select("name", "none", "doc_id", "text_key", F.explode(F.sequence(F.lit(1), "n")).alias("copy"), "size")
    )


def source_targets(
    sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE,
    most_copies: float = MOST_COPIES,
) -> DataFrame:
    """`name`, `none`, `n`, `source_size`, `target` per source.

    Sources take the weights in turn, by code point, null last.  They share
    `total_share` of all words by weight; none gets more than `most_copies` times
    its own, and what is cut off is shared among the others.  In order of the
    level at which they fill up, a source is full if it would be at the level of
    the words and weights not yet handed out.
    """
    per_source = sized.groupBy("none", "name").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    placed = running_total(
        per_source.withColumn("one", F.lit(1)), [F.col("none"), F.col("name")], "one", out="place", total_out="sources",
    )
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = placed.select(
        "none", "name", "source_size", "n",
        F.get(turn, ((F.col("place") - 1) % len(weights)).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(float(most_copies))).alias("cap"),
    ).withColumn("level", F.col("cap") / F.col("weight"))
    order = [F.col("level"), F.col("none"), F.col("name")]
    filled = running_total(weighed, order, "cap", out="caps", total_out="all_caps")
    filled = stage(running_total(filled, order, "weight", out="weights", total_out="all_weights"), "levels")
    all_words = F.col("all_caps") * F.lit(total_share / most_copies)
    left = all_words - (F.col("caps") - F.col("cap"))
    open_weight = F.col("all_weights") - (F.col("weights") - F.col("weight"))
    marked = filled.withColumn("full", F.col("level") * open_weight <= left).withColumn("words", all_words)
    water = marked.agg(
        (F.first("words") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0.0))).alias("words"),
        F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weight"),
    ).select((F.col("words") / F.col("weight")).alias("water")).scalar()
    return marked.select(
        "none", "name", "n", "source_size",
        F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", F.col("weight") * water)).alias("target"),
    )


def round_pivotal(sizes: np.ndarray, shares: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Shares made 0 or 1 but for at most one; the place of that one, or -1.

    `draw` holds a uniform number per document.  The sum of size times share
    does not change, and every share keeps its expectation.
    """
    out = shares.copy()
    held = -1
    for i, drawn in enumerate(draw.tolist()):
        if not 0.0 < out[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b, size_a, size_b = float(out[held]), float(out[i]), float(sizes[held]), float(sizes[i])
        up = min((1 - a) * size_a, b * size_b)
        down = min(a * size_a, (1 - b) * size_b)
        if drawn * (up + down) < down:
            a, b = (1.0, b - up / size_b) if (1 - a) * size_a <= b * size_b else (a + up / size_a, 0.0)
        else:
            a, b = (0.0, b + down / size_b) if a * size_a <= (1 - b) * size_b else (a - down / size_a, 1.0)
        out[held], out[i] = min(max(a, 0.0), 1.0), min(max(b, 0.0), 1.0)
        if not 0.0 < out[held] < 1.0:
            held = i if 0.0 < out[i] < 1.0 else -1
    return out, held


def _round_chunk(frame: pd.DataFrame) -> pd.DataFrame:
    """One node of the tree: decided documents get `more` 0 or 1, the residual keeps -1."""
    frame = frame.sort_values(["size", "text_key", "copy", "seed"], ascending=[False, True, True, True], ignore_index=True)
    draw = (frame["seed"].to_numpy(np.int64).view(np.uint64) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    shares, held = round_pivotal(frame["size"].to_numpy(), frame["share"].to_numpy(), draw)
    more = (shares >= 1.0).astype(np.int32)
    if held >= 0:
        more[held] = -1
    return frame.assign(share=shares, more=more).drop(columns="seed")


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE,
    most_copies: float = MOST_COPIES, seed: int = 1, chunk_rows: int = CHUNK_ROWS, fan_in: int = FAN_IN,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """A row per document: `doc_id`, `text_key`, `copy`, `name`, `none`, `size`, `source_size`, `target`, `copies`."""
    sized = stage(units(docs, id_col, text_col, source_col), "units")
    targets = stage(source_targets(sized, weights, total_share, most_copies), "targets")
    schema = _UNIT.format(id=sized.schema["doc_id"].dataType.simpleString())
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # The table of sources is small against that of documents; Spark checks its size.
    asked = sized.where("size > 0").join(targets, ["none", "name"]).select(
        "name", "none", "doc_id", "text_key", "copy", "size",
        (wanted - F.floor(wanted)).alias("share"),
        F.pmod(F.xxhash64("doc_id", "text_key", "copy", F.lit(seed)), F.ceil(F.col("n") / chunk_rows)).alias("chunk"),
        F.lit(-1).alias("more"),
    )
    largest = targets.agg(F.max("n")).first()[0] or 0
    chunks = -(-largest // chunk_rows)
    level, decided, open_units = 0, [], asked
    while True:
        drawn = open_units.withColumn("seed", F.xxhash64("doc_id", "text_key", "copy", F.lit(seed), F.lit(level)))
        done = stage(drawn.groupBy("none", "name", "chunk").applyInPandas(_round_chunk, schema), "rounded")
        decided.append(done.where("more >= 0"))
        open_units = done.where("more < 0")
        if chunks <= 1:
            break
        open_units = open_units.withColumn("chunk", F.floor(F.col("chunk") / fan_in).cast("long"))
        chunks = -(-chunks // fan_in)
        level += 1
    # One residual per source is left: its share is drawn.
    last = F.pmod(F.xxhash64("doc_id", "text_key", "copy", F.lit(seed), F.lit("last")), F.lit(1 << 32)) / float(1 << 32)
    more = open_units.withColumn("more", (last < F.col("share")).cast("int"))
    for part in decided:
        more = more.union(part)
    key = ["none", "name", "doc_id", "text_key", "copy"]
    chosen = more.select(*key[:2], F.col("doc_id").alias("_id"), "text_key", "copy", "more")
    joined = sized.alias("u").join(
        chosen.alias("c"),
        (F.col("u.none") == F.col("c.none")) & (F.col("u.name") == F.col("c.name"))
        & (F.col("u.text_key") == F.col("c.text_key")) & (F.col("u.copy") == F.col("c.copy"))
        & F.col("u.doc_id").eqNullSafe(F.col("c._id")),
        "left",
    ).select(*[f"u.{c}" for c in (*key, "size")], "c.more")
    return joined.join(targets, ["none", "name"]).select(
        "doc_id", "text_key", "copy", "name", "none", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.floor(wanted) + F.coalesce("more", F.lit(0)))
        .otherwise(F.lit(0)).cast("long").alias("copies"),
    )


def mixed_documents(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE,
    most_copies: float = MOST_COPIES, seed: int = 1, chunk_rows: int = CHUNK_ROWS, fan_in: int = FAN_IN,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The documents, each as often as the mix takes it; columns as they were."""
    chosen = mix(docs, weights, total_share, most_copies, seed, chunk_rows, fan_in, id_col, text_col, source_col)
    chosen = chosen.where("copies > 0").select(
        F.col("doc_id").alias("_c_id"), F.col("text_key").alias("_c_key"), F.col("copy").alias("_c_copy"),
        F.col("name").alias("_c_name"), F.col("none").alias("_c_none"), "copies",
    )
    text, source = docs[text_col].cast("string"), docs[source_col].cast("string")
    same = Window.partitionBy("_id", "_key", "_name", "_none").orderBy(F.xxhash64("row"))
    held = docs.select(
        F.struct("*").alias("row"), docs[id_col].alias("_id"), F.xxhash64(text).alias("_key"),
        F.coalesce(source, F.lit("")).alias("_name"), source.isNull().alias("_none"),
    ).withColumn("_copy", F.row_number().over(same))
    taken = held.join(
        chosen,
        F.col("_id").eqNullSafe(F.col("_c_id")) & (F.col("_key") == F.col("_c_key"))
        & (F.col("_name") == F.col("_c_name")) & (F.col("_none") == F.col("_c_none"))
        & (F.col("_copy") == F.col("_c_copy")),
    )
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
