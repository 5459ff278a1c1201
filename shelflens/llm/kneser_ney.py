"""Quality by perplexity under an interpolated modified Kneser-Ney model of characters.

The model is trained on trusted documents.  One pass over all texts counts, per
task, the four-character grams that stand in them and how often in trusted ones;
Spark adds the counts up in shards by gram.  From these come, by grouping and
joining on contexts and suffixes, the three discounts of each order, the
continuation counts of the lower orders, and the probability of every gram that
any text holds.  A second pass takes each text's mean.  A document is kept if
its perplexity is at most a quantile of those of the trusted documents of its
language.

A gram is four 16-bit codes in one number (characters beyond the basic plane
count as one; a text is led by zeros), so it is exact and its context and
suffix are shifts of it.  The table of probabilities is sent to the tasks where
it has at most `broadcast_grams` rows; beyond that each document's grams are
joined to it in shards, with the same result.

Defined cases: null and empty texts have null perplexity and are not kept; a
null language is a language of its own; a language without trusted text takes
the quantile over all; without any trusted text nothing has a perplexity and
nothing is kept; a document with several labels is trusted if all say so;
repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.ordered import exact_quantile
from ..staging import stage
from . import textarrays as ta

ORDER = 4
CODE_BITS = 16
QUANTILE = 0.99
BROADCAST_GRAMS = 4_000_000
HELD_GRAMS = 1 << 20
#: Ids of trusted documents up to this number are sent to the tasks; beyond it texts are joined to them by shuffle.
BROADCAST_TRUSTED = 1_000_000


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Gram and text number for every character of the texts."""
    lead = "\0" * (ORDER - 1)
    joined = lead + lead.join(texts)
    codes = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4"), 0xFFFF).astype(np.uint64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    key = np.zeros(max(len(codes) - ORDER + 1, 0), np.uint64)
    for i in range(ORDER):
        key = (key << np.uint64(CODE_BITS)) | codes[i:len(codes) - ORDER + 1 + i]
    owner = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(owner)) + (ORDER - 1) * owner
    return key[at].view(np.int64), owner


def gram_counts(docs: DataFrame) -> DataFrame:
    """`gram`, `n` (times in trusted texts, 0 if in none) over `text`, `trusted`; counted in the tasks first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for part in ta.slices(batch, 0):
                trusted = np.asarray(part.column(1).fill_null(False)).astype(np.int64)
                found, owner = grams([t or "" for t in part.column(0).to_pylist()])
                own, inverse = np.unique(found, return_inverse=True)
                n = np.bincount(inverse, trusted[owner], len(own)).astype(np.int64)
                keys, inverse = np.unique(np.concatenate([keys, own]), return_inverse=True)
                sums = np.bincount(inverse, np.concatenate([sums, n]), len(keys)).astype(np.int64)
                if len(keys) > HELD_GRAMS:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["gram", "n"])
                    keys, sums = keys[:0], sums[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["gram", "n"])

    per_task = docs.select("text", "trusted").mapInArrow(count, "gram long, n long")
    return per_task.groupBy("gram").agg(F.sum("n").alias("n"))


def _context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, CODE_BITS)


def _suffix(gram: Column, order: int) -> Column:
    """The gram without its first character, a gram of the order below."""
    return gram.bitwiseAND(F.lit((1 << (CODE_BITS * (order - 1))) - 1))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Discounts for counts of one, two, and three or more."""
    n1, n2, n3, n4 = (float(x) for x in counts.agg(*[F.count_if(F.col("n") == i) for i in (1, 2, 3, 4)]).first())
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.0, 2 - 3 * y * n3 / n2 if n2 else 0.0, 3 - 4 * y * n4 / n3 if n3 else 0.0)
    return tuple(min(max(d, 0.0), float(i)) for i, d in enumerate(raw, 1))  # type: ignore[return-value]


def gram_probabilities(counted: DataFrame) -> DataFrame:
    """`gram`, `logp` for every gram of `counted` (`gram`, `n`), from the grams with n > 0."""
    counts = {ORDER: counted.where("n > 0")}
    for order in range(ORDER - 1, 0, -1):
        # How many different characters stand before the gram.
        counts[order] = stage(
            counts[order + 1].select(_suffix(F.col("gram"), order + 1).alias("gram"))
            .groupBy("gram").agg(F.count(F.lit(1)).alias("n")),
            f"continuations{order}",
        )
    asked = {ORDER: counted.select("gram")}
    for order in range(ORDER - 1, 0, -1):
        asked[order] = asked[order + 1].select(_suffix(F.col("gram"), order + 1).alias("gram")).distinct()
    letters, total = asked[1].count(), counts[1].agg(F.sum("n")).first()[0]
    if not total:
        return counted.select("gram", F.lit(None).cast("double").alias("logp"))
    lower = None
    for order in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(counts[order])
        n = F.col("n")
        discount = F.when(n == 1, d1).when(n == 2, d2).when(n >= 3, d3).otherwise(0.0)
        held = asked[order].withColumn("context", _context(F.col("gram"))).join(counts[order], "gram", "left")
        held = held.withColumn("n", F.coalesce(n, F.lit(0)))
        contexts = counts[order].groupBy(_context(F.col("gram")).alias("context")).agg(
            F.sum("n").alias("total"), F.sum(discount).alias("spare")
        )
        held = held.join(contexts, "context", "left")
        if lower is None:
            held = held.withColumn("below", F.lit(1.0 / letters))
        else:
            held = held.withColumn("suffix", _suffix(F.col("gram"), order)).join(lower, "suffix")
        p = F.when(F.col("total").isNull(), F.col("below")).otherwise(
            (n - discount + F.col("spare") * F.col("below")) / F.col("total")
        )
        held = stage(held.select("gram", p.alias("p")), f"order{order}")
        lower = held.select(F.col("gram").alias("suffix"), F.col("p").alias("below"))
    return held.select("gram", F.log("p").alias("logp"))


def _perplexity(total: Column, n: Column) -> Column:
    return F.when(n > 0, F.exp(-total / n))


def _scores_by_broadcast(docs: DataFrame, table: DataFrame) -> DataFrame:
    found = table.toArrow()
    keys, logs = found["gram"].to_numpy(), found["logp"].to_numpy()
    order = np.argsort(keys)
    known = docs.sparkSession.sparkContext.broadcast((keys[order], logs[order]))
    schema = T.StructType([
        *[docs.schema[c] for c in ("doc_id", "lang")],
        T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType()),
    ])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs = known.value
        for batch in batches:
            for part in ta.slices(batch, 2):
                own, owner = grams([t or "" for t in part.column(2).to_pylist()])
                different, inverse = np.unique(own, return_inverse=True)
                values = logs[np.searchsorted(keys, different)]
                rows = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], pa.array(np.bincount(owner, minlength=rows)),
                     pa.array(np.bincount(owner, values[inverse], rows) if len(owner) else np.zeros(rows))],
                    names=schema.names,
                )

    return docs.select("doc_id", "lang", "text").mapInArrow(score, schema).select(
        "doc_id", "lang", "n", _perplexity(F.col("total"), F.col("n")).alias("perplexity")
    )


def _scores_by_join(docs: DataFrame, table: DataFrame) -> DataFrame:
    """The same, with each document's different grams joined to the table."""
    schema = T.StructType([
        docs.schema["doc_id"], docs.schema["text_key"], T.StructField("gram", T.LongType()), T.StructField("k", T.LongType()),
    ])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ta.slices(batch, 2):
                own, owner = grams([t or "" for t in part.column(2).to_pylist()])
                order = np.lexsort((own, owner))
                own, owner = own[order], owner[order]
                new = np.ones(len(own), bool)
                new[1:] = (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])
                at = np.flatnonzero(new)
                rows = pa.array(owner[at])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows), pa.array(own[at]),
                     pa.array(np.diff(np.append(at, len(own))))],
                    names=schema.names,
                )

    each = docs.select("doc_id", "text_key", "text").distinct().mapInArrow(emit, schema)
    sums = each.join(table, "gram").groupBy("doc_id", "text_key").agg(
        F.sum("k").alias("n"), F.sum(F.col("k") * F.col("logp")).alias("total")
    )
    d, s = docs.drop("text").alias("d"), sums.alias("s")
    joined = d.join(s, F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_key") == F.col("s.text_key")), "left")
    return joined.select(
        "d.doc_id", "d.lang", F.coalesce("n", F.lit(0)).alias("n"),
        _perplexity(F.col("total"), F.col("n")).alias("perplexity"),
    )


def judge_by_perplexity(
    docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE,
    broadcast_grams: int = BROADCAST_GRAMS,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "quality",
) -> DataFrame:
    """`doc_id`, `lang`, `n_scored`, `perplexity`, `threshold`, `kept` per document."""
    trusted = (
        labels.groupBy(labels[id_col].alias("_id")).agg(F.min(labels[label_col].cast("int")).alias("least"))
        .where("_id IS NOT NULL AND least = 1").select("_id", F.lit(True).alias("trusted"))
    )
    trusted = stage(trusted, "trusted")
    few = trusted.limit(BROADCAST_TRUSTED + 1).count() <= BROADCAST_TRUSTED

    def marked(df: DataFrame, ids: DataFrame) -> DataFrame:
        joined = df.join(ids, F.col("doc_id") == F.col("_id"), "left").drop("_id")
        return joined.withColumn("trusted", F.coalesce("trusted", F.lit(False)))

    text = docs[text_col].cast("string")
    narrow = docs.select(
        docs[id_col].alias("doc_id"), docs[lang_col].cast("string").alias("lang"), text.alias("text"),
        F.xxhash64(text).alias("text_key"),
    )
    with_text = marked(narrow.select("doc_id", "text"), F.broadcast(trusted) if few else trusted)
    counted = stage(gram_counts(with_text), "grams")
    table = stage(gram_probabilities(counted), "probabilities")
    small = table.limit(broadcast_grams + 1).count() <= broadcast_grams
    scored = stage(marked((_scores_by_broadcast if small else _scores_by_join)(narrow, table), trusted), "scores")
    good = scored.where("trusted AND perplexity IS NOT NULL")
    lang = F.coalesce(F.col("lang"), F.lit("")).alias("name"), F.col("lang").isNull().alias("none")
    per_lang = exact_quantile(good.select(*lang, "perplexity"), "perplexity", quantile, ["name", "none"], "own")
    overall = exact_quantile(good, "perplexity", quantile, out="overall")
    limits = scored.select(*lang).distinct().join(per_lang, ["name", "none"], "left")
    limits = limits.withColumn("threshold", F.coalesce("own", overall.select(F.max("overall")).scalar()))
    return scored.withColumns({"name": lang[0], "none": lang[1]}).join(limits.drop("own"), ["name", "none"]).select(
        "doc_id", "lang", F.col("n").alias("n_scored"), "perplexity", "threshold",
        F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("kept"),
    )
