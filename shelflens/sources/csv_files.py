"""CSV files whose header order, character set and quoting differ from file to file.

Spark binds CSV columns by position and applies one character set to a scan.
Here the files are scanned as text twice.  The first pass finds, per file, the
header, whether the bytes are UTF-8 and whether a quoted value runs over several
lines.  The second attaches these facts to the lines by file path, puts the
lines of such values together, and parses every record by the header of its own
file.  The driver sees the different headers, not the files.

No record is lost: what does not fit its header is a reject, with its reason.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, Observation, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from ..staging import stage

FALLBACK_CHARSET = "cp1258"  # fixed value: tried where a file is not UTF-8
FILE_PATH, FILE_NAME = "_file_path", "_file_name"
#: Files whose facts (a path and four short values each) are sent to every executor, some 200 bytes a file;
#: for more files the lines are joined to them by path.
BROADCAST_FILES = 500_000

SURPLUS, OPEN_QUOTE, HEADER_AGAIN = "more fields than the header", "quote never closed", "header again"

# A quoted value, closed: doubled quotes stand for one.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
# A line, read from a field's start, that ends inside a quoted value.
_ENDS_INSIDE = rf'^(?:(?:{_QUOTED}[^,]*+|[^",][^,]*+)?,)*+"[^"]*+(?:""[^"]*+)*+$'


@dataclass(frozen=True)
class CsvFiles:
    """`records`: a row per record with `_file_path`, `_file_name`, `_shape` (which of `headers`), `_fields`,
    `_record` (its text) and `_reject` (why it does not fit its header, else null).

    `observed` counts the records while the rows are first computed, as when they are written."""

    records: DataFrame
    headers: tuple[tuple[str, ...], ...]
    n_files: int
    observed: Observation

    def counts(self) -> dict[str, int]:
        """Rows, and rejects by reason; waits until the rows have been computed once."""
        seen = self.observed.get
        again = seen["headers"] - self.n_files
        return {"rows": seen["rows"], SURPLUS: seen["surplus"], OPEN_QUOTE: seen["unclosed"], HEADER_AGAIN: again}

    def good(self) -> DataFrame:
        """The records that fit, counted as they pass."""
        why = F.col("_reject")
        seen = self.records.observe(
            self.observed, F.count_if(why.isNull()).alias("rows"), F.count_if(why == HEADER_AGAIN).alias("headers"),
            F.count_if(why == SURPLUS).alias("surplus"), F.count_if(why == OPEN_QUOTE).alias("unclosed"),
        )
        return seen.where(why.isNull())

    @property
    def columns(self) -> list[str]:
        """First header's columns, then unseen ones as met."""
        return list(dict.fromkeys(c for header in self.headers for c in header))

    def has(self, column: str) -> Column:
        """Whether the record's file has the column."""
        shapes = [i for i, header in enumerate(self.headers) if column in header]
        return F.col("_shape").isin(shapes) if shapes else F.lit(False)

    def value(self, column: str) -> Column:
        """The record's value; null where its file has no such column."""
        places = [header.index(column) if column in header else -1 for header in self.headers]
        return F.get("_fields", F.get(F.expr(f"array({', '.join(map(str, places))})"), F.col("_shape")))

    def rows(self) -> DataFrame:
        """All records that fit, as text columns, with their file's path and name."""
        return self.good().select(*[self.value(c).alias(c) for c in self.columns], FILE_PATH, FILE_NAME)

    def rejects(self) -> DataFrame:
        """`file_path`, `reason`, `record` of the others.  A file's own header is none of them."""
        bad = self.records.where(F.col("_reject").isNotNull() & (F.col("_reject") != HEADER_AGAIN))
        again = self.records.where(F.col("_reject") == HEADER_AGAIN).groupBy(FILE_PATH, "_record").count()
        more = again.where("count > 1").select(
            FILE_PATH, F.lit(HEADER_AGAIN).alias("_reject"), "_record", F.explode(F.sequence(F.lit(2), "count"))
        )
        both = bad.select(FILE_PATH, "_reject", "_record").unionByName(more.select(FILE_PATH, "_reject", "_record"))
        return both.select(
            decoded(F.col(FILE_PATH)).alias("file_path"), F.col("_reject").alias("reason"), F.col("_record").alias("record")
        )


def text_lines(spark: SparkSession, pattern: str, leave_out: str | None = None) -> DataFrame:
    """Lines of all files with their place: `_block` (start of the split) and `_line` (rising within it)."""
    try:
        lines = spark.read.text(pattern)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no CSV file matches {pattern}") from error
        raise
    if leave_out:
        lines = lines.where(~F.lower(F.col("_metadata.file_name")).contains(leave_out.lower()))
    return lines.select(
        F.col("_metadata.file_path").alias(FILE_PATH), F.col("_metadata.file_name").alias(FILE_NAME),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"), "value",
    )


def _ends_inside(line: Column) -> Column:
    """Whether a quoted value is still open at the line's end."""
    return line.contains('"') & line.rlike(_ENDS_INSIDE)


def line_facts(lines: DataFrame) -> DataFrame:
    """`header` (bytes), `utf8` and `multiline` per file, from its lines.

    `collect_set` of a boolean (two values at most) stands in for `bool_and`:
    with it the aggregation is hash-based although `min_by` carries text, so
    the lines are not sorted.
    """
    return (
        lines.where(F.length("value") > 0)
        .groupBy(FILE_PATH)
        .agg(
            F.min_by(F.col("value").cast("binary"), F.struct("_block", "_line")).alias("header"),
            F.collect_set(F.is_valid_utf8("value")).alias("utf8"),
            F.collect_set(_ends_inside(F.col("value"))).alias("open"),
        )
        .select(
            FILE_PATH, "header", (~F.array_contains("utf8", False)).alias("utf8"),
            F.array_contains("open", True).alias("multiline"),
        )
    )


def _charset_table() -> tuple[str, str]:
    """Characters of the fallback set, and what ISO-8859-1 makes of the same bytes."""
    seen = [bytes([b]) for b in range(128, 256)]
    pairs = [(b.decode("latin-1"), b.decode(FALLBACK_CHARSET, errors="replace")) for b in seen]
    return "".join(a for a, b in pairs if a != b), "".join(b for a, b in pairs if a != b)


def decoded_text(value: Column, utf8: Column) -> Column:
    """The line's text: as it is, or one character per byte; no session setting is needed for that."""
    as_read, meant = _charset_table()
    return F.when(utf8, value).otherwise(
        F.translate(F.decode(value.cast("binary"), "ISO-8859-1"), as_read, meant)
    )


def read_files(spark: SparkSession, pattern: str, leave_out: str | None = None) -> CsvFiles:
    """All files that match, whatever their headers."""
    lines = text_lines(spark, pattern, leave_out)
    files = stage(line_facts(lines), "csv_files")
    # One row per different header.
    found = files.groupBy("header", "utf8").agg(
        F.min(FILE_PATH).alias("first"), F.count(F.lit(1)).alias("n"), F.max("multiline").alias("multiline")
    ).collect()
    if not found:
        raise FileNotFoundError(f"no CSV file matches {pattern}")
    headers: dict[tuple[str, ...], int] = {}
    shapes = []
    for row in sorted(found, key=lambda row: row["first"]):
        text = bytes(row.header).decode("utf-8-sig" if row.utf8 else FALLBACK_CHARSET, errors="replace")
        header = tuple(next(csv.reader([text])))
        shapes.append((row.header, row.utf8, headers.setdefault(header, len(headers)), len(header)))
    shapes = spark.createDataFrame(shapes, "header binary, utf8 boolean, _shape int, _width int")
    facts = files.join(F.broadcast(shapes), ["header", "utf8"])  # a row per different header
    n_files = sum(row.n for row in found)
    if n_files <= BROADCAST_FILES:
        facts = F.broadcast(facts)
    known = lines.join(facts, FILE_PATH)
    known = known.withColumn("_header", F.col("value").cast("binary") == F.col("header"))
    known = known.withColumn("value", decoded_text(F.col("value"), F.col("utf8"))).drop("header", "utf8")
    if any(row.multiline for row in found):
        # Only these lines are shuffled, to one task per file.
        records = _single(known.where("NOT multiline")).unionByName(_assembled(known.where("multiline")))
    else:
        records = _single(known)
    parsed = _parsed(records, sorted({len(h) for h in headers}))
    return CsvFiles(parsed, tuple(headers), n_files, Observation())


_KEPT = (FILE_PATH, FILE_NAME, "_shape", "_width", "_header")


def _single(lines: DataFrame) -> DataFrame:
    """Every line is a record."""
    return lines.where(F.length("value") > 0).select(
        *_KEPT, F.col("value").alias("_record"), F.lit(False).alias("_unclosed")
    )


def _assembled(lines: DataFrame) -> DataFrame:
    """Records of files in which quoted values run over lines.

    Whether a line begins inside a value follows from the lines before it.  A
    line either settles the state at its end, turns it over, or leaves it; so
    the state is that of the last line that settled it, turned over as often as
    lines have since.  A quote that is never closed would take the rest of the
    file into one record: there, every line is taken by itself.
    """
    in_file = Window.partitionBy(FILE_PATH).orderBy("_block", "_line")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(FILE_PATH)
    outside, inside = _ends_inside(F.col("value")), _ends_inside(F.concat(F.lit('"'), "value"))
    marked = lines.withColumns({"_outside": outside, "_inside": inside})
    turned = marked.withColumn(
        "_turns", F.coalesce(F.sum((F.col("_outside") & ~F.col("_inside")).cast("long")).over(before), F.lit(0))
    )
    settled = F.when(F.col("_outside") == F.col("_inside"), F.struct("_outside", "_turns"))
    last = turned.withColumn("_last", F.last(settled, ignorenulls=True).over(before))
    odd = (F.col("_turns") - F.coalesce("_last._turns", F.lit(0))) % 2 == 1
    stated = last.withColumn("_begins_inside", F.coalesce("_last._outside", F.lit(False)) != odd)
    ends = F.when(F.col("_begins_inside"), F.col("_inside")).otherwise(F.col("_outside"))
    numbered = stated.withColumns({
        "_ends_inside": ends, "_number": F.sum((~F.col("_begins_inside")).cast("long")).over(in_file),
    })
    # The state at the end of the file, and its last record.
    final = numbered.withColumns({
        "_final": F.max(F.struct("_block", "_line", "_ends_inside", "_number")).over(whole),
    })
    loose = F.col("_final._ends_inside") & (F.col("_number") == F.col("_final._number"))
    own = final.withColumn("_part", F.when(loose, F.struct("_block", "_line")))
    grouped = own.groupBy(*[c for c in _KEPT if c != "_header"], "_number", "_part").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_line", "value"))).alias("_lines"),
        F.max("_header").alias("_header"),
        F.max(F.col("_part").isNotNull() & F.col("_outside")).alias("_unclosed"),
    )
    record = F.array_join(F.col("_lines.value"), "\n")
    # A header is a record of one line.
    return grouped.select(
        FILE_PATH, FILE_NAME, "_shape", "_width", (F.col("_header") & (F.size("_lines") == 1)).alias("_header"),
        record.alias("_record"), "_unclosed",
    ).where(F.length("_record") > 0)


def _parsed(records: DataFrame, widths: list[int]) -> DataFrame:
    """Fields of every record, by its own header's width, and why it does not fit."""
    text = F.col("_record")
    bare = F.when(text.contains('"'), F.regexp_replace(text, _QUOTED, "")).otherwise(text)
    # Empty fields at the end are no surplus.
    fields = F.length(F.regexp_replace(F.rtrim(bare, F.lit(",")), "[^,]", "")) + 1
    reject = (
        F.when(F.col("_header"), F.lit(HEADER_AGAIN))
        .when(F.col("_unclosed"), F.lit(OPEN_QUOTE))
        .when(fields > F.col("_width"), F.lit(SURPLUS))
    )
    options = {"quote": '"', "escape": '"'}

    fits = {width: F.col("_width") == width for width in widths}
    rows = {
        width: F.from_csv(text, ", ".join(f"c{i} string" for i in range(width)), options) for width in widths
    }
    # A step of its own: taking a field out of the parsed row would parse it again.
    read = records.select(
        FILE_PATH, FILE_NAME, "_shape", "_width", "_record", reject.alias("_reject"),
        *[F.when(fits[width], row).alias(f"_row{width}") for width, row in rows.items()],
    )
    fields = [F.when(fits[w], F.array(*[F.col(f"_row{w}")[f"c{i}"] for i in range(w)])) for w in widths]
    return read.select(FILE_PATH, FILE_NAME, "_shape", "_record", F.coalesce(*fields).alias("_fields"), "_reject")


def decoded(path: Column) -> Column:
    """Path text with percent escapes resolved (a plus sign stays one)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
