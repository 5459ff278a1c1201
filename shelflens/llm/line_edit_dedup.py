"""Near-duplicate lines by a segment-partition edit join, in DataFrame functions only.

How many edits are near grows with the length of the shorter line, in `bands`.
Two lines within `max_edits` edits: lay `max_edits + 1` segments of one size over
the shorter, half of them from its beginning and half from its end; one of them
occurs unchanged in the longer, the i-th from either end moved by i places at
most.  Were none of them found so, i + 1 edits would be needed up to the i-th,
from both ends more than allowed.  The size is fixed by a class of lengths, so a
line looks for segments of its own class and of those that a shorter line within
reach can be in, not of every length.

A segment is known by the least hash of its grams (of one length, given by its
size).  Equal segments have equal least hashes, and of the places where a segment
is looked for, one beside the other, most share theirs.  So a line is written
under few keys.  All lines are dealt by key once, and those that meet none of a
length within reach are gone before any pair is made.  Lines that meet are
candidates if their lengths and the counts of their letters on either side of
seven splits can be reconciled by the edits allowed, which keeps the many variants
of one sentence from being paired with each other.  Candidates are
verified by edit distance over a diagonal band of `2 * max_edits + 1` cells held
in the bits of one number.

A line is dropped when an equal line, or a near one, stands earlier in the
corpus (by document id, null ids last, then text hash and line number).  Lines
shorter than the first band are compared for equality only; lines without a word
take no part and stay.

Defined cases: a null text stays null and has no lines; an empty text has one
empty line, which stays; a document all of whose lines go keeps an empty text;
repeated rows (same id, same text) are treated alike; other columns are passed
on whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..staging import stage, unstage

#: (length, edits): lines are near within so many edits if the shorter one has at least that length.
BANDS = ((6, 2), (60, 3), (80, 4), (120, 6))
#: Shorter lines are compared for equality only; segments need more than twice the edits.
MIN_CHARS = BANDS[0][0]
#: (size, grams): of so many neighbouring grams of a segment of that size or more the least hash stands for it; powers of two.
GRAMS = ((8, 2), (15, 4), (21, 8))
#: Letters whose counts candidates must nearly share; any choice is right, frequent ones tell most.
LETTERS = " etnaisrohdluc"
#: Lines are split at this many places less one, to compare the counts on either side.
PARTS = 8
#: The bits of a line's number that hold by how much a line of the class is shorter at least; of a key, the edits allowed.
_LESS = 4
_EDITS = (1 << _LESS) - 1
#: Six more hold by how much the line is longer than the shortest of the class, this much or more.
_OVER = 63
_ID = (1 << (63 - 6 - _LESS - 1)) - 1
#: One and seven in each of 15 fields of four bits.
_ONES = 0x0111111111111111
_FIELDS = 7 * _ONES
#: Candidate lines up to this number are sent to the tasks; beyond it they are joined by shuffle.
BROADCAST_LINES = 500_000


Bands = tuple[tuple[int, int], ...]


def wide(line: Column) -> Column:
    """The line with four bytes to the character, so that a part of it is found without counting."""
    return F.encode(line, "UTF-32")


def segment_reads(max_edits: int) -> list[tuple[int, int]]:
    """(segment, shift): the places where a segment of the shorter line is looked for in the longer.

    Segments 0, 1, ... count from the beginning, -1, -2, ... from the end.
    """
    left = max_edits // 2 + 1
    return [
        (segment, shift)
        for segment in (*range(left), *range(left - max_edits - 1, 0))
        for shift in _shifts(segment)
    ]


def _shifts(segment: int) -> range:
    most = segment if segment >= 0 else -1 - segment
    return range(-most, most + 1)


def _edits(length: Column, bands: Bands) -> Column:
    """Edits allowed where the shorter line has this length."""
    table = [max((e for least, e in bands if least <= n), default=bands[0][1]) for n in range(bands[-1][0] + 1)]
    return F.get(F.lit(table), F.greatest(F.least(length, F.lit(bands[-1][0])), F.lit(0)))


def _first(n: Column, bands: Bands) -> Column:
    """The first length of the class of a length; 0 below the first band."""
    table = [0] * bands[0][0]
    for (least, edits), (end, _) in zip(bands, bands[1:]):
        width = edits + least // 4
        last = max((end - least) // width, 1) - 1  # what is left over belongs to the last class
        table += [min((at - least) // width, last) * width + least for at in range(least, end)]
    least, edits = bands[-1]
    return F.when(n < least, F.get(F.lit(table), F.greatest(n, F.lit(0)))).otherwise(n - (n - least) % (edits + least // 4))


def segment_keys(cut: DataFrame, reads_of: Callable[[int], list[tuple[int, int]]], bands: Bands, id_name: str, shorter: bool) -> DataFrame:
    """`key`, `id_name` per line and gram that stands for a segment; lines as `line_id`, `n` (length) and `text` (wide).

    A segment is known by the least hash of its grams, so that the places where it
    is looked for, one beside the other, give few different keys.  `shorter`: for
    every class within reach, not the line's own only.  The last bits of `id_name`
    hold by how much a line of the class is shorter at least and whether the key is
    of the line's own segment, the first by how much the line is longer than the
    shortest of the class.  One row per segment, and the grams in steps, keep the generated code
    small enough to be compiled.
    """
    n = F.col("n")
    reach = range(bands[-1][1] + 1 if shorter else 1)
    # By how much a line of a class is shorter at least.
    near = cut.select("line_id", "n", "text", *[_first(n - less, bands).alias(f"first{less}") for less in reach])
    classes = F.array(*[
        F.when((F.col(f"first{less}") > 0) & ((F.col(f"first{less}") != F.col(f"first{max(less - 1, 0)}")) | F.lit(less == 0)), less)
        for less in reach
    ])
    named = near.select("line_id", "n", "text", F.explode(classes).alias("less")).where("less IS NOT NULL")
    short = n - F.col("less")
    sized = named.select(
        "line_id", "n", "text", "less", _first(short, bands).alias("first"), _edits(short, bands).alias("edits")
    ).where("edits >= less")
    reads = {edits: reads_of(edits) for _, edits in bands}
    most = max(shift for held in reads.values() for _, shift in held)
    listed = F.lit(None)
    for edits, held in reads.items():
        moved = {segment: max(shift for s, shift in held if s == segment) for segment, _ in held}
        places = [F.struct(F.lit(segment).alias("segment"), F.lit(far).alias("far")) for segment, far in moved.items()]
        listed = F.when(F.col("edits") == edits, F.array(*places)).otherwise(listed)
    size = F.floor(F.col("first") / (F.col("edits") + 1)).cast("int")
    grams, widest = F.lit(1), GRAMS[-1][1]
    for least, held in GRAMS:
        grams = F.when(F.col("size") >= least, held).otherwise(grams)
    over = F.least(n - F.col("first"), F.lit(_OVER)).cast("long")
    line = F.shiftleft(over, 63 - 6).bitwiseOR(F.shiftleft("line_id", _LESS + 1)).bitwiseOR(F.shiftleft(F.col("less"), 1).cast("long"))
    each = sized.select("text", "n", line.alias("line"), "less", "first", "edits", size.alias("size"), F.inline(listed)).select(
        "text", "n", "line", "less", "size", "far", grams.alias("grams"),
        (F.col("segment") * F.col("size") + F.when(F.col("segment") < 0, n).otherwise(0)).alias("start"),
        F.xxhash64("first", "segment").alias("salt"), "edits",
    )
    start, far, grams = F.col("start"), F.col("far"), F.col("grams")
    placed = each.select(
        "text", "line", "less", "grams", "salt", "edits", "far", (far + grams).alias("end"),
        F.greatest(-far, -start).alias("low"), F.least(far, n - F.col("size") - start).alias("high"),
        (4 * start + 1).alias("begin"), (4 * (F.col("size") - grams + 1)).alias("long"),
    )
    passed = ["line", "less", "grams", "low", "high", "salt", "edits"]
    steps = placed.select(*passed, *[
        F.when((far >= -at) & (F.col("end") > at), F.xxhash64(F.substring("text", F.col("begin") + 4 * at, F.col("long")))).alias(f"at{at}")
        for at in range(-most, most + widest)
    ])
    # The least of 2, 4, ... neighbours.
    behind, over = most + widest, 1
    while over < widest:
        behind -= over
        steps = steps.select(*passed, *[
            F.when(grams > over, F.least(f"at{at}", f"at{at + over}")).otherwise(F.col(f"at{at}")).alias(f"at{at}")
            for at in range(-most, behind)
        ])
        over *= 2
    held = steps.select("line", "less", "salt", "edits", *[
        F.when((F.col("low") <= at) & (F.col("high") >= at), F.col(f"at{at}")).alias(f"at{at}") for at in range(-most, most + 1)
    ])
    runs = F.array(F.col(f"at{-most}"), *[
        F.when(~F.col(f"at{at}").eqNullSafe(F.col(f"at{at - 1}")), F.col(f"at{at}")) for at in range(1 - most, most + 1)
    ])
    own = (F.col("less") == 0) & (F.col("gram") == F.col("at0"))
    return held.select("line", "less", "at0", "salt", "edits", F.explode(runs).alias("gram")).where("gram IS NOT NULL").select(
        F.col("line").bitwiseOR(F.coalesce(own, F.lit(False)).cast("long")).alias(id_name),
        F.xxhash64("salt", "gram").bitwiseAND(F.lit(~_EDITS)).bitwiseOR(F.col("edits").cast("long")).alias("key"),
    )


def banded_distance(a: Column, b: Column, max_edits: int) -> Column:
    """Edit distance of two texts where it is at most `max_edits`; else some larger number.

    Bit i of the vectors is row `column - max_edits + i` of the edit matrix.  The
    distance is followed down the lower edge of the band to the last row of `a`,
    then along that row.  Where the band holds one least diagonal from which all
    values grow by one a cell, a run of equal letters on it changes nothing and is
    passed in one go; a column without a value of at most `max_edits` ends the
    work.  Lengths must differ by `max_edits` at most, and `a`
    must be longer than `max_edits`.
    """
    k = max_edits
    width = 2 * k + 1
    full = (1 << width) - 1

    def lit(value: int) -> Column:
        return F.lit(value).cast("long")

    def flip(value: Column) -> Column:
        return value.bitwiseXOR(lit(full))

    def bit(value: Column, place: Column) -> Column:
        return F.call_function("shiftright", value, place.cast("int")).bitwiseAND(lit(1))

    def equal_rows(rows: Column, letter: Column, j: Column) -> Column:
        same = lit(0)
        for i in range(width):
            same = same + F.when(F.get(rows, j - k + i - 1) == letter, lit(1 << i)).otherwise(lit(0))
        return same

    def step(both: Column, state: Column) -> Column:
        up, down, j, m = state["up"], state["down"], state["at"], both["m"]
        letter = F.get(both["columns"], j - 1)
        return _let(equal_rows(both["rows"], letter, j), lambda same: _let(
            (same.bitwiseAND(up) + up).bitwiseAND(lit(full)).bitwiseXOR(up).bitwiseOR(same).bitwiseOR(down),
            lambda flat: _let(
                F.struct(down.bitwiseOR(flip(flat.bitwiseOR(up))).alias("more"), flat.bitwiseAND(up).alias("less")),
                lambda right: F.struct(
                    right["less"].bitwiseOR(flip(F.shiftright(flat, 1).bitwiseOR(right["more"]))).alias("up"),
                    F.shiftright(flat, 1).bitwiseAND(right["more"]).alias("down"),
                    (state["distance"] + F.when(j <= m - k, 1 - bit(flat, F.lit(width - 1))).otherwise(
                        bit(right["more"], m - j + k) - bit(right["less"], m - j + k)
                    )).alias("distance"),
                    (j + 1).alias("at"),
                ),
            ),
        ))

    def moved(state: Column, distance: Column, at: Column) -> Column:
        return F.struct(state["up"].alias("up"), state["down"].alias("down"), distance.alias("distance"), at.alias("at"))

    def row(state: Column) -> Column:
        return state["at"] - k + F.bit_count(state["down"])

    def funnel(both: Column, state: Column) -> Column:
        """All values grow from one diagonal outwards, and the next letters on it are equal."""
        down = state["down"]
        return (
            (state["at"] <= both["m"] - k) & (state["up"] == flip(down)) & (state["up"] != 0)
            & (down.bitwiseAND(down + 1) == 0)
            & (F.get(both["rows"], row(state) - 1) == F.get(both["columns"], state["at"] - 1))
        )

    def run(both: Column, state: Column) -> Column:
        """Behind the equal letters of the diagonal: they leave the band as it is."""
        rest = F.struct(
            F.substring(both["a"], row(state), both["m"]).alias("a"),
            F.substring(both["b"], state["at"], both["n"]).alias("b"),
            F.least(both["m"] - k, both["n"]).alias("end"),
        )
        return _let(rest, lambda r: moved(
            state, state["distance"],
            state["at"] + _common(F.left, r["a"], r["b"], r["end"] - state["at"] + 1),
        ))

    def move(both: Column, state: Column) -> Column:
        least = state["distance"] - F.bit_count(state["up"].bitwiseAND(lit(full >> 1)))
        return (
            F.when(state["at"] > both["n"], state)
            .when(least > k, moved(state, lit(k + 1), both["n"] + 1))
            .when(funnel(both, state), run(both, state))
            .otherwise(step(both, state))
        )

    start = F.struct(
        lit(((1 << (k + 1)) - 1) << k).alias("up"), lit(0).alias("down"), lit(k).alias("distance"), F.lit(1).alias("at"),
    )
    # Bound once: inside the lambda the texts would be cut again for every letter.
    letters = F.struct(
        a.alias("a"), b.alias("b"), F.split(a, "").alias("rows"), F.split(b, "").alias("columns"),
        F.char_length(a).alias("m"), F.char_length(b).alias("n"),
    )
    return _let(letters, lambda both: F.aggregate(
        F.sequence(F.lit(1), both["n"]), start, lambda state, _: move(both, state),
        lambda state: state["distance"],
    ))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), 0)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per line that takes part: its document, place, text and two hashes of it."""
    text = docs[text_col].cast("string")
    cut = docs.select(
        docs[id_col].alias("doc_id"), F.xxhash64(text).alias("text_key"),
        F.posexplode(F.split(text, "\n")).alias("pos", "line"),
    )
    return cut.where(F.ltrim("line", F.lit(" \t\n\x0b\x0c\r")) != "").select(
        "doc_id", "text_key", "pos", "line",
        *_line_hashes("line", "line"),
    )


def _packed(piece: Column) -> Column:
    """Counts of the letters of `LETTERS` and of all other characters, modulo 8, four bits each."""
    size = F.octet_length(piece)
    counts = [size - F.octet_length(F.replace(piece, F.lit(letter), F.lit(""))) for letter in LETTERS]
    fields = [*counts, F.char_length(piece) - reduce(Column.__add__, counts)]
    return reduce(Column.bitwiseOR, [F.shiftleft(c.bitwiseAND(F.lit(7)).cast("long"), 4 * i) for i, c in enumerate(fields)])


def _ringed(x: Column) -> Column:
    """Fields that differ in as many bits as their numbers differ, modulo 8: 0, 1, 11, 111, 1111, 1110, 1100, 1000."""
    low, middle, high = (F.shiftright(x, i).bitwiseAND(F.lit(_ONES)) for i in range(3))
    return (
        high.bitwiseXOR(low.bitwiseOR(middle))
        .bitwiseOR(F.shiftleft(high.bitwiseXOR(middle), 1))
        .bitwiseOR(F.shiftleft(high.bitwiseXOR(low.bitwiseAND(middle)), 2))
        .bitwiseOR(F.shiftleft(high, 3))
    )


def _traits(lines: DataFrame, bands: Bands) -> DataFrame:
    """`who`, `line_id`, `n`, `traits`: the letter counts of parts of every line; lines as `who`, `line_id`, `n`, `line`.

    The parts: the first 1, 2, ... `PARTS - 1` eighths of the least length of the
    class, from the beginning, then as many from the end; the same places in any two
    lines of the class.  One row per eighth keeps the generated code small.
    """
    ends = 2 * (PARTS - 1)
    size = F.floor(_first(F.col("n") - _less("who"), bands) / PARTS).cast("int")
    other = F.xxhash64("line", F.lit("second")).alias("check")  # lines that share an id stay apart
    cut = lines.select("who", "line_id", "n", "line", other, size.alias("size"), F.explode(F.sequence(F.lit(0), F.lit(ends - 1))).alias("at"))
    begin = F.when(F.col("at") < PARTS - 1, F.col("at") * F.col("size")).otherwise(F.col("n") - (F.col("at") - PARTS + 2) * F.col("size"))
    pieces = cut.select("who", "line_id", "n", "check", "at", F.substring("line", begin + 1, F.col("size")).alias("piece"))
    each = pieces.select("who", "line_id", "n", "check", "at", _packed(F.col("piece")).alias("packed"))
    line = each.groupBy("who", "line_id", "n", "check").agg(*[F.max(F.when(F.col("at") == i, F.col("packed"))).alias(f"at{i}") for i in range(ends)])
    sums = []
    for i in range(ends):
        sums.append(F.col(f"at{i}") if i % (PARTS - 1) == 0 else (sums[-1] + F.col(f"at{i}")).bitwiseAND(F.lit(_FIELDS)))
    added = line.select("who", "line_id", "n", *[x.alias(f"at{i}") for i, x in enumerate(sums)])
    return added.select("who", "line_id", "n", F.array(*[_ringed(F.col(f"at{i}")) for i in range(ends)]).alias("traits"))


def _open_splits(a: Column, b: Column, edits: Column) -> Column:
    """Whether the counts of two lines leave it open, wherever they are split, that they are within the edits.

    Edits in the first p characters of one line change the counts of the first p of
    the other by as many letters lost and gained at most, and so from the end.
    Parts that do not overlap share no edit: the differences of both add up to twice
    the edits at most.
    """
    def apart(i: int) -> Column:
        return F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i)))

    return reduce(Column.__and__, [apart(i) + apart(2 * PARTS - 3 - i) <= 2 * edits for i in range(PARTS - 1)])


def meeting_lines(lines: DataFrame) -> DataFrame:
    """`line_id`, `line`, `n` (length), `copies`, `traits` (letter counts) for every different line; the id is a hash.

    Different lines can share an id: it only serves to find candidates.
    """
    n = F.char_length("line")
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("copies")).select(
        F.xxhash64("line").bitwiseAND(F.lit(_ID)).alias("line_id"), "line", n.alias("n"), "copies", _packed(F.col("line")).alias("traits"),
    )


def _met(different: DataFrame, bands: Bands) -> DataFrame:
    """`key`, `line`: of the keys of all lines those under which different lines meet."""
    cut = different.where(F.col("n") >= bands[0][0]).select("line_id", "n", wide(F.col("line")).alias("text"))
    keys = segment_keys(cut, segment_reads, bands, "line", True)
    keyed = Window.partitionBy("key")
    alone = keys.select("key", "line", F.count(F.lit(1)).over(keyed).alias("lines"))
    group = keyed.orderBy("line")

    def over(line: Column) -> Column:
        return F.shiftright(line, 63 - 6)

    # Lines come by length: where the next to either side is too far, all are.
    seen = alone.where("lines > 1").select("key", "line", F.lag("line").over(group).alias("before"), F.lead("line").over(group).alias("behind"))
    edits = F.col("key").bitwiseAND(F.lit(_EDITS))
    close = (over(F.col("line")) - over(F.col("before")) <= edits) | (over(F.col("behind")) - over(F.col("line")) <= edits)
    return stage(seen.where(close).select("key", "line"), "met")


def _meeting(different: DataFrame, bands: Bands) -> tuple[DataFrame, DataFrame]:
    """`met`, and of the lines those that it names."""
    met = _met(different, bands)
    ids = stage(met.select(_id("line").alias("line_id")).distinct(), "met-lines")
    some = stage(different.select("line_id", "line", "n").join(_small(ids), "line_id", "left_semi"), "met-texts")
    unstage(ids)
    return met, some


def _less(line: str) -> Column:
    return F.shiftright(line, 1).bitwiseAND(F.lit((1 << _LESS) - 1)).cast("int")


def _id(line: str) -> Column:
    return F.shiftright(line, _LESS + 1).bitwiseAND(F.lit(_ID))


def _small(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES else ids


def _open_pairs(met: DataFrame, some: DataFrame, bands: Bands) -> DataFrame:
    """A pair that meets under several keys is made under the least of them."""
    who, own = F.col("line").bitwiseAND(F.lit(~1)), F.col("line").bitwiseAND(F.lit(1)) == 1
    known = met.groupBy(who.alias("who")).agg(
        F.collect_set(F.when(own, F.col("key"))).alias("own_keys"), F.collect_set("key").alias("keys"),
    )
    named = met.select(who.alias("who")).distinct().withColumn("line_id", _id("who"))
    traits = stage(_traits(named.join(some, "line_id"), bands).join(known, "who"), "traits")
    rows = met.select("key", own.alias("own"), who.alias("who")).join(traits, "who")
    index = rows.where("own").select("key", *[F.col(c).alias(f"a_{c}") for c in ("line_id", "n", "own_keys", "traits")])
    probe = rows.select("key", *[F.col(c).alias(f"b_{c}") for c in ("line_id", "n", "keys", "traits")])
    a, b, longer, edits = F.col("a_line_id"), F.col("b_line_id"), F.col("b_n") - F.col("a_n"), _edits(F.col("a_n"), bands)
    # The shorter line is looked for; of two of one length either finds the other, and one direction is enough.
    open_pair = (
        (longer >= 0) & (longer <= edits) & ((longer > 0) | (a < b)) & (a != b)
        & _open_splits(F.col("a_traits"), F.col("b_traits"), edits)
        & (F.col("key") == F.array_min(F.array_intersect("a_own_keys", "b_keys")))
    )
    made = index.join(probe, "key").where(open_pair)
    pairs = stage(made.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "candidates")
    unstage(traits)
    return pairs


def candidate_pairs(different: DataFrame, bands: Bands) -> DataFrame:
    """`a`, `b` (a < b): ids of different lines that meet under a segment key and can be within reach.

    No pair is made before the lines that meet nothing are gone.
    """
    met, some = _meeting(different, bands)
    pairs = _open_pairs(met, some, bands)
    for part in (met, some):
        unstage(part)
    return pairs


def _common(take: Callable[[Column, Column], Column], a: Column, b: Column, most: Column) -> Column:
    """How many characters two texts share at one end (`take`), `most` at most, by halving."""
    rounds = F.ceil(F.log2(most + 1)).cast("int")

    def step(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        return _let(F.shiftright(low + high + 1, 1), lambda half: F.when(
            take(a, half) == take(b, half), F.struct(half.alias("low"), high.alias("high"))
        ).otherwise(F.struct(low.alias("low"), (half - 1).alias("high"))))

    start = F.struct(F.lit(0).alias("low"), most.alias("high"))
    return F.aggregate(F.sequence(F.lit(0), rounds), start, step, lambda state: state["low"])


def without_common_ends(a: Column, b: Column, max_edits: int) -> Column:
    """The two texts (`a`, `b`) without equal beginnings and ends, which cost no edits; enough stays for the band."""
    def spare(both: Column) -> Column:
        shorter = F.least(F.char_length(both["a"]), F.char_length(both["b"]))
        return F.greatest(shorter - (2 * max_edits + 2), F.lit(0))

    def behind(both: Column) -> Column:
        return _let(_common(F.left, both["a"], both["b"], spare(both)), lambda n: F.struct(*[
            F.substring(both[c], n + 1, F.char_length(both[c])).alias(c) for c in ("a", "b")
        ]))

    def before(both: Column) -> Column:
        return _let(_common(F.right, both["a"], both["b"], spare(both)), lambda n: F.struct(*[
            F.left(both[c], F.char_length(both[c]) - n).alias(c) for c in ("a", "b")
        ]))

    return _let(_let(F.struct(a.alias("a"), b.alias("b")), behind), before)


#: Characters counted in every candidate line; all others are one class more.  Any choice is right, frequent ones tell most.
COUNTED = "etnaisrohdlucwbfy .,"


def _counts(line: Column) -> Column:
    """How often each of `COUNTED` and all other characters occur."""
    size = F.octet_length(line)
    counts = [size - F.octet_length(F.replace(line, F.lit(c), F.lit(""))) for c in COUNTED]
    return F.array(*counts, F.char_length(line) - reduce(Column.__add__, counts))


def reconcilable(a: Column, b: Column, n_a: Column, n_b: Column, bands: Bands) -> Column:
    """Whether the counts and lengths of two lines leave it open that they are within reach.

    An edit adds one at most to what is gained and one to what is lost.  The two together are the sum
    of the differences, and they differ by the lengths.
    """
    gap = F.abs(n_a - n_b)
    for i in range(len(COUNTED) + 1):
        gap = gap + F.abs(F.get(a, i) - F.get(b, i))
    return gap <= 2 * _edits(F.least(n_a, n_b), bands)


def within_reach(a: Column, b: Column, bands: Bands) -> Column:
    """Whether two lines are within the edits of the shorter one's band.

    What both begin and end with is cut off; the rest is followed along the band.
    """
    def near(n_a: Column, n_b: Column) -> Column:
        n = F.least(n_a, n_b)
        verdict = F.lit(False)
        for least, edits in bands:
            found = _let(without_common_ends(a, b, edits), lambda r, edits=edits: banded_distance(r["a"], r["b"], edits) <= edits)
            verdict = F.when(n >= least, found).otherwise(verdict)
        return F.when(F.abs(n_a - n_b) <= _edits(n, bands), verdict).otherwise(F.lit(False))

    return near(F.char_length(a), F.char_length(b))


def line_links(different: DataFrame, bands: Bands) -> DataFrame:
    """Pairs of different lines within the edits of `bands`, each in both directions; the staged lines are freed.

    `a_key`, `a_check`, `b_key`, `b_check`: the two hashes of either line.
    """
    met, some = _meeting(different, bands)
    unstage(different)
    pairs = _open_pairs(met, some, bands)
    unstage(met)
    ends = stage(pairs.select(F.col("a").alias("line_id")).union(pairs.select("b")).distinct(), "candidate-lines")
    paired = some.join(_small(ends), "line_id", "left_semi")
    texts = stage(paired.select("line_id", "line", "n", _counts(F.col("line")).alias("counts")), "texts")
    unstage(some)
    left = texts.toDF("a", "line_a", "n_a", "counts_a")
    right = texts.toDF("b", "line_b", "n_b", "counts_b")
    # Counted once a line, compared before anything of a pair is cut or followed.
    open_pairs = pairs.join(left, "a").join(right, "b").where(
        reconcilable(F.col("counts_a"), F.col("counts_b"), F.col("n_a"), F.col("n_b"), bands)
    )
    # Dealt out evenly: verifying is the costly part, and pairs of one line lie together.
    met = open_pairs.select("a", "b", "line_a", "line_b").repartition(F.xxhash64("a", "b"))
    near = met.where(within_reach(F.col("line_a"), F.col("line_b"), bands))
    found = stage(near.select(*_line_hashes("line_a", "a"), *_line_hashes("line_b", "b")).distinct(), "line-links")
    names = ["a_key", "a_check", "b_key", "b_check"]
    return found.union(found.select(*[F.col(n) for n in names[2:] + names[:2]]).toDF(*names))


def _line_hashes(line: str, name: str) -> list[Column]:
    return [F.xxhash64(line).alias(f"{name}_key"), F.xxhash64(line, F.lit("second")).alias(f"{name}_check")]


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "pos")


def line_verdicts(
    docs: DataFrame, bands: Bands = BANDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row per line that occurs again or is near to another: `doc_id`, `text_key`, `pos`, `n_links`, `exact`, `near`.

    `exact`: an equal line stands earlier; `near`: one within the edits of `bands`
    does; `n_links`: different lines within them.
    """
    if any(least <= 2 * e or e > _EDITS for least, e in bands) or any(a >= c or b > d for (a, b), (c, d) in zip(bands, bands[1:])):
        raise ValueError(f"bands must rise, with lines of more than twice the edits and {_EDITS} edits at most")
    lines = _lines(docs, id_col, text_col)
    line = ["line_key", "line_check"]
    different = stage(meeting_lines(lines).drop("traits"), "different-lines")
    repeated = stage(different.where("copies > 1").select(*_line_hashes("line", "line")), "repeated-lines")
    links = line_links(different, bands)
    told = stage(repeated.union(links.select("a_key", "a_check")).distinct(), "told-lines")
    places = stage(lines.drop("line").join(_small(told), line, "left_semi"), "places")
    distinct = stage(
        places.groupBy("line_key", "line_check").agg(F.min(_place()).alias("first")), "distinct-lines"
    )
    # Only lines that link to another go through these joins.
    linked = distinct.join(links.select("a_key", "a_check").toDF(*line).distinct(), line)
    near = (
        links.join(linked.select(*line, F.col("first").alias("own")).toDF("a_key", "a_check", "own"), ["a_key", "a_check"])
        .join(linked.select(*line, F.col("first").alias("other")).toDF("b_key", "b_check", "other"), ["b_key", "b_check"])
        .groupBy(F.col("a_key").alias("line_key"), F.col("a_check").alias("line_check"))
        .agg(F.count(F.lit(1)).alias("n_links"), F.max(F.col("other") < F.col("own")).alias("near"))
    )
    judged = distinct.join(near, line, "left")
    return places.join(judged, ["line_key", "line_check"]).select(
        "doc_id", "text_key", "pos", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (_place() > F.col("first")).alias("exact"), F.coalesce("near", F.lit(False)).alias("near"),
    )


def dedup_lines(
    docs: DataFrame, bands: Bands = BANDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """`row` (the input row), `lines_kept` (text without its dropped lines) and counts per document."""
    verdicts = line_verdicts(docs, bands, id_col, text_col)
    per_doc = (
        # Rows with the same id and text give the same verdicts: one is enough.
        verdicts.where("exact OR near OR n_links > 0")
        .groupBy("doc_id", "text_key", "pos")
        .agg(F.max("n_links").alias("n_links"), F.max("exact").alias("exact"), F.max("near").alias("near"))
        .groupBy("doc_id", "text_key")
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("exact") | F.col("near"), F.col("pos")))).alias("dropped"),
            F.sum("n_links").alias("n_links"),
            F.count_if(F.col("exact")).alias("n_exact"),
            F.count_if(F.col("near") & ~F.col("exact")).alias("n_near"),
        )
    )
    text = docs[text_col].cast("string")
    held = docs.select(
        F.struct("*").alias("row"), docs[id_col].alias("_id"), F.xxhash64(text).alias("_key"), text.alias("_text")
    )
    joined = held.join(
        per_doc, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key")), "left"
    )
    before = F.when(F.size("dropped") > 0, F.col("dropped"))

    def rest(both: Column) -> Column:
        """The runs of lines between one dropped line and the next; the text is cut once."""
        at, cut = both["at"], both["cut"]
        return F.flatten(F.transform(
            F.sequence(F.lit(0), F.size(at)),
            lambda i: _let(
                F.coalesce(F.get(at, i - 1), F.lit(-1)) + 1,
                lambda start: F.slice(cut, start + 1, F.coalesce(F.get(at, i), F.size(cut)) - start),
            ),
        ))

    kept = F.when(before.isNotNull(), F.array_join(
        _let(F.struct(before.alias("at"), F.split("_text", "\n").alias("cut")), rest), "\n"
    ))
    n_lines = F.octet_length("_text") - F.octet_length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1
    zero = F.lit(0).cast("long")
    return joined.select(
        "row",
        F.coalesce(kept, F.col("_text")).alias("lines_kept"),
        F.coalesce(n_lines.cast("long"), zero).alias("n_lines"),
        *[F.coalesce(c, zero).cast("long").alias(c) for c in ("n_links", "n_exact", "n_near")],
    )


def without_repeated_lines(
    docs: DataFrame, bands: Bands = BANDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The documents with their text cut to the lines that stay; columns as they were."""
    done = dedup_lines(docs, bands, id_col, text_col)
    return done.select(*[
        (F.col("lines_kept") if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns
    ])
