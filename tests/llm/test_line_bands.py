"""Lines near by a number of edits that grows with their length, and short lines."""

from __future__ import annotations

import random
from collections import Counter

from shelflens.llm import line_edit_dedup


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def kept(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: (r.lines_kept, r.n_links) for r in line_edit_dedup.dedup_lines(docs).select("row.doc_id", "lines_kept", "n_links").collect()}


def test_edits_grow_with_length(spark):
    rng = random.Random(5)
    lines = []
    for length in (58, 62, 83, 125, 167):
        line = "".join(rng.choice("abcdé 1😀") for _ in range(length - 1)) + "."
        lines.append(line)
        for edits in range(1, 11):
            for kind in ("swap", "cut", "mix"):
                new = list(line)
                for _ in range(edits):
                    at = rng.randrange(len(new))
                    new[at:at + (kind != "mix" or rng.random() < 0.5)] = [] if kind == "cut" else [rng.choice("XYZ")]
                lines.append("".join(new))
    lines = list(dict.fromkeys(lines))

    def near(a, b):
        edits = next(e for least, e in reversed(line_edit_dedup.BANDS) if min(len(a), len(b)) >= least)
        return abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits

    links = [[j for j, b in enumerate(lines) if i != j and near(a, b)] for i, a in enumerate(lines)]
    got = kept(spark, lines)
    for i, line in enumerate(lines):
        assert got[i] == ("" if any(j < i for j in links[i]) else line, len(links[i]))


def test_a_word_swapped_in_a_long_line(spark):
    line = " ".join(f"number{i * 7919 % 1000}" for i in range(20))
    assert len(line) > 160
    got = kept(spark, [line, line.replace("number919 ", "value919 ")])
    assert got[1] == ("", 1)


def test_short_equal_lines_go(spark):
    got = kept(spark, ["Ja\n\n \nMenu open", "Ja\nNo\n \nMenu open", "Ja"])
    assert {i: text for i, (text, _) in got.items()} == {0: "Ja\n\n \nMenu open", 1: "No\n ", 2: ""}


def test_counts_tell_lines_apart_that_edits_cannot_reconcile(spark):
    """No pair within reach is ruled out; lines that gain more than the edits allow are, whatever they lose."""
    from pyspark.sql import functions as F

    rng = random.Random(8)
    rows = []
    for length in (20, 70, 100, 130):
        allowed = next(e for least, e in reversed(line_edit_dedup.BANDS) if length - 7 >= least)
        for edits in (*range(allowed + 1), 30):
            a = [rng.choice("etaoin,. z😀é") for _ in range(length)]
            b = list(a)
            for _ in range(edits):
                at = rng.randrange(len(b))
                b[at:at + rng.randrange(2)] = rng.choice(["", "e", "x", "日"])
            rows.append(("".join(a), "".join(b)))
    # Four letters come, none goes: four edits, though the sum of the differences is within twice the two allowed.
    rows.append(("abcdefghijklmnopqrst", "abcdefghijklmnopqrsteeee"))

    def parts(name):
        return line_edit_dedup._counts(F.col(name)), F.char_length(name)

    (counts_a, n_a), (counts_b, n_b) = parts("a"), parts("b")
    frame = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", line_edit_dedup.reconcilable(counts_a, counts_b, n_a, n_b, line_edit_dedup.BANDS).alias("open")
    )
    for r in frame.collect():
        allowed = next(e for least, e in reversed(line_edit_dedup.BANDS) if min(len(r.a), len(r.b)) >= least)
        if edit_distance(r.a, r.b) <= allowed:
            assert r.open, r
        lost = sum((Counter(r.a) - Counter(r.b)).values())
        if lost == 0 and len(r.b) - len(r.a) > allowed:
            assert not r.open, r


def test_a_segment_of_every_near_pair_is_found(spark):
    """Edits packed anywhere, lengths on both sides of every class: one read meets one segment."""
    rng = random.Random(11)
    lines = []
    for length in (6, 7, 8, 9, 14, 58, 59, 60, 61, 77, 78, 79, 80, 84, 118, 119, 120, 121, 125, 155, 156, 160, 300):
        for _ in range(12):
            a = "".join(rng.choice("ab é") for _ in range(length - 1)) + "."
            allowed = next(e for least, e in reversed(line_edit_dedup.BANDS) if length >= least)
            b, at = list(a), rng.randrange(length)
            for _ in range(allowed):  # in one place, or all over
                place = min(at, len(b)) if rng.random() < 0.5 else rng.randrange(len(b) + 1)
                b[place:place + rng.randrange(2)] = rng.choice(["", "x", "y"])
            lines += [a, "".join(b)]
    frame = spark.createDataFrame([(x,) for x in dict.fromkeys(lines)], "line string")
    different = line_edit_dedup.meeting_lines(frame).localCheckpoint()
    line_of = {r.line_id: r.line for r in different.collect()}
    pairs = line_edit_dedup.candidate_pairs(different, line_edit_dedup.BANDS).collect()
    got = {frozenset((line_of[r.a], line_of[r.b])) for r in pairs}
    assert len(got) == len(pairs)
    near = 0
    for a, b in zip(lines[::2], lines[1::2]):
        short = min(len(a), len(b))
        allowed = next((e for least, e in reversed(line_edit_dedup.BANDS) if short >= least), 0)
        if a != b and edit_distance(a, b) <= allowed:
            near += 1
            assert frozenset((a, b)) in got, (a, b)
    assert near > 150


def test_a_line_is_looked_for_at_few_places(spark):
    """The lines of one class share their segments: no read for every length, and few rows to a join."""
    from pyspark.sql import functions as F

    assert {e: len(line_edit_dedup.segment_reads(e)) for e in (2, 3, 4, 6)} == {2: 5, 3: 8, 4: 13, 6: 25}
    lines = [("".join(chr(97 + (i * k) % 26) for k in range(1, 161)) + str(i),) for i in range(1, 20)]
    different = line_edit_dedup.meeting_lines(spark.createDataFrame(lines, "line string"))
    cut = different.select("line_id", "traits", "n", line_edit_dedup.wide(F.col("line")).alias("text"))
    probe = line_edit_dedup.segment_keys(cut, line_edit_dedup.segment_reads, line_edit_dedup.BANDS, "b", True)
    assert probe.count() <= 2 * 25 * len(lines)


def test_variants_of_a_sentence_are_told_apart_before_they_are_paired(spark):
    """Lines that share all but two words meet under most segments; few of the pairs are made."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghiklmnoprstuvwy") for _ in range(rng.randint(5, 9))) for _ in range(400)]
    base = [rng.choice(words) for _ in range(30)]
    lines = set()
    while len(lines) < 150:
        new = list(base)
        for at in rng.sample(range(30), 2):
            new[at] = rng.choice(words)
        lines.add(" ".join(new))
    different = line_edit_dedup.meeting_lines(spark.createDataFrame([(x,) for x in lines], "line string")).localCheckpoint()
    pairs = line_edit_dedup.candidate_pairs(different, line_edit_dedup.BANDS).count()
    assert pairs < 0.3 * 150 * 149 / 2


def test_places_beside_each_other_share_their_keys(spark):
    """A segment is looked for at 25 places of a long line, under half as many keys."""
    from pyspark.sql import functions as F

    rng = random.Random(4)
    lines = [("".join(rng.choice("abcdefghij ") for _ in range(400)),) for _ in range(50)]
    different = line_edit_dedup.meeting_lines(spark.createDataFrame(lines, "line string"))
    cut = different.select("line_id", "traits", "n", line_edit_dedup.wide(F.col("line")).alias("text"))
    keys = line_edit_dedup.segment_keys(cut, line_edit_dedup.segment_reads, line_edit_dedup.BANDS, "b", True)
    assert 7 * len(lines) <= keys.count() <= 16 * len(lines)


def test_variants_changed_in_one_place_each_are_told_apart(spark):
    """Two of them differ by what either has gained: counts of the whole line cannot tell, counts of its parts can."""
    rng = random.Random(6)
    base = "".join(rng.choice("etaoinsrhl dc") for _ in range(400))
    lines = set()
    while len(lines) < 150:
        at = rng.randrange(len(base))
        lines.add(base[:at] + "".join(rng.choice("etaoin") for _ in range(5)) + base[at:])
    different = line_edit_dedup.meeting_lines(spark.createDataFrame([(x,) for x in lines], "line string")).localCheckpoint()
    pairs = line_edit_dedup.candidate_pairs(different, line_edit_dedup.BANDS)
    line_of = {r.line_id: r.line for r in different.collect()}
    got = {frozenset((line_of[r.a], line_of[r.b])) for r in pairs.collect()}
    assert len(got) < 0.5 * 150 * 149 / 2
    held = sorted(lines)
    for i, a in enumerate(held[:20]):
        for b in held[i + 1:20]:
            assert frozenset((a, b)) in got or edit_distance(a, b) > 6, (a, b)


def test_ringed_counts_differ_in_as_many_bits_as_the_counts(spark):
    from pyspark.sql import functions as F

    rows = [(x, y) for x in range(8) for y in range(8)]
    frame = spark.createDataFrame(rows, "x long, y long").select(
        "x", "y", F.bit_count(line_edit_dedup._ringed(F.col("x") * 0x11).bitwiseXOR(line_edit_dedup._ringed(F.col("y") * 0x11))).alias("bits")
    )
    assert all(r.bits == 2 * min((r.x - r.y) % 8, (r.y - r.x) % 8) for r in frame.collect())


def test_blank_lines_stay_and_repeated_rows_are_no_repetition(spark):
    """A line of any blanks takes no part; the same row twice holds no line twice."""
    blank = "\x0b\x0c \t\r"
    docs = spark.createDataFrame([(1, f"{blank}\none line\n{blank}"), (1, f"{blank}\none line\n{blank}"), (2, "\x1fone\none line")], "doc_id long, text string")
    got = sorted((r.doc_id, r.lines_kept, r.n_lines, r.n_exact) for r in line_edit_dedup.dedup_lines(docs).select("row.doc_id", "lines_kept", "n_lines", "n_exact").collect())
    assert got == [(1, f"{blank}\none line\n{blank}", 3, 0)] * 2 + [(2, "\x1fone", 2, 1)]
