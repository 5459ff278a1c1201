"""The pipeline end to end, toxicity scores and long bands against plain recomputation."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from shelflens.llm import line_edit_dedup, queries, repetition_rules, textarrays, topk_pivots, toxicity_mil
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def good(text):
    """The quality rules in plain Python, with the limits of the stage."""
    limits, words = repetition_rules.FALLING, WORD.findall(text)
    chars = sum(map(len, words))

    def inside(n):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        count = Counter(grams)
        return {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + n)}

    lines = [line for line in text.split("\n") if WORD.search(line)]
    again = sum(len("".join(WORD.findall(x))) for i, x in enumerate(lines) if x in lines[:i])
    return (
        len(words) >= 10 and 100 * len(inside(5)) <= 20 * len(words) and again <= limits.lines * chars
        and all(sum(len(words[j]) for j in inside(n)) <= most * chars for n, most in limits.ngrams.items())
    )


def near(a, b):
    if min(len(a), len(b)) < line_edit_dedup.MIN_CHARS:
        return False
    edits = next(e for least, e in reversed(line_edit_dedup.BANDS) if min(len(a), len(b)) >= least)
    return abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits


def without_repeats(texts):
    """Texts by id, without the lines that equal or nearly equal an earlier one of the corpus."""
    order = [line for i in sorted(texts) for line in texts[i].split("\n") if WORD.search(line)]
    first = {}
    for at, line in enumerate(order):
        first.setdefault(line, at)
    dropped = {a for a in first for b in first if first[b] < first[a] and near(a, b)}
    seen, out = set(), {}
    for i in sorted(texts):
        kept = []
        for line in texts[i].split("\n"):
            if not WORD.search(line) or line not in seen and line not in dropped:
                kept.append(line)
            seen.add(line)
        out[i] = "\n".join(kept)
    return out


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_of_each(texts):
    label, marks = {i: i for i in texts}, {i: fingerprint(t) for i, t in texts.items()}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if (marks[a] ^ marks[b]).bit_count() <= 2 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: t for i, t in texts.items() if label[i] == i}


def test_pipeline(spark, tmp_path):
    rng = random.Random(21)
    words = ["".join(rng.choice("abdeginorstuéä") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    common = [line(12) for _ in range(4)]
    texts = {}
    for i in range(60):
        lines = [line(rng.randint(3, 25)) for _ in range(rng.randint(1, 5))]
        if i % 4 == 0:  # a passage that many texts share, once with a letter changed
            shared = rng.choice(common)
            lines.insert(rng.randint(0, len(lines)), shared if i % 8 else shared.replace("e", "x", 1))
        texts[i] = "\n".join(lines)
    for i in range(60, 70):  # copies of whole texts, some with a word more
        texts[i] = texts[i - 55] + (" again" if i % 2 else "")
    texts[70] = f"{line(30)} {(same := line(12))} {line(4)} {same}"
    texts |= {71: "", 72: "too short", 73: "\n".join([line(9)] * 6), 74: line(3000)}
    source = lambda i: None if i % 5 == 4 else "abc"[i % 3]
    rows = [(i, t, source(i), 1) for i, t in texts.items()] + [(75, None, "a", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, copies int").write.parquet(f"{tmp_path}/documents.parquet")

    held = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    steps = (
        ("quality_rules", lambda now: {i: t for i, t in now.items() if good(t)}),
        ("line_dedup", without_repeats),
        ("simhash_dedup", smallest_of_each),
    )
    want = texts
    for name, brute in steps:
        before, want = want, brute(want)
        assert want != before
        held = corpus_pipeline.stage(stages[name](spark, held, str(tmp_path)), name)
        assert {r.doc_id: r.text for r in held.collect()} == want and held.count() == len(want)

    # The mix: copies of what is left, each source's words near its target.
    mixed = corpus_pipeline.stage(stages["source_mix"](spark, held, str(tmp_path)), "mix")
    copies = Counter(r.doc_id for r in mixed.collect())
    assert all(r.text == want[r.doc_id] and r.source == source(r.doc_id) for r in mixed.collect())
    size = {i: len(WORD.findall(t)) for i, t in want.items()}
    of_source = defaultdict(list)
    for i in want:
        of_source[source(i)].append(i)
    weight = dict(zip(sorted(of_source, key=lambda s: (s is None, s or "")), (5, 2, 1, 5)))
    total = {s: sum(size[i] for i in ids) for s, ids in of_source.items()}
    full, left = set(), 1.5 * sum(total.values())
    while over := {s for s in weight if s not in full and (
        (left - sum(2 * total[f] for f in full)) * weight[s] / sum(weight[o] for o in weight if o not in full) > 2 * total[s]
    )}:
        full |= over
    level = (left - sum(2 * total[f] for f in full)) / max(sum(weight[o] for o in weight if o not in full), 1)
    for s, ids in of_source.items():
        target = 2 * total[s] if s in full else level * weight[s]
        assert abs(sum(copies[i] * size[i] for i in ids) - target) <= max(size[i] for i in ids)
        assert max(copies[i] for i in ids) <= 2

    # The whole run gives the pieces of exactly these copies.
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    ids = {i: [*tokenizer.encode(want[i], add_special_tokens=False).ids, 1] for i in copies}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces)
    assert len({p.sequence_id for p in pieces}) == len(pieces) and all(p.offset == 0 for p in pieces)
    covered = defaultdict(int)
    for (i, start, length, crc, tokens), n in got.items():
        assert n == copies[i] and tokens == len(ids[i]) and length & (length - 1) == 0 and length <= 2048
        assert crc == zlib.crc32(np.array(ids[i][start:start + length], "<u4").tobytes())
        covered[i] += length
    assert covered == {i: len(ids[i]) for i in copies}


def test_toxicity_scores(spark):
    """Features, noisy-or and the worst sentence, from the fitted weights in plain Python."""
    rng = random.Random(4)
    words = ["ant", "Bär", "cat", "dort", "été", "going", "hut", "inkwell", "jam"]
    sentence = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 9)))
    rows = []
    for i in range(400):
        parts = [sentence() for _ in range(rng.randint(1, 8))]
        if i % 3 == 0:
            parts[rng.randrange(len(parts))] = f"you {rng.choice(['vilely', 'NASTY'])} thing"
        rows.append((i, rng.choice([". ", "!\n", "? "]).join(parts), None, i))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, y long")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity_mil.train(docs, labels)
    rows += [(900, None, None, 0), (901, "", None, 0), (902, " .!\n", None, 0), (903, f"{sentence()}. " * 5000 + "you vilely thing", None, 0)]
    more = spark.createDataFrame([*rows, rows[3], rows[3]], docs.schema)
    base, values = textarrays._BASE, [int(v) for v in textarrays._BYTE_VALUES]

    def scramble(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            x = (x ^ x >> shift) * factor % (1 << 64)
        return x

    known = {}

    def hashed(part):
        if part not in known:
            known[part] = scramble((sum(values[c] * pow(base, i, 1 << 64) for i, c in enumerate(part)) + len(part)) % (1 << 64))
        return known[part]

    def weight(word):
        parts = [hashed(word), *[hashed(word[i:i + 5]) ^ 0x5851F42D4C957F2D for i in range(len(word) - 4)]]
        return sum(float(model.weights[h >> 64 - toxicity_mil.BITS]) for h in parts)

    def brute(text):
        none, worst = 0.0, None
        for found in re.finditer(rb"[^.!?\n]*[.!?\n]|[^.!?\n]+$", (text or "").encode()):
            own = re.findall(rb"[0-9a-z\x80-\xff]+", found.group().lower())
            if own:
                p = 1 / (1 + math.exp(-(model.bias + sum(map(weight, own)))))
                none += math.log1p(-p)
                if worst is None or p > worst[2] + 1e-12:
                    worst = (*found.span(), p)
        return -math.expm1(none), worst

    got = toxicity_mil.score_documents(more, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in [*rows, rows[3], rows[3]])
    texts = {r[0]: r[1] for r in rows}
    assert sum(r.score >= 0.7 for r in got) > 100
    for r in got:
        score, worst = brute(texts[r.doc_id])
        assert r.score == pytest.approx(score, abs=1e-5)
        if worst is None:
            assert r.worst_start is None and r.worst_end is None and r.worst_score is None
        else:
            assert r.worst_score == pytest.approx(worst[2], abs=1e-5)
            if r.score >= 0.7:
                assert (r.worst_start, r.worst_end) == worst[:2]


def test_an_id_with_several_texts(spark):
    """Learned from one text of an id, whatever order the rows come in."""
    rows = [(i, f"a plain text {i}. {'you nasty thing' if i % 2 else 'good day'}") for i in range(60)]
    rows += [(i, f"another text {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    one, two = (toxicity_mil.train(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels)
                for r, n in ((rows, 1), (rows[::-1], 7)))
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias


def test_long_bands(spark):
    """Runs of equal letters passed at once: few and many edits, shifts, and runs that repeat themselves."""
    rng = random.Random(13)
    pairs = []
    for _ in range(500):
        signs = rng.choice(["ab", "abcdefg é", "a", "xyz😀"])
        a = [rng.choice(signs) for _ in range(rng.randint(20, 120))]
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            at, width = rng.randrange(len(b)), rng.randint(1, 4)
            b[at:at + rng.choice([0, width])] = [rng.choice(signs + "q") for _ in range(rng.choice([0, width]))]
        pairs.append(("".join(a), "".join(b)))
    for edits in (2, 4, 6):
        fit = [p for p in pairs if abs(len(p[0]) - len(p[1])) <= edits]
        frame = spark.createDataFrame(fit, "a string, b string")
        close = 0
        for r in frame.select("a", "b", line_edit_dedup.banded_distance(F.col("a"), F.col("b"), edits).alias("d")).collect():
            true = edit_distance(r.a, r.b)
            close += true <= edits
            assert r.d == true if true <= edits else r.d > edits
        assert 50 < close < len(fit)


def test_products_beyond_64_bits(spark):
    vectors = spark.createDataFrame([(1, [1e300, 0.0]), (20, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        topk_pivots.top_k(vectors, F.col("vec_id") % 20 == 0).collect()
    long = spark.createDataFrame([(1, [2.0**24, -3.0]), (20, [2.0**24, 2.0]), (21, [-(2.0**24), 1.0])], vectors.schema)
    got = topk_pivots.top_k(long, F.col("vec_id") % 20 == 0).collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 2**60 - 64 * 64 * 6), (21, -(2**60) + 64 * 64 * 2)]
