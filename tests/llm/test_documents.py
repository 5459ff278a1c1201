"""Operators over documents: brute force on a small mixed table, and the defined edge cases."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from shelflens.llm import (
    binary_packing, kneser_ney, line_edit_dedup, pivotal_mix, queries, repetition_rules, simhash_pivots, toxicity_mil,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Columns that clash with names used inside the operators.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row int, _id long, n int, line string, copies int"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def sentence(rng, words):
    return " ".join(rng.choice(["ant", "Bär", "cat", "dort", "été", "fin,", "go", "hut.", "ink", "jam"]) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    lines = [sentence(rng, rng.randint(4, 12)) for _ in range(60)]
    texts = ["\n".join(rng.choice(lines) if rng.random() < 0.5 else sentence(rng, 8) for _ in range(rng.randint(1, 9))) for _ in range(70)]
    for t in texts[:15]:  # near copies of whole texts and of lines
        at = rng.randrange(len(t))
        texts.append(t[:at] + "x" + t[at + 1:])
        texts.append(t + " y")
    texts += [texts[0]] * 5 + [None, "", "\n\n", "  ", "one", "two words", "ünï cödé 😀 " * 40, "same " * 300, " lead  double\ttab\r\nend "]
    texts.append(" ".join(f"w{i}" for i in range(30000)))
    out = [
        (i, t, ["en", "de", None][i % 3], ["a", "b", "c", None][i % 4], None, None, i, -i, 1, "x", 7)
        for i, t in enumerate(texts)
    ]
    out.append((None, "no id, a text of its own here", "en", "a", *[None] * 7))
    return [*out, out[3], out[3]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_repetition_counts(docs, rows):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
                  for r in repetition_rules.repetition_report(docs).collect())
    limits = repetition_rules.RepetitionLimits()
    want = Counter()
    for row in rows:
        text = row[1] or ""
        words = WORD.findall(text)
        seen, dup, dup_chars = set(), 0, 0
        for line in text.split("\n"):
            if WORD.search(line):
                if line in seen:
                    dup += 1
                    dup_chars += sum(map(len, WORD.findall(line)))
                seen.add(line)

        def inside(n, words=words):
            grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
            count = Counter(grams)
            return {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + n)}

        chars = sum(map(len, words))
        repeat = len(inside(5))
        base = len(words) < 10 or 100 * repeat > 20 * len(words)
        fine = dup_chars <= limits.lines * max(chars, 1) and all(
            sum(len(words[j]) for j in inside(n)) <= most * max(chars, 1) for n, most in limits.ngrams.items())
        want[(row[0], len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), dup, repeat, base, not base and fine)] += 1
    assert got == want


def test_repetition_keeps_columns(docs):
    kept = repetition_rules.keep_by_repetition(docs)
    assert kept.schema == docs.schema
    assert kept.count() == repetition_rules.repetition_report(docs).where("kept").count()


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    rng = random.Random(edits)
    pairs = []
    while len(pairs) < 400:
        a = "".join(rng.choice("abé") for _ in range(rng.randint(7, 14)))
        b = list(a)
        for _ in range(rng.randint(0, edits + 2)):
            at = rng.randrange(len(b))
            b[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "bé"])
        if abs(len(a) - len(b)) <= edits and b:
            pairs.append((a, "".join(b)))
    frame = spark.createDataFrame(pairs, "a string, b string")
    frame = frame.where(F.abs(F.char_length("a") - F.char_length("b")) <= edits)
    for r in frame.select("a", "b", line_edit_dedup.banded_distance(F.col("a"), F.col("b"), edits).alias("d")).collect():
        true = edit_distance(r.a, r.b)
        assert r.d == true if true <= edits else r.d > edits


def test_common_ends_cost_nothing(spark):
    rng = random.Random(8)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(20, 60)))
        at = rng.randrange(len(a))
        pairs.append((a, a[:at] + rng.choice(["", "a", "bé"]) + a[at + rng.randint(0, 2):]))
    frame = spark.createDataFrame([p for p in pairs if abs(len(p[0]) - len(p[1])) <= 2], "a string, b string")
    rest = line_edit_dedup.without_common_ends(F.col("a"), F.col("b"), 2)
    cut = frame.select("a", "b", rest.alias("rest")).select("a", "b", F.col("rest.a").alias("rest_a"), F.col("rest.b").alias("rest_b")).collect()
    for r in cut:
        assert edit_distance(r.rest_a, r.rest_b) == edit_distance(r.a, r.b) and min(len(r.rest_a), len(r.rest_b)) >= 6
    assert sum(len(r.rest_a) for r in cut) < 0.7 * sum(len(r.a) for r in cut)


def test_line_dedup(docs, rows):
    done = line_edit_dedup.dedup_lines(docs).select("row.doc_id", "row.text", "lines_kept", "n_lines", "n_links", "n_exact", "n_near")
    places = defaultdict(list)
    key = lambda r: (r[0] is None, r[0] if r[0] is not None else 0)
    for r in rows:
        for pos, line in enumerate((r[1] or "").split("\n") if r[1] is not None else []):
            if len(line) >= line_edit_dedup.MIN_CHARS:
                places[line].append((*key(r), pos))
    first = {line: min(at) for line, at in places.items()}
    near = {a: [b for b in first if b != a and abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= 2] for a in first}
    assert sum(map(len, near.values())) > 10
    for r in done.collect():
        if r.text is None:
            assert r.lines_kept is None and r.n_lines == 0
            continue
        kept, exact, close = [], 0, 0
        for pos, line in enumerate(r.text.split("\n")):
            again = line in first and first[line] < (*key((r.doc_id,)), pos)
            like = line in first and any(first[b] < first[line] for b in near[line])
            exact += again
            close += like and not again
            if not again and not like:
                kept.append(line)
        assert (r.lines_kept, r.n_exact, r.n_near) == ("\n".join(kept), exact, close)
        assert r.n_links == sum(len(near.get(line, ())) for line in r.text.split("\n"))


def test_line_dedup_without_broadcast(docs, monkeypatch):
    names = ["row.doc_id", "lines_kept"]
    want = sorted(map(repr, line_edit_dedup.dedup_lines(docs).select(*names).collect()))
    monkeypatch.setattr(line_edit_dedup, "BROADCAST_LINES", 0)
    assert sorted(map(repr, line_edit_dedup.dedup_lines(docs).select(*names).collect())) == want


def brute_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(marks):
    label = dict(zip(marks, marks, strict=True))
    changed = True
    while changed:
        changed = False
        for a in marks:
            for b in marks:
                if (a ^ b).bit_count() <= 2 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


@pytest.mark.parametrize("bucket_rows", [4096, 1])
def test_simhash(docs, rows, bucket_rows):
    marks = {r[1]: brute_fingerprint(r[1]) for r in rows}
    label = brute_components(sorted(set(marks.values())))
    ids = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            ids[label[marks[r[1]]]].append(r[0])
    got = Counter(tuple(r) for r in simhash_pivots.near_duplicates(docs, bucket_rows=bucket_rows).collect())
    assert got == Counter(
        (r[0], f"{marks[r[1]]:016x}", min(ids[label[marks[r[1]]]], default=None)) for r in rows
    )
    left = simhash_pivots.drop_near_duplicates(docs, bucket_rows=bucket_rows)
    assert left.schema == docs.schema
    assert sorted(label[marks[r.text]] for r in left.collect()) == sorted(set(label.values()))


def test_simhash_links_all_found(spark):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    marks = {int(c) for c in centre}
    for c in centre:
        walk = int(c)
        for _ in range(60):  # chains of near fingerprints
            walk ^= (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64)))
            marks.add(walk)
    marks |= {int(x) for x in rng.integers(0, 1 << 63, 200, dtype=np.uint64)}
    label = brute_components(sorted(marks))
    frame = spark.createDataFrame([(int(np.uint64(m).astype(np.int64)),) for m in marks], "fingerprint long")
    for bucket_rows in (4096, 1):
        found = {r.fingerprint % (1 << 64): r.component for r in
                 simhash_pivots.fingerprint_classes(frame, bucket_rows=bucket_rows).collect()}
        groups = lambda of: sorted(sorted(g) for g in of.values() if len(g) > 1)
        want, got = defaultdict(list), defaultdict(list)
        for m in marks:
            want[label[m]].append(m)
            if m in found:
                got[found[m]].append(m)
        assert groups(got) == groups(want)


def test_round_pivotal_keeps_words_and_expectation():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 500, 200).astype(float)
    shares = np.full(200, 0.3)
    total = np.zeros(200)
    for _ in range(300):
        out, held = pivotal_mix.round_pivotal(sizes, shares, rng.random(200))
        assert abs(out @ sizes - shares @ sizes) < 1e-6
        assert sum((out > 0) & (out < 1)) <= 1 and (held < 0 or 0 < out[held] < 1)
        total += out
    assert abs(total / 300 - 0.3).max() < 0.13


@pytest.mark.parametrize("chunk_rows,fan_in", [(2048, 256), (4, 2)])
def test_mix(docs, rows, chunk_rows, fan_in):
    got = pivotal_mix.mix(docs, chunk_rows=chunk_rows, fan_in=fan_in)
    records = got.collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        level = left / sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    target = {s: 2.0 * sizes[s] if s in full else level * weight[s] for s in names}
    taken = defaultdict(int)
    for r in records:
        source = None if r.none else r.name
        assert r.source_size == sizes[source] and abs(r.target - target[source]) < 1e-6
        assert 0 <= r.copies <= 2
        taken[source] += r.copies * r.size
    assert Counter((r.doc_id, r.size) for r in records) == Counter((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    biggest = {s: max(len(WORD.findall(r[1] or "")) for r in rows if r[3] == s) for s in names}
    assert all(abs(taken[s] - target[s]) <= biggest[s] for s in names)
    again = pivotal_mix.mix(docs.repartition(5), chunk_rows=chunk_rows, fan_in=fan_in)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, records))
    mixed = pivotal_mix.mixed_documents(docs, chunk_rows=chunk_rows, fan_in=fan_in)
    assert mixed.schema == docs.schema
    assert mixed.count() == sum(r.copies for r in records)


@pytest.mark.parametrize("longest", [2048, 8])
def test_packing_round_trip(docs, rows, longest):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    rows = [*rows, (77_001, "a <|endoftext|> b", *rows[0][2:]), (77_002, "<|endoftext|><|endoftext|>", *rows[0][2:])]
    docs = docs.sparkSession.createDataFrame(rows, SCHEMA).repartition(3)
    pieces = binary_packing.pack(docs, path, longest).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    ids_of = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
    got = defaultdict(list)
    for p in pieces:
        assert p.length <= longest and p.length & (p.length - 1) == 0 and p.offset == 0 and 1 << p.bucket == p.length
        got[p.doc_id].append((p.start, np.frombuffer(p.ids, "<u4").tolist(), p.doc_tokens))
    for r in rows:
        if rows.count(r) == 1:
            whole = sorted(got[r[0]])
            want = ids_of(r[1])
            assert [i for _, ids, _ in whole for i in ids] == want and {t for _, _, t in whole} == {len(want)}
            assert [s for s, _, _ in whole] == np.cumsum([0, *[len(i) for _, i, _ in whole]])[:-1].tolist()
    crc = binary_packing.piece_digests(binary_packing.pack(docs, path, longest)).where("doc_id = 1 AND start = 0").first()
    assert crc.ids_crc32 == zlib.crc32(np.array(ids_of(rows[1][1])[:crc.length], "<u4").tobytes())


def test_word_encoder_odd_spaces():
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    texts = ["", " ", "a  b", " a b ", "a  b", "a  b", "a\x1c b c\x85 d", "it's 1 22 a.\nB,\n\nc !!", "<|endoftext|> a<|endoftext|>b",
             "é è\tç  　 ü", "ʰx ªb ﬁn.", "x.\ny z?\nß!"]
    texts += ["a\u2028 b \x1fc", "Ω one ωx. \u0250a Ǆ.", "end.\nNext;\n", "a.b c.,d ?! x...\ny!", "a\n\nb c\nd\ne", "\u2003 x"]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for cache_bytes in (0, 300, 1 << 20):
        encoder = binary_packing.WordEncoder(path, cache_bytes)
        for _ in range(3):
            assert [list(i) for i in encoder.encode(pa.array(texts))] == want
        assert [list(i) for i in encoder.encode(pa.array(texts[3:5]))] == want[3:5]
        assert encoder.encode(pa.array([], pa.string())) == []


def test_word_encoder_against_the_tokenizer():
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    tokenizer, encoder = Tokenizer.from_file(path), binary_packing.WordEncoder(path, 5000)
    rng = random.Random(12)
    signs = [" ", " ", "  ", "\n", "\t", "a", "word", "The", "é", "ß", "ǆ", "ʰ", "中", "1", "'s", ".", ",", "!?", "\x1c", "\xa0", "<|endoftext|>", "<|", "😀"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(600)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = [list(ids) for at in range(0, 600, 50) for ids in encoder.encode(pa.array(texts[at:at + 50]))]
    assert got == want


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        parts = [sentence(rng, 8) for _ in range(rng.randint(2, 12))]
        if toxic:
            at = rng.randrange(len(parts))
            parts[at] = f"you {rng.choice(['vile', 'nasty', 'Rotten'])} thing"
        rows.append((i, ". ".join(parts), "en"))
        labels.append((i, 1 if i % 2 else 0, int(toxic)))
    labels += [(None, 1, 1), (10_000, None, None), (1, 1, 1)]  # without document, without label, labelled both ways
    return (
        spark.createDataFrame([*rows, (None, None, None), (5000, "", "en"), (5001, "!!!", None)], "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_toxicity_held_out(labelled):
    docs, labels = labelled
    model = toxicity_mil.train(docs, labels)
    scored = toxicity_mil.score_documents(docs, model).withColumn("held", toxicity_mil.held_out(F.col("doc_id"))).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    unseen = [r for r in scored if r.held and r.doc_id < 900]
    right = sum((r.score >= 0.7) == (r.doc_id % 3 == 0) for r in unseen)
    assert right >= 0.95 * len(unseen)
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scored if r.doc_id is not None)
    blank = [r for r in scored if r.doc_id in (None, 5000, 5001)]
    assert all(r.score == 0 and r.worst_score is None for r in blank)
    found = toxicity_mil.offending_sentences(docs, model).collect()
    hits = [r for r in found if re.search("vile|nasty|Rotten", r.sentence)]
    assert len(hits) >= 0.95 * len(found) and len({r.doc_id for r in hits}) >= 280


def test_toxicity_without_examples(labelled, spark):
    docs, labels = labelled
    model = toxicity_mil.train(docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity_mil.score_documents(docs, model).collect()} == {0.0}


def brute_probabilities(trusted, texts):
    """Modified Kneser-Ney over four-character grams, straight from its formulas."""
    lead = "\0" * 3
    grams = Counter((lead + t)[i:i + 4] for t in trusted for i in range(len(t)))
    counts = {4: grams}
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    asked = {(lead + t)[i:i + 4] for t in texts for i in range(len(t))}
    letters = len({g[-1] for g in asked})

    def cut(n):
        c = Counter(counts[n].values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0
        raw = [k - (k + 1) * y * c[k + 1] / c[k] if c[k] else 0 for k in (1, 2, 3)]
        return [min(max(d, 0), k) for k, d in enumerate(raw, 1)]

    cuts = {n: cut(n) for n in counts}
    contexts = {n: defaultdict(list) for n in counts}
    for n in counts:
        for g, c in counts[n].items():
            contexts[n][g[:-1]].append(c)

    def p(g):
        n = len(g)
        if not n:
            return 1 / letters
        below = p(g[1:])
        held = contexts[n].get(g[:-1])
        if not held:
            return below
        off = lambda c: cuts[n][min(c, 3) - 1] if c else 0
        c = counts[n][g]
        return (c - off(c) + sum(map(off, held)) * below) / sum(held)

    return {g: p(g) for g in asked}


@pytest.mark.parametrize("broadcast", [4_000_000, 0])
def test_kneser_ney(labelled, broadcast):
    docs, labels = labelled
    small, few = docs.where("doc_id < 120 OR doc_id >= 5000 OR doc_id IS NULL"), labels.where("doc_id < 120")
    got = kneser_ney.judge_by_perplexity(small, few, broadcast_grams=broadcast).collect()
    texts = {r.doc_id: r.text or "" for r in small.collect()}
    table = brute_probabilities([texts[i] for i in range(120) if i % 2], texts.values())
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id]
        if not text:
            assert r.perplexity is None and r.kept is False
            continue
        logs = [np.log(table[("\0" * 3 + text)[i:i + 4]]) for i in range(len(text))]
        assert r.n_scored == len(text) and abs(r.perplexity - np.exp(-np.mean(logs))) < 1e-6 * r.perplexity
        assert r.kept == (r.perplexity <= r.threshold)
    assert [r.kept for r in got if r.doc_id == 5001] == [False]


def test_kneser_ney_without_trusted_text(labelled):
    docs, labels = labelled
    got = kneser_ney.judge_by_perplexity(docs, labels.where("quality = 0")).collect()
    assert len(got) == docs.count() and not any(r.kept for r in got)


def test_empty_tables(empty, spark):
    assert repetition_rules.repetition_report(empty).count() == 0
    assert line_edit_dedup.without_repeated_lines(empty).count() == 0
    assert simhash_pivots.near_duplicates(empty).count() == 0
    assert pivotal_mix.mixed_documents(empty).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity_mil.score_documents(empty, toxicity_mil.train(empty, labels)).count() == 0
    assert kneser_ney.judge_by_perplexity(empty, labels).count() == 0


def test_stages(docs, empty, spark, rows):
    """Each stage takes and returns documents; the last gives pieces that cover what is left."""
    for table in (docs, empty):
        held = table
        for _, function in corpus_pipeline.STAGES[:-1]:
            held = corpus_pipeline.stage(function(spark, held, ""), "stage")
            assert held.dtypes == table.dtypes
        pieces = corpus_pipeline.STAGES[-1][1](spark, held, "").collect()
        assert sum(p.doc_tokens for p in pieces if p.start == 0) == sum(p.length for p in pieces)
        assert sum(p.start == 0 for p in pieces) == held.count()
