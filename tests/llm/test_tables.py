"""Operators over vectors, conversations and pages, and the components they share."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflens.llm import chat_snapshots, queries, topk_pivots, url_equivalence
from shelflens.llm.components import connected_components


@pytest.mark.parametrize("query_rows,candidate_rows,pivots", [(512, 2048, 32), (7, 30, 5)])
def test_top_k(spark, query_rows, candidate_rows, pivots):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(5, 8))
    rows = [(i, [float(x) for x in centre[i % 5] + 0.3 * rng.normal(size=8)], "x") for i in range(200)]
    rows += [(1000 + i, rows[0][1], None) for i in range(40)]  # ties
    rows += [(2000, [0.0] * 8, None), (2001, None, None), (2002, [None] + [0.0] * 7, None), (2003, [float("nan")] * 8, None),
             (2004, [float("inf")] * 8, None), (None, [1.0] * 8, None), (2020, [1.0, 2.0], None), (2021, [], None), (2022, [3.0, 1.0], None)]
    rows += [rows[3], rows[3]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string")
    found = topk_pivots.top_k(frame, F.col("vec_id") % 20 == 0, k=6, pivots=pivots, query_rows=query_rows, candidate_rows=candidate_rows)
    got = sorted(map(tuple, found.collect()))
    sound = {i: np.floor(64 * np.array(v)).astype(int) for i, v, _ in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q, v in sound.items():
        if q % 20 == 0:
            best = sorted((-int(v @ w), i) for i, w in sound.items() if i != q and len(w) == len(v))[:6]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)


@pytest.mark.parametrize("together", [3, 32])
@pytest.mark.parametrize("longest", [40, 2**27])
def test_block_of_queries_that_go_together(monkeypatch, together, longest):
    """Ties, own rows, zero vectors and products beyond 52 bits, against brute force."""
    monkeypatch.setattr(topk_pivots, "TOGETHER", together)
    monkeypatch.setattr(topk_pivots, "STEP", 16)
    rng = np.random.default_rng(9)
    rows = rng.integers(-longest, longest, (400, 6))
    rows[::50] = 0
    rows[300:] = rows[rng.integers(0, 20, 100)]
    ids = rng.permutation(400)
    queries = np.arange(0, 400, 9)
    radius2 = float((rows.astype(float) ** 2).sum(axis=1).max())
    for n_rows in (400, 5, 1):
        found = list(topk_pivots.search_block(
            ids[queries], rows[queries], ids[:n_rows], rows[:n_rows], ids[-8:], rows[-8:], radius2, 7,
        ))
        assert [q for q, _, _ in found] == list(range(len(queries)))
        whole = [(s, i, *v) for s, i, v in zip(rows.tolist(), ids.tolist(), rows.tolist(), strict=True)]
        for q, best, scores in found:
            asked = rows[queries[q]].tolist()
            want = sorted((-sum(x * y for x, y in zip(asked, v, strict=True)), i) for v, i, *_ in whole[:n_rows] if i != ids[queries[q]])[:7]
            got = list(zip((-scores).tolist(), best.tolist(), strict=True))
            # What the pivots alone beat may be left out: it is in no top 7.
            assert got == want[:len(got)]
            pivots = sorted(-sum(x * y for x, y in zip(asked, v, strict=True)) for v, i, *_ in whole[-8:] if i != ids[queries[q]])
            assert all(s > pivots[6] for s, _ in want[len(got):])


def test_top_k_empty(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_pivots.top_k(frame, F.col("vec_id") % 20 == 0).count() == 0


def test_chat_snapshots(spark):
    rng = random.Random(2)
    chats = {}
    for i in range(60):
        base = chats[rng.choice(list(chats))] if chats and rng.random() < 0.6 else []
        cut = base[: rng.randint(0, len(base))] if base else []
        chats[i] = cut + [(rng.choice(["user", "assistant"]), rng.choice(["hi", "no", "yes"])) for _ in range(rng.randint(0 if cut else 1, 3))]
    chats[60], chats[61] = [("user", None)], [("user", "")]
    rows = [(c, n, r, t, "x") for c, turns in chats.items() for n, (r, t) in enumerate(turns)]
    rows += rows[:7] + [(None, 0, "user", "nobody's", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, turns string")
    got = {r.conv_id: r for r in chat_snapshots.format_chats(frame).collect()}
    chats[None] = [("user", "nobody's")]
    want = Counter()
    for turns in map(tuple, chats.values()):
        if not any(len(o) > len(turns) and tuple(o[: len(turns)]) == turns for o in chats.values()):
            want[turns] += 1
    assert Counter({tuple(chats[c]): r.n_copies for c, r in got.items()}) == want
    for c, r in got.items():
        assert c is None or c == min(i for i, t in chats.items() if i is not None and t == chats[c])
        assert r.rendered == "".join(f"<|{role or ''}|>\n{text or ''}\n" for role, text in chats[c])
    assert chat_snapshots.format_chats(frame.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(5000, 2000 + i) for i in range(80)] + [(7, 7), (9000, 9000), (None, 3)]
    label = {}
    for a, b in edges:
        if a is not None:
            label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(len(label)):
        before = dict(label)
        for a, b in edges:
            if a is not None:
                label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    frame = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.component for r in connected_components(frame).collect()} == label
    assert connected_components(frame.limit(0)).count() == 0


PAGES = [
    (1, "http://shop.x.net/a", None),
    (2, "https://Mirror.example.org/m/p?id=1", '<link rel="canonical" href="http://shop.x.net/a">'),
    (3, "http://other.example.org/q", "<META http-equiv=refresh content='0; url=//mirror.example.org/m/p?id=1#top'>"),
    (4, "http://www.example.net/en/1", '<link href="http://shop.x.net/a" rel=canonical>'),
    (5, "http://apart.example.org/", "<p>canonical words, no link</p>"),
    (6, "http://a.org/fr/x", '<link rel="canonical" href="/fr/../y">'),
    (7, "no scheme here", None), (8, None, None),
    (9, "http://fine.example.com/de/", None),
    (10, "http://net/", None), (11, "http://example.net", None),
    (12, "http://b.example.info/one/two", '<link rel="canonical" href="three">'),
    (13, "ftp://b.example.info/one/three#x", '<meta http-equiv="refresh" content="5;url=http://bad.net/z">'),
]


def test_url_rules_and_aliases(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("rule", F.lit("clash"))
    got = {r.page_id: r for r in url_equivalence.judge_urls(frame, queries.URL_RULES).collect()}
    assert {i: (r.rule, r.verdict) for i, r in got.items()} == {
        1: ("net/", "block"), 2: (None, "allow"), 3: (None, "allow"), 4: ("example.net/en/", "allow"), 5: (None, "allow"),
        6: ("org/fr/", "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: ("example.com/de/", "block"),
        10: ("net/", "block"), 11: (None, "allow"), 12: (None, "block"), 13: (None, "block"),
    }
    assert (got[2].host, got[2].path, got[7].host, got[8].path) == ("mirror.example.org", "/m/p", "", "")
    # Without page 4, which is explicitly allowed, its aliases are blocked.
    rest = {r.page_id: r.verdict for r in url_equivalence.judge_urls(frame.where("page_id != 4"), queries.URL_RULES).collect()}
    assert (rest[2], rest[3], rest[5]) == ("block", "block", "allow")
    moved = spark.createDataFrame([("http://apart.example.org/", "http://x.net/"), (None, "http://y.net/")], "a string, b string")
    with_table = {r.page_id: r.verdict for r in url_equivalence.judge_urls(frame, queries.URL_RULES, moved).collect()}
    assert with_table[5] == "block"
    assert url_equivalence.judge_urls(frame.limit(0), queries.URL_RULES).count() == 0


EDGE_PAGES = [
    (1, "http://a.example.org/", "<meta http-equiv=\"refresh\" content=\"0;url='http://bad.net/z'\">"),  # quoted target
    (2, "http://b.example.org/", '<link rel="canonical" href="http://h.example.org/p?x=1&amp;y=2">'),  # escaped sign
    (3, "http://h.example.org/p?x=1&y=2", '<link rel="canonical" href="http://bad.net/y">'),
    (4, "http://c.example.org/", '<link rel="alternate canonical" href="http://bad.net/z">'),  # one of several values
    (5, "http://d.example.org/", '<!-- <link rel="canonical" href="http://bad.net/z"> -->'),  # in a comment
    (6, "http://e.example.org/", '<link rel="non-canonical" href="http://bad.net/z">'),
    (7, "http://f.example.org/", "x " * 200_000 + "<!-- -->" + "<link rel='canonical' href='http://bad.net/z'>"),  # very long
    (7, "http://f.example.org/", "x " * 200_000 + "<!-- -->" + "<link rel='canonical' href='http://bad.net/z'>"),  # repeated
]


def test_url_edges_in_every_spelling(spark):
    import duckdb
    import pyarrow as pa

    frame = spark.createDataFrame(EDGE_PAGES, "page_id long, url string, html string")
    found = url_equivalence.judge_urls(frame, queries.URL_RULES).select("page_id", "verdict").collect()
    verdicts = {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "block"}
    assert sorted(map(tuple, found)) == sorted((i, verdicts[i]) for i, _, _ in EDGE_PAGES)
    pages = pa.table({c: [r[i] for r in EDGE_PAGES] for i, c in enumerate(("page_id", "url", "html"))})
    con = duckdb.connect()
    con.register("pages", pages)
    checked = con.sql(f"SELECT DISTINCT page_id, verdict FROM ({queries.CHECKS['op7_url_equivalence']})").fetchall()
    assert dict(checked) == verdicts
