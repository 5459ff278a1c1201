"""Whole jobs: the sample catalogue, dialects, files, enrichment, model."""

from __future__ import annotations

import csv
import io
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from shelflens.operators.encoding import as_vectors
from shelflens.plans import business, charts, clean, enrich, ingest, price_model, screening
from shelflens.schema import DETAIL, RAW_TYPES, REVIEW
from shelflens.sources import csv_files, payload_files, sinks

BADGES = "[{'code': 'fast', 'type': 'delivery_info_badge'}, {'code': 'authentic_brand', 'ok': None}]"
VARIANT = BADGES[:-1] + ", {'code': 'x', 'type': 'variant_count'}]"
NO_STARS = ";".join(f"{i}:count_0,percent_0" for i in range(1, 6))

# Seven products of one category.
SAMPLE = [
    # id, name, hero, brand, stars, rating, reviews, price, sold, badges
    ("278755979", "Steriliser, dryer", "True", "id:31627; name:Acme", NO_STARS, "0.0", "0", "1242000", "", BADGES),
    ("277822007", "Sieve 12,14", "False", "id:31627; name:Acme", NO_STARS[:-19] + "5:count_1,percent_100", "5.0", "1",
     "191000", "16.0", VARIANT),
    ("277809670", "Pan", "True", "id:31627; name:Acme", NO_STARS, "0.0", "0", "705000", "3.0", BADGES),
    ("277741454", "Pot", "True", "id:31627; name:Acme", NO_STARS, "0.0", "0", "611000", "3.0", BADGES),
    ("197775290", "Diapers", "False", "id:26863; name:Bo", NO_STARS, "0.0", "0", "198000", "2.0", BADGES),
    ("4138473", "Wipes", "False", "id:26863; name:Bo", NO_STARS, "0.0", "0", "170000", "7.0", BADGES),
    ("514255", "Combo 2 tins", "False", "id:145924; name:En", "1:count_2,percent_9;2:count_0,percent_0;"
     "3:count_0,percent_0;4:count_0,percent_0;5:count_19,percent_91", "4.6", "21", "329000", "219.0", BADGES),
]


@pytest.fixture(scope="module")
def raw(spark):
    rows = []
    for i, name, hero, brand, stars, rating, reviews, price, sold, badges in SAMPLE:
        given = {
            "id": i, "name": name, "brand_or_author": brand, "stars": stars, "rating_average": rating,
            "reviews_count": reviews, "price": price, "quantity_sold": sold, "badges_new": badges,
            "tracking_info_amplitude": f"is_authentic:True; is_freeship_xtra:True; is_hero:{hero}; is_top_brand:False",
            "stock_item": "max_sale_qty:1000; min_sale_qty:1; qty:1000", "discount_rate": "64", "availability": "1",
            "shippable": "True", "badges_v3": "[{'code': 'event_badge'}]", "category": "imports",
            "source_file": "p.csv",
        }
        rows.append(tuple(given.get(c) for c in RAW_TYPES))
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_TYPES))


@pytest.fixture(scope="module")
def cleaned(raw):
    return clean.clean_products(raw)


def test_clean_sample(cleaned):
    rows = {r.id: r for r in cleaned.collect()}
    assert len(rows) == 7
    assert {i: r.best_seller for i, r in rows.items()} == {
        278755979: None, 277822007: True, 277809670: False, 277741454: False, 197775290: False, 4138473: False,
        514255: True,
    }
    last = rows[514255]
    assert (last.star_1_count, last.star_1_percent, last.star_5_count, last.star_5_percent) == (2, 9, 19, 91)
    assert (last.brand_id, last.brand_name, last.stock_qty) == (145924, "En", 1000.0)
    assert {i for i, r in rows.items() if r.is_hero} == {278755979, 277809670, 277741454}
    assert {i for i, r in rows.items() if r.badges_new_has_variant_count_badge} == {277822007}
    for r in rows.values():
        assert r.is_authentic and r.is_freeship_xtra and r.is_top_brand is False and r.shippable
        assert r.badges_new_has_authentic_badge and r.badges_new_has_delivery_badge
        assert not r.badges_new_has_video_badge and not r.badges_v3_has_authentic_badge


def test_clean_column_order_and_types(cleaned):
    assert cleaned.columns[: len(RAW_TYPES)] == list(RAW_TYPES)
    assert cleaned.columns[-2:] == ["log_quantity_sold", "best_seller"]
    types = dict(cleaned.dtypes)
    assert {c: types[c] for c in RAW_TYPES} == RAW_TYPES


def test_clean_tolerates_missing_columns(spark):
    df = spark.createDataFrame([("1", "x "), ("1", "y")], "id string, name string")
    rows = clean.clean_products(df).collect()
    assert len(rows) == 1 and rows[0].asDict().keys() == {"id", "name"}


def test_no_best_seller_without_sales(spark):
    df = spark.createDataFrame([("1", "n/a"), ("2", "")], "id string, quantity_sold string")
    assert [r.best_seller for r in clean.clean_products(df).collect()] == [None, None]


def test_sample_answers(cleaned):
    gmv = business.gmv_share(cleaned).collect()
    assert [(r.category, r.gmv_proxy, r.gmv_pct, r.cumulative_gmv_pct) for r in gmv] == [
        ("imports", 80_641_000, 100.0, 100.0)
    ]
    assert business.discount_by_category(cleaned).count() == 0
    assert {r.seller_group: r.product_count for r in business.best_seller_comparison(cleaned).collect()} == {
        business.BEST: 1, business.OTHER: 6,
    }
    bins = {r.rating_bin: r for r in business.rating_bins(cleaned).collect()}
    good, low = bins["Excellent (>= 4.5)"], bins["Low (< 3)"]
    assert (good.product_count, good.avg_quantity_sold, good.avg_reviews, good.avg_price) == (2, 118.0, 11.0, 260000.0)
    assert (low.product_count, low.avg_quantity_sold, low.avg_reviews, low.avg_price) == (5, 4.0, 0.0, 585200.0)


@pytest.fixture(scope="module")
def shop(spark):
    """Ties in GMV, at the top-10 % cut and in ratings; null category and quantity."""
    rows = [(i, c, p, q, r) for i, (c, p, q, r) in enumerate(
        [("a", 10, 10, 4.5), ("b", 20, 5, 4.49), ("c", 50, 1, 3.0), (None, 100, 4, None), ("d", 10, None, 2.9)]
        + [("e", 1, 10, 0.0)] * 6
    )]
    return spark.createDataFrame(
        rows, "id long, category string, price long, quantity_sold long, rating_average double"
    ).withColumns({"discount_rate": F.lit(None).cast("double"), "reviews_count": F.lit(1)})


def test_dialects_differ_on_ties_and_null_groups(shop):
    by_sql = {r.category: r.cumulative_gmv_pct for r in business.gmv_share(shop, "sql").collect()}
    by_frame = {r.category: r.cumulative_gmv_pct for r in business.gmv_share(shop, "frame").collect()}
    assert None in by_sql and None not in by_frame
    assert by_sql["a"] == by_sql["b"]
    assert by_frame["a"] < by_frame["b"]
    assert max(by_sql.values()) == max(by_frame.values()) == 100.0


def test_best_sellers_with_and_without_ties(shop):
    ties = {r.seller_group: r.product_count for r in business.best_seller_comparison(shop, "sql").collect()}
    exact = {r.seller_group: r.product_count for r in business.best_seller_comparison(shop, "frame").collect()}
    assert ties == {business.BEST: 7, business.OTHER: 4}
    assert exact == {business.BEST: 2, business.OTHER: 9}
    chosen = business.with_exact_top_sellers(shop).where(F.col("seller_group") == business.BEST)
    assert sorted(r.id for r in chosen.collect()) == [0, 5]


def test_exact_top_reaching_into_unknown_quantities(spark):
    df = spark.createDataFrame([(i, None) for i in range(20)] + [(20, 5)], "id long, quantity_sold long")
    chosen = business.with_exact_top_sellers(df).where(F.col("seller_group") == business.BEST)
    assert sorted(r.id for r in chosen.collect()) == [0, 1, 20]
    tied = business.with_top_sellers(df).where(F.col("seller_group") == business.BEST)
    assert [r.id for r in tied.collect()] == [20]


def test_rating_labels(shop):
    assert {r.rating_bin: r.product_count for r in business.rating_bins(shop, "frame").collect()} == {
        "Excellent (>=4.5)": 1, "Good (4-4.49)": 1, "Average (3-3.99)": 1, "Low (<3)": 8,
    }
    with pytest.raises(ValueError):
        business.rating_bins(shop, "other")


def test_rating_bars_show_empty_bins(shop):
    bars = charts.rating_bars(shop.where("rating_average < 1")).collect()
    assert [(r.rating_bin, r.avg_quantity_sold) for r in bars][1:] == [(b, 0.0) for b in charts.RATING_ORDER[1:]]


def test_categories_to_share(shop):
    assert charts.categories_to_share(shop, share=50.0).first().categories == 2


# ------------------------------------------------------------------- files


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


@pytest.fixture()
def crawl(tmp_path):
    put(tmp_path / "đồ chơi + 50%20" / "p 1.csv", '﻿id,name\n1,"a ""q"", b"\n2,"two\nlines"\n3,\n'.encode())
    put(tmp_path / "b" / "p2.csv", "name,id,extra\nĐông,4,x\n".encode("cp1258"))
    put(tmp_path / "b" / "p3.csv", b"name,id,category\nplain,5,own\n")
    (tmp_path / "empty").mkdir()
    return tmp_path


def test_category_folders(spark, crawl):
    df = ingest.merge_category_folders(spark, str(crawl))
    rows = {r.id: (r.name, r.extra, r.category, r.source_file) for r in df.collect()}
    toys = "đồ chơi + 50%20"
    assert rows == {
        "1": ('a "q", b', None, toys, "p 1.csv"), "2": ("two\nlines", None, toys, "p 1.csv"),
        "3": (None, None, toys, "p 1.csv"), "4": ("Đông", "x", "b", "p2.csv"), "5": ("plain", None, "b", "p3.csv"),
    }
    report = {(r.category, r.total): r["rows"] for r in ingest.merge_report(df).collect()}
    assert report == {("b", 0): 2, (toys, 0): 3, (None, 1): 5}


def test_facts_of_files(spark, crawl):
    """Only files with values over several lines are put together by file."""
    files = csv_files.line_facts(csv_files.text_lines(spark, f"{crawl}/*/*.csv")).collect()
    assert {bytes(r.header)[-2:]: (r.utf8, r.multiline) for r in files} == {
        b"me": (True, True), b"ra": (False, False), b"ry": (True, False),
    }


@pytest.mark.parametrize("broadcast", [csv_files.BROADCAST_FILES, 0])
def test_records_that_do_not_fit(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(csv_files, "BROADCAST_FILES", broadcast)
    put(tmp_path / "c" / "a.csv", b'id,name\n1,x\n2,"a,b",3\n\nid,name\n3\n4,y,,\nid,name\n5,6.5" tv\n')
    put(tmp_path / "c" / "b.csv", b'id,name\r\n6,"two\r\n\r\nlines, ""q"""\r\n7,z,surplus\r\n8,"never\r\n9,w\r\n10,v\r\n')
    merged = ingest.category_folders(spark, str(tmp_path))
    rows = {r.id: r.name for r in merged.rows.collect()}
    assert rows == {"1": "x", "3": None, "4": "y", "5": '6.5" tv', "6": 'two\n\nlines, "q"', "9": "w", "10": "v"}
    rejects = sorted((r.file_path[-5:], r.reason, r.record) for r in merged.rejects.collect())
    assert rejects == [
        ("a.csv", csv_files.HEADER_AGAIN, "id,name"), ("a.csv", csv_files.HEADER_AGAIN, "id,name"),
        ("a.csv", csv_files.SURPLUS, '2,"a,b",3'), ("b.csv", csv_files.SURPLUS, "7,z,surplus"),
        ("b.csv", csv_files.OPEN_QUOTE, '8,"never'),
    ]


def test_quotes_over_lines_against_a_csv_parser(spark, tmp_path):
    """Random records through the standard library's writer, in blocks and files."""
    rng = random.Random(4)
    want = set()
    for f in range(6):
        lines = io.StringIO()
        writer = csv.writer(lines, lineterminator="\n", quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
        writer.writerow(["id", "a", "b"])
        for i in range(40):
            a, b = ("".join(rng.choices('xy,"\n ', k=rng.randint(1, 9))) for _ in "ab")
            writer.writerow([f"{f}-{i}", a, b])
            want.add((f"{f}-{i}", a, b))
        put(tmp_path / "c" / f"{f}.csv", lines.getvalue().encode())
    found = ingest.category_folders(spark, str(tmp_path))
    assert {tuple(r) for r in found.rows.select("id", "a", "b").collect()} == want
    assert found.rejects.isEmpty()


def test_every_byte_of_the_fallback_charset(spark, tmp_path):
    text = "".join(c for b in range(128, 256) if (c := bytes([b]).decode("cp1258", errors="replace")) != "\ufffd")
    put(tmp_path / "c" / "a.csv", f"id,name\n1,{text}\n".encode("cp1258"))
    before = spark.conf.get("spark.sql.legacy.javaCharsets", None)
    assert ingest.merge_category_folders(spark, str(tmp_path)).first().name == text
    assert spark.conf.get("spark.sql.legacy.javaCharsets", None) == before


def test_raw_folder(spark, tmp_path):
    put(tmp_path / "b.csv", b"id,x,category\n1,u,own\n")
    put(tmp_path / "a.csv", b"y,id\nv,2\n")
    put(tmp_path / "All_Categories_old.csv", b"id\n9\n")
    df = ingest.merge_raw_files(spark, str(tmp_path))
    assert df.columns == ["y", "id", "category", "source_file", "x"]
    assert sorted((r.id, r.category, r.source_file) for r in df.collect()) == [("1", "own", "b.csv"), ("2", "a", "a.csv")]


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest.merge_category_folders(spark, str(tmp_path))
    put(tmp_path / "all_categories.csv", b"id\n1\n")
    with pytest.raises(FileNotFoundError):
        ingest.merge_raw_files(spark, str(tmp_path))


def test_csv_sink_writes_byte_order_mark_and_reads_back(spark, tmp_path):
    df = spark.createDataFrame([(1, ' a "b",\nc '), (2, None)], "id long, name string")
    sinks.write_merged(df, str(tmp_path / "out"), "csv")
    part = next((tmp_path / "out").glob("part-*.csv")).read_bytes()
    assert part.startswith(b"\xef\xbb\xbfid,name")
    back = ingest.merge_raw_files(spark, str(tmp_path / "out")).select("id", "name")
    assert sorted(map(tuple, back.collect())) == [("1", ' a "b",\nc '), ("2", None)]


def test_database_types(spark):
    """What a SQL Server table is created with, as far as it can be seen without a server."""
    options = sinks.database_options("jdbc:sqlserver://host;databaseName=d", "products_clean")
    assert "createTableColumnTypes" not in options and options["dbtable"] == "products_clean"
    df = spark.createDataFrame([(1, "a", 2.0)], "id long, name string, price double")
    jvm = spark.sparkContext._jvm
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(options["url"])
    types = {f.name(): jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils.getJdbcType(f.dataType(), dialect)
             .databaseTypeDefinition() for f in df._jdf.schema().fields()}
    assert types["name"] == "NVARCHAR(MAX)" and types["id"] == "BIGINT"


def test_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "parquet")
    spark.range(3).write.parquet(path)
    sinks.load_tables(spark, {"loaded": path})
    spark.range(5).write.mode("overwrite").parquet(path)
    sinks.load_tables(spark, {"loaded": path})
    assert spark.table("loaded").count() == 5


# --------------------------------------------------------------- enrichment


def test_listing_stops_at_the_first_empty_page(spark, tmp_path):
    pages = [{"page": p, "data": d} for p, d in ((1, [{"id": 1}, {"id": 2}]), (2, [{"id": 3}]), (3, []), (4, [{"id": 4}]))]
    put(tmp_path / "pages.json", "\n".join(map(json.dumps, pages)).encode())
    assert sorted(r.id for r in payload_files.read_listing(spark, str(tmp_path)).collect()) == ["1", "2", "3"]
    only = payload_files.read_listing(spark, str(tmp_path), first_page=2, last_page=2)
    assert [r.id for r in only.collect()] == ["3"]


def test_listing_items_are_parsed_once(spark, tmp_path):
    """The first read takes the pages' lengths only."""
    put(tmp_path / "pages.json", b'{"page": 1, "data": [{"id": 1, "name": "a"}]}')
    plan = payload_files.read_listing(spark, str(tmp_path))._jdf.queryExecution().explainString(
        spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    schemas = re.findall(r"ReadSchema: (.*)", plan)
    assert len(schemas) >= 2 and sum("badges_new" in s for s in schemas) == 1


def test_broken_payloads_are_told_apart(spark, tmp_path):
    put(tmp_path / "d.json", b'{"product_id": 1, "spid": 2}\n\n{"product_id": 3, "spid"\n[]\n[{"product_id": 4}]\n[{"product_id"\n')
    rejects = payload_files.payload_rejects(spark, str(tmp_path), DETAIL).collect()
    assert [r.record for r in rejects] == ['{"product_id": 3, "spid"', '[{"product_id"'] and rejects[0].file_path.endswith("/d.json")
    put(tmp_path / "m" / "whole.json", b'{"product_id": 1,\n "spid": \n')
    put(tmp_path / "m" / "good.json", b'{"product_id": 1,\n "spid": 2}\n')
    assert payload_files.payload_rejects(spark, str(tmp_path / "m"), DETAIL, multi_line=True).count() == 1


def test_wide_rows_are_not_staged_for_the_threshold(spark, raw):
    """The quantile reads the deciding columns only."""
    plan = clean.clean_products(raw)._jdf.queryExecution().analyzed().toString()
    assert "/products-" not in plan


def test_known_quantity_before_an_unknown_one(spark):
    rows = [("1", None, "a", "f"), ("1", "-1", "b", "f"), ("2", "5", "a", "f"), ("3", None, "a", "f")]
    df = spark.createDataFrame(rows, "id string, quantity_sold string, name string, source_file string")
    best = {r.id: r.quantity_sold for r in clean.clean_products(df).collect()}
    assert best == {1: -1.0, 2: 5.0, 3: None}


def test_enrich_keeps_products_without_payloads(spark):
    items = spark.createDataFrame(
        [("1", "11", "5", "100"), ("2", None, None, "200"), ("3", "33", "7", "300")],
        "id string, seller_product_id string, seller_id string, price string",
    )
    details = spark.createDataFrame([
        (json.dumps({"product_id": 1, "spid": 11, "brand": {"id": 9, "name": "B"}, "benefits": [1]}),),
        (json.dumps({"product_id": 1, "spid": 11, "brand": {"id": 9, "name": "B"}, "benefits": [1]}),),
        (json.dumps({"product_id": 2, "inventory_status": "available"}),),
    ], "j string").select(F.from_json("j", DETAIL).alias("p")).select("p.*")
    reviews = spark.createDataFrame(
        [(json.dumps({"product_id": 2, "rating_average": 4.0, "reviews_count": 1}),)], "j string"
    ).select(F.from_json("j", REVIEW).alias("p")).select("p.*")
    rows = {r.id: r for r in enrich.enrich(items, details, reviews).collect()}
    assert len(rows) == 3 and enrich.enrich(items, details, reviews).count() == 3
    assert (rows[1].brand_or_author, rows[1].benefits_count, rows[1].rating_average) == ("id:9; name:B", 1, None)
    assert (rows[2].inventory_status, rows[2].rating_average, rows[2].stars) == ("available", 4.0, "")
    assert (rows[3].current_seller, rows[3].benefits_count, rows[3].price) == ("", 0, 300)


def test_payload_numbers_in_any_spelling(spark):
    details = spark.createDataFrame([
        ('{"product_id": "1", "spid": 11.0, "data_version": 3300.0, "day_ago_created": "7",'
         ' "authors": [{"id": 1, "name": "A"}, "loose", {"id": 2, "name": "B"}], "brand": {"id": 9, "name": "N"}}',),
        ('{"product_id": 2, "spid": 5, "authors": ["loose"], "brand": {"id": 9, "name": "N"}}',),
    ], "j string").select(F.from_json("j", DETAIL).alias("p")).select("p.*")
    rows = {r.product_id: r for r in enrich.flatten_detail(details).collect()}
    assert (rows[1].spid, rows[1].data_version, rows[1].day_ago_created) == (11, 3300, 7)
    assert rows[1].brand_or_author == "id:1,2; name:A, B"
    reviews = spark.createDataFrame(
        [('{"product_id": 1.0, "spid": "11", "seller_id": 3, "rating_average": "4.5", "reviews_count": 12.0}',)], "j string"
    ).select(F.from_json("j", REVIEW).alias("p")).select("p.*")
    assert tuple(enrich.flatten_review(reviews).first())[:5] == (1, 11, 3, 4.5, 12)
    items = spark.createDataFrame([("1", "1242000.0", "1.5e6", "12.0")], "id string, price string, original_price string, discount string")
    assert tuple(enrich.flatten_listing(items).select("price", "original_price", "discount").first()) == (1242000, 1500000, 12)


def test_broken_payload_fails_the_job(spark, tmp_path):
    put(tmp_path / "d.json", b'{"product_id": 1, "spid": 2}\n{"product_id": 3, "spid"\n')
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        payload_files.read_detail(spark, str(tmp_path)).collect()
    assert [r.product_id for r in payload_files.read_detail(spark, str(tmp_path), mode="DROPMALFORMED").collect()] == ["1"]


def test_payload_over_many_lines(spark, tmp_path):
    put(tmp_path / "d.json", json.dumps({"product_id": 1, "spid": 2}, indent=2).encode())
    assert payload_files.read_detail(spark, str(tmp_path), multi_line=True).first().product_id == "1"


def test_payload_landed_last_wins(spark, tmp_path):
    for at, name in ((2_000_000_000, "a.json"), (1_000_000_000, "b.json")):
        put(tmp_path / "d" / name, json.dumps({"product_id": 1, "spid": 2, "inventory_status": name}).encode())
        os.utime(tmp_path / "d" / name, (at, at))
    details = enrich.flatten_detail(payload_files.read_detail(spark, str(tmp_path / "d")))
    assert [r.inventory_status for r in enrich.one_per_key(details, enrich.DETAIL_KEYS, "_d").collect()] == ["a.json"]


def test_payloads_of_one_file_are_dealt_out_before_they_are_sorted(spark, tmp_path):
    """A file that unfolds into many rows, all of one key, is not sorted by the task that read it."""
    import re

    path = str(tmp_path / "d")
    spark.range(0, 2000, 1, 1).selectExpr(
        "1L AS product_id", "2L AS spid", "lpad(id, 6, '0') AS inventory_status"
    ).write.parquet(path)
    kept = enrich.one_per_key(spark.read.parquet(path), enrich.DETAIL_KEYS, "_d")
    assert [tuple(r)[-1] for r in kept.collect()] == ["001999"]
    plan = kept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    steps = re.findall(r"WindowGroupLimit|Sort|Exchange \w+|Scan", plan)
    # From the top: the choice over all, the shuffle by key, the choice in the map tasks, the dealing out, the file.
    assert steps[-4:] == ["WindowGroupLimit", "Sort", "Exchange hashpartitioning", "Scan"], plan
    assert "Exchange hashpartitioning" in steps[:-4]


# ------------------------------------------------------------------- models


@pytest.fixture(scope="module")
def goods(spark):
    rows = [
        (i, f"Item {'pro' if i % 2 else 'plain'} {i % 5}", ["x", "y", "z"][i % 3], 1000 * (1 + i % 3) + i % 7,
         None if i % 11 == 0 else i % 4, i % 2 == 0, None if i % 13 == 0 else i % 3 == 0)
        for i in range(300)
    ]
    return spark.createDataFrame(
        rows, "id long, name string, category string, price long, reviews_count long, "
              "badges_new_has_delivery_badge boolean, is_top_brand boolean"
    )


def test_flags_with_gaps_are_categories(goods):
    table = screening.screening_table(goods)
    assert screening.split_columns(table) == (
        ["reviews_count", "badges_new_has_delivery_badge"], ["name", "category", "is_top_brand"]
    )


def test_association_table(goods):
    rows = screening.association_table(goods).collect()
    assert rows[0].feature == "category" and rows[0].association_value > 0.99
    assert all(0 <= r.abs_association <= 1 for r in rows)
    assert [r.abs_association for r in rows] == sorted((r.abs_association for r in rows), reverse=True)
    chosen = screening.selected_features(screening.association_table(goods))
    assert "category" in {r.feature for r in chosen.collect()}


def test_rank_matrix_is_symmetric(goods):
    cells = {(r.feature_a, r.feature_b): r.rho for r in screening.rank_matrix(goods).collect()}
    assert len(cells) == 9
    assert all(v == pytest.approx(cells[(b, a)]) for (a, b), v in cells.items())
    assert all(v == pytest.approx(1.0) for (a, b), v in cells.items() if a == b)


def test_price_model(spark, goods):
    table = price_model.model_table(goods).cache()
    model = price_model.fit_price_model(table.where("part = 'train'"), trees=5, depth=5)
    strange = table.where("part = 'holdout'").withColumn("category", F.when(F.col("id") % 5 != 0, F.col("category")))
    predictions = price_model.predict(model, table.where("part <> 'train'"))
    scores = {r.part: r for r in price_model.evaluate(predictions).collect()}
    assert set(scores) == {"test", "holdout"} and all(r.r2 > 0.9 for r in scores.values())
    unseen = price_model.predict(model, strange.withColumn("name", F.lit("never seen"))).collect()
    assert len(unseen) == strange.count() and all(r.predicted_price > 0 for r in unseen)
    importance = price_model.feature_importance(model, table).collect()
    assert importance[0].original_feature == "category"
    assert sum(r.importance for r in importance) == pytest.approx(1.0)
    assert "name_storage_gb" not in {r.original_feature for r in importance}  # nowhere known
    points = price_model.actual_vs_predicted(predictions).first()
    assert points.diagonal_from <= points.log_actual <= points.diagonal_to


@pytest.mark.parametrize("encoding", ["target_mean", "one_hot"])
def test_encodings_use_every_category(goods, encoding):
    table = price_model.model_table(goods).cache()
    train = table.where("part = 'train'")
    model = price_model.fit_price_model(train, trees=4, depth=6, encoding=encoding, fit_rows=150)
    names = train.select("name").dropna().distinct().count()
    assert model.layout.slots["name"] == (names if encoding == "one_hot" else 1)
    assert model.layout.entries.where("feature = 'name'").count() == names
    scores = price_model.evaluate(price_model.predict(model, table.where("part <> 'train'"))).collect()
    assert all(r.r2 > 0.5 for r in scores)
    assert sum(r.importance for r in price_model.feature_importance(model, table).collect()) == pytest.approx(1.0)


def test_unknown_encoding(goods):
    with pytest.raises(ValueError, match="encoding"):
        price_model.fit_price_model(goods, encoding="other")


def test_category_means_leave_the_own_fold_out(spark):
    rows = [(i, "a" if i % 2 else "b", float(i)) for i in range(40)]
    table = spark.createDataFrame(rows, "id long, c string, log_price double")
    means = price_model.category_means(table, ["c"], "id").cache()
    layout = price_model.Layout("target_mean", (), ("c",), {}, {"c": 1}, means, 10.0)
    numbered = table.withColumns({"_row": F.col("id"), "f": price_model._fold("id")}).cache()
    out = price_model._vectors(layout, numbered, "f").collect()
    assert len(out) == 40
    for r in out:
        others = [x.log_price for x in out if x.c == r.c and x.f != r.f]
        assert r.features["values"][0] == pytest.approx((sum(others) + 50.0) / (len(others) + 5.0))
    new = spark.createDataFrame([(1, "a"), (2, "never seen")], "_row long, c string")
    seen = {r.c: r.features["values"][0] for r in price_model._vectors(layout, new).collect()}
    assert seen["a"] == pytest.approx((sum(i for i in range(40) if i % 2) + 50.0) / 25.0) and seen["never seen"] == 10.0


def test_one_hot_slots(spark):
    rows = [(1, 2.5, "b", True), (2, 0.0, "a", None), (3, None, "b", False), (4, 1.5, None, True), (5, 9.0, "c", True)]
    table = spark.createDataFrame(rows, "id long, x double, c string, flag boolean").withColumn("log_price", F.lit(1.0))
    layout = price_model.fit_layout(table.withColumn("price", F.lit(1)), kind="one_hot")
    numbers = {(r.feature, r.value): r.number for r in layout.entries.collect()}
    assert numbers == {("c", "b"): 0, ("c", "a"): 1, ("c", "c"): 2, ("flag", "true"): 0, ("flag", "false"): 1}
    assert layout.slots == {"x": 1, "c": 3, "flag": 2} and layout.fills == {"x": 2.0, "c": "b", "flag": "true"}
    more = table.unionByName(table.limit(1).withColumns({"id": F.lit(6).cast("long"), "c": F.lit("new")}))
    found = price_model.feature_slots(layout, more)
    got = {r.id: (r.features["size"], r.features["indices"], r.features["values"]) for r in found.collect()}
    assert got[1] == (6, [0, 1, 4], [2.5, 1.0, 1.0]) and got[2] == (6, [0, 2, 4], [0.0, 1.0, 1.0])
    assert got[3] == (6, [0, 1, 5], [2.0, 1.0, 1.0]) and got[4] == (6, [0, 1, 4], [1.5, 1.0, 1.0])
    assert got[6] == (6, [0, 4], [2.5, 1.0])
    vectors = as_vectors(found.select("id", "features"), "features").collect()
    assert {r.id: list(r.features.indices) for r in vectors} == {i: g[1] for i, g in got.items()}


def test_nothing_to_learn_from(spark):
    table = spark.createDataFrame([(1, None, 1, 1.0)], "id long, x double, price int, log_price double")
    with pytest.raises(ValueError, match="no feature"):
        price_model.fit_price_model(table)


def test_numbers_alone(goods):
    table = price_model.model_table(goods, features=("reviews_count",)).cache()
    model = price_model.fit_price_model(table.where("part = 'train'"), trees=2, depth=3)
    assert model.layout.slots == {"reviews_count": 1} and model.layout.entries is None
    assert price_model.predict(model, table).count() == table.count()


def test_forest_without_bagging_is_one_greedy_tree(spark):
    """Leaves are the means of their cells, and one cut explains all there is."""
    rows = [(i, ["a", "b", "c"][i % 3], float(i % 2), 1000 * (1 + i % 3)) for i in range(120)]
    frame = spark.createDataFrame(rows, "id long, brand_name string, reviews_count double, price long")
    table = price_model.model_table(frame, features=("brand_name", "reviews_count")).cache()
    model = price_model.fit_price_model(
        table.where("part = 'train'"), trees=4, depth=5, encoding="one_hot", bagging=False
    )
    scored = price_model.predict(model, table).collect()
    assert all(r.predicted_price == pytest.approx(r.actual_price) for r in scored)
    weights = {r.original_feature: r.importance for r in price_model.feature_importance(model, table).collect()}
    assert weights == {"brand_name": pytest.approx(1.0), "reviews_count": pytest.approx(0.0, abs=1e-9)}
