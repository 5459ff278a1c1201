"""The jobs chained from the command line on a small crawl folder."""

from __future__ import annotations

import pytest

from shelflens.__main__ import main
from shelflens.plans import business, clean, ingest, load
from shelflens.sources import csv_files, sinks


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    for c in range(3):
        (root / "crawl" / f"cat {c}").mkdir(parents=True)
        lines = ["id,name,price,quantity_sold,rating_average,reviews_count,discount_rate,brand_or_author"]
        lines += [
            f'{100 * c + i},"Item {i % 4}, {"pro" if i % 2 else "x"}",{1000 * (c + 1) + i},{i % 9}.0,4.{i % 9},{i % 5},'
            f"{i},id:{i % 3}; name:B{i % 3}"
            for i in range(40)
        ]
        (root / "crawl" / f"cat {c}" / "page01.csv").write_text("\n".join(lines), encoding="utf-8-sig")
    return root


def test_chain(spark, folders):
    at = lambda *parts: str(folders.joinpath(*parts))
    main(["merge-folders", at("crawl"), at("raw")])
    main(["clean", at("raw"), at("clean")])
    cleaned = spark.read.parquet(at("clean"))
    assert cleaned.count() == 120
    assert {r.category for r in cleaned.select("category").distinct().collect()} == {"cat 0", "cat 1", "cat 2"}

    main(["ask", "gmv", at("clean"), at("gmv"), "--dialect", "frame"])
    assert spark.read.parquet(at("gmv")).count() == 3
    main(["--csv", "ask", "pareto", at("clean"), at("pareto")])
    assert spark.read.option("header", True).csv(at("pareto")).count() == 3
    main(["screen", at("clean"), at("screen")])
    assert spark.read.parquet(at("screen", "associations")).count() > 3

    main(["model", at("clean"), at("model"), "--trees", "3", "--depth", "3"])
    parts = {r.part for r in spark.read.parquet(at("model", "evaluation")).collect()}
    assert parts == {"test", "holdout"}
    main(["model", at("clean"), at("model2"), "--trees", "2", "--depth", "2", "--features", "selected", "--encoding", "one_hot"])
    chosen = {r.original_feature for r in spark.read.parquet(at("model2", "importance")).collect()}
    assert "category" in chosen and "name_inch" not in chosen
    main(["load", "products_clean", at("clean")])
    assert spark.table("products_clean").count() == 120
    counted = {r.reason: r.n for r in spark.read.parquet(at("raw_counts")).collect()}
    assert counted == {None: 120, csv_files.SURPLUS: 0, csv_files.OPEN_QUOTE: 0, csv_files.HEADER_AGAIN: 0}
    report = {(r.category, r.total): r["rows"] for r in spark.read.parquet(at("raw_report")).collect()}
    assert report == {("cat 0", 0): 40, ("cat 1", 0): 40, ("cat 2", 0): 40, (None, 1): 120}
    assert not folders.joinpath("raw_rejects").exists()


def test_csv_chain(spark, folders):
    at = lambda *parts: str(folders.joinpath(*parts))
    main(["--csv", "merge-folders", at("crawl"), at("raw_csv")])
    main(["merge-raw", at("raw_csv"), at("merged")])
    merged = spark.read.parquet(at("merged"))
    assert merged.count() == 120
    seen = {tuple(r) for r in merged.select("category", "source_file").distinct().collect()}
    assert {c for c, _ in seen} == {"cat 0", "cat 1", "cat 2"} and ("cat 1", "page01.csv") in seen
    main(["--csv", "clean", at("raw_csv"), at("clean_csv")])
    assert spark.read.option("header", True).csv(at("clean_csv")).count() == 120
    typed = load.read_csv_table(spark, at("clean_csv"))
    from_parquet = clean.clean_products(ingest.merge_raw_files(spark, at("raw_csv")))
    assert dict(typed.dtypes) == dict(from_parquet.dtypes)
    main(["ask", "gmv", at("clean_csv"), at("gmv_csv")])
    shares = spark.read.parquet(at("gmv_csv")).collect()
    assert sorted(round(r.gmv_pct) for r in shares) == sorted(round(r.gmv_pct) for r in business.gmv_share(typed).collect())
    main(["--csv", "screen", at("clean_csv"), at("screen_csv")])
    assert spark.read.option("header", True).csv(at("screen_csv", "associations")).count() > 3


def test_categories_come_back_unchanged(spark, tmp_path):
    """Names that paths escape, that look like numbers, and none at all, through CSV and Parquet."""
    names = ["a/b", "cat: x", "kid's", "50% off", "c=d", "007", "010", None]
    rows = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "id string, category string")
    want = {(str(i), n) for i, n in enumerate(names)}
    sinks.write_by_category(rows, str(tmp_path / "csv"), "csv")
    back = ingest.merge_raw_files(spark, str(tmp_path / "csv"))
    assert {tuple(r) for r in back.select("id", "category").collect()} == want
    sinks.write_by_category(rows, str(tmp_path / "parquet"))
    back = spark.read.parquet(str(tmp_path / "parquet"))
    assert {tuple(r) for r in back.select("id", "category").collect()} == want


def test_rejects_are_written_beside_the_result(spark, tmp_path):
    at = lambda *parts: str(tmp_path.joinpath(*parts))
    (tmp_path / "crawl" / "a").mkdir(parents=True)
    (tmp_path / "crawl" / "a" / "p.csv").write_text("id,name\n1,x\n2,y,z\nid,name\n")
    main(["merge-folders", at("crawl"), at("raw")])
    assert [(r.id, r.name, r.category) for r in spark.read.parquet(at("raw")).collect()] == [("1", "x", "a")]
    rejects = {(r.reason, r.record) for r in spark.read.parquet(at("raw_rejects")).collect()}
    assert rejects == {(csv_files.SURPLUS, "2,y,z"), (csv_files.HEADER_AGAIN, "id,name")}
    counted = {r.reason: r.n for r in spark.read.parquet(at("raw_counts")).collect()}
    assert counted == {None: 1, csv_files.SURPLUS: 1, csv_files.OPEN_QUOTE: 0, csv_files.HEADER_AGAIN: 1}

    for name, lines in {
        "l": ['{"page": 1, "data": [{"id": 1, "seller_product_id": 5, "seller_id": 2}]}', '{"page": 2, "data": ['],
        "d": ['{"product_id": 1, "spid": 5, "inventory_status": "here"}', "oops"], "r": ['{"product_id": 1}', ""],
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.json").write_text("\n".join(lines))
    main(["enrich", at("l"), at("d"), at("r"), at("rich")])
    assert [(r.id, r.inventory_status) for r in spark.read.parquet(at("rich")).collect()] == [(1, "here")]
    broken = {(r.kind, r.record) for r in spark.read.parquet(at("rich_rejects")).collect()}
    assert broken == {("listing", '{"page": 2, "data": ['), ("detail", "oops")}


def test_load_folder(spark, tmp_path):
    folder = tmp_path / "in"
    spark.createDataFrame([(1, "a")], "id long, name string").write.parquet(str(folder / "one.parquet"))
    spark.createDataFrame([(2, "b"), (3, None)], "id long, name string").write.option("header", True).csv(str(folder / "Two words"))
    (folder / "three.csv").write_text("id,price,odd\n4,1000,x\n")
    (folder / "notes.txt").write_text("no table")
    main(["load-folder", str(folder)])
    assert [tuple(r) for r in spark.table("one").collect()] == [(1, "a")]
    assert sorted(tuple(r) for r in spark.table("two_words").collect()) == [(2, "b"), (3, None)]
    assert [tuple(r) for r in spark.table("three").collect()] == [(4, 1000, "x")]
    (folder / "three.csv").write_text("id,price,odd\n5,2000,y\n")
    assert load.load_folder(spark, str(folder)) == ["two_words", "one", "three"]
    assert [r.id for r in spark.table("three").collect()] == [5]
    # A broken entry leaves the old tables as they were.
    (folder / "one.parquet2").mkdir()
    (folder / "zero.parquet").write_text("not parquet")
    (folder / "three.csv").write_text("id,price,odd\n6,3000,z\n")
    with pytest.raises(Exception):
        load.load_folder(spark, str(folder))
    assert [r.id for r in spark.table("three").collect()] == [5]
    assert not [t.name for t in spark.catalog.listTables() if t.name.endswith("__new")]
    with pytest.raises(FileNotFoundError):
        load.load_folder(spark, str(tmp_path / "nowhere"))
    (folder / "ONE.csv").write_text("id\n1\n")
    with pytest.raises(ValueError, match="both be table one"):
        load.folder_tables(spark, str(folder))
