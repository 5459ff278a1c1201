"""The jobs from the command line.

    python -m shelflens merge-folders CRAWL_ROOT RAW_OUT
    python -m shelflens merge-raw RAW_ROOT MERGED_OUT
    python -m shelflens clean MERGED CLEAN_OUT
    python -m shelflens enrich LISTING DETAIL REVIEW OUT
    python -m shelflens load TABLE CLEAN [--url JDBC_URL]
    python -m shelflens load-folder FOLDER [--url JDBC_URL]
    python -m shelflens ask QUESTION CLEAN OUT [--dialect sql|frame]
    python -m shelflens screen CLEAN OUT
    python -m shelflens model CLEAN OUT [--trees N --depth N --encoding E --features selected --fit-rows N]

Inputs and outputs are folders.  Tables are written as Parquet, or with `--csv`
as CSV, as which `clean` then reads them; the jobs on a clean table see what it
is.  Records and payloads that cannot be read are written beside
the result, to OUT_rejects.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .plans import business, charts, clean, enrich, ingest, load, price_model, screening
from .schema import DETAIL, LISTING_PAGE, NAME_FEATURES, REVIEW
from .session import build_session
from .sources import payload_files, sinks
from .staging import stage

QUESTIONS = {
    "gmv": business.gmv_share,
    "discounts": business.discount_by_category,
    "best-sellers": business.best_seller_comparison,
    "ratings": business.rating_bins,
}
CHARTS = {
    "pareto": charts.pareto,
    "categories-to-80": charts.categories_to_share,
    "discount-bars": charts.discount_bars,
    "best-seller-panels": charts.best_seller_panels,
    "rating-bars": charts.rating_bars,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="shelflens", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    top.add_argument("--csv", action="store_true", help="write CSV instead of Parquet")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, *places):
        added = jobs.add_parser(name)
        for place in places:
            added.add_argument(place)
        return added

    job("merge-folders", "source", "out")
    job("merge-raw", "source", "out")
    job("clean", "source", "out")
    job("enrich", "listing", "detail", "review", "out")
    job("load", "table", "source").add_argument("--url")
    job("load-folder", "source").add_argument("--url")
    asked = jobs.add_parser("ask")
    asked.add_argument("question", choices=[*QUESTIONS, *CHARTS])
    asked.add_argument("source")
    asked.add_argument("out")
    asked.add_argument("--dialect", choices=sorted(business.RATING_LABELS), default="sql")
    job("screen", "source", "out")
    model = job("model", "source", "out")
    model.add_argument("--trees", type=int, default=price_model.TREES)
    model.add_argument("--depth", type=int, default=price_model.DEPTH)
    model.add_argument("--encoding", choices=("target_mean", "one_hot"), default="target_mean")
    model.add_argument(
        "--features", choices=("fixed", "selected"), default="fixed",
        help="selected: those that go with the price on the training rows",
    )
    model.add_argument("--fit-rows", type=int, help="labelled rows the forest is grown on (default: all)")
    return top


def raw_table(spark, source: str, csv: bool):
    """The raw rows of an earlier job: CSV with `--csv`, else Parquet."""
    return ingest.merge_raw_files(spark, source) if csv else spark.read.parquet(source)


def write_counts(merged: ingest.Merged, out: str, form: str) -> None:
    """What was counted while the rows were written, and the rejects if there are any."""
    counts = merged.counts()
    sinks.write_merged(counts, f"{out}_counts", form)
    if not counts.where("reason IS NOT NULL AND n > 0").isEmpty():
        sinks.write_merged(merged.rejects, f"{out}_rejects", form)


def write_payload_rejects(spark, args, form: str) -> None:
    kinds = {"listing": LISTING_PAGE, "detail": DETAIL, "review": REVIEW}
    found = [
        payload_files.payload_rejects(spark, getattr(args, kind), schema).withColumn("kind", F.lit(kind))
        for kind, schema in kinds.items()
    ]
    rejects = stage(ingest.union_by_name(found), "rejects")
    if not rejects.isEmpty():
        sinks.write_merged(rejects, f"{args.out.rstrip('/')}_rejects", form)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"shelflens {args.job}")
    form = "csv" if args.csv else "parquet"
    if args.job == "merge-folders":
        out = args.out.rstrip("/")
        merged = ingest.category_folders(spark, args.source)
        sinks.write_by_category(merged.rows, out, form)
        write_counts(merged, out, form)
        # The source files are not read again: Parquet's own row counts answer this.
        sinks.write_merged(ingest.merge_report(raw_table(spark, out, args.csv)), f"{out}_report", form)
    elif args.job == "merge-raw":
        merged = ingest.raw_files(spark, args.source)
        sinks.write_merged(merged.rows, args.out, form)
        write_counts(merged, args.out.rstrip("/"), form)
    elif args.job == "clean":
        sinks.write_merged(clean.clean_products(raw_table(spark, args.source, args.csv)), args.out, form)
    elif args.job == "enrich":
        rows = enrich.enrich(
            payload_files.read_listing(spark, args.listing, mode="DROPMALFORMED"),
            payload_files.read_detail(spark, args.detail, mode="DROPMALFORMED"),
            payload_files.read_review(spark, args.review, mode="DROPMALFORMED"),
        )
        sinks.write_merged(rows, args.out, form)
        write_payload_rejects(spark, args, form)
    elif args.job == "load":
        table = load.read_table(spark, args.source)
        if args.url:
            sinks.load_database({args.table: table}, args.url)
        else:
            sinks.replace_table(table, args.table)
    elif args.job == "load-folder":
        load.load_folder(spark, args.source, args.url)
    elif args.job == "ask":
        products = load.read_table(spark, args.source)
        if args.question in QUESTIONS:
            answer = QUESTIONS[args.question](products, args.dialect)
        else:
            answer = CHARTS[args.question](products)
        sinks.write_merged(answer, args.out, form)
    elif args.job == "screen":
        products = load.read_table(spark, args.source)
        sinks.write_merged(screening.association_table(products), f"{args.out}/associations", form)
        sinks.write_merged(screening.rank_matrix(products), f"{args.out}/rank_matrix", form)
    else:
        products = load.read_table(spark, args.source)
        features = {}
        if args.features == "selected":
            features["features"] = (*price_model.selected_features(products), *NAME_FEATURES)
        table = stage(price_model.model_table(products, **features), "model_table")
        model = price_model.fit_price_model(
            table.where("part = 'train'"), trees=args.trees, depth=args.depth, encoding=args.encoding,
            fit_rows=args.fit_rows,
        )
        scored = stage(price_model.predict(model, table.where("part <> 'train'")), "scored")
        sinks.write_merged(scored.where("part = 'holdout'").drop("part"), f"{args.out}/holdout_predictions", form)
        sinks.write_merged(price_model.evaluate(scored), f"{args.out}/evaluation", form)
        sinks.write_merged(price_model.feature_importance(model, table), f"{args.out}/importance", form)


if __name__ == "__main__":
    main()
