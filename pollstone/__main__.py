"""Jobs for ``spark-submit``: ``python -m pollstone <job> --lake <root> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from pollstone.plans.end_to_end import run_all
from pollstone.plans.gold import run_silver_to_gold
from pollstone.plans.ingest import ingest_databases, ingest_files, ingest_payloads
from pollstone.plans.silver import SurveyChoices, run_bronze_to_silver
from pollstone.session import build_session
from pollstone.sources.registry import API_SOURCES, Lake


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pollstone")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        made = jobs.add_parser(name, help=text)
        made.add_argument("--lake", required=True, help="root folder of the lake")
        return made

    job("files", "land new raw files").add_argument("--raw", required=True)
    answers = job("answers", "land service answers")
    answers.add_argument("--raw", required=True)
    answers.add_argument("--source", required=True, choices=sorted(API_SOURCES))
    extract = job("tables", "land database tables")
    extract.add_argument("--url", required=True)
    extract.add_argument("--split", help="column:low:high:partitions, to read the responses in parallel")
    clean = job("silver", "raw to clean tables")
    clean.add_argument("--with-database", action="store_true")
    clean_choices(clean)
    job("gold", "clean to business tables")
    whole = job("all", "everything in order")
    whole.add_argument("--raw", required=True)
    whole.add_argument("--answers")
    clean_choices(whole)
    return top


def clean_choices(made: argparse.ArgumentParser) -> None:
    made.add_argument("--aliases", help="CSV file with the columns alias and country_name")
    made.add_argument("--copies", action="store_true", help="keep the true number of copies")
    made.add_argument("--hold-back", action="store_true", help="leave out rows that break the contract")


def choices(spark: SparkSession, options: argparse.Namespace) -> SurveyChoices:
    aliases = spark.read.csv(options.aliases, header=True) if options.aliases else None
    return SurveyChoices(aliases, options.copies, options.hold_back)


def split(text: str | None) -> dict[str, object]:
    """``column:low:high:partitions`` as arguments of an extract."""
    if not text:
        return {}
    column, low, high, partitions = text.rsplit(":", 3)
    return {"split_column": column, "bounds": (int(low), int(high)), "partitions": int(partitions)}


def run(spark: SparkSession, options: argparse.Namespace) -> object:
    lake = Lake.under(options.lake)
    if options.job == "files":
        return ingest_files(spark, options.raw, lake)
    if options.job == "answers":
        return ingest_payloads(spark, options.raw, lake, options.source)
    if options.job == "tables":
        return ingest_databases(spark, options.url, lake, splits={"survey_responses": split(options.split)})
    if options.job == "silver":
        return run_bronze_to_silver(spark, lake, with_database=options.with_database, choices=choices(spark, options))
    if options.job == "gold":
        return run_silver_to_gold(spark, lake)
    return run_all(spark, lake, options.raw, options.answers, choices=choices(spark, options))


def main() -> None:
    options = parser().parse_args()
    spark = build_session()
    try:
        run(spark, options)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
