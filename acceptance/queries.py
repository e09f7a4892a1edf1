"""Registered queries: each reads the given tables whole and returns a lazy DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pollstone import fixtures
from pollstone.contracts import catalog
from pollstone.contracts.model import ERRORS, Contract
from pollstone.functions import expr
from pollstone.functions.durable import durable, shared_folder
from pollstone.operators import (
    cleaning,
    dedup,
    findings,
    ledger,
    quality,
    reference,
    rollups,
    serving,
    validation,
)
from pollstone.plans import bookkeeping, end_to_end, increment, ingest
from pollstone.plans import gold as gold_plan
from pollstone.sources import csv_files, payloads, readers, tables, writers
from pollstone.sources.readers import list_files, read_bronze
from pollstone.sources.registry import API_SOURCES, Lake, bronze_datasets
from pollstone.streaming import responses

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Load times and layer names are checked by the unit tests, not by value.
MARKS = ("gold_processed_at", "execution_date", "source_layer", "target_layer")


def query(function: Query) -> Query:
    """Register a query; times are compared in UTC whatever the session was started with."""

    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


def plain(df: DataFrame) -> DataFrame:
    """Without marks, and with times as plain wall-clock values."""
    kept = df.drop(*MARKS)
    times = {f.name: F.col(f.name).cast("timestamp_ntz") for f in kept.schema.fields if f.dataType.typeName() == "timestamp"}
    return kept.withColumns(times) if times else kept


def now() -> Column:
    return F.to_timestamp(F.lit("2002-01-01 00:00:00"))


def silver(spark: SparkSession, folder: str) -> DataFrame:
    """Clean responses; order keys are unique, so the raw rows need no deduplication."""
    cleaned = cleaning.clean_survey_responses(fixtures.survey_raw(spark, folder))
    return cleaning.add_silver_metadata(cleaned, processed_at=F.col("submission_timestamp"))


def feed_clean(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = cleaning.clean_survey_responses(fixtures.survey_feed(spark, folder))
    return cleaning.add_silver_metadata(cleaned, processed_at=F.col("loaded_at").cast("timestamp"))


def feed_silver(spark: SparkSession, folder: str) -> DataFrame:
    order = ["loaded_at", "submission_timestamp"]
    return dedup.merge_copies(feed_clean(spark, folder).drop("source_layer", "target_layer", "silver_processed_at"), ["response_id"], order)


def population_silver(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_world_bank_population(fixtures.population_payload(spark, folder))


def countries_silver(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_country_reference(fixtures.countries_payload(spark, folder))


# Cleaning, deduplication, validation


@query
def clean_survey(spark, folder):
    return plain(cleaning.clean_survey_responses(fixtures.survey_raw(spark, folder)))


@query
def clean_population(spark, folder):
    return population_silver(spark, folder)


@query
def clean_country_ref(spark, folder):
    return countries_silver(spark, folder)


@query
def rename_snake_case(spark, folder):
    customer = fixtures.table(spark, folder, "customer")
    messy = customer.toDF(" Customer ID", "fullName", "Nation-Key", "acctBal (2)", "Market__Segment ")
    return cleaning.standardize_column_names(messy)


@query
def load_table_cleaning(spark, folder):
    customer = fixtures.table(spark, folder, "customer")
    renamed = customer.withColumnsRenamed({"c_mktsegment": "Market Segment", "c_nationkey": " NATION-key"})
    return cleaning.clean_loaded_table(renamed.unionByName(renamed))


@query
def exact_dedup(spark, folder):
    feed = feed_clean(spark, folder)
    return plain(dedup.drop_exact_copies(feed.unionByName(feed)))


@query
def dedup_by_key(spark, folder):
    rows = feed_clean(spark, folder).drop("source_layer", "target_layer", "silver_processed_at")
    return plain(dedup.dedup_survey_responses(rows))


@query
def keep_latest(spark, folder):
    return dedup.keep_latest(
        fixtures.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate"
    )


@query
def merge_copies(spark, folder):
    return plain(
        feed_silver(spark, folder).select("response_id", "q3_trust_govt", "loaded_at", "copies", "duplicate_flag")
    )


@query
def validate_survey(spark, folder):
    return validation.validate_dataset(silver(spark, folder), "survey_responses")


@query
def validate_survey_feed(spark, folder):
    return validation.validate_dataset(feed_clean(spark, folder), "survey_responses")


@query
def validate_population(spark, folder):
    return validation.validate_dataset(population_silver(spark, folder), "world_bank_population")


@query
def validate_country_ref(spark, folder):
    return validation.validate_dataset(countries_silver(spark, folder), "country_reference")


@query
def validation_pass_rate(spark, folder):
    return validation.pass_rate(validate_survey_feed(spark, folder))


@query
def contract_check(spark, folder):
    """Rows per kind of contract violation when the corruption question must be a number."""
    asked = catalog.BRONZE_SURVEY
    numeric = type(asked)(
        asked.dataset,
        tuple(type(f)(f.name, "integer" if f.name == "q4_corruption" else f.type, f.required) for f in asked.fields),
        asked.primary_key,
    )
    checked = numeric.with_errors(fixtures.survey_raw(spark, folder))
    return checked.groupBy(F.concat_ws(",", ERRORS).alias("errors")).agg(F.count(F.lit(1)).alias("n"))


@query
def contract_conform(spark, folder):
    return plain(catalog.BRONZE_SURVEY.conform(fixtures.survey_raw(spark, folder)))


@query
def contract_rejects(spark, folder):
    """Raw responses that lack a required field, with what they lack."""
    _, rejected = catalog.BRONZE_SURVEY.split(fixtures.survey_raw(spark, folder))
    return rejected.select("response_id", F.concat_ws(",", ERRORS).alias("errors"))


@query
def declared_silver(spark, folder):
    """Deduplicated responses with every declared column of the clean layer."""
    rows = feed_silver(spark, folder).drop("duplicate_flag")
    loaded = rows.withColumn("ingestion_timestamp", F.col("loaded_at"))
    return plain(reference.declared_survey(loaded, population_silver(spark, folder)))


@query
def silver_enriched(spark, folder):
    checked = reference.with_row_checks(feed_silver(spark, folder).drop("duplicate_flag"))
    return reference.with_country_codes(checked, population_silver(spark, folder)).select(
        "response_id", "country", "country_code", "submission_date", "age_group", "duplicate_flag", "validation_status"
    )


@query
def country_aliases(spark, folder):
    """Nations renamed to their region through an alias table that lacks one region."""
    nation, region = (fixtures.table(spark, folder, name) for name in ("nation", "region"))
    aliases = nation.join(region, nation.n_regionkey == region.r_regionkey).filter("r_regionkey <> 0")
    aliases = aliases.select(F.col("n_name").alias("alias"), F.col("r_name").alias("country_name"))
    renamed = reference.standardize_country_names(silver(spark, folder), aliases)
    return renamed.groupBy("country").agg(F.count(F.lit(1)).alias("responses"))


# Business tables


@query
def country_survey_kpis(spark, folder):
    return plain(
        rollups.country_survey_kpis(
            silver(spark, folder), countries_silver(spark, folder), population_silver(spark, folder)
        )
    )


@query
def country_survey_kpis_by_country(spark, folder):
    return plain(
        rollups.country_survey_kpis(
            silver(spark, folder), countries_silver(spark, folder), population_silver(spark, folder), grain=["country"]
        )
    )


@query
def survey_feed_to_kpis(spark, folder):
    """The whole way: clean, keep the latest delivery, KPIs with true duplicate counts."""
    return plain(
        rollups.country_survey_kpis(
            feed_silver(spark, folder), countries_silver(spark, folder), population_silver(spark, folder)
        )
    )


@query
def demographic_distribution(spark, folder):
    return plain(rollups.demographic_distribution(silver(spark, folder)))


@query
def response_volume_trends(spark, folder):
    return plain(rollups.response_volume_trends(silver(spark, folder)))


@query
def governance_trust(spark, folder):
    return plain(rollups.governance_trust(silver(spark, folder)))


@query
def democracy_perception(spark, folder):
    return plain(rollups.democracy_perception(silver(spark, folder)))


@query
def corruption_perception(spark, folder):
    return plain(rollups.corruption_perception(silver(spark, folder)))


@query
def corruption_perception_numbers_only(spark, folder):
    """Word answers read as numbers only: no average, no counts, lowest level."""
    return plain(rollups.corruption_perception(silver(spark, folder), levels=None))


@query
def corruption_distribution(spark, folder):
    return plain(rollups.corruption_levels(silver(spark, folder)))


@query
def election_fairness(spark, folder):
    return plain(rollups.election_fairness(silver(spark, folder)))


@query
def population_coverage(spark, folder):
    return plain(rollups.population_coverage(silver(spark, folder), population_silver(spark, folder)))


@query
def place_rollup_trust(spark, folder):
    rollup = rollups.place_rollup(silver(spark, folder))
    return plain(rollups.perception_from_rollup(rollup, "governance_trust_gold"))


@query
def place_rollup_kpis(spark, folder):
    rollup = rollups.place_rollup(silver(spark, folder))
    return plain(
        rollups.kpis_from_rollup(rollup, countries_silver(spark, folder), population_silver(spark, folder))
    )


@query
def place_rollup_coverage(spark, folder):
    rollup = rollups.place_rollup(silver(spark, folder))
    return plain(rollups.coverage_from_rollup(rollup, population_silver(spark, folder)))


# Quality and platform


def profile(spark, folder):
    return quality.response_profile(silver(spark, folder))


@query
def data_quality_summary(spark, folder):
    return plain(quality.data_quality_summary(profile(spark, folder)))


@query
def reliability_index(spark, folder):
    return plain(quality.reliability_index(profile(spark, folder), now=now()))


@query
def job_runtime(spark, folder):
    return plain(quality.pipeline_runtime(profile(spark, folder), now=now()))


@query
def job_status(spark, folder):
    return plain(quality.pipeline_status(profile(spark, folder), now=now()))


@query
def data_freshness(spark, folder):
    return plain(quality.data_freshness(profile(spark, folder), now=now()))


@query
def freshness_by_country(spark, folder):
    return plain(quality.freshness_by_country(silver(spark, folder), now=now()))


@query
def dq_by_country(spark, folder):
    table = quality.quality_by_country(feed_clean(spark, folder))
    return table.withColumn("failed_checks", F.concat_ws(",", "failed_checks"))


@query
def cleaning_reduction(spark, folder):
    return quality.cleaning_reduction(fixtures.survey_feed(spark, folder), ["response_id"])


# Serving


@query
def country_summary(spark, folder):
    return serving.country_summary(country_survey_kpis(spark, folder))


def _kpis_and_trust(spark, folder):
    """Both tables off one written rollup: the responses are read once."""
    rollup = durable(rollups.place_rollup(silver(spark, folder)))
    return (
        rollups.kpis_from_rollup(rollup, countries_silver(spark, folder), population_silver(spark, folder)),
        rollups.perception_from_rollup(rollup, "governance_trust_gold"),
    )


@query
def business_kpis(spark, folder):
    return serving.business_kpis(*_kpis_and_trust(spark, folder))


@query
def business_kpi_texts(spark, folder):
    return serving.business_kpi_texts(*_kpis_and_trust(spark, folder))


@query
def platform_kpis(spark, folder):
    row = durable(profile(spark, folder))
    return serving.platform_kpis(
        quality.pipeline_status(row, now=now()),
        quality.data_quality_summary(row),
        quality.reliability_index(row, now=now()),
        quality.data_freshness(row, now=now()),
    )


@query
def country_mean_trust(spark, folder):
    return serving.country_means(governance_trust(spark, folder), "average_trust_score")


@query
def country_mean_democracy(spark, folder):
    return serving.country_means(democracy_perception(spark, folder), "average_democracy_score")


@query
def country_mean_fairness(spark, folder):
    return serving.country_means(election_fairness(spark, folder), "average_fairness_score")


@query
def gender_split(spark, folder):
    return serving.responses_by_gender(demographic_distribution(spark, folder))


@query
def quality_scores_long(spark, folder):
    return serving.quality_scores(data_quality_summary(spark, folder))


@query
def record_breakdown(spark, folder):
    return serving.record_breakdown(data_quality_summary(spark, folder))


@query
def job_health(spark, folder):
    return serving.job_health(job_status(spark, folder))


@query
def reliability_breakdown(spark, folder):
    return serving.reliability_breakdown(reliability_index(spark, folder))


@query
def civic_comparison(spark, folder):
    rollup = durable(rollups.place_rollup(silver(spark, folder)))
    return serving.civic_comparison(
        *[rollups.perception_from_rollup(rollup, f"{name}_gold") for name in ("democracy_perception", "election_fairness")]
    )


@query
def business_findings(spark, folder):
    """Six findings from tables that share one scan: the rollup is written once and read six times."""
    rollup = durable(rollups.place_rollup(silver(spark, folder)))
    population = population_silver(spark, folder)
    return findings.business_findings(
        rollups.kpis_from_rollup(rollup, countries_silver(spark, folder), population),
        *[rollups.perception_from_rollup(rollup, name) for name in rollups.PERCEPTIONS],
        rollups.coverage_from_rollup(rollup, population),
    )


@query
def platform_findings(spark, folder):
    """Three findings from one written profile row."""
    row = durable(profile(spark, folder))
    return findings.platform_findings(
        quality.pipeline_status(row, now=now()),
        quality.reliability_index(row, now=now()),
        quality.data_freshness(row, now=now()),
    )


@query
def report_findings(spark, folder):
    return findings.report_findings(business_findings(spark, folder), platform_findings(spark, folder))


@query
def risk_summary(spark, folder):
    return findings.risk_summary(report_findings(spark, folder))


@query
def top10_responses(spark, folder):
    return serving.top(country_summary(spark, folder), "total_responses")


@query
def bottom10_completion(spark, folder):
    return serving.bottom(country_summary(spark, folder), "completion_rate")


@query
def top10_coverage(spark, folder):
    return serving.top(population_coverage(spark, folder), "responses_per_million")


@query
def top10_trust(spark, folder):
    return serving.top(country_mean_trust(spark, folder), "average_trust_score")


@query
def top10_democracy(spark, folder):
    return serving.top(country_mean_democracy(spark, folder), "average_democracy_score")


@query
def top10_fairness(spark, folder):
    return serving.top(country_mean_fairness(spark, folder), "average_fairness_score")


def _ranking(table, score):
    """A whole ranking with the place of each row, as results are compared without order."""
    return serving.with_rank(table.select("country", score), score)


@query
def ranking_responses(spark, folder):
    return _ranking(country_summary(spark, folder), "total_responses")


@query
def ranking_trust(spark, folder):
    return _ranking(country_mean_trust(spark, folder), "average_trust_score")


@query
def ranking_corruption(spark, folder):
    table = serving.country_means(corruption_perception(spark, folder), "average_corruption_score")
    return _ranking(table, "average_corruption_score")


@query
def coverage_map(spark, folder):
    return serving.coverage_map(population_coverage(spark, folder))


# Sources and ingestion


@query
def union_sources(spark, folder):
    """Bag union of tables with different columns, missing ones as NULL."""
    named = {
        "survey": fixtures.survey_raw(spark, folder),
        "population": fixtures.population(spark, folder),
        "reference": fixtures.countries(spark, folder),
    }
    parts = [df.withColumn("source_table", F.lit(name)) for name, df in named.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("country").alias("with_country"),
        F.count("year").alias("with_year"),
    )


@query
def new_files(spark, folder):
    """Pages whose (name, content hash) has no processed entry: short pages changed, .com pages failed."""
    pages = fixtures.table(spark, folder, "pages")
    files = pages.select(F.col("url").alias("file_name"), F.sha2("html", 256).alias("file_hash"))
    changed = F.when(F.length("html") > 5000, F.sha2("html", 256)).otherwise(F.sha2("url", 256))
    status = F.when(F.contains("url", F.lit(".com")), "failed").otherwise("processed")
    done = pages.select(
        F.col("url").alias("file_name"), changed.alias("file_hash"), status.alias("processing_status")
    )
    return ledger.unseen_files(files, done)


@query
def insert_if_absent(spark, folder):
    """Documents that the table of labels does not hold."""
    new = fixtures.table(spark, folder, "documents").select("doc_id", "lang", "source")
    return ledger.absent_rows(new, fixtures.table(spark, folder, "labels"), ["doc_id"])


def _customer_paths(spark, folder):
    customer, nation = (fixtures.table(spark, folder, name) for name in ("customer", "nation"))
    path = F.concat(
        F.lit("raw/"), F.lower("n_name"), F.lit("_"), F.lower("c_mktsegment"), F.lit("/batch_"), "c_custkey", F.lit(".csv")
    )
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", path.alias("path"))


def _nation_names(spark, folder, rank):
    nation = fixtures.table(spark, folder, "nation")
    return nation.select(F.col("n_name").alias("pattern"), F.col("n_name").alias("name"), rank.alias("rank"))


def _with_country(spark, folder, rank):
    found = reference.with_names_found(_customer_paths(spark, folder), "path", _nation_names(spark, folder, rank), "country")
    return found.select("c_custkey", F.coalesce("country", F.lit("unknown")).alias("country"))


@query
def match_country(spark, folder):
    """Nations looked up in paths, the longest name first."""
    return _with_country(spark, folder, F.struct(-F.length("n_name"), F.col("n_nationkey")))


@query
def match_country_list_order(spark, folder):
    return _with_country(spark, folder, F.col("n_nationkey"))


@query
def match_country_file_name(spark, folder):
    """Regions looked up in file names, whole or by their first two letters."""
    customer, nation, region = (fixtures.table(spark, folder, name) for name in ("customer", "nation", "region"))
    placed = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    files = placed.select("c_custkey", F.concat(F.lower("r_name"), F.lit("_"), F.lower("c_mktsegment")).alias("name"))
    patterns = region.select(
        F.explode(F.array("r_name", F.substring("r_name", 1, 2))).alias("pattern"),
        F.col("r_name").alias("name"),
        F.col("r_regionkey").alias("rank"),
    )
    found = reference.with_names_found(files, "name", patterns, "region_name", split=None)
    return found.select("c_custkey", "region_name")


@query
def file_fingerprint(spark, folder):
    return fixtures.table(spark, folder, "documents").select(
        "doc_id", F.sha2("text", 256).alias("file_hash"), F.md5("text").alias("file_md5")
    )


@query
def file_names(spark, folder):
    url = F.col("url")
    return fixtures.table(spark, folder, "pages").select(
        "page_id",
        expr.file_name(url).alias("file_name"),
        expr.normalized_file_name(url).alias("clean_name"),
        expr.file_extension(url).alias("extension"),
    )


@query
def extension_check(spark, folder):
    """URLs of pages as file paths: which extensions are refused."""
    pages = fixtures.table(spark, folder, "pages").select("page_id", F.col("url").alias("path"))
    return validation.with_extension_check(pages, (".html", ".htm", ""))


@query
def load_count_check(spark, folder):
    """Rows sent, each twice, against rows found after exact copies went."""
    feed = fixtures.survey_feed(spark, folder)
    sent = feed.unionByName(feed)
    return tables.count_check(sent, cleaning.clean_loaded_table(sent))


def _place_names(spark, folder):
    return [row.n_name for row in fixtures.table(spark, folder, "nation").select("n_name").toLocalIterator()]


@query
def ingest_round_trip(spark, folder):
    """Raw files in one folder per nation, ingested, landed, read back, cleaned and deduplicated."""
    place = f"{shared_folder(spark)}/round_trips/{uuid.uuid4()}"
    raw = fixtures.survey_raw(spark, folder).withColumn("nation", F.lower(F.trim("country")))
    raw.write.partitionBy("nation").option("header", True).csv(f"{place}/raw")
    lake = Lake.under(f"{place}/lake")
    ingest.ingest_files(spark, f"{place}/raw", lake, countries=_place_names(spark, folder), day=F.lit("2024-05-01"))
    landed = read_bronze(
        spark, bronze_datasets(lake)["survey_responses"].input_glob, "parquet", folder_parts=True
    )
    typed = catalog.BRONZE_SURVEY.conform(landed, keep_extra=True)
    cleaned = cleaning.clean_survey_responses(typed)
    return plain(dedup.dedup_survey_responses(cleaned)).drop("path_source_system")


# Lakes that the job queries built, by session and input.
_LAKES: dict[tuple[str, str], Lake] = {}


def _whole_run(spark, folder) -> Lake:
    """A lake after one run of all jobs.

    The responses arrive as files, every delivery of them (without the trust
    question) as a database table before, population and countries as service
    answers. The files are the latest load, so their rows survive.
    """
    known = (spark.sparkContext.applicationId, folder)
    if known not in _LAKES:
        place = f"{shared_folder(spark)}/lakes/{uuid.uuid4()}"
        raw = fixtures.survey_raw(spark, folder).withColumn("nation", F.lower(F.trim("country")))
        keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        raw.write.partitionBy("nation").csv(f"{place}/raw", header=True, **keep_blanks)
        lake = Lake.under(f"{place}/lake")
        records = F.to_json(F.collect_list(F.struct("indicator", "country", "countryiso3code", "date", "value", "unit", "obs_status", "decimal")))
        per_nation = fixtures.population_payload(spark, folder).groupBy(F.trim("countryiso3code").alias("nation"))
        answers = per_nation.agg(F.concat(F.lit('[{"page": 1}, '), records, F.lit("]")).alias("value"))
        answers.write.partitionBy("nation").text(f"{place}/answers/world_bank")
        listed = fixtures.countries_payload(spark, folder).agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
        listed.write.text(f"{place}/answers/restcountries")
        for source in API_SOURCES:
            ingest.ingest_payloads(spark, f"{place}/answers/{source}", lake, source, pattern="*.txt")
        feed = fixtures.survey_feed(spark, folder).drop("loaded_at", "delivery", "batch", "q3_trust_govt")
        end_to_end.run_all(
            spark, lake, f"{place}/raw", tables={"survey_responses": feed}, now=now(), countries=_place_names(spark, folder)
        )
        _LAKES[known] = lake
    return _LAKES[known]


@query
def silver_job(spark, folder):
    """The published clean responses."""
    return plain(spark.read.parquet(f"{_whole_run(spark, folder).silver}/survey_responses").drop("ingestion_timestamp"))


@query
def silver_increment(spark, folder):
    """The published clean responses after three deliveries, each merged into the countries it touches.

    First a table with every delivery of the responses, then the files of half
    of the nations, then the others'.
    """
    place = f"{shared_folder(spark)}/increments/{uuid.uuid4()}"
    lake = Lake.under(f"{place}/lake")
    raw = fixtures.survey_raw(spark, folder).withColumn("nation", F.lower(F.trim("country")))
    writers.write_silver(population_silver(spark, folder), f"{lake.silver}/world_bank_population")
    feed = fixtures.survey_feed(spark, folder).drop("loaded_at", "delivery", "batch", "q3_trust_govt")
    ingest.ingest_table(spark, feed, lake, "survey_responses")
    increment.update_silver(spark, lake, now(), with_database=True)
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for half in (0, 1):
        some = raw.filter(F.pmod(F.length("nation"), F.lit(2)) == half)
        some.write.partitionBy("nation").csv(f"{place}/raw{half}", header=True, **keep_blanks)
        ingest.ingest_files(spark, f"{place}/raw{half}", lake, countries=_place_names(spark, folder))
        increment.update_silver(spark, lake, now(), with_database=True)
    return plain(spark.read.parquet(f"{lake.silver}/survey_responses").drop("ingestion_timestamp"))


def _gold_after_deliveries(spark, folder, name):
    """A business table off grouped rows that three deliveries of clean responses kept up."""
    lake = Lake.under(f"{shared_folder(spark)}/increments/{uuid.uuid4()}")
    rows = silver(spark, folder).drop("source_layer", "target_layer")
    table = increment.merged_table(spark, lake, rows.withColumn(dedup.COPIES, F.lit(1).cast("bigint")).schema)
    turn = F.pmod(F.col("response_id").cast("bigint"), F.lit(3))
    for delivery in range(3):
        # What came before comes again, in part.
        some = rows.filter((turn == delivery) | ((turn < delivery) & F.col("q1_democracy").isNull()))
        increment.merge_delivery(table, some, f"delivery{delivery}", check=False)
        increment.write_facts(spark, lake, table)
    facts = {
        fact: increment.fact_table(spark, lake, fact, rows).read().drop(increment.PART) for fact in increment.FACTS
    }
    tables = {"world_bank_population": population_silver(spark, folder), "country_reference": countries_silver(spark, folder), "survey_responses": rows}
    built = gold_plan.gold_tables(tables, facts["rollup"], quality.whole_profile(facts["profile"]), now(), {c: facts[c] for c in gold_plan.COUNTS})
    return plain(built[name]())


@query
def gold_increment_kpis(spark, folder):
    return _gold_after_deliveries(spark, folder, "country_survey_kpis_gold")


@query
def gold_increment_trends(spark, folder):
    return _gold_after_deliveries(spark, folder, "response_volume_trends_gold")


@query
def gold_increment_quality(spark, folder):
    return _gold_after_deliveries(spark, folder, "data_quality_summary_gold")


@query
def table_fingerprints(spark, folder):
    """Fingerprints of the responses, of them in another layout, and of tables in which values have moved to the next column."""
    rows = fixtures.survey_raw(spark, folder).select("response_id", "gender", "completion_status", "q1_democracy")
    moved = rows.withColumns(
        {
            "gender": F.coalesce("gender", F.col("completion_status")),
            "completion_status": F.when(F.col("gender").isNotNull(), F.col("completion_status")),
        }
    )
    swapped = rows.select("response_id", F.col("completion_status").alias("gender"), F.col("gender").alias("completion_status"), "q1_democracy")
    known = ledger.row_fingerprint(rows).select(F.col("file_hash").alias("known"))
    variants = {
        "again": rows,
        "other layout": rows.repartition(5, "gender").sortWithinPartitions(F.desc("response_id")),
        "moved": moved,
        "swapped": swapped,
        "one null more": rows.withColumn("q1_democracy", F.when(F.col("response_id") != "1", F.col("q1_democracy"))),
        "twice": rows.unionByName(rows),
    }
    marks = [ledger.row_fingerprint(df).select(F.lit(name).alias("variant"), "rows", "file_hash") for name, df in variants.items()]
    return readers.union_all(marks).select("variant", "rows", (F.col("file_hash") == known.scalar()).alias("same"))


@query
def silver_rejects(spark, folder):
    """Raw rows of files and table that break the contract, counted per response."""
    rejects = bookkeeping.rejected_rows(spark, _whole_run(spark, folder), "survey_responses")
    return rejects.groupBy("response_id", F.concat_ws(",", ERRORS).alias("errors")).agg(F.count(F.lit(1)).alias("n"))


@query
def silver_quality(spark, folder):
    """Quality per country as the run recorded it, with the true duplicate rate."""
    metrics = bookkeeping.data_quality_metrics(spark, _whole_run(spark, folder)).drop("metric_id", "run_id", "created_at")
    return metrics.withColumn("failed_checks", F.concat_ws(",", "failed_checks"))


def _published(spark, folder, name):
    return plain(readers.read_gold(spark, _whole_run(spark, folder).gold, name))


@query
def gold_job_kpis(spark, folder):
    return _published(spark, folder, "country_survey_kpis_gold")


@query
def gold_job_trends(spark, folder):
    return _published(spark, folder, "response_volume_trends_gold")


@query
def gold_job_corruption_levels(spark, folder):
    return _published(spark, folder, "corruption_levels_gold")


@query
def gold_job_quality(spark, folder):
    return _published(spark, folder, "data_quality_summary_gold")


@query
def gold_job_keys(spark, folder):
    """How far the published tables keep their primary keys."""
    return bookkeeping.key_checks(spark, _whole_run(spark, folder)).drop("run_id")


@query
def job_sources(spark, folder):
    """Rows that each source loaded, from the ledger of files."""
    book = bookkeeping.processed_files(spark, _whole_run(spark, folder))
    return book.groupBy("source_system").agg(F.sum("rows_loaded").alias("rows_loaded"))


@query
def silver_population(spark, folder):
    """The published population table, from service answers."""
    return spark.read.parquet(f"{_whole_run(spark, folder).silver}/world_bank_population").select(
        "country", "country_code", "year", "population", "indicator"
    )


@query
def dedup_population(spark, folder):
    """Every population row three times: the one with a known population stays."""
    rows = population_silver(spark, folder)
    unknown = rows.withColumn("population", F.lit(None).cast("bigint"))
    return dedup.dedup_world_bank_population(unknown.unionByName(rows).unionByName(rows))


@query
def dedup_countries(spark, folder):
    """Countries twice, once in capitals and without people: one row per name in any case."""
    rows = countries_silver(spark, folder)
    other = rows.withColumn("country_name", F.upper("country_name")).withColumn("population", F.lit(None).cast("bigint"))
    return dedup.dedup_country_reference(other.unionByName(rows))


@query
def drop_key_copies(spark, folder):
    """One line item per order, the largest over all columns."""
    rows = fixtures.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return dedup.drop_key_copies(rows, ["l_orderkey"])


@query
def csv_records(spark, folder):
    """Texts with line ends, quotes and commas, written as CSV files and read back."""
    place = f"{shared_folder(spark)}/round_trips/{uuid.uuid4()}"
    fixtures.table(spark, folder, "documents").select("doc_id", "text").write.csv(place, header=True, escape='"')
    paths = readers.file_paths(list_files(spark, place))
    return csv_files.read_csv_files(spark, paths, Contract.of("texts", {"doc_id": "long", "text": "string"}))


@query
def file_hashes(spark, folder):
    """Texts of a source, a thousand ids a file, written twice and in another order: which files hash alike."""
    place = f"{shared_folder(spark)}/round_trips/{uuid.uuid4()}"
    # One folder per file and all below one: folders in folders are listed by a job for each inner one.
    where = F.concat_ws("_", "copy", F.coalesce(F.expr("string(doc_id DIV 1000)"), F.lit("")), F.coalesce("source", F.lit("none")))
    docs = fixtures.table(spark, folder, "documents").select("doc_id", "source", F.to_json(F.struct("text")).alias("line"))
    copies = docs.withColumn("copy", F.explode(F.array(*map(F.lit, ("one", "same", "turned")))))
    order = F.when(F.col("copy") == "turned", -F.col("doc_id")).otherwise(F.col("doc_id"))
    dealt = copies.select(F.coalesce(where, F.lit("")).alias("place"), order.alias("order"), "line")
    # What a task does is counted in files, not bytes, so their number is given.
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "place")
    sorted_ = dealt.sortWithinPartitions("place", "order", "line").drop("order")
    sorted_.write.partitionBy("place").text(place)
    paths = readers.file_paths(list_files(spark, place, "*.txt"))
    part = lambda k: F.regexp_extract("uri", "/place=([a-z]*)_(-?[0-9]*)_([^/]*)/", k)
    found = readers.file_hashes(spark, paths).select(
        part(1).alias("copy"), part(3).alias("source"), part(2).try_cast("bigint").alias("block"), "file_hash"
    )
    hash_of = lambda name: F.max(F.when(F.col("copy") == name, F.col("file_hash")))
    return found.groupBy("source", "block").agg(
        F.count(F.lit(1)).alias("files"),
        (hash_of("one") == hash_of("same")).alias("copy_alike"),
        (hash_of("one") == hash_of("turned")).alias("turned_alike"),
    )


@query
def file_outcomes(spark, folder):
    """Raw files, one per nation: every third nation's lack a column, every third's are of another kind."""
    place = f"{shared_folder(spark)}/round_trips/{uuid.uuid4()}"
    raw = fixtures.survey_raw(spark, folder).withColumn("nation", F.coalesce(F.lower(F.trim("country")), F.lit("none")))
    third = F.pmod(F.length("nation") + F.ascii(F.reverse("nation")), F.lit(3))
    whole, lacking, other = (raw.filter(third == k).repartition("nation") for k in range(3))
    whole.write.partitionBy("nation").csv(f"{place}/raw/whole", header=True)
    lacking.drop("gender", "survey_id").write.partitionBy("nation").csv(f"{place}/raw/lacking", header=True)
    other.select("nation", F.to_json(F.struct("response_id")).alias("value")).write.partitionBy("nation").text(f"{place}/raw/other")
    files = ingest.check_files(spark, f"{place}/raw", Lake.under(f"{place}/lake"), countries=_place_names(spark, folder))
    return files.select(F.regexp_extract("uri", "/nation=([^/]*)/", 1).alias("nation"), "status", "reason", "rows_loaded")


@query
def table_outcomes(spark, folder):
    """The responses as a database table: taken once, known again in another layout, refused without columns or rows."""
    lake = Lake.under(f"{shared_folder(spark)}/round_trips/{uuid.uuid4()}")
    raw = fixtures.survey_raw(spark, folder)
    attempts = {
        "first": raw,
        "again": raw.repartition(5, "gender"),
        "lacking": raw.drop("gender", "survey_id"),
        "empty": raw.filter("false"),
        "changed": raw.withColumn("q2_economy", F.upper("q2_economy")),
    }
    for name, rows in attempts.items():
        ingest.ingest_table(spark, rows, lake, "survey_responses", run_id=name)
    runs = bookkeeping.pipeline_runs(spark, lake)
    return runs.select(F.col("run_id").alias("attempt"), "status", "rows_processed", "error_message")


@query
def snapshot_round_trip(spark, folder):
    """An extracted table under a time-stamped name."""
    raw = fixtures.survey_raw(spark, folder)
    path = writers.write_snapshot(raw, f"{shared_folder(spark)}/round_trips/{uuid.uuid4()}", "survey_responses", "20240501")
    return plain(spark.read.parquet(path))


@query
def kept_answers(spark, folder):
    """Population rows out of the answers kept for audit, and whether each answer still has its hash."""
    place = f"{shared_folder(spark)}/round_trips/{uuid.uuid4()}"
    lake = Lake.under(f"{place}/lake")
    records = F.to_json(F.collect_list(F.struct("indicator", "country", "countryiso3code", "date", "value")))
    per_nation = fixtures.population_payload(spark, folder).groupBy(F.trim("countryiso3code").alias("nation"))
    answers = per_nation.agg(F.concat(F.lit('[{"page": 1}, '), records, F.lit("]")).alias("value"))
    answers.write.partitionBy("nation").text(f"{place}/answers")
    ingest.ingest_payloads(spark, f"{place}/answers", lake, "world_bank", pattern="*.txt")
    kept = spark.read.text(f"{lake.meta}/answers/world_bank/*").select(F.from_json("value", "file_hash string, value string").alias("a"))
    shaped = payloads.shaped(kept.select("a.*"), "world_bank").withColumn("same", F.sha2("value", 256) == F.col("file_hash"))
    rows = shaped.select("same", F.explode("records").alias("r"))
    return rows.select(
        F.upper(F.trim("r.countryiso3code")).alias("country_code"), F.col("r.date").cast("int").alias("year"), F.col("r.value").alias("population"), "same"
    )


@query
def marked_trust(spark, folder):
    """A business table with its layer names and load time."""
    table = rollups.governance_trust(silver(spark, folder), processed_at=now())
    return table.withColumn("gold_processed_at", F.col("gold_processed_at").cast("timestamp_ntz"))


@query
def silver_views(spark, folder):
    """The published clean tables as views, joined in SQL."""
    place = f"{shared_folder(spark)}/round_trips/{uuid.uuid4()}"
    tables = {"survey_responses": silver, "country_reference": countries_silver, "world_bank_population": population_silver}
    for name, build in tables.items():
        writers.write_silver(build(spark, folder), f"{place}/{name}")
    readers.read_silver(spark, place, views=True)
    return spark.sql(
        "SELECT s.country, s.responses, c.population AS listed, p.years FROM (SELECT country, count(*) AS responses FROM survey_responses GROUP BY country) s "
        "LEFT JOIN country_reference c ON lower(s.country) = lower(c.country_name) "
        "LEFT JOIN (SELECT country, count(*) AS years FROM world_bank_population GROUP BY country) p ON s.country = p.country"
    )


@query
def bronze_layout(spark, folder):
    """Rows per raw folder: country, year, month, day and source."""
    landed = writers.with_bronze_parts(fixtures.survey_raw(spark, folder), day=F.col("submission_timestamp"))
    return landed.groupBy(
        F.col("path_country").alias("country"), "year", "month", "day", F.col("path_source").alias("source_system")
    ).agg(F.count(F.lit(1)).alias("rows_landed"))


@query
def normalise_world_bank(spark, folder):
    """Service answers as text, one per nation, parsed back into rows."""
    rows = fixtures.population(spark, folder).select(
        "country_code",
        F.struct(
            F.struct(F.lit("POP").alias("id"), F.col("indicator").alias("value")).alias("indicator"),
            F.struct(F.col("country_code").alias("id"), F.concat(F.lit(" "), F.lower("country")).alias("value")).alias("country"),
            F.col("country_code").alias("countryiso3code"),
            F.col("year").cast("string").alias("date"),
            F.col("population").alias("value"),
        ).alias("record"),
    )
    answers = rows.groupBy("country_code").agg(
        F.concat(F.lit('[{"page": 1}, '), F.to_json(F.collect_list("record")), F.lit("]")).alias("value")
    )
    refused = answers.select(F.lit('[{"message": [{"id": "120", "key": "Invalid value", "value": "bad"}]}]').alias("value"))
    parsed = payloads.world_bank_records(answers.select("value").unionByName(refused))
    return payloads.normalize_world_bank(parsed).drop("ingestion_timestamp")


@query
def answer_drift(spark, folder):
    """Service answers, one per nation; those of three nations in four lost or renamed a field."""
    drift = F.pmod(F.expr("CAST(substr(code, 2) AS INT)"), F.lit(4))
    named = F.struct(F.col("country.id").alias("id"), F.when(drift != 3, F.col("country.value")).alias("value"))
    rows = fixtures.population_payload(spark, folder).withColumn("code", F.upper(F.trim("countryiso3code")))
    record = F.struct(
        "indicator",
        named.alias("country"),
        F.when(drift != 2, F.col("countryiso3code")).alias("countryiso3code"),
        F.when(drift != 1, F.col("date")).alias("date"),
        F.when(drift != 3, F.col("value")).alias("value"),
        F.when(drift == 3, F.col("value")).alias("amount"),
    )
    text = F.concat(F.lit('[{"page": 1}, '), F.to_json(F.collect_list(record)), F.lit("]"))
    shaped = payloads.shaped(rows.groupBy("code").agg(text.alias("value")), "world_bank")
    return shaped.select(F.col("code").alias("country_code"), "reject_reason", F.size("records").cast("bigint").alias("records"))


@query
def normalise_countries(spark, folder):
    raw = fixtures.countries_payload(spark, folder)
    return payloads.normalize_countries(raw).drop("ingestion_timestamp")


@query
def event_payloads(spark, folder):
    events = fixtures.table(spark, folder, "events")
    return events.select("event_id", "user_id", F.from_json("props", "k bigint").alias("p")).select(
        "event_id", "user_id", "p.k"
    )


def _run_state():
    states = {"signup": "running", "purchase": "success", "error": "failed", "view": "skipped"}
    return expr.mapped(F.col("event_type"), states, "other")


@query
def run_ledger_latest(spark, folder):
    events = fixtures.table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("event_no"),
        _run_state().alias("status"),
        F.floor("value").alias("rows_processed"),
    )
    return plain(ledger.current_runs(events)).drop("rows_failed", "validation_pass_rate", "error_message")


@query
def event_levels(spark, folder):
    events = fixtures.table(spark, folder, "events").select("event_id", _run_state().alias("status"))
    return events.withColumns(
        {"log_level": ledger.log_level(F.col("status")), "valid_status": ledger.valid_status(F.col("status"))}
    )


@query
def incremental_state(spark, folder):
    loads = fixtures.table(spark, folder, "events").select(
        "event_type",
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("ingestion_timestamp"),
        F.col("event_id").cast("string").alias("batch_id"),
        F.floor("value").alias("rows_loaded"),
        F.when(F.col("event_type") == "error", "failed").otherwise("processed").alias("processing_status"),
    )
    return ledger.incremental_state(loads, ["event_type", "user_id"])


@query
def incremental_new_rows(spark, folder):
    events = fixtures.table(spark, folder, "events")
    landed = events.filter("event_type = 'purchase'")
    state = landed.groupBy(F.col("user_id").alias("source_key")).agg(F.max("ts").alias("last_ingestion_ts"))
    return ledger.newer_rows(events, state, "ts", landed, ["event_id"], source="user_id").select("event_id")


# Streaming


def _stream(spark, folder, name):
    """A given table as a stream of files."""
    schema = fixtures.table(spark, folder, name).schema
    return responses.read_stream(spark, folder, schema, "parquet", pattern=f"{name}.parquet")


def _finished(spark, stream):
    """Run a stream over everything there is and read what it appended."""
    place = f"{shared_folder(spark)}/streams/{uuid.uuid4()}"
    responses.append_available(stream, f"{place}/out", f"{place}/state")
    return spark.read.parquet(f"{place}/out")


def _raw_stream(spark, folder):
    static = {name: fixtures.table(spark, folder, name) for name in ("customer", "nation")}
    return spark.sql(fixtures.SURVEY_RAW, orders=_stream(spark, folder, "orders"), **static)


@query
def stream_ingest(spark, folder):
    """Three deliveries, the newest responses first; the later ones repeat some and are years older."""
    place = f"{shared_folder(spark)}/streams/{uuid.uuid4()}"
    raw = fixtures.survey_raw(spark, folder)
    year = F.year(F.col("submission_timestamp").cast("timestamp"))
    for some in (year >= 1997, year.between(1995, 1997), year.isNull() | (year < 1996)):
        raw.filter(some).write.mode("append").parquet(f"{place}/raw")
        responses.ingest_responses(spark, f"{place}/raw", raw.schema, f"{place}/out", f"{place}/state", "parquet")
    return plain(spark.read.parquet(f"{place}/out").drop("silver_processed_at", responses.LOAD))


@query
def stream_dedup(spark, folder):
    """Deliveries arrive as a stream; every response comes out once."""
    feed = spark.sql(
        fixtures.SURVEY_FEED, raw=fixtures.survey_raw(spark, folder), lineitem=_stream(spark, folder, "lineitem")
    )
    unique = responses.unique_responses(responses.clean_stream(feed))
    return plain(_finished(spark, unique.select("response_id", "submission_timestamp", "country")))


@query
def stream_daily_upkeep(spark, folder):
    """Daily counts kept over three deliveries; each brings rows of all days, so the later ones correct what stands."""
    place = f"{shared_folder(spark)}/streams/{uuid.uuid4()}"
    raw = fixtures.survey_raw(spark, folder)
    for delivery in range(3):
        raw.filter(F.expr(f"pmod(xxhash64(response_id), 3) = {delivery}")).write.mode("append").parquet(f"{place}/raw")
        stream = responses.clean_stream(responses.read_stream(spark, f"{place}/raw", raw.schema, "parquet"))
        responses.keep_daily_volume(stream, f"{place}/daily", f"{place}/state")
    return responses.kept_daily_volume(spark, f"{place}/daily")


@query
def stream_daily_volume(spark, folder):
    """Days that the watermark has closed."""
    cleaned = responses.clean_stream(_raw_stream(spark, folder))
    return _finished(spark, responses.daily_volume(cleaned))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
