"""Clean and business tables kept up to date: a run reads the new raw files and rewrites the countries they touch.

The merged responses, one row for each with the number of its copies, and the
grouped rows of the business tables are parted by country
(:mod:`pollstone.plans.parted`). A delivery touches the countries of its rows
and those in which an earlier copy of one of its responses stands; only these
are read whole, merged, checked, grouped again and published. What comes out
equals a full run over all deliveries.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollstone.contracts.catalog import BRONZE_SURVEY
from pollstone.contracts.model import ERRORS
from pollstone.operators import quality, rollups
from pollstone.operators.cleaning import clean_dataset
from pollstone.operators.dedup import COPIES, merge_merged_responses, merge_survey_responses
from pollstone.operators.reference import standardize_country_names, with_country_codes, with_row_checks
from pollstone.operators.validation import require_valid
from pollstone.plans.bookkeeping import append, read_book, record_quality
from pollstone.plans.gold import COUNTS, gold_tables, write_tables
from pollstone.plans.parted import PART, PartedTable, part_of
from pollstone.plans.silver import SurveyChoices, staged
from pollstone.sources.readers import list_files, read_bronze, read_silver
from pollstone.sources.registry import Lake
from pollstone.sources.writers import default_partitions, write_silver

SURVEY = "survey_responses"
#: Grouped rows of the business tables, each with its country.
FACTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "rollup": rollups.place_rollup,
    "profile": lambda survey: quality.response_profile(survey, ["country"]),
    **COUNTS,
}
PUBLISHED_SCHEMA = "seq bigint"


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def merged_table(spark: SparkSession, lake: Lake, schema: T.StructType) -> PartedTable:
    """The merged responses; ``schema`` is that of the clean rows with their copies."""
    return PartedTable(spark, f"{lake.meta}/increment/{SURVEY}", nullable(schema), ("country",))


def merge_delivery(table: PartedTable, cleaned: DataFrame, run_id: str, inputs: Sequence[str] = (), check: bool = True) -> list[str]:
    """Merge a delivery of clean rows into the table; returns the parts it touched.

    Only ``response_id`` is read of parts the delivery doesn't touch. The rules
    are checked on the touched countries as they stand after merging. A run
    that is committed already changes nothing, and neither does one that a
    rule refuses. A response that moves to another country leaves the old one.
    """
    if table.has(run_id):
        return [row.part for row in table.newest().where(F.col("run_id") == run_id).toLocalIterator()]
    place = f"{table.root}_staging/{run_id}"
    fresh = staged(merge_survey_responses(cleaned), place).withColumn(PART, part_of("country"))
    standing = table.read().select(F.col("response_id").alias("_standing"), PART)
    same = standing["_standing"].eqNullSafe(fresh["response_id"])
    earlier = standing.join(fresh.select("response_id"), same, "left_semi").select(PART)
    touched = [row.part for row in fresh.select(PART).union(earlier).distinct().toLocalIterator()]
    columns = table.schema.names
    merged = fresh.select(*columns)
    if not table.newest().where((F.col("rows") > 0) & F.col("part").isin(touched)).isEmpty():
        merged = merge_merged_responses(table.read(touched).select(*columns).unionByName(merged)).select(*columns)
    written = table.write(merged, run_id)
    if check:
        require_valid(written.drop(PART, COPIES), SURVEY)
    counts = {row.part: row.n for row in written.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    table.commit(run_id, {**dict.fromkeys(touched, 0), **counts}, inputs)
    return touched


def new_raw_files(spark: SparkSession, lake: Lake, table_inputs: DataFrame, sources: Sequence[str] = ("csv",)) -> list[str]:
    """Raw response files that no committed run has read, by listing only."""
    listed = list_files(spark, lake.bronze, "*.parquet")
    wanted = listed.where(F.regexp_extract("uri", "/source_system=([^/]+)/", 1).isin(*sources)).select(F.col("uri").alias("input"))
    return [row.input for row in wanted.join(table_inputs, "input", "left_anti").toLocalIterator()]


def survey_table(spark: SparkSession, lake: Lake) -> PartedTable:
    """The merged responses of raw files: clean contract columns, load time and copies."""
    raw = nullable(BRONZE_SURVEY.schema()).add("ingestion_timestamp", T.TimestampType())
    cleaned = clean_dataset(spark.createDataFrame([], raw), SURVEY)
    return merged_table(spark, lake, cleaned.withColumn(COPIES, F.lit(1).cast("bigint")).schema)


def update_silver(
    spark: SparkSession,
    lake: Lake,
    processed_at: Column | None = None,
    with_database: bool = False,
    choices: SurveyChoices = SurveyChoices(),
    run_id: str | None = None,
) -> list[str]:
    """Take in the raw responses landed since the last run and publish the countries they touch; returns the touched parts.

    Rejects, cleaning, rules and columns are those of a full run
    (:func:`pollstone.plans.silver.build_survey`), without columns that the
    contract doesn't have. A new alias or population table reaches the other
    countries with the next full run. What a broken run had merged but not
    grouped or published is made up for, new files or not.
    """
    run = run_id or str(uuid.uuid4())
    table = survey_table(spark, lake)
    sources = ("csv", "postgres_operational") if with_database else ("csv",)
    files = new_raw_files(spark, lake, table.inputs(), sources)
    touched: list[str] = []
    if files:
        raw = BRONZE_SURVEY.with_errors(read_bronze(spark, files, "parquet", BRONZE_SURVEY, file_time=True), keep_extra=True)
        checked = staged(raw, f"{lake.meta}/staging/{SURVEY}_raw_{run}")
        broken = F.size(ERRORS) > 0
        checked.filter(broken).write.mode("overwrite").parquet(f"{lake.meta}/rejects/{SURVEY}/run_id={run}")
        fit = checked.filter(~broken) if choices.hold_back else checked
        cleaned = clean_dataset(fit.select(*BRONZE_SURVEY.columns, "ingestion_timestamp"), SURVEY, processed_at)
        if choices.aliases is not None:
            cleaned = standardize_country_names(cleaned, choices.aliases)
        touched = merge_delivery(table, cleaned, run, files)
        record_quality(spark, lake, run, table.read(touched).drop(PART))
    write_facts(spark, lake, table, choices)
    publish(spark, lake, table, choices)
    return touched


def publish(spark: SparkSession, lake: Lake, table: PartedTable, choices: SurveyChoices = SurveyChoices()) -> int:
    """Write the countries of commits that aren't published yet to the clean table; returns how many rows.

    A part's files hold one country, so nothing is shuffled for the write. A
    broken run is made up for by the next. If a country has lost its last
    row, its folder must go, so the table is written whole.
    """
    book = f"{lake.meta}/increment/{SURVEY}_published"
    done = read_book(spark, book, PUBLISHED_SCHEMA).agg(F.max("seq")).first()[0] or 0
    newest = table.newest().where(F.col("seq") > done).collect()  # one row for each country touched
    if not newest:
        return 0
    whole = done == 0 or any(row.rows == 0 for row in newest)
    rows = table.read(None if whole else [row.part for row in newest]).drop(PART)
    codes = read_book(spark, f"{lake.silver}/world_bank_population", "country string, country_code string")
    declared = with_country_codes(with_row_checks(rows), codes)
    published = declared if choices.publish_copies else declared.drop(COPIES)
    path = f"{lake.silver}/{SURVEY}"
    columns = default_partitions(published)
    if whole:
        written = write_silver(published, path, columns, spread=False)
    else:
        written = sum(row.rows for row in newest)
        writer = published.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*columns).parquet(path)
    append(spark.createDataFrame([(max(row.seq for row in newest),)], PUBLISHED_SCHEMA).coalesce(1), book)
    return written


def fact_table(spark: SparkSession, lake: Lake, name: str, like: DataFrame) -> PartedTable:
    """One of the grouped tables; ``like`` has the columns of the responses."""
    facts = f"{lake.meta}/increment/facts"
    return PartedTable(spark, f"{facts}_{name}", nullable(FACTS[name](like).schema), ("country",), f"{facts}_commits")


def write_facts(spark: SparkSession, lake: Lake, table: PartedTable, choices: SurveyChoices = SurveyChoices()) -> None:
    """Group the countries that changed since they were grouped last; the others' grouped rows stay as they are."""
    empty = spark.createDataFrame([], table.schema)
    like = empty if choices.publish_copies else empty.drop(COPIES)
    tables = {name: fact_table(spark, lake, name, like) for name in FACTS}
    log = tables["profile"]
    done = log.inputs().agg(F.max(F.col("input").cast("bigint"))).first()[0] or 0
    changed = table.newest().where(F.col("seq") > done).collect()  # one row for each country touched
    if not changed:
        return
    seq, parts = max(row.seq for row in changed), [row.part for row in changed]
    rows = table.read(parts).select(*like.columns)
    run = f"{seq}-{uuid.uuid4()}"
    for name, group in FACTS.items():
        tables[name].write(group(rows), run)
    log.commit(run, dict.fromkeys(parts), [str(seq)])


def update_gold(spark: SparkSession, lake: Lake, now: Column | None = None, run_id: str | None = None) -> dict[str, int]:
    """Write the business tables off the grouped rows; no response is read."""
    tables = read_silver(spark, lake.silver)
    facts = {name: fact_table(spark, lake, name, tables[SURVEY]).read().drop(PART) for name in FACTS}
    built = gold_tables(tables, facts["rollup"], quality.whole_profile(facts["profile"]), now, {name: facts[name] for name in COUNTS})
    return write_tables(spark, lake, built, run_id or str(uuid.uuid4()))
