from datetime import datetime

from conftest import plan, rows
from pyspark.sql import functions as F

from pollstone.contracts.catalog import SILVER_SURVEY
from pollstone.operators import ledger, reference


def test_latest_population_ignores_case_and_nulls(spark):
    df = spark.createDataFrame(
        [("Mali", 2020, 5), ("MALI", 2021, 6), ("mali", 2022, None)], "country string, year int, population bigint"
    )
    assert rows(reference.latest_population(df)) == [("mali", 2021, 6)]


def test_country_in_path(spark):
    df = spark.createDataFrame(
        [("data/raw/nigeria/x.csv",), ("data/NIGER/nigeria.csv",), ("a/b.csv",), ("mali/ghana.csv",)], "p string"
    )
    path = F.col("p")
    longest = [r[0] for r in df.select(reference.country_in_path(path)).collect()]
    listed = [r[0] for r in df.select(reference.country_in_path(path, longest=False)).collect()]
    assert longest == ["Nigeria", "Niger", "unknown", "Mali"]
    assert listed == ["Niger", "Niger", "unknown", "Mali"]


def test_country_in_file_name(spark):
    df = spark.createDataFrame([("survey_gh_2026.csv",), ("zzz.csv",)], "n string")
    assert [r[0] for r in df.select(reference.country_in_file_name(F.col("n"))).collect()] == ["Ghana", None]


def test_aliases(spark):
    df = spark.createDataFrame([("Ivory Coast",), ("Mali",), (None,)], "country string")
    aliases = {"ivory coast": "Côte d'Ivoire"}
    table = spark.createDataFrame(list(aliases.items()), "alias string, country_name string")
    expected = sorted([("Côte d'Ivoire",), ("Mali",), (None,)], key=str)
    assert rows(reference.standardize_country_names(df, aliases)) == expected
    assert rows(reference.standardize_country_names(df, table)) == expected
    assert reference.standardize_country_names(df, {}) is df


def test_row_checks(spark):
    df = spark.createDataFrame(
        [("1", "A", "x", 20, 1, datetime(2024, 1, 1)), ("2", None, "x", 20, 3, datetime(2024, 1, 1))],
        "response_id string, country string, gender string, age int, copies bigint, submission_timestamp timestamp",
    )
    out = rows(reference.with_row_checks(df).select("response_id", "duplicate_flag", "validation_status", "age_group"))
    assert out == [("1", False, "valid", "18-24"), ("2", True, "invalid", "18-24")]


def test_unseen_files_need_name_and_hash(spark):
    files = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "file_name string, file_hash string")
    done = spark.createDataFrame(
        [("a", "1", "processed"), ("b", "9", "processed"), ("c", "3", "failed")],
        "file_name string, file_hash string, processing_status string",
    )
    assert rows(ledger.unseen_files(files, done)) == [("b", "2"), ("c", "3")]


def test_insert_if_absent(spark):
    new = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "file_name string, v int")
    old = spark.createDataFrame([("a",)], "file_name string")
    assert rows(ledger.absent_rows(new, old)) == [("b", 2)]


def test_run_states(spark):
    t = lambda s: datetime(2024, 1, 1, 0, 0, s)
    events = spark.createDataFrame(
        [("r1", t(0), 0, "running", 0), ("r1", t(5), 1, "success", 7), ("r2", t(1), 0, "running", 0)],
        "run_id string, event_time timestamp, event_no int, status string, rows_processed bigint",
    )
    out = {r.run_id: r for r in ledger.current_runs(events).collect()}
    assert (out["r1"].status, out["r1"].duration_seconds, out["r1"].rows_processed) == ("success", 5.0, 7)
    assert (out["r2"].status, out["r2"].end_time, out["r2"].duration_seconds) == ("running", None, None)
    later = ledger.current_runs(events, now=F.lit(t(30))).filter("run_id = 'r1'").first()
    assert later.duration_seconds == 30.0
    levels = spark.createDataFrame([("success",), ("skipped",), ("failed",), ("odd",)], "s string")
    assert [r[0] for r in levels.select(ledger.log_level(F.col("s"))).collect()] == ["info", "warning", "error", "info"]


def test_incremental_state(spark):
    t = lambda d: datetime(2024, 1, d)
    book = spark.createDataFrame(
        [("csv", t(1), "b1", 5, "processed"), ("csv", t(3), "b2", 6, "processed"), ("csv", t(9), "b3", 9, "failed")],
        "source_system string, ingestion_timestamp timestamp, batch_id string, rows_loaded bigint, processing_status string",
    )
    state = ledger.incremental_state(book)
    assert rows(state) == [("csv", t(3).date(), t(3), "b2", 11)]
    new = spark.createDataFrame(
        [(1, "csv", t(2)), (2, "csv", t(3)), (3, "csv", t(3)), (4, "csv", t(4)), (5, "api", t(1))],
        "id int, source_key string, ts timestamp",
    )
    newer = ledger.newer_rows(new, state, "ts", landed=new.filter("id = 2"), keys=["id"])
    assert sorted(r.id for r in newer.collect()) == [3, 4, 5]


def test_fingerprint_ignores_layout_but_not_content(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    one = ledger.row_fingerprint(df.repartition(1)).first()
    assert ledger.row_fingerprint(df.repartition(9, "v").orderBy(F.desc("id"))).first() == one
    assert ledger.row_fingerprint(df.withColumn("v", F.col("v") + 1)).first() != one
    assert ledger.row_fingerprint(df.union(df)).first() != one


def test_declared_survey_matches_its_contract(spark, folder):
    from acceptance.queries import population_silver, silver

    out = reference.declared_survey(silver(spark, folder), population_silver(spark, folder))
    assert out.columns == SILVER_SURVEY.columns
    assert out.filter("country_code IS NOT NULL AND age_group IS NOT NULL").count() > 0
    row = out.first()
    assert row.ingestion_timestamp == row.submission_timestamp and row.duplicate_flag is False


def test_names_found_in_texts(spark):
    names = spark.createDataFrame(
        [("niger", "Niger", 2), ("NIGERIA", "Nigeria", 1), ("mali", "Mali", 3), (" ", "Blank", 0), ("mali", "Also", 3), (None, "None", 0)],
        "pattern string, name string, rank int",
    )
    texts = ["raw/nigeria/x.csv", "raw/Niger_1/mali.csv", "a/mali.csv", "a/b", "", None, "a/b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, path string")
    found = reference.with_names_found(df, "path", names, "country")
    assert found.columns == ["i", "path", "country"]
    assert [r.country for r in found.orderBy("i").collect()] == ["Nigeria", "Niger", "Also", None, None, None, None]
    assert [r.country for r in reference.with_names_found(df, "path", names.limit(0), "country").collect()] == [None] * 7
    text = plan(found)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
