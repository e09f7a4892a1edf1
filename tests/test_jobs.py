import json
import os
import re
from datetime import datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acceptance.queries import countries_silver, population_silver, silver
from pollstone import __main__, fixtures
from pollstone.contracts.catalog import BRONZE, BRONZE_SURVEY, GOLD
from pollstone.operators import rollups
from pollstone.operators.validation import ValidationError
from pollstone.plans import bookkeeping, end_to_end, gold, ingest
from pollstone.plans import silver as silver_plan
from pollstone.sources import payloads, readers
from pollstone.sources.registry import Lake
from pollstone.sources.writers import write_silver
from pollstone.streaming import responses
from pollstone.streaming.held_keys import HeldKeys

HEADER = ",".join(BRONZE_SURVEY.columns)


def line(key, country="Mali", age="30.0", status="completed"):
    return f"{key},p{key},survey_1,{country},Town,Male,{age},Primary,Employed,{status},2024-05-01T10:00:00,field_tool,1,Good,3,High,5"


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    (root / "mali").mkdir(parents=True)
    (root / "nigeria").mkdir()
    (root / "mali" / "a.csv").write_text("\n".join([HEADER, line(1), line(2, age=""), line(2, age="")]) + "\n")
    (root / "nigeria" / "b.csv").write_text("\n".join([HEADER, line(3, "nigeria"), line(4, "nigeria") + ",surplus"]) + "\n")
    (root / "mali" / "empty.csv").write_text(HEADER + "\n")
    (root / "mali" / "bad.csv").write_text("response_id,country\n1,Mali\n")
    (root / "mali" / "notes.txt").write_text("hello\n")
    return root


def outcome(df):
    return {r.path.rsplit("/", 1)[1]: (r.status, r.reason, r.country) for r in df.collect()}


def test_files_are_ingested_once(spark, raw, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    first = outcome(ingest.ingest_files(spark, str(raw), lake, day=F.lit("2024-05-02"), run_id="r1"))
    assert first["a.csv"] == ("success", None, "Mali")
    assert first["b.csv"] == ("success", None, "Nigeria")
    assert first["empty.csv"][:2] == ("failed", "empty file")
    assert first["bad.csv"][0] == "failed" and first["bad.csv"][1].startswith("missing columns: respondent_id")
    assert first["notes.txt"][:2] == ("failed", "extension not allowed: .txt")
    assert (tmp_path / "lake/bronze/country=nigeria/year=2024/month=05/day=02/source_system=csv").is_dir()

    book = bookkeeping.processed_files(spark, lake)
    assert sorted(r.rows_loaded for r in book.collect()) == [1, 3]

    again = outcome(ingest.ingest_files(spark, str(raw), lake, run_id="r2"))
    assert again["a.csv"][0] == again["b.csv"][0] == "skipped"
    assert bookkeeping.processed_files(spark, lake).count() == 2

    before = (raw / "nigeria" / "b.csv").stat()
    text = (raw / "nigeria" / "b.csv").read_text()
    (raw / "nigeria" / "b.csv").write_text(text.replace(line(3, "nigeria"), line(5, "nigeria")))
    os.utime(raw / "nigeria" / "b.csv", ns=(before.st_atime_ns, before.st_mtime_ns))
    assert (raw / "nigeria" / "b.csv").stat().st_size == before.st_size
    third = outcome(ingest.ingest_files(spark, str(raw), lake, day=F.lit("2024-05-03"), run_id="r3"))
    assert (third["a.csv"][0], third["b.csv"][0]) == ("skipped", "success")
    states = {r.run_id: (r.status, r.rows_processed) for r in bookkeeping.pipeline_runs(spark, lake).collect()}
    assert states == {"r1": ("success", 2), "r2": ("success", 0), "r3": ("success", 1)}

    landed = silver_plan.read_dataset(spark, silver_plan.bronze_datasets(lake)["survey_responses"])
    assert sorted((r.response_id, r.country, r.age) for r in landed.collect()) == sorted(
        [("1", "Mali", 30), ("2", "Mali", None), ("2", "Mali", None), ("3", "nigeria", 30), ("5", "nigeria", 30)], key=str
    )


def test_failed_run_is_recorded(spark, tmp_path, monkeypatch):
    lake = Lake.under(str(tmp_path / "lake"))
    monkeypatch.setattr(ingest, "check_files", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.ingest_files(spark, str(tmp_path), lake, run_id="r")
    run = bookkeeping.pipeline_runs(spark, lake).first()
    assert (run.status, run.log_level) == ("failed", "error") and "division" in run.error_message
    with pytest.raises(ValueError):
        bookkeeping.record_run(spark, lake, "r", "p", "paused")


def test_answers_are_known_by_content(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    folder = tmp_path / "api"
    folder.mkdir()
    record = {"indicator": {"id": "P", "value": "Pop"}, "country": {"id": "ML", "value": "Mali"}, "countryiso3code": "mli", "date": "2024", "value": 9}
    (folder / "wb_1.json").write_text(json.dumps([{"page": 1}, [record, {**record, "date": "2023"}]]))
    (folder / "wb_2.json").write_text(json.dumps([{"page": 1}, [record, {**record, "date": "2023"}]]))
    (folder / "wb_3.json").write_text(json.dumps([{"message": [{"id": "120", "key": "k", "value": "bad value"}]}]))
    first = outcome(ingest.ingest_payloads(spark, str(folder), lake, "world_bank", run_id="a1"))
    assert first["wb_1.json"][0] == "success" and first["wb_2.json"][0] == "skipped"
    assert first["wb_3.json"][:2] == ("failed", "bad value")
    (folder / "wb_4.json").write_text((folder / "wb_1.json").read_text())
    second = outcome(ingest.ingest_payloads(spark, str(folder), lake, "world_bank", run_id="a2"))
    assert second["wb_4.json"][0] == "skipped"
    dataset = silver_plan.bronze_datasets(lake)["world_bank_population"]
    clean = silver_plan.transform_dataset(silver_plan.read_dataset(spark, dataset), dataset.name)
    assert sorted((r.country, r.country_code, r.year, r.population) for r in clean.collect()) == [
        ("Mali", "MLI", 2023, 9),
        ("Mali", "MLI", 2024, 9),
    ]
    with pytest.raises(ValueError):
        ingest.ingest_payloads(spark, str(folder), lake, "other")


def test_answers_without_a_required_field_fail_alone(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    good = {"indicator": {"id": "P", "value": "Pop"}, "country": {"id": "ML", "value": "Mali"}, "countryiso3code": "mli", "date": "2024", "value": None}
    renamed = {("period" if key == "date" else key): value for key, value in good.items()}
    shallow = good | {"country": "Mali"}
    for name, records in {"good": [good], "renamed": [renamed], "shallow": [shallow], "some": [renamed, good]}.items():
        write_answers(tmp_path / "api", name, [{"page": 1}, records])
    found = outcome(ingest.ingest_payloads(spark, str(tmp_path / "api"), lake, "world_bank"))
    assert found["renamed.json"][:2] == ("failed", "lacks year") and found["shallow.json"][:2] == ("failed", "lacks country")
    assert found["good.json"][0] == found["some.json"][0] == "success"
    for source, fields in payloads.ANSWER_FIELDS.items():
        assert set(fields) <= set(BRONZE[source].required)


def test_table_snapshots_are_known_by_content(spark, folder, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    rows_in = fixtures.survey_raw(spark, folder)
    assert ingest.ingest_table(spark, rows_in, lake, "survey_responses") == "success"
    assert ingest.ingest_table(spark, rows_in.repartition(7), lake, "survey_responses") == "skipped"
    assert ingest.ingest_table(spark, rows_in.limit(0), lake, "survey_responses") == "failed"
    assert ingest.ingest_table(spark, rows_in.drop("gender"), lake, "survey_responses") == "failed"
    landed = silver_plan.read_dataset(spark, silver_plan.database_snapshots(lake))
    assert landed.count() == rows_in.count()


def write_answers(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(records))


def test_end_to_end(spark, folder, tmp_path):
    """Raw files and answers of the test data come out as the same tables as the direct builders."""
    lake = Lake.under(str(tmp_path / "lake"))
    raw_rows = fixtures.survey_raw(spark, folder)
    raw_rows.union(raw_rows.limit(50)).repartition(3).write.option("header", True).csv(str(tmp_path / "raw" / "NATION_1"))
    population = [json.loads(r[0]) for r in fixtures.population_payload(spark, folder).select(F.to_json(F.struct("*"))).collect()]
    write_answers(tmp_path / "api" / "world_bank", "wb", [{"page": 1}, population])
    places = [json.loads(r[0]) for r in fixtures.countries_payload(spark, folder).select(F.to_json(F.struct("*"))).collect()]
    write_answers(tmp_path / "api" / "restcountries", "rc", places)

    now = F.lit(datetime(2024, 6, 1))
    written = end_to_end.run_all(spark, lake, str(tmp_path / "raw"), str(tmp_path / "api"), now=now)
    assert set(written["gold"]) == set(GOLD)
    assert written["silver"]["survey_responses"] == raw_rows.count()

    bundle = readers.report_bundle(spark, lake.gold)
    direct = rollups.country_survey_kpis(silver(spark, folder), countries_silver(spark, folder), population_silver(spark, folder), processed_at=now)
    assert rows(bundle["country_kpis"]) == rows(direct.select(*bundle["country_kpis"].columns))
    trends = readers.read_gold(spark, lake.gold, "response_volume_trends_gold")
    assert rows(trends) == rows(rollups.response_volume_trends(silver(spark, folder), now).select(*trends.columns))
    trust = rollups.governance_trust(silver(spark, folder), processed_at=now)
    assert rows(bundle["governance"]) == rows(trust.select(*bundle["governance"].columns))
    assert set(readers.business_bundle(spark, lake.gold)) | set(readers.platform_bundle(spark, lake.gold)) >= set(bundle)
    views = readers.read_silver(spark, lake.silver, views=True)
    assert spark.table("survey_responses").count() == views["survey_responses"].count()

    metrics = bookkeeping.data_quality_metrics(spark, lake)
    rates = [r.duplicate_rate for r in metrics.collect()]
    assert len(rates) == 25 and min(rates) >= 0 and max(rates) > 0
    clean = readers.read_silver(spark, lake.silver)["survey_responses"]
    assert clean.filter("duplicate_flag").count() == 50 and "copies" not in clean.columns
    assert {"country_code", "age_group", "submission_date", "validation_status"} <= set(clean.columns)
    # The files were written without surrounding blanks, so a blank gender arrives as none.
    broken = raw_rows.union(raw_rows.limit(50)).filter("nullif(trim(gender), '') IS NULL OR completion_status IS NULL").count()
    assert bookkeeping.rejected_rows(spark, lake, "survey_responses").count() == broken > 0
    assert {(r.null_keys, r.repeated_keys) for r in bookkeeping.key_checks(spark, lake).collect()} == {(0, 0)}
    kept = [json.loads(r.value) for r in spark.read.text(f"{lake.meta}/answers/world_bank/*").collect()]
    assert [r["value"] for r in kept] == [(tmp_path / "api" / "world_bank" / "wb.json").read_text()]
    state = {r.source_key: r.rows_processed_total for r in bookkeeping.incremental_state(spark, lake).collect()}
    assert state["csv"] == raw_rows.count() + 50 and state["restcountries"] == 24
    runs = {r.pipeline_name: r for r in bookkeeping.pipeline_runs(spark, lake).collect()}
    assert set(runs) == {"csv_ingestion", "api_world_bank", "api_restcountries", "silver_and_gold"}
    assert {r.status for r in runs.values()} == {"success"} and runs["api_world_bank"].run_type == "api"

    again = gold.run_silver_to_gold(spark, lake, now)
    assert again == written["gold"]


def test_choices_for_clean_responses(spark, tmp_path):
    """Aliases, true copies and held-back rows; a text with a line end survives landing."""
    lake = Lake.under(str(tmp_path / "lake"))
    (tmp_path / "raw" / "mali").mkdir(parents=True)
    odd = line(4).replace(",Good,", ',"so, ""so""\nGood",')
    kept = [HEADER, line(1, "Mahli"), line(1, "Mahli"), line(2, age="old"), line(3, status=""), odd, line(5), line(6)]
    (tmp_path / "raw" / "mali" / "a.csv").write_text("\n".join(kept) + "\n")
    ingest.ingest_files(spark, str(tmp_path / "raw"), lake)

    choices = silver_plan.SurveyChoices(aliases={"mahli": "Mali"}, publish_copies=True, hold_back=True)
    assert silver_plan.build_survey(spark, lake, choices=choices, run_id="r1") == 4
    table = spark.read.parquet(f"{lake.silver}/survey_responses")
    assert rows(table.select("response_id", "country", "copies", "duplicate_flag", "q2_economy", "country_code")) == [
        ("1", "Mali", 2, True, "Good", None),
        ("4", "Mali", 1, False, 'so, "so"\nGood', None),
        ("5", "Mali", 1, False, "Good", None),
        ("6", "Mali", 1, False, "Good", None),
    ]
    rejects = bookkeeping.rejected_rows(spark, lake, "survey_responses")
    assert rows(rejects.select("response_id", F.concat_ws(";", "contract_errors"), "run_id")) == [
        ("2", "age: not a integer", "r1"),
        ("3", "completion_status: required", "r1"),
    ]
    assert [r.duplicate_rate for r in bookkeeping.data_quality_metrics(spark, lake).collect()] == [20.0]


def test_nothing_is_published_when_rules_fail(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    (tmp_path / "raw" / "mali").mkdir(parents=True)
    (tmp_path / "raw" / "mali" / "a.csv").write_text("\n".join([HEADER, line(1, age=""), line(2)]) + "\n")
    ingest.ingest_files(spark, str(tmp_path / "raw"), lake)
    with pytest.raises(ValidationError, match="null_share age"):
        silver_plan.build_survey(spark, lake)
    assert not (tmp_path / "lake" / "silver" / "survey_responses").exists()
    with pytest.raises(ValidationError, match="survey_responses.*world_bank_population"):
        silver_plan.run_bronze_to_silver(spark, lake)


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    (source / "a.csv").write_text("\n".join([HEADER, line(1), line(2), line(2)]) + "\n")
    run = lambda: responses.ingest_responses(spark, str(source), BRONZE_SURVEY.text_schema(), target, state)
    run()
    assert sorted(r.response_id for r in spark.read.parquet(target).collect()) == ["1", "2"]
    run()
    assert spark.read.parquet(target).count() == 2
    (source / "b.csv").write_text("\n".join([HEADER, line(2), line(3, " ghana ")]) + "\n")
    run()
    out = {r.response_id: r.country for r in spark.read.parquet(target).collect()}
    assert out == {"1": "Mali", "2": "Mali", "3": "Ghana"}


def test_stream_keeps_late_responses(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    schema = "response_id string, submission_timestamp timestamp"
    stream = lambda: responses.read_stream(spark, str(source), schema)

    def run(name, text, checkpoint=state):
        (source / f"{name}.csv").write_text("id,at\n" + text)
        responses.append_new(stream(), target, checkpoint)
        return sorted(str(r.response_id) for r in spark.read.parquet(target).collect())

    assert run("a", "1,2024-06-30T08:00:00\n2,2024-06-30T08:00:00\n") == ["1", "2"]
    assert run("b", "3,2024-01-01T08:00:00\n1,2024-01-01T08:00:00\n,2024-01-01T08:00:00\n") == ["1", "2", "3", "None"]
    # A new checkpoint reads all files again and adds nothing that is there.
    assert run("c", "4,\n,2024-02-01T08:00:00\n", str(tmp_path / "other")) == ["1", "2", "3", "4", "None"]


def test_stream_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    index = HeldKeys(str(tmp_path / "keys"), "id", T.LongType(), buckets=16)
    table = spark.range(400).withColumn("load", F.lit("one"))
    index.catch_up(table)
    few = spark.createDataFrame([(7,), (700,), (None,)], "id long")
    missing = index.missing(few, "two")
    hit = {row[0] for row in few.select(index.bucket("id")).collect()}
    read = {int(re.search("bucket=([0-9]+)", name).group(1)) for name in missing.inputFiles()}
    assert read and read <= hit and len(hit) <= 3
    assert rows(missing) == [(700,), (None,)]
    assert rows(index.missing(few, "one")) == [(7,), (700,), (None,)]  # a load doesn't look at itself


def test_stream_index_is_brought_up_to_the_table(spark, tmp_path):
    """A table from before the index, and a run that broke between its rows and their keys."""
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    schema = "response_id string, submission_timestamp timestamp"
    old = spark.createDataFrame([("1", None), (None, None)], schema)
    old.write.parquet(f"{target}/load=old")

    def run(name, text):
        (source / f"{name}.csv").write_text("id,at\n" + text)
        responses.append_new(responses.read_stream(spark, str(source), schema), target, str(tmp_path / "state"))
        return sorted(str(r.response_id) for r in spark.read.parquet(target).collect())

    assert run("a", "1,\n2,\n,2024-01-01T08:00:00\n") == ["1", "2", "None"]
    spark.createDataFrame([("5", None), ("6", None)], schema).write.parquet(f"{target}/load=broken")
    assert run("b", "5,\n7,\n2,\n") == ["1", "2", "5", "6", "7", "None"]


def test_daily_counts_take_late_rows_once(spark, tmp_path):
    source, root, state = tmp_path / "in", str(tmp_path / "daily"), tmp_path / "state"
    source.mkdir()
    schema = "response_id string, country string, region string, completion_status string, submission_timestamp timestamp"

    def run(name, *days):
        text = "\n".join(f"{name}{i},Mali,,Completed,{day}T08:00:00" if day else f"{name}{i},Mali,,," for i, day in enumerate(days))
        (source / f"{name}.csv").write_text("id\n" + text + "\n")
        responses.keep_daily_volume(responses.read_stream(spark, str(source), schema), root, str(state))
        table = responses.kept_daily_volume(spark, root)
        return {str(r.submission_date): (r.daily_response_count, r.completed_response_count) for r in table.collect()}

    first = {"2024-03-01": (2, 2), "2024-03-09": (1, 1), "None": (1, 0)}
    assert run("a", "2024-03-01", "2024-03-01", "2024-03-09", None) == first
    march = responses.daily_table(spark, root).newest().count()
    second = first | {"2024-03-01": (3, 3), "2023-01-05": (1, 1)}
    assert run("b", "2024-03-01", "2023-01-05") == second
    assert responses.daily_table(spark, root).newest().count() == march + 1
    # The batch is run again, as after a failure past its commit: nothing counts twice.
    for name in ("1", ".1.crc"):
        (state / "commits" / name).unlink(missing_ok=True)
    responses.keep_daily_volume(responses.read_stream(spark, str(source), schema), root, str(state))
    assert {str(r.submission_date): r.daily_response_count for r in responses.kept_daily_volume(spark, root).collect()} == {
        day: counts[0] for day, counts in second.items()
    }


def test_stream_drops_rows_past_the_watermark(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    schema = "response_id string, country string, region string, completion_status string, submission_timestamp timestamp"

    def run(name, *days):
        text = "\n".join(f"{name}{i},Mali,A,Completed,2024-01-{day:02d}T08:00:00" for i, day in enumerate(days))
        (source / f"{name}.csv").write_text("id\n" + text + "\n")
        stream = responses.read_stream(spark, str(source), schema)
        responses.append_available(responses.daily_volume(stream, "2 days"), target, state)
        return {r.submission_date.day: r.daily_response_count for r in spark.read.parquet(target).collect()}

    assert run("a", 1, 1, 2, 6) == {1: 2, 2: 1}
    assert run("b", 1, 5, 9) == {1: 2, 2: 1, 5: 1, 6: 1}


def test_command_line(spark, raw, tmp_path):
    root = str(tmp_path / "lake")
    parse = __main__.parser().parse_args
    files = __main__.run(spark, parse(["files", "--lake", root, "--raw", str(raw)]))
    assert outcome(files)["a.csv"][0] == "success"
    with pytest.raises(SystemExit):
        parse(["answers", "--lake", root, "--raw", "x", "--source", "other"])
    assert __main__.split("id:1:900:8") == {"split_column": "id", "bounds": (1, 900), "partitions": 8}
    assert __main__.split(None) == {}
    names = tmp_path / "names.csv"
    names.write_text("alias,country_name\nmahli,Mali\n")
    made = __main__.choices(spark, parse(["silver", "--lake", root, "--aliases", str(names), "--copies"]))
    assert rows(made.aliases) == [("mahli", "Mali")] and made.publish_copies and not made.hold_back


def test_clean_table_scan_is_pruned(spark, folder, tmp_path):
    """Filters and columns reach the Parquet scan of the clean table."""
    path = str(tmp_path / "survey_responses")
    write_silver(silver(spark, folder), path, ["country"])
    table = rollups.governance_trust(spark.read.parquet(path).filter("country = 'Nation_3'"))
    text = plan(table)
    assert "PartitionFilters: [isnotnull(country" in text and "IsNotNull(q3_trust_govt)" in text
    assert "ReadSchema: struct<region:string,completion_status:string,q3_trust_govt:int>" in text
