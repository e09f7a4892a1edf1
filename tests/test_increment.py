"""Clean and business tables after several deliveries equal those of one full run, and only what is touched is read."""

import json
import re

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from test_jobs import HEADER, line

from pollstone.operators import dedup
from pollstone.operators.validation import ValidationError
from pollstone.plans import gold, increment, ingest, parted
from pollstone.plans import silver as silver_plan
from pollstone.plans.silver import SurveyChoices
from pollstone.sources import writers
from pollstone.sources.registry import Lake

DAYS = ("2024-05-01", "2024-05-02", "2024-05-03")
DELIVERIES = (
    {"mali": [line(1), line(2, age=""), line(2, age=""), line(3), *map(line, range(10, 18))], "nigeria": [line(4, "nigeria"), line(5, "nigeria")]},
    {"ghana": [line(6, "Ghana"), line(3, "Ghana", age="44")]},  # 3 moves from Mali to Ghana
    {"mali": [line(1, status="partial"), line(7)], "ghana": [line(6, "Ghana")]},
)


def stamp():
    return F.to_timestamp(F.lit("2024-06-01 00:00:00"))


def deliver(spark, root, lake, number):
    folder = root / f"delivery{number}"
    for country, lines in DELIVERIES[number].items():
        (folder / country).mkdir(parents=True)
        (folder / country / f"{country}{number}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    result = ingest.ingest_files(spark, str(folder), lake, day=F.lit(DAYS[number]))
    assert {r.status for r in result.collect()} == {"success"}


def references(spark, root, lake):
    answers = root / "answers"
    answers.mkdir()
    people = [
        {"indicator": {"id": "P", "value": "Pop"}, "country": {"id": c[:2], "value": c}, "countryiso3code": c[:3], "date": "2024", "value": 10**6}
        for c in ("Mali", "Ghana")
    ]
    (answers / "wb.json").write_text(json.dumps([{"page": 1}, people]))
    ingest.ingest_payloads(spark, str(answers), lake, "world_bank")
    places = root / "places"
    places.mkdir()
    (places / "c.json").write_text(json.dumps([{"name": {"common": "Mali", "official": "Mali"}, "region": "Africa", "subregion": "West", "population": 9, "area": 1.0}]))
    ingest.ingest_payloads(spark, str(places), lake, "restcountries")
    for name in ("world_bank_population", "country_reference"):
        silver_plan.build_dataset(spark, lake, silver_plan.bronze_datasets(lake)[name], stamp())


def published(spark, lake):
    return spark.read.parquet(f"{lake.silver}/survey_responses")


def test_increments_equal_a_full_run(spark, tmp_path):
    choices = SurveyChoices(publish_copies=True)
    lake = Lake.under(str(tmp_path / "lake"))
    references(spark, tmp_path, lake)
    seen = []
    for number in range(len(DELIVERIES)):
        deliver(spark, tmp_path, lake, number)
        seen.append(len(increment.update_silver(spark, lake, stamp(), choices=choices)))
    counts = increment.update_gold(spark, lake, stamp())
    assert seen == [2, 2, 2] and increment.update_silver(spark, lake, stamp(), choices=choices) == []
    kept = {name: spark.read.parquet(f"{lake.gold}/{name}") for name in counts}
    step = {name: rows(df.select(sorted(df.columns))) for name, df in kept.items()}
    table = published(spark, lake)
    names = sorted(table.columns)
    merged = rows(table.select(names))
    assert {r.response_id: r.country for r in table.collect()}["3"] == "Ghana"

    silver_plan.build_survey(spark, lake, stamp(), choices=choices)
    assert rows(published(spark, lake).select(names)) == merged
    gold.run_silver_to_gold(spark, lake, stamp())
    for name, want in step.items():
        full = spark.read.parquet(f"{lake.gold}/{name}")
        assert rows(full.select(sorted(full.columns))) == want, name


def test_only_touched_countries_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(increment, "FACTS", {"profile": increment.FACTS["profile"]})
    lake = Lake.under(str(tmp_path / "lake"))
    deliver(spark, tmp_path, lake, 0)
    increment.update_silver(spark, lake, stamp())
    before = {f: p.stat().st_mtime_ns for p in (tmp_path / "lake/silver/survey_responses").rglob("*.parquet") for f in [str(p)]}
    deliver(spark, tmp_path, lake, 1)
    table = increment.survey_table(spark, lake)
    assert all("/delivery1/" not in f and "day=02" in f for f in increment.new_raw_files(spark, lake, table.inputs()))
    read, original = [], parted.PartedTable.read

    def noted(self, parts=None):
        found = original(self, parts)
        if self.root == table.root:
            read.append((parts, plan(found)))
        return found

    monkeypatch.setattr(parted.PartedTable, "read", noted)
    touched = increment.update_silver(spark, lake, stamp())
    assert len(touched) == 2
    whole = [text for parts, text in read if parts is not None]
    other = spark.createDataFrame([("Nigeria",)], "country string").select(parted.part_of("country")).first()[0]
    scans = [text for text in whole if "FileScan" in text]
    assert scans and all(re.search(r"PartitionFilters: \[[^\]]", text) for text in scans)
    assert other not in touched and not any(other in (parts or ()) for parts, _ in read)
    after = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "lake/silver/survey_responses").rglob("*.parquet")}
    same = [f for f in before if "country=Nigeria" in f]
    assert same and all(after[f] == before[f] for f in same)


def test_broken_runs_change_nothing_and_are_made_up_for(spark, tmp_path, monkeypatch):
    few = {"profile": increment.FACTS["profile"]}
    monkeypatch.setattr(increment, "FACTS", few)
    lake = Lake.under(str(tmp_path / "lake"))
    deliver(spark, tmp_path, lake, 0)
    monkeypatch.setattr(parted.PartedTable, "commit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        increment.update_silver(spark, lake, stamp(), run_id="r1")
    monkeypatch.undo()
    monkeypatch.setattr(increment, "FACTS", few)
    assert increment.survey_table(spark, lake).read().count() == 0
    monkeypatch.setattr(increment, "write_facts", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        increment.update_silver(spark, lake, stamp(), run_id="r1")
    monkeypatch.undo()
    monkeypatch.setattr(increment, "FACTS", few)
    assert increment.update_silver(spark, lake, stamp()) == []
    assert {r.response_id for r in published(spark, lake).collect()} == {*map(str, range(1, 6)), *map(str, range(10, 18))}
    table = increment.survey_table(spark, lake)
    assert table.read().where("response_id = '2'").first()[dedup.COPIES] == 2
    again = increment.merge_delivery(table, published(spark, lake), "r1")
    assert len(again) == 2 and table.read().count() == 13


def test_a_country_can_lose_its_last_row(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    shape = "response_id string, country string, region string, gender string, age int, submission_timestamp timestamp"
    first = spark.createDataFrame([("1", "Mali"), ("2", None), (None, "Mali")], "response_id string, country string")
    fill = {"region": F.lit("r"), "gender": F.lit("Male"), "age": F.lit(30), "submission_timestamp": stamp()}
    first = first.withColumns(fill)
    table = increment.merged_table(spark, lake, first.withColumn(dedup.COPIES, F.lit(1).cast("bigint")).schema)
    assert [f.name for f in table.schema.fields][:6] == [part.split()[0] for part in shape.split(", ")]
    increment.merge_delivery(table, first, "a", check=False)
    later = first.withColumn("submission_timestamp", stamp() + F.expr("interval 1 day")).withColumn("country", F.lit("Ghana"))
    touched = increment.merge_delivery(table, later, "b", check=False)
    assert len(touched) == 3
    assert sorted((r.response_id or "", r.country, r.copies) for r in table.read().collect()) == [("", "Ghana", 2), ("1", "Ghana", 2), ("2", "Ghana", 2)]
    assert {r.rows for r in table.newest().collect()} == {0, 3}
    increment.merge_delivery(table, later.limit(0), "c", check=False)
    assert table.read().count() == 3


def test_refused_rows_are_not_merged(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    bad = spark.createDataFrame([(None, "Mali")], "response_id string, country string")
    table = increment.merged_table(spark, lake, bad.withColumn(dedup.COPIES, F.lit(1).cast("bigint")).schema)
    with pytest.raises(ValidationError):
        increment.merge_delivery(table, bad, "a")
    assert table.read().count() == 0 and table.inputs().count() == 0


def test_rows_that_come_by_folder_are_not_shuffled_again(spark, tmp_path, monkeypatch):
    """Landed files, landed tables and published countries are written as they come; a first delivery is merged once."""
    lake = Lake.under(str(tmp_path / "lake"))
    references(spark, tmp_path, lake)
    spread, merged = [], []
    monkeypatch.setattr(writers, "spread_by", lambda df, columns: spread.extend(columns) or df)
    twice = increment.merge_merged_responses
    monkeypatch.setattr(increment, "merge_merged_responses", lambda df: merged.append(1) or twice(df))
    deliver(spark, tmp_path, lake, 0)
    names = HEADER.split(",")
    table = spark.createDataFrame([line(30 + k).split(",") for k in range(8)], ", ".join(f"`{n}` string" for n in names))
    assert ingest.ingest_table(spark, table.repartition(4), lake, "survey_responses", day=F.lit(DAYS[0])) == "success"
    increment.update_silver(spark, lake, stamp(), with_database=True)
    assert merged == []
    deliver(spark, tmp_path, lake, 2)
    increment.update_silver(spark, lake, stamp(), with_database=True)
    assert merged == [1] and spread == []
    assert published(spark, lake).select("response_id").distinct().count() == published(spark, lake).count() == 23
