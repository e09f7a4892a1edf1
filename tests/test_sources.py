import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from pollstone.contracts.catalog import COUNTRY_SURVEY_KPIS
from pollstone.contracts.model import Contract
from pollstone.sources import csv_files, payloads, readers, tables, writers
from pollstone.sources.registry import API_SOURCES, DB_SOURCES, Lake, bronze_datasets

PAIR = Contract.of("pair", {"a": "string!", "n": "integer"})


def test_reader_dispatch(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,n\nu,1\nv,\n")
    (tmp_path / "y.json").write_text('[{"a": "u", "n": 1},\n {"a": "v"}]')
    csv = readers.read_bronze(spark, str(tmp_path / "x.csv"), "csv", PAIR)
    assert rows(csv) == [("u", "1"), ("v", None)]
    inferred = readers.read_bronze(spark, str(tmp_path / "x.csv"), "csv")
    assert dict(inferred.dtypes)["n"] == "int"
    assert rows(readers.read_bronze(spark, str(tmp_path / "y.json"), "json").select("a", "n")) == [("u", 1), ("v", None)]
    csv.write.parquet(str(tmp_path / "p"))
    assert rows(readers.read_bronze(spark, str(tmp_path / "p"), "parquet")) == rows(csv)
    with pytest.raises(ValueError, match="No reader"):
        readers.read_bronze(spark, "x", "xml")


def test_listing(spark, tmp_path):
    (tmp_path / "mali").mkdir()
    (tmp_path / "mali" / "a b.csv").write_text("x\n")
    (tmp_path / "c.txt").write_text("x\n")
    listed = readers.list_files(spark, str(tmp_path)).collect()
    assert [r.path.rsplit("/", 1)[1] for r in listed] == ["a b.csv"] and listed[0].length == 2
    assert readers.list_files(spark, str(tmp_path), "*").count() == 2
    assert readers.list_files(spark, str(tmp_path / "none")).isEmpty()


def test_file_paths_take_one_job(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"{k}.csv").write_text("a\n1\n")
    files = readers.list_files(spark, str(tmp_path))
    assert files.rdd.getNumPartitions() > 1
    spark.sparkContext.setJobGroup("file paths", "")
    try:
        paths = readers.file_paths(files)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("file paths")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(p.rsplit("/", 1)[1] for p in paths) == sorted(f"{k}.csv" for k in range(40))


def test_file_hashes(spark, tmp_path):
    lines = [f"line {i}\n" for i in range(3000)]
    body = "".join(lines)
    files = {
        "one.csv": body,
        "same.csv": body,
        "more.csv": body + "more\n",
        "open.csv": body[:-1],
        "crlf.csv": body.replace("\n", "\r\n"),
        "turned.csv": "".join(reversed(lines)),
        "swapped.csv": "".join([*lines[:1500], lines[1501], lines[1500], *lines[1502:]]),
        "moved.csv": "".join([*lines[1:], lines[0]]),
    }
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "empty.csv").write_text("")

    def hashes(**options):
        paths = [str(tmp_path / name) for name in (*files, "empty.csv")]
        return {r.uri.rsplit("/", 1)[1]: r.file_hash for r in readers.file_hashes(spark, paths, **options).collect()}

    whole = hashes()
    assert set(whole) == set(files) and len(set(whole.values())) == len(files) - 1 and whole["one.csv"] == whole["same.csv"]
    assert {len(h) for h in whole.values()} == {64} and {len(h) for h in hashes(algorithm="md5").values()} == {32}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000b", "7777b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert hashes() == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_tolerant_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,a,extra\n1,"x, ""y""",e\n2,z\n3,w,e,surplus\n\n,v,e\n')
    (tmp_path / "b.csv").write_bytes("a,n\nCôte,5\n".encode("latin-1"))
    (tmp_path / "c.csv").write_bytes("﻿a,n\r\nCôte,6\r\n".encode())
    paths = [str(tmp_path / name) for name in ("a.csv", "b.csv", "c.csv")]
    out = csv_files.read_csv_files(spark, paths, PAIR)
    assert rows(out) == sorted([('x, "y"', 1), ("z", 2), ("v", None), ("Côte", 5), ("Côte", 6)], key=str)
    counts = csv_files.row_counts(spark, csv_files.file_headers(spark, paths))
    assert {r.uri.rsplit("/", 1)[1]: r.usable_rows for r in counts.collect()} == {"a.csv": 3, "b.csv": 1, "c.csv": 1}
    assert "Join" not in plan(out)
    headers = {r.uri.rsplit("/", 1)[1]: r for r in csv_files.file_headers(spark, paths).collect()}
    assert not headers["b.csv"].utf8 and headers["c.csv"].utf8 and headers["c.csv"].header == ["a", "n"]
    with pytest.raises(ValueError, match="at least one CSV"):
        csv_files.read_csv_files(spark, [], PAIR)


@pytest.mark.parametrize("encoding, eol", [("utf-8", "\n"), ("utf-8", "\r\n"), ("iso-8859-1", "\n")])
def test_split_records_are_those_of_a_whole_read(spark, tmp_path, encoding, eol):
    """Files cut at many places, in and beside quotes, give what Spark's own reader of whole files does."""
    draw = random.Random(eol + encoding)

    def field():
        if draw.random() < 0.5:
            return "".join(draw.choice("abé ") for _ in range(draw.randint(1, 4)))
        return '"' + "".join(draw.choice(["a", "é", '""', ",", "\n", "\n\n", " "]) for _ in range(draw.randint(1, 9))) + '"'

    paths = []
    for k in range(12):
        lines = ["a,n", '"x\ny",é', *(f"{field()},{field()}" for _ in range(20))]
        (tmp_path / f"{k}.csv").write_bytes(eol.join(lines).encode(encoding))
        paths.append(str(tmp_path / f"{k}.csv"))
    whole = spark.read.schema("a string, n string").csv(paths, header=True, escape='"', multiLine=True, encoding=encoding)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64b")
        lines = csv_files.record_lines(spark, paths, encoding == "utf-8")
        assert lines.select("uri", "block").distinct().count() >= 3 * len(paths)
        assert lines.where("record IS NULL").count() == 0
        texts = Contract.of("texts", {"a": "string", "n": "string"})
        assert rows(csv_files.read_csv_files(spark, paths, texts)) == rows(whole)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_records_over_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,n\n"one\ntwo",5\n"x, ""y""\n\nz,w",6\n"p\nq",7,surplus\n\na,n\nlast\n')
    (tmp_path / "b.csv").write_text('"a, or b",n,a\nno,1,"1,2"\n  \n"r, s",2,\nno,1,2,\n')
    paths = [str(tmp_path / name) for name in ("a.csv", "b.csv")]
    out = csv_files.read_csv_files(spark, paths, PAIR)
    expected = [("one\ntwo", 5), ('x, "y"\n\nz,w', 6), ("last", None), ("1,2", 1), (None, 2)]
    assert rows(out) == sorted(expected, key=str)
    headers = {r.uri.rsplit("/", 1)[1]: r for r in csv_files.file_headers(spark, paths).collect()}
    assert headers["a.csv"].spans and not headers["b.csv"].spans and headers["b.csv"].header == ["a, or b", "n", "a"]


def test_world_bank_payloads(spark):
    record = '{"indicator":{"id":"P","value":"Population"},"country":{"id":"NG","value":"Nigeria"},"countryiso3code":"NGA","date":"2024","value":5}'
    texts = [
        (f'[{{"page":1}},[{record},{record.replace("2024", "2023").replace("5}", "null}")}]]',),
        (f"[{record}]",),
        ('[{"message":[{"id":"120","key":"Invalid value","value":"not valid"}]}]',),
        ("{}",),
    ]
    raw = spark.createDataFrame(texts, "value string")
    out = payloads.normalize_world_bank(payloads.world_bank_records(raw)).drop("ingestion_timestamp")
    assert rows(out) == sorted(
        [("Nigeria", "NGA", 2024, 5, "Population", "world_bank")] * 2
        + [("Nigeria", "NGA", 2023, None, "Population", "world_bank")],
        key=str,
    )
    assert sorted(r.reject_reason for r in payloads.rejected_payloads(raw).collect()) == ["not valid", "unexpected answer format"]


def test_country_payloads(spark):
    raw = spark.createDataFrame([('[{"name":{"common":"Mali","official":"R"},"region":"Africa","population":3,"area":1.5}]',)], "value string")
    out = payloads.normalize_countries(payloads.country_records(raw)).drop("ingestion_timestamp")
    assert rows(out) == [("Mali", None, "Africa", None, 3, 1.5, "restcountries")]
    plain = spark.createDataFrame([("Mali", "MLI", "r", "s", 1, 2.0)], "name string, cca3 string, region string, subregion string, population bigint, area double")
    assert payloads.normalize_countries(plain).first()[:2] == ("Mali", "MLI")


def test_silver_and_gold_folders(spark, tmp_path):
    df = spark.createDataFrame([("1", "A"), ("2", "A"), ("3", "B")], "response_id string, country string")
    path = str(tmp_path / "survey_responses")
    assert writers.write_silver(df, path, writers.default_partitions(df)) == 3
    assert writers.write_silver(df.limit(2), path, ["country"]) == 2
    back = spark.read.parquet(path)
    assert back.columns[-1] == "country" and back.count() == 2
    assert writers.default_partitions(df.drop("country")) == []
    kpis = spark.createDataFrame([("A", "r", 3)], "country string, region string, total_responses int")
    assert writers.write_gold(kpis, str(tmp_path / "gold" / "t"), COUNTRY_SURVEY_KPIS) == 1
    assert readers.read_gold(spark, str(tmp_path / "gold"), "t").columns == COUNTRY_SURVEY_KPIS.columns
    with pytest.raises(FileNotFoundError):
        readers.read_gold(spark, str(tmp_path / "gold"), "none")


def test_empty_tables_can_be_written(spark, tmp_path):
    empty = spark.createDataFrame([], "country string, x int")
    assert writers.write_silver(empty, str(tmp_path / "a"), ["country"]) == 0
    assert writers.write_gold(empty.groupBy("country").count(), str(tmp_path / "b")) == 0
    assert writers.write_gold(spark.range(9).filter("id > 10").groupBy("id").count(), str(tmp_path / "c")) == 0


def test_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(400000).selectExpr("IF(id % 3 < 2, 'hot', CAST(id % 50 AS STRING)) AS country", "sha2(CAST(id AS STRING), 256) AS v")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
    try:
        writers.write_silver(df, str(tmp_path / "t"), ["country"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "country=hot").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400000


def test_bronze_layout(spark, tmp_path):
    assert writers.bronze_path("Mali", "csv", "x/y/f.csv", "2024-03-05") == "country=mali/year=2024/month=03/day=05/csv/f.csv"
    df = spark.createDataFrame([("1", " Mali"), ("2", "Niger")], "response_id string, country string").withColumn("source_system", F.lit("field_tool"))
    landed = writers.with_bronze_parts(df, day=F.lit("2024-03-05"), source=F.lit("csv"))
    writers.land_bronze(landed, str(tmp_path), "parquet")
    assert (tmp_path / "country=mali" / "year=2024" / "month=03" / "day=05" / "source_system=csv").is_dir()
    glob = f"{tmp_path}/country=*/year=*/month=*/day=*/source_system=csv"
    back = readers.read_bronze(spark, glob, "parquet", folder_parts=True)
    assert rows(back.select("country", "source_system", "path_country", "path_month")) == [
        (" Mali", "field_tool", "mali", "03"),
        ("Niger", "field_tool", "niger", "03"),
    ]


def test_snapshots_and_audit_copies(spark, tmp_path):
    df = spark.createDataFrame([("[1]",)], "value string")
    assert spark.read.parquet(writers.write_snapshot(df, str(tmp_path), "t", "20240101_000000")).count() == 1
    kept = writers.keep_payloads(df, str(tmp_path), "world_bank", "20240101_000000", "NG")
    assert kept.endswith("world_bank/world_bank_ng_20240101_000000") and spark.read.text(kept).first().value == "[1]"


def test_table_extract_is_allow_listed(spark):
    with pytest.raises(ValueError, match="none of the declared"):
        tables.extract_options("users; DROP TABLE x")
    assert tables.extract_options("survey_responses") == {"dbtable": "survey_responses"}
    options = tables.extract_options("survey_responses", "id", (0, 100), 8)
    assert (options["numPartitions"], options["upperBound"]) == ("8", "100")
    check = tables.count_check(spark.range(3).toDF("a"), spark.range(4).toDF("a")).first()
    assert tuple(check) == (3, 4, False)


def test_registries():
    lake = Lake.under("/lake/")
    assert set(bronze_datasets(lake)) == {"survey_responses", "world_bank_population", "country_reference"}
    assert all(source["dataset"] in bronze_datasets(lake) for source in API_SOURCES.values())
    assert DB_SOURCES["survey_responses"]["table_name"] == "survey_responses"


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "y")], "x int, z string")
    assert rows(readers.union_all([a, b])) == [(1, None), (2, "y")]
    with pytest.raises(ValueError):
        readers.union_all([])
