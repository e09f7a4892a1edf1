import random
from itertools import groupby

import pytest
from conftest import plan, rows
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollstone.functions import expr
from pollstone.functions.durable import shared_folder
from pollstone.functions.names import plain_name, rename_columns, snake_case
from pollstone.functions.running import running_total


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Response ID", "response_id"),
        ("Country-Code", "country_code"),
        (" IndicatorName ", "indicator_name"),
        ("q1 (Democracy)?", "q1_democracy"),
        ("__A__b", "a_b"),
        ("age2Group", "age2_group"),
    ],
)
def test_snake_case(raw, clean):
    assert snake_case(raw) == clean


@given(st.text(max_size=20))
def test_snake_case_is_idempotent(name):
    assert snake_case(snake_case(name)) == snake_case(name)


def test_plain_name():
    assert plain_name(" Survey-Date x ") == "survey_date_x"


def test_renaming_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], ["Response ID", "response_id"])
    with pytest.raises(ValueError, match="response_id"):
        rename_columns(df)


def test_ratios_round_half_up(spark):
    df = spark.createDataFrame([(1, 800), (-1, 800), (0, 5), (3, 0), (None, 4)], "n bigint, d bigint")
    assert [r.p for r in df.select(expr.percent(F.col("n"), F.col("d")).alias("p")).collect()] == [
        0.13,
        -0.13,
        0.0,
        None,
        None,
    ]


def test_bands(spark):
    df = spark.createDataFrame([(None,), (17,), (24,), (25,), (54,), (55,)], "age int")
    assert [r.g for r in df.select(expr.age_group(F.col("age")).alias("g")).collect()] == [
        "Unknown",
        "18-24",
        "18-24",
        "25-34",
        "45-54",
        "55+",
    ]
    scores = spark.createDataFrame([(95.0,), (94.99,), (70.0,), (69.9,), (None,)], "s double")
    assert [r.b for r in scores.select(expr.quality_band(F.col("s")).alias("b")).collect()] == [
        "Excellent",
        "Good",
        "Fair",
        "Poor",
        "Poor",
    ]
    hours = spark.createDataFrame([(24.0,), (24.01,), (72.0,), (73.0,), (None,)], "h double")
    assert [r.b for r in hours.select(expr.freshness_band(F.col("h")).alias("b")).collect()] == [
        "Fresh",
        "Stale",
        "Stale",
        "Very Stale",
        "Very Stale",
    ]
    with pytest.raises(ValueError):
        expr.band(F.col("h"), [(1, "x")], "y", "near")


def test_lenient_cast(spark):
    df = spark.createDataFrame([("73.0",), (" 18 ",), ("x",), ("",), (None,), ("99999999999",)], "a string")
    cast = expr.lenient_cast(F.col("a"), T.StringType(), T.IntegerType())
    assert [r.a for r in df.select(cast.alias("a")).collect()] == [73, 18, None, None, None, None]


def test_file_names(spark):
    df = spark.createDataFrame([("a/B c.CSV",), ("x/.csv",), ("noext",)], "p string")
    out = df.select(expr.normalized_file_name(F.col("p")), expr.file_extension(F.col("p"))).collect()
    assert [tuple(r) for r in out] == [("b_c.csv", ".csv"), (".csv", ""), ("noext", "")]


def test_stable_mean_skips_nulls(spark):
    df = spark.createDataFrame([(1.1,), (None,), (2.2,)], "x double")
    assert df.agg(expr.stable_mean("x")).first()[0] == pytest.approx(1.65)
    assert df.filter("false").agg(expr.stable_mean("x")).first()[0] is None


def test_running_total_equals_brute_force_with_a_hot_group(spark):
    rng = random.Random(5)
    keys = {
        ("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]), rng.randrange(5), f"r{rng.randrange(4000)}")
        for _ in range(6000)
    }
    data = [(g, d, r, rng.randrange(10)) for g, d, r in keys]
    df = spark.createDataFrame(data, "g string, d int, r string, n bigint")
    got = rows(running_total(df, ["g"], ["d", "r"], "n", "total", F.expr("d DIV 2")))
    assert got == rows(running_total(df, ["g"], ["d", "r"], "n", "total", F.col("d")))
    expected = []
    ordered = sorted(data, key=lambda x: (x[0] or "", x[0] is not None, x[1], x[2]))
    for _, members in groupby(ordered, key=lambda x: x[0]):
        total = 0
        for g, d, r, n in members:
            total += n
            expected.append((g, d, r, n, total))
    assert got == sorted(expected, key=str)


def test_running_total_spreads_a_hot_group(spark):
    """A group's rows are dealt to tasks by block, and nothing is written on the way."""
    df = spark.range(20000).selectExpr("'one' AS g", "id AS o", "1L AS n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = running_total(df, ["g"], ["o"], "n", "total", F.expr("o DIV 100"))
        assert out.agg(F.max("total"), F.count_distinct("total")).first()[:] == (20000, 20000)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert "ExistingRDD" not in plan(out)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 8 and max(sizes) < 2 * 20000 / 8


def test_running_total_keeps_rows_without_a_place_in_the_order(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 3, 2), ("a", 4, 4), (None, None, 8), (None, 1, 16)], "g string, o int, n bigint")
    out = running_total(df, ["g"], ["o"], "n", "total", F.expr("o DIV 2"))
    assert sorted(r.total for r in out.collect()) == [1, 3, 7, 8, 24]


def test_running_total_shuffles_the_wide_side_once(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, NULL, 'g') AS g", "id AS o", "1L AS n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(running_total(df, ["g"], ["o"], "n", "total", F.expr("o DIV 100")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One for the window over the rows; three small ones for the offsets of the blocks.
    assert text.count("Exchange hashpartitioning") == 4 and "rangepartitioning" not in text


def test_checkpoint_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
