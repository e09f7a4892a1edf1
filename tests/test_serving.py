import pytest
from conftest import rows

from pollstone.operators import findings, serving


def test_country_summary_is_weighted(spark):
    kpis = spark.createDataFrame(
        [("A", 90, 9, 81), ("A", 10, 10, 0)],
        "country string, total_responses bigint, completed_responses bigint, incomplete_responses bigint",
    )
    assert serving.country_summary(kpis).first().completion_rate == pytest.approx(19.0)


def test_rankings_break_ties_by_country(spark):
    df = spark.createDataFrame([("B", 1.0), ("A", 1.0), ("C", 2.0), ("D", None), (None, 9.0)], "country string, s double")
    assert [r.country for r in serving.top(df, "s", 2).collect()] == ["C", "A"]
    assert [r.country for r in serving.bottom(df, "s", 2).collect()] == ["A", "B"]
    assert serving.ranked(df, "s").count() == 3
    assert serving.preview(df, 2).count() == 2


def test_civic_comparison_has_two_rows_per_country(spark):
    democracy = spark.createDataFrame([("A", 10.0), ("A", 20.0), ("B", 5.0)], "country string, democracy_index double")
    fairness = spark.createDataFrame([("A", 1.0), ("C", 2.0)], "country string, fairness_index double")
    assert rows(serving.civic_comparison(democracy, fairness)) == sorted(
        [
            ("A", "democracy_index", 15.0),
            ("A", "fairness_index", 1.0),
            ("B", "democracy_index", 5.0),
            ("B", "fairness_index", None),
            ("C", "democracy_index", None),
            ("C", "fairness_index", 2.0),
        ],
        key=str,
    )


def test_kpi_texts(spark):
    kpis = spark.createDataFrame([("A", 1234, 50.0), ("B", 1, 75.5)], "country string, total_responses bigint, completion_rate double")
    trust = spark.createDataFrame([(3.0,)], "average_trust_score double")
    assert tuple(serving.business_kpi_texts(kpis, trust).first()) == ("1,235", "2", "62.75%", "3.00")


def test_display_order(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 3.0), ("C", None)], "country string, corruption_index double")
    assert [r.country for r in serving.in_display_order(df, "corruption_perception_gold").collect()] == ["B", "A", "C"]
    assert serving.in_display_order(df, "other") is df


def one(spark, value, kind="double"):
    return spark.createDataFrame([(value,)], f"x {kind}")


@pytest.mark.parametrize(
    "check, value, severity",
    [
        (findings.COMPLETION, 69.99, "High"),
        (findings.COMPLETION, 70.0, "Medium"),
        (findings.COMPLETION, 85.0, "Low"),
        (findings.COMPLETION, None, "Low"),
        (findings.TRUST, 2.5, "Medium"),
        (findings.CORRUPTION, 70.0, "High"),
        (findings.CORRUPTION, 40.0, "Medium"),
        (findings.CORRUPTION, None, "Low"),
        (findings.COVERAGE, 9.9, "High"),
    ],
)
def test_thresholds(spark, check, value, severity):
    assert findings.finding(one(spark, value), check).first().severity == severity


def test_messages(spark):
    row = findings.finding(one(spark, 12.345), findings.COVERAGE).first()
    assert row.message.startswith("The average survey coverage is 12.3")
    assert "nan" in findings.finding(one(spark, None), findings.TRUST).first().message


@pytest.mark.parametrize("value, severity", [("SUCCESS", "Low"), ("success", "Low"), ("FAILED", "High"), (None, "High")])
def test_status(spark, value, severity):
    assert findings.finding(one(spark, value, "string"), findings.STATUS).first().severity == severity


@pytest.mark.parametrize("value, severity", [("Very Stale", "High"), ("Stale", "Medium"), ("Fresh", "Low")])
def test_freshness(spark, value, severity):
    assert findings.finding(one(spark, value, "string"), findings.FRESHNESS).first().severity == severity


def test_risk_headline(spark):
    def summary(*levels):
        return findings.risk_summary(spark.createDataFrame([(x,) for x in levels], "severity string")).first()

    assert summary("High", "Low").headline == findings.BANNERS["High"]
    assert summary("Medium", "Low").headline == findings.BANNERS["Medium"]
    assert summary("Low").headline == findings.BANNERS["Low"]
    assert tuple(summary("High", "Medium", "Medium"))[:4] == (1, 2, 0, 3)
