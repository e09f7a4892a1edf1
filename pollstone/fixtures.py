"""Survey-shaped inputs derived from the TPC-H-like test tables.

Each SQL text is portable: Spark runs it over DataFrames and the oracle runs
the same text over its own views. The imperfections are deliberate: mixed case
and padding, NULL and impossible ages, missing statuses and scores, a nation
without population rows, one with population zero, one without reference row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SURVEY_RAW = """
WITH base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderstatus AS st, o.o_orderdate AS ts,
         CAST(substr(o.o_orderpriority, 1, 1) AS INT) AS pr, c.c_mktsegment AS seg, n.n_nationkey AS nk, n.n_name AS nn
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
)
SELECT CAST(k AS STRING) AS response_id, CAST(ck AS STRING) AS respondent_id,
  concat('survey_', CAST(100 + ck % 900 AS STRING)) AS survey_id,
  CASE WHEN k % 3 = 0 THEN concat(' ', lower(nn)) ELSE nn END AS country,
  CASE WHEN k % 4 = 0 THEN lower(seg) ELSE seg END AS region,
  CASE k % 8 WHEN 0 THEN 'Male' WHEN 1 THEN 'MALE' WHEN 2 THEN ' m' WHEN 3 THEN 'Female' WHEN 4 THEN 'f ' WHEN 5 THEN ' ' WHEN 6 THEN NULL ELSE 'other' END AS gender,
  CASE WHEN k % 50 = 0 THEN NULL ELSE CAST(15 + (k * 7) % 90 AS DOUBLE) END AS age,
  CASE ck % 3 WHEN 0 THEN 'Primary' WHEN 1 THEN 'secondary' ELSE 'TERTIARY' END AS education_level,
  CASE ck % 4 WHEN 0 THEN 'Employed' WHEN 1 THEN 'unemployed' WHEN 2 THEN 'self-employed' ELSE '' END AS employment_status,
  CASE WHEN k % 40 = 0 THEN NULL WHEN st = 'F' THEN 'Completed' WHEN st = 'O' THEN 'completed' ELSE 'partial' END AS completion_status,
  ts AS submission_timestamp, 'field_tool' AS source_system,
  CASE WHEN k % 33 = 0 THEN NULL ELSE pr END AS q1_democracy,
  CASE k % 4 WHEN 0 THEN 'Bad' WHEN 1 THEN 'Neutral' WHEN 2 THEN 'Good' ELSE 'Very Good' END AS q2_economy,
  CAST(1 + (k + ck) % 5 AS INT) AS q3_trust_govt,
  CASE (k + nk) % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS q4_corruption,
  CAST(1 + ck % 5 AS INT) AS q5_election_fairness
FROM base
"""

# Every response is delivered once per line item; later deliveries correct earlier ones.
SURVEY_FEED = """
SELECT r.response_id, r.respondent_id, r.survey_id, r.country, r.region, r.gender, r.age,
  r.education_level, r.employment_status, r.completion_status, r.submission_timestamp, r.source_system,
  r.q1_democracy, r.q2_economy, CAST(1 + (l.l_suppkey + l.l_linenumber) % 5 AS INT) AS q3_trust_govt,
  r.q4_corruption, r.q5_election_fairness,
  l.l_shipdate AS loaded_at, l.l_linenumber AS delivery, l.l_partkey AS batch
FROM {raw} r JOIN {lineitem} l ON CAST(r.response_id AS BIGINT) = l.l_orderkey
"""

# Population per nation and year in which the nation has orders.
POPULATION = """
SELECT n.n_name AS country, concat('N', CAST(n.n_nationkey AS STRING)) AS country_code, y.yr AS year,
  CASE WHEN y.yr = 2001 AND n.n_nationkey % 3 = 0 THEN NULL WHEN n.n_nationkey = 23 THEN 0
       ELSE CAST(400000 AS BIGINT) * (n.n_nationkey + 1) * (n.n_nationkey + 1) + (y.yr - 1990) * 1000 END AS population,
  'Population, total' AS indicator
FROM {nation} n JOIN (
  SELECT DISTINCT c.c_nationkey AS nk, CAST(year(o.o_orderdate) AS INT) AS yr
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
) y ON n.n_nationkey = y.nk
WHERE n.n_nationkey <> 24
"""

COUNTRIES = """
SELECT lower(n.n_name) AS country_name, concat('Republic of ', n.n_name) AS official_name, r.r_name AS region,
  concat('sub ', r.r_name) AS subregion, CAST(1000000 * (n.n_nationkey + 1) AS BIGINT) AS population, CAST(1000.5 * n.n_nationkey AS DOUBLE) AS area
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey WHERE n.n_nationkey <> 22
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _run(spark: SparkSession, folder: str, text: str, names: tuple[str, ...], **frames: DataFrame) -> DataFrame:
    return spark.sql(text, **{name: table(spark, folder, name) for name in names}, **frames)


def survey_raw(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, SURVEY_RAW, ("orders", "customer", "nation"))


def survey_feed(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, SURVEY_FEED, ("lineitem",), raw=survey_raw(spark, folder))


def population(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, POPULATION, ("nation", "orders", "customer"))


def population_payload(spark: SparkSession, folder: str) -> DataFrame:
    """The population rows in the nested form of the statistics service."""
    return population(spark, folder).select(
        F.struct(F.lit("POP").alias("id"), F.col("indicator").alias("value")).alias("indicator"),
        F.struct("country_code", F.concat(F.lit(" "), F.lower("country")).alias("value"))
        .cast("struct<id:string,value:string>")
        .alias("country"),
        F.concat(F.lower("country_code"), F.lit(" ")).alias("countryiso3code"),
        F.col("year").cast("string").alias("date"),
        F.when(F.col("country_code") == "N7", -F.col("population")).otherwise(F.col("population")).alias("value"),
        F.lit("").alias("unit"),
        F.lit("").alias("obs_status"),
        F.lit(0).cast("bigint").alias("decimal"),
    )


def countries(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, COUNTRIES, ("nation", "region"))


def countries_payload(spark: SparkSession, folder: str) -> DataFrame:
    """The country rows in the nested form of the country service."""
    return countries(spark, folder).select(
        F.struct(F.col("country_name").alias("common"), F.col("official_name").alias("official")).alias("name"),
        F.lower("region").alias("region"),
        F.concat(F.lit(" "), F.col("subregion")).alias("subregion"),
        "population",
        "area",
    )
