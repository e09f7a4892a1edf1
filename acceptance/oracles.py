"""Oracle SQL: what each registered query must return, written for DuckDB.

Ratios of counts are rounded half up with integer arithmetic, independently of
the decimal and floating point arithmetic Spark uses.
"""

from __future__ import annotations

import re

from acceptance.finding_rules import CHECKS, HEADLINES
from pollstone import fixtures

NAMES = {
    name: name
    for name in ("orders", "customer", "nation", "region", "lineitem", "events", "documents", "pages", "labels")
}


def initcap(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({x}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def blank(x: str) -> str:
    return f"nullif(trim({x}), '')"


def ratio(num: str, den: str, scale: int = 100) -> str:
    """scale*num/den with two decimals, half up (away from zero), NULL for a zero denominator."""
    return (
        f"CAST(sign({num}) * (({2 * scale * 100} * abs(CAST({num} AS HUGEINT)) + ({den})) "
        f"// nullif(2 * CAST({den} AS HUGEINT), 0)) / 100.0 AS DOUBLE)"
    )


def mean2(x: str) -> str:
    return f"CAST(((200 * sum({x}) + count({x})) // nullif(2 * count({x}), 0)) / 100.0 AS DOUBLE)"


def stable_mean(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,2))) AS DOUBLE) / nullif(count({x}), 0)"


def flag(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def _clean_survey(source: str, extra: str = "") -> str:
    return f"""
SELECT {blank('response_id')} AS response_id, {blank('respondent_id')} AS respondent_id, {blank('survey_id')} AS survey_id,
  {initcap(blank('country'))} AS country, {initcap(blank('region'))} AS region,
  CASE WHEN lower(trim(gender)) IN ('male', 'm') THEN 'Male' WHEN lower(trim(gender)) IN ('female', 'f') THEN 'Female' ELSE 'Unknown' END AS gender,
  CASE WHEN trunc(age) BETWEEN 18 AND 100 THEN CAST(trunc(age) AS INT) END AS age,
  {initcap(blank('education_level'))} AS education_level, {initcap(blank('employment_status'))} AS employment_status,
  {initcap(blank('completion_status'))} AS completion_status, submission_timestamp, {blank('source_system')} AS source_system,
  q1_democracy, {blank('q2_economy')} AS q2_economy, q3_trust_govt, {blank('q4_corruption')} AS q4_corruption, q5_election_fairness{extra}
FROM {source}
"""


FEED_ORDER = (
    "loaded_at DESC NULLS LAST, submission_timestamp DESC NULLS LAST, respondent_id DESC NULLS LAST, survey_id DESC NULLS LAST, "
    "country DESC NULLS LAST, region DESC NULLS LAST, gender DESC NULLS LAST, age DESC NULLS LAST, education_level DESC NULLS LAST, "
    "employment_status DESC NULLS LAST, completion_status DESC NULLS LAST, source_system DESC NULLS LAST, q1_democracy DESC NULLS LAST, "
    "q2_economy DESC NULLS LAST, q3_trust_govt DESC NULLS LAST, q4_corruption DESC NULLS LAST, q5_election_fairness DESC NULLS LAST, "
    "delivery DESC NULLS LAST, batch DESC NULLS LAST"
)

CTES: dict[str, str] = {
    "survey_raw": fixtures.SURVEY_RAW.format(**NAMES),
    "feed": fixtures.SURVEY_FEED.format(raw="survey_raw", **NAMES),
    "wb": fixtures.POPULATION.format(**NAMES),
    "cref": fixtures.COUNTRIES.format(**NAMES),
    "silver": _clean_survey("survey_raw", ", submission_timestamp AS silver_processed_at"),
    "feed_clean": _clean_survey("feed", ", loaded_at, delivery, batch, loaded_at AS silver_processed_at"),
    "feed_ranked": f"""
SELECT *, row_number() OVER (PARTITION BY response_id ORDER BY {FEED_ORDER}) AS rn,
  count(*) OVER (PARTITION BY response_id) AS copies FROM feed_clean""",
    "feed_silver": "SELECT * EXCLUDE (rn), CAST(copies > 1 AS BOOLEAN) AS duplicate_flag FROM feed_ranked WHERE rn = 1",
    "landed": """
SELECT s.*, 1 + coalesce(n, 0) AS copies FROM silver s LEFT JOIN (SELECT response_id, count(*) AS n FROM feed GROUP BY 1) f ON f.response_id = s.response_id""",
    "wb_silver": f"""
SELECT {initcap(blank('country'))} AS country, upper(trim(country_code)) AS country_code, CAST(year AS INT) AS year,
  CASE WHEN country_code = 'N7' THEN NULL ELSE CAST(population AS BIGINT) END AS population, indicator,
  CAST(NULL AS VARCHAR) AS obs_status, CAST(NULL AS VARCHAR) AS unit, CAST(0 AS BIGINT) AS decimal FROM wb""",
    "cref_silver": f"""
SELECT {blank('country_name')} AS country_name, {blank('official_name')} AS official_name, {initcap(blank('region'))} AS region,
  {initcap(blank('subregion'))} AS subregion, population, area FROM cref""",
    "latest_pop": """
SELECT lower(country) AS ck, year, population FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(country) ORDER BY year DESC) AS rn FROM wb_silver WHERE population IS NOT NULL
) WHERE rn = 1""",
    "places": f"""
SELECT country, region, count(*) AS total, {flag("lower(completion_status) = 'completed'")} AS done,
  {flag("lower(completion_status) <> 'completed'")} AS undone FROM silver GROUP BY country, region""",
    "kpis": f"""
SELECT p.country, p.region, c.subregion, p.total AS total_responses, p.done AS completed_responses, p.undone AS incomplete_responses,
  {ratio('p.done', 'p.total')} AS completion_rate, p.done AS valid_responses, p.undone AS invalid_responses,
  CAST(0 AS BIGINT) AS duplicate_responses, l.population AS country_population,
  {ratio('p.total', 'l.population', 1000000)} AS response_rate_per_million
FROM places p LEFT JOIN cref_silver c ON lower(p.country) = lower(c.country_name) LEFT JOIN latest_pop l ON lower(p.country) = l.ck""",
    "demographics": f"""
SELECT *, {ratio('response_count', 'total')} AS percentage_of_total FROM (
  SELECT country, region, gender,
    CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
         WHEN age < 55 THEN '45-54' ELSE '55+' END AS age_group,
    education_level, employment_status, count(*) AS response_count, (SELECT count(*) FROM silver) AS total
  FROM silver GROUP BY ALL)""",
    "daily": f"""
SELECT CAST(submission_timestamp AS DATE) AS submission_date, country, region, count(*) AS daily_response_count,
  {flag("lower(completion_status) = 'completed'")} AS completed_response_count
FROM silver GROUP BY ALL""",
    "coverage": f"""
SELECT s.country, l.year, l.population, s.n AS total_responses, {ratio('s.n', 'l.population', 1000000)} AS responses_per_million,
  CASE WHEN s.n * 1000000 >= 500 * nullif(l.population, 0) THEN 'Very High' WHEN s.n * 1000000 >= 100 * nullif(l.population, 0) THEN 'High'
       WHEN s.n * 1000000 >= 50 * nullif(l.population, 0) THEN 'Medium' WHEN s.n * 1000000 >= 10 * nullif(l.population, 0) THEN 'Low'
       ELSE 'Very Low' END AS coverage_band
FROM (SELECT country, count(*) AS n FROM silver WHERE lower(completion_status) = 'completed' GROUP BY country) s
LEFT JOIN latest_pop l ON lower(s.country) = l.ck""",
    "profile": f"""
SELECT count(*) AS total, {flag("lower(completion_status) = 'completed'")} AS valid, {flag("lower(completion_status) <> 'completed'")} AS invalid,
  CAST(sum({' + '.join(f'CAST({c} IS NULL AS INT)' for c in ('response_id', 'respondent_id', 'survey_id', 'country', 'region', 'gender', 'age', 'completion_status', 'submission_timestamp', 'silver_processed_at', 'source_system'))}) AS BIGINT) AS missing,
  min(silver_processed_at) AS first_processed, max(silver_processed_at) AS last_processed FROM silver""",
}


def _perception(question: str, mean: str, counts: tuple[str, str, str], index: str, net: bool = True) -> str:
    low, mid, high = counts
    points = f"({flag('s >= 4')} - {flag('s <= 2')})" if net else flag("s >= 4")
    return f"""
SELECT country, region, count(*) AS total_responses, {mean2('s')} AS {mean},
  {flag('s <= 2')} AS {low}, {flag('s = 3')} AS {mid}, {flag('s >= 4')} AS {high}, {ratio(points, 'count(*)')} AS {index}
FROM (SELECT country, region, {question} AS s FROM silver WHERE lower(completion_status) = 'completed')
WHERE s IS NOT NULL GROUP BY country, region"""


def _banded(value: str, cuts: tuple, default: str) -> str:
    whens = " ".join(f"WHEN {value} >= {cut} THEN '{label}'" for cut, label in cuts)
    return f"CASE {whens} ELSE '{default}' END"


QUALITY = ((95, "Excellent"), (85, "Good"), (70, "Fair"))
WORD_SCORE = "CASE lower(q4_corruption) WHEN 'low' THEN 1 WHEN 'medium' THEN 3 WHEN 'high' THEN 5 END"

CTES |= {
    "trust": _perception(
        "q3_trust_govt", "average_trust_score", ("low_trust_count", "medium_trust_count", "high_trust_count"), "trust_index"
    ),
    "democracy": _perception(
        "q1_democracy",
        "average_democracy_score",
        ("negative_perception_count", "neutral_perception_count", "positive_perception_count"),
        "democracy_index",
    ),
    "corruption": f"""
SELECT *, {_banded('average_corruption_score', ((4, 'Very High'), (3, 'High'), (2, 'Medium')), 'Low')} AS corruption_level FROM ({
        _perception(WORD_SCORE, 'average_corruption_score',
                    ('low_corruption_count', 'medium_corruption_count', 'high_corruption_count'), 'corruption_index', net=False)
    })""",
    "fairness": _perception(
        "q5_election_fairness",
        "average_fairness_score",
        ("unfair_election_count", "neutral_election_count", "fair_election_count"),
        "fairness_index",
    ),
    "quality": f"""
SELECT 'survey_responses' AS dataset_name, total AS total_records, valid AS valid_records, invalid AS invalid_records,
  CAST(0 AS BIGINT) AS duplicate_records, missing AS missing_value_count,
  {ratio('(11 * total - missing)', '(11 * total)')} AS completeness_percentage, {ratio('valid', 'total')} AS validity_percentage,
  CAST(100 AS DOUBLE) AS uniqueness_percentage, {_banded(ratio('valid', 'total'), QUALITY, 'Poor')} AS quality_status FROM profile""",
    "reliability": f"""
SELECT 'survey_pipeline' AS pipeline_name, total AS total_records_processed, valid AS valid_records, invalid AS invalid_records,
  CAST(0 AS BIGINT) AS duplicate_records, {ratio('(11 * total - missing)', '(11 * total)')} AS completeness_score,
  {ratio('valid', 'total')} AS validity_score, CAST(100 AS DOUBLE) AS uniqueness_score, overall AS overall_reliability_index,
  {_banded('overall', QUALITY, 'Poor')} AS reliability_status
FROM (SELECT *, {ratio('(11 * total - missing + 11 * valid + 11 * total)', '(33 * total)')} AS overall FROM profile)""",
    "status": f"""
SELECT 'survey_silver_to_gold' AS pipeline_name, CASE WHEN total > 0 THEN 'SUCCESS' ELSE 'FAILED' END AS pipeline_status,
  valid AS successful_jobs, invalid AS failed_jobs, CAST(0 AS BIGINT) AS warning_jobs, {ratio('valid', 'total')} AS overall_health_score FROM profile""",
    "freshness": f"""
SELECT 'survey_responses' AS dataset_name, first_processed AS last_ingestion_timestamp, last_processed AS last_update_timestamp,
  {ratio('age', '3600', 1)} AS freshness_hours,
  CASE WHEN age <= 24 * 3600 THEN 'Fresh' WHEN age <= 72 * 3600 THEN 'Stale' ELSE 'Very Stale' END AS freshness_status,
  'Daily' AS expected_refresh_frequency
FROM (SELECT *, CAST(floor(epoch(TIMESTAMP '2002-01-01 00:00:00')) - floor(epoch(last_processed)) AS BIGINT) AS age FROM profile)""",
    "summary": """
SELECT country, CAST(sum(total) AS BIGINT) AS total_responses, CAST(sum(done) AS BIGINT) AS completed_responses,
  CAST(sum(undone) AS BIGINT) AS incomplete_responses, CAST(sum(done) AS DOUBLE) / CAST(sum(total) AS DOUBLE) * 100 AS completion_rate
FROM places GROUP BY country""",
}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _finding(scope: str, source: str, column: str, category: str, *outcomes: tuple[str, ...]) -> str:
    numeric = "upper" not in outcomes[0][0] and "lower" not in outcomes[0][0]
    value = stable_mean(column) if scope == "business" else column
    shown = "printf('%.2f', v)" if numeric else "upper(v)"

    def pick(read) -> str:
        return "CASE " + " ".join(f"WHEN {outcome[0]} THEN {read(outcome)}" for outcome in outcomes) + " END"

    message = pick(lambda o: f"replace({_text(o[3])}, '{{}}', {shown})" if "{}" in o[3] else _text(o[3]))
    return f"""
SELECT {pick(lambda o: _text(o[1]))} AS severity, {_text(category)} AS category, {pick(lambda o: _text(o[2]))} AS title,
  {message} AS message, {pick(lambda o: _text(o[4]))} AS recommendation, '{scope}' AS scope
FROM (SELECT {value} AS v FROM {source})"""


CTES["civic"] = f"""
SELECT coalesce(a.country, b.country) AS country, a.i AS democracy_index, b.i AS fairness_index
  FROM (SELECT country, {stable_mean('democracy_index')} AS i FROM democracy GROUP BY country) a
  FULL JOIN (SELECT country, {stable_mean('fairness_index')} AS i FROM fairness GROUP BY country) b ON a.country = b.country"""
for _scope in ("business", "platform"):
    CTES[f"{_scope}_findings"] = " UNION ALL ".join(_finding(*check) for check in CHECKS if check[0] == _scope)


def with_ctes(body: str) -> str:
    """Prefix a query with the CTEs it names, directly or through other CTEs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        words = set(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)", text))
        for name, sql in CTES.items():
            if name in words and name not in needed and sql is not text:
                visit(sql)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in needed) + "\n" + body


def _report(source: str, required: list[str], shares: dict, ranges: dict, keys: list[str]) -> str:
    rows = [f"SELECT 'required_column' AS rule, '{c}' AS target, 1.0::DOUBLE AS observed, 1.0::DOUBLE AS allowed, true AS passed" for c in required]
    for column, share in shares.items():
        rows.append(
            f"SELECT 'null_share', '{column}', (count(*) - count({column}))::DOUBLE / count(*), {share}::DOUBLE, "
            f"(count(*) - count({column}))::DOUBLE / count(*) <= {share} FROM {source}"
        )
    for column, (low, high) in ranges.items():
        bad = f"count(*) FILTER (WHERE {column} < {low} OR {column} > {high})"
        rows.append(f"SELECT 'out_of_range', '{column}', {bad}::DOUBLE, 0.0::DOUBLE, {bad} = 0 FROM {source}")
    if keys:
        distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {source}))"
        rows.append(
            f"SELECT 'surplus_keys', '{','.join(keys)}', (count(*) - {distinct})::DOUBLE, 0.0::DOUBLE, count(*) = {distinct} FROM {source}"
        )
    return " UNION ALL ".join(rows)


SURVEY_REPORT = _report(
    "silver",
    ["response_id", "country", "gender", "age"],
    {"response_id": 0.0, "country": 0.05, "gender": 0.10, "age": 0.15},
    {"age": (18, 100)},
    ["response_id"],
)
FEED_REPORT = SURVEY_REPORT.replace("FROM silver", "FROM feed_clean")
POPULATION_REPORT = _report(
    "wb_silver",
    ["country", "country_code", "year", "population"],
    {"country": 0.0, "year": 0.0, "population": 0.10},
    {"year": (1960, 2100), "population": (0, 10_000_000_000)},
    ["country", "year", "indicator"],
)
COUNTRY_REPORT = _report(
    "cref_silver",
    ["country_name", "region", "population"],
    {"country_name": 0.0, "region": 0.10, "population": 0.10},
    {"population": (0, 10_000_000_000), "area": (0, 20_000_000)},
    [],
)
CORRUPTION_LEVELS = f"""
SELECT country, region, CAST(total AS BIGINT) AS total_responses, corruption_level, n AS corruption_response_count,
  {ratio('n', 'total')} AS corruption_percentage, {ratio('high', 'total')} AS corruption_index
FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY country, region) AS BIGINT) AS total,
        CAST(sum(CASE WHEN lower(corruption_level) = 'high' THEN n ELSE 0 END) OVER (PARTITION BY country, region) AS BIGINT) AS high
      FROM (SELECT country, region, q4_corruption AS corruption_level, count(*) AS n FROM silver
            WHERE lower(completion_status) = 'completed' AND q4_corruption IS NOT NULL GROUP BY ALL))"""
TRENDS = """
SELECT submission_date, country, region, daily_response_count, completed_response_count, CAST(0 AS BIGINT) AS duplicate_response_count,
  completed_response_count AS valid_response_count,
  CAST(sum(daily_response_count) OVER (PARTITION BY country ORDER BY submission_date, region NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT)
    AS cumulative_response_count
FROM daily"""
FEED_KPIS = f"""
SELECT p.country, p.region, c.subregion, p.total AS total_responses, p.done AS completed_responses, p.undone AS incomplete_responses,
  {ratio('p.done', 'p.total')} AS completion_rate, p.done AS valid_responses, p.undone AS invalid_responses,
  p.dup AS duplicate_responses, l.population AS country_population,
  {ratio('p.total', 'l.population', 1000000)} AS response_rate_per_million
FROM (SELECT country, region, count(*) AS total, {flag("lower(completion_status) = 'completed'")} AS done,
        {flag("lower(completion_status) <> 'completed'")} AS undone, CAST(sum(copies - 1) AS BIGINT) AS dup
      FROM feed_silver GROUP BY country, region) p
LEFT JOIN cref_silver c ON lower(p.country) = lower(c.country_name) LEFT JOIN latest_pop l ON lower(p.country) = l.ck"""
COUNTRY_KPIS = f"""
SELECT p.country, c.subregion, p.total AS total_responses, p.done AS completed_responses, p.undone AS incomplete_responses,
  {ratio('p.done', 'p.total')} AS completion_rate, p.done AS valid_responses, p.undone AS invalid_responses,
  CAST(0 AS BIGINT) AS duplicate_responses, l.population AS country_population,
  {ratio('p.total', 'l.population', 1000000)} AS response_rate_per_million
FROM (SELECT country, CAST(sum(total) AS BIGINT) AS total, CAST(sum(done) AS BIGINT) AS done, CAST(sum(undone) AS BIGINT) AS undone FROM places GROUP BY country) p
LEFT JOIN cref_silver c ON lower(p.country) = lower(c.country_name) LEFT JOIN latest_pop l ON lower(p.country) = l.ck"""
TRACKED = "response_id respondent_id survey_id country region gender age completion_status submission_timestamp silver_processed_at source_system".split()
QUALITY_BY_COUNTRY = f"""
SELECT country, 'survey_responses' AS dataset_name, completeness_score, duplicate_rate, null_percentage,
  CASE WHEN failed = '' THEN 'passed' ELSE 'failed' END AS validation_status, failed AS failed_checks
FROM (SELECT *, concat_ws(',', CASE WHEN completeness_score < 95 THEN 'completeness' END, CASE WHEN duplicate_rate > 0 THEN 'duplicates' END,
        CASE WHEN validity < 70 THEN 'validity' END) AS failed
      FROM (SELECT country, {ratio('(11 * n - m)', '(11 * n)')} AS completeness_score, {ratio('(n - k)', 'n')} AS duplicate_rate,
              {ratio('m', '(11 * n)')} AS null_percentage, {ratio('v', 'n')} AS validity
            FROM (SELECT country, count(*) AS n, count(DISTINCT response_id) AS k, {flag("lower(completion_status) = 'completed'")} AS v,
                    CAST(sum({' + '.join(f'CAST({c} IS NULL AS INT)' for c in TRACKED)}) AS BIGINT) AS m
                  FROM feed_clean GROUP BY country)))"""
CONTRACT_ERRORS = """
SELECT concat_ws(',', CASE WHEN gender IS NULL THEN 'gender: required' END,
  CASE WHEN completion_status IS NULL THEN 'completion_status: required' END,
  CASE WHEN try_cast(q4_corruption AS INT) IS NULL AND q4_corruption IS NOT NULL THEN 'q4_corruption: not a integer' END) AS errors, count(*) AS n
FROM survey_raw GROUP BY 1"""
STATE = "CASE event_type WHEN 'signup' THEN 'running' WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'other' END"
LEVEL = "CASE status WHEN 'skipped' THEN 'warning' WHEN 'failed' THEN 'error' ELSE 'info' END"


def _top(source: str, score: str, columns: str = "*", descending: bool = True) -> str:
    order = "DESC" if descending else "ASC"
    return (
        f"SELECT {columns} FROM {source} WHERE country IS NOT NULL AND {score} IS NOT NULL ORDER BY {score} {order}, country LIMIT 10"
    )


def _means(source: str, score: str) -> str:
    return f"(SELECT country, {stable_mean(score)} AS {score} FROM {source} WHERE country IS NOT NULL AND {score} IS NOT NULL GROUP BY country)"


def _ranking(source: str, score: str) -> str:
    return f"""
SELECT country, {score}, CAST(row_number() OVER (ORDER BY {score} DESC, country) AS INT) AS rank FROM (SELECT * FROM {source})
WHERE country IS NOT NULL AND {score} IS NOT NULL"""


def _unpivot(source: str, names: dict[str, str], value: str = "score", kind: str = "DOUBLE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS metric, CAST({column} AS {kind}) AS {value} FROM {source}" for column, label in names.items()
    )


AGE_GROUP = (
    "CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' "
    "WHEN age < 55 THEN '45-54' ELSE '55+' END"
)
SILVER_JOB = f"""
SELECT s.* EXCLUDE (copies, silver_processed_at), TIMESTAMP '2002-01-01' AS silver_processed_at, copies > 1 AS duplicate_flag, w.country_code,
  CAST(submission_timestamp AS DATE) AS submission_date, {AGE_GROUP} AS age_group,
  CASE WHEN response_id IS NOT NULL AND s.country IS NOT NULL AND gender IS NOT NULL AND age IS NOT NULL THEN 'valid' ELSE 'invalid' END AS validation_status
FROM landed s LEFT JOIN (SELECT lower(country) AS ck, max(country_code) AS country_code FROM wb_silver GROUP BY 1) w ON lower(s.country) = w.ck"""

BODIES: dict[str, str] = {
    "clean_survey": "SELECT * EXCLUDE (silver_processed_at) FROM silver",
    "clean_population": "SELECT * FROM wb_silver",
    "clean_country_ref": "SELECT * FROM cref_silver",
    "rename_snake_case": "SELECT c_custkey AS customer_id, c_name AS full_name, c_nationkey AS nation_key, c_acctbal AS acct_bal_2, c_mktsegment AS market_segment FROM customer",
    "load_table_cleaning": "SELECT * EXCLUDE (c_mktsegment, c_nationkey), c_mktsegment AS market_segment, c_nationkey AS nation_key FROM customer",
    "exact_dedup": "SELECT DISTINCT * EXCLUDE (silver_processed_at), silver_processed_at FROM feed_clean",
    "dedup_by_key": "SELECT * EXCLUDE (rn, copies, silver_processed_at) FROM feed_ranked WHERE rn = 1",
    "keep_latest": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
  l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1""",
    "merge_copies": "SELECT response_id, q3_trust_govt, loaded_at, copies, duplicate_flag FROM feed_silver",
    "validate_survey": SURVEY_REPORT,
    "validate_survey_feed": FEED_REPORT,
    "validate_population": POPULATION_REPORT,
    "validate_country_ref": COUNTRY_REPORT,
    "validation_pass_rate": f"""
SELECT count(*) AS rules, CAST(sum(CAST(passed AS INT)) AS BIGINT) AS rules_passed, CAST(sum(CAST(passed AS INT)) AS DOUBLE) / count(*) AS pass_rate,
  CAST(sum(CAST(passed AS INT)) AS DOUBLE) / count(*) >= 0.95 AS meets_threshold FROM ({FEED_REPORT})""",
    "contract_check": CONTRACT_ERRORS,
    "contract_conform": """
SELECT response_id, respondent_id, survey_id, country, region, gender, CAST(age AS INT) AS age, education_level, employment_status, completion_status,
  submission_timestamp, source_system, q1_democracy, q2_economy, q3_trust_govt, q4_corruption, q5_election_fairness FROM survey_raw""",
    "contract_rejects": """
SELECT response_id, concat_ws(',', CASE WHEN gender IS NULL THEN 'gender: required' END,
  CASE WHEN completion_status IS NULL THEN 'completion_status: required' END) AS errors FROM survey_raw WHERE gender IS NULL OR completion_status IS NULL""",
    "declared_silver": f"""
SELECT s.response_id, respondent_id, survey_id, s.country, w.country_code, region, gender, age, {AGE_GROUP} AS age_group, education_level, employment_status,
  q1_democracy, q2_economy, q3_trust_govt, q4_corruption, q5_election_fairness, completion_status, CAST(s.submission_timestamp AS DATE) AS submission_date,
  submission_timestamp, loaded_at AS ingestion_timestamp, s.duplicate_flag,
  CASE WHEN s.response_id IS NOT NULL AND s.country IS NOT NULL AND s.gender IS NOT NULL AND s.age IS NOT NULL THEN 'valid' ELSE 'invalid' END AS validation_status, source_system
FROM feed_silver s LEFT JOIN (SELECT lower(country) AS ck, max(country_code) AS country_code FROM wb_silver GROUP BY 1) w ON lower(s.country) = w.ck""",
    "silver_enriched": f"""
SELECT s.response_id, s.country, w.country_code, CAST(s.submission_timestamp AS DATE) AS submission_date, {AGE_GROUP} AS age_group,
  s.duplicate_flag, CASE WHEN s.response_id IS NOT NULL AND s.country IS NOT NULL AND s.gender IS NOT NULL AND s.age IS NOT NULL THEN 'valid' ELSE 'invalid' END AS validation_status
FROM feed_silver s LEFT JOIN (SELECT lower(country) AS ck, max(country_code) AS country_code FROM wb_silver GROUP BY 1) w ON lower(s.country) = w.ck""",
    "country_aliases": """
SELECT coalesce(r.r_name, s.country) AS country, count(*) AS responses FROM silver s
LEFT JOIN (SELECT lower(n_name) AS a, max(r_name) AS r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 0 GROUP BY 1) r ON lower(s.country) = r.a
GROUP BY 1""",
    "country_survey_kpis": "SELECT * FROM kpis",
    "country_survey_kpis_by_country": COUNTRY_KPIS,
    "survey_feed_to_kpis": FEED_KPIS,
    "demographic_distribution": "SELECT * EXCLUDE (total) FROM demographics",
    "response_volume_trends": TRENDS,
    "governance_trust": "SELECT * FROM trust",
    "democracy_perception": "SELECT * FROM democracy",
    "corruption_perception": "SELECT * FROM corruption",
    "corruption_perception_numbers_only": f"""
SELECT country, region, count(*) AS total_responses, CAST(NULL AS DOUBLE) AS average_corruption_score, CAST(0 AS BIGINT) AS low_corruption_count,
  CAST(0 AS BIGINT) AS medium_corruption_count, CAST(0 AS BIGINT) AS high_corruption_count, CAST(0 AS DOUBLE) AS corruption_index, 'Low' AS corruption_level
FROM silver WHERE lower(completion_status) = 'completed' AND q4_corruption IS NOT NULL GROUP BY country, region""",
    "corruption_distribution": CORRUPTION_LEVELS,
    "election_fairness": "SELECT * FROM fairness",
    "population_coverage": "SELECT * FROM coverage",
    "place_rollup_trust": "SELECT * FROM trust",
    "place_rollup_kpis": "SELECT * FROM kpis",
    "place_rollup_coverage": "SELECT * FROM coverage",
    "data_quality_summary": "SELECT * FROM quality",
    "reliability_index": "SELECT * FROM reliability",
    "job_runtime": f"""
SELECT 'survey_silver_to_gold' AS pipeline_name, CAST(s AS DOUBLE) AS runtime_seconds, {ratio('s', '60', 1)} AS runtime_minutes, 'SUCCESS' AS status, total AS records_processed
FROM (SELECT total, CAST(floor(epoch(last_processed)) - floor(epoch(first_processed)) AS BIGINT) AS s FROM profile)""",
    "job_status": "SELECT * FROM status",
    "data_freshness": "SELECT * FROM freshness",
    "freshness_by_country": f"""
SELECT country, f AS last_ingestion_timestamp, l AS last_update_timestamp, {ratio('a', '3600', 1)} AS freshness_hours,
  CASE WHEN a <= 24 * 3600 THEN 'Fresh' WHEN a <= 72 * 3600 THEN 'Stale' ELSE 'Very Stale' END AS freshness_status, 'Daily' AS expected_refresh_frequency,
  {ratio('a', '60', 1)} AS freshness_minutes, last_submission
FROM (SELECT *, CAST(floor(epoch(TIMESTAMP '2002-01-01 00:00:00')) - floor(epoch(l)) AS BIGINT) AS a FROM (
  SELECT country, min(silver_processed_at) AS f, max(silver_processed_at) AS l, max(submission_timestamp) AS last_submission FROM silver GROUP BY country))""",
    "dq_by_country": QUALITY_BY_COUNTRY,
    "cleaning_reduction": f"""
SELECT b AS rows_before, a AS rows_after, b - a AS duplicates_removed, {ratio('(b - a)', 'b')} AS cleaning_reduction_percentage
FROM (SELECT count(*) AS b, count(DISTINCT response_id) AS a FROM feed)""",
    "country_summary": "SELECT * FROM summary",
    "business_kpis": f"""
SELECT CAST(sum(total_responses) AS BIGINT) AS total_responses, count(DISTINCT country) AS countries_covered, {stable_mean('completion_rate')} AS average_completion_rate,
  (SELECT {stable_mean('average_trust_score')} FROM trust) AS average_governance_trust_score FROM kpis""",
    "business_kpi_texts": f"""
SELECT format('{{:,}}', CAST(sum(total_responses) AS BIGINT)) AS total_responses, CAST(count(DISTINCT country) AS VARCHAR) AS countries_covered,
  printf('%.2f', {stable_mean('completion_rate')}) || '%' AS average_completion_rate,
  (SELECT printf('%.2f', {stable_mean('average_trust_score')}) FROM trust) AS average_governance_trust_score FROM kpis""",
    "platform_kpis": """
SELECT pipeline_status, (SELECT quality_status FROM quality) AS quality_status,
  (SELECT printf('%.2f', overall_reliability_index) || '%' FROM reliability) AS reliability_index, (SELECT freshness_status FROM freshness) AS freshness_status FROM status""",
    "country_mean_trust": f"SELECT * FROM {_means('trust', 'average_trust_score')}",
    "country_mean_democracy": f"SELECT * FROM {_means('democracy', 'average_democracy_score')}",
    "country_mean_fairness": f"SELECT * FROM {_means('fairness', 'average_fairness_score')}",
    "gender_split": "SELECT gender, count(*) AS response_count FROM silver WHERE gender IS NOT NULL GROUP BY gender",
    "quality_scores_long": _unpivot(
        "quality",
        {"completeness_percentage": "Completeness", "validity_percentage": "Validity", "uniqueness_percentage": "Uniqueness"},
    ),
    "record_breakdown": _unpivot(
        "quality",
        {"valid_records": "Valid Records", "invalid_records": "Invalid Records", "duplicate_records": "Duplicate Records"},
        "records",
        "BIGINT",
    ),
    "job_health": _unpivot(
        "status",
        {"successful_jobs": "Successful Jobs", "failed_jobs": "Failed Jobs", "warning_jobs": "Warning Jobs"},
        "jobs",
        "BIGINT",
    ),
    "reliability_breakdown": _unpivot(
        "reliability",
        {
            "completeness_score": "Completeness",
            "validity_score": "Validity",
            "uniqueness_score": "Uniqueness",
            "overall_reliability_index": "Overall Reliability",
        },
    ),
    "civic_comparison": """
SELECT country, 'democracy_index' AS metric, democracy_index AS score FROM civic UNION ALL SELECT country, 'fairness_index', fairness_index FROM civic""",
    "business_findings": "SELECT * EXCLUDE (scope) FROM business_findings",
    "platform_findings": "SELECT * EXCLUDE (scope) FROM platform_findings",
    "report_findings": "SELECT * FROM business_findings UNION ALL SELECT * FROM platform_findings",
    "risk_summary": f"""
SELECT h AS high_risk_count, m AS medium_risk_count, l AS low_risk_count, n AS total_findings,
  CASE WHEN h > 0 THEN {_text(HEADLINES['High'])} WHEN m > 0 THEN {_text(HEADLINES['Medium'])} ELSE {_text(HEADLINES['Low'])} END AS headline
FROM (SELECT {flag("severity = 'High'")} AS h, {flag("severity = 'Medium'")} AS m, {flag("severity = 'Low'")} AS l, count(*) AS n
  FROM (SELECT severity FROM business_findings UNION ALL SELECT severity FROM platform_findings))""",
    "top10_responses": _top("summary", "total_responses"),
    "bottom10_completion": _top("summary", "completion_rate", descending=False),
    "top10_coverage": _top("coverage", "responses_per_million"),
    "top10_trust": _top(_means("trust", "average_trust_score"), "average_trust_score"),
    "top10_democracy": _top(_means("democracy", "average_democracy_score"), "average_democracy_score"),
    "top10_fairness": _top(_means("fairness", "average_fairness_score"), "average_fairness_score"),
    "coverage_map": "SELECT country, total_responses, population, responses_per_million FROM coverage",
    "union_sources": """
SELECT source_table, count(*) AS row_count, count(country) AS with_country, count(year) AS with_year FROM (
  SELECT 'survey' AS source_table, country, CAST(NULL AS INT) AS year FROM survey_raw
  UNION ALL SELECT 'population', country, year FROM wb UNION ALL SELECT 'reference', CAST(NULL AS VARCHAR), CAST(NULL AS INT) FROM cref) GROUP BY source_table""",
    "new_files": """
SELECT f.file_name, f.file_hash FROM (SELECT url AS file_name, sha256(html) AS file_hash FROM pages) f
WHERE NOT EXISTS (SELECT 1 FROM (SELECT url AS file_name, CASE WHEN length(html) > 5000 THEN sha256(html) ELSE sha256(url) END AS file_hash,
  CASE WHEN contains(url, '.com') THEN 'failed' ELSE 'processed' END AS processing_status FROM pages) p
  WHERE p.file_name = f.file_name AND p.file_hash = f.file_hash AND p.processing_status = 'processed')""",
    "insert_if_absent": """
SELECT doc_id, max(lang) AS lang, max(source) AS source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""",
    "match_country": """
SELECT c_custkey, coalesce(m, 'unknown') AS country FROM (
  SELECT c_custkey, first(n_name ORDER BY length(n_name) DESC, n_nationkey) AS m FROM (
    SELECT c_custkey, n2.n_name, n2.n_nationkey
    FROM (SELECT c_custkey, 'raw/' || lower(n1.n_name) || '_' || lower(c_mktsegment) || '/batch_' || c_custkey || '.csv' AS path FROM customer JOIN nation n1 ON c_nationkey = n1.n_nationkey) f
    LEFT JOIN nation n2 ON contains(f.path, lower(n2.n_name))) GROUP BY c_custkey)""",
    "match_country_list_order": """
SELECT c_custkey, coalesce(m, 'unknown') AS country FROM (
  SELECT c_custkey, first(n_name ORDER BY n_nationkey) AS m FROM (
    SELECT c_custkey, n2.n_name, n2.n_nationkey
    FROM (SELECT c_custkey, 'raw/' || lower(n1.n_name) || '_' || lower(c_mktsegment) || '/batch_' || c_custkey || '.csv' AS path FROM customer JOIN nation n1 ON c_nationkey = n1.n_nationkey) f
    LEFT JOIN nation n2 ON contains(f.path, lower(n2.n_name))) GROUP BY c_custkey)""",
    "match_country_file_name": """
SELECT c_custkey, first(r_name ORDER BY r_regionkey) AS region_name FROM (
  SELECT f.c_custkey, r.r_name, r.r_regionkey FROM (
    SELECT c_custkey, lower(r_name) || '_' || lower(c_mktsegment) AS name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) f
  LEFT JOIN region r ON contains(f.name, lower(r.r_name)) OR contains(f.name, lower(substr(r.r_name, 1, 2)))) GROUP BY c_custkey""",
    "csv_records": "SELECT doc_id, text FROM documents",
    "file_hashes": """
SELECT coalesce(source, 'none') AS source, doc_id // 1000 AS block, CAST(3 AS BIGINT) AS files, true AS copy_alike,
  list(coalesce(text, '') ORDER BY doc_id) = list(coalesce(text, '') ORDER BY doc_id DESC) AS turned_alike
FROM documents GROUP BY 1, 2""",
    "file_fingerprint": "SELECT doc_id, sha256(text) AS file_hash, md5(text) AS file_md5 FROM documents",
    "file_names": """
SELECT page_id, regexp_extract(url, '[^/]*$') AS file_name, lower(replace(regexp_extract(url, '[^/]*$'), ' ', '_')) AS clean_name,
  lower(regexp_extract(regexp_extract(url, '[^/]*$'), '.(\\.[^.]+)$', 1)) AS extension FROM pages""",
    "extension_check": """
SELECT page_id, path, CASE WHEN e NOT IN ('.html', '.htm', '') THEN 'extension not allowed: ' || e END AS reject_reason FROM (
  SELECT *, lower(regexp_extract(regexp_extract(path, '[^/]*$'), '.(\\.[^.]+)$', 1)) AS e FROM (SELECT page_id, url AS path FROM pages))""",
    "load_count_check": """
SELECT 2 * count(*) AS rows_sent, (SELECT count(*) FROM (SELECT DISTINCT * FROM feed)) AS rows_loaded,
  2 * count(*) = (SELECT count(*) FROM (SELECT DISTINCT * FROM feed)) AS complete FROM feed""",
    "ingest_round_trip": """
SELECT s.* EXCLUDE (silver_processed_at), lower(s.country) AS path_country, '2024' AS path_year, '05' AS path_month, '01' AS path_day FROM silver s""",
    "silver_job": SILVER_JOB,
    "silver_increment": SILVER_JOB,
    "gold_increment_kpis": "SELECT * FROM kpis",
    "gold_increment_trends": TRENDS,
    "gold_increment_quality": "SELECT * FROM quality",
    "table_fingerprints": """
SELECT variant, n * times AS rows, same FROM (SELECT count(*) AS n FROM survey_raw), (VALUES ('again', 1, true), ('other layout', 1, true),
  ('moved', 1, false), ('swapped', 1, false), ('one null more', 1, false), ('twice', 2, false)) v(variant, times, same)""",
    "silver_rejects": """
SELECT response_id, concat_ws(',', CASE WHEN gender IS NULL THEN 'gender: required' END,
  CASE WHEN completion_status IS NULL THEN 'completion_status: required' END) AS errors, count(*) AS n
FROM (SELECT response_id, gender, completion_status FROM survey_raw UNION ALL SELECT response_id, gender, completion_status FROM feed)
WHERE gender IS NULL OR completion_status IS NULL GROUP BY 1, 2""",
    "silver_quality": f"""
SELECT country, 'survey_responses' AS dataset_name, completeness_score, duplicate_rate, null_percentage,
  CASE WHEN failed = '' THEN 'passed' ELSE 'failed' END AS validation_status, failed AS failed_checks
FROM (SELECT *, concat_ws(',', CASE WHEN completeness_score < 95 THEN 'completeness' END, CASE WHEN duplicate_rate > 0 THEN 'duplicates' END,
        CASE WHEN validity < 70 THEN 'validity' END) AS failed
      FROM (SELECT country, {ratio('(11 * n - m)', '(11 * n)')} AS completeness_score, {ratio('(a - n)', 'a')} AS duplicate_rate,
              {ratio('m', '(11 * n)')} AS null_percentage, {ratio('v', 'n')} AS validity
            FROM (SELECT country, count(*) AS n, CAST(sum(copies) AS BIGINT) AS a, {flag("lower(completion_status) = 'completed'")} AS v,
                    CAST(sum({' + '.join(f'CAST({c} IS NULL AS INT)' for c in TRACKED)}) AS BIGINT) AS m
                  FROM landed GROUP BY country)))""",
    "gold_job_kpis": "SELECT * FROM kpis",
    "gold_job_trends": TRENDS,
    "gold_job_corruption_levels": CORRUPTION_LEVELS,
    "gold_job_quality": "SELECT * FROM quality",
    "gold_job_keys": """
SELECT 'response_volume_trends_gold' AS dataset_name, 'submission_date,country,region' AS key, count(*) AS rows,
  CAST(0 AS BIGINT) AS null_keys, CAST(0 AS BIGINT) AS repeated_keys FROM daily
UNION ALL SELECT 'country_survey_kpis_gold', 'country,region', count(*), 0, 0 FROM kpis
UNION ALL SELECT 'corruption_levels_gold', 'country,region,corruption_level', count(*), 0, 0
  FROM (SELECT DISTINCT country, region, q4_corruption FROM silver WHERE lower(completion_status) = 'completed')
UNION ALL SELECT 'population_coverage_gold', 'country', count(*), 0, 0 FROM coverage""",
    "job_sources": """
SELECT 'csv' AS source_system, count(*) AS rows_loaded FROM survey_raw UNION ALL SELECT 'postgres_operational', count(*) FROM feed
UNION ALL SELECT 'world_bank', count(*) FROM wb UNION ALL SELECT 'restcountries', count(*) FROM cref""",
    "silver_population": "SELECT country, country_code, year, population, indicator FROM wb_silver",
    "dedup_population": "SELECT * FROM wb_silver",
    "dedup_countries": "SELECT * FROM cref_silver",
    "drop_key_copies": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1""",
    "ranking_responses": _ranking("summary", "total_responses"),
    "ranking_trust": _ranking(_means("trust", "average_trust_score"), "average_trust_score"),
    "ranking_corruption": _ranking(_means("corruption", "average_corruption_score"), "average_corruption_score"),
    "bronze_layout": f"""
SELECT lower(nullif(trim(country), '')) AS country, strftime(submission_timestamp, '%Y') AS year, strftime(submission_timestamp, '%m') AS month,
  strftime(submission_timestamp, '%d') AS day, source_system, count(*) AS rows_landed FROM survey_raw GROUP BY ALL""",
    "normalise_world_bank": """
SELECT n AS country, upper(country_code) AS country_code, CAST(year AS INT) AS year, CAST(population AS BIGINT) AS population, indicator, 'world_bank' AS source_system
FROM (SELECT ' ' || lower(country) AS n, lower(country_code) || ' ' AS cc, * FROM wb)""",
    "file_outcomes": """
SELECT nation, CASE k WHEN 0 THEN 'ready' ELSE 'failed' END AS status,
  CASE k WHEN 1 THEN 'missing columns: survey_id,gender' WHEN 2 THEN 'extension not allowed: .txt' END AS reason,
  CASE WHEN k < 2 THEN count(*) END AS rows_loaded
FROM (SELECT nation, (length(nation) + ascii(reverse(nation))) % 3 AS k FROM (SELECT coalesce(lower(trim(country)), 'none') AS nation FROM survey_raw))
GROUP BY nation, k""",
    "table_outcomes": """
SELECT attempt, status, CASE WHEN status = 'success' THEN n ELSE 0 END AS rows_processed, error_message
FROM (SELECT count(*) AS n FROM survey_raw), (VALUES ('first', 'success', NULL), ('again', 'skipped', NULL),
  ('lacking', 'failed', 'missing columns: survey_id,gender'), ('empty', 'failed', 'empty table'), ('changed', 'success', NULL)
) t(attempt, status, error_message)""",
    "snapshot_round_trip": "SELECT * FROM survey_raw",
    "kept_answers": """
SELECT upper(country_code) AS country_code, CAST(year AS INT) AS year,
  CAST(CASE WHEN country_code = 'N7' THEN -population ELSE population END AS BIGINT) AS population, TRUE AS same FROM wb""",
    "marked_trust": """
SELECT *, 'silver' AS source_layer, 'gold' AS target_layer, TIMESTAMP '2002-01-01 00:00:00' AS gold_processed_at FROM trust""",
    "silver_views": """
SELECT s.country, s.responses, c.population AS listed, p.years FROM (SELECT country, count(*) AS responses FROM silver GROUP BY country) s
LEFT JOIN cref_silver c ON lower(s.country) = lower(c.country_name)
LEFT JOIN (SELECT country, count(*) AS years FROM wb_silver GROUP BY country) p ON s.country = p.country""",
    "answer_drift": """
SELECT upper(country_code) AS country_code, CASE CAST(substr(country_code, 2) AS INT) % 4 WHEN 1 THEN 'lacks year' WHEN 2 THEN 'lacks country_code'
  WHEN 3 THEN 'lacks country, population' END AS reject_reason, count(*) AS records FROM wb GROUP BY 1, 2""",
    "normalise_countries": "SELECT country_name AS country, CAST(NULL AS VARCHAR) AS country_code, lower(region) AS region, ' ' || subregion AS subregion, population, area, 'restcountries' AS source_system FROM cref",
    "event_payloads": "SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "run_ledger_latest": f"""
SELECT run_id, start_time, CASE WHEN status <> 'running' THEN last_time END AS end_time,
  CASE WHEN status <> 'running' THEN (epoch_us(last_time) - epoch_us(start_time)) / 1000000.0::DOUBLE END AS duration_seconds, status, rows_processed, {LEVEL} AS log_level, events
FROM (SELECT CAST(user_id AS VARCHAR) AS run_id, min(ts) AS start_time, max(ts) AS last_time, count(*) AS events,
        last({STATE} ORDER BY ts, event_id) AS status, last(CAST(floor(value) AS BIGINT) ORDER BY ts, event_id) AS rows_processed FROM events GROUP BY user_id)""",
    "event_levels": f"""
SELECT event_id, status, {LEVEL} AS log_level, status IN ('success', 'failed', 'running', 'skipped') AS valid_status FROM (SELECT event_id, {STATE} AS status FROM events)""",
    "incremental_state": """
SELECT event_type || '/' || user_id AS source_key, CAST(max(ts) AS DATE) AS last_successful_date, max(ts) AS last_ingestion_ts,
  last(CAST(event_id AS VARCHAR) ORDER BY ts, CAST(event_id AS VARCHAR)) AS last_run_id, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS rows_processed_total
FROM events WHERE event_type <> 'error' GROUP BY event_type, user_id""",
    "incremental_new_rows": """
SELECT e.event_id FROM events e LEFT JOIN (SELECT user_id, max(ts) AS mark FROM events WHERE event_type = 'purchase' GROUP BY user_id) m ON e.user_id = m.user_id
WHERE e.event_type <> 'purchase' AND (m.mark IS NULL OR e.ts >= m.mark)""",
    "stream_ingest": "SELECT * EXCLUDE (silver_processed_at) FROM silver",
    "stream_dedup": "SELECT DISTINCT response_id, submission_timestamp, country FROM feed_clean",
    "stream_daily_upkeep": "SELECT submission_date, country, region, daily_response_count, completed_response_count FROM daily",
    "stream_daily_volume": """
SELECT submission_date, country, region, daily_response_count, completed_response_count FROM daily
WHERE submission_date + INTERVAL 1 DAY <= (SELECT max(submission_timestamp) FROM silver) - INTERVAL 2 DAY""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in BODIES.items()}
