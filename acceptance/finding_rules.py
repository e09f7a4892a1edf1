"""What the findings must say, stated for the oracle apart from the library.

Per check: scope, table, column, category, then its outcomes in order of their
test, each with the SQL condition on the metric ``v`` (the last one takes the
rest), severity, title, message with the metric's place, and recommendation.
"""

# Conditions and texts of the report's findings.
CHECKS = (
    ("business", "kpis", "completion_rate", "Survey Participation",
     ("v < 70", "High", "Low Average Completion Rate",
      "The average survey completion rate is {}%, which is below the recommended 70% threshold.",
      "Review survey length, respondent experience, and possible technical barriers affecting completion."),
     ("v < 85", "Medium", "Moderate Completion Rate",
      "The average survey completion rate is {}%. This is acceptable but still has room for improvement.",
      "Monitor completion trends and identify countries or regions with lower participation quality."),
     ("true", "Low", "Strong Completion Rate",
      "The average survey completion rate is {}%, indicating strong respondent completion behavior.",
      "Maintain current survey design and continue monitoring for regional variation.")),
    ("business", "trust", "average_trust_score", "Governance Trust",
     ("v < 2.5", "High", "Low Governance Trust",
      "The average governance trust score is {}, suggesting weak public confidence.",
      "Prioritize deeper review of countries and regions with the lowest trust scores."),
     ("v < 3.5", "Medium", "Moderate Governance Trust",
      "The average governance trust score is {}, indicating mixed citizen sentiment.",
      "Track trust indicators over time and compare with democracy and corruption perception metrics."),
     ("true", "Low", "Healthy Governance Trust",
      "The average governance trust score is {}, indicating relatively positive public trust.",
      "Maintain monitoring and investigate regional differences behind the aggregate score.")),
    ("business", "democracy", "democracy_index", "Democracy Perception",
     ("v < 40", "High", "Weak Democracy Perception",
      "The average democracy index is {}%, indicating weak perception of democratic quality.",
      "Identify the countries with the weakest democracy index and compare with governance trust and election fairness metrics."),
     ("v < 60", "Medium", "Moderate Democracy Perception",
      "The average democracy index is {}%, suggesting mixed perceptions of democratic performance.",
      "Monitor democracy perception trends and investigate countries with declining sentiment."),
     ("true", "Low", "Positive Democracy Perception",
      "The average democracy index is {}%, suggesting generally positive democratic perception.",
      "Continue monitoring democracy perception alongside election fairness and governance trust.")),
    ("business", "corruption", "corruption_index", "Corruption Perception",
     ("v >= 70", "High", "High Corruption Perception",
      "The average corruption perception index is {}%, indicating elevated perceived corruption.",
      "Prioritize deeper investigation into countries and regions with the highest corruption perception levels."),
     ("v >= 40", "Medium", "Moderate Corruption Perception",
      "The average corruption perception index is {}%, suggesting corruption perception requires monitoring.",
      "Compare corruption perception with trust and democracy scores to identify possible governance risk clusters."),
     ("true", "Low", "Low Corruption Perception",
      "The average corruption perception index is {}%, suggesting relatively lower perceived corruption.",
      "Maintain periodic monitoring and watch for regional spikes.")),
    ("business", "fairness", "fairness_index", "Election Fairness",
     ("v < 40", "High", "Low Election Fairness Perception",
      "The average election fairness index is {}%, indicating weak confidence in election fairness.",
      "Review countries with low fairness scores and compare them with democracy perception metrics."),
     ("v < 60", "Medium", "Moderate Election Fairness Perception",
      "The average election fairness index is {}%, suggesting mixed citizen confidence.",
      "Track fairness perception over time and identify countries with persistent concerns."),
     ("true", "Low", "Positive Election Fairness Perception",
      "The average election fairness index is {}%, suggesting relatively positive election fairness perception.",
      "Maintain monitoring and compare results with governance trust indicators.")),
    ("business", "coverage", "responses_per_million", "Population Coverage",
     ("v < 10", "High", "Very Low Population Coverage",
      "The average survey coverage is {} responses per million people, which is very low.",
      "Increase respondent outreach and improve geographic sampling coverage."),
     ("v < 50", "Medium", "Limited Population Coverage",
      "The average survey coverage is {} responses per million people.",
      "Expand survey distribution to improve representativeness across countries."),
     ("true", "Low", "Acceptable Population Coverage",
      "The average survey coverage is {} responses per million people.",
      "Maintain survey coverage and compare country-level sampling gaps.")),
    ("platform", "status", "pipeline_status", "Pipeline Health",
     ("upper(v) <> 'SUCCESS'", "High", "Pipeline Execution Issue",
      "The latest pipeline status is {}, meaning the ETL process did not complete successfully.",
      "Review Airflow logs, Spark job logs, and failed task dependencies immediately."),
     ("true", "Low", "Pipeline Execution Successful",
      "The latest pipeline execution completed successfully.",
      "Continue monitoring runtime, freshness, and data quality indicators.")),
    ("platform", "reliability", "overall_reliability_index", "Reliability",
     ("v < 70", "High", "Low Reliability Index",
      "The overall reliability index is {}%, which is below the safe threshold.",
      "Investigate validation failures, duplicate records, and missing values in the Silver and Gold layers."),
     ("v < 85", "Medium", "Moderate Reliability Index",
      "The overall reliability index is {}%. The platform is usable but should be monitored.",
      "Review data validation rules and monitor duplicate or invalid record trends."),
     ("true", "Low", "Strong Reliability Index",
      "The overall reliability index is {}%, indicating strong data reliability.",
      "Maintain the current validation and deduplication checks.")),
    ("platform", "freshness", "freshness_status", "Data Freshness",
     ("lower(v) = 'very stale'", "High", "Very Stale Dataset",
      "The dataset is marked as very stale, meaning the dashboard may not reflect recent survey activity.",
      "Trigger a new ingestion and transformation run through Airflow."),
     ("lower(v) = 'stale'", "Medium", "Stale Dataset",
      "The dataset is stale and may require refresh soon.",
      "Confirm whether the scheduled pipeline has run successfully within the expected refresh window."),
     ("true", "Low", "Fresh Dataset",
      "The dataset freshness status is healthy.",
      "Continue scheduled refresh monitoring.")),
)
# Headline of the report per worst severity.
HEADLINES = {
    "High": "The latest analytics contain high-risk findings that should be reviewed by stakeholders.",
    "Medium": "The latest analytics show moderate issues that require monitoring.",
    "Low": "The latest analytics show stable business and platform health.",
}
