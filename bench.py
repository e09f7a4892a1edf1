"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

from acceptance.queries import queries

HEADLINES = (
    "clean_survey",
    "dedup_by_key",
    "exact_dedup",
    "merge_copies",
    "keep_latest",
    "validate_survey_feed",
    "contract_check",
    "country_survey_kpis",
    "survey_feed_to_kpis",
    "demographic_distribution",
    "response_volume_trends",
    "governance_trust",
    "corruption_perception",
    "corruption_distribution",
    "population_coverage",
    "data_quality_summary",
    "reliability_index",
    "dq_by_country",
    "cleaning_reduction",
    "country_summary",
    "business_kpis",
    "civic_comparison",
    "business_findings",
    "risk_summary",
    "new_files",
    "match_country",
    "file_fingerprint",
    "run_ledger_latest",
    "incremental_state",
    "stream_ingest",
    "stream_daily_volume",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    wanted = sys.argv[1:] or HEADLINES
    registered = queries()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "survey_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
