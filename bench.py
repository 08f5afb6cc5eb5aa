"""Wall time per query, written to the no-op sink; one JSON line on stdout.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 3; the median counts), BENCH_QUERIES
(comma-separated names, or ``all``; default the headline queries below).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tamiz.plans.catalog import QUERIES  # noqa: E402

# At least one query of every family, the heaviest of each included.
HEADLINE = [
    "fact_enrich", "enrich_star", "enrich_sparse", "hierarchy_left", "salted_left_join",
    "ref_semi", "ref_flag", "cascade_filter", "lookup_or_dummy", "fanout_audit",
    "dedup_by_key", "dedup_latest", "dedup_exact_text", "distinct_on",
    "rule_unique_composite", "rule_date_range", "rule_summary", "rule_enrolment_flags",
    "profile_null_blank", "quality_report", "category_distribution",
    "clean_strip_quotes", "clean_zero_pad", "normalize_code_map", "parse_date_patterns",
    "clean_students", "clean_enrolments", "clean_graduates", "clean_projects",
    "student_final", "enrolment_final", "enrolment_final_fanout", "graduate_final",
    "graduate_final_fanout",
    "calendar_dim", "dim_surrogate_key", "dim_upsert", "geographic_dim", "student_dim",
    "ragged_dpa_parroquias", "csv_roundtrip", "xlsx_scan", "stage_overwrite",
    "staging_quality_report",
    "enrolment_final_bucketed", "dim_upsert_partitions", "dim_key_map", "title_history",
    "cleaning_funnel", "infer_types", "profile_incremental", "publish_tables", "staged_counts",
]


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tamiz-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, names[0], sf_dir)  # the first query also pays for starting up
    seconds = {
        n: round(statistics.median(run(spark, n, sf_dir) for _ in range(runs)), 4) for n in names
    }
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
