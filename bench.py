"""Wall-clock seconds of the headline queries, one JSON line.

Each query runs once to warm up (code generation, stored tables), then BENCH_RUNS times; the
median counts. Results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from nestmetrics import catalog  # noqa: E402
from nestmetrics.session import build_session  # noqa: E402

HEADLINE = """
clean_listings clean_calendar profile_columns quality_report duplicate_rows
agg_calendar agg_reviews enrich_listings
build_dim_neighbourhood build_dim_host build_dim_listing build_dim_date build_fact_listing_snapshot
build_fact_calendar build_fact_reviews
sql_price_by_neighbourhood sql_price_by_room_type sql_top_hosts sql_pro_vs_casual sql_weekend_pricing
sql_monthly_price_availability sql_quality_concerns sql_neighbourhood_summary
sql_quality_nulls sql_quality_ranges check_foreign_key
quantiles calendar_quantiles histogram surrogate_key average_rank_ties dedupe_keep_first join_dim_fact_all
eda_price_distribution eda_top_neighbourhoods eda_availability_by_month eda_insights
test_weekend_price kruskal_wallis statistical_report recommendations
dash_seasonality dash_improvement_targets filter_options
ml_feature_frame ml_linear_regression
""".split()


def run(build, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "nestmetrics-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()
    seconds, first = {}, {}
    for name in wanted:
        first[name] = round(run(registered[name], spark, sf_dir), 3)
        seconds[name] = round(statistics.median(run(registered[name], spark, sf_dir) for _ in range(runs)), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, first[name], seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": sf_dir.rsplit("/", 1)[-1].removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
