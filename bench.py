"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterlake.plans import catalogue  # noqa: E402
from meterlake.plans.load import load  # noqa: E402
from meterlake.plans.views import materialise_views  # noqa: E402
from meterlake.session import build_session, fresh_path  # noqa: E402
from meterlake.sources.paths import delete  # noqa: E402

HEADLINE = [
    *(name for name in catalogue.QUERIES if name[0] in "vqn" and name[1].isdigit() and "x_" not in name),
    "c06_daily_consumption",
    "c07_state_health",
    "c13_feeder_risk",
    "e02_04_meters_with_status",
    "e13_district_heatmap",
    "e15_rssi_distribution",
    "e18_worst_signal_devices",
    "p05_dedupe",
    "p17_dashboard_filters",
    "k03_null_counts",
    "k04_duplicates",
    "k07_numeric_ranges",
    "k08_category_counts",
    "k14_range_violations",
    "k17_reconcile",
    "x01_rolling_outliers",
    "x02_alert_severity",
    "x03_row_level_access",
    "x04_feeder_outliers",
    "x05_voltage_bands",
]


WARMUP_DIR = "/root/testdata/sf0.001"


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "meterlake-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the JVM and first code generation are reported apart from the queries.
    startup = timed(lambda: run(catalogue.readings(spark, os.environ.get("BENCH_WARMUP_DIR", WARMUP_DIR))))
    seconds: dict[str, float] = {}
    # The load is what the reference times: scan, clean, dedupe, derive, partitioned write.
    seconds["load"] = timed(lambda: catalogue.readings(spark, sf_dir))
    for name in HEADLINE:
        seconds[name] = timed(lambda: run(catalogue.QUERIES[name](spark, sf_dir)))
    csv, base = catalogue.raw_csv(spark, sf_dir), fresh_path(spark, "bench-load")
    seconds["load_csv"] = timed(lambda: load(spark, f"{base}/table", csv=csv))
    seconds["load_same_days_again"] = timed(lambda: load(spark, f"{base}/table", csv=csv))
    delete(spark, base)
    seconds["s17_arriving_files"] = timed(lambda: run(catalogue.QUERIES["s17_arriving_files"](spark, sf_dir)))
    table = catalogue.readings(spark, sf_dir)
    seconds["materialise_all_views"] = timed(lambda: materialise_views(table, fresh_path(spark, "bench")))
    rows = table.count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
                "rows": rows,
                "startup_sec": startup,
                "load_rows_per_sec": round(rows / seconds["load"]),
            }
        )
    )


if __name__ == "__main__":
    main()
