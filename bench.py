"""Times the headline queries at ``$BENCH_SF_DIR`` and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

HEADLINE = [
    "j06_sales_view",
    "g01_sales_by_productline",
    "g02_sales_by_productline_orders",
    "g03_top_countries",
    "g06_sales_by_year_orders",
    "g07_summary_tables_one_pass",
    "g09_describe",
    "g10_numeric_profile",
    "g11_categorical_profile",
    "g17_correlation_matrix",
    "g19_fingerprint",
    "g21_histogram",
    "g22_boxplot",
    "b06_impute_median",
    "b13_removal_report",
    "b20_regression_dataset",
    "c04_gate_report",
    "g23_regression_metrics",
    "g24_calibration_error",
    "g25_conformal_fit",
    "g27_psi",
    "g28_psi_equal_width",
    "g29_ks_statistic",
    "g31_drift_summary",
    "g33_column_drift_report",
    "j01_calendar_fill",
    "s07_risk_summary",
    "s09_garch_volatility",
    "m02_split_counts",
    "m19_shadow_comparison",
    "r02_daily_psi",
    "m03_linear_residuals",
    "u02_estimator_plugin",
    "s04_arima_forecast",
    "m24_daily_drift_alert",
    "r01_stream_intervals",
]


def main() -> None:
    from salescope.plans.registry import ENTRIES
    from salescope.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    times = {}
    # Start the JVM's code paths once, on a query that is timed again below.
    ENTRIES["g01_sales_by_productline"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in only or HEADLINE:
        start = time.perf_counter()
        ENTRIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
