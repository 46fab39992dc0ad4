"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from demandspark.plans import catalog
from demandspark.session import get_spark

HEADLINE = [
    "flagship_category_wmape",
    "E01_infer_prices",
    "E02_infer_prices_median",
    "E05_dq_score",
    "E08_normalise_customers",
    "E17_reconcile",
    "E20_outliers_iqr_1_5",
    "A06_sku_week_enriched",
    "A10_category_week",
    "A16_product_stats",
    "A17_week_completeness_v2",
    "A20_customer_cycles",
    "A36_raw_totals",
    "A38_quantile_exact",
    "W02_rolling_avg_excl",
    "W08_volatility",
    "W16_fill_gaps",
    "W17_rank_in_category",
    "F02_moving_average_8_sku",
    "F03_seasonal_naive",
    "F04_linear_trend",
    "F05_exp_smoothing_sku",
    "F06_walk_forward_ma",
    "F08_route",
    "V02_metrics",
    "V06_compare",
    "V08_confidence",
    "D04_series_document",
    "D07_eval_summary",
    "M01_gbt_global",
    "M02_gbt_by_group",
    "M03_gbt_by_sku",
    "M06_linear",
    "M07_auto_arima_sku",
    "M12_sku_revenue_model",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = get_spark(
        f"local[{cpus}]",
        app="bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["A10_category_week"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total wall-clock of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
