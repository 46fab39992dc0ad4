"""Windows, baselines and evaluation on literal series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.operators import aggregates, baselines, customers, evaluate, windows
from demandspark.plans import serve

# One published category series and its first test-week forecasts.
GOLDEN_SERIES = {
    "2024-W03": 18831, "2024-W04": 11014, "2024-W05": 1471, "2025-W01": 58682, "2025-W02": 196288,
    "2025-W03": 270879, "2025-W04": 276592, "2025-W05": 185823, "2025-W06": 44294, "2025-W07": 39645,
    "2025-W08": 52992, "2025-W09": 28166, "2025-W10": 66354, "2025-W11": 69095, "2025-W12": 46910,
    "2025-W13": 73049, "2025-W14": 168404, "2025-W15": 138828, "2025-W16": 93681, "2025-W17": 122310,
    "2025-W18": 136496, "2025-W19": 128376, "2025-W20": 143239, "2025-W21": 117952, "2025-W22": 112621,
    "2025-W23": 89484, "2025-W24": 151067, "2025-W25": 113865, "2025-W26": 180199,
}
GOLDEN = {"naive": 180199.0, "ma4": 133653.75, "smoothing": 138445.40974629397, "trend": 127260.7867097556}


@pytest.fixture(scope="module")
def golden(spark):
    data = [("c", w, float(q)) for w, q in GOLDEN_SERIES.items()] + [("c", "2025-W27", 100802.0)]
    return baselines.split(spark.createDataFrame(data, "category string, year_week string, q double"))


@pytest.mark.parametrize(
    "name,forecast",
    [
        ("naive", baselines.naive_last),
        ("ma4", baselines.moving_average),
        ("smoothing", baselines.exp_smoothing),
        ("trend", baselines.linear_trend),
    ],
)
def test_golden_forecasts(golden, name, forecast):
    row = forecast(*golden, ["category"], "q").first()
    assert row["predicted"] == pytest.approx(GOLDEN[name], rel=1e-12)
    assert row["actual"] == 100802.0


def series(spark, values, e="a", first=1):
    data = [(e, f"2025-W{w:02d}", float(v)) for w, v in enumerate(values, first) if v is not None]
    return spark.createDataFrame(data, "e string, year_week string, y double")


def test_short_histories_are_left_out(spark):
    train, test = baselines.split(series(spark, [5.0, 6.0, 7.0], first=25))
    assert baselines.moving_average(train, test, ["e"], "y").count() == 0
    assert baselines.linear_trend(train, test, ["e"], "y").count() == 0
    assert baselines.exp_smoothing(train, test, ["e"], "y").first()["predicted"] == pytest.approx(5.3)
    empty = baselines.naive_last(train.where("1 = 0"), test, ["e"], "y", missing=0.0)
    assert empty.first()["predicted"] == 0.0


def test_trend_is_flat_when_all_weeks_are_the_same_and_never_negative(spark):
    data = [("a", f"{y}-W10", float(v)) for y, v in zip(range(2020, 2024), (1, 2, 3, 6))] + [("a", "2024-W30", 1.0)]
    train, test = baselines.split(spark.createDataFrame(data, "e string, year_week string, y double"))
    assert baselines.linear_trend(train, test, ["e"], "y").first()["predicted"] == 3.0
    falling = baselines.split(series(spark, [100, 60, 20, 1] + [None] * 30 + [1]))
    assert baselines.linear_trend(*falling, ["e"], "y").first()["predicted"] == 0.0


@pytest.mark.parametrize("alpha", [0.3, 0.5, 0.95, 1.0])
def test_running_level_of_long_series(spark, alpha):
    """Blocks of the weighted sums are crossed: 0.95 has blocks of 76 rows."""
    values = [100.0 + (i * 37 % 91) for i in range(400)]
    data = [("a", f"{2000 + i // 50}-W{i % 50 + 1:02d}", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "e string, year_week string, y double")
    got = [r["s"] for r in baselines.running_smoothed(df, ["e"], "y", alpha, "s").orderBy("year_week").collect()]
    want = [values[0]]
    for v in values[1:]:
        want.append(alpha * v + (1 - alpha) * want[-1])
    assert got == pytest.approx(want, rel=1e-12)


def test_windows_never_see_the_current_row(spark):
    base, changed = series(spark, [1, 2, 3, 4, 5, 6]), series(spark, [1, 2, 3, 4, 5, 600])
    def last(df):
        out = windows.rolling_mean(df, ["e"], "year_week", "y")
        out = windows.rolling_std(out, ["e"], "year_week", "y")
        out = windows.volatility(windows.rolling_minmax(out, ["e"], "year_week", "y"), ["e"], "year_week", "y")
        return out.drop("y").orderBy(F.desc("year_week")).first()
    assert last(base) == last(changed)
    included = windows.rolling_mean(changed, ["e"], "year_week", "y", 4, True).orderBy(F.desc("year_week")).first()
    assert included["rolling_avg_4w"] == 153.0


def test_gap_fill(spark, rows):
    df = series(spark, [10, None, None, 40, None, None, None, 5, None, None, None, None, None, 7])
    out = windows.fill_gaps(df, ["e"], "y")
    got = [(r["y"], r["week_status"]) for r in out.orderBy("week_start").collect()]
    assert got == (
        [(10.0, "observed"), (20.0, "interpolated"), (30.0, "interpolated"), (40.0, "observed")]
        + [(None, "gap")] * 3
        + [(5.0, "observed")]
        + [(0.0, "inactive")] * 5
        + [(7.0, "observed")]
    )


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([("w", "a", 1.0), ("w", "b", 3.0)], "w string, e string, y double")
    assert windows.share(df, ["w"], "y", "s").agg(F.sum("s")).first()[0] == 1.0


def test_zero_actuals(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0)], "actual double, predicted double")
    assert [r["pct_error"] for r in evaluate.errors(df).collect()] == [None, 50.0]
    assert [r["pct_error"] for r in evaluate.errors(df, "zero").collect()] == [0.0, 50.0]
    none_sold = df.where("actual = 0")
    assert evaluate.metrics(none_sold).first()["wmape"] == 999.0
    assert evaluate.metrics(df).first()["median_mape"] == 50.0


def test_confidence_limits(spark):
    df = spark.createDataFrame([(39.9, 15), (39.9, 14), (59.9, 10), (59.9, 9), (40.0, 20)], "w double, n int")
    got = [r[0] for r in df.select(evaluate.confidence(F.col("w"), F.col("n"))).collect()]
    assert got == ["High", "Medium", "Medium", "Low", "Medium"]


def test_accuracy_tiers_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (20.0,), (20.1,), (1000.0,), (1000.1,)], "w double")
    got = [r[0] for r in df.select(evaluate.accuracy_tier(F.col("w"))).collect()]
    assert got == [None, "Excellent (<20%)", "Good (20-40%)", "Very Poor (>100%)", None]


def test_pattern_order(spark, rows):
    stats = spark.createDataFrame(
        [("few", 9, 0.1, 99.0, 1.0), ("stable", 20, 0.2, 60.0, 1.0), ("low", 12, 0.2, 40.0, 1.0), ("bulk", 30, 0.9, 60.0, 11.0), ("wild", 30, 0.9, 60.0, 9.0), ("null", 30, None, 60.0, 9.0)],
        "sku string, n_weeks int, cv double, mean_qty double, range_ratio double",
    )
    got = {r["sku"]: (r["pattern"], r["data_sufficiency"], r["recommended_model"]) for r in aggregates.pattern(stats).collect()}
    assert got == {
        "few": ("insufficient_data", "insufficient", "none"),
        "stable": ("stable", "full", "V2_cyclical"),
        "low": ("cyclical", "marginal", "V2_cyclical"),
        "bulk": ("bulk_oneoff", "full", "V1_baseline"),
        "wild": ("high_variance", "full", "V1_baseline"),
        "null": ("high_variance", "full", "V1_baseline"),
    }
    assert aggregates.pattern(stats, "doc").where("sku = 'low'").first()["pattern"] == "stable"


def test_week_uplift_counts_each_entity_once_and_honours_the_cut(spark):
    data = [("a", "2023-W47", 50.0), ("a", "2024-W47", 90.0), ("a", "2024-W10", 10.0), ("b", "2024-W10", 3.0)]
    df = spark.createDataFrame(data, "e string, year_week string, weekly_quantity double")
    got = {r["e"]: r["uplift"] for r in aggregates.week_uplift(df, ["e"]).collect()}
    assert got == {"a": 7.0, "b": 1.0}
    early = {r["e"]: r["uplift"] for r in aggregates.week_uplift(df, ["e"], as_of="2024-W20").collect()}
    assert early["a"] == 5.0


def test_segments_and_buyers(spark):
    df = spark.createDataFrame([(100_001.0, 1.0), (50.0, 10_001.0), (50.0, 2_001.0), (50.0, 501.0), (50.0, 500.0)], "u double, a double")
    assert [r[0] for r in df.select(customers.segment_v2(F.col("u"), F.col("a"))).collect()] == [
        "Bulk/Wholesale", "Bulk/Wholesale", "Large Retailer", "Medium Retailer", "Small Retailer",
    ]
    v1 = [r[0] for r in df.select(customers.segment_v1(F.col("a"))).collect()]
    assert v1 == ["Small Retailer", "Large Retailer", "Medium Retailer", "Medium Retailer", "Medium Retailer"]


def test_buying_cycles(spark):
    from datetime import date, timedelta

    start = date(2025, 1, 1)
    plan = {"weekly": [0, 7, 14, 21], "once": [0, 0], "odd": [0, 2, 90, 95], "": [0, 1]}
    data = [(c, start + timedelta(d)) for c, days in plan.items() for d in days]
    lines = spark.createDataFrame(data, "customer_id string, order_date date")
    got = {r["customer_id"]: (r["cycle_regularity"], r["std_days_between_orders"]) for r in customers.buying_cycles(lines).collect()}
    assert got["weekly"] == ("Weekly", 0.0)
    assert got["once"] == ("One-time", 0.0)
    assert got["odd"][0] == "Irregular"
    assert "" not in got


def test_series_document(spark):
    h1, preds = series(spark, [3.14159, 2]), series(spark, [7.77], first=27).select("e", "year_week", F.col("y").alias("actual"), (F.col("y") + 1).alias("predicted"))
    meta = spark.createDataFrame([("a", "Name")], "e string, name string")
    row = serve.series_document(h1, preds, meta, ["e"], "y").first()
    assert row["h1"] == {"2025-W01": 3.1, "2025-W02": 2.0}
    assert row["h2"]["predicted"] == {"2025-W27": 8.8}
    assert (row["meta"]["name"], row["meta"]["h1_weeks"]) == ("Name", 2)
    assert row["document"].startswith('{"h1":{"2025-W01":3.1')


def test_registered_halves_are_split_in_time(spark):
    """No training week of the hold-out queries lies after a test week."""
    from pathlib import Path

    from demandspark.plans import q_forecast, q_joins
    from demandspark.plans.registry import Sales

    if not Path("/root/testdata/sf0.001").exists():
        pytest.skip("driver tables absent")
    train, test = q_joins.halves(Sales(spark, "/root/testdata/sf0.001"))
    assert train.agg({"year_week": "max"}).first()[0] < test.agg({"year_week": "min"}).first()[0]
    parts = {r["part"] for r in q_forecast.marked(train, test).select("part").distinct().collect()}
    assert parts == {"train", "test"}


def test_trend_across_years(spark):
    data = [("a", f"{y}-W{w:02d}", float(w + 52 * (y - 2021))) for y in (2021, 2022) for w in (10, 20, 30, 40)] + [("a", "2023-W10", 114.0)]
    train, test = baselines.split(spark.createDataFrame(data, "e string, year_week string, y double"), "2022-W52")
    assert baselines.linear_trend(train, test, ["e"], "y", across_years=True).first()["predicted"] == pytest.approx(114.0, abs=1)
    assert baselines.linear_trend(train, test, ["e"], "y").first()["predicted"] < 60


def test_a_week_updates_only_the_series_that_have_a_value(monkeypatch):
    """Few weeks of a sparse series have values; the filter's costly step is not taken for the others."""
    from demandspark.operators import series_models

    taken = []
    plain = series_models.Filter.update
    monkeypatch.setattr(series_models.Filter, "update", lambda self, values, lanes: taken.append(values.shape[1]) or plain(self, values, lanes))
    there = np.zeros((2, 40), bool)
    there[0, ::10], there[1, :4] = True, True
    grid = np.zeros((4, 2, 40))
    grid[0][there] = np.arange(8.0)
    phi, theta = np.zeros((3, 2)), np.zeros((2, 2))
    _, sums, logs, count = series_models.filtered(grid, there, np.array([0, 1]), phi, theta, 0)
    assert sum(taken) == 8 and count.tolist() == [4, 4]
    assert np.allclose(sums[0, 0], (grid[0] ** 2).sum(1)) and np.allclose(logs, 0)
