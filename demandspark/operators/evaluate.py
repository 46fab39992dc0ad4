"""Forecast errors, comparison tables and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import flag
from ..functions.clean import safe_div
from ..functions.distributed import exact_percentiles
from .joins import union_all

# Fixed values: (upper WMAPE, fewest weeks) of the High and Medium labels, per variant.
CONFIDENCE_RULES = {
    "sku": ((40, 15), (60, 10)),
    "category": ((40, 0), (60, 0)),
    "customer": ((40, 0), (80, 0)),
    "config": ((40, 20), (70, 10)),
}

# Right-closed accuracy tiers.
ACCURACY_TIERS = (
    (0, 20, "Excellent (<20%)"),
    (20, 40, "Good (20-40%)"),
    (40, 60, "Fair (40-60%)"),
    (60, 100, "Poor (60-100%)"),
    (100, 1000, "Very Poor (>100%)"),
)


def errors(df: DataFrame, zero: str = "null") -> DataFrame:
    """Error columns; the percentage of a zero actual is NULL, or 0."""
    pct = safe_div(F.abs(F.col("actual") - F.col("predicted")) * 100, "actual")
    return df.withColumns(
        {
            "error": F.col("predicted") - F.col("actual"),
            "abs_error": F.abs(F.col("actual") - F.col("predicted")),
            "pct_error": pct if zero == "null" else F.coalesce(pct, F.lit(0.0)),
        }
    )


def wmape(actual: Column, predicted: Column, empty: float = 999.0, denom: str = "sum") -> Column:
    """100 * sum of errors / sum of actuals, `empty` when nothing sold; `abs` sums magnitudes."""
    base = F.sum(F.abs(actual)) if denom == "abs" else F.sum(actual)
    return F.when(base > 0, F.sum(F.abs(actual - predicted)) * 100 / base).otherwise(F.lit(float(empty)))


def metrics(
    df: DataFrame, by: list[str] | None = None, e: str | None = None, zero: str = "null", only_sold: bool = False
) -> DataFrame:
    """MAE, RMSE, mean and median MAPE, WMAPE, bias per slice.

    Slices may hold any number of rows, so the exact median comes from the distributed
    quantile. `only_sold` keeps rows with a positive actual.
    """
    keys = by or []
    rows = errors(df.where(F.col("actual") > 0) if only_sold else df, zero)
    parts = [
        F.count("*").alias("n_predictions"),
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        F.avg("pct_error").alias("mean_mape"),
        wmape(F.col("actual"), F.col("predicted")).alias("wmape"),
        F.avg("error").alias("bias"),
    ]
    if e:
        parts.append(F.count_distinct(e).alias("entities"))
    summary = rows.groupBy(*keys).agg(*parts)
    medians = exact_percentiles(rows, keys, "pct_error", {"median_mape": 0.5})
    return summary.join(medians, keys, "left") if keys else summary.crossJoin(F.broadcast(medians))


def per_entity(df: DataFrame, e: list[str], zero: str = "null") -> DataFrame:
    """Metrics of each weekly series (no longer than the calendar)."""
    return errors(df, zero).groupBy(*e).agg(
        F.count("*").alias("n_weeks"),
        F.avg("abs_error").alias("mae"),
        F.percentile("pct_error", 0.5).alias("median_mape"),
        F.avg("pct_error").alias("mean_mape"),
        wmape(F.col("actual"), F.col("predicted")).alias("wmape"),
        F.sum("actual").alias("total_actual"),
        F.sum("predicted").alias("total_predicted"),
    )


def compare(preds_by_model: dict[str, DataFrame], e: str) -> DataFrame:
    """One row per model; `is_best` marks the smallest MAE."""
    table = metrics(union_all(preds_by_model, "model"), ["model"], e)
    best = F.min(F.struct("mae", "model")).over(Window.partitionBy(F.lit(1)))
    return table.withColumn("is_best", flag(F.col("model") == best["model"]))


def compare_versions(preds_by_version: dict[str, DataFrame]) -> DataFrame:
    """WMAPE per version and the change on the version before (a few rows)."""
    table = union_all(preds_by_version, "model_version").groupBy("model_version").agg(
        F.count("*").alias("n_predictions"), wmape(F.col("actual"), F.col("predicted")).alias("wmape")
    )
    previous = F.lag("wmape").over(Window.orderBy("model_version"))
    return table.withColumn("delta_wmape", F.col("wmape") - previous)


def confidence(metric: Column, weeks: Column | None = None, variant: str = "sku") -> Column:
    """High / Medium / Low."""
    (high, high_weeks), (medium, medium_weeks) = CONFIDENCE_RULES[variant]
    n = F.lit(0) if weeks is None else weeks
    return (
        F.when((metric < high) & (n >= high_weeks), "High")
        .when((metric < medium) & (n >= medium_weeks), "Medium")
        .otherwise("Low")
    )


def with_confidence(per: DataFrame, weeks: DataFrame, e: list[str], variant: str = "sku") -> DataFrame:
    """Label of each entity from its WMAPE and training weeks (0 when it has none)."""
    joined = per.join(weeks, e, "left").withColumn("h1_weeks", F.coalesce("h1_weeks", F.lit(0)))
    return joined.withColumn("confidence", confidence(F.col("wmape"), F.col("h1_weeks"), variant))


def confidence_distribution(labelled: DataFrame) -> DataFrame:
    """Entities per label."""
    return labelled.groupBy("confidence").agg(F.count("*").alias("entities"), F.avg("wmape").alias("avg_wmape"))


def accuracy_tier(c: Column) -> Column:
    """Right-closed tiers, NULL outside."""
    out = None
    for low, high, label in ACCURACY_TIERS:
        inside = (c > low) & (c <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def threshold_counts(per: DataFrame, metric: str = "wmape") -> DataFrame:
    """Entities under 20 and 40, and over 100."""
    c = F.col(metric)
    return per.agg(
        F.count("*").alias("entities"),
        F.count_if(c < 20).alias("under_20"),
        F.count_if(c < 40).alias("under_40"),
        F.count_if(c > 100).alias("over_100"),
    )


def bias(df: DataFrame, by: list[str]) -> DataFrame:
    """Mean of predicted minus actual."""
    return df.groupBy(*by).agg(F.avg(F.col("predicted") - F.col("actual")).alias("bias"))


def share_under(per: DataFrame, limit: float = 50.0, metric: str = "median_mape") -> DataFrame:
    """Share of entities under a MAPE."""
    return per.agg(F.avg(F.when(F.col(metric) < limit, 1.0).otherwise(0.0)).alias("share_under"))


def direction(df: DataFrame, e: list[str]) -> DataFrame:
    """Whether prediction and actual moved the same way from the previous actual."""
    w = Window.partitionBy(*e).orderBy("year_week")
    last = F.lag("actual").over(w)
    same = F.signum(F.col("actual") - last) == F.signum(F.col("predicted") - last)
    return df.withColumn("direction_hit", F.when(last.isNotNull(), flag(same)))


def monitor(df: DataFrame, e: list[str], by: list[str]) -> DataFrame:
    """Accuracy, direction accuracy and missing share per slice."""
    rows = direction(errors(df), e)
    return rows.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        F.avg("pct_error").alias("mape"),
        wmape(F.col("actual"), F.col("predicted")).alias("wmape"),
        F.avg("direction_hit").alias("direction_accuracy"),
        (F.avg(F.when(F.col("predicted").isNull(), 100.0).otherwise(0.0))).alias("missing_values_pct"),
    )


def drift(reference: DataFrame, current: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Population stability index over quantile bins of the reference (half a row per empty bin)."""
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    cuts = exact_percentiles(reference, [], value, probs).select(F.array(*probs).alias("_cuts"))

    def counts(df: DataFrame, name: str) -> DataFrame:
        bin_no = F.size(F.filter("_cuts", lambda q: q < F.col(value)))
        rows = df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(cuts))
        return rows.groupBy(bin_no.alias("bin")).agg(F.count("*").alias(name))

    both = counts(reference, "_r").join(counts(current, "_c"), "bin", "full_outer").fillna(0, ["_r", "_c"])
    every_bin = Window.partitionBy(F.lit(1))
    both = both.withColumns({"_rt": F.sum("_r").over(every_bin), "_ct": F.sum("_c").over(every_bin)})
    p = F.greatest(F.col("_r").cast("double"), F.lit(0.5)) / F.col("_rt")
    q = F.greatest(F.col("_c").cast("double"), F.lit(0.5)) / F.col("_ct")
    return both.agg(
        F.sum((q - p) * F.log(q / p)).alias("psi"), F.count("*").alias("bins_used")
    )


def side_by_side(actual: DataFrame, a: DataFrame, b: DataFrame, keys: list[str], names=("a", "b")) -> DataFrame:
    """Actuals with two models' predictions and errors."""
    out = actual
    for name, preds in zip(names, (a, b)):
        out = out.join(preds.select(*keys, F.col("predicted").alias(f"predicted_{name}")), keys, "left")
        gap = F.abs(F.col("actual") - F.col(f"predicted_{name}"))
        out = out.withColumns({f"{name}_abs_error": gap, f"{name}_pct_error": safe_div(gap, "actual")})
    return out


def side_by_side_metrics(table: DataFrame, names=("a", "b")) -> DataFrame:
    """One metrics row per model of a side-by-side table, in one pass."""
    rows = table.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("model"), F.col("actual").alias("actual"), F.col(f"predicted_{n}").alias("predicted"))
                    for n in names
                ]
            )
        )
    ).where(F.col("predicted").isNotNull())
    scored = errors(rows)
    return scored.groupBy("model").agg(
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        F.avg("pct_error").alias("mape"),
        wmape(F.col("actual"), F.col("predicted")).alias("wmape"),
    )


def compare_runs(runs: DataFrame, params: list[str], metric_keys: list[str]) -> DataFrame:
    """One row per run; chosen parameters and metrics out of their JSON maps."""
    param_map = F.from_json("params", "map<string,string>")
    metric_map = F.from_json("metrics", "map<string,double>")
    return runs.select(
        "run_name",
        "status",
        "duration_seconds",
        *[F.try_element_at(param_map, F.lit(p)).alias(f"param_{p}") for p in params],
        *[F.try_element_at(metric_map, F.lit(m)).alias(f"metric_{m}") for m in metric_keys],
    )
