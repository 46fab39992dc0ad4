"""Sums that merge: multiset hashes and quantile sketches."""

import pytest
from pyspark.sql import functions as F

from demandspark.operators import aggregates, quality

COLUMNS = ["k", "v", "t", "s"]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(400).select(
        (F.col("id") % 7).alias("k"), (F.col("id") / 8).alias("v"), F.timestamp_seconds(F.col("id") * 3600).alias("t"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("é1:"), F.col("id") % 3)).alias("s"), F.col("id"),
    )
    return df.cache()


def values(df):
    return [tuple(r[c] for c in ("n_rows", "h0", "h1", "h2", "h3")) for r in df.collect()]


def test_hashes_of_parts_add_up(table):
    parts = quality.multiset_hash(table.withColumn("file", F.col("id") % 3), ["file"], COLUMNS)
    whole = values(quality.multiset_hash(table, columns=COLUMNS))
    assert values(quality.combined(parts)) == whole
    rest = quality.combined(quality.multiset_hash(table, columns=COLUMNS), parts.where("file = 1").drop("file"))
    assert values(rest) == values(quality.multiset_hash(table.where("id % 3 <> 1"), columns=COLUMNS))


def test_hashes_ignore_order_and_count_repeats(table):
    one = values(quality.multiset_hash(table, columns=COLUMNS))
    assert values(quality.multiset_hash(table.orderBy(F.desc("id")).repartition(5), columns=COLUMNS)) == one
    twice = values(quality.multiset_hash(table.unionAll(table.where("id = 3")), columns=COLUMNS))
    assert twice != one and twice[0][0] == 401


def test_hashes_see_every_change(table):
    one = values(quality.multiset_hash(table, columns=COLUMNS))
    changes = {"v": F.col("v") + 0.5, "s": F.coalesce("s", F.lit("")), "t": F.col("t") + F.expr("INTERVAL 1 MICROSECOND"), "k": F.lit(None).cast("long")}
    assert all(values(quality.multiset_hash(table.withColumn(c, F.when(F.col("id") == 5, e).otherwise(F.col(c))), columns=COLUMNS)) != one for c, e in changes.items())
    # a value's length stands before it: neighbours don't run into each other
    pair = lambda a, b: values(quality.multiset_hash(table.limit(1).select(F.lit(a).alias("a"), F.lit(b).alias("b"))))
    assert pair("ab", "c") != pair("a", "bc")
    assert values(quality.multiset_hash(table.where("false"), columns=COLUMNS)) == [(0, 0, 0, 0, 0)]


def test_sketches_of_any_range_keep_their_rank_error(spark):
    """Skewed, tied and tiny groups; sketches by part merged to groups, whatever the parts."""
    df = spark.range(60_000).select(
        (F.col("id") % 50).alias("week"), F.when(F.col("id") % 10 > 0, "big").otherwise("small").alias("g"),
        F.when(F.col("id") % 4 == 0, 7.0).otherwise(F.exp(F.rand(1) * 8)).alias("y"),
    ).withColumn("y", F.when(F.col("week") != 49, F.col("y"))).cache()
    stored = aggregates.quantile_sketches(df, ["g", "week"], "y").cache()
    for weeks in ((0, 48), (0, 3)):
        for q in (0.01, 0.5, 0.99):
            found = {r["g"]: r for r in aggregates.merged_quantile(stored.where(F.col("week").between(*weeks)), ["g"], q).collect()}
            for g in ("big", "small"):
                own = df.where((F.col("g") == g) & F.col("week").between(*weeks) & F.col("y").isNotNull())
                answer = found[g]["quantile"]
                n, low, high = own.agg(F.count("*"), F.avg((F.col("y") < answer).cast("int")), F.avg((F.col("y") <= answer).cast("int"))).first()
                assert found[g]["n"] == n and low <= q + aggregates.RANK_ERROR and high >= q - aggregates.RANK_ERROR
    assert aggregates.merged_quantile(stored.where("week = 49"), ["g"]).count() == 0


def test_an_id_is_shuffled_once_for_all_totals(spark):
    """files, regions, months and the total count distinct ids; NULL keys are places of their own, NULL ids none."""
    data = [("i1", 1, "c1", "A", "01"), ("i1", 1, "c1", "A", "01"), ("i1", 2, "c1", "A", "02"), ("i2", 1, None, "B", "01"), ("i3", 3, "", None, "02"), ("i3", 3, "", None, "02")]
    rows = spark.createDataFrame([(*r, f"{r[3]}_{r[4]}" if r[3] else None, 2.0, 3.0) for r in data], "invoice_id string, sku long, customer_id string, region string, month string, file_name string, quantity double, line_total double")
    out = aggregates.raw_totals(rows)
    got = {(r["level"], r["region"], r["month"]): (r["line_items"], r["invoices"], r["unique_skus"], r["unique_customers"]) for r in out.collect()}
    assert got == {
        ("file", "A", "01"): (2, 1, 1, 1), ("file", "A", "02"): (1, 1, 1, 1), ("file", "B", "01"): (1, 1, 1, 0), ("file", None, "02"): (2, 1, 1, 1),
        ("region", "A", None): (3, 1, 2, 1), ("region", "B", None): (1, 1, 1, 0), ("region", None, None): (2, 1, 1, 1),
        ("month", None, "01"): (3, 2, 1, 1), ("month", None, "02"): (3, 2, 2, 2), ("total", None, None): (6, 3, 3, 2),
    }
    # only the sums per file are spread over the grouping sets, not the ids
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Expand") == 1


def test_lines_of_a_week_are_shuffled_once_for_all_counts(spark):
    """F8: the same table as with distinct counts spread by value, without a row a count; NULLs are keys but not counted."""
    data = [("a", "w1", "i1", "c1", "N"), ("a", "w1", "i1", "c2", "N"), ("a", "w1", "i2", None, "S"), ("a", "w1", None, None, "S"), ("a", "w2", None, "c1", None), ("b", None, "i1", "c1", "N"), (None, "w1", "i3", "", "S"), (None, "w1", "i3", "", "S")]
    lines = spark.createDataFrame([(*r, float(k), 2.0 * k, 0.5 * k, k) for k, r in enumerate(data)], "sku string, year_week string, invoice_id string, customer_id string, region string, quantity double, line_total double, unit_price double, score int")
    args = (["sku"], {"orders": "invoice_id", "buyers": "customer_id"}, None, {"region": "region"}, {"score": "score"})
    placed, spread = (aggregates.weekly_features(lines, *args, placed=way) for way in (True, False))
    assert placed.schema == spread.schema
    assert sorted(map(str, placed.collect())) == sorted(map(str, spread.collect()))
    got = {(r["sku"], r["year_week"]): (r["orders"], r["buyers"]) for r in placed.collect()}
    assert got == {("a", "w1"): (2, 2), ("a", "w2"): (0, 1), ("b", None): (1, 1), (None, "w1"): (1, 1)}
    plan = placed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange") == 1 and "Expand" not in plan
