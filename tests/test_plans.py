"""What the physical plans must not contain."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from demandspark.plans import catalog
from demandspark.sources.retail import Retail

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables absent")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_the_query_needs(spark):
    text = plan(Retail(spark, FOLDER).lines().groupBy("sku").sum("quantity"))
    schemas = re.findall(r"ReadSchema: (\S+)", text)
    assert any("l_quantity" in s and "l_extendedprice" not in s for s in schemas)
    assert all("o_totalprice" not in s for s in schemas)


def test_filters_reach_the_scan(spark):
    text = plan(catalog.QUERIES["P31_account_sales"](spark, FOLDER))
    assert "EqualTo(o_orderstatus,F)" in text


def test_top_list_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(catalog.QUERIES["K04_top_by_volume"](spark, FOLDER))


def test_top_items_are_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(catalog.QUERIES["A22_top_items"](spark, FOLDER))


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    from demandspark.sources import tables

    facts = Retail(spark, FOLDER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")
            tables.write_table(facts.table(name), f"bucketed_{name}", path=str(tmp_path / name), bucket_by=[key], buckets=8)
        joined = spark.table("bucketed_lineitem").join(spark.table("bucketed_orders"), [F.col("l_orderkey") == F.col("o_orderkey")])
        assert "Exchange" not in plan(joined.select("l_orderkey", "o_custkey"))
        assert joined.count() == facts.table("lineitem").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("orders", "lineitem"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")


def test_a_hot_key_is_split(spark):
    """A third of the lines on one sku: the join splits it and the grouping shuffles partial sums."""
    from demandspark.operators import aggregates, enrich

    i, n = F.col("id"), 600_000
    mixed = F.xxhash64("id")
    lines = spark.range(n).select(
        F.when(i % 3 == 0, 7).otherwise(i % 5_000).alias("sku"),
        F.pmod(mixed, F.lit(40)).cast("double").alias("quantity"),
        F.when(i % 11 == 0, 0.0).otherwise(F.pmod(mixed, F.lit(997)) / 7).alias("unit_price"),
        F.concat(F.lit("2024-W"), F.lpad((i % 52 + 1).cast("string"), 2, "0")).alias("year_week"),
        mixed.cast("string").alias("invoice_id"),
    )
    lines = lines.withColumn("line_total", F.col("quantity") * F.col("unit_price"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        weekly = aggregates.weekly_features(enrich.infer_prices(lines), ["sku"], {"order_count": "invoice_id"})
        rows = weekly.groupBy().agg(F.sum("weekly_quantity"), F.sum("order_count"))
        total = rows.collect()[0]
        final = plan(rows).split("Initial Plan")[0]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in final and "hashpartitioning(sku" in final
    assert total[0] == lines.agg(F.sum("quantity")).first()[0] and total[1] == n


def scans_of_lines(spark, name, monkeypatch):
    """How often the line items are read, the tables written on the way included."""
    from demandspark import session

    read, real = [], session.pin

    def counted(df):
        read.append(plan(df).count("lineitem.parquet"))
        return real(df)

    for module in ("demandspark.operators.customers", "demandspark.plans.registry"):
        monkeypatch.setattr(f"{module}.pin", counted)
    df = catalog.QUERIES[name](spark, FOLDER)
    return sum(read) + plan(df).count("lineitem.parquet")


@pytest.mark.parametrize("name,most", [("A06_sku_week_enriched", 2), ("A20_customer_cycles", 1)])
def test_line_items_are_read_once_or_twice(spark, monkeypatch, name, most):
    assert 1 <= scans_of_lines(spark, name, monkeypatch) <= most


@pytest.mark.parametrize("name", ["M12_sku_revenue_model", "M08_segment_model"])
def test_pooled_fits_read_their_features_from_a_written_table(spark, monkeypatch, name):
    """The fit, the scores and the encodings would each run the scans, joins and windows again."""
    from demandspark.operators import models

    seen = []

    def fitted(train, test, *args, **kwargs):
        seen.extend(plan(half) for half in (train, test))
        return test.select(*args[0], "year_week", F.lit(0.0).alias("predicted"))

    monkeypatch.setattr(models, "gbt_global", fitted)
    catalog.QUERIES[name](spark, FOLDER)
    assert len(seen) == 2 and not any(word in text for text in seen for word in ("lineitem", "Window", "Join"))


@pytest.mark.parametrize("name", ["M04_gbt_cyclical", "M05_winsorised_by_sku"])
def test_written_features_need_no_distinct_orders(spark, monkeypatch, name):
    """the lines are combined to weeks before their only shuffle by sku."""
    from demandspark.plans import q_models

    class Written(Exception):
        pass

    seen = []

    def stop(df):
        seen.append(plan(df))
        raise Written

    monkeypatch.setattr(q_models, "pin", stop)
    with pytest.raises(Written):
        catalog.QUERIES[name](spark, FOLDER)
    assert "weekly_quantity" in seen[0] and "invoice_id" not in seen[0]
