from datetime import date

from pyspark.sql import functions as F

from demandspark.functions import calendar as cal
from demandspark.functions import clean
from demandspark.sources import sheets


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_year_week_variants_at_the_year_border(spark):
    day = F.lit("2024-12-30").cast("date")
    row = one(spark, cal.year_week(day), cal.year_week(day, iso_year=False))
    assert tuple(row) == ("2025-W01", "2024-W01")


def test_week_start_round_trip_over_53_week_years(spark):
    df = cal.week_calendar(spark, "2019-12-30", "2027-01-10")
    back = df.select("year_week", "week_start", cal.week_start("year_week").alias("again"))
    assert back.where(F.col("week_start") != F.col("again")).count() == 0
    assert back.where(F.col("year_week") == "2020-W53").count() == 1
    assert back.where(F.col("year_week") == "2021-W53").count() == 0


def test_easter(spark):
    years = {2024: date(2024, 3, 31), 2025: date(2025, 4, 20), 2000: date(2000, 4, 23), 2038: date(2038, 4, 25)}
    df = spark.createDataFrame([(y,) for y in years], "y int").select("y", cal.easter_sunday(F.col("y")))
    assert {r[0]: r[1] for r in df.collect()} == years


def test_week_53_quarter_and_month(spark):
    w = F.lit(53)
    assert tuple(one(spark, cal.week_month(w), cal.week_quarter(w), cal.week_quarter(w, "nb"))) == (12, 4, 5)


def test_period_variants_differ_for_late_weeks_of_an_earlier_year(spark):
    key = F.lit("2024-W40")
    assert tuple(one(spark, cal.period(key), cal.period(key, "2025-W26"))) == ("H2", "H1")


def test_holiday_season_variants(spark):
    found = {}
    for variant in ("sql", "v3", "v3_2", "v4"):
        df = spark.range(1, 54).select(F.col("id").cast("int").alias("week_num"))
        flags = cal.calendar_flags(df, "week_num", variant).where("is_holiday_season = 1")
        found[variant] = [r[0] for r in flags.select("week_num").orderBy("week_num").collect()]
    assert found["sql"] == list(range(47, 53))
    assert found["v3"] == list(range(47, 54))
    assert found["v3_2"] == list(range(45, 54))
    assert found["v4"] == [1, 2, *range(45, 54)]


def test_sku_code(spark):
    df = spark.createDataFrame([("1616.0",), (" 77 ",), ("X-9",), ("",), (None,)], "s string")
    got = df.select(clean.sku_code("s"), clean.sku_code("s", strict=False)).collect()
    assert [tuple(r) for r in got] == [("1616", "1616"), ("77", "77"), (None, "X-9"), (None, ""), (None, None)]


def test_normalise_lines(spark, rows):
    df = spark.createDataFrame(
        [
            ("1", "2", "10", None),  # total from price
            ("2", "4", "0", "20"),  # price from total
            ("3", "-1", "5", "5"),  # returned
            ("x", "1", "5", "5"),  # no code
            ("4", "1", "bad", None),  # nothing known
        ],
        "sku string, quantity string, price string, total string",
    )
    out = clean.normalise_lines(df).select("sku", "quantity", "unit_price", "line_total")
    assert rows(out, "sku") == [("1", 2.0, 10.0, 20.0), ("2", 4.0, 5.0, 20.0), ("4", 1.0, 0.0, 0.0)]


def test_category_levels(spark):
    paths = ["Root/A/B/C", "Root/A", "Root", "", None, " / Root / A "]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    l1, l2, l3 = clean.category_levels("p")
    assert [tuple(r) for r in df.select(l1, l2, l3).collect()] == [
        ("A", "B", "C"),
        ("A", "A", "A"),
        ("Unknown", "Unknown", "Root"),
        ("Unknown", "Unknown", "Unknown"),
        ("Unknown", "Unknown", "Unknown"),
        ("A", "A", "A"),
    ]


def test_clip_keeps_null_and_list_literal(spark):
    row = one(
        spark,
        clean.clip(F.lit(None).cast("double"), 0.0, 1.0),
        clean.clip(F.lit(7.0), 0.0, 1.0),
        clean.list_text(F.lit("['592', '573']")),
        clean.fmt_number(F.lit(1234567.0), "R"),
    )
    assert tuple(row) == (None, 1.0, "592, 573", "R1,234,567")


def test_clean_nulls(spark):
    df = spark.createDataFrame([("NaN", float("inf")), ("none", float("nan")), ("ok", 1.0), (None, None)], "s string, d double")
    assert [tuple(r) for r in clean.clean_nulls(df).collect()] == [(None, None), (None, None), ("ok", 1.0), (None, None)]


def test_sheet_kinds(spark):
    names = {
        "12345": "invoice",
        "123 45.": "invoice",
        "1234": "other",
        "March 2025": "summary",
        "Summary": "summary",
        "Debtors Masterfile": "debtors",
        "Sheet1": "other",
        "12345 jan": "other",
    }
    df = spark.createDataFrame([(n,) for n in names], "s string").select("s", sheets.classify_sheet("s"))
    assert {r[0]: r[1] for r in df.collect()} == names


def test_source_choice(spark, rows):
    names = ["a_CapeTown.xlsx", "a_CapeTown_v2.xlsx", "a_CapeTown-corrected.xlsx", "~$a_CapeTown-corrected.xlsx", "a.xlsm"]
    df = spark.createDataFrame([("m1", "C", n) for n in names] + [("m2", "C", names[0]), ("m2", "C", names[1])], "month string, region string, file_name string")
    assert rows(sheets.select_sources(df), "month") == [("m1", "C", "a_CapeTown-corrected.xlsx"), ("m2", "C", "a_CapeTown_v2.xlsx")]


def test_invoice_header_fallbacks(spark, rows):
    lines = spark.createDataFrame([("i1",), ("i2",), ("i3",)], "invoice_id string")
    summary = spark.createDataFrame([("i1", "2025-03-04", "c1", ""), ("i2", "bad", "c2", "Own")], "invoice_id string, order_date string, customer_id string, customer_name string")
    debtors = spark.createDataFrame([("c1", "Master"), ("c2", "Other")], "customer_id string, customer_name string")
    out = sheets.attach_invoice_header(lines, summary, debtors, F.lit("2025-03-01").cast("date"))
    assert rows(out.select("invoice_id", "order_date", "customer_id", "customer_name"), "invoice_id") == [
        ("i1", date(2025, 3, 4), "c1", "Master"),
        ("i2", date(2025, 3, 1), "c2", "Own"),
        ("i3", date(2025, 3, 1), "", ""),
    ]
