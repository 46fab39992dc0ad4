"""ISO week arithmetic and calendar features."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Week numbers that close a month, and a quarter.
MONTH_END_SQL = (4, 8, 13, 17, 22, 26, 30, 35, 39, 43, 48, 52)
MONTH_END_NB = (4, 8, 13, 17, 21, 26, 30, 35, 39, 43, 47, 52)
MONTH_START_NB = (1, 5, 9, 14, 18, 22, 27, 31, 36, 40, 44, 48)
QUARTER_END = (13, 26, 39, 52)
PEAK_WEEK = 47


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """Boolean to 0/1."""
    return condition.cast("int")


def year_week(c: Column | str, iso_year: bool = True) -> Column:
    """`YYYY-Wnn`; `iso_year=False` pairs the calendar year with the ISO week."""
    day = as_col(c).cast("date")
    year = F.extract(F.lit("YEAROFWEEK"), day) if iso_year else F.year(day)
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def week_num(c: Column | str) -> Column:
    """Week number out of `YYYY-Wnn`."""
    return F.regexp_extract(as_col(c), r"W(\d+)", 1).try_cast("int")


def week_start(c: Column | str) -> Column:
    """Monday of an ISO `YYYY-Wnn`."""
    key = as_col(c)
    first_monday = F.trunc(F.make_date(F.substring(key, 1, 4).cast("int"), F.lit(1), F.lit(4)), "week")
    return F.date_add(first_monday, (week_num(key) - 1) * 7)


def split_week(c: Column | str) -> tuple[Column, Column]:
    """Year text and week text."""
    key = as_col(c)
    return F.substring(key, 1, 4), F.substring(key, 7, 2)


def temporal_features(df: DataFrame, day: str) -> DataFrame:
    """Calendar parts of a date; Monday is day 0."""
    d = F.col(day).cast("date")
    weekday = F.weekday(d)
    return df.withColumns(
        {
            "year": F.year(d),
            "month": F.month(d),
            "week_of_year": F.weekofyear(d),
            "day_of_week": weekday,
            "day_of_month": F.dayofmonth(d),
            "quarter": F.quarter(d),
            "is_weekend": flag(weekday >= 5),
            "is_month_start": flag(F.dayofmonth(d) <= 7),
            "is_month_end": flag(F.dayofmonth(d) >= 25),
            "week_start": F.trunc(d, "week"),
        }
    )


def week_month(c: Column | str) -> Column:
    """Month of a week number, four weeks a month, at most 12."""
    return F.least(F.floor((as_col(c) - 1) / 4) + 1, F.lit(12)).cast("int")


def week_quarter(c: Column | str, variant: str = "v0") -> Column:
    """Quarter via `week_month` (v0) or thirteen-week blocks (nb; week 53 gives 5)."""
    if variant == "nb":
        return (F.floor((as_col(c) - 1) / 13) + 1).cast("int")
    return (F.floor((week_month(c) - 1) / 3) + 1).cast("int")


def holiday_season(w: Column, variant: str) -> Column:
    """The four late-year definitions: sql 47..52, v3 from 47, v3_2 from 45, v4 from 45 and to week 2."""
    return {
        "sql": w.between(47, 52),
        "v3": w >= 47,
        "v3_2": w >= 45,
        "v4": (w >= 45) | (w <= 2),
    }[variant]


def calendar_flags(df: DataFrame, week: str = "week_num", variant: str = "sql") -> DataFrame:
    """Calendar flags of a week number, per variant."""
    w = F.col(week)
    flags: dict[str, Column] = {"is_w47": flag(w == PEAK_WEEK)}
    if variant == "nb":
        flags |= {"is_month_start": flag(w.isin(*MONTH_START_NB)), "is_month_end": flag(w.isin(*MONTH_END_NB))}
        return df.withColumns(flags)
    flags["is_holiday_season"] = flag(holiday_season(w, variant))
    if variant == "sql":
        flags |= {
            "week_of_month": (w - 1) % 4 + 1,
            "is_month_end": flag(w.isin(*MONTH_END_SQL)),
            "is_quarter_end": flag(w.isin(*QUARTER_END)),
        }
    elif variant == "v3":
        flags |= {"is_month_start": flag(w % 4 == 1), "is_month_end": flag(w % 4 == 0)}
    return df.withColumns(flags)


def cyclical(df: DataFrame, week: str = "week_num", period: int = 52) -> DataFrame:
    """Sine and cosine of the week angle."""
    angle = F.col(week) * (2 * math.pi / period)
    return df.withColumns({"week_sin": F.sin(angle), "week_cos": F.cos(angle)})


def period(c: Column | str, cut: int | str = 26) -> Column:
    """H1/H2 by week number (int cut) or by `YYYY-Wnn` order (string cut)."""
    key = as_col(c)
    first_half = week_num(key) <= cut if isinstance(cut, int) else key <= cut
    return F.when(first_half, "H1").otherwise("H2")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole days."""
    return F.datediff(as_col(later).cast("date"), as_col(earlier).cast("date"))


def week_calendar(spark: SparkSession, first: str | date, last: str | date) -> DataFrame:
    """One row per ISO week between two dates (years of 52 or 53 weeks alike)."""
    days = spark.range(1).select(
        F.explode(
            F.sequence(
                F.trunc(F.lit(str(first)).cast("date"), "week"),
                F.trunc(F.lit(str(last)).cast("date"), "week"),
                F.expr("interval 7 days"),
            )
        ).alias("week_start")
    )
    return days.select("week_start", year_week("week_start").alias("year_week"))


def calendar_of(df: DataFrame, week: str = "year_week") -> DataFrame:
    """P34 over the weeks a table spans: first to last, no gaps, one row per week."""
    span = df.select(F.min(week).alias("a"), F.max(week).alias("b")).select(
        week_start("a").alias("a"), week_start("b").alias("b")
    )
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 7 days"))).alias("week_start"))
    return days.select("week_start", year_week("week_start").alias("year_week"))


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter in closed form, one expression over the year."""
    a = year % 19
    century = F.floor(year / 100)
    rest = year % 100
    leap = F.floor(century / 4)
    drift = F.floor((century - F.floor((century + 8) / 25) + 1) / 3)
    moon = (19 * a + century - leap - drift + 15) % 30
    sunday = (32 + 2 * (century % 4) + 2 * F.floor(rest / 4) - moon - rest % 4) % 7
    late = F.floor((a + 11 * moon + 22 * sunday) / 451)
    serial = moon + sunday - 7 * late + 114
    return F.make_date(year.cast("int"), F.floor(serial / 31).cast("int"), (serial % 31 + 1).cast("int"))


def holiday_flags(df: DataFrame, week: str = "year_week", holidays: DataFrame | None = None) -> DataFrame:
    """Easter week, new-year slowdown, late-year season; `holidays(week_start)` marks extra weeks.

    The holiday list holds a few rows per year and is unique on `week_start`.
    """
    key = F.col(week)
    w = week_num(key)
    out = df.withColumns(
        {
            "is_easter_week": flag(
                F.trunc(easter_sunday(F.substring(key, 1, 4).cast("int")), "week") == week_start(key)
            ),
            "is_new_year_slowdown": flag(w <= 2),
            "is_late_year": flag(w >= 48),
        }
    )
    if holidays is None:
        return out
    marks = holidays.select(F.col("week_start").alias("_hs"), F.lit(1).alias("_h")).distinct()
    joined = out.join(marks, week_start(key) == F.col("_hs"), "left")
    return joined.withColumn("is_holiday_week", F.coalesce("_h", F.lit(0))).drop("_hs", "_h")
