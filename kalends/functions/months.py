"""Months are ``yyyy-MM`` strings; arithmetic goes through the first day of the month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def first_day(period: Column) -> Column:
    return F.to_date(F.concat(period, F.lit("-01")))


def shift_month(period: Column, months: int | Column) -> Column:
    return F.date_format(F.add_months(first_day(period), months), "yyyy-MM")


def month_number(period: Column) -> Column:
    """Months since year zero, for calendar distance."""
    return F.substring(period, 1, 4).cast("int") * 12 + F.substring(period, 6, 2).cast("int")


def months_between(start: Column, end: Column) -> Column:
    """Array of every month from ``start`` to ``end``."""
    days = F.sequence(first_day(start), first_day(end), F.expr("interval 1 month"))
    return F.transform(days, lambda day: F.date_format(day, "yyyy-MM"))


def month_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.explode(months_between(F.lit(start), F.lit(end))).alias("period"))


def spine_of(df: DataFrame, period: str = "period") -> DataFrame:
    """Every month between the first and the last month of ``df``."""
    bounds = df.agg(F.min(period).alias("lo"), F.max(period).alias("hi")).filter(F.col("lo").isNotNull())
    return bounds.select(F.explode(months_between(F.col("lo"), F.col("hi"))).alias(period))


def release_lag(period: Column, release: Column) -> Column:
    """Days from the last day of the month to its release."""
    return F.datediff(release, F.last_day(first_day(period)))


def temporal_split(target: Column, development: tuple[str, str], holdout: tuple[str, str], outside: str | None = None) -> Column:
    return (
        F.when(target.between(*development), "DEVELOPMENT")
        .when(target.between(*holdout), "HOLDOUT")
        .otherwise(F.lit(outside))
    )
