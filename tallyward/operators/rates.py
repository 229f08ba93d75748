"""Daily exchange rates and conversion to EUR."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.contracts import MONEY4, RATE, Conversion


def daily_rates(published: DataFrame, start, until) -> DataFrame:
    """One rate per currency and calendar day, EUR included at 1.

    A day without a published rate takes the last one before it; days before a currency's
    first rate take that first rate.  The series starts at the earlier of ``start`` and the
    first published day and ends at ``until``.

    Each published rate is stretched over the days it is valid for, so the work is one row
    per published rate plus the generated days: no grid of days and currencies is joined.
    """
    last = F.lit(until).cast("date")
    rates = (
        published.select("rate_date", "currency", "units_per_eur")
        .where("currency is not null and units_per_eur is not null")
        .where(F.col("rate_date") <= last)
    )
    span = published.agg(F.least(F.min("rate_date"), F.lit(start).cast("date")).alias("first_day"))
    # A few decades of days per currency at most: the window partitions are bounded by the calendar.
    timeline = Window.partitionBy("currency").orderBy("rate_date")
    origin = span.select("first_day").scalar()
    valid = (
        rates.withColumn("next_day", F.lead("rate_date").over(timeline))
        .withColumn("valid_from", F.when(F.row_number().over(timeline) == 1, origin).otherwise(F.col("rate_date")))
        .withColumn("valid_to", F.least(F.coalesce(F.date_sub("next_day", 1), last), last))
        .where("valid_from <= valid_to")
    )
    filled = valid.select(
        F.explode(F.sequence("valid_from", "valid_to")).alias("rate_date"), "currency", "units_per_eur"
    )
    home = span.where(F.col("first_day") <= last).select(
        F.explode(F.sequence("first_day", last)).alias("rate_date"),
        F.lit("EUR").alias("currency"),
        F.lit(1).cast(RATE).alias("units_per_eur"),
    )
    return filled.unionByName(home)


def with_rate(df: DataFrame, rates: DataFrame, day: str, currency: str, name: str = "units_per_eur") -> DataFrame:
    """Attach the rate of (currency, day); NULL where there is none."""
    narrow = rates.select(
        F.col("rate_date").alias(day), F.col("currency").alias(currency), F.col("units_per_eur").alias(name)
    )
    return df.join(F.broadcast(narrow), [day, currency], "left")  # bounded by the calendar and the currencies


def convert(df: DataFrame, rates: DataFrame, conversions: tuple[Conversion, ...]) -> tuple[DataFrame, dict[str, str]]:
    """Add the EUR columns; return the frame and, per target, the column holding its rate.

    Conversions that share a day and a currency share one join.
    """
    rate_of: dict[tuple[str, str], str] = {}
    for c in conversions:
        if (c.day, c.currency) not in rate_of:
            name = f"__rate{len(rate_of)}"
            df = with_rate(df, rates, c.day, c.currency, name)
            rate_of[c.day, c.currency] = name
    used = {c.target: rate_of[c.day, c.currency] for c in conversions}
    return df.withColumns(
        {c.target: F.round(F.try_divide(F.col(c.amount), F.col(used[c.target])), 4).cast(MONEY4) for c in conversions}
    ), used
