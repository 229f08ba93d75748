from __future__ import annotations

import datetime as dt

import pytest

from conftest import rows
from tallyward.operators import opening, rates

D = dt.date


def published(spark, data):
    return spark.createDataFrame(data, "rate_date date, currency string, units_per_eur double").selectExpr(
        "rate_date", "currency", "cast(units_per_eur as decimal(18,6)) as units_per_eur"
    )


def test_rates_before_the_first_and_over_gaps(spark):
    fx = published(spark, [(D(2026, 1, 3), "CHF", 0.9), (D(2026, 1, 5), "CHF", 0.8)])
    got = rows(rates.daily_rates(fx, D(2026, 1, 1), D(2026, 1, 5)).where("currency = 'CHF'"), "rate_date")
    assert [float(rate) for _, _, rate in got] == [0.9, 0.9, 0.9, 0.9, 0.8]
    assert rates.daily_rates(fx, D(2026, 1, 1), D(2026, 1, 5)).count() == 10


def test_rates_published_after_the_end_are_unknown(spark):
    fx = published(spark, [(D(2026, 1, 2), "CHF", 0.9), (D(2026, 2, 1), "CHF", 0.7), (D(2026, 2, 1), "GBP", 0.8)])
    got = rates.daily_rates(fx, D(2026, 1, 1), D(2026, 1, 3))
    assert {r["currency"] for r in got.collect()} == {"CHF", "EUR"}
    assert {float(r["units_per_eur"]) for r in got.where("currency = 'CHF'").collect()} == {0.9}


def test_series_starts_at_the_first_published_day_if_earlier(spark):
    fx = published(spark, [(D(2025, 12, 30), "CHF", 0.9)])
    assert rates.daily_rates(fx, D(2026, 1, 1), D(2026, 1, 1)).where("currency = 'EUR'").count() == 3


def test_easter(spark):
    years = spark.createDataFrame([(2024,), (2025,), (2026,), (2038,), (1961,)], "year int")
    got = dict(years.select("year", opening.easter_sunday("year")).collect())
    assert got == {2024: D(2024, 3, 31), 2025: D(2025, 4, 20), 2026: D(2026, 4, 5), 2038: D(2038, 4, 25), 1961: D(1961, 4, 2)}


def test_holidays_differ_by_country(spark):
    got = {tuple(r) for r in opening.public_holidays(spark.createDataFrame([(2026,)], "year int")).collect()}
    assert ("DE", D(2026, 10, 3)) in got and ("CH", D(2026, 8, 1)) in got and ("CH", D(2026, 10, 3)) not in got
    assert ("DE", D(2026, 5, 14)) in got and len(got) == 18
    with pytest.raises(ValueError, match="FR"):
        opening.public_holidays(spark.createDataFrame([(2026,)], "year int"), ("FR",))


def test_open_days(spark):
    stores = spark.createDataFrame([("S1", "DE", "express"), ("S2", "CH", "express"), ("S3", "DE", "online")], "store_id string, country string, format string")
    got = rows(opening.expected_open_days(stores, D(2026, 8, 1), D(2026, 8, 3)), "store_id", "business_date")
    assert got == [
        ("S1", D(2026, 8, 1)), ("S1", D(2026, 8, 3)), ("S2", D(2026, 8, 3)),
        ("S3", D(2026, 8, 1)), ("S3", D(2026, 8, 2)), ("S3", D(2026, 8, 3)),
    ]
