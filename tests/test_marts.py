from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyward.operators import ledger, marts

D = dt.date


@pytest.fixture(scope="module")
def silver(spark):
    sold = [
        ("T1", 1, D(2026, 7, 31), "S1", "P1", 2, "2.00", "20.00", "16.81", "EUR", "card", "20.0000", "16.8100"),
        ("T1", 2, D(2026, 7, 31), "S1", "P2", 1, "0.00", "9.60", "9.60", "EUR", "cash", "9.6000", "9.6000"),
        ("T2", 1, D(2026, 8, 20), "S1", "P1", 1, "0.00", "10.00", "8.40", "EUR", "voucher", "10.0000", "8.4000"),
        ("T3", 1, D(2026, 8, 20), "S2", "P1", 4, "0.96", "38.40", "38.40", "CHF", "card", "40.0000", "40.0000"),
    ]
    names = "transaction_id line_no business_date store_id sku quantity discount_amount gross_amount net_amount currency payment_method gross_amount_eur net_amount_eur"
    money = {"discount_amount": 2, "gross_amount": 2, "net_amount": 2, "gross_amount_eur": 4, "net_amount_eur": 4}
    pos = spark.createDataFrame(sold, names.split()).withColumns({c: F.col(c).cast(f"decimal(18,{s})") for c, s in money.items()})
    refunds = spark.createDataFrame(
        [("S1", "C1", D(2026, 8, 1), True, "11.90", "0.19", "EUR", "cash"), ("S1", "C1", D(2026, 8, 2), False, "5.00", "0", "EUR", "card")],
        "store_id string, cashier_id string, business_date date, receipt_present boolean, refund_amount string, vat_rate string, currency string, refund_method string",
    ).withColumns(
        {
            "refund_amount": F.col("refund_amount").cast("decimal(18,2)"),
            "refund_amount_eur": F.col("refund_amount").cast("decimal(18,4)"),
            "vat_rate": F.col("vat_rate").cast("decimal(6,4)"),
        }
    )
    products = spark.sql("select 'P1' sku, 'food' category, cast(3 as decimal(18,2)) unit_cost_eur union all select 'P2', 'toys', cast(4 as decimal(18,2))")
    stores = spark.sql("select 'S1' store_id, 'express' format, 'DE' country union all select 'S2', 'online', 'CH'")
    rates = spark.sql(
        "select explode(sequence(date'2026-07-31', date'2026-08-20')) rate_date, 'EUR' currency, cast(1 as decimal(18,6)) units_per_eur "
        "union all select explode(sequence(date'2026-07-31', date'2026-08-20')), 'CHF', cast(0.96 as decimal(18,6))"
    )
    budget = spark.sql(
        "select 'S1' store_id, '2026-08' budget_month, cast(31000 as decimal(18,2)) revenue_budget_eur, cast(3100 as decimal(18,2)) cogs_budget_eur "
        "union all select 'S2', '2026-08', cast(0 as decimal(18,2)), cast(0 as decimal(18,2)) union all select 'S9', '2026-08', cast(1 as decimal(18,2)), cast(1 as decimal(18,2))"
    )
    return dict(pos_sales=pos, refunds=refunds, products=products, stores=stores, rates=rates, budget=budget)


@pytest.fixture(scope="module")
def gold(silver):
    return {k: v.cache() for k, v in marts.gold_tables(**silver).items()}


def test_daily_revenue_counts_receipts_once(gold):
    row = gold["daily_revenue"].where("store_id = 'S1' and business_date = '2026-07-31'").first()
    assert (row["channel"], row["transactions"], row["lines"], row["units"]) == ("store", 1, 2, 3)
    assert (row["net_sales_eur"], row["cogs_eur"], row["discount_eur"]) == (Decimal("26.41"), Decimal("10.00"), Decimal("2.00"))
    swiss = gold["daily_revenue"].where("store_id = 'S2'").first()
    assert swiss["channel"] == "online" and swiss["discount_eur"] == Decimal("1.00")


def test_margin_and_refunds(gold):
    toys = gold["margin"].where("category = 'toys'").first()
    assert float(toys["margin_pct"]) == round((9.6 - 4) / 9.6, 4) and float(toys["discount_rate"]) == 0
    row = gold["refunds"].first()
    assert (row["refunds"], row["no_receipt_refunds"]) == (2, 1)
    assert (row["refund_net_eur"], row["no_receipt_eur"]) == (Decimal("15.00"), Decimal("5.00"))
    assert float(row["no_receipt_share"]) == round(5 / 16.9, 4)


def test_budget_is_scaled_to_the_days_passed(gold):
    rows = {(r["store_id"], r["month"]): r for r in gold["budget_variance"].collect()}
    assert set(rows) == {("S1", "2026-07"), ("S1", "2026-08"), ("S2", "2026-08")}  # a budget without sales is left out
    august = rows["S1", "2026-08"]
    assert august["budget_to_date_eur"] == Decimal("20000.00") and august["budget_cogs_to_date_eur"] == Decimal("2000.00")
    assert not august["complete_month"] and august["has_budget"]
    assert rows["S2", "2026-08"]["variance_pct"] is None  # zero budget
    july = rows["S1", "2026-07"]
    assert july["complete_month"] and not july["has_budget"] and july["budget_to_date_eur"] is None


def test_rollup_gives_the_same_tables(silver, gold):
    lines = marts.sales_lines(silver["pos_sales"], silver["products"], silver["stores"], silver["rates"])
    assert sorted(marts.margin(lines).collect()) == sorted(gold["margin"].collect())


def test_tie_outs_hold_and_catch_a_doubled_category(silver, gold):
    args = (silver["pos_sales"], silver["refunds"], silver["budget"])
    assert marts.tie_outs(gold, *args).where("not ok").count() == 0
    doubled = {**gold, "margin": gold["margin"].unionByName(gold["margin"].where("category = 'toys'"))}
    bad = {r["check"] for r in marts.tie_outs(doubled, *args).where("not ok").collect()}
    assert bad == {"margin net sales", "margin cost of goods"}


def test_journals_balance_and_match_the_tills(silver):
    gl = ledger.post_journals(silver["pos_sales"], silver["refunds"], silver["products"], silver["rates"]).cache()
    totals = gl.groupBy("journal_id").agg(F.sum("debit_eur").alias("d"), F.sum("credit_eur").alias("c")).collect()
    assert len(totals) == 3 * 2 + 2 and all(r["d"] == r["c"] for r in totals)
    assert gl.where("(debit_eur > 0) = (credit_eur > 0)").count() == 0
    revenue = {(r["store_id"], r["posting_date"]): r["credit_eur"] for r in gl.where("account_code = '4000'").collect()}
    assert revenue == {("S1", D(2026, 7, 31)): Decimal("26.41"), ("S1", D(2026, 8, 20)): Decimal("8.40"), ("S2", D(2026, 8, 20)): Decimal("40.00")}
    lines = gl.where("journal_id = 'J20260731-S1-POS'").orderBy("line_no").collect()
    assert [r["line_no"] for r in lines] == list(range(1, len(lines) + 1))


def test_budget_from_prior_year(spark):
    lines = spark.sql(
        "select 'S1' store_id, date'2025-03-04' business_date, cast(10000 as decimal(18,4)) net_amount_eur, cast(4000 as decimal(18,2)) cogs_eur "
        "union all select 'S1', date'2024-03-04', cast(5 as decimal(18,4)), cast(1 as decimal(18,2))"
    )
    row = ledger.budget_from_prior_year(lines, 2025).collect()
    assert [tuple(r) for r in row] == [("S1", "2026-03", Decimal("10500.00"), Decimal("4200.00"))]


def test_highlights(gold):
    top = marts.top_no_receipt_cashiers(gold["refunds"])
    assert [r["cashier_id"] for r in top.collect()] == ["C1"]
    assert marts.largest_margin_drops(gold["margin"]).count() == 0  # no January-May to compare with
