"""The whole chain on a small made-up shop: files, silver, certified gold, models, table functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyward.contracts import CONTRACTS
from tallyward.operators import ledger, rates, reconcile
from tallyward.plans import jobs

FIRST, LAST = "2024-06-01", "2026-08-20"
FAKE = "J20260809-S1-MAN1"


def shop(spark):
    """Two stores, two products, one sale per store and open day, refunds every week."""
    stores = spark.sql(
        "select * from values ('S1', 'Shop 1', 'DE', 'EUR', 'north', 'express', 1.0, date'2020-01-01'), "
        "('S2', 'Shop 2', 'CH', 'CHF', 'south', 'online', 1.0, date'2020-01-01') "
        "as t(store_id, store_name, country, currency, region, format, size_factor, open_date)"
    )
    products = spark.sql("select * from values ('P1', 'food', true, 10.00, 6.00), ('P2', 'toys', false, 20.00, 9.00) as t(sku, category, reduced_vat, list_price_eur, unit_cost_eur)")
    cashiers = stores.select(F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n"), "store_id").select(F.format_string("%s-C%d", "store_id", "n").alias("cashier_id"), "store_id")
    days = spark.sql(f"select explode(sequence(date'{FIRST}', date'{LAST}')) as business_date")
    fx = days.where("weekday(business_date) < 5").selectExpr("business_date as rate_date", "'CHF' as currency", "cast(0.95 + dayofmonth(business_date) / 1000 as decimal(18,6)) as units_per_eur")
    open_days = days.join(stores.select("store_id", "currency", "format")).where("format = 'online' or weekday(business_date) < 6")
    pos = open_days.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("line_no")).selectExpr(
        "concat('T', date_format(business_date, 'yyyyMMdd'), store_id) as transaction_id", "line_no", "timestamp(business_date) as transaction_ts",
        "business_date", "store_id", "concat(store_id, '-C', 1 + dayofyear(business_date) % 3) as cashier_id", "concat('P', line_no) as sku",
        "1 + month(business_date) % 4 as quantity", "cast(12 * line_no as decimal(18,2)) as unit_price", "cast(0 as decimal(18,2)) as discount_amount",
        "cast(12 * line_no * (1 + month(business_date) % 4) as decimal(18,2)) as gross_amount", "cast(0.2 as decimal(6,4)) as vat_rate",
        "cast(10 * line_no * (1 + month(business_date) % 4) as decimal(18,2)) as net_amount", "cast(2 * line_no * (1 + month(business_date) % 4) as decimal(18,2)) as vat_amount",
        "currency", "element_at(array('card', 'cash', 'voucher'), 1 + dayofmonth(business_date) % 3) as payment_method", "false as promo_flag",
    )
    refunds = pos.where("line_no = 1 and dayofmonth(business_date) % 7 = 0").selectExpr(
        "concat('R', transaction_id) as refund_id", "transaction_ts as refund_ts", "business_date", "store_id", "cashier_id",
        "if(dayofmonth(business_date) = 7, null, transaction_id) as original_transaction_id", "if(dayofmonth(business_date) = 7, null, sku) as sku",
        "1 as quantity", "unit_price as refund_amount", "vat_rate", "currency", "dayofmonth(business_date) <> 7 as receipt_present",
        "'cash' as refund_method", "'damaged' as reason",
    )
    daily = rates.daily_rates(fx, FIRST, LAST)
    gl = ledger.post_journals(pos, refunds, products, daily)
    fake = spark.sql(
        f"select * from values ('{FAKE}', 1, date'2026-08-09', '1200', 'Card clearing', 'S1', 5000.00, 0.00, 'MANUAL', 'adjustment'), "
        f"('{FAKE}', 2, date'2026-08-09', '4000', 'Revenue', 'S1', 0.00, 5000.00, 'MANUAL', 'adjustment') as t(journal_id, line_no, posting_date, account_code, account_name, store_id, debit_eur, credit_eur, source, description)"
    )
    budget = spark.sql("select s as store_id, date_format(m, 'yyyy-MM') as budget_month, cast(900 as decimal(18,2)) revenue_budget_eur, cast(500 as decimal(18,2)) cogs_budget_eur from (select explode(array('S1', 'S2')) s), (select explode(sequence(date'2026-01-01', date'2026-12-01', interval 1 month)) m)")
    return dict(stores=stores, products=products, cashiers=cashiers, fx_rates=fx, pos_sales=pos, refunds=refunds, gl_journal=gl.unionByName(fake), budget=budget)


@pytest.fixture(scope="module")
def ws(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("shop"))
    for name, df in shop(spark).items():
        text = df.select(*[F.col(c).cast("string") for c in CONTRACTS[name].names])
        text.write.option("header", True).option("nullValue", "").csv(f"{root}/landing/{name}")
    work = jobs.Workspace(spark, root, "shop").create()
    jobs.ingest_bronze(work)
    return work


def test_whole_chain(spark, ws, tmp_path):
    accounting = {r["source"]: r for r in jobs.build_silver(ws).collect()}
    assert set(accounting) == set(CONTRACTS) and all(r["quarantined"] == r["duplicates"] == 0 for r in accounting.values())

    key = tmp_path / "key.csv"
    key.write_text(f"anomaly,entity_id\n{reconcile.PLANTED_ANOMALY},{FAKE}\n")
    run = jobs.build_gold(ws, "run1", str(key))
    assert tuple(ws.table("ops", "detection_scores").drop("scored_at").first()) == ("gl_pos_reconciliation", reconcile.PLANTED_ANOMALY, 1, 1, 0, 0)
    exceptions = ws.table("gold", "recon_exceptions").collect()
    assert [(r["journal_id"], r["reason"]) for r in exceptions] == [(FAKE, reconcile.UNSUPPORTED)]
    assert jobs.certified_run(ws) == run
    evidence = {r["kind"] for r in ws.table("ops", "lineage_evidence").collect()}
    assert "table" in evidence

    out = jobs.score_models(ws, rounds=2, trees=20)
    assert out["last_complete"] == "2026-07" and out["winner"] in ("model", "baseline")
    assert ws.table("gold", "revenue_forecast").count() == 6
    assert ws.table("ops", "model_drift").select("model").distinct().count() == 3
    assert ws.table("ops", "model_metrics").where("metric = 'flags_total'").count() == 2

    assert len(jobs.register_functions(ws)) == 7
    close = spark.sql("select * from close_overview('2026-08')").first()
    assert close["days_with_sales"] == 20 and close["complete_month"] is False
    assert float(close["budget_to_date_eur"]) == pytest.approx(2 * 900 * 20 / 31, abs=0.02)
    assert spark.sql("select * from close_overview('1999-01')").first()["days_with_sales"] == 0
    assert spark.sql("select journal_id from reconciliation_exceptions('2026-08')").collect()[0][0] == FAKE
    assert spark.sql("select * from gold_certification_status()").first()["gold_run"] == run
    count = spark.sql("select * from cashier_case_count('2026-07')")
    assert count.columns == ["month", "cashier_cases_referred", "cashier_months_scored"]

    spark.sql(f"insert into {ws.name('gold', 'margin')} select * from {ws.name('gold', 'margin')} limit 1")
    with pytest.raises(RuntimeError, match="rewritten after run run1"):
        jobs.certified_run(ws)


def test_lineage_is_what_was_read(ws):
    assert jobs.record_lineage(ws, "run1").first()["passed"]
    ws.begin()
    ws.publish(ws.table("gold", "margin").limit(1), "unread", "run1")  # nothing was read through the workspace for it
    edges = ws.table("ops", "lineage_edges")
    assert edges.where("target like '%unread'").isEmpty() and edges.where("target = 'shop.gold.margin' and source = 'shop.silver.pos_sales'").count() == 1
    other = jobs.record_lineage(ws, "a run that published nothing").first()
    assert not other["passed"] and other["violations"] == len(jobs.GOLD) + len(jobs.RECONCILED)


def test_wrong_grants_stop_publication(spark):
    schema = "principal string, privilege string, object_type string, object_name string"
    seen = spark.createDataFrame([("finance-analysts", "MODIFY", "SCHEMA", "c.gold")], schema)
    with pytest.raises(RuntimeError, match="finance-analysts has MODIFY"):
        jobs.require_access(seen, "me")
    jobs.require_access(seen.where("false"), "me")  # nothing visible: nothing proven


def test_detectors_are_scored_against_a_key(spark, ws):
    key = spark.createDataFrame([("A1_no_receipt_refunds", "S1-C1"), ("A2_discount_creep", "S2"), ("A3_unsupported_manual_revenue", "J")], "anomaly string, entity_id string")
    jobs.score_detectors(ws, key, ["2026-06", "2026-07"], "run1")
    scores = ws.table("ops", "detector_scores").collect()
    assert {(r["model"], r["entity"]) for r in scores} == {("fraud_scores", "S1-C1"), ("margin_alerts", "S2")} and len(scores) == 4


def test_a_failed_gate_is_recorded_but_not_certified(spark, ws):
    ledger_name = ws.name("silver", "gl_journal")
    spark.sql(f"insert into {ledger_name} select 'JX', 1, posting_date, account_code, account_name, store_id, 1.00, 0.00, source, description, _source_file, _ingested_at from {ledger_name} limit 1")
    with pytest.raises(RuntimeError, match="journals_balance"):
        jobs.build_gold(ws, "run2")
    assert ws.table("ops", "dq_results").where("run_id = 'run2' and `check` = 'journals_balance' and not passed").count() == 1
    assert ws.table("ops", "gold_certification").where("run_id = 'run2'").count() == 0
