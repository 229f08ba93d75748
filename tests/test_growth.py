"""What a query builds and moves must follow from its own question: the steps that grew faster than their input."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tallyward.contracts import CONTRACTS, POS_SALES
from tallyward.functions import table_functions
from tallyward.operators import forecasting, joins, quality, validation
from tallyward.sources import driver_tables as raw
from tallyward.verification.stage import Stage

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_a_function_builds_its_own_tables_only(spark):
    s = Stage(spark, SF_DIR)
    s.register_functions("store_variances")
    assert not spark.table("variances_by_store").isEmpty()
    assert not s.stored & {"refunds", "journals", "gl_journal", "daily_revenue", "margin", "margin_alerts", "fraud_scores", "recon_exceptions"}
    assert table_functions.VIEWS.keys() == table_functions.SIGNATURES.keys() == table_functions.BODIES.keys()


@needs_tables
def test_a_check_builds_its_own_tables_only(spark):
    s = Stage(spark, SF_DIR)
    assert quality.run_check("gold_adds_up", s).first()["passed"]
    assert not s.stored & {"refunds", "journals", "gl_journal", "quarantine", "rolled", "budget"}


def test_known_parents_do_not_move_whole_rows(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")  # the parents are larger
    try:
        rows = spark.range(9000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.repeat(F.lit("wide"), 9).alias("w"))
        got = joins.mark_known(rows, "k", rows.where("k <> 'k7'").select("k"), "known")
        assert "SortMergeJoin" not in plan_of(got) and "Exchange hashpartitioning" not in plan_of(got)
        assert [r["k"] for r in got.where("not known").collect()] == ["k7"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("few", [validation.FEW_KEYS, 0])
def test_single_keys_are_not_gathered(spark, monkeypatch, few):
    monkeypatch.setattr(validation, "FEW_KEYS", few)
    names = [n for n in POS_SALES.names if n not in POS_SALES.key]
    rows = spark.range(60).select(
        F.concat(F.lit("T"), F.col("id") % 50).alias("transaction_id"),
        F.lit(1).alias("line_no"),
        *[F.col("id").cast("string").alias(n) for n in (*names, *[c.target for c in POS_SALES.conversions])],
        F.lit("f").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
    )
    got = validation.latest_per_key(rows, CONTRACTS["pos_sales"])
    want = sorted([str(i) for i in range(10, 50)] + [max(str(i), str(i + 50)) for i in range(10)])
    assert sorted(r["store_id"] for r in got.collect()) == want
    unique = validation.latest_per_key(rows.where("id < 50"), CONTRACTS["pos_sales"])
    assert "Exchange" not in plan_of(unique) and unique.count() == 50


@pytest.mark.parametrize("words", [1, 64, validation.FILTER_WORDS])
def test_many_repeated_keys_move_their_own_rows(spark, monkeypatch, words):
    monkeypatch.setattr(validation, "FILTER_WORDS", words)
    hashed = spark.range(4000).select("id", F.xxhash64("id").alias("__h"))
    single, moved = validation._sifted(hashed, hashed.where("id % 10 = 0").select("__h"))
    stay, go = ({r["id"] for r in df.collect()} for df in (single, moved))
    assert stay | go == set(range(4000)) and not stay & go and go >= set(range(0, 4000, 10))
    assert (len(go) == 400) == (words > 64)


def test_faulty_ledger_reads_the_journals_once(spark, tmp_path):
    lines = spark.range(3000).selectExpr(
        "concat('J', id, '-POS') as journal_id", "1 as line_no", "date_add(date'1995-01-01', int(id)) as posting_date", "'4000' as account_code", "'Revenue' as account_name",
        "'S00000000' as store_id", "cast(0 as decimal(18,2)) as debit_eur", "cast(10 as decimal(18,2)) as credit_eur", "'POS' as source", "'Daily sales' as description",
    )
    lines.write.parquet(f"{tmp_path}/j")
    got = raw.faulty_ledger(spark.read.parquet(f"{tmp_path}/j"))
    assert plan_of(got).count("FileScan") == 1
    missing, high, twice, manual = (len(range(0, 3000, n)) for n in (97, 101, 103, 107))
    assert got.where("journal_id like '%-DUP'").count() == twice - 1  # day 0 is not booked
    assert got.where("source = 'MANUAL'").count() == 2 * manual
    assert got.where("source = 'POS'").count() == 3000 - missing + twice - 1
    assert got.where("credit_eur = 15 and journal_id not like '%-DUP'").count() == high - 1
    assert got.where("source = 'MANUAL'").agg(F.sum(F.col("debit_eur") - F.col("credit_eur"))).first()[0] == 0


@needs_tables
def test_refunds_are_audited_without_storing_the_sales(spark):
    s, whole = Stage(spark, SF_DIR), Stage(spark, SF_DIR)
    assert not s.refunds_month.isEmpty()
    assert not s.stored & {"pos_sales", "audited_pos_sales", "rolled", "gl_journal"}
    receipts = lambda df: {r[0] for r in df.select("transaction_id").collect()}
    assert receipts(s.receipts()) == receipts(whole.pos_sales) != set()


@needs_tables
def test_the_monthly_panel_needs_no_table_as_large_as_the_sales(spark):
    s, whole = Stage(spark, SF_DIR), Stage(spark, SF_DIR)
    assert s.last_complete() == forecasting.last_complete_month(whole.budget_variance)
    assert not s.panel.isEmpty()
    assert not s.stored & {"rolled", "budget", "budget_variance", "daily_revenue"}
    assert not whole.daily_revenue.isEmpty() and s.panel.exceptAll(whole.panel).isEmpty() and whole.panel.exceptAll(s.panel).isEmpty()


@needs_tables
@pytest.mark.parametrize("name", ["input_problems", "snapshot_composed"])
def test_rows_read_once_are_not_stored(spark, monkeypatch, name):
    s = Stage(spark, SF_DIR)
    monkeypatch.setattr(Stage, "of", classmethod(lambda cls, spark, sf_dir: s))
    assert not registry.queries()[name](spark, SF_DIR).isEmpty()
    assert "audited_pos_sales" in s.stored and not s.stored & {"pos_sales", "refunds", "journals", "gl_journal"}


def test_findings_are_listed_without_a_lambda_over_the_catalogue(spark):
    odd = [validation.Finding("big", F.col("id") > 2), validation.Finding("unknown", F.when(F.col("id") != 1, F.col("id") == 3))]
    got = spark.range(4).select("id", validation.reasons(odd).alias("found"))
    assert [r["found"] for r in got.orderBy("id").collect()] == [[], [], [], ["big", "unknown"]]
    assert "struct(" not in plan_of(got)


@needs_tables
def test_contract_findings_judge_rows_once_and_store_no_ledger(spark, monkeypatch):
    s = Stage(spark, SF_DIR)
    monkeypatch.setattr(Stage, "of", classmethod(lambda cls, spark, sf_dir: s))
    got = registry.queries()["contract_findings"](spark, SF_DIR)
    assert "sales_days" in s.stored and not s.stored & {"journals", "gl_journal"}
    assert "size(CASE" not in plan_of(got)


@needs_tables
def test_a_detection_is_scored_without_the_refunds(spark, monkeypatch):
    s = Stage(spark, SF_DIR)
    monkeypatch.setattr(Stage, "of", classmethod(lambda cls, spark, sf_dir: s))
    score = registry.queries()["detection_score"](spark, SF_DIR).first()
    assert score["planted"] > 0 and not s.stored & {"refunds", "audited_refunds", "refund_days", "gl_journal"}
    months = registry.queries()["close_overview_months"](spark, SF_DIR)
    assert not months.isEmpty() and not s.stored & {"rolled", "daily_revenue", "margin"}
