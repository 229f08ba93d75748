from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyward.operators import evidence, quality


def one(df):
    return df.first().asDict()


def test_each_check_finds_its_fault(spark):
    pos = spark.sql(
        """select * from values
        ('T1', 1, 'S1', 'P1', date'2026-08-03', 2, 10.0, 10.00), ('T1', 1, 'S1', 'P1', date'2026-08-03', 2, 10.0, 10.00),
        ('T2', 1, 'S9', 'P9', date'2026-08-05', 600, 60000.0, 60000.00)
        as t(transaction_id, line_no, store_id, sku, business_date, quantity, net_amount_eur, gross_amount)"""
    )
    refunds = spark.sql(
        """select * from values ('T1', 'P1', true, 20.02, 5.0), ('T2', 'P9', true, 1.00, 20000.0), ('T1', 'P1', false, 99.0, 0.0)
        as t(original_transaction_id, sku, receipt_present, refund_amount, refund_amount_eur)"""
    )
    gl = spark.sql("select * from values ('J2', 1.0, 2.0), ('J1', 3.0, 2.0), ('J3', 2000000.0, 2000000.0) as t(journal_id, debit_eur, credit_eur)")
    tables = {
        "pos_sales": pos,
        "refunds": refunds,
        "gl_journal": gl,
        "stores": spark.sql("select 'S1' store_id, 'DE' country, 'express' format"),
        "products": spark.sql("select 'P1' sku"),
        "quarantine": spark.sql("select * from values ('pos_sales'), ('stores'), ('stores') as t(source)"),
    }
    got = {r["check"]: r for r in quality.run_checks(tables, "silver").collect()}
    want = {
        "silver_keys_unique": 1, "journals_balance": 2, "amounts_in_range": 4, "sales_have_masters": 2, "quarantine_money": 1,
        "quarantine_masters": 2, "refund_within_sale": 1, "missing_store_days": 2, "volume_collapse": 0,
    }
    assert {c: r["violations"] for c, r in got.items()} == want
    assert got["journals_balance"]["detail"].endswith(": J1, J2")
    assert got["missing_store_days"]["detail"].endswith(": S1 2026-08-04, S1 2026-08-05")
    with pytest.raises(RuntimeError, match=r"5 critical.*journals_balance: 2"):
        quality.enforce(quality.run_checks(tables, "silver"))


def test_volume_collapse(spark):
    days = spark.sql("select explode(sequence(date'2026-01-05', date'2026-03-30', interval 7 day)) business_date")
    pos = days.select(F.lit("S1").alias("store_id"), "business_date", F.explode(F.sequence(F.lit(1), F.when(F.col("business_date") == "2026-02-02", 2).otherwise(9))).alias("n"))
    assert [(r["business_date"], r["lines"], r["usual"]) for r in quality.collapsed_days(pos).collect()] == [(dt.date(2026, 2, 2), 2, 9)]


def test_snapshots(spark):
    t = spark.range(100).withColumn("x", F.col("id") % 3)
    before = quality.snapshot({"t": t, "u": t})
    assert one(quality.silver_unchanged(before, quality.snapshot({"t": t.repartition(7), "u": t})))["passed"]
    doubled = t.unionByName(t)
    assert one(quality.silver_unchanged(before, quality.snapshot({"t": doubled, "u": t})))["detail"].endswith(": t")
    edited = t.withColumn("x", F.when(F.col("id") == 5, 0).otherwise(F.col("x")))
    assert one(quality.silver_unchanged(before, quality.snapshot({"t": edited, "u": edited})))["violations"] == 2
    assert one(quality.silver_unchanged(before.where("false"), before))["violations"] == 1
    assert one(quality.row_count_drop(before, quality.snapshot({"t": t.limit(94), "u": t.limit(95)})))["violations"] == 1
    assert one(quality.row_count_drop(before.where("false"), before))["passed"]


def test_certification(spark):
    results = spark.sql("select * from values ('a', 'critical', false), ('b', 'warning', false), ('c', 'critical', true) as t(`check`, severity, passed)")
    row = one(quality.certification(results, "r1"))
    assert (row["certified"], row["failed"]) == (False, "a")
    history = spark.sql("select * from values ('r1', true, '', timestamp'2026-01-01'), ('r2', false, 'a', timestamp'2026-01-02') as t(run_id, certified, failed, certified_at)")
    gold = quality.snapshot({"g": spark.range(3)})
    with pytest.raises(RuntimeError, match="not certified"):
        quality.require_certified(history, gold, gold)
    passed = history.where("run_id = 'r1'")
    assert quality.require_certified(passed, gold, gold) == "r1"
    with pytest.raises(RuntimeError, match="rewritten after run r1"):
        quality.require_certified(passed, gold, quality.snapshot({"g": spark.range(4)}))


def test_lineage(spark):
    edges = spark.createDataFrame(
        [("c.gold.a", "c.silver.x", ["1"]), ("c.gold.b", "c.silver.y", ["2"]), ("c.gold.d", "c.silver.z", ["1"]), ("c.silver.x", "c.bronze.x", ["9"])],
        "target string, source string, job_ids array<string>",
    )
    chains = evidence.lineage_chains(edges, "1")
    assert {tuple(r) for r in chains.collect()} == {("c.gold.a", "c.silver.x", "c.bronze.x"), ("c.gold.d", "c.silver.z", "")}
    required = spark.createDataFrame([("c.gold.a",), ("c.gold.b",)], "gold string")
    assert [r[0] for r in evidence.untraced(required, chains).collect()] == ["c.gold.b"]
    assert evidence.lineage_chains(edges).count() == 3


def test_grants(spark):
    def problems(*grants):
        df = spark.createDataFrame(grants, "principal string, privilege string, object_type string, object_name string")
        return sorted(r[0] for r in evidence.grant_problems(df).collect()), evidence.grants_visible(df, "me").first()[0]

    fine = [(evidence.ANALYSTS, "USE CATALOG", "CATALOG", "c"), (evidence.ANALYSTS, "USE_SCHEMA", "SCHEMA", "c.gold"), (evidence.ANALYSTS, "SELECT", "SCHEMA", "c.gold")]
    assert problems(*fine, ("someone", "MODIFY", "SCHEMA", "c.silver")) == ([], True)
    assert problems(*fine, ("users", "SELECT", "SCHEMA", "c.gold"))[0] == ["users has SELECT on schema c.gold"]
    assert problems(*fine[:2])[0] == ["finance-analysts lacks SELECT on gold"]
    assert problems(*fine, (evidence.ANALYSTS, "SELECT", "TABLE", "c.silver.t"))[0] == ["finance-analysts has SELECT on table c.silver.t"]
    assert not problems(("other", "SELECT", "TABLE", "c.ops.t"), ("me", "ALL", "SCHEMA", "c.ops"))[1]


def test_fingerprints_are_composed_of_files(spark):
    """One rewritten partition is one partition read; sums over files equal the full scan; empty tables have a row."""
    from tallyward.sources import tables

    spark.sql("DROP TABLE IF EXISTS composed")
    df = spark.range(100).selectExpr("id", "id % 7 as v", "concat('m', id % 5) as month")
    stored = tables.replace_table(df, "composed", ("month",))
    first = spark.createDataFrame(quality.file_fingerprints(stored, "t").collect(), quality.file_fingerprints(stored, "t").schema)
    whole = lambda: quality.fingerprint(spark.table("composed"), "t").collect()
    assert quality.composed(first, ["t"]).collect() == whole()
    tables.replace_partitions(df.where("month = 'm3'").withColumn("v", F.col("v") + 1), "composed", "month", ["m3"])
    second = quality.file_fingerprints(spark.table("composed"), "t", first)
    assert quality.composed(second, ["t"]).collect() == whole() != quality.composed(first, ["t"]).collect()
    new = {r["file"] for r in second.collect()} - {r["file"] for r in first.collect()}
    assert new and all("month=m3" in f for f in new)
    again = quality.file_fingerprints(spark.table("composed"), "t", second)
    assert sorted(map(str, again.collect())) == sorted(map(str, second.collect()))
    assert quality.composed(first.where("false"), ["t"]).collect() == [("t", 0, 0)]


def test_lines_without_masters_are_counted_per_master(spark):
    """A NULL store or product has no master either; a line that lacks both counts twice; nothing as large as the sales is stored."""
    pos = spark.sql("select * from values ('S1', 'P1'), ('S1', null), (null, 'P1'), (null, null), ('S9', 'P9'), ('S9', 'P1') as t(store_id, sku)")
    masters = {"stores": spark.sql("select 'S1' store_id"), "products": spark.sql("select 'P1' sku")}
    inputs = quality.Inputs({"pos_sales": pos, **masters})
    assert one(quality.run_check("sales_have_masters", inputs))["violations"] == 7
    assert inputs._sold_days is None
