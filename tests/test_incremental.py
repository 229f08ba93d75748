"""Silver kept up to date by deliveries: the same tables as a full rebuild, without writing untouched months again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyward.contracts import CONTRACTS
from tallyward.plans import jobs
from tallyward.sources import tables
from test_jobs import shop

MOVED = "T20260505S1"


def deliver(ws, name, df, part):
    text = df.select(*[F.col(c).cast("string") for c in CONTRACTS[name].names])
    text.coalesce(1).write.mode("append").option("header", True).option("nullValue", "").csv(f"{ws.root}/landing/{name}")


def first_delivery(ws, tables_of):
    """Everything but the sales of August; one sale of May carries a date of March, another an unknown article."""
    for name, df in tables_of.items():
        if name == "pos_sales":
            df = df.where("business_date < '2026-08-01'")
            moved = df.where(F.col("transaction_id") == MOVED).withColumns({"business_date": F.lit("2026-03-05").cast("date"), "transaction_ts": F.lit("2026-03-05").cast("timestamp")})
            bad = df.where("transaction_id = 'T20260506S1'").withColumn("sku", F.lit("P-unknown"))
            df = df.where(~F.col("transaction_id").isin(MOVED, "T20260506S1")).unionByName(moved).unionByName(bad)
        deliver(ws, name, df, 1)
    jobs.ingest_bronze(ws)


def second_delivery(ws, tables_of):
    sales = tables_of["pos_sales"].where(f"business_date >= '2026-08-01' or transaction_id in ('{MOVED}', 'T20260506S1')")
    deliver(ws, "pos_sales", sales, 2)
    jobs.ingest_bronze(ws, ("pos_sales",))


def content(ws):
    out = {t: ws.table("silver", t).drop("_source_file", "_ingested_at") for t in ("pos_sales", "refunds", "fx_daily")}
    out["quarantine"] = ws.table("silver", "quarantine").select("source", "record_key", F.array_join("reasons", ",").alias("r"), "record")
    return {t: sorted(map(str, df.collect())) for t, df in out.items()}


def files(ws, table):
    rows = ws.table("silver", table).select("month", "_metadata.file_path", "_metadata.file_modification_time").distinct().collect()
    return {m: {(p, t) for k, p, t in rows if k == m} for m in {r[0] for r in rows}}


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("kept"))
    ws = jobs.Workspace(spark, root, "kept").create()
    tables_of = {n: df.persist() for n, df in shop(spark).items()}
    first_delivery(ws, tables_of)
    assert {r["source"] for r in jobs.update_silver(ws).collect()} == set(CONTRACTS)  # nothing to build on: a full build
    held = ws.table("silver", "quarantine").groupBy("source").count().collect()
    assert {r["source"] for r in held} == {"pos_sales", "refunds"}
    before = {t: files(ws, t) for t in jobs.FACTS}
    second_delivery(ws, tables_of)
    accounting = {r["source"]: r for r in jobs.update_silver(ws).collect()}
    yield ws, before, accounting
    for df in tables_of.values():
        df.unpersist()


def test_an_update_equals_a_full_rebuild(spark, kept):
    ws, before, accounting = kept
    updated = content(ws)
    assert set(accounting) == {"pos_sales", "refunds"} and all(r["balanced"] for r in accounting.values())
    after = {t: files(ws, t) for t in jobs.FACTS}
    changed = {t: {m for m in before[t].keys() | after[t].keys() if before[t].get(m) != after[t].get(m)} for t in jobs.FACTS}
    assert changed == {"pos_sales": {"2026-03", "2026-05", "2026-08"}, "refunds": {"2026-08"}}
    jobs.build_silver(ws)
    rebuilt = content(ws)
    assert {t: set(rebuilt[t]) ^ set(updated[t]) for t in rebuilt} == {t: set() for t in rebuilt} and rebuilt == updated
    left = ws.table("silver", "quarantine").where("source = 'pos_sales'").collect()
    assert [r["reasons"] for r in left] == [["ref:sku"]] * 2  # the rows with the unknown article stay held, their corrections are in
    assert ws.table("silver", "quarantine").where("source = 'refunds'").isEmpty()


def test_nothing_new_changes_nothing(spark, kept):
    ws = kept[0]
    before = {t: files(ws, t) for t in jobs.FACTS}
    assert jobs.update_silver(ws).isEmpty()
    assert {t: files(ws, t) for t in jobs.FACTS} == before


def test_an_update_that_is_repeated_after_a_failure(spark, kept):
    """The marks are written last: without them the same batches are merged once more."""
    ws = kept[0]
    expected = content(ws)
    name = ws.name("ops", "silver_batches")
    marks = ws.store(ws.table("ops", "silver_batches").where("not (source = 'pos_sales' and batch = 1)"), "marks_again")
    tables.replace_table(marks, name)
    assert {r["source"] for r in jobs.update_silver(ws).collect()} == {"pos_sales", "refunds"}
    assert content(ws) == expected


def test_changed_masters_rebuild(spark, kept):
    ws = kept[0]
    article = spark.sql("select 'P-unknown' as sku, 'food' as category, true as reduced_vat, 1.00 as list_price_eur, 0.50 as unit_cost_eur")
    deliver(ws, "products", article, 3)
    jobs.ingest_bronze(ws, ("products",))
    assert {r["source"] for r in jobs.update_silver(ws).collect()} == set(CONTRACTS)
    assert ws.table("silver", "quarantine").isEmpty()


def test_partitions_are_replaced_and_emptied(spark):
    spark.sql("DROP TABLE IF EXISTS by_part")
    make = lambda *r: spark.createDataFrame(list(r), "x long, month string")
    tables.replace_table(make((1, "a"), (2, "b"), (3, "c")), "by_part", ("month",))
    tables.replace_partitions(make((4, "b")), "by_part", "month", ["a", "b"])
    assert sorted(map(tuple, spark.table("by_part").collect())) == [(3, "c"), (4, "b")]
    with pytest.raises(ValueError, match="outside"):
        tables.replace_partitions(make((4, "z")), "by_part", "month", ["a"])
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
