from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyward.contracts import CONTRACTS, POS_SALES, REFUNDS, STORES
from tallyward.operators import rates, validation

GOOD = {
    "transaction_id": "T1", "line_no": "1", "transaction_ts": "2026-08-03 10:00:00", "business_date": "2026-08-03",
    "store_id": "S1", "cashier_id": "S1-C1", "sku": "P1", "quantity": " 2 ", "unit_price": "10.00",
    "discount_amount": "0", "gross_amount": "20.00", "vat_rate": "0.19", "net_amount": "16.81", "vat_amount": "3.19",
    "currency": "CHF", "payment_method": "card", "promo_flag": "True",
}


def bronze(spark, contract, records, file="a.csv", day=1):
    names = contract.names
    schema = ", ".join(f"`{n}` string" for n in (*names, "_rescued_data", "_source_file")) + ", _ingested_at timestamp"
    data = [
        tuple(r.get(n) for n in (*names, "_rescued_data")) + (r.get("_source_file", file), r.get("_at", dt.datetime(2026, 9, day)))
        for r in records
    ]
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def world(spark):
    fx = spark.createDataFrame([(dt.date(2026, 7, 31), "CHF", "0.95")], "rate_date date, currency string, units_per_eur string")
    fx = fx.withColumn("units_per_eur", F.col("units_per_eur").cast("decimal(18,6)"))
    return {
        "parents": {
            "stores": spark.createDataFrame([("S1",)], "store_id string"),
            "products": spark.createDataFrame([("P1",), ("P1",)], "sku string"),
            "cashiers": spark.createDataFrame([("S1-C1",)], "cashier_id string"),
        },
        "fx": rates.daily_rates(fx, "2026-07-30", "2026-08-31"),
    }


def audit(spark, world, records, contract=POS_SALES):
    raw = bronze(spark, contract, records)
    return raw, validation.audit(raw, contract, world["parents"], world["fx"])


def reasons_of(spark, world, change, contract=POS_SALES, base=GOOD):
    _, parts = audit(spark, world, [{**base, **change}], contract)
    got = parts.rejected.collect()
    return list(got[0]["reasons"]) if got else []


def test_clean_row_is_typed_and_converted(spark, world):
    _, parts = audit(spark, world, [GOOD])
    row = parts.accepted.first()
    assert parts.rejected.isEmpty()
    assert row["quantity"] == 2 and row["promo_flag"] is True and row["business_date"] == dt.date(2026, 8, 3)
    assert str(row["net_amount_eur"]) == "17.6947"  # 16.81 / 0.95, a rate carried over the weekend


def test_each_fault_has_its_reason(spark, world):
    cases = {
        "missing:sku": {"sku": None},
        "bad_type:quantity": {"quantity": "1.5"},
        "rule:quantity_positive": {"quantity": "-1"},
        "rule:gross_equals_net_plus_vat": {"gross_amount": "21.00"},
        "rule:date_matches_timestamp": {"transaction_ts": "2026-08-04 10:00:00"},
        "rule:payment_known": {"payment_method": "cheque"},
        "ref:store_id": {"store_id": "S9"},
        "ref:cashier_id": {"cashier_id": "S1-C9"},
        "unexpected_columns": {"_rescued_data": "x"},
    }
    records = [{**GOOD, **change, "transaction_id": reason} for reason, change in cases.items()]
    _, parts = audit(spark, world, records)
    got = {r["record_key"].split("|")[0]: list(r["reasons"]) for r in parts.rejected.collect()}
    assert got == {reason: [reason] for reason in cases}


def test_all_reasons_are_kept_in_contract_order(spark, world):
    got = reasons_of(spark, world, {"business_date": "2026-13-45", "quantity": "0", "currency": "USD"})
    assert got == [
        "bad_type:business_date", "rule:quantity_positive", "rule:currency_known",
        "no_fx_rate:gross_amount_eur", "no_fx_rate:net_amount_eur",
    ]


def test_null_rule_passes_but_absence_is_reported(spark, world):
    got = reasons_of(spark, world, {"quantity": " "})
    assert got == ["missing:quantity"]


def test_record_keeps_original_text_and_key_keeps_empty_parts(spark, world):
    _, parts = audit(spark, world, [{**GOOD, "transaction_id": "", "quantity": " 0 "}])
    row = parts.rejected.first()
    assert row["record_key"] == "|1"
    record = json.loads(row["record"])
    assert record["quantity"] == " 0 " and "transaction_id" not in record


def test_latest_clean_copy_wins_and_a_bad_later_copy_does_not(spark, world):
    copies = [
        {**GOOD, "quantity": "1", "_at": dt.datetime(2026, 9, 1)},
        {**GOOD, "quantity": "3", "_at": dt.datetime(2026, 9, 2)},
        {**GOOD, "quantity": "-5", "_at": dt.datetime(2026, 9, 3)},
    ]
    raw, parts = audit(spark, world, copies)
    assert [r["quantity"] for r in parts.accepted.collect()] == [3]
    row = validation.account("pos_sales", raw, *parts).first()
    assert (row["bronze"], row["silver"], row["quarantined"], row["duplicates"], row["balanced"]) == (3, 1, 1, 1, True)


def test_ties_do_not_depend_on_row_order(spark, world):
    copies = [{**GOOD, "quantity": str(q)} for q in (4, 9, 2)]
    picks = {audit(spark, world, order)[1].accepted.first()["quantity"] for order in (copies, copies[::-1])}
    assert picks == {9}


def test_lost_rows_raise(spark, world):
    raw, parts = audit(spark, world, [GOOD, {**GOOD, "line_no": "2"}])
    lost = validation.account("pos_sales", raw, parts.audited.limit(1), parts.accepted.limit(1), parts.rejected)
    with pytest.raises(AssertionError, match="pos_sales"):
        validation.require_balanced(lost)


def test_optional_columns_may_be_missing_but_not_wrong(spark, world):
    base = {
        "refund_id": "R1", "refund_ts": "2026-08-03 10:00:00", "business_date": "2026-08-03", "store_id": "S1",
        "cashier_id": "S1-C1", "quantity": "1", "refund_amount": "5", "vat_rate": "0.19", "currency": "EUR",
        "receipt_present": "False", "refund_method": "cash", "reason": "damaged",
    }
    parents = {**world["parents"], "pos_sales": spark.createDataFrame([("T1",), ("T1",)], "transaction_id string")}
    world = {**world, "parents": parents}
    assert reasons_of(spark, world, {}, REFUNDS, base) == []
    assert reasons_of(spark, world, {"receipt_present": "True"}, REFUNDS, base) == ["rule:receipt_means_original"]
    receipted = {"receipt_present": "True", "original_transaction_id": "T1"}
    assert reasons_of(spark, world, receipted, REFUNDS, base) == []
    assert reasons_of(spark, world, {**receipted, "original_transaction_id": "T7"}, REFUNDS, base) == ["ref:original_transaction_id"]
    assert reasons_of(spark, world, {"sku": "P9"}, REFUNDS, base) == ["ref:sku"]


def test_country_decides_currency(spark, world):
    base = {
        "store_id": "S1", "store_name": "n", "country": "DE", "currency": "CHF", "region": "r", "format": "kiosk",
        "size_factor": "1", "open_date": "2020-01-01",
    }
    assert reasons_of(spark, world, {}, STORES, base) == ["rule:currency_matches_country", "rule:format_known"]


def test_contracts_name_their_parents_first():
    seen = set()
    for source, contract in CONTRACTS.items():
        assert {r.parent for r in contract.references} <= seen
        assert set(contract.key) <= set(contract.names)
        seen.add(source)


def test_planted_faults_cover_every_reason(spark):
    """Each contract's blanks, unreadable values, rules, references, surplus and missing rates all occur in the deliveries."""
    import duckdb

    import __spark_entry__ as registry

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("nation", "supplier", "part", "orders", "lineitem", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    want = sorted(con.execute("SELECT source, reason, n FROM (" + registry.oracle_sql()["contract_findings"] + ")").fetchall())
    got = sorted(tuple(r) for r in registry.queries()["contract_findings"](spark, folder).select("source", "reason", "n").collect())
    assert got == want
    possible = set()
    for source, c in CONTRACTS.items():
        possible |= {(source, f"missing:{n}") for n in c.names if n not in c.may_be_empty} | {(source, f"bad_type:{n}") for n, kind in c.columns if kind != "string"}
        possible |= {(source, f"rule:{n}") for n, _ in c.rules} | {(source, f"ref:{r.column}") for r in c.references}
        possible |= {(source, f"no_fx_rate:{x.target}") for x in c.conversions} | {(source, "unexpected_columns")}
    assert {(s, r) for s, r, _ in got} == possible
