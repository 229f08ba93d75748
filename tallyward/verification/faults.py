"""Deliveries with planted faults: at least one for every reason that a contract can report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.contracts import Contract
from tallyward.operators.validation import PROVENANCE, RESCUED

# What is written into which column, by source; a blank and a wrong value of each column come first.
WRONG = {
    "stores": [{"country": "'FR'"}, {"currency": "'USD'"}, {"format": "'kiosk'"}, {"size_factor": "'0'"}],
    "products": [{"list_price_eur": "'0'"}, {"unit_cost_eur": "'0'"}],
    "cashiers": [{"store_id": "'S-UNKNOWN'"}],
    "fx_rates": [{"units_per_eur": "'0'"}],
    "pos_sales": [
        {"quantity": "'0'"}, {"unit_price": "'0'"}, {"discount_amount": "'-1'"}, {"gross_amount": "'-1'"}, {"transaction_ts": "'1900-01-01 00:00:00'"},
        {"payment_method": "'coin'"}, {"currency": "'USD'"}, {"store_id": "'S-UNKNOWN'"}, {"cashier_id": "'C-UNKNOWN'"}, {"sku": "'P-UNKNOWN'"},
        {"business_date": "'1900-01-01'"},
    ],
    "refunds": [
        {"quantity": "'0'"}, {"refund_amount": "'0'"}, {"receipt_present": "string(original_transaction_id is null)"}, {"refund_method": "'coin'"},
        {"store_id": "'S-UNKNOWN'"}, {"cashier_id": "'C-UNKNOWN'"}, {"sku": "'P-UNKNOWN'"},
        {"original_transaction_id": "'T-UNKNOWN'", "receipt_present": "'true'"}, {"business_date": "'1900-01-01'"},
    ],
    "gl_journal": [{"debit_eur": "'1'", "credit_eur": "'-1'"}, {"debit_eur": "'1'", "credit_eur": "'1'"}, {"store_id": "'S-UNKNOWN'"}],
    "budget": [{"budget_month": "'2000-13'"}, {"cogs_budget_eur": "'-1'"}, {"store_id": "'S-UNKNOWN'"}],
}


def faults(contract: Contract) -> list[dict[str, str]]:
    blanks = [{name: "''"} for name in contract.names if name not in contract.may_be_empty]
    unreadable = [{name: "'n/a'"} for name, kind in contract.columns if kind != "string"]
    return [*blanks, *unreadable, *WRONG[contract.source], {RESCUED: "'{\"extra\":\"1\"}'"}]


def faulty(rows: DataFrame, contract: Contract, each: bool) -> DataFrame:
    """The raw text of accepted ``rows`` with one fault in each.

    With ``each`` every row comes once per fault, so that short tables show all of them; otherwise a digest of its key picks the fault of a row,
    or none.
    """
    planted = faults(contract)
    text = rows.select(*[F.col(n).cast("string").alias(n) for n in contract.names], F.lit(None).cast("string").alias(RESCUED), *_provenance(rows))
    if each:
        numbered = text.withColumn("__fault", F.explode(F.sequence(F.lit(1), F.lit(len(planted)))))
    else:
        digest = F.conv(F.substring(F.md5(F.concat_ws("|", *contract.key)), 1, 8), 16, 10).cast("long")
        numbered = text.withColumn("__fault", digest % (len(planted) + 1))

    def written(name: str) -> Column:
        cases = [(i, fault[name]) for i, fault in enumerate(planted, 1) if name in fault]
        value = F.col(name)
        for i, sql in cases:
            value = F.when(F.col("__fault") == i, F.expr(sql)).otherwise(value)
        return value.alias(name)

    return numbered.select(*[written(n) for n in (*contract.names, RESCUED)], *PROVENANCE)


def _provenance(rows: DataFrame) -> list[Column]:
    if set(PROVENANCE) <= set(rows.columns):
        return [F.col(n) for n in PROVENANCE]
    return [F.lit("planted").alias(PROVENANCE[0]), F.lit("2000-01-01").cast("timestamp").alias(PROVENANCE[1])]
