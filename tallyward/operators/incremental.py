"""Keeping a monthly fact table up to date: only the months that new rows touch are computed and written again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.contracts import Contract
from tallyward.functions.expressions import month_of
from tallyward.operators import validation

MONTH = "month"


def by_month(accepted: DataFrame) -> DataFrame:
    return accepted.withColumn(MONTH, month_of("business_date"))


def touched_months(current: DataFrame, fresh: DataFrame, contract: Contract) -> list[str]:
    """Months of the new rows, and those that still hold an older copy of one of their keys (a correction may move a row to another month)."""
    keys = fresh.select(*contract.key).distinct()
    left = current.select(*contract.key, MONTH).join(keys, list(contract.key), "left_semi").select(MONTH)
    return sorted(r[MONTH] for r in fresh.select(MONTH).union(left).distinct().collect())  # bounded by the calendar


def merged(current: DataFrame, fresh: DataFrame, contract: Contract) -> tuple[list[str], DataFrame]:
    """The touched months and their rows as they have to be: the latest copy of each key of ``current`` and ``fresh`` (both accepted rows with a month).

    Reads of ``current`` are limited to these months; merging the same rows again changes nothing.
    """
    months = touched_months(current, fresh, contract)
    old = current.where(F.col(MONTH).isin(months))
    return months, by_month(validation.latest_per_key(old.unionByName(fresh).drop(MONTH), contract))


def waiting_keys(held: DataFrame, contract: Contract, parents: tuple[str, ...], rates_grew: bool) -> DataFrame:
    """Keys held back for an unknown parent among ``parents``, or for a missing rate where rates of new days came: they may be right by now."""
    reasons = [f"ref:{r.column}" for r in contract.references if r.parent in parents]
    reasons += [f"no_fx_rate:{c.target}" for c in contract.conversions if rates_grew]
    return held.where(F.arrays_overlap("reasons", F.array(*map(F.lit, reasons)).cast("array<string>"))).select("record_key").distinct()


def held_again(raw: DataFrame, waiting: DataFrame, contract: Contract) -> DataFrame:
    """Raw rows with one of the waiting keys."""
    return raw.withColumn("__key", validation.raw_key(contract)).join(waiting, F.col("__key") == F.col("record_key"), "left_semi").drop("__key")


def still_held(held: DataFrame, fresh: DataFrame, waiting: DataFrame) -> DataFrame:
    """What stays in quarantine: not the keys judged anew, nor what an earlier try at the same files left there."""
    files = fresh.select("_source_file").distinct()
    kept = held.join(files, held["_source_file"].eqNullSafe(files["_source_file"]), "left_anti")
    return kept.join(waiting, "record_key", "left_anti").select(*held.columns)
