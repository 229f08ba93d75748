"""Detector features, ranking and evaluation."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.marts import store_month_margin
from tallyward.operators.ordering import group_quantiles, rank_within

# Names of the model inputs, review-queue shares and history limits.
CASHIER_FEATURES = ("log_refunds", "log_no_receipt_eur", "no_receipt_share", "peer_no_receipt_ratio", "peer_refunds_ratio")
MARGIN_FEATURES = ("margin_drop_vs_own", "discount_rise_vs_own")
CASHIER_CONTAMINATION, MARGIN_CONTAMINATION = 0.005, 0.02
GAP, WINDOW, MIN_HISTORY = 4, 9, 3
NOT_RANKED = 10**6


def _against_peers(df: DataFrame, keys: list[str], values: list[str], suffix: str) -> DataFrame:
    """Add the group median of each value; a group is as large as the staff of one store."""
    medians = df.groupBy(*keys).agg(*[F.median(v).alias(f"{v}{suffix}") for v in values])
    return df.join(medians, keys, "left")


def _against_fleet(df: DataFrame, keys: list[str], values: list[str], suffix: str) -> DataFrame:
    """Add the group median of each value, from one pass over all of them; groups grow with the number of stores."""
    long = df.select(*keys, *[F.col(v).cast("double").alias(v) for v in values]).unpivot(keys, values, "__what", "__x")
    medians = group_quantiles(long, [*keys, "__what"], "__x", [0.5])
    wide = medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__what") == v, F.col("quantiles")[0])).alias(f"{v}{suffix}") for v in values]
    )
    return df.join(wide, keys, "left")


def cashier_features(refunds: DataFrame) -> DataFrame:
    """Features per (store_id, cashier_id, month), from the monthly refund roll-up; peers are the rows that share (store_id, month)."""
    amounts = ("refunds", "refund_gross_eur", "no_receipt_refunds", "no_receipt_eur")
    r = refunds.withColumns({c: F.col(c).cast("double") for c in amounts})
    r = _against_peers(r, ["store_id", "month"], ["no_receipt_eur", "refunds"], "_peers")
    share = F.when(F.col("refund_gross_eur") > 0, F.col("no_receipt_eur") / F.col("refund_gross_eur"))
    return r.withColumns(
        {
            "no_receipt_share": F.coalesce(share, F.lit(0.0)),
            "peer_no_receipt_ratio": F.log1p("no_receipt_eur") - F.log1p("no_receipt_eur_peers"),
            "peer_refunds_ratio": F.log1p("refunds") - F.log1p("refunds_peers"),
            "log_refunds": F.log1p("refunds"),
            "log_no_receipt_eur": F.log1p("no_receipt_eur"),
        }
    ).drop("no_receipt_eur_peers", "refunds_peers")


class Features(NamedTuple):
    rows: DataFrame
    dropped: DataFrame


def margin_features(margin: DataFrame, gap: int = GAP, window: int = WINDOW) -> Features:
    """Store-months against the store's own earlier months, less what moved for every store.

    ``gap`` and ``window`` count months: history is the ``window`` months of the store up to the one ``gap`` months back, taken as a
    median.  Rows without enough history are returned apart, as ``dropped``.
    """
    months = store_month_margin(margin)
    # A store has one row per month: the window partitions are bounded by the calendar.
    own = Window.partitionBy("store_id").orderBy("month")

    def history(c: str) -> Column:
        return F.sort_array(F.array_compact(F.array(*[F.lag(c, k).over(own) for k in range(gap, gap + window)])))

    def median(values: str) -> Column:
        n = F.size(values)
        middle = F.get(values, ((n - 1) / 2).cast("int")) + F.get(values, (n / 2).cast("int"))
        return F.when(n >= MIN_HISTORY, middle / 2)

    known = months.withColumns({"margin_base": history("margin"), "discount_base": history("discount_rate")})
    moved = known.withColumns({c: median(c) for c in ("margin_base", "discount_base")}).withColumns(
        {
            "margin_drop": F.col("margin_base") - F.col("margin"),
            "discount_rise": F.col("discount_rate") - F.col("discount_base"),
        }
    )
    moved = _against_fleet(moved, ["month"], ["margin_drop", "discount_rise"], "_fleet")
    net = moved.withColumns(
        {
            "margin_drop_vs_own": F.col("margin_drop") - F.col("margin_drop_fleet"),
            "discount_rise_vs_own": F.col("discount_rise") - F.col("discount_rise_fleet"),
        }
    ).drop("margin_drop_fleet", "discount_rise_fleet")
    complete = F.col("margin_drop_vs_own").isNotNull() & F.col("discount_rise_vs_own").isNotNull()
    return Features(net.where(complete), net.where(~complete))


def ranked(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``rank_in_month``: 1 for the highest ``anomaly_score`` of a month; equal scores are told apart by ``keys``.

    The rank uses the full score; the published score is rounded afterwards.
    """
    order = [F.col("anomaly_score").desc(), *[F.col(k) for k in keys]]
    return rank_within(scores, ["month"], order, "rank_in_month").select(
        *keys, "month", F.round("anomaly_score", 4).alias("anomaly_score"), "rank_in_month", "flagged"
    )


def evaluate_detector(scores: DataFrame, entity_column: str, entity: str, months: list[str], top: int = 3) -> DataFrame:
    """One row per month of ``months``: the rank of a planted entity and the flags raised on others."""
    hit = F.col(entity_column) == entity
    wanted = scores.sparkSession.createDataFrame([(m,) for m in months], "month string")
    found = scores.groupBy("month").agg(
        F.min(F.when(hit, F.col("rank_in_month"))).alias("rank"), F.count_if(~hit & F.col("flagged")).alias("false_flags")
    )
    total = scores.agg(F.count_if("flagged")).scalar()
    return wanted.join(found, "month", "left").select(
        "month",
        F.coalesce("rank", F.lit(NOT_RANKED)).alias("rank"),
        (F.coalesce("rank", F.lit(NOT_RANKED)) <= top).alias("in_top"),
        F.coalesce("false_flags", F.lit(0)).alias("false_flags"),
        total.alias("flags_total"),
    )
