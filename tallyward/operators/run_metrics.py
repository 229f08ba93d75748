"""What one model run records: errors, flags, rows learnt from and settings as (model, metric, value)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.forecasting import mean_errors

FORECAST = "revenue_forecast"
DETECTORS = {"fraud_scores": "fraud_cashier_refunds", "margin_alerts": "fraud_store_margin"}


def run_metrics(
    errors: DataFrame, scores: Mapping[str, DataFrame], without_history: DataFrame, learnt: DataFrame, settings: Mapping[str, Mapping[str, float]]
) -> DataFrame:
    """One row per metric of a run.

    ``errors`` are the backtest's, ``scores`` the detectors' tables by name, ``without_history`` the store-months left unscored, ``learnt`` the
    training rows, ``settings`` the parameters by model.  Counts of nothing are zero, so a run that flags nothing still has its row.
    """

    def counted(model: str, metric: str, df: DataFrame, flag: str = "true") -> DataFrame:
        return df.agg(F.count_if(F.expr(flag)).cast("double").alias("value")).select(F.lit(model).alias("model"), F.lit(metric).alias("metric"), "value")

    mape = mean_errors(errors).select(F.lit(FORECAST).alias("model"), F.concat_ws("_", "method", F.lit("mape"), "month").alias("metric"), F.col("mape").alias("value"))
    by_horizon = learnt.groupBy("horizon").agg(F.count("*").cast("double").alias("value"))
    parts = [mape, *[counted(DETECTORS[name], "flags_total", df, "flagged") for name, df in scores.items()]]
    parts.append(counted(DETECTORS["margin_alerts"], "store_months_without_history", without_history))
    parts.append(by_horizon.select(F.lit(FORECAST).alias("model"), F.format_string("training_rows_%d", "horizon").alias("metric"), "value"))
    named = [(model, f"parameter_{k}", float(v)) for model, chosen in settings.items() for k, v in chosen.items()]
    out = errors.sparkSession.createDataFrame(named, "model string, metric string, value double")
    for part in parts:
        out = out.unionByName(part)
    return out
