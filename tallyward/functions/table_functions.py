"""Month-end questions as SQL table functions, each with a DataFrame behind it.

A function is a month filter over a view that answers the question for every month; Spark
pushes the filter below the view's aggregations.  Nothing below store level is returned, except
counts, and no free text from the ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.functions.expressions import month_index, month_of, month_text
from tallyward.operators.quality import latest_certification

PERCENT, EUR = "decimal(9,2)", "decimal(18,2)"
REVIEW_TOP = 3
BASE_MONTHS = 6
RANGE_PCT = 80


def _percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole) * 100, 2).cast(PERCENT)


def _eur(c: Column) -> Column:
    return c.cast(EUR)


def close_by_month(daily: DataFrame, margin: DataFrame, variance: DataFrame) -> DataFrame:
    """Chain totals per month: budget, growth on the same days of last year, margin, discount."""
    by_day = daily.groupBy(month_of("business_date").alias("month"), F.dayofmonth("business_date").alias("day")).agg(
        F.sum("net_sales_eur").alias("net")
    )  # at most 31 rows per month from here on
    sold = by_day.groupBy("month").agg(F.max("day").alias("last_day"), F.count("*").alias("days"))
    prior = (
        by_day.withColumn("month", month_text(month_index("month") + 12))
        .join(sold.select("month", "last_day"), "month")
        .where("day <= last_day")
        .groupBy("month")
        .agg(F.sum("net").alias("prior"))
    )
    planned = F.col("has_budget")
    plan = variance.groupBy("month").agg(
        F.sum("actual_net_sales_eur").alias("total"),
        F.sum(F.when(planned, F.col("actual_net_sales_eur"))).alias("actual"),
        F.sum(F.when(planned, F.col("budget_to_date_eur"))).alias("budget"),
        F.bool_and("complete_month").alias("complete"),
    )
    cost = margin.groupBy("month").agg(
        *[F.sum(f"{c}_eur").alias(c) for c in ("net_sales", "cogs", "discount", "paid_incl_vat")]
    )
    months = sold.join(plan, "month", "full").join(prior, "month", "left").join(cost, "month", "full")
    c = F.col
    return months.select(
        "month",
        _eur(c("total")).alias("net_sales_eur"),
        _eur(c("budget")).alias("budget_to_date_eur"),
        _eur(c("actual") - c("budget")).alias("variance_eur"),
        _percent(c("actual") - c("budget"), c("budget")).alias("variance_pct"),
        _eur(c("prior")).alias("prior_year_net_sales_eur"),
        _percent(c("total") - c("prior"), c("prior")).alias("yoy_growth_pct"),
        _percent(c("net_sales") - c("cogs"), c("net_sales")).alias("gross_margin_pct"),
        _percent(c("discount"), c("paid_incl_vat") + c("discount")).alias("discount_rate_pct"),
        c("complete").alias("complete_month"),
        F.coalesce("days", F.lit(0)).cast("int").alias("days_with_sales"),
    )


def variances_by_store(variance: DataFrame) -> DataFrame:
    share = F.try_divide("variance_eur", "budget_to_date_eur")
    return variance.where("has_budget").select(
        "month",
        "store_id",
        F.col("actual_net_sales_eur").alias("net_sales_eur"),
        "budget_to_date_eur",
        "variance_eur",
        _percent(F.col("variance_eur"), F.col("budget_to_date_eur")).alias("variance_pct"),
        "complete_month",
        share.alias("sort_key"),
    )


def margin_alerts_by_store(alerts: DataFrame, margin: DataFrame) -> DataFrame:
    """Alerts to review, with margin and discount against the store's previous six calendar months."""
    sums = margin.groupBy("store_id", "month").agg(
        *[F.sum(f"{c}_eur").alias(c) for c in ("net_sales", "cogs", "discount", "paid_incl_vat")]
    )
    rates = sums.select(
        "store_id",
        "month",
        month_index("month").alias("at"),
        ((1 - F.try_divide("cogs", "net_sales")) * 100).alias("margin"),
        (F.try_divide("discount", F.col("paid_incl_vat") + F.col("discount")) * 100).alias("discount"),
    )
    before = Window.partitionBy("store_id").orderBy("at").rangeBetween(-BASE_MONTHS, -1)
    rates = rates.withColumns({f"{c}_base": F.avg(c).over(before) for c in ("margin", "discount")})

    def pct(c: Column) -> Column:
        return F.round(c, 2).cast(PERCENT)

    return (
        alerts.where(F.col("flagged") | (F.col("rank_in_month") <= REVIEW_TOP))
        .join(rates, ["store_id", "month"])
        .select(
            "month",
            "store_id",
            F.col("rank_in_month").cast("bigint").alias("rank_in_month"),
            "flagged",
            pct(F.col("margin")).alias("margin_pct"),
            pct(F.col("margin_base")).alias("margin_pct_prior_6m"),
            pct(F.col("margin") - F.col("margin_base")).alias("margin_change_pts"),
            pct(F.col("discount")).alias("discount_rate_pct"),
            pct(F.col("discount_base")).alias("discount_rate_pct_prior_6m"),
        )
    )


def exceptions_by_month(exceptions: DataFrame) -> DataFrame:
    return exceptions.select(
        month_of("business_date").alias("month"),
        "store_id",
        "business_date",
        "journal_id",
        _eur(F.col("amount_eur")).alias("amount_eur"),
        "reason",
        _eur(F.col("day_pos_net_eur")).alias("day_pos_net_eur"),
        _eur(F.col("day_gl_revenue_eur")).alias("day_gl_revenue_eur"),
    )


def outlook_by_month(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("month").agg(
        *[_eur(F.sum(c)).alias(c) for c in ("forecast_eur", "low_80_eur", "high_80_eur")],
        F.lit(RANGE_PCT).alias("range_pct"),
        F.max("method").alias("method"),
    )


def cases_by_month(scores: DataFrame) -> DataFrame:
    return scores.groupBy("month").agg(
        F.count_if("flagged").alias("cashier_cases_referred"), F.count("*").alias("cashier_months_scored")
    )


def certification_status(history: DataFrame) -> DataFrame:
    return latest_certification(history).select("certified", F.col("run_id").alias("gold_run"), "certified_at")


# Names, parameters and result columns of the functions.
SIGNATURES = {
    "close_overview": (
        "m STRING COMMENT 'close month, yyyy-MM'",
        "month STRING, net_sales_eur DECIMAL(18,2), budget_to_date_eur DECIMAL(18,2), variance_eur DECIMAL(18,2), "
        "variance_pct DECIMAL(9,2), prior_year_net_sales_eur DECIMAL(18,2), yoy_growth_pct DECIMAL(9,2), "
        "gross_margin_pct DECIMAL(9,2), discount_rate_pct DECIMAL(9,2), complete_month BOOLEAN, days_with_sales INT",
    ),
    "store_variances": (
        "m STRING COMMENT 'close month, yyyy-MM'",
        "store_id STRING, net_sales_eur DECIMAL(18,2), budget_to_date_eur DECIMAL(18,2), variance_eur DECIMAL(18,2), "
        "variance_pct DECIMAL(9,2), complete_month BOOLEAN",
    ),
    "store_margin_alerts": (
        "m STRING COMMENT 'close month, yyyy-MM'",
        "store_id STRING, rank_in_month BIGINT, flagged BOOLEAN, margin_pct DECIMAL(9,2), margin_pct_prior_6m DECIMAL(9,2), "
        "margin_change_pts DECIMAL(9,2), discount_rate_pct DECIMAL(9,2), discount_rate_pct_prior_6m DECIMAL(9,2)",
    ),
    "reconciliation_exceptions": (
        "m STRING COMMENT 'close month, yyyy-MM'",
        "store_id STRING, business_date DATE, journal_id STRING, amount_eur DECIMAL(18,2), reason STRING, "
        "day_pos_net_eur DECIMAL(18,2), day_gl_revenue_eur DECIMAL(18,2)",
    ),
    "revenue_outlook": (
        "m STRING COMMENT 'close month, yyyy-MM; the outlook covers the months after it'",
        "month STRING, forecast_eur DECIMAL(18,2), low_80_eur DECIMAL(18,2), high_80_eur DECIMAL(18,2), range_pct INT, method STRING",
    ),
    "cashier_case_count": (
        "m STRING COMMENT 'close month, yyyy-MM'",
        "month STRING, cashier_cases_referred BIGINT, cashier_months_scored BIGINT",
    ),
    "gold_certification_status": ("", "certified BOOLEAN, gold_run STRING, certified_at TIMESTAMP"),
}

# A month without data still gives one row of close_overview and cashier_case_count.
BODIES = {
    "close_overview": """
        SELECT asked.month, net_sales_eur, budget_to_date_eur, variance_eur, variance_pct, prior_year_net_sales_eur,
          yoy_growth_pct, gross_margin_pct, discount_rate_pct, complete_month, coalesce(days_with_sales, 0)
        FROM (SELECT m AS month) asked LEFT JOIN close_by_month c ON c.month = asked.month""",
    "store_variances": """
        SELECT store_id, net_sales_eur, budget_to_date_eur, variance_eur, variance_pct, complete_month
        FROM variances_by_store WHERE month = m ORDER BY sort_key""",
    "store_margin_alerts": """
        SELECT store_id, rank_in_month, flagged, margin_pct, margin_pct_prior_6m, margin_change_pts,
          discount_rate_pct, discount_rate_pct_prior_6m
        FROM margin_alerts_by_store WHERE month = m ORDER BY rank_in_month""",
    "reconciliation_exceptions": """
        SELECT store_id, business_date, journal_id, amount_eur, reason, day_pos_net_eur, day_gl_revenue_eur
        FROM exceptions_by_month WHERE month = m ORDER BY abs(amount_eur) DESC""",
    "revenue_outlook": """
        SELECT month, forecast_eur, low_80_eur, high_80_eur, range_pct, method
        FROM outlook_by_month WHERE month > m ORDER BY month""",
    "cashier_case_count": """
        SELECT max(month), coalesce(sum(cashier_cases_referred), 0), coalesce(sum(cashier_months_scored), 0)
        FROM cases_by_month WHERE month = m""",
    "gold_certification_status": "SELECT certified, gold_run, certified_at FROM certification_status",
}


# Per function: the view it filters, what answers it for every month, and the tables that takes.
VIEWS = {
    "close_overview": ("close_by_month", close_by_month, ("daily_revenue", "margin", "budget_variance")),
    "store_variances": ("variances_by_store", variances_by_store, ("budget_variance",)),
    "store_margin_alerts": ("margin_alerts_by_store", margin_alerts_by_store, ("margin_alerts", "margin")),
    "reconciliation_exceptions": ("exceptions_by_month", exceptions_by_month, ("recon_exceptions",)),
    "revenue_outlook": ("outlook_by_month", outlook_by_month, ("revenue_forecast",)),
    "cashier_case_count": ("cases_by_month", cases_by_month, ("fraud_scores",)),
    "gold_certification_status": ("certification_status", certification_status, ("gold_certification",)),
}


def register(spark: SparkSession, *functions: str, **tables: DataFrame) -> list[str]:
    """Create the named functions for this session (all seven if none is named) and return their names.

    ``tables`` holds what :data:`VIEWS` lists for them; a caller that asks for one function need not have the other functions' tables.
    """
    chosen = functions or tuple(SIGNATURES)
    for name in chosen:
        view, answer, inputs = VIEWS[name]
        answer(*[tables[t] for t in inputs]).createOrReplaceTempView(view)
        parameters, columns = SIGNATURES[name]
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {BODIES[name]}")
    return list(chosen)
