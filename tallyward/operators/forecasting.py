"""Monthly revenue forecast: seasonal baseline, gradient-boosted model, backtest, error bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.functions.expressions import month_index, month_of, month_text
from tallyward.operators import boosting
from tallyward.operators.marts import budget_years
from tallyward.operators.ordering import group_quantiles
from tallyward.sources.storage import keep

# Model inputs, horizon and boosting parameters.
MODEL_FEATURES = ("lag_12", "lag_1", "lag_2", "month_of_year", "horizon", "store_level")
HORIZON = 3
ROUNDS, TREE_DEPTH, LEARNING_RATE, SUBSAMPLE = 300, 3, 0.05, 0.8
SEED = 4211
ROWS_PER_PART = 200_000
LEAST_PARTS, ROWS_PER_LEAST_PART = 8, 10_000  # few rows are dealt out too, as far as the rows alone tell
YEAR = 12


def monthly_sales(daily_revenue: DataFrame) -> DataFrame:
    """Net sales per store and month, as a number."""
    return daily_revenue.groupBy("store_id", month_of("business_date").alias("month")).agg(
        F.sum("net_sales_eur").cast("double").alias("net_sales_eur")
    )


def last_complete_month(budget_variance: DataFrame) -> str:
    return budget_variance.where("complete_month").agg(F.max("month")).first()[0]


def last_sold_month(pos_sales: DataFrame, budget: DataFrame) -> str:
    """What :func:`last_complete_month` finds in the variances up to the last day sold: the last month over by then that sold in a budgeted year."""
    until = pos_sales.agg(F.max("business_date")).scalar()
    months = pos_sales.select(month_of("business_date").alias("month")).distinct().where(F.last_day(F.to_date("month", "yyyy-MM")) <= until)
    return months.join(budget_years(budget), F.substring("month", 1, 4) == F.col("year"), "left_semi").agg(F.max("month")).first()[0]


def month_number(month: str) -> int:
    return int(month[:4]) * YEAR + int(month[5:7]) - 1


def _months(panel: DataFrame) -> DataFrame:
    return panel.select("store_id", month_index("month").alias("at"), "net_sales_eur")


def _horizons(horizon: int) -> Column:
    return F.sequence(F.lit(1), F.lit(horizon))


def baseline_forecast(panel: DataFrame, last: str, horizon: int = HORIZON) -> DataFrame:
    """Per store and horizon: sales twelve months before the target month, scaled by a yearly growth taken from the last three months.

    One aggregation per store gives every horizon.
    """
    at, sales, end = F.col("at"), F.col("net_sales_eur"), month_number(last)

    def total(first: int, until: int) -> Column:
        return F.sum(F.when(at.between(first, until), sales))

    def last_year(h: int) -> Column:
        return F.max(F.when(at == end + h - YEAR, sales))

    growth = F.try_divide(F.coalesce(total(end - 2, end), F.lit(0.0)), total(end - 2 - YEAR, end - YEAR))
    return (
        _months(panel)
        .where(at <= end)
        .groupBy("store_id")
        .agg(growth.alias("growth"), F.array(*[last_year(h) for h in range(1, horizon + 1)]).alias("base"))
        .select("store_id", "growth", F.posexplode("base").alias("step", "base"))
        .select(
            "store_id",
            month_text(F.lit(end + 1) + F.col("step")).alias("month"),
            (F.col("step") + 1).alias("horizon"),
            (F.col("base") * F.col("growth")).alias("forecast"),
        )
    )


def feature_rows(panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Model inputs and outcome for every store, as-of month and horizon.

    All lags are calendar offsets inside one window per store, whose length the calendar bounds:
    one shuffle, no self-joins.
    """
    store = Window.partitionBy("store_id").orderBy("at")

    def value_at(offset: int) -> Column:
        return F.max("net_sales_eur").over(store.rangeBetween(offset, offset))

    steps = range(1, horizon + 1)
    wide = _months(panel).withColumns(
        {
            "lag_1": F.col("net_sales_eur"),
            "lag_2": value_at(-1),
            "store_level": F.avg("net_sales_eur").over(store.rangeBetween(Window.unboundedPreceding, 0)),
            "steps": F.array(
                *[
                    F.struct(F.lit(h).alias("horizon"), value_at(h - YEAR).alias("lag_12"), value_at(h).alias("actual"))
                    for h in steps
                ]
            ),
        }
    )
    rows = wide.select("store_id", "at", "lag_1", "lag_2", "store_level", F.explode("steps").alias("s"))
    target = F.col("at") + F.col("s.horizon")
    return rows.select(
        "store_id",
        month_text(F.col("at")).alias("asof"),
        month_text(target).alias("month"),
        "s.lag_12",
        "lag_1",
        "lag_2",
        (F.pmod(target, F.lit(YEAR)) + 1).alias("month_of_year"),
        "s.horizon",
        "store_level",
        F.try_divide("s.actual", "s.lag_12").alias("y"),
    )


def training_rows(panel: DataFrame, last: str, horizon: int = HORIZON) -> DataFrame:
    """Rows whose outcome is known by ``last`` and that have every input."""
    known = panel.where(F.col("month") <= last)
    return feature_rows(known, horizon).dropna(subset=[*MODEL_FEATURES, "y"])


def train(panel: DataFrame, last: str, rounds: int = ROUNDS, horizon: int = HORIZON) -> boosting.Boosted:
    rows = keep(training_rows(panel, last, horizon), "training-rows")
    # Sampling goes by place: the same rows are in the same places on every run, without a global sort.
    count = rows.count()
    parts = max(1 + count // ROWS_PER_PART, min(LEAST_PARTS, 1 + count // ROWS_PER_LEAST_PART))
    rows = rows.repartition(parts, "store_id").sortWithinPartitions("store_id", "asof", "horizon")
    return boosting.fit(rows, list(MODEL_FEATURES), "y", rounds, TREE_DEPTH, LEARNING_RATE, SUBSAMPLE, SEED)


def model_forecast(model: boosting.Boosted, panel: DataFrame, last: str, horizon: int = HORIZON) -> DataFrame:
    """Predicted ratio to last year's month, times that month."""
    rows = feature_rows(panel.where(F.col("month") <= last), horizon).where(F.col("asof") == last)
    return (
        boosting.predict(model, rows.dropna(subset=list(MODEL_FEATURES)), list(MODEL_FEATURES), "ratio")
        .withColumn("forecast", F.col("ratio") * F.col("lag_12"))
        .select("store_id", "month", "horizon", "forecast")
    )


NO_NODE = -1


def tree_table(model: boosting.Boosted) -> DataFrame:
    """The fitted trees as rows (tree, weight, node, feature, threshold, below, above, value): what any engine needs to repeat a forecast.

    A row goes ``below`` where its feature is at or under the threshold, else ``above``; a leaf has neither and gives ``value``.  The forecast's
    ratio is the weighted sum of the trees' leaves; tree 0 is the mean that boosting starts from.  The model's size is bounded by its rounds and
    depth, not by the data.
    """
    rows = [(0, 1.0, 0, None, None, NO_NODE, NO_NODE, float(model.start))]
    for tree, (feature, threshold, value) in enumerate(zip(model.feature, model.threshold, model.value, strict=True), 1):
        todo = [0]
        while todo:
            node = todo.pop()
            if feature[node] == boosting.NO_SPLIT:
                rows.append((tree, model.rate, node, None, None, NO_NODE, NO_NODE, float(value[node])))
                continue
            below, above = 2 * node + 1, 2 * node + 2
            rows.append((tree, model.rate, node, MODEL_FEATURES[feature[node]], float(threshold[node]), below, above, float(value[node])))
            todo += [below, above]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "tree int, weight double, node int, feature string, threshold double, below int, above int, value double")


def forecast_errors(predictions: DataFrame, panel: DataFrame) -> DataFrame:
    """Relative error of each prediction (column ``method`` says whose) with a known outcome."""
    actual = panel.select("store_id", "month", F.col("net_sales_eur").alias("actual"))
    return predictions.join(actual, ["store_id", "month"]).withColumn(
        "error", F.try_divide(F.col("forecast") - F.col("actual"), F.col("actual"))
    )


def mean_errors(errors: DataFrame) -> DataFrame:
    """Mean absolute percentage error per method and month; outcomes of zero or less do not count."""
    return (
        errors.where("actual > 0 and forecast is not null")
        .groupBy("method", "month", "horizon")
        .agg(F.avg(F.abs("error")).alias("mape"))
    )


def backtest(panel: DataFrame, last_complete: str, rounds: int = ROUNDS, horizon: int = HORIZON, methods=("model", "baseline")) -> DataFrame:
    """Errors of each method on the last ``horizon`` complete months, forecast from before them."""
    cutoff = month_name(month_number(last_complete) - horizon)
    known = panel.where(F.col("month") <= cutoff)
    parts = {
        "baseline": lambda: baseline_forecast(known, cutoff, horizon),
        "model": lambda: model_forecast(train(known, cutoff, rounds, horizon), known, cutoff, horizon),
    }
    out = None
    for method in methods:
        part = parts[method]().withColumn("method", F.lit(method))
        out = part if out is None else out.unionByName(part)
    return forecast_errors(out, panel)


def month_name(index: int) -> str:
    return f"{index // YEAR:04d}-{index % YEAR + 1:02d}"


def winner(errors: DataFrame) -> str:
    """The method with the lower mean of the monthly errors; the model must be strictly better."""
    means = dict(mean_errors(errors).groupBy("method").agg(F.avg("mape")).collect())  # two rows
    model, baseline = means.get("model"), means.get("baseline")
    return "model" if model is not None and baseline is not None and model < baseline else "baseline"


def with_bands(predictions: DataFrame, errors: DataFrame, method: str) -> DataFrame:
    """Published forecast with an 80 % range from the method's backtest errors of the same horizon."""
    mine = errors.where((F.col("method") == method) & F.col("error").isNotNull())
    bands = group_quantiles(mine, ["horizon"], "error", [0.1, 0.9], "q")  # one row per horizon
    low, high = F.coalesce(F.col("q")[0], F.lit(0.0)), F.coalesce(F.col("q")[1], F.lit(0.0))
    return (
        predictions.where("forecast is not null")
        .join(F.broadcast(bands), "horizon", "left")
        .select(
            "store_id",
            "month",
            "horizon",
            F.round("forecast", 2).alias("forecast_eur"),
            F.round(F.try_divide(F.col("forecast"), 1 + high), 2).alias("low_80_eur"),
            F.round(F.try_divide(F.col("forecast"), 1 + low), 2).alias("high_80_eur"),
            F.lit(method).alias("method"),
        )
    )


def forecast(panel: DataFrame, last_complete: str, method: str, errors: DataFrame, rounds: int = ROUNDS, horizon: int = HORIZON) -> DataFrame:
    """The next ``horizon`` months after the last complete one, by the method that won the backtest."""
    known = panel.where(F.col("month") <= last_complete)
    if method == "model":
        ahead = model_forecast(train(known, last_complete, rounds, horizon), known, last_complete, horizon)
    else:
        ahead = baseline_forecast(known, last_complete, horizon)
    return with_bands(ahead, errors, method)
