"""Drift of model inputs: population stability index (PSI) per feature and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.expressions import month_index, month_text
from tallyward.operators.ordering import group_quantiles
from tallyward.sources.storage import ensure_checkpoint_dir

# Reference window, bin counts, floor for empty bins and status limits.
GAP, WINDOW, MIN_MONTHS = 4, 9, 3
MIN_BINS, MAX_BINS, ROWS_PER_BIN = 2, 10, 10
FLOOR = 1e-4
WATCH, DRIFT = 0.1, 0.2
CLOSE_RELATIVE, CLOSE_ABSOLUTE = 1e-5, 1e-8


def status(psi: Column) -> Column:
    """Text for a PSI; NULL means there was nothing to compare."""
    return F.when(psi.isNull(), "no data").when(psi < WATCH, "stable").when(psi < DRIFT, "watch").otherwise("drift")


def _fractions() -> list[float]:
    """All k/b for the possible bin counts b, each block in order: block b starts at ``_offset(b)``."""
    return [k / b for b in range(MIN_BINS, MAX_BINS + 1) for k in range(b + 1)]


def _offset(bins: Column) -> Column:
    """1-based start of the block of ``bins`` in :func:`_fractions`."""
    return ((bins * (bins + 1)) / 2 - 2).cast("int")


def psi(reference: DataFrame, current: DataFrame, keys: list[str], value: str = "x", bins: int | None = None) -> DataFrame:
    """PSI of ``current`` against ``reference`` for each group of ``keys``.

    Both frames hold (keys, value); a column ``n`` counts repeated values.  Bins are quantiles of the
    reference, about ten current rows each.  The lowest bin holds exactly the values
    equal to the least of the reference.  A constant reference compares "same value" with "other value".

    Quantile edges are one row per group; values are counted per bin on the map side.
    """

    def weighted(df: DataFrame) -> DataFrame:
        n = F.col("n") if "n" in df.columns else F.lit(1)
        return (
            df.select(*keys, F.col(value).cast("double").alias("x"), n.cast("long").alias("n"))
            .where(F.col("x").isNotNull() & ~F.isnan("x"))
            .groupBy(*keys, "x")
            .agg(F.sum("n").alias("n"))
        )

    ref, cur = weighted(reference), weighted(current)
    size = cur.groupBy(*keys).agg(F.sum("n").alias("cur_n"))
    edges = group_quantiles(ref, keys, "x", _fractions(), weight="n")
    wanted = F.lit(bins) if bins else F.greatest(F.lit(MIN_BINS), F.least(F.lit(MAX_BINS), F.floor(F.col("cur_n") / ROWS_PER_BIN)))
    plan = edges.join(size, keys, "left").withColumn("bins", F.coalesce(wanted, F.lit(MIN_BINS)).cast("int"))
    plan = plan.withColumn(
        "edges", F.array_distinct(F.slice("quantiles", _offset(F.col("bins")), F.col("bins") + 1))
    ).select(*keys, "cur_n", "edges", (F.size("edges") < 2).alias("constant"), F.slice("edges", 1, F.greatest(F.size("edges") - 1, F.lit(1))).alias("inner"))

    both = ref.withColumn("side", F.lit("r")).unionByName(cur.withColumn("side", F.lit("c")))
    first = F.col("inner")[0]
    same = F.abs(F.col("x") - first) <= CLOSE_ABSOLUTE + CLOSE_RELATIVE * F.abs(first)
    bin_of = F.when(F.col("constant"), F.when(same, 0).otherwise(1)).otherwise(
        F.size(F.filter("inner", lambda e: e < F.col("x")))
    )
    counted = (
        both.join(plan, keys)
        .withColumn("bin", bin_of)
        .groupBy(*keys, "bin")
        .agg(
            F.sum(F.when(F.col("side") == "r", F.col("n")).otherwise(0)).alias("r"),
            F.sum(F.when(F.col("side") == "c", F.col("n")).otherwise(0)).alias("c"),
        )
    )
    # Empty bins count too: they are added by position, at most MAX_BINS + 1 per group.
    table = counted.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("bin", F.struct("r", "c")))).alias("by_bin"))
    last = F.when(F.col("constant"), 1).otherwise(F.size("inner"))

    def add_up(side: str) -> Column:
        return F.aggregate(F.map_values("by_bin"), F.lit(0).cast("long"), lambda total, v: total + v[side])

    total = {side: add_up(side) for side in ("r", "c")}

    def share(b: Column, side: str) -> Column:
        n = F.coalesce(F.try_element_at("by_bin", b)[side], F.lit(0))
        return F.greatest(F.try_divide(n, total[side]), F.lit(FLOOR))

    def term(b: Column) -> Column:
        r, c = share(b, "r"), share(b, "c")
        return (c - r) * F.log(c / r)

    value_of = F.aggregate(F.transform(F.sequence(F.lit(0), last), term), F.lit(0.0), lambda a, t: a + t)
    return plan.join(table, keys, "left").select(
        *keys, F.when((F.coalesce("cur_n", F.lit(0)) > 0) & (total["r"] > 0), value_of).alias("psi")
    )


def feature_drift(features: DataFrame, columns: list[str], months: list[str]) -> DataFrame:
    """PSI of each feature in each month of ``months`` against the calendar months before it.

    The reference is what is known of the ``WINDOW`` months ending ``GAP`` months earlier; gaps are not
    filled from older months, and fewer than ``MIN_MONTHS`` known months give "no reference".
    """
    spark = features.sparkSession
    ensure_checkpoint_dir(spark)
    checked = spark.createDataFrame([(m,) for m in months], "checked string")
    # Month arithmetic instead of a range join: each checked month names its reference months.
    windows = checked.select(
        "checked",
        F.explode(F.sequence(F.lit(GAP), F.lit(GAP + WINDOW - 1))).alias("back"),
    ).select("checked", month_text(month_index("checked") - F.col("back")).alias("month"))
    values = (
        features.select("month", *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot(["month"], columns, "feature", "x")
        .groupBy("month", "feature", "x")
        .agg(F.count("*").alias("n"))
        .checkpoint()  # reference, current and the list of known months all read it
    )
    reference = values.join(F.broadcast(windows), "month").drop("month").withColumnRenamed("checked", "month")
    current = values.join(F.broadcast(checked.withColumnRenamed("checked", "month")), "month")
    known = (
        values.select("month")
        .distinct()
        .join(F.broadcast(windows), "month")
        .groupBy(F.col("checked").alias("month"))
        .agg(F.count("*").alias("n_months"), F.min("month").alias("first"), F.max("month").alias("last"))
    )
    values_psi = psi(reference, current, ["month", "feature"])
    grid = checked.select(F.col("checked").alias("month"), F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"))
    enough = F.coalesce("n_months", F.lit(0)) >= MIN_MONTHS
    value = F.when(enough, F.col("psi"))
    return (
        grid.join(known, "month", "left")
        .join(values_psi, ["month", "feature"], "left")
        .select(
            "month",
            "feature",
            F.round(value, 4).alias("psi"),
            F.when(enough, status(value)).otherwise("no reference").alias("status"),
            F.when(
                F.col("n_months").isNotNull(), F.format_string("%s..%s (%d months)", "first", "last", "n_months")
            ).alias("reference"),
        )
    )


def sales_growth(panel: DataFrame) -> DataFrame:
    """Growth of each store-month over the same month last year; NULL where last year sold nothing."""
    last_year = panel.select(
        "store_id", month_text(month_index("month") + 12).alias("month"), F.col("net_sales_eur").alias("before")
    )
    growth = F.col("net_sales_eur") / F.when(F.col("before") > 0, F.col("before")) - 1
    return panel.join(last_year, ["store_id", "month"]).select("store_id", "month", growth.alias("yoy_growth"))
