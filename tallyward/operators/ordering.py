"""Exact quantiles and ranks of groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.sources.storage import ensure_checkpoint_dir


def in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows range-partitioned by ``order`` with the number of their range, checkpointed so that ranges do not move.

    Ranges are drawn by row counts, so neither a huge group nor a far value fills one.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()).checkpoint()


def group_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], name: str = "quantiles", weight: str | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``value`` per group, as an array in the order of ``probs``.

    ``weight`` names a column that counts repeated values.  Equal values are collapsed to counts on the map side; the counts are
    range-partitioned by group and value, and running totals of the ranges tell which of them hold the wanted order
    statistics.  Only those are sorted, each by itself, so no task needs a whole group.  Every step is a function of the
    data alone, so a re-run task gives the same answer.
    """
    counts = (
        df.select(*keys, F.col(value).cast("double").alias("__v"), (F.col(weight) if weight else F.lit(1)).alias("__w"))
        .where(F.col("__v").isNotNull() & ~F.isnan("__v"))
        .groupBy(*keys, "__v")
        .agg(F.sum("__w").alias("__n"))
    )
    placed = in_ranges(counts, [*map(F.col, keys), F.col("__v")])
    group = Window.partitionBy(*keys)  # over ranges, not rows
    running = group.orderBy("__range")
    totals = (
        placed.groupBy(*keys, "__range")
        .agg(F.sum("__n").alias("__in"))
        .select("*", (F.sum("__in").over(running) - F.col("__in")).alias("__before"), F.sum("__in").over(group).alias("__size"))
    )
    # Array functions keep the expressions short however many probabilities are asked for.
    fractions = F.array(*[F.lit(float(p)) for p in probs])
    around = F.transform(fractions, lambda p: F.array(*[f(p * (F.col("__size") - 1)).cast("long") for f in (F.floor, F.ceil)]))
    wanted = F.array_distinct(F.flatten(around))
    inside = F.filter(wanted, lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__in")))
    picks = totals.withColumn("__ranks", inside).where(F.size("__ranks") > 0).drop("__in")
    order = Window.partitionBy(*keys, "__range").orderBy("__v")
    candidates = placed.join(picks, [*keys, "__range"]).withColumn("__end", F.col("__before") + F.sum("__n").over(order))
    hits = F.filter("__ranks", lambda r: (r < F.col("__end")) & (r >= F.col("__end") - F.col("__n")))
    stats = candidates.select(*keys, "__size", "__v", F.explode(hits).alias("__rank"))
    # Two order statistics per probability at most.
    table = stats.groupBy(*keys, "__size").agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__v"))).alias("__at"))

    def interpolate(p: Column) -> Column:
        at = p * (F.col("__size") - 1)
        below = F.element_at("__at", F.floor(at).cast("long"))
        above = F.element_at("__at", F.ceil(at).cast("long"))
        return below + (above - below) * (at - F.floor(at))

    return table.select(*keys, F.transform(fractions, interpolate).alias(name))


def rank_within(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """Add the 1-based position of each row within its group.

    Even a single huge group is spread over all ranges; positions are local row numbers plus the sizes of the preceding ranges.
    """
    placed = in_ranges(df, [*map(F.col, group), *order])
    sizes = placed.groupBy(*group, "__range").agg(F.count("*").alias("__rows"))
    earlier = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, "__range", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__offset"))
    local = Window.partitionBy(*group, "__range").orderBy(*order)  # never more than one range
    numbered = placed.withColumn("__local", F.row_number().over(local)).join(offsets, [*group, "__range"])
    return numbered.withColumn(name, F.col("__offset") + F.col("__local")).drop("__range", "__local", "__offset")
