"""Membership of a column's values in another table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.sources.storage import keep


def unknown_values(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The distinct values of the text column ``df[column]`` that do not occur in the single column of ``keys``, stored.

    Only that column is moved, never whole rows; what is left is usually so small that the planner sees it can be broadcast.
    """
    known = keys.toDF("__k").where("__k is not null").distinct()
    return keep(df.select(F.col(column).alias("__k")).where("__k is not null").distinct().join(known, "__k", "left_anti"), "unknown")


def mark_known(df: DataFrame, column: str, keys: DataFrame, flag: str) -> DataFrame:
    """Add boolean ``flag``: does the text column ``df[column]`` occur in the single column of ``keys``?"""
    return mark_unless(df, column, unknown_values(df, column, keys), flag)


def mark_unless(df: DataFrame, column: str, unknown: DataFrame, flag: str) -> DataFrame:
    """Add boolean ``flag``: ``df[column]`` is there and not among the ``unknown`` values.

    One ordinary join: few unknown values are broadcast, hot ones split.  A NULL is replaced by a text
    that no value can equal, different from row to row: NULLs neither match nor meet in one task.
    """
    own = F.xxhash64(*[c for c in df.columns if not c.startswith("_")])
    probe = df.withColumn("__k", F.coalesce(F.col(column), F.concat(F.lit("\x00"), F.hex(own))))
    marked = probe.join(unknown.withColumn("__unknown", F.lit(True)), "__k", "left")
    return marked.withColumn(flag, F.col(column).isNotNull() & F.col("__unknown").isNull()).drop("__k", "__unknown")
