from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyward.operators import joins, ordering


@pytest.fixture(scope="module")
def skewed(spark):
    """Half the rows share one key, a tenth have none."""
    left = spark.range(2000).select(
        "id", F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 37)).alias("k")
    )
    right = spark.range(0, 37, 2).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"))
    return left, right.union(spark.sql("select 'hot', 999L"))


def test_mark_known(skewed):
    left, right = skewed
    got = joins.mark_known(left, "k", right.union(right).select("k"), "known")
    known = {r[0] for r in right.select("k").collect()}
    assert got.count() == 2000
    assert all(r["known"] == (r["k"] in known) for r in got.collect())


@pytest.mark.parametrize("ranges", [1, 13])
def test_quantiles_equal_numpy(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        check_quantiles(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def check_quantiles(spark):
    rng = np.random.default_rng(5)
    data = [("normal", float(x)) for x in rng.normal(size=301)]
    data += [("zeros", float(x)) for x in np.where(rng.random(200) < 0.7, 0, rng.random(200))]
    data += [("heavy", float(x)) for x in rng.pareto(0.6, size=150)] + [("one", 3.0), ("one", None)]
    probs = [0.0, 0.1, 0.5, 0.77, 0.995, 1.0]
    df = spark.createDataFrame(data, "g string, x double").repartition(5)
    got = dict(ordering.group_quantiles(df, ["g"], "x", probs).collect())
    for g, values in pd.DataFrame(data, columns=["g", "x"]).dropna().groupby("g")["x"]:
        assert got[g] == pytest.approx(list(np.quantile(values, probs)), rel=1e-12, abs=1e-15)
    overall = ordering.group_quantiles(df, [], "x", [0.25]).first()[0]
    assert overall[0] == pytest.approx(np.quantile([x for _, x in data if x is not None], 0.25))


def test_a_far_value_does_not_fill_a_range(spark):
    values = spark.range(4000).select(F.when(F.col("id") == 7, 1e12).otherwise(F.col("id").cast("double")).alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one range
    try:
        sizes = [r["count"] for r in ordering.in_ranges(values, [F.col("x")]).groupBy("__range").count().collect()]
        assert len(sizes) >= 3 and max(sizes) < 0.5 * sum(sizes)
        assert ordering.group_quantiles(values, [], "x", [0.5]).first()[0] == [2000.5]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_weighted_quantiles_count_repeats(spark):
    df = spark.createDataFrame([(1.0, 3), (5.0, 1)], "x double, n long")
    assert ordering.group_quantiles(df, [], "x", [0.5, 1.0], weight="n").first()[0] == [1.0, 5.0]


def test_rank_within_equals_a_window(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("x"))
    got = ordering.rank_within(df, ["g"], [F.desc("x"), F.col("id")], "rank").toPandas()
    want = got.sort_values(["g", "x", "id"], ascending=[True, False, True]).groupby("g").cumcount() + 1
    assert (got["rank"] == want.reindex(got.index)).all() and len(got) == 5000
