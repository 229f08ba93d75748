from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tallyward.operators import boosting, forecasting


def brute(x, y, rounds, rate):
    """Boosted stumps and depth-two trees on all cuts, for whole-number features."""

    def tree(rows, left, depth):
        best = (1e-12, None)
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1]:
                low = x[rows, f] <= cut
                a, b = left[low], left[~low]
                gain = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b) - left.sum() ** 2 / len(left)
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, low)
        out = np.full(len(rows), left.mean())
        if depth and best[1] is not None:
            for side in (best[1], ~best[1]):
                out[side] = tree(rows[side], left[side], depth - 1)
        return out

    total = np.full(len(y), y.mean())
    for _ in range(rounds):
        total = total + rate * tree(np.arange(len(y)), y - total, 2)
    return total


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 20, size=(600, 3)).astype(float)
    y = np.where(x[:, 0] > 11, 3.0, 0.0) + 0.1 * x[:, 1] + rng.normal(0, 0.3, 600)
    return pd.DataFrame({"id": np.arange(600), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})


def blocks(spark, data, n):
    return spark.createDataFrame(data).repartition(n, "id").sortWithinPartitions("id")


@pytest.mark.parametrize("n", [1, 7])
def test_equals_brute_force_on_any_number_of_blocks(spark, data, n):
    model = boosting.fit(blocks(spark, data, n), ["a", "b", "c"], "y", 6, 2, 0.3, 1.0, 1)
    got = boosting.predict(model, spark.createDataFrame(data), ["a", "b", "c"], "p").toPandas().sort_values("id")["p"].to_numpy()
    assert got == pytest.approx(brute(data[["a", "b", "c"]].to_numpy(), data["y"].to_numpy(), 6, 0.3), abs=1e-9)


def test_same_trees_again_also_after_a_stored_state(spark, data, monkeypatch):
    def trees():
        return boosting.fit(blocks(spark, data, 5), ["a", "b", "c"], "y", 5, 3, 0.1, 0.8, 4)

    first = trees()
    monkeypatch.setattr(boosting, "SETTLED", 2)
    for one, other in zip(first, trees(), strict=True):
        assert np.array_equal(one, other)
    assert len({tuple(v) for v in first.value}) == 5  # each round draws its own sample


def test_bins_hold_equal_shares_and_few_values_one_each():
    parts = [boosting._marks(np.random.default_rng(k).exponential(size=20_000)) for k in range(3)]
    edges = boosting.edges_of(parts)
    assert len(edges) == boosting.BINS - 1
    shares = np.bincount(np.searchsorted(edges, np.concatenate([np.random.default_rng(k).exponential(size=20_000) for k in range(3)])))
    assert abs(shares / 60_000 - 1 / boosting.BINS).max() < 0.003
    assert list(boosting.edges_of([boosting._marks(np.array([3.0, 1, 2, 3]))])) == [1, 2]
    assert len(boosting.edges_of([boosting._marks(np.array([2.0, 2]))])) == 0


def test_a_round_is_one_job_a_level(spark):
    months = [f"{y}-{m:02d}" for y in (2024, 2025) for m in range(1, 13)]
    panel = spark.createDataFrame([(f"S{k}", m, 100.0 + k + i % 7) for k in range(9) for i, m in enumerate(months)], "store_id string, month string, net_sales_eur double")
    tracker = spark.sparkContext.statusTracker()

    def jobs(rounds):
        spark.sparkContext.setJobGroup(f"boost-{rounds}", "boost")
        forecasting.train(panel, "2025-12", rounds=rounds)
        spark.sparkContext.setJobGroup("rest", "rest")
        return len(tracker.getJobIdsForGroup(f"boost-{rounds}"))

    assert jobs(6) - jobs(2) == 4 * forecasting.TREE_DEPTH
