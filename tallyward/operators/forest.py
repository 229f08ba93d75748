"""Isolation Forest (Liu, Ting and Zhou, 2008): trees grown in parallel, rows scored in parallel.

Every choice (which rows a tree samples, which feature a node splits, where) is an MD5 digest of the seed and of what is
chosen for, and path lengths are whole billionths, so scores follow from the rows and the seed alone: any engine with MD5
finds the same ones, and sums do not depend on an order.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators.ordering import group_quantiles
from tallyward.sources.storage import ensure_checkpoint_dir

# Workers get this module's functions with the task, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES = 300
SAMPLE_ROWS = 256
DEPTH = 8  # log2(SAMPLE_ROWS)
SEED = 9173
SCORING_ROWS = 4096  # rows scored at once, to bound memory
UNIT = 10**9  # path lengths are kept as whole numbers of 1/UNIT


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    long = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def billionths(n: int) -> int:
    return int(round(float(expected_path(n)) * UNIT))


def digits(digest: Column, start: int, length: int) -> Column:
    """Some hexadecimal digits of a digest as a number."""
    return F.conv(F.substring(digest, start, length), 16, 10).cast("long")


def draw_samples(df: DataFrame, keys: list[str], total: int, trees: int, size: int, seed: int) -> DataFrame:
    """At most ``size`` of the ``total`` rows per tree, chosen by hash so the choice never depends on the layout.

    The trees are split into blocks small enough that each row may join one tree of every block and
    each tree still gets enough rows; a hash threshold then keeps about 1.3 x ``size`` rows per tree
    whatever the number of rows, and the smallest hashes of each tree are its sample.
    """
    enough = 1.3 * size
    block = max(1, min(trees, int(total / enough)))
    blocks = -(-trees // block)
    keep = min(1.0, enough * block / max(total, 1))
    digest = F.md5(F.concat_ws("|", F.lit(f"{seed}|row"), "__b", *keys))
    one_per_block = df.withColumn("__b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("__d", digest)
    placed = one_per_block.withColumns({"tree": (F.col("__b") * block + digits(F.col("__d"), 1, 8) % block).cast("int"), "h": digits(F.col("__d"), 9, 10)})
    drawn = placed.where((F.col("tree") < trees) & (F.col("h") <= int(keep * (1 << 40)))).drop("__b", "__d")
    order = Window.partitionBy("tree").orderBy("h", *keys)
    return drawn.withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") <= size)


NODE = "tree int, node int, feature int, threshold double, depth long"


def grow(features: list[str], depth: int, seed: int):
    """Pandas function growing one tree from its sample; nodes are numbered as in a heap.

    A node splits one of the features that differ among its rows, at a place between their ends.
    """

    def grow_tree(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree"].iloc[0])
        nodes, todo = [], [(0, 0, sample[features].to_numpy(dtype=float))]
        while todo:
            node, level, rows = todo.pop()
            spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
            if level == depth or len(spread) == 0:
                nodes.append((tree, node, -1, 0.0, level * UNIT + billionths(len(rows))))
                continue
            digest = hashlib.md5(f"{seed}|cut|{tree}|{node}".encode()).hexdigest()
            f = int(spread[int(digest[:8], 16) % len(spread)])
            low, high = float(rows[:, f].min()), float(rows[:, f].max())
            cut = low + int(digest[8:16], 16) / 2.0**32 * (high - low)
            cut = cut if cut < high else low  # rounding must not leave a side empty
            nodes.append((tree, node, f, cut, 0))
            below = rows[:, f] <= cut
            todo += [(2 * node + 1, level + 1, rows[below]), (2 * node + 2, level + 1, rows[~below])]
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "depth"])

    return grow_tree


def isolation_scores(
    df: DataFrame,
    keys: list[str],
    features: list[str],
    contamination: float = 0.01,
    trees: int = TREES,
    seed: int = SEED,
) -> DataFrame:
    """Add ``anomaly_score`` (higher is more unusual) and ``flagged``.

    ``contamination`` is used once, after scoring: rows above the exact (1 - contamination) quantile of the scores are flagged.
    The driver collects the tree nodes, at most ``trees`` x 511.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # The features are read by the count, the samples and the scoring; the scores by the threshold and the caller.
    numbered = df.withColumns({f: F.col(f).cast("double") for f in features}).checkpoint()
    total = numbered.count()
    samples = draw_samples(numbered.select(*keys, *features), keys, total, trees, SAMPLE_ROWS, seed)
    nodes = samples.groupBy("tree").applyInPandas(grow(features, DEPTH, seed), NODE).toPandas()
    width = 2 ** (DEPTH + 1) - 1
    feature, threshold, depth = np.full((trees, width), -1), np.zeros((trees, width)), np.zeros((trees, width), dtype=np.int64)
    at = (nodes["tree"].to_numpy(), nodes["node"].to_numpy())
    feature[at], threshold[at], depth[at] = nodes["feature"], nodes["threshold"], nodes["depth"]
    grown = np.unique(at[0])
    forest = df.sparkSession.sparkContext.broadcast((feature[grown], threshold[grown], depth[grown]))
    usual = billionths(min(SAMPLE_ROWS, max(total, 2))) * len(grown)

    def path_lengths(x: np.ndarray) -> np.ndarray:
        feature, threshold, depth = forest.value
        tree = np.arange(len(feature))
        node = np.zeros((len(x), len(feature)), dtype=int)
        row = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            f = feature[tree, node]
            right = x[row, np.maximum(f, 0)] > threshold[tree, node]
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return depth[tree, node].sum(axis=1)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[features].to_numpy(dtype=float)
            parts = [path_lengths(x[i : i + SCORING_ROWS]) for i in range(0, len(x), SCORING_ROWS)]
            total_depth = np.concatenate(parts) if parts else np.zeros(0)
            yield batch.assign(anomaly_score=2.0 ** (-total_depth / max(usual, 1)))

    schema = T.StructType([*numbered.schema.fields, T.StructField("anomaly_score", T.DoubleType())])
    scored = numbered.mapInPandas(score, schema).checkpoint()
    cut = group_quantiles(scored, [], "anomaly_score", [1 - contamination]).select(F.col("quantiles")[0]).scalar()
    return scored.withColumn("flagged", F.col("anomaly_score") > cut)
