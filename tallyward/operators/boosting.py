"""Gradient boosting of regression trees (Friedman, 2001) on squared errors: rows stay where they are, histograms of residuals travel.

Each task holds its rows as one block of bin numbers and residuals.  A level of a tree is one job of one stage: every block counts and sums its
residuals per node, feature and bin, the driver adds these small tables and picks the splits.  Blocks are numbered and added in that order, and a
round's sample follows from the block's number, so a task that runs again, anywhere, gives the same trees.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyward.sources.storage import ensure_checkpoint_dir

# Workers get this module's functions with the task, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 64  # per feature; a feature of fewer values has a bin for each
MARKS = 1024  # a block tells a feature's distribution by this many order statistics
SETTLED = 50  # rounds between two stored states, which bound what a lost executor costs
NO_SPLIT = -1


class Boosted(NamedTuple):
    """Trees as heaps, one row each: a row goes to child 2n+1 where its feature is at or under the threshold, else to 2n+2."""

    start: float
    rate: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray


def _block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a task as one row: the number of the block, its inputs column by column, its outcomes."""
    table = [b for b in batches if b.num_rows]
    if table:
        table = pa.Table.from_batches(table)
        *x, y = (np.ascontiguousarray(c.to_numpy(), dtype=float).tobytes() for c in table.columns)
        yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([b"".join(x)], pa.binary()), pa.array([y], pa.binary())], ["block", "x", "y"])


def _marks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and their counts: all of them if they are few, else evenly spaced order statistics."""
    values, counts = np.unique(x, return_counts=True)
    if len(values) > MARKS:
        ends = np.linspace(0, len(x), MARKS + 1).astype(int)
        values, counts = np.repeat(values, counts)[ends[1:] - 1], np.diff(ends)
    return values, counts


def edges_of(marks: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Upper ends of all bins but the last, from the marks of all blocks."""
    values, where = np.unique(np.concatenate([v for v, _ in marks]), return_inverse=True)
    if len(values) <= BINS:
        return values[:-1]
    reached = np.cumsum(np.bincount(where, weights=np.concatenate([n for _, n in marks])))
    picks = np.searchsorted(reached, reached[-1] * np.arange(1, BINS) / BINS)
    return values[np.unique(np.minimum(picks, len(values) - 2))]


def _walk(tree: tuple, columns, n: int, levels: int) -> np.ndarray:
    """Where each of ``n`` rows is after some levels; ``tree`` holds features and cuts by node."""
    feature, cut = tree
    at = np.zeros(n, np.int64)
    for level in range(levels):
        for node in range(2**level - 1, 2 ** (level + 1) - 1):
            if feature[node] != NO_SPLIT:
                here = np.flatnonzero(at == node) if level else slice(None)
                at[here] = 2 * node + 1 + (columns[feature[node]][here] > cut[node])
    return at


def _histogram(state: tuple, tree: tuple, level: int, round_: int, share: float, seed: int) -> tuple[int, np.ndarray]:
    """Counts and sums of the sampled residuals per node of the level, feature and bin."""
    block, codes, left = state
    chosen = np.random.default_rng((seed, round_, block)).random(len(left), np.float32) < share
    nodes = 2**level
    at = _walk(tree, codes, len(left), level) - (nodes - 1)
    rows = np.flatnonzero(chosen & (at >= 0))
    at, y = at[rows] * BINS, left[rows]
    out = np.zeros((2, len(codes), nodes * BINS))
    for f, column in enumerate(codes):
        place = at + column[rows]
        out[0, f], out[1, f] = np.bincount(place, minlength=nodes * BINS), np.bincount(place, y, nodes * BINS)
    return block, out.reshape(2, len(codes), nodes, BINS)


def _split(counts: np.ndarray, sums: np.ndarray) -> tuple | None:
    """The feature and bin that reduce the squared error most, with count and sum below and above; none if nothing does."""
    n, s = counts.cumsum(axis=1), sums.cumsum(axis=1)
    total, whole = n[0, -1], s[0, -1]
    over, rest = total - n, whole - s
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where((n > 0) & (over > 0), s**2 / n + rest**2 / over - whole**2 / max(total, 1), -np.inf)
    f, cut = np.unravel_index(np.argmax(gain), gain.shape)
    if not gain[f, cut] > 1e-12 * max(whole**2 / max(total, 1), 1e-12):
        return None
    return int(f), int(cut), s[f, cut] / n[f, cut], rest[f, cut] / over[f, cut]


def fit(rows: DataFrame, features: list[str], outcome: str, rounds: int, depth: int, rate: float, share: float, seed: int) -> Boosted:
    """Boost ``rounds`` trees on ``rows``, whose partitions are the blocks; these must be the same whenever they are computed.

    The driver gets, per block, ``MARKS`` values of each feature once and a table of nodes x features x ``BINS`` for each level of a tree.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    packed = rows.select(*[rows[c].cast("double").alias(c) for c in (*features, outcome)]).mapInArrow(_block, "block int, x binary, y binary")
    width = len(features)

    def unpack(row) -> tuple:
        return row[0], np.frombuffer(row[1]).reshape(width, -1), np.frombuffer(row[2])

    blocks = packed.rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
    known = sorted(blocks.map(lambda b: (b[0], [_marks(x) for x in b[1]], len(b[2]), float(b[2].sum()))).collect(), key=lambda b: b[0])
    size = sum(b[2] for b in known)
    if not size:
        raise ValueError("no rows to learn from")
    start = sum(b[3] for b in known) / size
    edges = [edges_of([b[1][f] for b in known]) for f in range(width)]

    def coded(b: tuple) -> tuple:
        return b[0], [np.searchsorted(e, x).astype(np.uint8) for e, x in zip(edges, b[1])], b[2] - start

    state, spent = blocks.map(coded).persist(StorageLevel.MEMORY_AND_DISK), [blocks]
    inner, heap = 2**depth - 1, 2 ** (depth + 1) - 1
    feature, cuts = np.full((rounds, heap), NO_SPLIT), np.zeros((rounds, heap), np.int64)
    threshold, value = np.zeros((rounds, heap)), np.zeros((rounds, heap))
    for k in range(rounds):
        for level in range(depth):
            tree = (feature[k, :inner].copy(), cuts[k, :inner].copy())
            parts = state.map(lambda s, t=tree, at=level, k=k: _histogram(s, t, at, k, share, seed)).collect()
            for old in spent:
                old.unpersist()
            spent = []
            counts, sums = np.sum([h for _, h in sorted(parts, key=lambda p: p[0])], axis=0)
            if level == 0:
                value[k, 0] = sums[0].sum() / max(counts[0].sum(), 1)
            for i in range(2**level):
                node, found = 2**level - 1 + i, _split(counts[:, i], sums[:, i])
                if found:
                    f, cut, below, above = found
                    feature[k, node], cuts[k, node], threshold[k, node] = f, cut, edges[f][cut]
                    value[k, 2 * node + 1], value[k, 2 * node + 2] = below, above
        if k + 1 < rounds:
            tree, step = (feature[k, :inner].copy(), cuts[k, :inner].copy()), rate * value[k]
            spent, before = [state], state
            state = before.map(lambda s, t=tree, v=step: (s[0], s[1], s[2] - v[_walk(t, s[1], len(s[2]), depth)])).persist(StorageLevel.MEMORY_AND_DISK)
            if k % SETTLED == SETTLED - 1:
                state.checkpoint()
    state.unpersist()
    return Boosted(start, rate, feature, threshold, value)


def predict(model: Boosted, df: DataFrame, features: list[str], name: str) -> DataFrame:
    """Add the model's prediction."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, rate, feature, threshold, value = shared.value
        levels = int(np.log2(feature.shape[1] + 1)) - 1
        for batch in batches:
            columns = [batch[f].to_numpy(dtype=float) for f in features]
            total = np.full(len(batch), start)
            for tree in zip(feature, threshold, value):
                total += rate * tree[2][_walk(tree[:2], columns, len(batch), levels)]
            yield batch.assign(**{name: total})

    return df.mapInPandas(run, T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))
