"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates.

Edge cases: NULL and empty texts have no tokens and score by the bias alone; labels that are NULL are not learnt from;
a document labelled more than once counts once, with its larger label; without any usable label every score is 0.5.
Copies of a row are scored alike, and other columns of the input are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.text import mixed, pieces, prefix_sums, ship, span_hashes, sums_by, texts_of, tokens

BITS = 20
TRAIN_ROWS = 6_000  # labelled rows learnt from, at most; the ones with the smallest hash of their id
EPOCHS = 4
SCALE = 40.0  # a text is the mean of its n-grams, times this
SAME = np.uint64(0x5EED5EED5EED5EED)  # stands for a token equal to the one before it

#: Byte classes: 0 white space, 1 ASCII punctuation and symbols, 2 the rest.
KINDS = np.full(256, 2, np.uint8)
KINDS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
KINDS[[32, *range(9, 14)]] = 0


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed uni- and bigrams of every text, in text order, and their bounds.

    Symbol runs are tokens of their own, and a token that repeats the one before it becomes one
    common token, so that stuttering texts share n-grams.
    """
    starts, ends, first = tokens(KINDS[data], offsets)
    h = span_hashes(prefix_sums(data), starts, ends)
    fresh = np.ones(len(h), bool)
    fresh[1:] = h[1:] != h[:-1]
    fresh[first[:-1][first[:-1] < len(h)]] = True
    h = np.where(fresh, h, SAME)
    pairs = np.empty(2 * len(h), np.uint64)
    pairs[0::2] = h
    before = np.zeros(len(h), np.uint64)
    before[1:] = h[:-1]
    before[first[:-1][first[:-1] < len(h)]] = 0  # the first token's bigram is with the start of the text
    pairs[1::2] = mixed(before * np.uint64(3) + h)
    return (pairs >> np.uint64(64 - BITS)).astype(np.int32), 2 * first


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.empty(len(offsets) - 1)
        for lo, hi in pieces(offsets):
            part = offsets[lo : hi + 1]
            index, bounds = features(data[part[0] : part[-1]], part - part[0])
            size = np.maximum(np.diff(bounds), 1)
            out[lo:hi] = self.bias + SCALE * sums_by(self.weights[index], bounds) / size
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def ftrl(bags: list[tuple[np.ndarray, int]], alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5) -> Model:
    """Proximal follow-the-regularised-leader, one example at a time; ``bags`` are (hashed n-grams, label)."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = 1 << BITS

    def weight(at: np.ndarray) -> np.ndarray:
        zs, ns = z[at], n[at]
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2))

    bags = [(*np.unique(index, return_counts=True), len(index), label) for index, label in bags]
    order = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for k in order.permutation(len(bags)):
            at, count, size, label = bags[k]
            at = np.append(at, bias)
            x = np.append(SCALE * count / max(1, size), 1.0)
            w = weight(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -40, 40)))
            g = (p - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weight(np.arange(bias + 1))
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def labelled(labels: DataFrame, label: str, usable: Column, most: int) -> DataFrame:
    """At most ``most`` usable (doc_id, label) rows, one per document: those with the smallest hash of the id."""
    known = labels.where(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("__label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts_of(batch.column("text"))
        for lo, hi in pieces(offsets):
            part = offsets[lo : hi + 1]
            index, bounds = features(data[part[0] : part[-1]], part - part[0])
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(index))
            yield pa.record_batch(
                [batch.column("doc_id").slice(lo, hi - lo), batch.column("__label").slice(lo, hi - lo), lists],
                ["doc_id", "label", "index"],
            )


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", usable: Column | None = None, rows: int = TRAIN_ROWS) -> Model:
    """Learn from a bounded, fixed choice of labelled documents (``rows`` is the bound).

    The n-grams are hashed in tasks; the driver gets the hashed rows of the bounded choice and updates the weights.
    """
    ship(docs.sparkSession)
    usable = F.lit(True) if usable is None else usable
    chosen = labelled(labels, label, usable, rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``rows`` narrow rows
    hashed = chosen.mapInArrow(_bags, "doc_id long, label int, index array<int>")
    seen = {r["doc_id"]: (np.asarray(r["index"], np.int32), r["label"]) for r in hashed.toLocalIterator()}
    return ftrl([seen[k] for k in sorted(seen)])


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """Add the probability of label 1 to every row; the input's columns stay as they are, but one of that name is replaced."""
    ship(docs.sparkSession)
    docs = docs.drop(column)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 2^20 floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shared.value.scores(data, offsets))], [*batch.schema.names, column]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{column}` double")
