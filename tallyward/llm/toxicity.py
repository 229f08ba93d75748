"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

A sentence's score is the logistic function of the weights of its hashed words and word beginnings; a document is toxic if at
least one sentence is, so its score is the noisy-or of its sentences.  The weights are fitted to the documents' labels through that
noisy-or; afterwards the sentences with high scores are where the offence lies.

Edge cases: NULL and empty texts have no sentence; they score like one without words.  Labels that are NULL are
not learnt from, a document labelled more than once counts once, with its larger label; without usable labels of both kinds every
score is the share of label 1 (0 without labels).  Copies of a row are scored alike; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.text import mixed, pieces, prefix_sums, ship, span_hashes, sums_by, texts_of, tokens

BITS = 18
BEGINNINGS = (4, 5, 6)  # bytes of a word's beginning that are features of their own
TOXIC_ROWS, CLEAN_ROWS = 2_000, 4_000  # labelled documents learnt from, at most
LEAST_DOCS = 3  # a feature has to occur in so many toxic documents
EPOCHS = 60
SPOT = 0.3  # a sentence at or above it is located as offending

#: Byte classes: 0 white space and punctuation, 1 the rest; sentences end at . ! ? and line ends.  A-Z are lowered.
KINDS = np.ones(256, np.uint8)
KINDS[[*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]] = 0
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
STOPS = np.zeros(256, bool)
STOPS[[10, 33, 46, 63]] = True


@dataclass(frozen=True)
class Sentences:
    """Hashed features of the sentences of several texts: features by sentence, sentences by text, bytes of each sentence."""

    index: np.ndarray
    by_sentence: np.ndarray
    by_text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def sentences(data: np.ndarray, offsets: np.ndarray) -> Sentences:
    low = LOWER[data]
    starts, ends, first = tokens(KINDS[low], offsets)
    sums = prefix_sums(low)
    columns = [span_hashes(sums, starts, ends)]
    for n in BEGINNINGS:
        cut = span_hashes(sums, starts, np.minimum(starts + n, ends))
        columns.append(mixed(cut + np.uint64(n)))
    index = (np.stack(columns, axis=1) >> np.uint64(64 - BITS)).astype(np.int32).ravel()
    # A word opens a sentence if a stop, or the start of its text, lies between it and the word before.
    stops = np.concatenate([[0], np.cumsum(STOPS[data])])
    opens = np.zeros(len(starts), bool)
    opens[1:] = stops[starts[1:]] != stops[ends[:-1]]
    opens[first[:-1][np.diff(first) > 0]] = True
    at = np.flatnonzero(opens)
    bounds = np.append(at, len(starts))
    last = bounds[1:] - 1
    return Sentences(index, bounds * len(columns), np.searchsorted(at, first), starts[at], ends[last] if len(at) else ends[:0])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    empty: float = 0.0  # score of a text without words

    def sentence_scores(self, s: Sentences) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + sums_by(self.weights[s.index], s.by_sentence), -40, 40)))

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.judge(data, offsets, SPOT)[0]

    def judge(self, data: np.ndarray, offsets: np.ndarray, least: float) -> tuple[np.ndarray, pa.ListArray]:
        """The score of each text, and the numbers (from 0) of its sentences that score ``least`` or more."""
        out, spots, ends = np.empty(len(offsets) - 1), [], [np.zeros(1, np.int64)]
        for lo, hi in pieces(offsets):
            part = offsets[lo : hi + 1]
            s = sentences(data[part[0] : part[-1]], part - part[0])
            p = self.sentence_scores(s)
            clean = sums_by(np.log1p(-np.minimum(p, 1 - 1e-12)), s.by_text)
            out[lo:hi] = np.where(np.diff(s.by_text) > 0, np.clip(1 - np.exp(clean), 0, 1), self.empty)
            hit = np.flatnonzero(p >= least)
            spots.append(hit - s.by_text[np.searchsorted(s.by_text, hit, "right") - 1])
            ends.append(np.searchsorted(hit, s.by_text[1:]) + ends[-1][-1])
        numbers = np.concatenate(spots) if spots else np.zeros(0)
        return out, pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(numbers, pa.int32()))


def fit(bags: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = 0.5, l2: float = 1e-4) -> Model:
    """Adaptive gradient steps on the likelihood of the documents' labels; ``bags`` are (features, their bounds by sentence, label)."""
    labels = np.array([b[2] for b in bags], np.float64)
    share = float(labels.mean()) if len(bags) else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(1 << BITS, np.float32), -40.0 if share == 0 else 40.0, share)
    # Only what several toxic documents share, and clean ones show less often, can be offensive; all else stays at zero.
    held, seen = np.zeros((2, 1 << BITS)), np.zeros((2, 1 << BITS))
    for features, _, label in bags:
        names, times = np.unique(features, return_counts=True)
        held[label, names] += 1
        seen[label, names] += times
    held /= np.array([[len(bags) - labels.sum()], [labels.sum()]]) / len(bags)
    names = np.flatnonzero((held[1] >= LEAST_DOCS * len(bags) / labels.sum()) & (held[1] > 2 * held[0]))
    if not len(names):
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))), share)
    short = np.full(1 << BITS, -1, np.int32)
    short[names] = np.arange(len(names))
    kept, ends, first = [], [], 0
    for features, bounds, _ in bags:  # of each text only the useful features stay
        useful = short[features] >= 0
        kept.append(short[features[useful]])
        ends.append(first + np.concatenate([[0], np.cumsum(useful)])[bounds[1:]])
        first += len(kept[-1])
    index = np.concatenate(kept)
    by_sentence = np.concatenate([[0], *ends])
    sizes = np.diff(by_sentence)
    by_text = np.concatenate([[0], np.cumsum([len(b[1]) - 1 for b in bags])])
    counts = np.diff(by_text)
    # How often a feature is seen in toxic and in clean documents gives the start; the noisy-or does the rest.
    odds = np.log((seen[1, names] + 0.1) / (seen[0, names] + 1.0)) - np.log(seen[1].sum() / seen[0].sum())
    w = np.clip(odds, 0, 3) * 0.5
    bias = np.log(share / max(1.0, counts.mean())) - 1.0
    total, total_bias = np.full(len(w), 1e-2), 1e-2
    y = np.repeat(labels, counts)
    for _ in range(epochs):
        p = 1 / (1 + np.exp(-np.clip(bias + sums_by(w[index], by_sentence), -30, 30)))
        toxic = np.clip(1 - np.exp(sums_by(np.log1p(-np.minimum(p, 1 - 1e-12)), by_text)), 1e-9, 1 - 1e-9)
        toxic = np.repeat(toxic, counts)
        slope = np.where(y > 0, -(1 - toxic) / toxic * p, p)  # of the negative log-likelihood, by sentence score before the logistic
        g = np.bincount(index, np.repeat(slope, sizes), minlength=len(w)) + l2 * len(bags) * w / len(w)
        total += g * g
        total_bias += slope.sum() ** 2
        w -= rate * g / np.sqrt(total)
        bias -= rate * slope.sum() / np.sqrt(total_bias)
    weights = np.zeros(1 << BITS, np.float32)
    weights[names] = w
    return Model(weights, float(bias), float(1 / (1 + np.exp(-bias))))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts_of(batch.column("text"))
        for k in range(batch.num_rows):
            s = sentences(data[offsets[k] : offsets[k + 1]], np.array([0, offsets[k + 1] - offsets[k]]))
            lists = [pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (s.index, s.by_sentence)]
            yield pa.record_batch([batch.column("doc_id").slice(k, 1), batch.column("__label").slice(k, 1), *lists], ["doc_id", "label", "features", "bounds"])


def chosen(labels: DataFrame, label: str, usable: Column, rows: tuple[int, int]) -> DataFrame:
    """Up to ``rows`` documents of label 1 and of label 0: those with the smallest hash of their id."""
    known = labels.where(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("__label"))
    parts = [known.where(F.col("__label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in zip((1, 0), rows)]
    return parts[0].unionAll(parts[1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", usable: Column | None = None, rows: tuple[int, int] = (TOXIC_ROWS, CLEAN_ROWS)) -> Model:
    """Learn from a bounded, fixed choice of labelled documents (``rows`` is the bound for either label)."""
    ship(docs.sparkSession)
    usable = F.lit(True) if usable is None else usable
    some = docs.select("doc_id", "text").join(F.broadcast(chosen(labels, label, usable, rows)), "doc_id")  # a bounded number of narrow rows
    hashed = some.mapInArrow(_bags, "doc_id long, label int, features array<int>, bounds array<int>")
    bags = {r["doc_id"]: (np.array(r["features"], np.int32), np.array(r["bounds"], np.int64), r["label"]) for r in hashed.toLocalIterator()}
    return fit([bags[k] for k in sorted(bags)])


def score(docs: DataFrame, model: Model, least: float = SPOT) -> DataFrame:
    """doc_id, score (the noisy-or of the sentences of the whole text) and spots: the numbers of the sentences at or above ``least``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 2^18 floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, spots = shared.value.judge(*texts_of(batch.column("text")), least)
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores), spots], ["doc_id", "score", "spots"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, spots array<int>")


def locate(docs: DataFrame, model: Model, least: float = SPOT) -> DataFrame:
    """doc_id, sentence and score of every sentence at or above ``least``: where a document offends."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            for lo, hi in pieces(offsets):
                part = offsets[lo : hi + 1]
                raw = data[part[0] : part[-1]]
                s = sentences(raw, part - part[0])
                p = shared.value.sentence_scores(s)
                hit = np.flatnonzero(p >= least)
                row = np.searchsorted(s.by_text, hit, "right") - 1 + lo
                text = [raw[s.starts[k] : s.ends[k]].tobytes().decode() for k in hit]
                yield pa.record_batch([batch.column("doc_id").take(pa.array(row)), pa.array(text, pa.string()), pa.array(p[hit])], ["doc_id", "sentence", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, sentence string, score double")
