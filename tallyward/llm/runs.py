"""Periodic runs of words: maximal stretches that repeat with a period, found from Lyndon roots, and the text without the repetitions.

Per text, over numbers that stand for its words:

1. A run of at least 12 words and two periods lies wholly within words that six-word windows found twice in the text cover.  (Windows of six at
   its start and one period on are equal; from both ends they cover it.)  Only such stretches are looked at further.
2. Lyndon arrays, under an order of the words and under its reverse: suffixes are grouped by their first word, and groups are
   taken from the highest.  Everything between a member and the nearest lower suffix before it is done with; so that suffix's Lyndon prefix now ends
   where the member's ends, and it moves to a new group above its old one, apart from those that met another number of members.
   This grouping is the first phase of a suffix sorter; the Lyndon array is read off it, and no suffix is sorted further.
3. Every run has a root, a longest Lyndon word under one of the two orders.  Each word of the arrays is extended to both sides by longest common
   extensions (binary search over hashes of prefixes; what is reported is compared word by word), and what holds two roots is a run.

Edge cases: NULL and empty texts have no words and no runs.  NULL ids and repeated rows are rows like others; other columns are not read.
Time and memory per text are in proportion to its words (times a logarithm for the extensions); texts are independent, so nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyward.llm.text import mixed, prefix_sums_of, ship, span_hashes

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
WINDOW = 6  # words
SHORTEST = 12  # words of a run
BATCH_ROWS = 256
SEPARATOR = -1  # lower than any word under both orders


def numbered(words: list[str]) -> np.ndarray:
    """A number per word, equal for equal words."""
    known: dict[str, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def repeated_stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """The maximal stretches of words that are covered by windows of WINDOW words found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return []
    mixes = mixed(words.astype(np.uint64) + np.uint64(1))
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h = h * np.uint64(0x9E3779B97F4A7C15) + mixes[k : k + n]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return []
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    change = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    change[at] += 1
    np.add.at(change, at + WINDOW, -1)
    inside = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2]) if b - a >= SHORTEST]


def lyndon_array(text: list[int], falling: bool = False) -> list[int]:
    """The length of the longest Lyndon word from each place on (0 at a SEPARATOR); ``falling`` reverses the order of the words."""
    n = len(text)
    size = [1] * n
    left = list(range(n))  # left[i]: the nearest place at or before i that is not done, once followed to its end
    members: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        if c != SEPARATOR:
            members.setdefault(c, []).append(i)
        else:
            size[i] = 0
    # Groups in a doubly linked list from the highest to the lowest; a group keeps the places that ever joined it, group_of tells who still belongs.
    held = [members[c] for c in sorted(members, reverse=not falling)]
    count = len(held)
    below, above = [*range(1, count), -1], list(range(-1, count - 1))
    group_of = [-1] * n
    for g, places in enumerate(held):
        for i in places:
            group_of[i] = g
    g = 0 if count else -1
    while g >= 0:
        mine = [i for i in held[g] if group_of[i] == g]
        for i in mine:
            left[i] = i - 1
        met: dict[int, int] = {}
        for i in mine:  # places rise, so the last to meet a place is the farthest
            j = i - 1
            while j >= 0 and left[j] != j:
                j = left[j]
            k = i - 1
            while k >= 0 and left[k] != k and left[k] != j:  # shorten the way
                left[k], k = j, left[k]
            if j >= 0 and text[j] != SEPARATOR:
                met[j] = met.get(j, 0) + 1
                size[j] = i + size[i] - j
        if met:
            split: dict[tuple[int, int], list[int]] = {}
            for j, times in met.items():
                split.setdefault((group_of[j], times), []).append(j)
            for (old, _), places in sorted(split.items(), reverse=True):  # more often is higher; what comes later is placed below, next above the old group
                new = len(held)
                places.sort()
                held.append(places)
                for j in places:
                    group_of[j] = new
                up = above[old]
                below.append(old)
                above.append(up)
                below[up] = new
                above[old] = new
        g = below[g]
    return size


def common_extension(sums: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from ``a`` and ``b`` on (or before them) are equal, at most ``most`` each."""
    low, high = np.zeros_like(most), most.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_] + 1) // 2
        x, y = a[open_], b[open_]
        if forward:
            same = span_hashes(sums, x, x + mid) == span_hashes(sums, y, y + mid)
        else:
            same = span_hashes(sums, x - mid, x) == span_hashes(sums, y - mid, y)
        low[open_] = np.where(same, mid, low[open_])
        high[open_] = np.where(same, high[open_], mid - 1)


def _exact(text: np.ndarray, start: int, end: int, period: int) -> tuple[int, int]:
    """The maximal stretch of the period around the root in [start, end), by comparing words; only where a hash misled."""
    while start > 0 and text[start - 1] == text[start - 1 + period]:
        start -= 1
    while end < len(text) and text[end] == text[end - period]:
        end += 1
    return start, end


def runs_of(words: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``shortest`` (12 or more) words and two periods, by start, then period."""
    found = set()
    for lo, hi in repeated_stretches(words):
        text = words[lo:hi]
        listed = text.tolist()
        n = len(text)
        sums = prefix_sums_of(mixed(text.astype(np.uint64) + np.uint64(1)))
        for falling in (False, True):
            period = np.array(lyndon_array(listed, falling), np.int64)
            at = np.arange(n)
            some = np.flatnonzero((2 * period <= n) & (at + period <= n))
            at, period = at[some], period[some]
            right = common_extension(sums, at, at + period, n - at - period, True)
            before = common_extension(sums, at, at + period, at.copy(), False)
            length = before + period + right
            good = (length >= 2 * period) & (length >= shortest)
            for i, p, s, size in zip(*(c[good].tolist() for c in (at, period, at - before, length))):
                key = (s + lo, size, p)
                if key not in found:
                    if not np.array_equal(text[s : s + size - p], text[s + p : s + size]):
                        s, end = _exact(text, i, i + p, p)
                        size = end - s
                        if size < max(2 * p, shortest):
                            continue
                        key = (s + lo, size, p)
                    found.add(key)
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Marks the words that no run contains behind its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def collapse(text: str | None, change=None) -> tuple[list[tuple[int, int, int]], str]:
    """The runs of a text and its words without repetitions, joined by one space; ``change`` may replace the list of words first."""
    words = WORD.findall(text or "")
    words = change(words) if change else words
    runs = runs_of(numbered(words)) if len(words) >= SHORTEST else []
    if runs:
        words = [w for w, keep in zip(words, kept_words(len(words), runs).tolist()) if keep]
    return runs, " ".join(words)


def planted(ident: int | None):
    """The periodic tail that the query's contract gives to a tenth of the documents, told by the checksum of their id; None for the others."""
    import zlib

    h = zlib.crc32(str(ident).encode()) if ident is not None else 1
    if h % 10:
        return None
    g = h // 10

    def change(words: list[str]) -> list[str]:
        n = len(words)
        if not n:
            return words
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        unit = words[a : a + p]
        return words[:a] + (unit * (-(-(n - a) // len(unit))))[: n - a]

    return change


FIELDS = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def _digest(plant: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(lo, BATCH_ROWS)
                rows = []
                for ident, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    runs, kept = collapse(text, planted(ident) if plant else None)
                    listed = "".join(f"{s},{size},{p}\n" for s, size, p in runs)
                    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
                    milli = 1000 * best[1] // best[2] if runs else None
                    digests = (hashlib.sha256(t.encode()).hexdigest() for t in (listed, kept))
                    rows.append((len(runs), *best, milli, *digests))
                columns = [pa.array(c, pa.int64() if k < 5 else pa.string()) for k, c in enumerate(zip(*rows))]
                yield pa.record_batch([batch.column("doc_id"), *columns], ["doc_id", *(f.split()[0] for f in FIELDS.split(", "))])

    return run


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for whole in batches:
        for lo in range(0, whole.num_rows, BATCH_ROWS):
            batch = whole.slice(lo, BATCH_ROWS)
            made = [collapse(text) for text in batch.column("text").to_pylist()]
            spans = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs, _ in made]
            yield pa.record_batch([batch.column("doc_id"), pa.array(spans, kind), pa.array([t for _, t in made], pa.string())], ["doc_id", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (list of start, length, period, in words) and collapsed, the text without the repetitions; a row per document."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return docs.select("doc_id", "text").mapInArrow(_spans, f"doc_id {kind}, runs {spans}, collapsed string")


def run_digests(docs: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id, n_runs, the longest run, and digests of all runs and of the collapsed text; ``plant`` makes the contract's documents periodic first."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_digest(plant), f"doc_id {kind}, {FIELDS}")
