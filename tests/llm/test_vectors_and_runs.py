"""Whitening, periodic runs and nearest neighbours against brute force, on fixtures with nulls, repeats, ties, odd lengths and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import neighbours, runs, whitening
from tallyward.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, component string, score int, n int, v string"


def table_of(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, "x", 1, 2, "y") for i, v in rows], SCHEMA).repartition(parts)


ODD = [(901, None), (902, []), (903, [None, 1.0, 2.0]), (904, [float("nan"), 1.0, 2.0]), (905, [float("inf"), 1.0, 2.0]), (906, [1.0, 2.0])]


# Whitening


def test_whitening_against_eigenvectors(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(12, 12))
    held = (rng.normal(size=(300, 12)) @ mix + 5).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(held)] + [(7, held[7].tolist()), (None, held[9].tolist())]
    wrong = [(i, (v + [0.0] * 9 if v and len(v) == 3 else v)) for i, v in ODD]
    got = whitening.whitened_components(table_of(spark, rows + wrong)).toPandas()
    x = np.floor(1024 * np.array([v for _, v in rows], np.float64)).astype(np.int64) + 100000
    n, sums = len(x), x.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov((x - sums / n).T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    white = (x - sums / n) @ axes[:, :8] / np.sqrt(values[:8])
    assert len(got) == 8 * n and set(got.component) == set(range(1, 9)) and set(got.n) == {n}
    single = got[got.vec_id == 11].sort_values("component")
    signs = np.sign(single.whitened.to_numpy() * white[11])
    for k in (0, 5, 250):
        own = got[got.vec_id == k].sort_values("component")
        assert np.allclose(own.whitened * signs, white[k], rtol=1e-9, atol=1e-9)
        assert set(own.deviation) == {int(((n * x[k] - sums) ** 2).sum())}
    assert np.allclose(single.explained, values[:8] / values.sum(), rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    assert (got.vec_id == 7).sum() == 16 and got.vec_id.isna().sum() == 8


def test_whitening_of_little(spark):
    assert whitening.whitened_components(table_of(spark, [])).count() == 0
    assert whitening.whitened_components(table_of(spark, ODD[:5])).count() == 0
    assert whitening.whitened_components(table_of(spark, [(1, [1.0, 2.0, 3.0])] * 3)).count() == 0
    line = whitening.whitened_components(table_of(spark, [(k, [1.0 * k, 2.0 * k, 0.5]) for k in range(5)])).toPandas()
    assert set(line.component) == {1} and np.isclose(line.explained.iloc[0], 1) and len(line) == 5  # one direction has variance


def test_factor_and_rotation():
    rng = np.random.default_rng(1)
    for d, rank in ((1, 1), (2, 2), (7, 7), (20, 6), (33, 33)):
        a = rng.normal(size=(d, rank)) * np.logspace(0, 4, rank)
        a = a @ a.T
        order, factor = whitening.pivoted_cholesky(a)
        assert factor.shape[1] == rank and np.allclose(factor @ factor.T, a[order][:, order])
        values, axes = whitening.principal(a)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-6)
        assert np.allclose(axes.T @ axes, np.eye(rank), atol=1e-9) and np.allclose(a @ axes, axes * values, rtol=1e-7, atol=1e-7 * values[0])


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(k, [1e9 * k, 1.0]) for k in range(4)]
    got = whitening.whitened_components(table_of(spark, rows)).toPandas()
    assert got.deviation.isna().all() and len(got) == 4


# Runs


def brute_runs(words, shortest=12):
    out, n = set(), len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            size = i + p - start
            smaller = any(all(words[k] == words[k + q] for k in range(start, start + size - q)) for q in range(1, p))
            if size >= max(shortest, 2 * p) and not smaller:
                out.add((start, size, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_lyndon(text, falling):
    key = (lambda u: [-c for c in u]) if falling else list
    good = lambda u: all(key(u) < key(u[k:]) for k in range(1, len(u)))
    return [max(j - i for j in range(i + 1, len(text) + 1) if good(text[i:j])) for i in range(len(text))]


def test_lyndon_arrays_and_runs():
    rng = random.Random(2)
    for _ in range(150):
        text = [rng.randint(0, rng.choice([1, 2, 4])) for _ in range(rng.randint(1, 16))]
        for falling in (False, True):
            assert runs.lyndon_array(text, falling) == brute_lyndon(text, falling)
    for _ in range(250):
        words = [rng.randint(0, rng.choice([1, 2, 9])) for _ in range(rng.randint(1, 50))]
        unit = words[: rng.randint(1, 9)]
        words = words[: rng.randint(0, 20)] + unit * rng.randint(1, 6) + words
        assert runs.runs_of(np.array(words)) == brute_runs(words)
    fibonacci = [1], [1, 0]
    for _ in range(9):
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    assert runs.runs_of(np.array(fibonacci[1])) == brute_runs(fibonacci[1])
    assert runs.runs_of(np.array([5] * 100_000)) == [(0, 100_000, 1)]


def expected(ident, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    h = zlib.crc32(str(ident).encode()) if ident is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {i for s, size, p in found for i in range(s + p, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    s, size, p = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (ident, len(found), s, size, p, 1000 * size // p if found else None, digest(listed), digest(kept))


def test_runs_query_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 90))) for _ in range(120)]
    texts += [None, "", " \n\t", "one", "da " * 40, "é ñ x " * 20, "a b c d e f\n" * 3 + "g h", "a\x85b " * 13]
    rows = list(enumerate(texts)) + [(None, "x y " * 9), (None, None), (3, texts[3]), (3, texts[4])]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n_runs int, start int").repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in QUERIES["op12_runs"](spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(repr(expected(i, t)) for i, t in rows)
    assert sum(r[1] > 0 for r in got) > 10
    spans = runs.find_runs(docs.where("doc_id = 124")).first()
    assert [tuple(r) for r in spans["runs"]] == [(0, 40, 1)] and spans["collapsed"] == "da"
    assert runs.run_digests(docs.limit(0)).count() == 0 and runs.find_runs(docs.limit(0)).count() == 0


# Nearest neighbours


def brute_nearest(rows, asked, top):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for i, v in rows:
        if not asked(i):
            continue
        score = np.add.reduce(points * np.array(v, np.float32).astype(np.float64), axis=1)
        best = out.setdefault(i, {})
        for j, s in zip(ids.tolist(), score.tolist()):
            if j != i:
                best[j] = max(s, best.get(j, -np.inf))
    return {i: sorted(((-s, j) for j, s in best.items()))[:top] for i, best in out.items()}


@pytest.mark.parametrize("spread", ["even", "groups", "norms"])
def test_neighbours_recall(spark, spread):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(6000, 16))
    if spread == "groups":
        points = rng.normal(size=(40, 16))[rng.integers(0, 40, 6000)] * 3 + points
    if spread == "norms":
        points *= np.exp(rng.normal(size=(6000, 1)))
    rows = [(k, v) for k, v in enumerate(points.astype(np.float32).tolist())]
    got = neighbours.nearest(table_of(spark, rows), F.col("vec_id") % 20 == 0, top=20)
    mine: dict[int, list] = {}
    for r in got.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(mine.setdefault(r["query_id"], [])) + 1
        mine[r["query_id"]].append((-r["score"], r["vec_id"]))
    best = brute_nearest(rows, lambda i: i % 20 == 0, 20)
    assert set(mine) == set(best) and all(len(v) == 20 and v == sorted(v) for v in mine.values())
    recall = np.mean([len({j for _, j in best[i]} & {j for _, j in mine[i]}) / 20 for i in best])
    assert recall >= 0.9, recall


def test_neighbours_copies_ties_and_edges(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 200)
    rng = np.random.default_rng(6)
    points = rng.normal(size=(400, 3)).astype(np.float32).tolist()
    rows = [(k, v) for k, v in enumerate(points)] + [(1000 + k, points[0]) for k in range(700)]  # copies of a query, over several blocks
    rows += [(40, points[41])] + [(42, points[42])] * 300  # an id with two vectors; repeated rows
    odd = ODD + [(907, [0.0, 0.0, 0.0]), (None, points[5]), (920, None), (940, [0.0, 0.0, 0.0])]
    got = neighbours.nearest(table_of(spark, rows + odd), F.col("vec_id") % 20 == 0)
    best = brute_nearest(rows, lambda i: i % 20 == 0, 20)
    mine: dict[int, list] = {}
    for r in got.orderBy("query_id", "rank").collect():
        mine.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(mine) == set(best) and 920 not in mine
    assert [i for i, _ in mine[0]] == [j for _, j in best[0]]  # ties by id, the query's own row left out
    recall = np.mean([len({j for _, j in best[i]} & {j for j, _ in mine[i]}) / 20 for i in best])
    assert recall >= 0.9
    for i, found in mine.items():
        exact = {j: -s for s, j in brute_nearest(rows, lambda k: k == i, len(rows))[i]}
        assert len(found) == 20 and all(exact[j] == s for j, s in found)


def test_neighbours_of_little(spark):
    every = F.col("vec_id") % 20 == 0
    assert neighbours.nearest(table_of(spark, []), every).count() == 0
    assert neighbours.nearest(table_of(spark, ODD[:5]), every).count() == 0
    assert neighbours.nearest(table_of(spark, [(20, [1.0, 0.0])]), every).count() == 0
    few = neighbours.nearest(table_of(spark, [(20, [1.0, 0.0]), (3, [0.5, 1.0]), (1, [0.5, -1.0]), (2, [-1.0, 0.0])]), every).collect()
    assert [tuple(r) for r in sorted(few, key=lambda r: r["rank"])] == [(20, 1, 1, 0.5), (20, 2, 3, 0.5), (20, 3, 2, -1.0)]
    assert neighbours.nearest(table_of(spark, [(1, [1.0]), (2, [2.0])]), every).count() == 0  # nobody asks
