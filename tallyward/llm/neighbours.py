"""Approximate nearest neighbours by largest inner product: balanced posting lists, a graph over their centroids, distance-ratio pruning.

Inner products become distances by one more coordinate: with M the largest norm, a row x is (x, sqrt(M^2 - |x|^2)) and a query q is (q M / |q|, 0), so
nearer means a larger product for one query.

1. Centroids are fitted on a bounded sample (``SAMPLE_ROWS``, by hash; every row is indexed): halves are cut at the median along the line
   between two means until a leaf holds its share, so lists are balanced however the rows are spread.  There are ``rows / LIST_ROWS``
   centroids, at most ``CENTROIDS``; tasks get them (a few MB) with a graph that links each to its nearest ones.
2. Every row goes to its nearest list, found by search over the graph; a row near a boundary goes to up to ``REPLICAS`` lists in all.
3. A query reads the lists whose centroids are within ``ratio`` times the distance of the nearest one.  The ratio is what would have found ``AIM`` of the true neighbours
   in the sample.  Lists are added until they hold enough ids.
4. A list is cut into blocks of bounded size by the row's number, queries of a list too, and each pair of blocks is one product of matrices.  So a list
   with a third of all rows, such as copies of one vector, is many blocks.  A block returns a query's best rows only, and nothing below what a few rows of the
   sample offer (at most a sixteenth of all rows), which are counted in.  Scores are then computed alike for equal vectors.

Edge cases: rows without an id, and vectors that are NULL, empty, zero, or hold NULL, NaN or infinite entries take no part, nor do vectors of another length than most.
An id with several vectors counts once, with its best pair; repeated rows change nothing.  Fewer than ``top`` other ids give shorter results;
an empty table gives none.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.text import ship, stored
from tallyward.llm.vectors import dimension, finite, matrix

SAMPLE_ROWS = 16384
LIST_ROWS = 512
CENTROIDS = 2048
REPLICAS = 3
CLOSE = 1.04  # times the nearest distance, up to which a row is replicated
LINKS = 16  # of a centroid to its nearest
FLOOR_ROWS = 4096  # of the sample, at most a sixteenth of all rows, that queries are compared with beforehand
AIM = 0.97
PROBES = 256  # sample queries that the ratio is read from
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
SEARCHED = 256  # rows that search the graph at once
MARGIN = 1e-9  # of the norms: far above rounding of one product


@dataclass(frozen=True)
class Index:
    d: int
    norm: float  # the largest
    centroids: np.ndarray  # augmented
    links: np.ndarray  # numbers of linked centroids, all lists in a row
    bounds: np.ndarray  # where each centroid's links begin
    entries: np.ndarray  # where every search begins
    ratio: float
    sample_ids: np.ndarray
    sample: np.ndarray  # one vector per id: candidates that bound a query's last place from below


def rows_as_points(rows: np.ndarray, norm: float) -> np.ndarray:
    rest = np.maximum(norm * norm - np.einsum("ij,ij->i", rows, rows), 0)
    return np.concatenate([rows, np.sqrt(rest)[:, None]], axis=1)


def queries_as_points(rows: np.ndarray, norm: float) -> np.ndarray:
    size = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return np.concatenate([rows * (norm / size)[:, None], np.zeros((len(rows), 1))], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def balanced_centroids(points: np.ndarray, leaves: int) -> np.ndarray:
    """Means of the leaves of a tree of median cuts; equal points stay together."""
    most = max(1.0, len(points) / leaves)
    todo, out = [points], []
    while todo:
        part = todo.pop()
        centre = part.mean(axis=0)
        spread = np.einsum("ij,ij->i", part - centre, part - centre)
        if len(part) <= most or spread.max() <= 1e-18 * max(1.0, float(centre @ centre)):
            out.append(centre)
            continue
        a = part[int(np.argmax(spread))]
        b = part[int(np.argmax(np.einsum("ij,ij->i", part - a, part - a)))]
        for _ in range(4):
            side = distances(part, np.stack([a, b])) @ np.array([1.0, -1.0]) > 0
            if side.all() or not side.any():
                break
            a, b = part[~side].mean(axis=0), part[side].mean(axis=0)
        along = part @ (b - a)
        order = np.argsort(along, kind="stable")
        cut = len(part) // 2
        while 0 < cut < len(part) and np.array_equal(part[order[cut - 1]], part[order[cut]]):
            cut += 1
        if cut == len(part):  # copies fill the upper half: cut before them
            cut = int(np.argmax((part[order] == part[order[-1]]).all(axis=1)))
        if not 0 < cut < len(part):
            out.append(centre)
            continue
        todo += [part[order[:cut]], part[order[cut:]]]
    return np.array(out)


def linked(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each centroid to its nearest ones, and back."""
    k = len(centroids)
    pairs = []
    for lo in range(0, k, 512):
        far = distances(centroids[lo : lo + 512], centroids)
        far[np.arange(len(far)), np.arange(lo, lo + len(far))] = np.inf
        near = np.argsort(far, axis=1, kind="stable")[:, : min(LINKS, k - 1)]
        pairs.append(np.stack([np.repeat(np.arange(lo, lo + len(far)), near.shape[1]), near.ravel()]))
    both = np.concatenate(pairs, axis=1)
    both = np.unique(np.concatenate([both, both[::-1]], axis=1), axis=1)
    return both[1], np.searchsorted(both[0], np.arange(k + 1))


def search(index: Index, points: np.ndarray, ratio: float, least: int) -> np.ndarray:
    """Distances to the centroids that a walk over the graph meets, infinite for the others.

    From the entries on, the links of every centroid within ``ratio`` times the best distance, and of the ``least`` best ones, are followed.
    """
    k = len(index.centroids)
    far = np.full((len(points), k), np.inf)
    far[:, index.entries] = distances(points, index.centroids[index.entries])
    done = np.zeros((len(points), k), bool)
    degree = np.diff(index.bounds)
    least = min(least, k)
    while True:
        bound = np.maximum(far.min(axis=1) * ratio, np.partition(far, least - 1, axis=1)[:, least - 1])
        who, where = np.nonzero((far <= bound[:, None]) & ~done & np.isfinite(far))
        if not len(who):
            return far
        done[who, where] = True
        sizes = degree[where]
        steps = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        to = index.links[np.repeat(index.bounds[where], sizes) + steps]
        pairs = np.unique(np.repeat(who, sizes) * k + to)
        who, to = pairs // k, pairs % k
        fresh = np.isinf(far[who, to])
        who, to = who[fresh], to[fresh]
        for lo in range(0, len(who), 1 << 16):
            some = slice(lo, lo + (1 << 16))
            gap = points[who[some]] - index.centroids[to[some]]
            far[who[some], to[some]] = np.sqrt(np.einsum("ij,ij->i", gap, gap))


def placed(index: Index, rows: np.ndarray) -> list[np.ndarray]:
    """The lists of each row, its nearest first."""
    out = []
    for lo in range(0, len(rows), SEARCHED):
        far = search(index, rows_as_points(rows[lo : lo + SEARCHED], index.norm), CLOSE, 2 * REPLICAS)
        near = np.argsort(far, axis=1, kind="stable")[:, :REPLICAS]
        gap = np.take_along_axis(far, near, axis=1)
        out += [own[g <= CLOSE * g[0]] for own, g in zip(near, gap)]
    return out


def probed(index: Index, rows: np.ndarray, held: np.ndarray, wanted: int) -> list[np.ndarray]:
    """The lists each query reads: those within the ratio, and more until they hold ``wanted`` ids."""
    out = []
    for lo in range(0, len(rows), SEARCHED):
        far = search(index, queries_as_points(rows[lo : lo + SEARCHED], index.norm), index.ratio, 8)
        near = np.argsort(far, axis=1, kind="stable")
        gap = np.take_along_axis(far, near, axis=1)
        within = gap <= index.ratio * gap[:, :1]
        short = np.cumsum(held[near], axis=1) - held[near] < wanted
        out += [own[w | s] for own, w, s in zip(near, within, short)]
    return out


def usable(vectors: DataFrame, ident: str, column: str) -> DataFrame:
    """Columns vec_id and v of the rows that take part, but for their length."""
    some = F.exists(column, lambda c: c != 0)
    return vectors.where(F.col(ident).isNotNull() & finite(F.col(column)) & some).select(F.col(ident).alias("vec_id"), F.col(column).alias("v"))


def fit(rows: DataFrame, top: int, d: int) -> Index:
    """Centroids, graph and ratio from a sample by hash; ``rows`` as from ``usable``."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    n, most = rows.agg(F.count("*"), F.max(norm)).first()
    h = F.xxhash64("vec_id", "v")
    share = min(1.0, SAMPLE_ROWS / n)
    chosen = rows.withColumn("h", h).where(F.col("h") <= F.lit(min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))))
    # One row per hash, combined before the shuffle: repeated rows do not add up in the driver.
    sample = chosen.groupBy("h").agg(F.first("vec_id").alias("vec_id"), F.first("v").alias("v")).orderBy("h").toArrow()
    ids, points = sample["vec_id"].to_numpy(), matrix(sample["v"], d)
    points_up = rows_as_points(points, most)
    centroids = balanced_centroids(points_up, int(max(1, min(CENTROIDS, n / LIST_ROWS, len(points) / 4)))) if len(points) else np.zeros((1, d + 1))
    links, bounds = linked(centroids)
    entries = np.unique(np.linspace(0, len(centroids) - 1, max(1, int(np.sqrt(len(centroids))))).astype(np.int64))
    single = np.unique(ids, return_index=True)[1]
    single = np.sort(single)[: min(FLOOR_ROWS, n // 16)]  # in the order of their hashes
    rough = Index(d, float(most), centroids, links, bounds, entries, 1.0, ids[single], points[single])
    return Index(**{**rough.__dict__, "ratio": calibrated(rough, points, top)})


def calibrated(index: Index, points: np.ndarray, top: int) -> float:
    """The distance ratio that reaches ``AIM`` of the nearest rows of the sample from PROBES of its rows."""
    if len(points) < 2:
        return 1.0
    queries = points[np.linspace(0, len(points) - 1, min(PROBES, len(points))).astype(np.int64)]
    score = queries @ points.T
    near = np.argsort(-score, axis=1, kind="stable")[:, 1 : top + 1]
    far = distances(queries_as_points(queries, index.norm), index.centroids)
    best = far.min(axis=1)
    lists = dict(zip((which := np.unique(near)).tolist(), placed(index, points[which])))
    reach = [far[q, lists[i]].min() / best[q] if best[q] > 0 else 1.0 for q, own in enumerate(near.tolist()) for i in own]
    return float(max(1.0, np.quantile(reach, AIM)))


def _place(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = placed(index, matrix(batch.column("v"), index.d))
            yield pa.record_batch([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], [*batch.schema.names, "lists"])

    return run


def _probe(index: Index, held: np.ndarray, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("v"), index.d)
            lists = probed(index, rows, held, top + 1)
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            kept = min(top, len(index.sample))
            floor, own, said = np.full(len(rows), -np.inf), [], []
            for lo in range(0, len(rows), SEARCHED) if kept else ():
                rough = rows[lo : lo + SEARCHED] @ index.sample.T
                rough[ids[lo : lo + SEARCHED, None] == index.sample_ids[None]] = -np.inf
                near = np.argpartition(-rough, kept - 1, axis=1)[:, :kept]
                for k, some in enumerate(near, lo):
                    some = some[index.sample_ids[some] != ids[k]]
                    own.append(index.sample_ids[some])
                    said.append(scores(rows[k], index.sample[some]))
                    if len(some) == top:
                        floor[k] = said[-1].min()
            own, said = (own, said) if kept else ([[]] * len(rows), [[]] * len(rows))
            columns = [pa.array(lists, pa.list_(pa.int32())), pa.array(floor), pa.array(own, pa.list_(pa.int64())), pa.array(said, pa.list_(pa.float64()))]
            yield pa.record_batch([*batch.columns, *columns], [*batch.schema.names, "lists", "floor", "own", "said"])

    return run


def scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products that depend on the two vectors alone, not on where they stand in a matrix."""
    return np.add.reduce(np.ascontiguousarray(rows) * query, axis=1)


def _best(top: int, d: int, norm: float):
    names = ["query_id", "vec_id", "score"]

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if queries.num_rows and rows.num_rows:
            q, v = matrix(queries["v"], d), matrix(rows["v"], d)
            qid, vid, floor = queries["vec_id"].to_numpy(), rows["vec_id"].to_numpy(), queries["floor"].to_numpy()
            for lo in range(0, len(q), 256):
                rough = q[lo : lo + 256] @ v.T
                for k, line in enumerate(rough, lo):
                    slack = MARGIN * norm * np.sqrt(q[k] @ q[k])
                    near = np.flatnonzero((line >= floor[k] - slack) & (vid != qid[k]))
                    if len(near) > 4 * top:  # not ids but rows are counted: only a first cut, where ids are all different
                        ids, first = np.unique(vid[near], return_index=True)
                        if len(ids) == len(near):
                            near = near[line[near] >= np.partition(line[near], -top)[-top] - slack]
                    exact = scores(q[k], v[near])
                    order = np.lexsort((vid[near], -exact))
                    ids, first = np.unique(vid[near][order], return_index=True)
                    order = order[np.sort(first)[:top]]
                    out.append((np.full(len(order), qid[k]), vid[near][order], exact[order]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({n: pa.array(c) for n, c in zip(names, columns)})

    return run


def nearest(vectors: DataFrame, queries: Column, top: int = 20, ident: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row that ``queries`` marks the ``top`` other rows with the largest inner product, by score, then id."""
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, ident, column)
    d = dimension(rows, "v")
    if not d:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("v") == d)
    index = fit(rows, top, d)
    kind = rows.schema["v"].dataType.simpleString()
    placed_rows = rows.mapInArrow(_place(index), f"vec_id bigint, v {kind}, lists array<int>")
    indexed = stored(placed_rows.withColumn("row", F.monotonically_increasing_id()), "posting-lists")
    sizes = indexed.select("vec_id", F.posexplode("lists").alias("at", "list")).groupBy("list").agg(
        F.count("*").alias("n"), F.countDistinct(F.when(F.col("at") == 0, F.col("vec_id"))).alias("ids")
    )  # a row per list, CENTROIDS at most
    held, counts = np.zeros(len(index.centroids), np.int64), np.zeros(len(index.centroids), np.int64)
    for r in sizes.collect():
        counts[r["list"]], held[r["list"]] = r["n"], r["ids"]
    marked = usable(vectors.where(queries), ident, column).where(F.size("v") == d)
    schema = f"vec_id bigint, v {kind}, lists array<int>, floor double, own array<bigint>, said array<double>"
    probes = marked.mapInArrow(_probe(index, held, top), schema)
    probes = stored(probes.withColumn("row", F.monotonically_increasing_id()), "probes")
    asked_of = {r["list"]: r["n"] for r in probes.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count("*").alias("n")).collect()}
    cuts = [(k, -(-int(counts[k]) // BLOCK_ROWS), -(-n // BLOCK_QUERIES)) for k, n in asked_of.items() if counts[k]]
    plan = F.broadcast(spark.createDataFrame(cuts, "list int, row_blocks int, query_blocks int"))
    part = lambda blocks: F.pmod(F.xxhash64("row"), F.col(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    data = indexed.select("vec_id", "v", "row", F.explode("lists").alias("list")).join(plan, "list")
    data = data.select("list", part("row_blocks").alias("a"), every("query_blocks").alias("b"), "vec_id", "v")
    seek = probes.select("vec_id", "v", "floor", "row", F.explode("lists").alias("list")).join(plan, "list")
    seek = seek.select("list", every("row_blocks").alias("a"), part("query_blocks").alias("b"), "vec_id", "v", "floor")
    key = ("list", "a", "b")
    found = seek.groupBy(*key).cogroup(data.groupBy(*key)).applyInArrow(_best(top, d, index.norm), "query_id bigint, vec_id bigint, score double")
    own = probes.select(F.col("vec_id").alias("query_id"), F.explode(F.arrays_zip("own", "said")).alias("s"))
    found = found.union(own.select("query_id", "s.own", "s.said"))
    single = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by_rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return single.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
