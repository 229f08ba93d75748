"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

Bits of SimHash prints do not find these: at 0.8 two 64-bit prints differ by about ten bits, give or take three, and no cells or flips reach that far.
Candidates therefore come from least hashes (MinHash), 96 per set: sets meet in a band's cell if four of them agree, and 24 bands miss a
pair at 0.8 three times in a million.  In a cell every set is compared with the least one.  Where a cell holds more than two sets it is also split by
further least hashes, twelve more in steps of two, and in each sub-cell every set is compared with the one that is least there; unlike sets part on
the way, so similar ones that an unlike least one kept apart find each other.  No pairs of a cell are listed: a set has at most one
partner per band and depth.  Before shingles move, a pair has to agree in at least 61 of its 96 least hashes (at 0.8 it has 77, give or take four);
then the exact similarity of the two sets decides, so nothing else is linked.

Equal sets become one first.  Components of all links make up the groups; one document of each stays.

Edge cases: texts without a word have equal (empty) sets and are copies of each other; texts of fewer than five words have one shingle of all
their words.  Repeated rows and NULL ids are as in ``simhash``.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.components import components
from tallyward.llm.simhash import HASHES, shingle_hashes, without
from tallyward.llm.text import mixed, pieces, ship, stored

SHINGLE = 5  # words
SIMILAR = (4, 5)  # a Jaccard similarity of at least 4/5
BANDS, ROWS = 24, 4
DEEPER = (6, 8, 10, 12, 14, 16)  # least hashes that agree in a sub-cell
ALIKE = 61  # of the 96 least hashes
_random = np.random.default_rng(20)
SALTS = _random.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
ODDS = _random.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)


def sketches(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per set (its distinct hashes begin at ``starts``; none is empty) the upper halves of its least hashes under 96 orders."""
    out = np.zeros((len(starts), BANDS * ROWS), np.uint32)
    for k in range(BANDS * ROWS):
        out[:, k] = np.minimum.reduceat((values ^ SALTS[k]) * ODDS[k], starts) >> np.uint64(32)
    return out


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("h")
        lists = pa.array(lists.to_pylist(), lists.type) if lists.null_count and lists.offset else lists
        bounds = np.asarray(lists.offsets, np.int64)
        values = np.asarray(lists.values, np.int64).view(np.uint64)
        for lo, hi in pieces(bounds, HASHES):
            part = bounds[lo : hi + 1]
            own, sizes = values[part[0] : part[-1]], np.diff(part)
            full = np.flatnonzero(sizes)
            keys, cells = np.zeros(hi - lo, np.uint64), np.zeros((0, BANDS * ROWS), np.uint32)
            if len(full):
                starts = part[:-1][full] - part[0]
                keys[full] = mixed(np.add.reduceat(mixed(own), starts))  # the same in any order
                cells = sketches(own, starts)
            offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS * ROWS, 0))]).astype(np.int32)
            made = pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells.ravel().view(np.int32)))
            kept = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_hash")]
            yield pa.record_batch([*kept, pa.array(keys.view(np.int64)), pa.array(sizes.astype(np.int32)), made], ["doc_id", "text_hash", "key", "n", "sketch"])


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, key, n, sketch): the hash and size of every document's set of shingles, and its least hashes."""
    ship(docs.sparkSession)
    hashes = F.coalesce(F.array_distinct(shingle_hashes(F.col("text"), shingle)), F.array().cast("array<bigint>"))
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), hashes.alias("h"))
    ident = docs.schema["doc_id"].dataType.simpleString()
    return hashed.mapInArrow(_sets, f"doc_id {ident}, text_hash bigint, key bigint, n int, sketch array<int>")


def close(a, b):
    """Sizes of two sets that may be similar."""
    top, bottom = F.greatest(a, b), F.least(a, b)
    return bottom * SIMILAR[1] >= top * SIMILAR[0]


def cell(band: Column, depth: Column) -> Column:
    """A hash of the band's number and of ``depth`` least hashes from the band's first on, going round at the end."""
    twice = F.concat("sketch", "sketch")
    return F.xxhash64(band, depth, F.slice(twice, band * ROWS + 1, depth))


def candidates(sets: DataFrame) -> DataFrame:
    """(hi, lo): pairs of sets (key, n, sketch) that a cell or sub-cell brings together and whose sketches are alike."""
    bands = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    cells = sets.where(F.size("sketch") > 0).select("key", "n", "sketch", bands.alias("band")).select("key", "n", cell(F.col("band"), F.lit(ROWS)).alias("cell"), "band")
    least = lambda by: F.min(F.struct(by.alias("by"), F.col("key"), F.col("n")))
    shared = cells.groupBy("cell").agg(least(F.col("key")).alias("least"), F.count("*").alias("held")).where("held > 1")
    met = stored(cells.join(shared.hint("merge"), "cell"), "company")
    pair = lambda df: df.where((F.col("key") != F.col("least.key")) & close(F.col("n"), F.col("least.n"))).select(
        F.greatest("key", "least.key").alias("hi"), F.least("key", "least.key").alias("lo")
    )
    crowded = met.where("held > 2").select("key", "n", "band")
    deeper = crowded.join(sets.select("key", "sketch").hint("merge"), "key").select("key", "n", "band", "sketch", F.explode(F.array(*map(F.lit, DEEPER))).alias("depth"))
    deeper = deeper.select("key", "n", cell(F.col("band"), F.col("depth")).alias("cell"), F.xxhash64("key", "depth").alias("by"))
    inner = deeper.groupBy("cell").agg(least(F.col("by")).alias("least"), F.count("*").alias("held")).where("held > 1").drop("held")
    pairs = pair(met).union(pair(deeper.join(inner.hint("merge"), "cell"))).distinct()
    side = lambda name, own: sets.select(F.col("key").alias(name), F.col("sketch").alias(own))
    both = pairs.hint("merge").join(side("lo", "a"), "lo").hint("merge").join(side("hi", "b"), "hi")
    agree = F.aggregate(F.zip_with("a", "b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return both.where(agree >= ALIKE).select("hi", "lo")


def links(docs: DataFrame, sets: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(hi, lo): links between similar ``sets`` (key, n, sketch, first)."""
    pairs = stored(candidates(sets), "pairs")
    keys = pairs.select(F.explode(F.array("hi", "lo")).alias("key")).distinct()
    wanted = sets.select("key", F.col("first.doc_id").alias("__id"), F.col("first.text_hash").alias("__hash")).join(keys.hint("merge"), "key")
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__hash"))
    texts = docs.select("doc_id", "text").join(stored(wanted, "wanted").hint("merge"), same)
    texts = texts.select("key", F.array_distinct(shingle_hashes(F.col("text"), shingle)).alias("h"))
    shingles = stored(texts.groupBy("key").agg(F.first("h").alias("h")), "shingles")
    first = pairs.hint("merge").join(shingles.toDF("lo", "g"), "lo")
    both = first.hint("merge").join(shingles.toDF("hi", "h"), "hi")
    common = both.select("hi", "lo", F.size(F.array_intersect("g", "h")).alias("common"), (F.size("g") + F.size("h")).alias("total"))
    similar = common.where(F.col("common") * SIMILAR[1] >= (F.col("total") - F.col("common")) * SIMILAR[0])
    return similar.select("hi", "lo")


def near_copies(docs: DataFrame, shingle: int = SHINGLE, among: DataFrame | None = None) -> DataFrame:
    """doc_id, text_hash, component_id (the smallest id of the group) and stays (as in ``simhash.near_duplicates``); a row per document.

    With ``among`` (doc_id, text_hash, stays) what does not stay there takes no part and does not stay here; its component_id is NULL.
    """
    prints = shingle_sets(docs, shingle)
    if among is not None:
        among = stored(among.select("doc_id", "text_hash", "stays"), "marks")
        gone = among.where(~F.col("stays")).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
        out = prints["doc_id"].eqNullSafe(F.col("__id")) & (prints["text_hash"] == F.col("__hash"))
        prints = prints.join(stored(gone, "gone").hint("merge"), out, "left_anti")
    prints = stored(prints, "sets")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("doc_id"), F.col("text_hash").alias("text_hash"))
    sets = stored(prints.groupBy("key").agg(F.min(place).alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "distinct-sets")
    roots = components(links(docs, sets, shingle)).toDF("key", "root")
    placed = stored(sets.select("key", "first").join(roots.hint("merge"), "key", "left").withColumn("root", F.coalesce("root", "key")), "placed")
    least = placed.groupBy("root").agg(F.min("first").alias("least"))
    named = placed.select("key", "root").join(least.hint("merge"), "root").select("key", "least")
    marked = prints.select("doc_id", "text_hash", "key").join(named.hint("merge"), "key").select(
        "doc_id", "text_hash", F.col("least.doc_id").alias("component_id"), (place == F.col("least")).alias("stays")
    )
    if among is None:
        return marked
    return marked.union(among.where(~F.col("stays")).select("doc_id", "text_hash", F.lit(None).cast(docs.schema["doc_id"].dataType), F.lit(False)))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, among: DataFrame | None = None) -> DataFrame:
    """The input without the near copies that do not stay."""
    return without(docs, near_copies(docs, shingle, among))
