"""SimHash near-duplicates: candidate fingerprints by segment popcounts, then exact links and components.

A fingerprint is mapped to the numbers of set bits in its 21 three-bit segments and its last bit.  Each differing bit changes one
of these numbers by one, so the Manhattan distance of two such vectors never exceeds the Hamming distance of the
fingerprints.  The range join lays every distinct fingerprint into the grid cells within half the radius of its own; two
fingerprints within the radius meet in a cell.  What has no company in any of its cells is done.  The rest is compared exactly: flipping up to
half the radius of bits gives the points that a fingerprint shares with all others within the radius, and one link to the least
fingerprint of each point keeps exactly the components of all links (a point's fingerprints lie within the radius of each other).
No pairs within a cell or a group of copies are listed.

Edge cases: NULL and empty texts have fingerprint zero and link like any other.  Fingerprints, not ids, are linked, so repeated
rows and NULL ids are rows like others; a component without any id has a NULL component_id.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.components import components
from tallyward.llm.text import ascii_lower, let, pieces, ship, stored, words

SHINGLE = 3  # words
RADIUS = 2  # differing bits of a link; cells and flips below reach half of it
SEGMENT = 3  # bits
HASHES = 1 << 18  # counted at once
#: Eight bits as eight bytes, so that sums count each bit apart.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """XXH64 (seed 42) of every shingle of the lower-cased words; of all words where there are fewer."""

    def hashed(w: Column) -> Column:
        one = lambda i: F.xxhash64(F.concat_ws(" ", *[w[i + j] for j in range(size)]))
        whole = F.when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))
        return F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(0), F.size(w) - size), one)).otherwise(whole)

    return let(words(ascii_lower(F.coalesce(text, F.lit("")))), hashed)


def majorities(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text the bits set in more than half of its hashes."""
    sizes = np.diff(bounds)
    # Blocks of up to 255 hashes of one text: their counts fit a byte.
    blocks = np.concatenate([[0], np.cumsum(-(-sizes // 255))])
    owner = np.repeat(np.arange(len(sizes)), np.diff(blocks))
    starts = bounds[owner] + (np.arange(blocks[-1]) - blocks[owner]) * 255
    out = np.zeros((len(sizes), 64), np.uint8)
    full = np.flatnonzero(sizes)
    if len(full):
        raw = hashes.view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            counts = np.add.reduceat(SPREAD[raw[:, byte]], starts).view(np.uint8).reshape(-1, 8)
            totals = np.add.reduceat(counts.astype(np.int64), blocks[full], axis=0)
            out[full, 8 * byte : 8 * byte + 8] = 2 * totals > sizes[full, None]
    return np.packbits(out, axis=1, bitorder="little").view(np.int64).ravel()


def _majorities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("h")
        lists = pa.array(lists.to_pylist(), lists.type) if lists.null_count and lists.offset else lists
        bounds = np.asarray(lists.offsets, np.int64)
        values = np.asarray(lists.values, np.int64).view(np.uint64)
        for lo, hi in pieces(bounds, HASHES):
            part = bounds[lo : hi + 1]
            fp = pa.array(majorities(values[part[0] : part[-1]], part - part[0]))
            kept = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_hash")]
            yield pa.record_batch([*kept, fp], ["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): built-in hashing, then bit counts over Arrow batches."""
    ship(docs.sparkSession)
    hashes = F.coalesce(shingle_hashes(F.col("text"), shingle), F.array().cast("array<bigint>"))
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), hashes.alias("h"))
    return hashed.mapInArrow(_majorities, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash bigint, fp bigint")


def popcounts(fp: Column) -> Column:
    """The number of set bits of each of the 21 low three-bit segments plus one, itself in three bits."""
    ones = F.lit(sum(1 << at for at in range(0, 63, SEGMENT)))
    out = ones
    for bit in range(SEGMENT):
        out = out + F.shiftrightunsigned(fp, bit).bitwiseAND(ones)
    return out


def links(fps: DataFrame) -> DataFrame:
    """(hi, lo): links whose components are those of all pairs of distinct ``fp`` at RADIUS or fewer differing bits."""
    # The 64th bit is a segment of its own: it tells whether the other 21 counts are kept as they are or complemented.
    grid = F.array(F.lit(0).cast("bigint"), *[F.lit(sign * (1 << at)).cast("bigint") for at in range(0, 63, SEGMENT) for sign in (1, -1)])
    signed = lambda top: lambda c: F.when(top, F.bitwise_not(c)).otherwise(c)
    own, other = signed(F.col("fp") < 0), signed(F.col("fp") >= 0)
    near = F.concat(F.transform(grid, lambda d: own(F.col("c") + d)), F.array(other(F.col("c"))))
    cells = fps.select("fp", popcounts(F.col("fp")).alias("c")).select("fp", F.explode(near).alias("cell"))
    shared = cells.groupBy("cell").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b").select("cell")
    # Sizes after an explode are not estimated: these joins say themselves that they are no broadcasts.
    close = stored(cells.join(shared.hint("merge"), "cell").select("fp").distinct(), "close")
    flips = F.array(F.lit(0).cast("bigint"), *[F.shiftleft(F.lit(1).cast("bigint"), bit) for bit in range(64)])
    points = close.select("fp", F.explode(F.transform(flips, lambda d: F.col("fp").bitwiseXOR(d))).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("lo"), F.max("fp").alias("top")).where("lo < top").select("point", "lo")
    found = points.join(least.hint("merge"), "point").where("fp > lo").select(F.col("fp").alias("hi"), "lo").distinct()
    return found.where(F.bit_count(F.col("hi").bitwiseXOR(F.col("lo"))) <= RADIUS)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fingerprint (16 hex digits), component_id (the smallest id of the row's component) and stays; a row per document.

    ``stays`` marks one document of each component: the one with the smallest id, or text hash where ids are equal or missing.
    """
    prints = stored(fingerprints(docs, shingle), "prints")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("doc_id"), F.col("text_hash").alias("text_hash"))
    fps = stored(prints.groupBy("fp").agg(F.min(place).alias("first")), "fps")
    roots = components(links(fps.select("fp")))
    placed = stored(fps.join(roots.toDF("fp", "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "placed")
    least = placed.groupBy("root").agg(F.min("first").alias("least"))
    named = placed.select("fp", "root").join(least, "root").select("fp", "least")
    return prints.join(named, "fp").select(
        "doc_id",
        "text_hash",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("least.doc_id").alias("component_id"),
        (place == F.col("least")).alias("stays"),
    )


def without(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """``docs`` without what is marked (doc_id, text_hash, stays) as not staying.  Rows with one id and text are one document: one row stays."""
    id_and_hash = F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")
    counted = marked.groupBy(*id_and_hash).agg(F.max("stays").alias("stays"), F.count("*").alias("n")).where(~F.col("stays") | (F.col("n") > 1))
    counted = stored(counted, "near-copies")
    own = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__hash"))
    kept = docs.join(counted.select("__id", "__hash").hint("merge"), own, "left_anti")
    repeated = counted.where("stays").select("__id", "__hash")
    if repeated.isEmpty():
        return kept
    single = docs.join(repeated.hint("merge"), own).dropDuplicates(["__id", "__hash"]).select(*[docs[c] for c in docs.columns])
    return kept.union(single)


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The input without the documents that do not stay."""
    return without(docs, near_duplicates(docs, shingle))
