"""Removal of repeated byte strings by suffix arrays.

A byte goes if it lies in a ``LENGTH``-byte string that also starts in a document with a smaller id.  To sort only what can repeat, and to let
equal strings meet wherever they are:

1. Documents are packed, as they lie, into compressed packs of bounded size, and stored.  Exact copies are found by hashes of the texts: a copy
   of a document with a smaller id goes whole, and everything it could say about others that document says too.
2. Each string of LENGTH bytes holds an anchor: the leftmost of its GRAM-byte grams with the smallest hash.  An anchor depends on the string
   alone, so copies hold the same.  Anchors that only one document has are done with.
3. The bytes of neighbouring strings with one shared anchor are a segment.  Different segments of one
   anchor meet in one block; segments of an anchor that many documents share are first cut into their single strings, which are
   dealt out by their own hash, so that no frequent passage fills a block.
4. In a block, a segment that is alone with its anchor holds strings that nothing else there holds.  All others form one text whose suffix array is
   built by two-stage sorting; neighbours with a common prefix of LENGTH bytes or more are one string, and the smallest id
   among them its first document.
5. Packs are told the first documents, and remove what occurs earlier.

Edge cases: NULL and empty texts have no bytes.  Texts shorter than LENGTH stay.  Rows with the same id are one document here: they do not
remove from each other.  A NULL id counts as larger than any other (the largest 64-bit number stands for it).
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.suffix_array import equal_runs, suffix_array
from tallyward.llm.text import mixed, prefix_sums, ship, span_hashes, stored, texts_of

LENGTH = 50  # bytes of a string that is removed
GRAM = 20  # bytes under an anchor's hash
SPAN = LENGTH - GRAM + 1  # grams in a string
PACK_BYTES = 4 << 20
BUCKET_BYTES = 1 << 20  # of anchors that one task compares
BLOCK_BYTES = 2 << 20  # of segments under one suffix array
ALONE = 255  # stands for the place of an anchor in a segment that is a single string
HOT = 64  # documents that share an anchor, above which its segments are cut into strings
NO_ID = (1 << 63) - 1
PART = 1 << 20  # bytes of a long document looked at once
SEPARATOR = 0xFF  # no byte of UTF-8


# Packs


def pack(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[int, bytes, bytes]:
    """A pack's number (a hash of what it holds), its bytes, documents in the order of their ids, and the ids with hashes of the texts."""
    import zstandard

    order = np.argsort(ids, kind="stable")
    texts = [data[offsets[k] : offsets[k + 1]].tobytes() for k in order]
    raw = np.int64(len(ids)).tobytes() + ids[order].tobytes() + np.array([len(t) for t in texts], np.int64).tobytes() + b"".join(texts)
    number = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "big", signed=True)
    names = b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts)
    return number, zstandard.ZstdCompressor(level=3).compress(raw), ids[order].tobytes() + names


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, bytes and offsets of a pack's documents."""
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    ids, sizes = np.frombuffer(raw, np.int64, n, 8), np.frombuffer(raw, np.int64, n, 8 + 8 * n)
    return ids, np.frombuffer(raw, np.uint8, -1, 8 + 16 * n), np.concatenate([[0], np.cumsum(sizes)])


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, texts, size = [], [], 0

    def flush() -> pa.RecordBatch:
        data = np.concatenate(texts) if texts else np.zeros(0, np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        number, blob, names = pack(np.array(ids, np.int64), data, offsets)
        columns = [pa.array([number]), pa.array([len(data)]), pa.array([blob], pa.binary()), pa.array([names], pa.binary())]
        return pa.record_batch(columns, ["pack", "size", "blob", "names"])

    for batch in batches:
        data, offsets = texts_of(batch.column("text"))
        for k, i in enumerate(batch.column("id").to_pylist()):
            ids.append(i)
            texts.append(data[offsets[k] : offsets[k + 1]].copy())
            size += len(texts[-1])
            if size >= PACK_BYTES:
                yield flush()
                ids, texts, size = [], [], 0
    if ids:
        yield flush()


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document: pack, place in the pack, id and the two halves of the hash of its text."""
    for batch in batches:
        for number, blob in zip(batch.column("pack").to_pylist(), batch.column("names").to_pylist()):
            n = len(blob) // 24
            halves = np.frombuffer(blob, np.int64, 2 * n, 8 * n).reshape(n, 2)
            columns = [np.full(n, number), np.arange(n), np.frombuffer(blob, np.int64, n), halves[:, 0], halves[:, 1]]
            yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in columns], ["pack", "place", "id", "a", "b"])


def copies(packs: DataFrame) -> DataFrame:
    """(pack, place) of every document whose text a document with a smaller id has too."""
    named = packs.select("pack", "names").mapInArrow(_names, "pack bigint, place bigint, id bigint, a bigint, b bigint")
    first = named.groupBy("a", "b").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last")
    return named.join(stored(first, "first-copies"), ["a", "b"]).where("id > first").select("pack", "place")


# Anchors


def _leftmost(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost smallest of every ``width`` values in a row, by doubling."""
    best, at, span = values, np.arange(len(values), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        left, right = slice(None, len(best) - step), slice(step, None)
        earlier = best[left] <= best[right]
        best, at = np.minimum(best[left], best[right]), np.where(earlier, at[left], at[right])
        span += step
    return at


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, place and hash of the anchors, and the first and last start of the strings that each is the anchor of.

    ``data`` holds the documents one behind the other; strings do not cross their bounds, so neither do anchors.
    """
    parts = []
    room = np.maximum(np.diff(offsets) - LENGTH + 1, 0)  # strings of each document
    marks = np.zeros(int(offsets[-1]) + 1, np.int32)
    np.add.at(marks, offsets[:-1], room > 0)
    np.add.at(marks, offsets[:-1] + room, -(room > 0).astype(np.int32))
    valid = np.cumsum(marks)[:-1] > 0
    for lo in range(0, max(0, len(data) - LENGTH + 1), PART):
        part = data[lo : lo + PART + LENGTH - 1]
        count = len(part) - GRAM + 1
        rows = np.lib.stride_tricks.as_strided(part, (len(part) - 7, 8), (1, 1))
        words = np.ascontiguousarray(rows).view(np.uint64).ravel()
        h = np.zeros(count, np.uint64)
        for k in sorted({*range(0, GRAM - 7, 8), GRAM - 8}):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += words[k : k + count]
            h ^= h >> np.uint64(32)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(29)
        owner = _leftmost(h, SPAN)
        own = valid[lo : lo + len(owner)]
        fresh = own.copy()
        fresh[1:] &= (owner[1:] != owner[:-1]) | ~own[:-1]
        final = own.copy()
        final[:-1] &= (owner[1:] != owner[:-1]) | ~own[1:]
        start = np.flatnonzero(fresh)  # documents of one string or more are apart: LENGTH - 1 starts between them are none
        parts.append((owner[start].astype(np.int64) + lo, h[owner[start]], start + lo, np.flatnonzero(final) + lo))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), none, none
    at, h, first, last = (np.concatenate(c) for c in zip(*parts))
    fresh = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(first, prepend=-LENGTH) >= LENGTH + SPAN))  # an anchor on both sides of a cut is one
    fresh = fresh if len(at) else np.zeros(0, np.int64)
    last = last[np.append(fresh[1:], len(at)) - 1] if len(at) else last
    at, h, first = at[fresh], h[fresh], first[fresh]
    return np.searchsorted(offsets, first, "right") - 1, at, h, first, last


def keys(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each hash, and the 40 bits that tell it from others there."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)), (h >> np.uint64(8)) & np.uint64((1 << 40) - 1)


def joined(bucket: np.ndarray, key: np.ndarray) -> np.ndarray:
    """One even number for bucket and key, whatever the number of buckets."""
    return mixed(bucket * np.uint64(0x9E3779B97F4A7C15) ^ key) & ~np.uint64(1)


def _pack_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per pack and bucket the anchors, five bytes each, and the number of documents that hold each (255 at most), a byte."""
        for batch in batches:
            for number, blob in zip(batch.column("pack").to_pylist(), batch.column("blob").to_pylist()):
                ids, data, offsets = unpack(blob)
                doc, _, h, _, _ = anchors(data, offsets)
                document = np.cumsum(np.diff(ids, prepend=ids[:1]) != 0)[doc]  # rows with one id are one document
                order = np.lexsort((document, h))
                h, document = h[order], document[order]
                single = np.ones(len(h), bool)
                single[1:] = (h[1:] != h[:-1]) | (document[1:] != document[:-1])
                whole, n = np.unique(h[single], return_counts=True)
                bucket, key = keys(whole, buckets)  # hashes rise, so buckets do
                cuts = np.concatenate([np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1)), [len(bucket)]])
                short, n = key.view(np.uint8).reshape(-1, 8)[:, :5], np.minimum(n, 255).astype(np.uint8)
                blobs = [short[a:b].tobytes() + n[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                some = bucket[cuts[:-1]].astype(np.int64)
                yield pa.record_batch(
                    [pa.array(some), pa.array([number] * len(some), pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "pack", "blob"]
                )

    return run


def _shared_anchors(group: pd.DataFrame) -> pd.DataFrame:
    """Per pack those of its anchors that two documents or more hold, with their bucket; the lowest bit tells the hot ones."""
    sizes = [len(b) // 6 for b in group["blob"]]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    counts = np.zeros(bounds[-1], np.float64)
    for lo, n, blob in zip(bounds, sizes, group["blob"]):
        wide[lo : lo + n, :5] = np.frombuffer(blob, np.uint8, 5 * n).reshape(n, 5)
        counts[lo : lo + n] = np.frombuffer(blob, np.uint8, n, 5 * n)
    every = joined(np.uint64(int(group["bucket"].iloc[0])), wide.view(np.uint64).ravel())
    names, where = np.unique(every, return_inverse=True)
    docs = np.bincount(where, counts, minlength=len(names))[where]
    marked = every | (docs > HOT).astype(np.uint64)
    blobs = [marked[a:b][docs[a:b] >= 2] for a, b in zip(bounds[:-1], bounds[1:])]
    out = pd.DataFrame({"pack": group["pack"].to_numpy(), "n": [len(b) for b in blobs], "blob": [b.tobytes() for b in blobs]})
    return out[out["n"] > 0]


# Segments


class Shared:
    """What a pack knows of its anchors and copies."""

    def __init__(self, side: pd.DataFrame, buckets: int):
        parts = [np.frombuffer(b, np.uint64) for b in side.loc[side["kind"] == SHARED, "blob"]]
        every = np.sort(np.concatenate([*parts, np.zeros(0, np.uint64)]))
        self.known, self.hot, self.buckets = every & ~np.uint64(1), (every & np.uint64(1)).astype(bool), buckets
        self.copies = side.loc[side["kind"] == COPY, "place"].to_numpy(np.int64)

    def segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Document, hash to deal by, name, first byte, end and place of the anchor of the strings of LENGTH bytes of each shared anchor, in one piece.

        Around a hot anchor each string is a segment of its own.  Copies have none.
        """
        doc, at, h, first, last = anchors(data, offsets)
        key = joined(*keys(h, self.buckets))
        if len(self.known) and len(doc):
            k = np.minimum(np.searchsorted(self.known, key), len(self.known) - 1)
            copied = np.zeros(len(offsets) - 1, bool)
            copied[self.copies] = True
            held = np.flatnonzero((self.known[k] == key) & ~copied[doc])
            hot = self.hot[k[held]]
        else:
            held, hot = np.zeros(0, np.int64), np.zeros(0, bool)
        doc, at, key, first, last = doc[held], at[held], key[held], first[held], last[held]
        times = np.where(hot, last - first + 1, 1)
        piece = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        doc, at, key, first, last, hot = (np.repeat(c, times) for c in (doc, at, key, first, last, hot))
        lo = first + piece
        hi = np.where(hot, lo, last) + LENGTH
        name = span_hashes(prefix_sums(data), lo, hi)
        return doc, np.where(hot, name, key >> np.uint64(1)), name, lo, hi, np.where(hot, ALONE, at - lo).astype(np.uint8)


SHARED, NEWS, COPY = 0, 1, 2  # kinds of what a pack is told


def gathered(data: np.ndarray, lo: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of many spans, one behind the other."""
    at = np.arange(sizes.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return data[at]


def _pack_segments(buckets: int, blocks: int):
    def run(packs: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        """Per pack and block the different segments with the smallest id that has them."""
        import zstandard

        rows = []
        if len(packs) and len(side):
            ids, data, offsets = unpack(packs["blob"].iloc[0])
            doc, deal, name, lo, hi, place = Shared(side, buckets).segments(data, offsets)
            _, first = np.unique(name, return_index=True)  # ids ascend: the first to have it is the smallest
            block = (deal[first] % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            first, block = first[order], block[order]
            cuts = np.concatenate([np.flatnonzero(np.diff(block, prepend=-1)), [len(block)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                own = first[a:b]
                sizes = hi[own] - lo[own]
                raw = ids[doc[own]].tobytes() + sizes.astype(np.uint8).tobytes() + place[own].tobytes() + gathered(data, lo[own], sizes).tobytes()
                rows.append((int(block[a]), packs["pack"].iloc[0], len(own), zstandard.ZstdCompressor(level=3).compress(raw)))
        return pd.DataFrame(rows, columns=["block", "pack", "n", "data"])

    return run


def _first_documents(group: pd.DataFrame) -> pd.DataFrame:
    """The block's suffix array; per pack what it has to know: (name, smallest id, strings that start in a smaller id) of its segments."""
    import zstandard

    counts = group["n"].to_numpy(np.int64)
    raws = [zstandard.ZstdDecompressor().decompress(d) for d in group["data"]]
    ids = np.concatenate([np.frombuffer(r, np.int64, n) for r, n in zip(raws, counts)])
    sizes = np.concatenate([np.frombuffer(r, np.uint8, n, 8 * n) for r, n in zip(raws, counts)]).astype(np.int64)
    places = np.concatenate([np.frombuffer(r, np.uint8, n, 9 * n) for r, n in zip(raws, counts)]).astype(np.int64)
    data = np.concatenate([np.frombuffer(r, np.uint8, -1, 10 * n) for r, n in zip(raws, counts)])
    del raws
    lo = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    sums = prefix_sums(data)
    name = span_hashes(sums, lo, lo + sizes)
    _, one, which = np.unique(name, return_index=True, return_inverse=True)
    first = np.full(len(one), NO_ID)
    np.minimum.at(first, which, ids)
    masks = np.zeros(len(one), np.uint64)
    # A segment alone with its anchor has no string in common with any other; so has one that is a single string.
    anchor = lo[one] + places[one]
    alone = places[one] == ALONE
    anchor_name = np.where(alone, name[one], span_hashes(sums, np.where(alone, lo[one], anchor), np.where(alone, lo[one], anchor + GRAM)))
    _, kind, company = np.unique(anchor_name, return_inverse=True, return_counts=True)
    some = np.flatnonzero((company[kind] > 1) & ~alone)
    if len(some):
        masks[some] = _sorted_out(data, lo[one[some]], sizes[one[some]], first[some])
    rows = []
    known, mask = first[which], masks[which]
    told = (known < ids) | (mask != 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    for number, a, b in zip(group["pack"], bounds[:-1], bounds[1:]):
        own = np.flatnonzero(told[a:b]) + a
        if len(own):
            rows.append((number, len(own), name[own].tobytes() + known[own].tobytes() + mask[own].tobytes()))
    return pd.DataFrame(rows, columns=["pack", "n", "blob"])


def _sorted_out(data: np.ndarray, lo: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per segment (its smallest id in ``first``) the strings in it, as bits, that start in a document with a smaller one."""
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    text = np.full(int(sizes.sum()) + len(sizes), SEPARATOR, np.uint8)
    text[np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)), sizes)] = gathered(data, lo, sizes)
    strings = sizes - LENGTH + 1
    owner = np.full(len(text), -1, np.int64)
    number = np.repeat(np.arange(len(sizes)), strings)
    starts = np.repeat(begin - np.concatenate([[0], np.cumsum(strings)[:-1]]), strings) + np.arange(strings.sum())
    owner[starts] = number
    order = suffix_array(text, LENGTH + 6)
    order = order[owner[order] >= 0]
    runs = equal_runs(order, text, LENGTH)
    heads = np.flatnonzero(np.diff(runs, prepend=-1))
    least = np.minimum.reduceat(first[owner[order]], heads)[runs]
    own = owner[order]
    early = least < first[own]
    masks = np.zeros(len(sizes), np.uint64)
    np.bitwise_or.at(masks, own[early], np.uint64(1) << (order[early] - begin[own[early]]).astype(np.uint64))
    return masks


# Removal


def _removal(digest: bool, buckets: int):
    def run(packs: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept"]
        if not len(packs):
            return pd.DataFrame([], columns=names)
        shared = Shared(side, buckets)
        ids, data, offsets = unpack(packs["blob"].iloc[0])
        doc, _, name, lo, hi, _ = shared.segments(data, offsets)
        news = [np.frombuffer(b, np.uint64).reshape(3, -1) for b in side.loc[side["kind"] == NEWS, "blob"]]
        news = np.concatenate([*news, np.zeros((3, 0), np.uint64)], axis=1)
        news = news[:, np.argsort(news[0], kind="stable")]
        # Who has a segment first: the pack itself, unless it was told of someone earlier.
        _, one, which = np.unique(name, return_index=True, return_inverse=True)
        first, mask = ids[doc[one]].copy(), np.zeros(len(one), np.uint64)
        if news.shape[1] and len(one):
            k = np.minimum(np.searchsorted(news[0], name[one]), news.shape[1] - 1)
            told = news[0][k] == name[one]
            first[told], mask[told] = news[1][k[told]].view(np.int64), news[2][k[told]]
        change = np.zeros(len(data) + 1, np.int32)  # bytes that go: the strings that start earlier, LENGTH bytes each
        late = first[which] < ids[doc]
        np.add.at(change, lo[late], 1)
        np.add.at(change, hi[late], -1)
        some = np.flatnonzero(~late & (mask[which] != 0))
        own = mask[which[some]]
        for j in range(SPAN):
            at = lo[some[(own >> np.uint64(j)) & np.uint64(1) != 0]] + j
            np.add.at(change, at, 1)
            np.add.at(change, at + LENGTH, -1)
        whole = shared.copies[np.diff(offsets)[shared.copies] >= LENGTH]
        np.add.at(change, offsets[whole], 1)
        np.add.at(change, offsets[whole + 1], -1)
        gone = np.cumsum(change[:-1]) > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        begins[offsets[:-1][np.diff(offsets) > 0]] = gone[offsets[:-1][np.diff(offsets) > 0]]
        removed, spans = (np.concatenate([[0], np.cumsum(c)]) for c in (gone, begins))
        kept, stays = [], np.concatenate([[0], np.cumsum(~gone)])
        left = data[~gone].tobytes()
        for a, b in zip(stays[offsets[:-1]].tolist(), stays[offsets[1:]].tolist()):
            kept.append(hashlib.sha256(left[a:b]).hexdigest() if digest else left[a:b])
        between = lambda c: c[offsets[1:]] - c[offsets[:-1]]
        columns = (ids, np.diff(offsets), between(removed), between(spans), kept)
        out = pd.DataFrame(dict(zip(names, columns)))
        return pd.concat([out] * len(packs)) if len(packs) > 1 else out

    return run


def dedup_strings(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the bytes kept; a row per document.

    With ``digest`` the bytes are replaced by their SHA-256: kept_sha256.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), "text")
    packs = stored(rows.mapInArrow(_packs, "pack bigint, size bigint, blob binary, names binary"), "packs")
    total = packs.agg(F.sum("size")).first()[0] or 0
    buckets = 4 + int(total * 0.065 * 6) // BUCKET_BYTES
    anchored = packs.select("pack", "blob").mapInArrow(_pack_anchors(buckets), "bucket bigint, pack bigint, blob binary")
    shared = stored(anchored.groupBy("bucket").applyInPandas(_shared_anchors, "pack bigint, n bigint, blob binary"), "shared-anchors")
    blocks = 4 + int((shared.agg(F.sum("n")).first()[0] or 0) * (LENGTH + SPAN // 2)) // BLOCK_BYTES
    none = F.lit(None).cast("binary"), F.lit(None).cast("bigint")
    twins = stored(copies(packs), "copies").select("pack", F.lit(COPY).alias("kind"), none[0].alias("blob"), "place")
    told = shared.select("pack", F.lit(SHARED).alias("kind"), "blob", none[1].alias("place")).union(twins)
    by_pack = packs.select("pack", "blob").groupBy("pack")
    cut = by_pack.cogroup(told.groupBy("pack")).applyInPandas(_pack_segments(buckets, blocks), "block bigint, pack bigint, n bigint, data binary")
    news = stored(cut.groupBy("block").applyInPandas(_first_documents, "pack bigint, n bigint, blob binary"), "first-documents")
    told = told.union(news.select("pack", F.lit(NEWS), "blob", none[1]))
    kept = "kept_sha256 string" if digest else "kept binary"
    schema = f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {kept}"
    out = by_pack.cogroup(told.groupBy("pack")).applyInPandas(_removal(digest, buckets), schema)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
