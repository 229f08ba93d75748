"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash of the last bytes says so, hence at the same places in every copy of a passage.
A task encodes each distinct chunk once; chunks it has met before, in whichever document, are looked up.  Inside a chunk
only the pieces between two white spaces are final.  The open ends of neighbouring chunks are joined again and the join is
re-encoded up to the white space on both sides; if there is none in a chunk, the join grows over that chunk too.  For
tokenizers whose pre-tokens never hold white space (``separable`` checks this) that is exactly the encoding of the whole text.

Edge cases: NULL and empty texts have no tokens and decode to an empty text.  Rows are encoded one by one, so repeated rows give
equal results; very long texts are cut like all others; only ``doc_id`` and ``text`` are read.  The strings of special tokens
inside a text become those tokens, as the library does.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyward.llm.text import pieces, prefix_sums, ship, span_hashes, texts_of

WINDOW = 16  # bytes under the rolling hash
MEAN_CHUNK = 512  # bytes between two cuts, on average
LEAST_CHUNK = 64
KNOWN_PIECES = 200_000  # remembered by a worker; forgotten together when there are more
KNOWN_CHUNKS = 4_000


def separable(settings: dict) -> bool:
    """Does white space always end a token, and never become one?  Then texts may be cut at white space."""
    steps = settings.get("normalizer") or {}
    steps = steps.get("normalizers", [steps])
    before = settings.get("pre_tokenizer") or {}
    before = before.get("pretokenizers", [before])
    context_free = all(s.get("type") in ("NFC", "Lowercase") or s.get("pattern") == {"Regex": "\\s+"} for s in steps)
    drops = before[0].get("type") == "Split" and before[0].get("behavior") == "Removed" and before[0].get("invert")
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in settings["added_tokens"])
    return bool(context_free and drops and plain and not settings.get("post_processor") and not settings.get("decoder"))


class Encoder:
    """One tokenizer with what a worker remembers of pieces and chunks."""

    _of: dict[str, Encoder] = {}

    def __init__(self, settings: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        if not separable(json.loads(settings)):
            raise ValueError("this tokenizer's tokens may hold white space: texts cannot be cut there")
        self.tokenizer = Tokenizer.from_str(settings)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.names = {i: f" {t}" for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.ids: dict[bytes, bytes] = {}
        self.shown: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, tuple] = {}

    @classmethod
    def of(cls, settings: str) -> Encoder:
        if settings not in cls._of:
            cls._of = {settings: cls(settings)}
        return cls._of[settings]

    def learn(self, wanted: set[bytes]) -> None:
        """Encode the pieces not met before; a piece is decoded as its tokens' names, each after a space."""
        new = [w for w in wanted if w not in self.ids]
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            for piece, e in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)):
                self.ids[piece] = np.asarray(e.ids, "<u4").tobytes()
                self.shown[piece] = "".join([self.names[i] for i in e.ids]).encode()

    def encode(self, texts: list[list[bytes]]) -> Iterator[tuple[bytes, bytes]]:
        """Token ids (little-endian) and decoded bytes of texts given as lists of chunks."""
        if len(self.chunks) > KNOWN_CHUNKS:
            self.chunks.clear()
        if len(self.ids) > KNOWN_PIECES:
            self.ids.clear(), self.shown.clear()
        fresh = {c for chunks in texts for c in chunks} - self.chunks.keys()
        parts = {c: _ends(c) for c in fresh}
        inner = {c: middle.split() for c, (_, middle, _) in parts.items() if middle is not None}
        joins = [list(_joins([parts.get(c) or self.chunks[c][2] for c in chunks])) for chunks in texts]
        wanted = {w for ws in inner.values() for w in ws}
        wanted.update(w for join in joins for w in join if w)
        self.learn(wanted)
        ids, shown = self.ids.__getitem__, self.shown.__getitem__
        for c, ends in parts.items():
            ws = inner.get(c)
            self.chunks[c] = (b"", b"", ends) if ws is None else (b"".join(map(ids, ws)), b"".join(map(shown, ws)), ends)
        for chunks, join in zip(texts, joins):
            known = [self.chunks[c] for c in chunks if self.chunks[c][2][1] is not None]
            out_ids, out_shown = [], []
            for k, piece in enumerate(join):
                if piece:
                    out_ids.append(self.ids[piece]), out_shown.append(self.shown[piece])
                if k < len(known):
                    out_ids.append(known[k][0]), out_shown.append(known[k][1])
            yield b"".join(out_ids), b"".join(out_shown)[1:]


SPACE = b" \t\n\x0b\x0c\r"


def _ends(chunk: bytes) -> tuple[bytes, bytes | None, bytes]:
    """Open head, final middle (from the first white space to the last) and open tail; without white space all is head."""
    head = chunk.split(None, 1)[0] if chunk[:1].strip() else b""
    if len(head) == len(chunk):
        return chunk, None, b""
    tail = chunk.rsplit(None, 1)[-1] if chunk[-1:].strip() else b""
    return head, chunk[len(head) : len(chunk) - len(tail)], tail


def _joins(parts: list[tuple]) -> Iterator[bytes]:
    """What lies between the middles: one open piece (or nothing) before, between and after them."""
    open_ = b""
    for head, middle, tail in parts:
        open_ += head
        if middle is not None:
            yield open_
            open_ = tail
    yield open_


def cuts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Per text the bounds of its chunks: after each window whose hash is a multiple of ``MEAN_CHUNK``, not too close together."""
    at = np.zeros(0, np.int64)
    if len(data) >= WINDOW:
        starts = np.arange(len(data) - WINDOW + 1)
        h = span_hashes(prefix_sums(data), starts, starts + WINDOW)
        at = np.flatnonzero(h % np.uint64(MEAN_CHUNK) == 0) + WINDOW
    out = []
    first = np.searchsorted(at, offsets[:-1] + WINDOW)  # windows across two texts do not count
    last = np.searchsorted(at, offsets[1:])
    for lo, hi, a, b in zip(offsets[:-1], offsets[1:], first, last):
        kept = [lo]
        for cut in at[a:b]:
            if cut - kept[-1] >= LEAST_CHUNK:
                kept.append(cut)
        out.append(np.append(kept, hi) if hi > lo else np.array([lo]))
    return out


def encode(docs: DataFrame, settings: str, digest: bool = False) -> DataFrame:
    """doc_id, n_tokens, and the token ids (binary, little-endian unsigned 32-bit) with the decoded text.

    ``settings`` is the tokenizer's JSON (a fixed file, sent to the workers once).  With ``digest`` the two
    large columns are replaced by their SHA-256: ids_sha256, decoded_sha256.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(shared.value)
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            for lo, hi in pieces(offsets):
                part = offsets[lo : hi + 1]
                raw = data[part[0] : part[-1]]
                whole = raw.tobytes()
                texts = [[whole[a:b] for a, b in pairwise(at.tolist())] for at in cuts(raw, part - part[0])]
                counts, ids, shown = [], [], []
                for i, d in encoder.encode(texts):
                    counts.append(len(i) // 4)
                    ids.append(hashlib.sha256(i).hexdigest() if digest else i)
                    shown.append(hashlib.sha256(d).hexdigest() if digest else d.decode())
                columns = [pa.array(counts, pa.int64()), pa.array(ids, pa.string() if digest else pa.binary()), pa.array(shown, pa.string())]
                yield pa.record_batch([batch.column("doc_id").slice(lo, hi - lo), *columns], names)

    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"])]
    kinds = ["bigint", *(["string", "string"] if digest else ["binary", "string"])]
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, [key, *kinds]))
    return docs.select("doc_id", "text").mapInArrow(run, schema)
