"""Chat formatting at token level.

Every turn's text is encoded by itself, and the template's marks are spliced in as reserved ids that lie above the vocabulary: no text,
whatever it says, can produce one.  Where a text holds a control string (or a backslash), a backslash is put before it, so the formatted text can
be read back as well as the ids.  The loss mask covers the tokens of the assistant's texts; it is the running sum of +1 where such
a text starts and -1 where it ends, both found from the running sums of the segments' lengths.

Template: ``<<SYS>>system<</SYS>>``, ``[INST]user[/INST]``, ``<s>assistant</s>``; any other role is ``[ROLE]name[:]text[/ROLE]``.

Edge cases: rows go by ``turn`` (NULL first), ties by role and text; repeated rows are turns like others.  A NULL text or role is an empty one.
Rows with a NULL conv_id form one conversation.  A conversation is one row of the result, so it has to fit a task; a table
without rows gives none.  Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.text import ship

#: The template's control strings; their place in this list, added to the size of the vocabulary, is the reserved id.
CONTROLS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[:]", "[/ROLE]"]
ROLES = {"system": (0, 1), "user": (2, 3), "assistant": (4, 5)}
OTHER, NAMED, END = 6, 7, 8
_ESCAPED = re.compile("|".join(["\\\\", *map(re.escape, CONTROLS)]))
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


class Codec:
    """A byte-level tokenizer, in which the strings of special tokens are ordinary text, and the reserved ids above it."""

    _of: dict[str, Codec] = {}

    def __init__(self, settings: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(settings)
        self.tokenizer.encode_special_tokens = True
        self.base = self.tokenizer.get_vocab_size(with_added_tokens=True)

    @classmethod
    def of(cls, settings: str) -> Codec:
        if settings not in cls._of:
            cls._of = {settings: cls(settings)}
        return cls._of[settings]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([escape(t) for t in texts], add_special_tokens=False)
        return [np.asarray(e.ids, "<u4") for e in found]

    def decode(self, ids: np.ndarray) -> str:
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)

    def assemble(self, turns: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and loss mask of one conversation; a turn has ``role`` and the encoded ``name`` and ``text``."""
        mark = lambda k: np.array([self.base + k], "<u4")
        parts, loss = [], []
        for t in turns:
            ids = np.frombuffer(t["text"], "<u4")
            if t["role"] in ROLES:
                start, end = ROLES[t["role"]]
                parts += [mark(start), ids, mark(end)]
            else:
                parts += [mark(OTHER), np.frombuffer(t["name"], "<u4"), mark(NAMED), ids, mark(END)]
            if t["role"] == "assistant":
                loss.append(len(parts) - 2)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        change = np.zeros(bounds[-1] + 1, np.int64)
        np.add.at(change, bounds[loss], 1)
        np.add.at(change, bounds[np.asarray(loss, np.int64) + 1], -1)
        return np.concatenate([*parts, np.zeros(0, "<u4")]).astype("<u4"), np.cumsum(change[:-1]).astype(np.uint8)

    def formatted(self, ids: np.ndarray) -> str:
        """The formatted text, control strings and escapes included."""
        at = [-1, *np.flatnonzero(ids >= self.base).tolist(), len(ids)]
        out = []
        for a, b in pairwise(at):
            out.append(self.decode(ids[a + 1 : b]) if b > a + 1 else "")
            out.append(CONTROLS[int(ids[b]) - self.base] if b < len(ids) else "")
        return "".join(out)

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[list[dict], str]:
        """The turns, from the reserved ids, and the text under the loss mask."""
        at = np.flatnonzero(ids >= self.base)
        names = {start: role for role, (start, _) in ROLES.items()}
        turns, role = [], None
        for a, b in pairwise(at.tolist()):
            kind = int(ids[a]) - self.base
            text = lambda a=a, b=b: unescape(self.decode(ids[a + 1 : b])) if b > a + 1 else ""
            if kind in names:
                turns.append({"role": names[kind], "text": text()})
            elif kind == OTHER:
                role = text()
            elif kind == NAMED:
                turns.append({"role": role, "text": text()})
        edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]]).astype(np.int8)))
        loss = [unescape(self.decode(ids[a:b])) for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist())]
        return turns, "".join(loss)


def format_chats(conversations: DataFrame, settings: str) -> DataFrame:
    """conv_id, ids (little-endian unsigned 32-bit), mask (a byte per id) and the formatted text; a row per conversation.

    Rows are encoded where they are; only then do the encoded turns of a conversation meet.
    """
    ship(conversations.sparkSession)
    shared = conversations.sparkSession.sparkContext.broadcast(settings)  # a fixed file
    key = conversations.schema["conv_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                texts = [t or "" for t in part.column("text").to_pylist()]
                roles = [r or "" for r in part.column("role").to_pylist()]
                name = dict(zip(set(roles), [i.tobytes() for i in codec.encode(list(set(roles)))])) if roles else {}
                ids = [i.tobytes() for i in codec.encode(texts)]
                columns = [pa.array(roles, pa.string()), pa.array([name[r] for r in roles], pa.binary()), pa.array(ids, pa.binary())]
                kept = [part.column("conv_id"), part.column("turn"), part.column("raw")]
                yield pa.record_batch([*kept, *columns], ["conv_id", "turn", "raw", "role", "name", "text"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                made = [codec.assemble(turns) for turns in part.column("turns").to_pylist()]
                columns = [pa.array([i.tobytes() for i, _ in made], pa.binary()), pa.array([m.tobytes() for _, m in made], pa.binary())]
                text = pa.array([codec.formatted(i) for i, _ in made], pa.string())
                yield pa.record_batch([part.column("conv_id"), *columns, text], ["conv_id", "ids", "mask", "formatted"])

    turn = conversations.schema["turn"].dataType.simpleString()
    # Ties go by the text's bytes, of which a hash would change the order: keep the text itself for sorting.
    rows = conversations.select("conv_id", "turn", "role", "text", F.coalesce("text", F.lit("")).alias("raw"))
    encoded = rows.mapInArrow(encode, f"conv_id {key}, turn {turn}, raw string, role string, name binary, text binary")
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "raw", "name", "text")))
    whole = encoded.groupBy("conv_id").agg(turns.alias("turns"))
    whole = whole.select("conv_id", F.transform("turns", lambda t: t.dropFields("turn", "raw")).alias("turns"))
    return whole.mapInArrow(assemble, f"conv_id {key}, ids binary, mask binary, formatted string")


def read_chats(formatted: DataFrame, settings: str) -> DataFrame:
    """conv_id, turns (role, text), loss (the text under the mask) and formatted_chars, read back from ids and mask alone."""
    ship(formatted.sparkSession)
    shared = formatted.sparkSession.sparkContext.broadcast(settings)
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    key = formatted.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                ids = [np.frombuffer(x, "<u4") for x in part.column("ids").to_pylist()]
                masks = [np.frombuffer(x, np.uint8) for x in part.column("mask").to_pylist()]
                found = [codec.read(i, m) for i, m in zip(ids, masks)]
                chars = pa.array([len(codec.formatted(i)) for i in ids], pa.int64())
                columns = [pa.array([t for t, _ in found], kind), pa.array([x for _, x in found], pa.string()), chars]
                yield pa.record_batch([part.column("conv_id"), *columns], ["conv_id", "turns", "loss", "formatted_chars"])

    schema = f"conv_id {key}, turns array<struct<role:string,text:string>>, loss string, formatted_chars bigint"
    return formatted.select("conv_id", "ids", "mask").mapInArrow(read, schema)
