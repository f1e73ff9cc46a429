"""Chat formatting at the level of tokens.

Template, with every control string a single reserved id:

    <s>                                   opens a conversation
    <<SYS>> text <</SYS>>                 a system turn
    [INST] text [/INST]                   a user turn
    text </s>                             an assistant turn
    <<ROLE>> role <</ROLE>> text </s>     a turn of any other role

There is no white space around the texts. Each text is encoded by itself and
reserved ids are put between the results, so a text can never produce one. To
keep the rendered string as clear as the ids, a control string inside a text
gets a backslash behind its first character, and a backslash becomes two.

Where the loss counts is derived from the boundaries: +1 where an assistant's
text begins, -1 behind its end, and the prefix sum of both over the ids.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import resident, slices

# Fixed values of the template, in the order of their reserved ids.
BEGIN, END = "<s>", "</s>"
USER, USER_END = "[INST]", "[/INST]"
SYSTEM, SYSTEM_END = "<<SYS>>", "<</SYS>>"
ROLE, ROLE_END = "<<ROLE>>", "<</ROLE>>"
CONTROL = [BEGIN, END, USER, USER_END, SYSTEM, SYSTEM_END, ROLE, ROLE_END]

_CONTROL = re.compile("|".join(map(re.escape, [*CONTROL, "\\"])))
_ESCAPED = re.compile(r"\\(.?)", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


class ChatEncoder:
    """Ids of texts by a rank file; the reserved ids follow the vocabulary."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "chat", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
        # One id is left free behind the vocabulary, as its other form uses it.
        first = max(table.values()) + 2
        self.reserved = {c: first + i for i, c in enumerate(CONTROL)}
        self.control = {i: c for c, i in self.reserved.items()}
        # How ids are packed while they are dealt.
        self.packed = np.dtype("<u2") if first + len(CONTROL) <= 1 << 16 else np.dtype("<u4")

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Ids of one turn, and where an assistant's text begins and ends among them."""
        body, at = self.encoding.encode_ordinary(escape(text)), self.reserved
        before, after = {
            "system": ([at[SYSTEM]], [at[SYSTEM_END]]),
            "user": ([at[USER]], [at[USER_END]]),
            "assistant": ([], [at[END]]),
        }.get(role) or (
            [at[ROLE], *self.encoding.encode_ordinary(escape(role)), at[ROLE_END]],
            [at[END]],
        )
        first = len(before)
        last = first + len(body) if role == "assistant" else first
        return [*before, *body, *after], first, last

    def render(self, ids: list[int]) -> str:
        """The formatted string of ids."""
        out, run = [], []
        for i in [*ids, None]:
            name = self.control.get(i)
            if i is None or name:
                out.append(self.encoding.decode_bytes(run).decode())
                out.append(name or "")
                run = []
            else:
                run.append(i)
        return "".join(out)


def loss_mask(n_ids: int, first: int, last: int) -> np.ndarray:
    """1 from ``first`` up to ``last``, as the prefix sum of both edges."""
    edges = np.zeros(n_ids + 1, np.int8)
    edges[first] += 1
    edges[last] -= 1
    return np.cumsum(edges[:-1], dtype=np.int8)


def _encoder(ranks: str, pattern: str) -> ChatEncoder:
    return resident(("chat", ranks, pattern), lambda: ChatEncoder(ranks, pattern))


ENCODED = ["conv_id", "turn", "role", "text", "packed", "first", "last"]
SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("loss_mask", T.ArrayType(T.ByteType())),
    ]
)


def format_conversations(turns: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Conversations as token ids with a loss mask, one row per turn, in order.

    Takes ``conv_id``, ``turn``, ``role``, ``text``; other columns are not read.
    Turns are encoded where they are read, before any shuffle, so the turns of one
    conversation are encoded by as many tasks as read them. Ids, the edges of the
    loss and, for the order of equal turns, texts are then dealt by conversation
    and sorted; ``part`` counts a conversation's turns and ``start`` the ids before
    this one, both carried along the sorted stream, so that a conversation of any
    length passes through in bounded memory. A null text or role is empty; null
    turns come first; turns that repeat a number are ordered by role, then text,
    and repeated rows all stay; rows without a conversation id are one
    conversation with a null id. No rows give no rows.
    """
    spoken = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks, pattern)
        for batch in slices(batches, "text"):
            packed, first, last = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                ids, a, b = encoder.turn(role, text)
                packed.append(np.array(ids, encoder.packed).tobytes())
                first.append(a)
                last.append(b)
            added = [pa.array(packed, pa.binary()), pa.array(first, pa.int32()), pa.array(last, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=ENCODED)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks, pattern)
        begin = encoder.reserved[BEGIN]
        now, part, start = object(), 0, 0
        for batch in slices(batches, "packed"):
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "packed", "first", "last")]
            rows: list[list] = [[], [], [], [], []]
            for conv, packed, first, last in zip(*columns):
                ids = np.frombuffer(packed, encoder.packed).astype(np.int32)
                mask = loss_mask(len(ids), first, last)
                if conv != now:
                    now, part, start = conv, 0, 0
                    ids, mask = np.append(np.int32(begin), ids), np.append(np.int8(0), mask)
                for column, value in zip(rows, (conv, part, start, ids, mask)):
                    column.append(value)
                part, start = part + 1, start + len(ids)
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int32()), pa.list_(pa.int8())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, k) for r, k in zip(rows, kinds)], names=SCHEMA.names
            )

    kinds = ["long", "long", "string", "string", "binary", "int", "int"]
    encoded = spoken.mapInArrow(encode, ", ".join(map(" ".join, zip(ENCODED, kinds))))
    # Texts have had their part once rows are sorted.
    dealt = encoded.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.select("conv_id", "packed", "first", "last").mapInArrow(assemble, SCHEMA)


class _Reader:
    """Reads turns back from the ids of a conversation, and digests them."""

    def __init__(self, encoder: ChatEncoder, conv: int | None):
        self.encoder, self.conv = encoder, conv
        self.turns, self.turn_hash = 0, hashlib.sha256()
        self.loss_chars, self.loss_hash, self.chars = 0, hashlib.sha256(), 0
        self.role, self.run = "assistant", []

    def text(self, ids: list[int]) -> str:
        return self.encoder.encoding.decode_bytes(ids).decode()

    def feed(self, ids: list[int], mask: list[int]) -> None:
        control = self.encoder.control
        self.chars += len(self.encoder.render(ids))
        spoken = unescape(self.text([i for i, m in zip(ids, mask) if m]))
        self.loss_chars += len(spoken)
        self.loss_hash.update(spoken.encode())
        for i in ids:
            name = control.get(i)
            if name is None:
                self.run.append(i)
            elif name in (USER, SYSTEM, ROLE):
                self.role = {USER: "user", SYSTEM: "system"}.get(name, "")
            elif name == ROLE_END:
                self.role, self.run = unescape(self.text(self.run)), []
            elif name != BEGIN:
                said = unescape(self.text(self.run))
                self.turn_hash.update(f"{self.role}\n{said}\n".encode())
                self.turns, self.role, self.run = self.turns + 1, "assistant", []

    def result(self) -> tuple:
        return (
            self.conv,
            self.turns,
            self.turn_hash.hexdigest(),
            self.loss_chars,
            self.loss_hash.hexdigest(),
            self.chars,
        )


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
    "loss_sha256 string, formatted_chars long"
)


def digest_conversations(formatted: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """One row per conversation, read back from the rows of ``format_conversations``.

    The rows must come as that function gives them: each conversation in one
    partition, in order.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, reader = _encoder(ranks, pattern), None

        def rows(done: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*done) if done else [[]] * 6
            names = [c.split()[0] for c in DIGEST.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "part", "ids", "loss_mask")]
            for conv, part, ids, mask in zip(*columns):
                if part == 0:
                    if reader:
                        done.append(reader.result())
                    reader = _Reader(encoder, conv)
                reader.feed(ids, mask)
            yield rows(done)
        if reader:
            yield rows([reader.result()])

    return formatted.mapInArrow(read, DIGEST)
