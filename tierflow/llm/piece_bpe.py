"""Encoding and decoding with a SentencePiece model through a table of distinct chunks.

The library writes a marker for each blank and one before the text. Where no
piece has a marker behind another character, no merge crosses the place in
front of a run of markers, so a text is cut there into marked words and the ids
of a text are those of its words, one after another. Each worker keeps a table
of the distinct marked words it has met: the library segments a word when it is
first seen, and the ids of a text are gathered from the table by position. A
model whose pieces do cross markers is refused the table: its texts go to the
library whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tierflow.llm.common import Memory, Sequences, append, octets, resident, segment_sums

MARK = "\N{LOWER ONE EIGHTH BLOCK}"
_MARK = MARK.encode()
# A run of markers with what follows it, markers written as blanks.
CHUNK = re.compile(rb" +[^ ]*")
PER_CALL = 50
PROBES = ["a", "a b", "  a", "a  ", "\N{IDEOGRAPHIC SPACE}a", "\N{LATIN SMALL LIGATURE FI}\N{NO-BREAK SPACE}A\N{COMBINING RING ABOVE}"]


def crosses_markers(piece: str) -> bool:
    """Whether a piece has a marker behind another character."""
    return MARK in piece.lstrip(MARK)


class PieceEncoder:
    """Ids of texts, and texts of ids, by a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        model = self.library
        kinds = range(model.get_piece_size())
        self.surface = [self._surface(i) for i in kinds]
        self.mark, self.unknown = model.piece_to_id(MARK), self.surface[model.unk_id()]
        self.opens = np.array([model.id_to_piece(i).startswith(MARK) for i in kinds])
        self.by_chunk = self._has_plain_markers()
        self.ids = Sequences()
        self.chunks = Memory(self.learn, self.ids.keep, 200_000)

    def _surface(self, i: int) -> bytes:
        model = self.library
        if model.is_control(i):
            return b""
        if model.is_byte(i):
            return bytes([int(model.id_to_piece(i)[3:-1], 16)])
        if model.is_unknown(i):
            return model.decode([i]).encode()
        return model.id_to_piece(i).replace(MARK, " ").encode()

    def _has_plain_markers(self) -> bool:
        """Whether texts are cut as this module does: seen from the pieces and from short texts."""
        model = self.library
        if any(crosses_markers(model.id_to_piece(i)) for i in range(model.get_piece_size())):
            return False
        if self.mark == model.unk_id():
            return False
        # No other normalization, and a marker before the text: then pieces spell it out.
        spelled = [b"".join(self.surface[i] for i in model.encode(p)) for p in PROBES]
        return spelled == [b" " + p.encode() for p in PROBES]

    def learn(self, chunks: list[bytes]) -> None:
        # Many words reach the library as one text, which again is cut by its
        # markers: a word's first piece, and no other, begins with one.
        encode = self.library.encode
        for at in range(0, len(chunks), PER_CALL):
            some = chunks[at : at + PER_CALL]
            if not any(c.startswith(b"  ") or c == b" " for c in some):
                ids = np.array(encode(b"".join(some)[1:].decode()), np.int64)
                starts = np.flatnonzero(self.opens[ids])
                if len(starts) == len(some):
                    self.ids.extend_flat(ids, np.diff(starts, append=len(ids)))
                    continue
            # The library adds the first marker itself, but not to an empty text.
            lists = encode([c[1:].decode() for c in some], num_threads=1)
            self.ids.extend([x if len(c) > 1 else [self.mark] for c, x in zip(some, lists)])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        if not self.by_chunk:
            lists = self.library.encode([t.decode() for t in texts], num_threads=1)
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            return np.array([i for x in lists for i in x], np.int32), counts
        words = [CHUNK.findall(b" " + t.replace(_MARK, b" ")) if t else [] for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        numbers = self.chunks.numbers([w for x in words for w in x])
        values, lengths = self.ids.gather(numbers)
        return values, segment_sums(lengths, counts)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; ids beyond the model raise an error."""
        spelled = b"".join(map(self.surface.__getitem__, ids))
        if self.by_chunk and not spelled.startswith(self.unknown):
            try:
                return spelled.decode().removeprefix(" ")
            except UnicodeDecodeError:
                pass  # The library says what broken bytes become.
        return self.library.decode(ids)


def piece_encoder(path: str) -> PieceEncoder:
    return resident(("pieces", path), lambda: PieceEncoder(path))


IDS = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_tokens", T.LongType()),
    ]
)
DECODED = T.StructType([T.StructField("decoded", T.StringType())])


def _lists(values: np.ndarray, counts: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and ids of an Arrow list, each text followed by its end id."""
    if end_id is None:
        return np.concatenate([[0], np.cumsum(counts)]), values
    ends = np.cumsum(counts)
    return np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]), np.insert(values, ends, end_id)


def _encoded(encoder: PieceEncoder, column: pa.Array, end_id: int | None) -> tuple:
    values, counts = encoder.encode(octets(column))
    offsets, ids = _lists(values, counts, end_id)
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
    return offsets, ids, [lists, pa.array(np.diff(offsets), pa.int64())]


def encode_pieces(
    docs: DataFrame, model: str, end_id: int | None = None, text: str = "text"
) -> DataFrame:
    """Add ``ids`` of the whole texts as the library gives them, and ``n_tokens``.

    With ``end_id``, that id follows each text's own and is counted. A null or
    empty text has no ids but that one. Columns named like the result are
    replaced, others pass; repeated rows stay; nothing is shuffled.
    """

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        encoder = piece_encoder(model)
        return lambda column: _encoded(encoder, column, end_id)[2]

    return append(docs, IDS, make, text)


def decode_pieces(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of ``ids``, as the library's ``decode`` gives it.

    Control ids vanish, bytes that are no UTF-8 become replacement characters,
    null or empty ids give an empty text, and an id beyond the model an error.
    """

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        encoder = piece_encoder(model)
        return lambda column: [
            pa.array([encoder.decode(x or []) for x in column.to_pylist()], pa.string())
        ]

    # Lists have no length in bytes: their number of rows per batch is Spark's.
    kept = [f for f in encoded.schema if f.name.lower() != "decoded"]
    schema, names = T.StructType([*kept, *DECODED]), [f.name for f in kept]

    def run(batches):
        step = make()
        for batch in batches:
            arrays = [batch.column(n) for n in names] + step(batch.column(ids))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return encoded.mapInArrow(run, schema)


def piece_round_trip(
    docs: DataFrame, model: str, end_id: int | None = None, text: str = "text"
) -> DataFrame:
    """``encode_pieces`` and then ``decode_pieces``, in one Python worker."""

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        encoder = piece_encoder(model)

        def step(column: pa.Array) -> list[pa.Array]:
            offsets, ids, arrays = _encoded(encoder, column, end_id)
            decoded = [
                encoder.decode(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])
            ]
            return [*arrays, pa.array(decoded, pa.string())]

        return step

    return append(docs, T.StructType([*IDS, *DECODED]), make, text)
