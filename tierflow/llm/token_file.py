"""Token ids in binary blocks whose document boundaries are Elias-Fano coded.

A file is a table of blocks, since on a cluster only Spark's writers reach the
store. Each block is a row: documents in ascending order, their ids one after
another, and the boundaries between them as an Elias-Fano sequence, which needs
about two bits and the low bits per document and still gives any boundary by a
select over its upper bits. Blocks know their place within their shard, and
shards are numbered in order, so offsets over all ids follow from one sum per
shard.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import Memory, Sequences, octets, resident, segment_sums, slices

# ---------------------------------------------------------------- Elias-Fano

MAGIC = b"EFB1"
HEAD = struct.Struct("<4sIQQB")
SAMPLE = 256


class EliasFano:
    """A non-decreasing sequence of whole numbers, with ``select``.

    The ``low`` lowest bits of each value are packed one after another; the rest
    is a bit array with bit ``(value >> low) + i`` set for the i-th value. The
    place of every 256th set bit is stored, so that ``select`` reads a few bytes.
    """

    def __init__(self, data: bytes | memoryview):
        magic, self.sample, self.size, self.limit, self.low = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not an Elias-Fano sequence")
        view, at = memoryview(data), HEAD.size
        lows = (self.size * self.low + 7) // 8
        self.lows = np.frombuffer(view[at : at + lows], np.uint8)
        at += lows
        highs = (self.size + (self.limit >> self.low) + 1 + 7) // 8
        self.highs = np.frombuffer(view[at : at + highs], np.uint8)
        at += highs
        self.samples = np.frombuffer(view[at : at + 8 * -(-self.size // self.sample)], "<u8")

    @staticmethod
    def encode(values: np.ndarray, sample: int = SAMPLE) -> bytes:
        values = np.asarray(values, np.int64)
        n, limit = len(values), int(values[-1]) if len(values) else 0
        low = max(0, (limit // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low)) & 1
        lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        places = (values >> low) + np.arange(n)
        upper = np.zeros(n + (limit >> low) + 1, np.uint8)
        upper[places] = 1
        return b"".join(
            [
                HEAD.pack(MAGIC, sample, n, limit, low),
                lows.tobytes(),
                np.packbits(upper, bitorder="little").tobytes(),
                places[::sample].astype("<u8").tobytes(),
            ]
        )

    def _low(self, i: int) -> int:
        first, last = i * self.low, (i + 1) * self.low
        window = int.from_bytes(self.lows[first >> 3 : (last + 7) >> 3].tobytes(), "little")
        return (window >> (first & 7)) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        place, left = int(self.samples[i // self.sample]), i % self.sample
        byte = place >> 3
        bits = int(self.highs[byte]) >> (place & 7) << (place & 7)
        while left >= bits.bit_count():
            left -= bits.bit_count()
            byte += 1
            bits = int(self.highs[byte])
        for _ in range(left):
            bits &= bits - 1
        place = (byte << 3) + (bits & -bits).bit_length() - 1
        return ((place - i) << self.low) | self._low(i)

    def values(self) -> np.ndarray:
        """All values."""
        high = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.size]
        bits = np.unpackbits(self.lows, bitorder="little")[: self.size * self.low]
        weights = 1 << np.arange(self.low, dtype=np.int64)
        lows = bits.reshape(self.size, self.low).astype(np.int64) @ weights
        return ((high - np.arange(self.size)) << self.low) | lows


# ---------------------------------------------------------------- tokenizing

# What the library does to these texts is known without it: Latin letters are
# lower-cased one by one, composed already, and split as in SPLIT, if all of them are
# still among its letters then. Of all other texts the pieces between white space go
# to the library whole, and so do those of a tokenizer that does not say that it splits and lower-cases like this.
PLAIN = re.compile("[\\t-\\r -~À-ÖØ-öø-ɏ]*")
LOWER = re.compile("[\\t-\\r -~ß-öø-ɏ]*")
# The parts of a tokenizer file that say so.
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏªº]+|[0-9]|[^\\t-\\r a-zß-öø-ɏ0-9]+")
PER_CALL = 1000


def splits_plainly(path: str) -> bool:
    """Whether a tokenizer file normalizes and splits as SPLIT takes it to."""
    with open(path, "rb") as file:
        parts = json.load(file)
    normalizer, splitter = parts.get("normalizer") or {}, parts.get("pre_tokenizer") or {}
    first = (splitter.get("pretokenizers") or [{}])[0]
    return (
        normalizer.get("normalizers") == NORMALIZERS
        and first.get("pattern") == {"Regex": SPLITTER}
        and (first.get("behavior"), first.get("invert")) == ("Removed", True)
        and [p.get("use_regex") for p in splitter["pretokenizers"][1:]] == [False]
    )


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space and marks word ends.

    White space separates what the tokenizer looks at, so a text's ids are those of
    its words, or, where these are not known, of its pieces; both are encoded once
    and remembered. New words reach the library many at a time and are told apart
    by their end-of-word tokens.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.is_end = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.is_end[i] = token.endswith("</w>")
        self.splits_plainly = splits_plainly(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ids, self.word_ids = Sequences(), Sequences()
        self.pieces = Memory(self.learn, self.ids.keep, 100_000)
        self.words = Memory(self.learn_words, self.word_ids.keep, 400_000)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def plain_words(self, text: str) -> list[str] | None:
        """The words of a text, if it is known what the library takes for them."""
        if not self.splits_plainly or PLAIN.fullmatch(text) is None:
            return None
        lowered = text.lower()
        if LOWER.fullmatch(lowered) is None or any(s in text for s in self.special):
            return None
        return SPLIT.findall(lowered)

    def learn(self, pieces: list[bytes]) -> None:
        texts = [p.decode() for p in pieces]
        words = [self.plain_words(t) for t in texts]
        values, sizes = self.of_words([w or [] for w in words])
        ends = np.cumsum(sizes)
        self.ids.extend(
            [
                self.whole(t) if w is None else values[e - n : e].tolist()
                for t, w, e, n in zip(texts, words, ends.tolist(), sizes.tolist())
            ]
        )

    def of_words(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lists of words one after another, and how many each list has."""
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        values, lengths = self.word_ids.gather(self.words.numbers([w for x in lists for w in x]))
        return values, segment_sums(lengths, counts)

    def learn_words(self, words: list[str]) -> None:
        for at in range(0, len(words), PER_CALL):
            some = words[at : at + PER_CALL]
            ids = np.array(self.whole(" ".join(some)), np.int64)
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                self.word_ids.extend_flat(ids, np.diff(ends, prepend=0))
            else:
                self.word_ids.extend([self.whole(w) for w in some])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        words = [self.plain_words(t.decode()) for t in texts]
        odd = [i for i, w in enumerate(words) if w is None]
        values, sizes = self.of_words([w or [] for w in words])
        if not odd:
            return values, sizes
        pieces = [texts[i].split() for i in odd]
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        others, lengths = self.ids.gather(self.pieces.numbers([p for x in pieces for p in x]))
        # Texts of pieces have no ids of words, so theirs go where these would be.
        places = np.repeat((np.cumsum(sizes) - sizes)[odd], segment_sums(lengths, counts))
        sizes[odd] = segment_sums(lengths, counts)
        return np.insert(values, places, others), sizes


def word_encoder(path: str) -> WordEncoder:
    return resident(("words", path), lambda: WordEncoder(path))


# -------------------------------------------------------------------- blocks

BLOCK_IDS = 1 << 20
BLOCK = T.StructType(
    [
        T.StructField("shard", T.LongType()),
        T.StructField("block", T.LongType()),
        T.StructField("first", T.LongType()),  # ids of the shard before this block
        T.StructField("n_ids", T.LongType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("bounds", T.BinaryType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def _blocks(make: Callable[[], WordEncoder], end_id: int, limit: int):
    def block(shard, number, first, docs, ids, dtype):
        bounds = np.cumsum([0, *map(len, ids)])
        row = [shard, number, first, int(bounds[-1]), dtype.itemsize, docs]
        row += [EliasFano.encode(bounds), np.concatenate(ids).astype(dtype).tobytes()]
        arrays = [pa.array([v], f) for v, f in zip(row, ARROW)]
        return pa.RecordBatch.from_arrays(arrays, names=BLOCK.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = make(), TaskContext.get().partitionId()
        docs, ids, size, first, number = [], [], 0, 0, 0
        for batch in slices(batches, "text"):
            values, counts = encoder.encode(octets(batch.column("text")))
            ends = np.cumsum(counts)
            for doc, end, n in zip(batch.column("doc_id").to_pylist(), ends, counts):
                if docs and size + n + 1 > limit:
                    yield block(shard, number, first, docs, ids, encoder.dtype)
                    first, number = first + size, number + 1
                    docs, ids, size = [], [], 0
                docs.append(doc)
                ids.append(np.append(values[end - n : end], end_id))
                size += int(n) + 1
        if docs:
            yield block(shard, number, first, docs, ids, encoder.dtype)

    return run


ARROW = [pa.int64()] * 4 + [pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()]


def write_token_file(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode each whole text, append ``end_id``, and write blocks in order of ids.

    Texts are dealt by ranges of ids, in one shuffle, and each range is one shard.
    Null ids come first; rows of one id are ordered by a hash of their text, then
    by their place in the input, so ids that repeat, however often, spread over
    several shards. A null or empty text has the end id alone. A block has
    ``block_ids`` ids at most, or one document. Other columns are not read; an
    empty table gives a file without blocks.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        F.monotonically_increasing_id().alias("place"),
    ).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("place")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.select("doc_id", "text").mapInArrow(
        _blocks(lambda: word_encoder(tokenizer), end_id, block_ids), BLOCK
    ).write.option("compression", "zstd").parquet(path)


def _unpack(bases: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                bounds = EliasFano(row["bounds"].as_buffer()).values()
                width = row["width"].as_py()
                ids = np.frombuffer(row["ids"].as_buffer(), f"<u{width}").astype("<u4")
                data = memoryview(ids).cast("B")
                crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:])]
                base = bases[row["shard"].as_py()] + row["first"].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        row["doc_ids"].values,
                        pa.array(base + bounds[:-1], pa.int64()),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def shard_bases(spark: SparkSession, path: str) -> dict[int, int]:
    """Per shard the ids of all shards before it: one number per written partition."""
    totals = spark.read.schema(BLOCK).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    bases, base = {}, 0
    for r in sorted(totals.collect()):
        bases[r.shard] = base
        base += r.n
    return bases


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a token file: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it; the checksum is over the
    ids, the end id included, as little-endian unsigned 32-bit numbers. Blocks are
    read where they lie, without a shuffle.
    """
    blocks = spark.read.schema(BLOCK).parquet(path)
    return blocks.select("shard", "first", "width", "doc_ids", "bounds", "ids").mapInArrow(
        _unpack(shard_bases(spark, path)), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_range(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of the whole file; reads only the blocks that hold them."""
    bases = shard_bases(spark, path)
    wanted = [s for s, base in bases.items() if base < stop]
    blocks = spark.read.schema(BLOCK).parquet(path).where(F.col("shard").isin(wanted))
    base = F.create_map(*[F.lit(x) for s in wanted for x in (s, bases[s])])[F.col("shard")] if wanted else F.lit(0)
    at = base + F.col("first")
    rows = blocks.where((at < stop) & (at + F.col("n_ids") > start)).select(at.alias("at"), "width", "ids")
    found = []
    for r in sorted(rows.collect(), key=lambda r: r["at"]):
        ids = np.frombuffer(r["ids"], f"<u{r['width']}")
        found.append(ids[max(0, start - r["at"]) : max(0, stop - r["at"])])
    return np.concatenate(found).astype(np.uint32) if found else np.zeros(0, np.uint32)
