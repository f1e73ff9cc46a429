"""Quality classifier: hashed word and character n-gram vectors, averaged, softmax.

Words are what white space separates, with their case and signs. A document is
the mean of the vectors of its words, of the words' n-grams, and of two marks
for repetition: a word that follows itself, and one that occurred before. Vectors
and the output layer are trained together by stochastic gradient descent in
numpy on a bounded sample. For two labels the output depends on one number per
vector, so scoring needs only that number for each word that a text holds.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import (
    Memory,
    Rows,
    append,
    keep_where,
    octets,
    resident,
    segment_sums,
    share,
    slices,
)

BUCKETS = 1 << 16
FOLLOWS, SEEN = BUCKETS, BUCKETS + 1
SIZES = (1, 2, 3)
PER_STEP = 20_000
SLICE = 1 << 19
FIELDS = T.StructType(
    [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
)


def word_buckets(word: bytes) -> list[int]:
    """Buckets of a word and of its n-grams."""
    marked = b"<" + word + b">"
    found = [zlib.crc32(marked) % BUCKETS]
    for n in SIZES:
        found += [
            zlib.crc32(marked[i : i + n], n) % BUCKETS for i in range(len(marked) - n + 1)
        ]
    return found


def _crc_table() -> np.ndarray:
    """Steps of crc32 by byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ (np.uint32(0xEDB88320) * (table & 1))
    return table


_CRC = _crc_table()


def all_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``word_buckets`` of many words, one after another, and how many each has.

    The words lie in one array; the n-grams of a length are hashed at all places at
    once, and those that cross the end of a word are left out.
    """
    marked = [b"<" + w + b">" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked), np.uint8)
    word = np.repeat(np.arange(len(marked)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    found = [np.fromiter(map(zlib.crc32, marked), np.int64, len(marked)) % BUCKETS]
    owner = [np.arange(len(marked))]
    for n in SIZES:
        places = np.flatnonzero(left >= n)
        crc = np.full(len(places), ~np.uint32(n), np.uint32)
        for k in range(n):
            crc = _CRC[(crc ^ data[places + k]) & 0xFF] ^ (crc >> 8)
        found.append((~crc % BUCKETS).astype(np.int64))
        owner.append(word[places])
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.bincount(owners, minlength=len(marked))


def repetition(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: words that follow themselves, and words that occurred before."""
    docs = np.repeat(np.arange(len(counts)), counts)
    follows = np.zeros(len(numbers), np.int64)
    follows[1:] = (numbers[1:] == numbers[:-1]) & (docs[1:] == docs[:-1])
    keys = np.sort(docs << 32 | numbers)
    again = np.zeros(len(keys), np.int64)
    again[1:] = keys[1:] == keys[:-1]
    return segment_sums(follows, counts), segment_sums(again, counts)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's buckets with their counts."""
    index: dict[bytes, int] = {}
    memory = Memory(lambda words: None, lambda numbers: None)
    for batch in slices(batches, "text"):
        lists = [t.split() for t in octets(batch.column("text"))]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        numbers = memory.numbers([w for x in lists for w in x])
        follows, seen = repetition(numbers, counts)
        buckets, weights = [], []
        for words, f, s in zip(lists, follows, seen):
            index.clear()
            for w in words:
                index[w] = index.get(w, 0) + 1
            total = np.zeros(BUCKETS + 2, np.int32)
            for w, n in index.items():
                np.add.at(total, word_buckets(w), n)
            total[FOLLOWS], total[SEEN] = f, s
            used = np.flatnonzero(total)
            buckets.append(used.astype(np.int32))
            weights.append(total[used])
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(buckets, kind), pa.array(weights, kind), batch.column("label")],
            names=["buckets", "weights", "label"],
        )


@dataclass
class QualityModel:
    """Per bucket what it adds for label 1 against label 0, and the bias."""

    gains: np.ndarray
    bias: float
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def train(
    docs: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    dim: int = 8,
    epochs: int = 12,
    rate: float = 0.5,
    batch: int = 32,
    seed: int = 7,
) -> QualityModel:
    """What embeddings and output layer, once trained, say of label 1 against label 0."""
    if len(set(labels.tolist())) < 2:
        sure = 0.0 if not len(labels) else (4.0 if labels[0] else -4.0)
        return QualityModel(np.zeros(BUCKETS + 2, np.float32), sure)
    vectors, output, bias = train_embeddings(docs, labels, dim, epochs, rate, batch, seed)
    gains = vectors @ (output[:, 1] - output[:, 0])
    return QualityModel(gains.astype(np.float32), float(bias[1] - bias[0]))


def train_embeddings(
    docs: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    dim: int,
    epochs: int,
    rate: float,
    batch: int,
    seed: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, output layer and bias by gradient descent on the cross-entropy."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / dim, 1 / dim, (BUCKETS + 2, dim)).astype(np.float32)
    output = np.zeros((dim, 2), np.float32)
    # Each row weighs the same, so the ratio of the labels goes into the bias.
    bias = np.zeros(2, np.float32)
    shares = [
        (b, (w / max(1, w.sum())).astype(np.float32)) for b, w in docs
    ]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = random.permutation(len(shares))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            buckets = np.concatenate([shares[i][0] for i in chosen])
            weights = np.concatenate([shares[i][1] for i in chosen])
            counts = np.array([len(shares[i][0]) for i in chosen])
            rows = vectors[buckets] * weights[:, None]
            hidden = segment_sums(rows.astype(np.float64), counts).astype(np.float32)
            logits = hidden @ output + bias
            logits -= logits.max(axis=1, keepdims=True)
            error = np.exp(logits)
            error /= error.sum(axis=1, keepdims=True)
            error[np.arange(len(chosen)), labels[chosen]] -= 1
            back = error @ output.T
            output -= step * hidden.T @ error
            bias -= step * error.sum(axis=0) / len(chosen)
            pull = np.repeat(back, counts, axis=0) * weights[:, None]
            unique, inverse = np.unique(buckets, return_inverse=True)
            change = np.stack(
                [np.bincount(inverse, pull[:, k], len(unique)) for k in range(dim)], axis=1
            )
            vectors[unique] -= (step * change).astype(np.float32)
    return vectors, output, bias


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_column: str = "doc_id",
    text: str = "text",
    max_docs: int = 2000,
) -> QualityModel:
    """Learn ``label`` (0 or 1) of ``labels`` from the texts of ``docs``.

    About ``max_docs`` labelled ids, chosen by a hash, are read whole; a hundred
    thousand labels more change nothing in what is collected. Rows with a null
    id, label or text teach nothing, of labels that repeat an id the smallest
    counts, and without both labels every score is the same.
    """
    chosen = (
        share(labels.where(f"{label} IN (0, 1) AND {id_column} IS NOT NULL"), id_column, max_docs)
        .groupBy(F.col(id_column).alias("id"))
        .agg(F.min(label).cast("int").alias("label"))
    )
    # About max_docs ids and labels, however large the tables: a few kB to broadcast.
    known = F.broadcast(docs.sparkSession.createDataFrame(chosen.collect(), chosen.schema))
    rows = (
        docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
        .where("text IS NOT NULL")
        .join(known, "id")
        .groupBy("id", "label")
        .agg(F.min("text").alias("text"))
        .select("text", "label")
        .mapInArrow(_features, "buckets array<int>, weights array<int>, label int")
    )
    found = rows.toArrow()
    lists = [
        [x.values.to_numpy() for x in found.column(c).combine_chunks()]
        if found.num_rows
        else []
        for c in ("buckets", "weights")
    ]
    order = sorted(range(found.num_rows), key=lambda i: (lists[0][i].tobytes(), lists[1][i].tobytes()))
    truth = np.array(found.column("label").to_pylist(), np.int64)
    return train([(lists[0][i], lists[1][i]) for i in order], truth[order])


class _Scorer:
    def __init__(self, model: QualityModel):
        self.model = model
        self.gains = model.gains.astype(np.float64)
        self.rows = Rows((2,), np.float64)
        self.memory = Memory(self.learn, self.rows.keep)

    def learn(self, words: list[bytes]) -> None:
        for at in range(0, len(words), PER_STEP):
            buckets, counts = all_buckets(words[at : at + PER_STEP])
            sums = segment_sums(self.gains[buckets], counts)
            self.rows.extend(np.stack([sums, counts], axis=1))

    def scores(self, column: pa.Array) -> np.ndarray:
        lists = [t.split() for t in octets(column)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        numbers = self.memory.numbers([w for x in lists for w in x])
        sums = segment_sums(self.rows.view()[numbers], counts)
        for bucket, times in zip((FOLLOWS, SEEN), repetition(numbers, counts)):
            sums[:, 0] += self.gains[bucket] * times
            sums[:, 1] += times
        means = sums[:, 0] / np.maximum(1, sums[:, 1])
        return (1 / (1 + np.exp(-(means + self.model.bias)))).round(6)

    def __call__(self, column: pa.Array) -> list[pa.Array]:
        scores = self.scores(column)
        return [pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32), pa.int32())]


def _scorer(shared) -> _Scorer:
    return resident(("quality", shared.value.key), lambda: _Scorer(shared.value))


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from 0.5 on).

    The whole text counts; a null or empty one has the score of the bias alone.
    Columns named like the result are replaced, others pass; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return append(docs, FIELDS, lambda: _scorer(shared), text, SLICE)


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Documents that the classifier predicts label 1 for."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = _scorer(shared)
        return lambda column: scorer.scores(column) >= 0.5

    return keep_where(docs, make, text, SLICE)
