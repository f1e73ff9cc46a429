"""Benchmark decontamination with suffix arrays over the training texts.

Each slice of documents is a shard: its words become numbers, and the word
suffixes that could begin a window of the benchmark are sorted into a suffix
array. A suffix is left out only if a word of its first window, or its first
pair of words, does not occur in the benchmark, so nothing that could match is
lost. Every distinct test suffix is found in every shard by binary search; the
range it covers gives all places of the window. Consecutive matches along one
item are joined into the longest verbatim matches.

The benchmark is read in blocks of bounded text, each of which meets all
documents; results of the blocks are merged per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import append, keep_where, octets, resident
from tierflow.staging import stage

WINDOW = 10
BLOCK_BYTES = 8 << 20
PAIR_BITS = 24
# Words hold digits, a-z after lower-casing, and everything beyond ASCII.
WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
MATCH = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("item_start", T.LongType()),
    ]
)
FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.LongType())),
        T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("longest", MATCH),
    ]
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed += second.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed >> np.uint64(64 - PAIR_BITS)


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort in the same order."""
    width = rows.shape[1]
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * width}").ravel()


@dataclass
class Level:
    """All distinct windows of one length, sorted, and where each occurs."""

    width: int
    windows: np.ndarray
    first: np.ndarray
    place_row: np.ndarray
    place_at: np.ndarray


class TestSuffixes:
    """A block of the benchmark: its words, its windows and the items they are in."""

    __test__ = False

    def __init__(self, items: list[tuple[int | None, bytes]], window: int = WINDOW):
        rows = [(item, words_of(text)) for item, text in items]
        rows = [r for r in rows if r[1]]
        vocabulary = sorted({w for _, words in rows for w in words})
        self.number = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.items = [item for item, _ in rows]
        self.pairs = np.zeros(1 << PAIR_BITS if rows else 0, bool)
        found: dict[int, list[tuple[list[int], int, int]]] = {}
        for row, (_, words) in enumerate(rows):
            ids = [self.number[w] for w in words]
            width = min(window, len(ids))
            level = found.setdefault(width, [])
            level.extend((ids[i : i + width], row, i) for i in range(len(ids) - width + 1))
        self.levels = []
        for width, places in sorted(found.items()):
            windows = np.array([p[0] for p in places], np.uint32).reshape(-1, width)
            keys, inverse = np.unique(_keys(windows), return_inverse=True)
            order = np.argsort(inverse, kind="stable")
            counts = np.bincount(inverse, minlength=len(keys))
            self.levels.append(
                Level(
                    width,
                    keys,
                    np.concatenate([[0], np.cumsum(counts)]),
                    np.array([p[1] for p in places])[order],
                    np.array([p[2] for p in places])[order],
                )
            )
            if width > 1:
                self.pairs[_pair(windows[:, 0], windows[:, 1])] = True
            else:
                # A window of one word begins no pair; any pair may follow it.
                self.pairs[:] = True

    def search(self, texts: list[bytes]) -> list[tuple]:
        """Per text: words, hit words, items, spans of hit words, longest match."""
        number = self.number
        lists = [words_of(t) for t in texts]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        if not self.levels:
            return [(n, 0, [], [], None) for n in counts.tolist()]
        # Texts stand one after another with an unknown word between them.
        ids = np.zeros(int(counts.sum()) + len(lists) + WINDOW, np.uint32)
        at, starts = 0, []
        for words in lists:
            starts.append(at)
            ids[at : at + len(words)] = [number.get(w, 0) for w in words]
            at += len(words) + 1
        starts = np.array(starts, np.int64)
        breaks = np.flatnonzero(ids == 0)
        known = np.flatnonzero(ids[:-1])
        run = breaks[np.searchsorted(breaks, known)] - known
        least, most = self.levels[0].width, self.levels[-1].width
        enough = run >= least
        suffixes, run = known[enough], run[enough]
        if least > 1:
            begins = self.pairs[_pair(ids[suffixes], ids[suffixes + 1])]
            suffixes, run = suffixes[begins], run[begins]
        rows = ids[suffixes[:, None] + np.arange(most)] if len(suffixes) else np.zeros((0, most), np.uint32)
        rows[np.arange(most) >= run[:, None]] = 0
        array = np.argsort(_keys(rows), kind="stable")
        rows, suffixes = rows[array], suffixes[array]
        marks = np.zeros(len(ids) + 1, np.int64)
        matches = []
        for level in self.levels:
            keys = _keys(rows[:, : level.width])
            low = np.searchsorted(keys, level.windows, "left")
            high = np.searchsorted(keys, level.windows, "right")
            hits = high - low
            window = np.repeat(np.arange(len(hits)), hits)
            inside = np.arange(len(window)) - np.repeat(np.cumsum(hits) - hits, hits)
            place = suffixes[np.repeat(low, hits) + inside]
            np.add.at(marks, place, 1)
            np.add.at(marks, place + level.width, -1)
            matches.append((place, window, level))
        covered = np.cumsum(marks)[:-1] > 0
        edge = np.diff(covered.astype(np.int8), prepend=0, append=0)
        span_from, span_to = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        results: list[list] = [[n, 0, set(), [], None] for n in counts.tolist()]
        for a, b in zip(span_from.tolist(), span_to.tolist()):
            doc = int(np.searchsorted(starts, a, "right")) - 1
            result, base = results[doc], int(starts[doc])
            result[1] += b - a
            result[3].append([a - base, b - a])
        for place, window, level in matches:
            self._place(results, starts, place, window, level)
        return [
            (n, hit, sorted(items), spans, longest)
            for n, hit, items, spans, longest in results
        ]

    def _place(self, results, starts, place, window, level: Level) -> None:
        """Items of each text, and the longest run of windows along one item."""
        if not len(place):
            return
        times = level.first[window + 1] - level.first[window]
        first = np.repeat(level.first[window], times)
        inside = np.arange(len(first)) - np.repeat(np.cumsum(times) - times, times)
        row, item_at = level.place_row[first + inside], level.place_at[first + inside]
        at = np.repeat(place, times)
        doc = np.searchsorted(starts, at, "right") - 1
        for d, r in np.unique(np.stack([doc, row]), axis=1).T.tolist():
            if self.items[r] is not None:
                results[d][2].add(self.items[r])
        order = np.lexsort((at, at - item_at, row, doc))
        at, item_at, row, doc = at[order], item_at[order], row[order], doc[order]
        follows = (
            (np.diff(at) == 1) & (np.diff(item_at) == 1) & (np.diff(row) == 0) & (np.diff(doc) == 0)
        )
        begin = np.concatenate([[0], np.flatnonzero(~follows) + 1])
        length = np.diff(np.concatenate([begin, [len(at)]])) + level.width - 1
        for b, n in zip(begin.tolist(), length.tolist()):
            result = results[doc[b]]
            found = {
                "start": int(at[b] - starts[doc[b]]),
                "length": n,
                "item_id": self.items[row[b]],
                "item_start": int(item_at[b]),
            }
            if result[4] is None or _rank(found) < _rank(result[4]):
                result[4] = found


def _rank(match: dict) -> tuple:
    item = match["item_id"]
    return -match["length"], match["start"], item is None, item or 0, match["item_start"]


def _suffixes(shared) -> TestSuffixes:
    name, rows = shared.value
    return resident(("benchmark", name), lambda: TestSuffixes(rows))


def _search_block(docs: DataFrame, shared, text: str) -> DataFrame:
    def make():
        suffixes = _suffixes(shared)

        def step(column: pa.Array) -> list[pa.Array]:
            found = suffixes.search(octets(column))
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))]
            match = pa.struct([(f.name, pa.int64()) for f in MATCH])
            return [pa.array([f[k] for f in found], t) for k, t in enumerate([*types, match])]

        return step

    return append(docs, FIELDS, make, text)


class Benchmark:
    """The items in ``blocks`` blocks of about ``limit`` bytes; an item stays in one.

    Several blocks are stored as a table, and the driver holds one of them at a time.
    """

    def __init__(self, items: DataFrame, limit: int = BLOCK_BYTES, item: str = "item_id", text: str = "text"):
        rows = items.select(F.col(item).cast("long").alias("item_id"), F.col(text).alias("text"))
        rows = rows.where("text IS NOT NULL")
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.blocks = max(1, -(-size // limit))
        part = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.blocks))
        dealt = rows.distinct().withColumn("part", part)
        self.rows = dealt if self.blocks == 1 else stage(dealt, "benchmark")[0]

    def block(self, k: int):
        """A block, broadcast under a name that its items give it."""
        rows = self.rows.where(F.col("part") == k).select("item_id", "text").collect()
        items = [(r.item_id, r.text.encode()) for r in rows]
        items.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        name = hashlib.sha256(repr(items).encode()).hexdigest()
        return self.rows.sparkSession.sparkContext.broadcast((name, items))


def _merged(lists: list[list[list[int]]]) -> list[list[int]]:
    spans: list[list[int]] = []
    for start, length in sorted(s for x in lists for s in x or []):
        if spans and start <= sum(spans[-1]):
            spans[-1][1] = max(sum(spans[-1]), start + length) - spans[-1][0]
        else:
            spans.append([start, length])
    return spans


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [_merged(x) for x in batch.column("spans").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in ("row", "doc_id", "n_words")],
                pa.array([sum(s[1] for s in x) for x in spans], pa.int64()),
                batch.column("items"),
                pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                batch.column("longest"),
            ],
            names=["row", "doc_id", *FIELDS.names],
        )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_hit``, ``items``, ``hit_spans``, ``longest``.

    A window is ten consecutive words of an item, or a whole shorter item. Hit
    words lie in an occurrence of a window; ``hit_spans`` are their (start word,
    length) pairs, ``items`` the ids of items with an occurring window, and
    ``longest`` the longest verbatim match with its places (of equal ones the
    first). Null and empty texts have no words; an item without words has no
    window; an item id that is null marks hits but is not listed. Repeated rows
    each keep their row, other columns are not read, and an empty benchmark or
    table gives no hits or no rows. With one block nothing is shuffled.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    held = Benchmark(benchmark, block_bytes)
    if held.blocks == 1:
        return _search_block(rows, held.block(0), "text").drop("text")
    # Rows get a number of their own, since ids may be null or repeat.
    rows, _ = stage(rows.withColumn("row", F.expr("uuid()")), "decontaminate")
    parts = []
    for k in range(held.blocks):
        shared = held.block(k)
        found = _search_block(rows, shared, "text").drop("text")
        # The first block gives every document its words, the others their hits.
        parts.append(stage(found.where("n_hit > 0") if k else found, "hits")[0])
        shared.destroy()
    every = reduce(DataFrame.unionByName, parts)
    longest = F.struct(
        (-F.col("longest.length")).alias("rank"),
        F.col("longest.start").alias("at"),
        F.col("longest.item_id").alias("item"),
        "longest",
    )
    merged = every.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.collect_list("hit_spans").alias("spans"),
        F.min(F.when(F.col("longest").isNotNull(), longest))["longest"].alias("longest"),
    )
    schema = T.StructType(
        [T.StructField("row", T.StringType()), rows.schema["doc_id"], *FIELDS.fields]
    )
    return merged.mapInArrow(_merge, schema).drop("row")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Documents without a hit word, with all their columns.

    With one block nothing is shuffled. With several the documents are stored with a
    number each, and the numbers of those that any block hits are taken out.
    """
    held = Benchmark(benchmark, block_bytes)

    def clean(shared):
        def make():
            suffixes = _suffixes(shared)
            return lambda column: np.array([f[1] == 0 for f in suffixes.search(octets(column))])

        return make

    if held.blocks == 1:
        return keep_where(docs, clean(held.block(0)), text)
    row = "__row"
    rows, _ = stage(docs.withColumn(row, F.expr("uuid()")), "decontaminate")
    hits = []
    for k in range(held.blocks):
        shared = held.block(k)
        found = _search_block(rows.select(row, F.col(text).alias("__text")), shared, "__text")
        hits.append(stage(found.where("n_hit > 0").select(row), "hits")[0])
        shared.destroy()
    return rows.join(reduce(DataFrame.union, hits).distinct(), row, "left_anti").drop(row)
