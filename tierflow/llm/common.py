"""What several of the operators share: Arrow batches, memory of pieces, graphs."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.staging import stage

SLICE_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds ``limit`` bytes, or one row, at most."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        first, before = 0, 0
        while first < batch.num_rows:
            end = int(np.searchsorted(ends, before + limit, "right"))
            end = max(end, first + 1)
            yield batch.slice(first, end - first)
            before, first = int(ends[end - 1]), end


def strings(column: pa.Array) -> list[str]:
    """Texts, null as empty."""
    return [x or "" for x in column.to_pylist()]


def octets(column: pa.Array) -> list[bytes]:
    """UTF-8 of the texts, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


Step = Callable[[pa.Array], list[pa.Array]]


def append(
    df: DataFrame,
    fields: T.StructType,
    make: Callable[[], Step],
    column: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Add ``fields``, computed from ``column``; they replace columns of their names.

    ``make`` runs once per task and gives the function from a slice of the
    column to the arrays of the new fields. Rows stay where they are. What a task no
    longer needs goes back to the system at its end, as its worker stays.
    """
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema if f.name.lower() not in new]
    source = next(f.name for f in kept if f.name.lower() == column.lower())
    schema = T.StructType(kept + list(fields))
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in slices(batches, source, limit):
            arrays = [batch.column(f.name) for f in kept] + step(batch.column(source))
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        batch = arrays = None
        give_back()

    return df.mapInArrow(run, schema)


def keep_where(
    docs: DataFrame,
    make: Callable[[], Callable[[pa.Array], np.ndarray]],
    text: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Rows for whose ``text`` the function that ``make`` gives says true, as they are.

    Rows that go do not leave the worker, and no column is added on the way.
    """
    source = next(c for c in docs.columns if c.lower() == text.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in slices(batches, source, limit):
            stay = step(batch.column(source))
            if stay.any():
                yield batch.filter(pa.array(stay))
        batch = None
        give_back()

    return docs.mapInArrow(run, docs.schema)


def segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; a run may be empty."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=values.dtype)
    np.cumsum(values, axis=0, out=total[1:])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


@contextmanager
def collector_paused() -> Iterator[None]:
    """Many small objects without cycles are made inside: nothing to look for."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


class Memory:
    """Numbers the pieces of texts; what is known of a piece is worked out once.

    ``learn`` is called with the new pieces, in the order of their numbers. Before
    the memory outgrows ``limit`` it forgets at least half of its pieces, those that
    were met least; ``keep`` is called with the old numbers of those that stay, in
    the order of their new ones.
    """

    def __init__(self, learn, keep, limit: int = 150_000):
        self.learn, self.keep, self.limit = learn, keep, limit
        self.index: dict = {}
        self.met = np.zeros(0, np.int64)

    @property
    def is_full(self) -> bool:
        """Whether the next call changes the numbers."""
        return len(self.index) > self.limit

    def forget(self) -> None:
        met = self.met[: len(self.index)]
        least = max(2, int(np.partition(met, len(met) // 2)[len(met) // 2]) + 1)
        stay = np.flatnonzero(met >= least)
        pieces = list(self.index)
        self.index = {pieces[i]: n for n, i in enumerate(stay.tolist())}
        # What was met long ago counts less and less.
        self.met = met[stay] // 2
        self.keep(stay)

    def numbers(self, pieces: list) -> np.ndarray:
        if self.is_full:
            self.forget()
        known = map(self.index.get, pieces, repeat(-1))
        found = np.fromiter(known, np.int32, len(pieces))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            unknown = [pieces[i] for i in missing.tolist()]
            new = list(dict.fromkeys(unknown))
            first = len(self.index)
            self.index.update(zip(new, range(first, first + len(new))))
            with collector_paused():
                self.learn(new)
            found[missing] = [self.index[p] for p in unknown]
        met = np.bincount(found, minlength=len(self.index))
        met[: len(self.met)] += self.met
        self.met = met
        return found


def give_back() -> None:
    """Memory that is free in this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# One thing per worker process: what the operator that ran last keeps between tasks.
_resident: dict = {}


def resident(key, make):
    """What ``make`` gives, kept in this process until an operator asks for another key.

    Workers go from one operator's tasks to the next one's; what the last one has
    remembered goes back to the system then, and does not add up.
    """
    if key not in _resident:
        if _resident:
            _resident.clear()
            gc.collect()
            give_back()
        _resident[key] = make()
    return _resident[key]


class Rows:
    """A growing array of equal rows."""

    def __init__(self, width: tuple[int, ...], dtype):
        self.width, self.dtype = width, dtype
        self.clear()

    def clear(self) -> None:
        self.data, self.size = np.empty((1024, *self.width), self.dtype), 0

    def extend(self, rows) -> None:
        rows = np.asarray(rows, dtype=self.dtype).reshape(-1, *self.width)
        need = self.size + len(rows)
        if need > len(self.data):
            grown = np.empty((max(need, 2 * len(self.data)), *self.width), self.dtype)
            grown[: self.size] = self.data[: self.size]
            self.data = grown
        self.data[self.size : need] = rows
        self.size = need

    def view(self) -> np.ndarray:
        return self.data[: self.size]

    def keep(self, numbers: np.ndarray) -> None:
        """Only these rows, in this order."""
        self.data = self.view()[numbers]
        self.size = len(numbers)


class Sequences:
    """A growing list of integer sequences of different lengths."""

    def __init__(self, dtype=np.int32):
        self.values, self.ends = Rows((), dtype), Rows((), np.int64)

    def clear(self) -> None:
        self.values.clear()
        self.ends.clear()

    def extend(self, sequences: list) -> None:
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        self.extend_flat([x for s in sequences for x in s], lengths)

    def extend_flat(self, values, lengths: np.ndarray) -> None:
        self.ends.extend(np.cumsum(lengths) + self.values.size)
        self.values.extend(values)

    def keep(self, numbers: np.ndarray) -> None:
        """Only these sequences, in this order."""
        values, lengths = self.gather(numbers)
        self.clear()
        self.extend_flat(values, lengths)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequences of these numbers one after another, and their lengths."""
        ends = self.ends.view()
        starts = np.concatenate([[0], ends[:-1]])[numbers]
        lengths = ends[numbers] - starts
        stops = np.cumsum(lengths)
        shift = np.repeat(starts - (stops - lengths), lengths)
        return self.values.view()[np.arange(len(shift)) + shift], lengths


def share(df: DataFrame, key: str, wanted: int) -> DataFrame:
    """About ``wanted`` rows of ``df``, chosen by a hash of ``key``: for fitting only.

    The share follows from the count, so what is drawn does not grow with the
    table, and the same rows are drawn each time.
    """
    total = df.count()
    if total <= wanted:
        return df
    scale = 1_000_000_000
    return df.where(
        F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(scale)) < int(wanted / total * scale)
    )


def share_of_each(df: DataFrame, key: str, group: str, wanted: int | None) -> tuple[DataFrame, dict]:
    """As ``share``, about ``wanted`` rows of each ``group``; and the rows that each has in all.

    Without ``wanted`` it is all rows. Groups are few: their sizes pass through the driver.
    """
    sizes = {r[0]: r[1] for r in df.groupBy(group).count().collect()}
    scale = 1_000_000_000
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(scale))
    large = {g: int(wanted / n * scale) for g, n in sizes.items() if wanted and n > wanted}
    if not large:
        return df, sizes
    limits = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])
    return df.where(drawn < F.coalesce(limits[F.col(group)], F.lit(scale))), sizes


def crc_of_id(column: str = "doc_id"):
    """crc32 of the id written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of a graph of longs: ``node``, ``root``.

    Each round every node points to the neighbour, or itself, that comes first in
    an order drawn anew for the round; edges are carried over to those nodes and
    lose their loops and copies, which shrinks any graph by a constant factor on
    average. Rounds are stored in the shared folder. Minima combine before the
    shuffle, and a hub's edges meet its one pointer in a join that adaptive
    execution may split, so a hub needs no task of its own.
    """
    edges, _ = stage(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    nodes = edges.select("u").union(edges.select("v")).distinct()
    labels = nodes.select(F.col("u").alias("node"), F.col("u").alias("root"))
    turn = 0
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v"), F.col("u")))

        def order(c, turn=turn):
            return F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("id"))

        best = both.groupBy("u").agg(F.min(order("v")).alias("best"))
        pointers, _ = stage(
            best.select("u", F.least(F.col("best"), order("u"))["id"].alias("p")), "pointers"
        )
        labels, _ = stage(
            labels.join(pointers, labels.root == pointers.u, "left").select(
                "node", F.coalesce("p", "root").alias("root")
            ),
            "labels",
        )
        first = pointers.select(F.col("u"), F.col("p").alias("pu"))
        second = pointers.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        edges, _ = stage(
            edges.join(first, "u")
            .join(second, "v")
            .where("pu <> pv")
            .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
            .distinct(),
            "edges",
        )
        turn += 1
    return labels
