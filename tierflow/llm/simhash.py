"""SimHash near-duplicates: tiles of fingerprints compared exactly with numpy.

A text's fingerprint has a bit where more than half of the hashes of its word
shingles have it. Two fingerprints that differ in at most ``RADIUS`` bits agree
wholly on two of six blocks of bits, so each distinct fingerprint is put into
the 15 groups named by two blocks and their bits. Every group is compared in
full: it is cut into tiles, fingerprints are ordered by their population
count, exclusive-or and bit counts run over pairs of tiles, and pairs whose
population counts differ beyond the radius are left out. Of the links in a
pair of tiles those of a spanning forest are given out, which keeps every
component and never lists all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import append, components, octets
from tierflow.staging import stage

SHINGLE = 4
SEED = 42
RADIUS = 4
BLOCKS = 6
TILE = 4096
STEP = 512
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
FIELDS = T.StructType([T.StructField("fp", T.LongType())])


def fingerprint(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint of UTF-8 text; zero without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = len(words) - width + 1
    if n <= 1:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[width - 1 :].tolist()
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = slice(at, min(n, at + (1 << 16)))
        hashes = np.array(
            [digest(joined[a:b], seed) for a, b in zip(starts[part], stops[part])], "<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(column: pa.Array) -> list[pa.Array]:
    found = np.array([fingerprint(t) for t in octets(column)], np.uint64)
    return [pa.array(found.view(np.int64), pa.int64())]


def with_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fp``, the signed 64-bit fingerprint of each whole text; null is empty."""
    return append(docs, FIELDS, lambda: _fingerprints, text)


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """Signed masks of the bits on which some pair within the radius must agree."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    spans = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(spans, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels[:] = further


def forest(left: np.ndarray, right: np.ndarray | None = None, radius: int = RADIUS):
    """Links that connect what lies within the radius in a tile, or between two."""

    def ordered(x):
        counts = np.bitwise_count(x)
        order = np.argsort(counts, kind="stable")
        return x[order], counts[order].astype(np.int64)

    x, cx = ordered(left)
    y, cy, shift = (x, cx, 0) if right is None else (*ordered(right), len(x))
    labels = np.arange(len(x) + (0 if right is None else len(y)))
    for i in range(0, len(x), STEP):
        rows, low, high = x[i : i + STEP, None], cx[i], cx[min(i + STEP, len(x)) - 1]
        for j in range(i if right is None else 0, len(y), STEP):
            if cy[j] - high > radius:
                break
            if low - cy[min(j + STEP, len(y)) - 1] > radius:
                continue
            a, b = np.nonzero(np.bitwise_count(rows ^ y[None, j : j + STEP]) <= radius)
            _unite(labels, a + i, b + j + shift)
    every = x if right is None else np.concatenate([x, y])
    moved = np.flatnonzero(labels != np.arange(len(labels)))
    return every[moved], every[labels[moved]]


def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for left, right in zip(batch.column("left"), batch.column("right")):
            a, b = (
                x.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                for x in (left, right)
            )
            found.append(forest(a, b if len(b) else None))
        child, parent = (
            np.concatenate([f[k] for f in found] or [np.empty(0, np.uint64)]).view(np.int64)
            for k in (0, 1)
        )
        yield pa.RecordBatch.from_arrays([pa.array(child), pa.array(parent)], names=["a", "b"])


def fingerprint_links(fingerprints: DataFrame, tile: int = TILE) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct ``fp`` within the radius.

    A group of more than ``tile`` fingerprints is dealt into tiles by a hash and
    each pair of tiles is a row of its own, so a row never holds more than two
    tiles, however many fingerprints share their blocks.
    """
    keyed = fingerprints.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("combo"), F.col("fp").bitwiseAND(F.lit(m)).alias("block"))
                    for c, m in enumerate(block_masks())
                ]
            )
        ).alias("key"),
    ).select("fp", "key.combo", "key.block")
    sizes = keyed.groupBy("combo", "block").agg(F.count("*").alias("n")).where("n > 1")
    dealt = (
        keyed.join(sizes, ["combo", "block"])
        .withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    )
    pairs = dealt.groupBy(
        "combo",
        "block",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
    ).agg(
        F.collect_list(F.when(F.col("own") <= F.col("other"), F.col("fp"))).alias("left"),
        F.collect_list(F.when(F.col("own") > F.col("other"), F.col("fp"))).alias("right"),
    )
    return pairs.select("left", "right").mapInArrow(_tile_links, "a long, b long").distinct()


def _classes(prints: DataFrame) -> DataFrame:
    """Of ``doc_id``, ``fp`` rows: each distinct ``fp`` with ``root`` and ``component_id``."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(fingerprint_links(distinct.select("fp")), "a", "b")
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    # Stored, so that the join below meets two plain exchanges: adaptive execution can
    # then split a component that holds very many fingerprints.
    named, _ = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    return stage(rooted.join(named, "root").select("fp", "root", "component_id"), "classes")[0]


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``fp``, and ``component_id``.

    ``component_id`` is the smallest id among all rows reachable over links; null
    ids are passed over, and a component with none but null ids has null. Null
    and empty texts share fingerprint zero. Other columns are not read, repeated
    rows each keep their row, and an empty table gives an empty result.
    Fingerprints are stored once in the shared folder.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    prints, _ = stage(with_fingerprints(rows).select("doc_id", "fp"), "fingerprints")
    return prints.join(_classes(prints), "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Keep one row of each component: the smallest id, null ids last.

    Of rows that repeat that id the one with the smallest fingerprint stays, and
    of exact copies one. All columns stay as they are; the rows are stored once
    with their fingerprints, so that these are worked out a single time.
    """
    whole = docs.select(
        F.col(id_column).alias("id"),
        F.col(text).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("rest"),
    )
    marked, _ = stage(with_fingerprints(whole), "fingerprinted")
    prints = marked.select(F.col("id").alias("doc_id"), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "fp"))
    keep = (
        prints.join(_classes(prints), "fp")
        .groupBy("root")
        .agg(first.alias("first"))
        .select(F.col("first.doc_id").alias("keep_id"), F.col("first.fp").alias("keep_fp"))
    )
    kept = marked.join(
        keep, (marked.fp == keep.keep_fp) & marked.id.eqNullSafe(keep.keep_id), "left_semi"
    )
    one = kept.groupBy("fp", "id").agg(F.first(F.struct("text", "rest")).alias("row"))
    return one.select(
        *[F.col("row.text").alias(text) if c == text else F.col(f"row.rest.`{c}`") for c in docs.columns]
    )
