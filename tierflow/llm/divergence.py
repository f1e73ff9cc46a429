"""How far the sources of a language differ in their words, and by which words.

Terms travel as fixed-width digests. Each worker counts the terms of a few
million words at a time, by language and source, and hands on one row per term
with its digest, and once per worker the text behind a digest. The least and the
greatest text of each digest show whether several terms share it; only terms of
such digests are counted again with their text, which splits them. Text is
joined back only for the terms that are given out.

All numbers are whole. The value of a pair of sources is a sum over all kept
terms, but terms without an occurrence in either contribute alike, and terms in
one of the two contribute by their count there alone. So, with ``f00``, ``fa0``,
``f0b`` and ``fab`` for a term's value where the counts of none, the first, the
second or both are put in,

    value = V * f00 + sum over a's terms of (fa0 - f00)
                    + sum over b's terms of (f0b - f00)
                    + sum over common terms of (fab - fa0 - f0b + f00)

The first two sums come from a histogram of counts per source. Only the last
needs terms that sources share; those of one term lie side by side, and tasks add
them up per pair of sources before anything is written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import Memory, Rows, collector_paused, octets, slices
from tierflow.staging import stage

# Bytes of terms in lower case; all others separate them.
LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)
SCALE = 1_000_000_000
HELD_ROWS = 1 << 20
DIGEST_BITS = 64

# A count has no text, unless its digest is split; a text has no language.
COUNTED = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("digest", T.LongType()),
        T.StructField("term", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("docs", T.LongType()),
    ]
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


class _Counts:
    """Occurrences and documents per group and term, in bounded memory."""

    def __init__(self, bits: int, with_text: bool):
        self.shift, self.with_text = 64 - bits, with_text
        self.digests = Rows((), np.int64)
        self.fresh: list[tuple[list[bytes], np.ndarray]] = []
        self.terms = Memory(self.learn, self.keep, 300_000)
        self.names: list[bytes] = []
        self.groups: dict[tuple[str, str], int] = {}
        self.held: list[np.ndarray] = []
        self.size = 0

    def learn(self, terms: list[bytes]) -> None:
        shift = self.shift
        hashes = [xxhash.xxh64_intdigest(t) >> shift for t in terms]
        digests = np.array(hashes, np.uint64).view(np.int64)
        self.digests.extend(digests)
        if self.with_text:
            self.names += terms
        else:
            self.fresh.append((terms, digests))

    def keep(self, numbers: np.ndarray) -> None:
        self.digests.keep(numbers)
        if self.with_text:
            self.names = [self.names[i] for i in numbers.tolist()]

    def add(self, texts: list[bytes], langs: list[str], sources: list[str]) -> None:
        """The terms of some documents, each counted once per document and in all."""
        lists = [terms_of(t) for t in texts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        numbers = self.terms.numbers([w for x in lists for w in x]).astype(np.int64)
        place = np.repeat(np.arange(len(lists)), sizes)
        keys, n = np.unique(place << 32 | numbers, return_counts=True)
        groups = np.array(
            [self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources)], np.int64
        )
        self.hold(groups[keys >> 32] << 32 | keys & 0xFFFFFFFF, n, np.ones_like(n))

    def hold(self, keys: np.ndarray, n: np.ndarray, docs: np.ndarray) -> None:
        self.held.append(np.stack([keys, n, docs]))
        self.size += len(keys)

    def combined(self) -> np.ndarray:
        rows = np.concatenate(self.held, axis=1) if self.held else np.empty((3, 0), np.int64)
        order = np.argsort(rows[0], kind="stable")
        rows = rows[:, order]
        first = np.flatnonzero(np.diff(rows[0], prepend=-1))
        if len(first):
            rows = np.stack([rows[0][first], *(np.add.reduceat(r, first) for r in rows[1:])])
        self.held, self.size = [rows], rows.shape[1]
        return rows

    def flush(self) -> Iterator[pa.RecordBatch]:
        """All that is held, as rows of ``COUNTED``."""
        rows = self.combined()
        groups = list(self.groups)
        langs, sources = pa.array([g[0] for g in groups], pa.string()), pa.array([g[1] for g in groups], pa.string())
        number, group = rows[0] & 0xFFFFFFFF, pa.array(rows[0] >> 32)
        names = pa.array(self.names, pa.binary()).cast(pa.string()) if self.with_text else None
        yield pa.RecordBatch.from_arrays(
            [
                langs.take(group),
                sources.take(group),
                pa.array(self.digests.view()[number]),
                names.take(pa.array(number)) if names is not None else pa.nulls(len(number), pa.string()),
                pa.array(rows[1]),
                pa.array(rows[2]),
            ],
            names=COUNTED.names,
        )
        self.held, self.size, self.groups = [], 0, {}
        for terms, digests in self.fresh:
            size = len(terms)
            texts = pa.array(terms, pa.binary()).cast(pa.string())
            blank = [pa.nulls(size, pa.string())] * 2
            none = [pa.nulls(size, pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(
                [*blank, pa.array(digests), texts, *none], names=COUNTED.names
            )
        self.fresh = []


def count_terms(docs: DataFrame, bits: int = DIGEST_BITS, with_text: bool = False) -> DataFrame:
    """Terms of whole texts, counted per worker: rows of ``COUNTED``.

    A term may come in several rows. Without ``with_text`` each worker adds rows
    that give the text of each digest it has used.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(bits, with_text)
        for batch in slices(batches, "text"):
            # Numbers of terms hold until the memory forgets some.
            if counts.terms.is_full:
                yield from counts.flush()
            with collector_paused():
                langs, sources = (batch.column(c).to_pylist() for c in ("lang", "source"))
                counts.add(octets(batch.column("text")), langs, sources)
            if counts.size > HELD_ROWS and len(counts.combined()[0]) > HELD_ROWS // 2:
                yield from counts.flush()
        yield from counts.flush()

    return docs.select("text", "lang", "source").mapInArrow(run, COUNTED)


def proportion(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)), in whole numbers of any size."""
    below = F.greatest(total + kept, F.lit(1))
    wide = T.DecimalType(38, 0)
    large = F.lit(SCALE).cast(wide) * (n + 1).cast(T.DecimalType(20, 0))
    small = n < F.lit(2**63 // SCALE - 1)
    quotient = F.when(small, F.call_function("div", F.lit(SCALE) * (n + 1), below))
    return F.lit(1) + quotient.otherwise(F.call_function("div", large, below.cast(T.DecimalType(20, 0))))


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); the square of a number up to a billion fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class _Pairs:
    """Sums per pair of groups, added up within a task."""

    def __init__(self, limit: int = 1 << 20):
        self.keys, self.values, self.size, self.limit = [], [], 0, limit

    def add(self, keys: np.ndarray, values: np.ndarray) -> bool:
        """Whether there are more pairs than should be kept."""
        self.keys.append(keys)
        self.values.append(values)
        self.size += len(keys)
        return self.size > 4 * self.limit and len(self.combine()[0]) > self.limit

    def combine(self) -> tuple[np.ndarray, np.ndarray]:
        if self.keys:
            keys, back = np.unique(np.concatenate(self.keys), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, back, np.concatenate(self.values))
        else:
            keys = sums = np.empty(0, np.int64)
        self.keys, self.values, self.size = [keys], [sums], len(keys)
        return keys, sums

    def take(self) -> pa.RecordBatch:
        keys, sums = self.combine()
        self.keys, self.values, self.size = [], [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(sums)],
            names=["a", "b", "s"],
        )


# Cells of one block of pairs: of many terms with few sources, or of some rows of one term's.
CELLS = 1 << 18


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of groups the sum of fab - fa0 - f0b + f00 over their common terms.

    A row is a term; its list names the groups that have it, their ``p``, and the
    ``p0`` that they would have without it.
    """
    pairs = _Pairs()
    for batch in batches:
        lists = batch.column("sources")
        offsets = lists.offsets.to_numpy()
        sizes, starts = np.diff(offsets), offsets[:-1] - offsets[0]
        flat = lists.flatten()
        group, having, lacking = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("g", "p", "p0"))
        for width in np.unique(sizes[sizes > 1]).tolist():
            first = starts[sizes == width]
            at_once, rows = max(1, CELLS // width**2), max(1, min(width, CELLS // width))
            for at in range(0, len(first), at_once):
                cells = first[at : at + at_once, None] + np.arange(width)
                g, p, p0 = group[cells], having[cells], lacking[cells]
                for row in range(0, width, rows):
                    of = np.s_[:, row : row + rows, None]
                    value = _distances(p[of], p[:, None]) - _distances(p[of], p0[:, None])
                    value += _distances(p0[of], p0[:, None]) - _distances(p0[of], p[:, None])
                    if pairs.add((g[of] << 32 | g[:, None]).ravel(), value.ravel()):
                        yield pairs.take()
    yield pairs.take()


class Audit:
    """The counts of a table of documents, stored, and what they say.

    Takes ``text``, ``lang`` and ``source``, null as empty; other columns are not
    read. Every (lang, source) that occurs is a group, even without terms; a
    language keeps the terms of ``min_docs`` of its documents. Repeated rows are
    documents of their own. No rows give no rows.
    """

    def __init__(self, docs: DataFrame, min_docs: int = 3, digest_bits: int = DIGEST_BITS):
        docs = docs.select(
            *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
        )
        # All groups, numbered so that those of a language follow one another: one row each.
        by_name = F.row_number().over(Window.orderBy("lang", "source")).cast("long") - 1
        groups = docs.select("lang", "source").distinct().withColumn("g", by_name)
        self.groups, _ = stage(groups, "groups")

        counted, _ = stage(count_terms(docs, digest_bits), "terms")
        texts = counted.where("lang IS NULL").groupBy("digest")
        self.texts, _ = stage(
            texts.agg(F.min("term").alias("least"), F.max("term").alias("most")), "digests"
        )
        rows = counted.where("lang IS NOT NULL")
        split = self.texts.where("least <> most").select("digest")
        if not split.isEmpty():
            again = count_terms(docs, digest_bits, with_text=True).join(split, "digest", "left_semi")
            rows = rows.join(split, "digest", "left_anti").unionByName(again)
        self.terms = self._kept(rows, min_docs)
        self.langs = self._langs()

    def _kept(self, rows: DataFrame, min_docs: int) -> DataFrame:
        """One row per language and kept term, with the counts of the groups that have it.

        Workers have combined their rows, so these are dealt once, by language and term.
        """
        term = ["lang", "digest", "term"]
        numbered = rows.join(self.groups, ["lang", "source"]).select(*term, "g", "n", "docs")
        by_group = numbered.repartition(*term).groupBy(*term, "g")
        by_term = by_group.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).groupBy(*term)
        kept = by_term.agg(
            F.sum("n").alias("n"),
            F.sum("docs").alias("docs"),
            F.collect_list(F.struct("g", "n")).alias("sources"),
        )
        return stage(kept.where(F.col("docs") >= min_docs).drop("docs"), "kept")[0]

    def _langs(self) -> DataFrame:
        """Per language its sum, its number of terms, and its groups' sums and ``p0`` in order."""
        each = self.terms.select("lang", F.explode("sources").alias("s"))
        sums = each.groupBy(F.col("s.g").alias("g")).agg(F.sum("s.n").alias("total"))
        langs = self.terms.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("kept"))
        totals = (
            self.groups.join(sums, "g", "left")
            .groupBy("lang")
            .agg(F.min("g").alias("base"), F.sort_array(F.collect_list(F.struct("g", F.coalesce("total", F.lit(0)).alias("total")))).alias("totals"))
        )
        known = totals.join(langs, "lang", "left").na.fill(0, ["lang_total", "kept"])
        sums_of = F.col("totals.total")
        p0 = F.transform(sums_of, lambda t: proportion(F.lit(0).cast("long"), t, F.col("kept")))
        return stage(known.select("lang", "base", "lang_total", "kept", sums_of.alias("totals"), p0.alias("p0")), "langs")[0]

    def _share(self, g: Column, n: Column) -> Column:
        """The p of ``n`` occurrences in group ``g``, beside the row of its language."""
        return proportion(n, F.get("totals", (g - F.col("base")).cast("int")), F.col("kept"))

    def leading_terms(self, top: int) -> DataFrame:
        """The ``top`` terms that each group has more of than its language: ``lang``,
        ``source``, ``item``, ``value``, ``rank``.

        The value of the last place comes from values alone; then the terms from
        that value on get their text, which orders equal values.
        """
        each = self.terms.select("lang", "digest", "term", "n", F.explode("sources").alias("s"))
        known = each.join(self.langs.drop("p0"), "lang")
        p, q = self._share(F.col("s.g"), F.col("s.n")), proportion(F.col("n"), F.col("lang_total"), F.col("kept"))
        above = known.select(F.col("s.g").alias("g"), "digest", "term", p.alias("p"), q.alias("q")).where("p > q")
        above = above.select("g", "digest", "term", distance(F.col("p"), F.col("q")).alias("value"))
        place = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("value")))
        first = above.select("g", "value", place.alias("place")).where(F.col("place") <= top)
        # One row per group; stored, so that its size decides how terms are held against it.
        last, _ = stage(first.groupBy("g").agg(F.min("value").alias("last")), "last")
        named = above.join(last, "g").where("value >= last").join(self.texts.select("digest", "least"), "digest")
        items = named.select("g", F.coalesce("term", "least").alias("item"), "value")
        rank = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("value"), "item"))
        return (
            items.withColumn("rank", rank)
            .where(F.col("rank") <= top)
            .join(self.groups, "g")
            .select("lang", "source", "item", "value", "rank")
        )

    def source_pairs(self) -> DataFrame:
        """Each group against each other source of its language: ``lang``, ``source``,
        ``item``, ``value``, ``rank``."""
        others = self.langs.select("base", "kept", "totals", "p0", F.posexplode("p0").alias("j", "p0_b"))
        b = F.col("base") + F.col("j")
        every = others.select("base", "kept", b.alias("b"), "p0_b", F.posexplode("p0").alias("i", "p0_a")).where("base + i <> b")
        base = every.select((F.col("base") + F.col("i")).alias("a"), "b", (F.col("kept") * distance(F.col("p0_a"), F.col("p0_b"))).alias("s"))

        # Histograms of counts: a group's terms with one count weigh alike against a group without them.
        each = self.terms.select("lang", F.explode("sources").alias("s"))
        bars = each.groupBy("lang", F.col("s.g").alias("a"), F.col("s.n").alias("n")).agg(F.count("*").alias("m"))
        known = bars.join(self.langs, "lang")
        mine = F.get("p0", (F.col("a") - F.col("base")).cast("int"))
        sized = known.select("a", "m", "base", self._share(F.col("a"), F.col("n")).alias("p"), mine.alias("p0_a"), F.posexplode("p0").alias("j", "p0_b"))
        sized = sized.select("a", (F.col("base") + F.col("j")).alias("b"), "m", "p", "p0_a", "p0_b").where("a <> b")
        p, mine, other, m = (F.col(c) for c in ("p", "p0_a", "p0_b", "m"))
        forth = F.struct(F.col("a").alias("a"), F.col("b").alias("b"), (m * (distance(p, other) - distance(mine, other))).alias("s"))
        back = F.struct(F.col("b").alias("a"), F.col("a").alias("b"), (m * (distance(other, p) - distance(other, mine))).alias("s"))
        single = sized.select(F.inline(F.array(forth, back)))

        listed = self.terms.join(self.langs, "lang").where(F.size("sources") > 1)
        shares = F.transform(
            "sources",
            lambda s: F.struct(
                s["g"].alias("g"),
                self._share(s["g"], s["n"]).alias("p"),
                F.get("p0", (s["g"] - F.col("base")).cast("int")).alias("p0"),
            ),
        )
        common = listed.select(shares.alias("sources")).mapInArrow(_shared_terms, "a long, b long, s long").where("a <> b")
        sums = base.unionAll(single).unionAll(common).groupBy("a", "b").agg(F.sum("s").alias("value"))
        first = self.groups.select(F.col("g").alias("a"), "lang", "source")
        second = self.groups.select(F.col("g").alias("b"), F.col("source").alias("item"))
        rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
        return (
            sums.join(first, "a").join(second, "b").withColumn("rank", rank)
            .select("lang", "source", "item", "value", "rank")
        )


def audit_sources(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """Pairs of sources and leading terms of each: ``lang``, ``source``, ``part``
    (``pair`` or ``term``), ``item``, ``value``, ``rank``; see ``Audit``."""
    audit = Audit(docs, min_docs)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = audit.source_pairs().withColumn("part", F.lit("pair")).select(*columns)
    return pairs.unionAll(audit.leading_terms(top).withColumn("part", F.lit("term")).select(*columns))
