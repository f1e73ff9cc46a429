"""Language identification: known words first, shorter and shorter n-grams after.

A model holds, for each language, log frequencies of words and of character
n-grams. A word of a text that the model knows is scored by its frequency in
each language. An unknown word is scored at each of its positions by the
longest known n-gram that starts there. Evidence adds up over the whole text;
the score is the share of the chosen language in the posterior.

A token is kept with the languages that have it, and by how much the log of its
frequency there exceeds that of a token which a language lacks; what all
languages share takes no part in the posterior. So a model is as large as its
tokens, however many languages it knows.

The posterior only weighs languages against each other. Whether a text is in any
of them is told by its evidence: the mean over its words of how much of a word is
covered by what the chosen language knows, 1 for a known word, else from 0 where
single letters are all that is found at its places to 1 where the longest n-grams are.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import (
    Memory,
    Rows,
    Sequences,
    append,
    keep_where,
    resident,
    segment_sums,
    share_of_each,
    slices,
    strings,
)
from tierflow.staging import staged

WORD = re.compile(r"[^\W\d_]+")
LONGEST_GRAM = 4
LENGTHS = range(LONGEST_GRAM, 0, -1)
UNDETERMINED = "und"
FIELDS = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("evidence", T.DoubleType()),
    ]
)
# Each word of a slice has an entry for each of its languages in several arrays.
SLICE = 1 << 18
# What a task counts before it hands on: some 15 MB.
DISTINCT_WORDS = 80_000
ROWS_PER_BATCH = 10_000
COUNTED = "lang string, token string, n long"


@dataclass
class Tokens:
    """Tokens, and one after another the languages of each with its excess there."""

    names: list[str]
    lengths: np.ndarray
    langs: np.ndarray
    excess: np.ndarray


@dataclass
class LanguageModel:
    """Languages by the number of their documents, and what is known of them."""

    languages: list[str]
    words: Tokens
    grams: Tokens
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def grams_of(word: str) -> list[str]:
    marked = f"<{word}>"
    size = len(marked) + 1
    return [marked[i : i + n] for n in range(1, LONGEST_GRAM + 1) for i in range(size - n)]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their languages; a task's copies are added up first.

    What is added up goes on, and is begun anew, beyond ``DISTINCT_WORDS``. What another
    operator has kept in this process goes before.
    """
    words: dict[str, Counter] = resident("language counts", dict)
    words.clear()
    for batch in slices(batches, "text"):
        for text, lang in zip(strings(batch.column("text")), batch.column("lang").to_pylist()):
            words.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
        if sum(map(len, words.values())) > DISTINCT_WORDS:
            yield from _counted(words)
    yield from _counted(words)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams of counted words, added up likewise."""
    grams: dict[str, Counter] = resident("language counts", dict)
    grams.clear()
    for batch in batches:
        for token, lang, n in zip(*(batch.column(c).to_pylist() for c in ("token", "lang", "n"))):
            counts = grams.setdefault(lang, Counter())
            if n == 1:
                counts.update(grams_of(token))
            else:
                for g in grams_of(token):
                    counts[g] += n
        if sum(map(len, grams.values())) > DISTINCT_WORDS:
            yield from _counted(grams)
    yield from _counted(grams)


def _counted(tokens: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    """All that is added up, which is forgotten."""
    while tokens:
        lang, counts = tokens.popitem()
        names, numbers = list(counts), list(counts.values())
        for at in range(0, len(names), ROWS_PER_BATCH):
            token = pa.array(names[at : at + ROWS_PER_BATCH], pa.string())
            n = pa.array(numbers[at : at + ROWS_PER_BATCH], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(token), pa.string()), token, n], names=["lang", "token", "n"]
            )


def _tokens(pairs: pa.Table, languages: list[str]) -> Tokens:
    """Tokens with their languages.

    What a language lacks has the same small frequency in each of them, so that
    languages with little text are not favoured.
    """
    column = {x: i for i, x in enumerate(languages)}
    names = pairs["token"].combine_chunks().dictionary_encode()
    tokens = np.asarray(names.indices, np.int64)
    order = np.argsort(tokens, kind="stable")
    langs = np.array([column[x] for x in pairs["lang"].to_pylist()], np.int64)[order]
    counts = pairs["n"].to_numpy()[order].astype(np.float64)
    totals = np.maximum(1, np.bincount(langs, counts, len(languages)))
    floor = 0.5 / totals.max() if len(totals) else 1.0
    excess = np.log(counts / totals[langs] + floor) - np.log(floor)
    lengths = np.bincount(tokens, minlength=len(names.dictionary))
    return Tokens(names.dictionary.to_pylist(), lengths, langs.astype(np.int32), excess)


def _added_up(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang", "token").agg(F.sum("n").alias("n"))


def fit_languages(
    labelled: DataFrame,
    key: str = "doc_id",
    max_docs: int | None = None,
    max_tokens: int = 240_000,
) -> LanguageModel:
    """Learn from ``text`` and ``lang``; rows where either is null teach nothing.

    All rows are counted; given ``max_docs``, about so many of each language, chosen by
    a hash of ``key``. A model has ``max_tokens`` words and as many n-grams at most, an equal
    part for each language, of which the most frequent are taken, ties in the order
    of a hash; so its size has a bound, whatever the number of languages. Each
    language with a word among the rows read is known. Without rows, or with none
    that has a word, the model knows no language and predicts ``und``.
    """
    rows, docs = share_of_each(
        labelled.where("text IS NOT NULL AND lang IS NOT NULL").select(key, "text", "lang"),
        key,
        "lang",
        max_docs,
    )
    counted = _added_up(rows.select("text", "lang").mapInArrow(_count_words, COUNTED))
    with staged(counted, "language-words") as words:
        # N-grams come from each distinct word once, however often and wherever it occurs.
        counted = _added_up(words.mapInArrow(_count_grams, COUNTED))
        with staged(counted, "language-grams") as grams:
            counts = words.withColumn("kind", F.lit("word")).unionByName(grams.withColumn("kind", F.lit("gram")))
            found = {r[0] for r in words.select("lang").distinct().collect()}
            languages = sorted(found, key=lambda x: (-docs[x], x))
            most = max_tokens // max(1, len(languages))
            order = Window.partitionBy("kind", "lang").orderBy(F.desc("n"), F.xxhash64("token", F.lit(7)), "token")
            taken = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max(1, most))
            chosen = taken.select("kind", "lang", "token", "n").toArrow()
    chosen = chosen.sort_by([("token", "ascending"), ("lang", "ascending")])
    kinds = np.array(chosen["kind"].to_pylist(), object)
    words, grams = (
        _tokens(chosen.filter(pa.array(kinds == kind, pa.bool_())), languages) for kind in ("word", "gram")
    )
    return LanguageModel(languages, words, grams)


class _Known:
    """Looks tokens up, and lists the languages of some of them."""

    def __init__(self, tokens: Tokens):
        self.place = {t: i for i, t in enumerate(tokens.names)}
        self.langs, self.excess = Sequences(np.int32), Sequences(np.float64)
        self.langs.extend_flat(tokens.langs, tokens.lengths)
        self.excess.extend_flat(tokens.excess, tokens.lengths)

    def entries(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        langs, lengths = self.langs.gather(numbers)
        return langs, self.excess.gather(numbers)[0], lengths


class _Scorer:
    def __init__(self, model: LanguageModel):
        self.languages = model.languages
        self.words, self.grams = _Known(model.words), _Known(model.grams)
        # Per remembered word its languages, with the excess and the cover of each.
        self.langs, self.values = Sequences(np.int32), Rows((2,), np.float64)
        self.letters = Rows((), np.int64)
        self.memory = Memory(self.learn, self.keep, 150_000)

    def keep(self, numbers: np.ndarray) -> None:
        places = self.places(numbers)[0]
        self.langs.keep(numbers)
        self.values.keep(places)
        self.letters.keep(numbers)

    def places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the entries of some words lie, and how many each has."""
        ends = self.langs.ends.view()
        starts = np.concatenate([[0], ends[:-1]])[numbers]
        lengths = ends[numbers] - starts
        shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
        return np.arange(len(shift)) + shift, lengths

    def learn(self, words: list[str]) -> None:
        get = self.words.place.get
        known = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        seen, unseen = np.flatnonzero(known >= 0), np.flatnonzero(known < 0)
        langs, excess, lengths = self.words.entries(known[seen])
        owner, cover = np.repeat(seen, lengths), np.ones(len(langs))
        found: list[int] = []
        sizes: list[int] = []
        counts = np.array([self.backoff(words[i], found, sizes) for i in unseen.tolist()], np.int64)
        if found:
            # Neighbouring grams overlap, so each character counts about once.
            more, part, lengths = self.grams.entries(np.array(found))
            span = np.array([len(words[i]) + 2 for i in unseen.tolist()])
            shares = (np.array(sizes) - 1) / (LONGEST_GRAM - 1) / np.repeat(span, counts)
            langs, excess = np.concatenate([langs, more]), np.concatenate([excess, part / LONGEST_GRAM])
            owner = np.concatenate([owner, np.repeat(np.repeat(unseen, counts), lengths)])
            cover = np.concatenate([cover, np.repeat(shares, lengths)])
        width = max(1, len(self.languages))
        keys, back = np.unique(owner * width + langs, return_inverse=True)
        sums = [np.bincount(back, v, len(keys)) for v in (excess, cover)]
        self.values.extend(np.stack(sums, axis=1))
        self.langs.extend_flat(keys % width, np.bincount(keys // width, minlength=len(words)))
        self.letters.extend([w.isalpha() or any(map(str.isalpha, w)) for w in words])

    def backoff(self, word: str, found: list[int], sizes: list[int]) -> int:
        """Append the longest known n-gram at each position; how many there are."""
        marked, before, get = f"<{word}>", len(found), self.grams.place.get
        for i in range(len(marked)):
            for n in LENGTHS:
                row = get(marked[i : i + n])
                if row is not None:
                    found.append(row)
                    # A gram that reaches the end of the word could not be longer.
                    sizes.append(LONGEST_GRAM if i + n >= len(marked) else n)
                    break
        return len(found) - before

    def judge(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text the number of its language, or -1, the score, and the evidence."""
        texts = [WORD.findall(t.lower()) for t in strings(column)]
        n, width = len(texts), len(self.languages)
        if not width:
            return np.full(n, -1), np.zeros(n), np.zeros(n)
        counts = np.fromiter(map(len, texts), np.int64, n)
        numbers = self.memory.numbers([w for t in texts for w in t])
        letters = segment_sums(self.letters.view()[numbers], counts)
        places, lengths = self.places(numbers)
        cell = np.repeat(np.repeat(np.arange(n), counts) * width, lengths) + self.langs.values.view()[places]
        values = self.values.view()[places]
        total, cover = (
            np.bincount(cell, values[:, k], n * width).reshape(n, width) for k in (0, 1)
        )
        shares = np.exp(total - total.max(axis=1, keepdims=True))
        shares /= shares.sum(axis=1, keepdims=True)
        # Sums depend on the neighbours in the batch in their last digits.
        shares = shares.round(6)
        best = shares.argmax(axis=1)
        known = letters > 0
        evidence = (cover[np.arange(n), best] / np.maximum(1, counts)).round(6)
        return np.where(known, best, -1), np.where(known, shares.max(axis=1), 0.0), np.where(known, evidence, 0.0)

    def __call__(self, column: pa.Array) -> list[pa.Array]:
        best, score, evidence = self.judge(column)
        names = [self.languages[b] if b >= 0 else UNDETERMINED for b in best.tolist()]
        return [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(evidence, pa.float64())]


def _scorer(shared) -> _Scorer:
    return resident(("language", shared.value.key), lambda: _Scorer(shared.value))


def identify_languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``evidence`` (0 to 1) to each row; nothing is shuffled.

    ``und`` with zeros where the text is null or has no letter, or where the model
    knows no language. A text without known words or n-grams goes to the most
    frequent language with an even score and no evidence. Columns named like the
    result are replaced; all others, repeated rows and an empty table pass unchanged.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return append(docs, FIELDS, lambda: _scorer(shared), text, SLICE)


def least_evidence(
    labelled: DataFrame,
    model: LanguageModel,
    key: str = "doc_id",
    max_docs: int | None = None,
    share: float = 0.6,
) -> float:
    """The evidence that a text in one of the languages may be expected to have.

    A ``share`` of the median over the labelled rows, or given ``max_docs`` over about so
    many of each language, chosen by a hash of ``key``: prose varies by a few hundredths
    around that median, whatever the languages are, while texts of other languages and
    random letters lie far below.
    """
    rows, _ = share_of_each(
        labelled.where("text IS NOT NULL AND lang IS NOT NULL").select(key, "text", "lang"), key, "lang", max_docs
    )
    found = identify_languages(rows, model).where(f"lang_pred <> '{UNDETERMINED}'")
    # Evidence has six places, so few distinct values are gathered.
    middle = found.agg(F.expr("percentile(evidence, 0.5)")).first()[0]
    return share * (middle or 0.0)


def keep_identified(
    docs: DataFrame,
    model: LanguageModel,
    min_score: float = 0.3,
    min_evidence: float = 0.0,
    text: str = "text",
) -> DataFrame:
    """Documents in one of the languages: determined with ``min_score`` and ``min_evidence`` at least."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = _scorer(shared)

        def stays(column: pa.Array) -> np.ndarray:
            best, score, evidence = scorer.judge(column)
            return (best >= 0) & (score >= min_score) & (evidence >= min_evidence)

        return stays

    return keep_where(docs, make, text, SLICE)
