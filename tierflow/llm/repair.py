"""Repair of the turn structure of conversations, at the least cost.

A repaired conversation is empty, or has an optional system turn and then turns
of user and assistant by turns. Its turns are kept (K), deleted (D) or given
another role (R), and empty turns are inserted (I); the letters in order are the
audit. Among repairs of one cost the audit that comes first counts.

Both are one whole number: the cost in the high digits, and below it the audit
in places of equal width, first letter highest, zeros behind its end, so that a
letter at place ``j`` of ``width`` adds ``letter * 8 ** (width - 1 - j)``. Repairs
are paths through a graph without cycles, whose nodes are a turn and what came
last; the least number of a node follows from those before it by plain ``min``.
No repair's audit begins another one's of equal cost at the same node, so what
is least at a node stays so. Places that all nodes share are taken off from time
to time, which keeps the numbers short however long a conversation is.

Only keys travel for the decision: role, faults, and a digest of the text, about
a byte of which reaches the task that decides. Texts move once, for the turns
that stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.staging import stage

# ------------------------------------------------------------------ decision

# Letters in order of their bytes, and what edits cost.
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
_SPELL = str.maketrans("1234", "DIKR")
DELETE, RENAME, INSERT, TRUNCATED = 4, 3, 3, 3
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
# Where a user or assistant turn leads: from each state only one of them may follow.
NEXT = (USER, USER, ASSISTANT, USER)
KEEP = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NAMES = {USER: "user", ASSISTANT: "assistant"}

# A symbol is the initial of a role (``o`` for others) and its fault, as one character.
INITIALS, FAULTS = "suao", "-bdt"
SYMBOLS = {i + f: chr(65 + 4 * a + b) for a, i in enumerate(INITIALS) for b, f in enumerate(FAULTS)}
MEANING = {c: pair for pair, c in SYMBOLS.items()}
ORDERLY = {"su", "ua", "au"}


class _Weights:
    """The least number of each node of the current turn."""

    def __init__(self, width: int = 256):
        self.width = width
        # The number, and how many places of it are taken, per state.
        self.least: list[tuple[int, int] | None] = [(0, 0), None, None, None]
        self.settled: list[str] = []
        self.insert()

    def grown(self, node: tuple[int, int], letter: int, cost: int) -> tuple[int, int]:
        weight, used = node
        places = 3 * (self.width - 1 - used)
        return weight + (cost << 3 * self.width) + (letter << places), used + 1

    def offer(self, to: list, state: int, node: tuple[int, int]) -> None:
        if to[state] is None or node[0] < to[state][0]:
            to[state] = node

    def insert(self) -> None:
        """Inserted turns before the next one; a third would lead back to a node."""
        least, letter = self.least, LETTERS["I"]
        answered = least[ASSISTANT]
        for a, b in ((EMPTY, USER), (SYSTEM, USER), (USER, ASSISTANT)):
            if least[a] is not None:
                self.offer(least, b, self.grown(least[a], letter, INSERT))
        if answered is not None:
            self.offer(least, USER, self.grown(answered, letter, INSERT))

    def turn(self, initial: str, fault: str) -> None:
        to: list[tuple[int, int] | None] = [None] * 4
        more = TRUNCATED if fault == "t" else 0
        for state, node in enumerate(self.least):
            if node is None:
                continue
            self.offer(to, state, self.grown(node, LETTERS["D"], DELETE))
            if fault in "bd":
                continue
            kept = KEEP.get(initial, {}).get(state)
            if kept is not None:
                self.offer(to, kept, self.grown(node, LETTERS["K"], more))
            self.offer(to, NEXT[state], self.grown(node, LETTERS["R"], RENAME + more))
        self.least = to
        self.insert()
        if max(n[1] for n in self.least if n) > self.width - 4:
            self.shorten()

    def cost(self, state: int) -> int:
        return self.least[state][0] >> 3 * self.width

    def shorten(self) -> None:
        """Take off the places that all nodes share; widen the numbers if few are."""
        # Whatever an empty repair can still become, one after an assistant turn
        # can with one more deletion; and it is the better of a system turn's.
        for state, more in ((EMPTY, DELETE), (SYSTEM, 0)):
            if self.least[state] is not None and self.cost(state) > self.cost(ASSISTANT) + more:
                self.least[state] = None
        mask = (1 << 3 * self.width) - 1
        nodes = [n for n in self.least if n]
        one = nodes[0][0] & mask
        differ = max(((n[0] & mask) ^ one).bit_length() for n in nodes)
        shared = min(self.width - -(-differ // 3), *(n[1] for n in nodes))
        if shared:
            self.settled.append(oct(one >> 3 * (self.width - shared))[2:].translate(_SPELL))
            for state, node in enumerate(self.least):
                if node:
                    cost, places = node[0] >> 3 * self.width, (node[0] << 3 * shared) & mask
                    self.least[state] = cost << 3 * self.width | places, node[1] - shared
        if max(n[1] for n in self.least if n) > self.width // 2:
            self.least = [n and (n[0] << 3 * self.width, n[1]) for n in self.least]
            self.width *= 2

    def result(self) -> tuple[int, str]:
        ends = [self.least[s] for s in (EMPTY, ASSISTANT) if self.least[s]]
        weight, used = min(ends)
        places = weight & (1 << 3 * self.width) - 1
        rest = oct(places >> 3 * (self.width - used))[2:].translate(_SPELL) if used else ""
        return weight >> 3 * self.width, "".join([*self.settled, rest])


def cheapest_repair(symbols: str) -> tuple[int, str]:
    """The cost and the audit of turns given by their symbols."""
    weights = _Weights()
    for symbol in symbols:
        weights.turn(*MEANING[symbol])
    return weights.result()


_remembered = lru_cache(maxsize=20_000)(cheapest_repair)


def decide(symbols: str) -> tuple[int, str]:
    return (_remembered if len(symbols) <= 64 else cheapest_repair)(symbols)


def repaired_roles(symbols: str, audit: str) -> Iterator[tuple[int | None, str | None]]:
    """Per repaired turn the number of the turn it was, or None, and its new role, or None."""
    at, state = 0, EMPTY
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield None, NAMES[state]
            continue
        if letter == "K":
            state = KEEP[MEANING[symbols[at]][0]][state]
            yield at, None
        elif letter == "R":
            state = NEXT[state]
            yield at, NAMES[state]
        at += 1


# -------------------------------------------------------------------- tables

SPACE = " \t\n\x0b\f\r"
FRAGMENT_BITS = 12
DECIDED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        # A repaired turn: its number, the place of the turn it was, its new role.
        T.StructField("position", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("role", T.StringType()),
        # Or what is said of the conversation.
        T.StructField("gaps", T.LongType()),
        T.StructField("blank", T.LongType()),
        T.StructField("duplicate", T.LongType()),
        T.StructField("truncated", T.LongType()),
        T.StructField("illegal", T.LongType()),
        T.StructField("cost", T.LongType()),
        T.StructField("audit", T.StringType()),
    ]
)
REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
KEY = ["conv_id", "turn", "role", "digest"]
ROWS_OUT = 50_000


def _join(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """Join on equality of ``columns``, null with null; the left ones stay."""
    other = {c: f"__{c}" for c in columns}
    condition = F.lit(True)
    for c, name in other.items():
        condition = condition & F.col(c).eqNullSafe(F.col(name))
    return left.join(right.withColumnsRenamed(other), condition, how).drop(*other.values())


def _turns(turns: DataFrame) -> DataFrame:
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns without their texts, in order, copies as one row: ``KEY``, ``place``,
    ``symbol`` and ``copies``."""
    said = F.rtrim("text", F.lit(SPACE))
    keys = turns.select(*KEY, (said == "").alias("blank"), F.right(said, F.lit(1)).isin(".", "!", "?").alias("whole"))
    rows, _ = stage(keys.groupBy(*keys.columns).agg(F.count("*").alias("copies")), "turns")
    # What is said again at a later turn; the first turn may be one without a number.
    same = rows.groupBy("conv_id", "role", "digest").agg(
        F.count("*").alias("turns"), F.count_if(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("first")
    )
    again, _ = stage(same.where("turns > 1"), "again")
    found = _join(rows, again, ["conv_id", "role", "digest"], "left")
    later = F.col("turn").isNotNull() & ((F.col("unnumbered") > 0) | (F.col("turn") > F.col("first")))
    fault = (
        F.when(F.col("blank"), "b").when(F.coalesce(later, F.lit(False)), "d").when(~F.col("whole"), "t").otherwise("-")
    )
    initial = F.left("role", F.lit(1))
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    names = F.create_map(*[F.lit(x) for pair in SYMBOLS.items() for x in pair])
    marked = found.select(*KEY, names[F.concat(initial, fault)].alias("symbol"), "copies")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(dealt.withColumn("place", F.monotonically_increasing_id()), "ordered")[0]


class _Conversation:
    """Fragments of one conversation, in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.symbols: list[str] = []
        self.places: list[int | None] = []
        self.first = self.last = None
        self.distinct = 0

    def feed(self, place: int, symbols: str, turns: list, copies: list[int]) -> None:
        for i, (symbol, turn, n) in enumerate(zip(symbols, turns, copies)):
            again = SYMBOLS[MEANING[symbol][0] + ("b" if MEANING[symbol][1] == "b" else "d")]
            self.symbols.append(symbol + again * (n - 1))
            self.places += [place + i, *[None] * (n - 1)]
            if turn is not None and turn != self.last:
                self.distinct += 1
                self.first = turn if self.first is None else self.first
                self.last = turn

    def rows(self) -> Iterator[tuple]:
        symbols = "".join(self.symbols)
        cost, audit = decide(symbols)
        for position, (at, role) in enumerate(repaired_roles(symbols, audit)):
            place = None if at is None else self.places[at]
            yield (self.conv_id, position, place, role, *[None] * len(REPORT))
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        count = {f: sum(symbols.count(SYMBOLS[i + f]) for i in INITIALS) for f in "bdt"}
        initials = "".join(MEANING[s][0] for s in symbols)
        illegal = sum(a + b not in ORDERLY for a, b in zip(initials, initials[1:]))
        yield (self.conv_id, None, None, None, gaps, count["b"], count["d"], count["t"], illegal, cost, audit)


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string() if isinstance(f.dataType, T.StringType) else pa.int64() for f in DECIDED]
    names = ["conv_id", "first", "symbols", "turns", "copies"]
    now, out = None, []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [()] * len(kinds)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=DECIDED.names)

    def finish() -> Iterator[pa.RecordBatch]:
        for row in now.rows() if now else ():
            out.append(row)
            if len(out) >= ROWS_OUT:
                yield batch()

    for part in batches:
        for conv_id, *fragment in zip(*(part.column(n).to_pylist() for n in names)):
            if now is None or now.conv_id != conv_id:
                yield from finish()
                now = _Conversation(conv_id)
            now.feed(*fragment)
    yield from finish()
    yield batch()


@dataclass
class Repair:
    """``reports``, one row per conversation, and ``turns``, those that it has then."""

    reports: DataFrame
    turns: DataFrame


def repair_conversations(turns: DataFrame) -> Repair:
    """The cheapest repair of each conversation of ``conv_id``, ``turn``, ``role``, ``text``.

    Turns count in order of their numbers, null first, then of role and digest of
    the text; other columns are not read, null roles and texts are empty, and rows
    without a conversation id are one conversation with a null id. A turn's first
    fault counts: blank, duplicate (role and text said before in the conversation),
    truncated (not closed by ``.``, ``!`` or ``?``); copies are duplicates. Reports
    hold ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal`` (neighbours
    that may not follow each other), ``cost`` and ``audit``; turns hold ``conv_id``,
    ``position``, ``role`` and ``text``. No rows give no rows.

    Turns are dealt by ranges, so those of a long conversation by many tasks; a
    character and two numbers of each reach the task that decides.
    """
    turns = _turns(turns)
    ordered = _ordered(turns)
    part = F.struct("place", "turn", "symbol", "copies")
    fragments = ordered.groupBy("conv_id", F.shiftright("place", FRAGMENT_BITS).alias("fragment")).agg(
        F.sort_array(F.collect_list(part)).alias("rows")
    )
    rows = F.col("rows")
    lists = fragments.select(
        "conv_id",
        rows[0]["place"].alias("first"),
        F.array_join(rows["symbol"], "").alias("symbols"),
        rows["turn"].alias("turns"),
        rows["copies"].alias("copies"),
    )
    dealt = lists.repartition("conv_id").sortWithinPartitions("conv_id", "first")
    decided, _ = stage(dealt.mapInArrow(_decide, DECIDED), "decided")
    stay = decided.where("position IS NOT NULL").select("conv_id", "position", "place", "role")
    kept = stay.where("place IS NOT NULL").select("position", "place", F.col("role").alias("new_role"))
    kept = kept.join(ordered.select("place", *KEY), "place").drop("place")
    # Of copies only the first may stay, so a key names one text.
    texts = turns.groupBy(*KEY).agg(F.first("text").alias("text"))
    told = _join(kept, texts, KEY).select(
        "conv_id", "position", F.coalesce("new_role", "role").alias("role"), "text"
    )
    inserted = stay.where("place IS NULL").select("conv_id", "position", "role", F.lit("").alias("text"))
    return Repair(decided.where("position IS NULL").select("conv_id", *REPORT), told.unionAll(inserted))


def digest_turns(turns: DataFrame) -> DataFrame:
    """Per conversation the SHA-256 of its ``role:text`` lines: ``conv_id``, ``sha256``.

    The digest of a conversation is sequential, so it is one stream, in bounded memory.
    """
    import hashlib

    dealt = turns.select("conv_id", "position", "role", "text").repartition("conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, seen = None, [], False

        def batch() -> pa.RecordBatch:
            ids, hashes = zip(*done) if done else ((), ())
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], names=["conv_id", "sha256"]
            )

        for part in batches:
            columns = (part.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for conv_id, role, text in zip(*columns):
                line = f"{role}:{text}".encode()
                if not seen or now[0] != conv_id:
                    if seen:
                        done.append((now[0], now[1].hexdigest()))
                    now, seen = (conv_id, hashlib.sha256(line)), True
                else:
                    now[1].update(b"\n" + line)
            yield batch()
        if seen:
            done.append((now[0], now[1].hexdigest()))
        yield batch()

    return dealt.sortWithinPartitions("conv_id", "position").mapInArrow(run, "conv_id long, sha256 string")
