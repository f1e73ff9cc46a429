"""Byte-level BPE: a lazily determinised transducer, and a streaming decoder.

In a valid encoding each pair of neighbours is itself a valid encoding, and a
prefix of a text has exactly one valid last token, given those of its own
prefixes. The transducer reads bytes and keeps, for each position at which a
token that is still open could begin, the last token before it and the node of
the vocabulary's prefix tree that the bytes since then lead to. Positions no
open token begins at are dropped; once all that remain share their first
tokens, these are settled and given out, after a lookahead bounded by the
vocabulary. What is kept is relative to the current byte, so equal situations
are one state. Some of the transitions that leave the known states are kept and
reused for all later text, so that those met often are known soon; the others lead
on without a state. All are forgotten together when there are too many.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tierflow.llm.common import Memory, Sequences, append, octets, resident, segment_sums

ROOT, DEAD, START, SETTLED, OFF = 0, -1, -1, -2, -1
# Bytes of a match beyond which it is held to repeat itself.
LONG_MATCH = 64
SLICE = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: base64 of a token, then its rank, per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class Transducer:
    """Encodes one match of the split pattern, given as bytes."""

    def __init__(
        self,
        ranks: dict[bytes, int],
        max_transitions: int = 200_000,
        keep_one_in: int = 4,
        max_pairs: int = 300_000,
    ):
        self.ranks = ranks
        self.bytes = {r: t for t, r in ranks.items()}
        self.child: dict[int, int] = {}
        self.accepts = [DEAD]
        self.inner = [True]
        for token, rank in ranks.items():
            node = ROOT
            for b in token:
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.accepts)
                    self.inner[node] = True
                    self.accepts.append(DEAD)
                    self.inner.append(False)
                node = self.child[key]
            self.accepts[node] = rank
        self.lengths = {r: len(t) for r, t in self.bytes.items()}
        self.max_transitions, self.keep_one_in, self.max_pairs = max_transitions, keep_one_in, max_pairs
        self.pairs: dict[int, bool] = {}
        self.proper: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        # An entry is (bytes back, last token, open node); the oldest comes first
        # and all others follow from it, so its token is settled.
        begin = ((0, START, ROOT),)
        self.states, self.known = [begin], {begin: 0}
        self.left = 0
        self.steps: dict[int, int] = {}
        self.settled: dict[int, tuple[int, ...]] = {}
        self.rests: dict[int, tuple[int, ...]] = {}

    def merges(self, text: bytes, cut: int = 0) -> list[bytes] | None:
        """Parts of a text after all merges, the lowest rank and leftmost first.

        None as soon as a merge crosses ``cut``.
        """
        get, none = self.ranks.get, len(self.accepts) + len(self.ranks)
        parts = [text[i : i + 1] for i in range(len(text))]
        pairs = [get(text[i : i + 2], none) for i in range(len(text) - 1)]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            i = pairs.index(least)
            if i + 1 == cut:
                return None
            cut -= i < cut
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
        return parts

    def fits(self, last: int, token: int) -> bool:
        """Whether ``token`` may follow ``last``, or begin a text."""
        if last == START:
            if token not in self.proper:
                self.proper[token] = len(self.merges(self.bytes[token])) == 1
            return self.proper[token]
        pair = last << 32 | token
        fits = self.pairs.get(pair)
        if fits is None:
            if len(self.pairs) > self.max_pairs:
                self.pairs.clear()
            first = self.bytes[last]
            fits = self.merges(first + self.bytes[token], len(first)) == [first, self.bytes[token]]
            self.pairs[pair] = fits
        return fits

    def advance(self, entries: tuple, byte: int) -> tuple[list, int]:
        """The entries after a byte, and the token that ends with it."""
        moved, candidates = [], []
        child, accepts, inner = self.child.get, self.accepts, self.inner
        for back, last, node in entries:
            if node >= 0:
                node = child(node << 8 | byte, DEAD)
                if node >= 0:
                    if accepts[node] >= 0:
                        candidates.append((last, accepts[node]))
                    if not inner[node]:
                        node = DEAD
            moved.append((back + 1, last, node))
        if not candidates:
            raise ValueError("the vocabulary lacks a byte")
        # Exactly one candidate is right, so the last one needs no look.
        for last, token in candidates[:-1]:
            if self.fits(last, token):
                return moved, token
        return moved, candidates[-1][1]

    def move(self, entries: tuple, byte: int) -> tuple[tuple, tuple[int, ...]]:
        """The entries of the next state, and the tokens settled on the way."""
        moved, chosen = self.advance(entries, byte)
        moved.append((0, chosen, ROOT))
        oldest, lengths = moved[0][0], self.lengths
        followers: dict[int, int] = {}
        kept = []
        for entry in reversed(moved):
            back, last, node = entry
            if node >= 0 or back in followers:
                kept.append(entry)
                if back != oldest:
                    before = back + lengths[last]
                    followers[before] = followers.get(before, 0) + 1
        kept.reverse()
        # A dead oldest entry with one follower settles it: it is the next one kept.
        first = 0
        while kept[first][2] < 0 and followers[kept[first][0]] == 1:
            first += 1
        settled = tuple(e[1] for e in kept[1 : first + 1])
        # Nothing can follow a dead entry directly, so its own token is no matter.
        back, last, node = kept[first]
        return ((back, last if node >= 0 else SETTLED, node), *kept[first + 1 :]), settled

    def number(self, entries: tuple) -> int:
        """The number of a state, which is kept from now on."""
        found = self.known.get(entries)
        if found is None:
            found = self.known[entries] = len(self.states)
            self.states.append(entries)
        return found

    def rest(self, state: int) -> tuple[int, ...]:
        """The tokens that are open when the text ends in this state."""
        entries = self.states[state]
        place, at, found = {e[0]: e for e in entries}, 0, []
        while at != entries[0][0]:
            token = place[at][1]
            found.append(token)
            at += self.lengths[token]
        self.rests[state] = tuple(reversed(found))
        return self.rests[state]

    def finish(self, entries: tuple, byte: int) -> list[int]:
        """The tokens that are open when the text ends with a byte.

        For a step that is not known: most are met once, at the end of a rare word,
        and no state is made for what nothing follows.
        """
        moved, chosen = self.advance(entries, byte)
        place, lengths = {e[0]: e[1] for e in moved}, self.lengths
        found, at = [chosen], lengths[chosen]
        while at != moved[0][0]:
            found.append(place[at])
            at += lengths[place[at]]
        found.reverse()
        return found

    def encode(self, match: bytes) -> list[int]:
        whole = self.ranks.get(match)
        if whole is not None:
            return [whole]
        if len(self.steps) > self.max_transitions or len(self.states) > self.max_transitions:
            self.reset()
        if not match:
            return []
        # Off the states that are kept its number is -1, and no step has a negative key.
        state, out, get, entries = 0, [], self.steps.get, ()
        for byte in match[:-1]:
            key = state << 8 | byte
            step = get(key)
            if step is None:
                before = entries if state < 0 else self.states[state]
                entries, settled = self.move(before, byte)
                out += settled
                if self.is_kept(state, match):
                    target = self.number(entries)
                    if state >= 0:
                        self.steps[key] = target << 1 | bool(settled)
                        if settled:
                            self.settled[key] = settled
                    state = target
                else:
                    state = self.known.get(entries, OFF)
                continue
            if step & 1:
                out += self.settled[key]
            state = step >> 1
        key = state << 8 | match[-1]
        step = get(key)
        if step is None:
            return out + self.finish(entries if state < 0 else self.states[state], match[-1])
        if step & 1:
            out += self.settled[key]
        state = step >> 1
        rest = self.rests.get(state)
        return out + list(self.rest(state) if rest is None else rest)

    def is_kept(self, state: int, match: bytes) -> bool:
        """Whether a step from a state that is met now is kept.

        Most are met once, within rare words: of those that leave the states that are
        kept, one in some is, so that what is met often is known soon. A long match may
        repeat itself, and keeps all. None is kept beyond the limit, also within a match.
        """
        if len(self.steps) > self.max_transitions or len(self.states) > self.max_transitions:
            return False
        if len(match) > LONG_MATCH:
            return True
        if state < 0:
            return False
        self.left += 1
        return self.left % self.keep_one_in == 0


class ByteEncoder:
    """Ids of texts; matches that have been met are remembered."""

    def __init__(self, path: str, pattern: str):
        self.transducer = Transducer(read_ranks(path))
        self.pattern = regex.compile(pattern)
        self.ids = Sequences()
        self.matches = Memory(self.learn, self.ids.keep, 300_000)

    def learn(self, matches: list[str]) -> None:
        encode = self.transducer.encode
        self.ids.extend([encode(m.encode()) for m in matches])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        find = self.pattern.findall
        lists = [find(t.decode()) for t in texts]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        values, lengths = self.ids.gather(self.matches.numbers([m for x in lists for m in x]))
        return values, segment_sums(lengths, counts)


# ------------------------------------------------------------------ decoding

# States of the UTF-8 machine: 0 between characters; then what may come next.
_NEXT = [
    {**dict.fromkeys(range(0x80), 0), **dict.fromkeys(range(0xC2, 0xE0), 1), 0xE0: 4,
     **dict.fromkeys([*range(0xE1, 0xED), 0xEE, 0xEF], 2), 0xED: 5, 0xF0: 6,
     **dict.fromkeys(range(0xF1, 0xF4), 3), 0xF4: 7},
    dict.fromkeys(range(0x80, 0xC0), 0),
    dict.fromkeys(range(0x80, 0xC0), 1),
    dict.fromkeys(range(0x80, 0xC0), 2),
    dict.fromkeys(range(0xA0, 0xC0), 1),
    dict.fromkeys(range(0x80, 0xA0), 1),
    dict.fromkeys(range(0x90, 0xC0), 2),
    dict.fromkeys(range(0x80, 0x90), 2),
]
REPLACEMENT = "\N{REPLACEMENT CHARACTER}".encode()


# Ids whose bytes go to the stream at once.
PER_PIECE = 1 << 16


class Utf8Stream:
    """Turns bytes that come in pieces into whole characters.

    A character is given out once its last byte is there. Each longest beginning
    of a character that cannot go on becomes one replacement character, as in
    Python's decoder.
    """

    def __init__(self):
        self.state, self.open = 0, b""

    def feed(self, piece: bytes) -> bytes:
        if not self.open:
            # What is whole already passes at once; the machine takes over where it is not.
            try:
                piece.decode()
                return piece
            except UnicodeDecodeError as error:
                whole, piece = piece[: error.start], piece[error.start :]
        else:
            whole = b""
        out, state, begun = bytearray(), self.state, bytearray(self.open)
        for b in piece:
            target = _NEXT[state].get(b)
            if target is None:
                if begun:
                    out += REPLACEMENT
                    begun.clear()
                target = _NEXT[0].get(b)
                if target is None:
                    out += REPLACEMENT
                    state = 0
                    continue
            begun.append(b)
            state = target
            if state == 0:
                out += begun
                begun.clear()
        self.state, self.open = state, bytes(begun)
        return whole + bytes(out)

    def close(self) -> bytes:
        rest = REPLACEMENT if self.open else b""
        self.state, self.open = 0, b""
        return rest


class ByteDecoder:
    """Bytes and text of ids."""

    def __init__(self, path: str):
        self.tokens = {r: t for t, r in read_ranks(path).items()}

    def octets(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def text(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text, replacement characters for what is broken."""
        stream, out = Utf8Stream(), []
        for at in range(0, len(ids), PER_PIECE):
            out.append(stream.feed(self.octets(ids[at : at + PER_PIECE])))
        out.append(stream.close())
        return b"".join(out)


def _encoder(path: str, pattern: str) -> ByteEncoder:
    return resident(("bytes", path, pattern), lambda: ByteEncoder(path, pattern))


def _decoder(path: str) -> ByteDecoder:
    return resident(("octets", path), lambda: ByteDecoder(path))


def _coder(path: str, pattern: str) -> tuple[ByteEncoder, ByteDecoder]:
    """Both in one, where one worker does both."""
    return resident(("both", path, pattern), lambda: (ByteEncoder(path, pattern), ByteDecoder(path)))


IDS = T.StructType(
    [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
)
DECODED = T.StructType(
    [T.StructField("decoded_bytes", T.BinaryType()), T.StructField("decoded", T.StringType())]
)


def _packed(encoder: ByteEncoder, column: pa.Array) -> tuple[list[bytes], np.ndarray]:
    values, counts = encoder.encode(octets(column))
    data, ends = values.astype("<u4"), np.cumsum(counts)
    return [data[e - n : e].tobytes() for e, n in zip(ends, counts)], counts


def encode_bytes(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (little-endian unsigned 32-bit numbers) and ``n_tokens``.

    Each match of ``pattern`` in the whole text is encoded by itself. A null or
    empty text has no ids. Columns named like the result are replaced, others
    pass; repeated rows keep their rows, nothing is shuffled.
    """

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        encoder = _encoder(ranks, pattern)

        def step(column: pa.Array) -> list[pa.Array]:
            ids, counts = _packed(encoder, column)
            return [pa.array(ids, pa.binary()), pa.array(counts, pa.int64())]

        return step

    return append(docs, IDS, make, text, SLICE)


def _round_trip(encoder: ByteEncoder, decoder: ByteDecoder, column: pa.Array) -> list[pa.Array]:
    ids, counts = _packed(encoder, column)
    decoded = [decoder.text(np.frombuffer(x, "<u4")) for x in ids]
    return [pa.array(ids, pa.binary()), pa.array(counts, pa.int64()), pa.array(decoded, pa.binary())]


def round_trip(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """``encode_bytes``, and ``decoded_bytes``, what the streaming decoder makes of the ids, in one Python worker."""

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        return partial(_round_trip, *_coder(ranks, pattern))

    return append(docs, T.StructType([*IDS, DECODED[0]]), make, text, SLICE)


def decode_bytes(encoded: DataFrame, ranks: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded_bytes`` and ``decoded``, the text of ``ids``; null ids are empty.

    Broken UTF-8 becomes replacement characters in the text; the bytes are exact.
    An id that the vocabulary lacks raises an error.
    """

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        decoder = _decoder(ranks)

        def step(column: pa.Array) -> list[pa.Array]:
            lists = [np.frombuffer(x, "<u4") for x in octets(column)]
            exact = [decoder.octets(x) for x in lists]
            clean = [decoder.text(x) for x in lists]
            return [
                pa.array(exact, pa.binary()),
                pa.array(clean, pa.binary()).cast(pa.string()),
            ]

        return step

    return append(encoded, DECODED, make, ids)
