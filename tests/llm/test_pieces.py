"""Piece encoding against the library."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from llm_support import LONG, plain
from tierflow.llm.piece_bpe import PieceEncoder, crosses_markers, decode_pieces, encode_pieces, piece_round_trip
from tierflow.llm.queries import QUERIES, tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
SIGNS = "abcÉ  ▁▁ \n\t\x00日本<s></s> the of İı\U0001f600́ﬁ ⁇​　"


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(MODEL)


def ids_of(encoder, texts):
    values, counts = encoder.encode([t.encode() for t in texts])
    ends = counts.cumsum()
    return [values[e - n : e].tolist() for e, n in zip(ends, counts)]


@pytest.fixture(scope="module")
def noise():
    rng = random.Random(1)
    made = ["".join(rng.choices(SIGNS, k=rng.randint(0, 40))) for _ in range(4000)]
    return made + ["", " ", "  ", "▁", "a ", " a", "a  b", "\n", "</s>", LONG[:100_000], " " * 5000, "x" * 20_000]


def test_ids_equal_the_library(encoder, noise):
    assert encoder.by_chunk
    assert ids_of(encoder, noise) == encoder.library.encode(noise)


def test_every_character_alone_and_within_a_word(encoder):
    texts = [f"{c} a{c}b {c}{c}" for c in map(chr, range(0x3000)) if not 0xD800 <= ord(c) < 0xE000]
    assert ids_of(encoder, texts) == encoder.library.encode(texts)


def test_forgotten_chunks_are_learnt_again(noise):
    encoder = PieceEncoder(MODEL)
    encoder.chunks.limit = 50
    for at in range(0, len(noise), 100):
        some = noise[at : at + 100]
        assert ids_of(encoder, some) == encoder.library.encode(some)


def test_texts_equal_the_library(encoder):
    rng = random.Random(4)
    odd = [0, 1, 2, 3, 10, 13, 200, 230, 250, 28705, 259, 264]
    for _ in range(5000):
        ids = [rng.choice([*odd, rng.randrange(32_000)]) for _ in range(rng.randint(0, 8))]
        assert encoder.decode(ids) == encoder.library.decode(ids)


def test_a_model_that_crosses_markers_goes_to_the_library(noise):
    assert crosses_markers("a▁") and crosses_markers("▁a▁b")
    assert not crosses_markers("▁▁") and not crosses_markers("▁▁a") and not crosses_markers("a")
    encoder = PieceEncoder(MODEL)
    encoder.by_chunk = False
    assert ids_of(encoder, noise[:300]) == encoder.library.encode(noise[:300])


def test_query_against_the_library(spark, folder):
    import hashlib

    library = PieceEncoder(MODEL).library
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    expected = []
    for doc, text in rows:
        ids = library.encode(text or "", add_eos=True)
        hashes = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
        expected.append((doc, len(ids), *hashes))
    found = QUERIES["op13_piece_bpe"](spark, folder)
    assert plain(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)


def test_odd_rows(spark, odd_docs, encoder):
    coded = piece_round_trip(odd_docs, MODEL, end_id=2)
    assert set(coded.columns) == set(odd_docs.columns) | {"n_tokens", "decoded"}
    rows = coded.select("doc_id", "text", "ids", "n_tokens", "decoded").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.ids == encoder.library.encode(r.text or "", add_eos=True)
        assert r.n_tokens == len(r.ids) and r.decoded == encoder.library.decode(r.ids)


def test_encode_and_decode_apart(spark, odd_docs):
    both = decode_pieces(encode_pieces(odd_docs.select("text"), MODEL), MODEL)
    assert plain(both, "decoded") == plain(odd_docs.select(F.coalesce("text", F.lit(""))))
    nothing = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert plain(decode_pieces(nothing, MODEL), "decoded") == [("",), ("",)]


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert piece_round_trip(empty, MODEL, end_id=2).collect() == []
