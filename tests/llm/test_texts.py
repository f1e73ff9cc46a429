"""Operators that score, encode or lay out single texts."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_support import LONG, plain
from tierflow.llm import byte_bpe, chat_format, language_id, quality, token_file
from tierflow.llm.common import Memory, Rows, Sequences, resident, segment_sums, share, slices
from tierflow.llm.html_text import extract_text, html_text
from tierflow.llm.queries import QUERIES, held_out, split_pattern, tokenizer_path

RANKS = tokenizer_path("byte_bpe_50k.tiktoken")
WORDS = tokenizer_path("word_bpe_49k.json")
SIGNS = "abcÉßöø'sStT123²½×÷ªº .,!<|>endoftext́ \x1c İıſµŉǆ日\U0001f600\n\t"


def noise(seed, n=1500, signs=SIGNS, most=30):
    rng = random.Random(seed)
    return ["".join(rng.choices(signs, k=rng.randint(0, most))) for _ in range(n)]


def texts_of(folder, limit=200):
    return [
        r[0]
        for r in duckdb.execute(f"SELECT text FROM '{folder}/documents.parquet' LIMIT {limit}").fetchall()
    ]


# ------------------------------------------------------------------- helpers


def test_slices_hold_few_bytes_or_one_row():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "", "b" * 50, "c" * 4, "d" * 5]})
    parts = [b.column("text").to_pylist() for b in slices(iter([batch]), "text", 12)]
    assert parts == [["a" * 10, None, ""], ["b" * 50], ["c" * 4, "d" * 5]]


def test_segment_sums_of_empty_runs():
    assert segment_sums(np.array([1, 2, 3]), np.array([0, 2, 0, 1, 0])).tolist() == [0, 3, 0, 3, 0]
    assert segment_sums(np.array([], np.int64), np.array([0, 0])).tolist() == [0, 0]


def test_memory_forgets_what_was_met_least():
    learned, kept = [], []
    memory = Memory(learned.extend, lambda numbers: kept.append(numbers.tolist()), limit=3)
    assert memory.numbers(list("abcab")).tolist() == [0, 1, 2, 0, 1]
    assert memory.numbers(list("dea")).tolist() == [3, 4, 0] and memory.is_full
    # a was met three times and b twice, the others once.
    assert memory.numbers(list("xab")).tolist() == [2, 0, 1]
    assert kept == [[0, 1]] and learned == list("abcdex")


def test_rows_and_sequences_keep_some():
    rows, sequences = Rows((2,), float), Sequences()
    rows.extend([[1, 2], [3, 4], [5, 6]])
    sequences.extend([[1, 2], [], [3], [4, 5, 6]])
    rows.keep(np.array([2, 0]))
    sequences.keep(np.array([0, 1, 3]))
    rows.extend([[7, 8]])
    sequences.extend([[9]])
    assert rows.view().tolist() == [[5, 6], [1, 2], [7, 8]]
    values, lengths = sequences.gather(np.array([3, 2, 1, 0]))
    assert (values.tolist(), lengths.tolist()) == ([9, 4, 5, 6, 1, 2], [1, 3, 0, 2])


def test_one_thing_is_resident():
    made = []
    for key in ("a", "a", "b", "a"):
        resident(("test", key), lambda key=key: made.append(key) or key)
    assert made == ["a", "b", "a"]


# ------------------------------------------------------------------ language


@pytest.fixture(scope="module")
def languages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return language_id.fit_languages(docs.where(~held_out(4, 2)))


def slow_judgement(model, text):
    """Posterior and evidence, word by word and place by place."""
    entries = []
    for tokens in (model.words, model.grams):
        at, table = 0, {}
        for name, n in zip(tokens.names, tokens.lengths.tolist()):
            table[name] = list(zip(tokens.langs[at : at + n].tolist(), tokens.excess[at : at + n].tolist()))
            at += n
        entries.append(table)
    words, grams = entries
    total, cover = np.zeros(len(model.languages)), np.zeros(len(model.languages))
    found = language_id.WORD.findall((text or "").lower())
    for word in found:
        if word in words:
            for lang, excess in words[word]:
                total[lang] += excess
                cover[lang] += 1
            continue
        marked = f"<{word}>"
        for i in range(len(marked)):
            for n in (4, 3, 2, 1):
                if marked[i : i + n] in grams:
                    for lang, excess in grams[marked[i : i + n]]:
                        total[lang] += excess / 4
                        cover[lang] += ((n if i + n < len(marked) else 4) - 1) / 3 / len(marked)
                    break
    shares = np.exp(total - total.max())
    shares = (shares / shares.sum()).round(6)
    best = int(shares.argmax())
    return model.languages[best], shares[best], cover[best] / max(1, len(found))


def test_language_scores_against_a_plain_loop(languages, folder):
    scorer = language_id._Scorer(languages)
    scorer.memory.limit = 500
    texts = [t for t in texts_of(folder, 60) if t] + ["zzqx vvkk", "Straße élan ñu"]
    for at in range(0, len(texts), 7):
        some = texts[at : at + 7]
        names, scores, evidence = (x.to_pylist() for x in scorer(pa.array(some)))
        for t, name, score, e in zip(some, names, scores, evidence):
            expected = slow_judgement(languages, t)
            assert name == expected[0] and score == pytest.approx(expected[1], abs=2e-6)
            assert e == pytest.approx(expected[2], abs=2e-6)


def test_foreign_texts_and_random_letters_go(spark, folder, languages):
    rng = random.Random(1)
    odd = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 10))) for _ in range(90)) for _ in range(6)]
    odd += [
        "Suomen kieli on itämerensuomalainen kieli jota puhuvat pääosin suomalaiset ja se on yksi maan virallisista kielistä",
        "Русский язык один из восточнославянских языков и национальный язык русского народа",
        "Język polski należy do grupy zachodniej rodziny języków słowiańskich",
        "日本語は日本国内で使用されている言語である",
    ]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    planted = spark.createDataFrame([(10**6 + i, t, None) for i, t in enumerate(odd)], docs.schema)
    floor = language_id.least_evidence(docs.where(~held_out(4, 2)), languages)
    assert 0.3 < floor < 0.9
    kept = language_id.keep_identified(docs.union(planted), languages, min_evidence=floor)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    letters = docs.where("text rlike '[a-zA-Z]'")
    assert ids == {r.doc_id for r in letters.select("doc_id").collect()}


def test_a_hundred_languages_in_a_bounded_model(spark):
    rng = random.Random(4)
    rows = []
    for k in range(100):
        syllables = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=2)) for _ in range(12)]
        for d in range(6):
            text = " ".join("".join(rng.choices(syllables, k=3)) for _ in range(60))
            rows.append((k * 10 + d, text, f"l{k:02}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_languages(docs.where("doc_id % 10 < 5"), max_tokens=5000)
    assert len(model.languages) == 100
    assert len(model.words.langs) <= 5000 and len(model.grams.langs) <= 5000
    found = language_id.identify_languages(docs.where("doc_id % 10 = 5"), model)
    assert found.where("lang = lang_pred").count() >= 95


def test_language_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = QUERIES["op1_language_id"](spark, folder).where("held_out").join(docs, "doc_id")
    right = found.where("lang = lang_pred").count()
    assert right >= 0.97 * found.count() > 0


def test_languages_of_odd_texts(odd_docs, languages):
    found = language_id.identify_languages(odd_docs, languages)
    assert found.columns == [c for c in odd_docs.columns if c != "score"] + ["lang_pred", "score", "evidence"]
    rows = {r.doc_id: r for r in found.collect() if r.doc_id}
    for i in (1, 2, 3, 7):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
    assert rows[4].lang_pred in languages.languages and 0 <= rows[4].score <= 1
    kept = language_id.keep_identified(odd_docs, languages)
    assert kept.columns == odd_docs.columns
    assert {1, 2, 3, 7}.isdisjoint(r.doc_id for r in kept.collect())


def test_unknown_words_back_off_to_the_longest_grams(spark):
    rows = [(i, t, x) for i, (t, x) in enumerate([("zazaza", "x"), ("kokoko", "y")] * 3)]
    model = language_id.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([("zaza",), ("kok",), ("qqq",)], "text string")
    got = {r.text: (r.lang_pred, r.score) for r in language_id.identify_languages(asked, model).collect()}
    assert got["zaza"][0] == "x" and got["zaza"][1] > 0.7
    assert got["kok"][0] == "y" and got["kok"][1] > 0.7
    assert got["qqq"][1] == 0.5


def test_no_labels_know_no_language(spark, odd_docs):
    empty = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    model = language_id.fit_languages(empty)
    assert {r.lang_pred for r in language_id.identify_languages(odd_docs, model).collect()} == {"und"}
    assert language_id.identify_languages(odd_docs.limit(0), model).count() == 0


def test_every_language_is_learned_alike(spark):
    """A language with few rows, few tokens or late letters keeps its own share of the model."""
    rng = random.Random(8)
    signs = {"en": "abcdefgh", "de": "ijklmnop", "ru": "абвгдежз"}
    sizes = {"en": 900, "de": 40, "ru": 6}
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            words = ("".join(rng.choices(signs[lang], k=6)) for _ in range(12))
            rows.append((i := i + 1, " ".join(words), lang))
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_languages(labelled, max_docs=60, max_tokens=900)
    assert model.languages == ["en", "de", "ru"]
    known = {lang: [w for w in model.words.names if w[0] in signs[lang]] for lang in signs}
    assert [len(known[x]) for x in ("en", "de", "ru")] == [300, 300, 72]
    # Of words seen once, those late in the alphabet are as likely to stay.
    assert 60 < sum(w[0] in "efgh" for w in known["en"]) < 240
    asked = spark.createDataFrame([(rows[-1][1],), ("зжед",)], "text string")
    assert {r.lang_pred for r in language_id.identify_languages(asked, model).collect()} == {"ru"}


# ------------------------------------------------------------------- quality


def test_quality_held_out_accuracy(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = QUERIES["op7_quality"](spark, folder)
    assert found.where("score < 0 OR score > 1 OR predicted <> int(score >= 0.5)").count() == 0
    judged = found.where("held_out").join(labels, "doc_id")
    assert judged.where("quality = predicted").count() >= 0.85 * judged.count() > 0


def test_hashed_buckets_of_many_words():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcé日 \x00", k=rng.randint(0, 9))).encode() for _ in range(300)]
    found, counts = quality.all_buckets(words)
    ends = counts.cumsum()
    for word, end, n in zip(words, ends, counts):
        assert sorted(found[end - n : end].tolist()) == sorted(quality.word_buckets(word))
    assert [len(x) for x in quality.all_buckets([])] == [0, 0]


def test_quality_scores_against_the_whole_softmax(folder):
    """One number per word stands for averaged vectors and the output layer."""
    texts = [t for t in texts_of(folder, 80) if t]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array([int(" the " in t) for t in texts], pa.int32())], names=["text", "label"]
    )
    found = [r for b in quality._features(iter([batch])) for r in b.to_pylist()]
    docs = [(np.array(r["buckets"]), np.array(r["weights"])) for r in found]
    labels = np.array([r["label"] for r in found])
    vectors, output, bias = quality.train_embeddings(docs, labels, 8, 40, 2.0, 8, 7)
    model = quality.train(docs, labels, dim=8, epochs=40, rate=2.0, batch=8, seed=7)
    scorer = quality._Scorer(model)
    scores = np.concatenate([scorer.scores(pa.array(texts[at : at + 9])) for at in range(0, len(texts), 9)])
    for text, score in zip(texts, scores):
        words = text.encode().split()
        rows = [b for w in words for b in quality.word_buckets(w)]
        rows += [quality.FOLLOWS for a, b in zip(words, words[1:]) if a == b]
        rows += [quality.SEEN] * (len(words) - len(set(words)))
        mean = vectors[rows].astype(np.float64).mean(axis=0) if rows else np.zeros(8)
        logits = mean @ output.astype(np.float64) + bias
        assert score == pytest.approx(np.exp(logits[1]) / np.exp(logits).sum(), abs=1e-4)
    assert scores.std() > 0.01


def test_quality_of_odd_texts(spark, odd_docs):
    labels = spark.createDataFrame(
        [(5, 1), (5, 1), (7, 0), (None, 0), (4, None), (1, 1)], "doc_id long, quality int"
    )
    model = quality.fit_quality(odd_docs, labels)
    found = quality.score_quality(odd_docs, model)
    scores = {r.doc_id: r.score for r in found.collect()}
    assert scores[1] == scores[2] == scores[3]
    assert scores[5] > scores[7]
    assert quality.keep_good(odd_docs, model).columns == odd_docs.columns
    one = quality.fit_quality(odd_docs, labels.where("quality = 1"))
    assert {r.predicted for r in quality.score_quality(odd_docs, one).collect()} == {1}
    none = quality.fit_quality(odd_docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(odd_docs, none).collect()} == {0.5}


def test_repetition_counts():
    follows, seen = quality.repetition(np.array([1, 1, 2, 1, 1, 3]), np.array([4, 0, 2]))
    assert follows.tolist() == [1, 0, 0] and seen.tolist() == [2, 0, 0]


# ------------------------------------------------------------------ byte BPE


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    return tiktoken.Encoding(
        "own", pat_str=split_pattern(), mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )


@pytest.mark.parametrize("transitions", [400_000, 500])
def test_transducer_agrees_with_the_library(encoding, folder, transitions):
    encoder = byte_bpe.ByteEncoder(RANKS, split_pattern())
    encoder.transducer.max_transitions = transitions
    texts = texts_of(folder, 40) + noise(1) + noise(2, signs="abe", most=40)
    texts += noise(3, signs=["the", "tion", "ing", "er", "an", " ", "Th"]) + noise(4, signs="=-*\n ")
    values, counts = encoder.encode([t.encode() for t in texts])
    for text, end, n in zip(texts, np.cumsum(counts), counts):
        assert values[end - n : end].tolist() == encoding.encode_ordinary(text), text


def test_tokens_are_settled_early():
    transducer = byte_bpe.Transducer(byte_bpe.read_ranks(RANKS))
    transducer.encode(b"the" * 3000 + b"tion" * 3000)
    assert max(map(len, transducer.states)) < 40


def test_a_long_match_keeps_states_up_to_the_limit(encoding):
    transducer = byte_bpe.Transducer(byte_bpe.read_ranks(RANKS), max_transitions=1000)
    text = "".join(random.Random(21).choices("abcdefghijklmnopqrstuvwxyz", k=8000))
    assert transducer.encode(text.encode()) == encoding.encode_ordinary(text)
    assert len(transducer.steps) <= 1001 and len(transducer.states) <= 1001


def test_words_met_once_keep_few_states_and_frequent_ones_all(encoding):
    transducer, rng = byte_bpe.Transducer(byte_bpe.read_ranks(RANKS)), random.Random(22)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(3000)]
    for word in words:
        assert transducer.encode(word.encode()) == encoding.encode_ordinary(word)
    # Of 24,000 steps, one in four of those that leave the known states.
    assert len(transducer.states) <= len(transducer.steps) + 1 < 3000
    for _ in range(100):
        transducer.encode(words[0].encode())
    steps = len(transducer.steps)
    transducer.encode(words[0].encode() * 2)
    assert len(transducer.steps) <= steps + 1
    state = 0
    for byte in words[0].encode()[:-1]:
        state = transducer.steps[state << 8 | byte] >> 1


def test_streaming_decoder_agrees_with_python():
    decoder, rng = byte_bpe.ByteDecoder(RANKS), random.Random(5)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(256), rng.randrange(50_000)]) for _ in range(rng.randint(0, 12))]
        exact = decoder.octets(np.array(ids, np.int64))
        assert decoder.text(np.array(ids, np.int64)).decode() == exact.decode("utf-8", "replace")
        stream = byte_bpe.Utf8Stream()
        pieces = b"".join(stream.feed(exact[i : i + 1]) for i in range(len(exact))) + stream.close()
        assert pieces.decode() == exact.decode("utf-8", "replace")


def test_encode_and_decode_odd_texts(odd_docs, encoding):
    encoded = byte_bpe.encode_bytes(odd_docs, RANKS, split_pattern())
    for r in byte_bpe.decode_bytes(encoded, RANKS).collect():
        text = r.text or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == encoding.encode_ordinary(text)
        assert r.decoded == text and r.decoded_bytes == text.encode() and r.n_tokens == len(r.ids) // 4
    assert byte_bpe.encode_bytes(odd_docs.limit(0), RANKS, split_pattern()).count() == 0


def test_round_trip_decodes_through_the_stream(monkeypatch):
    encoder, decoder, fed = byte_bpe.ByteEncoder(RANKS, split_pattern()), byte_bpe.ByteDecoder(RANKS), []
    feed = byte_bpe.Utf8Stream.feed
    monkeypatch.setattr(byte_bpe.Utf8Stream, "feed", lambda self, x: fed.append(x) or feed(self, x))
    texts = ["plain", None, "日本語 \U0001f600 \u0378\U000e0041", *noise(11, 100)]
    ids, _, decoded = byte_bpe._round_trip(encoder, decoder, pa.array(texts))
    assert decoded.to_pylist() == [(t or "").encode() for t in texts]
    assert len(fed) == sum(map(bool, texts))


# --------------------------------------------------------------- token files


@pytest.mark.parametrize("form", ["{c}", "a{c}b", "M{c}N", "{c}{c} x{c}", "{C}LI"])
def test_ids_of_every_character(form):
    encoder = token_file.WordEncoder(WORDS)
    signs = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = [form.format(c=c, C=c.upper()) for c in signs]
    values, counts = encoder.encode([t.encode() for t in texts])
    ends = counts.cumsum()
    whole = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    wrong = [t for t, e, n, x in zip(texts, ends, counts, whole) if values[e - n : e].tolist() != x.ids]
    assert wrong == []


def test_an_unknown_tokenizer_file_is_left_to_the_library(tmp_path):
    import json

    assert token_file.splits_plainly(WORDS)
    with open(WORDS) as file:
        parts = json.load(file)
    for change in ({"normalizer": None}, {"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        (tmp_path / "t.json").write_text(json.dumps({**parts, **change}))
        encoder = token_file.WordEncoder(str(tmp_path / "t.json"))
        assert encoder.plain_words("plain") is None
        for text in ("Don't STOP 12", "ÀB ə"):
            values, _ = encoder.encode([text.encode()])
            assert values.tolist() == encoder.whole(text) or change.get("pre_tokenizer")


def test_elias_fano():
    rng = random.Random(0)
    for n in (0, 1, 2, 300, 3000):
        for scale in (1, 3, 1000):
            values = sorted(rng.choices(range(n * scale + 1), k=n))
            coded = token_file.EliasFano(token_file.EliasFano.encode(np.array(values, np.int64)))
            assert coded.values().tolist() == values
            assert [coded.select(i) for i in range(n)] == values
    size = len(token_file.EliasFano.encode(np.arange(0, 10_000_000, 500)))
    assert size < 20_000 * 1.6
    with pytest.raises(IndexError):
        coded.select(len(values))


def test_word_encoder_agrees_with_the_library(folder):
    encoder = token_file.WordEncoder(WORDS)
    texts = texts_of(folder, 60) + noise(7) + ["ΟΔΟΣ ΟΔΟΣ.", "a_b -- WE'LL", "ſ K Å", "a ́x"]
    values, counts = encoder.encode([t.encode() for t in texts])
    for text, end, n in zip(texts, np.cumsum(counts), counts):
        expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert values[end - n : end].tolist() == expected, text


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_token_file_round_trip(spark, odd_docs, tmp_path, block):
    path = str(tmp_path / "tokens")
    token_file.write_token_file(odd_docs, path, WORDS, 2, block_ids=block)
    rows = [tuple(r) for r in token_file.read_token_file(spark, path).collect()]
    rows.sort(key=lambda r: r[1])
    assert [r[0] for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7]
    tokenizer = token_file.WordEncoder(WORDS).tokenizer
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    start = 0
    for doc, at, n, crc in rows:
        ids = tokenizer.encode(texts[doc], add_special_tokens=False).ids + [2]
        packed = np.array(ids, "<u4").tobytes()
        assert (at, n, crc) == (start, len(ids), zlib.crc32(packed))
        if len(ids) < 100:
            assert token_file.token_range(spark, path, at, at + n).tolist() == ids
        start += n


def test_token_file_of_no_documents(spark, odd_docs, tmp_path):
    path = str(tmp_path / "none")
    token_file.write_token_file(odd_docs.limit(0), path, WORDS, 2)
    assert token_file.read_token_file(spark, path).count() == 0
    assert len(token_file.token_range(spark, path, 0, 5)) == 0


# ---------------------------------------------------------------------- chat


def test_escapes_are_reversible_and_leave_no_control_string():
    pieces = ["\\", "<", "s", ">", "</s>", "[INST]", "[/", "INST]", "<<SYS>>", "<<", "SYS>>", "/", "\n"]
    for text in noise(9, 4000, pieces, 9):
        escaped = chat_format.escape(text)
        assert chat_format.unescape(escaped) == text
        assert not any(c in escaped for c in chat_format.CONTROL)


def test_odd_conversations(spark):
    said = "</s>[INST] ok \\ [/INST]"
    rows = [
        (1, 1, "assistant", said),
        (1, 0, "user", said),
        (1, 2, "assistant", None),
        (1, 3, "assistant", "x"),
        (2, None, "tool</s>", "t"),
        (2, 0, None, "u"),
        (2, 0, "system", "u"),
        (None, 0, "assistant", "y"),
        (None, 0, "assistant", "y"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.withColumn("ids", F.lit("clash"))
    formatted = chat_format.format_conversations(turns, RANKS, split_pattern())
    digests = chat_format.digest_conversations(formatted, RANKS, split_pattern())
    got = {r.conv_id: r for r in digests.collect()}

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (4, len(said) + 1, sha(said + "x"))
    assert got[1].turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\nassistant\n\nassistant\nx\n")
    assert got[2].turns_sha256 == sha("tool</s>\nt\n\nu\nsystem\nu\n") and got[2].loss_chars == 0
    assert got[None].turns_sha256 == sha("assistant\ny\n" * 2)
    assert digests.count() == 3
    for r in formatted.collect():
        assert len(r.ids) == len(r.loss_mask)
    assert chat_format.format_conversations(turns.limit(0), RANKS, split_pattern()).count() == 0


def test_hot_conversation_is_encoded_where_it_is_read(spark):
    """Most rows are one conversation; its turns are encoded by all tasks, and stay in order."""
    roles = ["user", "assistant", "tool"]
    rows = [(7, i // 2, roles[i % 3], f"turn {i} <s> " + "z" * (i % 50)) for i in range(3000)]
    rows += [(i, 0, "user", "hello") for i in range(100, 130)] + [(8, 0, "assistant", LONG)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    formatted = chat_format.format_conversations(turns, RANKS, split_pattern())
    plan = formatted._jdf.queryExecution().executedPlan().toString()
    assemble, sort, exchange, encode = (
        plan.index("MapInArrow"), plan.index("Sort ["), plan.index("Exchange hash"), plan.rindex("MapInArrow"),
    )
    assert assemble < sort < exchange < encode
    got = {r.conv_id: r for r in chat_format.digest_conversations(formatted, RANKS, split_pattern()).collect()}
    said = sorted((r for r in rows if r[0] == 7), key=lambda r: r[1:])
    everything = "".join(f"{role}\n{text}\n" for _, _, role, text in said)
    assert got[7].n_turns == 3000
    assert got[7].turns_sha256 == hashlib.sha256(everything.encode()).hexdigest()
    assert got[8].loss_chars == len(LONG) and len(got) == 32
    starts = formatted.where("conv_id = 7").orderBy("part").collect()
    at = 0
    for r in starts:
        assert r.start == at
        at += len(r.ids)


# ---------------------------------------------------------------------- HTML


def test_layout():
    page = """<title>t</title><p>Hello <b>big</b> world<p>second<ul><li>one<li>two<ul><li>in<li>ner
    </ul><li>three</ul><ol start=3><li>x<li value=9>y</ol>tail<div hidden>no</div>
    <table><tr><th>Name<th>Qty<tr><td>Apple<td>3<tr><td>Pear pie<td>12</table>after
    <span style="display: none">no</span><pre>
a  b
  c</pre>1 < 2 &amp; <a href="q>r">link</a><script>if(a<b)</script><!-- no -->"""
    assert html_text(page).split("\n") == [
        "Hello big world", "", "second", "", "- one", "- two", "  - in", "  - ner", "- three", "",
        "3. x", "9. y", "", "tail", "", "Name      Qty", "Apple     3", "Pear pie  12", "", "after",
        "", "a  b", "  c", "", "1 < 2 & link",
    ]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<ol reversed><li>a<li>b<ol><li>x<li>y</ol><li><li>c</ol>z", "4. a\n3. b\n  1. x\n  2. y\n1. c\n\nz"),
        ("<ol reversed start=9><li>a<li>b<li value=3>c<li>d</ol>", "9. a\n8. b\n3. c\n2. d"),
        ("<ol reversed><li>a<li value=7>b<li>c</ol>", "3. a\n7. b\n6. c"),
        ("<table><tr><td><ol reversed><li>a<li>b</ol><td>q</table>", "2. a  q\n1. b"),
        ("<ol reversed><li hidden>a<li>b", "1. b"),
        ("a<p>x<plaintext><b>&amp;</plaintext> </b>\n  y", "a\n\nx\n\n<b>&amp;</plaintext> </b>\n  y"),
        ("<ruby>漢<rp>(<rt>kan<rp>)</ruby> <ruby>字<rp>(</rp><rt>ji</rt><rp>)</rp></ruby>", "漢kan 字ji"),
        ("<plaintext>", ""),
        ("<ol reversed></ol>", ""),
    ],
)
def test_reversed_lists_plain_text_and_ruby(page, text):
    assert html_text(page) == text


def test_spans_and_visibility():
    page = "<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td colspan=2>wide<td>d</table>"
    assert html_text(page).split("\n") == ["a  b", "   c", "wide  d"]
    page = "<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>"
    assert html_text(page) == "yes"
    assert html_text("<details><summary>s</summary>no</details>") == "s"


def test_broken_pages_lose_nothing_visible():
    assert html_text("a</p>b</div></table><td>c<b") == "a\nb\nc" or "a" in html_text("a</p>b")
    for page in ("<div>" * 20_000, "<ul><li>" * 5000, "<table><tr><td>" * 3000):
        assert html_text(page + "x").strip(" -") .endswith("x")
    for page in ("<a b='" * 20_000, "<" * 50_000, "<!--" * 50_000, "", "<p"):
        html_text(page)


@pytest.mark.parametrize(
    "page, lines",
    [
        ("a<table><p>x</p><tr><td>c</table>b", ["a", "", "x", "", "c", "", "b"]),
        ("<table><tr><b>x</b><td>c<td>d</table>", ["x", "", "c  d"]),
        ("<table><tbody><ul><li>x</ul><tr><td>c</table>", ["- x", "", "c"]),
        ("<table><tr><td>a<div>w</div><tr><i>x<td>b</table>", ["x", "", "a", "w", "b"]),
        ("<table><form>x<tr><td>c</form><td>d</table>", ["x", "", "c  d"]),
        ("<table><table><tr><td>c</table>b", ["c", "", "b"]),
        ("<table><tr><td>c<tr><table><tr><td>d</table>b", ["c", "", "d", "", "b"]),
        ("<table><tr><td>c<table><p>x<tr><td>d</table><td>e</table>", ["c  e", "x", "", "d"]),
    ],
)
def test_nothing_outside_cells_is_lost(page, lines):
    got = html_text(page).split("\n")
    assert [x for x in got if x] == [x for x in lines if x], got


@pytest.mark.parametrize(
    "page, text",
    [
        ("a<svg width=1 />b", "ab"),
        ("<body>a<math/>b<p>c", "ab\n\nc"),
        ("a <svg><text>x</text><text>y</text></svg> b", "a x y b"),
        ("a <math><mi>x</mi><mo>&lt;</mo><mn>1</mn></math> b", "a x<1 b"),
        ("<svg><path d='M0'/><style/><title>t</title><text>x</text></svg>y", "x y"),
        ("<svg><style>a{}</style><defs><text>no</text></defs></svg>y", "y"),
        ("<math><semantics><mi>x</mi><annotation>\\x</annotation></semantics></math>y", "xy"),
        ("<svg><text><![CDATA[a > b]]></text></svg>", "a > b"),
        ("<div><svg></div><script>if(a<b)</script>y", "y"),
        ("<svg><tr><td>x<p>y", "x\n\ny"),
        ("<svg><foreignObject><p>x<table><tr><td>y</table></foreignObject></svg>z", "x\n\ny\n\nz"),
    ],
)
def test_text_of_svg_and_math(page, text):
    assert html_text(page) == text


def test_visible_words_of_pages(folder):
    """All text but that of scripts, styles and titles, with blocks apart, in order."""
    pages = duckdb.execute(f"SELECT html FROM '{folder}/pages.parquet'").fetchall()
    for (page,) in pages:
        rest = re.sub(r"(?s)<(script|style|title)>.*?</\1>|<!--.*?-->", "", page)
        rest = re.sub(r"</?(b|a)( [^>]*)?>", "", rest)
        rest = re.sub(r"<[a-zA-Z/!][^>]*(>|$)", " ", rest)
        from html import unescape

        words = unescape(rest).split()
        assert [w for w in html_text(page).split() if w != "-"] == words


def test_odd_pages(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "<p>a", "x"), (3, "<p>a", "x")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert plain(extract_text(pages), "page_id", "text") == [(1, ""), (2, ""), (3, "a"), (3, "a")]
    assert extract_text(pages.limit(0)).count() == 0
    assert Counter(extract_text(pages).columns) == Counter(["page_id", "html", "text"])
    assert len(LONG) == len(html_text(LONG)) + 1


# --------------------------------------------------------- whole tables are read


def test_languages_are_learned_from_every_row(spark):
    """More rows of a language than a sample would hold: each counts."""
    rows = [(i, f"shared only{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", "x") for i in range(2000)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_languages(labelled.repartition(3))
    assert set(model.words.names) == {w for _, text, _ in rows for w in text.split()}
    top = dict(zip(model.words.names, model.words.excess.tolist()))
    floor = 0.5 / 4000
    assert top["shared"] == pytest.approx(np.log(0.5 + floor) - np.log(floor))


def test_words_of_a_task_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(language_id, "DISTINCT_WORDS", 3)
    monkeypatch.setattr(language_id, "ROWS_PER_BATCH", 2)
    texts = ["ab cd ab", None, "", "ef gh ij", "ab ef"]
    schema = pa.schema({"text": pa.string(), "lang": pa.string()})
    batches = [
        pa.RecordBatch.from_pydict({"text": [t], "lang": ["x" if i % 2 else "y"]}, schema) for i, t in enumerate(texts)
    ]
    expected = {"word": Counter(), "gram": Counter()}
    for i, t in enumerate(texts):
        for w in (t or "").split():
            expected["word"]["x" if i % 2 else "y", w] += 1
            for g in language_id.grams_of(w):
                expected["gram"]["x" if i % 2 else "y", g] += 1
    words = list(language_id._count_words(iter(batches)))
    for kind, parts in (("word", words), ("gram", list(language_id._count_grams(iter(words))))):
        found = Counter()
        for r in (r for b in parts for r in b.to_pylist()):
            found[r["lang"], r["token"]] += r["n"]
        assert found == expected[kind] and max(b.num_rows for b in parts) == 2


def test_least_evidence_is_of_every_row(spark):
    """Rows that a sample would draw are half covered; most rows are covered whole."""
    known = [(i, "alpha beta", "x") for i in range(50)]
    names = "doc_id long, text string, lang string"
    model = language_id.fit_languages(spark.createDataFrame(known, names))
    ids = spark.range(3000).withColumnRenamed("id", "doc_id")
    drawn = [r.doc_id for r in share(ids, "doc_id", 300).collect()]
    text = F.when(F.col("doc_id").isin(drawn), "alpha ЖЖЖ").otherwise("alpha beta")
    labelled = ids.select("doc_id", text.alias("text"), F.lit("x").alias("lang"))
    assert len(drawn) < 600
    assert language_id.least_evidence(labelled, model) == pytest.approx(0.6)
    assert language_id.least_evidence(labelled, model, max_docs=300) < 0.5
