"""The operators as named queries over a folder of tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.ann_tree import nearest_neighbours
from tierflow.llm.byte_bpe import round_trip
from tierflow.llm.chat_format import digest_conversations, format_conversations
from tierflow.llm.common import crc_of_id, table
from tierflow.llm.decontaminate import find_contamination
from tierflow.llm.divergence import audit_sources
from tierflow.llm.html_text import extract_text
from tierflow.llm.language_id import fit_languages, identify_languages
from tierflow.llm.piece_bpe import piece_round_trip
from tierflow.llm.repair import digest_turns, repair_conversations
from tierflow.llm.quality import fit_quality, score_quality
from tierflow.llm.simhash import near_duplicates
from tierflow.llm.token_file import read_token_file, write_token_file
from tierflow.llm.url_rules import ListedRule, judge_urls, listed_verdict, mine_rules, url_host, url_path
from tierflow.staging import new_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def held_out(folds: int, fold: int):
    return F.pmod(crc_of_id(), F.lit(folds)) == fold


@query("op1_language_id")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = fit_languages(docs.where(~held_out(4, 2)))
    scored = identify_languages(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


# The length of the formatted string follows from the template: control strings
# around each turn, and a backslash for each one escaped within.
CHAT_SQL = r"""
WITH every AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), spoken AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM every
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text,
      '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<<ROLE>>|<</ROLE>>|\\'))
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 4
      ELSE 21 + length(role) END AS chars
  FROM spoken
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op2_chat_format", CHAT_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    ranks, pattern = tokenizer_path("byte_bpe_50k.tiktoken"), split_pattern()
    return digest_conversations(
        format_conversations(turns.unionByName(probe), ranks, pattern), ranks, pattern
    )


@query("op3_token_file")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    path = new_path(spark, "tokens")
    write_token_file(docs, path, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return read_token_file(spark, path)


@query("op4_byte_bpe")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ranks = tokenizer_path("byte_bpe_50k.tiktoken")
    return round_trip(docs, ranks, split_pattern()).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded_bytes", 256).alias("decoded_sha256"),
    )


@query("op5_simhash")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    classes = near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
    return classes.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )

@query("op6_nearest_neighbours")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours(table(spark, folder, "embeddings").select("vec_id", "embedding"))


@query("op7_quality")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    model = fit_quality(docs, labels.where(~held_out(3, 1)))
    return score_quality(docs, model).select(
        "doc_id", held_out(3, 1).alias("held_out"), "score", "predicted"
    )


@query("op8_html_text")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "html")
    return extract_text(pages).select("page_id", "text")


# The listed rules.
URL_RULES = [
    ListedRule.parse("allow org/"),
    ListedRule.parse("block example.org/es/"),
    ListedRule.parse("block example.org/en/1"),
    ListedRule.parse("allow com/fr/"),
    ListedRule.parse("block com/de/"),
]


@query("op9_url_filter")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    # The list labels the URLs it covers; what they have in common is mined for the rest.
    decided = listed_verdict(URL_RULES, url_host(F.col("url")), url_path(F.col("url")))
    rules = mine_rules(pages.select("url", decided["verdict"].alias("label")))
    return judge_urls(pages, URL_RULES, rules).drop("url")


# Words of an item in order, all windows of ten, and the words of the texts that
# lie in an occurrence of a window.
CONTAMINATION_SQL = r"""
WITH item_words AS (
  SELECT item_id, i, words[i] AS word, len(words) AS n
  FROM (SELECT item_id, unnest(range(1, len(words) + 1)) AS i, words FROM (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark))
), docs AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), windows AS (
  SELECT item_id, least(n, 10) AS width, string_agg(word, ' ' ORDER BY j) AS win FROM (
    SELECT a.item_id, a.i, a.n, b.i AS j, b.word FROM item_words a JOIN item_words b
    ON a.item_id = b.item_id AND b.i BETWEEN a.i AND a.i + least(a.n, 10) - 1
    WHERE a.i <= greatest(a.n - 9, 1))
  GROUP BY item_id, i, n
), widths AS (SELECT DISTINCT width FROM windows
), spots AS (
  SELECT doc_id, p, width, array_to_string(words[p : p + width - 1], ' ') AS win FROM (
    SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS p
    FROM docs, widths WHERE len(words) >= width)
), hits AS (
  SELECT s.doc_id, s.p, s.width, w.item_id FROM spots s JOIN windows w USING (width, win)
), marked AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
    SELECT doc_id, unnest(range(p, p + width)) AS q FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(words), 0) AS BIGINT) AS n_words,
  coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op10_decontamination", CONTAMINATION_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, folder, "benchmark"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# Every kept term in every group, then all pairs of groups, term by term.
DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS d,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), said AS (SELECT d, lang, source, unnest(words) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM said GROUP BY lang, term HAVING count(DISTINCT d) >= 3
), sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), sources AS (SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM said SEMI JOIN kept USING (lang, term)
  GROUP BY lang, source, term
), totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source
), dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + s.v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (k.n + 1)) // (s.total + s.v) AS q
  FROM sources g JOIN kept k USING (lang) JOIN sizes s USING (lang)
  LEFT JOIN totals t USING (lang, source) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), results AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM dense WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM results)
WHERE part = 'pair' OR place <= 200
"""


@query("op11_source_divergence", DIVERGENCE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("text", "lang", "source")
    return audit_sources(docs, min_docs=3, top=200)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with the faults that the contract plants by a checksum of their keys."""
    blank = F.lit(" ")
    spelled = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *spelled).cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    without = F.translate(text, ".!?", "")
    return (
        turns.withColumn("fault", fault)
        .where("fault <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, "user").otherwise(role).alias("role"),
            F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, without).otherwise(text).alias("text"),
            F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))),
        )
        .drop("col")
    )


def _repair_sql() -> str:
    """The least ``cost || audit`` per state, turn by turn, costs in twelve digits."""

    def grown(x: str, cost: str, letter: str) -> str:
        spent = f"CAST({x}[1:12] AS BIGINT) + {cost}"
        return f"lpad(CAST({spent} AS VARCHAR), 12, '0') || {x}[13:] || '{letter}'"

    def least(*xs: str) -> str:
        return f"least({', '.join(xs)})"

    def dropped(q: str) -> str:
        return grown(q, "4", "D")

    def kept(q: str, initial: str) -> str:
        return f"CASE WHEN live AND initial = '{initial}' THEN {grown(q, 'more', 'K')} END"

    def renamed(q: str) -> str:
        return f"CASE WHEN live THEN {grown(q, '3 + more', 'R')} END"

    to_user = [f(q) for q in "esa" for f in (lambda q: kept(q, "u"), renamed)]
    inserted = {q: grown(q, "3", "I") for q in ("e0", "s0", "a0", "u1")}
    return rf"""
WITH RECURSIVE faulty AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), drawn AS (
  SELECT *, xor(4294967295, list_reduce(
    list_transform(string_split(key, ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
    lambda crc, byte: list_reduce(CAST(range(8) AS BIGINT[]),
      lambda x, bit: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END), xor(crc, byte)),
    4294967295)) % 20 AS f
  FROM faulty
), after AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn WHERE f <> 0
), numbered AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
  FROM after
), counted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM numbered
), turns AS (
  SELECT *, said = '' AS blank, said <> '' AND nth > 1 AS duplicate,
    said <> '' AND nth = 1 AND right(said, 1) NOT IN ('.', '!', '?') AS truncated,
    said <> '' AND nth = 1 AS live,
    CASE WHEN said <> '' AND nth = 1 AND right(said, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS more,
    lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS following
  FROM counted
), ids AS (SELECT DISTINCT conv_id FROM conversations
), best AS (
  SELECT conv_id, 0 AS i, repeat('0', 12) AS e, CAST(NULL AS VARCHAR) AS s,
    '000000000003I' AS u, '000000000006II' AS a
  FROM ids
  UNION ALL
  SELECT conv_id, i, e0, s0, {least("u1", inserted["a0"])}, {least("a0", inserted["u1"])}
  FROM (
    SELECT *, {least("u0", inserted["e0"], inserted["s0"])} AS u1 FROM (
      SELECT b.conv_id, t.i, {dropped("e")} AS e0, {least(dropped("s"), kept("e", "s"))} AS s0,
        {least(dropped("u"), *to_user)} AS u0,
        {least(dropped("a"), kept("u", "a"), renamed("u"))} AS a0
      FROM best b JOIN turns t ON b.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = b.i + 1))
), ends AS (
  SELECT conv_id, least(e, a) AS w FROM best
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), letters AS (
  SELECT conv_id, k, w[12 + k] AS letter FROM (
    SELECT conv_id, w, unnest(range(1, length(w) - 11)) AS k FROM ends)
), placed AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER line AS i, count(*) FILTER (letter <> 'D') OVER line AS p
  FROM letters WINDOW line AS (PARTITION BY conv_id ORDER BY k)
), shown AS (
  SELECT l.conv_id, l.p, l.letter, t.role, t.text, t.initial,
    max(CASE WHEN l.p = 1 AND l.letter = 'K' AND t.initial = 's' THEN 1 ELSE 0 END)
      OVER (PARTITION BY l.conv_id) AS shift
  FROM placed l LEFT JOIN turns t
    ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.i = l.i AND l.letter <> 'I'
  WHERE l.letter <> 'D'
), repaired AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (p - shift) % 2 = 1 THEN 'user'
    ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS lines
  FROM shown GROUP BY conv_id
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id
)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(w[1:12] AS BIGINT) AS cost, w[13:] AS audit,
  sha256(coalesce(lines, '')) AS repaired_sha256
FROM ids d JOIN ends n ON d.conv_id IS NOT DISTINCT FROM n.conv_id
LEFT JOIN stats z ON d.conv_id IS NOT DISTINCT FROM z.conv_id
LEFT JOIN repaired r ON d.conv_id IS NOT DISTINCT FROM r.conv_id
"""


@query("op12_conversation_repair", _repair_sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    repair = repair_conversations(damaged(turns))
    ids = turns.select(F.col("conv_id").cast("long").alias("id")).distinct()
    digests = digest_turns(repair.turns).withColumnsRenamed({"conv_id": "digested"})
    known = ids.join(repair.reports, ids["id"].eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    found = known.join(digests, F.col("id").eqNullSafe(F.col("digested")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.na.fill(0, counts).na.fill("", ["audit"]).select(
        F.col("id").alias("conv_id"),
        *counts,
        "audit",
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


@query("op13_piece_bpe")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # Fixed value: the end id of the model.
    coded = piece_round_trip(docs, tokenizer_path("piece_bpe_32k.model"), end_id=2)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
