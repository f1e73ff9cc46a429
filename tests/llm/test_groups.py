"""Operators that bring rows together, against brute force."""

import hashlib
import random
from itertools import combinations, product

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from llm_support import plain
from tierflow.llm import ann_tree, decontaminate, simhash, url_rules
from tierflow.llm.common import components
from tierflow.llm.queries import ORACLES, QUERIES, URL_RULES

# ------------------------------------------------------------------- SimHash


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints, radius=4):
    """Smallest id reachable, by comparing all pairs."""
    label = list(range(len(ids)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    x = np.array(prints, np.uint64)
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i] ^ x[i + 1 :]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            label[max(a, b)] = min(a, b)
    roots = [find(i) for i in range(len(ids))]
    least = {}
    for r, d in zip(roots, ids):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [least.get(r) for r in roots]


def test_simhash_query_against_brute_force(spark, folder):
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    prints = [slow_fingerprint(t) for _, t in rows]
    classes = slow_components([d for d, _ in rows], prints)
    expected = sorted((d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, classes))
    got = QUERIES["op5_simhash"](spark, folder)
    assert plain(got, "doc_id", "fingerprint", "component_id") == sorted(expected, key=repr)


@pytest.mark.parametrize("tile", [4096, 7])
def test_links_of_hot_groups_and_chains(spark, tile):
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for base in (0, (1 << 64) - 1, rng.getrandbits(64)):
        chain = base
        for _ in range(60):
            for b in rng.sample(range(64), rng.choice([1, 3, 4, 5])):
                chain ^= 1 << b
            prints.add(chain)
            prints.add(base ^ (1 << rng.randrange(64)))
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = [tuple(r) for r in simhash.fingerprint_links(table, tile).collect()]
    assert len(links) <= 15 * len(prints) * (1 if tile > 1000 else 60)
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    expected = slow_components(list(range(len(prints))), prints)
    groups, found = {}, {}
    for s, e in zip(signed, expected):
        groups.setdefault(e, set()).add(s)
        found.setdefault(roots.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_components_of_long_paths(spark):
    edges = spark.range(400).selectExpr("id AS a", "id + 1 AS b").where("a <> 200")
    roots = components(edges.union(edges.select("b", "b")), "a", "b")
    sizes = sorted(r[1] for r in roots.groupBy("root").count().collect())
    assert sizes == [200, 201]
    assert components(edges.limit(0), "a", "b").count() == 0


def test_near_duplicates_of_odd_rows(spark, odd_docs):
    got = plain(simhash.near_duplicates(odd_docs), "doc_id", "component_id")
    assert got == sorted(
        [(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (5, 5), (None, 5), (6, 6), (7, 7)], key=repr
    )
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7]
    assert simhash.near_duplicates(odd_docs.limit(0)).count() == 0
    nameless = odd_docs.where("doc_id IS NULL")
    assert plain(simhash.near_duplicates(nameless), "doc_id", "component_id") == [(None, None)]
    assert simhash.drop_near_duplicates(nameless).count() == 1


# ----------------------------------------------------------- nearest neighbours


def slow_neighbours(rows, every=20, k=20):
    usable = [
        (i, np.array(v, np.float64))
        for i, v in rows
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    out = {}
    for q, x in usable:
        if q % every == 0:
            scored = sorted((-float(x @ y), i) for i, y in usable if i != q and len(y) == len(x))
            out[q] = scored[:k]
    return out


def test_recall_against_brute_force(spark, folder):
    rows = duckdb.execute(f"SELECT vec_id, embedding FROM '{folder}/embeddings.parquet'").fetchall()
    truth = slow_neighbours([(i, list(v)) for i, v in rows])
    got = QUERIES["op6_nearest_neighbours"](spark, folder).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(truth)
    hits = 0
    for q, best in truth.items():
        mine = sorted(found[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [(-round(r.score, 9), r.vec_id) for r in mine] == sorted((-round(r.score, 9), r.vec_id) for r in mine)
        hits += len({i for _, i in best} & {r.vec_id for r in mine})
    assert hits >= 0.9 * 20 * len(truth)
    (recall,) = {r.recall for r in got}
    assert recall >= 0.95


def test_calibration_counts_neighbours_among_all_rows(spark):
    """Visits are widened by rows of all, of which the fitted sample holds a part."""
    random_ = np.random.default_rng(4)
    x = random_.normal(size=(900, 6))
    tree = ann_tree.build_tree(x[:200], 16)
    copies = random_.integers(1, 4, len(x))
    leaves = tree.assign(x)
    rows = [
        (bytearray(v.astype("<f8").tobytes()), list(range(n)), int(leaf))
        for v, n, leaf in zip(x, copies.tolist(), leaves)
    ]
    dealt = spark.createDataFrame(rows, "packed binary, ids array<long>, leaf long").repartition(5)
    queries = x[:40]
    truth = ann_tree.true_neighbours(dealt, queries, 20)
    for i, (q, found) in enumerate(zip(queries, truth)):
        order = [j for j in np.argsort(-(x @ q)) if j != i]
        near = [leaves[j] for j in order for _ in range(copies[j])][:20]
        assert [leaf for leaf, n in found for _ in range(n)] == near
    for target in (0.3, 0.9, 1.0):
        visits, recall = ann_tree.calibrate(tree, queries, truth, target)
        shares = [
            np.mean([leaf in tree.walk(q, v) for q, t in zip(queries, truth) for leaf, n in t for _ in range(n)])
            for v in (visits - 1, visits)
        ]
        assert shares[0] < target <= recall + 1e-12 and abs(shares[1] - recall) < 1e-12
    assert ann_tree.calibrate(tree, queries[:1], [[]], 0.9) == (tree.n_leaves, 1.0)


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(0, 60, 2)] + [(i, [0.5, float(i % 7)]) for i in range(1, 30, 2)]
    rows += [(100, None), (101, []), (102, [0.0, 0.0]), (103, [nan, 1.0]), (104, [1.0, inf])]
    rows += [(105, [None, 1.0]), (None, [1.0, 1.0]), (20, [0.0, -1.0]), (300, [1.0, 2.0, 3.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn(
        "packed", F.lit("clash")
    )
    got = {}
    for r in ann_tree.nearest_neighbours(vectors).where("query_id <> 20").collect():
        got.setdefault(r.query_id, []).append((r["rank"], round(r.score, 9), r.vec_id))
    for q, best in slow_neighbours(rows).items():
        if q != 20 and best:
            expected = [(n + 1, round(-s, 9), i) for n, (s, i) in enumerate(best)]
            assert sorted(got[q]) == expected, q
    assert 100 not in got and 300 not in got
    assert ann_tree.nearest_neighbours(vectors.limit(0)).count() == 0


# ------------------------------------------------------------------------ URLs


def slow_listed(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        r
        for r in URL_RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return host, path, max(fits, key=lambda r: len(r.host + r.path), default=None)


def test_listed_rules(spark, folder):
    urls = [r[0] for r in duckdb.execute(f"SELECT url FROM '{folder}/pages.parquet'").fetchall()]
    urls += [
        None, "", "org/", "http://", "http://ORG/x", "http://a.org", "http://aorg/", "x://b.com/de/?q",
        "http://example.org/en/1", "http://m.Example.org/en/12?x=://y", "http://example.org/es/#a/b",
        "http://u.com/fr/a\nb", "a\nb://h.org/", "http://com?/fr/", "://org/", "http://İ.com/de/",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn(
        "rule", F.lit("clash")
    )
    got = {r.page_id: r for r in url_rules.judge_urls(pages, URL_RULES, []).collect()}
    for i, url in enumerate(urls):
        host, path, rule = slow_listed(url)
        assert (got[i].host, got[i].path) == (host, path), url
        assert got[i].rule == (rule and rule.host + rule.path), url
        assert got[i].verdict == (rule.verdict if rule else "allow"), url


def test_mined_rules(spark):
    rows = [(f"http://s{i % 3}.spam.biz/win/{i}?id=1", "block") for i in range(40)]
    rows += [(f"http://s{i % 3}.news.biz/win/{i}", "allow") for i in range(40)]
    rows += [("http://x.y/", None), (None, "block")]
    rules = url_rules.mine_rules(spark.createDataFrame(rows, "url string, label string"))
    assert all(r.confidence >= 0.8 and r.support >= 0.01 for r in rules)
    asked = spark.createDataFrame(
        [(1, "http://other.spam.biz/a"), (2, "http://news.biz/win"), (3, "http://q.r/"), (4, None)],
        "page_id long, url string",
    )
    got = url_rules.judge_urls(asked, [], rules, default="allow")
    assert plain(got, "page_id", "verdict") == [(1, "block"), (2, "allow"), (3, "allow"), (4, "allow")]
    assert url_rules.mine_rules(spark.createDataFrame([], "url string, label string")) == []


def test_no_rule_is_lost_to_a_limit(spark):
    """A rule of five tokens, and one less sure than thousands of redundant ones."""
    five = "abcde"
    rows = [("x://y/" + "/".join(five), "block")] * 20
    rows += [("x://y/" + "/".join(five.replace(c, "")), "allow") for c in five for _ in range(10)]
    rows += [(f"x://g{g}/" + "/".join(f"t{g}x{i}" for i in range(8)), "block") for g in range(20) for _ in range(5)]
    rows += [("x://weak/", "block")] * 18 + [("x://weak/", "allow")] * 2
    rules = url_rules.mine_rules(spark.createDataFrame(rows, "url string, label string"))
    found = {(r.tokens, r.verdict): r.confidence for r in rules}
    assert found[frozenset({"h:weak"}), "block"] == 0.9
    assert found[frozenset(f"p:{c}" for c in five), "block"] == 1.0
    assert all(len(r.tokens) == 1 for r in rules if r.tokens & {"h:g0", "p:t0x0"})
    (of_g0,) = (r for r in rules if "h:g0" in r.tokens)
    assert of_g0.choices() == [{"h:g0", *(f"p:t0x{i}" for i in range(8))}]
    for r in rules:
        assert not any(s.tokens < r.tokens and s.verdict == r.verdict and s.confidence >= r.confidence for s in rules)


def slow_rules(rows, least, min_confidence=0.8):
    """Confidence of all rules that are surer than each part of theirs, by tokens and label."""
    urls = [(frozenset(tokens), label) for tokens, label in rows]
    every = {frozenset(c) for tokens, _ in urls for n in range(1, len(tokens) + 1) for c in combinations(sorted(tokens), n)}
    sure = {}
    for tokens in every:
        of = [label for have, label in urls if tokens <= have]
        for label in set(of):
            if of.count(label) >= least:
                sure[tokens, label] = of.count(label) / len(of)
    return {
        (t, label): c
        for (t, label), c in sure.items()
        if c >= min_confidence
        and not any(sure[p, m] >= c for p, m in sure if m == label and p < t)
    }


def one_by_one(rules):
    """Each choice of tokens of each rule."""
    return {(frozenset(c), r.verdict): r.confidence for r in rules for c in product(*r.choices())}


def test_mined_rules_against_brute_force(spark):
    rng = random.Random(8)
    for _ in range(4):
        rows = []
        for _ in range(60):
            words = {w for w in "abcdef" if rng.random() < 0.5} | {"always"}
            words |= {"b2"} if "b" in words else set()
            words |= {"sure"} if rng.random() < 0.2 else set()
            label = "block" if "sure" in words or ("a" in words and "c" in words) or rng.random() < 0.2 else "allow"
            rows.append((sorted(words), label))
        urls = [(f"://h/{'/'.join(words)}", label) for words, label in rows]
        rules = url_rules.mine_rules(spark.createDataFrame(urls, "url string, label string"), min_support=0.1)
        named = [(["h:h", *(f"p:{w}" for w in words)], label) for words, label in rows]
        # What brute force takes for two rules of one set of rows is one rule with choices.
        assert one_by_one(rules) == slow_rules(named, 6)


def test_many_shared_parameters(spark):
    """Forty parameters that URLs of two labels share are one token, not 2^40 combinations."""
    shared = "&".join(f"k{i}=v{i}" for i in range(40))
    rows = [(f"http://a.biz/win?{shared}", "block")] * 60 + [(f"http://a.biz/read?{shared}", "allow")] * 60
    rows += [("http://b.biz/win", "allow")] * 20
    rules = url_rules.mine_rules(spark.createDataFrame(rows, "url string, label string"))
    expected = slow_rules([(["p:win", "h:a"], "block"), (["p:read", "h:a"], "allow")] * 60 + [(["p:win", "h:b"], "allow")] * 20, 2)
    shape = {frozenset(min(c & {"p:win", "h:a", "p:read", "h:b"}, default="") for c in r.choices()): r for r in rules}
    assert {(t, r.verdict): r.confidence for t, r in shape.items() if "" not in t} == expected
    both = shape[frozenset({"p:win", "h:a"})]
    assert {f"q:k{i}" for i in range(40)} <= set().union(*both.choices())
    long = "&".join(f"x{i}=y" for i in range(20_000))
    asked = [(1, f"http://a.biz/win?{long}"), (1, f"http://a.biz/win?{long}"), (2, "http://z.z/win?k7=v7")]
    pages = spark.createDataFrame(asked, "page_id long, url string")
    got = url_rules.judge_urls(pages, [], rules)
    assert plain(got, "page_id", "verdict") == [(1, "block"), (1, "block"), (2, "block")]
    assert url_rules.judge_urls(pages.limit(0), URL_RULES, rules).count() == 0


def test_index_finds_the_best_rule_of_all():
    rng = random.Random(2)
    for _ in range(200):
        rules = sorted(
            (
                url_rules.MinedRule(frozenset(rng.sample("abcdef", rng.randint(1, 3))), rng.choice(["x", "y"]), rng.random(), 0.1)
                for _ in range(8)
            ),
            key=url_rules.MinedRule.rank,
        )
        index, tokens = url_rules.RuleIndex(rules, "none"), set(rng.sample("abcdef", 4))
        assert index.verdict(tokens) == next((r.verdict for r in rules if r.tokens <= tokens), "none")


# -------------------------------------------------------------- decontamination


def slow_contamination(texts, items, window=10):
    windows = {}
    for item, text in items:
        words = decontaminate.words_of(text)
        width = min(window, len(words))
        for i in range(len(words) - width + 1 if width else 0):
            windows.setdefault(tuple(words[i : i + width]), set()).add(item)
    out = []
    for text in texts:
        words = decontaminate.words_of(text)
        hit, found = [0] * len(words), set()
        for width in {len(w) for w in windows}:
            for p in range(len(words) - width + 1):
                key = tuple(words[p : p + width])
                if key in windows:
                    found |= windows[key]
                    hit[p : p + width] = [1] * width
        out.append((len(words), sum(hit), sorted(x for x in found if x is not None)))
    return out


def noisy_items(seed):
    rng = random.Random(seed)
    signs = [b"a", b"b", b"c", b"d"]
    items = [
        (rng.choice([1, 2, 3, None]), b" ".join(rng.choices(signs, k=rng.choice([0, 1, 2, 9, 10, 11, 14]))))
        for _ in range(rng.choice([0, 1, 5]))
    ]
    if seed % 2:
        items = [x for x in items if len(x[1].split()) > 6]
    texts = [
        b"x,A" + b". ".join(rng.choices(signs + [b"zz"] * (seed % 3), k=rng.choice([0, 1, 5, 40])))
        for _ in range(4)
    ]
    return texts + [b"x " + t + b" " + t for _, t in items], items


def test_suffix_arrays_against_brute_force():
    for seed in range(250):
        texts, items = noisy_items(seed)
        got = decontaminate.TestSuffixes(items).search(texts)
        assert [g[:3] for g in got] == slow_contamination(texts, items), seed
        for (n, hit, _, spans, longest), text in zip(got, texts):
            assert sum(s[1] for s in spans) == hit
            if longest:
                words = decontaminate.words_of(text)
                part = words[longest["start"] : longest["start"] + longest["length"]]
                sources = [decontaminate.words_of(t) for i, t in items if i == longest["item_id"]]
                at = longest["item_start"]
                assert any(s[at : at + longest["length"]] == part for s in sources)


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_contamination_in_blocks(spark, odd_docs, block):
    items = [(1, "one two three"), (1, "one two three"), (2, " ".join("abcdefghijkl")), (None, "four"), (3, None), (4, "")]
    items += [(9, "12 34"), (10, "lorem ipsum dolor sit amet lorem ipsum dolor sit amet lorem")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("n_hit", F.lit(1))
    found = decontaminate.find_contamination(odd_docs, benchmark, block_bytes=block)
    expected = []
    for r in odd_docs.collect():
        ((n, hit, names),) = slow_contamination(
            [(r.text or "").encode()], [(i, t.encode()) for i, t in items if t is not None]
        )
        expected.append((r.doc_id, n, hit, names))
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    kept = decontaminate.drop_contaminated(odd_docs, benchmark, block_bytes=block)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 6]
    assert decontaminate.find_contamination(odd_docs.limit(0), benchmark).count() == 0
    clean = decontaminate.find_contamination(odd_docs, benchmark.limit(0))
    assert clean.where("n_hit = 0").count() == 9


# ------------------------------------------------------------ queries, pipeline


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, folder, name):
    from oracle import connect, differences

    with connect(folder) as connection:
        assert differences(QUERIES[name](spark, folder), connection, ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = corpus_pipeline.identify(spark, docs, folder)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    good = corpus_pipeline.classify(spark, docs, folder)
    assert good.columns == docs.columns
    gone = labels.join(good, "doc_id", "left_anti")
    assert gone.where("quality = 1").count() <= 0.03 * labels.where("quality = 1").count()
    single = corpus_pipeline.deduplicate(spark, docs, folder)
    classes = QUERIES["op5_simhash"](spark, folder).select("component_id").distinct()
    assert plain(single, "doc_id") == plain(classes)
    clean = corpus_pipeline.decontaminate(spark, docs, folder)
    hits = QUERIES["op10_decontamination"](spark, folder).where("contaminated")
    assert clean.columns == docs.columns
    assert plain(clean, "doc_id") == plain(docs.join(hits, "doc_id", "left_anti"), "doc_id")
    ids = corpus_pipeline.tokenize(spark, docs, folder).join(docs, "doc_id")
    for r in ids.limit(50).collect():
        assert r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_pipeline_is_its_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, folder)
        if "text" in docs.columns:
            docs = spark.createDataFrame(docs.toArrow())
    got = corpus_pipeline.run(spark, folder)
    assert plain(got, "doc_id", "n_tokens") == plain(docs, "doc_id", "n_tokens")


def test_pipeline_of_odd_documents(spark, odd_docs, folder):
    docs = odd_docs.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text"))
    for _, step in corpus_pipeline.STAGES:
        out = step(spark, docs, folder)
        assert step(spark, docs.limit(0), folder).count() == 0
        assert out.count() <= docs.count()
