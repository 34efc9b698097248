"""Shuffling operators and the pipeline against brute force, and odd inputs."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from turnstile.llm import decontaminate, jaccard_join, pii, quality, queries, substring_dedup, topk, url_reputation

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, id string, n int, node long, block long, token string"


def docs_of(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, "y") for i, t in pairs], DOCS)


def by_row(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# -- n-gram Jaccard join ------------------------------------------------------------------


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute_components(pairs):
    """One (id, n, component) for each row; rows are nodes."""
    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    names = defaultdict(list)
    for i, (doc, _) in enumerate(pairs):
        if doc is not None:
            names[find(i)].append(doc)
    return by_row((doc, len(sets[i]), min(names[find(i)], default=None)) for i, (doc, _) in enumerate(pairs))


def family(rnd, base, copies, edits):
    """Copies of a word list with some words replaced."""
    out = []
    for _ in range(copies):
        words = base[:]
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(len(words))] = f"new{rnd.randint(0, 10**6)}"
        out.append(" ".join(words))
    return out


def test_join_equals_all_pairs_on_families(spark):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(200)]
    texts = []
    for edits in (1, 2, 4, 8):
        texts += family(rnd, [rnd.choice(vocabulary) for _ in range(120)], 25, edits)
    line = " ".join(rnd.choice(vocabulary) for _ in range(30))  # shared by many that are else unlike
    texts += [" ".join([line, *(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 15)))]) for _ in range(40)]
    texts += ["a b c", "A b\tC", "a b c d", "a", "", None, " \n ", "é b c d e f", "É b c d e f"]
    pairs = list(enumerate(texts, 10))
    rnd.shuffle(pairs)
    got = by_row(jaccard_join.jaccard_components(docs_of(spark, pairs)).collect())
    assert got == brute_components(pairs)
    assert len({c for _, _, c in got}) < len(pairs) - 60


def test_join_group_bound_is_below_every_member_pair():
    sizes, cases = range(20, 60), []
    for low in sizes:
        for high in range(low, min(60, low + 12)):
            cases += [(low, high, other) for other in sizes if high * 100 >= other * 80 and other * 100 >= low * 80]
    cases += [(90, 100, 90)]
    rows = [(t, g, g, a, b, True, 1000) for t, (low, high, other) in enumerate(cases) for g, a, b in ((2 * t, low, high), (2 * t + 1, other, other))]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["token", "grp", "node", "low", "high", "many", "rest"])
    need = {a // 2: n for out in jaccard_join._meetings(iter([batch])) for a, n in zip(out.column(0).to_pylist(), out.column(2).to_pylist())}
    assert len(need) == len(cases)
    for t, (low, high, other) in enumerate(cases):
        least = min(int(jaccard_join._need(n, other)) for n in range(low, high + 1))
        assert least - 1 <= need[t] <= least and (low < high or need[t] == least), cases[t]


def star_of(spark, monkeypatch, links):
    """The (id, id) links as stars, whatever the min-hashes say."""

    def stars(join):
        ids = join.nodes.select("node", "id")
        pairs = spark.createDataFrame(links, "x long, y long")
        pairs = pairs.join(ids.toDF("a", "x"), "x").join(ids.toDF("b", "y"), "y")
        return join.links(pairs.select("a", "b"))

    monkeypatch.setattr(jaccard_join.Join, "stars", stars)


def test_join_group_without_its_centre(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    versions = [" ".join(words[20 * i : 20 * i + 200]) for i in range(4)]  # only neighbours link
    pairs = list(enumerate(versions, 10))
    assert {c for _, _, c in brute_components(pairs)} == {10}
    star_of(spark, monkeypatch, [(11, 12), (12, 13)])  # 11 stands in the group of 12, which stands in that of 13
    assert by_row(jaccard_join.jaccard_components(docs_of(spark, pairs)).collect()) == brute_components(pairs)


def test_join_equals_all_pairs_on_chains(spark):
    rnd = random.Random(6)
    pairs = []
    for chain in range(12):
        words = [f"c{chain}w{i}" for i in range(400)]
        step = rnd.choice([8, 14, 20])
        pairs += [(100 * chain + k, " ".join(words[step * k : step * k + 200])) for k in range(10)]
        pairs += [(100 * chain + 50 + k, t) for k, t in enumerate(family(rnd, words[:200], 6, 6))]
    rnd.shuffle(pairs)
    assert by_row(jaccard_join.jaccard_components(docs_of(spark, pairs)).collect()) == brute_components(pairs)


def test_join_compares_few_pairs_of_a_large_family(spark, monkeypatch):
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    pairs = list(enumerate(family(rnd, base, 240, 4), 10))
    made, links, meetings, met = [], jaccard_join.Join.links, jaccard_join._meetings, spark.sparkContext.accumulator(0)

    def counted_links(join, pairs):
        pairs = pairs.select("a", "b").distinct().cache()
        made.append(pairs.count())
        return links(join, pairs)

    def counted_rows(rows):
        for out in meetings(rows):
            met.add(out.num_rows)
            yield out

    monkeypatch.setattr(jaccard_join.Join, "links", counted_links)
    monkeypatch.setattr(jaccard_join, "_meetings", counted_rows)
    got = by_row(jaccard_join.jaccard_components(docs_of(spark, pairs)).collect())
    assert got == brute_components(pairs)
    assert sum(made) < 10 * len(pairs) and met.value < 10 * len(pairs), (made, met.value)  # of 28,680 pairs


def test_join_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    pairs = [(1, "one two three four five six"), (1, "one two three four five six"), (None, "one two three four five six"), (None, "quite alone here"), (5, None), (5, ""), (None, None), (7, long), (8, long + " end"), (9, "x"), (9, "y"), (3, "y")]
    got = by_row(jaccard_join.jaccard_components(docs_of(spark, pairs)).collect())
    assert got == by_row([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 1, None), (5, 0, 5), (5, 0, 5), (None, 0, None), (7, 29_996, 7), (8, 29_997, 7), (9, 1, 9), (9, 1, 3), (3, 1, 3)])
    assert jaccard_join.jaccard_components(docs_of(spark, [])).count() == 0


def test_one_row_of_each_with_repeated_ids(spark):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(100)]
    near = " ".join([*words, "end"])
    pairs = [(9, "x"), (9, "y"), (3, "y"), (5, None), (5, ""), (5, ""), (6, " "), (None, "y"), (None, None), (7, "Z"), (7, "z"), (8, " ".join(words)), (8, near), (8, "of its own"), (4, near.upper()), (2, "p q"), (1, "p  q"), (2, "r"), (2, "r")]
    rnd.shuffle(pairs)
    for frame in (docs_of(spark, pairs), docs_of(spark, pairs).repartition(3)):
        out = corpus_pipeline.near_duplicates_stage(spark, frame, SF)
        assert out.columns == frame.columns
        got = by_row((r.doc_id, r.text and r.text.lower().split()) for r in out.collect())
        assert got == by_row([(9, ["x"]), (3, ["y"]), (5, None), (5, ""), (6, []), (None, ["y"]), (None, None), (7, ["z"]), (8, "of its own".split()), (4, near.split()), (1, ["p", "q"]), (2, ["r"])])
    assert corpus_pipeline.near_duplicates_stage(spark, docs_of(spark, []), SF).count() == 0


def test_jaccard_frequent_tokens_are_no_rows_of_the_driver(spark, monkeypatch):
    """The order's list of frequent tokens comes as arrays; of everything else the driver sees counts."""
    stem = " ".join(f"w{i}" for i in range(60))
    pairs = [(i, f"{stem} " + " ".join(f"x{i}_{j}" for j in range(i % 5))) for i in range(30)]
    frame, seen = type(spark.range(0)), []
    collect = frame.collect

    def counted(self):
        out = collect(self)
        seen.append(len(out))
        return out

    monkeypatch.setattr(frame, "collect", counted)
    named = jaccard_join.jaccard_components(docs_of(spark, pairs))
    monkeypatch.undo()
    assert by_row(named.collect()) == brute_components(pairs)
    assert max(seen, default=0) <= 1


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60, 100)]
    star = [(7, i) for i in range(8, 40)]
    rows = spark.createDataFrame(chain + [(b, a) for a, b in star] + star[:3], "a long, b long")
    got = {r.node: r.component for r in jaccard_join.components(rows).collect()}
    assert got == {i: 60 for i in range(60, 101)} | {i: 7 for i in range(7, 40)}


def test_op3_whole_table(spark):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert by_row(queries.QUERIES["op3_jaccard_join"](spark, SF).collect()) == brute_components(pairs)


# -- substring dedup ----------------------------------------------------------------------


def brute_kept(pairs, window=20):
    """Rows in document order (null first) to (id, kept text, words, removed)."""
    seen, out = set(), []
    for doc, text in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0)):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in seen:
                gone[p : p + window] = [True] * window
            seen.add(key)
        out.append((doc, " ".join(w for w, g in zip(words, gone) if not g), len(words), sum(gone)))
    return by_row(out)


@pytest.mark.parametrize("block", [300, 5000, 10**7])
def test_dedup_equals_brute_force(spark, block):
    rnd = random.Random(8)
    passages = [[rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(rnd.randint(15, 60))] for _ in range(6)]
    pairs = []
    for i in range(60):
        words = []
        for _ in range(rnd.randint(0, 4)):
            words += rnd.choice([rnd.choice(passages), [rnd.choice("xyz")] * rnd.randint(1, 50), [f"u{rnd.randint(0, 10**6)}" for _ in range(10)], ["p", "q"] * rnd.randint(1, 30)])
        pairs.append((i, rnd.choice([" ", "\n", "\u00a0 "]).join(words)))
    pairs += [(100, None), (101, ""), (102, " \t"), (None, " ".join(passages[0])), (103, "w " * 30_000)]
    rnd.shuffle(pairs)
    got = by_row(substring_dedup.dedup(docs_of(spark, pairs).coalesce(3), block_chars=block).collect())
    assert got == brute_kept(pairs)


def test_dedup_of_equal_rows_keeps_one(spark):
    text = " ".join(f"w{i}" for i in range(25))
    got = sorted(r.n_removed for r in substring_dedup.dedup(docs_of(spark, [(1, text)] * 4).repartition(3)).collect())
    assert got == [0, 25, 25, 25]
    assert substring_dedup.dedup(docs_of(spark, [])).count() == 0


def test_op8_whole_table(spark):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = by_row((i, n, gone, hashlib.sha256(text.encode()).hexdigest()) for i, text, n, gone in brute_kept(pairs))
    assert by_row(queries.QUERIES["op8_substring_dedup"](spark, SF).collect()) == want


# -- exact top-k --------------------------------------------------------------------------


def brute_top(rows, k, is_query):
    usable = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in usable:
        if is_query(i):
            asked[i, len(v)] = min(asked.get((i, len(v)), v), v)
    out = []
    for (i, dim), q in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == dim)
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return by_row(out)


@pytest.mark.parametrize("block", [4, 64, 1024])
def test_top_k_equals_brute_force(spark, block):
    rng = np.random.default_rng(2)
    same = [0.5, -0.25, 0.125]
    rows = [(i, [float(x) for x in rng.normal(size=3) * rng.choice([0.1, 1, 30])]) for i in range(150)]
    rows += [(i, same) for i in range(150, 230)]  # ties
    rows += [(300, None), (301, [1.0, None, 2.0]), (302, [float("nan"), 1.0, 1.0]), (303, [float("inf"), 0.0, 0.0]), (None, same), (304, []), (310, [1.0] * 5), (320, [2.0] * 5), (5, same), (50, same)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, dim string")
    got = topk.top_k(frame, F.col("id") % 10 == 0, k=4, item_block=block, query_block=7)
    assert by_row(got.collect()) == brute_top(rows, 4, lambda i: i % 10 == 0)
    assert topk.top_k(frame.limit(0), F.col("id") % 10 == 0).count() == 0


def test_op7_equals_duckdb(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(queries.ORACLE_SQL["op7_topk"]).fetchall()
    assert by_row(queries.QUERIES["op7_topk"](spark, SF).collect()) == by_row(want)


# -- url filter ---------------------------------------------------------------------------


def test_op10_equals_duckdb(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL["op10_url_reputation"]).fetchall()
    assert by_row(queries.QUERIES["op10_url_reputation"](spark, SF).collect()) == by_row(want)


def test_urls_rules_and_reputation(spark):
    urls = ["HTTP://Blog.EXAMPLE.org/es/1?x#y", "http://example.org/en/12", "http://example.org/en/2", "http://a.com/de/", "a.com/de/", None, "", "x://y.com", "http://notexample.org/es/", "http://bad.net/a", "http://bad.net/b", "http://good.net:80/a?b://c.com/", "http://ÄB.net/", "http://bad.net/a"]
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)] + [(9, urls[9], "h", "p"), (None, "http://bad.net/", "h", "p")], "page_id long, url string, host string, rule string")
    labels = spark.createDataFrame([(9, 0)] * 30 + [(10, 0)] * 30 + [(11, 1)] * 40 + [(12, 1)] * 20 + [(2, 1)] * 20 + [(None, 0), (3, None), (99, 0), (4, 7)], "doc_id long, quality int")
    got = {(r.page_id, r.host): tuple(r)[2:] for r in url_reputation.judge(pages, labels).collect()}
    assert got[0, "blog.example.org"] == ("/es/1", "example.org/es/", "block")
    assert got[1, "example.org"] == ("/en/12", "example.org/en/1", "block")
    assert got[2, "example.org"] == ("/en/2", "org/", "allow")
    assert got[3, "a.com"] == ("/de/", "com/de/", "block")
    assert got[4, ""][:2] == got[5, ""][:2] == got[6, ""][:2] == ("", None)
    assert got[7, "y.com"] == ("", None, "allow")
    assert got[8, "notexample.org"][1:] == ("org/", "allow")
    assert got[9, "bad.net"][1:] == got[None, "bad.net"][1:] == (None, "block")
    assert got[11, "good.net:80"] == ("/a", None, "allow") and (12, "Äb.net") in got
    assert url_reputation.judge(pages, labels).count() == len(urls) + 2
    assert url_reputation.judge(pages.limit(0), labels).count() == 0
    assert {r.verdict for r in url_reputation.judge(pages, labels.limit(0)).collect()} == {"allow", "block"}


# -- pipeline -----------------------------------------------------------------------------


def test_pipeline_equals_its_stages_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    model = quality.trained(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = quality.score_texts([r.text or "" for r in rows], *model)
    left = [r for r, s in zip(rows, scores) if s >= quality.THRESHOLD]
    component = {i: c for i, _, c in brute_components([(r.doc_id, r.text) for r in left])}
    left = [r for r in left if component[r.doc_id] == r.doc_id]
    items = [(r.item_id, decontaminate.normal(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    matcher = decontaminate.Matcher(items, decontaminate.RATE)
    left = [r for r in left if not matcher.matches(decontaminate.normal(r.text or ""))]
    crf = pii.fit(spark.createDataFrame(left, docs.schema))
    want = {r.doc_id: pii.masked(r.text or "", sum(pii.find(r.text or "", crf), [])) for r in left}
    got = {r.doc_id: r.text for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 0 < len(got) < len(rows)


def test_stages_keep_the_columns_and_odd_rows(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "words of a plain text here, all of it clean.", None, "s", 1), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "mail me: joe@example.com now", "en", "s", 29)], schema)
    assert corpus_pipeline.STAGES[0][0] == "quality" and len(corpus_pipeline.STAGES) == 5
    for frame in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            out.collect()
            assert name == "encoding" or out.columns == schema.names, name
    masked = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.personal_data_stage(spark, odd.filter("doc_id = 3"), SF).collect()}
    assert masked == {3: ("mail me: <email> now", 20)}
