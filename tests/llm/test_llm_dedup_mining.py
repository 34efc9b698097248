"""Suffix dedup, hard negatives and periodic runs against brute force."""

import random
import zlib
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from turnstile.llm import hard_negatives, induced_sort, periodic_runs, suffix_dedup

SF = "/root/testdata/sf0.001"


def _table(spark, tmp_path, data, schema, name="t"):
    """A table in several files: read the same way each time."""
    path = str(tmp_path / name)
    spark.createDataFrame(data, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


# -- induced sorting ------------------------------------------------------------------------

def _suffixes(text, cap):
    order = sorted(range(len(text)), key=lambda i: text[i:])
    shared = [0] * len(text)
    for j in range(1, len(text)):
        a, b = text[order[j - 1] :], text[order[j] :]
        while shared[j] < min(len(a), len(b), cap) and a[shared[j]] == b[shared[j]]:
            shared[j] += 1
    return order, shared


def test_induced_sort_equals_plain_sort(monkeypatch):
    """Random, periodic and constant texts, small and large alphabets; queues and arrays on disk and in memory."""
    rng = random.Random(11)
    for _ in range(600):
        sigma = rng.choice([1, 2, 3, 5, 50])
        text = [rng.randint(1, sigma) for _ in range(rng.randint(0, 70))]
        period = rng.randint(1, 6)
        if rng.random() < 0.4:
            for i in range(period, len(text)):
                text[i] = text[i - period] if rng.random() < 0.97 else text[i]
        text.append(0)
        monkeypatch.setattr(induced_sort, "BATCH", rng.choice([2, 7, 65536]))
        cap = rng.choice([3, 10, 100])
        got = induced_sort.sort_suffixes(np.array(text, rng.choice([np.uint16, np.int64])), sigma + 1, cap, rng.choice([3, 20, 10**6]), rng.choice([1, 4, 1000]))
        assert tuple(list(x) for x in got) == _suffixes(text, cap), text


# -- suffix dedup ---------------------------------------------------------------------------

def _brute_dedup(docs, window):
    """(id, bytes, removed, stretches, kept) of rows in the order of their ids."""
    seen, out = set(), []
    for key, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for a in range(len(raw) - window + 1):
            if raw[a : a + window] in seen:
                gone[a : a + window] = b"\1" * window
            else:
                seen.add(raw[a : a + window])
        starts = sum(1 for j in range(len(raw)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((key, len(raw), sum(gone), starts, bytes(c for c, g in zip(raw, gone) if not g)))
    return sorted(out, key=repr)


def _dedup_rows(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("window", "options"), [
    (20, {"block_chars": 300, "chunk": 100, "budget": 40}),
    (40, {"block_chars": 1000, "chunk": 10**6}),
    (100, {}),
])
def test_suffix_dedup_equals_brute_force(spark, tmp_path, window, options):
    rng = random.Random(window)
    base = ["".join(rng.choice("abé ") for _ in range(rng.randint(10, 300))) for _ in range(5)]
    docs = []
    for i in range(40):
        text = "".join(rng.choice(base)[rng.randint(0, 30) : rng.randint(40, 300)] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 5)))
        docs.append((i, rng.choice([text, text, text, text, None, "", "abc" * rng.randint(1, 120), "x" * 500, docs[-1][1] if docs else ""])))
    got = _dedup_rows(suffix_dedup.dedup(_table(spark, tmp_path, docs, "doc_id long, text string"), window=window, **options))
    want = _brute_dedup(docs, window)
    assert got == want and sum(r[2] for r in want) > 0


def test_suffix_dedup_odd_rows(spark, tmp_path):
    passage = "a passage of more than one hundred bytes that several rows hold, once in full and once with an end " * 2
    docs = [(None, passage, 1), (3, passage + "x", 2), (3, passage + "y", 3), (7, passage, 4), (7, passage, 5), (8, None, 6), (None, None, 7), (9, "short", 8), (9, "short", 9)]
    df = _table(spark, tmp_path, docs, "doc_id long, text string, id int").withColumns({c: F.lit(1) for c in ("anchor", "block", "data", "at", "n", "kept")})
    got = _dedup_rows(suffix_dedup.dedup(df))
    assert [r[:3] for r in got if r[0] in (7, 8, 9)] == [(7, 198, 198), (7, 198, 198), (8, 0, 0), (9, 5, 0), (9, 5, 0)]
    # The null id comes first and stays but for its own repeated half.
    whole = dict((r[0], r) for r in _brute_dedup([(None, passage), (3, passage + "x")], 100))
    assert (None, *whole[None][1:]) in got
    assert suffix_dedup.dedup(df.filter("false")).count() == 0
    # One text larger than every bound, most of it one stretch.
    long = [(1, "0123456789" * 30_000 + passage), (2, passage)]
    rows = _dedup_rows(suffix_dedup.dedup(_table(spark, tmp_path, long, "doc_id long, text string", "long"), block_chars=1000, chunk=1000, budget=5000))
    assert [r[2] for r in rows] == [300_000 - 109 + 99, 198] and rows[0][3] == 1


def test_suffix_dedup_query(spark):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op11_suffix_dedup(spark, SF).collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {r[0]: (*r[1:4], sha256(r[4]).hexdigest()) for r in _brute_dedup(docs, 100)}
    assert got == want and any(r[1] for r in want.values())


# -- hard negatives -------------------------------------------------------------------------

def test_strassen_is_exact():
    rng = np.random.default_rng(5)
    for n, k, m, top in ((1, 1, 1, 9), (65, 33, 70, 10**3), (40, 129, 37, 2**25), (7, 64, 300, 2**28), (90, 90, 90, 2**27)):
        a, b = rng.integers(-top, top, (n, k)), rng.integers(-top, top, (k, m))
        for leaf in (1, 8, 32)[n * m > 300 :]:
            assert (hard_negatives.strassen(a, b, leaf) == (a.astype(object) @ b.astype(object))).all()
    huge = np.full((2, 3), 2**62)
    assert hard_negatives.scores(huge, huge).tolist() == [[2**63 - 1] * 2] * 2


def _brute_negatives(rows, step, n_positive=5, n_negative=3, scale=256):
    """Rows (id, label, vector) that take part; the anchors are those whose id ``step`` divides."""
    rows = [(i, l, [int(np.floor(scale * x)) for x in v]) for i, l, v in rows]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out, asked = [], {}
    for i, l, v in sorted((r for r in rows if r[0] % step == 0), key=lambda r: (r[0], len(r[2]), r[1], r[2])):
        asked.setdefault(i, (l, v))
    for i, (l, v) in asked.items():
        others = [(-dot(v, w), j, m) for j, m, w in rows if j != i and len(w) == len(v)]
        for s, j, _ in sorted(o for o in others if o[2] == l)[:n_positive]:
            inside = sorted(o for o in others if o[2] != l and 50 * -s <= 100 * -o[0] <= 95 * -s)[:n_negative]
            out += [(i, j, rank, o[1], -s, -o[0]) for rank, o in enumerate(inside, 1)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark, tmp_path):
    """Ties, equal vectors, repeated ids, two lengths, negative scores, rows that take no part; one cell and many."""
    rng = random.Random(3)
    rows = [(rng.randrange(60), rng.randrange(3), [rng.choice([-1.0, 0.0, 0.3, 0.5, 1.0]) for _ in range(rng.choice([4, 4, 5]))]) for _ in range(150)]
    nan = float("nan")
    odd = [(None, 1, [1.0] * 4), (5, None, [1.0] * 4), (10, 1, None), (10, 1, [1.0, None, 1.0, 1.0]), (10, 1, [nan, 1.0, 1.0, 1.0]), (10, 1, [float("inf")] * 4), (20, 1, [])]
    schema = "vec_id long, label int, embedding array<double>"
    df = _table(spark, tmp_path, rows + odd, schema).withColumns({c: F.lit(0) for c in ("id", "dim", "v", "slot", "a_cell")})
    want = _brute_negatives(rows, 5)
    assert want
    for group_bytes in (32 << 20, 300):
        got = hard_negatives.mine(df, F.col("id") % 5 == 0, group_bytes=group_bytes)
        assert sorted(map(tuple, got.collect())) == want
    assert hard_negatives.mine(df.filter("false"), F.col("id") % 5 == 0).count() == 0
    assert hard_negatives.mine(df.filter("vec_id is null or embedding is null"), F.col("id") % 5 == 0).count() == 0


def test_hard_negatives_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    got = sorted(map(tuple, hard_negatives.op12_hard_negatives(spark, SF).collect()))
    assert got and got == sorted(con.execute(hard_negatives.ORACLE).fetchall())


# -- periodic runs --------------------------------------------------------------------------

def _brute_runs(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(8)
    for _ in range(1500):
        docs = []
        for _ in range(rng.randint(1, 4)):
            a, n = rng.choice([1, 2, 2, 3, 5, 20]), rng.randint(0, 110)
            words = [rng.randrange(a) for _ in range(n)]
            if n and rng.random() < 0.7:
                p, s = rng.randint(1, 40), rng.randrange(n)
                for i in range(s + p, min(n, s + 6 * p)):
                    words[i] = words[i - p]
            if n > 30 and rng.random() < 0.3:
                b = rng.randint(5, 15)
                words = (words[:b] * 3 + [99] + words[:b] * 3 + [98]) * 3
            docs.append(words)
        least = rng.choice([2, 5, 12, 13])
        got = periodic_runs.runs_of(np.array(sum(docs, []), np.int64), np.array([len(d) for d in docs]), least)
        assert got == [_brute_runs(d, least) for d in docs], docs


def test_one_word_a_long_time_is_one_run():
    """What would be every pair of words: one word, and one word with another now and then."""
    assert periodic_runs.runs_of(np.zeros(400_000, np.int64), np.array([400_000])) == [[(0, 400_000, 1)]]
    (runs,) = periodic_runs.runs_of(np.array(([0] * 500 + [1]) * 300), np.array([150_300]))
    assert len(runs) == 301 and (0, 150_300, 501) in runs


def _digest(key, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(key).encode()) if key is not None else 1, len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (
        key, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def test_periodic_runs_query(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    docs = [(None, "a b " * 20), (None, None), (1, ""), (1, "x " * 40), (1, "x " * 40)]
    docs += [(i, " ".join(rng.choice(["é", "b", "c d", "\t\n"]) for _ in range(rng.randint(0, 90)))) for i in range(2, 60)]
    folder = tmp_path / "documents.parquet"
    spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "runs", "n_words")}).write.parquet(str(folder))
    got = periodic_runs.op13_periodic_runs(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((_digest(*d) for d in docs), key=repr)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs) > 2
    whole = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 4000").select("doc_id", "text").collect()
    rows = {r.doc_id: tuple(r) for r in periodic_runs.op13_periodic_runs(spark, SF).collect()}
    assert all(rows[d.doc_id] == _digest(d.doc_id, d.text) for d in whole) and len(whole) > 100
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.collapse(empty).count() == 0


# -- main text ------------------------------------------------------------------------------

LONG = "This is a paragraph of the article with a good many words in it, as one would expect. " * 3
ARTICLE = f"<article><h1>Head</h1><p>{LONG}</p>%s<p>End.</p></article>"


@pytest.mark.parametrize("furniture", [
    "<div id=comments><p>first</p><article class=comment-body><p>nice one</p></article></div>",
    "<aside><article><p>teaser</p></article></aside>", "<article class=comment><p>hi</p></article>", "<article class='post teaser'><p>hi</p></article>",
    "<p class=advert>Buy</p>", "<p class=cookie-notice>We use them</p>", "<ul><li class=comment>me</li></ul>",
    "<table class=sidebar><tr><td>x</td></tr></table>", "<div id=comments><p>a</p></div>", "<div id=sidebar>s</div>", "<div class='share-buttons'>Share</div>",
])
def test_main_text_leaves_furniture_in_and_beside_the_article(furniture):
    from turnstile.llm.html_text import main_text

    for page in ("<body>" + ARTICLE % furniture, "<body>" + ARTICLE % "" + furniture, "<main>" + ARTICLE % furniture + "</main>", "<body><main>" + ARTICLE % "" + furniture + "</main>"):
        assert main_text(page).split("\n\n") == ["Head", LONG.strip(), "End."], page


def test_main_text_of_headers_and_unclosed_elements():
    import time

    from turnstile.llm.html_text import main_text

    assert main_text(f"<body><main><header>Site</header>{ARTICLE % ''}</main>").split("\n\n")[0] == "Head"
    assert main_text(f"<main><header><h1>Own</h1></header><p>{LONG}</p></main>").split("\n\n")[0] == "Own"
    assert main_text(f"<div class=comments>{ARTICLE % ''}").split("\n\n")[0] == "Head"  # never closed
    assert main_text("<table><tr><td>a<td>b<tr><td>c<table><tr><td>d</table><td>e</table><ul><li>f<li>g</ul>").split("\n\n") == list("abcdefg")
    began = time.monotonic()
    assert len(main_text("<table>" + "<tr><td>cell text<td>other" * 20_000)) == 20_000 * 18 - 2
    assert len(main_text("<div>x" * 60_000)) == 60_000 * 3 - 2
    assert time.monotonic() - began < 60
