"""Narrow operators: token counts, quality, decontamination, personal data, HTML, BPE. Brute force, round trips and odd inputs."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

os.environ["TOKENIZERS_PARALLELISM"] = "false"
from tokenizers import Tokenizer  # noqa: E402

import corpus_pipeline  # noqa: E402
from turnstile.llm import bpe, decontaminate, html_text, pii, quality, queries, token_count  # noqa: E402

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, id string, words string, score double"
ODD = [
    (1, "hello world", "x", "y", 1.0),
    (1, "hello world", "x", "y", 1.0),
    (2, None, None, None, None),
    (3, "", "", "", 0.0),
    (None, "no id", None, None, None),
    (4, " \n\t ", None, None, None),
    (5, "<|endoftext|> a<|endoftext|><|endoftext|>  b", None, None, None),
    (6, "café 漢字 \U0001f600 é  　 \x1c\x85", None, None, None),
    (7, "long " * 40_000 + "x" * 30_000, None, None, None),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def by_row(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_heap_counts_equal_the_library(library):
    rnd = random.Random(1)
    alphabet = " \n\t\r\x0b\x0c\x1c\x85\xa0 　ab'sreTé漢字0١٣12.,!<|endoftext|>́\U0001f600ſİ"
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) + rnd.choice(["", "<|endoftext|>", "<|endoftext"])
        assert token_count.count_text(text, PATH) == len(ids_of(library, text)), text


def test_merges_by_rank_then_place():
    ranks, made = {1 << 32 | 1: 0, 2 << 32 | 1: 1}, [2, 3]
    assert [token_count.merges_needed([1] * n, ranks, made) for n in range(6)] == [0, 0, 1, 2, 2, 3]


def test_token_counts_odd_rows(odd, none, library):
    got = by_row(token_count.token_counts(odd).collect())
    assert got == by_row((i, len((t or "").encode()), len(ids_of(library, t))) for i, t, *_ in ODD)
    assert token_count.token_counts(none).count() == 0


def test_op4_whole_table(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.QUERIES["op4_token_counts"](spark, SF).collect():
        n = len(ids_of(library, docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 512)


def test_bpe_ids_and_round_trip_of_odd_rows(odd, none, library):
    got = by_row((r.doc_id, tuple(np.frombuffer(r.ids, "<u4")), r.text) for r in bpe.decode(bpe.encode(odd)).collect())
    want = by_row((i, tuple(np.array(ids_of(library, t), "<u4")), library.decode(ids_of(library, t), skip_special_tokens=False)) for i, t, *_ in ODD)
    assert got == want
    assert bpe.decode(bpe.encode(none)).count() == 0


def test_bpe_blocks_do_not_hold_their_batches(monkeypatch):
    class Context:
        get = staticmethod(lambda: Context)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(bpe, "TaskContext", Context)
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array(["x" * (1 << 20)])], names=["id", "text"])
    held = []

    def batches():
        for _ in range(40):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            yield next(iter(pa.ipc.open_stream(sink.getvalue())))
            held.append(pa.total_allocated_bytes())

    blocks = list(bpe._blocks(batches(), 1 << 30))
    assert [len(ids) for _, ids, *_ in blocks] == [40]
    assert max(held) < held[0] + (8 << 20)


def test_pipeline_reads_texts_in_small_batches(spark, monkeypatch):
    batches, large = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    rows_of = bpe._word_rows

    def counted(*args):
        inside = rows_of(*args)

        def run(given):
            def seen():
                for batch in given:
                    batches.add(1)
                    large.add(int(batch.nbytes > 12 << 20))
                    yield batch

            yield from inside(seen())

        return run

    monkeypatch.setattr(bpe, "_word_rows", counted)
    docs = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2000).alias("text"))
    assert dict(corpus_pipeline.STAGES)["encoding"](spark, docs, SF).count() == 3000
    assert batches.value and not large.value  # of 30 MB


def test_pipeline_holds_few_texts_at_once(spark, tmp_path):
    """Every stage reads, writes and sends to Python some MB of texts; rows and texts are those given."""
    settings = ["spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize", "parquet.block.size"]
    rng = np.random.default_rng(3)
    texts = [rng.bytes(20_000).hex() for _ in range(1500)]  # 60 MB, 30 MB as Parquet
    pq.write_table(pa.table({"doc_id": pa.array(range(1500), pa.int64()), "text": texts}), tmp_path / "in.parquet", row_group_size=1500)
    for name, stage in corpus_pipeline.STAGES[1:3]:
        for key in settings:
            spark.conf.unset(key)
        out = stage(spark, spark.read.parquet(str(tmp_path / "in.parquet")).coalesce(1), SF)
        assert int(spark.conf.get(settings[1])) <= 512, name
        sizes = out.select("text").mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"size": [b.nbytes]}) for b in batches), "size long")
        assert max(r.size for r in sizes.collect()) <= 4 << 20, name
        out.coalesce(1).write.parquet(str(tmp_path / name))
        (file,) = (tmp_path / name).glob("*.parquet")
        groups = pq.ParquetFile(file).metadata
        assert max(groups.row_group(i).total_byte_size for i in range(groups.num_row_groups)) <= 40 << 20, name
        assert groups.num_row_groups > 1, name
        rows = pq.read_table(file)
        assert dict(zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist(), strict=True)) == dict(enumerate(texts)), name


@pytest.mark.parametrize("chars", [1, 3000, 10**7])
def test_bpe_blocks_of_any_size(spark, library, chars):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    rows = docs.collect()
    got = {r.doc_id: r.ids for r in bpe.encode(spark.createDataFrame(rows, docs.schema), block_chars=chars).collect()}
    assert got == {r.doc_id: np.array(ids_of(library, r.text), "<u4").tobytes() for r in rows}


def test_decode_of_any_ids(spark, library):
    lists = [[], [0], [50256, 50256], [220, 198, 198], [447, 95, 447], list(range(300))]
    rows = [(i, np.array(x, "<u4").tobytes()) for i, x in enumerate(lists)] + [(99, None)]
    got = {r.i: r.text for r in bpe.decode(spark.createDataFrame(rows, "i int, ids binary")).collect()}
    assert got == {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(lists)} | {99: ""}
    pieces = {r.id: bytes(r.piece) for r in bpe.pieces_table(spark, PATH).collect()}
    assert len(pieces) == 50257 and pieces[50256] == b"<|endoftext|>"
    ints = spark.createDataFrame(rows[:3], "i int, ids binary").select("i", bpe.as_ints(F.col("ids")).alias("x")).collect()
    assert {r.i: r.x for r in ints} == {0: [], 1: [0], 2: [50256, 50256]}


def test_op1_whole_table(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op1_bpe"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = ids_of(library, docs[r.doc_id])
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_quality_features_are_words_and_grams():
    for text in ("", " ", "a", "a a b", "  word one\n\nword", "x" * 50 + " é漢 " * 3):
        words = text.split()
        want = len(words) + sum(max(0, len(w) + 2 - k + 1) for w in words for k in quality.GRAMS)
        want += len(re.findall(r"(?<!\S)(?=(\S+)\s\1(?!\S))", text))
        assert len(quality.features(text)[1]) == want, text


def test_quality_scores_do_not_depend_on_neighbours():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=quality.BUCKETS).astype(np.float32)
    texts = ["a", "", "a a", "some words here", "b", " ", "z " * 200_000, "here some"]
    together = quality.score_texts(texts, weights, 0.1)
    alone = [quality.score_texts([t], weights, 0.1)[0] for t in texts]
    assert np.allclose(together, alone)


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.QUERIES["op2_quality"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    tested = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in tested) >= 0.93 * len(tested)


def test_quality_never_reads_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.trained(docs, labels), quality.trained(docs, turned)
    assert a[1] == b[1] and np.array_equal(a[0], b[0])


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 0), (None, 1), (7, None), (99, 1), (5, 7)], "doc_id long, quality int")
    model = quality.fit(odd, labels)
    scores = {(r.doc_id, r.text): r.score for r in quality.score(odd.drop("score"), model).collect()}
    assert len(scores) == len(ODD) - 1 and all(0 <= s <= 1 for s in scores.values())
    assert quality.fit(none, labels)[1] == 0 == quality.fit(odd, labels.limit(0))[1]
    assert quality.score(none, model, score_col="other").count() == 0


def test_quality_sample_is_held_compressed(spark):
    """The driver holds what the tasks send, not arrays of all documents at once; what it trains on is the same."""
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(800)]
    texts = {i: " ".join(rng.choice(words, 300)) for i in range(40)} | {40: "", 41: "a a"}
    docs = spark.createDataFrame([*texts.items(), (0, texts[1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int")
    sample = quality.sample_features(docs, labels, "doc_id", "text", "quality", 100, 1 << 30)
    want = sorted(((str(i), i % 2, *quality.counted(t)) for i, t in [*texts.items(), (0, texts[1])]), key=lambda r: (r[0], r[2].tobytes()))
    assert len(sample) == len(want) == 43
    for (y, ids, n), (_, label, *counts) in zip(sample, want, strict=True):
        assert y == label and ids.dtype == np.int32 and n.dtype == np.float32
        assert np.array_equal(ids, counts[0]) and np.array_equal(n, counts[1])
    assert 3 * sum(len(a) + len(b) for _, a, b in sample.rows) < sum(ids.nbytes + n.nbytes for _, ids, n in sample)
    a, b = quality.train(sample), quality.train(list(sample))
    assert a[1] == b[1] and np.array_equal(a[0], b[0]) and a[0].any()


def test_bpe_driver_keeps_no_tokenizer(odd):
    bpe._tokenizer.cache_clear()
    bpe._vocab_size.cache_clear()
    bpe.encode(odd)
    assert bpe._tokenizer.cache_info().currsize == 0


def levenshtein(item, text):
    last = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
        last = row
    return min(last)


def test_myers_equals_dynamic_programming():
    rnd = random.Random(3)
    for _ in range(400):
        item = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
        text = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 30)))
        assert decontaminate.myers(item, text)[0] == levenshtein(item, text)


@pytest.mark.parametrize("rate", [0.0, 0.07, 0.2])
def test_every_match_within_the_budget_is_found(rate):
    rnd = random.Random(5)
    items = [(i, decontaminate.normal("".join(rnd.choice("abcd  ") for _ in range(rnd.randint(10, 60))))) for i in range(15)]
    matcher = decontaminate.Matcher(items, rate)
    for _ in range(60):
        text = ""
        for _ in range(3):
            item = list(rnd.choice(items)[1])
            for _ in range(rnd.randint(0, 4)):
                item[rnd.randrange(len(item))] = rnd.choice(["", "a", "xy", " "])
            text += "".join(item) + "".join(rnd.choice("abcd  ") for _ in range(20))
        text = decontaminate.normal(text)
        want = {k: d for k, s in items if s and (d := levenshtein(s, text)) <= int(rate * len(s))}
        assert {k: d for k, d, _, _ in matcher.matches(text)} == want


def test_leaks_and_their_places(spark, none):
    passage = "The quick brown fox jumps over the lazy dog, again and again, until the evening comes."
    edited = passage.upper().replace("LAZY", "LAZI").replace(",", " -")
    rows = [(1, f"İ before. {passage} After.", None, None, None), (2, f"x {edited} y", None, None, None), (3, "nothing here", None, None, None), (None, passage, None, None, None), (1, passage, None, None, None), (5, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame([(7, passage), (7, passage), (8, None), (9, ""), (10, "!!"), (None, "nothing here at all that fits")], "item_id long, text string")
    for part in (10**6, 60):  # in one part and in several
        got = by_row((r.doc_id, r.item_id, r.distance) for r in decontaminate.find_leaks(docs, bench, part_chars=part).collect())
        assert got == by_row([(1, 7, 0), (1, 7, 0), (2, 7, 1), (None, 7, 0)])
        kept = sorted(r.doc_id for r in decontaminate.without_leaks(docs, bench, part_chars=part).collect())
        assert kept == [3, 5]
    for r in decontaminate.find_leaks(docs.filter("doc_id = 2"), bench).collect():
        assert rows[1][1][r.start : r.end] == edited[:-1]
    for r in decontaminate.find_leaks(docs.filter("text like '%before%'"), bench).collect():
        assert rows[0][1][r.start : r.end] == passage[:-1]
    assert decontaminate.find_leaks(none, bench).count() == 0
    assert decontaminate.without_leaks(docs, bench.limit(0)).count() == len(rows)


def test_one_part_of_the_benchmark_is_held_at_a_time(spark, monkeypatch):
    sent, items = [], [(i, f"the words of item {i} stand here in a row {i * i}") for i in range(12)]
    docs = spark.createDataFrame([(i, f"before {t} after") for i, t in items[:5]] + [(99, "a text of its own")], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = by_row(decontaminate.find_leaks(docs, benchmark).collect())
    send = spark.sparkContext.broadcast

    def held(value):
        assert not any(os.path.exists(b._path) for b in sent)  # destroy() removes it
        sent.append(send(value))
        return sent[-1]

    monkeypatch.setattr(spark.sparkContext, "broadcast", held)
    leaks = decontaminate.find_leaks(docs, benchmark, part_chars=100)
    assert len(sent) > 2 and by_row(leaks.collect()) == want and len(want) >= 5
    sent.clear()
    clean = decontaminate.without_leaks(docs, benchmark, part_chars=100)
    assert len(sent) > 2 and [r.doc_id for r in clean.collect()] == [99]


def test_op5_finds_every_verbatim_item(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if decontaminate.normal(i.text) in decontaminate.normal(d.text)}
    got = {(r.doc_id, r.item_id): r.distance for r in queries.QUERIES["op5_decontaminate"](spark, SF).collect()}
    assert want and want <= got.keys() and all(got[k] == 0 for k in want)


def plain_spans(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_equal_the_plain_patterns():
    rnd = random.Random(2)
    for _ in range(15_000):
        text = "".join(rnd.choice("aé@@..+-0123456789 ()\n") for _ in range(rnd.randint(0, 60)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("1" * 50_000 + ".2.3.4 " + "a" * 20_000) == []


def test_alike_tokens_take_the_label():
    model = pii.Model(np.zeros((pii.FEATURES, 5)), np.zeros((5, 5)), 3.0)
    model.node[0, 0] = 1.0
    text = "call +1 (017) 555-7713 now; or 5557713 later, ask 5557713 or room 12"
    base, added = pii.find(text, model)
    assert [text[a:b] for _, a, b in base] == ["+1 (017) 555-7713"]
    assert all(text[a:b] == "5557713" for _, a, b in added)
    assert pii.masked(text, base).startswith("call <phone> now")
    assert pii.masked("abcdef", [(0, 1, 4), (2, 2, 5)]) == "a<email>f"


def test_pii_odd_rows(spark, odd, none):
    model = pii.fit(odd)
    rows = pii.detect(odd, model, masked_col="hidden").collect()
    assert len(rows) == len(ODD) and all(r.pii_spans == [] and r.hidden == (r.text or "") for r in rows)
    assert pii.detect(none, pii.fit(none)).count() == 0


def test_op6_base_spans_of_the_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.QUERIES["op6_pii"](spark, SF).collect():
        want = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in plain_spans(docs[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(",")) and [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]


def test_main_text_of_odd_pages():
    page = "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav><header><h1>Site</h1></header>{}<aside>side</aside><footer>foot</footer></body></html>"
    article = "<article><header><h1>Head &amp line</h1></header><p>One<br>two &eacute;<p><b>Short.<p>x</article>"
    assert html_text.main_text(page.format(article)) == "Head & line\n\nOne two é\n\nShort.\n\nx"
    divs = "<div class='cookie-notice'>We use cookies</div><div id=content><p>First paragraph of the text.</p><p>Second.</p></div><section class=comments><p>Nice post, thank you very much!</p></section><form><p>Sign up</p></form>"
    assert html_text.main_text(page.format(divs)) == "First paragraph of the text.\n\nSecond."
    assert html_text.main_text("<body><![if x]><p>a</p><![endif]><p>hello world this") == "a\n\nhello world this"
    assert html_text.main_text("<nav>menu <article><p>never closed") == "never closed"
    for empty in (None, "", "   ", "<div class=ad>x", "<script>"):
        assert html_text.main_text(empty) == ""


def test_main_text_of_split_nested_and_bare_articles():
    long, part = "many words of the text, one after the other, " * 30, "the second part of the text has words too " * 8
    want = [" ".join(t.split()) for t in ("Heading", "A short lead.", long, part, "The end.")]
    for tag in ("div", "section", "table><tr><td"):
        end = "td></tr></table" if "td" in tag else tag
        split = f"<h1>Heading</h1><p>A short lead.</p><{tag}><p>{long}</p></{end}><{tag}><p>{part}</p></{end}><p>The end.</p>"
        for page in ("<body><article>{}</article></body>", "<article>{}</article>", "<body><main><div>{}</div></main></body>", "<main><article>{}</article></main>", "<body><article><article>{}</article></article></body>", "<body>{}</body>", "{}"):
            assert html_text.main_text(page.format(split)).split("\n\n") == want, (tag, page)
    furniture = "<body><div><p>Home</p></div><div><article>{}</article></div><div><p>Imprint</p></div></body>"
    assert html_text.main_text(furniture.format(split)).split("\n\n") == want
    bare = f"<h1>Heading</h1><p>A short lead.</p><p>{long}</p><p>{part}</p><p>x</p><p>y</p><p>The end.</p>"
    assert html_text.main_text(bare).split("\n\n") == html_text.main_text(f"<body>{bare}").split("\n\n") == [*want[:-1], "x", "y", "The end."]
    both = html_text.main_text(f"<body><article><p>{long}</p></article><article><p>{part}</p></article></body>")
    assert both.split("\n\n") == want[2:4]


def test_main_text_keeps_article_elements_with_furniture_words():
    inside = "<h2 id='related-work'>Related work</h2><section id='cookies'><p>Cookies are small files.</p></section><div id='tags'>Tags of a text.</div><p class='header'>A header is told of.</p><table><tr class='header'><th>Name</th></tr></table><h3 id=share class=navigation>Share</h3>"
    want = ["Related work", "Cookies are small files.", "Tags of a text.", "A header is told of.", "Name", "Share", "The end."]
    for tag in ("article", "main"):
        furniture = "<div class='share-buttons'>Share this</div><ul class=tags><li>tag</ul><div role=navigation>Next</div><nav>Menu</nav>"
        page = f"<body><div id=sidebar>Side</div><p class=header>Site</p><{tag}>{inside}{furniture}<p>The end.</p></{tag}><section id=comments>Nice</section></body>"
        assert html_text.main_text(page).split("\n\n") == want


def test_op9_articles_of_the_whole_table(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.QUERIES["op9_html_text"](spark, SF).collect():
        inner = re.search(r"(?s)<article>(.*)</article>", pages[r.page_id])[1]
        parts = re.sub(r"<[^>]+>", " ", re.sub(r"</?(p|h1)[^>]*>", "\0", inner)).split("\0")
        want = "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)
        assert (r.text, r.n_chars) == (want, len(want))


def test_html_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, "u"), (None, "<p>a", "u"), (1, None, "u")], "page_id long, html string, text string")
    assert by_row(html_text.extract(pages).collect()) == by_row([(1, "", 0), (None, "a", 1), (1, "", 0)])
    assert html_text.extract(pages.limit(0)).count() == 0
