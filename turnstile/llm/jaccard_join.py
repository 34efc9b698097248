"""N-gram Jaccard join by a token-group matrix.

A text's set holds the hashes of its distinct ``SHINGLE``-word shingles (ASCII lower case; with fewer words, the whole sequence).
Two documents link when their sets' Jaccard similarity reaches ``PERCENT`` / 100; the result is each document's
component. All links between different sets are found, none is taken on a guess:

1. *Sets.* Equal sets (128-bit fingerprint) become one node, so copies are never paired.
2. *Groups.* A set's least hash in each of ``BINS`` equal ranges is its sketch (one permutation for all ranges). Nodes with
   a value in common are compared with the most central node of those that have it, where their sketches agree enough; the
   components of the links are groups. Everything else is a group of its own.
3. *Matrix.* Of each node the n - ceil(0.8 n) + 1 first tokens in one order for all (frequent tokens last) are its prefix;
   nodes that link share a prefix token. The matrix holds each group's union of prefix tokens, one row
   for each (token, group), dealt by token. Groups that meet on a token are counted: the tokens that two unions share
   bound the overlap of any two members. Pairs below what their members' sizes need never are opened.
4. *Opening.* Two single nodes are compared if they pass. Larger groups still apart are opened: their members are paired
   likewise, with those of other groups only. Two nodes are paired where they may share their first token, not on each that
   they share; then their shared prefix tokens are counted, and the bits that an odd number of a set's tokens fall on bound
   from below how many tokens only one has. Of what passes the pair that shares most is compared first for each
   two components, then, with labels renewed, the rest of those still apart.

Comparisons fetch just the documents they need and count shared shingles exactly (64-bit hashes of shingles).
Large components cost what their stars cost, not their pairs; sketches only choose what is compared early. The list of frequent tokens (``FREQUENT``
at most) decides the order only, never the result. Driver: counts, nothing else.

Null and empty texts have an empty set and link with nothing. Rows with equal ids and different texts are documents of
their own with one name; equal rows are copies. Rows with a null id take part, but give no name: their
``component_id`` is null if nothing with an id is reachable. Further columns pass unseen. Ids must be integers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHashes, forget, mix, prefix_hash, read, span_hash, written

SHINGLE, PERCENT = 5, 80
#: Ranges of the sketch, and the share of them in which a node and a centre agree at least to be compared early.
BINS, AGREE = 32, 0.6
#: Bits of a set: whether an odd number of its tokens fall on each.
ODD = 512
#: Frequent tokens that the order knows: the most frequent of those met SEEN times in a task's LOOK tokens.
FREQUENT, SEEN, LOOK = 1 << 17, 3, 1_000_000
#: Rows up to which a list of wanted documents is sent to every task instead of shuffling the documents.
SMALL = 200_000
GROUP_WORDS = 200_000
_SEEDS = [int(x) | 1 for x in np.random.default_rng(11).integers(1 << 62, 1 << 63, 2)]
_BIN_STARTS = np.arange(BINS, dtype=np.uint64) * np.uint64((1 << 64) // BINS)


def _sets(texts: Iterable[str | None], hashes: WordHashes, size: int) -> Iterator[np.ndarray]:
    """The sorted set of each text; texts are hashed in groups."""
    held: list[np.ndarray] = []

    def flush() -> Iterator[np.ndarray]:
        prefix = prefix_hash(np.concatenate(held))
        offset = 0
        for words in held:
            n = len(words)
            start = np.arange(offset, offset + max(min(n, 1), n - size + 1))
            tokens = np.sort(span_hash(prefix, start, np.minimum(start + size, offset + n)))
            offset += n
            if len(tokens):
                tokens = tokens[np.concatenate([[True], tokens[1:] != tokens[:-1]])]
            yield tokens

    total = 0
    for text in texts:
        words = hashes.of((text or "").encode("utf-8").lower().split())  # bytes: lower() and split() are ASCII's
        held.append(words)
        total += len(words)
        if total >= GROUP_WORDS:
            yield from flush()
            held, total = [], 0
    if held:
        yield from flush()


def _texts(column: pa.Array) -> Iterator[str | None]:
    """One at a time: a batch's texts need not be in memory twice."""
    return (value.as_py() for value in column)


def _fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return tuple(int(mix(tokens * np.uint64(s)).sum(dtype=np.uint64).view(np.int64)) for s in _SEEDS)


def _sketches(starts: list[np.ndarray], values: list[np.ndarray]) -> pa.Array:
    """Of each set 32 bits of its least token in each range, null where it has none there."""
    at = np.array(starts, np.int64).reshape(-1, BINS + 1)
    keys = np.array(values, np.int32).reshape(-1, BINS)
    empty = at[:, :-1] == at[:, 1:]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * BINS), pa.array(keys.ravel(), pa.int32(), mask=empty.ravel()))


_FEATURES = "id long, n int, f1 long, f2 long, keys array<int>, token long, count long"


def _feature_rows(size: int):
    """Rows of (id, text) to one row a document, and (token, count) for tokens that are frequent here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, total = WordHashes(), [], 0

        def frequent() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(seen), return_counts=True)
            some = counts >= SEEN
            return batch_of(token=tokens[some].view(np.int64), count=counts[some])

        def batch_of(**given) -> pa.RecordBatch:
            rows = len(next(iter(given.values())))
            kinds = dict(id=pa.int64(), n=pa.int32(), f1=pa.int64(), f2=pa.int64(), keys=pa.list_(pa.int32()), token=pa.int64(), count=pa.int64())
            return pa.RecordBatch.from_arrays([given[k] if isinstance(given.get(k), pa.Array) else pa.array(given[k], kind) if k in given else pa.nulls(rows, kind) for k, kind in kinds.items()], names=list(kinds))

        for batch in batches:
            n, f1, f2, starts, keys = [], [], [], [], []
            for tokens in _sets(_texts(batch.column(1)), hashes, size):
                a, b = _fingerprint(tokens)
                n.append(len(tokens)), f1.append(a), f2.append(b)
                at = np.searchsorted(tokens, _BIN_STARTS)
                least = tokens[np.minimum(at, len(tokens) - 1)] if len(tokens) else _BIN_STARTS
                starts.append(np.append(at, len(tokens))), keys.append((least >> np.uint64(16)).astype(np.uint32).view(np.int32))
                seen.append(tokens)
                total += len(tokens)
                if total >= LOOK:
                    yield frequent()
                    seen, total = [], 0
            yield batch_of(id=batch.column(0), n=n, f1=f1, f2=f2, keys=_sketches(starts, keys))
        if seen:
            yield frequent()

    return run


def prefix_length(n: int) -> int:
    """n - ceil(PERCENT n / 100) + 1."""
    return n - -(-PERCENT * n // 100) + 1


def _prefix_rows(size: int, order):
    """(id, n, f1, f2, prefix tokens, odd bits) of each document with words; sets that a task has just seen are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = order.value
        hashes, seen = WordHashes(), set()
        for batch in batches:
            if len(seen) > 500_000:
                seen.clear()
            rows = []
            for i, tokens in enumerate(_sets(_texts(batch.column(1)), hashes, size)):
                if not len(tokens):
                    continue
                doc = batch.column(0)[i].as_py()
                a, b = _fingerprint(tokens)
                if (doc, a, b) in seen:
                    continue
                seen.add((doc, a, b))
                odd = np.packbits(np.bincount((tokens % np.uint64(ODD)).astype(np.int64), minlength=ODD) & 1 == 1)
                if len(known):
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    tokens = tokens[np.argsort(np.where(known[at] == tokens, rank[at], 0), kind="stable")]
                rows.append((doc, len(tokens), a, b, tokens[: prefix_length(len(tokens))].tobytes(), odd.tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["id", "n", "f1", "f2", "tokens", "odd"])

    return run


_ROWS = "token long, grp long, node long, low int, high int, many boolean, rest int, before long"


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, node, low, high, many, n, tokens) to one row for each prefix token; ``rest`` is how many tokens of the
    set stand from this one on, ``before`` the token that precedes it (the first: itself)."""
    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            part = batch.slice(i, 500)
            tokens = [np.frombuffer(t.as_py(), np.int64) for t in part.column(6)]
            if not tokens:
                continue
            sizes = np.array([len(t) for t in tokens])
            n = part.column(5).to_numpy()
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            flat = np.concatenate(tokens)
            before = np.where(place > 0, np.roll(flat, 1), flat)
            spread = [pa.array(np.repeat(part.column(c).to_numpy(zero_copy_only=False), sizes)) for c in range(5)]
            yield pa.RecordBatch.from_arrays([pa.array(flat), *spread, pa.array((np.repeat(n, sizes) - place).astype(np.int32)), pa.array(before)], names=["token", "grp", "node", "low", "high", "many", "rest", "before"])


def _least_shared(a, b):
    """Tokens that linked sets of sizes a and b share at least: 0.8 / 1.8 of a + b, rounded up."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def _need(a, b):
    """How many prefix tokens linked sets of sizes a and b share at least: past the prefix of one of them there are
    less than ceil(0.8 n) tokens left."""
    return np.maximum(1, _least_shared(a, b) - np.maximum(-(-PERCENT * a // 100), -(-PERCENT * b // 100)) + 1)


def _group_need(low_a, high_a, low_b, high_b):
    """The same for any members of two groups with sizes from low to high. Without its roundings ``_need`` is concave, so
    least at a corner, and the rounded value lies above it everywhere; rounded corners may lie above the sizes inside."""
    corners = [(a, b) for a in (low_a, high_a) for b in (low_b, high_b)]
    exact = np.min([_need(a, b) for a, b in corners], axis=0)
    plain = np.min([PERCENT * (100 * (a + b) - (100 + PERCENT) * np.maximum(a, b)) // (100 * (100 + PERCENT)) for a, b in corners], axis=0)
    return np.where((low_a < high_a) | (low_b < high_b), np.maximum(1, np.minimum(exact, plain + 1)), exact)


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order (token, node) to the pairs of nodes of different groups on each token whose sizes may link:
    with the tokens that they need to share, whether this one may be their first, and their groups. A group's members have
    sizes from low to high, and its pairs are counted token by token. Two single nodes are paired only where this may be the
    first token that they share: enough tokens follow in both, and different ones (or none) precede it."""

    def pairs(rows: list[np.ndarray]):
        token, group, node, low, high, many, rest, before = rows
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])  # a union has a token once,
        rest = np.maximum.reduceat(rest, np.flatnonzero(new))  # at its earliest place
        token, group, node, low, high, many, before = (x[new] for x in (token, group, node, low, high, many, before))
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        size = np.diff(np.append(first, len(token)))
        for a, n in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            for i in range(a, a + n - 1):  # one against those after it
                j = np.arange(i + 1, a + n)
                j = j[(group[j] != group[i]) & (high[j] * 100 >= low[i] * PERCENT) & (high[i] * 100 >= low[j] * PERCENT)]
                seed = np.minimum(rest[i], rest[j]) >= _least_shared(low[i], low[j])
                first_shared = seed & ((before[j] != before[i]) | (before[i] == token[i]))
                told = many[i] | many[j] | first_shared
                j, seed = j[told], seed[told]
                if len(j):
                    need = _group_need(low[i], high[i], low[j], high[j])
                    yield np.full(len(j), node[i]), node[j], need, seed, many[i] | many[j], np.full(len(j), group[i]), group[j]

    def out(found: list) -> pa.RecordBatch:
        a, b, need, seed, many, grp_a, grp_b = (np.concatenate(x) for x in zip(*found, strict=True))
        columns = [a, b, need.astype(np.int32), seed, many, grp_a, grp_b]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "need", "seed", "many", "grp_a", "grp_b"])

    held: list[np.ndarray] | None = None
    found, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        # Without ``before`` each token counts as a set's first.
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in (*range(7), 7 if batch.num_columns > 7 else 0)]
        now = [x.astype(np.int64) if x.dtype == np.int32 else x for x in now]
        now = now if held is None else [np.concatenate(both) for both in zip(held, now, strict=True)]
        cut = int(np.searchsorted(now[0], now[0][-1]))  # the last token may go on in the next batch
        held = [x[cut:] for x in now]
        for pair in pairs([x[:cut] for x in now]) if cut else ():
            found.append(pair)
            rows += len(pair[0])
            if rows > 100_000:
                yield out(found)
                found, rows = [], 0
    found += pairs(held) if held is not None else ()
    if found:
        yield out(found)


def _shared_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, need, x, y, n_x, n_y, odd_x, odd_y) to the pairs that may link, with the number of tokens that their prefixes x
    and y share: ``need`` at least, and the bits in which odd_x and odd_y differ are no more than tokens that only one has."""
    for batch in batches:
        both = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64), assume_unique=True)) for x, y in zip(batch.column(3), batch.column(4), strict=True)]
        count = np.array(both, np.int64)
        n_x, n_y = (batch.column(i).to_numpy().astype(np.int64) for i in (5, 6))
        odd_x, odd_y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, ODD // 8) for i in (7, 8))
        differ = np.bitwise_count(odd_x ^ odd_y).sum(axis=1, dtype=np.int64)
        out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(count)], names=["a", "b", "c"])
        yield out.filter(pa.array((count >= batch.column(2).to_numpy()) & (differ <= n_x + n_y - 2 * _least_shared(n_x, n_y))))


def _small(df: DataFrame) -> DataFrame:
    """A written table, for every task if it has few rows; else joined as it comes."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def similar_sizes(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _wanted_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            node, found = [], []
            for i, tokens in enumerate(_sets(_texts(batch.column(3)), hashes, size)):
                if _fingerprint(tokens) == (batch.column(1)[i].as_py(), batch.column(2)[i].as_py()):
                    node.append(batch.column(0)[i].as_py()), found.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(found, pa.binary())], names=["node", "tokens"])

    return run


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            at = np.minimum(np.searchsorted(x, y), len(x) - 1)
            both = int((x[at] == y).sum())
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


class Join:
    """The state of one join; see the module's text."""

    def __init__(self, rows: DataFrame, size: int):
        self.rows, self.size = rows, size
        features = written(rows.mapInArrow(_feature_rows(size), _FEATURES))
        self.docs = features.filter("n is not null").select("id", "n", "f1", "f2", "keys")
        self.counts = features.filter("token is not null").groupBy("token").agg(F.sum("count").alias("count"))
        sets = self.docs.filter("n > 0").groupBy("n", "f1", "f2").agg(F.min("id").alias("id"), F.first("keys").alias("keys"))
        # Numbered once and written: 64 bits name a set without chance.
        self.nodes = written(sets.withColumn("node", F.monotonically_increasing_id()))

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the (a, b) node pairs that link."""
        pairs = written(pairs.select("a", "b").distinct())
        if pairs.isEmpty():
            return self.rows.sparkSession.createDataFrame([], "a long, b long")
        ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = _small(written(self.nodes.join(ends, "node").select("node", "f1", "f2", "id")))
        texts = self.rows.join(wanted.withColumnRenamed("id", "of"), F.col("id").eqNullSafe(F.col("of")))
        sets = written(texts.select("node", "f1", "f2", "text").mapInArrow(_wanted_sets(self.size), "node long, tokens binary"))
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
        found = written(both.select("a", "b", "x", "y").mapInArrow(_linked, "a long, b long").distinct())
        forget(sets)
        return found

    def stars(self) -> DataFrame:
        """Links of nodes with the centre of those that have a value of the sketch in common with them."""
        values = self.nodes.select("node", F.posexplode("keys").alias("bin", "value")).filter("value is not null")
        values = values.select("node", (F.col("bin").cast("long") * (1 << 32) + F.col("value")).alias("key"))
        shared = values.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
        values = written(values.join(shared, "key"))
        central = values.groupBy("node").agg(F.sum("size").alias("weight"))
        centre = values.join(central, "node").groupBy("key").agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("c"))
        pairs = values.join(centre, "key").filter("node <> c").select(F.col("node").alias("a"), F.col("c").alias("b"))
        pairs = written(pairs.distinct())
        forget(values)
        ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
        ends = written(self.nodes.join(_small(written(ends)), "node").select("node", "n", "keys"))
        of = lambda x: ends.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("keys").alias(f"keys_{x}"))
        alike = F.size(F.filter(F.zip_with("keys_a", "keys_b", lambda x, y: x == y), lambda x: x))
        either = F.size(F.filter(F.zip_with("keys_a", "keys_b", lambda x, y: F.coalesce(x, y)), lambda x: x.isNotNull()))
        both = pairs.join(of("a"), "a").join(of("b"), "b").filter(similar_sizes(F.col("n_a"), F.col("n_b")) & (alike >= AGREE * either))
        found = self.links(both)
        forget(ends)
        return found

    def prefixes(self, group: DataFrame) -> DataFrame:
        """(node, n, grp, tokens, odd) of every node, written."""
        # At most FREQUENT numbers, as arrays: the tasks' lists are merged by a task, not by the driver.
        top = self.counts.orderBy(F.desc("count"), "token").limit(FREQUENT).toArrow()
        known = top["token"].to_numpy().view(np.uint64)
        rank = np.log2(top["count"].to_numpy().astype(float) + 1).astype(np.int32)
        by = np.argsort(known)
        order = self.rows.sparkSession.sparkContext.broadcast((known[by], rank[by]))
        found = self.rows.mapInArrow(_prefix_rows(self.size, order), "id long, n int, f1 long, f2 long, tokens binary, odd binary")
        nodes = self.nodes.join(group, "node", "left").select("node", F.coalesce("grp", "node").alias("grp"), "n", "f1", "f2", F.col("id").alias("of"))
        # A node's tokens come from the documents of its least id; the others with the set fall out here.
        return written(found.join(nodes, ["n", "f1", "f2"]).filter(F.col("id").eqNullSafe(F.col("of"))).select("node", "n", "grp", "tokens", "odd"))

    def meetings(self, rows: DataFrame) -> DataFrame:
        """(grp, node, low, high, many, n, tokens) to the pairs (a, b) that meet, written: counted and bounded as they
        are made; only what passes is joined with anything."""
        tokens = rows.select("grp", "node", "low", "high", "many", "n", "tokens").mapInArrow(_explode, _ROWS)
        dealt = tokens.repartition("token").sortWithinPartitions("token", "node")
        met = dealt.mapInArrow(_meetings, "a long, b long, need int, seed boolean, many boolean, grp_a long, grp_b long").groupBy("a", "b")
        most = [F.max(c).alias(c) for c in ("seed", "need", "many", "grp_a", "grp_b")]
        return written(met.agg(F.count("*").alias("c"), *most))

    def sharing(self, met: DataFrame, rows: DataFrame) -> DataFrame:
        """Those of the pairs (a, b, need) of single nodes that may link by their prefixes and odd bits in ``rows``, with the
        number of prefix tokens shared: they have met on one token only, so these are counted now."""
        of = lambda x, y: rows.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{y}") for c in ("tokens", "n", "odd")))
        both = met.select("a", "b", "need").join(of("a", "x"), "a").join(of("b", "y"), "b")
        both = both.select("a", "b", "need", "tokens_x", "tokens_y", "n_x", "n_y", "odd_x", "odd_y")
        return both.mapInArrow(_shared_enough, "a long, b long, c long")

    def named(self) -> DataFrame:
        """The nodes with the component of each, itself where nothing links with it."""
        return self.nodes.join(self.components(), "node", "left").withColumn("component", F.coalesce("component", "node"))

    def components(self) -> DataFrame:
        """(node, component) for the nodes that have a link."""
        found = written(components(self.stars()))
        prefixes = self.prefixes(found.select("node", F.col("component").alias("grp")))
        # Groups that hold more than the node they are named for: their sizes. The others are their own low and high.
        others = F.max(F.col("node") != F.col("grp")).alias("others")
        wide = prefixes.groupBy("grp").agg(F.min("n").alias("low"), F.max("n").alias("high"), others).filter("others").drop("others")
        sized = prefixes.join(_small(written(wide)), "grp", "left").withColumn("many", F.col("low").isNotNull())
        sized = sized.withColumns({"low": F.coalesce("low", "n"), "high": F.coalesce("high", "n")})
        # Each group's union of prefix tokens: the group stands as its own node.
        met = self.meetings(sized.withColumn("node", F.col("grp")))
        single = self.sharing(met.filter("not many"), sized.filter("not many"))
        # No link has found single nodes before.
        found = written(found.unionAll(components(self.links(single))))
        label = lambda x: found.select(F.col("node").alias(x), F.col("component").alias(f"comp_{x}"))
        groups = met.filter("many and seed and c >= need").join(label("a"), "a", "left").join(label("b"), "b", "left")
        apart = written(groups.filter(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b"))
        if apart.isEmpty():
            return found
        grps = apart.select(F.col("a").alias("grp")).unionAll(apart.select(F.col("b").alias("grp"))).distinct()
        members = prefixes.join(_small(written(grps)), "grp").withColumns({"low": F.col("n"), "high": F.col("n"), "many": F.lit(False)})
        members = written(members)
        pair = apart.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        met = self.meetings(members).withColumns({"low": F.least("grp_a", "grp_b"), "high": F.greatest("grp_a", "grp_b")})
        return self.merged(found, self.sharing(met.join(pair, ["low", "high"], "left_semi"), members))

    def merged(self, found: DataFrame, met: DataFrame) -> DataFrame:
        """(node, component) after the links among the (a, b, c) pairs. One link joins two components, so of
        each two the pair that shares most is compared first, and labels are renewed; the rest of those still apart follows."""
        best = True
        while True:
            label = lambda x: found.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}"))  # noqa: E731,B023
            named = met.select("a", "b", "c").join(label("a"), "a", "left").join(label("b"), "b", "left")
            named = named.withColumns({"of_a": F.coalesce("of_a", "a"), "of_b": F.coalesce("of_b", "b")}).filter("of_a <> of_b")
            met = written(named.select("a", "b", "c", F.least("of_a", "of_b").alias("low"), F.greatest("of_a", "of_b").alias("high")))
            if met.isEmpty():
                return found
            ask = met.groupBy("low", "high").agg(F.max_by(F.struct("a", "b"), F.struct("c", -F.col("a"), -F.col("b"))).alias("p")).select("p.*") if best else met
            linked = self.links(ask)
            joined = linked.join(label("a"), "a", "left").join(label("b"), "b", "left")
            edges = written(joined.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).distinct())
            if not edges.isEmpty():
                found = written(_renewed(found, components(edges)))
            if not best:
                return found
            best = False


def _renewed(found: DataFrame, over: DataFrame) -> DataFrame:
    """(node, component) with the components of ``over``, whose nodes are components of ``found`` or nodes that have none."""
    now = over.select(F.col("node").alias("component"), F.col("component").alias("now"))
    old = found.join(now, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    return old.unionAll(over.join(found, "node", "left_anti").select("node", "component")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes in (a, b) links: the least node reachable. Alternating large and small stars, each
    round written; a node's neighbours are never gathered, only their minimum."""
    least, greatest = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = written(links.select(least, greatest).filter("a < b").distinct())
    state = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(low, "b")
        small = joined.filter("a > m").select(F.col("m").alias("a"), F.col("a").alias("b")).unionAll(low.select(F.col("m").alias("a"), "b"))
        last, edges = edges, written(small.distinct())
        forget(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, component_id) for each row."""
    join = Join(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), size)
    named = join.named()
    # A component's id is its least document id.
    by_id = named.groupBy("component").agg(F.min("id").alias("component_id"))
    of_set = written(named.join(by_id, "component").select("n", "f1", "f2", "component_id"))
    out = join.docs.join(of_set, ["n", "f1", "f2"], "left")
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def _marked(size: int, at: int):
    """Rows with the text in column ``at``, and the size and fingerprint of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = [(len(tokens), *_fingerprint(tokens)) for tokens in _sets(_texts(batch.column(at)), hashes, size)]
            marks = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 3, (pa.int32(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *marks], names=[*batch.schema.names, "__n", "__f1", "__f2"])

    return run


def one_row_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """``docs`` with, of each component, only one row of the least (id, set). Rows with a null id stay, and rows without
    words, whose sets link with nothing; of those with equal ids and texts one. What travels is the list of ids of which
    a row goes, and only the documents whose id stands in several rows are looked at again."""
    join = Join(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), size)
    named = join.named()
    first = F.min(F.struct("id", "n", "f1", "f2")).alias("first")
    least = named.filter("id is not null").groupBy("component").agg(first)
    same_set = (F.col("n") == F.col("first.n")) & (F.col("f1") == F.col("first.f1")) & (F.col("f2") == F.col("first.f2"))
    of_set = written(named.join(least, "component").select("n", "f1", "f2", F.when(same_set, F.col("first.id")).alias("first")))
    stays = (F.col("n") == 0) | F.coalesce(F.col("id") == F.col("first"), F.lit(False))
    rows = join.docs.filter("id is not null").join(of_set, ["n", "f1", "f2"], "left").select(F.col("id").alias("__id"), "n", "f1", "f2", stays.alias("stays"))
    dropped = written(rows.groupBy("__id").agg(F.max("stays").alias("some"), F.count("*").alias("c")).filter("not some or c > 1"))
    same = F.col(id_col).cast("long") == F.col("__id")
    once = docs.join(_small(dropped.select("__id")), same, "left_anti")
    again = dropped.filter("some").select("__id")
    if again.isEmpty():
        return once
    again = _small(again)
    sets = rows.filter("stays").join(again, "__id", "left_semi").select("__id", "n", "f1", "f2").distinct().select(F.col("__id").alias("__of"), *(F.col(c).alias(f"__of_{c}") for c in ("n", "f1", "f2")))
    schema = T.StructType([*docs.schema.fields, T.StructField("__n", T.IntegerType()), T.StructField("__f1", T.LongType()), T.StructField("__f2", T.LongType())])
    marked = docs.join(again, same, "left_semi").mapInArrow(_marked(size, docs.columns.index(text_col)), schema)
    marked = marked.withColumns({"__id": F.col(id_col).cast("long"), "__text": F.when(F.col("__n") == 0, F.col(text_col))})
    kept = [F.col("__id") == F.col("__of"), *(F.col(f"__{c}") == F.col(f"__of_{c}") for c in ("n", "f1", "f2"))]
    marked = marked.join(_small(written(sets)), kept, "left_semi")
    return once.unionAll(marked.dropDuplicates(["__id", "__n", "__f1", "__f2", "__text"]).select(*docs.columns))


def op3_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))
