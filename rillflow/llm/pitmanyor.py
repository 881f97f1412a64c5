"""Scoring texts with a hierarchical Pitman-Yor language model.

Tokens are lower-cased words and one end for each text. Each token of the
training texts has a restaurant for the token that follows it; a text begins
after an end. These context restaurants share one parent restaurant over all
words, whose base is uniform over them and one unknown word. So the
probabilities of all words in a context sum to one.

Customers are all tokens of the training texts, and new tables are the
parent's customers. Seats are sampled by Gibbs: of each dish one customer after
another leaves and is seated anew, at a table of the dish with weight
c - 1 - d t or at a new one with weight (strength + d tables) times the parent's
probability, with the counts of all others as they are at that moment. Table
sizes are summed out: a customer that leaves was alone with the probability
that the sizes of t tables of c customers give it (ratios of generalised
Stirling numbers; above MOST_EXACT customers their limit). Restaurants are
independent given the parent, so they are sampled side by side, each one
customer at a time. The parent is one restaurant over all machines: each hash
range samples its own words, takes the other ranges' tables in proportion to
its own, and brings the number of tables up to date once for each block.
Strengths are sampled from the tables (auxiliary variables); discounts come
from the numbers of dishes with one and two customers.

Everything that grows with the corpus is held by hash range. Each chunk of
texts sends its distinct pairs (context, word) once, with their counts in
training texts, to the range of the context; the range sends back a
probability for each of them, in the same order. The answers are read from the
shared folder by the tasks that read the chunks, so those are never shuffled. Since a text's contexts are
its tokens (each end stands before the first word instead of after the last),
the range also has the counts of its words. Two exchanges with the ranges of
the words give the parent's customers: at first each pair has one table, then
the tables after burn-in. Then tables are averaged over further sweeps, and so
are the predictive probabilities, which are linear in them.

Defined results: null and empty texts are one end token; repeated rows count
and are scored each; with no training text every count is 0 and base_score
is log10 of the formula with N = V = 0, that is 0; other columns never enter.
Of a long text some ten bytes are held for each token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sampling, storage
from . import text as tx

BURN_IN, SWEEPS = 4, 6
#: Customers of a dish up to which the probability that one sits alone is exact.
MOST_EXACT = 512
#: Bytes of text for each range, least and most, and ranges from which on they grow.
LEAST_RANGE, MOST_RANGE, MANY_RANGES = 8 << 20, 256 << 20, 4096
#: Bytes of text of a chunk, least and most, and for each range; ranges of pairs for each range of words.
LEAST_CHUNK, MOST_CHUNK, CHUNK_PER_RANGE, RANGES_PER_ROOT = 4 << 20, 64 << 20, 1 << 10, 16
#: Restaurants from which on their next dishes are sampled together; words of the parent that are.
SIDE_BY_SIDE, ROOT_BLOCK = 32, 1024
END = tx.mix(np.array([0xE4D], np.uint64))[0]
U = np.uint64


def tokenised(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its end, and the place of each text's first token (one more at the end)."""
    own, counts = [], np.zeros(len(texts), np.int64)
    for parts, numbers in tx.cut_up(texts, list(range(len(texts))), limit=tx.CHUNK_BYTES):
        words = tx.split(parts, lower=True)
        own.append(words.hashes())
        np.add.at(counts, numbers, words.counts)
    first = np.concatenate(([0], np.cumsum(counts + 1)))
    out = np.empty(int(first[-1]), np.uint64)
    word = np.ones(len(out), bool)
    word[first[1:] - 1] = False
    out[word] = np.concatenate([np.empty(0, np.uint64), *own])
    out[~word] = END
    return out, first


def part_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> U(32)) * U(ranges) >> U(32)).astype(np.int64)


def _pieces(values: np.ndarray, part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal ``part`` (ascending, as the hashes are)."""
    cut = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for i, j in zip(cut, [*cut[1:], len(values)], strict=True):
        yield int(part[i]), slice(i, j)


def shrunk(values: np.ndarray, dtype: str, ascending: bool = False) -> bytes:
    """Compressed numbers, byte by byte; ``ascending`` ones as steps."""
    values = np.ascontiguousarray(np.diff(values, prepend=values.dtype.type(0)) if ascending else values, dtype)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def grown(data: bytes, dtype: str, ascending: bool = False) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.empty(0, dtype)
    planes = np.frombuffer(pa.decompress(data[8:], n * width, "zstd", asbytes=True), np.uint8)
    values = np.ascontiguousarray(planes.reshape(width, n).T).view(dtype).ravel()
    return np.cumsum(values, dtype=dtype) if ascending else values


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[t]) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])


def _lists(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The named columns, row by row."""
    for b in batches:
        columns = [b.column(c) for c in names]
        for i in range(b.num_rows):
            yield tuple(c[i].as_py() for c in columns)


# --- seats -----------------------------------------------------------------

_ALONE: dict[float, np.ndarray] = {}


def alone(counts: np.ndarray, tables: np.ndarray, d: float) -> np.ndarray:
    """The probability that one of c customers at t tables of a dish sits alone: S(c - 1, t - 1) / S(c, t)."""
    if d not in _ALONE:
        n = MOST_EXACT
        log = np.full((n + 1, n + 1), -np.inf)
        log[0, 0] = 0.0
        t = np.arange(1, n + 1)
        for c in range(1, n + 1):  # S(c, t) = S(c - 1, t - 1) + (c - 1 - t d) S(c - 1, t)
            log[c, 1:] = np.logaddexp(log[c - 1, :-1], np.log(np.maximum(c - 1 - t * d, 1e-300)) + log[c - 1, 1:])
        with np.errstate(invalid="ignore"):
            table = np.exp(np.concatenate([np.full((1, n + 1), -np.inf), np.concatenate([np.full((n, 1), -np.inf), log[:-1, :-1]], axis=1)]) - log)
        _ALONE.clear()
        _ALONE[d] = np.nan_to_num(table)
    few = counts <= MOST_EXACT
    out = d * (tables - 1) / np.maximum(counts - 1 - d, 1e-9)
    out[few] = _ALONE[d][counts[few], tables[few]]
    return out


def opened(counts: np.ndarray, base: np.ndarray, free: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables to begin with: each dish's customers enter one after another, ``free`` as the weight of a new table before the base."""
    tables = (counts > 0).astype(np.int64)
    order = np.argsort(-counts, kind="stable")
    seen, weight = 1, free * base
    while True:
        some = order[: int(np.searchsorted(-counts[order], -seen, side="left"))]  # dishes with more than ``seen`` customers
        if not len(some):
            return tables
        block = 1 if seen < 64 else seen // 32
        p = weight[some] / (weight[some] + np.maximum(seen - d * tables[some], 1e-12))
        tables[some] += rng.binomial(np.minimum(block, counts[some] - seen), p)
        seen += block


class Restaurants:
    """Context restaurants: pairs (restaurant, dish) in order of the restaurant, with customers and the parent's probability."""

    def __init__(self, owner: np.ndarray, n: int, counts: np.ndarray, base: np.ndarray, d: float, strength: float, rng: np.random.Generator):
        self.owner, self.n, self.counts, self.base, self.d, self.strength, self.rng = owner, n, counts, base, d, strength, rng
        self.tables = (counts > 0).astype(np.int64)
        total = np.bincount(owner, self.tables, n)
        some = np.flatnonzero(counts > 1)  # one customer has one table
        self.tables[some] = opened(counts[some], base[some], strength + d * total[owner[some]], d, rng)
        # the k-th dishes of all restaurants stand together
        here = owner[some]
        begin = np.flatnonzero(np.diff(here, prepend=-1))
        sizes = np.diff(begin, append=len(here))
        rank = np.arange(len(here)) - np.repeat(begin, sizes)
        order = np.argsort(rank, kind="stable")
        self.some = some[order]
        edges = np.searchsorted(rank[order], np.arange(int(sizes.max()) + 1 if len(sizes) else 1))
        wide = np.diff(edges, append=len(here)) >= SIDE_BY_SIDE
        steps = int(wide.argmin()) if not wide.all() else len(wide)
        self.edges = [*edges[: steps + 1].tolist()] if steps < len(edges) else [*edges.tolist(), len(here)]
        rest = self.some[self.edges[-1] :]
        order = np.argsort(owner[rest], kind="stable")
        self.rest = rest[order]
        self.some = np.concatenate([self.some[: self.edges[-1]], self.rest])

    def sweep(self) -> None:
        """One customer of each dish leaves and is seated anew, in each restaurant one after another."""
        some, d = self.some, self.d
        if not len(some):
            return
        counts, tables, base, owner = self.counts[some], self.tables[some], self.base[some], self.owner[some]
        total = np.bincount(self.owner, self.tables, self.n)
        gone = (self.rng.random(len(some)) < alone(counts, tables, d)).astype(np.int64)
        tables = tables - gone
        stay = counts - 1 - d * tables
        luck = self.rng.random(len(some))
        for i, j in zip(self.edges[:-1], self.edges[1:], strict=True):
            at = owner[i:j]
            now = total[at] - gone[i:j]
            new = (self.strength + d * now) * base[i:j]
            more = luck[i:j] * (new + stay[i:j]) < new
            tables[i:j] += more
            total[at] = now + more
        i = self.edges[-1]
        last, now, added = -1, 0.0, []
        for r, g, b, s, u in zip(owner[i:].tolist(), gone[i:].tolist(), base[i:].tolist(), stay[i:].tolist(), luck[i:].tolist(), strict=True):
            if r != last:
                last, now = r, float(total[r])
            now -= g
            new = (self.strength + d * now) * b
            more = u * (new + s) < new
            now += more
            added.append(more)
        tables[i:] += np.array(added, np.int64)
        self.tables[some] = tables

    def averaged(self, times: int) -> np.ndarray:
        total = np.zeros(len(self.tables))
        for _ in range(times):
            self.sweep()
            total += self.tables
        return total / times

    def probabilities(self, mean: np.ndarray) -> np.ndarray:
        """Of each pair, with the mean number of tables."""
        customers = np.bincount(self.owner, self.counts, self.n) + self.strength
        free = (self.strength + self.d * np.bincount(self.owner, mean, self.n)) / customers
        return (self.counts - self.d * mean) / customers[self.owner] + free[self.owner] * self.base

    def auxiliary(self) -> tuple[float, float]:
        """Sums over the restaurants for the strength's posterior: successes, and minus the logs of the Beta variables."""
        customers, tables = np.bincount(self.owner, self.counts, self.n), np.bincount(self.owner, self.tables, self.n)
        customers, tables = customers[customers > 1], tables[customers > 1]
        logs = -np.log(np.maximum(self.rng.beta(self.strength + 1, customers - 1), 1e-300)).sum()
        return float(successes(tables, self.strength, self.d).sum()), float(logs)


def successes(tables: np.ndarray, strength: float, d: float) -> np.ndarray:
    """The expected number of successes with probability strength / (strength + d i), i from 1 to t - 1."""
    return strength / d * np.log((strength + d * np.maximum(tables - 0.5, 0.5)) / (strength + d / 2))


def root_tables(guests: np.ndarray, words: int, d: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    """Mean tables of one range's words in the parent; ``words`` are those of all ranges."""
    out = (guests > 0).astype(float)
    own = int((guests > 0).sum())
    some = np.flatnonzero(guests > 1)
    if not len(some):
        return out
    share, base = words / own, np.full(len(some), 1.0 / (words + 1))
    counts = guests[some]
    tables = opened(counts, base, np.full(len(some), strength + d * words), d, rng)
    single = own - len(some)
    mean = np.zeros(len(some))
    for sweep in range(BURN_IN + SWEEPS):
        total = float(tables.sum() + single)
        for i in range(0, len(some), ROOT_BLOCK):
            s = slice(i, i + ROOT_BLOCK)
            before = tables[s].sum()
            gone = rng.random(len(counts[s])) < alone(counts[s], tables[s], d)
            left = tables[s] - gone
            new = (strength + d * (total * share - gone)) * base[s]
            tables[s] = left + (rng.random(len(left)) * (new + counts[s] - 1 - d * left) < new)
            total += float(tables[s].sum() - before)
        if sweep >= BURN_IN:
            mean += tables
    out[some] = mean / SWEEPS
    return out


def discount(one: float, two: float) -> float:
    """n1 / (n1 + 2 n2), kept within [0.05, 0.95]."""
    return min(0.95, max(0.05, one / (one + 2 * two))) if one + two else 0.5


def strength_drawn(done: float, logs: float, seed: int) -> float:
    """A draw from the strength's posterior under a Gamma(1, 1) prior."""
    return float(max(0.01, np.random.default_rng(seed).gamma(1 + done, 1 / (1 + logs))))


# --- exchanges -------------------------------------------------------------

ASKED = "part int, chunk long, ids array<long>, held array<boolean>, lengths binary, entry binary, ctx binary, runs binary, dishes binary, dish binary, counts binary"
RANGES = "part int, chunk long, ids array<long>, held array<boolean>, lengths binary, entry binary, runs binary, dishes binary, dish binary, counts binary, chunks array<long>, sizes array<long>, places binary, tokens long, words long, ones long, twos long, word_ones long, word_twos long"
ANSWERS = "home long, chunk long, part int, logs binary, runs binary, totals binary"
TOLD, HEARD = "root int, home int, dishes binary, guests binary", "home long, root int, q binary, customers double, tables double"


class Shape:
    """Ranges of contexts and of words, and bytes of a chunk, for so many bytes of text."""

    def __init__(self, size: int):
        self.ranges = max(16, min(size // LEAST_RANGE, MANY_RANGES), size // MOST_RANGE)
        self.roots = max(16, self.ranges // RANGES_PER_ROOT)
        self.chunk = min(MOST_CHUNK, max(LEAST_CHUNK, self.ranges * CHUNK_PER_RANGE))


def asked(source: DataFrame, shape: Shape) -> DataFrame:
    """Chunks of texts (parts from ``shape.ranges`` on), and their distinct pairs (context, next token) by hash range of the context.

    A chunk has its texts' ids and ``lengths`` in tokens, and for each token its
    pair's number among the chunk's pairs (``entry``). Pairs stand by context,
    ``runs`` pairs each, their ``dish`` as a place in ``dishes`` and their
    ``counts`` in training texts.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = TaskContext.get().partitionId()
        number = home << 32
        for texts, ids, held in tx.chunked(batches, ["text", "doc_id", "held_out"], shape.chunk):
            tokens, first = tokenised(texts)
            lengths = np.diff(first)
            before = np.empty_like(tokens)
            before[1:] = tokens[:-1]
            before[first[:-1]] = END
            order = np.lexsort((tokens, before))
            before, tokens = before[order], tokens[order]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (before[1:] != before[:-1]) | (tokens[1:] != tokens[:-1])
            begin = np.flatnonzero(fresh)
            entry = np.empty(len(order), np.uint32)
            entry[order] = np.cumsum(fresh) - 1
            train = np.repeat(~np.array(held, bool), lengths).astype(np.int64)
            counts = np.add.reduceat(train[order], begin)
            before, tokens = before[begin], tokens[begin]
            yield _batch([(shape.ranges + home % shape.ranges, number, ids, held, shrunk(lengths, "<u4"), shrunk(entry, "<u4"), *[None] * 5)], ASKED)
            for p, s in _pieces(before, part_of(before, shape.ranges)):
                ctx, runs = np.unique(before[s], return_counts=True)
                dishes, dish = np.unique(tokens[s], return_inverse=True)
                yield _batch([(p, number, None, None, None, None, shrunk(ctx, "<u8", True), shrunk(runs, "<u4"), shrunk(dishes, "<u8", True), shrunk(dish, "<u4"), shrunk(counts[s], "<u4"))], ASKED)
            number += 1

    return source.select("text", "doc_id", "held_out").mapInArrow(made, ASKED)


def pair_ranges(rows: DataFrame, ranges: int, parts: int) -> DataFrame:
    """A row for each hash range of contexts: all its pairs with their counts, and for each of ``chunks`` the ``places`` of its pairs.

    Chunks of texts pass through, those of one task one after another.
    """

    def merged(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = key[0].as_py()
        chunks, all_ctx, all_runs, all_dishes, all_dish, all_counts = [], [], [], [], [], []
        for chunk, ids, held, lengths, entry, ctx, runs, dishes, dish, counts in _lists(batches, *[f.split()[0] for f in ASKED.split(", ")[1:]]):
            if part >= ranges:
                yield _batch([(part, chunk, ids, held, lengths, entry, *[None] * 7, *[0] * 6)], RANGES)
                continue
            chunks.append(chunk)
            all_ctx.append(grown(ctx, "<u8", True))
            all_runs.append(grown(runs, "<u4"))
            all_dishes.append(grown(dishes, "<u8", True))
            all_dish.append(grown(dish, "<u4"))
            all_counts.append(grown(counts, "<u4"))
        if part >= ranges:
            return
        sizes = [len(c) for c in all_counts]
        ctxs, place = np.unique(np.concatenate(all_ctx), return_inverse=True)
        key_of = np.repeat(place, np.concatenate(all_runs))
        dishes, place = np.unique(np.concatenate(all_dishes), return_inverse=True)
        shift = np.cumsum([0, *map(len, all_dishes[:-1])])
        key_of = key_of * len(dishes) + place[np.concatenate([d + k for d, k in zip(all_dish, shift.tolist(), strict=True)])]
        del all_ctx, all_runs, all_dishes, all_dish, place
        pairs, places = np.unique(key_of, return_inverse=True)
        del key_of
        counts = np.bincount(places, np.concatenate(all_counts), len(pairs)).astype(np.int64)
        of_ctx = pairs // len(dishes)
        totals = np.bincount(of_ctx, counts, len(ctxs))
        values = [shrunk(np.bincount(of_ctx, minlength=len(ctxs)), "<u4"), shrunk(dishes, "<u8", True), shrunk(pairs % len(dishes), "<u4"), shrunk(counts, "<i8")]
        seen = [totals.sum(), (totals > 0).sum(), (counts == 1).sum(), (counts == 2).sum(), (totals == 1).sum(), (totals == 2).sum()]
        yield _batch([(part, *[None] * 5, *values, chunks, sizes, shrunk(places, "<u4"), *map(int, seen))], RANGES)

    return rows.repartition(parts, "part").groupBy("part").applyInArrow(merged, RANGES)


def told_of(part: int, dishes: np.ndarray, guests: np.ndarray, roots: int) -> Iterator[pa.RecordBatch]:
    for p, s in _pieces(dishes, part_of(dishes, roots)):
        yield _batch([(p, part, shrunk(dishes[s], "<u8", True), shrunk(guests[s], "<i8"))], TOLD)


def heard(told: DataFrame, words: int, d: float, strength: float, seed: int, parts: int) -> DataFrame:
    """Seat the parent's words by range. Each range of contexts (home) hears q = customers - d tables of its dishes; home -1 the sums."""

    def merged(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(h, grown(x, "<u8", True), grown(g, "<i8")) for h, x, g in _lists(batches, "home", "dishes", "guests")]
        dishes, place = np.unique(np.concatenate([x for _, x, _ in rows]), return_inverse=True)
        guests = np.bincount(place, np.concatenate([g for _, _, g in rows]), len(dishes)).astype(np.int64)
        here, at = key[0].as_py(), 0
        tables = root_tables(guests, words, d, strength, np.random.default_rng([seed, here]))
        q = guests - d * tables
        for home, x, _ in rows:
            yield _batch([(home, here, shrunk(q[place[at : at + len(x)]], "<f8"), None, None)], HEARD)
            at += len(x)
        yield _batch([(-1, here, None, float(guests.sum()), float(tables.sum()))], HEARD)

    return told.repartition(parts, "root").groupBy("root").applyInArrow(merged, HEARD)


class Parent:
    """The parent's probability of a word from its q, and of an unknown one (q = 0)."""

    def __init__(self, customers: float, tables: float, words: int, d: float, strength: float):
        self.rows = strength + customers
        self.free = (strength + d * tables) / (words + 1)
        self.tables, self.customers, self.d, self.strength = tables, customers, d, strength

    def of(self, q: np.ndarray) -> np.ndarray:
        return (q + self.free) / self.rows

    def strength_drawn(self, seed: int) -> float:
        if self.customers < 2:
            return self.strength
        x = np.random.default_rng([seed, 1]).beta(self.strength + 1, self.customers - 1)
        return strength_drawn(float(successes(np.array([self.tables]), self.strength, self.d)[0]), -float(np.log(max(x, 1e-300))), seed)


def scored(docs: DataFrame, folds: int = 7, out_fold: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of each row of ``docs``."""
    spark = docs.sparkSession
    folder = storage.shared_dir(spark)
    held = sampling.fold("doc_id", folds) == out_fold
    source = docs.select(F.col("text").cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"))
    size, n_texts = storage.text_bytes(docs), docs.limit(1).count()
    shape, parts = Shape(size), storage.parts_for(spark, size, storage.TASK_BYTES // 2)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    if not n_texts:
        return spark.createDataFrame([], schema)
    held_all = storage.stored(pair_ranges(asked(source, shape), shape.ranges, parts), folder, "ranges")
    rows, heads = held_all.where(F.col("part") < shape.ranges), held_all.where(F.col("part") >= shape.ranges)
    names = ("tokens", "words", "ones", "twos", "word_ones", "word_twos")
    n_all, n_kinds, *of_counts = (x or 0 for x in rows.agg(*[F.sum(c) for c in names]).first())
    storage.swept(spark)  # after another job: Spark holds the last one's plan
    d, d_root = discount(*of_counts[:2]), discount(*of_counts[2:])
    norm = float(np.log10(n_all + n_kinds + 1))

    def first_told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, dishes, dish, counts in _lists(batches, "part", "dishes", "dish", "counts"):
            values = grown(dishes, "<u8", True)
            yield from told_of(part, values, np.bincount(grown(dish, "<u4"), grown(counts, "<i8") > 0, len(values)).astype(np.int64), shape.roots)

    def met(values: tuple, columns: list[str], answers: str, parent: Parent, strength: float, seed: int) -> tuple[dict, Restaurants]:
        """A range's columns, and its restaurants with the parent's answers, which are in the order of its dishes."""
        own = dict(zip(columns, values, strict=True))
        runs, dish = grown(own["runs"], "<u4"), grown(own["dish"], "<u4")
        heard_of = sorted((root, q) for root, q, _, _ in storage.answers_of(answers, own["part"]))
        base = parent.of(np.concatenate([np.empty(0), *[grown(q, "<f8") for _, q in heard_of]]))
        owner = np.repeat(np.arange(len(runs)), runs)
        return own, Restaurants(owner, len(runs), grown(own["counts"], "<i8"), base[dish], d, strength, np.random.default_rng([seed, own["part"]]))

    def parent_of(answers: str, strength: float) -> Parent:
        sums = spark.read.schema(HEARD).parquet(answers).where("home = -1").agg(F.sum("customers").alias("c"), F.sum("tables").alias("t")).first()
        return Parent(sums["c"] or 0.0, sums["t"] or 0.0, n_kinds, d_root, strength)

    told = rows.select("part", "dishes", "dish", "counts").mapInArrow(first_told, TOLD)
    storage.by_home(heard(told, n_kinds, d_root, 1.0, 19, parts), f"{folder}/first", parts)
    parent, some = parent_of(f"{folder}/first", 1.0), ["part", "runs", "dishes", "dish", "counts"]

    def burnt_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _lists(batches, *some):
            own, seats = met(values, some, f"{folder}/first", parent, 1.0, 17)
            for _ in range(BURN_IN):
                seats.sweep()
            dishes, dish = grown(own["dishes"], "<u8", True), grown(own["dish"], "<u4")
            yield from told_of(own["part"], dishes, np.bincount(dish, seats.tables, len(dishes)).astype(np.int64), shape.roots)
            yield _batch([(-1, own["part"], None, np.array(seats.auxiliary(), "<f8").tobytes())], TOLD)

    told = storage.stored(rows.select(*some).mapInArrow(burnt_in, TOLD), folder, "told")
    storage.removed(spark, f"{folder}/first")
    sums = np.zeros(2)
    for r in told.where("root < 0").select("guests").toLocalIterator():  # two numbers for each range
        sums += np.frombuffer(r["guests"], "<f8")
    strength, root_strength = strength_drawn(*sums, 29), parent.strength_drawn(31)
    storage.by_home(heard(told.where("root >= 0"), n_kinds, d_root, root_strength, 23, parts), f"{folder}/second", parts)
    storage.removed(spark, f"{folder}/told")
    last, every = parent_of(f"{folder}/second", root_strength), ["part", "runs", "dish", "counts", "chunks", "sizes", "places"]

    storage.swept(spark)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _lists(batches, *every):
            own, seats = met(values, every, f"{folder}/second", last, strength, 37)
            for _ in range(BURN_IN):
                seats.sweep()
            yield from answers_for(own, seats)

    def answers_for(own: dict, seats: Restaurants) -> Iterator[pa.RecordBatch]:
        logs = np.log10(seats.probabilities(seats.averaged(SWEEPS))).astype("<f4")
        totals = np.bincount(seats.owner, seats.counts, seats.n).astype(np.int64)
        places, at = grown(own["places"], "<u4"), 0
        for chunk, n in zip(own["chunks"], own["sizes"], strict=True):
            mine = places[at : at + n]
            at += n
            ctx = seats.owner[mine]
            begin = np.flatnonzero(np.diff(ctx, prepend=-1))
            yield _batch([(chunk >> 32, chunk, own["part"], logs[mine].tobytes(), shrunk(np.diff(begin, append=n), "<u4"), shrunk(totals[ctx[begin]], "<i8"))], ANSWERS)

    storage.by_home(rows.select(*every).mapInArrow(answered, ANSWERS), f"{folder}/answers", parts)
    storage.removed(spark, f"{folder}/second")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, of_chunk = None, {}
        for chunk, ids, held_out, lengths, entry in _lists(batches, "chunk", "ids", "held", "lengths", "entry"):
            if chunk >> 32 != at:
                at, of_chunk = chunk >> 32, {}
                for number, part, *answer in storage.answers_of(f"{folder}/answers", at):
                    of_chunk.setdefault(number, []).append((part, *answer))
            answers = sorted(of_chunk.pop(chunk), key=lambda a: a[0])
            lengths, entry = grown(lengths, "<u4"), grown(entry, "<u4")
            logs = np.concatenate([np.frombuffer(x, "<f4") for _, x, _, _ in answers]).astype(float)[entry]
            counts = np.concatenate([np.repeat(grown(t, "<i8"), grown(r, "<u4")) for _, _, r, t in answers])[entry]
            first = np.cumsum(lengths, dtype=np.int64) - lengths
            own, known = np.add.reduceat(logs, first), np.add.reduceat((counts > 0).astype(np.int64), first)
            base = np.add.reduceat(np.log10(counts + 1.0), first) - lengths * norm
            columns = [pa.array(ids, pa.int64()), pa.array(held_out, pa.bool_()), pa.array(lengths.astype(np.int64)), pa.array(known), pa.array(np.full(len(lengths), n_all, np.int64)), pa.array(base), pa.array(own), pa.array(10.0 ** (-own / lengths))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return heads.select("chunk", "ids", "held", "lengths", "entry").mapInArrow(summed, schema)
