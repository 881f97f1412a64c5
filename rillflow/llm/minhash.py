"""MinHash near-duplicates of texts, with odd sketches before the exact check.

A document is the set of its distinct word shingles. MinHash samples of equal
sets are equal, so equal sets are one class from the start. Bands of samples
give candidate buckets. In a first round every member of a bucket is compared
with the bucket's smallest member only. In a second round members of different components that
may be near by their sketches form clusters, and within a cluster the sets of
all but the largest component are compared with all others, in pairs of
blocks. So no link that could join two components is left out, and a group of
n copies costs about n comparisons and not n * n.

Before texts are read, an odd sketch decides: each MinHash sample flips one bit
of a short bitmap, and the ones of two bitmaps' XOR estimate how many samples
differ. Only pairs far below the threshold are dropped by it; all others are
confirmed on their full sets.

With the threshold t, bands of r rows miss a pair with probability
(1 - t**r)**bands: 32 bands of 4 rows miss 6e-11 at 0.85 and 5e-8 at 0.8.
Shingles are compared by 64-bit hashes, and sets by all of these. Classes of
equal sets are told apart by 128 bits (two independent sums over the hashes).
A band key or a component's centre with very many members is met in several
tasks. Of a long text, eight bytes are held for each shingle.

Defined results: null or empty texts and texts without words have no shingles,
no links, and stay; a text with fewer words than a shingle has its whole word
sequence as its one shingle; rows that repeat a doc_id are one document for
``kept`` (``deduplicated`` tells them apart by their texts); a null doc_id
counts as one id that is smaller than all others; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import components, storage
from . import text as tx

SAMPLES, BANDS, ROWS, SKETCH_BITS = 128, 32, 4, 256
#: A pair is dropped by its sketches if the estimate is so much below the threshold (7 standard deviations).
SKETCH_MARGIN = 0.25
#: Members that are compared with a copy of one bucket's smallest member; most rows of a block.
CHUNK_MEMBERS, BLOCK_MEMBERS = 256, 1024
NO_ID = -(2**63)
_rng = np.random.default_rng(7)
_FACTOR = _rng.integers(0, 2**31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _rng.integers(0, 2**32, SAMPLES, dtype=np.uint32)
_BAND = _rng.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
U = np.uint64
_SALTS = (U(0xA5A5A5A5A5A5A5A5), U(0x3C6EF372FE94F82B))


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (lower case); long texts go segment by segment."""
    long = [i for i, t in enumerate(texts) if t and len(t) > tx.CHUNK_BYTES]
    words = tx.split([None if i in long else t for i, t in enumerate(texts)] if long else texts, lower=True)
    hashes, first = words.hashes(), words.first
    grams, begin = tx.windows(hashes, first, size)
    at = np.searchsorted(begin, first)
    out = []
    for k in range(len(first) - 1):
        n = int(first[k + 1] - first[k])
        if n >= size:
            own = np.sort(grams[at[k] : at[k + 1]])
            fresh = np.empty(len(own), bool)
            fresh[0] = True
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            out.append(own[fresh])
        elif n:
            out.append(tx.windows(hashes[first[k] : first[k + 1]], np.array([0, n]), n)[0])
        else:
            out.append(np.empty(0, np.uint64))
    for i in long:
        found = []
        for part in tx.segments(texts[i], size - 1):
            words = tx.split([part], lower=True)
            n = min(size, int(words.counts[0]))
            if n:
                found.append(np.unique(tx.windows(words.hashes(), words.first, n)[0]))
        out[i] = np.unique(np.concatenate(found)) if found else out[i]
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Two independent 64-bit values (rows) for each non-empty set, the same for equal sets."""
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    values = np.concatenate(sets)
    return np.stack([tx.mix(np.add.reduceat(tx.mix(values ^ salt), starts) + sizes.astype(np.uint64)) for salt in _SALTS])


def samples(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash samples of non-empty sets: one row of 32-bit values for each."""
    values = np.concatenate(sets)
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    halves = (values.astype(np.uint32), (values >> U(32)).astype(np.uint32))
    out = np.empty((len(sets), SAMPLES), np.uint32)
    for k in range(SAMPLES):
        out[:, k] = np.minimum.reduceat(halves[k & 1] * _FACTOR[k] + _SHIFT[k], starts)
    return out


def bands(mins: np.ndarray) -> np.ndarray:
    rows = mins.astype(np.uint64).reshape(len(mins), BANDS, ROWS) + U(1)
    return tx.mix((rows * _BAND[None]).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def odd_sketches(mins: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples, as 64-bit words."""
    place = tx.mix(mins.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << U(32))) % U(SKETCH_BITS)
    flat = (np.arange(len(mins))[:, None] * SKETCH_BITS + place.astype(np.int64)).ravel()
    odd = (np.bincount(flat, minlength=len(mins) * SKETCH_BITS) & 1).astype(np.uint8).reshape(len(mins), SKETCH_BITS)
    return np.packbits(odd, axis=1, bitorder="little").view("<u8")


def most_differing_bits(similarity: float) -> int:
    """Ones in the XOR of two sketches whose estimate is ``similarity``."""
    differ = 2 * SAMPLES * (1 - similarity)
    return math.ceil(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** differ))


WORDS_OF_SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]


def features(docs: DataFrame, size: int, marked: bool = False) -> DataFrame:
    """doc_id, h1, h2 (the set's 128 bits), n_shingles; bands and sketch words where the set is new to the chunk; if ``marked`` the text's hash."""
    more = ["mark"] if marked else []

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, ids, *marks in tx.chunked(batches, ["text", "doc_id", *more]):
            sets = shingle_sets(texts, size)
            n = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            sig = np.zeros((2, len(ids)), np.int64)
            band_of: list = [None] * len(ids)
            sketch = np.zeros((len(ids), len(WORDS_OF_SKETCH)), np.int64)
            if len(full):
                sig[:, full] = signatures([sets[i] for i in full]).view(np.int64)
                new = full[np.unique(sig[:, full], axis=1, return_index=True)[1]]
                mins = samples([sets[i] for i in new])
                keys = bands(mins).view(np.int64)
                sketch[new] = odd_sketches(mins).view(np.int64)
                for i, k in zip(new.tolist(), keys, strict=True):
                    band_of[i] = k
            columns = [pa.array(ids, pa.int64()), pa.array(sig[0], mask=n == 0), pa.array(sig[1], mask=n == 0), pa.array(n), pa.array(band_of, pa.list_(pa.int64()))]
            columns += [pa.array(sketch[:, i]) for i in range(len(WORDS_OF_SKETCH))]
            columns += [pa.array(m, pa.int64()) for m in marks]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h1", "h2", "n_shingles", "bands", *WORDS_OF_SKETCH, *more])

    source = docs.select(F.col("text").cast("binary").alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), *[F.xxhash64(F.col("text").cast("binary")).alias(m) for m in more])
    return source.mapInArrow(made, "doc_id long, h1 long, h2 long, n_shingles long, bands array<long>, " + ", ".join(f"{s} long" for s in [*WORDS_OF_SKETCH, *more]))


def confirmed(docs: DataFrame, pairs: DataFrame, classes: DataFrame, size: int, percent: int, parts: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets meet 100 * intersection >= percent * union.

    Partners of one b are dealt to chunks, each with a copy of b's set, so no
    task takes more than CHUNK_MEMBERS partners of it. Sets are streamed in
    the order of the chunks: only b's set is held.
    """
    degree = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / CHUNK_MEMBERS).cast("int").alias("chunks"))
    member = pairs.join(degree, "b").select(F.col("a").alias("sig"), "b", F.pmod(F.xxhash64("a"), F.col("chunks")).cast("int").alias("chunk"), F.lit(False).alias("head"))
    heads = degree.select(F.col("b").alias("sig"), "b", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(True).alias("head"))
    wanted = member.union(heads).join(classes.select("sig", "least", "h1"), "sig")
    source = docs.select(F.col("text").cast("binary").alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("least"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, sig, b, chunk, head, h1 in tx.chunked(batches, ["text", "sig", "b", "chunk", "head", "h1"]):
            place: dict[bytes, int] = {}
            number = [place.setdefault(t, len(place)) for t in texts]
            own = shingle_sets(list(place), size)
            real = signatures([s if len(s) else np.zeros(1, np.uint64) for s in own])[0].view(np.int64)
            keep = [i for i, k in enumerate(number) if real[k] == h1[i]]
            data = [tx.packed(s, "<u8") for s in own]
            values = ([b[i] for i in keep], [chunk[i] for i in keep], [head[i] for i in keep], [sig[i] for i in keep], [data[number[i]] for i in keep])
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary()), strict=True)], ["b", "chunk", "head", "sig", "set"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, base = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = [], []
            for key_b, key_chunk, head, sig, data in zip(*(batch.column(c).to_pylist() for c in ("b", "chunk", "head", "sig", "set")), strict=True):
                own = np.frombuffer(data, "<u8")
                if head:
                    at, base = (key_b, key_chunk), own
                elif at == (key_b, key_chunk):
                    place = np.searchsorted(base, own)
                    place[place == len(base)] = 0
                    common = int((base[place] == own).sum())
                    if 100 * common >= percent * (len(base) + len(own) - common):
                        a.append(sig)
                        b.append(key_b)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rows = source.join(wanted, "least").select("text", "sig", "b", "chunk", "head", "h1").mapInArrow(sets, "b long, chunk int, head boolean, sig long, set binary")
    ordered = rows.repartition(parts, "b", "chunk").sortWithinPartitions("b", "chunk", F.desc("head"), "sig")
    return ordered.mapInArrow(compared, "a long, b long")


def _sketched(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow the similarity and whose sketches don't rule it out."""
    one = classes.select(F.col("sig").alias("a"), F.col("n").alias("na"), *[F.col(s).alias(f"a{s}") for s in WORDS_OF_SKETCH])
    two = classes.select(F.col("sig").alias("b"), F.col("n").alias("nb"), *[F.col(s).alias(f"b{s}") for s in WORDS_OF_SKETCH])
    ones = sum((F.bit_count(F.col(f"a{s}").bitwiseXOR(F.col(f"b{s}"))) for s in WORDS_OF_SKETCH), F.lit(0))
    near = pairs.join(one, "a").join(two, "b").where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (ones <= most_differing_bits(percent / 100 - SKETCH_MARGIN)))
    return near.select("a", "b")


def _dealt(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Rows (key, comp, sig, …) in pairs of blocks (low, high) of their key; ``own`` is a row's block.

    Members of a key's largest component are never paired with each other:
    only the rest is paired, with itself and with the largest component. So a
    large group that is linked already costs its rest times its size.
    """
    per = rows.groupBy(key, "comp").agg(F.count(F.lit(1)).alias("k"))
    top = per.groupBy(key).agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.max("k").alias("most"), F.sum("k").alias("all"))
    top = top.where("all > most").select(key, "main", F.ceil(F.col("most") / size).cast("int").alias("mains"), F.ceil((F.col("all") - F.col("most")) / size).cast("int").alias("rests"))
    both = rows.join(top, key)
    is_main = F.col("comp") == F.col("main")
    own = F.pmod(F.xxhash64("sig"), F.when(is_main, F.col("mains")).otherwise(F.col("rests"))).cast("int")
    both = both.withColumn("own", F.when(is_main, own + F.col("rests")).otherwise(own))
    other = F.when(is_main, F.sequence(F.lit(0), F.col("rests") - 1)).otherwise(F.sequence(F.lit(0), F.col("rests") + F.col("mains") - 1))
    both = both.withColumn("other", F.explode(other))
    return both.select(key, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", *[c for c in rows.columns if c != key])


def _near(rows: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of one block pair in different components that sizes and sketches allow, and their differing bits."""
    one = np.flatnonzero(rows["own"] == rows["low"])
    two = np.flatnonzero(rows["own"] == rows["high"])
    n, comp = rows["n"], rows["comp"]
    near = (comp[one][:, None] != comp[two][None]) & (100 * np.minimum(n[one][:, None], n[two][None]) >= percent * np.maximum(n[one][:, None], n[two][None]))
    if rows["low"][0] == rows["high"][0]:
        near &= one[:, None] < two[None]
    i, j = np.nonzero(near)
    i, j = one[i], two[j]
    ones = sum((np.bitwise_count(rows[s][i] ^ rows[s][j]).astype(np.int64) for s in WORDS_OF_SKETCH), np.zeros(len(i), np.int64))
    keep = ones <= most_differing_bits(percent / 100 - SKETCH_MARGIN)
    return i[keep], j[keep], ones[keep]


def _streamed(batches: Iterator[pa.RecordBatch], key: str, more: tuple[str, ...] = ()) -> Iterator[dict]:
    """Groups of equal (key, low, high) from sorted batches, as arrays (``more``: as lists)."""
    names = [key, "low", "high", "own", "sig", "comp", "n", *WORDS_OF_SKETCH]
    held = {c: np.empty(0, np.int64) for c in names} | {c: [] for c in more}

    def cut_off(last: bool) -> Iterator[dict]:
        change = (np.diff(held[key]) != 0) | (np.diff(held["low"]) != 0) | (np.diff(held["high"]) != 0)
        cut = [0, *(np.flatnonzero(change) + 1).tolist(), len(held[key])]
        stop = len(cut) - 1 if last else len(cut) - 2
        for i, j in zip(cut[:stop], cut[1 : stop + 1], strict=True):
            if j - i > 1:
                yield {c: v[i:j] for c, v in held.items()}
        for c in held:
            held[c] = held[c][cut[stop] :]

    for batch in batches:
        for c in names:
            held[c] = np.concatenate([held[c], batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)])
        for c in more:
            held[c] = held[c] + batch.column(c).to_pylist()
        if len(held[key]):
            yield from cut_off(False)
    if len(held[key]):
        yield from cut_off(True)


def _pairs(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _across(members: DataFrame, percent: int, parts: int) -> DataFrame:
    """Pairs of components that join all members of a bucket that sizes and sketches let be near: a forest, not all pairs."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _streamed(batches, "key"):
            i, j, _ = _near(rows, percent)
            tree = components.spanning(len(rows["sig"]), zip(i.tolist(), j.tolist(), strict=True))
            if tree:
                yield _pairs([int(rows["comp"][x]) for x, _ in tree], [int(rows["comp"][y]) for _, y in tree])

    ordered = _dealt(members, "key", BLOCK_MEMBERS).repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high")
    return ordered.mapInArrow(searched, "a long, b long").distinct()


def _settled(docs: DataFrame, clusters: DataFrame, size: int, percent: int, parts: int) -> DataFrame:
    """Links between components within clusters (cluster, comp, sig, n, least, sketch words), confirmed on full sets.

    A block pair holds the sets of at most two blocks; of its links only a
    forest goes out. Pairs are tried from the nearest on, and pairs that are
    joined already aren't tried.
    """
    rows = _dealt(clusters, "cluster", CHUNK_MEMBERS)
    source = docs.select(F.col("text").cast("binary").alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("least"))
    names = ["cluster", "low", "high", "own", "sig", "comp", "n", *WORDS_OF_SKETCH]
    schema = "cluster long, low int, high int, own int, sig long, comp long, n long, " + ", ".join(f"{s} long" for s in WORDS_OF_SKETCH) + ", set binary"

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.int64()] * (3 + len(WORDS_OF_SKETCH))]
        for texts, h1, *values in tx.chunked(batches, ["text", "h1", *names]):
            place: dict[bytes, int] = {}
            number = [place.setdefault(t, len(place)) for t in texts]
            own = shingle_sets(list(place), size)
            real = signatures([s if len(s) else np.zeros(1, np.uint64) for s in own])[0].view(np.int64)
            keep = [i for i, k in enumerate(number) if real[k] == h1[i]]
            data = [tx.packed(s, "<u8") for s in own]
            columns = [pa.array([v[i] for i in keep], t) for v, t in zip(values, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([data[number[i]] for i in keep], pa.binary())], [*names, "set"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _streamed(batches, "cluster", ("set",)):
            i, j, ones = _near(rows, percent)
            order = np.argsort(ones, kind="stable")
            sets: dict[int, np.ndarray] = {}
            comps = np.unique(rows["comp"], return_inverse=True)[1].tolist()
            comp, a, b = rows["comp"], [], []
            parent = list(range(len(comps)))

            def root(x: int, parent=parent) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
                p, q = root(comps[x]), root(comps[y])
                if p == q:
                    continue
                for k in (x, y):
                    if k not in sets:
                        sets[k] = np.frombuffer(rows["set"][k], "<u8")
                place = np.searchsorted(sets[x], sets[y])
                place[place == len(sets[x])] = 0
                common = int((sets[x][place] == sets[y]).sum())
                if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                    parent[max(p, q)] = min(p, q)
                    a.append(int(comp[x]))
                    b.append(int(comp[y]))
            if a:
                yield _pairs(a, b)

    held = source.join(rows, "least").select("text", "h1", *names).mapInArrow(with_sets, schema)
    ordered = held.repartition(parts, "cluster", "low", "high").sortWithinPartitions("cluster", "low", "high")
    return ordered.mapInArrow(linked, "a long, b long")


def _components(docs: DataFrame, size: int, percent: int, marked: bool = False) -> tuple[DataFrame, DataFrame]:
    """The features of all rows, and h1, h2, least, root of each class of equal sets."""
    spark = docs.sparkSession
    folder = storage.shared_dir(spark)
    # sets are sent with 8 bytes for each shingle, a little more than their texts
    parts = storage.parts_for(spark, storage.text_bytes(docs), storage.TASK_BYTES // 2)
    seen = storage.stored(features(docs, size, marked), folder, "features")
    first = [F.first("bands", ignorenulls=True).alias("bands"), *[F.max(F.when(F.col("bands").isNotNull(), F.col(s))).alias(s) for s in WORDS_OF_SKETCH]]
    classes = seen.where("h1 is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), *first)
    classes = storage.stored(classes.withColumn("sig", F.monotonically_increasing_id()), folder, "classes")
    keys = classes.select("sig", F.explode("bands").alias("key"))
    buckets = storage.stored(keys.groupBy("key").agg(F.min("sig").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1"), folder, "keys")
    sizes = buckets.agg(F.max("n").alias("most"), F.sum("n").alias("total")).first()
    shared = storage.stored(components.met(keys, buckets, "key", sizes["most"] or 0, sizes["total"] or 0), folder, "buckets")
    tried = storage.stored(_sketched(shared.where("sig <> b").select(F.col("sig").alias("a"), "b").distinct(), classes, percent), folder, "tried")
    links = storage.stored(confirmed(docs, tried, classes, size, percent, parts), folder, "links")
    roots = components.components(links, folder)
    # second round: buckets that hold more than one component
    known = storage.stored(classes.join(roots.withColumnRenamed("node", "sig"), "sig", "left").select("sig", F.coalesce("root", "sig").alias("comp"), "n", "least", "h1", "h2", *WORDS_OF_SKETCH), folder, "known")
    placed = shared.select("sig", "key").join(known.select("sig", "comp"), "sig")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
    members = shared.select("sig", "key").join(mixed, "key").join(known.drop("least", "h1", "h2"), "sig")
    near = storage.stored(_across(members, percent, parts), folder, "near")
    ids = known.select("h1", "h2", "least", F.col("comp").alias("root"))
    if near.limit(1).count():
        clusters = components.components(near, folder).select(F.col("node").alias("comp"), F.col("root").alias("cluster"))
        late = storage.stored(_settled(docs, known.join(clusters, "comp"), size, percent, parts), folder, "late")
        joined = components.components(late, folder).select(F.col("node").alias("comp"), F.col("root").alias("joined"))
        ids = known.join(joined, "comp", "left").select("h1", "h2", "least", F.coalesce("joined", "comp").alias("root"))
    return seen, ids


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text)."""
    seen, ids = _components(docs, size, percent)
    smallest = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = ids.join(smallest, "root").select("h1", "h2", "component_id")
    out = seen.select("doc_id", "h1", "h2", "n_shingles").join(of_class, ["h1", "h2"], "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return out.select(real("doc_id"), "n_shingles", real("component_id"), (F.col("doc_id") == F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group, and all without shingles.

    Rows are told apart by id and text, so different texts that share an id,
    or have none, are judged each on its own. Of a group the row with the
    smallest id stays, null before all others.
    """
    seen, ids = _components(docs, size, percent, marked=True)
    full = seen.where("h1 is not null")
    least = full.join(ids.select("h1", "h2", "root"), ["h1", "h2"]).groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("row"))
    stay = least.select(F.col("row.doc_id").alias("_stay_id"), F.col("row.mark").alias("_stay_mark"))
    wordless = ~F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    key, mark = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.xxhash64(F.col("text").cast("binary"))
    rows = docs.where(~wordless).withColumns({"_row_id": key, "_row_mark": mark})
    rows = rows.join(stay, (F.col("_row_id") == F.col("_stay_id")) & (F.col("_row_mark") == F.col("_stay_mark")), "left_semi")
    counts = full.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id", "mark").alias("d")).first()
    if counts["n"] != counts["d"]:  # rows that repeat with their text
        rows = rows.dropDuplicates(["_row_id", "_row_mark"])
    return rows.select(*docs.columns).union(docs.where(wordless))
