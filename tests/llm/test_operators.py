"""Each operator on small tables with hard rows, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.llm import bytecnn, components, embeddings, langid, minhash, mixing, oracles, packing, pitmanyor, queries, rules, substrings, text, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size long"


def corpus(seed=1, n=60):
    """Prose of made-up words with near copies, shared passages, nulls, empty and very long texts."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeiou") for _ in range(r.randint(2, 7))) for _ in range(300)]
    prose = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    shared = prose(60)
    texts = [prose(r.randint(5, 120)) for _ in range(n)]
    base = prose(120).split()
    for k in range(25):  # a family of near copies, some linked only through others
        copy = list(base)
        for _ in range(r.randint(0, 9)):
            copy[r.randrange(len(copy))] = r.choice(vocabulary)
        texts.append(" ".join(copy))
        if k % 5 == 0:
            base = copy
    texts += [f"{prose(8)} {shared} {prose(8)}", f"{shared}\n{prose(3)}", shared + " " + shared]
    texts += ["", " \t\n", None, "one", "one two", "One TWO", texts[3], texts[3], "é ñ ß " * 20, "a\x0bb\x0cc", prose(6000), "x" * 50_000, "<|endoftext|> is text", "x<|endoftext|>y <|endoftext|><|endoftext|>", " a  <|endoftext|> b \n", "one two <|endoftext|>", "<|endoftext", "two  spaces ", "日本語 テキスト 漢字"]
    return [(i, t, ("en", "de", None)[i % 3], ("s1", "s2", None)[i % 3], 0, "clash", i) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return WORD.findall(t or "")


def lower(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def closure(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_queries_give_the_rows_of_their_sql(spark, sf_dir, same_rows, name):
    same_rows(queries.QUERIES[name](spark, sf_dir), oracles.ORACLES[name])


def test_words(rows):
    texts = [(r[1] or "").encode() for r in rows]
    found = text.split(texts)
    hashes = found.hashes()
    seen = {}
    for i, r in enumerate(rows):
        own = [w.encode() for w in words(r[1])]
        assert found.counts[i] == len(own) and found.joined(i) == b" ".join(own)
        for w, h in zip(own, hashes[found.first[i] : found.first[i + 1]].tolist(), strict=True):
            assert seen.setdefault(h, w) == w
    assert len(seen) == len(set(seen.values()))


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, rows, size, percent):
    sets = []
    for r in rows:
        w = words(lower(r[1]))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    expected = closure(len(rows), links)
    out = {r["doc_id"]: r for r in minhash.near_duplicates(docs, size, percent).collect()}
    assert len(out) == len(rows)
    for i, c in enumerate(expected):
        assert (out[i]["component_id"], out[i]["n_shingles"], out[i]["kept"]) == (c, len(sets[i]), c == i)
    left = minhash.deduplicated(docs, size, percent)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(expected)) and left.columns == docs.columns


def test_blocks_and_chunks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(components, "HOT_ROWS", 8)
    monkeypatch.setattr(minhash, "CHUNK_MEMBERS", 4)
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 4)
    rows = corpus(7, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    sets = []
    for r in rows:
        w = words(lower(r[1]))
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set()))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    out = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, 3, 85).collect()}
    assert [out[i] for i in range(len(rows))] == closure(len(rows), links)


def test_odd_sketches_estimate_similarity():
    r = np.random.default_rng(1)
    a = r.integers(0, 2**63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:900], r.integers(0, 2**63, 100, dtype=np.uint64)])
    sketch = minhash.odd_sketches(minhash.samples([np.sort(a), np.sort(b)]))
    ones = int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())
    similarity = 1 + minhash.SKETCH_BITS / (4 * minhash.SAMPLES) * math.log(1 - 2 * ones / minhash.SKETCH_BITS)
    assert abs(similarity - 900 / 1100) < 0.12 and ones <= minhash.most_differing_bits(0.6)


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, None), (2, "x y z u v")], "doc_id long, text string")
    out = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"], r["kept"]) for r in minhash.near_duplicates(df, 3, 85).collect())
    assert out == [(False, 1, None, False), (False, 1, None, False), (False, 2, 2, True), (True, 0, None, True), (True, 0, None, True)]
    assert substrings.without_repeats(df).count() == 5
    assert sum(r["taken"] for r in mixing.mixed(df.withColumn("source", F.lit("s"))).collect()) == 30
    assert packing.packed(df).count() == 5 and tokens.written_and_read(df).count() == 5 and pitmanyor.scored(df).count() == 5
    assert rules.judged(df.withColumn("lang", F.lit(None).cast("string"))).count() == 5


def test_texts_that_share_an_id_are_judged_each(spark):
    a, b, c, d, e = ("".join(f"{x}{k} " for k in range(9)) for x in "abcde")
    rows = [(None, a), (None, b), (None, None), (None, None), (1, c), (3, c), (3, d), (4, e), (4, e), (5, ""), (5, " ")]
    left = minhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    expected = [(None, a), (None, b), (None, None), (None, None), (1, c), (3, d), (4, e), (5, ""), (5, " ")]
    assert Counter((r["doc_id"], r["text"]) for r in left) == Counter(expected)


def test_components(spark, tmp_path):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 150)] + [(r.randrange(300, 340), r.randrange(300, 340)) for _ in range(60)]
    out = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(links, "a long, b long"), f"file://{tmp_path}").collect()}
    expected = closure(340, links)
    assert out == {n: expected[n] for n in {x for l in links for x in l if l[0] != l[1]}}


def stored_names(monkeypatch):
    """The names of the tables that are stored from now on, with their numbers of files."""
    names, before = {}, components.storage.stored

    def stored(df, folder, name):
        out = before(df, folder, name)
        names.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(components.storage, "stored", stored)
    return names


def test_components_of_stars_take_no_step(spark, tmp_path, monkeypatch):
    names = stored_names(monkeypatch)
    links = [(i, 0) for i in range(1, 40)] + [(100, 99), (99, 100), (7, 7)]
    out = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(links, "a long, b long"), f"file://{tmp_path}").collect()}
    assert out == {i: 0 for i in range(40)} | {99: 99, 100: 99}
    assert list(names) == ["links-0"]
    assert components.components(spark.createDataFrame([], "a long, b long"), f"file://{tmp_path}").collect() == []


@pytest.mark.parametrize("hot", [8, 1024])
def test_components_around_the_largest_node_in_few_files(spark, tmp_path, monkeypatch, hot):
    """A centre above all its leaves, a chain and a dense part, whether or not nodes count as hot."""
    monkeypatch.setattr(components, "HOT_ROWS", hot)
    names = stored_names(monkeypatch)
    links = [(1000, i) for i in range(40)] + [(i, i + 1) for i in range(2000, 2030)] + [(i, j) for i in range(3000, 3012) for j in range(3000, 3012)]
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(links, "a long, b long"), f"file://{tmp_path}").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out == {i: 0 for i in [*range(40), 1000]} | {i: 2000 for i in range(2000, 2031)} | {i: 3000 for i in range(3000, 3012)}
    assert all(n <= spark.sparkContext.defaultParallelism for k, v in names.items() if k != "links-0" for n in v)


def test_second_round_joins_components_not_all_nodes(spark, tmp_path, monkeypatch):
    """The links of the second round stand between components: no component of the first round is found again."""
    r = random.Random(3)
    vocabulary = ["".join(r.choice("abcdeiou") for _ in range(6)) for _ in range(400)]
    texts, base = [], [r.choice(vocabulary) for _ in range(150)]
    for k in range(120):  # drifting families, each near the one before but not linked with it
        base = list(base)
        for _ in range(9 if k % 10 == 0 else 1):
            base[r.randrange(150)] = r.choice(vocabulary)
        texts.append(" ".join(base))
    seen, before = [], components.components

    def counted(links, folder):
        seen.append(links.count())
        return before(links, folder)

    monkeypatch.setattr(components, "components", counted)
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in map(words, texts)]
    roots = closure(120, [(i, j) for i in range(120) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])])
    out = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, 85).collect()}
    assert out == dict(enumerate(roots))
    assert len(seen) == 3 and all(n < seen[0] for n in seen[1:])


def test_repeated_windows(docs, rows):
    size = 35
    where = Counter()
    for r in rows:
        w = words(r[1])
        where.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = {r["doc_id"]: r for r in substrings.without_repeats(docs).collect()}
    for r in rows:
        w = words(r[1])
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if where[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        got = out[r[0]]
        assert (got["_sub_n_words"], got["_sub_n_removed"], got["_sub_kept"]) == (len(w), sum(gone), kept)
    clean = {r["doc_id"]: r["text"] for r in substrings.cleaned(docs).collect()}
    assert all(clean[r[0]] == r[1] for r in rows if not out[r[0]]["_sub_n_removed"])


def kept_of(rows, size=35):
    """Brute force: (n_words, n_removed, kept text) of each row."""
    where = Counter()
    for t in rows:
        w = words(t)
        where.update(hash(tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    out = []
    for t in rows:
        w = words(t)
        gone = bytearray(len(w))
        for i in range(len(w) - size + 1):
            if where[hash(tuple(w[i : i + size]))] > 1:
                gone[i : i + size] = b"\1" * size
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def test_long_texts_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BYTES_PER_RANGE", 1 << 16)
    monkeypatch.setattr(substrings, "HELD_WINDOWS", 500)
    monkeypatch.setattr(substrings, "HELD_ANCHORS", 100)
    r = random.Random(8)
    names = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(2000)]
    long = r.choices(names, k=450_000)  # 2.7 MB, three segments
    edge = len(" ".join(long)[: text.CHUNK_BYTES].split())
    rows = [" ".join(long), " ".join(long[edge - 60 : edge + 50]), " ".join(long[100:200]), " ".join(r.choices(names, k=300)), None, " ".join(long[-40:] + long[-40:]), "x" * 1_200_000]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").coalesce(2)
    got = {x["doc_id"]: (x["_sub_n_words"], x["_sub_n_removed"], x["_sub_kept"]) for x in substrings.without_repeats(df).collect()}
    assert [got[i] for i in range(len(rows))] == kept_of(rows)


@pytest.mark.parametrize("copies", [1, 16])
def test_the_prefilter_holds_at_any_size(spark, tmp_path, copies, monkeypatch):
    """Few windows that occur once go to the second pass, however many ranges of the sketch the input fills."""
    monkeypatch.setattr(substrings, "LEAST_RANGE", 1 << 16)
    r = random.Random(copies)
    names = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(5000)]
    rows = [(k, " ".join(r.choice(names) for _ in range(1500))) for k in range(40 * copies)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    size = sum(len(t) for _, t in rows)
    shape = substrings.Shape(size)
    assert copies == 1 or shape.ranges > 16
    found = substrings.storage.stored(substrings.sketched(df, shape, 35, 20), f"file://{tmp_path}", "chunks")
    substrings.storage.by_home(substrings.heavy(found, shape, 4), f"file://{tmp_path}/heavy", 4)
    sent = substrings.candidates(found, f"file://{tmp_path}/heavy", shape, 35, 20).where("range >= 0").agg(F.sum(F.octet_length("hashes"))).first()[0] or 0
    assert sent / 8 < 0.05 * len(rows) * 1466


@pytest.mark.parametrize("limits", [(40, 64, 1 << 16, 16), (4, 3, 5, 6)])
def test_vectors(spark, monkeypatch, limits):
    for name, value in zip(("CELL_VECTORS", "MOST_PIVOTS", "PIVOTS_PER_PASS", "BLOCK_VECTORS"), limits, strict=True):
        monkeypatch.setattr(embeddings, name, value)
    r = np.random.default_rng(5)
    base = r.normal(size=(12, 8))
    x = [base[i % 12] + r.normal(size=8) * (0.02 if i % 3 else 0.3) for i in range(150)]
    x += [x[0], x[0] * 2, np.zeros(8)]
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    rows += [(200, None, 1), (201, [1.0, None], 1), (202, [float("nan")] * 8, 1), (203, [float("inf")] * 8, 0), (204, x[0].tolist(), None), (205, [], 0), (206, [1.0, 2.0], 0), (207, [1.0, 2.0], 0), (208, (x[0] * 1e300).tolist(), 0)]
    extra = {c: F.lit("clash") for c in ("node", "cell", "unit", "n_links", "component_id", "kept", "h1", "dim", "many")}
    out = {q["vec_id"]: q for q in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(extra)).collect()}
    assert len(out) == len(rows)

    def unit(v):
        if not v or any(c is None or not math.isfinite(c) for c in v) or not any(v):
            return None
        v = np.array(v) / np.abs(v).max()
        return v / math.sqrt(v @ v)

    units = [None if lab is None else unit(v) for _, v, lab in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.98]
    roots = closure(len(rows), links)
    degree = Counter(x for pair in links for x in pair)
    for i, (vec_id, _, _) in enumerate(rows):
        assert (out[vec_id]["n_links"], out[vec_id]["component_id"]) == (degree[i], rows[roots[i]][0])


def test_bits():
    r = np.random.default_rng(2)
    for bits in (1, 3, 8, 13, 16, 17, 20, 32):
        ids = r.integers(0, 2**bits, 1001).astype(np.uint32)
        data = tokens.pack(ids, bits)
        assert len(data) == -(-1001 * bits // 8) and (tokens.unpack(data, bits, 1001) == ids).all()
    assert [tokens.bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def plain_ids(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_tokenizer())
    return {r[0]: t.encode(r[1] or "", add_special_tokens=False).ids for r in rows}


def test_token_files(docs, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 50)
    ids, at = plain_ids(rows), 0
    for r in sorted(tokens.written_and_read(docs).collect(), key=lambda r: r["start"]):
        own = np.array([*ids[r["doc_id"]], 2], "<u4")
        assert (r["start"], r["n_tokens"], bytes(r["ids"]), r["ids_crc32"]) == (at, len(own), own.tobytes(), zlib.crc32(own.tobytes()))
        at += len(own)
    w = tokens.ShardWriter(f"file://{tmp_path}/a.tok", 17, 10)
    parts = [np.arange(k, dtype="<u4") for k in (0, 3, 25, 10, 1)]
    w.add([5, None, 7], [p.tobytes() for p in parts[:3]])
    w.add([8, 9], [p.tobytes() for p in parts[3:]])
    assert w.close() == (5, 39)
    shard = tokens.ShardReader(f"file://{tmp_path}/a.tok")
    assert all((shard.document(k) == p).all() for k, p in enumerate(parts))
    assert shard.ids(8, 31).tolist() == [*range(5, 25), 0, 1, 2] and shard.null.tolist() == [0, 1, 0, 0, 0]


def test_packing(docs, rows):
    ids = {k: [*v, 0] for k, v in plain_ids(rows).items()}
    out = packing.packed(docs, with_ids=True).collect()
    whole = Counter()
    for r in out:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(own) == r["length"] and zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"]
        assert tokens.unpack(bytes(r["ids"]), 16, r["length"]).tolist() == own
        assert r["length"] == 2048 or len(ids[r["doc_id"]]) <= 2048 or r["piece"] == 0
        whole[r["doc_id"]] += r["length"]
    assert whole == {k: len(v) for k, v in ids.items()}
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(by) <= -(-sum(whole.values()) // 2048) + 1


def test_two_for_one_fills_better():
    assert packing.plan({60: 1, 30: 1, 25: 1, 15: 1}, 100) == [([60, 25, 15], 1), ([30], 1)]
    runs = packing.plan({2048: 3, 1000: 5, 700: 4, 348: 9, 1: 100}, 2048)
    used = Counter()
    for pattern, n in runs:
        assert sum(pattern) <= 2048
        for p in pattern:
            used[p] += n
    assert used == {2048: 3, 1000: 5, 700: 4, 348: 9, 1: 100}


def test_base_rules(docs, rows):
    out = {r["doc_id"]: r for r in rules.judged(docs).collect()}
    for r in rows:
        t, w = r[1] or "", words(r[1])
        lines = [x for x in t.split("\n") if WORD.search(x)]
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = [False] * len(w)
        for i in range(len(w) - 4):
            if grams[tuple(w[i : i + 5])] > 1:
                again[i : i + 5] = [True] * 5
        failed = len(w) < 10 or 100 * sum(again) > 20 * len(w)
        got = out[r[0]]
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"], got["base_failed"]) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), sum(again), failed), r
        assert not (failed and got["kept"])


def test_marks_and_lines_of_long_texts(monkeypatch):
    r = random.Random(4)
    texts = [" ".join(r.choice(["a", "bb.", "...", "(x)", "'y'", "\n", "zz\nzz", "#%"]) for _ in range(r.randint(0, 60))) for _ in range(60)]
    for t in texts:
        raw = t.encode()
        cores = [w.strip(".,;:!?\"'()") for w in words(lower(t))]
        found = rules.core_hashes(text.split([raw]))
        assert len({*zip(cores, found.tolist(), strict=True)}) == len(set(cores)) and len(set(found.tolist())) == len(set(cores))
        whole = {k: int(v[0]) for k, v in rules.base_counts(text.split([raw]), [raw]).items()}
        with monkeypatch.context() as m:
            m.setattr(text.segments, "__defaults__", (20,))
            m.setattr(text, "CHUNK_BYTES", 20)
            assert rules.long_counts(raw) == whole


def verdict(t, known):
    """Brute force of the method's verdict: distances to the nearest reference."""
    raw, w = (t or "").encode(), words(t)
    kinds = [0] * len(rules.CLASSES)
    for x in raw:
        kinds[int(rules._CLASS[x])] += 1
    js = lambda p, q: math.sqrt(max(0.0, sum(a * math.log2(2 * a / (a + b)) for a, b in zip(p, q, strict=True) if a) + sum(b * math.log2(2 * b / (a + b)) for a, b in zip(p, q, strict=True) if b)) / 2)
    best = None
    for ref in known.values():
        common = {h: i for i, h in enumerate(ref["words"].tolist())}
        counts = [0] * (len(common) + 1)
        for x in w:
            h = rules.core_hashes(text.split([x.encode()]))
            counts[common.get(int(h[0]), len(common))] += 1
        d = [js([x / max(1, sum(p)) for x in p], list(q)) for p, q in ((kinds, ref["classes"]), (counts, ref["shares"]))]
        none = js([0] * len(common) + [1], list(ref["shares"]))
        best = [*d, none] if best is None or sum(d) < sum(best[:2]) else best
    far = best is not None and ((best[0] > rules.MAX_CLASS_DISTANCE and len(raw) >= rules.MIN_CHARS_FOR_CLASSES) or (best[1] > rules.WORD_SHARE * best[2] and len(w) >= rules.MIN_WORDS_FOR_COMMON))
    return not far


def test_the_verdict(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = rules.references(df)
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    out = rules.judged(df).collect()
    assert all(r["kept"] == (not r["base_failed"] and verdict(texts[r["doc_id"]], known)) for r in out)
    assert any(not r["kept"] and not r["base_failed"] for r in out)


def test_references_and_distances(docs, rows):
    known = rules.references(docs)
    assert sorted(known) == ["de", "en"]
    own = [r for r in rows if r[2] == "en"]
    counts = Counter(w.strip(".,;:!?\"'()") for r in own for w in words(lower(r[1])))
    top = sorted(counts.values(), reverse=True)[: rules.COMMON_WORDS]
    assert sorted((known["en"]["shares"][:-1] * sum(counts.values())).round().astype(int), reverse=True) == top
    p, q = np.array([[1, 0], [1, 1], [3, 1]]), np.array([0.5, 0.5])
    got = rules.distance(p, q)
    m = lambda a, b: sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(a, b, strict=True) if x)
    for row, d in zip(p / p.sum(axis=1, keepdims=True), got, strict=True):
        assert abs(d - math.sqrt((m(row, q) + m(q, row)) / 2)) < 1e-9


def test_quality_is_learned(spark, sf_dir):
    from tests.conftest import SF

    sf = SF.replace("sf0.001", "sf0.01")
    out = queries.op5_quality(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    held = out.merge(labels, on="doc_id")
    held = held[held.held_out]
    order = held.score.rank()
    good = held.quality == 1
    n, m = good.sum(), (~good).sum()
    assert (order[good].sum() - n * (n + 1) / 2) / (n * m) > 0.95
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.7)).all()


def plain_logit(net, t):
    """The network's forward pass on one text, in plain loops."""
    p = {k: v.astype(float) for k, v in net.p.items()}
    n = max(1, -(-len(t) // bytecnn.BLOCK_BYTES))
    raw = list(t) + [0] * (n * bytecnn.BLOCK_BYTES + bytecnn.FILTER_BYTES - len(t))
    blocks = []
    for b in range(n):
        act = [sum(p["tables"][j][raw[at + j]] for j in range(bytecnn.FILTER_BYTES)) for at in range(b * bytecnn.BLOCK_BYTES, (b + 1) * bytecnn.BLOCK_BYTES, bytecnn.STRIDE)]
        blocks.append(np.max(act, axis=0))
    chunks = [(blocks[i], blocks[i + 1]) for i in range(n - 1)] or [(blocks[0], blocks[0])]
    out = []
    for x, y in chunks:
        v = np.maximum(np.maximum(x, y) + p["bias"], 0)
        out.append(float(np.maximum(v @ p["w1"] + p["b1"], 0) @ p["w2"] + p["b2"][0]))
    return sum(out) / len(out)


def test_scores_are_those_of_the_network(spark, monkeypatch):
    net = bytecnn.Network(9)
    r = random.Random(2)
    texts = ["".join(r.choice("abc de\n.é日") for _ in range(r.choice([0, 1, 60, 120, 128, 300, 1000]))) for _ in range(30)] + [None, "", "x" * 128, "x" * 128]
    df = spark.createDataFrame([(i, t, "clash", 0.5) for i, t in enumerate(texts)], "doc_id long, text string, predicted string, score double")
    out = {x["doc_id"]: x["score"] for x in bytecnn.scored(df, net).collect()}
    for i, t in enumerate(texts):
        z = plain_logit(net, (t or "").encode())
        assert abs(out[i] - 1 / (1 + math.exp(-z))) < 1e-5
    assert out[len(texts) - 1] == out[len(texts) - 2]
    monkeypatch.setattr(bytecnn, "SLICE_BLOCKS", 2)
    for t in texts[:30]:
        if t and len(t.encode()) > bytecnn.BLOCK_BYTES:
            assert abs(net.long_logit(t.encode()) - plain_logit(net, t.encode())) < 1e-4


def test_gradients(monkeypatch):
    net = bytecnn.Network()
    texts, y, w = [b"abc def " * 40, b"%%%", b""], np.array([1.0, 0.0, 1.0], np.float32), np.array([1.0, 2.0, 0.5], np.float32)

    def loss():
        z = net.logits(texts).astype(float)
        return float((w * (np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y))).sum() / w.sum())

    before = {k: v.copy() for k, v in net.p.items()}
    net.step(texts, y, w, 0.0)
    grads = {k: v / 0.1 for k, v in net.m.items()}  # the first moment of the first step
    for name, at in (("w2", (3,)), ("b1", (5,)), ("w1", (7, 2)), ("bias", (4,)), ("b2", (0,)), ("tables", (2, ord("c"), 9)), ("tables", (0, ord("%"), 1)), ("tables", (5, 0, 3))):
        net.p = {k: v.astype(float) for k, v in before.items()}
        net.p[name][at] += 1e-4
        up = loss()
        net.p[name][at] -= 2e-4
        slope = (up - loss()) / 2e-4
        own = float(grads[name][at]) - (1e-5 * float(before[name][at]) if name == "tables" else 0)
        assert abs(slope - own) < 2e-3 * max(1, abs(slope)), (name, at, slope, own)
    net.p = before
    first = loss()
    for _ in range(30):
        net.step(texts, y, w, 0.01)
    assert loss() < 0.5 * first


def test_languages(spark, sf_dir):
    from tests.conftest import SF

    sf = SF.replace("sf0.001", "sf0.01")
    out = queries.op10_langid(spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    held = out[out.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97 and out.score.between(0, 1).all()
    model = langid.train([(b"aa bb aa cc " * 9, "x"), (b"zz yy zz qq " * 9, "y")] * 150)
    df = spark.createDataFrame([(1, None), (2, ""), (3, "12 34"), (4, "zz yy qq zz"), (5, "日本")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predicted(df, model).collect()}
    texts = [b"aa bb", b"", b"a", b"zz yy " * 50, "zz é".encode()]
    want = []
    for t in texts:  # brute force: the average of the rows of all n-grams
        raw = bytes(langid._LOWER[x] for x in b" " + t + b" ")
        rows = []
        for n in langid.ORDERS:
            for i in range(len(raw) - n + 1):
                code = (int.from_bytes(raw[i : i + n], "big") + n * 0x51ED27) * 0x9E3779B1 % 2**32 >> (32 - langid.BUCKET_BITS)
                rows.append(model["scores"][code].astype(float))
        want.append(np.mean(rows, axis=0) + model["bias"])
    assert np.allclose(langid.raw_scores(model, texts)[0], want, atol=1e-5)
    held_scores, langid.HELD_SCORES = langid.HELD_SCORES, 1
    try:
        assert np.allclose(langid.raw_scores(model, [x * 40 for x in texts])[0], np.stack([langid.raw_scores(model, [x * 40])[0][0] for x in texts]))
        small = langid.raw_scores(model, [b"zz yy " * 500])
        langid.HELD_SCORES = held_scores
        assert np.allclose(langid.raw_scores(model, [b"zz yy " * 500])[0], small[0]) and langid.raw_scores(model, [b"zz yy " * 500])[1] == small[1]
    finally:
        langid.HELD_SCORES = held_scores
    hard = [(7, "zz yy zz", "x", 1.0), (7, "zz yy zz", "x", 1.0), (8, "aa bb " * 30_000, "y", 0.0), (9, "?!", None, 0.0)]
    rows_ = langid.predicted(spark.createDataFrame(hard, "doc_id long, text string, lang_pred string, score double"), model).collect()
    assert sorted((r["doc_id"], r["lang_pred"], r["accepted"]) for r in rows_)[-1][1:] == ("und", False) and len(rows_) == 4
    assert len({(r["lang_pred"], r["score"]) for r in rows_ if r["doc_id"] == 7}) == 1
    assert all(r["accepted"] == (r["score"] >= model["least"]) for r in rows_ if r["doc_id"] != 9)
    assert (got[1], got[2], got[3], got[4]) == ("und", "und", "und", "y") and got[5] in ("x", "y")


def test_language_model(docs, rows):
    out = {r["doc_id"]: r for r in pitmanyor.scored(docs).collect()}
    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows}
    toks = {r[0]: [*words(lower(r[1])), None] for r in rows}
    counts = Counter(w for k, t in toks.items() if not held[k] for w in t)
    n, v = sum(counts.values()), len(counts)
    for k, t in toks.items():
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)
        got = out[k]
        assert (got["held_out"], got["n_tokens"], got["n_known"], got["train_tokens"]) == (held[k], len(t), sum(counts[w] > 0 for w in t), n)
        assert abs(got["base_score"] - base) < 1e-6 * max(1, abs(base)) and got["score"] < 0


def partitions(items):
    if not items:
        yield []
        return
    for p in partitions(items[1:]):
        for i in range(len(p)):
            yield [*p[:i], [items[0], *p[i]], *p[i + 1 :]]
        yield [[items[0]], *p]


def test_customers_that_sit_alone():
    d = 0.4
    for c in range(1, 8):
        total, single = Counter(), Counter()
        for p in partitions(list(range(c))):
            weight = math.prod(math.prod(i - d for i in range(1, len(x))) for x in p)
            total[len(p)] += weight
            single[len(p)] += weight * ([0] in p)
        got = pitmanyor.alone(np.full(c, c), np.arange(1, c + 1), d)
        assert np.allclose(got, [single[t] / total[t] for t in range(1, c + 1)])
    near = pitmanyor.alone(np.array([pitmanyor.MOST_EXACT, pitmanyor.MOST_EXACT + 1]), np.array([5, 5]), d)
    assert abs(near[0] / near[1] - 1) < 0.15


@pytest.mark.parametrize("side_by_side", [1, 99])
def test_seats_have_the_distribution_of_the_model(monkeypatch, side_by_side):
    """One restaurant, many times: the numbers of tables follow the exact posterior, found by enumeration."""
    monkeypatch.setattr(pitmanyor, "SIDE_BY_SIDE", side_by_side)
    counts, base, d, strength, n = [2, 3, 5, 1], [0.3, 0.2, 0.4, 0.1], 0.5, 1.3, 4000
    stirling = {(0, 0): 1.0}
    for c in range(1, 6):
        for t in range(1, c + 1):
            stirling[c, t] = stirling.get((c - 1, t - 1), 0) + (c - 1 - t * d) * stirling.get((c - 1, t), 0)
    weights = {}
    for t in np.ndindex(*counts):
        t = tuple(x + 1 for x in t)
        weights[t] = math.prod(strength + d * i for i in range(1, sum(t))) * math.prod(stirling[c, x] * b**x for c, x, b in zip(counts, t, base, strict=True))
    exact = sum(np.array(t) * w for t, w in weights.items()) / sum(weights.values())
    owner = np.repeat(np.arange(n), 4)
    seats = pitmanyor.Restaurants(owner, n, np.tile(counts, n), np.tile(base, n), d, strength, np.random.default_rng(3))
    for _ in range(40):
        seats.sweep()
    mean = np.mean([(seats.sweep(), seats.tables.reshape(n, 4).mean(axis=0))[1] for _ in range(20)], axis=0)
    assert np.abs(mean - exact).max() < 0.03


def test_language_model_sums_to_one():
    r = np.random.default_rng(4)
    n = 40
    pairs = (r.integers(0, 30, (n, n)) * (r.random((n, n)) < 0.3)).astype(np.int64)
    pairs[0] = 0  # never met in training
    pairs[:, 5] = 0
    guests = (pairs > 0).sum(axis=0)
    words = int((guests > 0).sum())
    tables = pitmanyor.root_tables(guests, words, 0.4, 1.0, r)
    assert (tables[guests > 0] >= 1).all() and (tables <= guests).all()
    parent = pitmanyor.Parent(float(guests.sum()), float(tables.sum()), words, 0.4, 1.0)
    base = parent.of(guests - 0.4 * tables)
    assert abs(base[guests > 0].sum() + parent.of(np.zeros(1))[0] - 1) < 1e-9
    seats = pitmanyor.Restaurants(np.repeat(np.arange(n), n), n, pairs.ravel(), np.tile(base, n), 0.6, 2.0, r)
    p = seats.probabilities(seats.averaged(6)).reshape(n, n)
    free = np.array([seats.probabilities(seats.tables.astype(float))[k * n + 5] for k in range(n)])  # the word never seen: as unknown
    assert np.allclose(p[:, guests > 0].sum(axis=1) + p[:, 5], 1, atol=1e-9) and (free > 0).all()
    for values, up in ((np.array([3, 5, 2**63], np.uint64), True), (np.empty(0, np.uint64), True), (np.array([9, 1], np.uint64), False)):
        assert (pitmanyor.grown(pitmanyor.shrunk(values, "<u8", up), "<u8", up) == values).all()


class Seating:
    """Brute force: restaurants with table sizes, one customer at a time, and the parent's customers one for each table."""

    def __init__(self, pairs, words, d, d_root, strength, root_strength, seed):
        self.r, self.words, self.d, self.strength = random.Random(seed), words, (d, d_root), (strength, root_strength)
        self.pairs = pairs
        self.sizes = {p: [] for p in pairs}
        self.root = {}
        self.tables = Counter()
        for p, c in pairs.items():
            for _ in range(c):
                self.enter(p)

    def root_p(self, w):
        t = self.root.get(w, [])
        total, rows = sum(map(len, self.root.values())), sum(map(sum, self.root.values()))
        return (sum(t) - self.d[1] * len(t) + (self.strength[1] + self.d[1] * total) / (self.words + 1)) / (self.strength[1] + rows)

    def seat(self, sizes, new, d):
        at = self.r.uniform(0, sum(sizes) - d * len(sizes) + new)
        for i, n in enumerate(sizes):
            at -= n - d
            if at < 0:
                sizes[i] += 1
                return False
        sizes.append(1)
        return True

    def leave(self, sizes):
        i = self.r.choices(range(len(sizes)), sizes)[0]
        sizes[i] -= 1
        if not sizes[i]:
            del sizes[i]
            return True
        return False

    def enter(self, p):
        if self.seat(self.sizes[p], (self.strength[0] + self.d[0] * self.tables[p[0]]) * self.root_p(p[1]), self.d[0]):
            self.tables[p[0]] += 1
            own = self.root.setdefault(p[1], [])
            self.seat(own, (self.strength[1] + self.d[1] * sum(map(len, self.root.values()))) / (self.words + 1), self.d[1])

    def sweep(self):
        for p, c in self.pairs.items():
            for _ in range(c):
                if self.leave(self.sizes[p]):
                    self.tables[p[0]] -= 1
                    self.leave(self.root[p[1]])
                self.enter(p)

    def p(self, u, w, rows):
        own = self.sizes.get((u, w), [])
        return (sum(own) - self.d[0] * len(own) + (self.strength[0] + self.d[0] * self.tables[u]) * self.root_p(w)) / (self.strength[0] + rows[u])


def test_scores_are_near_those_of_plain_seating(spark):
    r = random.Random(11)
    names = [f"w{k}" for k in range(25)]
    texts = [(k, " ".join(r.choices(names, [1 / (1 + (i + k) % 25) for i in range(25)], k=14))) for k in range(70)]
    held = {k for k, _ in texts if zlib.crc32(str(k).encode()) % 7 == 2}
    pairs, rows, seen = Counter(), Counter(), Counter()
    for k, t in texts:
        if k not in held:
            own = ["", *t.split(), ""]
            pairs.update(zip(own[:-1], own[1:], strict=True))
            seen.update(own[1:])
    for (u, _), c in pairs.items():
        rows[u] += c
    ones = lambda c: ([*c.values()].count(1), [*c.values()].count(2))
    plain = Seating(pairs, len(seen), pitmanyor.discount(*ones(pairs)), pitmanyor.discount(*ones(seen)), 1.0, 1.0, 5)
    for _ in range(10):
        plain.sweep()
    total = Counter()
    for _ in range(15):
        plain.sweep()
        for k, t in texts:
            own = ["", *t.split(), ""]
            for i, (u, w) in enumerate(zip(own[:-1], own[1:], strict=True)):
                total[k, i] += plain.p(u, w, rows) / 15
    out = {x["doc_id"]: x["score"] / x["n_tokens"] for x in pitmanyor.scored(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for k, t in texts:
        own = sum(math.log10(total[k, i]) for i in range(15)) / 15
        assert abs(out[k] - own) < 0.04, (k, k in held, out[k], own)


def test_every_pair_of_words_counts(spark):
    r = random.Random(5)
    names = [f"w{k}" for k in range(1400)]  # each as frequent as the others, more than a thousand
    follow = dict(zip(names, r.sample(names, len(names)), strict=True))
    texts = [(k, " ".join(f"{w} {follow[w]}" for w in r.sample(names, 700))) for k in range(14)]
    held = [k for k in range(1000, 1100) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    w = names[::10]
    texts += [(held[0], " ".join(f"{x} {follow[x]}" for x in w)), (held[1], " ".join(f"{x} {follow[y]}" for x, y in zip(w, w[1:] + w[:1], strict=True)))]
    out = {x["doc_id"]: x for x in pitmanyor.scored(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert out[held[0]]["held_out"] and out[held[0]]["n_known"] == out[held[1]]["n_known"] and out[held[0]]["n_tokens"] == out[held[1]]["n_tokens"]
    assert out[held[0]]["score"] - out[held[1]]["score"] > len(w)  # before: the same class for all


def test_mixing(docs, rows):
    out = mixing.mixed(docs).collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    total = sum(sizes.values()) * 1.5
    weights = dict(zip(["s1", "s2", None], (3, 1, 2), strict=True))
    target, open_ = {}, dict(weights)
    while open_:  # reshare until none is above
        left = total - sum(target.values())
        level = left / sum(open_.values())
        above = [s for s in open_ if level * open_[s] > 2 * sizes[s]]
        for s in above or list(open_):
            target[s] = 2 * sizes[s] if above else level * open_[s]
            del open_[s]
        if not above:
            break
    source = {r[0]: r[3] for r in rows}
    for r in out:
        assert r["size"] == len(words(rows[r["doc_id"]][1])) and 0 <= r["taken"] <= 2 * r["size"] and abs(r["target"] - target[source[r["doc_id"]]]) < 1e-6
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    mixed = mixing.curriculum(docs)
    assert mixed.columns == docs.columns
    got = Counter()
    for r in mixed.collect():
        got[r["source"]] += len(words(r["text"]))
    assert got == taken


def test_the_pipeline_mixes_whole_documents(spark, docs, rows, sf_dir):
    import corpus_pipeline as pipeline

    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mixed(docs).collect()}
    assert any(t % max(1, n) for t, n in taken.values())  # a source's demand ends within a document
    got = Counter()
    for r in pipeline.mixed_sources(spark, docs, sf_dir).collect():
        assert r["text"] == rows[r["doc_id"]][1]
        got[r["doc_id"]] += 1
    assert all(got[k] == math.ceil(t / n) if n else not got[k] for k, (t, n) in taken.items())


def test_positions():
    import pyspark.sql  # noqa: F401

    for ramp in mixing.RAMPS:
        for t in (0.0, 0.3, 1.0):
            share = (1 + ramp) * t - ramp * t * t
            root = share if ramp == 0 else 2 * share / (1 + ramp + math.sqrt((1 + ramp) ** 2 - 4 * ramp * share))
            assert abs(root - t) < 1e-12


CLASHES = ("kept", "n_words", "word_chars", "base_failed", "class_distance", "size", "source_size", "target", "taken", "position", "component_id", "n_shingles", "sig", "h1", "n", "least", "root", "bands", "key", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset", "part", "nth", "number", "score", "held_out", "predicted", "lang_pred", "accepted", "n_tokens", "base_score", "home", "rows", "row", "range", "cells", "mark", "_salt", "a", "b")


def test_other_columns_of_any_name(spark, docs, rows, sf_dir):
    """Extra columns with the names of results and of columns within change nothing, in operators and stages."""
    import corpus_pipeline as pipeline

    own = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    more = own.withColumns({c: F.lit("clash") for c in CLASHES})
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, len(rows), 3)], "doc_id long, quality int, toxic int")
    made = {
        "op1": lambda d: minhash.near_duplicates(d, 3, 85).select("doc_id", "component_id", "n_shingles"),
        "op2": lambda d: substrings.without_repeats(d).select("doc_id", "_sub_n_words", "_sub_n_removed"),
        "op4": lambda d: tokens.written_and_read(d).select("doc_id", "start", "ids_crc32"),
        "op5": lambda d: bytecnn.classified(d, labels).select("doc_id", "predicted"),
        "op6": lambda d: rules.judged(d).select("doc_id", "kept", "n_repeat_words"),
        "op7": lambda d: pitmanyor.scored(d).select("doc_id", "n_known", F.round("base_score", 6)),
        "op8": lambda d: packing.packed(d).select("doc_id", "piece", "ids_crc32"),
        "op9": lambda d: mixing.mixed(d).select("doc_id", "size", "taken"),
        "op10": lambda d: langid.identified(d).select("doc_id", "lang_pred"),
    }
    order = lambda d: sorted((tuple(r) for r in d.collect()), key=lambda r: (r[0] is None, str(r)))
    for name, f in made.items():
        assert order(f(more)) == order(f(own)), name
    plain, wide = own, more
    for name, stage in pipeline.STAGES[:-1]:
        plain, wide = (stage(spark, d, sf_dir).cache() for d in (plain, wide))
        assert wide.columns == more.columns and order(wide.select(*own.columns)) == order(plain), name
        assert wide.where("kept <> 'clash' or ids <> 'clash'").count() == 0
    last = [stage for _, stage in pipeline.STAGES][-1]
    assert last(spark, wide, sf_dir).select("doc_id", "start", "ids_crc32").count() == last(spark, plain, sf_dir).count()


def test_empty_tables(spark, empty):
    assert minhash.near_duplicates(empty).count() == 0 and minhash.deduplicated(empty).count() == 0
    assert substrings.without_repeats(empty).count() == 0
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert tokens.written_and_read(empty).count() == 0 and packing.packed(empty).count() == 0
    assert bytecnn.classified(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    assert rules.judged(empty).count() == 0 and pitmanyor.scored(empty).count() == 0
    assert mixing.mixed(empty).count() == 0 and mixing.curriculum(empty).count() == 0 and langid.identified(empty).count() == 0


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    judged = {r["doc_id"]: r["kept"] for r in rules.judged(docs).collect()}
    one = pipeline.quality_rules(spark, docs, sf_dir).cache()
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(k for k, v in judged.items() if v)
    two = pipeline.near_duplicates(spark, one, sf_dir).cache()
    sets = {}
    for r in one.collect():
        w = words(lower(r["text"]))
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    names = sorted(sets)
    links = [(i, j) for i in range(len(names)) for j in range(i) if 100 * len(sets[names[i]] & sets[names[j]]) >= 80 * len(sets[names[i]] | sets[names[j]])]
    roots = closure(len(names), links)
    assert sorted(r["doc_id"] for r in two.collect()) == sorted({names[x] for x in roots})
    three = pipeline.repeated_passages(spark, two, sf_dir).cache()
    assert three.columns == docs.columns
    kept = sorted((r["doc_id"], r["text"]) for r in two.collect())
    cut = {i: (t if not gone else left) for (i, t), (_, gone, left) in zip(kept, kept_of([t for _, t in kept]), strict=True)}
    assert {r["doc_id"]: r["text"] for r in three.collect()} == cut
    four = pipeline.mixed_sources(spark, three, sf_dir).cache()
    turns = turns_of([(r["doc_id"], r["text"], r["source"]) for r in three.collect()])
    got = Counter()
    for r in four.collect():
        assert r["text"] == cut[r["doc_id"]]
        got[r["doc_id"]] += 1
    assert got == turns
    five = pipeline.packed_sequences(spark, four, sf_dir).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_tokenizer())
    whole = {i: [*t.encode(x, add_special_tokens=False).ids, 0] for i, x in cut.items()}
    pieces = Counter()
    for r in five:
        ids = tokens.unpack(bytes(r["ids"]), 16, r["length"]).tolist()
        assert ids == whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        pieces[r["doc_id"], r["start"], r["length"]] += 1
    expected = Counter()
    for i, n in turns.items():
        for start, length in packing.cut(len(whole[i]), packing.SEQUENCE_TOKENS):
            expected[i, start, length] += n
    assert pieces == expected
    places = {}
    for r in five:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048
    last = pipeline.run(spark, sf_dir)
    assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in last.collect()) == sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in five)


def turns_of(docs):
    """How often each document is taken (whole, also where its source's demand ends within it), by plain sums."""
    sizes, by_source = Counter(), {}
    for i, t, s in docs:
        sizes[s] += len(words(t))
        by_source.setdefault(s, []).append((int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), i, len(words(t))))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()) * 1.5, {}, dict(weights)
    while open_:
        level = (total - sum(target.values())) / sum(open_.values())
        above = [s for s in open_ if level * open_[s] > 2 * sizes[s]]
        for s in above or list(open_):
            target[s] = 2 * sizes[s] if above else level * open_[s]
            del open_[s]
        if not above:
            break
    out = Counter()
    for s, own in by_source.items():
        left = round(target[s])
        for _ in range(2):
            for _, i, n in sorted(own):
                if left > 0 and n:
                    out[i] += 1
                    left -= n
    return out
