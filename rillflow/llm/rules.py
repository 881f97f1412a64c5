"""Quality rules: divergence of a document from references of its language.

Two histograms describe a document: its characters by class, and its words by
the common words of a language (one more bin holds all others). References are
the same histograms summed over all documents of a language. A document is
rejected if its Jensen-Shannon distance to the nearest reference is above a
threshold, where the text is long enough for a histogram to mean anything. The
words' threshold follows the reference: it lies just below the distance of a
text that has none of the common words.

Defined results: a null or empty text has no words, fails the base rules and
is not kept; a document with a null language takes no part in the references;
every document is compared with all of them, whatever its language; with no
reference at all (empty table, no language known) only the base rules decide.
Repeated rows count as often as they stand there. Columns to keep pass through
untouched, ``accepted`` keeps all, whatever their names. Long texts go through
in segments; 8 bytes are held for each of their words and lines.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage
from . import text as tx

MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20
#: Common words of a language that have a bin of their own.
COMMON_WORDS = 64
#: Shortest text, in characters and in words, that the two histograms can judge.
MIN_CHARS_FOR_CLASSES, MIN_WORDS_FOR_COMMON = 200, 60
#: Largest Jensen-Shannon distance (base 2, in [0, 1]) of a kept document by classes, and by words as a share of the
#: distance that a text without any common word has. Measured on labelled documents of sf0.1 of these lengths: good
#: ones have at most 0.33 by classes (99.9 %: 0.24), and 0.93 of the distance without common words (99.9 %: 0.88).
MAX_CLASS_DISTANCE, WORD_SHARE = 0.31, 0.96
SYMBOLS = b"#*$%&|<>"

# Character classes by byte; bytes above 127 lead or continue letters of other scripts.
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "mark", "symbol", "other", "wide")
_CLASS = np.full(256, 8, np.int64)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[9, 32]] = 3
_CLASS[[10, 11, 12, 13]] = 4
_CLASS[[ord(c) for c in ".,;:!?"]] = 5
_CLASS[[ord(c) for c in "'\"-()"]] = 6
_CLASS[list(SYMBOLS)] = 7
_CLASS[128:] = 9
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?\"'()"]] = True
#: The hash of a word that has nothing but marks.
EMPTY = tx.mix(np.zeros(1, np.uint64))[0]


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def class_counts(words: tx.Words) -> np.ndarray:
    """Bytes of each class in each text; what separates the texts isn't counted."""
    kinds = _CLASS[words.raw]
    texts = np.repeat(np.arange(len(words.offsets) - 1), np.diff(words.offsets))
    table = np.bincount(texts * len(CLASSES) + kinds, minlength=(len(words.offsets) - 1) * len(CLASSES)).reshape(-1, len(CLASSES))
    table[:, 4] -= 1
    return table


def base_counts(words: tx.Words, texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    raw, owner = words.raw, words.owner
    is_char = ((raw & 0xC0) != 0x80) & ~tx._SPACE[raw]
    symbol = np.isin(raw, np.frombuffer(SYMBOLS, np.uint8))
    dup = []
    for t in texts:
        lines = [x for x in (t or b"").split(b"\n") if x.split()]
        dup.append(len(lines) - len(set(lines)))
    hashes, begin = tx.windows(words.hashes(), words.first, REPEAT_WINDOW)
    repeats = np.zeros(len(words.starts) + 1, np.int64)
    if len(hashes):
        key = hashes ^ tx.mix(owner[begin].astype(np.uint64))
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        at = begin[counts[inverse] > 1]
        np.add.at(repeats, at, 1)
        np.add.at(repeats, at + REPEAT_WINDOW, -1)
    covered = (np.cumsum(repeats[:-1]) > 0).astype(np.int64)
    n = len(texts)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": _sums(is_char, words.offsets),
        "n_symbols": _sums(symbol, words.offsets),
        "n_dup_lines": np.array(dup, np.int64).reshape(n),
        "n_repeat_words": np.bincount(owner, covered, n).astype(np.int64) if len(owner) else np.zeros(n, np.int64),
    }


def core_hashes(words: tx.Words) -> np.ndarray:
    """Hashes of the words in lower case, without marks at their ends."""
    raw = np.frombuffer(words.raw.tobytes().lower(), np.uint8)
    starts, ends = words.starts.copy(), words.ends.copy()
    for _ in range(4):  # few marks at once, words with more one by one
        starts[_MARK[raw[starts]] & (starts < ends)] += 1
        ends[_MARK[raw[ends - 1]] & (starts < ends)] -= 1
    for i in np.flatnonzero((starts < ends) & (_MARK[raw[starts]] | _MARK[raw[ends - 1]])).tolist():
        plain = ~_MARK[raw[starts[i] : ends[i]]]
        if plain.any():
            starts[i], ends[i] = starts[i] + int(plain.argmax()), ends[i] - int(plain[::-1].argmax())
        else:
            starts[i] = ends[i]
    return tx.spans_of_bytes(raw, starts, ends)


def long_counts(text: bytes) -> dict[str, int]:
    """base_counts of one long text, segment by segment; eight bytes are held for each word and line."""
    hashes, n, chars, symbols = [], 0, 0, 0
    for part in tx.segments(text, REPEAT_WINDOW - 1):
        words = tx.split([part])
        hashes.append(tx.windows(words.hashes(), words.first, REPEAT_WINDOW)[0])
    for part in tx.segments(text, 0):
        own = base_counts(tx.split([part]), [b""])
        n, chars, symbols = n + int(own["n_words"][0]), chars + int(own["word_chars"][0]), symbols + int(own["n_symbols"][0])
    every = np.concatenate(hashes)
    del hashes
    order = np.sort(every)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    del order
    near = np.searchsorted(twice, every)
    at = np.flatnonzero(np.append(twice, every[:1])[near] == every) if len(twice) else np.empty(0, np.int64)
    at = at[near[at] < len(twice)]
    repeats = int(np.minimum(np.diff(at), REPEAT_WINDOW).sum()) + REPEAT_WINDOW * bool(len(at))
    lines, begin = [np.empty(0, np.int64)], 0
    while begin < len(text):
        end = text.find(b"\n", begin + tx.CHUNK_BYTES)
        end = len(text) if end < 0 else end
        lines.append(np.array([hash(x) for x in text[begin:end].split(b"\n") if x.strip()], np.int64))
        begin = end + 1
    every = np.concatenate(lines)
    return {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": len(every) - len(np.unique(every)), "n_repeat_words": repeats}


def references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, dict]:
    """Per language: its common words (as hashes) with their shares, and its class shares, from all documents.

    Every chunk sums its words by language and hash and sends them packed, by
    ranges of the hash; each range gives its own top list. What reaches the
    driver is bounded: COMMON_WORDS entries for each language and range.
    """
    storage.small_batches(docs.sparkSession)
    parts = max(64, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, langs in (part for rows in tx.chunked(batches, ["text", "lang"]) for part in tx.cut_up(*rows)):
            words = tx.split(texts)
            classes, hashes = class_counts(words), core_hashes(words)
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            of_word = number[words.owner]
            rows: list[tuple] = []
            for k, lang in enumerate(names):
                values, n = np.unique(hashes[of_word == k], return_counts=True)
                part = (values >> np.uint64(32)).astype(np.int64) * parts >> 32
                cut = np.searchsorted(part, np.arange(parts + 1))
                for p, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
                    if i < j:
                        rows.append((lang, p, tx.packed(values[i:j], "<u8"), tx.packed(n[i:j], "<u4"), b""))
                rows.append((lang, 0, b"", b"", tx.packed(classes[number == k].sum(axis=0), "<i8")))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["lang", "part", "words", "n", "classes"])

    def merged(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, classes = (np.empty(0, np.uint64), np.empty(0, np.int64)), np.zeros(len(CLASSES), np.int64)
        fresh: list[tuple[np.ndarray, np.ndarray]] = []

        def fold(held):
            values = np.concatenate([held[0], *[v for v, _ in fresh]])
            counts = np.concatenate([held[1], *[c for _, c in fresh]])
            fresh.clear()
            values, place = np.unique(values, return_inverse=True)
            return values, np.bincount(place, counts, len(values)).astype(np.int64)

        for batch in batches:
            for words, n, kinds in zip(*(batch.column(c).to_pylist() for c in ("words", "n", "classes")), strict=True):
                fresh.append((np.frombuffer(words, "<u8"), np.frombuffer(n, "<u4").astype(np.int64)))
                classes += np.frombuffer(kinds, "<i8") if kinds else 0
                if len(fresh) >= 256:
                    held = fold(held)
        values, n = fold(held)
        top = np.lexsort((values, -n))[:COMMON_WORDS]
        top = top[values[top] != EMPTY]
        row = [key[0], pa.scalar(tx.packed(values[top], "<u8")), pa.scalar(tx.packed(n[top], "<i8")), pa.scalar(int(n.sum())), pa.scalar(tx.packed(classes, "<i8"))]
        yield pa.RecordBatch.from_arrays([pa.array([x.as_py()], t) for x, t in zip(row, (pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.binary()), strict=True)], ["lang", "words", "n", "total", "classes"])

    source = docs.where(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("binary").alias("text"), F.col(lang_col).alias("lang"))
    counts = source.mapInArrow(counted, "lang string, part int, words binary, n binary, classes binary")
    best = counts.groupBy("lang", "part").applyInArrow(merged, "lang string, words binary, n binary, total long, classes binary")
    found: dict[str, list] = {}
    for r in best.toLocalIterator():
        kinds, total, tops = found.setdefault(r["lang"], [np.zeros(len(CLASSES)), 0, []])
        tops.extend(zip(np.frombuffer(r["n"], "<i8").tolist(), np.frombuffer(r["words"], "<u8").tolist(), strict=True))
        tops.sort(key=lambda x: (-x[0], x[1]))
        del tops[COMMON_WORDS:]
        found[r["lang"]] = [kinds + np.frombuffer(r["classes"], "<i8"), total + r["total"], tops]
    out = {}
    for lang, (kinds, total, tops) in sorted(found.items()):
        if not kinds.sum() or not total:
            continue
        hashes = np.array([h for _, h in tops], np.uint64)
        shares = np.array([n for n, _ in tops], float)
        order = np.argsort(hashes)
        shares = np.append(shares[order], max(0.0, total - shares.sum()))
        out[lang] = {"words": hashes[order], "shares": shares / shares.sum(), "classes": kinds / kinds.sum()}
    return out


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of the rows of p and one distribution q."""
    total = p.sum(axis=1, keepdims=True)
    p = p / np.maximum(total, 1e-300)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0.0).sum(axis=1)
        b = np.where(q > 0, q * np.log2(q / m), 0.0).sum(axis=1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


def most_word_distance(shares: np.ndarray) -> float:
    """The largest distance by words that a reference allows."""
    none = np.zeros((1, len(shares)))
    none[0, -1] = 1
    return WORD_SHARE * float(distance(none, shares)[0])


def word_table(words: tx.Words, hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Counts of the common words in each text; the last column counts all others."""
    other, n = len(common), len(words.first) - 1
    place = np.searchsorted(common, hashes)
    if other:
        place[(place == other) | (common[np.minimum(place, other - 1)] != hashes)] = other
    return np.bincount(words.owner * (other + 1) + place, minlength=n * (other + 1)).reshape(n, other + 1)


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double, base_failed boolean, kept boolean"


def judged(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, known: dict[str, dict] | None = None) -> DataFrame:
    """The columns ``keep`` of each document, its counts, distances and the verdict.

    Columns to keep must not have the names of the others (see ``accepted``).
    """
    keep = ["doc_id"] if keep is None else keep
    known = references(docs, text_col=text_col) if known is None else known
    model = docs.sparkSession.sparkContext.broadcast(pickle.dumps(known))
    fields = [f for f in docs.schema.fields if f.name in keep]
    carried = [f"keep_{i}" for i in range(len(fields))]
    cache: dict = {}

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = cache.setdefault("refs", pickle.loads(model.value))
        kinds: dict[str, pa.DataType] = {}

        def typed(stream):
            for b in stream:
                kinds.update({c: b.schema.field(c).type for c in carried})
                yield b

        for texts, *rest in tx.chunked(typed(batches), ["text", *carried]):
            n = len(texts)
            long = [i for i, t in enumerate(texts) if t and len(t) > tx.CHUNK_BYTES]
            short = [None if i in long else t for i, t in enumerate(texts)] if long else texts
            words = tx.split(short)
            out = base_counts(words, short)
            classes, hashes = class_counts(words), core_hashes(words)
            tables = [word_table(words, hashes, r["words"]) for r in refs.values()]
            for i in long:
                for name, value in long_counts(texts[i]).items():
                    out[name][i] = value
                for (part,) in tx.cut_up([texts[i]]):
                    words = tx.split(part)
                    classes[i] += class_counts(words).sum(axis=0)
                    hashes = core_hashes(words)
                    for table, r in zip(tables, refs.values(), strict=True):
                        table[i] += word_table(words, hashes, r["words"]).sum(axis=0)
            by_class, by_word, most = np.full(n, np.nan), np.full(n, np.nan), np.full(n, np.nan)
            if refs:
                d_class = np.stack([distance(classes, r["classes"]) for r in refs.values()])
                d_word = np.stack([distance(table, r["shares"]) for table, r in zip(tables, refs.values(), strict=True)])
                nearest = (d_class + d_word).argmin(axis=0)
                by_class, by_word = d_class[nearest, np.arange(n)], d_word[nearest, np.arange(n)]
                most = np.array([most_word_distance(r["shares"]) for r in refs.values()])[nearest]
            failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * out["n_words"])
            with np.errstate(invalid="ignore"):
                far = (by_class > MAX_CLASS_DISTANCE) & (classes.sum(axis=1) >= MIN_CHARS_FOR_CLASSES)
                far |= (by_word > most) & (out["n_words"] >= MIN_WORDS_FOR_COMMON)
            values = [pa.array(r, kinds[c]) for r, c in zip(rest, carried, strict=True)]
            values += [pa.array(v) for v in out.values()] + [pa.array(by_class), pa.array(by_word), pa.array(failed), pa.array(~failed & ~far)]
            yield pa.RecordBatch.from_arrays(values, [*carried, *[x.split()[0] for x in SCHEMA.split(", ")]])

    source = docs.select(F.col(text_col).cast("binary").alias("text"), *[F.col(f.name).alias(c) for f, c in zip(fields, carried, strict=True)])
    schema = ", ".join(f"{c} {f.dataType.simpleString()}" for f, c in zip(fields, carried, strict=True)) + ", " + SCHEMA
    out = source.mapInArrow(verdicts, schema)
    return out.select(*[F.col(c).alias(f.name) for f, c in zip(fields, carried, strict=True)], *[x.split()[0] for x in SCHEMA.split(", ")])


def accepted(docs: DataFrame, known: dict[str, dict] | None = None) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    rows = docs.select("text", "lang", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return judged(rows, keep=["row"], known=known).where("kept").select("row.*")
