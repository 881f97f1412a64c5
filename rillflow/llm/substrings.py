"""Removal of word windows that occur more than once in a corpus.

A window is a number of consecutive words of one document. Two passes find the
windows that start at two or more places:

1. Every window is sampled by its anchor, the run of ANCHOR_WORDS words in it
   with the smallest hash. Equal windows have equal anchors at equal places, so
   the count of an anchor is never below that of its windows. Each partition
   of the documents makes a sketch of its anchors, and the partitions' sketches
   are merged, range of cells by range of cells, to one count-min sketch. A
   range answers each partition with those of its cells that count two or more.
2. Windows whose anchor is in such cells in all rows of the sketch are grouped
   exactly, by ranges of their anchor's hash. Those that repeat within a batch
   of a task are settled there and sent on once, so no group is larger than the
   number of batches, however often a passage occurs.

The sketch's width follows the input without a bound: no task and no driver
holds all of it, since only the answers of a partition come back to it. It
overestimates, so no repeated window is lost, and at every size only a small
share of the others is sent to the second pass (load of a cell about 1/16).

The documents are read once and kept in chunks in the shared folder. Both
answers, by partition, are read there by the tasks that hold the chunks, so
texts are never shuffled. Windows are told apart by a 64-bit hash within a
range of 64-bit anchor hashes.

Defined results: null and empty texts and texts shorter than a window have
nothing removed; a repeat within one document counts; rows that repeat count
as often as they stand there; an empty table gives no rows; all columns pass
through, names that begin with ``_sub_`` are reserved. Long texts go through
in overlapping segments.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import storage
from . import text as tx

WINDOW_WORDS, ANCHOR_WORDS, DEPTH = 35, 20, 2
#: Bytes of text for each cell of a row of the sketch, and for each range of the second pass.
BYTES_PER_CELL, BYTES_PER_RANGE = 4, 16 << 20
#: Bytes of text for each range of the sketch, least and most, and ranges from which on they grow.
LEAST_RANGE, MOST_RANGE, MANY_RANGES = 64 << 20, 512 << 20, 4096
#: Anchors and windows that a task holds before it sends them.
HELD_ANCHORS, HELD_WINDOWS = 1 << 21, 1 << 20
_SEEDS = np.random.default_rng(35).integers(1, 2**63, DEPTH + 1, dtype=np.uint64)
U = np.uint64


def anchors(hashes: np.ndarray, begin: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the place and the hash of its anchor (the leftmost of equal ones)."""
    grams = tx.spans_of_words(hashes, anchor)
    bits = max(24, int(len(grams)).bit_length())
    low = U((1 << bits) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    reach, width = 1, window - anchor + 1
    while reach < width:  # minima over reach places, doubled
        step = min(reach, width - reach)
        key = np.minimum(key[: len(key) - step], key[step:])
        reach += step
    place = (key[begin] & low).astype(np.int64)
    return place, grams[place]


class Shape:
    """Ranges of the sketch, cells of a range (as bits) and ranges of the second pass for so many bytes of text."""

    def __init__(self, size: int):
        self.ranges = max(16, min(size // LEAST_RANGE, MANY_RANGES), size // MOST_RANGE)
        self.bits = max(10, (size // self.ranges // BYTES_PER_CELL).bit_length())
        self.groups = max(16, size // BYTES_PER_RANGE)

    def cells(self, anchor: np.ndarray, row: int) -> np.ndarray:
        """Range (upper half) and cell (lower half) of each anchor."""
        mixed = tx.mix(anchor ^ _SEEDS[row])
        return ((mixed >> U(32)) * U(self.ranges) >> U(32)) << U(32) | mixed & U((1 << self.bits) - 1)


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[t]) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])


def _lists(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in names), strict=True)


def _windows(texts: list[bytes | None], window: int, anchor: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The windows of a chunk's texts: word hashes, starts in them, places and hashes of the anchors, first words in the chunk.

    One item if all texts are short, else one for each segment of each text.
    """
    if all(not t or len(t) <= tx.CHUNK_BYTES for t in texts):
        parts: Iterator[tuple[list, int]] = iter([(texts, 0)])
    else:
        parts = (([part], (window - 1) * (k > 0)) for t in texts for k, part in enumerate(tx.segments(t or b"", window - 1)))
    base = 0
    for own, again in parts:
        words = tx.split(own)
        hashes = words.hashes()
        room = np.maximum(words.counts - window + 1, 0)
        begin = np.repeat(words.first[:-1] - np.concatenate(([0], np.cumsum(room)[:-1])), room) + np.arange(room.sum())
        place, value = anchors(hashes, begin, window, anchor) if len(begin) else (begin, np.empty(0, np.uint64))
        yield hashes, begin, place, value, begin + (base - again)
        base += len(hashes) - again


SKETCHED = "home long, number int, rows binary, row int, range int, cells binary"


def sketched(docs: DataFrame, shape: Shape, window: int, anchor: int) -> DataFrame:
    """Chunks of ``docs`` (home, number, rows), and the sketches of partitions by row and range (home, row, range, cells).

    ``home`` is the partition that made the chunk, ``number`` counts its
    chunks, ``rows`` has all their columns. A cell stands with a bit for
    "more than once".
    """
    text_at = docs.columns.index("text")

    def packed(batch: pa.RecordBatch) -> bytes:
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        return out.getvalue().to_pybytes()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def sent() -> pa.RecordBatch:
            value, out = np.concatenate(held), []
            for row in range(DEPTH):
                cell, n = np.unique(shape.cells(value, row), return_counts=True)
                coded = ((cell & U(0x7FFFFFFF)) << U(1) | (n > 1)).astype("<u4")
                part = (cell >> U(32)).astype(np.int64)
                cut = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
                out += [(home, None, None, row, int(part[i]), coded[i:j].tobytes()) for i, j in zip(cut, [*cut[1:], len(part)], strict=True)]
            return _rows(out, SKETCHED)

        for b in batches:
            if not b.num_rows:
                continue
            text = b.column(text_at).cast(pa.large_binary())
            lengths = np.diff(np.frombuffer(text.buffers()[1], "<i8", b.num_rows + 1, 8 * text.offset))
            chunk = (np.cumsum(lengths + 64) - lengths - 64) // tx.CHUNK_BYTES
            cut = np.flatnonzero(np.diff(chunk, prepend=-1)).tolist()
            for i, j in zip(cut, [*cut[1:], b.num_rows], strict=True):
                yield _rows([(home, number, packed(b.slice(i, j - i)), None, None, None)], SKETCHED)
                number += 1
                for _, _, place, value, _ in _windows(text.slice(i, j - i).to_pylist(), window, anchor):
                    held.append(value[np.flatnonzero(np.diff(place, prepend=-1))])
                    size += len(held[-1])
                if size >= HELD_ANCHORS:
                    yield sent()
                    held, size = [], 0
        if size:
            yield sent()

    return docs.mapInArrow(made, SKETCHED)


HEAVY = "home long, row int, cells binary"


def heavy(found: DataFrame, shape: Shape, parts: int) -> DataFrame:
    """Merge the sketches; for each partition those of its cells (range and cell) that count two or more."""

    def merged(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, part = key[0].as_py(), key[1].as_py()
        counts = np.zeros(1 << shape.bits, np.uint8)
        pieces = []
        for home, data in _lists(batches, "home", "cells"):
            coded = np.frombuffer(data, "<u4")
            at = coded >> 1
            counts[at] = np.minimum(counts[at] + 1 + (coded & 1).astype(np.uint8), 2)
            pieces.append((home, data))
        out = []
        for home, data in pieces:
            at = np.frombuffer(data, "<u4") >> 1
            at = at[counts[at] > 1]
            if len(at):
                out.append((home, row, tx.packed(at.astype(np.uint64) | U(part) << U(32), "<u8")))
        for i in range(0, len(out), 1024):
            yield _rows(out[i : i + 1024], HEAVY)

    return found.where("cells is not null").select("home", "row", "range", "cells").repartition(parts, "row", "range").groupBy("row", "range").applyInArrow(merged, HEAVY)


CANDIDATES = "home long, range int, hashes binary, at binary, many binary"


def candidates(found: DataFrame, answers: str, shape: Shape, window: int, anchor: int) -> DataFrame:
    """Windows that may repeat, by range (those found twice already in ``many``); in range -1 the places that are settled.

    A place is the number of the chunk and the first word in it.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, dense, held, size = None, [], [], 0

        def sent() -> pa.RecordBatch:
            grams, group, place = (np.concatenate(x) for x in zip(*held, strict=True))
            _, inverse, n = np.unique(grams, return_inverse=True, return_counts=True)
            twice = n[inverse] > 1
            out = [(at, -1, None, tx.packed(np.diff(place[twice], prepend=0), "<i8"), None)]
            order = np.argsort(group, kind="stable")
            grams, group, place, twice = grams[order], group[order], place[order], twice[order]
            cut = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
            for i, j in zip(cut, [*cut[1:], len(group)], strict=True):
                one = ~twice[i:j]
                out.append((at, int(group[i]), tx.packed(grams[i:j][one], "<u8"), tx.packed(np.diff(place[i:j][one], prepend=0), "<i8"), tx.packed(np.unique(grams[i:j][~one]), "<u8")))
            return _rows(out, CANDIDATES)

        for home, number, rows in _lists(batches, "home", "number", "rows"):
            if home != at:
                if held:
                    yield sent()
                at, held, size = home, [], 0
                parts: list[list[np.ndarray]] = [[] for _ in range(DEPTH)]
                for row, cells in storage.answers_of(answers, home):
                    parts[row].append(np.frombuffer(cells, "<u8"))
                dense = [np.sort(np.concatenate([np.empty(0, np.uint64), *p])) for p in parts]
            texts = pa.ipc.open_stream(rows).read_all().column("text").cast(pa.large_binary()).to_pylist()
            for hashes, begin, _, value, first in _windows(texts, window, anchor):
                may = np.ones(len(begin), bool)
                for row in range(DEPTH):
                    cell = shape.cells(value, row)
                    near = np.searchsorted(dense[row], cell)
                    may &= np.append(dense[row], U(0xFFFFFFFFFFFFFFFF))[near] == cell
                if may.any():
                    grams = tx.spans_of_words(hashes, window)[begin[may]]
                    group = ((tx.mix(value[may] ^ _SEEDS[DEPTH]) >> U(32)) * U(shape.groups) >> U(32)).astype(np.int64)
                    held.append((grams, group, first[may] | number << 32))
                    size += len(grams)
            if size >= HELD_WINDOWS:
                yield sent()
                held, size = [], 0
        if held:
            yield sent()

    return found.where("rows is not null").select("home", "number", "rows").mapInArrow(made, CANDIDATES)


def repeated(found: DataFrame, parts: int) -> DataFrame:
    """Exact grouping by range: (home, places) of all windows that occur at two or more places."""

    def grouped(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        homes, values, places, many = [], [], [], []
        for home, h, at, m in _lists(batches, "home", "hashes", "at", "many"):
            homes.append(home)
            values.append(np.frombuffer(h, "<u8"))
            places.append(np.cumsum(np.frombuffer(at, "<i8")))
            many.append(np.frombuffer(m, "<u8"))
        single = np.concatenate(values)
        both = np.sort(np.concatenate([single, *many]))
        # a window stands here once for each batch that has it; those of ``many`` occur twice anyway
        twice = np.unique(np.concatenate([both[1:][both[1:] == both[:-1]], *many]))
        near = np.searchsorted(twice, single)
        hit = np.append(twice, U(0))[near] == single if len(twice) else np.zeros(len(single), bool)
        hit &= near < len(twice)
        out, start = [], 0
        for home, at in zip(homes, places, strict=True):
            mine = at[hit[start : start + len(at)]]
            start += len(at)
            if len(mine):
                out.append((home, tx.packed(mine, "<i8")))
        for i in range(0, len(out), 256):
            yield _rows(out[i : i + 256], "home long, places binary")

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for home, at in _lists(batches, "home", "at"):
            if at:
                yield _rows([(home, tx.packed(np.cumsum(np.frombuffer(at, "<i8")), "<i8"))], "home long, places binary")

    own = found.where("range < 0").select("home", "at").mapInArrow(settled, "home long, places binary")
    return own.union(found.where("range >= 0").repartition(parts, "range").groupBy("range").applyInArrow(grouped, "home long, places binary"))


def _cut(text: bytes | None, hits: np.ndarray, window: int) -> tuple[int, int, bytes]:
    """Words, removed words and what is left of a text whose repeated windows start at ``hits``."""
    counts, removed, kept = 0, 0, []
    for part in tx.segments(text or b"", 0):
        words = part.split()
        n = len(words)
        i, j = np.searchsorted(hits, (counts - window + 1, counts + n))
        if i < j:
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, np.maximum(hits[i:j] - counts, 0), 1)
            np.add.at(edge, np.minimum(hits[i:j] - counts + window, n), -1)
            words = list(compress(words, (np.cumsum(edge[:n]) == 0).tolist()))
        counts += n
        removed += n - len(words)
        if words:
            kept.append(b" ".join(words))
    return counts, removed, b" ".join(kept)


def without_repeats(docs: DataFrame, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """``docs`` with _sub_n_words, _sub_n_removed and _sub_kept, the kept words joined by one space."""
    spark = docs.sparkSession
    anchor = min(anchor, window)
    folder = storage.shared_dir(spark)
    size = storage.text_bytes(docs)
    parts, shape = storage.parts_for(spark, size), Shape(size)
    found = storage.stored(sketched(docs, shape, window, anchor), folder, "chunks")
    storage.by_home(heavy(found, shape, parts), f"{folder}/heavy", parts)
    may = storage.stored(candidates(found, f"{folder}/heavy", shape, window, anchor), folder, "candidates")
    storage.by_home(repeated(may, parts), f"{folder}/places", parts)
    storage.removed(spark, f"{folder}/heavy")
    storage.removed(spark, f"{folder}/candidates")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, places = None, np.empty(0, np.int64)
        for home, number, rows in _lists(batches, "home", "number", "rows"):
            if home != at:
                at, places = home, np.sort(np.concatenate([np.empty(0, np.int64), *[np.frombuffer(p, "<i8") for (p,) in storage.answers_of(f"{folder}/places", home)]]))
            i, j = np.searchsorted(places, (number << 32, (number + 1) << 32))
            hits, base = places[i:j] & 0xFFFFFFFF, 0
            for batch in pa.ipc.open_stream(rows):
                out = []
                for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                    upto = int(np.searchsorted(hits, base))
                    out.append(_cut(text, hits[upto:] - base, window))
                    base += out[-1][0]
                counts, removed, kept = zip(*out, strict=True)
                columns = [*batch.columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_sub_n_words", "_sub_n_removed", "_sub_kept"])

    schema = T.StructType([*docs.schema.fields, T.StructField("_sub_n_words", T.LongType()), T.StructField("_sub_n_removed", T.LongType()), T.StructField("_sub_kept", T.StringType())])
    return found.where("rows is not null").select("home", "number", "rows").mapInArrow(cut, schema)


def cleaned(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The columns of ``docs``, texts without their repeated windows; texts with none stay as they are."""
    rows = without_repeats(docs, window)
    text = F.when(F.col("_sub_n_removed") > 0, F.col("_sub_kept")).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("_sub_n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
