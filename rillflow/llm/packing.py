"""Best-two-fit packing of tokenised documents into sequences of fixed length.

Lengths are small integers, so the plan is made on the histogram of lengths:
at most one number for each length reaches the driver, whatever the corpus.
A sequence is filled greedily, always with the longest piece that fits. Then
its smallest piece gives way to two unpacked pieces, if some two fit the wider
gap more tightly. The same pattern is repeated as long as the counts allow,
so the plan is a bounded list of runs (pattern, number of sequences). The
n-th piece of a length finds its run by a search in that list.

Defined results: a null or empty text is a document of one id (the end id);
documents longer than a sequence are cut, the remainder comes first; rows that
repeat are separate documents; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import storage, tokens
from . import text as tx

SEQUENCE_TOKENS = 2048
PIECE_SCHEMA = "part long, doc_id long, piece int, start long, length long, ids_crc32 long, nth long"


def cut(total: int, room: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than ``room``."""
    if total <= room:
        return [(0, total)]
    first = total % room or room
    return [(0, first)] + [(s, room) for s in range(first, total, room)]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, room: int, with_ids: bool) -> DataFrame:
    """All pieces; ``nth`` numbers those of one length within a task."""
    end = np.array([end_id], "<u4").tobytes()
    bits = tokens.bits_for(max(tokens.vocabulary_size(tokenizer), end_id + 1))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        for texts, ids in tx.chunked(batches, ["text", "doc_id"]):
            rows: list[tuple] = []
            for doc_id, coded in zip(ids, tokens.encode([t.decode() if t else t for t in texts], tokenizer), strict=True):
                coded += end
                for k, (start, length) in enumerate(cut(len(coded) // 4, room)):
                    own = coded[4 * start : 4 * (start + length)]
                    rows.append((part, doc_id, k, start, length, zlib.crc32(own), seen[length], *([tokens.pack(np.frombuffer(own, "<u4"), bits)] if with_ids else [])))
                    seen[length] += 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary()]
            names = ["part", "doc_id", "piece", "start", "length", "ids_crc32", "nth", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=False)], names[: len(rows[0])])

    source = docs.select(F.col("text").cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    return source.mapInArrow(made, PIECE_SCHEMA + (", ids binary" if with_ids else ""))


def plan(counts: dict[int, int], room: int) -> list[tuple[list[int], int]]:
    """Runs of (lengths of the pieces of a sequence, number of such sequences)."""
    left = np.zeros(room + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    runs = []
    places = np.arange(room + 1)
    while True:
        below = np.maximum.accumulate(np.where(left > 0, places, 0))  # the longest piece of at most x
        if not below[room]:
            return runs
        taken: Counter = Counter()
        pattern: list[int] = []
        gap = room
        while gap:
            best = int(below[gap])
            while best and taken[best] >= left[best]:
                best = int(below[best - 1])
            if not best:
                break
            n = min(gap // best, int(left[best]) - taken[best])
            pattern += [best] * n
            taken[best] += n
            gap -= best * n
        if gap and len(pattern) > 1:
            pattern = _two_for_one(pattern, taken, left, gap, places)
        need = Counter(pattern)
        n = min(int(left[length]) // k for length, k in need.items())
        for length, k in need.items():
            left[length] -= n * k
        runs.append((pattern, n))


def _two_for_one(pattern: list[int], taken: Counter, left: np.ndarray, gap: int, places: np.ndarray) -> list[int]:
    """Replace the smallest piece by the two unpacked ones that fill the widened gap best, if they fill more."""
    smallest = pattern[-1]
    free = left.copy()
    for length, k in taken.items():
        free[length] -= k
    wide = gap + smallest
    first = np.flatnonzero(free[:wide] > 0)
    if not len(first):
        return pattern
    below = np.maximum.accumulate(np.where(free > 0, places, 0))
    second = below[wide - first]
    alone = (second == first) & (free[first] < 2)
    second = np.where(alone, np.where(first > 0, below[np.maximum(first - 1, 0)], 0), second)
    total = np.where(second > 0, first + second, 0)
    best = int(total.argmax())
    if total[best] <= smallest:
        return pattern
    return [*pattern[:-1], *sorted((int(first[best]), int(second[best])), reverse=True)]


def lookup(runs: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """For each run and length: the first number of a piece, copies in a sequence, first sequence, places."""
    rows, offsets, used, sequence = [], [], Counter(), 0
    for pattern, n in runs:
        starts = np.concatenate(([0], np.cumsum(pattern)))
        for length, k in Counter(pattern).items():
            rows.append((length, used[length], k, sequence, len(offsets)))
            offsets += [int(s) for s, x in zip(starts, pattern, strict=False) if x == length]
            used[length] += n * k
        sequence += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return {"length": table[:, 0], "from": table[:, 1], "copies": table[:, 2], "sequence": table[:, 3], "at": table[:, 4], "offsets": np.array(offsets, np.int64)}


def placed(table: dict[str, np.ndarray], length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the ``number``-th piece of a length."""
    key = (table["length"] << 44) + table["from"]
    row = np.searchsorted(key, (length << 44) + number, side="right") - 1
    inside = number - table["from"][row]
    copies = table["copies"][row]
    return table["sequence"][row] + inside // copies, table["offsets"][table["at"][row] + inside % copies]


def packed(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, room: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, packed in the vocabulary's bits)."""
    spark = docs.sparkSession
    folder = storage.shared_dir(spark)
    rows = storage.stored(pieces(docs, tokenizer or tokens.default_tokenizer(), end_id, room, with_ids), folder, "pieces")
    per_task = rows.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(lookup(plan(counts, room)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    numbered = rows.join(base, ["part", "length"]).withColumn("number", F.col("base") + F.col("nth")).drop("base", "nth", "part")
    kept = [c for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids") if c in numbered.columns]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, number = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            sequence, offset = placed(table.value, length, number)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    kinds = {"piece": "int", "ids": "binary"}
    schema = ", ".join(f"{c} {kinds.get(c, 'long')}" for c in kept) + ", sequence_id long, offset long"
    return numbered.select(*kept, "number").mapInArrow(assign, schema)
