"""Language identification with averaged hashed subword embeddings.

A text is the average of the embeddings of its byte 2-, 3- and 4-grams (lower
case, white space as a space), which stand in a hashed table; a linear softmax
gives the languages. Table and softmax are trained together by stochastic
gradient descent in numpy on a bounded sample. For prediction the table is
multiplied by the softmax's weights once, so a text costs one lookup for each
n-gram; the whole text counts.

A temperature, fitted on a part of the sample kept aside, calibrates the
probabilities; ``accepted`` is false below the probability at which the kept
part still reaches the wanted precision.

Defined results: a null text, and one without a letter, is ``und`` with score
0 and not accepted; with no labelled row at all every text is ``und``; other
columns than text never enter a prediction; repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sampling, storage
from . import text as tx

ORDERS, BUCKET_BITS, WIDTH = (2, 3, 4), 16, 16
PER_LANGUAGE, MOST_DOCUMENTS, LONGEST_BYTES = 500, 4000, 20_000
EPOCHS, BATCH, RATE, PRECISION = 4, 128, 4.0, 0.995
#: Numbers (bytes of text times languages) that a prediction holds at a time.
HELD_SCORES = 4 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32
_LETTER = np.zeros(256, np.int64)
_LETTER[ord("a") : ord("z") + 1] = 1


def codes_of(raw: np.ndarray) -> list[np.ndarray]:
    """Buckets of the n-grams at all places, by order."""
    wide = raw.astype(np.uint32)
    out, code = [], wide
    for n in range(2, max(ORDERS) + 1):
        code = (code[:-1] << np.uint32(8)) | wide[n - 1 :]
        if n in ORDERS:
            out.append((((code + np.uint32(n * 0x51ED27)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32))
    return out


def grams(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of the n-grams at all places by order, and the texts' offsets. Texts have a space on both sides."""
    raw = _LOWER[np.frombuffer(b"".join(b" " + t + b" " for t in texts), np.uint8)]
    return codes_of(raw), np.concatenate(([0], np.cumsum([len(t) + 2 for t in texts]))).astype(np.int64)


def sums(table: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text the sum of the table's rows over its n-grams, their number, and the number of ASCII letters.

    Texts go through in slices of bytes, each with the bytes that its last
    n-grams need, so HELD_SCORES numbers are held, whatever the languages.
    """
    limit = max(256, HELD_SCORES // table.shape[1])
    total, count, letters = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    held: list[tuple[int, bytes, int]] = []
    size = 0

    def add() -> None:
        owner, own = np.array([h[0] for h in held]), np.array([h[2] for h in held])
        raw = _LOWER[np.frombuffer(b"".join(h[1] for h in held), np.uint8)]
        lengths = np.array([len(h[1]) for h in held])
        starts = np.cumsum(lengths) - lengths
        for n, code in zip(ORDERS, codes_of(raw), strict=True):
            room = np.maximum(np.minimum(own, lengths - n + 1), 0)
            some = np.flatnonzero(room)
            if len(some):
                edges = np.stack([starts[some], starts[some] + room[some]], axis=1).ravel()
                rows = table[code]
                rows = np.concatenate([rows, np.zeros((max(0, int(edges[-1]) + 1 - len(rows)), table.shape[1]), table.dtype)])
                np.add.at(total, owner[some], np.add.reduceat(rows, edges, axis=0)[::2])
                np.add.at(count, owner, room)
        here = np.concatenate(([0], np.cumsum(_LETTER[raw])))
        np.add.at(letters, owner, here[starts + own] - here[starts])

    for k, text in enumerate(texts):
        text = b" " + text + b" "
        for at in range(0, len(text), limit):
            part = text[at : at + limit + max(ORDERS) - 1]
            held.append((k, part, min(limit, len(text) - at)))
            size += len(part)
            if size >= limit:
                add()
                held, size = [], 0
    if held:
        add()
    return total, count, letters


def train(sample: list[tuple[bytes, str]]) -> dict | None:
    names = sorted({lang for _, lang in sample})
    if not names:
        return None
    rng = np.random.default_rng(11)
    pieces: list[tuple[bytes, int]] = []
    for text, lang in sample:  # the whole text in pieces of various lengths, so short texts are learned too
        at, k = 0, names.index(lang)
        while at < len(text):
            size = int(rng.integers(16, 500))
            pieces.append((text[at : at + size], k))
            at += size
    order = rng.permutation(len(pieces))
    pieces = [pieces[i] for i in order]
    aside = max(1, len(pieces) // 8) if len(pieces) > 16 else 0
    kept, learn = pieces[:aside], pieces[aside:]
    table = (rng.normal(size=(1 << BUCKET_BITS, WIDTH)) / WIDTH).astype(np.float32)
    out, bias = np.zeros((WIDTH, len(names)), np.float32), np.zeros(len(names), np.float32)
    steps, done = EPOCHS * -(-len(learn) // BATCH), 0
    for _ in range(EPOCHS):
        for at in range(0, len(learn), BATCH):
            part = learn[at : at + BATCH]
            codes, offsets = grams([t for t, _ in part])
            index, owner = [], []
            for n, code in zip(ORDERS, codes, strict=True):
                text_of = np.repeat(np.arange(len(part)), np.diff(offsets))[: len(code)]
                inside = np.arange(len(code)) + n <= offsets[text_of + 1]
                index.append(code[inside])
                owner.append(text_of[inside])
            index, owner = np.concatenate(index), np.concatenate(owner)
            size = np.maximum(np.bincount(owner, minlength=len(part)), 1)[:, None]
            order = np.argsort(owner, kind="stable")
            index, owner = index[order], owner[order]
            rows, starts = np.unique(owner, return_index=True)
            mean = np.zeros((len(part), WIDTH), np.float32)
            mean[rows] = np.add.reduceat(table[index], starts, axis=0)
            mean /= size
            logits = mean @ out + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), [k for _, k in part]] -= 1
            rate = RATE * (1 - done / steps)
            back = (p @ out.T) / size * np.float32(rate)
            order = np.argsort(index, kind="stable")
            values, first = np.unique(index[order], return_index=True)
            table[values] -= np.add.reduceat(back[owner[order]].astype(np.float32), first, axis=0)
            out -= (rate / len(part)) * (mean.T @ p)
            bias -= (rate / len(part)) * p.sum(axis=0)
            done += 1
    model = {"names": names, "scores": (table @ out).astype(np.float32), "bias": bias, "temperature": 1.0, "least": 0.0}
    if kept:
        logits, truth = raw_scores(model, [t for t, _ in kept])[0], np.array([k for _, k in kept])

        def loss(t: float) -> float:
            z = logits / t
            z = z - z.max(axis=1, keepdims=True)
            return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]))

        model["temperature"] = min(np.geomspace(0.1, 10, 81).tolist(), key=loss)
        p = softmax(logits / model["temperature"])
        sure, right = p.max(axis=1), p.argmax(axis=1) == truth
        order = np.argsort(-sure)
        good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= PRECISION
        model["least"] = float(sure[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return model


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def raw_scores(model: dict, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    total, count, letters = sums(model["scores"], texts)
    return total / np.maximum(count, 1)[:, None] + model["bias"], letters


def predicted(docs: DataFrame, model: dict | None, folds: int = 3, out_fold: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted for each row of ``docs`` (doc_id, text)."""
    storage.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for texts, ids, held in tx.chunked(batches, ["text", "doc_id", "held_out"], 1 << 20):
            n = len(texts)
            pred, score, accepted = ["und"] * n, np.zeros(n), np.zeros(n, bool)
            if m is not None:
                logits, letters = raw_scores(m, [t or b"" for t in texts])
                p = softmax(logits / m["temperature"])
                best = p.argmax(axis=1)
                for i in range(n):
                    if letters[i] or (texts[i] and any(map(str.isalpha, texts[i].decode("utf-8", "replace")))):
                        pred[i], score[i] = m["names"][best[i]], p[i, best[i]]
                        accepted[i] = score[i] >= m["least"]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held), pa.array(pred), pa.array(score), pa.array(accepted)], ["doc_id", "held_out", "lang_pred", "score", "accepted"])

    source = docs.select(F.col("text").cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), (sampling.fold("doc_id", folds) == out_fold).alias("held_out"))
    return source.mapInArrow(made, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")


def identified(docs: DataFrame, folds: int = 3, out_fold: int = 1) -> DataFrame:
    """Learn from the documents outside the held-out fold that have a language; predict all."""
    learn = docs.where(sampling.fold("doc_id", folds) != out_fold)
    sample = sampling.labelled(learn.select("doc_id", "text"), learn.select("doc_id", "lang"), "lang", PER_LANGUAGE, MOST_DOCUMENTS, LONGEST_BYTES)
    return predicted(docs, train(sample), folds, out_fold)
