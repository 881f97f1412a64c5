"""A quality classifier: a convolutional network on bytes, in numpy.

Filters see FILTER_BYTES bytes and move by STRIDE, so they overlap. The
activations of a block of places are max-pooled; two neighbouring blocks make
a chunk, so chunks overlap by half and cover the whole text. Each chunk's
pooled vector goes through a small dense layer to a logit; the mean of the
logits over all chunks gives the document's probability.

A filter on one-hot bytes is a table for each of its bytes, so the convolution
is a sum of table rows. Training (Adam on the cross entropy, gradients through
the places of the maxima) runs on the driver on a bounded sample, balanced by
label and weighted back to the labels' true shares; every text is scored whole.

Defined results: a null or empty text is one chunk of zero bytes; with labels
of one kind only, or none, every score is the share of label 1 (0.5 without
labels); repeated rows get equal scores; other columns never enter. Long texts
are scored a number of blocks at a time, with a running sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sampling, storage
from . import text as tx

FILTER_BYTES, STRIDE, FILTERS, HIDDEN = 8, 2, 32, 16
BLOCK_PLACES = 64
BLOCK_BYTES = BLOCK_PLACES * STRIDE
PER_LABEL, LONGEST_BYTES = 1500, 16_000
EPOCHS, BATCH, RATE = 5, 32, 0.004
#: Bytes of texts that are scored together; blocks of a longer text that are.
SCORED_BYTES, SLICE_BLOCKS = 1 << 19, 4096


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each filled up with zeros to whole blocks and one more, and each text's first block (one more at the end).

    The last block has zeros only, so no filter sees the bytes of the next text.
    """
    blocks = np.array([max(1, -(-len(t) // BLOCK_BYTES)) + 1 for t in texts])
    first = np.concatenate(([0], np.cumsum(blocks)))
    raw = np.zeros(int(first[-1]) * BLOCK_BYTES + FILTER_BYTES, np.uint8)
    for t, b in zip(texts, first[:-1].tolist(), strict=True):
        raw[b * BLOCK_BYTES : b * BLOCK_BYTES + len(t)] = np.frombuffer(t, np.uint8)
    return raw, first


def pooled(tables: np.ndarray, raw: np.ndarray, blocks: int, places: bool = False):
    """The largest activation of each filter in each block (and where it is)."""
    n = blocks * BLOCK_PLACES
    act = tables[0][raw[0 : n * STRIDE : STRIDE]]
    for j in range(1, FILTER_BYTES):
        act += tables[j][raw[j : j + n * STRIDE : STRIDE]]
    act = act.reshape(blocks, BLOCK_PLACES, FILTERS)
    if not places:
        return act.max(axis=1)
    at = act.argmax(axis=1)
    return np.take_along_axis(act, at[:, None], axis=1)[:, 0], at


def chunk_rows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The two blocks of each chunk (the same one twice for a text of one block), and each text's first chunk."""
    blocks = np.diff(first) - 1
    chunks = np.maximum(blocks - 1, 1)
    starts = np.concatenate(([0], np.cumsum(chunks)))
    own = np.repeat(first[:-1] - starts[:-1], chunks) + np.arange(starts[-1])
    return own, own + np.repeat((blocks > 1).astype(np.int64), chunks), starts


class Network:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        f32 = np.float32
        self.p = {
            "tables": rng.normal(0, 0.25, (FILTER_BYTES, 256, FILTERS)).astype(f32),
            "bias": np.zeros(FILTERS, f32),
            "w1": rng.normal(0, (2 / FILTERS) ** 0.5, (FILTERS, HIDDEN)).astype(f32),
            "b1": np.zeros(HIDDEN, f32),
            "w2": rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN).astype(f32),
            "b2": np.zeros(1, f32),
        }
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    def chunk_logits(self, top: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        x = np.maximum(np.maximum(top[left], top[right]) + self.p["bias"], 0)
        h = np.maximum(x @ self.p["w1"] + self.p["b1"], 0)
        return h @ self.p["w2"] + self.p["b2"]

    def logits(self, texts: list[bytes]) -> np.ndarray:
        raw, first = padded(texts)
        left, right, starts = chunk_rows(first)
        z = self.chunk_logits(pooled(self.p["tables"], raw, int(first[-1])), left, right)
        return np.add.reduceat(z.astype(float), starts[:-1]) / np.diff(starts)

    def long_logit(self, text: bytes) -> float:
        """The same for one text, a number of blocks at a time (each time with the first of the next ones)."""
        blocks = -(-len(text) // BLOCK_BYTES)
        raw = np.zeros(SLICE_BLOCKS * BLOCK_BYTES + BLOCK_BYTES + FILTER_BYTES, np.uint8)
        total = 0.0
        for b in range(0, blocks - 1, SLICE_BLOCKS):
            part = np.frombuffer(text, np.uint8)[b * BLOCK_BYTES : b * BLOCK_BYTES + len(raw)]
            raw[: len(part)], raw[len(part) :] = part, 0
            n = min(SLICE_BLOCKS, blocks - 1 - b)
            left = np.arange(n)
            total += float(self.chunk_logits(pooled(self.p["tables"], raw, n + 1), left, left + 1).sum(dtype=float))
        return total / (blocks - 1)

    def step(self, texts: list[bytes], y: np.ndarray, weight: np.ndarray, rate: float) -> None:
        raw, first = padded(texts)
        top, at = pooled(self.p["tables"], raw, int(first[-1]), places=True)
        left, right, starts = chunk_rows(first)
        second = top[right] > top[left]
        block = np.where(second, right[:, None], left[:, None])
        pre = np.where(second, top[right], top[left]) + self.p["bias"]
        x = np.maximum(pre, 0)
        hidden = x @ self.p["w1"] + self.p["b1"]
        h = np.maximum(hidden, 0)
        z = h @ self.p["w2"] + self.p["b2"]
        chunks = np.diff(starts)
        mean = np.add.reduceat(z.astype(float), starts[:-1]) / chunks
        out = (1 / (1 + np.exp(-mean)) - y) * weight / weight.sum()
        dz = np.repeat(out / chunks, chunks).astype(np.float32)
        g = {"w2": h.T @ dz, "b2": dz.sum(keepdims=True)}
        dh = dz[:, None] * self.p["w2"] * (hidden > 0)
        g["w1"], g["b1"] = x.T @ dh, dh.sum(axis=0)
        dx = (dh @ self.p["w1"].T) * (pre > 0)
        g["bias"] = dx.sum(axis=0)
        rows, cols = np.nonzero(dx)
        value, where = dx[rows, cols], block[rows, cols]
        place = (where * BLOCK_PLACES + at[where, cols]) * STRIDE
        g["tables"] = np.stack([np.bincount(raw[place + j].astype(np.int64) * FILTERS + cols, value, 256 * FILTERS).reshape(256, FILTERS) for j in range(FILTER_BYTES)])
        self.t += 1
        for k, grad in g.items():
            grad = grad.astype(np.float32) + (1e-5 * self.p[k] if k == "tables" else 0)
            self.m[k] += 0.1 * (grad - self.m[k])
            self.v[k] += 0.001 * (grad * grad - self.v[k])
            self.p[k] -= rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)


def train(sample: list[tuple[bytes, int]], share: float) -> Network | float:
    """The network; the share of label 1 itself where the sample has one label only."""
    y = np.array([int(k) for _, k in sample], np.float32)
    if not len(y) or y.min() == y.max():
        return share
    texts = [t for t, _ in sample]
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())).astype(np.float32)
    network, rng = Network(), np.random.default_rng(3)
    steps, done = EPOCHS * -(-len(y) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at : at + BATCH]
            network.step([texts[i] for i in rows], y[rows], weight[rows], RATE * (1 - 0.9 * done / steps))
            done += 1
    return network


def scored(docs: DataFrame, model: Network | float, folds: int = 4, out_fold: int = 2, least: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text)."""
    storage.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model if isinstance(model, float) else model.p)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = None
        if not isinstance(shared.value, float):
            network = Network()
            network.p = shared.value
        for texts, ids, held in tx.chunked(batches, ["text", "doc_id", "held_out"], SCORED_BYTES):
            if network is None:
                score = np.full(len(ids), shared.value)
            else:
                long = [i for i, t in enumerate(texts) if t and len(t) > SCORED_BYTES]
                z = network.logits([t if t and i not in long else b"" for i, t in enumerate(texts)])
                z[long] = [network.long_logit(texts[i]) for i in long]
                score = 1 / (1 + np.exp(-z))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held), pa.array(score), pa.array((score >= least).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    source = docs.select(F.col("text").cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), (sampling.fold("doc_id", folds) == out_fold).alias("held_out"))
    return source.mapInArrow(made, "doc_id long, held_out boolean, score double, predicted int")


def classified(docs: DataFrame, labels: DataFrame, folds: int = 4, out_fold: int = 2) -> DataFrame:
    """Learn ``quality`` from labelled documents outside the held-out fold; score all documents."""
    known = labels.where(F.col("quality").isin(0, 1) & (sampling.fold("doc_id", folds) != out_fold)).select("doc_id", "quality")
    share = known.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    sample = sampling.labelled(docs.select("doc_id", "text"), known, "quality", PER_LABEL, 2 * PER_LABEL, LONGEST_BYTES)
    return scored(docs, train(sample, 0.5 if share is None else float(share)), folds, out_fold)
