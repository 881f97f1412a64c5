"""Token ids in a packed binary format.

One shard file holds a range of documents in ascending order of id. The ids
stand in the fewest bits the vocabulary needs, in blocks of a fixed number of
ids; each block starts at a whole byte, so the place of any block follows from
its number, and one block can be unpacked alone.

Layout of a shard (little-endian)::

    "RILLTOK1"  u32 bits  u32 block_ids  u64 documents  u64 ids  u64 directory_at
    blocks      ceil(block_ids * bits / 8) bytes each, the last one shorter
    directory   u64 end of each document (in ids, from the shard's start),
                i64 doc_id of each document, u8 1 where the doc_id is null
    u64 block offsets from the start of the file

Memory is bounded by one shard's directory (17 bytes a document), a chunk of
texts and the longest text (its characters and ids; it is encoded in slices). Shards are written under a temporary name and renamed, so a task
that runs twice leaves one whole file.

Defined results: null text is empty (only the end id); rows with the same id
stand next to each other, ordered by text; a null id comes first; an empty
table gives no shard and no rows.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage
from . import text as tx

MAGIC, HEAD = b"RILLTOK1", struct.Struct("<8sIIQQQ")
BLOCK_IDS = 4096
#: Pieces of text whose ids a worker keeps; others are encoded again each time.
CACHE_PIECES = 600_000
_MARKS = frozenset(".,;:!?")
_LOOSE = re.compile(r" (?:\s|$)")
#: A space that the pre-tokenizer always puts at the start of a unit, with the end of a unit before it.
_TIGHT = re.compile(r"(?<=\S) (?=\S)")
#: Units of the pre-tokenizer without white space; numbers other than ASCII digits don't match or are found out.
_UNITS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|[0-9]+|(?:[^\w\s]|_)+")
#: Characters of a text that are split at a time; longest piece whose ids are kept.
SLICE_CHARS, LONGEST_KEPT = 1 << 20, 64
_TOKENIZERS: dict[str, tuple] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Pieces(dict):
    """Ids (little-endian u32) of pieces of text that a space precedes.

    A piece of letters is one unit of the pre-tokenizer and goes straight to
    the model, in the byte-level alphabet; a piece of letters with one mark
    behind them is two units. Other pieces fall into units, those with single
    line feeds into lines before; pieces with other white space, with numbers
    beyond ASCII or with the string of an added token go through the whole
    tokenizer.
    """

    def __init__(self, tokenizer, heads: _Pieces | None = None):
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        #: Pieces at the start of a text or behind another unit, without a space.
        self.heads = self if heads is None else heads
        self.space = "" if heads is None else " "
        # The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.alphabet = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}
        self.direct = type(tokenizer.pre_tokenizer).__name__ == "ByteLevel" and tokenizer.normalizer is None
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.marks: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if self.direct and piece.isalpha():
            ids = self.unit(piece)
        elif self.direct and piece[-1:] in _MARKS and piece[:-1].isalpha():
            ids = self[piece[:-1]] + self.mark(piece[-1])
        elif self.direct and piece[0] != "'" and not any(x in piece for x in self.added):
            lines = piece.split("\n")
            if len(lines) > 1:
                if piece.split() != lines:
                    return self.whole(self.space + piece)
                end, heads = self.mark("\n"), self.heads
                return self[lines[0]] + b"".join([end + heads[x] for x in lines[1:]])
            units = _UNITS.findall(piece)
            if sum(map(len, units)) != len(piece) or not all(u.isalpha() or u.isascii() or not u[0].isalnum() for u in units):
                ids = self.whole(self.space + piece)
            elif len(units) == 1:
                ids = self.unit(piece)
            else:
                heads = self.heads
                ids = self[units[0]] + b"".join([heads[x] for x in units[1:]])
        else:
            ids = self.whole(self.space + piece)
        if len(self) < CACHE_PIECES and len(piece) <= LONGEST_KEPT:
            self[piece] = ids
        return ids

    def unit(self, piece: str) -> bytes:
        written = (self.space + piece).encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(written)]).tobytes()

    def mark(self, x: str) -> bytes:
        found = self.marks.get(x)
        if found is None:
            found = self.marks[x] = self.whole(x)
        return found

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def _loaded(path: str) -> tuple:
    """The tokenizer, its pieces behind a space and its pieces at the start of a text."""
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        heads = _Pieces(t)
        _TOKENIZERS[path] = (t, _Pieces(t, heads), heads)
    return _TOKENIZERS[path]


def _slices(text: str) -> Iterator[str]:
    """A text in parts, cut before spaces between two units."""
    at = 0
    while len(text) - at > SLICE_CHARS:
        gap = _TIGHT.search(text, at + SLICE_CHARS)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:]


def encode(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of each text as little-endian u32, those of the library for the whole text without special tokens added.

    The byte-level pre-tokenizer always starts a unit at a space that stands
    before a character other than white space. So a text falls into pieces
    that are encoded alone, and equal pieces only once. A text with a space
    before white space, or at its end, is encoded as a whole. A piece with the
    string of an added token goes through the whole tokenizer; if such a string
    holds white space, whole texts do. Long texts are cut at spaces between two
    other characters.
    """
    tokenizer, pieces, heads = _loaded(path)
    get, out = pieces.__getitem__, []
    direct = pieces.direct and not any(re.search(r"\s", t.content) or t.lstrip or t.rstrip for t in tokenizer.get_added_tokens_decoder().values())
    for t in texts:
        if not t:
            out.append(b"")
        elif not direct:
            out.append(pieces.whole(t))
        else:
            coded = []
            for part in _slices(t):
                if _LOOSE.search(part):
                    coded.append(pieces.whole(part))
                    continue
                head, *rest = part.split(" ")
                coded.append((heads[head] if head else b"") + b"".join(map(get, rest)))
            out.append(b"".join(coded))
    return out


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, lowest bit first, padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = ((ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1).astype(np.uint8)
    return np.packbits(spread.ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (spread.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class ShardWriter:
    """Writes one shard to any store that pyarrow knows by URI."""

    def __init__(self, uri: str, bits: int, block_ids: int = BLOCK_IDS):
        self.store, self.path = fs.FileSystem.from_uri(uri)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}.part"
        self.store.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.bits, self.block_ids = bits, block_ids
        self.out = self.store.open_output_stream(self.temporary)
        self.out.write(HEAD.pack(MAGIC, bits, block_ids, 0, 0, 0)[: HEAD.size])
        self.rest = np.empty(0, np.uint32)
        self.total, self.ends, self.ids, self.places, self.at = 0, [], [], [], HEAD.size

    def add(self, doc_ids: list[int | None], encoded: list[bytes]) -> None:
        ends = self.total + np.cumsum([len(e) // 4 for e in encoded])
        self.ends.append(ends.astype("<u8"))
        self.ids.append(np.array([(0, 1) if i is None else (i, 0) for i in doc_ids], np.int64).reshape(-1, 2))
        self.total = int(ends[-1])
        waiting = np.concatenate([self.rest, np.frombuffer(b"".join(encoded), "<u4")])
        whole = len(waiting) // self.block_ids * self.block_ids
        for i in range(0, whole, self.block_ids):
            self._block(waiting[i : i + self.block_ids])
        self.rest = waiting[whole:]

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.places.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def close(self) -> tuple[int, int]:
        """(documents, ids) of the shard. The counts stand in a trailer, as a stream can't go back."""
        if len(self.rest):
            self._block(self.rest)
        ends = np.concatenate([np.empty(0, "<u8"), *self.ends])
        ids = np.concatenate([np.empty((0, 2), np.int64), *self.ids])
        for part in (ends.astype("<u8"), ids[:, 0].astype("<i8"), ids[:, 1].astype("u1"), np.array(self.places, "<u8")):
            self.out.write(part.tobytes())
        self.out.write(HEAD.pack(MAGIC, self.bits, self.block_ids, len(ends), self.total, self.at))
        self.out.close()
        self.store.move(self.temporary, self.path)
        return len(ends), self.total


class ShardReader:
    """Random access to the documents and blocks of one shard."""

    def __init__(self, uri: str):
        store, path = fs.FileSystem.from_uri(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        magic, self.bits, self.block_ids, n, self.total, at = HEAD.unpack(self.file.read_at(HEAD.size, size - HEAD.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        blocks = -(-self.total // self.block_ids)
        data = self.file.read_at(17 * n + 8 * blocks, at)
        self.ends = np.frombuffer(data, "<u8", n).astype(np.int64)
        self.doc_ids = np.frombuffer(data, "<i8", n, 8 * n)
        self.null = np.frombuffer(data, "u1", n, 16 * n)
        self.places = np.append(np.frombuffer(data, "<u8", blocks, 17 * n).astype(np.int64), at)

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids a to b of the shard, read by whole blocks."""
        if a >= b:
            return np.empty(0, np.uint32)
        i, j = a // self.block_ids, -(-b // self.block_ids)
        data = self.file.read_at(int(self.places[j] - self.places[i]), int(self.places[i]))
        out = []
        for k in range(i, j):
            n = min(self.block_ids, self.total - k * self.block_ids)
            out.append(unpack(data[self.places[k] - self.places[i] : self.places[k + 1] - self.places[i]], self.bits, n))
        return np.concatenate(out)[a - i * self.block_ids : b - i * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def vocabulary_size(path: str) -> int:
    return _loaded(path)[0].get_vocab_size(with_added_tokens=True)


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, str, int, int]]:
    """Write all documents as shards in ascending order of id: [(number, uri, documents, ids)].

    The range partitioning makes the shards; the list has one entry for each.
    """
    spark = docs.sparkSession
    bits = bits_for(max(vocabulary_size(tokenizer), end_id + 1))
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, number = None, TaskContext.get().partitionId()
        uri = f"{folder}/shard-{number:06d}.tok"
        for texts, ids in tx.chunked(batches, ["text", "doc_id"]):
            writer = writer or ShardWriter(uri, bits)
            writer.add(ids, [e + end for e in encode([t.decode() if t else t for t in texts], tokenizer)])
        if writer:
            documents, total = writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (number, uri, documents, total)], ["number", "uri", "documents", "ids"])

    parts = storage.parts_for(spark, storage.text_bytes(docs, text_col))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    ranged = source.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return sorted(tuple(r) for r in ranged.mapInArrow(write, "number long, uri string, documents long, ids long").collect())


def read_shards(spark, shards: list[tuple[int, str, int, int]]) -> DataFrame:
    """The documents of the shards: doc_id, start, n_tokens, ids (little-endian u32), ids_crc32."""
    schema = "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long"
    starts, at = [], 0
    for number, uri, _, ids in shards:
        starts.append((number, uri, at))
        at += ids
    if not shards:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("uri").to_pylist(), batch.column("base").to_pylist(), strict=True):
                shard = ShardReader(uri)
                i, n = 0, len(shard.ends)
                while i < n:  # some thousand blocks at a time
                    a = int(shard.ends[i - 1]) if i else 0
                    j = max(i + 1, int(np.searchsorted(shard.ends, a + (1 << 20), side="right")))
                    data = shard.ids(a, int(shard.ends[j - 1])).astype("<u4").tobytes()
                    cut = np.concatenate(([a], shard.ends[i:j])) - a
                    docs = [data[4 * x : 4 * y] for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids[i:j], mask=shard.null[i:j] == 1),
                            pa.array(base + a + cut[:-1]),
                            pa.array(np.diff(cut)),
                            pa.array(docs, pa.binary()),
                            pa.array([zlib.crc32(d) for d in docs], pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
                    )
                    i = j

    table = spark.createDataFrame(starts, "number long, uri string, base long")
    return table.repartition(len(starts), "number").mapInArrow(read, schema)


def written_and_read(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write all documents to the shared folder and read them back."""
    spark = docs.sparkSession
    shards = write_shards(docs, f"{storage.shared_dir(spark)}/tokens", tokenizer or default_tokenizer(), end_id)
    return read_shards(spark, shards)
