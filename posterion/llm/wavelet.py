"""Token ids in shards of wavelet matrices.

Documents are range-partitioned and sorted by id, encoded, and written as shards of a bounded
number of tokens. A shard is one binary file value: header, document ids and ends, and a wavelet
matrix, that is one bit-plane for each bit of an id, from the highest, each plane in the order
that its predecessors' zeros-first partitions leave. A rank directory (ones before every 512
bits) makes access, counting and finding occurrences a matter of one pass over the planes.
Spark's writer puts the shards in place, so a lost task leaves no half file.

Defined cases: null or empty text has the end id alone; null ids sort first; repeated rows are
separate documents; an empty table writes no shard.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from posterion.llm.common import staged
from posterion.llm.tokens import encoder

END = 2
SHARD_TOKENS = 1 << 18     # small enough that building stays in a core's cache
MAGIC = b"WMX1"
HEADER = "<4sQIB3x"         # magic, tokens, documents, planes
BLOCK = 512                 # bits between two entries of the rank directory


class WaveletMatrix:
    """Bit-planes with their zero counts and rank directories."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray, depth: int | None = None) -> "WaveletMatrix":
        n = len(ids)
        depth = depth or max(1, int(ids.max()).bit_length() if n else 1)
        a = ids.astype(np.uint16 if depth <= 16 else np.uint32)
        planes, zeros, ranks = [], [], []
        for level in range(depth - 1, -1, -1):
            bit = (a & a.dtype.type(1 << level)) != 0
            packed = np.packbits(bit, bitorder="little")
            planes.append(np.concatenate([packed, np.zeros(-len(packed) % (BLOCK // 8), np.uint8)]))
            ones = np.bitwise_count(planes[-1].view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
            ranks.append(np.concatenate([[0], np.cumsum(ones)]).astype("<u4"))
            zeros.append(n - int(ranks[-1][-1]))
            a = np.concatenate([np.compress(~bit, a), np.compress(bit, a)])
        return cls(n, planes, zeros, ranks)

    def bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // BLOCK
        rest = np.unpackbits(self.planes[level][block * (BLOCK // 8):(i + 7) // 8], bitorder="little")[:i - block * BLOCK]
        return int(self.ranks[level][block]) + int(rest.sum())

    def access(self, i: int) -> int:
        value = 0
        for level in range(len(self.planes)):
            bit = self.planes[level][i >> 3] >> (i & 7) & 1
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | int(bit)
        return value

    def _range(self, value: int, i: int) -> tuple[int, int]:
        """Where the last order keeps the occurrences of a value among the first i ids."""
        low, high, depth = 0, i, len(self.planes)
        if value >> depth:
            return 0, 0
        for level in range(depth):
            a, b = self._ones(level, low), self._ones(level, high)
            if value >> (depth - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, value: int, i: int) -> int:
        """Occurrences of a value among the first i ids."""
        low, high = self._range(value, i)
        return high - low

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def _place(self, level: int, one: bool, k: int) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        starts = self.ranks[level].astype(np.int64)
        if not one:
            starts = np.arange(len(starts)) * BLOCK - starts
        block = int(np.searchsorted(starts, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * (BLOCK // 8):(block + 1) * (BLOCK // 8)], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == one)[k - int(starts[block])])

    def select(self, value: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a value."""
        low, high = self._range(value, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        i, depth = low + k, len(self.planes)
        for level in range(depth - 1, -1, -1):
            one = bool(value >> (depth - 1 - level) & 1)
            i = self._place(level, one, i - self.zeros[level] if one else i)
        return i

    def occurrences(self, value: int) -> np.ndarray:
        """Positions of all occurrences: the last order's range is carried up plane by plane."""
        low, high = self._range(value, self.n)
        at, depth = np.arange(low, high), len(self.planes)
        for level in range(depth - 1, -1, -1):
            if not len(at):
                break
            if value >> (depth - 1 - level) & 1:
                at = np.flatnonzero(self.bits(level))[at - self.zeros[level]]
            else:
                at = np.flatnonzero(~self.bits(level))[at]
        return at

    def decode(self) -> np.ndarray:
        """All ids: the planes are undone from the last, each value growing by its bit."""
        depth = len(self.planes)
        a = np.zeros(self.n, np.uint16 if depth <= 16 else np.uint32)
        for level in range(depth - 1, -1, -1):
            bit, zeros, out = self.bits(level), self.zeros[level], np.empty_like(a)
            out[np.flatnonzero(~bit)] = a[:zeros]
            out[np.flatnonzero(bit)] = a[zeros:] | a.dtype.type(1 << (depth - 1 - level))
            a = out
        return a.astype("<u4")

    def to_bytes(self) -> bytes:
        return b"".join(struct.pack("<Q", z) + r.tobytes() + p.tobytes() for p, z, r in zip(self.planes, self.zeros, self.ranks))

    @classmethod
    def from_bytes(cls, data: memoryview, n: int, depth: int) -> "WaveletMatrix":
        blocks, at, planes, zeros, ranks = -(-n // BLOCK), 0, [], [], []
        for _ in range(depth):
            zeros.append(struct.unpack_from("<Q", data, at)[0])
            ranks.append(np.frombuffer(data, "<u4", blocks + 1, at + 8))
            at += 8 + 4 * (blocks + 1)
            planes.append(np.frombuffer(data, np.uint8, blocks * (BLOCK // 8), at))
            at += blocks * (BLOCK // 8)
        return cls(n, planes, zeros, ranks)


def pack_shard(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """One shard as bytes: its tokens and where its documents end."""
    matrix = WaveletMatrix.build(ids)
    return struct.pack(HEADER, MAGIC, len(ids), len(ends), len(matrix.planes)) + ends.astype("<u8").tobytes() + matrix.to_bytes()


def open_shard(blob: bytes) -> tuple[WaveletMatrix, np.ndarray]:
    magic, n, docs, depth = struct.unpack_from(HEADER, blob)
    if magic != MAGIC:
        raise ValueError("not a token shard")
    at = struct.calcsize(HEADER)
    return WaveletMatrix.from_bytes(memoryview(blob)[at + 8 * docs:], n, depth), np.frombuffer(blob, "<u8", docs, at)


def _shards(path: str, end: int):
    def run(batches):
        part, before, number, last = TaskContext.get().partitionId(), 0, 0, end.to_bytes(4, "little")
        docs, texts, size = [], [], 0

        def shard():
            ids = np.frombuffer(b"".join(texts), "<u4")
            ends = np.cumsum([len(t) // 4 for t in texts])
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()),
                                               pa.array([len(ids)], pa.int64()), pa.array([docs], pa.list_(kind)), pa.array([pack_shard(ids, ends)], pa.binary())],
                                              names=["part", "shard", "before", "n_tokens", "docs", "blob"])

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0), batch.column(1)):
                docs.append(doc.as_py())
                texts.append(encoder(path).encode(text.as_py()) + last)
                size += len(texts[-1]) // 4
                if size >= SHARD_TOKENS:
                    yield shard()
                    before, number = before + size, number + 1
                    docs, texts, size = [], [], 0
        if texts:
            yield shard()
    return run


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """Encode and write; the table of shards: part, shard, before (tokens of the part before it),
    n_tokens, docs, blob. Parts and shards follow the order of the ids."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return staged(ordered.mapInArrow(_shards(path, end), f"part int, shard int, before long, n_tokens long, docs array<{kind}>, blob binary"), "shards")


def _documents(batches):
    for batch in batches:
        for part, before, docs, blob in zip(*(batch.column(i) for i in range(4))):
            matrix, ends = open_shard(blob.as_py())
            data, starts = matrix.decode().tobytes(), np.concatenate([[0], ends[:-1]]).astype(np.int64)
            n = len(ends)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.as_py()] * n, pa.int32()), docs.values, pa.array(starts + before.as_py()), pa.array(ends.astype(np.int64) - starts),
                 pa.array([data[4 * s:4 * e] for s, e in zip(starts.tolist(), ends.tolist())], pa.binary())],
                names=["part", "doc_id", "start", "n_tokens", "ids"])


def read_documents(shards: DataFrame) -> DataFrame:
    """Every document from the shards: doc_id, start (over all documents), n_tokens, ids (bytes)."""
    spark = shards.sparkSession
    kind = shards.schema["docs"].dataType.elementType.simpleString()
    sums = sorted(shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())      # one row for each range partition
    base, rows = 0, []
    for part, n in sums:
        rows.append((part, base))
        base += n
    bases = spark.createDataFrame(rows, "part int, base long")
    docs = shards.select("part", "before", "docs", "blob").mapInArrow(
        _documents, f"part int, doc_id {kind}, start long, n_tokens long, ids binary")
    return docs.join(F.broadcast(bases), "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """Part, shard and position inside the shard of every occurrence of an id."""
    def run(batches):
        for batch in batches:
            for part, shard, blob in zip(*(batch.column(i) for i in range(3))):
                at = open_shard(blob.as_py())[0].occurrences(token)
                yield pa.RecordBatch.from_arrays([pa.array([part.as_py()] * len(at), pa.int32()), pa.array([shard.as_py()] * len(at), pa.int32()),
                                                  pa.array(at, pa.int64())], names=["part", "shard", "position"])
    return shards.select("part", "shard", "blob").mapInArrow(run, "part int, shard int, position long")
