"""Best-fit packing by minimum bin slack.

Documents become token ids with an end id; only those longer than a sequence are cut. Pieces are
packed where they are read, in bounded buffers: each bin takes the longest piece left, and a
bitset subset-sum over the lengths left finds the fullest combination for the rest of it. Only
exactly full bins leave a task; pieces of other bins stay over, also when the buffer has to be
emptied. What stays over from all tasks is dealt at random into as few groups as its size allows
and packed again, round after round, until one group holds it or a round gains little; then all
bins leave.

The texts are never shuffled: one written table holds the pieces, and later rounds move only
what stayed over. Sequence ids name the round, the task or group, and a counter.

Defined cases: null or empty text is the end id alone; repeated rows are separate documents; ids
of documents may be null or repeated; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from posterion.llm.common import staged
from posterion.llm.tokens import encoder

LENGTH = 4096
END = 1
BUFFER_TOKENS = 4 << 20
GAIN = 0.8                   # a round that leaves more than this share is the last but one
TURNS = 60
SCHEMA = "piece int, start long, length long, ids binary, sequence_id long, offset long"


def fullest(counts: np.ndarray, gap: int) -> list[int]:
    """Lengths, out of counts[length] available each, with the largest sum of at most gap.

    Bit s of a step's bitset says that a sum s can be made; the search ends once the gap itself can.
    """
    limit, goal = (1 << (gap + 1)) - 1, 1 << gap
    steps, reach = [], 1
    for length in np.flatnonzero(counts[:gap + 1])[::-1].tolist():
        left, many = min(int(counts[length]), gap // length), 1
        while left and not reach & goal:
            take = min(many, left)                       # 1, 2, 4, ... copies make every number of copies
            more = reach | (reach << (take * length)) & limit
            if more != reach:
                steps.append((length, take, reach))
                reach = more
            left -= take
            many *= 2
        if reach & goal:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * take
            total -= take * length
    return chosen


def bins(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices of the pieces of each bin. Equal lengths leave in the order they came."""
    counts = np.zeros(capacity + 1, np.int64)
    queues: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        counts[lengths[i]] += 1
        queues.setdefault(lengths[i], []).append(i)
    out = []
    for longest in sorted(queues, reverse=True):
        while counts[longest]:
            counts[longest] -= 1
            chosen = [longest, *fullest(counts, capacity - longest)]
            for c in chosen[1:]:
                counts[c] -= 1
            out.append([queues[c].pop() for c in chosen])
    return out


class _Packer:
    """Pieces of one task: full bins leave, the rest stays over without a sequence; in the last round (`everything`)
    all bins leave."""

    def __init__(self, schema: pa.Schema, base: int, capacity: int, everything: bool):
        self.schema, self.base, self.capacity, self.everything = schema, base, capacity, everything
        self.rows: list[tuple] = []
        self.tokens, self.made = 0, 0

    def add(self, row: tuple):
        self.rows.append(row)
        self.tokens += row[3]
        if self.tokens >= BUFFER_TOKENS:
            yield from self.flush(last=False)

    def flush(self, last: bool):
        out, rest = [], []
        lengths = [r[3] for r in self.rows]
        packed = bins(lengths, self.capacity)
        loose = sum(sum(lengths[i] for i in b) < self.capacity for b in packed)
        empty = last or loose * self.capacity > BUFFER_TOKENS // 2      # too much would stay in memory
        for b in packed:
            if self.everything and empty or sum(lengths[i] for i in b) == self.capacity:
                at = 0
                for i in b:
                    out.append((*self.rows[i], self.base + self.made, at))
                    at += lengths[i]
                self.made += 1
            else:
                rest += b
        self.rows = [self.rows[i] for i in sorted(rest)]
        if empty:
            out += [(*r, None, None) for r in self.rows]
            self.rows = []
        self.tokens = sum(r[3] for r in self.rows)
        for at in range(0, len(out), 2000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[at:at + 2000]), self.schema)], schema=self.schema)


def _arrow(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("doc_id", id_type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                      ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _first(path: str, capacity: int, end: int):
    def run(batches):
        packer, last = None, end.to_bytes(4, "little")
        for batch in batches:
            if packer is None:
                packer = _Packer(_arrow(batch.schema.field(0).type), TaskContext.get().partitionId() << 32, capacity, False)
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids = encoder(path).encode(text.as_py()) + last
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    yield from packer.add((doc.as_py(), k, at // 4, len(own) // 4, own))
        if packer:
            yield from packer.flush(last=True)
    return run


def _again(capacity: int, turn: int, everything: bool):
    def run(batches):
        packer = None
        for batch in batches:
            if packer is None:
                packer = _Packer(_arrow(batch.schema.field(0).type), turn << 56 | TaskContext.get().partitionId() << 32, capacity, everything)
            for row in zip(*(c.to_pylist() for c in batch.columns[:5])):
                yield from packer.add(row)
        if packer:
            yield from packer.flush(last=True)
    return run


def packed(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", capacity: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, sequence_id, offset."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, {SCHEMA}"
    pieces = staged(narrow.mapInArrow(_first(path, capacity, end), schema), "pieces")
    done, turn, before = [pieces.filter("sequence_id is not null")], 1, None
    while True:
        loose = pieces.filter("sequence_id is null")
        tokens = loose.agg(F.sum("length")).first()[0] or 0
        groups = max(1, -(-tokens // BUFFER_TOKENS))
        last = groups == 1 or turn == TURNS or before is not None and tokens > GAIN * before
        # dealt by row, not by content: copies and runs of one length spread over all groups
        salt = F.xxhash64(F.monotonically_increasing_id(), F.lit(turn))
        again = loose.withColumn("salt", salt).repartition(groups, "salt").drop("salt").mapInArrow(_again(capacity, turn, last), schema)
        if last:
            done.append(again)
            break
        pieces = staged(again, "pieces")
        done.append(pieces.filter("sequence_id is not null"))
        turn, before = turn + 1, tokens
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
