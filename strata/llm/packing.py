"""Cost-balanced packing of token ids into training sequences.

Nulls and empty texts are documents of one token, the end id. Long documents are cut. A null
doc_id is carried along; repeated documents are packed like any others; an empty table gives no
pieces. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.common import documents_only, give_back, slices, tidy
from strata.llm.tokens import encoder

SEQUENCE = 1024
#: Pieces shorter than a sequence that are packed together; bounds a worker's memory.
BLOCK_PIECES = 4096

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])


def balance(lengths: list[int], capacity: int = SEQUENCE, linear: float = 1.0,
            quadratic: float = 1 / 512) -> list[tuple[int, int, int, int, int]]:
    """(piece, cut start, cut length, sequence, offset) for pieces in descending length.

    Just as many sequences are opened as the tokens need. A piece goes to the sequence of lowest
    cost (``linear`` per token, ``quadratic`` per pair of tokens that attend to each other) among
    those with room for it; if none has room, the cheapest one with any room is filled and the rest
    is placed likewise.
    """
    count = -(-sum(lengths) // capacity)
    cost, room = np.zeros(count), np.full(count, capacity)
    placed = []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        done = 0
        while done < lengths[piece]:
            rest = lengths[piece] - done
            fits = room >= rest
            if not fits.any():
                fits = room > 0
            target = int(np.argmin(np.where(fits, cost, np.inf)))
            size = min(rest, int(room[target]))
            placed.append((piece, done, size, target, capacity - int(room[target])))
            room[target] -= size
            cost[target] += linear * size + quadratic * size * size
            done += size
    return placed


class Packer:
    """Pieces of one task: whole sequences leave at once, rests wait for a block."""

    def __init__(self, partition: int, capacity: int, block: int, with_ids: bool):
        self.base, self.capacity, self.block, self.with_ids = partition << 36, capacity, block, with_ids
        self.sequences = 0
        self.rests: list[tuple] = []
        self.rows: list[tuple] = []

    def piece(self, doc, start, ids, total, sequence, offset) -> None:
        raw = ids.astype("<u4").tobytes()
        self.rows.append((doc, start, len(ids), zlib.crc32(raw), total, self.base + sequence, offset,
                          raw if self.with_ids else None))

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            self.piece(doc, start, ids[start:start + self.capacity], len(ids), self.sequences, 0)
            self.sequences += 1
        if whole < len(ids):
            self.rests.append((doc, whole, ids[whole:].astype(np.uint32), len(ids)))
        if len(self.rests) >= self.block:
            self.flush()

    def flush(self) -> None:
        self.rests.sort(key=lambda rest: (rest[0] is None, rest[0] or 0, rest[1]))
        used = 0
        for index, cut, size, sequence, offset in balance([len(rest[2]) for rest in self.rests], self.capacity):
            doc, start, ids, total = self.rests[index]
            self.piece(doc, start + cut, ids[cut:cut + size], total, self.sequences + sequence, offset)
            used = max(used, sequence + 1)
        self.sequences += used
        self.rests = []

    def take(self) -> pa.RecordBatch | None:
        rows, self.rows = self.rows, []
        if not rows:
            return None
        kinds = [pa.int64()] * 7 + [pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)], PIECES.names)


def pack(docs: DataFrame, capacity: int = SEQUENCE, tokenizer: str | None = None, end: int = 0,
         block: int = BLOCK_PIECES, with_ids: bool = False) -> DataFrame:
    """One row per piece: document, start in it, length, checksum, sequence, offset there, ids on request.

    Every task packs the documents it reads, block by block, so nothing is shuffled; a block
    leaves at most one sequence that is not full. Sequence ids hold the partition, so they
    never meet. A task that is run again gives its own rows anew.
    """
    @tidy
    def run(batches):
        packer = Packer(TaskContext.get().partitionId(), capacity, block, with_ids)
        encode = encoder(tokenizer, end).encode
        for batch in batches:
            for part in slices(batch, limit=2_000_000):
                ids, starts = encode(part.column("text").to_pylist())
                for i, doc in enumerate(part.column("doc_id").to_pylist()):
                    packer.add(doc, ids[starts[i]:starts[i + 1]])
                if (made := packer.take()) is not None:
                    yield made
            give_back()
        packer.flush()
        if (made := packer.take()) is not None:
            yield made

    return documents_only(docs).mapInArrow(run, PIECES)
