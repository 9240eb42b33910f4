"""Best-fit packing of token pieces into sequences of bounded length.

Documents are encoded where they are read. Only lengths travel: pieces are spread evenly by a hash
over tasks of ``ROWS_PER_TASK`` pieces, and each task packs its pieces online with a fixed number of
open sequences. A task's order is fixed by that hash, so a task that runs again packs alike.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm.word_ids import word_ids
from assayer.session import settle

CAPACITY = 2048
OPEN_SEQUENCES = 512
ROWS_PER_TASK = 50_000
END_ID = 0


class OpenSequences:
    """Open sequences by free space; the set bits of ``free`` are the free spaces at hand."""

    def __init__(self, capacity: int, limit: int, first: int = 0):
        self.capacity, self.limit, self.next = capacity, limit, first
        self.free, self.open = 0, 0
        self.waiting: dict[int, list[int]] = defaultdict(list)

    def take(self, space: int) -> int:
        """Take out a sequence with just this free space."""
        self.open -= 1
        sequence = self.waiting[space].pop()
        if not self.waiting[space]:
            self.free &= ~(1 << space)
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset for a piece: the least free space that holds it, else a new one."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            sequence = self.take(space)
        else:
            if self.open == self.limit:
                self.take((self.free & -self.free).bit_length() - 1)
            space, sequence = self.capacity, self.next
            self.next += 1
        left = space - length
        if left:
            self.open += 1
            self.free |= 1 << left
            self.waiting[left].append(sequence)
        return sequence, self.capacity - space


def token_pieces(
    documents: DataFrame,
    vocabulary: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """Encode texts and cut those longer than ``capacity``: ``doc_id, piece, start, length, ids``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. Each text ends with id
    ``END_ID``; a null text counts as empty, so it is that id alone. Other columns are ignored.
    """
    source = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    end = END_ID.to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, width = word_ids(vocabulary), 4 * capacity
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                owner, piece, ids = [], [], []
                for row, text in enumerate(part.column(1).cast(pa.binary()).to_pylist()):
                    body = encoder.encode(text or b"") + end
                    cuts = [body[i : i + width] for i in range(0, len(body), width)]
                    owner += [row] * len(cuts)
                    piece += range(len(cuts))
                    ids += cuts
                place = np.array(piece, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(owner, pa.int32())),
                        pa.array(place),
                        pa.array(place.astype(np.int64) * capacity),
                        pa.array(np.fromiter(map(len, ids), np.int64, len(ids)) // 4),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids binary"
    return source.mapInArrow(encode, schema)


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    open_sequences: int = OPEN_SEQUENCES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have ``doc_id``, ``piece`` and ``length``.

    All columns are kept; ``sequence_id`` and ``offset`` that are there already are replaced. Each
    piece must be 1 to ``capacity`` long. Pieces that are equal in all columns are packed one by one.
    """
    pieces = settle(pieces.drop("sequence_id", "offset"), "pieces")
    tasks = -(-pieces.count() // rows_per_task) or 1
    turn = F.xxhash64("doc_id", "piece")
    spread = (
        pieces.withColumn("turn", turn).repartition(tasks, "turn").sortWithinPartitions("turn", "doc_id", "piece")
    )
    schema = T.StructType(
        [*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = OpenSequences(capacity, open_sequences, TaskContext.get().partitionId() << 32)
        for batch in batches:
            placed = [bins.place(length) for length in batch["length"].tolist()]
            places = np.array(placed, np.int64).reshape(-1, 2)
            yield batch.drop(columns="turn").assign(sequence_id=places[:, 0], offset=places[:, 1])

    return spread.mapInPandas(fill, schema)
