"""Packing token ids of documents into fixed-length sequences, in bounded space.

Every task keeps ``open_windows`` unfinished sequences and nothing else of what it has read. What a
document has beyond whole sequences goes into the open window it fits best. When none has room and
all windows are open, the fullest is topped up with a cut of the document and emitted. What is still
open at the end of a task is packed again the same way, many tasks' leftovers at a time, until one
task closes the last windows. So only those last few sequences are ever padded.

Defined results: a null text has no ids but the end id; rows that share a doc_id are packed as
documents of their own; an empty table gives no pieces; columns beside the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from changefold.llm.common import map_arrow, staged, text_rounds
from changefold.llm.tokens import Encoder

#: Tasks whose leftovers one task of the next level packs. A level's input is at most this many
#: times the open windows.
MERGED = 64

SCHEMA = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long, level int, part int"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("level", pa.int32()), ("part", pa.int32())]
)
#: Rows put out at a time.
_OUT_ROWS = 2_000


class _Packer:
    """The open windows of one task, and the pieces that are ready to be put out."""

    def __init__(self, capacity: int, open_windows: int, level: int, part: int) -> None:
        self.capacity, self.open_windows, self.level, self.part = capacity, open_windows, level, part
        self.windows: list[list] = []  # [ids held, pieces]
        self.sequences = 0
        self.out: list[tuple] = []

    def add(self, doc_id: int | None, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        done = 0
        while len(ids) - done >= self.capacity:
            self._emit([(doc_id, start + done, ids[done : done + self.capacity], doc_tokens)])
            done += self.capacity
        while rest := len(ids) - done:
            fitting = [window for window in self.windows if self.capacity - window[0] >= rest]
            if fitting:
                window = max(fitting, key=lambda w: w[0])
            elif len(self.windows) < self.open_windows:
                window = [0, []]
                self.windows.append(window)
            else:
                window = max(self.windows, key=lambda w: w[0])
            taken = min(rest, self.capacity - window[0])
            window[1].append((doc_id, start + done, ids[done : done + taken], doc_tokens))
            window[0] += taken
            done += taken
            if window[0] == self.capacity:
                self.windows = [w for w in self.windows if w is not window]
                self._emit(window[1])

    def close(self) -> None:
        """Emit what is open as it is."""
        for _, pieces in self.windows:
            self._emit(pieces)
        self.windows = []

    def leave(self) -> None:
        """Hand what is open to the next level: pieces without a sequence."""
        for _, pieces in self.windows:
            for doc_id, start, ids, doc_tokens in pieces:
                self.out.append((doc_id, start, ids.tobytes(), doc_tokens, None, None, self.level, self.part))
        self.windows = []

    def _emit(self, pieces: list[tuple]) -> None:
        sequence = self.level << 58 | self.part << 34 | self.sequences
        self.sequences += 1
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.out.append((doc_id, start, ids.tobytes(), doc_tokens, sequence, offset, self.level, self.part))
            offset += len(ids)

    def ready(self, least: int = _OUT_ROWS) -> Iterator[pa.RecordBatch]:
        while self.out and len(self.out) >= least:
            rows, self.out = self.out[:_OUT_ROWS], self.out[_OUT_ROWS:]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), _ARROW, strict=True)],
                schema=_ARROW,
            )


def _pack_texts(tokenizer: str, end_id: int, capacity: int, open_windows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        packer = _Packer(capacity, open_windows, 0, TaskContext.get().partitionId())
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for row, data, offsets in text_rounds(batch.column(1)):
                texts, bounds = data.tobytes(), offsets.tolist()
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    own = np.frombuffer(encoder.encode(texts[a:b].decode()) + end, "<u4")
                    packer.add(doc_ids[row + k], 0, own, len(own))
                yield from packer.ready()
        packer.leave()
        yield from packer.ready(1)

    return run


def _pack_pieces(capacity: int, open_windows: int, level: int, last: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(capacity, open_windows, level, TaskContext.get().partitionId())
        for batch in batches:
            for doc_id, start, ids, doc_tokens in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                packer.add(doc_id, start, np.frombuffer(ids, "<u4"), doc_tokens)
            yield from packer.ready()
        if last:
            packer.close()
        else:
            packer.leave()
        yield from packer.ready(1)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    open_windows: int = 16,
) -> DataFrame:
    """Pieces of documents: doc_id, start, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file that all executors can open.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    parts = texts.rdd.getNumPartitions()
    levels = [_written(map_arrow(texts, _pack_texts(tokenizer, end_id, capacity, open_windows), SCHEMA))]
    while True:
        groups = -(-parts // MERGED)
        level, left = len(levels), levels[-1].where("sequence_id IS NULL")
        left = left.repartition(groups, F.floor(F.col("part") / MERGED)) if groups > 1 else left.repartition(1)
        pieces = left.sortWithinPartitions("part", "doc_id", "start", "ids").select("doc_id", "start", "ids", "doc_tokens")
        packed = map_arrow(pieces, _pack_pieces(capacity, open_windows, level, groups <= 1), SCHEMA)
        levels.append(_written(packed))
        if groups <= 1:
            break
        parts = groups
    every = reduce(DataFrame.unionByName, (rows.where("sequence_id IS NOT NULL") for rows in levels))
    return every.drop("level", "part")


def _written(rows: DataFrame) -> DataFrame:
    """Staged, so that closed sequences and leftovers come from one and the same run of each task."""
    return staged(rows, "packing", compression="zstd")
