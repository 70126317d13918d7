"""Token-id output: best-fit-decreasing packing of documents into rows of fixed length.

Each task packs the documents that it reads, in shards of a bounded number of tokens, so nothing is shuffled and no shard
grows with the input. Overlong documents are split into pieces, losslessly. Pieces go, longest first, into the open row with
the least capacity that still holds them; a segment tree over capacities finds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import codec, default_ranks
from .common import documents, keyed_texts

ROW_TOKENS = 2048
#: Tokens of a shard, about; a longer document is a shard of its own.
SHARD_TOKENS = 2_000_000
#: Fills the ends of rows in the id matrix; no token has this id.
PAD = 65_535


class CapacityTree:
    """Which capacities 0..top have open rows; finds the least one that is at least a given size in log time."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, capacity: int, there: bool) -> None:
        i = self.leaves + capacity
        self.any[i] = there
        while (i := i // 2) and self.any[i] != (now := self.any[2 * i] or self.any[2 * i + 1]):
            self.any[i] = now

    def least(self, size: int) -> int | None:
        i = self.leaves + size
        while not self.any[i]:
            while i & 1:  # right children have no neighbour under the same parent
                i //= 2
            if not i:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit_decreasing(sizes: list[int], top: int) -> list[list[int]]:
    """Rows of indices into sizes, each at most top in sum; equal sizes in given order."""
    tree, rows = CapacityTree(top), []
    open_rows: dict[int, list[int]] = {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        capacity = tree.least(sizes[i])
        if capacity is None:
            rows.append([])
            row, capacity = len(rows) - 1, top
        else:
            row = open_rows[capacity].pop()
            if not open_rows[capacity]:
                tree.set(capacity, False)
        rows[row].append(i)
        left = capacity - sizes[i]
        open_rows.setdefault(left, []).append(row)
        tree.set(left, True)
    return rows


def pack(docs: DataFrame, ranks_file: str, pattern: str, row_tokens: int = ROW_TOKENS, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per packed row: row_id; doc_ids, pieces (number of the piece in its document) and cu_seqlens (where segments end,
    from 0) as arrays; n_tokens; ids and positions as binary (unsigned 16-bit little-endian, row_tokens each, PAD at the end).

    Positions start again at 0 with each segment. Null and empty texts are segments of length 0. Repeated rows are packed
    each; other columns are ignored; an empty table gives an empty one. A document's pieces of row_tokens fill rows alone.
    """
    texts = keyed_texts(docs, id_col, text_col)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, made = codec(ranks_file, pattern), TaskContext.get().partitionId(), 0
        ids, names, numbers, held, arrow = [], [], [], 0, pa.int64()

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal made
            packed = best_fit_decreasing([len(x) for x in ids], row_tokens)
            for lo in range(0, len(packed), 500):
                some = packed[lo : lo + 500]
                matrix, places, ends = np.full((len(some), row_tokens), PAD, "<u2"), np.full((len(some), row_tokens), PAD, "<u2"), []
                for r, row in enumerate(some):
                    end = [0]
                    for i in row:
                        matrix[r, end[-1] : end[-1] + len(ids[i])] = ids[i]
                        places[r, end[-1] : end[-1] + len(ids[i])] = np.arange(len(ids[i]))
                        end.append(end[-1] + len(ids[i]))
                    ends.append(end)
                columns = {
                    "row_id": pa.array(np.arange(made, made + len(some)) + (part << 36)),
                    "doc_ids": pa.array([[names[i] for i in row] for row in some], pa.list_(arrow)),
                    "pieces": pa.array([[numbers[i] for i in row] for row in some], pa.list_(pa.int32())),
                    "cu_seqlens": pa.array(ends, pa.list_(pa.int32())),
                    "n_tokens": pa.array([e[-1] for e in ends], pa.int32()),
                    "ids": pa.array([x.tobytes() for x in matrix], pa.binary()),
                    "positions": pa.array([x.tobytes() for x in places], pa.binary()),
                }
                made += len(some)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        for batch in batches:
            arrow = batch.column(0).type
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                found = tokens.array(text.as_py())
                for number, lo in enumerate(range(0, max(1, len(found)), row_tokens)):
                    ids.append(found[lo : lo + row_tokens])
                    names.append(name.as_py())
                    numbers.append(number)
                held += len(found)
                if held >= shard_tokens:
                    yield from rows()
                    ids, names, numbers, held = [], [], [], 0
        if ids:
            yield from rows()

    return texts.mapInArrow(run, f"row_id bigint, doc_ids array<{kind}>, pieces array<int>, cu_seqlens array<int>, n_tokens int, ids binary, positions binary")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), *default_ranks())
