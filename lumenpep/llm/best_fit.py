"""Best-fit packing without needless cuts: the plan is made over counts of lengths, and documents take its places by rank.

Each task tokenizes its documents. Only those longer than a sequence are cut, into whole sequences and a shorter piece that
comes first. The histogram of piece lengths (at most `capacity` rows) reaches the driver, where best fit decreasing runs on
it: all pieces of a length go, longest lengths first, into the open sequences with the least space that holds them, as many
sequences at once as are alike. The plan is a list of places: so many ranks of a length go to a run of sequences, at an
offset. A piece finds its place by its rank among the pieces of its length; ranks are counted inside each task and shifted
by the counts of the tasks before it, so no length, however common, is ranked in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import only, released, small_batches, stage, values

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
KEPT = [f.split()[0] for f in PIECES.split(", ")][:5]


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, each, first sequence, offset), by length and first rank: from that rank on, `each` pieces
    go into every one of a run of sequences, the first at this offset. A row ends where the next of its length begins.

    Best fit decreasing, exactly: of the open sequences that a piece fits, the one with the least space takes it, so a
    sequence takes pieces of a length until it has less space than that. Sequences with the same space are runs of
    numbers; a length cuts at most one run in two and opens at most two, so the plan grows with the capacity alone.
    """
    spaces: list[int] = []  # of open sequences, ascending
    runs: dict[int, list[tuple[int, int]]] = {}  # space -> runs (first sequence, how many)
    rows, opened = [], 0

    def put(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in runs:
                insort(spaces, space)
            runs.setdefault(space, []).append((first, count))

    for length in sorted((k for k, n in histogram.items() if n > 0), reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, count = runs[space].pop()
                if not runs[space]:
                    del runs[space], spaces[at]
            else:
                space, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            each = space // length
            whole = min(count, left // each)
            for sequences, times in ((whole, each), (1 if whole < count else 0, left - whole * each if whole < count else 0)):
                if sequences and times:
                    rows.append((length, rank, times, first, capacity - space))
                    put(space - times * length, first, sequences)
                    rank, left, first, count = rank + sequences * times, left - sequences * times, first + sequences, count - sequences
            put(space, first, count)
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _cut(path: str, capacity: int, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        encoder = tokens.encoder(path)
        for batch in batches:
            rows = []
            ids = encoder.encode(values(batch, 1))
            for doc, data in zip(batch.column(0).to_pylist(), ids, strict=True):
                data += end
                n = len(data) // 4
                start, stop, piece = 0, (n - 1) % capacity + 1, 0
                while start < n:
                    part = data[start * 4 : stop * 4]
                    rows.append((doc, piece, start, stop - start, zlib.crc32(part), task, seen[stop - start]))
                    seen[stop - start] += 1
                    start, stop, piece = stop, stop + capacity, piece + 1
            if rows:
                types = [pa.int32() if f.endswith(" int") else pa.int64() for f in PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[*KEPT, "task", "nth"])

    return run


def _place(rows: np.ndarray):
    key = (rows[:, 0] << 48) + rows[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            row = rows[np.searchsorted(key, (length << 48) + rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 3] + nth // row[:, 2], row[:, 4] + nth % row[:, 2] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in KEPT), pa.array(sequence), pa.array(offset)], names=[*KEPT, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    docs: doc_id, text; other columns, whatever their names, are ignored. A null or empty text is the end id alone; every
    document ends with it. A document of up to `capacity` ids is one piece; a longer one has whole sequences after a first
    piece of the rest. Texts of any length are encoded whole. Rows with equal or null doc_id are documents of their own;
    equal lengths take places in the order of tasks and rows. An empty table gives no rows. Sequences are numbered
    from 0; offsets in each are gapless from 0.
    """
    small_batches(docs.sparkSession)
    path = tokenizer or tokens.public("byte_bpe_50k.json")
    pieces = stage(only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(released(_cut(path, capacity, end_id)), PIECES), "best-fit")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    ranked = pieces.join(shift, ["length", "task"]).withColumn("rank", F.col("nth") + F.col("shift"))
    return ranked.mapInArrow(_place(plan(histogram, capacity)), PLACED)
