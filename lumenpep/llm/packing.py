"""Packing documents into sequences of fixed length: shortest-pack-first over the length histogram.

Each task tokenizes its documents and cuts them into pieces of at most `capacity` ids. Only the histogram of piece
lengths (at most `capacity` rows) reaches the driver, where patterns are built longest length first. A pattern says which
lengths share a sequence and how many sequences look like it. Pieces find their place by rank among the pieces of their
length: the first ranks go to the first pattern that uses the length, and so on. Ranks are counted inside each task and
shifted by the counts of the tasks before it, so no length, however common, is ranked in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import only, released, small_batches, stage, values

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long, nth long"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """[(length -> how often in a sequence, number of such sequences)], for a histogram length -> number of pieces.

    Lengths are placed longest first, each into the shortest pack that exists (the one with most space left) as long as
    it fits, and into new packs after that.
    """
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}  # space left -> patterns with counts
    full: list[tuple[dict[int, int], int]] = []

    def keep(pattern: dict[int, int], count: int, space: int) -> None:
        if space:
            open_.setdefault(space, []).append((pattern, count))
        else:
            full.append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            space = max(open_, default=0)
            if space < length:
                per = capacity // length  # new packs, each filled with as many pieces of this length as fit
                if left >= per:
                    keep({length: per}, left // per, capacity - per * length)
                if left % per:
                    keep({length: left % per}, 1, capacity - left % per * length)
                break
            pattern, count = open_[space].pop()
            if not open_[space]:
                del open_[space]
            # every pack of this kind takes as many pieces as fit while they last, so packs of a kind stay alike
            each = min(space // length, max(1, left // count))
            used = min(count, left // each)
            if used < count:
                keep(pattern, count - used, space)
            keep({**pattern, length: pattern.get(length, 0) + each}, used, space - each * length)
            left -= used * each
    return full + [p for group in open_.values() for p in group]


def slots(found: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, sequences, first sequence, offset), sorted by length and first rank. Bounded by the
    capacity alone: patterns and the different lengths in each don't grow with the number of documents."""
    rows, taken, first = [], {}, 0
    for pattern, count in found:
        offset = 0
        for length, times in pattern.items():
            rank = taken.get(length, 0)
            rows.append((length, rank, count, first, offset))
            taken[length] = rank + count * times
            offset += length * times
        first += count
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
                for start in range(0, n, capacity):
                    piece = data[start * 4 : (start + capacity) * 4]
                    length = len(piece) // 4
                    rows.append((doc, start, length, zlib.crc32(piece), n, task, seen[length]))
                    seen[length] += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=[f.split()[0] for f in PIECES.split(", ")])

    return run


def _place(slot: np.ndarray):
    key = (slot[:, 0] << 48) + slot[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            row = slot[np.searchsorted(key, (length << 48) + rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence = row[:, 3] + nth % row[:, 2]
            offset = row[:, 4] + nth // row[:, 2] * length
            kept = [batch.column(n) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[f.split()[0] for f in PLACED.split(", ")])

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    docs: doc_id, text; other columns are ignored. A null or empty text is the end id alone; every document ends with
    it. Long documents are cut after each `capacity` ids. Rows with equal or null doc_id are documents of their own. An
    empty table gives no rows. Sequences are numbered from 0; offsets in each are gapless from 0.
    """
    small_batches(docs.sparkSession)
    path = tokenizer or tokens.public("byte_bpe_50k.json")
    pieces = stage(only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(released(_cut(path, capacity, end_id)), PIECES), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    ranked = pieces.join(shift, ["length", "task"]).withColumn("rank", F.col("nth") + F.col("shift"))
    return ranked.mapInArrow(_place(slots(patterns(histogram, capacity))), PLACED)
