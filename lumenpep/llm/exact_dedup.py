"""Exact deduplication with an extendible-hash index in shared files.

The key of a text is a 64-bit hash. A directory over the leading bits of keys points to buckets; buckets that hold more
than their capacity are split, and the directory doubles where a bucket is as deep as the directory. Each bucket is a
range of keys with one owner task. Map tasks first collapse equal texts, so a text that fills a third of the table reaches
its owner as a few rows. An owner reads its rows in key order, keeps a chain of the different texts of one key, compares
bytes, and writes the bucket's file. Documents then find their group by key and digest; groups of over a thousandth of all
rows, fewer than a thousand, are known beforehand and dealt over several tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import new_path, only, released, small_batches, text_or_empty, values

ENTRIES = "bucket int, key long, chain int, text_sha256 string, keep_id long, group_size long"
COMBINED = "bucket int, key long, text string, n long, last long"
HOT = 1000


class Directory:
    """Leading `depth` bits of a key -> bucket. `load` is what each of the 2**finest slots of keys holds."""

    def __init__(self, load: np.ndarray, capacity: int, finest: int):
        self.depth, self.finest = 0, finest
        self.pointers = [0]
        self.local = [0]  # depth of each bucket
        before = np.concatenate(([0], np.cumsum(load)))
        low = [0]  # first slot of each bucket
        todo = [0]
        while todo:
            b = todo.pop()
            width = 1 << (finest - self.local[b])
            if before[low[b] + width] - before[low[b]] <= capacity or self.local[b] == finest:
                continue
            if self.local[b] == self.depth:  # the directory doubles
                self.pointers = [p for p in self.pointers for _ in range(2)]
                self.depth += 1
            self.local[b] += 1
            self.local.append(self.local[b])
            low.append(low[b] + width // 2)
            new = len(low) - 1
            first, many = low[new] >> (finest - self.depth), width // 2 >> (finest - self.depth)
            self.pointers[first : first + many] = [new] * many
            todo += [b, new]

    def buckets(self) -> int:
        return len(self.local)

    def of(self, keys: np.ndarray) -> np.ndarray:
        at = keys.view(np.uint64) >> np.uint64(64 - self.depth) if self.depth else np.zeros(len(keys), dtype=np.uint64)
        return np.array(self.pointers, dtype=np.int32)[at.astype(np.int64)]


def _combine(directory: Directory, held: int):
    """Collapses equal texts of a task, as far as `held` characters go at once."""
    names = [f.split()[0] for f in COMBINED.split(", ")]

    def flush(met: dict) -> pa.RecordBatch:
        keys = np.array([k for k, _ in met], dtype=np.int64)
        n, last = zip(*met.values(), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(directory.of(keys)), pa.array(keys), pa.array([t for _, t in met]), pa.array(n, pa.int64()), pa.array(last, pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[tuple[int, str], tuple[int, int | None]] = {}
        size = 0
        for batch in batches:
            for doc, key, text in zip(*(values(batch, i) for i in range(3)), strict=True):
                n, last = met.get((key, text), (0, None))
                met[key, text] = n + 1, doc if last is None else last if doc is None else max(last, doc)
                if not n:
                    size += len(text) + 200
                    if size > held:
                        yield flush(met)
                        met, size = {}, 0
        if met:
            yield flush(met)

    return run


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one bucket or more, in the order of their keys."""
    names = [f.split()[0] for f in ENTRIES.split(", ")]
    done: list[tuple] = []
    at, chain = None, []

    def close() -> None:
        done.extend((*at, i, hashlib.sha256(text).hexdigest(), last, n) for i, (text, n, last) in enumerate(chain))

    def out() -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        for bucket, key, text, n, last in zip(*(values(batch, i) for i in range(5)), strict=True):
            if at != (bucket, key):
                if at:
                    close()
                at, chain = (bucket, key), []
            data = text.encode("utf-8")
            for entry in chain:
                if entry[0] == data:
                    entry[1] += n
                    entry[2] = last if entry[2] is None else entry[2] if last is None else max(entry[2], last)
                    break
            else:
                chain.append([data, n, last])
        if len(done) > 5_000:
            yield out()
            done.clear()
    if at:
        close()
    if done:
        yield out()


def _keyed(docs: DataFrame, key: Column | None) -> DataFrame:
    return only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).select("doc_id", (F.xxhash64("text") if key is None else key).alias("key"), "text")


def build_index(docs: DataFrame, path: str | None = None, capacity: int = 16 << 20, finest: int = 16, held: int = 4 << 20, key: Column | None = None) -> tuple[str, Directory]:
    """Writes the index of docs (doc_id, text) and returns its folder and directory. Each bucket is a folder with one
    file of chains: key, chain, text_sha256, keep_id, group_size. capacity: characters of different texts in a bucket, or,
    where it is more, 2**(1 - finest) of all of them, so that files stay countable: an owner streams through its bucket in the
    order of keys, whatever that holds. The directory has at most 2**finest entries."""
    spark = docs.sparkSession
    small_batches(spark)
    path = path or new_path(spark, "dedup-index")
    keyed = _keyed(docs, key)
    loads = keyed.select("key", F.length("text").alias("n")).groupBy("key").agg(F.max("n").alias("n"))
    loads = loads.groupBy(F.shiftrightunsigned("key", 64 - finest).cast("int").alias("slot")).agg(F.sum(F.col("n") + 64).alias("n"))
    load = np.zeros(1 << finest, dtype=np.int64)
    for r in loads.toLocalIterator():  # at most 2**finest rows
        load[r["slot"]] = r["n"]
    directory = Directory(load, max(capacity, int(load.sum()) >> (finest - 1)), finest)
    combined = keyed.mapInArrow(released(_combine(directory, held)), COMBINED)
    owned = combined.repartitionById(directory.buckets(), F.col("bucket")).sortWithinPartitions("bucket", "key")
    owned.mapInArrow(released(_own), ENTRIES).write.partitionBy("bucket").parquet(path)
    return path, directory


def dedup(docs: DataFrame, **options) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are, a null text as the empty one. Of equal texts the row with the largest doc_id
    stays; of rows that share this doc_id as well, all have kept = true (kept_rows() takes one of them). A null doc_id is
    the smallest. An empty table gives no rows; columns other than doc_id and text are ignored.
    """
    path, _ = build_index(docs, **options)
    index = docs.sparkSession.read.schema("key long, text_sha256 string, keep_id long, group_size long").parquet(path)
    rows = _keyed(docs, options.get("key")).select("doc_id", "key", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    # a group of over 1/HOT of all rows, of which there are fewer than HOT, is dealt over as many tasks as it has such shares
    total = index.agg(F.coalesce(F.sum("group_size"), F.lit(0))).head()[0]
    parts = F.when(F.col("group_size") * HOT > total, F.ceil(F.col("group_size") * HOT / F.lit(max(total, 1)))).otherwise(1).cast("int")
    index = index.withColumn("parts", parts)
    hot = index.filter("parts > 1").select("key", "text_sha256", "parts")
    rows = rows.join(F.broadcast(hot), ["key", "text_sha256"], "left").withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("parts"))).cast("int")).drop("parts")
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return rows.join(index, ["key", "text_sha256", "part"]).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def kept_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs (doc_id, text, and any others), with all their columns, that dedup() keeps; a single one where rows
    share text and doc_id.

    A null text is the empty one and a null doc_id the smallest: of rows without doc_id and with equal texts one stays, if no
    other row has the text. Names of other columns, whatever they are, stay; an empty table gives no rows.
    """
    given = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_given"), F.col("doc_id").cast("long").alias("_doc"), F.sha2(text_or_empty().cast("binary"), 256).alias("_sha"))
    kept = dedup(docs, **options).filter("kept").groupBy(F.col("doc_id").alias("_keep"), F.col("text_sha256").alias("_text")).agg(F.count("*").alias("_many"))
    joined = given.join(kept, F.col("_sha").eqNullSafe(F.col("_text")) & F.col("_doc").eqNullSafe(F.col("_keep")))
    repeated = joined.filter("_many > 1").groupBy("_keep", "_text").agg(F.first("_given").alias("_given")).select("_given")
    return joined.filter("_many = 1").select("_given").union(repeated).select(*(F.col(f"_given.`{c}`").alias(c) for c in docs.columns))
