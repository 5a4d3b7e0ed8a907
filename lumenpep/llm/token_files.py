"""Token ids in compressed shard files with a shared zstandard dictionary.

A shard holds documents in ascending doc_id order, and shard n only ids above those of shard n - 1:

    magic "TOKSHARD", width of an id in bytes (1 byte), sha256 of the dictionary (32 bytes, zeros without one)
    for each document one zstandard frame over its serialized ids
    index: doc_id, end of the frame and number of ids of each document, as three little-endian int64 arrays
    number of documents (8 bytes), magic "TOKINDEX"

A reader of one document reads the tail, finds the document in the index and decompresses one short frame.
Files are written under another name and moved, so a task that is run again leaves whole files only.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import new_path, only, partitions, released, small_batches, stage, values

HEAD, TAIL = b"TOKSHARD", b"TOKINDEX"
NO_ID = -(1 << 63)  # in the index, for a null doc_id
SHARDS = "shard long, path string, documents long, ids long, first long, last long"
#: Names of one store that Hadoop and Arrow call differently.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs", "wasb": "abfs"}
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _fs(uri: str) -> tuple[pa.fs.FileSystem, str]:
    scheme, mark, rest = uri.partition("://")
    return pa.fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}{mark}{rest}" if mark else f"file://{uri}")


def serialize(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes()


def deserialize(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, dtype="<u2").astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, path: str, width: int, samples: int = 1000, longest: int = 32_000, size: int = 65_536) -> bytes:
    """A dictionary from the serialized ids of `samples` texts of at most `longest` characters: those with the smallest
    hash of doc_id. The sample is bounded since the library trains in memory; every document is compressed with the
    dictionary. With too few texts there is none."""
    import zstandard

    fit = docs.filter(F.length("text").between(1, longest))
    few = fit.select(F.xxhash64("doc_id", F.lit("dictionary")).alias("h"), "doc_id").orderBy("h").limit(samples).select("doc_id").distinct()
    texts = sorted(r["text"] for r in fit.join(F.broadcast(few), "doc_id", "left_semi").limit(samples).toLocalIterator())
    data = [serialize(ids, width) for ids in tokens.encoder(path).encode(texts)]
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, data)) // 8)), data, level=3).as_bytes()
    except zstandard.ZstdError:
        return b""


def _write(folder: str, path: str, width: int, trained: bytes, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        fs, base = _fs(folder)
        shared = zstandard.ZstdCompressionDict(trained) if trained else None
        if shared:
            shared.precompute_compress(level=3)  # once a task, not for each frame
        press = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=True)
        encoder, out, ids, ends, counts, at = tokens.encoder(path), None, [], [], [], 0
        draft, name = f"{base}/draft-{uuid.uuid4().hex}", f"shard-{shard:06d}.tok"
        for batch in batches:
            if out is None and batch.num_rows:
                out = fs.open_output_stream(draft)
                out.write(HEAD + bytes([width]) + (hashlib.sha256(trained).digest() if trained else bytes(32)))
                at = len(HEAD) + 33
            for doc, data in zip(batch.column(0).to_pylist(), encoder.encode(values(batch, 1)), strict=True):
                frame = press.compress(serialize(data + end, width))
                out.write(frame)
                at += len(frame)
                ids.append(NO_ID if doc is None else doc)
                ends.append(at)
                counts.append(len(data) // 4 + 1)
        if out is not None:
            for column in (ids, ends, counts):
                out.write(np.array(column, dtype="<i8").tobytes())
            out.write(len(ids).to_bytes(8, "little") + TAIL)
            out.close()
            fs.move(draft, f"{base}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (shard, f"{folder}/{name}", len(ids), sum(counts), ids[0], ids[-1])], names=[f.split()[0] for f in SHARDS.split(", ")])

    return run


def write(docs: DataFrame, tokenizer: str | None = None, folder: str | None = None, end_id: int = 1, shards: int | None = None, per_shard: int = 128 << 20) -> DataFrame:
    """Writes documents (doc_id, text) into shards and returns the table of shards: shard, path, documents, ids,
    and the first and last doc_id. Without a number of shards there are as many as shuffles have partitions, or, where it is more,
    one for each per_shard characters (64 more for each document): a shard and its index keep their size as tables grow.

    Null and empty texts are the end id alone. Rows with equal doc_id lie in one shard, one after another; a null doc_id
    comes before all others and is null again when read. An empty table gives no shards.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = tokenizer or tokens.public("word_bpe_49k.json")
    folder = folder or new_path(spark, "tokens")
    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    width = 2 if tokens.encoder(path).vocabulary <= 1 << 16 and end_id < 1 << 16 else 4
    trained = train_dictionary(docs, path, width)
    fs, base = _fs(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/dictionary") as f:
        f.write(trained)
    if shards is None:
        total = docs.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 64)).head()[0] or 0
        shards = max(partitions(spark), -(-total // per_shard))
    dealt = docs.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id")
    return stage(dealt.mapInArrow(released(_write(folder, path, width, trained, end_id)), SHARDS), "shards")


class Shard:
    """One open file. `dictionary` is checked against the hash that the file keeps."""

    def __init__(self, path: str):
        import zstandard

        fs, where = _fs(path)
        self.file = fs.open_input_file(where)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        head = self.file.read_at(len(HEAD) + 33, 0)
        if tail[8:] != TAIL or head[: len(HEAD)] != HEAD:
            raise ValueError(f"{path} is no shard")
        n = int.from_bytes(tail[:8], "little")
        self.width, wanted = head[len(HEAD)], head[len(HEAD) + 1 :]
        index = np.frombuffer(self.file.read_at(24 * n, size - 16 - 24 * n), dtype="<i8").reshape(3, n)
        self.doc_ids, self.ends, self.counts = index
        self.begins = np.concatenate(([len(HEAD) + 33], self.ends[:-1]))
        with fs.open_input_stream(where.rpartition("/")[0] + "/dictionary") as f:
            trained = f.read()
        if (hashlib.sha256(trained).digest() if trained else bytes(32)) != wanted:
            raise ValueError(f"{path} was written with another dictionary")
        self.press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)

    def ids(self, nth: int) -> bytes:
        frame = self.file.read_at(int(self.ends[nth] - self.begins[nth]), int(self.begins[nth]))
        return deserialize(self.press.decompress(frame), self.width)

    def find(self, doc_id: int) -> np.ndarray | None:
        """The ids of one document, by its place in the index."""
        nth = int(np.searchsorted(self.doc_ids, doc_id))
        return np.frombuffer(self.ids(nth), dtype="<u4") if nth < len(self.doc_ids) and self.doc_ids[nth] == doc_id else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shard = Shard(path)
            for low in range(0, len(shard.doc_ids), 10_000):
                part = slice(low, low + 10_000)
                counts = shard.counts[part]
                crc = [zlib.crc32(shard.ids(i)) for i in range(low, low + len(counts))]
                starts = start + np.cumsum(counts) - counts
                start += int(counts.sum())
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids[part], mask=shard.doc_ids[part] == NO_ID), pa.array(starts), pa.array(counts), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read(shards: DataFrame) -> DataFrame:
    """For the table of shards that write() returns, one row for each document, from its files: doc_id, start (ids of
    all documents before it), n_tokens, ids_crc32."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file, not for each document
    at = shards.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    return at.repartition(partitions(shards.sparkSession)).mapInArrow(_read, ROWS)


def lookup(spark: SparkSession, shards: DataFrame, doc_id: int) -> np.ndarray | None:
    """The ids of one document, of the first where rows share its doc_id: the table of shards tells which shard can hold it,
    and of that its index and one frame are read."""
    row = shards.filter((F.col("first") <= doc_id) & (F.col("last") >= doc_id)).orderBy("shard").head()
    return Shard(row["path"]).find(doc_id) if row else None
