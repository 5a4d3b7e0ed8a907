"""Windows of several lengths, counted together: the longest window from a place stands for the shorter ones that begin there. A place is
shuffled once, as a number, and windows are written as strings only where they have met."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructType

from ..functions.hashes import md5_first
from .windows import _CODE, _LETTER, BITS, CODED

#: Places that a task gathers before it sends them on, and bytes of text for each bucket of places that meet in one group.
HELD, BUCKET = 1 << 22, 4_000_000
#: Windows that are hashed at once.
PORTION = 1 << 15
#: Codes of a text's letters, in either case; 255 for bytes that are no letters and drop out.
_TEXT = np.full(256, 255, dtype=np.uint8)
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TEXT[[_c, _c + 32]] = _CODE[_c]
#: First and last key of a window none of whose rows has one.
_FIRST, _LAST = np.iinfo(np.int64).max, np.iinfo(np.int64).min


class Shape:
    """How a number of 64 bits holds a place: the residues of its longest window, from the highest on and with zeros after its end,
    and in the lowest bits which of the lengths is the first that it counts for."""

    def __init__(self, lengths):
        self.lengths = tuple(sorted({int(k) for k in lengths if k > 0}))
        self.low, self.high = (self.lengths[0], self.lengths[-1]) if self.lengths else (0, 0)
        self.extra = max(len(self.lengths) - 1, 0).bit_length()
        self.rows = 1 << min(max(64 - BITS * self.high, 0), 9)

    def fits(self) -> bool:
        return bool(self.lengths) and self.high <= CODED and BITS * self.high + self.extra <= 64

    def prefix(self, codes: np.ndarray, k: int) -> np.ndarray:
        return codes >> np.uint64(BITS * (self.high - k))

    def bucket(self, codes: np.ndarray, buckets: int) -> np.ndarray:
        """By the shortest window, as all that begin with it count for it."""
        mixed = (self.prefix(codes, self.low) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        return ((mixed * np.uint64(buckets)) >> np.uint64(32)).astype(np.uint16)


def codes(texts: pa.Array, shape: Shape, text: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows and codes of all places where the shortest window fits; with text, of the letters of texts."""
    texts = pa.array(pc.fill_null(texts, "").cast(pa.large_binary()))
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    code = (_TEXT if text else _CODE).take(np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[at[0] : at[-1]])
    at = at - at[0]
    if text:
        letter = code != 255
        code, at = code[letter], np.concatenate(([0], np.cumsum(letter)))[at]
    # runs of residues end before another letter or with their row; odd numbers are ends of rows, which come after a letter there
    ends = np.sort(np.concatenate((2 * (np.flatnonzero(code == 0) + 1), 2 * at[1:] + 1)))
    begin = np.concatenate(([0], ends[:-1] >> 1))
    end = (ends >> 1) - 1 + (ends & 1)
    many = np.maximum(end - begin - shape.low + 1, 0)
    on = many > 0
    begin, end, many = begin[on], end[on], many[on]
    starts = np.arange(int(many.sum())) + np.repeat(begin - np.cumsum(many) + many, many)
    rows = np.repeat(np.searchsorted(at[1:], begin, "right"), many)
    left = np.minimum(np.repeat(end, many) - starts, shape.high)
    wide = np.concatenate((code, np.zeros(shape.high, dtype=np.uint8))).astype(np.uint64)
    found, k = wide, 1
    while 2 * k <= shape.high:
        found, k = (found[:-k] << np.uint64(BITS * k)) | found[k:], 2 * k
    found = found[starts]
    for j in range(k, shape.high):
        found = (found << np.uint64(BITS)) | wide[starts + j]
    held = np.array([(1 << (BITS * shape.high)) - (1 << (BITS * (shape.high - x))) for x in range(shape.high + 1)], dtype=np.uint64)
    return rows, found & held[left]


def once(rows: np.ndarray, found: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Rows and entries: codes with the first length that each counts for, so that each window counts once a row. In the order of a
    row's codes one counts for the lengths in which it differs from the code before."""
    shift = np.uint64(BITS * shape.high)
    both = np.sort((rows.astype(np.uint64) << shift) | found) if BITS * shape.high < 64 else np.sort(found)
    differs = both[1:] ^ both[:-1]
    first = np.zeros(len(both), dtype=np.uint64)
    for k in shape.lengths:
        first[1:] += shape.prefix(differs, k) == 0
    on = first < len(shape.lengths)
    both, first = both[on], first[on]
    return (both >> shift).astype(np.int64), ((both & ((np.uint64(1) << shift) - np.uint64(1))) << np.uint64(shape.extra)) | first


def entries(batch: pa.RecordBatch, shape: Shape, text: bool, distinct: bool, most: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For parts of about `most` bytes of a batch, whose last column has the sequences: the part's first row, rows from there, entries."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.columns[-1]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < batch.num_rows:
        before = upto[low - 1] if low else 0
        high = min(max(int(np.searchsorted(upto, before + most, "right")), low + 1), low + shape.rows, batch.num_rows)
        rows, found = codes(batch.columns[-1].slice(low, high - low), shape, text)
        yield low, *(once(rows, found, shape) if distinct else (rows, found << np.uint64(shape.extra)))
        low = high


def heads(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate((np.ones(min(len(values), 1), dtype=bool), values[1:] != values[:-1])))


_FOUR = np.stack([_LETTER[(np.arange(1 << 20) >> (BITS * (3 - j))) & 31] for j in range(4)], axis=1).view(np.uint32).ravel()


def strings(found: np.ndarray, k: int) -> pa.Array:
    """Windows from their codes of k residues, by four residues at once."""
    found = found << np.uint64(BITS * (CODED - k))
    out = np.empty((len(found), 3), dtype=np.uint32)
    for j in range(3):
        out[:, j] = _FOUR.take((found >> np.uint64(BITS * 4 * (2 - j))) & np.uint64((1 << 20) - 1))
    letters = np.ascontiguousarray(out.view(np.uint8)[:, :k])
    return pa.StringArray.from_buffers(len(found), pa.py_buffer(np.arange(0, (len(found) + 1) * k, k, dtype=np.int32)), pa.py_buffer(letters))


def _packed(columns: list[np.ndarray]) -> bytes:
    """Whole numbers byte by byte: the high bytes of small ones are equal."""
    raw = b"".join(np.ascontiguousarray(c.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _unpacked(data: bytes, n: int, columns: int) -> np.ndarray:
    raw = pa.Codec("zstd").decompress(data, decompressed_size=8 * n * columns, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(columns, 8, n).transpose(0, 2, 1)).view(np.int64).reshape(columns, n)


_SENT = StructType().add("side", IntegerType()).add("bucket", IntegerType()).add("n", IntegerType()).add("data", BinaryType())


def _sender(shape: Shape, text: bool, distinct: bool, ends: bool, buckets: int, side: int, held: int = HELD) -> Callable:
    """A row for each bucket that a task's next `held` entries reach: its entries in order, how often each is there and, with ends, the
    first and the last key of its rows."""

    def sent(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        bucket = shape.bucket(columns[0] >> np.uint64(shape.extra), buckets)
        order = np.argsort(bucket, kind="stable")
        edges = np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=buckets))))
        for i, c in enumerate(columns):
            columns[i] = c[order]
        del bucket, order, c
        out = []
        for b in np.flatnonzero(np.diff(edges)):
            of, *key = (c[edges[b] : edges[b + 1]] for c in columns)
            if ends:
                by = np.argsort(of)
                of = of[by]
                at = heads(of)
                low, high = np.minimum.reduceat(key[0][by], at), np.maximum.reduceat(key[-1][by], at)
                more = [low, high - low]
            else:
                of, more = np.sort(of), []
                at = heads(of)
            out.append((side, int(b), len(at), _packed([np.diff(of[at].view(np.int64), prepend=0), np.diff(at, append=len(of)) - 1, *more])))
            if len(out) == 64 or edges[b + 1] == edges[-1]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=_SENT.names)
                out = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n, none = ([], [], []), 0, False  # places, and their rows' keys, twice where some are null

        def columns() -> list[np.ndarray]:
            return [np.concatenate([kept[i].pop(0) for _ in range(len(kept[i]))]) for i in range(1 + ends + (ends and none))]

        for batch in batches:
            for low, rows, found in entries(batch, shape, text, distinct):
                if not len(found):
                    continue
                kept[0].append(found)
                n += len(found)
                if ends:
                    key = batch.columns[0].slice(low, int(rows[-1]) + 1).cast(pa.int64())
                    if key.null_count and not none:
                        kept[2].extend(kept[1])
                        none = True
                    kept[1].append(key.fill_null(_FIRST).to_numpy(zero_copy_only=False)[rows])
                    if none:
                        kept[2].append(key.fill_null(_LAST).to_numpy(zero_copy_only=False)[rows])
                if n >= held:
                    yield from sent(columns())
                    kept, n, none = ([], [], []), 0, False
        if n:
            yield from sent(columns())

    return run


def _meeting(shape: Shape, ends: bool, names: tuple[str, ...], without: bool) -> Callable:
    """The windows of a bucket's entries, longest first: how many rows of the first side have each, with ends their first and last key,
    and how often it is on the other side; without: only windows that the other side lacks."""

    def run(table: pa.Table) -> pa.Table:
        sizes, sides = table["n"].to_pylist(), table["side"].to_numpy()
        columns = 4 if ends else 2
        parts = [_unpacked(d, n, columns if side == 0 else 2) for d, n, side in zip(table["data"].to_pylist(), sizes, sides, strict=True)]
        found = np.concatenate([np.cumsum(p[0]).view(np.uint64) for p in parts])
        many = np.concatenate([p[1] + 1 for p in parts])
        own = np.repeat(sides == 0, sizes)
        order = np.argsort(found, kind="stable")
        found, many, own = found[order], many[order], own[order]
        if ends:
            none = [(np.full(n, _FIRST), np.full(n, _LAST)) if side else (p[2], p[2] + p[3]) for p, n, side in zip(parts, sizes, sides, strict=True)]
            first, last = (np.concatenate([x[i] for x in none])[order] for i in (0, 1))
        del parts
        place, since = found >> np.uint64(shape.extra), found & np.uint64((1 << shape.extra) - 1)
        out = []
        for j in reversed(range(len(shape.lengths))):
            k = shape.lengths[j]
            window = shape.prefix(place, k)
            on = np.flatnonzero((window & np.uint64((1 << BITS) - 1)) > 0)
            window = window[on]
            at = heads(window)
            if not len(at):
                continue
            count = np.where(since[on] <= j, many[on], 0)
            n = np.add.reduceat(np.where(own[on], count, 0), at)
            other = np.add.reduceat(np.where(own[on], 0, count), at) if (sides > 0).any() else np.zeros(len(at), dtype=np.int64)
            here = (n > 0) & (other == 0) if without else n > 0
            values = {"n": n[here], "count": other[here]}
            if ends:
                low, high = np.minimum.reduceat(first[on], at)[here], np.maximum.reduceat(last[on], at)[here]
                values |= {"first": pa.array(low, mask=low > high), "last": pa.array(high, mask=low > high)}
            columns = {"peptide": strings(window[at][here], k)} | {c: pa.array(values[c]) for c in names}
            out += pa.table(columns).to_batches(max_chunksize=1 << 16)
        return pa.Table.from_batches(out, schema=pa.schema([("peptide", pa.string()), *((c, pa.int64()) for c in names)]))

    return run


def scanned(of: DataFrame) -> list[int]:
    """Bytes of seq in each of a table's partitions that has any."""
    return [r["n"] for r in of.groupBy(F.spark_partition_id().alias("at")).agg(F.sum(F.octet_length("seq")).alias("n")).filter("n > 0").collect()]


def dealt(of: DataFrame, sizes: list[int], tasks: int, least: int = 1 << 23) -> DataFrame:
    """Rows dealt to so many tasks where their partitions, of these sizes, are few or uneven; else their texts aren't shuffled."""
    largest, cores = max(sizes, default=0), of.sparkSession.sparkContext.defaultParallelism
    even = len(sizes) >= 2 * cores and largest * len(sizes) <= 2 * sum(sizes)
    return of if even or largest <= max(2 * sum(sizes) // tasks, least) else of.repartition(tasks)


def _smallest(shape: Shape, text: bool, want: dict[int, int], after: str, held: int = HELD) -> Callable:
    """Of a task's different windows of each length, as many as wanted: the first by md5 of the window and what comes after it, and those
    whose hash has the same first 8 bytes as the last of these."""
    end = (after.encode() + b"\x80").ljust(32, b"\0")

    def words(found: np.ndarray, k: int) -> list:
        padded = (b"\0" * k + end)[: -(-(k + len(after.encode()) + 1) // 4) * 4]
        fixed = np.frombuffer(padded, dtype="<u4").tolist()
        found = found << np.uint64(BITS * (CODED - k))
        own = [_FOUR.take((found >> np.uint64(BITS * 4 * (2 - j))) & np.uint64((1 << 20) - 1)) | np.uint32(fixed[j]) for j in range(-(-k // 4))]
        return own + fixed[len(own) :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {k: (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)) for k in want}  # hashes in order, and codes

        def add(found: np.ndarray) -> None:
            found = np.sort(found)
            for k, n in want.items():
                window = shape.prefix(found, k)
                window = window[(window & np.uint64((1 << BITS) - 1)) > 0]
                window = window[heads(window)]
                for low in range(0, len(window), PORTION):
                    part, (hashes, had) = window[low : low + PORTION], best[k]
                    of = md5_first(words(part, k), k + len(after.encode()))
                    on = of <= hashes[n - 1] if len(hashes) >= n else np.ones(len(of), dtype=bool)
                    if on.any():
                        hashes, had = np.concatenate((hashes, of[on])), np.concatenate((had, part[on]))
                        order = np.lexsort((had, hashes))
                        order = order[heads(had[order])]
                        hashes, had = hashes[order], had[order]
                        upto = int(np.searchsorted(hashes, hashes[n - 1], "right")) if len(hashes) > n else len(hashes)
                        best[k] = (hashes[:upto], had[:upto])

        kept, n = [], 0
        for batch in batches:
            for _, _, found in entries(batch, shape, text, False):
                kept.append(found >> np.uint64(shape.extra))
                n += len(found)
                if n >= held:
                    add(np.concatenate(kept))
                    kept, n = [], 0
        if n:
            add(np.concatenate(kept))
        for k, (_, had) in best.items():
            yield pa.RecordBatch.from_arrays([strings(had, k)], names=["peptide"])

    return run


def smallest(proteins: DataFrame, want: dict[int, int], after: str, text: bool = False) -> DataFrame:
    """peptide: of all windows of proteins (seq), at least the wanted number of each length, or all there are: those that come first by md5 of
    the window and `after`. A task returns its own first ones, so a window may be there more than once."""
    tasks = int(proteins.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of = proteins.select("seq")
    return dealt(of, scanned(of), tasks).mapInArrow(_smallest(Shape(want), text, want, after), StructType().add("peptide", StringType()))


def in_buckets(sides: list[DataFrame], shape: Shape, text: bool, per_row: bool = False, ends: bool = False, each: int = BUCKET, least: int = 8) -> DataFrame:
    """The places of one or two tables (seq, with ends transcript too in the first) in rows by bucket: a bucket for about `each` bytes of
    sequences, `least` a task at least where tables aren't small."""
    tasks = int(sides[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = [s.select(*(["transcript"] if ends and not i else []), "seq") for i, s in enumerate(sides)]
    sizes = [scanned(s) for s in sides]
    size = sum(map(sum, sizes))
    buckets = min(max(-(-size // each), min(least * tasks, size // 65536)) + 1, 1 << 16)
    sent = [dealt(s, x, tasks).mapInArrow(_sender(shape, text, distinct=per_row and not i, ends=ends and not i, buckets=buckets, side=i), _SENT) for i, (s, x) in enumerate(zip(sides, sizes, strict=True))]
    return (sent[0].union(sent[1]) if len(sent) > 1 else sent[0]).repartition(tasks, "bucket")


def different(table: pa.Table, shape: Shape) -> Iterator[tuple[int, np.ndarray]]:
    """Each length and its different windows, as codes, of a bucket of one table without ends."""
    parts = [_unpacked(d, n, 2)[0] for d, n in zip(table["data"].to_pylist(), table["n"].to_pylist(), strict=True)]
    place = np.sort(np.concatenate([np.cumsum(p).view(np.uint64) >> np.uint64(shape.extra) for p in parts]))
    for k in shape.lengths:
        window = shape.prefix(place, k)
        window = window[(window & np.uint64((1 << BITS) - 1)) > 0]
        yield k, window[heads(window)]


def met(left: DataFrame, right: DataFrame | None = None, lengths=(8, 9, 10, 11), names: tuple[str, ...] = (), without: bool = False, text: bool = False, per_row: bool = True) -> DataFrame:
    """peptide and the named columns for each different window of left's rows (seq): n, how many rows have it, first and last, the least and
    largest transcript (whole numbers) of these rows, and count, how often it is in right (seq), overlaps and rows counted. With without, only windows that right
    doesn't have; with text, seq is a text whose letters count. Lengths must fit Shape. Without per_row, n counts repeats within a row too, which is cheaper."""
    shape, ends = Shape(lengths), "first" in names or "last" in names
    rows = in_buckets([left] if right is None else [left, right], shape, text, per_row, ends)
    schema = StructType().add("peptide", StringType())
    for c in names:
        schema = schema.add(c, LongType())
    return rows.groupBy("bucket").applyInArrow(_meeting(shape, ends, names, without), schema)
