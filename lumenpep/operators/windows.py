"""Windows of sequences, cut in Arrow batches: a sequence is read once for all lengths, in time proportional to its letters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructType

from ..functions.alleles import RESIDUES

#: Bits of a residue in a window's code, and the most residues that a code holds.
BITS, CODED = 5, 12
_LETTER = np.frombuffer(b"\0" + RESIDUES.encode() + b"\0" * (31 - len(RESIDUES)), dtype=np.uint8)
_CODE = np.zeros(256, dtype=np.uint8)
_CODE[_LETTER[1 : len(RESIDUES) + 1]] = np.arange(1, len(RESIDUES) + 1)


def cut(of: DataFrame, lengths, distinct: bool = True, standard: bool = True, marked: np.ndarray | None = None) -> DataFrame:
    """peptide and the other columns of `of`, which has seq, for each window of a row's seq; each once a row where distinct, only
    those of standard residues where standard; with a table of marks(), only those that may be marked. A null seq has none. Rows are dealt anew first, as windows are 40 times
    as many bytes."""
    carried = [f for f in of.schema.fields if f.name != "seq"]
    names = [f"`{f.name}`" for f in carried]
    dealt = of.select(*names, "seq").repartition(int(of.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.mapInArrow(_run(tuple(sorted({k for k in lengths if k > 0})), distinct, standard, np.packbits(marked) if marked is not None else None), StructType([*carried]).add("peptide", StringType()))


def _run(lengths: tuple[int, ...], distinct: bool, standard: bool, marked=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(marked).astype(bool) if marked is not None else None
        for batch in batches:
            for part in _slices(batch):
                carried = part.columns[:-1]
                names = [*part.schema.names[:-1], "peptide"]
                for rows, found in _windows(part.columns[-1], lengths, distinct, standard, table):
                    if len(rows):
                        yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows)) for c in carried), found], names=names)

    return run


def _slices(batch: pa.RecordBatch, most: int = 1 << 19, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Parts of about `most` bytes of the last column, a row at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.columns[-1]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < batch.num_rows:
        held = upto[low - 1] if low else 0
        high = min(max(int(np.searchsorted(upto, held + most, "right")), low + 1), low + rows, batch.num_rows)
        yield batch.slice(low, high - low)
        low = high


def _windows(texts: pa.Array, lengths: tuple[int, ...], distinct: bool, standard: bool, table: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """For each length, rows and windows."""
    texts = pa.array(pc.fill_null(texts, "").cast(pa.large_binary()))
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    letters = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[at[0] : at[-1]]
    size = np.diff(at)
    if not len(letters):
        return
    if not standard and letters.max() > 127:
        yield from _by_characters(texts, lengths, distinct)
        return
    row = np.repeat(np.arange(len(size), dtype=np.int64), size)
    place = np.arange(len(letters), dtype=np.int64)
    end = np.repeat(at[1:] - at[0], size)
    code = _CODE[letters]
    if standard:  # a window ends before the next letter that is no residue
        other = np.where(code == 0, place, len(letters))
        end = np.minimum(end, np.minimum.accumulate(other[::-1])[::-1])
    left = end - place
    coded = code.astype(np.uint64)
    rolled, k = coded, 1  # codes of the k letters from each place on
    for length in lengths:
        starts = np.flatnonzero(left >= length)
        rows = row[starts]
        if standard and length <= CODED:
            while k < length:
                rolled, k = (rolled[:-1] << np.uint64(BITS)) | coded[k:], k + 1
            found = rolled[starts]
            if table is not None:
                may = table[_places(found, len(table))]
                rows, found = rows[may], found[may]
            if distinct:
                rows, found = _once(rows, found, len(size), BITS * length)
            yield rows, _strings(np.stack([_LETTER[(found >> np.uint64(BITS * (length - 1 - j))) & np.uint64(31)] for j in range(length)], axis=1))
            continue
        if not len(starts):
            continue
        found = np.lib.stride_tricks.sliding_window_view(letters, length)[starts]
        if distinct:
            first = [low + np.sort(np.unique(found[low:high].view(f"S{length}").ravel(), return_index=True)[1]) for low, high in _runs(rows)]
            keep = np.concatenate(first)
            rows, found = rows[keep], found[keep]
        yield rows, _strings(found)


def _once(rows: np.ndarray, codes: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Different codes of each of n rows: sorted as one number with their row where both fit one."""
    if bits + int(n - 1).bit_length() <= 64:
        shift = np.uint64(bits % 64)
        both = _different((rows.astype(np.uint64) << shift) | codes if n > 1 else codes)
        return ((both >> shift).astype(np.int64), both & np.uint64((1 << bits) - 1)) if n > 1 else (np.zeros(len(both), dtype=np.int64), both)
    parts = [(rows[low], _different(codes[low:high])) for low, high in _runs(rows)]
    return np.repeat(np.array([r for r, _ in parts], dtype=np.int64), [len(c) for _, c in parts]), np.concatenate([c for _, c in parts] or [codes])


def _different(codes: np.ndarray) -> np.ndarray:
    """np.unique() by sorting, which is many times as fast as its table of hashes."""
    codes = np.sort(codes)
    return codes[np.concatenate((np.ones(min(len(codes), 1), dtype=bool), codes[1:] != codes[:-1]))]


def _runs(rows: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal numbers begin and end."""
    edges = np.flatnonzero(np.diff(rows)) + 1
    return list(zip([0, *edges], [*edges, len(rows)], strict=True)) if len(rows) else []


def _strings(letters: np.ndarray) -> pa.Array:
    n, k = letters.shape
    offsets = np.arange(0, (n + 1) * k, k, dtype=np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters)))


def _by_characters(texts: pa.Array, lengths: tuple[int, ...], distinct: bool) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Windows of texts whose characters differ in bytes."""
    for length in lengths:
        for i, text in enumerate(texts.cast(pa.large_string()).to_pylist()):
            found = [text[j : j + length] for j in range(len(text) - length + 1)]
            found = list(dict.fromkeys(found)) if distinct else found
            yield np.full(len(found), i, dtype=np.int64), pa.array(found, pa.string())


def _places(codes: np.ndarray, size: int) -> np.ndarray:
    """Places of codes in a table whose size is a power of two."""
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)


def marks(peptides: list[str]) -> np.ndarray | None:
    """A table of at most 2**22 places (512 KB as it goes with a task), in which those of the peptides' codes are marked; None where a peptide has no code. A window
    whose place isn't marked is none of the peptides."""
    if any(not 0 < len(p) <= CODED for p in peptides):
        return None
    table = np.zeros(1 << min(22, max(16, (16 * len(peptides)).bit_length())), dtype=bool)
    for k in {len(p) for p in peptides}:
        letters = _CODE[np.frombuffer("".join(p for p in peptides if len(p) == k).encode("ascii"), dtype=np.uint8)].reshape(-1, k).astype(np.uint64)
        codes = np.zeros(len(letters), dtype=np.uint64)
        for j in range(k):
            codes = (codes << np.uint64(BITS)) | letters[:, j]
        table[_places(codes, len(table))] = True
    return table
