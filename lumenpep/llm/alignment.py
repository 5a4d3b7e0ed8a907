"""Two tokenizers' tokens of the same texts, cut into the smallest groups that cover the same bytes, and how their ids go together.

A text's B tokens are a static index of disjoint intervals of bytes. Each A token finds the first and last B token that it
overlaps by bisection, all of a text at once. A gap between two B tokens that no A token spans is a boundary of groups.

How often two ids are linked is counted over the whole corpus. Texts are worked on in chunks of bounded size, and a chunk's
different pairs of ids are listed once, with the number of its documents that hold them: these lists are counted, and the
counts come back to the chunk, so links themselves are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import only, released, small_batches, stage, values

_SPACE = "▁"
_ALIGNED = "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, places binary, times binary, pairs array<long>, docs array<long>"
_NAMES = [f.split()[0] for f in _ALIGNED.split(", ")]
_TYPES = [*[pa.int64()] * 6, pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]


class Strings:
    """Byte strings by number, and numbers' strings joined without a step for each."""

    def __init__(self, parts: list[bytes]):
        self.length = np.array([len(p) for p in parts], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def join(self, numbers: np.ndarray) -> np.ndarray:
        length = self.length[numbers]
        end = np.cumsum(length)
        return self.flat[np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[numbers] - end + length, length)]


class ByteLevel:
    """Tokenizer A: ids and bytes of a text with a space before it; strings of special tokens are plain text."""

    def __init__(self, path: str):
        self.encoder = tokens.Encoder(path)
        self.encoder.tokenizer.encode_special_tokens = True
        raw = {chr(tokens._SHOWN.get(b, b)): b for b in range(256)}
        shown = (self.encoder.tokenizer.id_to_token(i) for i in range(self.encoder.vocabulary))
        self.bytes = Strings([bytes(raw[c] for c in t) if t and all(c in raw for c in t) else (t or "").encode("utf-8") for t in shown])

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(next(iter(self.encoder.encode([" " + text]))), dtype="<u4").astype(np.int64)


class Pieces:
    """Tokenizer B: ids and bytes of a text; the model puts a space before it. Where no piece has a space after another
    character, merges never pass from a word to the spaces before the next one, and a long text is encoded in parts that begin
    with such spaces. Any other model encodes texts whole."""

    def __init__(self, path: str, part: int = 100_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        parts = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(_SPACE, " ").encode("utf-8") for i, n in enumerate(names)]
        self.bytes = Strings(parts)
        self.cut = re.compile(r"(?<! ) +(?=[^ ])").search if not any(re.search(f"[^{_SPACE}]{_SPACE}", n) for n in names) and parts[self.model.encode("a")[0]][:1] == b" " else None
        self.part = part

    def encode(self, text: str) -> np.ndarray:
        out, low = [], 0
        # a literal space sign is a space to the model, so words would begin elsewhere
        while self.cut and len(text) - low > self.part and _SPACE not in text and (at := self.cut(text, low + self.part)):
            out += self.model.encode(text[low : at.start()])
            low = at.start() + 1  # the model puts the space back
        return np.array(out + self.model.encode(text[low:]), dtype=np.int64)


_kept: dict[tuple[str, str], tuple] = {}


def tokenizers(a: str, b: str) -> tuple:
    """Both tokenizers, and the ids as text with what follows them; one a worker process."""
    if (a, b) not in _kept:
        one, two = ByteLevel(a), Pieces(b)
        _kept[a, b] = one, two, Strings([f"{i}{end}".encode() for t, ends in ((one, ",|"), (two, ",;")) for end in ends for i in range(len(t.bytes.length))])
    return _kept[a, b]


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place in B of the tokens that each A token overlaps. Both sides cover the same bytes without gaps."""
    starts_a = np.concatenate(([0], ends_a[:-1]))
    return np.searchsorted(ends_b, starts_a, side="right"), np.searchsorted(ends_b, ends_a, side="left")


def grouped(first: np.ndarray, last: np.ndarray, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and of each B token, numbered from 0: gap i, between B tokens i and i + 1, is spanned by A tokens
    whose range holds both."""
    spans = np.zeros(n_b + 1, dtype=np.int64)
    np.add.at(spans, first, 1)
    np.add.at(spans, last, -1)
    of_b = np.concatenate(([0], np.cumsum(np.cumsum(spans)[: n_b - 1] == 0)))
    return of_b[first], of_b


def _written(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, sizes: tuple[int, int], texts: Strings) -> str:
    """`a1,a2|b1;a3|b2,b3`: the groups' ids in order."""
    n = int(of_b[-1]) + 1
    per_a, per_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
    code = np.empty(len(a) + len(b), dtype=np.int64)
    code[np.arange(len(a)) + (np.cumsum(per_b) - per_b)[of_a]] = a + sizes[0] * np.append(of_a[1:] != of_a[:-1], True)
    code[np.arange(len(b)) + np.cumsum(per_a)[of_b]] = b + 2 * sizes[0] + sizes[1] * np.append(of_b[1:] != of_b[:-1], True)
    return texts.join(code).tobytes()[:-1].decode("ascii")


def _align(path_a: str, path_b: str, most: int):
    """Rows of _ALIGNED from (doc_id, text): one for each document with the places of its pairs in the chunk's list and how
    often each is linked, and after a chunk's documents one with that list. A chunk ends with the document that brings it
    over `most` characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        one, two, texts = tokenizers(path_a, path_b)
        length_a, length_b = one.bytes.length, two.bytes.length
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0

        def links(text: str | None):
            """n_a, n_b, n_groups, n_links, groups, pairs, times."""
            nothing = 0, 0, 0, 0, "", np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            if not text:
                return nothing
            a, b, whole = one.encode(text), two.encode(text), np.frombuffer(b" " + text.encode("utf-8"), dtype=np.uint8)
            ends_a, ends_b = np.cumsum(length_a[a]), np.cumsum(length_b[b])
            same = len(a) and len(b) and ends_a[-1] == ends_b[-1] == len(whole)
            if not same or any((t.bytes.join(ids) != whole).any() for t, ids in ((one, a), (two, b))):
                return nothing
            first, last = overlaps(ends_a, ends_b)
            of_a, of_b = grouped(first, last, len(b))
            many = last - first + 1
            at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
            pairs, times = np.unique(np.repeat(a, many) * len(length_b) + b[at], return_counts=True)
            return len(a), len(b), int(of_b[-1]) + 1, len(at), _written(a, b, of_a, of_b, (len(length_a), len(length_b)), texts), pairs, times

        def flush() -> Iterator[pa.RecordBatch]:
            pairs, docs = np.unique(np.concatenate([r[6] for r in held]), return_counts=True)
            for low in range(0, len(held), 500):
                rows = [(chunk, *r[:6], np.searchsorted(pairs, r[6]).astype("<i4").tobytes(), r[7].astype("<i4").tobytes(), None, None) for r in held[low : low + 500]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([[chunk], *[[None]] * 8, [pairs], [docs]], _TYPES, strict=True)], names=_NAMES)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), values(batch, 1), strict=True):
                held.append((doc, *links(text)))
                size += len(text or "")
                if size > most:
                    yield from flush()
                    chunk, held, size = chunk + 1, [], 0
        if held:
            yield from flush()

    return run


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"


def _answer(docs: pa.Table, found: pa.Table) -> pa.Table:
    """A chunk's documents with sums over their links; found has the chunk's pairs with count and best."""
    order = np.argsort(found.column("pair").to_numpy())
    count, best = (found.column(c).to_numpy()[order] for c in ("count", "best"))
    sums = ([], [])
    for places, times in zip(docs.column("places"), docs.column("times"), strict=True):
        at, n = (np.frombuffer(x.as_py(), dtype="<i4") for x in (places, times))
        for out, of in zip(sums, (best, count), strict=True):
            out.append(int((of[at].astype(np.int64) * n).sum()) if len(at) else 0)
    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"])
    return kept.append_column("n_best", pa.array(sums[0], pa.int64())).append_column("count_sum", pa.array(sums[1], pa.int64()))


def counted(aligned: DataFrame) -> DataFrame:
    """pair, count, best: in how many documents a pair of ids is linked, and whether no pair of its A id has more."""
    per = aligned.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("count"))
    return stage(per, "pairs")


def align(docs: DataFrame, a: str | None = None, b: str | None = None, groups: Callable[[Column], Column] = lambda g: g, most: int = 4_000_000) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum for documents (doc_id, text).

    a is a byte-level file of the tokenizers library, which encodes a space and the text; b a model of sentencepiece, which puts a
    space there itself. groups is the alignment as `a1,a2|b1;a3|b2,b3`, or what the function of that column makes of it. A
    link is an A and a B token that share bytes; a pair's count is in how many documents it is linked; n_best are the links
    whose pair has the highest count of its A id, ties included; count_sum adds the counts of all links.

    Null and empty texts, and those that either tokenizer doesn't give back byte by byte, have no tokens: 0 and ''. Texts of
    any length are encoded whole; equal or null ids are documents of their own. An empty table gives no rows. Other
    columns, whatever their names, are ignored. Chunks hold about `most` characters, or one longer text.
    """
    small_batches(docs.sparkSession)
    path_a, path_b = a or tokens.public("byte_bpe_50k.json"), b or tokens.public("piece_bpe_32k.model")
    of = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(released(_align(path_a, path_b, most)), _ALIGNED)
    rows = stage(of.withColumn("groups", groups(F.col("groups"))), "aligned")
    counts = counted(rows)
    # one row for each of A's ids, so bounded by its vocabulary
    top = counts.groupBy(_of_a(path_b).alias("a")).agg(F.max("count").alias("top"))
    counts = counts.join(F.broadcast(top), _of_a(path_b) == F.col("a")).select("pair", "count", (F.col("count") == F.col("top")).cast("long").alias("best"))
    asked = rows.filter("pairs IS NOT NULL").select(F.col("chunk").alias("of"), F.explode("pairs").alias("pair"))
    found = asked.join(counts, "pair").select("of", "pair", "count", "best")
    return rows.filter("pairs IS NULL").groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(_answer, _RESULT)


def _of_a(path_b: str) -> Column:
    import sentencepiece

    return F.floor(F.col("pair") / sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size())
