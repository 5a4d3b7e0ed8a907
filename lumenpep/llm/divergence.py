"""How far the sources of a language differ in their words: every source against every other, and against the language.

Terms are counted in tasks and their sums in one shuffle. A language's kept terms are cut into slabs by hash and numbered within
each, so a group (a source of a language) has one short vector of counts a slab, compressed. Groups are dealt into blocks.
Each block of a slab is resident in one task; the vectors of the other blocks come past it, one at a time, in the order of the
rounds of a round-robin tournament (circle method). Each two blocks meet once, in the task of one of them, which works out both
directions. So a task holds one block and one vector, whatever the number of groups. A task's heaps keep the ten
terms of a group that stand out most in a slab, and the slabs' tens meet in the end.

Numbers are whole throughout: p = 1 + floor(SCALE * (count + 2) / (sum + 2 * terms)), f = floor((p - q)^2 / (p + q)).
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import only, partitions, released, slices, small_batches, stage

SCALE = 1_000_000_000
#: A byte of a term as it counts (A to Z in lower case, letters and all beyond ASCII as they are), any other one as a blank.
_SHOWN = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Texts beyond this many bytes are cut at blanks and counted part by part.
_PART = 4 << 20

COUNTS = "lang string, source string, term string, n long, docs long"
VECTORS = "lang string, slab long, source string, data binary, top array<struct<value: long, term: string>>"
MET = "lang string, source string, item string, value long"


def _parts(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, whole lists for parts of bounded size."""
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= _PART else data.find(b" ", at + _PART)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _count(most: int):
    """Rows of COUNTS from (lang, source, text): terms of a task's documents, summed until there are `most` of them; a group
    shows itself by a row with a null term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in held.items():
                terms = [None, *(t.decode("utf-8") for t in n)]
                sums = [0, *n.values()], [0, *(docs[t] for t in n)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.string()), *(pa.array(s, pa.int64()) for s in sums)], names=["lang", "source", "term", "n", "docs"])
            held.clear()

        size = 0
        for batch in batches:
            for part in slices(batch, 2):
                raw = part.column(2).cast(pa.binary()).to_pylist()
                for lang, source, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), raw, strict=True):
                    n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                    size -= len(n)
                    own: set[bytes] = set()
                    for terms in _parts(data.translate(_SHOWN)):
                        n.update(terms)
                        own.update(terms)
                    docs.update(own)
                    size += len(n)
                    if size > most:
                        yield from flush()
                        size = 0
        yield from flush()

    return run


def share(count: np.ndarray | int, total: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), digit by digit in thousands, as the product may pass 64 bits."""
    by = total + 2 * terms
    whole, rest = np.divmod(np.asarray(count, dtype=np.int64) + 2, by)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, by)
        whole = whole * 1000 + more
    return whole + 1


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def packed(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending ids and their counts, compressed: gaps as 32-bit numbers, counts as 64-bit ones, each byte plane apart."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() for a in (np.diff(ids, prepend=0).astype("<u4"), counts.astype("<i8"))]
    return zlib.compress(b"".join(planes), 1)


def unpacked(data: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(data), dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    n = len(raw) // 12
    gaps, counts = np.ascontiguousarray(raw[: 4 * n].reshape(4, n).T).view("<u4"), np.ascontiguousarray(raw[4 * n :].reshape(8, n).T).view("<i8")
    return np.cumsum(gaps.reshape(n), dtype=np.int64), counts.reshape(n)


def _vector(tops: int):
    """One row of VECTORS from a group's kept terms in a slab (term, id, n, of_lang, and the totals)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        ids, n, of = (table.column(c).to_numpy() for c in ("id", "n", "of_lang"))
        total, by_lang, terms = (table.column(c)[0].as_py() for c in ("total", "lang_total", "terms"))
        p, q = share(n, total, terms), share(of, by_lang, terms)
        f, high = _f(p, q), np.flatnonzero(p > q)
        if len(high) > tops:  # all that reach the least value of the first ones, so ties are settled by their terms below
            high = high[f[high] >= np.partition(f[high], -tops)[-tops]]
        names = table.column("term")
        best = heapq.nsmallest(tops, ((-int(f[i]), names[int(i)].as_py().encode("utf-8")) for i in high))
        top = [{"value": -v, "term": t.decode("utf-8")} for v, t in best]
        key = [table.column(c)[0].as_py() for c in ("lang", "slab", "source")]
        return pa.table({"lang": [key[0]], "slab": pa.array([key[1]], pa.int64()), "source": [key[2]], "data": pa.array([packed(ids, n)], pa.binary()), "top": pa.array([top], pa.list_(pa.struct([("value", pa.int64()), ("term", pa.string())])))})

    return run


class _Group:
    """A vector in use: where it has terms, and its shares there and elsewhere."""

    def __init__(self, source: str, data: bytes | None, total: int, terms: int):
        self.source = source
        self.ids, counts = unpacked(data)
        self.at, self.off = (share(counts, total, terms), int(share(0, total, terms))) if terms else (counts, 0)

    def spread(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Shares of all ids, and which of them have the term."""
        all_, has = np.full(width, self.off, dtype=np.int64), np.zeros(width, dtype=bool)
        all_[self.ids], has[self.ids] = self.at, True
        return all_, has


def between(a: _Group, all_: np.ndarray, has: np.ndarray, b: _Group, width: int) -> int:
    """The sum of f over a slab's terms. a is spread out; b only has its own terms looked up: terms of b, then those of a that b
    lacks, then those of neither."""
    if not width:
        return 0
    both = b.ids[has[b.ids]]
    out = int(_f(all_[b.ids], b.at).sum()) + int(_f(a.at, np.int64(b.off)).sum()) - int(_f(all_[both], np.int64(b.off)).sum())
    return out + (width - len(a.ids) - len(b.ids) + len(both)) * int(_f(np.int64(a.off), np.int64(b.off)))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of MET. Rows come ordered by (lang, slab, host, round): round 0 are the residents, which meet each other as they
    come; all later ones are guests, which meet every resident and are gone."""
    now, home = None, []
    for batch in batches:
        rows = []
        for r in (x for low in range(0, batch.num_rows, 64) for x in batch.slice(low, 64).to_pylist()):
            key = (r["lang"], r["slab"], r["host"])
            if key != now:
                now, home = key, []
            one = _Group(r["source"], r["data"], r["total"], r["terms"])
            for other, all_, has in home:
                value = between(other, all_, has, one, r["width"])
                rows += [(r["lang"], other.source, one.source, value), (r["lang"], one.source, other.source, value)]
            if r["round"] == 0:
                home.append((one, *one.spread(r["width"])))
        if rows:
            lang, source, item, value = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64())], names=["lang", "source", "item", "value"])


def schedule(block: Column, blocks: Column) -> Column:
    """Where a block goes: an array of (host, round). It stays home in round 0 and visits about half of the others, in
    the round of the circle method in which the two meet. Of two blocks the one behind on the circle is the host; at equal
    distance, the smaller number."""
    half, even = F.floor((blocks - 1) / 2), blocks % 2 == 0
    steps = F.when(half > 0, F.sequence(F.lit(1).cast("long"), half)).otherwise(F.array().cast("array<bigint>"))
    steps = F.concat(steps, F.when(even & (block >= blocks / 2), F.array(F.floor(blocks / 2))).otherwise(F.array().cast("array<bigint>")))
    odd = F.when(even, blocks - 1).otherwise(blocks)  # the circle; of an even number the last block stands in its middle

    def visit(step: Column) -> Column:
        host = F.pmod(block - step, blocks)
        sum_ = F.when(even & (block == blocks - 1), 2 * host).when(even & (host == blocks - 1), 2 * block).otherwise(block + host)
        return F.struct(host.alias("host"), (F.pmod(sum_, F.greatest(odd, F.lit(1))) + 1).alias("round"))

    home = F.array(F.struct(block.alias("host"), F.lit(0).cast("long").alias("round")))
    return F.concat(home, F.transform(steps, visit))


def counted(docs: DataFrame, most: int = 500_000) -> DataFrame:
    """lang, source, term, n, docs: how often a term occurs in a group and in how many of its documents; a group's row with a
    null term has n 0. Written to the shared folder."""
    small_batches(docs.sparkSession)
    of = only(docs, "lang", "source", "text").select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    parts = of.mapInArrow(released(_count(most)), COUNTS)
    return stage(parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")


def _dealt(kept: DataFrame, langs: DataFrame) -> DataFrame:
    """kept (lang, term) with its language's row of langs. The terms of a language are dealt over as many parts as there are
    partitions, and its row goes to each, so a language that has most terms isn't one task's."""
    parts = partitions(kept.sparkSession)
    left = kept.withColumn("_part", F.pmod(F.xxhash64("term", F.lit(1)), F.lit(parts)))
    right = langs.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return left.join(right, ["lang", "_part"]).drop("_part")


def audit(docs: DataFrame, least: int = 10, tops: int = 10, slab: int = 250_000, block: int = 8) -> DataFrame:
    """lang, source, part, item, value, rank for documents (lang, source, text).

    Part `pair`: for each group the other sources of its language, value the sum of f over the language's kept terms,
    ranked by falling value and then item. Part `term`: the group's terms whose share is above the language's, value f, the
    first `tops`. A term is kept where at least `least` of the language's documents have it. A slab has about `slab` terms, a
    block `block` groups.

    Null text, lang and source count as empty; groups without terms take part with shares of 2 each; where a language
    keeps no term, its pairs have value 0. Texts of any length are counted whole; repeated documents count each; ties go by item.
    An empty table gives no rows. Other columns, whatever their names, are ignored.
    """
    counts = counted(docs)
    kept = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("of_lang")).filter(F.col("docs") >= least).drop("docs")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("of_lang").alias("lang_total"))
    cut = F.ceil(F.col("terms") / slab)
    slabs = _dealt(kept, langs).withColumn("slab", F.pmod(F.xxhash64("term"), cut))
    slabs = slabs.withColumn("id", F.row_number().over(Window.partitionBy("lang", "slab").orderBy("term")).cast("long") - 1)
    cells = stage(counts.filter("term IS NOT NULL").select("lang", "source", "term", "n").join(slabs, ["lang", "term"]), "cells")

    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    by = Window.partitionBy("lang")
    block_of = F.floor((F.row_number().over(by.orderBy("source")) - 1) / block)
    groups = stage(groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "terms", "lang_total")), block_of.alias("block"), F.ceil(F.count("*").over(by) / block).alias("blocks")), "groups")

    grid = groups.withColumn("slab", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(cut, F.lit(1)) - 1)))
    # by slab too, so the terms of a large group meet its total in many tasks
    vectors = cells.join(grid.select("lang", "slab", "source", "total"), ["lang", "slab", "source"]).groupBy("lang", "slab", "source").applyInArrow(_vector(tops), VECTORS)
    vectors = stage(vectors, "vectors")
    widths = cells.select("lang", "slab", "id").groupBy("lang", "slab").agg((F.max("id") + 1).alias("width"))
    grid = grid.join(widths, ["lang", "slab"], "left").join(vectors.drop("top"), ["lang", "slab", "source"], "left")
    grid = grid.select("lang", "slab", "source", "data", "total", "terms", F.coalesce("width", F.lit(0)).alias("width"), F.explode(schedule(F.col("block"), F.col("blocks"))).alias("to"))
    grid = grid.select("lang", "slab", "to.host", "to.round", "source", "data", "total", "terms", "width")
    tour = grid.repartition("lang", "slab", "host").sortWithinPartitions("lang", "slab", "host", "round", "source")
    pairs = tour.mapInArrow(released(_meet), MET).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = vectors.select("lang", "source", F.inline("top")).withColumnRenamed("term", "item")
    out = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.alias("rank")) for part, df in (("pair", pairs), ("term", best))]
    return out[0].union(out[1].filter(F.col("rank") <= tops))
