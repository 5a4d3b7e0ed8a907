"""N-gram Jaccard join: a prefix join over groups of documents.

Every set's shingles are put in one order for the whole corpus, rare ones first; two sets that are similar enough share a
shingle in their prefixes. Documents with equal sets are one node, and nodes with identical prefixes and size are one
group: the groups are joined, and group pairs expand to their members for verification. Rarity comes from a table of counts
of fixed size that tasks fill and Spark adds up; it decides only the order, never the result.

A shingle that very many groups share would make a pair of each two of them, though links within a component need not be
known one by one. So the join goes in rounds. Entries of short lists that fit no other by size and place go at once. In the first round each group of a shingle's list is compared with the list's pivot,
which costs as many pairs as the list has entries. Verified links give components, and lists whose entries lie in one
component are done. In some rounds more, up to 16 nodes of each component of the other lists, others in each list, are
compared with the most similar of the next few of their size. In the last, every pair from two components is compared in the task
where it meets, in blocks of bounded size, so the components are exact; a task returns only the links that join its components.

Texts are found again by `at`, a hash of a row's doc_id and text: rows without a doc_id are rows like all others.

Before the sets of a pair are read, their signatures are compared: a bit for each of about as many ranges of hashes as the set
has shingles, that tells whether an odd number fell there. Every bit that differs stands for a shingle that one set lacks, so
a pair with too many can't be similar; only the others' sets travel.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, discard, only, partitions, released, small_batches, stage, values
from .shingles import mix, shingle_sets

SETS = "doc_id long, at long, n long, node long, grp long, prefix binary, sig binary, mini binary"
ENTRIES = "token long, grp long, n int, pos int"
CROSSED = ("token", "low", "high", "node", "root", "n", "pos", "side", "mini")
#: So many of a node's first open lists tell whether a pair has met before.
FIRST = 16
#: Shingles of whole sets in a part of a list: 16 MB.
SHINGLES = 1 << 21


class Rule(NamedTuple):
    """Similarity of num/den or more over shingles of `size` words."""

    num: int = 80
    den: int = 100
    size: int = 5
    counters: int = 1 << 20

    def least(self, n):
        """Of a set of n, how many shingles any similar set shares."""
        return (self.num * n + self.den - 1) // self.den


def _sum_blocks(parts: DataFrame, blocks: int, kind: str) -> np.ndarray:
    """parts: block int, data binary. Adds up the arrays of each block, row by row, and gathers the blocks: as many bytes
    as a single task emitted, whatever the number of tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a = np.frombuffer(data, dtype=kind)
                total[block] = (total[block] | a if kind == "u1" else total[block] + a) if block in total else a
        if total:
            scaled = [v if kind == "u1" else np.minimum(255, 8 * np.log2(1.0 + v)).astype("u1") for v in total.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in scaled], pa.binary())], names=["block", "data"])

    found = {r["block"]: r["data"] for r in parts.repartitionById(blocks, F.col("block")).mapInArrow(run, "block int, data binary").collect()}
    size = len(next(iter(found.values()))) if found else 0
    return np.frombuffer(b"".join(found.get(b, bytes(size)) for b in range(blocks)), dtype="u1")


def rarity(docs: DataFrame, rule: Rule, blocks: int = 64) -> np.ndarray:
    """For each of `counters` ranges of shingle hashes, the number of sets with a shingle there, as a logarithm in a byte."""
    shift = np.uint64(64 - rule.counters.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(rule.counters, dtype="<i8")
        for batch in batches:
            for s in shingle_sets(values(batch, 0), rule.size):
                np.add.at(count, (s >> shift).astype(np.int64), 1)  # a set has a shingle once, but a range may have several
        if count.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(blocks), pa.int32()), pa.array([b.tobytes() for b in np.split(count.astype("<f4"), blocks)], pa.binary())], names=["block", "data"])

    return _sum_blocks(docs.select("text").mapInArrow(run, "block int, data binary"), blocks, "<f4")


def _node(s: np.ndarray) -> int:
    """A set's fingerprint."""
    return int(mix(mix(s ^ np.uint64(0xA0761D6478BD642F)).sum(keepdims=True) + np.uint64(len(s))).view(np.int64)[0])


def signature(s: np.ndarray) -> bytes:
    """Whether an odd number of the set's hashes ends in each pattern of bits; the number of patterns is the power of two
    above the set's size, 64 at least."""
    bits = 1 << max(6, len(s).bit_length())
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype("u1"), bitorder="little").tobytes()


def _mini(s: np.ndarray) -> bytes:
    """A signature of 256 bits, whatever the set's size: it goes with every entry of a list that is still open. Of very long
    sets it tells little, and their pairs are left to the whole signature."""
    return np.packbits((np.bincount((s & np.uint64(255)).astype(np.int64), minlength=256) & 1).astype("u1"), bitorder="little").tobytes()


def _differing(x: bytes, y: bytes) -> int:
    """How many bits of two signatures differ."""
    x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
    least = min(len(x), len(y))  # patterns of fewer bits: the parts of the longer signature add up
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, least), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _may_link(rule: Rule):
    """Pairs with sizes and signatures -> those whose sets can share enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            differ = np.array([_differing(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)], dtype=np.int64)
            yield batch.select([0, 1]).filter(pa.array((n - differ) * (rule.num + rule.den) >= 2 * n * rule.num))

    return run


def _prefixes(rule: Rule, rare: np.ndarray, seen_limit: int = 500_000):
    shift = np.uint64(64 - rule.counters.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # groups and nodes that this task has given a prefix or signature
        for batch in batches:
            rows = []
            for doc, at, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_sets(values(batch, 2), rule.size), strict=True):
                n = len(s)
                if not n:
                    rows.append((doc, at, 0, None, None, None, None, None))
                    continue
                order = np.lexsort((s, rare[(s >> shift).astype(np.int64)]))[: n - rule.least(n) + 1]
                prefix = s[order]
                group = int(mix((mix(prefix) * (2 * np.arange(len(prefix), dtype=np.uint64) + np.uint64(1))).sum(keepdims=True) + np.uint64(n)).view(np.int64)[0])
                if len(seen) > seen_limit:
                    seen.clear()
                node = _node(s)
                fresh = node not in seen
                rows.append((doc, at, n, node, group, None if group in seen else prefix.tobytes(), signature(s) if fresh else None, _mini(s) if fresh else None))
                seen.update((group, node))
            if rows:
                kinds = (*[pa.int64()] * 5, *[pa.binary()] * 3)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[f.split()[0] for f in SETS.split(", ")])

    return run


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """grp, n, prefix -> an entry for each shingle of the prefix."""
    for batch in batches:
        groups, sizes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        data = batch.column(2).to_pylist()
        for low in range(0, len(data), 500):
            part = data[low : low + 500]
            lengths = np.array([len(p) // 8 for p in part])
            token = np.frombuffer(b"".join(part), dtype="<i8")
            pos = np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(np.repeat(groups[low : low + 500], lengths)), pa.array(np.repeat(sizes[low : low + 500], lengths).astype(np.int32)), pa.array(pos.astype(np.int32))], names=[f.split()[0] for f in ENTRIES.split(", ")])


def _beside(rule: Rule, n: np.ndarray, pos: np.ndarray, end: np.ndarray, one: np.ndarray, reach: int | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """Of entries sorted by n in lists that end at `end`, the places of pairs of fitting sizes, and whether their own places let them
    share enough. All lists go together: each entry of `one` meets the next, then the one after, and so on while that is in the
    same list and of a fitting size, or up to the reach-th."""
    step = 0
    while len(one) and step != reach:
        step += 1
        one = one[one + step < end[one]]
        one = one[n[one] * rule.den >= n[one + step] * rule.num]
        two = one + step
        yield one, two, np.minimum(n[one] - pos[one], n[two] - pos[two]) * (rule.num + rule.den) >= (n[one] + n[two]) * rule.num


def _stars(rule: Rule, short: int = 64):
    """Entries sorted by token, n and grp, where a group's may repeat -> those of tokens that more than one group has, once
    each, with their list's pivot: the first group of the list that is large enough to be similar. Lists of at most `short` groups
    are seen whole, and entries there that sizes and places let be similar to no other stay behind: no round would link them."""
    names = ["token", "grp", "n", "pos", "pivot", "pivot_n", "pivot_pos"]

    def starred(columns: list[np.ndarray], pivot: tuple[int, ...] | None) -> tuple[pa.RecordBatch | None, tuple[int, ...] | None]:
        """pivot: of the first list, which goes on from entries given before; its first entry here is the last of these."""
        token, group, n, pos = columns[0], columns[1], columns[2].astype(np.int64), columns[3].astype(np.int64)
        first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        lengths = np.diff(np.append(first, len(token)))
        kept = np.repeat(lengths > short, lengths)
        if pivot:
            kept[: lengths[0]] = True
        for one, two, fit in _beside(rule, n, pos, np.repeat(first + lengths, lengths), np.flatnonzero(~kept)):
            kept[one[fit]] = kept[two[fit]] = True
        if pivot:
            kept[0] = False
        rows = np.flatnonzero(kept)
        out = np.zeros((3, len(rows)), dtype=np.int64)
        for k, (t, g, m, p) in enumerate(zip(token[rows].tolist(), group[rows].tolist(), n[rows].tolist(), pos[rows].tolist(), strict=True)):
            if pivot is None or pivot[0] != t or pivot[2] * rule.den < m * rule.num:
                pivot = (t, g, m, p)
            out[:, k] = pivot[1:]
        made = pa.RecordBatch.from_arrays([pa.array(c[rows]) for c in columns] + [pa.array(out[0]), pa.array(out[1].astype(np.int32)), pa.array(out[2].astype(np.int32))], names=names)
        return made if len(rows) else None, pivot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the last list while it is short, or the last entry given of a longer one
        pivot: tuple[int, ...] | None = None  # of that longer one
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held is not None:
                columns = [np.concatenate((h, c)) for h, c in zip(held, columns, strict=True)]
            once = np.ones(len(columns[0]), dtype=bool)
            once[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
            columns = [c[once] for c in columns]
            last = int(np.argmax(columns[0] == columns[0][-1]))  # where the last list begins
            more = len(columns[0]) - last > short or (pivot is not None and not last)
            now, held = ([c[:last] for c in columns], [c[last:] for c in columns]) if not more else (columns, [c[-1:] for c in columns])
            if len(now[0]):
                made, pivot = starred(now, pivot)
                if made:
                    yield made
            if not more:
                pivot = None
        if held is not None and pivot is None:
            made, _ = starred(held, None)
            if made:
                yield made

    return run


def _possible(a_n, a_pos, b_n, b_pos, rule: Rule):
    """Whether sets that share the entry as their first common shingle can share enough, and have fitting sizes."""
    most = F.least(a_n - a_pos, b_n - b_pos).cast("long")
    sizes = F.least(a_n, b_n).cast("long") * rule.den >= F.greatest(a_n, b_n).cast("long") * rule.num
    return sizes & (most * (rule.num + rule.den) >= (a_n.cast("long") + b_n) * rule.num)


def _bloom(ids: DataFrame, bits: int, blocks: int = 16) -> np.ndarray:
    """A bit table of hashes, filled by tasks. bits is at most 2**29 (64 MB); a fuller table only lets more rows pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(bits // 8, dtype="u1")
        for batch in batches:
            for at in _places(batch.column(0).to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(table, at >> 3, (1 << (at & 7)).astype("u1"))
        if table.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(blocks), pa.int32()), pa.array([b.tobytes() for b in np.split(table, blocks)], pa.binary())], names=["block", "data"])

    return _sum_blocks(ids.mapInArrow(run, "block int, data binary"), blocks, "u1")


def _places(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return [(h & np.uint64(bits - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)]


def _whole_sets(rule: Rule, table: np.ndarray, bits: int):
    """Rows (at, text) that the bit table has -> their sets, once a task for rows that repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            passed = np.ones(len(ids), dtype=bool)
            for at in _places(ids, bits):
                passed &= (table[at >> 3] >> (at & 7) & 1).astype(bool)
            for i in np.flatnonzero(passed).tolist():
                passed[i] = int(ids[i]) not in done
                done.add(int(ids[i]))
            if len(done) > 1_000_000:
                done.clear()
            some = batch.filter(pa.array(passed))
            sets = list(shingle_sets(values(some, 1), rule.size))
            if sets:
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([_node(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["at", "node", "shingles"])

    return run


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(i).to_pylist() for i in (2, 3))
        found = []
        for x, y in zip(a, b, strict=True):
            x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            found.append(int((y[at] == x).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64()), pa.array([len(x) // 8 for x in a], pa.int64()), pa.array([len(y) // 8 for y in b], pa.int64())], names=["a", "b", "both", "a_n", "b_n"])


class Verifier:
    """Compares whole sets, read from the texts, of the node pairs whose signatures allow it."""

    def __init__(self, nodes: DataFrame, docs: DataFrame, rule: Rule):
        self.nodes, self.docs, self.rule = nodes, docs, rule

    def sets(self, wanted: DataFrame) -> DataFrame | None:
        """node, shingles of the nodes wanted, each given once; None where there are none."""
        wanted = stage(wanted.join(self.nodes.select("node", "at"), "node"), "wanted")
        count = wanted.count()
        if not count:
            return None
        bits = 1 << min(29, max(16, (16 * count).bit_length()))
        run = _whole_sets(self.rule, _bloom(wanted.select("at"), bits), bits)
        sets = self.docs.select("at", "text").mapInArrow(released(run), "at long, node long, shingles binary")
        # a node has one `at`; rows that share it and the set are in the same place already
        return stage(sets.join(wanted, ["at", "node"]).dropDuplicates(["at", "node"]).select("node", "shingles"), "sets")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Of node pairs (a, b), those that are similar."""
        rule = self.rule
        pairs = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        x, y = (self.nodes.select(F.col("node").alias(k), F.col("n").alias(f"{k}_n"), F.col("sig").alias(f"{k}_sig")) for k in ("a", "b"))
        near = pairs.join(x, "a").join(y, "b").select("a", "b", "a_n", "b_n", "a_sig", "b_sig")
        near = stage(near.mapInArrow(_may_link(rule), "a long, b long"), "pairs")
        sets = self.sets(near.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        if sets is None:
            return near
        x, y = (sets.select(F.col("node").alias(k), F.col("shingles").alias(v)) for k, v in (("a", "x"), ("b", "y")))
        both = near.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_common, "a long, b long, both long, a_n long, b_n long")
        links = stage(both.filter(F.col("both") * (rule.num + rule.den) >= (F.col("a_n") + F.col("b_n")) * rule.num).select("a", "b"), "links")
        discard(sets)
        return links


def _similar(x: bytes, y: bytes, rule: Rule) -> bool:
    x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
    return len(np.intersect1d(x, y, assume_unique=True)) * (rule.num + rule.den) >= (len(x) + len(y)) * rule.num


def _top(above: dict[int, int], x: int) -> int:
    while (y := above.setdefault(x, x)) != x:
        above[x] = above[y]
        x = y
    return x


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges a, b -> for every node of them the smallest node that the task's edges lead to."""
    above: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = _top(above, a), _top(above, b)
            above[max(a, b)] = min(a, b)
    nodes = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([_top(above, x) for x in nodes], pa.int64())], names=["node", "root"])


def components(edges: DataFrame, small: int = 100_000) -> DataFrame:
    """node, root for every node of edges (a, b): each round every node moves to the smallest of its neighbours and
    itself, and edges within a root vanish. Nodes are hashes, so the number of nodes falls by a factor each round. At most
    `small` edges that are left are one task's work, whose memory this bounds."""
    labels = None
    while (left := edges.count()) > small:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        moved = stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "moved")
        labels = moved if labels is None else _moved_on(labels, moved)
        step = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
        ends = edges.join(step.select(F.col("root").alias("a"), F.col("to").alias("x")), "a").join(step.select(F.col("root").alias("b"), F.col("to").alias("y")), "b")
        edges = stage(ends.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not left:
        return edges.selectExpr("a AS node", "b AS root") if labels is None else labels
    last = stage(edges.select("a", "b").coalesce(1).mapInArrow(_forest, "node long, root long"), "forest")
    return last if labels is None else _moved_on(labels, last)


def _moved_on(labels: DataFrame, moved: DataFrame) -> DataFrame:
    """labels (node, root), where roots have moved (node, root)."""
    step = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
    return stage(labels.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    """A batch of CROSSED, and of what may follow them, as arrays with a row for each entry: the eight numbers, mini as four words, earlier tokens
    and how many these are, whole signatures and sets as bytes."""
    columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(8)]
    columns.append(np.frombuffer(b"".join(batch.column(8).to_pylist()), dtype="<u8").reshape(-1, 4))
    if batch.num_columns > 9:
        many = batch.column(9).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        earlier = np.zeros((len(many), FIRST), dtype=np.int64)
        earlier[np.arange(FIRST) < many[:, None]] = batch.column(9).flatten().to_numpy(zero_copy_only=False)
        columns += [earlier, many]
    for i in range(10, batch.num_columns):
        columns.append(np.empty(batch.num_rows, dtype=object))
        columns[-1][:] = batch.column(i).to_pylist()
    return columns


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Entries sorted by token, low and high -> their columns, cut where a block ends."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = _columns(batch)
        if held:
            columns = [np.concatenate((h, c)) for h, c in zip(held, columns, strict=True)]
        last = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1]) & (columns[2] == columns[2][-1])
        at = len(last) - int(last[::-1].argmin()) if not last.all() else 0  # the last block may go on
        if at:
            yield [c[:at] for c in columns]
        held = [c[at:] for c in columns]
    if held:
        yield held


def _fitting(rule: Rule, columns: list[np.ndarray], reach: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of blocks of entries sorted by n, the places of pairs from two components that can be similar by sizes, places and small
    signatures, and the share of bits that differ. With earlier tokens a pair is met in the first list that both are in: there its
    places allow the most."""
    token, low, high, _, root, n, pos, side, mini, *more = columns
    n, pos = n.astype(np.int64), pos.astype(np.int64)
    edge = np.ones(len(token), dtype=bool)
    edge[1:] = (token[1:] != token[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    end = np.append(np.flatnonzero(edge)[1:], len(token))[np.cumsum(edge) - 1]
    for one, two, fit in _beside(rule, n, pos, end, np.arange(len(token)), reach):
        fit &= (root[one] != root[two]) & ((low[one] == high[one]) | (side[one] != side[two]))
        a, b = one[fit], two[fit]
        differ, both = np.bitwise_count(mini[a] ^ mini[b]).sum(axis=1, dtype=np.int64), n[a] + n[b]
        may = (both - differ) * (rule.num + rule.den) >= 2 * both * rule.num
        a, b, differ = a[may], b[may], differ[may] / both[may]
        if more and len(a):
            earlier, many = more[:2]
            met = np.zeros(len(a), dtype=bool)
            for k in range(int(many[a].max())):
                met |= (k < many[a]) & ((earlier[b] == earlier[a, k][:, None]) & (np.arange(FIRST) < many[b][:, None])).any(axis=1)
            a, b, differ = a[~met], b[~met], differ[~met]
        if len(a):
            yield a, b, differ


def _nearest(rule: Rule, reach: int):
    """CROSSED, sorted -> for each entry the one of the next few that is most like it by small signatures, if any can be
    similar: as many pairs as entries at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_blocks(batches):
            node = columns[3]
            to, least = np.full(len(node), -1), np.full(len(node), np.inf)
            for a, b, differ in _fitting(rule, columns, reach):
                nearer = differ < least[a]
                to[a[nearer]], least[a[nearer]] = b[nearer], differ[nearer]
            found = np.unique(np.sort(np.stack((node[to >= 0], node[to[to >= 0]])), axis=0), axis=1)
            if found.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    return run


def _near(rule: Rule, columns: list[np.ndarray], i: int, j: int) -> bool:
    """Whether two entries' sets can be similar by their sizes and whole signatures."""
    both = int(columns[5][i]) + int(columns[5][j])
    return (both - _differing(columns[11][i], columns[11][j])) * (rule.num + rule.den) >= 2 * both * rule.num


def _meeting(rule: Rule):
    """CROSSED and earlier, sorted -> the entries, once each, that meet any they can be similar to; by their whole signatures too,
    where these follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_blocks(batches):
            some = np.zeros(len(columns[0]), dtype=bool)
            for a, b, _ in _fitting(rule, columns):
                if len(columns) > 11:
                    open_ = ~(some[a] & some[b])  # others' pairs change nothing
                    a, b = a[open_], b[open_]
                    near = np.array([_near(rule, columns, i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True)], dtype=bool)
                    a, b = a[near], b[near]
                some[a] = some[b] = True
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(columns[0][some]), pa.array(columns[3][some])], names=["token", "node"])

    return run


def _linking(rule: Rule):
    """CROSSED, earlier, whole signatures and sets, sorted -> links that join components. Sets are compared here, and only where no links
    found before in the task join the two: a task has fewer links than components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}
        for columns in _whole_blocks(batches):
            node, root, sets = columns[3], columns[4], columns[-1]
            links = []
            for a, b, differ in _fitting(rule, columns):
                order = np.argsort(differ, kind="stable")
                for i, j in zip(a[order].tolist(), b[order].tolist(), strict=True):
                    x, y = _top(above, int(root[i])), _top(above, int(root[j]))
                    if x != y and _near(rule, columns, i, j) and _similar(sets[i], sets[j], rule):
                        above[max(x, y)] = min(x, y)
                        links.append((int(node[i]), int(node[j])))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], names=["a", "b"])

    return run


def _dealt(entries: DataFrame, parts: Column) -> DataFrame:
    """Entries of each list in blocks: each pair of its parts is one, so that any two entries meet in one block."""
    dealt = entries.withColumn("parts", parts.cast("int")).withColumn("side", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other"))


def _sorted(dealt: DataFrame, *more: str) -> DataFrame:
    return dealt.select(*CROSSED, *more).repartition(partitions(dealt.sparkSession), "token", "low", "high").sortWithinPartitions("token", "low", "high", "n")


def _bounded(entries: DataFrame, block: int, shingles: int) -> DataFrame:
    """Entries dealt out in blocks of about so many entries, and shingles of their sets, at most."""
    sizes = entries.groupBy("token").agg(F.greatest(F.count("*") / block, F.sum("n") / shingles).alias("blocks"))
    return _dealt(entries.join(sizes, "token"), F.ceil("blocks"))


def _last_links(lists: DataFrame, labels: DataFrame, minis: DataFrame, verifier: Verifier, block: int) -> DataFrame | None:
    """Links that join all components which any list's entries link. First the entries that meet none they can be similar to go, by
    small signatures and then, for what these leave, by whole ones, as small ones tell nothing of long sets; the others come with their
    whole sets, in blocks of as many shingles as memory allows, and are compared where they meet. So rows are as many as entries in
    blocks, not pairs, and whole sets are read of near misses only."""
    open_ = _open(lists, labels)
    first = open_.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("pos", "token"))), 1, FIRST).alias("first"))
    earlier = F.expr("transform(filter(first, x -> x.pos < pos OR (x.pos = pos AND x.token < token)), x -> x.token)").alias("earlier")
    entries = stage(open_.join(first, "node").join(minis, "node").select("token", "node", "root", "n", "pos", "many", "mini", earlier), "entries")
    meeting, found = _meeting(verifier.rule), "token long, node long"
    met = stage(_sorted(_dealt(entries, F.ceil(F.col("many") / block)), "earlier").mapInArrow(meeting, found).distinct(), "met")
    sigs = verifier.nodes.join(met.select("node").distinct(), "node").select("node", "sig")
    entries = stage(entries.drop("many").join(met, ["token", "node"]).join(sigs, "node"), "entries")
    met = stage(_sorted(_bounded(entries, block, 32 * SHINGLES), "earlier", "sig").mapInArrow(meeting, found).distinct(), "met")
    sets = verifier.sets(met.select("node").distinct())
    if sets is None:
        return None
    dealt = _bounded(entries.join(met, ["token", "node"]), block, SHINGLES).join(sets, "node")
    links = stage(_sorted(dealt, "earlier", "sig", "shingles").mapInArrow(released(_linking(verifier.rule)), "a long, b long"), "links")
    discard(sets)
    return links


def _open(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries of the lists whose nodes lie in more than one component, with root and many, the list's length. A list of
    two nodes has no pair but the one that the first round compared. As components only grow, no other list opens later:
    the next round reads these alone."""
    lists = lists.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of = lists.groupBy("token").agg(F.count("*").alias("many"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high AND many > 2")
    of = stage(of.select("token", "many"), "of")
    return stage(lists.join(of, "token"), "open")


def _grown(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components of before, joined by links found since."""
    return components(stage(labels.select(F.col("node").alias("a"), F.col("root").alias("b")).filter("a <> b").union(links), "edges"))


def _at() -> Column:
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), "text")


def _rooted(docs: DataFrame, rule: Rule, block: int, turns: int) -> DataFrame:
    """doc_id, at, n, node and root (null where the set is empty) for each row of docs."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), _at().alias("at"), "text")
    wide = stage(docs.mapInArrow(released(_prefixes(rule, rarity(docs, rule))), SETS), "prefixes")
    narrow = stage(wide.drop("prefix", "sig", "mini"), "nodes")
    nodes = stage(wide.filter("n > 0").groupBy("node").agg(F.min("at").alias("at"), F.max("n").alias("n"), F.max("sig").alias("sig"), F.max("mini").alias("mini")), "classes")
    members = stage(narrow.filter("n > 0").groupBy("grp", "node").agg(F.max("n").cast("int").alias("n")), "members")
    one = members.groupBy("grp").agg(F.min("node").alias("node"), F.count("*").alias("many"))

    entries = wide.filter("prefix IS NOT NULL").select("grp", F.col("n").cast("int").alias("n"), "prefix").mapInArrow(_explode, ENTRIES)
    entries = entries.repartition(partitions(spark), "token").sortWithinPartitions("token", "n", "grp")
    shared = stage(entries.mapInArrow(_stars(rule), ENTRIES + ", pivot long, pivot_n int, pivot_pos int"), "shared")
    discard(wide)

    fits = _possible(F.col("n"), F.col("pos"), F.col("pivot_n"), F.col("pivot_pos"), rule)
    groups = shared.filter((F.col("grp") != F.col("pivot")) & fits).select("grp", "pivot").distinct()
    # a group stands for its members: all with the group's first node, and the first nodes of two groups
    rep = one.select("grp", F.col("node").alias("first"))
    within = members.join(rep, "grp").select(F.col("first").alias("a"), F.col("node").alias("b"))
    across = groups.join(rep.withColumnRenamed("first", "a"), "grp").join(rep.select(F.col("grp").alias("pivot"), F.col("first").alias("b")), "pivot").select("a", "b")
    verifier = Verifier(nodes, docs, rule)
    found = verifier.links(within.union(across))

    # lists of more than two nodes may have other pairs
    lists = shared.select("token", "grp", "pos").join(members, "grp").select("token", "node", "n", "pos")
    inner = members.join(one.filter("many > 1").select("grp"), "grp").select(F.col("grp").alias("token"), "node", "n", F.lit(0).alias("pos"))
    lists = stage(lists.union(inner), "lists")
    discard(shared)
    labels = components(found)
    minis = nodes.select("node", "mini")
    for turn in range(turns):
        open_ = _open(lists, labels)
        discard(lists)
        some = open_.groupBy("token", "root", F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(16))).agg(F.max("many").alias("many"), F.min(F.struct(F.xxhash64("token", "node", F.lit(turn)).alias("h"), "node", "n", "pos")).alias("one"))
        low = F.pmod(F.xxhash64("one.node", F.lit(turn)), F.ceil(F.col("many") / block)).cast("int")
        some = some.select("token", low.alias("low"), low.alias("high"), "one.node", "root", "one.n", "one.pos", low.alias("side")).join(minis, "node")
        labels = _grown(labels, verifier.links(_sorted(some).mapInArrow(_nearest(rule, 8 << 2 * turn), "a long, b long")))
        lists = open_.select("token", "node", "n", "pos")
    last = _last_links(lists, labels, minis, verifier, block)
    labels = labels if last is None else _grown(labels, last)

    return narrow.select("doc_id", "at", "n", "node").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), block: int = 2048, turns: int = 1) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_shingles, component_id.

    component_id is the smallest doc_id that links lead to, itself included. A null text or one without words has an empty
    set and no link. Rows that share a doc_id are documents of their own. A row without a doc_id is a document like all
    others; component_id is null where links lead to no row with a doc_id. Extra columns are ignored; an empty table gives
    no rows.
    """
    rows = _rooted(docs, rule, block, turns)
    smallest = rows.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("many")).filter("many > 1")
    out = rows.join(smallest.select("root", "component_id"), "root", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, rule: Rule = Rule(), block: int = 2048, turns: int = 1) -> DataFrame:
    """The rows of docs (doc_id, text, and any others), with all their columns, that are the first of their component: the
    one with the smallest doc_id, a null one last, and a single one where rows share doc_id and text.

    Null texts and those without words are in no component and stay, repeated or not. Names of other columns, whatever they
    are, stay; an empty table gives no rows.
    """
    rows = _rooted(docs, rule, block, turns)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at", "many"))
    kept = rows.filter("root IS NOT NULL").groupBy("root", "doc_id", "at").agg(F.count("*").alias("many")).groupBy("root").agg(first.alias("one"))
    kept = kept.select(F.col("one.doc_id").alias("_doc"), F.col("one.at").alias("_key"), F.col("one.many").alias("_many"))
    worded = F.regexp_like(F.coalesce("text", F.lit("")), F.lit(WORD))
    given = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_given"), F.col("doc_id").cast("long").alias("_id"), _at().alias("_at"), (~worded).alias("_empty"))
    joined = given.filter("NOT _empty").join(kept, (F.col("_at") == F.col("_key")) & F.col("_id").eqNullSafe(F.col("_doc")))
    repeated = joined.filter("_many > 1").groupBy("_id", "_at").agg(F.first("_given").alias("_given")).select("_given")
    out = given.filter("_empty").select("_given").union(joined.filter("_many = 1").select("_given")).union(repeated)
    return out.select(*(F.col(f"_given.`{c}`").alias(c) for c in docs.columns))
