"""Nearest reference by a position-weighted substitution matrix, among references of the same length."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from ..functions.alleles import RESIDUES, valid
from ..session import written
from .places import BUCKET, Shape, codes, different, in_buckets, met, strings
from .windows import BITS

#: BLOSUM62, lower triangle.
ORDER = "ARNDCQEGHILKMFPSTWYV"
BLOSUM62 = """
4
-1 5
-2 0 6
-2 -2 1 6
0 -3 -3 -3 9
-1 1 0 0 -3 5
-1 0 0 2 -4 2 5
0 -2 0 -1 -3 -2 -2 6
-2 0 1 -1 -3 0 0 -2 8
-1 -3 -3 -3 -1 -3 -3 -4 -3 4
-1 -2 -3 -4 -1 -2 -3 -4 -3 2 4
-1 2 0 -1 -3 1 1 -2 -1 -3 -2 5
-1 -1 -2 -3 -1 0 -2 -3 -2 1 2 -1 5
-2 -3 -3 -3 -2 -3 -3 -3 -1 0 0 -3 0 6
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4 7
1 -1 1 0 -1 0 0 0 -1 -2 -2 0 -1 -2 -1 4
0 -1 0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1 1 5
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1 1 -4 -3 -2 11
-2 -2 -2 -3 -2 -1 -2 -3 2 -1 -1 -2 -1 3 -3 -2 -2 2 7
0 -3 -3 -3 -1 -2 -2 -3 -3 3 1 -2 1 -1 -2 -2 0 -3 -1 4
"""


def matrix(text: str = BLOSUM62) -> np.ndarray:
    rows = [[int(x) for x in line.split()] for line in text.split("\n") if line]
    out = np.zeros((len(rows), len(rows)), dtype=np.int32)
    for i, row in enumerate(rows):
        out[i, : i + 1] = out[: i + 1, i] = row
    return out


def weights(length: int, step: int = 4) -> list[int]:
    """Of positions: 1, 2, 3 .. from either end within a third of the length. Between them a ramp of `step` from 1 on, up and down
    again; with a step of 1 the ramp lacks its top, so that what is left of it stands a place further to the left."""
    if step == 1 and length == 4:
        raise ValueError("a step of 1 leaves a place of four without a weight")
    top, third = -(-length // 2) - (step == 1), length // 3
    place = lambda i: i if i < top else top + min(top, length // 2) - 1 - i
    return [i + 1 if i < third else length - i if i >= length - third else 1 + step * place(i) for i in range(length)]


def encode(peptides: list[str]) -> np.ndarray:
    place = np.full(256, -1, dtype=np.int64)
    place[[ord(c) for c in ORDER]] = np.arange(20)
    return place[np.frombuffer("".join(peptides).encode("ascii"), dtype=np.uint8)].reshape(len(peptides), -1)


class Trie:
    """Different sequences of one length, as rows in order, by their runs of first residues: level d has a node for each different run
    of d + 1 residues. A node's children are neighbours in the next level."""

    def __init__(self, rows: np.ndarray):
        first = np.concatenate((np.full(min(len(rows), 1), -1), (rows[1:] != rows[:-1]).argmax(axis=1)))
        self.begin = [np.flatnonzero(first <= d) for d in range(rows.shape[1])]  # rows where a node of the level begins
        self.residue = [rows[s, d].astype(np.int32) for d, s in enumerate(self.begin)]
        self.child = [np.searchsorted(later, np.append(s, len(rows))).astype(np.int32) for s, later in zip(self.begin, self.begin[1:], strict=False)]


def _in_order(rows: np.ndarray) -> np.ndarray:
    """Places of rows of residues (0 to 19), sorted."""
    if rows.shape[1] > 12:
        return np.lexsort(rows.T[::-1])
    return np.argsort(sum(rows[:, d].astype(np.uint64) << np.uint64(5 * (rows.shape[1] - 1 - d)) for d in range(rows.shape[1])))


def _pairs(few: Trie, many: Trie, gain: list[np.ndarray], need: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Rows of few, and their scores with those rows of many for which no run of first residues of both stays at or below what few's
    node needs there. Pairs of nodes go down level by level, so peptides share what they have in common. None where more than `most` pairs are met at once."""
    p, r = np.repeat(np.arange(len(few.residue[0]), dtype=np.int32), len(many.residue[0])), np.tile(np.arange(len(many.residue[0]), dtype=np.int32), len(few.residue[0]))
    score = np.zeros(len(p), dtype=np.int32)
    for d, of in enumerate(gain):
        if d:
            low = few.child[d - 1][p]
            times = few.child[d - 1][p + 1] - low
            total = int(times.sum(dtype=np.int64))
            if total > most:
                return None
            if total > len(p):  # pairs of the peptides' children and the references' node
                p = np.arange(total, dtype=np.int32) + np.repeat(low - np.cumsum(times, dtype=np.int32) + times, times)
                r, score = np.repeat(r, times), np.repeat(score, times)
            else:
                p = low
            low = many.child[d - 1][r]
            times = many.child[d - 1][r + 1] - low
            total = int(times.sum(dtype=np.int64))
            if total > most:
                return None
            pair = np.repeat(np.arange(len(p), dtype=np.int32), times)
            r = np.arange(total, dtype=np.int32) + np.repeat(low - np.cumsum(times, dtype=np.int32) + times, times)
        else:
            pair = np.arange(len(p), dtype=np.int32)
        more = of.take((few.residue[d][p] * 20)[pair] + many.residue[d][r])
        on = np.flatnonzero(more > (need[d][p] - score)[pair])
        pair, r = pair[on], r[on]
        p, score = p[pair], score[pair] + more[on]
    return p, score


#: Floors that are tried one after another, as shares of a peptide's own score; what is left has none.
FLOORS = (0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6, 0.55, 0.5, 0.45, 0.4, 0.3)
_BELOW = -(1 << 24)


class References:
    """References of one length (rows of residues, each once), positions of most weight first."""

    def __init__(self, rows: np.ndarray, step: int = 4):
        w, self.matrix = np.array(weights(rows.shape[1], step)), matrix()
        self.order, self.size = np.argsort(-w, kind="stable"), len(rows)
        rows = rows[:, self.order]
        self.trie = Trie(rows[_in_order(rows)].astype(np.uint8))
        self.gain = [(self.matrix * x).astype(np.int32).ravel() for x in w[self.order]]

    def best(self, rows: np.ndarray, exclude: bool, block: int = 1 << 16, most: int = 2_000_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For different peptides (rows of residues whose positions are in this order, sorted): the best score (of those below the
        peptide's own, with exclude), -inf where there is none; the own score; and how many pairs were scored to the end. A score over
        the floor is exact, as all that reach it are met; peptides without one go on to the next floor. Where more than `most` pairs
        are met at once, half of the peptides go first."""
        k = rows.shape[1]
        own = np.stack([self.gain[d].take(rows[:, d].astype(np.int32) * 21) for d in range(k)], axis=1)  # no other residue adds more
        rest = np.cumsum(own[:, ::-1], axis=1)[:, ::-1]
        own, rest = rest[:, 0].copy(), np.concatenate((rest[:, 1:], np.zeros((len(rows), 1), dtype=rest.dtype)), axis=1)
        best, scored, left = np.full(len(rows), _BELOW, dtype=np.int32), np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
        for share in (*FLOORS, None):
            stack = [left[low : low + block] for low in range(0, len(left), block)]
            while stack:
                at = stack.pop()
                floor = np.floor(share * own[at]).astype(np.int32) if share else np.full(len(at), _BELOW, dtype=np.int32)
                few = Trie(rows[at])
                need = [np.minimum.reduceat(floor - rest[at, d], few.begin[d]).astype(np.int32) for d in range(k)]
                found = _pairs(few, self.trie, self.gain, need, most if len(at) > 1 else 1 << 60)
                if found is None:
                    stack += [at[len(at) // 2 :], at[: len(at) // 2]]
                    continue
                scored[at] += np.bincount(found[0], minlength=len(at))
                on = found[1] < own[at][found[0]] if exclude else np.ones(len(found[0]), dtype=bool)
                np.maximum.at(best, at[found[0][on]], found[1][on])
            left = left[best[left] == _BELOW]
            if not len(left):
                break
        return np.where(best == _BELOW, -np.inf, best), own, scored


def _best(exclude_identity: bool, block: int = 1 << 16, most: int = 2_000_000, step: int = 4):
    """Best scores of a group's peptides, all of one length, among the group's references, and how many pairs were scored for
    them."""

    def run(peptides: pd.DataFrame, refs: pd.DataFrame) -> pd.DataFrame:
        peptides, refs = peptides["peptide"].tolist(), refs["seq"].tolist()
        raw, own, scored = np.full(len(peptides), -np.inf), np.ones(len(peptides)), np.zeros(len(peptides), dtype=np.int64)
        if peptides and refs:
            among = References(np.unique(encode(refs), axis=0), step)
            rows = encode(peptides)[:, among.order].astype(np.uint8)
            order = _in_order(rows)
            raw[order], own[order], scored[order] = among.best(rows[order], exclude_identity, block, most)
        return pd.DataFrame({"peptide": pd.Series(peptides, dtype=object), "raw": pd.array(np.where(np.isfinite(raw), raw, np.nan), dtype="Float64"), "own": own, "scored": scored, "pairs": np.full(len(peptides), len(refs), dtype=np.int64)})

    return run


def _parts(df: DataFrame, column: str, most: int, turns: int = 1, upto: int = 0) -> tuple[dict[int, int], Column]:
    """By length of the column: how many parts of about `most` rows there are, one at least; and a row's part. A length of more
    than `turns` such parts has larger ones, of up to `upto` rows."""
    counts = {r["k"]: r["n"] for r in df.groupBy(F.length(column).alias("k")).agg(F.count("*").alias("n")).collect()}  # a row for each length
    rows = lambda n: max(most, min(-(-n // turns), upto))
    many = {k: -(-n // rows(n)) for k, n in counts.items() if n > most}
    return many, F.pmod(F.xxhash64(column), _of(many, F.length(column)).cast("long")).cast("int")


def _of(many: dict[int, int], k: Column) -> Column:
    """A length's number of parts, 1 where many has none."""
    return F.coalesce(*(F.when(k == F.lit(length), F.lit(n)) for length, n in sorted(many.items())), F.lit(1))


def similarity(peptides: DataFrame, references: DataFrame, exclude_identity: bool = True, normalised: bool = True, at_once: int = 500_000, share: int = 20_000, counts: bool = False, step: int = 4) -> DataFrame:
    """peptide, similarity for peptides (peptide): the best score of a reference (seq) of its length over its own score;
    with exclude_identity only scores below its own count; null where no reference counts. A peptide with anything but standard
    residues is an error when the result is read; such references don't count. Weights follow from the length, any from 3 on, and the step. The oldest form, a raw maximum, is
    normalised=False without exclude_identity.

    Both sides are keyed by length, block of about at_once references at most and part of about `share` peptides (ten times as
    many where these would be more parts than tasks, as each part takes the references once more), and meet in these groups on executors; the best of the blocks counts. A group's references are a trie over positions by falling
    weight, in which a peptide leaves a branch whose residues so far and the best substitution of all others can't reach
    what is asked for; results are exact. With counts, also scored, the pairs scored to the end, and pairs, all that there are.
    """
    refs = references.select("seq").filter(valid(F.col("seq")) & (F.length("seq") > 2)).distinct()
    said = F.concat(F.lit("not a standard peptide: "), F.coalesce("peptide", F.lit("null")))
    wanted = peptides.select(F.when(valid(F.col("peptide")) & (F.length("peptide") > 2), F.col("peptide")).otherwise(F.raise_error(said)).alias("peptide")).distinct()
    sources, refs, wanted = (refs, wanted), written(refs, "references"), written(wanted, "wanted")
    (blocks, block), (turns, turn) = _parts(refs, "seq", at_once), _parts(wanted, "peptide", share, 2 * int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions")), 10 * share)
    if not blocks and not turns:  # few rows, whose plan goes on to name the files that it reads
        refs, wanted = sources
    each = lambda many, c: F.explode(F.sequence(F.lit(0), _of(many, F.length(c)) - 1))
    left = wanted.select("peptide", F.length("peptide").alias("k"), turn.alias("turn"), each(blocks, "peptide").alias("block"))
    right = refs.select("seq", F.length("seq").alias("k"), block.alias("block"), each(turns, "seq").alias("turn"))
    keys = ("k", "block", "turn")
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_best(exclude_identity, step=step), "peptide string, raw double, own double, scored long, pairs long")
    if blocks:  # else each peptide is in one group
        best = best.groupBy("peptide").agg(F.max("raw").alias("raw"), F.max("own").alias("own"), F.sum("scored").alias("scored"), F.sum("pairs").alias("pairs"))
    return best.select("peptide", (F.round(F.col("raw") / F.col("own"), 6) if normalised else F.col("raw")).alias("similarity"), *(("scored", "pairs") if counts else ()))


def _scored(shape: Shape, refs: dict[int, np.ndarray], exclude: bool, step: int):
    """The windows of a bucket, with their best scores among the references (codes by length)."""
    place = np.zeros(32, dtype=np.uint8)
    place[np.arange(1, 21)] = [ORDER.index(c) for c in RESIDUES]
    residues = lambda found, k, order: np.stack([place[((found >> np.uint64(BITS * (k - 1 - j))) & np.uint64(31)).astype(np.uint8)] for j in order], axis=1)
    among: dict[int, References] = {}

    def run(table: pa.Table) -> pa.Table:
        out = []
        for k, found in different(table, shape):
            if k not in among and len(refs.get(k, ())):
                among[k] = References(residues(refs[k], k, range(k)), step)
            raw, own, scored, pairs = np.full(len(found), -np.inf), np.ones(len(found)), np.zeros(len(found), dtype=np.int64), 0
            if len(found) and k in among:
                rows = residues(found, k, among[k].order)
                order = _in_order(rows)
                found, pairs = found[order], among[k].size
                raw, own, scored = among[k].best(rows[order], exclude)
            columns = [strings(found, k), pa.array(raw, mask=np.isneginf(raw)), pa.array(own.astype(np.float64)), pa.array(scored), pa.array(np.full(len(found), pairs))]
            out += pa.table(columns, names=_SCORED.names).to_batches(max_chunksize=1 << 16)
        return pa.Table.from_batches(out, schema=pa.schema(zip(_SCORED.names, (pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()), strict=True)))

    return run


_SCORED = StructType().add("peptide", StringType()).add("raw", DoubleType()).add("own", DoubleType()).add("scored", LongType()).add("pairs", LongType())


def similarity_of_windows(proteins: DataFrame, references: DataFrame, lengths=(8, 9, 10, 11), text: bool = False, exclude_identity: bool = True, counts: bool = False, step: int = 4, most: int = 1_000_000) -> DataFrame:
    """similarity() of all windows of proteins (seq) to all windows of references (seq), of 3 residues at least. Up to `most` windows of
    references go to every task, and the proteins' windows are scored where their places meet, without being written or shuffled as strings;
    more meet as in similarity()."""
    shape = Shape(k for k in lengths if k > 2)
    if not shape.fits():
        raise ValueError("these lengths don't fit a number of a place")
    near = met(references, lengths=shape.lengths, text=text, per_row=False)
    refs = near.limit(most + 1).toArrow().column(0).to_pylist()
    if len(refs) > most:
        return similarity(met(proteins, lengths=shape.lengths, text=text, per_row=False), near.withColumnRenamed("peptide", "seq"), exclude_identity, counts=counts, step=step)
    by = {k: codes(pa.array([r for r in refs if len(r) == k], pa.string()), Shape([k]), False)[1] for k in shape.lengths}
    best = in_buckets([proteins], shape, text, each=2 * BUCKET, least=3).groupBy("bucket").applyInArrow(_scored(shape, by, exclude_identity, step), _SCORED)
    return best.select("peptide", F.round(F.col("raw") / F.col("own"), 6).alias("similarity"), *(("scored", "pairs") if counts else ()))


def in_order(peptides: DataFrame, scores: DataFrame, order: str) -> DataFrame:
    """A score for each row of peptides (peptide, and a column to order by), repeated rows too; sort by it where written."""
    return peptides.select(order, "peptide").join(scores, "peptide", "left").select(order, "peptide", "similarity")
