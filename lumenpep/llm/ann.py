"""Approximate nearest neighbours by largest inner product: balanced posting lists.

Vectors are lifted to the unit sphere, where the nearest by angle are those with the largest inner product with a query:
x -> (x, sqrt(M^2 - |x|^2)) / M for stored vectors, M the largest norm; q -> (q, 0) / |q| for queries.
Centroids come from a bounded sample by k-means with a penalty on large lists. Tasks search the centroids by an in-memory
neighbour graph. A vector near a boundary is stored with every centroid that is nearly as near as its nearest, unless an
already chosen one is nearer to that centroid than the vector is. A query reads the lists whose centroids' distance is within
a ratio of the nearest one's, however many these are, and more where these hold too few vectors for a whole result. The ratio is fitted to a recall: a bounded sample of the queries is
compared with all vectors, and for each vector that a query should find, the ratio is noted that would read a list with it.
Lists that are longer than a block (many equal vectors, say) are dealt in blocks of bounded size, and so are the queries of a
list. Scores are inner products of the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import only, partitions, released, small_batches, stage


class Index(NamedTuple):
    """centroids (k, d + 1) of unit length; graph (k, r) of neighbours; hubs: centroids at which searches begin; largest
    norm. At most `lists` centroids, whatever the table's size: a list grows with the table beyond `lists` * `per_list` vectors."""

    centroids: np.ndarray
    graph: np.ndarray
    hubs: np.ndarray
    norm: float
    dim: int


def lift(x: np.ndarray, norm: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0))
    return (np.concatenate((x, rest[:, None]), axis=1) / norm).astype(np.float32)


def _unit(c: np.ndarray) -> np.ndarray:
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def balanced_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Centroids of unit length. Distances grow with the size that a list had in the round before, so lists even out."""
    r = np.random.default_rng(seed)
    c = x[r.choice(len(x), k, replace=False)]
    penalty = np.zeros(k, dtype=np.float32)
    for _ in range(rounds):
        near = np.concatenate([(part @ c.T - penalty).argmax(axis=1) for part in np.array_split(x, max(1, len(x) * k // 20_000_000 + 1))])
        size = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(size[:, None] > 0, sums, x[r.integers(len(x), size=k)])
        c = _unit(c).astype(np.float32)
        penalty = (0.02 * (size / (len(x) / k) - 1)).clip(-0.02, 0.2).astype(np.float32)
    return c


def neighbour_graph(c: np.ndarray, links: int = 16, hubs: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Each centroid's nearest others, and evenly chosen centroids to begin at: as many as the root of all, `hubs` at most."""
    k = len(c)
    hubs = min(hubs, int(np.ceil(np.sqrt(k))))
    links = min(links, k - 1)
    if links < 1:
        return np.zeros((k, 1), dtype=np.int64), np.zeros(1, dtype=np.int64)
    rows = []
    for low in range(0, k, 1024):
        s = c[low : low + 1024] @ c.T
        s[np.arange(len(s)), np.arange(low, low + len(s))] = -2
        rows.append(np.argpartition(-s, links - 1, axis=1)[:, :links])
    return np.concatenate(rows), np.linspace(0, k - 1, min(hubs, k)).astype(np.int64)


def search_centroids(index: Index, q: np.ndarray, most: int, beam: int | None = None, spread: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """For lifted vectors (B, d + 1), the `most` nearest centroids found and their squared distances, nearest first. Each
    query holds the `beam` nearest centroids that it has met, and goes on to the neighbours of the `spread` nearest ones that
    it has not yet left, until it has left all. The graph is walked at every size, unless all centroids are asked for."""
    k, batch = len(index.centroids), len(q)
    most = min(most, k)
    beam = min(k, beam or max(2 * most, 32))
    if most == k:  # all are asked for
        return _nearest(q @ index.centroids.T, most)
    held, sims = np.broadcast_to(index.hubs, (batch, len(index.hubs))), q @ index.centroids[index.hubs].T
    fresh = np.ones(held.shape, dtype=bool)
    met = np.zeros((batch, k), dtype=bool)
    met[:, index.hubs] = True
    each = np.arange(batch)[:, None]
    while fresh.any():
        s, wide = np.where(fresh, sims, -np.inf), min(spread, held.shape[1])
        at = np.argpartition(-s, wide - 1, axis=1)[:, :wide]
        going = np.take_along_axis(fresh, at, axis=1)
        np.put_along_axis(fresh, at, False, axis=1)
        near = np.sort(np.where(going[:, :, None], index.graph[np.take_along_axis(held, at, axis=1)], -1).reshape(batch, -1), axis=1)
        new = near >= 0
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        new &= ~met[each, near]
        rows, cols = np.nonzero(new)
        met[rows, near[rows, cols]] = True
        found = np.full(near.shape, -np.inf, dtype=np.float32)
        found[rows, cols] = np.einsum("nd,nd->n", q[rows], index.centroids[near[rows, cols]])
        held, sims, fresh = np.concatenate((held, near), axis=1), np.concatenate((sims, found), axis=1), np.concatenate((fresh, new), axis=1)
        if held.shape[1] > beam:
            best = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
            held, sims, fresh = (np.take_along_axis(x, best, axis=1) for x in (held, sims, fresh))
    order, d = _nearest(sims, min(most, sims.shape[1]))
    out = np.take_along_axis(held, order, axis=1)
    few = np.flatnonzero(~np.isfinite(d).all(axis=1)) if out.shape[1] == most else each.ravel()
    if len(few):  # the graph led to fewer than asked for: all are compared
        every = _nearest(q[few] @ index.centroids.T, most)
        if len(few) == batch:
            return every
        out, d = out.copy(), d.copy()
        out[few], d[few] = every
    return out, d


def _nearest(sims: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-sims, axis=1, kind="stable")[:, :most]
    return order, np.maximum(2 - 2 * np.take_along_axis(sims, order, axis=1), 0)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding as doubles, of the vectors that take part: not null, not zero, all components finite."""
    of = only(vectors, "vec_id", "embedding").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return of.filter(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False)))


def fit(vectors: DataFrame, lists: int = 16_384, per_list: int = 1024, samples: int = 40_000) -> Index | None:
    """From `samples` vectors at most, those with the smallest hash; None where no vector is usable. The dimension is the
    most common one (the larger of two as common); vectors of another take no part."""
    dims = vectors.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not dims:
        return None
    dim, n = dims[0]["dim"], dims[0]["n"]
    of = vectors.filter(F.size("embedding") == dim)
    norm = of.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))).head()[0] ** 0.5
    few = of.select("embedding", F.xxhash64(F.lit("centroids"), "vec_id").alias("h")).filter(F.pmod("h", F.lit(1 << 20)) < min(1 << 20, int(1.2 * samples / n * (1 << 20)) + 1)) if n > samples else of.select("embedding", F.xxhash64(F.lit("centroids"), "vec_id").alias("h"))
    x = np.array([r["embedding"] for r in few.orderBy("h", "embedding").limit(samples).select("embedding").collect()], dtype=np.float64)
    x = lift(x, norm * (1 + 1e-9))
    distinct = len(np.unique(x, axis=0))
    k = max(1, min(lists, n // per_list, distinct // 2))
    c = balanced_kmeans(x, k, rounds=12 if k <= 4096 else 4)
    graph, hubs = neighbour_graph(c)
    return Index(c, graph, hubs, norm * (1 + 1e-9), dim)


def _vectors(batch: pa.RecordBatch, name: str, dim: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _store(index: Index, copies: int, ratio: float, step: int = 2048):
    """Each vector with the lists that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, step):
                batch = whole.slice(low, step)
                x = lift(_vectors(batch, "embedding", index.dim), index.norm)
                near, d = search_centroids(index, x, copies)
                take = d <= d[:, :1] * (1 + ratio) ** 2 + 1e-12
                for j in range(1, near.shape[1]):
                    between = 2 - 2 * np.einsum("bd,bjd->bj", index.centroids[near[:, j]], index.centroids[near[:, :j]])
                    take[:, j] &= ~((between < d[:, j : j + 1]) & take[:, :j]).any(axis=1)
                rows, cols = np.nonzero(take)
                yield pa.RecordBatch.from_arrays([pa.array(near[rows, cols].astype(np.int32)), *(c.take(pa.array(rows)) for c in batch.columns)], names=["list", "vec_id", "embedding"])

    return run


def _exact(names: np.ndarray, q: np.ndarray, k: int, step: int = 4096):
    """A task's k best vectors for each of a few queries, by comparing all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, ids = np.full((len(q), 0), 0.0), np.zeros((len(q), 0), dtype=np.int64)
        for whole in batches:
            for low in range(0, whole.num_rows, step):
                batch = whole.slice(low, step)
                own = batch.column(batch.schema.get_field_index("vec_id")).to_numpy(zero_copy_only=False)
                new = q @ _vectors(batch, "embedding", q.shape[1]).T
                new[names[:, None] == own[None, :]] = -np.inf
                score, ids = np.concatenate((score, new), axis=1), np.concatenate((ids, np.broadcast_to(own, new.shape)), axis=1)
                if score.shape[1] > k:
                    at = np.argpartition(-score, k - 1, axis=1)[:, :k]
                    score, ids = np.take_along_axis(score, at, axis=1), np.take_along_axis(ids, at, axis=1)
        rows, cols = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays([pa.array(names[rows]), pa.array(ids[rows, cols]), pa.array(score[rows, cols])], names=["query_id", "vec_id", "score"])

    return run


def _lifted_queries(x: np.ndarray) -> np.ndarray:
    return np.concatenate((_unit(x), np.zeros((len(x), 1))), axis=1).astype(np.float32)


def fitted_ratio(vectors: DataFrame, queries: DataFrame, stored: DataFrame, index: Index, k: int, recall: float, asked: int = 200) -> tuple[float, int]:
    """Of the squared distances of lists, the ratio to the nearest one's that reads this share of the true k nearest, measured
    on the `asked` queries with the smallest hash against all vectors; and how many lists this is for a query, on average.
    stored: the postings (list, vec_id)."""
    few = queries.select("vec_id", "embedding", F.xxhash64(F.lit("recall"), "vec_id").alias("h")).orderBy("h", "embedding").limit(asked).collect()
    if not few:
        return 1.0, 1
    few = list({r["vec_id"]: r for r in few}.values())
    names, q = np.array([r["vec_id"] for r in few], dtype=np.int64), np.array([r["embedding"] for r in few])
    best = vectors.select("vec_id", "embedding").mapInArrow(_exact(names, q, k), "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)
    held = stored.select("list", "vec_id").join(F.broadcast(best.select("query_id", "vec_id")), "vec_id").collect()  # `asked` * k * copies rows
    near, d = search_centroids(index, _lifted_queries(q), len(index.centroids))
    times = np.take_along_axis(d, np.argsort(near, axis=1), axis=1) / np.maximum(d[:, :1], 1e-9)
    row = {n: i for i, n in enumerate(names.tolist())}
    needed: dict[tuple[int, int], float] = {}
    for r in held:
        at, key = float(times[row[r["query_id"]], r["list"]]), (r["query_id"], r["vec_id"])
        needed[key] = min(at, needed.get(key, at))
    if not needed:
        return 1.0, 1
    ratio = sorted(needed.values())[int(np.ceil(recall * len(needed))) - 1] * (1 + 1e-6)
    return ratio, int(np.ceil((times <= ratio).sum(axis=1).mean()))


def _probe(index: Index, sizes: np.ndarray, ratio: float, enough: int, width: int, step: int = 1024):
    """Each query with the lists within the ratio, and more until they hold `enough` vectors: a result has its length.
    width: how many lists are looked for first; where these don't end it, twice as many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, step):
                batch = whole.slice(low, step)
                q = _lifted_queries(_vectors(batch, "embedding", index.dim))
                todo, wide = np.arange(len(q)), width
                while len(todo):
                    near, d = search_centroids(index, q[todo], wide)
                    held = np.cumsum(sizes[near], axis=1) - sizes[near]
                    take = (d <= np.maximum(d[:, :1] * ratio, 1e-9)) | (held < enough)
                    more = take.all(axis=1) & (near.shape[1] < len(index.centroids))
                    rows, cols = np.nonzero(take & ~more[:, None])
                    yield pa.RecordBatch.from_arrays([pa.array(near[rows, cols].astype(np.int32)), *(c.take(pa.array(todo[rows])) for c in batch.columns)], names=["list", "query_id", "query"])
                    todo, wide = todo[more], 2 * wide

    return run


def _scan(k: int):
    def run(queries: pa.Table, stored: pa.Table) -> pa.Table:
        names, ids, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if queries.num_rows and stored.num_rows:
            own = stored["vec_id"].to_numpy()
            order = np.argsort(own, kind="stable")
            table = lambda t, c: t[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
            own, x = own[order], table(stored, "embedding")[order]
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))  # rows that repeat a vec_id count as one, the nearest
            one = own[first]
            asked, y = queries["query_id"].to_numpy(), table(queries, "query")
            for low in range(0, len(asked), 256):
                score = y[low : low + 256] @ x.T
                if len(first) < len(own):
                    score = np.maximum.reduceat(score, first, axis=1)
                score[asked[low : low + 256, None] == one[None, :]] = -np.inf
                for i, s in enumerate(score):
                    at = np.arange(len(s))
                    if len(s) > k:  # all that tie with the k-th stay until they are ordered
                        at = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                    at = at[np.lexsort((one[at], -s[at]))][:k]
                    at = at[np.isfinite(s[at])]
                    names.append(np.full(len(at), asked[low + i]))
                    ids.append(one[at])
                    scores.append(s[at])
        return pa.table({"query_id": np.concatenate(names), "vec_id": np.concatenate(ids), "score": np.concatenate(scores)})

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, index: Index | None = None, copies: int = 4, store_ratio: float = 0.1, block: int = 4096, recall: float = 0.955, exact: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k nearest found among all vectors but those with the query's id.

    vectors, queries: vec_id, embedding. Those that are null, zero, not finite or of another dimension take no part, nor do
    rows without vec_id. Ties go to the smaller vec_id. Rows that repeat a vec_id count as one, the nearest. Every vector is
    in the index; the index itself is fitted on a bounded sample. recall is what the ratio of lists is fitted to; with exact,
    every block of queries meets every block of vectors instead. Extra columns, whatever their names, are ignored; empty tables
    give no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    vectors, queries = usable(vectors), usable(queries)
    index = index or fit(vectors)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors, queries = (t.filter(F.size("embedding") == index.dim) for t in (vectors, queries))
    if exact:
        stored = vectors.select(F.lit(0).alias("list"), "vec_id", "embedding")
        asked = queries.select(F.lit(0).alias("list"), F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    else:
        stored = stage(vectors.mapInArrow(released(_store(index, copies, store_ratio)), "list int, vec_id long, embedding array<double>"), "postings")
        sizes = np.zeros(len(index.centroids), dtype=np.int64)
        for r in stored.groupBy("list").count().collect():  # a row for each list
            sizes[r["list"]] = r["count"]
        ratio, width = fitted_ratio(vectors, queries, stored, index, k, recall)
        asked = queries.repartition(partitions(spark)).mapInArrow(released(_probe(index, sizes, ratio, copies * (k + 1), width)), "list int, query_id long, query array<double>")
        asked = stage(asked, "probes")
    lengths = stored.groupBy("list").agg(F.count("*").alias("n"))
    wanted = asked.groupBy("list").agg(F.count("*").alias("m"))
    parts = lengths.join(wanted, "list").select("list", F.ceil(F.col("n") / block).cast("int").alias("parts"), F.ceil(F.col("m") / block).cast("int").alias("turns"))
    # every block of a list meets every block of its queries
    stored = stored.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    asked = asked.join(parts, "list").withColumn("turn", F.pmod(F.xxhash64("query_id"), F.col("turns")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keys = ("list", "part", "turn")
    near = asked.select(*keys, "query_id", "query").groupBy(*keys).cogroup(stored.select(*keys, "vec_id", "embedding").groupBy(*keys)).applyInArrow(_scan(k), "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(by).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
