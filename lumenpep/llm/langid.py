"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

Texts are cut into windows of bytes; both directions run over every window, and every position gets probabilities of the
languages from both states. A document's probabilities are the means over the positions that are letters. The network is
trained on the driver by backpropagation through time, on a bounded sample of labelled documents; tasks apply it to whole
texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import only, released, slices, small_batches, values

#: Bytes as the network sees them: A-Z in lower case; digits, punctuation and white space of ASCII as one symbol.
_SEEN = np.array([b + 32 if 65 <= b < 91 else b if 97 <= b < 123 or b >= 128 else 32 for b in range(256)], dtype=np.uint8)


class Net(NamedTuple):
    """wx: (2, 3H, 256) input columns of both directions, gates in the order reset, update, candidate; wh: (2, 3H, H);
    b: (2, H) the candidate's recurrent bias; wo: (L, 2H); bo: (L,). languages: the L labels."""

    wx: np.ndarray
    wh: np.ndarray
    b: np.ndarray
    wo: np.ndarray
    bo: np.ndarray
    languages: tuple[str, ...]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def states(net: Net, seen: np.ndarray, keep: bool = False):
    """seen: (T, B) bytes. States (T, 2, H, B) after reading each byte, in the order of reading: the second direction reads
    from the end. With keep, the gates as well."""
    steps, batch = seen.shape
    hidden = net.wh.shape[2]
    h = np.zeros((2, hidden, batch), dtype=np.float32)
    out = np.empty((steps, 2, hidden, batch), dtype=np.float32)
    gates = []
    x = np.empty((2, 3 * hidden, batch), dtype=np.float32)
    for t in range(steps):
        np.take(net.wx[0], seen[t], axis=1, out=x[0], mode="clip")
        np.take(net.wx[1], seen[steps - 1 - t], axis=1, out=x[1], mode="clip")
        u = net.wh @ h
        rz = x[:, : 2 * hidden]
        rz += u[:, : 2 * hidden]
        rz *= 0.5
        np.tanh(rz, out=rz)
        rz *= 0.5
        rz += 0.5
        r, z = rz[:, :hidden], rz[:, hidden:]
        un = u[:, 2 * hidden :]
        un += net.b[:, :, None]
        n = x[:, 2 * hidden :]
        n += r * un
        np.tanh(n, out=n)
        if keep:
            gates.append((r.copy(), z.copy(), n.copy(), un.copy()))
        h = n + z * (h - n)
        out[t] = h
    return (out, gates) if keep else out


def position_probabilities(net: Net, seen: np.ndarray) -> np.ndarray:
    """(T, L, B): the probabilities of each language at each position."""
    out = states(net, seen)
    hidden = out.shape[2]
    logits = net.wo[:, :hidden] @ out[:, 0] + net.wo[:, hidden:] @ out[::-1, 1] + net.bo[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def gradients(net: Net, seen: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over all positions of windows (T, B) with labels (B,), and its gradients by wx, wh, b, wo, bo."""
    steps, batch = seen.shape
    hidden = net.wh.shape[2]
    out, gates = states(net, seen, keep=True)
    both = np.concatenate((out[:, 0], out[::-1, 1]), axis=1)  # (T, 2H, B)
    logits = net.wo @ both + net.bo[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    own = p[:, label, np.arange(batch)]
    loss = float(-np.log(own + 1e-9).mean())
    p[:, label, np.arange(batch)] -= 1
    p /= steps * batch
    g_wo, g_bo = np.einsum("tlb,thb->lh", p, both), p.sum(axis=(0, 2))
    g_both = net.wo.T @ p
    g_out = np.stack((g_both[:, :hidden], g_both[::-1, hidden:]), axis=1)  # in the order of reading
    g_wx, g_wh, g_b = np.zeros_like(net.wx), np.zeros_like(net.wh), np.zeros_like(net.b)
    g_h = np.zeros((2, hidden, batch), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        r, z, n, un = gates[t]
        before = out[t - 1] if t else np.zeros_like(g_h)
        g_h = g_h + g_out[t]
        g_n = g_h * (1 - z) * (1 - n * n)
        g_z = g_h * (before - n) * z * (1 - z)
        g_r = g_n * un * r * (1 - r)
        g_x = np.concatenate((g_r, g_z, g_n), axis=1)
        g_u = np.concatenate((g_r, g_z, g_n * r), axis=1)
        g_wh += g_u @ before.transpose(0, 2, 1)
        g_b += g_u[:, 2 * hidden :].sum(axis=2)
        for d, row in ((0, seen[t]), (1, seen[steps - 1 - t])):
            np.add.at(g_wx[d].T, row, g_x[d].T)
        g_h = g_h * z + net.wh.transpose(0, 2, 1) @ g_u
    return loss, [g_wx, g_wh, g_b, g_wo, g_bo]


def train(texts: list[bytes], labels: list[str], hidden: int = 8, steps: int = 96, batch: int = 128, updates: int = 500, rate: float = 0.02, seed: int = 3) -> Net:
    """Adam on windows drawn from the texts, as many of each language. The seed fixes the result."""
    r = np.random.default_rng(seed)
    languages = tuple(sorted(set(labels)))
    one = lambda *shape: (r.standard_normal(shape) * 0.3).astype(np.float32)
    net = Net(one(2, 3 * hidden, 256), one(2, 3 * hidden, hidden), np.zeros((2, hidden), np.float32), one(len(languages), 2 * hidden), np.zeros(len(languages), np.float32), languages)
    by = [[_windows(t, steps)[0] for t, x in zip(texts, labels, strict=True) if x == language and t] for language in languages]
    pools = [np.concatenate(w, axis=0) if w else np.full((1, steps), 32, np.uint8) for w in by]
    params = list(net[:5])
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for k in range(1, updates + 1):
        label = r.integers(len(languages), size=batch)
        seen = np.stack([pools[x][r.integers(len(pools[x]))] for x in label], axis=1)
        _, grads = gradients(Net(*params, languages), seen, label)
        norm = max(1.0, float(np.sqrt(sum((g * g).sum() for g in grads))))
        now = rate * (1 - k / (updates + 1))
        for i, g in enumerate(grads):
            g = g / norm
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            params[i] = (params[i] - now * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
    return Net(*params, languages)


def _windows(text: bytes, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """The whole text as windows (n, steps) of bytes as seen, blanks after its end, and which positions are letters."""
    seen = _SEEN[np.frombuffer(text, dtype=np.uint8)]
    keep = np.ones(len(seen), dtype=bool)
    keep[1:] = (seen[1:] != 32) | (seen[:-1] != 32)  # runs of blanks are one
    seen = seen[keep]
    n = -(-len(seen) // steps)
    out = np.full(n * steps, 32, dtype=np.uint8)
    out[: len(seen)] = seen
    out = out.reshape(n, steps)
    return out, out != 32


def _apply(net: Net, steps: int, block: int):
    names = ["doc_id", "lang_pred", "score"]

    def flush(docs: list, windows: list[np.ndarray], letters: list[np.ndarray]) -> pa.RecordBatch:
        total = np.zeros((len(docs), len(net.languages)))
        count = np.zeros(len(docs))
        if windows:
            of = np.repeat(np.arange(len(docs)), [len(w) for w in windows])
            seen, real = np.concatenate(windows), np.concatenate(letters)
            for low in range(0, len(seen), 2048):
                part = slice(low, low + 2048)
                p = position_probabilities(net, np.ascontiguousarray(seen[part].T))
                mask = real[part].T.astype(np.float32)
                pooled = np.einsum("tlb,tb->bl", p, mask)
                np.add.at(total, of[part], pooled)
                np.add.at(count, of[part], mask.sum(axis=0))
        best = total.argmax(axis=1)
        score = total[np.arange(len(docs)), best] / np.maximum(count, 1)
        known = count > 0
        langs = [net.languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(langs), pa.array(np.where(known, np.clip(score, 0, 1), 0.0))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, windows, letters, size = [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), values(batch, 1), strict=True):
                w, k = _windows((text or "").encode("utf-8"), steps)
                if not text or not any(map(str.isalpha, text)):
                    k = np.zeros_like(k)
                docs.append(doc)
                windows.append(w)
                letters.append(k)
                size += w.size
                if size > block or len(docs) >= 10_000:
                    yield flush(docs, windows, letters)
                    docs, windows, letters, size = [], [], [], 0
        if docs:
            yield flush(docs, windows, letters)

    return run


def held_out() -> Column:
    return (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4) == 2


def sample(docs: DataFrame, each: int = 300, longest: int = 20_000, labels: int = 200) -> tuple[list[bytes], list[str]]:
    """Training texts: of each of the `labels` most common languages `each` different texts at most, those with the smallest
    hash among documents that are not held out and have at most `longest` characters. The bounds keep training on the driver
    within fixed memory. Hashes beyond about twice what a language needs are left out before anything is sorted, and
    repeated rows are one before they meet, so no common language or row fills a task."""
    fit = only(docs, "doc_id", "text", "lang").filter(F.col("lang").isNotNull() & ~held_out() & F.length("text").between(1, longest))
    counts = fit.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(labels).collect()
    if not counts:
        return [], []
    span = 1 << 40
    limit = F.element_at(F.create_map(*(F.lit(v) for r in counts for v in (r["lang"], min(span, span * 2 * each // r["count"] + 1)))), F.col("lang"))
    few = fit.select("text", "lang", F.pmod(F.xxhash64(F.lit("language sample"), "doc_id", "text"), F.lit(span)).alias("h")).filter(F.col("h") < limit)
    few = few.groupBy("lang", "h").agg(F.min("text").alias("text"))
    rows = few.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("nth") <= each).select("text", "lang").collect()  # each * labels rows
    rows.sort(key=lambda r: (r["lang"], r["text"]))
    return [r["text"].encode("utf-8") for r in rows], [r["lang"] for r in rows]


def identify(docs: DataFrame, net: Net | None = None, steps: int = 96, block: int = 1_500_000, **options) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, lang_pred, score.

    docs: doc_id, text, and lang where no net is given. held_out: crc32 of doc_id as text, modulo 4, is 2; such documents
    are never learned from. lang_pred is `und` with score 0 for a null text or one without a letter, and for all texts
    where no document has a label. Otherwise it is a label, and score its mean probability over the text's letters. Rows
    without doc_id, repeated rows and extra columns change nothing. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    if net is None:
        texts, labels = sample(docs)
        net = train(texts, labels, steps=steps, **options) if texts else None
    of = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if net is None:
        out = of.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        out = of.mapInArrow(released(_apply(net, steps, block)), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, least: float = 0.4, net: Net | None = None, steps: int = 96, block: int = 1_500_000) -> DataFrame:
    """The rows of docs (doc_id, text, lang, and any others) with a language of score `least` or more.

    Rows keep all their columns, whatever their names, and pass through the network's tasks whole, so nothing is shuffled or
    joined by doc_id. Null and empty texts and those without a letter go. Where no document has a label, nothing can be
    learned, and all texts with a letter stay. Repeated rows are judged each; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    if net is None:
        texts, labels = sample(docs)
        net = train(texts, labels, steps=steps) if texts else None
    names, at = docs.columns, docs.columns.index("text")
    judge = _apply(net, steps, block) if net else _lettered

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at, rows=4000):
                one = pa.RecordBatch.from_arrays([pa.array(range(part.num_rows), pa.int64()), part.column(at)], names=["doc_id", "text"])
                score = np.concatenate([b.column(2).to_numpy(zero_copy_only=False) for b in judge(iter([one]))])
                yield part.filter(pa.array(score >= least))

    return docs.toDF(*(f"c{i}" for i in range(len(names)))).mapInArrow(released(run), _renamed(docs.schema)).toDF(*names)


def _lettered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Score 1 for texts with a letter."""
    for batch in batches:
        score = [float(any(map(str.isalpha, t or ""))) for t in values(batch, 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(["und"] * len(score)), pa.array(score)], names=["doc_id", "lang_pred", "score"])


def _renamed(schema: StructType) -> StructType:
    """Columns by place, as names may clash."""
    return StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])
