"""What the rounds of near copies need not move."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa

from lumenpep.llm import ngram_join

#: Seven lines of three points each; any two points share one line.
LINES = [(0, 1, 2), (0, 3, 4), (0, 5, 6), (1, 3, 5), (1, 4, 6), (2, 3, 6), (2, 4, 5)]


def test_whole_sets_of_long_texts_are_read_of_near_misses_only(spark, monkeypatch):
    """Seven texts of about 900 shingles, any two with a Jaccard index of 0.2 and lists of three: small signatures let all pairs pass."""
    texts = [[w for k, line in enumerate(LINES) if i in line for w in (f"line{k}word{x}" for x in range(300))] for i in range(7)]
    for i in (7, 8):
        texts.append(list(texts[0]))
        texts[-1][100 * i - 500] = f"own{i}"
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    read, sets = [], ngram_join.Verifier.sets
    monkeypatch.setattr(ngram_join.Verifier, "sets", lambda self, wanted: read.append(wanted.count()) or sets(self, wanted))
    for turns in (0, 1):
        read.clear()
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(docs, turns=turns).collect()}
        assert got == {**{i: i for i in range(7)}, 7: 0, 8: 0}
        assert len(read) == 2 + turns and max(read) <= 3


def batches(rows: list[tuple[int, ...]], size: int):
    for k in range(0, len(rows), size):
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[k : k + size]], pa.int64() if i < 2 else pa.int32()) for i in range(4)], names=["token", "grp", "n", "pos"])


def fit(x, y) -> bool:
    return min(x[2], y[2]) * 100 >= max(x[2], y[2]) * 80 and min(x[2] - x[3], y[2] - y[3]) * 180 >= 80 * (x[2] + y[2])


def test_entries_that_fit_no_other_stay_behind():
    """Lists of any length, cut anywhere into batches, groups that repeat."""
    assert not list(ngram_join._stars(ngram_join.Rule())(batches([(1, 1, 20, 0), (1, 2, 40, 0), (1, 3, 80, 0), (2, 1, 50, 8), (2, 2, 50, 0)], 2)))
    r = np.random.default_rng(1)
    for trial in range(60):
        rows = []
        for t in range(r.integers(1, 12)):
            for g in r.choice(1000, size=r.integers(1, (3, 9, 40)[trial % 3]), replace=False):
                n = int(r.integers(20, 60))
                rows += [(t, int(g), n, int(r.integers(0, n // 5 + 1)))] * int(r.integers(1, 3))
        rows.sort(key=lambda x: (x[0], x[2], x[1]))
        short, lists, want = int(r.integers(1, 10)), defaultdict(list), []
        for x in dict.fromkeys(rows):
            lists[x[0]].append(x)
        for of in lists.values():
            pivot = None
            for x in of if len(of) > short else [x for x in of if any(y is not x and fit(x, y) for y in of)]:
                if pivot is None or pivot[2] * 100 < x[2] * 80:
                    pivot = x
                want.append(x + pivot[1:])
        made = ngram_join._stars(ngram_join.Rule(), short)(batches(rows, int(r.integers(1, 15))))
        assert [tuple(x.values()) for b in made for x in b.to_pylist()] == want
