"""Windows that meet as numbers of places, against a plain version."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lumenpep.functions.alleles import RESIDUES
from lumenpep.functions.hashes import md5_first
from lumenpep.operators import peptides, places, similarity
from lumenpep.queries import QUERIES


def found(text, lengths):
    return [text[i : i + k] for k in lengths for i in range(len(text or "") - k + 1) if set(text[i : i + k]) <= set(RESIDUES)]


def drawn(seed, n):
    r = np.random.default_rng(seed)
    return ["".join(r.choice(list("ACDEX"), k, p=[0.3, 0.3, 0.2, 0.17, 0.03])) for k in r.integers(0, 60, n)]


LEFT = [(None if i % 40 == 3 else i, x) for i, x in enumerate(drawn(3, 400))] + [(900, None), (901, ""), (902, "A" * 3000), (903, "ACDÉFGHIKLMNPQRSTVWYß"), (None, "WYWYWYWYWYWY"), (904, "acdefghiklmnp")]
RIGHT = [*drawn(4, 100), None, "", "A" * 50]


def plain(lengths):
    """n, first, last and count by window."""
    rows, out = {}, Counter(x for text in RIGHT for x in found(text, lengths))
    for i, (key, text) in enumerate(LEFT):
        for x in found(text, lengths):
            rows.setdefault(x, {})[i] = key
    ends = lambda f, keys: f((k for k in keys if k is not None), default=None)
    return {x: (len(v), ends(min, v.values()), ends(max, v.values()), out[x]) for x, v in rows.items()}


@pytest.mark.parametrize("lengths", [(8, 9, 10, 11), (3, 8), (1, 2, 5, 12), (4,)])
def test_places_of_several_portions_meet(lengths):
    shape = places.Shape(lengths)
    assert shape.fits()
    left = pa.record_batch([pa.array([k for k, _ in LEFT], pa.int64()), pa.array([x for _, x in LEFT])], names=["transcript", "seq"])
    right = pa.record_batch([pa.array(RIGHT)], names=["seq"])
    sent = [*places._sender(shape, False, True, True, 5, 0, held=300)(iter([left.slice(0, 250), left.slice(250)])), *places._sender(shape, False, False, False, 5, 1, held=300)(iter([right]))]
    rows = pa.Table.from_batches(sent)
    want, names = plain(lengths), ("n", "first", "last", "count")
    for without in (False, True):
        got = [r for b in range(5) for r in places._meeting(shape, True, names, without)(rows.filter(pa.compute.equal(rows["bucket"], b))).to_pylist()]
        assert len({r["peptide"] for r in got}) == len(got)
        assert {r["peptide"]: tuple(r[c] for c in names) for r in got} == {x: v for x, v in want.items() if not (without and v[3])}


@pytest.mark.parametrize("lengths", [(8, 9, 10, 11), (8, 13)])  # the latter fit no number
def test_operators_equal_a_plain_version(spark, lengths):
    left, right = spark.createDataFrame(LEFT, "transcript long, seq string"), spark.createDataFrame([(x,) for x in RIGHT], "seq string")
    want = plain(lengths)
    assert {tuple(r) for r in peptides.counted(left, lengths).collect()} == {(x, *v[:3]) for x, v in want.items()}
    assert {tuple(r) for r in peptides.counted_novel(left, right, lengths).collect()} == {(x, v[0]) for x, v in want.items() if not v[3]}
    assert {tuple(r) for r in peptides.occurrences_of_windows(left, right, lengths).collect()} == {(x, v[3]) for x, v in want.items()}


def test_keys_that_are_no_numbers(spark):
    of = spark.createDataFrame([("b", "ACDEFGHI"), ("a", "ACDEFGHI")], "transcript string, seq string")
    assert [tuple(r) for r in peptides.counted(of).collect()] == [("ACDEFGHI", 2, "a", "b")]


def test_letters_of_texts(spark):
    texts = [(1, "A c-dée f\n1gHiıkl"), (2, "acdOefghikl"), (3, None), (4, "ÅK")]
    of = spark.createDataFrame(texts, "transcript long, seq string")
    want = sorted(map(tuple, peptides.transcript_counts(peptides.windows(peptides.letters(of))).collect()))
    assert want and sorted(map(tuple, peptides.counted(of, text=True).collect())) == want


@pytest.mark.parametrize("name", ["kmer_novel", "kmer_transcripts", "expression_counts", "similarity_documents"])
def test_no_window_is_shuffled_as_a_row(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(bucket" in plan and "hashpartitioning(peptide" not in plan


def test_a_place_takes_few_bytes_of_a_shuffle():
    texts = ["".join(x) for x in np.random.default_rng(5).choice(list(RESIDUES), (300, 1000))]
    batch = pa.record_batch([pa.array(range(300)), pa.array(texts)], names=["transcript", "seq"])
    sent = [b for x in places._sender(places.Shape((8, 9, 10, 11)), False, True, True, 8, 0)(iter([batch])) for b in x["data"].to_pylist()]
    assert sum(map(len, sent)) < 10 * 300 * 993  # about 37 for each of four windows as a row


@pytest.mark.parametrize("size", [0, 3, 4, 11, 17, 55])
def test_md5_of_many(size):
    texts = [bytes(x) for x in np.random.default_rng(size).integers(0, 256, (50, size), dtype=np.uint8)]
    blocks = np.frombuffer(b"".join((t + b"\x80").ljust(56, b"\0") for t in texts), dtype="<u4").reshape(50, 14)
    assert [f"{x:016x}" for x in md5_first([blocks[:, j].copy() for j in range(14)], size)] == [hashlib.md5(t).hexdigest()[:16] for t in texts]


@pytest.mark.parametrize("seed", [42, 7])
@pytest.mark.parametrize("ratios", [{8: 1, 9: 2, 10: 1, 11: 0.5}, {3: 1, 12: 4}, {8: 1, 13: 1}])
def test_quotas_from_one_reading_of_the_sequences(spark, seed, ratios):
    rows = [x for _, x in LEFT] + drawn(8, 300) * 2
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    of = spark.createDataFrame([(x,) for x in rows], "seq string")
    want = peptides.quotas(300, ratios)
    first = lambda k, n: sorted({x for t in rows for x in found(t, (k,))}, key=lambda x: (hashlib.md5(f"{x}|{seed}".encode()).hexdigest(), x))[:n]
    got = sorted(x[0] for x in peptides.sampled_windows(of.mapInArrow(run, "seq string"), 300, ratios, seed).collect())
    assert got == sorted(x for k, n in want.items() for x in first(k, n))
    if 13 not in ratios:
        assert read.value <= 2 * len(rows)  # once for its bytes, once for its windows


def test_portions_of_a_task_keep_the_first_of_all():
    shape, texts = places.Shape((8, 9)), drawn(9, 200)
    batch = pa.record_batch([pa.array(texts)], names=["seq"])
    for want in ({8: 1, 9: 40}, {8: 10**6, 9: 2}):
        got = [x for b in places._smallest(shape, False, want, "|42", held=200)(iter([batch])) for x in b["peptide"].to_pylist()]
        assert sorted(got) == sorted(x for k, n in want.items() for x in sorted({x for t in texts for x in found(t, (k,))}, key=lambda x: hashlib.md5(f"{x}|42".encode()).hexdigest())[:n])


@pytest.mark.parametrize("exclude", [True, False])
def test_windows_are_scored_where_they_meet(spark, exclude):
    r = np.random.default_rng(12)
    words = lambda n: [("".join(r.choice(list("ACDSWYX"), k)),) for k in r.integers(5, 40, n)]
    of, refs = spark.createDataFrame(words(60), "seq string"), spark.createDataFrame(words(12), "seq string")
    lengths = (3, 8, 9, 40)  # of 40 there are no references, and numbers hold 12 residues
    with pytest.raises(ValueError):
        similarity.similarity_of_windows(of, refs, lengths)
    lengths = (3, 8, 9, 12)
    one, two = (places.met(x, lengths=lengths) for x in (of, refs))
    want = {tuple(x) for x in similarity.similarity(one, two.withColumnRenamed("peptide", "seq"), exclude, counts=True).select("peptide", "similarity", "pairs").collect()}
    for most in (10**6, 5):  # the latter sends no references to tasks
        got = similarity.similarity_of_windows(of, refs, lengths, exclude_identity=exclude, counts=True, most=most).select("peptide", "similarity", "pairs").collect()
        assert len(got) == len(want) > 500 and {tuple(x) for x in got} == want


@pytest.mark.parametrize("most", [2_000_000, 60])
def test_peptides_share_what_they_have_in_common(most):
    r = np.random.default_rng(1)
    refs, rows = (np.unique(r.integers(0, 20, (n, 5)), axis=0) for n in (200, 300))
    among = similarity.References(refs)
    rows = rows[:, among.order].astype(np.uint8)
    rows = rows[similarity._in_order(rows)]
    raw, own, _ = among.best(rows, False, block=64, most=most)
    b, w = similarity.matrix(), np.array(similarity.weights(5))[among.order]
    assert (raw == [max((w * b[x, q]).sum() for q in refs[:, among.order]) for x in rows]).all() and (own == [(w * b[x, x]).sum() for x in rows]).all()
