import hashlib
import time

import numpy as np
import pytest

from lumenpep.functions.alleles import RESIDUES
from lumenpep.operators import peptides
from lumenpep.operators.windows import cut, marks


def plain(rows, lengths, distinct, standard=True):
    out = []
    for key, text in rows:
        for k in lengths:
            found = [text[i : i + k] for i in range(len(text or "") - k + 1)]
            found = [x for x in found if not standard or set(x) <= set(RESIDUES)]
            out += [(key, x) for x in (dict.fromkeys(found) if distinct else found)]
    return sorted(out, key=str)


@pytest.mark.parametrize("distinct", [True, False])
@pytest.mark.parametrize("standard", [True, False])
def test_windows_equal_a_plain_version(spark, distinct, standard):
    r = np.random.default_rng(3)
    rows = [(i, "".join(r.choice(list("ACDEX"), n, p=[0.3, 0.3, 0.2, 0.17, 0.03]))) for i, n in enumerate(r.integers(0, 90, 700))]
    rows += [(-1, None), (-2, ""), (None, "ACDEFGHIKLMNPQ"), (-3, "ACDÉFGHIKLMNPQRSTVWYß"), (-4, "A" * 3000), (-5, "acdefghikl")]
    of = spark.createDataFrame(rows, "transcript long, seq string").coalesce(1)
    lengths = (3, 8, 11, 12, 14)
    got = cut(of, lengths, distinct, standard).select("transcript", "peptide").collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, lengths, distinct, standard)


def test_a_long_sequence_takes_time_in_proportion(spark):
    text = "".join(np.random.default_rng(1).choice(list(RESIDUES), 300_000))
    start = time.time()
    assert peptides.windows(spark.createDataFrame([("a", text)], "transcript string, seq string")).count() == sum(len({text[i : i + k] for i in range(len(text) - k + 1)}) for k in (8, 9, 10, 11))
    assert time.time() - start < 60  # minutes when each window is counted off from the sequence's beginning


def test_counts_of_transcripts_without_lists(spark):
    of = spark.createDataFrame([("P", 3), ("P", 1), ("P", 2), ("Q", 7)], "peptide string, transcript long")
    assert {tuple(r) for r in peptides.transcript_counts(of).collect()} == {("P", 3, 1, 3), ("Q", 1, 7, 7)}


def seen(spark, rows):
    """Rows as a table, and a counter of those that were made."""
    counter = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            counter.add(b.num_rows)
            yield b

    return spark.createDataFrame([(x,) for x in rows], "peptide string").mapInArrow(run, "peptide string"), counter


def test_many_peptides_meet_reads_in_one_shuffle(spark):
    rows = ["AAA", "CCC", "AAA", "XÉX", None]
    of, made = seen(spark, rows)
    reads = spark.createDataFrame([("AAAAA",), ("XÉXÉX",), (None,)], "seq string")
    assert {tuple(r) for r in peptides.occurrences(of, reads, (3,), most=0).collect()} == {("AAA", 3), ("CCC", 0), ("XÉX", 2), (None, 0)}
    assert made.value == len(rows)


@pytest.mark.parametrize("repeats", [1, 40])
def test_quotas_from_small_hashes(spark, repeats):
    r = np.random.default_rng(2)
    words = ["".join(r.choice(list("ACDEFGHIKL"), k)) for k in (8, 9, 10, 11) for _ in range(1500)]
    rows = words + words[:20] * (repeats * 100)  # few of a length's rows differ: the first bound leaves too few
    of, made = seen(spark, rows)
    want = peptides.quotas(40, {8: 1, 9: 2, 10: 1, 11: 0.5})
    md5 = lambda x: (hashlib.md5(f"{x}|42".encode()).hexdigest(), x)
    assert sorted(x[0] for x in peptides.sampled(of, 40, {8: 1, 9: 2, 10: 1, 11: 0.5}).collect()) == sorted(x for k, n in want.items() for x in sorted({w for w in words if len(w) == k}, key=md5)[:n])
    assert made.value <= (2 if repeats == 1 else 3) * len(rows)


def test_windows_of_reads_that_no_peptide_is_are_not_made(spark):
    r = np.random.default_rng(6)
    reads = ["".join(r.choice(list(RESIDUES), 400)) for _ in range(50)]
    wanted = sorted({x[i : i + k] for x in reads[:3] for k in (8, 9, 12) for i in (0, 50, 388)})
    of, texts = spark.createDataFrame([(x,) for x in wanted], "peptide string"), spark.createDataFrame([(x,) for x in reads], "seq string")
    made = [x[0] for x in cut(texts, (8, 9, 12), distinct=False, marked=marks(wanted)).collect()]
    assert set(wanted) <= set(made) and len(made) < 2000  # of 58,500 or so
    assert marks(["ACDEFGHIKLMNP"]) is None
    assert {tuple(x) for x in peptides.occurrences(of, texts, (8, 9, 12)).collect()} == {(w, sum(x.startswith(w, i) for x in reads for i in range(400))) for w in wanted}
