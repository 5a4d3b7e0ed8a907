"""Figures that must not grow faster than the table."""

from __future__ import annotations

import numpy as np
import pytest

from lumenpep.llm import ngram_join, tokens


def near_misses(spark, m: int):
    """m texts in 16 classes: links within a class, a Jaccard index of 0.78 between any two."""
    rows = []
    for i in range(m):
        words = [f"base{w}" for w in range(250)]
        for turn in range(3):
            words[5 * (3 * (i % 16) + turn) + 4] = f"own{i}x{turn}"
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_near_misses_make_no_pair_each(spark, monkeypatch):
    made = []
    links, grown = ngram_join.Verifier.links, ngram_join._grown
    monkeypatch.setattr(ngram_join.Verifier, "links", lambda self, pairs: made.append(pairs.count()) or links(self, pairs))
    monkeypatch.setattr(ngram_join, "_grown", lambda labels, found: made.append(found.count()) or grown(labels, found))
    counts = []
    for m in (48, 192):
        made.clear()
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(near_misses(spark, m), block=64).collect()}
        assert got == {i: i % 16 for i in range(m)}
        counts.append(max(made[1:]))  # after the first round
    assert counts[1] <= 6 * counts[0]


@pytest.mark.parametrize("shingles", [1 << 21, 500])
def test_last_round_without_others(spark, monkeypatch, shingles):
    monkeypatch.setattr(ngram_join, "SHINGLES", shingles)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(near_misses(spark, 40), block=7, turns=0).collect()}
    assert got == {i: i % 16 for i in range(40)}


def test_words_that_come_again_are_kept():
    """320,000 words in 16 texts: the second time none is asked of the model."""
    e = tokens.Encoder(tokens.public("word_bpe_49k.json"))
    ends = [f"{b}{x}{y}{z}" for b in "aeiouyàéèö" for x in "aeiou" for y in "bcdfghjklmnpqrstvwxz" for z in "abcdefghijklmnopqrst"]
    texts = [" ".join(a + end for end in ends) for a in "bcdfghjklmnpqrst"]
    first = list(e.encode(texts))
    e.memo.model = None
    assert list(e.encode(texts)) == first


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cut_and_bytes_as_the_library(name):
    e = tokens.Encoder(tokens.public(name), memo=3)
    for text in ("it's we'll I'm 'd 're've 'x' ''s", "a'sb 's1 12's  'S 'LL", " \t\n x  y \r\n", "\x00\x01a \x1bb ~!", "é'é «l'été» œuvre's", "a" * 300, "-_ '" * 40):
        assert next(e.encode([text])) == np.asarray(e.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
