"""Alignment, best-fit packing and the divergence audit against plain versions, with edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenpep.llm import alignment, ann, best_fit, divergence, packing, token_files, tokens

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "  ", "a", "x ", " x  y ", "<|endoftext|> x <s> </s> <unk> <0x41>", "▁x y", "ﬁ ½ 　 é é", "日本語 テキスト", "\x00\x01 \x85 \xa0 a", "\n\n  \t x \n", "😀😀 a😀", "a" * 3000, " " * 500 + "x" + " " * 500, "\r\n", "مرحبا  بالعالم", "same text", "same text"]


def odd(spark, columns="doc_id long, text string"):
    return spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(ODD)], columns)


def plain_alignment(docs):
    """doc_id -> all columns, by walking both lists of tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model, b_model = Tokenizer.from_file(tokens.public("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=tokens.public("piece_bpe_32k.model"))
    a_model.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    piece = lambda i: bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
    found, links, counts = {}, defaultdict(list), Counter()
    for doc, text in docs:
        found[doc] = (0, 0, 0, "")
        a = [(i, bytes(shown[c] for c in a_model.id_to_token(i))) for i in a_model.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(i, piece(i)) for i in b_model.encode(text)] if text else []
        whole = f" {text}".encode()
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            continue
        spans = [_spans([x for _, x in side]) for side in (a, b)]
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        sides = [defaultdict(list), defaultdict(list)]
        for ids, at, side in ((a, spans[0], sides[0]), (b, spans[1], sides[1])):
            nth = 0
            for (i, _), (_, e) in zip(ids, at, strict=True):
                side[nth].append(str(i))
                nth += e == ends[nth]
        low = 0
        for (i, _), (s, e) in zip(a, spans[0], strict=True):
            while spans[1][low][1] <= s:
                low += 1
            j = low
            while j < len(b) and spans[1][j][0] < e:
                links[doc].append((i, b[j][0]))
                j += 1
        counts.update(set(links[doc]))
        text = ";".join(f"{','.join(sides[0][k])}|{','.join(sides[1][k])}" for k in range(len(ends)))
        found[doc] = (len(a), len(b), len(ends), text)
    top = defaultdict(int)
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    return {d: (*row[:3], len(links[d]), row[3], sum(counts[p] == top[p[0]] for p in links[d]), sum(counts[p] for p in links[d])) for d, row in found.items()}


def _spans(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def test_alignment_gives_what_a_walk_over_all_tokens_gives(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(odd(spark)).repartition(3)
    docs = docs.withColumn("chunk", F.lit("x")).withColumn("pairs", F.lit(1)).withColumn("groups", F.lit(0.5))
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(docs, most=100_000).collect()}
    assert got == plain_alignment([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_alignment_takes_null_and_equal_ids_very_long_texts_and_no_rows(spark):
    long = "word 日本 " * 120_000
    docs = spark.createDataFrame([(None, "one two"), (None, "one two"), (7, "one"), (7, None), (8, long)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_a"], r["n_links"], r["groups"]) for r in alignment.align(docs, groups=lambda g: F.substring(g, 1, 9)).collect()), key=repr)
    assert [r[:3] for r in got if r[0] is None] == [(None, 2, 2)] * 2 and (7, 0, 0, "") in got
    assert next(r[1] for r in got if r[0] == 8) == len(alignment.ByteLevel(tokens.public("byte_bpe_50k.json")).encode(long))
    assert alignment.align(docs.limit(0)).collect() == []


def test_parts_of_a_long_text_give_the_model_s_own_ids():
    random.seed(3)
    texts = [t for t in ODD if t] + ["".join(random.choice(["  ", " ", "a", "B", "é", "\n", "▁", "the", "ing", "日", "0", ".", "'"]) for _ in range(60)) for _ in range(400)]
    for part in (1, 7):
        one = alignment.Pieces(tokens.public("piece_bpe_32k.model"), part=part)
        assert one.cut is not None
        assert [one.encode(t).tolist() for t in texts] == [one.model.encode(t) for t in texts]


def test_boundaries_are_the_common_ends():
    random.seed(4)
    for _ in range(300):
        n = random.randint(1, 40)
        ends = [np.array(sorted({*random.sample(range(1, n + 1), random.randint(0, n)), n})) for _ in range(2)]
        first, last = alignment.overlaps(*ends)
        of_a, of_b = alignment.grouped(first, last, len(ends[1]))
        common = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        for group, e in ((of_a, ends[0]), (of_b, ends[1])):
            assert group.tolist() == [sum(c < x for c in common) for x in e.tolist()]


def plain_best_fit(histogram, capacity):
    """Space left of each sequence."""
    space = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            best = min((s for s in range(len(space)) if space[s] >= length), key=lambda s: space[s], default=None)
            if best is None:
                space.append(capacity - length)
            else:
                space[best] -= length
    return sorted(space)


def test_the_plan_over_counts_is_best_fit_over_pieces():
    random.seed(5)
    for _ in range(300):
        capacity = random.choice([5, 10, 17, 64])
        h = {random.randint(1, capacity): random.randint(1, 30) for _ in range(random.randint(1, capacity))}
        rows, held = best_fit.plan(h, capacity), defaultdict(list)
        for i, (length, rank, each, first, offset) in enumerate(rows.tolist()):
            end = rows[i + 1][1] if i + 1 < len(rows) and rows[i + 1][0] == length else h[length]
            for k in range(end - rank):
                held[first + k // each].append((offset + k % each * length, length))
        for v in held.values():
            at = 0
            for offset, length in sorted(v):
                assert offset == at
                at += length
        assert sum(map(len, held.values())) == sum(h.values())
        assert sorted(capacity - sum(n for _, n in v) for v in held.values()) == plain_best_fit(h, capacity)
    many = best_fit.plan(dict.fromkeys(range(1, 2049), 10**9 + 7), 2048)
    assert len(many) < 20_000
    assert best_fit.plan({}, 2048).shape == (0, 5)


@pytest.mark.parametrize("capacity", [2048, 100])
def test_best_fit_packing_of_whole_documents(spark, capacity):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(odd(spark)).repartition(3).withColumn("length", F.lit("x")).withColumn("task", F.lit("y"))
    got = best_fit.pack(docs, capacity=capacity).collect()
    encoder, pieces = tokens.encoder(tokens.public("byte_bpe_50k.json")), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    histogram = Counter()
    for r in docs.collect():
        ids = [*np.frombuffer(next(iter(encoder.encode([r["text"] or ""]))), dtype="<u4").tolist(), 0]
        own = sorted(pieces.pop(r["doc_id"]), key=lambda p: p["piece"])
        assert [p["piece"] for p in own] == list(range(len(own))) and sum(p["length"] for p in own) == len(ids)
        assert all(p["length"] == capacity for p in own[1:]) and (len(ids) > capacity or len(own) == 1)
        at = 0
        for p in own:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], dtype="<u4").tobytes())
            at += p["length"]
            histogram[p["length"]] += 1
    assert not pieces
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for v in held.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in v) for v in held.values()) == plain_best_fit(histogram, capacity)
    want = -(-sum(k * n for k, n in histogram.items()) // capacity)
    assert len(held) <= want * 1.03 + 1


def test_best_fit_takes_null_and_equal_ids_very_long_texts_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "a"), (3, None), (3, ""), (4, "x y " * 150_000)], "doc_id long, text string")
    got = best_fit.pack(docs).collect()
    assert sum(r["doc_id"] is None for r in got) == 2 and [r["length"] for r in got if r["doc_id"] == 3] == [1, 1]
    long = sorted((r for r in got if r["doc_id"] == 4), key=lambda r: r["piece"])
    assert len(long) > 100 and {r["length"] for r in long[1:]} == {2048}
    assert best_fit.pack(docs.limit(0)).collect() == []
    assert packing.pack(docs).count() == len(got)


def plain_audit(docs, least, tops):
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))) for lang, source, text in docs]
    groups, docs_of = defaultdict(Counter), defaultdict(Counter)
    for lang, source, w in words:
        groups[lang, source].update(w)
        docs_of[lang].update(set(w))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs_of[lang].items() if n >= least)
        own = {s: {t: c[t] for t in kept} for (x, s), c in groups.items() if x == lang}
        own_all = {t: sum(c[t] for c in own.values()) for t in kept}
        p = lambda c, t: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s, c in own.items():
            pairs = [(sum(f(p(c, t), p(d, t)) for t in kept), o) for o, d in own.items() if o != s]
            terms = [(f(p(c, t), p(own_all, t)), t) for t in kept if c[t] > 0 and p(c, t) > p(own_all, t)]
            for part, rows in (("pair", pairs), ("term", terms)):
                for i, (v, item) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1].encode()))):
                    if part == "pair" or i < tops:
                        out.append((lang, s, part, item, v, i + 1))
    return sorted(out)


@pytest.mark.parametrize(("slab", "block"), [(250_000, 8), (7, 1), (7, 2), (3, 3)])
def test_the_audit_is_the_plain_one_whatever_the_slabs_and_blocks(spark, slab, block):
    random.seed(6)
    vocabulary = ["The", "the", "ÉTÉ", "été", "日本", "x1y", "a_b", "foo", "Bar", "baz", "q", "zebra", "ö", "é"]
    rows = [(random.choice(["en", "de", None, ""]), random.choice([*(f"s{i}" for i in range(9)), None, ""]), " ".join(random.choices(vocabulary, k=random.randint(0, 12)))) for _ in range(400)]
    rows += [("en", "empty", None), ("en", "empty", ""), ("only", "a", "rare words"), ("only", "b", None), ("lone", "x", "one " * 20), ("en", "s1", "the " * 50), ("en", "s1", "the " * 50)]
    docs = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "lang string, source string, text string, n long, slab long, term string").repartition(3)
    got = sorted(tuple(r) for r in divergence.audit(docs, slab=slab, block=block).collect())
    assert got == plain_audit(rows, 10, 10)


def test_the_audit_of_no_rows_is_empty_and_long_texts_are_counted_whole(spark, monkeypatch):
    schema = "lang string, source string, text string"
    assert divergence.audit(spark.createDataFrame([], schema)).collect() == []
    monkeypatch.setattr(divergence, "_PART", 1000)
    data = ("Some words, AND more of them! " * 5000).encode().translate(divergence._SHOWN)
    assert Counter(t for part in divergence._parts(data) for t in part) == Counter(data.split())
    assert max(len(p) for p in divergence._parts(data)) < 300


def test_shares_are_exact_beyond_64_bits():
    counts = [0, 1, 10**10, 10**15, 4 * 10**15]
    total, terms = sum(counts), 5
    assert divergence.share(np.array(counts), total, terms).tolist() == [1 + 10**9 * (c + 2) // (total + 2 * terms) for c in counts]


def test_vectors_come_back_from_their_compressed_form():
    ids, counts = np.array([0, 5, 6, 10**6]), np.array([1, 10**12, 3, 4])
    for got, want in zip(divergence.unpacked(divergence.packed(ids, counts)), (ids, counts), strict=True):
        assert got.tolist() == want.tolist()
    assert [len(x) for x in divergence.unpacked(None)] == [0, 0]


@pytest.mark.parametrize("blocks", [1, 2, 3, 4, 5, 8, 9])
def test_every_two_blocks_meet_once_and_a_block_once_a_round(spark, blocks):
    rows = spark.range(blocks).select("id", F.explode(divergence.schedule(F.col("id"), F.lit(blocks).cast("long"))).alias("to")).select("id", "to.host", "to.round").collect()
    assert sorted(r["id"] for r in rows if r["round"] == 0 and r["id"] == r["host"]) == list(range(blocks))
    met = [r for r in rows if r["round"] > 0]
    assert sorted(tuple(sorted((r["id"], r["host"]))) for r in met) == [(a, b) for a in range(blocks) for b in range(a + 1, blocks)]
    in_round = Counter((r["round"], x) for r in met for x in (r["id"], r["host"]))
    assert all(n == 1 for n in in_round.values())
    assert all(1 <= r["round"] <= (blocks if blocks % 2 else blocks - 1) for r in met)


def test_digest_of_groups_as_the_query_gives_it(spark):
    from lumenpep.llm.queries import op11_alignment

    got = {r["doc_id"]: r["groups_sha256"] for r in op11_alignment(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for doc, row in plain_alignment([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]).items():
        assert got[doc] == (hashlib.sha256(row[4].encode()).hexdigest() if row[4] else "")


@pytest.mark.parametrize("lists", [1, 2, 7, 50, 300])
def test_the_graph_is_walked_at_every_size_and_finds_near_centroids(lists, monkeypatch):
    r = np.random.default_rng(lists)
    unit = lambda n: ann._unit(r.normal(size=(n, 12))).astype(np.float32)
    c, q = unit(lists), unit(200)
    index = ann.Index(c, *ann.neighbour_graph(c), 1.0, 11)
    assert len(index.hubs) <= np.ceil(np.sqrt(lists))
    for most in sorted({1, max(1, lists // 3), lists}):
        found, d = ann.search_centroids(index, q, most)
        best = np.argsort(-(q @ c.T), axis=1)[:, :most]
        assert found.shape == (200, most) and all(len(set(row)) == most for row in found.tolist()) and (np.diff(d, axis=1) >= 0).all()
        assert np.mean([len(set(a) & set(b)) / most for a, b in zip(found.tolist(), best.tolist(), strict=True)]) > 0.93
    alone = index._replace(graph=np.zeros((lists, 1), dtype=np.int64))  # leads nowhere: all are compared
    want = max(1, lists - 1)
    assert (np.sort(ann.search_centroids(alone, q, want)[0], axis=1) >= 0).all()


def test_shards_grow_in_number_with_the_table(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 20).alias("text"), F.lit("x").alias("start"), F.lit(1).alias("ids"))
    few, many = token_files.write(docs), token_files.write(docs, per_shard=2000)
    assert few.count() <= 4 and 20 <= many.count() <= 60 and many.agg(F.max("documents")).head()[0] < 40
    assert sorted(map(tuple, token_files.read(few).collect())) == sorted(map(tuple, token_files.read(many).collect()))
    assert token_files.write(docs.limit(0)).count() == 0
