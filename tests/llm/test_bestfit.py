import random
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from streammetrics.llm import bestfit as B
from streammetrics.llm.common import table


def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(B.default_tokenizer())


def encoded(coder, texts):
    ids, bounds = coder.batch(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def check(docs, pieces, window=B.WINDOW):
    """Every id in one piece, only long documents cut, gapless sequences that fit; returns (sequences, least possible)."""
    tok = tokenizer()
    want = []
    for d, text in docs:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), window)):
            part = ids[at:at + window]
            want.append((d, k, at, len(part), zlib.crc32(part.tobytes())))
    got = [tuple(r)[:5] for r in pieces]
    assert sorted(got, key=str) == sorted(want, key=str)
    sequences = {}
    for r in pieces:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences), -(-sum(w[3] for w in want) // window)


def test_encoding_by_words_equals_whole():
    coder, tok = B.WordEncoder(B.default_tokenizer()), tokenizer()
    texts = ["", " ", "  ", "a", " a ", "It's  don't we'll 's ''s", "word, (word) [word]... «word»", "a\x1cb \x1d", "İstanbul ŉ",
             "<|endoftext|> x<|endoftext|>y <|endoftext|", "é ́x", "ΣΑΣ ΣΑΣ.", "日本語 12ab 3.5%", "a\xa0b c​d",
             "ǅ ß ẞ K", "-- -a- --b", "x" * 5000, "'tis 'twas o'clock, 'S", "a|b <| |> <|a", "ªº µ"]
    rng = random.Random(4)
    parts = [" ", " ", "\n", "a", "Bc", ".", ",", "'s", "'", "é", "É", "12", "\t", "　", "!?", "<|endoftext|>", "<|", "|>", "the",
             "ß", "İ", "́", "\x1e", "\x85", "ſ", "Ω", "日"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    for limit in (B.WordEncoder.LIMIT, 50, 3):
        coder.LIMIT = limit
        for at in range(0, len(texts), 100):
            for t, got, ids in zip(texts[at:at + 100], encoded(coder, texts[at:at + 100]), want[at:at + 100]):
                assert got == ids, repr(t)


def test_latin_letters_are_words_of_their_own():
    coder, tok = B.WordEncoder(B.default_tokenizer()), tokenizer()
    letters = [chr(c) for c in range(0x21, 0x250)]
    texts = [f"{c} x{c} {c}x x{c}x ({c})" for c in letters]
    for t, got in zip(texts, encoded(coder, texts)):
        assert got == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"i": list(range(7)), "t": ["a" * 10, None, "é" * 30, "", "b" * 99, "c", "d"]})
    for size in (1, 20, 1000):
        got = [(i, t) for ids, texts in B.slices(iter([batch, batch.slice(0, 0)]), size) for i, t in zip(ids, texts.to_pylist())]
        assert got == list(zip(*batch.to_pydict().values()))


def test_pricing_equals_all_fillings():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = 9
        weights = np.where(rng.random(n + 1) < 0.5, rng.random(n + 1), 0.0)
        weights[0] = 0
        best = max(sum(m * weights[b] for b, m in enumerate(c, 1)) for c in product(*[range(n // b + 1) for b in range(1, n + 1)])
                   if sum(m * b for b, m in enumerate(c, 1)) <= n)
        found = B.price(weights)
        if best == 0:
            assert not found
            continue
        value = [sum(m * weights[b] for b, m in c) for c in found]
        assert value[0] == pytest.approx(best) and min(value) >= B.NEAR * best - 1e-12
        assert all(sum(b * m for b, m in c) <= n for c in found)


def test_solution_covers_and_is_near_the_least():
    rng = np.random.default_rng(2)
    histogram = {int(b): int(n) for b, n in zip(rng.permutation(np.arange(5, 101))[:40], rng.integers(50, 500, 40))}
    use = B.solve(histogram, 100)
    least = sum(b * n for b, n in histogram.items()) / 100
    cover = {b: sum(x * dict(c).get(b, 0) for c, x in use.items()) for b in histogram}
    short = sum(max(n - cover[b], 0) * b for b, n in histogram.items())
    assert short <= (1 - B.COVERED) * least * 100 + 1e-6
    assert all(sum(b * m for b, m in c) <= 100 for c in use)
    assert sum(use.values()) <= 1.2 * least


def test_plan_gives_each_rank_its_own_slot():
    rng = np.random.default_rng(3)
    histogram = {int(b): int(n) for b, n in zip(range(3, 60), rng.integers(100, 900, 57))}
    runs, taken = B.plan(histogram, 64)
    places, fill = set(), {}
    for b, rs in runs.items():
        for (first, m, seq, slot), end in zip(rs, [r[0] for r in rs[1:]] + [taken[b]]):
            for r in range(first, end):
                s = seq + (r - first) // m
                places.add((s, slot + (r - first) % m))
                fill[s] = fill.get(s, 0) + b
    assert len(places) == sum(taken.values()) > 0.5 * sum(histogram.values())     # half the pieces are longer than half a window
    assert max(fill.values()) <= 64 and len(fill) <= 1.3 * sum(b * n for b, n in taken.items()) / 64


def test_best_fit_takes_the_fullest_sequence():
    assert B.best_fit([6, 5, 4, 3, 2], 10) == ([0, 1, 0, 1, 1], [0, 0, 6, 5, 8])


def test_documents_round_trip(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    used, least = check(docs, B.op11_best_fit_packing(spark, sf_dir).collect())
    assert used <= least * 1.02 + 1


def test_many_groups_and_unusual_rows(spark):
    rng = random.Random(6)
    rows = [(i, "some words of text " * rng.randint(0, 60), "a", 0) for i in range(1500)]
    rows += [(5000, None, "b", 0), (5001, "", "b", 0), (None, "no id", "b", 0), (7, rows[7][1], "a", 0),
             (5002, "long " * 50_000, "c", 0), (5003, "word " * 4095, "c", 0), (5004, "word " * 4096, "c", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, length int")      # clashing columns
    for group in (B.GROUP, 200):
        pieces = B.pack(docs, group=group).collect()
        used, least = check([(r[0], r[1]) for r in rows], pieces)
        assert used <= least * 1.03 + (1 if group == B.GROUP else 8)
        assert {0, 1, 2} >= {r["sequence_id"] % 3 for r in pieces} >= {1, 2}
    whole = [r for r in pieces if r["doc_id"] == 5003]
    assert [(r["piece"], r["length"], r["offset"]) for r in whole] == [(0, 4096, 0)]
    empty = B.pack(docs.limit(0))
    assert empty.count() == 0
    assert empty.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_configurations_are_used(spark):
    rows = [(i, "word " * n) for i, n in enumerate([1023] * 300 + [2047] * 200 + [3071] * 150 + [700] * 90)]
    pieces = B.pack(spark.createDataFrame(rows, "doc_id long, text string"), group=100).collect()
    used, least = check(rows, pieces)
    assert sum(r["sequence_id"] % 3 == 0 for r in pieces) > 0.8 * len(pieces)
    assert used <= least + 10
