import zlib

import numpy as np

from streammetrics.llm import packing as P
from streammetrics.llm.common import table


def check(docs, pieces):
    """Every id in exactly one piece, gapless sequences, right CRCs; returns the padding share."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.default_tokenizer())
    want = {}
    for d, text in docs:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.setdefault(d, []).append(ids)
    got, seqs = {}, {}
    for r in pieces:
        got.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append(r)
    assert set(got) == set(want)
    for d, rows in got.items():
        assert sum(r["length"] for r in rows) == sum(map(len, want[d]))
        for r in rows:
            assert any(len(ids) == r["doc_tokens"] and
                       zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
                       for ids in want[d])
        if len(want[d]) == 1:
            at = 0
            for r in sorted(rows, key=lambda r: r["start"]):
                assert r["start"] == at and r["length"] > 0
                at += r["length"]
    padding = total = 0
    for rows in seqs.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= P.WINDOW
        total += at
        padding += 0 if at & (at - 1) == 0 else P.WINDOW - at
    return padding / max(total, 1)


def test_chunked_encoding_equals_whole():
    coder = P.Encoder(P.default_tokenizer())
    tok = P._tokenizer(P.default_tokenizer())
    texts = ("", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a\n  b", "x \n y", "x  \ny", "it's 12ab　 c",
              "don't <|endoftext|> stop", "é ß\xa0 \xa0x", "a\n\n b\n", "tab\t\tx y", "日本 語 123 4", "  lead two",
             "one Two. three,\nFour it's 3.5% <|endoftext|>x <|end y'll 's")
    for limit in (P.Encoder.LIMIT, 3):
        coder.LIMIT = limit
        for _ in range(2):
            for t, got in zip(texts, coder.batch(list(texts))):
                assert np.frombuffer(got, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_chunked_encoding_of_random_text():
    import random
    rng = random.Random(8)
    coder, tok = P.Encoder(P.default_tokenizer()), P._tokenizer(P.default_tokenizer())
    texts = ["".join(rng.choice([" ", " ", "a", "Bc", ".", "\n", "'s", "é", "12", "\t", "　", "!?", "<|endoftext|>", "the", "ß"])
                     for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for t, got in zip(texts, coder.batch(texts)):
        assert np.frombuffer(got, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_crc_of_tail():
    a, b = b"some words", b"and a tail of bytes"
    assert P.crc_of_tail(zlib.crc32(a + b), zlib.crc32(a), len(b)) == zlib.crc32(b)


def test_combinations_and_plan():
    combos = P.combinations(6)
    assert combos == [(1, 1, 4), (1, 2, 3), (1, 5), (2, 2, 2), (2, 4), (3, 3), (6,)]
    bins = P.WINDOW // P.UNIT
    histogram = {bins // 4: 1000, bins // 2: 700, 10: 33, bins - 10: 20}
    runs, sequences, left = P.plan(histogram)
    used = sum(b * (histogram[b] - left[b]) for b in histogram)
    assert used == sequences * bins
    assert sum(b * n for b, n in left.items()) < 0.02 * sum(b * n for b, n in histogram.items())
    places = set()
    for b, rs in runs.items():
        ends = [r[0] for r in rs[1:]] + [histogram[b] - left[b]]
        for (first, m, seq, slot), end in zip(rs, ends):
            for r in range(first, end):
                places.add((seq + (r - first) // m, slot + (r - first) % m))
    assert len(places) == sum(histogram[b] - left[b] for b in histogram)


def test_documents_round_trip(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    pieces = P.op6_packing(spark, sf_dir).collect()
    assert check(docs, pieces) < 0.02


def test_small_groups_and_unusual_rows(spark):
    text = "some words of text and more " * 40
    rows = [(i, text * (i % 9) + "x" * i, "a", 0) for i in range(120)]
    rows += [(500, None, "b", 0), (501, "", "b", 0), (None, "no id", "b", 0), (7, rows[7][1], "a", 0),
             (502, "long " * 60000, "c", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, length int")
    for group in (P.GROUP, 16):
        pieces = P.pack(docs, group=group).collect()
        check([(r[0], r[1]) for r in rows], pieces)
    assert P.pack(docs.limit(0)).count() == 0
