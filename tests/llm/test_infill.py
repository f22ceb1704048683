import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from streammetrics.llm import infill as I
from streammetrics.llm.common import table

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text):
    """The contract, word for word, with plain lists."""
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def random_texts(count, seed=3):
    rng = np.random.default_rng(seed)
    parts = np.array([" ", "  ", "\t", "\n", "\x0b", "a", "word", "é", "日本", "🦆", "<", "P>", "<P", "S", ">", "\x1c", "\xa0", "<M>"])
    return ["".join(rng.choice(parts[:rng.integers(6, len(parts) + 1)], rng.integers(0, 60))) for _ in range(count)]


def test_token_widths_equal_the_pattern():
    for text in ["", " ", "\n\n", "a", " a", "a ", "a  b\t", *random_texts(500)]:
        assert I.token_widths(text).tolist() == [len(t) for t in TOKEN.findall(text)], repr(text)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 1000])
def test_every_rank_is_found(n):
    widths = np.random.default_rng(n).integers(1, 30, n)
    tokens = I.SkipList(widths)
    for rank in range(n + 1):
        assert tokens.find(rank)[0] == widths[:rank].sum()
    with pytest.raises(IndexError):
        tokens.find(n + 1)


def test_lanes_carry_both_widths_and_keep_searches_short():
    widths = np.random.default_rng(5).integers(1, 30, 300_000)
    tokens = I.SkipList(widths)
    assert 7 <= len(tokens.lanes) <= 13
    ends = np.cumsum(widths)
    ranks = np.arange(1, len(widths) + 1)          # the rank behind each link's node
    for units, points, below in tokens.lanes:
        ranks = ranks[below]
        assert np.array_equal(np.cumsum(units), ranks)
        assert np.array_equal(np.cumsum(points), ends[ranks - 1])
    links = [tokens.find(int(r))[1] for r in np.random.default_rng(6).integers(0, 300_001, 500)]
    assert np.mean(links) < 40 and max(links) < 150


def test_transform_equals_the_contract_and_restores():
    for i, text in enumerate(random_texts(2000, 9)):
        assert I.transform(text, I.draws(i)) == expected(i, text), repr(text)


def test_all_forms_restore(spark):
    texts = random_texts(400, 11) + ["a<", "<<P", "S>x <S", "no marker"]
    rows = [(k, t, *[int(x) for x in np.random.default_rng(k).integers(0, 2 ** 32, 2)]) for k, t in enumerate(texts)]
    made = []
    for k, t, h1, h2 in rows:
        for h4 in (0, 99):
            n, form, _, _, out = I.transform(t, (h1, h2, 0, h4))
            made.append((t, form, out))
    df = spark.createDataFrame(made, "text string, form string, output string")
    assert {r["form"] for r in df.select("form").distinct().collect()} == {"plain", "spm", "psm"}
    assert df.where(I.restored(F.col("output"), F.col("form")) != F.col("text")).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in I.op12_fill_in_middle(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for d in docs:
        n, form, p, m, out = expected(*d)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (out, d["text"] or "")]
        assert got[d["doc_id"]] == (n, form, p, m, *sha)


def test_unusual_rows(spark):
    rows = [(1, None, "n", 1), (2, "", "n", 1), (None, "no id at all here", "n", 1), (3, "has <P> in it", "n", 1),
            (4, "same text", "n", 1), (4, "same text", "n", 1), (5, "long é " * 300_000, "n", 1), (6, " \n\t ", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int")      # clashing columns
    got = sorted((tuple(r) for r in I.fill_in_middle(docs).collect()), key=str)
    assert got == sorted(((r[0], *expected(r[0], r[1])) for r in rows), key=str)
    empty = I.fill_in_middle(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    other = docs.select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("body"))
    named = I.fill_in_middle(other, "key", "body", plain_from=100)
    assert named.columns[0] == "key" and named.where("form != 'plain'").count() == 5
