import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from streammetrics.llm import spelling as S
from streammetrics.llm.common import table

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def expected(words):
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def rows(df):
    got = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def random_docs(count, seed):
    """Texts over a small alphabet, so that most words have near words and many share a chunk."""
    rng = np.random.default_rng(seed)
    stems = ["".join(rng.choice(list("abé"), 8)) for _ in range(6)]

    def word():
        w = list(stems[min(int(rng.geometric(0.5)) - 1, 5)])
        for _ in range(rng.choice([0, 0, 0, 0, 1, 2])):
            at, kind = int(rng.integers(0, len(w))), rng.integers(0, 3)
            if kind == 0:
                del w[at]
            elif kind == 1:
                w.insert(at, str(rng.choice(list("abéz"))))
            else:
                w[at] = str(rng.choice(list("abéz")))
        w = "".join(w)
        return w.upper() if rng.random() < 0.1 else w

    return [(i, " ".join(word() for _ in range(int(rng.integers(0, 120))))) for i in range(count)]


@pytest.mark.parametrize("block", [S.BLOCK, 3])
def test_random_texts_equal_brute_force(spark, block):
    docs = random_docs(150, 4)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = expected(expected_words(docs))
    assert len(want) > 200 and any(w[1] for w in want)
    assert rows(S.variants(df, block=block)) == want


def test_pairs_come_once_and_only_near(spark):
    rng = np.random.default_rng(8)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(7, 10))) for _ in range(400)})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    for block in (S.BLOCK, 16):
        got = [(r["a"], r["b"]) for r in S.near_pairs(df, block=block).collect()]
        want = {(a, b) for a in words for b in words if (len(a), a) < (len(b), b) and one_edit(a, b)}
        assert len(got) == len(set(got)) and set(got) == want


def test_chunks_and_grams():
    # of any pair, one chunk of the shorter stands in the longer within shift one
    rng = np.random.default_rng(2)
    for _ in range(2000):
        a = "".join(rng.choice(list("ab"), rng.integers(7, 12)))
        at = int(rng.integers(0, len(a) + 1))
        b = a[:at] + "z" + (a[at:] if rng.random() < 0.5 else a[at + 1:])
        q = len(a) // 2
        shifts = range(len(b) - len(a) + 1)
        assert any(b[s:s + q] == a[:q] for s in shifts) or any(
            b[len(a) - q + s:len(a) + s] == a[len(a) - q:] for s in shifts)


def test_chains_end_at_their_last_word(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(18)] + [("x", "w0"), ("y", "w17")]
    got = {r["word"]: r["root"] for r in S.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w18" for w, _ in chain}
    assert S.roots(spark.createDataFrame([], "word string, form string")).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    words = expected_words(docs)
    got = rows(S.op13_spelling_variants(spark, sf_dir))
    assert {(r[0], r[3]) for r in got} == set(words.items())
    by_cut = {}                 # near words share a deletion; compared only within it, as all pairs are too many
    for w in words:
        for part in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by_cut.setdefault(part, []).append(w)
    near = {w: set() for w in words}
    for group in by_cut.values():
        for w in group:
            near[w].update(v for v in group if v != w and one_edit(v, w))
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    for w, f, root, n, n_near, form_n in got:
        end = w
        while form[end]:
            end = form[end]
        assert (f, root, n_near, form_n) == (form[w], end, len(near[w]), words.get(form[w]))


def test_unusual_rows(spark):
    base = "tremendous tremendous tremendos TREMENDOUS Ètremendous short ÉCOLEÀÀÀ école"
    docs = [(1, base), (1, base), (2, None), (3, ""), (None, base), (None, "tremendous " * 5), (4, "wordlike " * 200_000 + "wordlyke wordlyke"),
            (5, "x" * 500_000 + " " + "x" * 500_000), (6, "123 ... \n"), *[(k, "tremendous wordlyke") for k in range(10, 60)]]
    df = spark.createDataFrame([(t, i, 0, "w") for i, t in docs], "text string, doc_id long, n int, word string")
    got = rows(S.variants(df))
    assert got == expected(expected_words(docs))
    assert {w for w, *_ in got} >= {"tremendous", "wordlike", "wordlyke"}
    empty = S.variants(df.limit(0))
    assert empty.count() == 0 and sorted(empty.columns) == sorted(COLUMNS)
    named = S.variants(df.select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("body")), "key", "body")
    assert rows(named) == got


def test_partial_counts_add_up(spark, monkeypatch):
    docs = random_docs(40, 12)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(S, "HELD", 5)
    assert {r["word"]: r["n"] for r in S.word_counts(df).collect()} == expected_words(docs)
