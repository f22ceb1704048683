import random

import numpy as np
import pytest

from streammetrics.llm import language_id as L
from streammetrics.llm.common import table

WORDS = {"aa": "balo kami toru sene", "bb": "strix grond vlek umpf", "cc": "œuil çaro ñemi ßüt"}


@pytest.fixture(scope="module")
def filters(spark):
    rng = random.Random(1)
    rows = [(k * 10 + i, " ".join(rng.choice(w.split()) for _ in range(30)), lang)
            for k, (lang, w) in enumerate(WORDS.items()) for i in range(10)]
    rows += [(99, None, "aa"), (None, "x y", "aa"), (98, "some", None)]
    return L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def brute_grams(text):
    s = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split()) + " "
    return [s[i:i + n] for n in L.ORDERS for i in range(len(s) - n + 1)] if s.strip() else []


def test_filters_hold_each_language_s_ngrams(filters):
    assert filters.langs == ["aa", "bb", "cc"]
    rates = filters.false_positive_rates()
    assert (rates < 1e-6).all()
    for k, (lang, w) in enumerate(WORDS.items()):
        hits, n = filters.hits(w)
        assert n == len(brute_grams(w)) and hits[k] == n
        assert filters.predict(w, rates)[0] == lang


def test_correction_removes_expected_false_positives(filters):
    full = L.Filters(["aa", "bb"], filters.masks.copy())
    full.masks[0] |= np.uint64(2)          # the second filter has every bit: all its hits are false
    rates = full.false_positive_rates()
    assert rates[1] == 1.0
    assert full.predict(WORDS["aa"], rates)[0] == "aa"


def test_more_than_one_mask_word(spark):
    rng = random.Random(2)
    langs = [f"l{i:02d}" for i in range(70)]
    rows = []
    for i, lang in enumerate(langs):
        letters = [chr(0x4E00 + 40 * i + k) for k in range(30)]
        rows += [(1000 * i + j, "".join(rng.choice(letters) for _ in range(200)), lang) for j in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    f = L.train(df)
    assert f.masks.shape[0] == 2
    rates = f.false_positive_rates()
    assert all(f.predict(t, rates)[0] == lang for _, t, lang in rows)


def test_nulls_repeats_long_and_clashing_columns(spark, filters):
    rows = [(1, None, 1.0), (2, "", 1.0), (3, "123 !?", 1.0), (4, "balo toru", 1.0), (4, "balo toru", 1.0),
            (None, "strix", 1.0), (5, "kami " * 200_000, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = sorted(((r["doc_id"], r["lang_pred"]) for r in L.identify(docs, filters).collect()), key=str)
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "aa"), (4, "aa"), (None, "bb"), (5, "aa")], key=str)
    assert L.identify(docs.limit(0), filters).count() == 0
    empty = L.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in L.identify(docs, empty).collect()} == {"und"}


def test_long_texts_are_counted_over_chunk_borders(filters, monkeypatch):
    text = " ".join(WORDS.values()) * 20
    whole = filters.hits(text)
    monkeypatch.setattr(L, "CHUNK", 7)
    parts = filters.hits(text)
    assert whole[1] == parts[1] and whole[0].tolist() == parts[0].tolist()


def test_query_is_accurate_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in table(spark, sf, "documents").collect()}
    got = L.op3_language_id(spark, sf).collect()
    assert len(got) == len(lang) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
