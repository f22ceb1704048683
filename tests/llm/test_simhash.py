import hashlib

import numpy as np
import pytest
import xxhash

from streammetrics.llm import simhash as S


def brute_fingerprint(text):
    words = [w for w in __import__("re").findall("[^\x20\x09-\x0d]+", text or "")]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    sh = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps):
    """Row → smallest row reachable over links of at most four bits, by brute force."""
    n = len(fps)
    f = np.array(fps, dtype=np.uint64)
    label = list(range(n))
    near = [np.flatnonzero(np.bitwise_count(f ^ x) <= 4) for x in f]
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min(label[j] for j in near[i])
            if low < label[i]:
                label[i], changed = low, True
    return label


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(1)
    for width in S.WIDTHS:
        message, errors = S.decode_tables(width)
        for _ in range(300):
            w = int(rng.integers(1 << width)) << (23 - width)
            v = w
            for b in rng.choice(width, int(rng.integers(0, 3)), replace=False):
                v ^= 1 << (int(b) + 23 - width)
            idx = []
            for x in (w, v):
                e = errors[(x & 2047) ^ message[x >> 11]]
                idx.append({(x ^ int(q)) >> 11 for q in e if q >= 0})
            assert idx[0] & idx[1] and len(idx[0]) <= 6


def test_fingerprint_matches_definition():
    for t in (None, "", " \n\t", "one", "Two Words", "a b c d", "Ä B c\x0bd e\xa0f  g " * 30, "x y " * 5000):
        assert S.fingerprint(t) & (2**64 - 1) == brute_fingerprint(t)


@pytest.mark.parametrize("block", [S.BLOCK, 8])
def test_components_match_brute_force(spark, block):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = list(base)
    for c in base[:6]:  # chains and dense groups of near fingerprints
        at = int(c)
        for _ in range(40):
            near = at
            for b in rng.choice(64, int(rng.integers(0, 6)), replace=False):
                near ^= 1 << int(b)
            fps.append(np.uint64(near))
            at = near if rng.random() < 0.4 else int(c)
    fps = list(dict.fromkeys(int(x) for x in fps))
    rng.shuffle(fps)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    links = S.links(spark.createDataFrame([(x,) for x in signed], "fp long"), block=block)
    roots = {r["node"]: r["root"] for r in S.connected_components(links).collect()}
    want = components(fps)
    groups = {}
    for x, w in zip(signed, want):
        groups.setdefault(roots.get(x, x), set()).add(w)
    assert all(len(v) == 1 for v in groups.values())
    assert len(groups) == len(set(want))


def test_query_matches_brute_force_on_documents(spark, sf_dir):
    from streammetrics.llm.common import table
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [brute_fingerprint(r["text"]) for r in docs]
    want = components(fps)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"])
           for r in S.op5_simhash_golay(spark, sf_dir).collect()}
    assert got == {r["doc_id"]: (f"{f:016x}", docs[w]["doc_id"]) for r, f, w in zip(docs, fps, want)}


def test_nulls_ties_repeats_and_clashing_columns(spark):
    schema = "doc_id long, text string, fp string, component_id string, root string"
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text, "x", "y", "z"), (3, text, "x", "y", "z"), (3, text, "x", "y", "z"), (None, text, "", "", ""),
            (7, None, "", "", ""), (8, "", "", "", ""), (9, " \n", "", "", ""), (11, "other " * 30000, "", "", "")]
    docs = spark.createDataFrame(rows, schema)
    got = sorted(((r["doc_id"], r["component_id"]) for r in S.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (None, 3), (7, 7), (8, 7), (9, 7), (11, 11)], key=str)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [11, 3, 7]      # the copy without an id goes too
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_keep_one_decides_by_row(spark):
    text, alone = (" ".join(f"{c}{i}" for i in range(50)) for c in "wu")
    rows = [(3, text, "a"), (7, alone, "b"), (7, text, "c"), (7, alone, "a"), (7, alone, "b"), (9, text, "a"),
            (5, None, "b"), (5, "", "a"), (6, " ", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    for n in (1, 5):  # whatever the order of rows
        for part in (docs, docs.orderBy("row"), docs.orderBy(docs.text.desc())):
            kept = S.keep_one(part.repartition(n))
            assert kept.columns == docs.columns
            assert sorted(kept.collect()) == [(3, text, "a"), (5, None, "b"), (7, alone, "a")]


def test_keep_one_without_ids(spark):
    text, near, alone = (" ".join([*(f"{c}{i}" for i in range(200)), end]) for c, end in (("w", "x"), ("w", "y"), ("u", "x")))
    assert 0 < (S.fingerprint(text) ^ S.fingerprint(near)).bit_count() <= 4
    rows = [(3, text), (4, near)] + 200 * [(None, text), (None, near), (None, alone), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (small, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            kept = sorted(((r["doc_id"], r["text"]) for r in S.keep_one(docs.repartition(7)).collect()), key=str)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
        assert kept == sorted([(3, text), (None, alone), (None, None)], key=str)
    kept = S.keep_one(docs.where("doc_id is null")).collect()
    first = min(text, near, key=lambda t: hashlib.md5(t.encode()).digest())
    assert sorted((r["text"] for r in kept), key=str) == sorted([first, alone, None], key=str)
