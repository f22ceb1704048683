import numpy as np

from streammetrics.llm import topk as T


def brute(rows, queries, k):
    best = {}
    for i, v in rows:
        ok = i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
        if ok:
            v = [int(np.floor(256 * float(x))) for x in v]
            best[i] = min(best.get(i, v), v)
    out = {}
    for q in best:
        if queries(q):
            scores = sorted((-sum(a * b for a, b in zip(best[q], v)), i) for i, v in best.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return {q: r for q, r in out.items() if r}


def run(spark, rows, schema="vec_id long, embedding array<float>, score int", **kw):
    df = spark.createDataFrame([(*r, 0) for r in rows], schema)
    out = {}
    for r in sorted(T.search(df, lambda i: i % 5 == 0, 3, **kw).collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_random_vectors_in_many_shards(spark):
    rng = np.random.default_rng(0)
    for centre, spread in ((0.0, 1.0), (0.6, 0.3), (-0.5, 0.2)):
        rows = [(i, [float(x) for x in np.round(rng.normal(centre, spread, 12), 2)]) for i in range(300)]
        rows += [(1000 + i, rows[i][1]) for i in range(40)]  # ties
        sparse = [(2000 + i, [float(x) if rng.random() < 0.2 else 0.0 for x in rng.normal(0, 1, 12)]) for i in range(60)]
        assert run(spark, rows + sparse, shard=64, block=16) == brute(rows + sparse, lambda i: i % 5 == 0, 3)


def test_nulls_repeats_few_rows_and_lengths(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [0.5, 9.0]), (5, [1.0, None]), (10, [float("nan"), 1.0]), (None, [1.0, 1.0]),
            (15, None), (20, [float("inf"), 0.0]), (1, [1.0]), (25, []), (2, [-1.0, -1.0, 3.0])]
    got = run(spark, rows)
    assert got == {0: [(1, 128 * 256), (25, 0), (2, -128 * 256 - 9 * 256 * 256)], 25: [(0, 0), (1, 0), (2, 0)]}
    assert run(spark, rows[:1]) == {} and run(spark, []) == {}


def test_pruning_leaves_out_terms():
    rng = np.random.default_rng(1)
    x = np.abs(rng.normal(0, 1, (500, 30)) ** 3 * 100).astype(np.int64).astype(float)
    shard = T.Shard(np.arange(500), x)
    for _ in range(50):
        q = np.floor(np.abs(rng.normal(0, 1, 30) ** 3) * 100)
        ids, scores = shard.top(-1, q, 5)
        want = np.lexsort([np.arange(500), -(x @ q)])[:5]
        assert ids.tolist() == want.tolist() and scores.tolist() == (x @ q)[want].tolist()
