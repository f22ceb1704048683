import corpus_pipeline
from streammetrics.llm import decontaminate as D
from streammetrics.llm import packing, pii, toxicity
from streammetrics.llm.common import labelled, materialize, table
from test_decontaminate import covered
from test_packing import check
from test_simhash import brute_fingerprint, components


def test_each_stage_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "test-stage")
        out[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    source = {r["doc_id"]: r for r in table(spark, sf_dir, "documents").collect()}

    model = toxicity.train(labelled(spark, sf_dir, "toxic", toxicity.TRAIN_DOCS))
    features = model.features()
    clean = [d for d, r in source.items() if 1 / (1 + 2.718281828459045 ** -(features(r["text"] or "") @ model.weights)) < 0.3]
    assert sorted(r["doc_id"] for r in out["toxicity"]) == sorted(clean)

    ids = sorted(clean)
    want = components([brute_fingerprint(source[d]["text"]) for d in ids])
    one = {ids[i] for i, w in enumerate(want) if i == w}
    assert {r["doc_id"] for r in out["near_dedup"]} == one and len(out["near_dedup"]) == len(one)

    items = [D.tokens(r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    def leaked(text):
        doc = D.tokens(text)
        grams = {tuple(doc[i:i + 5]) for i in range(len(doc) - 4)}
        return any(any(tuple(w[j:j + 5]) in grams for j in range(len(w) - 4))
                   and covered(D.tile(doc, w, 5)) >= D.COVERAGE * len(w) for w in items)
    assert {r["doc_id"] for r in out["decontaminate"]} == {d for d in one if not leaked(source[d]["text"])}

    by = {r["doc_id"]: r for r in out["pii"]}
    assert set(by) == {r["doc_id"] for r in out["decontaminate"]}
    for d, r in by.items():
        assert r["text"] == pii.redacted(source[d]["text"]) and r["n_chars"] == len(r["text"])
    assert check([(r["doc_id"], r["text"]) for r in out["pii"]], out["packing"]) < 0.05


def test_pipeline_takes_empty_and_null_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (None, "x", None, "s", 1)], docs.schema)
    for rows in (docs, odd):
        for name, stage in corpus_pipeline.STAGES:
            rows = materialize(stage(spark, rows, sf_dir), "odd-stage")
        assert rows.columns[:2] == ["doc_id", "start"]


def test_run_is_registered():
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
