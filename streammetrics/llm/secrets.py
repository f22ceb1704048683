"""Secret scans with character Markov models (operator 4), in DataFrame functions only.

Known forms of secrets are found by patterns. Two character-pair models, one of random strings
and one of ordinary identifiers, are trained from labelled samples; a further token counts as
a secret when its log-likelihood ratio under the two is high enough, in all and per character.
Offsets come from the lengths of the pieces between matches. Texts never leave their row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streammetrics.llm.common import hash_below, table

TRAIN_DOCS = 20_000      # expected documents searched for known secrets to learn from
WORD_DOCS = 1_500        # expected documents whose identifiers are learned from
LEAST_RATIO = 15.0       # log-likelihood ratio (natural logarithm) that a secret must reach
LEAST_MEAN = 0.5         # and the least mean ratio of its character pairs
TOKEN = "[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = "[A-Za-z0-9+/_=-]{4,}"
SYMBOLS = 66             # characters that tokens are made of
RANDOM_WEIGHT, WORD_WEIGHT = 64.0, 4.0  # pseudo-counts that smooth the two models towards uniform

# kind, pattern with the value as its group 1 (the whole match where there is none), least value length
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    # for these two, dropping short runs is the same as asking for long ones
    ("access", "(AKIA[A-Z0-9]{16,})", 20),
    ("hex", "([0-9a-f]{24,})", 24),
)
_FAR = 2 ** 31 - 1
SCAN_BLOCK = 256         # elements that a running total takes one by one


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, within one projection (a column of its own would copy the row)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, zero: int, op: Callable[[Column, Column], Column]) -> Column:
    """Array of the total, by an associative ``op``, of all elements before each; ``values`` is a bound array of ints.

    An array grows by copying, so one running total over n elements would take n²/2 copies; here blocks
    of ``SCAN_BLOCK`` have totals of their own, which start from the running total of the blocks before them.
    """
    def exclusive(array: Column, of: Callable[[Column], Column]) -> Column:
        start = F.struct(F.lit(zero).alias("total"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(array, start, lambda a, x: F.struct(
            op(a["total"], of(x)).alias("total"), F.concat(a["out"], F.array(a["total"])).alias("out")))

    last = F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / SCAN_BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: exclusive(
        F.slice(values, b * SCAN_BLOCK + 1, F.lit(SCAN_BLOCK)), lambda x: x))
    return _let(blocks, lambda parts: F.flatten(F.zip_with(
        parts, exclusive(parts, lambda part: part["total"])["out"],
        lambda part, before: F.transform(part["out"], lambda x: op(before, x)))))


def _spans(text: str, pattern: str, kind: int) -> Column:
    """Array of (start, kind, end, value) of a pattern's matches in a text column, ends exclusive.

    Each match starts after all pieces between matches and all matches before it. The pattern has no
    look-around, so it finds its group 1 in a match alone as in the text.
    """
    def placed(m: Column, p: Column, at: Column) -> Column:
        return F.zip_with(F.zip_with(at, p, lambda at, p: at + F.length(p)), m, lambda start, m: F.struct(
            start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(m)).alias("end"),
            F.regexp_extract(m, pattern, 1).alias("value")))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = _let(found, lambda m: _let(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m)), lambda p: _let(
            F.zip_with(p, m, lambda p, m: F.length(p) + F.length(m)),
            lambda n: placed(m, p, _running(n, 0, lambda x, y: x + y)))))
    return F.when(F.col(text).rlike(pattern), spans).otherwise(
        F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>"))


def base_spans(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``texts`` with ``base``: the spans of all known forms, by start and then kind."""
    def at_least(n: int):  # a second lambda parameter would be the index
        return lambda s: F.length(s["value"]) >= n

    return texts.withColumn("base", F.array_sort(F.concat(*[
        F.filter(_spans(text_col, pattern, k), at_least(least)) for k, (_, pattern, least) in enumerate(KINDS)])))


def _free(base: Column, tokens: Column) -> Column:
    """The spans of ``tokens`` that meet no span of ``base``, by start.

    Both go into one array by start, base spans first. A token meets a base span that begins no later if
    the greatest end before it lies behind its start, and one that begins later if the least start behind it
    lies before its end.
    """
    def item(order: int) -> Callable[[Column], Column]:
        return lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"),
                                  s["kind"].alias("kind"))

    def kept(items: Column) -> Column:
        ends = F.transform(items, lambda s: F.when(s["order"] == 0, s["end"]).otherwise(F.lit(-1)))
        starts = F.transform(F.reverse(items), lambda s: F.when(s["order"] == 0, s["start"]).otherwise(F.lit(_FAR)))
        reach = _let(ends, lambda e: _running(e, -1, F.greatest))
        after = F.reverse(_let(starts, lambda e: _running(e, _FAR, F.least)))
        return F.array_compact(F.zip_with(
            F.zip_with(items, reach, lambda s, reach: F.when((s["order"] == 1) & (reach <= s["start"]), s)),
            after, lambda s, after: F.when(s["end"] <= after, s)))

    every = F.concat(F.transform(base, item(0)), F.transform(tokens, item(1)))
    return F.when(F.size(tokens) > 0, _let(F.array_sort(every), kept)).otherwise(
        F.array().cast("array<struct<start:int,order:int,end:int,kind:int>>"))


def pair_weights(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each character pair from (token, random) samples, at 128 * first + second.

    Counting pairs is one aggregation with at most 2 * 128 * 128 rows, which reach the driver.
    Smoothing gives every pair a weight even without samples.
    """
    chars = F.transform(F.split("token", ""), lambda c: F.ascii(c))
    pairs = samples.select("random", chars.alias("c")).filter(F.size("c") >= 2).select(
        "random", F.explode(F.expr("transform(sequence(1, size(c) - 1), i -> 128 * c[i - 1] + c[i])")).alias("pair"))
    counts = np.zeros((2, 128, 128))
    for r in pairs.groupBy("random", "pair").count().collect():
        if 0 <= r["pair"] < 128 * 128:
            counts[int(r["random"]), r["pair"] // 128, r["pair"] % 128] = r["count"]
    model = [(c + w / SYMBOLS) / (c.sum(axis=1, keepdims=True) + w) for c, w in zip(counts, (WORD_WEIGHT, RANDOM_WEIGHT))]
    return np.round(np.log(model[1]) - np.log(model[0]), 4).ravel().tolist()


def corpus_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(token, random): values of known secrets, and the other identifiers of fewer documents.

    Both come from samples by id hash of a bounded expected number of documents.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    n = max(rows.count(), 1)
    secret = base_spans(rows.filter(hash_below("id", TRAIN_DOCS / n, 1))).select(
        F.explode("base.value").alias("token"), F.lit(1).alias("random"))
    every = "|".join(p for _, p, _ in KINDS)
    words = rows.filter(hash_below("id", WORD_DOCS / n, 2)).select(F.explode(F.regexp_extract_all(
        F.regexp_replace("text", every, " "), F.lit(IDENTIFIER), F.lit(0))).alias("token"), F.lit(0).alias("random"))
    return secret.unionByName(words)


def scan(docs: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text",
         least_ratio: float = LEAST_RATIO, least_mean: float = LEAST_MEAN) -> DataFrame:
    """``id_col``, base span counts by kind, base_sha256 and spans of every whole text.

    Spans are kind:start:end in code points, the end exclusive; kind ``random`` marks tokens
    found by the models that meet no base span. Null counts as the empty text, which has no
    spans; repeated rows give the same row each; other columns are not read. A text is scanned whole, in time
    nearly linear in its length and matches. Empty in, empty out.
    """
    table_ = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<double>")  # folded to a constant
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = base_spans(rows)

    def ratio(token: Column) -> Column:
        chars = F.transform(F.split(token, ""), lambda c: F.ascii(c))
        pairs = _let(chars, lambda c: F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1),
                                                 lambda a, b: F.element_at(table_, 128 * a + b + 1)))
        return F.aggregate(pairs, F.lit(0.0), lambda total, w: total + w)

    tokens = F.transform(_spans("text", f"({TOKEN})", len(KINDS)), lambda t: F.struct(
        t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end"), ratio(t["value"]).alias("ratio")))
    random = F.filter(tokens, lambda t: (t["ratio"] >= least_ratio) & (
        t["ratio"] >= least_mean * (t["end"] - t["start"] - 1)))
    rows = rows.select("id", "base", random.alias("random"))
    plain = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end")))
    more = F.transform(_free(F.col("base"), F.col("random")), lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end")))
    rows = rows.select("id", plain.alias("plain"), F.array_sort(F.concat(plain, more)).alias("all"))
    names = F.array(*[F.lit(k) for k, _, _ in KINDS], F.lit("random"))

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")

    def of_kind(k: int):
        return lambda s: s["kind"] == k

    return rows.select(
        F.col("id").alias(id_col),
        *[F.size(F.filter("plain", of_kind(k))).cast("long").alias(f"n_{name}") for k, (name, _, _) in enumerate(KINDS)],
        F.sha2(listed("plain"), 256).alias("base_sha256"), listed("all").alias("spans"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, pair_weights(corpus_samples(docs)))


QUERIES = {"op4_secret_scan": op4_secret_scan}
