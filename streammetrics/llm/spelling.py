"""Spelling variant grouping by asymmetric q-chunks (operator 13).

Words are counted over all texts. Two words are near if one inserted, deleted or replaced code point
makes one of the other. Of a pair, the shorter word (either, if equally long) gives two disjoint
chunks of half its length, its first and its last q code points. The edit touches at most one of them, so the
other stands unchanged in the longer word, shifted by one place at most. The longer word
therefore gives its positional q-grams, for the q of each length its partners may have; only grams within
shift one of a chunk's place can join, and only those are emitted. What lies outside the unchanged chunk holds the
edit and is treated the same way: of its own two disjoint chunks one is unchanged. Both
together, about three quarters of a word, are the key on which chunks join grams, and each pair is verified.

The joined rows are vocabulary, not text, and keys get longer with the words they must tell apart. A key
that many words share is split: its grams are dealt over blocks of about ``BLOCK`` by hash and
its chunks are copied once a block. Verification is part of the join, so no candidate pair leaves it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streammetrics.llm.common import materialize, table, text_batches

MIN_LENGTH = 7       # code points of a word
MIN_COUNT = 2        # occurrences of a word
RATIO = 10           # a form occurs at least this many times as often as its variant
SLIP = 31            # a run whose hash this divides loses a code point
BLOCK = 4096         # grams of one key that one block holds, about
HELD = 200_000       # words that a task counts before it hands them on
A_TASK = 50_000      # words whose keys one task makes

_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _lower(run: str) -> str:
    """Lower-case A-Z only."""
    return run.lower() if run.isascii() else run.translate(_UPPER)


def slipped(doc_id, run: str, slip: int = SLIP) -> str:
    """The word that a lower-cased run of a document stands for."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % slip:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n) of all words of at least ``min_length`` code points and ``min_count`` occurrences.

    A task counts the words of its rows and hands on partial counts, so a word that is everywhere leaves one
    row for each ``HELD`` distinct words, not one for each occurrence.
    """
    # Shorter runs can't give a longer word, and a run found is maximal whatever its least length.
    runs = re.compile(rf"[A-Za-zÀ-ÿ]{{{min_length},}}")

    def run(batches):
        counts: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()),
                                              pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for ids, texts in text_batches(batches):
            for doc_id, text in zip(ids, texts):
                mine: Counter = Counter()
                for found, n in Counter(runs.findall(text)).items():
                    mine[_lower(found)] += n
                for lowered, n in mine.items():      # the hash is that of the document and the run
                    word = slipped(doc_id, lowered, slip)
                    if len(word) >= min_length:
                        counts[word] += n
                if len(counts) >= HELD:
                    yield flush()
        yield flush()

    parts = docs.select(id_col, text_col).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _signatures(size: Column, less: int) -> list[tuple[Column, Column, Column, Column]]:
    """(start, length, start, length) of the unchanged chunk and of the unchanged chunk of the rest, from 1, in a
    word ``less`` code points longer than ``size``; ``size`` and places are those of the shorter word's chunks.

    The first half doesn't shift, the last half shifts by all of ``less``; the chunk of the rest by any number up to it.
    """
    q = F.floor(size / 2).cast("int")
    u = F.floor((size - q) / 2).cast("int")
    out = []
    for start, rest in ((F.lit(1), q + 1), (size - q + 1 + less, F.lit(1))):
        for inner in (rest, rest + size - q - u):
            out += [(start, q, inner + shift, u) for shift in range(less + 1)]
    return out


def _keys(less: int) -> list[Column]:
    """Keys of the column ``word`` towards words ``less`` code points shorter."""
    size = F.length("word") - less
    keys = []
    for i, (start, q, inner, u) in enumerate(_signatures(size, less)):
        gram = F.concat(F.substring(F.col("word"), start, q), F.substring(F.col("word"), inner, u))
        keys.append(F.struct(size.alias("size"), F.lit(i // (less + 1)).alias("chunk"), gram.alias("gram")))
    return keys


def chunks(words: DataFrame) -> DataFrame:
    """(size, chunk, gram, word, n): each half of a word with each half of its rest."""
    return words.select("word", "n", F.explode(F.array(*_keys(0))).alias("key")).select("key.*", "word", "n")


def grams(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(size, chunk, gram, word, n): grams of each word within shift one of a chunk of its partners.

    A partner is as long (its chunks don't shift) or one code point shorter (they shift by none or by one).
    """
    longer = F.when(F.length("word") > min_length, F.array(*_keys(1))).otherwise(F.array().cast(
        "array<struct<size:int,chunk:int,gram:string>>"))
    keys = F.array_distinct(F.concat(F.array(*_keys(0)), longer))
    return words.select("word", "n", F.explode(keys).alias("key")).select("key.*", "word", "n")


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH, block: int = BLOCK) -> DataFrame:
    """(a, n_a, b, n_b): each pair of near words of ``words(word, n)`` once, ``b`` the longer or, if equally long, the greater."""
    key = ["size", "chunk", "gram"]
    left, right = chunks(words), grams(words, min_length)
    # Keys of more than one block; all others need no row here.
    hot = (right.groupBy(*key).agg(F.count("*").alias("held")).where(F.col("held") > block)
           .select(*key, F.ceil(F.col("held") / block).cast("int").alias("blocks")))
    hot = materialize(hot, "hot-grams")
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    right = right.join(hot, key, "left").select(
        *key, F.pmod(F.xxhash64("word"), blocks).cast("int").alias("block"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    left = left.join(hot, key, "left").select(
        *key, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    a, b = F.col("a"), F.col("b")
    near = ((F.length(b) > F.col("size")) | (a < b)) & (F.levenshtein(a, b, 1) == 1)
    # Words that agree in more than one chunk meet once for each.
    return left.join(right, [*key, "block"]).where(near).select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms(word, form)``: from each word along its forms to the last, by doubling.

    A form is ``RATIO`` times as frequent as its variant, so chains have at most 19 steps and the
    loop at most 6 rounds, whatever the number of words.
    """
    reach = materialize(forms.select("word", F.col("form").alias("root")), "reach")
    while True:
        on = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(reach.join(on, "root", "left"), "step")
        reach = step.select("word", F.coalesce("further", "root").alias("root"))
        if step.where(F.col("further").isNotNull()).isEmpty():
            return reach


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, ratio: int = RATIO, slip: int = SLIP, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word.

    ``form`` is the near word of largest n (ties: the smallest in code-point order) if it occurs at least
    ``ratio`` times as often, else null; ``root`` is the end of the chain of forms, the word
    itself if it has none. Null and empty texts have no words; a row without an id counts as one whose id is the
    empty string; repeated rows count again; long texts are read whole. Other columns are not read. No
    words, no rows.
    """
    if min_length < 4:
        raise ValueError("words of fewer than four code points have no chunks of a rest")
    words = materialize(word_counts(docs, id_col, text_col, min_length, min_count, slip), "words")
    tasks = max(1, -(-words.count() // A_TASK))      # a word has 16 keys: few files would be few long tasks
    pairs = near_pairs(words.repartition(tasks), min_length, block)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("other"), F.col("n_b").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("other"), F.col("n_a").alias("other_n"))
    )).alias("p")).select("p.*")
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"),
                                         F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best"))
    is_form = -F.col("best.less") >= F.col("n") * ratio
    best = materialize(best.select("word", "n_near", F.when(is_form, F.col("best.other")).alias("form"),
                                   F.when(is_form, -F.col("best.less")).alias("form_n")), "near")
    ends = roots(best.where(F.col("form").isNotNull()))
    return (words.join(best, "word", "left").join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


QUERIES = {"op13_spelling_variants": op13_spelling_variants}

# CRC-32 by bytes; near words by their deletions (a way of its own, apart from chunks).
ORACLE_SQL = {"op13_spelling_variants": f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
           CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(0, 256)) AS i) s),
found AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
         translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
runs AS (
  SELECT run, hex(encode(d || ':' || run)) AS x, count(*) AS k
  FROM found WHERE length(run) >= {MIN_LENGTH} GROUP BY d, run),
hashed AS (
  SELECT run, k,
         xor(list_reduce(list_prepend(4294967295,
               list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, CAST(i AS BIGINT), 2) AS BIGINT))),
             lambda c, y: xor(c // 256, t[CAST(xor(c % 256, y) AS BIGINT) + 1])), 4294967295) AS h
  FROM runs, crc_table),
slips AS (
  SELECT CASE WHEN h % {SLIP} <> 0 THEN run
              ELSE substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
         END AS word, k FROM hashed),
words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM slips
  WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(k) >= {MIN_COUNT}),
cut AS (
  SELECT DISTINCT word, n, unnest(list_prepend(word, list_transform(range(1, length(word) + 1),
           lambda i: substr(word, 1, CAST(i AS BIGINT) - 1) || substr(word, CAST(i AS BIGINT) + 1)))) AS part
  FROM words),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n
  FROM cut a JOIN cut b ON a.part = b.part AND a.word <> b.word
  WHERE length(a.word) <> length(b.word) OR len(list_filter(range(1, length(a.word) + 1),
          lambda i: substr(a.word, CAST(i AS BIGINT), 1) <> substr(b.word, CAST(i AS BIGINT), 1))) = 1),
ranked AS (
  SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS r
  FROM near),
best AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
         CASE WHEN r.other_n >= {RATIO} * w.n THEN r.other END AS form,
         CASE WHEN r.other_n >= {RATIO} * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.r = 1),
chain AS (
  SELECT word, word AS root FROM best
  UNION ALL
  SELECT c.word, b.form FROM chain c JOIN best b ON b.word = c.root WHERE b.form IS NOT NULL),
ends AS (
  SELECT c.word, c.root FROM chain c JOIN best b ON b.word = c.root WHERE b.form IS NULL)
SELECT b.word, b.form, e.root, CAST(b.n AS BIGINT) AS n, CAST(b.n_near AS BIGINT) AS n_near,
       CAST(b.form_n AS BIGINT) AS form_n
FROM best b JOIN ends e ON e.word = b.word
"""}
