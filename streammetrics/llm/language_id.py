"""Language ID with language-bitmask n-gram filters (operator 3).

Each language has a Bloom filter of its frequent character n-grams. The filters share their
hash functions and are stored bit-sliced: cell ``i`` of the table holds bit ``i`` of every
language's filter as one bitmask. AND-ing the cells of an n-gram gives all languages whose
filter contains it at once. A text's hits per language are popcounts over its n-grams,
corrected for that language's false-positive rate; the largest corrected share decides.

Training counts n-grams on a bounded sample of labelled rows; filters, counts and bit
positions are Spark aggregates, and only the table (at most ``CELLS`` masks) reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streammetrics.llm.common import hash_below, id_remainder, mix64, per_text, table, text_batches

ORDERS = (2, 3, 4)
CELLS = 1 << 20          # cells of the bit-sliced table
HASHES = 3               # cells tested per n-gram
TRAIN_DOCS = 1500        # expected training documents per language
MIN_RATE = 1e-5          # an n-gram enters a filter at this share of its language's n-grams of that order
LANGS_PER_WORD = 62      # languages held in one mask word
CHUNK = 1 << 18          # code points handled at once

_NORM: np.ndarray | None = None


def _norm_table() -> np.ndarray:
    """code point → its lower-case letter, or a space for anything that is no letter."""
    global _NORM
    if _NORM is None:
        t = np.full(0x110000, 32, dtype=np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                t[i] = ord(low) if len(low) == 1 else i
        _NORM = t
    return _NORM


def letters(text: str) -> np.ndarray:
    """Lower-case letters of a text with one space between words and at both ends."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    s = np.concatenate(([32], _norm_table()[cp], [32])).astype(np.uint32)
    blank = s == 32
    keep = np.ones(len(s), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return s[keep]


def gram_hashes(s: np.ndarray, order: int) -> np.ndarray:
    """64-bit hashes of the n-grams of one order."""
    if len(s) < order:
        return np.empty(0, np.uint64)
    n = len(s) - order + 1
    h = np.full(n, order, dtype=np.uint64)
    for j in range(order):
        h = h * np.uint64(0x100000001B3) + s[j:j + n].astype(np.uint64)
    return mix64(h)


def grams(text: str):
    """(order, hashes) of a text's n-grams, a bounded stretch at a time."""
    s = letters(text)
    if len(s) <= 1:
        return
    for at in range(0, len(s), CHUNK):
        for order in ORDERS:
            yield order, gram_hashes(s[at:at + CHUNK + order - 1], order)


def cells_of(h: np.ndarray) -> list[np.ndarray]:
    """The ``HASHES`` table cells of each n-gram (double hashing of its two halves)."""
    a = h & np.uint64(0xFFFFFFFF)
    b = (h >> np.uint64(32)) | np.uint64(1)
    return [((a + np.uint64(k) * b) % np.uint64(CELLS)).astype(np.int64) for k in range(HASHES)]


@dataclass
class Filters:
    """Bit-sliced filters: ``masks[w][cell]`` holds languages ``w * LANGS_PER_WORD ...``."""
    langs: list[str] = field(default_factory=list)
    masks: np.ndarray = field(default_factory=lambda: np.zeros((1, CELLS), np.uint64))

    def false_positive_rates(self) -> np.ndarray:
        rates = np.zeros(len(self.langs))
        for i in range(len(self.langs)):
            w, bit = divmod(i, LANGS_PER_WORD)
            fill = float(((self.masks[w] >> np.uint64(bit)) & np.uint64(1)).mean())
            rates[i] = fill ** HASHES
        return rates

    def hits(self, text: str) -> tuple[np.ndarray, int]:
        """Popcount per language over all n-grams, and the number of n-grams."""
        out, n = np.zeros(len(self.langs), np.int64), 0
        for _, h in grams(text):
            if not len(h):
                continue
            n += len(h)
            cells = cells_of(h)
            for w in range(len(self.masks)):
                m = self.masks[w][cells[0]]
                for c in cells[1:]:
                    m = m & self.masks[w][c]
                for i in range(w * LANGS_PER_WORD, min(len(self.langs), (w + 1) * LANGS_PER_WORD)):
                    out[i] += np.count_nonzero(m & np.uint64(1 << (i % LANGS_PER_WORD)))
        return out, n

    def predict(self, text: str | None, rates: np.ndarray) -> tuple[str, float]:
        """(language, share of the corrected hits); ``und`` without a letter or without a hit."""
        if not text or not self.langs:
            return "und", 0.0
        hits, n = self.hits(text)
        if n == 0:
            return "und", 0.0
        fixed = np.maximum((hits - n * rates) / np.maximum(1 - rates, 1e-9), 0.0)
        total = fixed.sum()
        if total <= 0:  # letters, but no known n-gram: the language with most raw hits, score 0
            return self.langs[int(hits.argmax())], 0.0
        best = int(fixed.argmax())  # ties: the first language in alphabetical order
        return self.langs[best], float(fixed[best] / total)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          docs_per_lang: int = TRAIN_DOCS, min_rate: float = MIN_RATE) -> Filters:
    """Build the filters from about ``docs_per_lang`` documents of each language.

    Rows with a null id, text or language are not learned from. No language: empty filters,
    which call every text ``und``.
    """
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                           F.col(lang_col).alias("lang")).dropna()
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Filters()
    index = {lang: i for i, lang in enumerate(langs)}
    keep = F.lit(False)
    for lang in langs:
        keep = keep | ((F.col("lang") == lang) & hash_below("id", docs_per_lang / sizes[lang]))

    def count(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64).to_pydict()
                found: dict = {}
                for text, lang in zip(part["text"], part["lang"]):
                    for order, h in grams(text):
                        found.setdefault((index[lang], order), []).append(h)
                for (lang, order), hs in found.items():
                    u, c = np.unique(np.concatenate(hs), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(u), lang)), pa.array(np.full(len(u), order)),
                         pa.array(u.view(np.int64)), pa.array(c.astype(np.int64))], ["l", "o", "g", "n"])

    schema = StructType([StructField(c, LongType()) for c in ("l", "o", "g", "n")])
    counts = (rows.filter(keep).select("text", "lang").mapInArrow(count, schema)
              .groupBy("l", "o", "g").agg(F.sum("n").alias("n")))
    counts = counts.persist()
    try:
        totals = counts.groupBy("l", "o").agg(F.sum("n").alias("t"))  # languages x orders rows
        kept = (counts.join(F.broadcast(totals), ["l", "o"])
                .filter(F.col("n") >= F.greatest(F.lit(2), F.ceil(F.col("t") * min_rate))))

        def positions(batches):
            for batch in batches:
                d = batch.to_pydict()
                lang = np.array(d["l"], np.int64)
                h = np.array(d["g"], np.int64).view(np.uint64)
                for c in cells_of(h):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lang // LANGS_PER_WORD), pa.array(c),
                         pa.array(np.int64(1) << (lang % LANGS_PER_WORD))], ["w", "cell", "mask"])

        slices = (kept.select("l", "g")
                  .mapInArrow(positions, StructType([StructField(c, LongType()) for c in ("w", "cell", "mask")]))
                  .groupBy("w", "cell").agg(F.bit_or("mask").alias("mask")))
        got = slices.toArrow()  # at most CELLS rows for each 62 languages
    finally:
        counts.unpersist()
    masks = np.zeros((-(-len(langs) // LANGS_PER_WORD), CELLS), np.uint64)
    masks[got["w"].to_numpy(), got["cell"].to_numpy()] = got["mask"].to_numpy().astype(np.uint64)
    return Filters(langs, masks)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred`` and ``score`` of every row's whole text.

    Null texts and texts without a letter: ``und`` with score 0. Repeated rows each get their
    own result; other columns are not read. The broadcast table has a fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def setup():
        f = shared.value
        rates = f.false_positive_rates()
        return lambda text: f.predict(text, rates)

    return per_text(docs, None, "lang_pred string, score double", id_col, text_col, None, setup)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = id_remainder("doc_id", 5, 0)
    filters = train(docs.filter(remainder != 0))
    return identify(docs, filters).select(
        "doc_id", (remainder == 0).alias("held_out"), "lang_pred", "score")


QUERIES = {"op3_language_id": op3_language_id}
