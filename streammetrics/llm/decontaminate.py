"""Benchmark decontamination by greedy string tiling (operator 2).

Benchmark items give seeds: hashes of ``SEED`` successive tokens (of all tokens for shorter
items). A Bloom filter of fixed size over the seeds lets the scan of the documents keep only
the stretches covered by possible seeds; every match of at least ``SEED`` tokens lies in one.
The kept seeds are joined exactly with each item's rarest seeds, as many as a leak can't
do without: a seed that many items share, such as a common stem, brings no pairs. For each (document, item) that
shares enough seeds, the longest matches found by running Karp-Rabin hashing are marked as
non-overlapping tiles, longest first, until none of ``SEED`` tokens is left. Tiles may be in any order,
so reordered passages count; an item is leaked if tiles cover ``COVERAGE`` of its tokens.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from streammetrics.llm.common import PieceCache, hash64, materialize, mix64, table

SEED = 5
COVERAGE = 0.5
FILTER_BITS = 1 << 25   # bits of the seed filter, whatever the benchmark's size
KEY = "__row_key"       # hash of id and text, which names a document row in joins

_TOKEN = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def token_hashes():
    cache = PieceCache(lambda t: hash64(t.encode("utf-8", "replace")).to_bytes(8, "little"))
    return lambda toks: np.frombuffer(cache.joined(toks), "<u8")


def seed_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of every ``width`` successive tokens."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out = out * np.uint64(0x100000001B3) + h[j:j + n]
    return mix64(out)


_BASE = np.uint64(0x100000001B3)                                  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))


class Running:
    """Karp-Rabin hashes of all windows of a token list, of any width, from one running sum."""

    def __init__(self, toks: list):
        n = len(toks)
        h = np.fromiter(map(hash, toks), np.int64, n).view(np.uint64)
        self.powers = np.cumprod(np.append(np.uint64(1), np.full(n, _BASE)))
        self.sums = np.append(np.uint64(0), np.cumsum(h * np.cumprod(np.append(np.uint64(1), np.full(n, _INVERSE)))[:n]))

    def windows(self, size: int) -> np.ndarray:
        """Sum of h[k] * BASE**(end - k) over each window of ``size`` tokens, modulo 2**64."""
        return (self.sums[size:] - self.sums[:-size]) * self.powers[size - 1:-1]


def _free(used: list[bool], size: int) -> np.ndarray:
    """Whether each window of ``size`` tokens is unmarked."""
    marked = np.append(0, np.cumsum(used))
    return marked[size:] == marked[:-size]


def tile(doc: list, item: list, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiles (doc position, item position, length), longest first.

    Search lengths are halved down to ``least``; at each, windows of unmarked tokens are found
    by running hash, compared, extended to maximal matches and marked from the longest on. A match that earlier
    tiles have cut short is taken up again with what is left of it.
    """
    used_a, used_b = [False] * len(doc), [False] * len(item)
    found: list[tuple[int, int, int]] = []
    size = max(least, min(len(doc), len(item)))
    running_a, running_b = Running(doc), Running(item)
    while size <= min(len(doc), len(item)):
        hashes = running_b.windows(size)
        at = np.flatnonzero(_free(used_b, size))
        windows: dict[int, list[int]] = {}
        for j, h in zip(at.tolist(), hashes[at].tolist()):
            windows.setdefault(h, []).append(j)
        queue: list[tuple[int, int, int]] = []
        reached: dict[int, int] = {}  # diagonal → end of its last match
        in_doc = running_a.windows(size)
        at = np.flatnonzero(np.isin(in_doc, hashes[at]) & _free(used_a, size))
        for i, h in zip(at.tolist(), in_doc[at].tolist()):
            for j in windows[h]:
                if reached.get(i - j, -1) > i or doc[i:i + size] != item[j:j + size]:
                    continue
                n = size
                while (i + n < len(doc) and j + n < len(item) and not used_a[i + n] and not used_b[j + n]
                       and doc[i + n] == item[j + n]):
                    n += 1
                reached[i - j] = i + n
                heapq.heappush(queue, (-n, i, j))
        while queue:
            n, i, j = heapq.heappop(queue)
            n = -n
            free = [not (used_a[i + x] or used_b[j + x]) for x in range(n)]
            if all(free):
                found.append((i, j, n))
                used_a[i:i + n] = [True] * n
                used_b[j:j + n] = [True] * n
                continue
            x = 0
            while x < n:  # unmarked stretches of the match
                y = x
                while y < n and free[y]:
                    y += 1
                if y - x >= size:
                    heapq.heappush(queue, (x - y, i + x, j + x))
                x = y + 1
        if size == least:
            break
        size = max(least, size // 2)
    return found


def _items(bench: DataFrame, item_col: str, text_col: str, seed: int) -> DataFrame:
    """(iid, item_id, words, n, width) of the distinct benchmark items with tokens."""
    rows = bench.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).dropna(
        subset=["text"]).distinct()
    arrow_id = to_arrow_type(rows.schema["item_id"].dataType)

    def run(batches):
        for batch in batches:
            ids, toks = batch.column(0).to_pylist(), [tokens(t) for t in batch.column(1).to_pylist()]
            keep = [k for k, t in enumerate(toks) if t]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[k] for k in keep], arrow_id), pa.array([toks[k] for k in keep], pa.list_(pa.string()))],
                ["item_id", "words"])

    out = rows.mapInArrow(run, f"item_id {rows.schema['item_id'].dataType.simpleString()}, words array<string>")
    return materialize(out.withColumn("iid", F.monotonically_increasing_id()).withColumn(
        "n", F.size("words")).withColumn("width", F.least("n", F.lit(seed))), "items")


def _item_seeds(items: DataFrame) -> DataFrame:
    """(seed, iid, starts): each seed of an item and where it has it."""
    def run(batches):
        hashes = token_hashes()
        for batch in batches:
            seeds, iids, starts = [], [], []
            for iid, words, width in zip(*(batch[c].to_pylist() for c in ("iid", "words", "width"))):
                s = seed_hashes(hashes(words), width)
                seeds.append(s)
                iids.append(np.full(len(s), iid, np.int64))
                starts.append(np.arange(len(s), dtype=np.int32))
            if seeds:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(seeds).view(np.int64)), pa.array(np.concatenate(iids)),
                     pa.array(np.concatenate(starts))], ["seed", "iid", "start"])

    return items.select("iid", "words", "width").mapInArrow(run, "seed long, iid long, start int").groupBy(
        "seed", "iid").agg(F.collect_list("start").alias("starts"))


def _probes(seeds: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64(FILTER_BITS - 1)
    return [(seeds & mask).astype(np.int64), ((seeds >> np.uint64(32)) & mask).astype(np.int64)]


def _filter(seeds: DataFrame) -> np.ndarray:
    """The seed filter as 64-bit words, OR-ed together by Spark: at most FILTER_BITS / 64 rows."""
    low = F.col("seed").bitwiseAND(F.lit(FILTER_BITS - 1))
    high = F.shiftrightunsigned("seed", 32).bitwiseAND(F.lit(FILTER_BITS - 1))
    got = (seeds.select(F.explode(F.array(low, high)).alias("bit"))
           .groupBy(F.expr("bit div 64").alias("at"))
           .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toArrow())
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[got["at"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return out


def _scan(docs: DataFrame, seeds: DataFrame, widths: list[int]) -> DataFrame:
    """(key, doc_id, seeds, starts, stretches) of the documents that may hold a seed."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter(seeds))
    arrow_id = to_arrow_type(docs.schema["doc_id"].dataType)
    fields = [("key", pa.int64()), ("doc_id", arrow_id), ("seeds", pa.list_(pa.int64())),
              ("starts", pa.list_(pa.int32())), ("stretches", pa.list_(pa.string()))]

    def run(batches):
        bits, hashes = shared.value, token_hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: list[tuple] = []
                for key, doc_id, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                    toks = tokens(text)
                    h = hashes(toks)
                    edge, kept = np.zeros(len(h) + 1, np.int32), []
                    for width in widths:
                        s = seed_hashes(h, width)
                        hit = np.ones(len(s), bool)
                        for p in _probes(s):
                            hit &= (bits[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) != 0
                        pos = np.flatnonzero(hit)
                        if len(pos):
                            edge[pos] += 1
                            edge[pos + width] -= 1
                            kept.append(s[pos])
                    if not kept:
                        continue
                    inside = np.concatenate(([0], (np.cumsum(edge) > 0).astype(np.int8), [0]))
                    starts = np.flatnonzero(np.diff(inside) == 1).tolist()
                    ends = np.flatnonzero(np.diff(inside) == -1).tolist()
                    out.append((key, doc_id, np.unique(np.concatenate(kept)).view(np.int64).tolist(), starts,
                                [" ".join(toks[a:b]) for a, b in zip(starts, ends)]))
                cols = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(cols, fields)],
                                                 [n for n, _ in fields])

    return docs.mapInArrow(run, f"key long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                                "seeds array<long>, starts array<int>, stretches array<string>")


def _candidates(found: DataFrame, seeds: DataFrame, items: DataFrame, coverage: float) -> DataFrame:
    """(key, iid) of documents that hold one of an item's rarest seeds.

    Tiles that cover enough of an item consist of seeds that the document shares, so these cover as much. With an
    item's seeds ranked by how many documents hold them, rarest first, the rarest shared one still has
    such a cover from itself on; seeds of higher ranks are not joined. No pair that could leak is missed, and a seed
    that most documents hold is joined only where an item has little else.
    """
    held = found.select("key", F.explode("seeds").alias("seed"))
    often = held.groupBy("seed").agg(F.count("*").alias("documents"))
    ranked = seeds.join(often, "seed").withColumn("rank", F.row_number().over(
        Window.partitionBy("iid").orderBy("documents", "seed")))
    # A token is covered from rank r on if its highest-ranked seed has r or more, so the rank up to which
    # enough tokens are covered is the highest rank of the token that comes last among them.
    of_token = (ranked.join(items.select("iid", "width"), "iid")
                .select("iid", "rank", "width", F.explode("starts").alias("start"))
                .select("iid", "rank", F.explode(F.expr("sequence(start, start + width - 1)")).alias("token"))
                .groupBy("iid", "token").agg(F.max("rank").alias("rank")))
    last = (of_token.groupBy("iid").agg(F.sort_array(F.collect_list("rank"), asc=False).alias("ranks"))
            .join(items.select("iid", "n"), "iid")
            .select("iid", F.get("ranks", F.greatest(F.ceil(F.col("n") * coverage), F.lit(1)).cast("int") - 1).alias("last")))
    rare = ranked.join(last, "iid").filter(F.col("rank") <= F.col("last"))
    return held.join(rare.select("seed", "iid"), "seed").select("key", "iid").distinct()


def leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", seed: int = SEED,
          coverage: float = COVERAGE) -> DataFrame:
    """Leaked (document, item) pairs: ``key``, doc_id, item_id, item_tokens, tiled_tokens, coverage, tiles.

    ``tiles`` lists doc token:item token:length. Null and empty texts and items match nothing.
    Repeated document rows (same id and text) give one result row, as do repeated item rows. Rows
    without an id are reported with a null id. Other columns are not read.
    """
    items = _items(bench, item_col, item_text_col, seed)
    seeds = materialize(_item_seeds(items), "item-seeds")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most SEED values
    rows = docs.select(F.xxhash64(id_col, text_col).alias("key"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    found = materialize(_scan(rows, seeds, widths).dropDuplicates(["key"]), "stretches")
    candidates = _candidates(found, seeds, items, coverage)
    of_item = seeds.groupBy("iid").agg(F.collect_list("seed").alias("item_seeds"), F.max(F.size("starts")).alias("most"))
    # a tile of n tokens has at least n / width seeds, so fewer shared seeds can't reach the coverage
    shared = F.size(F.array_intersect("seeds", "item_seeds")) * F.col("most")
    enough = (candidates.join(items, "iid").join(of_item, "iid").join(found, "key")
              .filter(shared >= F.ceil(F.col("n") * coverage / F.col("width")))
              .select("key", "item_id", "words", "width", "doc_id", "starts", "stretches"))
    item_type = items.schema["item_id"].dataType
    id_type = docs.schema[id_col].dataType

    def run(batches):
        for batch in batches:
            d = batch.to_pydict()
            covered, lists = [], []
            for words, width, starts, stretches in zip(d["words"], d["width"], d["starts"], d["stretches"]):
                doc, place = [], []
                for s, text in zip(starts, stretches):
                    part = text.split(" ")
                    doc += [*part, None]  # no tile crosses from one stretch to the next
                    place += range(s, s + len(part) + 1)
                t = tile(doc, words, width)
                covered.append(sum(n for _, _, n in t))
                lists.append(",".join(f"{place[i]}:{j}:{n}" for i, j, n in t))
            n = [len(w) for w in d["words"]]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["doc_id"], batch["item_id"], pa.array(n, pa.int32()),
                 pa.array(covered, pa.int32()), pa.array([c / k for c, k in zip(covered, n)], pa.float64()),
                 pa.array(lists, pa.string())],
                ["key", "doc_id", "item_id", "item_tokens", "tiled_tokens", "coverage", "tiles"])

    return enough.mapInArrow(
        run, f"key long, doc_id {id_type.simpleString()}, item_id {item_type.simpleString()}, item_tokens int, "
             "tiled_tokens int, coverage double, tiles string").filter(F.col("coverage") >= coverage)


def drop_leaked(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no leaked item; all columns stay."""
    bad = materialize(leaks(docs, bench, id_col, text_col).select(F.col("key").alias(KEY)).distinct(), "leaked")
    return docs.withColumn(KEY, F.xxhash64(id_col, text_col)).join(bad, KEY, "left_anti").select(docs.columns)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


QUERIES = {"op2_decontamination": op2_decontamination}
