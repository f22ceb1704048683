"""Sequence packing by non-negative least squares (operator 6).

A document's ids are cut into full windows, which are sequences of their own, and a remainder.
Remainder lengths, rounded up to ``UNIT`` tokens, give a histogram. All combinations of at most
``DEPTH`` lengths that fill a window are enumerated, and non-negative least squares finds how
often to repeat each so that together they use up the histogram. The rounded-down counts assign
remainders by their rank in their bin; what is left over is packed greedily in independent
bounded groups, cutting a piece where a window ends.

Ranks are built from per-group counts and bounded windows, so no bin is ever gathered in one
task. Pieces carry CRCs of their prefixes every ``GRID`` ids, from which the CRC of any cut on
that grid follows; documents are tokenized once.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streammetrics.llm.common import materialize, table
from streammetrics.llm.tokens import ByteEncoder, slices

WINDOW = 2048
UNIT = 8            # remainder lengths are counted in bins of this many tokens
DEPTH = 3           # most lengths in a combination
GRID = 16           # left-over pieces are cut at multiples of this many tokens
GROUP = 5_000       # documents whose ranks, or left-over pieces whose packing, one task handles
END = 1             # id that ends each document



def _tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder(ByteEncoder):
    """texts → little-endian unsigned 32-bit ids, equal to encoding each text at once."""

    def batch(self, texts: list[str]) -> list[bytes]:
        ids, bounds = super().batch(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The process's encoder of a tokenizer file; its caches outlive a task."""
    return Encoder(path)


def crc_of_tail(whole: int, head: int, tail_bytes: int) -> int:
    """CRC-32 of B from those of A + B and A (the CRC is linear in its start value)."""
    zeros = _zeros(tail_bytes)
    return whole ^ zlib.crc32(zeros, head) ^ zlib.crc32(zeros)


@lru_cache(maxsize=4096)
def _zeros(n: int) -> bytes:
    return bytes(n)


def tokenized(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str) -> DataFrame:
    """One row per document: uid, id, tokens, CRCs of its full windows, prefix CRCs of the remainder."""
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = docs.schema[id_col].dataType
    arrow_id = to_arrow_type(id_type)

    def run(batches):
        encode = encoder(tokenizer_path).batch
        end = np.array([END], "<u4").tobytes()
        step, window = 4 * GRID, 4 * WINDOW
        for ids, texts in slices(batches):
            tokens, full, prefix = [], [], []
            for b in encode(texts.to_pylist()):
                b += end
                cut = len(b) // window * window
                tokens.append(len(b) // 4)
                full.append(np.array([zlib.crc32(b[i:i + window]) for i in range(0, cut, window)], "<u4").tobytes())
                crc, crcs = 0, []
                for i in range(cut, len(b), step):
                    crc = zlib.crc32(b[i:i + step], crc)
                    crcs.append(crc)
                prefix.append(np.array(crcs, "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, arrow_id), pa.array(tokens, pa.int64()), pa.array(full, pa.binary()),
                 pa.array(prefix, pa.binary())], ["doc_id", "tokens", "full", "prefix"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type.simpleString()}, tokens long, full binary, prefix binary")
    return rows.withColumn("uid", F.monotonically_increasing_id())


def combinations(bins: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Non-decreasing tuples of at most ``depth`` bin lengths that sum to ``bins``."""
    found: list[tuple[int, ...]] = []

    def extend(prefix: tuple[int, ...], least: int, rest: int) -> None:
        if rest == 0:
            found.append(prefix)
        elif len(prefix) < depth:
            for b in ([rest] if len(prefix) == depth - 1 else range(least, rest + 1)):
                if b >= least and b <= rest:
                    extend((*prefix, b), b, rest - b)

    extend((), 1, bins)
    return found


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 minimising |a x - b|, by an active-set method (Lawson and Hanson)."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    scale = max(float(np.abs(b).max(initial=0.0)), 1.0)
    for _ in range(3 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[passive] = -np.inf
        j = int(gradient.argmax())
        if gradient[j] <= 1e-9 * scale:
            break
        passive[j] = True
        while True:
            at = np.flatnonzero(passive)
            s = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if s.min() > 0:
                break
            low = s <= 0
            step = (x[at][low] / np.maximum(x[at][low] - s[low], 1e-300)).min()
            x[at] += step * (s - x[at])
            drop = at[(x[at] <= 1e-12 * scale) & low]
            if not len(drop):
                drop = at[low]
            x[drop] = 0.0
            passive[drop] = False
            if not passive.any():
                break
        x[:] = 0.0
        if passive.any():
            x[np.flatnonzero(passive)] = s
    return x


def plan(histogram: dict[int, int], window: int = WINDOW) -> tuple[dict, int, dict[int, int]]:
    """(runs by bin, number of sequences, left-over count by bin).

    A run (first rank, slots, first sequence, first slot) of a bin gives ranks to the slots that
    a repeated combination has for it: rank r goes to sequence first + (r - first rank) // slots.
    """
    bins = window // UNIT
    combos = combinations(bins)
    a = np.zeros((bins + 1, len(combos)))
    for j, c in enumerate(combos):
        for b in c:
            a[b, j] += 1
    h = np.zeros(bins + 1)
    for b, n in histogram.items():
        h[b] = n
    x = nnls(a, h)
    left = {b: int(n) for b, n in histogram.items()}
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    sequences = 0
    for j in sorted(np.flatnonzero(x), key=lambda j: (-x[j], combos[j])):
        need = {b: combos[j].count(b) for b in combos[j]}
        times = min([int(np.floor(x[j] + 1e-6)), *[left.get(b, 0) // m for b, m in need.items()]])
        if times <= 0:
            continue
        for b, m in need.items():
            first = histogram[b] - left[b]
            runs.setdefault(b, []).append((first, m, sequences, combos[j].index(b)))
            left[b] -= m * times
        sequences += times
    return runs, sequences, left


def _greedy(window: int):
    """Fill windows one after the other with the group's pieces, longest first, cutting at window ends."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "uid"], ascending=[False, True])
        out, seq, used = [], 0, 0
        for r in pdf.itertuples(index=False):
            prefix = np.frombuffer(r.prefix, "<u4")

            def crc_to(n: int) -> int:
                return 0 if n == 0 else int(prefix[-(-n // GRID) - 1])

            done = 0
            while done < r.length:
                room = window - used
                take = r.length - done
                if take > room:
                    take = room // GRID * GRID
                if take <= 0:
                    seq, used = seq + 1, 0
                    continue
                whole = crc_to(done + take)
                crc = whole if done == 0 else crc_of_tail(whole, crc_to(done), 4 * take)
                out.append((r.doc_id, r.start + done, take, crc, r.tokens, seq, used, r.grp))
                done, used = done + take, used + take
        return pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "local",
                                          "offset", "grp"])
    return run


def pack(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``window`` tokens.

    Null texts count as empty; an empty text has one token, its end. Repeated rows are documents
    of their own. Rows without an id are packed like others. Other columns are not read. Empty
    in, empty out. Sequence ids are unique but not consecutive: remainder 0 modulo 3 means
    combined, 1 greedily packed, 2 a full window.
    """
    if window % UNIT or window % GRID:
        raise ValueError(f"the window must be a multiple of {UNIT} and {GRID}")
    if window != WINDOW:
        raise ValueError(f"only windows of {WINDOW} tokens are supported")
    id_ddl = docs.schema[id_col].dataType.simpleString()
    rows = materialize(tokenized(docs, tokenizer_path or default_tokenizer(), id_col, text_col), "tokenized")
    rows = rows.withColumn("windows", F.expr(f"tokens div {window}")).withColumn("length", F.col("tokens") % window)
    n = rows.count()
    salts = max(1, -(-n // group))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(salts))).withColumn(
        "bin", F.ceil(F.col("length") / UNIT).cast("int"))

    # full windows: numbered within their salt
    before = F.sum("windows").over(Window.partitionBy("salt").orderBy("uid").rowsBetween(
        Window.unboundedPreceding, -1))
    full = (rows.filter("windows > 0").withColumn("first", F.coalesce(before, F.lit(0)))
            .select("doc_id", "tokens", "salt", "first", "full", F.posexplode(F.sequence(F.lit(1), F.col("windows")))))
    k = F.col("pos").cast("long")
    byte = F.col("pos") * 4
    little = F.concat(*[F.substring("full", byte + i, 1) for i in (4, 3, 2, 1)])
    full = full.select(
        "doc_id", (k * window).alias("start"), F.lit(window).cast("long").alias("length"),
        F.conv(F.hex(little), 16, 10).cast("long").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"),
        (((F.col("first") + k) * salts + F.col("salt")) * 3 + 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))

    # remainders: rank in their bin = remainders of the bin in lower salts + rank within the salt
    rest = rows.filter("length > 0").select("doc_id", "uid", "tokens", "length", "prefix", "salt", "bin",
                                            (F.col("windows") * window).alias("start"))
    counts = rest.groupBy("bin", "salt").agg(F.count("*").alias("n"))
    lower = Window.partitionBy("bin").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(counts.withColumn("base", F.coalesce(F.sum("n").over(lower), F.lit(0))), "bases")
    histogram = {r["bin"]: r["n"] for r in bases.groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    runs, _, left = plan(histogram, window)
    taken = {b: histogram[b] - left[b] for b in histogram}
    ranked = rest.join(bases.select("bin", "salt", "base"), ["bin", "salt"]).withColumn(
        "rank", F.col("base") + F.row_number().over(Window.partitionBy("salt", "bin").orderBy("uid")) - 1)
    limit = F.element_at(F.expr("map(" + ",".join(f"{b},{t}L" for b, t in taken.items()) + ")")
                         if taken else F.expr("map(0, 0L)"), F.col("bin"))
    ranked = materialize(ranked.withColumn("combined", F.col("rank") < limit), "ranked")

    def place(batches):
        starts = {b: np.array([r[0] for r in rs]) for b, rs in runs.items()}
        for batch in batches:
            b, rank = batch["bin"].to_numpy(), batch["rank"].to_numpy()
            seq, slot = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            for value in np.unique(b):
                at = np.flatnonzero(b == value)
                run = np.array(runs[int(value)])[np.searchsorted(starts[int(value)], rank[at], "right") - 1]
                past = rank[at] - run[:, 0]
                seq[at], slot[at] = run[:, 2] + past // run[:, 1], run[:, 3] + past % run[:, 1]
            cols = [batch[c] for c in ("doc_id", "start", "length", "prefix", "tokens")]
            crc = [int(np.frombuffer(p[-4:], "<u4")[0]) for p in cols[3].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*cols[:3], pa.array(crc, pa.int64()), cols[4], pa.array(seq), pa.array(slot)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "seq", "slot"])

    placed = ranked.filter("combined").mapInArrow(
        place, f"doc_id {id_ddl}, start long, length long, ids_crc32 long, doc_tokens long, seq long, slot long")
    ahead = Window.partitionBy("seq").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))).withColumn(
        "sequence_id", F.col("seq") * 3)

    groups = max(1, -(-sum(left.values()) // group))
    greedy = (ranked.filter("not combined").withColumn("grp", F.pmod(F.xxhash64(F.lit(1), "uid"), F.lit(groups)))
              .select("doc_id", "uid", "start", "length", "prefix", "tokens", "grp")
              .groupBy("grp").applyInPandas(_greedy(window), (
                  f"doc_id {id_ddl}, start long, length long, ids_crc32 long, doc_tokens long, local long, "
                  "offset long, grp long"))
              .withColumn("sequence_id", (F.col("local") * groups + F.col("grp")) * 3 + 1))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return full.select(names).unionByName(placed.select(names)).unionByName(greedy.select(names))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op6_packing": op6_packing}
