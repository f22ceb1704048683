"""Best-fit packing by a configuration linear program (operator 11).

Documents are cut into pieces only where they are longer than a window. Whole windows are sequences of
their own; the lengths of all other pieces, rounded up to ``UNIT`` tokens, give a histogram. A configuration is
a multiset of lengths that fits a window; the program asks how often to use each so that every
length is covered and the fewest windows are used. It is solved by multiplicative weights: a
length weighs its tokens at first and less the more of it is covered, a knapsack by dynamic programming finds the
configurations of most weight, and each is used a little more, until (nearly) all is covered. The
counts are rounded, and pieces take the places of configurations by their rank in their length. What is left
over is packed best fit, longest first, in independent bounded groups.

At scale: the histogram has ``WINDOW / UNIT`` rows whatever the input, and it alone is solved in the driver.
Ranks come from counts per group, so neither a length nor the left-over is ever gathered in one task. A piece
carries its CRC from the start, so documents are tokenized once and their ids are never shuffled.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streammetrics.llm.common import materialize, table
from streammetrics.llm.tokens import WordEncoder, slices

WINDOW = 4096
UNIT = 2            # lengths are counted in bins of this many tokens
STEP = 0.25         # share of a length that one use of a configuration covers, at most
RATE = 2.0          # how fast a covered length loses weight
MANY = 64           # configurations taken from one pricing
NEAR = 0.9          # of the best configuration's weight, what the others need
ROUNDS = 1500       # pricings, at most; what is uncovered then is left over
COVERED = 0.995     # share of all tokens whose cover ends the solution
GROUP = 20_000      # pieces that one task ranks and packs
END = 1             # id that ends each document


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The process's encoder of a tokenizer file; its caches outlive a task."""
    return WordEncoder(path)


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, window: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, full): ``full`` numbers the whole windows and is null for other pieces."""
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = docs.schema[id_col].dataType
    arrow_id = to_arrow_type(id_type)

    def run(batches):
        encode = encoder(tokenizer_path).batch
        end = np.array([END], "<u4")
        full = TaskContext.get().partitionId() << 33
        for doc_ids, texts in slices(batches):
            ids, bounds = encode(texts)
            rows = []
            for doc_id, a, b in zip(doc_ids, bounds[:-1].tolist(), bounds[1:].tolist()):
                own = np.append(ids[a:b], end)
                for k, at in enumerate(range(0, len(own), window)):
                    piece = own[at:at + window]
                    number = None
                    if len(piece) == window:
                        number, full = full, full + 1
                    rows.append((doc_id, k, at, len(piece), zlib.crc32(piece), number))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [arrow_id, pa.int32(), *[pa.int64()] * 4])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "full"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long, full long")


Configuration = tuple[tuple[int, int], ...]      # (length, how often), lengths in units and ascending


def price(weights: np.ndarray, many: int = MANY, near: float = NEAR) -> list[Configuration]:
    """Configurations of most weight that fit ``len(weights) - 1`` units, heaviest first.

    Knapsack by dynamic programming over the room: the best filling of a room is the best first length
    with the best filling of the rest. Besides the best configuration, those that begin with another length
    and weigh nearly as much come from the same table. ``weights[0]`` is not used.
    """
    n = len(weights) - 1
    best = np.zeros(n + 1)                  # of room c at n - c, so that smaller rooms lie behind it
    first = np.zeros(n + 1, np.int64)
    room = np.empty(n)
    for c in range(1, n + 1):
        values = np.add(best[n - c + 1:], weights[1:c + 1], out=room[:c])
        k = int(values.argmax())
        best[n - c], first[c] = values[k], k + 1
    found: dict[Configuration, None] = {}
    values = np.where(weights[1:] > 0, room, -1.0)
    for k in np.argsort(-values, kind="stable")[:many]:
        if values[k] < near * best[0] or values[k] < 0:
            break
        used: dict[int, int] = {}
        b, c = int(k) + 1, n
        while c > 0:
            if weights[b] > 0:              # a length without weight stands for empty room
                used[b] = used.get(b, 0) + 1
            c -= b
            b = int(first[c])
        found[tuple(sorted(used.items()))] = None
    return list(found)


def solve(histogram: dict[int, int], bins: int, step: float = STEP, rate: float = RATE,
          rounds: int = ROUNDS) -> dict[Configuration, float]:
    """How often to use each configuration so that every length's count is (nearly) covered."""
    need = np.zeros(bins + 1)
    for b, n in histogram.items():
        need[b] = n
    inverse = np.divide(1.0, need, out=np.zeros(bins + 1), where=need > 0)
    lengths = np.arange(bins + 1, dtype=float)
    tokens = need * lengths
    covered = np.where(need > 0, 0.0, 1.0)
    use: dict[Configuration, float] = {}
    for _ in range(rounds):
        open_ = covered < 1 - 1e-9
        if (tokens * np.maximum(1 - covered, 0)).sum() <= (1 - COVERED) * tokens.sum():
            break
        for c in price(np.where(open_, np.exp(-rate * covered) * lengths, 0.0)):
            if any(covered[b] >= 1 - 1e-9 for b, _ in c):
                continue                    # covered by a configuration of the same pricing
            amount = step * min(need[b] / m for b, m in c)
            use[c] = use.get(c, 0.0) + amount
            for b, m in c:
                covered[b] += amount * m * inverse[b]
    return use


def plan(histogram: dict[int, int], bins: int) -> tuple[dict[int, list[tuple[int, int, int, int]]], dict[int, int]]:
    """(runs by length, pieces of each length that configurations take).

    A run (first rank, slots, first sequence, first slot) gives ranks to the slots that a configuration has
    for the length: rank r goes to sequence first + (r - first rank) // slots. Counts are rounded to
    whole uses, the most used first, as far as pieces last.
    """
    use = solve(histogram, bins)
    left, runs, sequences = dict(histogram), {}, 0
    for c in sorted(use, key=lambda c: (-use[c], c)):
        times = min([int(use[c] + 0.5), *[left[b] // m for b, m in c]])
        if times <= 0:
            continue
        slot = 0
        for b, m in c:
            runs.setdefault(b, []).append((histogram[b] - left[b], m, sequences, slot))
            left[b] -= m * times
            slot += m
        sequences += times
    return runs, {b: histogram[b] - left[b] for b in histogram}


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """(sequence, offset) of each piece: in the given order, each into the fullest sequence that has room."""
    rooms: list[tuple[int, int]] = []
    sequence, offset, n = [], [], 0
    for length in lengths:
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, s = rooms.pop(at)
        else:
            room, s, n = window, n, n + 1
        sequence.append(s)
        offset.append(window - room)
        if room > length:
            insort(rooms, (room - length, s))
    return sequence, offset


def _place(runs: dict, taken: dict, window: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """One group's pieces: by rank into configurations, the others best fit."""
    def run(items: pd.DataFrame, bases: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["bin", "uid"], ignore_index=True)
        base = dict(zip(bases["bin"], bases["base"]))
        b = items["bin"].to_numpy()
        rank = items.groupby("bin").cumcount().to_numpy() + np.array([base[v] for v in b], np.int64)
        seq, slot = np.full(len(b), -1, np.int64), np.full(len(b), -1, np.int64)
        for value in np.unique(b):
            at = np.flatnonzero((b == value) & (rank < taken.get(int(value), 0)))
            if len(at):
                rows = np.array(runs[int(value)])
                mine = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                past = rank[at] - mine[:, 0]
                seq[at], slot[at] = mine[:, 2] + past // mine[:, 1], mine[:, 3] + past % mine[:, 1]
        offset = np.full(len(b), -1, np.int64)
        rest = np.flatnonzero(seq < 0)
        rest = rest[np.argsort(-items["length"].to_numpy()[rest], kind="stable")]
        if len(rest):
            seq[rest], offset[rest] = best_fit(items["length"].to_numpy()[rest].tolist(), window)
        return items.assign(seq=seq, slot=slot, offset=offset).drop(columns=["uid", "bin"])
    return run


def pack(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece and its place.

    Null texts count as empty; an empty text has one token, its end. Repeated rows are documents of
    their own, and rows without an id are packed like others. A long text gives one sequence for each whole
    window and a shorter last piece. Other columns are not read. Empty in, empty out. Sequence ids are unique but
    not consecutive: remainder 0 modulo 3 means a configuration, 1 best fit, 2 a whole window.
    """
    if window % UNIT:
        raise ValueError(f"the window must be a multiple of {UNIT}")
    bins = window // UNIT
    id_ddl = docs.schema[id_col].dataType.simpleString()
    rows = materialize(pieces(docs, tokenizer_path or default_tokenizer(), id_col, text_col, window)
                       .withColumn("uid", F.monotonically_increasing_id()), "pieces")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = rows.where(F.col("full").isNotNull()).select(
        *names, (F.col("full") * 3 + 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    items = rows.where(F.col("full").isNull()).drop("full")
    groups = max(1, -(-items.count() // group))
    items = items.withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(groups))).withColumn(
        "bin", F.ceil(F.col("length") / UNIT).cast("int"))
    lower = Window.partitionBy("bin").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(items.groupBy("bin", "grp").agg(F.count("*").alias("n"))
                        .withColumn("base", F.coalesce(F.sum("n").over(lower), F.lit(0))), "bases")
    histogram = {r["bin"]: r["n"] for r in bases.groupBy("bin").agg(F.sum("n").alias("n")).collect()}  # at most ``bins`` rows
    runs, taken = plan(histogram, bins)

    placed = materialize(
        items.groupBy("grp").cogroup(bases.groupBy("grp")).applyInPandas(
            _place(runs, taken, window),
            f"doc_id {id_ddl}, piece int, start long, length long, ids_crc32 long, grp long, seq long, slot long, offset long"),
        "placed")
    best = placed.where("slot < 0").select(
        *names, ((F.col("seq") * groups + F.col("grp")) * 3 + 1).alias("sequence_id"), "offset")
    ahead = Window.partitionBy("seq").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    configured = placed.where("slot >= 0").select(
        *names, (F.col("seq") * 3).alias("sequence_id"), F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset"))
    return full.unionByName(best).unionByName(configured)


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op11_best_fit_packing": op11_best_fit_packing}
