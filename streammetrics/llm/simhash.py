"""SimHash near-dedup with Golay-code fuzzy hashing (operator 5).

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, padded to words of the
perfect (23, 12) Golay code. A word's keys are the codewords to which it or one of its
one-bit neighbours decodes: one or at most six indices, such that words two bits apart share one.
Of two fingerprints at most four bits apart, the two least differing segments differ in at
most two bits each (pigeonhole), so they share a key in both segments of some pair. Distinct
fingerprints meet on these 24-bit keys, are compared exactly, and the links' components found.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streammetrics.llm.common import materialize, per_text, table
from streammetrics.llm.components import connected_components, forest

SHINGLE = 4
MAX_BITS = 4
WIDTHS = (22, 21, 21)
POLYNOMIAL = 0xC75        # generator of the (23, 12) Golay code
BLOCK = 16384             # fingerprints of one key compared in one piece; larger keys are split

_OFFSETS = np.arange(8) * 256
_BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles; 0 for a null text or one without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[:len(words) - shingle] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[i:j], 42) for i, j in zip(starts, ends[shingle - 1:].tolist())]
    counts = np.zeros((8, 256), np.int64)
    for at in range(0, len(hashes), 1 << 18):
        h = np.array(hashes[at:at + (1 << 18)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.bincount((h + _OFFSETS).ravel(), minlength=2048).reshape(8, 256)
    ones = 2 * (counts @ _BYTE_BITS).ravel() > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``id_col`` and ``fp`` of every row; no other column is read."""
    return per_text(docs, lambda t: (fingerprint(t, shingle),), "fp long", id_col, text_col)


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= POLYNOMIAL << (bit - 11)
    return word


def decode_tables(width: int) -> tuple[np.ndarray, np.ndarray]:
    """(remainder of each message part, error vectors by remainder).

    Error vectors take a word to the codewords that it and its neighbours decode to; -1 fills up.
    """
    message = np.array([_remainder(m << 11) for m in range(4096)])
    leader = np.zeros(2048, np.int64)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            leader[(e & 2047) ^ message[e >> 11]] = e
    flips = [1 << b for b in range(23 - width, 23)]  # padding bits never differ
    errors = np.full((2048, 24), -1, np.int64)
    widest = 1
    for s in range(2048):
        found = {int(leader[s])} | {f ^ int(leader[s ^ (f & 2047) ^ message[f >> 11]]) for f in flips}
        errors[s, :len(found)] = sorted(found)
        widest = max(widest, len(found))
    return message, errors[:, :widest]


def segment_keys(fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each segment: codeword indices of every fingerprint, and which of them count."""
    out, shift = [], 0
    for width in WIDTHS:
        message, errors = decode_tables(width) if width not in _TABLES else _TABLES[width]
        _TABLES[width] = message, errors
        word = ((fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64) << (23 - width)
        e = errors[(word & 2047) ^ message[word >> 11]]
        out.append(((word[:, None] ^ e) >> 11, e >= 0))
        shift += width
    return out


_TABLES: dict = {}


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) pairs for all segment pairs and index combinations."""
    segments = segment_keys(fp)
    keys, owners = [], []
    for p, (i, j) in enumerate(combinations(range(len(WIDTHS)), 2)):
        (a, ok_a), (b, ok_b) = segments[i], segments[j]
        key = (p << 24) | (a[:, :, None] << 12) | b[:, None, :]
        ok = ok_a[:, :, None] & ok_b[:, None, :]
        keys.append(key[ok])
        owners.append(np.broadcast_to(fp[:, None, None], ok.shape)[ok])
    return np.concatenate(keys), np.concatenate(owners)


def _emit_keys(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            fp = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
            key, owner = keys_of(fp)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(owner.view(np.int64))], ["key", "fp"])


def _run_links(key: np.ndarray, fp: np.ndarray, side: np.ndarray, max_bits: int):
    """Links between fingerprints of equal keys (sorted); where a side is set, only across sides."""
    bounds = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    sizes = np.diff(bounds)
    for start, size in zip(bounds[:-1][sizes > 128].tolist(), sizes[sizes > 128].tolist()):
        f, s = fp[start:start + size], side[start:start + size]
        a, b = [], []
        for d in range(1, size):
            hit = np.flatnonzero((np.bitwise_count(f[d:] ^ f[:-d]) <= max_bits)
                                 & ((s[d:] != s[:-d]) | (s[d:] == 0)))
            if len(hit):
                a.append(f[hit])
                b.append(f[hit + d])
                if len(a) >= 256:
                    x, y = forest(np.concatenate(a), np.concatenate(b))
                    a, b = [x], [y]
        if a:
            yield forest(np.concatenate(a), np.concatenate(b))
    left = np.flatnonzero(np.repeat(sizes <= 128, sizes))
    d = 0
    while len(left):
        d += 1
        left = left[left + d < len(key)]
        left = left[key[left + d] == key[left]]
        hit = left[(np.bitwise_count(fp[left] ^ fp[left + d]) <= max_bits)
                   & ((side[left] != side[left + d]) | (side[left] == 0))]
        if len(hit):
            yield fp[hit], fp[hit + d]


def _verify(max_bits: int):
    """Sorted (key, side, fp) batches → a spanning forest of the links found in the partition."""
    def run(batches):
        held: list[list[np.ndarray]] = []  # the last key's rows; a key never has over two blocks' rows
        a, b, n = [], [], 0

        def found(parts):
            nonlocal a, b, n
            key, side, fp = (np.concatenate(x) for x in zip(*parts))
            for x, y in _run_links(key, fp.view(np.uint64), side, max_bits):
                a.append(x)
                b.append(y)
                n += len(x)
            if n > 200_000:
                x, y = forest(np.concatenate(a), np.concatenate(b))
                a, b, n = [x], [y], 0

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last key may go on in the next batch
            if held and (cut or cols[0][0] != held[0][0][0]):
                found([*held, [c[:cut] for c in cols]])
                held = []
            elif cut:
                found([[c[:cut] for c in cols]])
            held.append([c[cut:] for c in cols])
        if held:
            found(held)
        if a:
            x, y = forest(np.concatenate(a), np.concatenate(b))
            for at in range(0, len(x), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[at:at + 100_000].view(np.int64)), pa.array(y[at:at + 100_000].view(np.int64))],
                    ["a", "b"])
    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) spanning the same components as all pairs of ``fp`` within ``max_bits``.

    ``distinct`` holds each fingerprint once. A key with more than ``block`` fingerprints is
    split into blocks, and each pair of blocks is compared in a task of its own.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"three Golay segments find pairs of at most {MAX_BITS} differing bits")
    keys = distinct.select("fp").mapInArrow(_emit_keys, "key long, fp long")
    hot = materialize(keys.groupBy("key").count().filter(F.col("count") > block), "hot-keys")
    rows = keys.withColumn("side", F.lit(0))
    if not hot.isEmpty():
        parts = F.ceil(F.col("count") / block).cast("int")
        split = keys.join(hot, "key").select(
            "key", "fp", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("own"))
        pairs = split.select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        rows = keys.join(hot, "key", "left_anti").withColumn("side", F.lit(0)).unionByName(
            # one key for each pair of blocks; equal blocks compare all their rows
            pairs.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp",
                         F.when(F.col("own") == F.col("other"), 0).otherwise(F.col("own") + 1).alias("side")))
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.select("key", "side", "fp").repartition(n, "key").sortWithinPartitions("key")
            .mapInArrow(_verify(max_bits), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``id_col``, ``fp`` and ``component_id`` (smallest id linked directly or through others) of every row.

    Null, empty and blank texts have fingerprint 0 and link like any other. Repeated rows are
    each returned. A row without an id belongs to its component but never names it; a
    component of such rows only has a null ``component_id``. Empty in, empty out.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min(id_col).alias("id")), "distinct-fingerprints")
    roots = connected_components(links(distinct, max_bits, block))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = named.join(smallest, "root").select("fp", "component_id")
    return fps.join(classes, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component one row of ``docs``: that with the smallest id, and of those with one id the smallest text hash.

    Unlike texts under one id are in components of their own and are decided each by itself; of rows that
    differ in other columns only, the first as JSON stays. A row without an id stays only where no row of its
    component has one, and of several that with the smallest text hash.
    """
    row = "row"
    while row in docs.columns:
        row += "_"
    key = F.unhex(F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit("")))
    keyed = docs.withColumn(row, F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), key.alias("key")))
    found = materialize(near_duplicates(keyed, row, text_col), "components")
    # Rows order by no_id first, so a component is named by a row with an id if it has one.
    best = found.groupBy(row).agg(F.count("*").alias("rows"), F.min("component_id").alias("component_id"))
    best = materialize(best.select(row, "rows", (F.col(row) != F.col("component_id")).cast("int").alias("other")), "kept-rows")
    kept = keyed.join(best.filter("other = 1").select(row), row, "left_anti")
    repeated = best.filter("other = 0 and rows > 1").select(row)
    if repeated.isEmpty():
        return kept.select(docs.columns)
    whole = F.struct(*docs.columns)
    once = kept.join(repeated, row, "left_semi").groupBy(row).agg(F.min_by(whole, F.to_json(whole)).alias("one"))
    return kept.join(repeated, row, "left_anti").select(docs.columns).unionByName(once.select("one.*"))


def op5_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op5_simhash_golay": op5_simhash_golay}
