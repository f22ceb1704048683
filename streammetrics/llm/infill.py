"""Fill-in-middle transformation over an indexable skip list (operator 12).

A text is cut into tokens (white space and the word after it; trailing white space is a token of
its own). The tokens form an indexable skip list: every link of a lane carries how many tokens and
how many code points it passes. From the top lane down, a link is followed while the tokens passed
stay within the wanted rank, which ends exactly at the cut in O(log n) links, and the accumulated code points
are the place of the cut in the text. Prefix, middle and suffix are then joined with markers, as
prefix-suffix-middle or suffix-prefix-middle.

Scoring is a map: a text never leaves its row, and nothing depends on other rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streammetrics.llm.common import mix64, table, text_batches

# Fixed values of the transformation.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
PLAIN_FROM = 50     # of 100 documents, those whose number is this or more stay plain
SPM_BELOW = 80      # of 100 cut documents, those whose number is below this are suffix-prefix-middle


def token_widths(text: str) -> np.ndarray:
    """Code points of each token ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``, left to right."""
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    blank = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    # A token ends where a word does; white space after the last word is the last token.
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    if blank[-1]:
        ends = np.append(ends, len(points))
    return np.diff(ends, prepend=0)


class SkipList:
    """Tokens by rank. Lane 0 links every token, and each higher lane about a quarter of the one below.

    A link of a lane ends at a node and carries the tokens (``units``) and code points (``points``)
    from the lane's node before it. ``below`` is the link of the next lower lane that ends at the
    same node. Towers come from a hash of the node's rank, so the same text gives the same list.
    """

    def __init__(self, widths: np.ndarray):
        units, points = np.ones(len(widths), np.int64), np.asarray(widths, np.int64)
        towers = mix64(np.arange(1, len(widths) + 1, dtype=np.uint64))
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        below = np.arange(len(widths))
        while len(units):
            self.lanes.append((units, points, below))
            below = np.flatnonzero(towers & np.uint64(3) == 0)
            if not len(below):
                break
            starts = np.append(0, below[:-1] + 1)
            last = below[-1] + 1        # links behind the last tower belong to no link of the higher lane
            units, points = np.add.reduceat(units[:last], starts), np.add.reduceat(points[:last], starts)
            towers = towers[below] >> np.uint64(2)

    def find(self, rank: int) -> tuple[int, int]:
        """(code points before the token of this rank, links followed); ``rank`` from 0 to the token count."""
        passed, place, links, at = 0, 0, 0, 0
        for lane in range(len(self.lanes) - 1, -1, -1):
            units, points, below = self.lanes[lane]
            while at < len(units) and passed + units[at] <= rank:
                passed, place, at, links = passed + int(units[at]), place + int(points[at]), at + 1, links + 1
            if passed == rank:
                break
            if lane:
                at = int(below[at - 1]) + 1 if at else 0
        if passed != rank:
            raise IndexError(rank)
        return place, links


def draws(doc_id, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document: the first hex groups of sha256 of seed, colon and decimal id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def transform(text: str, numbers: tuple[int, int, int, int], plain_from: int = PLAIN_FROM,
              spm_below: int = SPM_BELOW) -> tuple[int, str, int | None, int | None, str]:
    """(tokens, form, code points of the prefix, of the middle, output) of one text."""
    widths = token_widths(text)
    n = len(widths)
    if not text or numbers[2] % 100 >= plain_from or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    tokens = SkipList(widths)
    low, high = sorted((numbers[0] % (n + 1), numbers[1] % (n + 1)))
    a, b = tokens.find(low)[0], tokens.find(high)[0]
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if numbers[3] % 100 < spm_below:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                   plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """``id_col``, n, form, prefix_chars, middle_chars and output of every row.

    A null text counts as empty; an empty text, and one that holds a marker, stays plain whatever is
    drawn. A row without an id draws as one whose id is the empty string. Repeated rows give the same row
    each. A text is handled whole whatever its length, in memory and time linear in it. Other
    columns are not read. Empty in, empty out.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = docs.schema[id_col].dataType
    arrow_id = to_arrow_type(id_type)

    def run(batches):
        for ids, texts in text_batches(batches):
            rows = [transform(t, draws(i, seed), plain_from, spm_below) for i, t in zip(ids, texts)]
            n, form, prefix, middle, output = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, arrow_id), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                [id_col, "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type.simpleString()}, n long, form string, prefix_chars long, middle_chars long, "
             "output string")


def restored(output: Column, form: Column) -> Column:
    """The text from which an output of a form was made. No part holds a marker, so each marker is found once."""
    def between(first: str, second: str) -> Column:
        start = F.position(F.lit(first), output) + len(first)
        return F.substring(output, start, F.position(F.lit(second), output) - start)

    last = F.substring(output, F.position(F.lit(MIDDLE), output) + len(MIDDLE), F.length(output))
    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), last, between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), last, between(SUFFIX, PREFIX)))
            .otherwise(output))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES = {"op12_fill_in_middle": op12_fill_in_middle}

_TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

ORACLE_SQL = {"op12_fill_in_middle": f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_TOKEN}') AS tokens,
         sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s
  FROM documents),
h AS (
  SELECT doc_id, text, tokens, CAST(len(tokens) AS BIGINT) AS n,
         CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}')
                   OR contains(text, '{MIDDLE}') OR h3 % 100 >= {PLAIN_FROM} THEN 'plain'
              WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(tokens[:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
         array_to_string(tokens[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
         array_to_string(tokens[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS x
  FROM h)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || x || '{MIDDLE}' || m
                        ELSE '{SUFFIX}' || x || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""}
