"""Message lines derived from the record table, with malformed and edge-case lines.

Every record becomes exactly one line. A variant number
``(orderkey * 7 + linenumber) % 20`` picks how the line is written; variants
0–10 are malformed (the parser must drop them), variants 11–19 are well formed
and must parse back to the original record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lines import DEFAULT_NULL
from ..schema import EVENT_COLUMNS

VARIANT = "variant"
REJECTED_VARIANTS = tuple(range(0, 11))

_CSV = {"sep": ",", "quote": '"', "escape": '"', "nullValue": DEFAULT_NULL,
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _line(fields: dict[str, Column], quote_all: bool = False,
          columns: tuple[str, ...] = EVENT_COLUMNS) -> Column:
    opts = dict(_CSV, quoteAll="true") if quote_all else _CSV
    return F.to_csv(F.struct(*[fields[c].alias(c) for c in columns]), opts)


def variant_lines(records: DataFrame) -> DataFrame:
    """``records`` (17 columns + orderkey, linenumber) → (variant, orderkey, value).

    Field-level variants change one field before a single ``to_csv``; line-level
    variants then rewrite that line, so the plan holds two CSV encoders only.
    """
    k = ((F.col("orderkey") * 7 + F.col("linenumber")) % 20).cast("int")
    s = {c: F.col(c).cast("string") for c in EVENT_COLUMNS}
    field_variants = {
        "age": [(2, F.concat(F.lit("x"), F.coalesce(s["age"], F.lit("")))),   # not a number
                (3, F.lit("")),                                               # empty number
                (4, F.concat(F.lit(" "), F.coalesce(s["age"], F.lit("1")))),  # leading blank
                (11, F.concat(F.lit("+"), s["age"]))],                        # explicit sign
        "height": [(5, F.lit("99999"))],                                      # out of range
        "year": [(6, F.concat(F.coalesce(s["year"], F.lit("1")), F.lit(".0")))],
        "weight": [(12, F.concat(F.lit(" "), s["weight"], F.lit(" "))),       # padded float
                   (13, F.concat(s["weight"], F.lit("f"))),                   # float suffix
                   (16, F.concat(s["weight"], F.lit("e0")))],                 # exponent
    }
    fields = {}
    for c in EVENT_COLUMNS:
        expr = None
        for num, val in field_variants.get(c, []):
            expr = (F.when(k == num, val) if expr is None else expr.when(k == num, val))
        fields[c] = s[c] if expr is None else expr.otherwise(s[c])
    # The line is encoded once in its own projection; the line-level variants
    # below then only rewrite that column.
    base = records.select(k.alias(VARIANT), F.col("id"), F.col("orderkey"), (F.col("orderkey") % 101 == 0).alias("_huge"),
                          _line(fields).alias("_line"),
                          F.when(k == 15, _line(s, quote_all=True)).alias("_quoted"))
    k, line, first = F.col(VARIANT), F.col("_line"), F.col("id")   # id: digits only, never quoted
    rest = F.substring(line, F.length(first) + 1, 1 << 30)
    value = (
        F.when(k == 0, F.regexp_replace(line, ",[^,]*$", ""))                     # 16 fields
         .when((k == 1) & F.col("_huge"), F.concat(line, F.repeat(F.lit(","), 25_000)))  # 25,017 fields
         .when(k == 1, F.concat(line, F.lit(",x")))                               # 18 fields
         .when(k == 7, F.concat(F.lit('"un'), line))                              # unterminated
         .when(k == 8, F.concat(F.lit('"a"b'), rest))                             # text after quote
         .when(k == 9, F.lit(""))                                                 # blank line
         .when(k == 10, F.lit(",".join(EVENT_COLUMNS)))                           # header line
         .when(k == 14, F.concat(F.lit('"'), first, F.lit('"'), rest))           # quoted id
         .when(k == 15, F.col("_quoted"))                                         # all quoted, "NA"
         .otherwise(line))
    return base.select(k, "orderkey", value.alias("value"))
