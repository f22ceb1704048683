"""Delimited lines ⇄ typed records, as native Spark column expressions.

Line format (one record per line):

* fields are split on a one-character delimiter (default ``,``);
* a field that *starts* with the quote character (default ``"``) is quoted: it
  runs to the matching closing quote, a doubled quote inside it is one quote,
  and the closing quote must be followed by the delimiter or the end of line;
* any other field is plain: it runs to the next delimiter, may contain quotes
  after its first character, and is taken literally (no trimming, no
  backslash escapes); an empty plain field is the empty string;
* a trailing delimiter means a trailing empty field;
* a field equal to the null token (default ``NA``, quoted or not) is null;
* numbers are strict: integers are ``[+-]?digits`` in range, floating point
  follows Java's ``Float/Double.valueOf`` (``NaN``, ``Infinity``, ``1e3``,
  ``1f``, hex, surrounding blanks); an empty numeric field is malformed.

A line is malformed when its structure is broken (text after a closing
quote, unterminated quote), its field count differs from the schema, or a
typed field doesn't parse. ``DROPMALFORMED`` drops such lines,
``FAILFAST`` fails the job naming the line.

Implementation: a possessive regular expression (a scan over the split line for schemas of
more than ``MAX_FIELDS`` fields) checks the structure and the field count, ``from_csv`` splits and unquotes into strings, and ``try_cast``
plus strict patterns convert — all in one JVM projection with no Python
worker, for batch and streaming DataFrames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import EVENT_SCHEMA, FRACTIONAL_TYPES, INTEGRAL_TYPES, check_supported

MODES = ("DROPMALFORMED", "FAILFAST")

# Defaults of the line format.
DEFAULT_DELIMITER = ","
DEFAULT_QUOTE = '"'
DEFAULT_NULL = "NA"

# A string that cannot occur in a line; used so that from_csv never nulls a field itself.
_SENTINEL = "\u0001\u0002null\u0002\u0001"

# Range and most digits (leading zeros apart) of the integral types.
_INT_RANGES = {T.ByteType: (7, 3), T.ShortType: (15, 5), T.IntegerType: (31, 10), T.LongType: (63, 19)}
# Every number that try_cast takes holds one of these; for a text without it no cast is tried.
_FLOAT_HINT = r"[0-9]|(?i:inf|nan)"
# try_cast also takes these spellings, which Java's Float/Double parsers refuse.
_LOOSE_SPECIALS = r"\A(?![+-]?(?:Infinity|NaN)\z)[+-]?(?i:inf|infinity|nan)\z"


def _jre(ch: str) -> str:
    """Escape one character for a Java regex, inside or outside a class."""
    if len(ch) != 1:
        raise ValueError(f"delimiter and quote must be single characters, got {ch!r}")
    if ch.isalnum() and ch.isascii():
        return ch
    return "\\x{%x}" % ord(ch)


# One regular expression over all fields guards schemas up to this width; a far wider one would
# overflow its matcher's stack, so wider schemas are guarded by a scan over the split line.
MAX_FIELDS = 500


def structure_pattern(n_fields: int, delimiter: str = DEFAULT_DELIMITER,
                      quote: str = DEFAULT_QUOTE) -> str:
    """Java regex matching exactly the well-formed lines with ``n_fields`` fields.

    A field is a quoted field (quote, runs of non-quotes or doubled quotes,
    quote), a plain field (not starting with a quote, no delimiter), or empty.
    Quantifiers are possessive so long fields can't cause backtracking.
    """
    if delimiter == quote:
        raise ValueError("delimiter and quote must differ")
    if not 1 <= n_fields <= MAX_FIELDS:
        raise ValueError(f"between 1 and {MAX_FIELDS} fields are supported, got {n_fields}")
    d, q = _jre(delimiter), _jre(quote)
    field = f'(?:{q}(?:[^{q}]++|{q}{q})*+{q}|[^{d}{q}][^{d}]*+|)'
    return rf"\A{field}(?:{d}{field}){{{n_fields - 1}}}\z"


def structure_scan(value: Column, n_fields: int, delimiter: str = DEFAULT_DELIMITER,
                   quote: str = DEFAULT_QUOTE) -> Column:
    """True for the well-formed lines with ``n_fields`` fields, whatever the width; null for a null line.

    The line is split at every delimiter and the pieces are scanned in order: a piece inside a quoted
    field carries that state on to the next. Behind the opening quote (if any) doubled quotes are
    taken out; then no quote left means that the field goes on behind the delimiter, a single one at the
    end closes it, and any other is text after a closing quote.
    """
    if delimiter == quote:
        raise ValueError("delimiter and quote must differ")
    _jre(quote)
    q, none = F.lit(quote), F.lit("")

    def step(state: Column, piece: Column) -> Column:
        inside, opens = state["inside"], ~state["inside"] & piece.startswith(q)
        rest = F.replace(F.when(opens, F.substring(piece, F.lit(2), F.length(piece))).otherwise(piece),
                         F.lit(quote * 2), none)
        at = F.position(q, rest)
        quoted = inside | opens
        goes_on = quoted & (at == 0)
        broken = quoted & (at > 0) & (at < F.length(rest))
        return F.struct(goes_on.alias("inside"), (state["broken"] | broken).alias("broken"),
                        (state["fields"] + F.when(goes_on, 0).otherwise(1)).alias("fields"))

    start = F.struct(F.lit(False).alias("inside"), F.lit(False).alias("broken"), F.lit(0).alias("fields"))
    return F.aggregate(F.split(value, _jre(delimiter)), start, step,
                       lambda state: ~state["inside"] & ~state["broken"] & (state["fields"] == n_fields))


def well_formed(value: Column, n_fields: int, delimiter: str = DEFAULT_DELIMITER,
                quote: str = DEFAULT_QUOTE) -> Column:
    """Whether a line has ``n_fields`` fields in a sound structure; false for a null line."""
    if n_fields <= MAX_FIELDS:
        right = value.rlike(structure_pattern(n_fields, delimiter, quote))
    else:
        right = structure_scan(value, n_fields, delimiter, quote)
    return F.coalesce(right, F.lit(False))


def _java_float_ok(s: Column) -> Column:
    return ~F.trim(s).rlike(_LOOSE_SPECIALS)


def _integer(s: Column, dt: T.DataType) -> Column:
    """The integer that a text spells, null if it spells none or one out of range. A failed cast raises
    and formats an exception inside Spark, so texts of other forms don't reach the cast."""
    bits, digits = _INT_RANGES[type(dt)]
    number = F.when(s.rlike(rf"\A[+-]?0*[0-9]{{1,{digits}}}\z"), s).try_cast("bigint")
    if isinstance(dt, T.LongType):
        return number
    return F.when(number.between(-(1 << bits), (1 << bits) - 1), number).cast(dt)


def split_fields(value: Column, n_fields: int, *, delimiter: str = DEFAULT_DELIMITER,
                 quote: str = DEFAULT_QUOTE) -> Column:
    """Struct ``_c0 … _c{n-1}`` of the unquoted field texts (null = empty plain field).

    The splitter fails a job on a line with more columns than it can hold, so pass it
    only lines that are ``well_formed`` (null for any other). It touches room for all columns it can
    hold on every line, so that is little more than ``n_fields``.
    """
    raw_schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(n_fields)])
    opts = {"sep": delimiter, "quote": quote, "escape": quote, "nullValue": _SENTINEL,
            "maxCharsPerColumn": "-1", "maxColumns": str(2 * n_fields + 64), "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "mode": "PERMISSIVE"}
    return F.from_csv(value, raw_schema.simpleString(), opts)


def parse_columns(value: Column, schema: T.StructType = EVENT_SCHEMA, *,
                  delimiter: str = DEFAULT_DELIMITER, quote: str = DEFAULT_QUOTE,
                  null_value: str = DEFAULT_NULL,
                  fields: Column | None = None, right: Column | None = None) -> tuple[list[Column], Column]:
    """Typed field columns and a well-formedness flag for a line column.

    ``fields`` and ``right`` may pass an already computed ``split_fields`` struct and
    structure check.
    """
    check_supported(schema)
    n = len(schema.fields)
    if right is None:
        right = well_formed(value, n, delimiter, quote)
    parsed = fields
    if parsed is None:
        parsed = split_fields(F.when(right, value), n, delimiter=delimiter, quote=quote)
    ok = right
    cols: list[Column] = []
    for i, f in enumerate(schema.fields):
        text = F.coalesce(parsed.getField(f"_c{i}"), F.lit(""))
        s = F.when(text != F.lit(null_value), text)
        dt = f.dataType
        if isinstance(dt, T.StringType):
            cols.append(s.alias(f.name))
            continue
        if isinstance(dt, INTEGRAL_TYPES):
            typed = _integer(s, dt)
            good = s.isNull() | typed.isNotNull()
        elif isinstance(dt, FRACTIONAL_TYPES):
            typed = F.when(s.rlike(_FLOAT_HINT), s).try_cast(dt)
            good = s.isNull() | (typed.isNotNull() & _java_float_ok(s))
        else:  # pragma: no cover - check_supported rejects it
            raise ValueError(f"Unsupported type: {dt.typeName()}")
        ok = ok & good
        cols.append(typed.alias(f.name))
    return cols, ok


OK = "__ok"


def flag_lines(lines: DataFrame, schema: T.StructType = EVENT_SCHEMA, *,
               column: str = "value", delimiter: str = DEFAULT_DELIMITER,
               quote: str = DEFAULT_QUOTE, mode: str = "DROPMALFORMED",
               null_value: str = DEFAULT_NULL, keep_line: bool = False) -> DataFrame:
    """Every line as ``__ok`` + the typed fields, in one projection.

    Fields of a line whose ``__ok`` is false are meaningless. In FAILFAST mode
    evaluating ``__ok`` of a malformed line fails the job with the line.
    ``keep_line`` adds the line itself as ``__line``.
    """
    m = mode.upper()
    if m not in MODES:
        raise ValueError(f'Unknown parse mode: "{mode}"')
    check_supported(schema)
    n = len(schema.fields)
    right = well_formed(F.col(column), n, delimiter, quote)
    src = lines.select(F.col(column).alias("__line"), right.alias("__right"))
    src = src.select("__line", "__right", split_fields(F.when(F.col("__right"), F.col("__line")), n,
                                                       delimiter=delimiter, quote=quote).alias("__f"))
    cols, ok = parse_columns(F.col("__line"), schema, delimiter=delimiter, quote=quote,
                             null_value=null_value, fields=F.col("__f"), right=F.col("__right"))
    if m == "FAILFAST":
        ok = F.when(ok, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("Malformed line: <"), F.col("__line"), F.lit(">"))))
    return src.select(ok.alias(OK), *cols, *([F.col("__line")] if keep_line else []))


def parse_lines(lines: DataFrame, schema: T.StructType = EVENT_SCHEMA, *,
                column: str = "value", delimiter: str = DEFAULT_DELIMITER,
                quote: str = DEFAULT_QUOTE, mode: str = "DROPMALFORMED",
                null_value: str = DEFAULT_NULL) -> DataFrame:
    """Lines → typed records (batch or streaming).

    ``mode`` is case-insensitive, one of DROPMALFORMED (default) and FAILFAST;
    other modes and unsupported field types are refused before any job runs.
    """
    typed = flag_lines(lines, schema, column=column, delimiter=delimiter, quote=quote,
                       mode=mode, null_value=null_value)
    # One projection computes the flag and the typed fields (sharing the split
    # fields and casts), then each line yields an array of zero or one record
    # that ``inline`` expands. A generator rather than a filter: a filter would
    # be pushed below the projection with the split inlined into every check.
    # In FAILFAST mode the flag raises, and it sits in the generator's input, so
    # pruning can't remove it.
    one = F.array(F.struct(*[F.col(n) for n in schema.fieldNames()]))
    return typed.select(F.inline(F.when(F.col(OK), one)))


def malformed_lines(lines: DataFrame, schema: T.StructType = EVENT_SCHEMA, *,
                    column: str = "value", delimiter: str = DEFAULT_DELIMITER,
                    quote: str = DEFAULT_QUOTE, null_value: str = DEFAULT_NULL) -> DataFrame:
    """The lines that DROPMALFORMED would drop (for diagnostics), in ``column``; each line is split once."""
    flagged = flag_lines(lines, schema, column=column, delimiter=delimiter, quote=quote,
                         null_value=null_value, keep_line=True)
    return flagged.select(F.inline(F.when(~F.col(OK), F.array(F.struct(F.col("__line").alias(column))))))


def encode_lines(records: DataFrame, columns: list[str] | tuple[str, ...] | None = None, *,
                 delimiter: str = DEFAULT_DELIMITER, quote: str = DEFAULT_QUOTE,
                 null_value: str = DEFAULT_NULL, null_as_empty: bool = False,
                 column: str = "value") -> DataFrame:
    """Records → one delimited line per row in ``column``.

    Quotes are escaped by doubling, whitespace is kept, empty strings are
    written as ``""`` and nulls as the null token, so that ``parse_lines``
    restores the record. ``null_as_empty`` writes nulls as empty fields instead
    (the form a pandas export produces).
    """
    cols = list(columns) if columns else records.columns
    opts = {"sep": delimiter, "quote": quote, "escape": quote,
            "nullValue": "" if null_as_empty else null_value,
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return records.select(F.to_csv(F.struct(*[F.col(c) for c in cols]), opts).alias(column))


def decode_payload(payload: Column) -> Column:
    """Message bytes → text; invalid UTF-8 sequences become U+FFFD."""
    return F.make_valid_utf8(payload.cast("string"))
