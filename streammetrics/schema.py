"""Record schema of the medal stream and the types the line reader accepts."""

from __future__ import annotations

from pyspark.sql import types as T

# The 17-field positional record, in message order.
EVENT_FIELDS: tuple[tuple[str, T.DataType], ...] = (
    ("id", T.StringType()),
    ("name", T.StringType()),
    ("sex", T.StringType()),
    ("age", T.ShortType()),
    ("height", T.ShortType()),
    ("weight", T.FloatType()),
    ("team", T.StringType()),
    ("noc", T.StringType()),
    ("games", T.StringType()),
    ("year", T.ShortType()),
    ("season", T.StringType()),
    ("city", T.StringType()),
    ("sport", T.StringType()),
    ("event", T.StringType()),
    ("medal", T.StringType()),
    ("region", T.StringType()),
    ("notes", T.StringType()),
)

EVENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in EVENT_FIELDS])
EVENT_COLUMNS: tuple[str, ...] = tuple(n for n, _ in EVENT_FIELDS)

# The first 15 columns come from the events file, the last two from the lookup.
LOOKUP_KEY = "noc"
LOOKUP_COLUMNS: tuple[str, ...] = ("noc", "region", "notes")
SOURCE_COLUMNS: tuple[str, ...] = EVENT_COLUMNS[:15]

# Types a delimited line can be cast into; anything else is rejected when the
# reader is built, not per row.
INTEGRAL_TYPES = (T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType)
SUPPORTED_TYPES = INTEGRAL_TYPES + FRACTIONAL_TYPES + (T.StringType,)


def check_supported(schema: T.StructType) -> None:
    for f in schema.fields:
        if not isinstance(f.dataType, SUPPORTED_TYPES):
            raise ValueError(f"Unsupported type: {f.dataType.typeName()} (field {f.name!r})")
