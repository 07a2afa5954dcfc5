"""Text in and out: readings, id lists and request rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A decimal needs a point, the exponent is optional (integers are not readings).
DECIMAL_PATTERN = r"-?\d+\.\d+(?:[eE][-+]?\d+)?"
# The white space that splits an id list, Unicode spaces included.
SPACE_PATTERN = r"[\t-\r\x{1c}-\x{1f}\x{85}\p{Z}]+"
# The fields of a prediction request, in the order they are sent.
REQUEST_FIELDS = (
    ("hourly_timestamp", "string"),
    ("avg_energy", "double"),
    ("std_sensor_A", "double"),
    ("std_sensor_B", "double"),
    ("std_sensor_C", "double"),
    ("std_sensor_D", "double"),
    ("std_sensor_E", "double"),
    ("std_sensor_F", "double"),
    ("location", "string"),
    ("model", "string"),
    ("state", "string"),
)


def decimals_in(text: Column) -> Column:
    """Every decimal number in a text, as texts, in order."""
    return F.regexp_extract_all(text, F.lit(DECIMAL_PATTERN), F.lit(0))


def ids_in(text: Column) -> Column:
    """White-space separated ids as an array; blank text gives an empty array."""
    return F.filter(F.split(text, SPACE_PATTERN), lambda word: word != "")


def explode_ids(df: DataFrame, column: str, name: str = "turbine_id") -> DataFrame:
    """One row per id in a list, with its place in the list."""
    keep = [c for c in df.columns if c != column]
    return df.select(*keep, F.posexplode(ids_in(F.col(column))).alias("position", name))


def joined_values(columns: Sequence[Column]) -> Column:
    """Values in one line of text. A missing value is written ``None`` (``concat_ws`` alone would skip it)."""
    return F.concat_ws(" ", *[F.coalesce(c.cast("string"), F.lit("None")) for c in columns])


def parse_requests(df: DataFrame, column: str) -> DataFrame:
    """Turn list texts such as ``['2024-01-01 00:00:00', 1.5, ...]`` into typed rows with a ``status``.

    A list or tuple counts, a comma before its end too, and ``None`` outside quotes is a missing value. ``status`` is
    ``ok``, or ``invalid`` where the text is neither, goes on behind it, is empty, has the wrong number of items or an
    item that is no number where one belongs; the fields of an invalid request are null.
    """
    bare = F.trim(F.col(column))
    inner = F.regexp_replace(F.substring(bare, F.lit(2), F.length(bare) - 2), r",\s*$", "")
    closed = (bare.startswith("[") & bare.endswith("]")) | (bare.startswith("(") & bare.endswith(")"))
    # Each match goes on where the last one ended and swallows quoted texts whole, so it ends at a bare word.
    bare_none = r"""\G((?:[^'"N]|'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+"|N(?!one\b))*+)None\b"""
    as_json = F.concat(F.lit("["), F.regexp_replace(inner, bare_none, "$1null"), F.lit("]"))
    # A text with a bare bracket inside is no flat list; what does not look like one is not parsed.
    flat = ~F.regexp_replace(inner, r"""'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+\"""", "").rlike(r"[\[\](){}]")
    items = F.from_json(F.when(closed & flat, as_json), "array<string>")
    parsed = df.withColumn("_items", items)
    valid = F.size("_items") == len(REQUEST_FIELDS)
    for i, (_, kind) in enumerate(REQUEST_FIELDS):
        item = F.get("_items", F.lit(i))
        if kind != "string":
            valid = valid & (item.isNull() | item.try_cast(kind).isNotNull())
    valid = F.coalesce(valid, F.lit(False))
    fields = {
        name: F.when(valid, F.get("_items", F.lit(i))).try_cast(kind)
        for i, (name, kind) in enumerate(REQUEST_FIELDS)
    }
    return parsed.withColumns({**fields, "status": F.when(valid, "ok").otherwise("invalid")}).drop("_items")
