"""Epoch seconds, hours and date parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

# The parts in order from coarse to fine; a granularity takes all parts up to itself.
DATE_PARTS = ("year", "month", "day", "hour", "minute", "dayofweek")


def event_time(epoch_seconds: Column) -> Column:
    """Epoch seconds (any numeric type) as a timestamp, with no detour through zone-dependent text."""
    return F.timestamp_seconds(epoch_seconds.cast("long"))


def hour_of(epoch_seconds: Column, grain: str = "hour") -> Column:
    """Start of the hour (or another grain) that holds the reading."""
    return F.date_trunc(grain, event_time(epoch_seconds))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp with or without zone."""
    return F.unix_seconds(ts.cast("timestamp"))


def parts_up_to(granularity: str) -> tuple[str, ...]:
    """Parts for a granularity; an unknown one means all of them."""
    if granularity not in DATE_PARTS:
        return DATE_PARTS
    return DATE_PARTS[: DATE_PARTS.index(granularity) + 1]


def _part(name: str, ts: Column) -> Column:
    # Monday is 0, as in pandas; Spark's own dayofweek starts with Sunday = 1.
    return F.weekday(ts) if name == "dayofweek" else getattr(F, name)(ts)


def with_date_parts(
    df: DataFrame, column: str, granularity: str = "day", keep_original: bool = False
) -> DataFrame:
    """Add ``{part}_ts`` columns for a timestamp, date or text column; text that is no time gives nulls.

    Their metadata holds a name with the source column in it: ``{column}_{part}_ts``.
    """
    kind = df.schema[column].dataType
    ts = F.col(column)
    if isinstance(kind, StringType):
        ts = F.try_to_timestamp(ts)
    elif not isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        raise TypeError(f"{column} is {kind.simpleString()}, not a time")
    out = df.withColumns({
        f"{p}_ts": _part(p, ts).alias(f"{p}_ts", metadata={"feature_name": f"{column}_{p}_ts"})
        for p in parts_up_to(granularity)
    })
    return out if keep_original else out.drop(column)
