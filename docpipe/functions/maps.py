"""Maps, bytes and points in time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docpipe.functions.text import col


def value_or(m: Column | str, key: str, default: Column) -> Column:
    """The value of a key, or the default where the key or the map is missing."""
    return F.coalesce(F.try_element_at(col(m), F.lit(key)), default)


def has_key(m: Column | str, key: str) -> Column:
    return F.coalesce(F.map_contains_key(col(m), key), F.lit(False))


def merged(first: Column | str, second: Column | str) -> Column:
    """All keys of both; of a key in both the second's value."""
    a, b = (F.coalesce(col(m), F.create_map().cast("map<string,string>")) for m in (first, second))
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)


def without_nulls(m: Column | str) -> Column:
    return F.map_filter(col(m), lambda _, v: v.isNotNull())


def utf8(c: Column | str) -> Column:
    return F.encode(col(c), "UTF-8")


def from_utf8(c: Column | str) -> Column:
    return F.decode(col(c), "UTF-8")


def now_iso() -> Column:
    """The current time in UTC, as ISO text with microseconds."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    return (F.unix_micros(col(end).cast("timestamp")) - F.unix_micros(col(start).cast("timestamp"))) / 1e6


def days(seconds: Column | str) -> Column:
    return col(seconds) / 86400
