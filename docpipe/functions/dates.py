"""Dates as written in Chilean legal pages."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from docpipe.functions.text import WS, col, group1, strip

# Month names in Spanish, in order.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
ABBREVIATED = tuple(m[:3] for m in MONTHS)
DAY_MONTH_YEAR = r"(\d{1,2})-([A-Za-z]{3})-(\d{4})"


def month_number(name: Column, names: tuple[str, ...]) -> Column:
    """1..12, or null for a name that is none of `names`."""
    table = F.create_map(*chain.from_iterable((F.lit(n), F.lit(i)) for i, n in enumerate(names, 1)))
    return F.try_element_at(table, F.lower(name))


def from_parts(year: Column, month: Column, day: Column) -> Column:
    """The date, or null if there is no such day."""
    return F.try_to_date(F.format_string("%s-%s-%s", year, month.cast("string"), day), "yyyy-M-d")


def parse_date(c: Column | str) -> Column:
    """ISO date (nothing may follow it), d-MMM-yyyy or `d de month de yyyy` at the start of the text; else null."""
    t = strip(c)
    short = [group1(t, f"^{DAY_MONTH_YEAR}", i) for i in (1, 2, 3)]
    long_pattern = rf"(?iu)^(\d{{1,2}}){WS}+de{WS}+(\w+){WS}+de{WS}+(\d{{4}})"
    long = [group1(t, long_pattern, i) for i in (1, 2, 3)]
    short_month, long_month = month_number(short[1], ABBREVIATED), month_number(long[1], MONTHS)
    return (
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd")))
        .when(short_month.isNotNull(), from_parts(short[2], short_month, short[0]))
        .when(long_month.isNotNull(), from_parts(long[2], long_month, long[0]))
    )


def labelled_date(text: Column | str, label: str) -> Column:
    """The date d-MMM-yyyy behind `label:`."""
    return parse_date(group1(col(text), rf"(?iu){label}:{WS}*(\d{{1,2}}-[A-Z]{{3}}-\d{{4}})"))
