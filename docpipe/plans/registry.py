"""Registration of named queries with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            key = name or f.__name__
            self.queries[key] = f
            if sql is not None:
                self.sql[key] = sql
            return f

        return add


# Pieces of DuckDB SQL that say the same as the functions of docpipe.functions.text, written for the other engine.
SQL_WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')"


def sql_squeeze(x: str) -> str:
    return f"regexp_replace({x}, '{SQL_WS}+', ' ', 'g')"


def sql_clean(x: str) -> str:
    return sql_strip(f"regexp_replace({sql_squeeze(x)}, '&[a-z]+;', '', 'gi')")


def sql_tokens(x: str) -> str:
    return f"CAST(floor(length({x}) * CAST(0.6 AS DOUBLE)) AS INTEGER)"
