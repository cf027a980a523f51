"""Named queries, each with its check query where SQL can express it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workload.tables import STAND_INS, bank_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}       # derived tables used by several check queries


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def full_sql(text: str) -> str:
    """Prefix the WITH clause of every derived table the text names, directly or not."""
    known = set(STAND_INS) | set(VIEWS)
    ordered: list[str] = []

    def visit(body: str) -> None:
        for word in dict.fromkeys(re.findall(r"\w+", body)):
            if word in known and word not in ordered:
                if word in VIEWS:
                    visit(VIEWS[word])
                ordered.append(word)

    visit(text)
    parts = [f"{n} as ({VIEWS[n] if n in VIEWS else bank_sql(n)})" for n in ordered]
    return (f"with {', '.join(parts)} " if parts else "") + text


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable output: rounded doubles, dates and times as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    """Rounded SQL expression: half up on the decimal text of the double, as Spark rounds it."""
    exact = f"cast(cast({expr} as double)::varchar as decimal(38, 17))"
    return f"cast(round({exact}, {digits}) as double) as {name or expr}"


def rs(*names: str, digits: int = 6) -> str:
    return ", ".join(r(n, digits=digits) for n in names)


def ts(expr: str, name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f') as {name or expr}"


def day(expr: str, name: str | None = None) -> str:
    return f"cast(cast({expr} as date) as varchar) as {name or expr}"
