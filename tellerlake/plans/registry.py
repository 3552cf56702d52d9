"""Registration of queries with the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DecimalType, IntegerType, ShortType, TimestampNTZType, TimestampType

from tellerlake.plans.bank_sql import VIEWS

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
CHECK_SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types any SQL engine renders alike: money as DOUBLE, counts as BIGINT, times as text."""

    def render(field):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, DecimalType):
            column = column.cast("double")
        elif isinstance(kind, (ByteType, ShortType, IntegerType)):
            column = column.cast("bigint")
        elif isinstance(kind, DateType):
            column = column.cast("string")
        elif isinstance(kind, (TimestampType, TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        return column.alias(field.name)

    return df.select(*[render(f) for f in df.schema.fields])


def with_views(body: str) -> str:
    """Prefix ``body`` with the shared views it names, directly or through other views."""
    needed: set[str] = set()
    queue = [body]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in words & VIEWS.keys() - needed:
            needed.add(name)
            queue.append(VIEWS[name])
    views = ",\n".join(f"{name} AS ({text})" for name, text in VIEWS.items() if name in needed)
    if not views:
        return body
    own = body.startswith("WITH")
    return f"WITH {views}{',' if own else ''}\n{body.removeprefix('WITH') if own else body}"


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query, and its check if SQL can express one."""

    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(build(spark, sf_dir))
        if sql is not None:
            CHECK_SQL[name] = with_views(sql.strip())
        return build

    return register
