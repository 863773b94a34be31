"""Registry of queries over the driver tables.

Every query builds its input from whole driver tables, row by row, and runs library operators on it. The
SQL text beside it computes the same rows from the tables directly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.session import spread

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    """A query with the operator ids it covers and the SQL that must agree with it (if SQL can)."""

    name: str
    covers: tuple[str, ...]
    run: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """File a query under ``name``."""

    def file(fn: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"query {name} is registered twice")
        CHECKS[name] = Check(name, tuple(covers.split()), fn, sql)
        return fn

    return file


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as the input of costly row-local work."""
    return spread(table(spark, sf_dir, name))


def s(value: str) -> Column:
    """Text literal."""
    return F.lit(value)


def text_el(value: Column) -> Column:
    """Element with a character string, as XML structs name it."""
    return F.struct(value.alias("CharacterString"))


def code_el(value: Column, tag: str) -> Column:
    """Element with a code list value."""
    return F.struct(F.struct(value.alias("_codeListValue")).alias(tag))


def page_title(html: Column) -> Column:
    """Title element of a page."""
    return F.regexp_extract(html, "<title>(.*?)</title>", 1)


PAGE_TITLE_SQL = "regexp_extract(html, '<title>(.*?)</title>', 1)"


def slug_sql(x: str) -> str:
    """Slug of a SQL expression."""
    return (
        f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'untitled' ELSE "
        f"left(trim(regexp_replace(lower({x}), '[^a-z0-9]+', '_', 'g'), '_'), 80) END"
    )


HOST_SQL = "regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)', 1)"
