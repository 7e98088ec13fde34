"""Names to query functions and to the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .standins import VIEWS, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}  # without the view definitions, see `oracle_sql`


def with_views(sql: str) -> str:
    """Prefix `sql` with the views it mentions, and those they mention, in definition order."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name, body in VIEWS.items():
            if name in text and name not in needed:
                needed.add(name)
                todo.append(body)
    ctes = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed]
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(ctes) + ", " + body[5:]
    return "WITH " + ", ".join(ctes) + " " + body


def query(name: str, sql: str | None = None, doubles: str = ""):
    """Register fn(Tables) -> DataFrame under `name`; doubles are rounded to 6 places on both sides.

    `doubles` names the columns of `sql` that can hold fractions.
    """

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(Tables(spark, sf_dir)))
        if sql is not None:
            text = sql
            if doubles:
                fixes = ", ".join(f'round("{c}", 6) AS "{c}"' for c in doubles.split())
                text = f"SELECT * REPLACE ({fixes}) FROM ({sql})"
            ORACLES[name] = text
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of places; adding 0 turns a negative zero into zero."""
    return df.select(*[
        (F.round(F.col(f"`{n}`"), digits) + F.lit(0.0)).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes
    ])


def oracle_sql() -> dict[str, str]:
    """Complete SQL per query; views are resolved once all modules have defined theirs."""
    return {name: with_views(text) for name, text in ORACLES.items()}
