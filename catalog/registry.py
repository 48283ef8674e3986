"""Name, Spark query and SQL twin of every registered query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalog.inputs import CTES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_inputs(body: str, *needs: str) -> str:
    """Prefix a statement with the inputs it names, each after what it needs itself."""
    ordered: list[str] = []

    def add(name: str) -> None:
        sql, own = CTES[name]
        for n in own:
            add(n)
        if name not in ordered:
            ordered.append(name)

    for n in needs:
        add(n)
    ctes = ",\n".join(f"{n} AS ({CTES[n][0]})" for n in ordered)
    if not ctes:
        return body
    if body.lstrip().lower().startswith("with "):
        return f"WITH {ctes},\n{body.lstrip()[5:]}"
    return f"WITH {ctes}\n{body}"


def query(sql: str | None = None, *needs: str) -> Callable[[Query], Query]:
    """Register a query under its function name; without SQL only its rows are checked."""
    def register(fn: Query) -> Query:
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_inputs(sql, *needs)
        return fn

    return register


def r(column: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; adding 0.0 turns -0.0 into 0.0."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), digits) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in columns})


def sql_round(expr: str, digits: int = 6) -> str:
    return f"(round(cast({expr} as double), {digits}) + cast(0 as double))"
