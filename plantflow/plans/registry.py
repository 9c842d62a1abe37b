"""Registry of named queries: a Spark job and, where SQL can say it, the equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
SQL: dict[str, str] = {}
COMMON: dict[str, tuple[tuple[str, ...], str]] = {}


def query(name: str, sql: str | None = None, using: tuple[str, ...] = ()) -> Callable[[Job], Job]:
    """Register a job; `using` names common tables its SQL starts from."""

    def add(job: Job) -> Job:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is already registered")
        QUERIES[name] = job
        if sql is not None:
            SQL[name] = with_tables(sql, using)
        return job

    return add


def common(name: str, sql: str, using: tuple[str, ...] = ()) -> None:
    """Define a common table expression that query SQL can build on."""
    COMMON[name] = (using, sql)


def with_tables(select: str, using: tuple[str, ...]) -> str:
    """Prefix a select with the common tables it needs, in dependency order."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for dependency in COMMON[name][0]:
            visit(dependency)
        if name not in needed:
            needed.append(name)

    for name in using:
        visit(name)
    if not needed:
        return select
    tables = ",\n".join(f"{n} AS ({COMMON[n][1]})" for n in needed)
    return f"WITH {tables}\n{select}"


def rounded(df: DataFrame, digits: int = 6, *skip: str) -> DataFrame:
    """Round every double column, so that summation order does not show in results."""
    names = [n for n, t in df.dtypes if t == "double" and n not in skip]
    return df.withColumns({n: F.round(n, digits) for n in names})


def round_sql(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)
