"""All queries: the Spark side and the SQL side of each, under one name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cohortgram.queries.context import Context, context, plain, plain_sql
from cohortgram.queries.source import WINDOW_START
from cohortgram.queries.sql import compose


@dataclass(frozen=True)
class Query:
    """One query. ``columns`` is the shared column spec; ``sql`` selects ``{columns}`` from the relations."""

    build: Callable[[Context], DataFrame]
    columns: str
    sql: str | None
    needs: tuple[str, ...] = ()
    windows: tuple[str, ...] = ()

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(self.build(context(spark, sf_dir)), self.columns)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        text = self.sql.replace("{columns}", plain_sql(self.columns))
        if not self.needs:
            return text
        if not self.windows:
            return compose(text, *self.needs)
        return "\nUNION ALL\n".join(f"SELECT * FROM ({compose(text, *self.needs, window=w)})" for w in self.windows)


QUERIES: dict[str, Query] = {}


def query(columns: str, sql: str | None, *needs: str, window: bool = False, windows: tuple[str, ...] = ()):
    """Register the decorated function as a query of the same name.

    ``window`` runs the SQL in the usual window, ``windows`` in each of several, one after the other.
    """
    starts = windows or ((WINDOW_START,) if window else ())

    def register(build: Callable[[Context], DataFrame]):
        QUERIES[build.__name__] = Query(build, columns, sql, needs, starts)
        return build

    return register


def load_all() -> dict[str, Query]:
    from cohortgram.queries import (  # noqa: F401
        audit_queries,
        check_queries,
        fault_queries,
        profile_queries,
        report_queries,
        source_queries,
    )

    return QUERIES
