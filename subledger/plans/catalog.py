"""Query catalog: every registered query = a Spark operator call + its DuckDB oracle.

``build(t)`` receives the twelve tables (``subledger.sources.fixtures.Tables``)
and returns a DataFrame; ``oracle`` is DuckDB SQL over the table names, to
which ``oracle_fixtures.with_tables`` prepends the driver-table mapping.
Queries without an oracle are checked on rows only (MLlib models).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame

from . import oracle_derived  # noqa: F401  (registers the derived oracle CTEs)
from .oracle_fixtures import with_tables


@dataclass(frozen=True)
class Query:
    name: str
    op: str
    build: Callable[..., DataFrame]
    oracle: str | None
    before: str | None = None  # the oracle sees the tables as they stood before this day

    def oracle_sql(self) -> str | None:
        return with_tables(self.oracle, self.before) if self.oracle else None


REGISTRY: dict[str, Query] = {}


def register(name: str, op: str, build: Callable[..., DataFrame], oracle: str | None = None,
             before: str | None = None) -> None:
    if name in REGISTRY:
        raise ValueError(f"duplicate query {name}")
    REGISTRY[name] = Query(name, op, build, oracle, before)


def load_all() -> dict[str, Query]:
    from . import q_base, q_diag, q_integrity, q_kpi, q_more, q_predict, q_profile, q_reports, q_rules  # noqa: F401
    return REGISTRY
