"""Every registered query against its DuckDB oracle on the driver tables (sf0.01 by default)."""

import math

import pytest

from subledger.plans.catalog import load_all
from subledger.plans.compare import compare

CATALOG = load_all()
WITH_ORACLE = sorted(n for n, q in CATALOG.items() if q.oracle)
ROWS_ONLY = sorted(n for n, q in CATALOG.items() if not q.oracle)


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_matches_oracle(name, tables, duck):
    q = CATALOG[name]
    r = compare(q.build(tables), q.oracle_sql(), duck)
    assert r["columns_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["match"], (r.get("sample_spark_only"), r.get("sample_oracle_only"))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_model_rows(name, tables):
    """Models give rows, no repeated ones, and no null or infinite figure."""
    df = CATALOG[name].build(tables)
    rows = df.collect()
    assert rows and len(set(rows)) == len(rows)
    figures = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    assert all(r[f] is not None and math.isfinite(r[f]) for r in rows for f in figures)
