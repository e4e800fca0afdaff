"""The Spark mapping of the driver tables equals its DuckDB twin, table by table."""

import pytest

from subledger.plans import oracle_fixtures as OF
from subledger.plans.compare import compare
from subledger.sources.schemas import TABLES


@pytest.mark.parametrize("name", OF.TABLE_NAMES)
def test_table_matches_duckdb(name, tables, duck):
    r = compare(getattr(tables, name), OF.with_tables(f"select * from {name}"), duck)
    assert r["match"], r


@pytest.mark.parametrize("name", OF.TABLE_NAMES)
def test_schema_is_declared(name, tables):
    df = getattr(tables, name)
    assert df.columns == TABLES[name].column_names
    declared = {f.name: f.dataType for f in TABLES[name].schema}
    for f in df.schema:
        assert f.dataType == declared[f.name], (f.name, f.dataType, declared[f.name])


def test_known_sizes(tables):
    # row counts of the mapping at sf0.01 (FIXTURES.md)
    assert tables.subscriptions.count() == 15000
    assert tables.payments.count() == 31538
    assert tables.subscription_events.count() == 64962
