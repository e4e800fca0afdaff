"""The driver contract: entry on sf0.001, and queries / oracle keys line up."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["month", "currency", "product_name", "revenue", "payments", "share"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    models = {"churn_model", "churn_model_auc", "upgrade_propensity", "kmeans_segments"}
    assert set(q) - set(o) - set(E._corpus()[0]) == models  # the corpus queries have tests of their own


def test_base_queries_do_not_need_the_corpus_subpackage(monkeypatch):
    import builtins
    import sys

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("subledger.llm")]:
        monkeypatch.delitem(sys.modules, name)
    real = builtins.__import__

    def gone(name, globals=None, locals=None, fromlist=(), level=0):
        if name == "corpus_pipeline" or name.startswith("subledger.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(name, globals, locals, fromlist, level)

    monkeypatch.setattr(builtins, "__import__", gone)
    q = E.queries()
    assert "pipeline" not in q and not any(n.startswith("op") for n in q) and len(q) > 100
    o = E.oracle_sql()
    assert all(sql.strip() for sql in o.values())
