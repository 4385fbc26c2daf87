from __future__ import annotations

import sys


def test_other_queries_stay_without_the_training_data_subpackage(monkeypatch):
    import __spark_entry__ as entry

    for name in list(sys.modules):
        if name == "corpus_pipeline" or name.startswith("marketloom.llm"):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "marketloom.llm", None)
    names = set(entry.queries())
    assert "rfm_quintile" in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
    assert "pipeline" not in names and set(entry.oracle_sql()) <= names
