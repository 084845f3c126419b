"""The driver contract holds with and without the optional subpackage."""

import importlib.util

import __spark_entry__ as entry


def test_optional_queries_are_left_out_where_the_subpackage_is_missing(monkeypatch):
    found = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith("shelfcast.llm") else found(name, *a))
    assert not any(k.startswith("op") and k[2].isdigit() or k == "pipeline" for k in entry.queries())
    assert set(entry.oracle_sql()) == set(entry.queries())


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_a_missing_module_costs_just_the_optional_queries(monkeypatch, capsys):
    import sys
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("shelfcast.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "zstandard", None)  # as if it weren't installed
    kept = set(entry.queries())
    assert "demand_daily" in kept and not any(k.startswith("op") and k[2].isdigit() for k in kept)
    assert not importlib.util.find_spec("shelfcast.llm") or "zstandard" in capsys.readouterr().err
