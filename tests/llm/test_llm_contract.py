"""Queries with SQL equal it; the entry works with and without the subpackage."""

from __future__ import annotations

import sys

import pytest
from llm_checks import assert_same

import __spark_entry__ as contract
from tollstats.llm.registry import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_equals_sql(spark, name, scale):
    path = f"/root/testdata/sf{scale}"
    assert assert_same(QUERIES[name](spark, path), path, ORACLE[name]) > 0


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14))
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry_without_the_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "tollstats.llm", None)
    for name in [m for m in sys.modules if m.startswith("tollstats.llm.")]:
        monkeypatch.delitem(sys.modules, name)
    assert "q7" in contract.queries() and not any(n.startswith("op") for n in contract.queries())
    assert "pipeline" not in contract.queries() and "op9_mixing" not in contract.oracle_sql()
