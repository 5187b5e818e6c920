"""Every query with a SQL counterpart equals it on the given tables."""

from __future__ import annotations

import os

import pytest
from compare import assert_same

import __spark_entry__ as contract
from tollstats.registry.oracle import ORACLE
from tollstats.registry.queries import QUERIES


# Result sizes at scale 0.01.
ROWS = {"q2": 274, "q6": 8261, "q7": 700, "q8": 1199, "q10": 35, "topk_q11": 30}


SCALE = os.environ.get("TOLLSTATS_TEST_SF", "0.001")
PATH = f"/root/testdata/sf{SCALE}"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    assert assert_same(QUERIES[name](spark, PATH), PATH, ORACLE[name]) > 0


@pytest.mark.parametrize("name", sorted(ROWS))
def test_size_of_the_result(spark, medium, name):
    assert QUERIES[name](spark, medium).count() == ROWS[name]


@pytest.mark.parametrize("name", ["ml_lr_binary", "ml_mlp", "ml_tree", "ml_forest", "ml_lr_multi"])
def test_trained_model_scores_the_test_side(spark, small, name):
    frame = QUERIES[name](spark, small)
    classes = [c for c in frame.columns if c in ("p0", "p1", "p2")]
    assert len(classes) == (2 if name in ("ml_lr_binary", "ml_mlp") else 3)
    rows = frame.collect()
    assert len(rows) == 168
    for row in rows:
        assert abs(sum(row[c] for c in classes) - 1) < 1e-9


def test_only_trained_models_lack_sql():
    assert set(ORACLE) <= set(QUERIES)
    assert all(name.startswith("ml_") for name in set(QUERIES) - set(ORACLE))


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == [
        "anio", "nombre_peaje", "departamento", "total_ligeros", "total_vehiculos", "pct_ligeros",
    ]
    assert frame.count() > 0
