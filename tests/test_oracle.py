"""Every registered query against its DuckDB oracle (sf0.001 by default;
set ``ORACLE_SF_DIR`` for another scale)."""

import os

import pytest

from oracle_harness import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def _registry():
    from colloquy.plans.registry import load_all

    return load_all()


REG = _registry()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, REG[name], SF, con)
    assert r["status"] in ("match", "rows-only"), r


def test_every_operator_has_a_query():
    ops = {q.operator for q in REG.values()}
    expected = ({f"A{i}" for i in range(1, 9)} | {f"B{i}" for i in range(1, 11)} | {f"C{i}" for i in range(1, 13)}
                | {f"D{i}" for i in range(1, 7)} | {f"E{i}" for i in range(1, 9)} | {f"F{i}" for i in range(1, 13)}
                | {f"G{i}" for i in range(1, 4)} | {f"H{i}" for i in range(1, 6)} | {f"I{i}" for i in range(1, 6)}
                | {f"J{i}" for i in range(1, 5)})
    assert expected <= ops, sorted(expected - ops)


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["conv_id", "reply"]
    assert df.count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
