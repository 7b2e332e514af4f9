"""Queries that SQL can express, against DuckDB."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as entry  # noqa: E402
from finwater.llm import queries  # noqa: E402
from tools import check_oracle  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_equals_duckdb(spark, key):
    want = check_oracle.duck(SF).execute(entry.oracle_sql()[key])
    names = [d[0] for d in want.description]
    got = queries.queries()[key](spark, SF)
    assert sorted(got.columns) == sorted(names)
    rows = lambda rs: sorted((tuple(map(check_oracle.norm, r)) for r in rs), key=str)
    assert rows(got.select(*names).collect()) == rows(want.fetchall())


def test_every_operator_is_registered():
    keys = entry.queries()
    assert "pipeline" in keys
    assert {k.split("_")[0] for k in keys if k.startswith("op")} >= {f"op{n}" for n in range(1, 11)}
