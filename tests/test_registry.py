"""The driver's entry points, the queries' SQL, and independence from the optional subpackage."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import compare

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]


def names():
    from tidegrid import oracles

    return sorted(oracles.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in compare.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", names())
def test_query_equals_sql(spark, duck, name):
    from collections import Counter

    from tidegrid import oracles, queries

    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rel = duck.sql(oracles.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    got = Counter(tuple(compare.cell(x) for x in r) for r in df.select(*cols).collect())
    assert got == Counter(tuple(compare.cell(r[i]) for i in at) for r in rel.fetchall())


def test_every_query_has_sql():
    from tidegrid import oracles, queries

    assert set(queries.queries()) == set(oracles.oracle_sql())


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() >= 0 and set(e.oracle_sql()) <= set(e.queries())


def test_without_the_optional_subpackage(tmp_path):
    import shutil

    shutil.copytree(ROOT / "tidegrid", tmp_path / "tidegrid", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not any(k.startswith('op') and k[2].isdigit() for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "HOME": "/root", "PYTHONPATH": str(tmp_path)})
