"""Every core query beside its SQL, and the driver contract."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from clausemill import queries_classes, queries_contents, queries_core, queries_names, queries_orphans, queries_scalars
from tools_compare import norm

MODULES = (queries_orphans, queries_core, queries_contents, queries_names, queries_classes, queries_scalars)
SQL = {k: s for m in MODULES for k, s in m.SQL.items()}
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}


@pytest.fixture(scope="session")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in sorted(Path(small).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    rel = duck.execute(SQL[name])
    have = [c[0] for c in rel.description]
    cols = sorted(df.columns)
    assert sorted(have) == cols
    assert sorted(tuple(norm(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(norm(r[have.index(c)]) for c in cols) for r in rel.fetchall())


def test_contract(spark, small):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(SQL) == set(QUERIES)


def test_the_rest_imports_without_the_subpackage():
    code = "import sys; sys.modules['clausemill.llm'] = None; import __spark_entry__ as e; assert e._llm is None and 'p6_found' in e.queries() and 'p1_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent)
