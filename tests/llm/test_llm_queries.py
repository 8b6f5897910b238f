"""The subpackage's queries beside their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from clausemill.llm import registry
from tools_compare import norm


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in sorted(Path(small).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_its_sql(spark, small, duck, name):
    df = registry.QUERIES[name](spark, small)
    rel = duck.execute(registry.SQL[name])
    have = [c[0] for c in rel.description]
    cols = sorted(df.columns)
    assert sorted(have) == cols
    assert sorted(tuple(norm(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(norm(r[have.index(c)]) for c in cols) for r in rel.fetchall())


COLUMNS = {
    "p1_found": ["row_nr", "line_nr"], "p2_found": ["row_nr", "damage"], "p3_found": ["row_nr"], "p4_found": ["id", "norm", "version", "source_file"], "p5_found": ["alias_id", "norm"],
    "p7_found": ["row_a", "row_b"], "p8_found": ["doc_id", "item_id"], "p10_found": ["doc_id", "kind", "value"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_found_queries_have_their_columns(spark, small, name):
    assert registry.QUERIES[name](spark, small).columns == COLUMNS[name]
