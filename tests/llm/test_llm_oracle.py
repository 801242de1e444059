"""The operators' queries against DuckDB where SQL can express them, and the rest by rows."""
import duckdb
import pytest
from conftest import SMALL, plan_of

from corpusq.llm.oracle import llm_oracles
from corpusq.llm.queries import llm_queries

TABLES = "documents pages benchmark labels conversations embeddings".split()
QUERIES, ORACLES = llm_queries(), llm_oracles()
NATIVE = ("op1_mix_sources", "op3_quality_rules", "op4_chat_format")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def test_there_is_a_query_for_each_operator():
    assert sorted(int(name.split("_")[0][2:]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    kinds = [d[0] for d in result.description]
    want = sorted((tuple(row[kinds.index(c)] for c in columns) for row in result.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(columns).collect()), key=repr) == want


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_run_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert not [x for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop") if x in plan]
