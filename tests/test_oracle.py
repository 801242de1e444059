"""Every registered query against its DuckDB twin, on the smallest tables."""
import duckdb
import pytest
from conftest import SMALL, plan_of

import __spark_entry__ as entry
from corpusq.catalog.oracle import all_oracles
from corpusq.catalog.queries import all_queries

TABLES = "documents pages benchmark labels conversations".split()
QUERIES, ORACLES = all_queries(), all_oracles()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


# Queries whose last plan runs one of the two Arrow functions; no other may start Python
# workers. What a query writes on its way is checked where it is built.
ARROW = {"python_structure", "structure_non_python", "syntactic_score", "doc_score", "minhash_bands"}
# Queries that score security: Python rows are analysed on their syntax tree, once per row
# (at most a step per corpus of a union).
ANALYSED = {"composite_no_judge", "composite_with_judge", "max_severity", "rows_above", "run_summary",
            "score_distribution", "score_histogram", "score_stage", "security_findings", "security_score",
            "threshold_flag"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(columns).collect()), key=repr)
    result = duck.execute(ORACLES[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert sorted(kinds) == columns
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == kinds
    at = [list(kinds).index(c) for c in columns]
    want = sorted((tuple(row[i] for i in at) for row in result.fetchall()), key=repr)
    assert got == want

    plan = plan_of(df)
    assert not [operator for operator in FORBIDDEN if operator in plan]
    steps = [line for line in plan.splitlines() if line.startswith("(") and "ArrowEvalPython" in line]
    tree = [line for line in plan.splitlines() if line.startswith("Arguments: [tree_findings(")]
    assert len(steps) - len(tree) == (1 if name in ARROW else 0)
    assert bool(tree) == (name in ANALYSED) and len(tree) <= 2


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "composite_score" in df.columns
