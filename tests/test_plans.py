"""Shapes of the physical plans that matter at scale."""
import pytest
from conftest import SMALL, plan_of

from corpusq.catalog import queries

QUERIES = queries.all_queries()


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = plan_of(QUERIES["exact_dedup"](spark, SMALL))
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["content_hash"](spark, SMALL))
    assert "n_chars" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_measures_run_once_under_a_filter(spark):
    plan = plan_of(QUERIES["hard_filter"](spark, SMALL))
    assert "[^\\p{L}\\p{N}]" not in plan.split("Condition")[1]


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from corpusq import session

    bare = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn"),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(bare)
    bare.conf.get = lambda key, default=None: "hdfs:///shared/"
    assert session.shared_dir(bare) == "hdfs:///shared"
    for local in ("/tmp/checkpoints", "file:///tmp/x", "file:/var/tmp"):
        bare.conf.get = lambda key, default=None, local=local: local
        with pytest.raises(ValueError, match="temporary"):
            session.shared_dir(bare)
