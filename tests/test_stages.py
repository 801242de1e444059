"""Stages end to end, reports, and empty inputs."""
import json
from datetime import datetime, timezone
from glob import glob

import pytest
from pyspark.sql import functions as F

from corpusq.catalog.rendered import rendered_corpus
from corpusq.config import Settings
from corpusq.plans import reports, stages
from corpusq.schemas import cleaned_schema, scored_schema
from corpusq.sources.registry import SourceSpec

TS = datetime(2024, 1, 2, tzinfo=timezone.utc)
RECORD = "id string, source string, language string, content string"
BODY = "x = 1\n" * 6


def records(spark, contents):
    return spark.createDataFrame([(f"r{i}", "s", "python", c) for i, c in enumerate(contents)], RECORD)


def test_dedup_comes_before_the_cutoffs(spark):
    # r0 and r1 are equal once stripped; only the first is tested, and it has too few lines.
    contents = ["a = 1\nb = 2", "\n\n\n\n\na = 1\nb = 2", BODY, None]
    for near in (False, True):
        out = stages.transform_rows(records(spark, contents), "src", "python", Settings(dedup_near=near))
        rows = out.collect()
        assert [(r.id, r.source, r.content, r.is_parseable) for r in rows] == [("r2", "src", BODY, True)]


def test_near_switch(spark):
    base = "\n".join(f"value_{i} = {i}" for i in range(300))
    rows = records(spark, [base, base + "\n# end", BODY])
    off = stages.transform_rows(rows, "s", "python")
    on = stages.transform_rows(rows, "s", "python", Settings(dedup_near=True))
    assert {r.id for r in off.collect()} == {"r0", "r1", "r2"}
    kept = {r.id for r in on.collect()}
    assert "r2" in kept and len(kept & {"r0", "r1"}) == 1


@pytest.mark.parametrize("near", [False, True])
def test_empty_input_at_every_stage(spark, near):
    out = stages.transform_rows(records(spark, []), "s", "python", Settings(dedup_near=near))
    replies = spark.createDataFrame([], "id string, reply string")
    scored = stages.score_rows(out, Settings(), replies, TS)
    assert scored.count() == 0
    assert reports.run_summary(scored).first().asDict() == dict(
        total=0, passed=0, with_findings=0, pass_rate=None, findings_rate=None)
    assert reports.overview_metrics(scored).first().pass_rate is None
    assert {r.n for r in reports.score_histogram(scored).collect()} == {0}
    assert reports.score_distribution(scored).count() == 0
    assert reports.sample_browser(scored).count() == 0
    assert reports.stage_counts(records(spark, []), "python").first().raw_rows == 0


def test_cleaned_layout(spark):
    rows = records(spark, [BODY]).withColumn("ingested_at", F.lit(TS)).withColumn("position", F.lit(0).cast("bigint"))
    out = stages.transform_rows(rows, "s", "python")
    want = {f.name: f.dataType for f in cleaned_schema()}
    assert {f.name: f.dataType for f in out.schema} == want

    def plain(df_or_schema):
        return {f.name: f.dataType.simpleString() for f in df_or_schema}

    assert plain(stages.score_rows(out, run_ts=TS).schema) == plain(scored_schema())


def test_unknown_stage(spark):
    with pytest.raises(ValueError):
        stages.run(spark, stages.Folders("a", "b"), stage="publish")


def test_full_run_through_the_layers(spark, tmp_path):
    corpus = rendered_corpus(spark.range(200).withColumnRenamed("id", "doc_id")).orderBy("doc_id")
    corpus.select("content").coalesce(1).write.parquet(f"{tmp_path}/source/shards")
    spec = SourceSpec("rendered", "content", "shards")
    settings = Settings(source="rendered", sample_size=150)
    folders = stages.Folders(f"{tmp_path}/source", f"{tmp_path}/data")
    for stage in ("ingest", "transform", "score"):
        result = stages.run(spark, folders, settings, stage, None, TS, spec)
    rows = result.collect()
    # Every tenth text copies its predecessor.
    assert 0 < len(rows) <= 135 and not any(int(r.id[-6:]) % 10 == 9 for r in rows)
    assert all(r.is_parseable == (int(r.id[-6:]) % 11 != 0) for r in rows)
    assert all(r.pipeline_version == "v0.1.0" and r.llm_score is None for r in rows)
    lines = [json.loads(x) for f in glob(f"{folders.scored_jsonl}/*.json") for x in open(f)]
    assert {x["id"] for x in lines} == {r.id for r in rows}
    assert all("llm_score" in x and x["scored_at"] == "2024-01-02T00:00:00.000000" for x in lines)
    total = reports.run_summary(result).first()
    assert total.total == len(rows) and total.passed == sum(r.above_threshold for r in rows)
    # A rerun replaces, it does not append.
    assert stages.run(spark, folders, settings, "all", None, TS, spec).count() == len(rows)


def test_unparseable_rows_never_pass(spark):
    corpus = rendered_corpus(spark.range(300).withColumnRenamed("id", "doc_id")).drop("doc_id")
    scored = stages.score_rows(stages.transform_rows(corpus, "r", "go"), run_ts=TS)
    assert scored.agg(F.max("composite_score")).first()[0] <= 0.3438
    assert scored.filter("above_threshold").count() == 0


def test_histogram_puts_edges_in_the_upper_bin(spark):
    df = spark.createDataFrame([(0.58,), (0.5799,), (1.0,), (0.0,), (None,)], "composite_score double")
    bins = {r.bin: r.n for r in reports.score_histogram(df).collect()}
    assert len(bins) == 50 and sum(bins.values()) == 4
    assert bins[29] == bins[28] == bins[49] == bins[0] == 1


def test_browser_shows_only_columns_that_exist(spark):
    df = spark.createDataFrame([("a", 0.9), ("b", 0.7), ("c", 0.69)], "id string, composite_score double")
    out = reports.sample_browser(df)
    assert out.columns == ["id", "composite_score"] and [r.id for r in out.collect()] == ["a", "b"]
    assert [r.id for r in reports.sample_browser(df, rows=1).collect()] == ["a"]
    assert reports.rows_above(df).first().matching == 2


def test_browser_without_a_composite_shows_all_rows(spark):
    df = spark.createDataFrame([("b", "go"), ("a", "go")], "id string, language string")
    out = reports.sample_browser(df)
    assert out.columns == ["id", "language"] and [r.id for r in out.collect()] == ["a", "b"]
    assert [r.id for r in reports.sample_browser(df, rows=1).collect()] == ["a"]


@pytest.mark.parametrize("near", [False, True])
def test_a_run_counts_what_it_removes(spark, tmp_path, near):
    contents = [BODY, BODY + "\n", "x = 1", BODY + "def broken(:\n", None]
    spark.createDataFrame([(c,) for c in contents], "content string").coalesce(1).write.parquet(f"{tmp_path}/source/shards")
    spec, counts = SourceSpec("counted", "content", "shards"), stages.StageCounts()
    folders = stages.Folders(f"{tmp_path}/source", f"{tmp_path}/data")
    settings = Settings(source="counted", dedup_near=near)
    stages.run(spark, folders, settings, "all", None, TS, spec, counts)
    assert counts.get() == dict(raw_rows=5, unique_rows=4, near_rows=4, kept_rows=2, parseable_rows=1)
    row = reports.counts_table(spark, counts).first()
    assert (row.duplicate_rate, row.near_duplicate_rate, row.filtered_rate) == (0.2, 0.0, 0.5)


@pytest.mark.parametrize("near", [False, True])
def test_days_are_told_apart(spark, tmp_path, near):
    spec, settings = SourceSpec("daily", "content", "shards"), Settings(source="daily", dedup_near=near)
    for day, words in enumerate((["one", "two", "three"], ["one", "changed", "four"])):
        folders = stages.Folders(f"{tmp_path}/source{day}", f"{tmp_path}/data")
        rows = [(i, f"{w} = {i}\n" * 9 if w != "one" else BODY) for i, w in enumerate(words)]
        df = spark.createDataFrame(rows, "i int, content string").coalesce(1).sortWithinPartitions("i")
        df.select("content").write.parquet(f"{folders.source}/shards")
        stages.ingest_stage(spark, folders, settings, TS.replace(day=1 + day), spec)
    out = stages.transform_stage(spark, folders, settings, spec)
    rows = out.select("id", "content", "content_hash", "ingested_at").collect()
    assert len({r.content_hash for r in rows}) == len(rows) == 5
    assert [r.ingested_at.day for r in rows if r.content == BODY] == [1]


def test_near_path_moves_no_text_that_fails(spark):
    """With broadcasts off, every text below an exchange has passed the cut-offs."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = stages.transform_rows(records(spark, [BODY, "x", BODY + "y = 2\n"]), "s", "go", Settings(dedup_near=True))
        tree = df._jdf.queryExecution().optimizedPlan().toString()
        # The only text that rises through the join is the one nulled where a row fails.
        assert "CASE WHEN" in tree and tree.count("LeftSemi") == 1
        assert {r.id for r in df.collect()} <= {"r0", "r2"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_sources_with_other_extras_keep_them_in_one_scored_table(spark, tmp_path):
    from pyspark.sql import types as T

    folders = stages.Folders(f"{tmp_path}/source", f"{tmp_path}/data")
    made = {"mine": ("stars", T.LongType(), 7), "yours": ("license", T.StringType(), "mit")}
    for name, (extra, kind, value) in made.items():
        body = [(BODY + f"y = {i}\n", value) for i in range(3)]
        spark.createDataFrame(body, f"content string, {extra} {kind.simpleString()}").coalesce(1).write.parquet(
            f"{folders.source}/{name}")
        spec = SourceSpec(name, "content", name, extras={extra: kind})
        settings = Settings(source=name)
        for stage in ("ingest", "transform"):
            stages.run(spark, folders, settings, stage, None, TS, spec)
    scored = stages.run(spark, folders, Settings(source="mine"), "score", None, TS,
                        SourceSpec("mine", "content", "mine", extras={"stars": T.LongType()}))
    rows = scored.collect()
    assert {"stars", "license"} <= set(scored.columns)
    assert {(r.source, r.stars, r.license) for r in rows} == {("mine", 7, None), ("yours", None, "mit")}
