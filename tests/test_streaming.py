"""Scoring arrivals equals scoring in batch; the command line runs a whole job."""
from datetime import datetime, timezone

from pyspark.sql import functions as F

from corpusq.__main__ import main
from corpusq.catalog.rendered import rendered_corpus
from corpusq.config import Settings
from corpusq.plans import stages
from corpusq.sources import layers
from corpusq.streaming.incremental import arrivals_path, score_arrivals

TS = datetime(2024, 1, 2, tzinfo=timezone.utc)


def cleaned(spark, first, last):
    corpus = rendered_corpus(spark.range(first, last).withColumnRenamed("id", "doc_id")).drop("doc_id")
    return stages.transform_rows(corpus, f"from{first}", "python")


def test_arrivals_match_batch_and_count_once(spark, tmp_path):
    folders = stages.Folders("unused", str(tmp_path))
    for first in (0, 100):
        layers.write_cleaned(cleaned(spark, first, first + 100), folders.processed)
        for _ in range(2):  # a restart finds nothing new
            score_arrivals(spark, folders, Settings(), TS, files_per_batch=1).awaitTermination()
    streamed = spark.read.parquet(arrivals_path(folders))
    batch = stages.score_rows(layers.read_cleaned(spark, folders.processed), Settings(), None, TS)
    columns = ["id", "source", "composite_score", "above_threshold", "security_finding_count", "scored_at"]
    assert streamed.count() == batch.count() > 100
    assert streamed.select(columns).exceptAll(batch.select(columns)).count() == 0


def test_rewritten_files_and_batch_runs_leave_each_id_once(spark, tmp_path):
    folders = stages.Folders("unused", str(tmp_path))
    for last in (60, 60, 40):  # a transform that is run again, and one that keeps less
        layers.write_cleaned(cleaned(spark, 0, last), folders.processed)
        stages.score_stage(spark, folders, Settings(), None, TS)
        score_arrivals(spark, folders, Settings(), TS, files_per_batch=1).awaitTermination()
        stored, streamed = spark.read.parquet(folders.scored_parquet), spark.read.parquet(arrivals_path(folders))
        ids = sorted(r.id for r in streamed.select("id").collect())
        assert ids == sorted(r.id for r in stored.select("id").collect()) and len(set(ids)) == len(ids) > 0


def test_command_line(spark, tmp_path, capfd):
    corpus = rendered_corpus(spark.range(60).withColumnRenamed("id", "doc_id")).orderBy("doc_id")
    corpus.select("content", F.lit("Python").alias("lang")).coalesce(1).write.parquet(f"{tmp_path}/src/tmp")
    target = tmp_path / "src" / "data" / "python"
    target.mkdir(parents=True)
    for f in (tmp_path / "src" / "tmp").glob("*.parquet"):
        (target / "train-00000.parquet").write_bytes(f.read_bytes())
    main(["--source-dir", f"{tmp_path}/src", "--data-dir", f"{tmp_path}/data", "--sample", "50", "--near-dedup"])
    stored = spark.read.parquet(f"{tmp_path}/data/scored/scored.parquet")
    assert stored.count() > 0 and stored.filter("id like 'the-stack_python_0000%'").count() == stored.count()
    assert "pass_rate" in capfd.readouterr().out
