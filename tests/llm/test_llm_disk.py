"""What the Jaccard join leaves on disk, and how often it deals a row."""
import random
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_llm_groups import brute, corpus

from corpusq.llm import jaccard
from corpusq.session import SHUFFLE_CLEANUP, shared_dir, written


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_a_write_takes_its_shuffle_files_along(spark):
    before, chosen = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    out = written(spark.range(50_000).groupBy((F.col("id") % 9_000).alias("k")).count(), "test-shuffle")
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert out.count() == 9_000 and spark.conf.get(SHUFFLE_CLEANUP) == chosen


def tables(spark):
    """The tables in the shared folder, by path, with the columns of each."""
    import pathlib

    root = pathlib.Path(shared_dir(spark).removeprefix("file:")) / "corpusq"
    return {f.parent: pq.read_schema(f).names for f in root.rglob("*.parquet")}


def test_wide_tables_are_removed(spark):
    df = spark.createDataFrame(corpus(random.Random(2)), "doc_id bigint, text string").repartition(2)
    written(df.select("doc_id"), "test-first")
    before = tables(spark)
    kept = jaccard.keep_one(df, 3, 90)
    new = {path: names for path, names in tables(spark).items() if path not in before}
    assert new and not [path for path, names in new.items() if {"first", "hashes"} & set(names) or {"column", "node"} <= set(names)]
    assert kept.count() == kept.distinct().count()


@pytest.mark.parametrize("dealt", [0.1, 1.5])
def test_a_round_deals_a_row_a_bounded_number_of_times(spark, monkeypatch, dealt):
    """A cluster of many blocks: rows of one size, a few of them linked across far blocks only."""
    monkeypatch.setattr(jaccard, "ROW_BLOCK", 5)
    monkeypatch.setattr(jaccard, "SHORT_COLUMN", 4)
    monkeypatch.setattr(jaccard, "DEALT", dealt, raising=False)
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for n in range(80):
        own = [f"own{n % 50}x{i}" for i in range(14 if n % 3 else 5 + n % 7)]
        texts.append(" ".join(passage + own[:-1] + [f"e{rng.randrange(10**6)}"]))
    rows = list(enumerate(texts))
    rounds, links = [], jaccard._links

    def counted(blocked, percent):
        rounds.append(blocked.count())
        return links(blocked, percent)

    monkeypatch.setattr(jaccard, "_links", counted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, 3, 90).collect()}
    assert got == brute(rows, 3, 90)
    assert rounds[0] > 5 * jaccard.ROW_BLOCK and max(rounds) <= 2 * len(rows)


def test_connected_blocks_are_not_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "ROW_BLOCK", 5)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(60):
        w = list(base)
        w[rng.randrange(200)] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    rounds, links = [], jaccard._links

    def counted(blocked, percent):
        rounds.append(blocked.count())
        return links(blocked, percent)

    monkeypatch.setattr(jaccard, "_links", counted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, 3, 90).collect()}
    assert got == brute(rows, 3, 90)
    assert sum(rounds) <= 4 * len(rows)
