"""Sources, record mapping, layers."""
import json
from datetime import datetime, timezone
from glob import glob

import pytest
from conftest import SMALL, plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.sources import layers, registry
from corpusq.sources.registry import SourceSpec

TS = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


def test_registry():
    assert set(registry.SOURCES) == {"the-stack", "codesearchnet", "humaneval"}
    assert registry.lookup("the-stack").path("/r/", "go") == "/r/data/go/train-*.parquet"
    assert registry.lookup("codesearchnet").path("/r", "go") == "/r/go/train"
    assert registry.lookup("humaneval").path("/r", "python") == "/r/test"
    with pytest.raises(ValueError, match="unknown source"):
        registry.lookup("elsewhere")


def test_missing_path_raises(spark, tmp_path):
    for read in (lambda: registry.read_source(spark, registry.lookup("humaneval"), str(tmp_path), "python"),
                 lambda: layers.read_cleaned(spark, str(tmp_path / "none")),
                 lambda: layers.read_tree(spark, str(tmp_path))):
        with pytest.raises(AnalysisException):
            read()


def stack_shards(spark, root, files=4, rows=25):
    for f in range(files):
        (spark.range(f * rows, (f + 1) * rows).coalesce(1)
         .select(F.concat(F.lit("text "), "id").alias("content"), F.lit("x").alias("lang"), F.col("id").alias("size"))
         .write.parquet(f"{root}/tmp{f}"))
        src = glob(f"{root}/tmp{f}/*.parquet")[0]
        target = root / "data" / "python"
        target.mkdir(parents=True, exist_ok=True)
        (target / f"train-{f:05d}.parquet").write_bytes(open(src, "rb").read())


def test_ids_follow_file_order(spark, tmp_path):
    stack_shards(spark, tmp_path)
    spec = registry.lookup("the-stack")
    scan = registry.read_source(spark, spec, str(tmp_path), "python")
    rows = registry.ingest(scan, spec, "python", None, TS).orderBy("id").collect()
    assert [r.id for r in rows] == [f"the-stack_python_{i:06d}" for i in range(100)]
    assert [r.content for r in rows] == [f"text {i}" for i in range(100)]
    assert rows[3]["size"] == 3 and rows[3].max_line_length is None and rows[0].ingested_at == TS.replace(tzinfo=None)
    first = registry.ingest(scan, spec, "python", 30, TS).collect()
    assert {r.content for r in first} == {f"text {i}" for i in range(30)}
    assert registry.ingest(scan, spec, "python", 0, TS).count() == 0


def test_first_n_opens_only_the_files_it_needs(spark, tmp_path):
    stack_shards(spark, tmp_path)
    scan = registry.read_source(spark, registry.lookup("the-stack"), str(tmp_path), "python")
    df = registry.with_position(scan, 30)
    # Counted by now. The rest must not be opened again, so it may as well be garbage.
    for f in (2, 3):
        (tmp_path / "data" / "python" / f"train-{f:05d}.parquet").write_bytes(b"not parquet")
    assert sorted(r.position for r in df.select("position", "content").collect()) == list(range(30))


def test_first_n_never_counts_files_beyond(spark, tmp_path):
    stack_shards(spark, tmp_path, files=6)
    scan = registry.read_source(spark, registry.lookup("the-stack"), str(tmp_path), "python")
    assert len(registry._first_files(scan, 20)) == 1
    assert len(registry._first_files(scan, 70)) == 3
    assert {r["size"]: r.position for r in registry.with_position(scan, 60).collect()} == {i: i for i in range(60)}
    assert registry.with_position(scan, 10_000).count() == 150


def test_odd_file_names(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    spark.range(7).coalesce(1).write.parquet(str(folder))
    assert registry.with_position(spark.read.parquet(str(folder)), 5).count() == 5


def test_id_widens_past_six_digits(spark):
    ids = spark.range(999_999, 1_000_002).coalesce(1).select(registry.record_id("s", "l", F.col("id")))
    assert [r[0] for r in ids.collect()] == ["s_l_999999", "s_l_1000000", "s_l_1000001"]


def test_missing_field_is_empty_and_null_stays_null(spark):
    spec = SourceSpec("s", "body", "x", None, {"stars": T.LongType()})
    absent = spark.createDataFrame([(1,)], "id int")
    row = absent.select(*[c.alias(n) for n, c in registry.map_fields(absent, spec).items()]).first()
    assert (row.content, row.stars) == ("", None)
    null = spark.createDataFrame([(None, 3)], "body string, stars int")
    row = null.select(*[c.alias(n) for n, c in registry.map_fields(null, spec).items()]).first()
    assert (row.content, row.stars) == (None, 3)


def test_raw_layer_replaces_the_same_day_and_prunes(spark, tmp_path):
    path = str(tmp_path / "raw")
    spec = SourceSpec("007", "content", "x", None, {"stars": T.LongType()})

    def records(language, contents):
        rows = [(f"{language}{i}", "007", language, c, TS, 1) for i, c in enumerate(contents)]
        return spark.createDataFrame(
            rows, "id string, source string, language string, content string, ingested_at timestamp, stars bigint")

    layers.write_raw(records("1", ["a", "b"]), path, TS)
    layers.write_raw(records("2", ["c"]), path, TS)
    layers.write_raw(records("1", ["d"]), path, TS)
    back = layers.read_raw(spark, path, spec, "1")
    assert [(r.id, r.source, r.language, r.content, r.stars) for r in back.collect()] == [("10", "007", "1", "d", 1)]
    assert layers.read_raw(spark, path, spec, "2").count() == 1
    pruning = next(line for line in plan_of(back).splitlines() if line.startswith("PartitionFilters"))
    assert "source" in pruning and "language" in pruning


def test_cleaned_layer_unites_files_and_keeps_keys_as_text(spark, tmp_path):
    path = str(tmp_path / "processed")
    layers.write_cleaned(spark.createDataFrame([("a", "007", "go", 5)],
                                               "id string, source string, language string, size bigint"), path)
    layers.write_cleaned(spark.createDataFrame([("b", "8", "go", "f")],
                                               "id string, source string, language string, entry string"), path)
    spec = SourceSpec("8", "content", "x", None, {"entry": T.StringType()})
    rows = layers.read_cleaned(spark, path, spec).select("id", "source", "language", "size", "entry").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("a", "007", "go", 5, None), ("b", "8", "go", None, "f")]


def test_jsonl_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", None, TS, [("HIGH", 1)])],
                               "id string, llm_score double, scored_at timestamp, f array<struct<s:string,l:int>>")
    layers.write_jsonl(df, str(tmp_path / "j"))
    line = json.loads("".join(open(f).read() for f in glob(f"{tmp_path}/j/*.json")))
    assert line == {"id": "a", "llm_score": None, "scored_at": "2024-01-02T03:04:05.000000", "f": [{"s": "HIGH", "l": 1}]}


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, content string")
    b = spark.createDataFrame([("y", 2.0)], "content string, extra double")
    rows = registry.union_by_name([a, b, a]).orderBy("content").collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (1, "x", None), (None, "y", 2.0)]


def test_normalise_overwrites_source(spark):
    df = spark.createDataFrame([(1, "old")], "id int, source string")
    assert registry.normalise_schema(df, "new").first().source == "new"
    assert registry.normalise_schema(df.drop("source"), "new").first().source == "new"


def test_sorted_shards_are_ranges_and_keep_positions(spark, tmp_path):
    """No task writes the whole table; positions follow the keys, then the order read."""
    from corpusq.catalog.queries import in_order

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.createDataFrame([((i * 7919) % 1000 // 2, f"t{i}") for i in range(1000)], "doc_id long, content string")
        expected = [r.content for r in sorted(rows.collect(), key=lambda r: r.doc_id)]
        in_order(rows, "doc_id").write.parquet(f"{tmp_path}/shards")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scan = spark.read.parquet(f"{tmp_path}/shards")
    assert len(scan.inputFiles()) > 4
    placed = registry.with_position(scan).orderBy("position").collect()
    assert [r.position for r in placed] == list(range(1000))
    assert [r.content for r in placed] == expected


@pytest.mark.parametrize("name", ["two_days", "full_run"])
def test_queries_deal_their_source_shards_to_several_tasks(spark, tmp_path, monkeypatch, name):
    from corpusq.catalog import queries

    monkeypatch.setattr(queries, "fresh_path", lambda session, folder: f"{tmp_path}/{folder}")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        getattr(queries, name)(spark, SMALL)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for folder in glob(f"{tmp_path}/*/source*/shards"):
        assert len(glob(f"{folder}/*.parquet")) > 4
    assert glob(f"{tmp_path}/*/source*/shards")
