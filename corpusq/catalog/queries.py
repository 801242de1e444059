"""One query per operator over the given tables; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.catalog.rendered import rendered_corpus
from corpusq.config import Settings
from corpusq.operators import dedup, features, judge, scoring
from corpusq.plans import reports, stages
from corpusq.schemas import scored_schema
from corpusq.session import fresh_path, prepare
from corpusq.sources import layers, registry
from corpusq.sources.registry import SourceSpec

Query = Callable[[SparkSession, str], DataFrame]
RUN_TS = datetime(2024, 5, 17, 10, 30, 0, tzinfo=timezone.utc)
FIRST_N = 500
SAMPLED = 500
WIDE_FROM = 999_900

_text, _long, _int = T.StringType(), T.LongType(), T.IntegerType()

# The given tables as sources. `size` and, in labels, `text` are absent on purpose.
TABLE_SOURCES = {
    "documents": SourceSpec("documents", "text", "documents.parquet", "lang",
                            {"doc_id": _long, "n_chars": _long, "size": _long}),
    "pages": SourceSpec("pages", "html", "pages.parquet", None, {"page_id": _long, "url": _text}),
    "benchmark": SourceSpec("benchmark", "text", "benchmark.parquet", None, {"item_id": _long}),
    "conversations": SourceSpec("conversations", "text", "conversations.parquet", None,
                                {"conv_id": _long, "turn": _long, "role": _text}),
    "labels": SourceSpec("labels", "text", "labels.parquet", None, {"doc_id": _long, "quality": _int}),
}


# ---- inputs ---------------------------------------------------------------------------

def spread(df: DataFrame, key: str) -> DataFrame:
    """The given tables are a file each; a local session deals them to all its cores."""
    context = df.sparkSession.sparkContext
    return df.repartition(context.defaultParallelism, key) if context.master.startswith("local[") else df


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` sorted for writing, rows of equal keys in the order they are read: Spark deals
    ranges of the keys to tasks, and part files are named in the order of their ranges."""
    read = F.monotonically_increasing_id()
    return df.withColumn("_read", read).orderBy(*keys, "_read").drop("_read")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """(id, content) with the document number as id."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))


def document_records(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.format_string("documents_text_%06d", "doc_id").alias("id"),
        F.lit("documents").alias("source"), F.lit("text").alias("language"),
        F.col("text").alias("content"),
    )


def rendered_records(spark: SparkSession, sf: str) -> DataFrame:
    return rendered_corpus(table(spark, sf, "documents").select("doc_id")).drop("doc_id")


def rendered_measured(spark: SparkSession, sf: str) -> DataFrame:
    return features.add_structure(
        features.add_text_features(spread(rendered_records(spark, sf), "id")), "python"
    )


def both_measured(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and rendered code, measured, parsed where they are Python."""
    return features.add_structure(features.add_text_features(both_corpora(spark, sf)))


def both_corpora(spark: SparkSession, sf: str) -> DataFrame:
    return registry.union_by_name(
        [spread(document_records(spark, sf), "id"), spread(rendered_records(spark, sf), "id")]
    )


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return registry.union_by_name([
        stages.transform_rows(spread(document_records(spark, sf), "id"), "documents", "text"),
        stages.transform_rows(spread(rendered_records(spark, sf), "id"), "rendered", "python"),
    ])


def raw_replies(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, reply) as a model would word it: fenced or bare, some of it unusable."""
    q, d = F.col("quality"), F.col("doc_id")
    mark = (1 + 4 * q).cast("string")
    body = (
        F.when(d % 11 == 0, F.lit("not sure about this one"))
        .when(d % 13 == 0, F.concat(F.lit('{"score": '), mark, F.lit("}")))
        .when(d % 17 == 0, F.lit('{"score": 9, "reason": "off the scale"}'))
        .when(d % 19 == 0, F.lit('{"reason": "no mark"}'))
        .otherwise(F.concat(F.lit('{"score": '), mark, F.lit(', "reason": "r'), d.cast("string"),
                            F.lit('", "flags": []}')))
    )
    reply = (
        F.when(d % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(d % 3 == 1, F.concat(F.lit("\n  ```\n"), body, F.lit("\n```\n")))
        .otherwise(body)
    )
    first = table(spark, sf, "labels").select("doc_id", reply.alias("reply"))
    # Asked again: a usable answer after one that failed, and a worse mark after a good one.
    again = table(spark, sf, "labels").filter(d % 22 == 0).select("doc_id", F.concat(
        F.lit('{"score": '), mark, F.lit(', "reason": "asked again"}')).alias("reply"))
    worse = table(spark, sf, "labels").filter(d % 23 == 1).select(
        "doc_id", F.lit('{"score": 1, "reason": "second look"}').alias("reply"))
    return first.unionByName(again).unionByName(worse)


def record_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Replies keyed by record id, for both corpora."""
    replies = raw_replies(spark, sf)
    return replies.select(F.format_string("documents_text_%06d", "doc_id").alias("id"), "reply").unionByName(
        replies.select(F.format_string("rendered_python_%06d", "doc_id").alias("id"), "reply")
    )


def stored_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "processed")
    layers.write_cleaned(cleaned(spark, sf), path)
    return layers.read_cleaned(spark, path)


def scored(spark: SparkSession, sf: str, judged: bool = True) -> DataFrame:
    rows = stored_cleaned(spark, sf)
    return stages.score_rows(rows, Settings(), record_replies(spark, sf) if judged else None, RUN_TS)


def stored_scored(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "scored")
    layers.write_scored_parquet(scored(spark, sf), path)
    return layers.read_tree(spark, path, scored_schema())


# ---- sources and sinks ----------------------------------------------------------------

def source_mapping(spark: SparkSession, sf: str) -> DataFrame:
    frames = []
    for spec in TABLE_SOURCES.values():
        df = registry.read_source(spark, spec, sf, "any")
        mapped = registry.map_fields(df, spec)
        frames.append(df.select(F.lit(spec.name).alias("source"), *[c.alias(n) for n, c in mapped.items()]))
    return registry.union_by_name(frames)


def scan_language(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_path(spark, "by-language")
    layers.write_partitioned(table(spark, sf, "documents"), root, ["lang"], balance=True)
    spec = SourceSpec("documents", "text", "lang={language}/*.parquet", None, {"doc_id": _long})
    df = registry.read_source(spark, spec, root, "en")
    return df.select(*[c.alias(n) for n, c in registry.map_fields(df, spec).items()])


def ingest_records(spark: SparkSession, sf: str, n: int | None = None) -> DataFrame:
    spec = TABLE_SOURCES["documents"]
    rows = registry.ingest(registry.read_source(spark, spec, sf, "any"), spec, "mixed", n, RUN_TS)
    return rows.withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss"))


def partition_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_path(spark, "raw")
    rows = table(spark, sf, "documents").select(
        F.format_string("%s_%s_%06d", "source", "lang", "doc_id").alias("id"), "source",
        F.col("lang").alias("language"), F.col("text").alias("content"),
        F.lit(RUN_TS).cast("timestamp").alias("ingested_at"),
    )
    layers.write_raw(rows, root, RUN_TS, balance=True)
    # A rerun on the same day replaces the partitions it touches, and no others.
    layers.write_raw(rows.filter("language = 'en'"), root, RUN_TS, balance=True)
    back = spark.read.schema(layers.raw_schema()).parquet(root)
    return back.select("id", "source", "language", "content", F.col("date").cast("string").alias("date"))


def jsonl_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "jsonl")
    spec = TABLE_SOURCES["documents"]
    layers.write_jsonl(
        registry.ingest(registry.read_source(spark, spec, sf, "any"), spec, "mixed", None, RUN_TS), path
    )
    fields = ("id string, source string, language string, position bigint, content string, "
              "ingested_at string, doc_id bigint, n_chars bigint, size bigint")
    return spark.read.text(path).select(
        F.from_json("value", fields).alias("r"),
        F.contains("value", F.lit('"size":null')).alias("null_is_explicit"),
    ).select("r.*", "null_is_explicit")


def normalise_schema(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "source", F.col("text").alias("content"))
    return registry.normalise_schema(rows, "the-stack")


def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"), "lang")
    pages = table(spark, sf, "pages").select(F.col("html").alias("content"), "page_id")
    items = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("content"))
    return registry.union_by_name([docs, pages, items])


# ---- text, cut-offs, structure --------------------------------------------------------

MEASURES = ["num_lines", "avg_line_length", "alphanum_fraction", "comment_ratio"]


def text_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.add_text_features(both_corpora(spark, sf)).select("id", *MEASURES)


def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.add_content_hash(both_corpora(spark, sf)).select("id", "content_hash")


def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.deduplicate(both_corpora(spark, sf)).select("id", "content_hash")


def hard_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.add_text_features(both_corpora(spark, sf))
    return features.apply_hard_filters(rows).select("id", *MEASURES)


def python_structure(spark: SparkSession, sf: str) -> DataFrame:
    return rendered_measured(spark, sf).select(
        "id", "is_parseable", "num_functions", "num_classes", "has_docstring",
        F.col("parse_error").isNotNull().alias("has_error"),
    )


def structure_non_python(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("language"),
                                                F.col("text").alias("content"))
    return features.add_structure(rows).select("doc_id", *features.STRUCTURE_COLUMNS)


# ---- near duplicates ------------------------------------------------------------------

def minhash_bands(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.minhash_bands(spread(documents(spark, sf), "id"))


def near_dup_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.near_duplicate_lookup(documents(spark, sf))


def near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.near_deduplicate(documents(spark, sf)).select("id")


# ---- scores ---------------------------------------------------------------------------

def syntactic_score(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.add_syntactic_score(both_measured(spark, sf)).select("id", "syntactic_score")


def doc_score(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.add_doc_score(both_measured(spark, sf)).select("id", "doc_score")


def security_findings(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.security_findings(both_corpora(spark, sf))


def security_score(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.add_security(both_corpora(spark, sf)).select(
        "id", "security_score", "security_finding_count", "security_high_count"
    )


def max_severity(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.add_max_severity(scoring.add_security(both_corpora(spark, sf))).select(
        "id", "security_severity"
    )


def judge_sample(spark: SparkSession, sf: str) -> DataFrame:
    return judge.judge_sample(documents(spark, sf), Settings(judge_sample_size=SAMPLED))


def judge_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return judge.judge_prompts(documents(spark, sf))


def judge_parse(spark: SparkSession, sf: str) -> DataFrame:
    return judge.parse_replies(raw_replies(spark, sf)).select("doc_id", "llm_score", "llm_reason")


def judge_attach(spark: SparkSession, sf: str) -> DataFrame:
    replies = raw_replies(spark, sf).withColumnRenamed("doc_id", "id")
    return judge.attach_judgements(documents(spark, sf), replies).select("id", "llm_score", "llm_reason")


def composite_no_judge(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf, judged=False).select("id", "llm_score", "composite_score")


def composite_with_judge(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).filter("llm_score is not null").select("id", "llm_score", "composite_score")


def threshold_flag(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("id", "composite_score", "above_threshold")


# ---- stages and reports ---------------------------------------------------------------

CLEANED = ["id", "source", "language", "content", "content_hash", *MEASURES,
           "is_parseable", "num_functions", "num_classes", "has_docstring"]
SCORED = ["id", "source", "language", "content_hash", "num_lines", "syntactic_score", "doc_score",
          "security_score", "security_finding_count", "security_high_count", "security_severity", "llm_score", "llm_reason",
          "composite_score", "above_threshold", "pipeline_version"]


def run_transforms(spark: SparkSession, sf: str) -> DataFrame:
    return stored_cleaned(spark, sf).select(*CLEANED)


def transforms_near(spark: SparkSession, sf: str) -> DataFrame:
    rows = spread(document_records(spark, sf), "id")
    kept = stages.transform_rows(rows, "documents", "text", Settings(dedup_near=True))
    return kept.select("id", "content_hash", *MEASURES)


def _two_days(spark: SparkSession, sf: str, near: bool) -> DataFrame:
    """The documents ingested on two days, every second text changed on the later one."""
    base = fresh_path(spark, "days")
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"))
    spec = SourceSpec("daily", "content", "shards", None, {"doc_id": _long})
    settings = Settings(source="daily", language="text", dedup_near=near)
    for day in (0, 1):
        folders = stages.Folders(f"{base}/source-{day}", f"{base}/data")
        changed = F.concat("content", F.lit("\nchanged since"))
        rows = docs.withColumn("content", F.when((F.col("doc_id") % 2 == 1) & F.lit(day == 1), changed).otherwise(F.col("content")))
        in_order(rows, "doc_id").write.parquet(f"{folders.source}/shards")
        stages.ingest_stage(spark, folders, settings, RUN_TS + timedelta(days=day), spec)
    cleaned_rows = stages.transform_stage(spark, stages.Folders("", f"{base}/data"), settings, spec)
    return cleaned_rows.select("id", "doc_id", "content_hash", "num_lines")


def two_days(spark: SparkSession, sf: str) -> DataFrame:
    return _two_days(spark, sf, near=False)


def two_days_near(spark: SparkSession, sf: str) -> DataFrame:
    return _two_days(spark, sf, near=True)


def wide_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Exact dedup where ids grow a digit: the first of equal texts is the first by position."""
    position = F.col("doc_id") + WIDE_FROM
    rows = table(spark, sf, "documents").select(
        registry.record_id("documents", "text", position).alias("id"), position.alias("position"), F.col("text").alias("content"))
    return stages.transform_rows(spread(rows, "id"), "documents", "text").select("id", "content_hash")


def score_stage(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select(*SCORED)


def full_run(spark: SparkSession, sf: str) -> DataFrame:
    """Ingest, transform and score through all layers on disk; the source is rendered code
    and, after it, the documents' own texts, all taken for Python."""
    base = fresh_path(spark, "run")
    code = rendered_records(spark, sf).select(F.lit("rendered").alias("part"), "id", "content")
    prose = documents(spark, sf).select(F.lit("written").alias("part"), F.format_string("%06d", "id").alias("id"), "content")
    in_order(code.unionByName(prose), "part", "id").write.parquet(f"{base}/source/shards")
    spec = SourceSpec("rendered", "content", "shards", None, {"size": _long})
    settings = Settings(source="rendered", language="python")
    folders = stages.Folders(f"{base}/source", f"{base}/data")
    result = stages.run(spark, folders, settings, "all", record_replies(spark, sf), RUN_TS, spec)
    stamp = F.date_format("scored_at", "yyyy-MM-dd'T'HH:mm:ss").alias("scored_at")
    return result.select(*SCORED, "size", stamp)


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.run_summary(scored(spark, sf))


def stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a run over both corpora, all texts taken for Python."""
    return reports.stage_counts(both_corpora(spark, sf).select("id", "content"), "python")


def stage_counts_near(spark: SparkSession, sf: str) -> DataFrame:
    rows = spread(document_records(spark, sf), "id")
    return reports.stage_counts(rows, "text", Settings(dedup_near=True))


def overview_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return reports.overview_metrics(stored_scored(spark, sf))


def score_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return reports.score_histogram(scored(spark, sf))


def score_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return reports.score_distribution(scored(spark, sf))


def sample_browser(spark: SparkSession, sf: str) -> DataFrame:
    return reports.sample_browser(stored_scored(spark, sf))


def browse_unscored(spark: SparkSession, sf: str) -> DataFrame:
    """The browser over a layer that has no composite yet."""
    return reports.sample_browser(stored_cleaned(spark, sf))


def rows_above(spark: SparkSession, sf: str) -> DataFrame:
    return reports.rows_above(scored(spark, sf))


def registered_sources(spark: SparkSession, sf: str) -> DataFrame:
    """All registered layouts, scanned: documents laid out as each source lays out its files."""
    root = fresh_path(spark, "sources")
    docs = table(spark, sf, "documents")
    frames = []
    for spec in registry.SOURCES.values():
        given = {"size": F.col("n_chars"), "entry_point": F.col("lang"), "repository_name": F.col("source")}
        shaped = docs.select(F.col("text").alias(spec.content_field), *(
            given[name].cast(kind).alias(name) for name, kind in spec.extras.items() if name in given))
        for language in ("python", "other"):
            part = shaped if language == "python" else shaped.limit(1)
            folder = spec.path(f"{root}/{spec.name}", language).replace("*", "00000")
            if language == "python" or "{language}" in spec.layout:
                part.write.parquet(folder)
        df = registry.read_source(spark, spec, f"{root}/{spec.name}", "python")
        frames.append(df.select(F.lit(spec.name).alias("source"), *(c.alias(n) for n, c in registry.map_fields(df, spec).items())))
    return registry.union_by_name(frames)


def language_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Kept documents per language: hash, first copy, measures and cut-offs in one plan."""
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("language"), F.col("text").alias("content")
    )
    kept = features.apply_hard_filters(features.add_text_features(dedup.deduplicate(spread(rows, "id"))))
    return kept.groupBy("language").agg(F.count("*").alias("n"), F.sum("num_lines").alias("lines"))


NAMES = [
    source_mapping, scan_language, ingest_records, partition_roundtrip, jsonl_roundtrip, normalise_schema,
    union_by_name, text_features, content_hash, exact_dedup, hard_filter, python_structure,
    structure_non_python, minhash_bands, near_dup_lookup, near_dedup, syntactic_score, doc_score,
    security_findings, security_score, max_severity, judge_sample, judge_prompt, judge_parse, judge_attach,
    composite_no_judge, composite_with_judge, threshold_flag, run_transforms, transforms_near, score_stage,
    full_run, run_summary, stage_counts, stage_counts_near, overview_metrics, score_histogram, score_distribution,
    sample_browser, browse_unscored, rows_above, registered_sources, two_days, two_days_near, wide_positions,
    language_profile,
]


def _prepared(query: Query) -> Query:
    def call(spark: SparkSession, sf: str) -> DataFrame:
        return query(prepare(spark), sf)

    call.__name__ = query.__name__
    call.__doc__ = query.__doc__
    return call


def all_queries() -> dict[str, Query]:
    registered = {q.__name__: _prepared(q) for q in NAMES}
    registered["ingest_first_n"] = _prepared(lambda spark, sf: ingest_records(spark, sf, FIRST_N))
    return registered
