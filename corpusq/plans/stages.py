"""Ingest, transform and score, singly or as one run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusq.config import Settings
from corpusq.operators import dedup, features, judge, scoring
from corpusq.session import prepare
from corpusq.sources import layers, registry

STAGES = ("ingest", "transform", "score", "all")


class StageCounts:
    """Rows before and after each removal, counted while a transform runs."""

    NAMES = ("raw_rows", "unique_rows", "near_rows", "kept_rows", "parseable_rows")

    def __init__(self) -> None:
        self._seen = {name: Observation(name) for name in self.NAMES}

    def watch(self, df: DataFrame, name: str, rows: Column | None = None) -> DataFrame:
        counted = F.count("*") if rows is None else F.count_if(rows)
        return df.observe(self._seen[name], counted.alias("rows"))

    def get(self) -> dict[str, int]:
        """The counts, once the transformed rows have been written."""
        return {name: int(seen.get["rows"]) for name, seen in self._seen.items()}


def transform_rows(df: DataFrame, source: str, language: str, settings: Settings = Settings(),
                   counts: StageCounts | None = None) -> DataFrame:
    """Exact dedup, near dedup if switched on, source stamp, measures, cut-offs, structure.

    The order decides the result: of equal stripped texts only the first is ever
    tested against the cut-offs. First is by (date, position) where the rows have them, else
    by id. The measures depend on one row alone, though, so they are taken before rows are
    moved, and the text of a row that will fail is left behind: each surviving text crosses
    the network once, a failing one never. Near dedup names its survivors by text hash,
    which exact dedup makes unique, and so decides on the rows where they already lie.
    """
    watch = counts.watch if counts else lambda frame, *_: frame
    order = [c for c in ("date", "position") if c in df.columns] or ["id"]
    measured = features.add_text_features(dedup.add_content_hash(watch(df, "raw_rows")))
    passes = F.coalesce(features.passes_cutoffs(settings), F.lit(False))
    slim = measured.withColumn("_passes", passes).withColumn(
        "content", F.when(F.col("_passes"), F.col("content"))
    )
    firsts = watch(dedup.first_per(slim, "content_hash", *order, "id"), "unique_rows")
    if settings.dedup_near:
        firsts = firsts.withColumn("_hash", F.coalesce("content_hash", F.lit(NO_TEXT))).join(
            _near_survivors(df, settings), "_hash", "left_semi").drop("_hash")
    survivors = watch(watch(firsts, "near_rows").filter("_passes").drop("_passes"), "kept_rows")
    out = features.add_structure(registry.normalise_schema(survivors, source), language)
    return watch(out, "parseable_rows", F.col("is_parseable"))


NO_TEXT = "no text"


def _near_survivors(df: DataFrame, settings: Settings) -> DataFrame:
    """Text hashes left by near dedup of the distinct texts, in hashed order of their hashes."""
    hashed = dedup.add_content_hash(df.select("id", "content"))
    hashed = hashed.select(F.coalesce("content_hash", F.lit(NO_TEXT)).alias("id"), "content")
    # Copies of a text have equal buckets and meet in one combining grouping.
    rows = dedup.add_bucket_keys(hashed, "content", "id", settings).groupBy("id").agg(F.first("_buckets").alias("buckets"))
    return dedup.keep_first(rows).withColumnRenamed("id", "_hash")


def score_rows(df: DataFrame, settings: Settings = Settings(), replies: DataFrame | None = None,
               run_ts: datetime | None = None) -> DataFrame:
    """All score columns, the composite, the pass flag and the stamps; no row is dropped."""
    scored = df.transform(scoring.add_syntactic_score).transform(scoring.add_doc_score)
    scored = scored.transform(scoring.add_security).transform(scoring.add_max_severity)
    scored = judge.attach_judgements(scored, replies, settings)
    scored = scoring.add_threshold_flag(scoring.add_composite_score(scored, settings), settings)
    stamp = F.lit(run_ts) if run_ts else F.current_timestamp()
    return scored.withColumns(
        {"pipeline_version": F.lit(settings.version), "scored_at": stamp.cast("timestamp")}
    )


@dataclass(frozen=True)
class Folders:
    """Where a run reads its source and keeps its layers."""

    source: str
    data: str

    @property
    def raw(self) -> str:
        return f"{self.data}/raw"

    @property
    def processed(self) -> str:
        return f"{self.data}/processed"

    @property
    def scored_parquet(self) -> str:
        return f"{self.data}/scored/scored.parquet"

    @property
    def scored_jsonl(self) -> str:
        return f"{self.data}/scored/scored.jsonl"


def ingest_stage(spark: SparkSession, folders: Folders, settings: Settings,
                 run_ts: datetime | None = None, spec: registry.SourceSpec | None = None) -> DataFrame:
    spec = spec or registry.lookup(settings.source)
    scan = registry.read_source(spark, spec, folders.source, settings.language)
    records = registry.ingest(scan, spec, settings.language, settings.sample_size, run_ts)
    layers.write_raw(records, folders.raw, run_ts)
    return layers.read_raw(spark, folders.raw, spec, settings.language)


def transform_stage(spark: SparkSession, folders: Folders, settings: Settings,
                    spec: registry.SourceSpec | None = None, counts: StageCounts | None = None) -> DataFrame:
    """Clean all days of one source and language; ``counts`` is filled in on the way.

    Days are read together. Ids restart with each of them, so rows are told apart by day
    and position, and of a text found on several days the earliest row stays.
    """
    spec = spec or registry.lookup(settings.source)
    raw = layers.read_raw(spark, folders.raw, spec, settings.language)
    cleaned = transform_rows(raw, spec.name, settings.language, settings, counts).drop("date")
    layers.write_cleaned(cleaned, folders.processed, part=(spec.name, settings.language))
    return layers.read_cleaned(spark, folders.processed, spec)


def score_stage(spark: SparkSession, folders: Folders, settings: Settings,
                replies: DataFrame | None = None, run_ts: datetime | None = None,
                spec: registry.SourceSpec | None = None) -> DataFrame:
    """Score every cleaned file, write Parquet, and JSON Lines from that Parquet."""
    scored = score_rows(layers.read_cleaned(spark, folders.processed, spec), settings, replies, run_ts)
    layers.write_scored_parquet(scored, folders.scored_parquet)
    stored = spark.read.parquet(folders.scored_parquet)
    layers.write_jsonl(stored, folders.scored_jsonl)
    return stored


def run(spark: SparkSession, folders: Folders, settings: Settings = Settings(), stage: str = "all",
        replies: DataFrame | None = None, run_ts: datetime | None = None,
        spec: registry.SourceSpec | None = None, counts: StageCounts | None = None) -> DataFrame:
    """One stage, or all in turn. Returns the last stage's table; a score run's summary
    is ``reports.run_summary`` of it."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}, known are {STAGES}")
    prepare(spark)
    result = None
    if stage in ("ingest", "all"):
        result = ingest_stage(spark, folders, settings, run_ts, spec)
    if stage in ("transform", "all"):
        result = transform_stage(spark, folders, settings, spec, counts)
    if stage in ("score", "all"):
        result = score_stage(spark, folders, settings, replies, run_ts, spec)
    return result
