"""Command line: ``spark-submit`` this package, or ``python -m corpusq``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from corpusq.config import Settings
from corpusq.plans import reports, stages
from corpusq.sources.registry import SOURCES


def main(argv: list[str] | None = None) -> None:
    defaults = Settings()
    p = argparse.ArgumentParser(prog="corpusq")
    p.add_argument("--stage", default="all", choices=stages.STAGES)
    p.add_argument("--source", default=defaults.source, choices=sorted(SOURCES))
    p.add_argument("--language", default=defaults.language)
    p.add_argument("--sample", type=int, default=defaults.sample_size, help="first N rows only")
    p.add_argument("--near-dedup", action="store_true")
    p.add_argument("--source-dir", required=True, help="root folder of the source's Parquet files")
    p.add_argument("--data-dir", required=True, help="root folder of the raw, processed and scored layers")
    p.add_argument("--replies", help="Parquet table (id, reply) of judge replies")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName("corpusq").getOrCreate()
    settings = Settings(source=a.source, language=a.language, sample_size=a.sample, dedup_near=a.near_dedup)
    replies = spark.read.parquet(a.replies) if a.replies else None
    result = stages.run(spark, stages.Folders(a.source_dir, a.data_dir), settings, a.stage, replies)
    if a.stage in ("score", "all"):
        reports.run_summary(result).show(truncate=False)


if __name__ == "__main__":
    main()
