"""Score cleaned files as they arrive.

Without judgements every score depends on one row alone. The stream tells which sources and
languages have new files; their cleaned rows are then scored as a whole and replace what
the output holds of them. A file that a transform rewrites is thus never counted twice,
and a batch that is repeated after a failure writes the same again. Dedup compares rows
across the whole corpus and stays a batch step.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusq.config import Settings
from corpusq.plans.stages import Folders, score_rows
from corpusq.schemas import cleaned_schema
from corpusq.session import prepare
from corpusq.sources import layers
from corpusq.sources.registry import SourceSpec


def arrivals_path(folders: Folders) -> str:
    """Where streamed scores are kept, apart from those of the batch stage."""
    return f"{folders.data}/scored/arrivals"


def score_arrivals(spark: SparkSession, folders: Folders, settings: Settings = Settings(),
                   run_ts: datetime | None = None, files_per_batch: int = 1000,
                   spec: SourceSpec | None = None) -> StreamingQuery:
    """Bring ``arrivals_path`` up to date with the cleaned layer, and stop."""
    prepare(spark)
    schema = cleaned_schema(layers.known_extras(spec))
    arriving = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
        .parquet(folders.processed)
    )

    def replace(batch: DataFrame, _: int) -> None:
        touched = batch.select(*layers.CLEANED_KEYS).distinct()
        current = layers.read_cleaned(spark, folders.processed, spec).join(
            F.broadcast(touched), [*layers.CLEANED_KEYS], "left_semi")  # a row per directory
        layers.write_cleaned(score_rows(current, settings, None, run_ts), arrivals_path(folders), balance=True)

    return (
        arriving.writeStream.foreachBatch(replace)
        .option("checkpointLocation", f"{folders.data}/scored/arrivals-log")
        .trigger(availableNow=True).start()
    )
