"""Reading and writing the raw, cleaned and scored layers."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.schemas import cleaned_schema, raw_schema
from corpusq.sources.registry import SOURCES, SourceSpec

RAW_KEYS = ("source", "language", "date")
CLEANED_KEYS = ("source", "language")


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], balance: bool = False) -> None:
    """Hive-style Parquet directories; a rerun replaces only the partitions it writes.

    ``balance`` evens out file sizes when rows of many partitions are mixed: Spark
    splits a partition that is too large over several tasks and merges small ones,
    so one dominant source neither lands in one task nor leaves a file per task.
    """
    if balance:
        df = df.hint("rebalance", *keys)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*keys).parquet(path))


def write_raw(df: DataFrame, path: str, run_ts: datetime | None = None, balance: bool = False) -> None:
    stamp = F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp()
    write_partitioned(df.withColumn("date", F.to_date(stamp)), path, RAW_KEYS, balance)


def read_raw(spark: SparkSession, path: str, spec: SourceSpec, language: str) -> DataFrame:
    """All files of one source and language; other directories are pruned, not read.

    The explicit schema keeps directory keys as strings, also those that look numeric.
    """
    return (
        spark.read.schema(raw_schema(spec.extras)).parquet(path)
        .filter((F.col("source") == spec.name) & (F.col("language") == language))
    )


def known_extras(spec: SourceSpec | None = None) -> dict[str, T.DataType]:
    """The extra columns of all registered sources, and of ``spec``."""
    specs = [*SOURCES.values(), *([spec] if spec else [])]
    return {name: kind for s in specs for name, kind in s.extras.items()}


MANIFEST = "_schemas"  # Spark's readers skip folders whose names begin with an underscore


def write_cleaned(df: DataFrame, path: str, balance: bool = False, part: tuple[str, str] | None = None) -> None:
    """Write the rows; with ``part`` (source, language), also that part's schema to the
    layer's manifest, replacing what an earlier run wrote for it."""
    write_partitioned(df, path, CLEANED_KEYS, balance)
    if part is not None:
        source, language = part
        columns = T.StructType([f for f in df.schema if f.name not in CLEANED_KEYS])
        entry = df.sparkSession.createDataFrame([(columns.json(),)], "value string")
        entry.coalesce(1).write.mode("overwrite").text(f"{path}/{MANIFEST}/source={source}/language={language}")


def manifest_columns(spark: SparkSession, path: str) -> list[T.StructField]:
    """Columns the manifest names for any part of the layer, first mention first; one small
    file per source and language is read, no data file is opened."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    found: dict[str, T.StructField] = {}
    for row in spark.read.text(f"{path}/{MANIFEST}/*/*").select("value").collect():
        for f in T.StructType.fromJson(json.loads(row.value)):
            found.setdefault(f.name, f)
    return list(found.values())


def read_cleaned(spark: SparkSession, path: str, spec: SourceSpec | None = None) -> DataFrame:
    """Every cleaned file, columns united by name. A missing or empty folder raises.

    The layer's schema is known, so no data file is opened to find it, and directory keys
    stay text: the common columns, the extras of registered sources and of ``spec``, and
    every column the layer's manifest names for one of its parts (a source scored with
    others keeps its own extras), null in rows of parts that lack them.
    """
    schema = cleaned_schema(known_extras(spec))
    have = set(schema.names)
    extra = [f for f in manifest_columns(spark, path) if f.name not in have]
    if extra:
        keys = [f for f in schema if f.name in CLEANED_KEYS]
        schema = T.StructType([f for f in schema if f.name not in CLEANED_KEYS] + extra + keys)
    df = spark.read.schema(schema).parquet(path)
    if not df.inputFiles():
        raise ValueError(f"no cleaned files in {path}")
    return df


def read_tree(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every Parquet file at any depth, directory names ignored; without a schema all files
    are opened to unite their columns."""
    reader = spark.read.option("recursiveFileLookup", True)
    return (reader.schema(schema) if schema else reader.option("mergeSchema", True)).parquet(path)


def write_scored_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON Lines with explicit nulls, timestamps as ISO-8601 text without a zone (UTC)."""
    stamps = {
        f.name: F.date_format(F.col(f.name), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    out = df.withColumns(stamps) if stamps else df
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
