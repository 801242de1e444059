"""Known sources, and their mapping into the raw layout."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.session import written

@dataclass(frozen=True)
class SourceSpec:
    """How one source is laid out on disk and which of its columns mean what.

    ``layout`` is the path below the source's root; ``{language}`` picks the shards
    of one language, so that other languages are never listed or read.
    """

    name: str
    content_field: str
    layout: str
    language_field: str | None = None
    extras: dict[str, T.DataType] = field(default_factory=dict)

    def path(self, root: str, language: str) -> str:
        return f"{root.rstrip('/')}/{self.layout.format(language=language)}".rstrip("/")


_text, _long, _double = T.StringType(), T.LongType(), T.DoubleType()

# Names and fields of the public datasets.
SOURCES = {
    spec.name: spec
    for spec in (
        SourceSpec(
            "the-stack", "content", "data/{language}/train-*.parquet", "lang",
            {"size": _long, "avg_line_length": _double, "max_line_length": _long,
             "alphanum_fraction": _double},
        ),
        SourceSpec(
            "codesearchnet", "func_code_string", "{language}/train", "language",
            {"func_documentation_string": _text, "repository_name": _text},
        ),
        SourceSpec(
            "humaneval", "prompt", "test", None,
            {"canonical_solution": _text, "test": _text, "entry_point": _text},
        ),
    )
}


def lookup(source: str) -> SourceSpec:
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r}, known are {sorted(SOURCES)}")
    return SOURCES[source]


def read_source(spark: SparkSession, spec: SourceSpec, root: str, language: str) -> DataFrame:
    """Scan of one source and language. A missing path raises Spark's own error."""
    return spark.read.parquet(spec.path(root, language))


def map_fields(df: DataFrame, spec: SourceSpec) -> dict[str, Column]:
    """``content`` and the extras as expressions over a source's columns.

    An absent content field reads as "", an absent extra as null; nulls in
    present columns stay null.
    """
    content = F.col(spec.content_field) if spec.content_field in df.columns else F.lit("")
    mapped = {"content": content.cast("string")}
    for name, kind in spec.extras.items():
        mapped[name] = (F.col(name) if name in df.columns else F.lit(None)).cast(kind)
    return mapped


def with_position(df: DataFrame, n: int | None = None) -> DataFrame:
    """Add ``position``: 0-based place of each row in file order, then row order.

    ``df`` must be a file scan. Rows are not sorted or moved: a row's place in its
    file comes with the scan, and only the per-file row counts are summed up, one
    row per file. With ``n`` given only the first n rows are kept and the
    files beyond them are not opened again.
    """
    if n is not None:
        df = df.filter(_in_files(_first_files(df, n)))
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.row_index").alias("_row"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        placed.groupBy("_file").agg(F.count("*").alias("_rows"))
        .select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")),
        "starts",
    )
    positioned = placed.join(starts, "_file").withColumn("position", F.col("_start") + F.col("_row")).drop(
        "_file", "_row", "_start")
    return positioned if n is None else positioned.filter(F.col("position") < n)


def _in_files(names: list[str]) -> Column:
    """Rows of the named files; the listing and the scan may spell a path differently."""
    spelt = {form for n in names for form in (n, unquote(n))}
    return F.col("_metadata.file_path").isin(sorted(spelt | {n.replace("file:///", "file:/") for n in spelt}))


def _first_files(df: DataFrame, n: int) -> list[str]:
    """The files, in name order, that hold the first ``n`` rows, found by counting growing
    groups of files; files beyond them are not opened."""
    names = sorted(set(df.inputFiles()))
    taken, group, rows, needed = 0, 1, 0, []
    while rows < n and taken < len(names):
        counts = df.filter(_in_files(names[taken:taken + group])).groupBy("_metadata.file_path").count()
        for path, count in sorted(tuple(r) for r in counts.collect()):  # a row per file of the group
            if rows < n:
                needed.append(path)
            rows += count
        taken, group = taken + group, group * 2
    return needed


def record_id(source: str, language: str, position: Column) -> Column:
    """``{source}_{language}_`` and the position, zero-padded to six digits or longer."""
    return F.concat(F.lit(f"{source}_{language}_"), F.format_string("%06d", position))


def ingest(df: DataFrame, spec: SourceSpec, language: str, n: int | None,
           run_ts: datetime | None = None) -> DataFrame:
    """The first ``n`` rows of a source scan (all with None) as raw records."""
    stamp = F.lit(run_ts) if run_ts else F.current_timestamp()
    rows = with_position(df, n)
    mapped = map_fields(df, spec)
    return rows.select(
        record_id(spec.name, language, F.col("position")).alias("id"),
        F.col("position"),
        F.lit(spec.name).alias("source"),
        F.lit(language).alias("language"),
        mapped.pop("content").alias("content"),
        stamp.cast("timestamp").alias("ingested_at"),
        *[c.alias(name) for name, c in mapped.items()],
    )


def normalise_schema(df: DataFrame, source: str) -> DataFrame:
    """Stamp ``source``, replacing whatever the rows carried."""
    return df.withColumn("source", F.lit(source))


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; columns match by name, absent ones read as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
