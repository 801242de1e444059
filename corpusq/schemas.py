"""Fixed column layouts of the raw, cleaned and scored layers."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_FIELDS = [
    T.StructField("id", T.StringType()),
    T.StructField("position", T.LongType()),
    T.StructField("content", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
]

# Kept in directory names on disk and restored on read.
RAW_PARTITION_FIELDS = [
    T.StructField("source", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("date", T.DateType()),
]

CLEANED_FIELDS = [
    T.StructField("content_hash", T.StringType()),
    T.StructField("num_lines", T.IntegerType()),
    T.StructField("avg_line_length", T.DoubleType()),
    T.StructField("alphanum_fraction", T.DoubleType()),
    T.StructField("comment_ratio", T.DoubleType()),
    T.StructField("is_parseable", T.BooleanType()),
    T.StructField("num_functions", T.LongType()),
    T.StructField("num_classes", T.LongType()),
    T.StructField("has_docstring", T.BooleanType()),
    T.StructField("parse_error", T.StringType()),
]

FINDING = T.StructType(
    [
        T.StructField("severity", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("line", T.IntegerType()),
    ]
)

STRUCTURE = T.StructType([f for f in CLEANED_FIELDS if f.name in (
    "is_parseable", "num_functions", "num_classes", "has_docstring", "parse_error")])

SCORED_FIELDS = [
    T.StructField("syntactic_score", T.DoubleType()),
    T.StructField("doc_score", T.DoubleType()),
    T.StructField("security_score", T.DoubleType()),
    T.StructField("security_findings", T.ArrayType(FINDING)),
    T.StructField("security_finding_count", T.LongType()),
    T.StructField("security_high_count", T.LongType()),
    T.StructField("security_severity", T.StringType()),
    T.StructField("llm_score", T.DoubleType()),
    T.StructField("llm_reason", T.StringType()),
    T.StructField("composite_score", T.DoubleType()),
    T.StructField("above_threshold", T.BooleanType()),
    T.StructField("pipeline_version", T.StringType()),
    T.StructField("scored_at", T.TimestampType()),
]


def raw_schema(extras: dict[str, T.DataType] | None = None) -> T.StructType:
    """Raw layer of one source: the common fields, its extras, the directory keys."""
    extra_fields = [T.StructField(name, kind) for name, kind in (extras or {}).items()]
    return T.StructType(RAW_FIELDS + extra_fields + RAW_PARTITION_FIELDS)


def cleaned_schema(extras: dict[str, T.DataType] | None = None) -> T.StructType:
    """Cleaned layer with sources' extras; the partition columns come last."""
    measured = {f.name for f in CLEANED_FIELDS}  # these replace a source's own figures
    extra_fields = [T.StructField(name, kind) for name, kind in (extras or {}).items() if name not in measured]
    return T.StructType(RAW_FIELDS + extra_fields + CLEANED_FIELDS + RAW_PARTITION_FIELDS[:2])


def scored_schema(extras: dict[str, T.DataType] | None = None) -> T.StructType:
    """Scored layer: the cleaned columns, then the scores and stamps."""
    return T.StructType(list(cleaned_schema(extras)) + SCORED_FIELDS)
