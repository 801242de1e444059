"""Text measures, hard cut-offs and Python structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.config import Settings
from corpusq.functions import text as tx
from corpusq.functions.structure import python_structure
from corpusq.session import ship_package

TEXT_COLUMNS = ["num_lines", "avg_line_length", "alphanum_fraction", "comment_ratio"]
STRUCTURE_COLUMNS = ["is_parseable", "num_functions", "num_classes", "has_docstring", "parse_error"]


def add_text_features(df: DataFrame, content_col: str = "content") -> DataFrame:
    """num_lines, avg_line_length, alphanum_fraction and comment_ratio of the unstripped text.

    Columns of the same name that came with the source are replaced.
    """
    c = F.col(content_col)
    counted = (
        df.drop(*TEXT_COLUMNS)
        .withColumn("_unusual", tx.has_unusual_ends(c))
        .withColumn("_unended", tx.length_without_line_ends(c, F.col("_unusual")))
        .withColumn("_lines", tx.line_count(c, F.col("_unusual"), F.col("_unended")))
    )
    lines = tx.at_least_one(F.col("_lines"))
    # A one-row stack rather than a projection: a filter on a measure would be
    # pushed below a projection, and each text pass would run twice per row.
    measures = F.stack(
        F.lit(1), F.col("_lines"), F.col("_unended") / lines, tx.alphanumeric_fraction(c),
        tx.comment_line_count(c, F.col("_unusual")) / lines,
    ).alias(*TEXT_COLUMNS)
    return counted.select("*", measures).drop("_unusual", "_unended", "_lines")


def passes_cutoffs(settings: Settings = Settings()) -> Column:
    """True where a row meets every hard cut-off; false or null elsewhere."""
    return (
        F.col("num_lines").between(settings.min_lines, settings.max_lines)
        & (F.col("alphanum_fraction") >= settings.min_alphanum)
        & (F.col("avg_line_length") <= settings.max_avg_line_length)
    )


def apply_hard_filters(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return df.filter(passes_cutoffs(settings))


def add_structure(df: DataFrame, language: str | None = None, content_col: str = "content") -> DataFrame:
    """Parser-derived columns for Python rows, constants for the rest.

    With ``language`` given all rows share it, and for any language but Python no
    Python worker starts. Without it the ``language`` column decides per row, and
    rows of other languages reach the worker as null.
    """
    if language is not None and language != "python":
        s = F.lit(None).cast("struct<is_parseable:boolean,num_functions:bigint,num_classes:bigint,"
                             "has_docstring:boolean,parse_error:string>")
        with_struct = df.withColumn("_structure", s)
    else:
        ship_package(df.sparkSession)
        code = F.col(content_col)
        if language is None:
            code = F.when(F.col("language") == "python", code)
        with_struct = df.withColumn("_structure", python_structure(code))
    s = F.col("_structure")
    return with_struct.withColumns(
        {
            "is_parseable": s["is_parseable"],
            "num_functions": F.coalesce(s["num_functions"], F.lit(0).cast("bigint")),
            "num_classes": F.coalesce(s["num_classes"], F.lit(0).cast("bigint")),
            "has_docstring": F.coalesce(s["has_docstring"], F.lit(False)),
            "parse_error": s["parse_error"],
        }
    ).drop("_structure")
