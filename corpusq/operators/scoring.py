"""Score columns, with the documented default where an input column is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.config import Settings
from corpusq.functions import analysis, scores, security
from corpusq.session import ship_package

# What a missing column counts as. A null in a present column stays null.
DEFAULTS = {
    "is_parseable": False,
    "num_lines": 0,
    "avg_line_length": 0.0,
    "alphanum_fraction": 1.0,
    "num_functions": 0,
    "num_classes": 0,
    "has_docstring": False,
    "comment_ratio": 0.0,
    "syntactic_score": 0.0,
    "doc_score": 0.0,
    "security_score": 0.0,
}


def col_or_default(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(DEFAULTS[name])


def add_syntactic_score(df: DataFrame) -> DataFrame:
    names = ["is_parseable", "num_lines", "avg_line_length", "alphanum_fraction",
             "num_functions", "num_classes"]
    return df.withColumn("syntactic_score", scores.syntactic(*[col_or_default(df, n) for n in names]))


def add_doc_score(df: DataFrame) -> DataFrame:
    names = ["has_docstring", "comment_ratio", "num_functions"]
    return df.withColumn("doc_score", scores.documentation(*[col_or_default(df, n) for n in names]))


def _findings(df: DataFrame, content_col: str) -> Column:
    """Findings of each text: from its syntax tree where it is Python that parses, else by lines.

    Python rows (``language`` = python) go through one parse (functions/analysis.py); a text
    that does not parse falls back to the line rules, and one whose parse ran out of time gets
    null, which scores as unknown. Rows without a ``language`` column are scanned by lines.
    """
    text = F.col(content_col)
    if "language" not in df.columns:
        return security.findings(text)
    ship_package(df.sparkSession)
    tree = analysis.tree_findings(F.when(F.col("language") == "python", text))
    return (F.when(tree["state"] == analysis.TREE, tree["findings"])
            .when(tree["state"] == analysis.FAILED, F.lit(None))
            .otherwise(security.findings(text)))


def add_security(df: DataFrame, content_col: str = "content") -> DataFrame:
    """Findings, their counts and the security score, all within the row."""
    scanned = df.withColumn("_found", _findings(df, content_col))
    found = F.col("_found")
    listed = F.coalesce(found, F.array().cast(scanned.schema["_found"].dataType))
    return scanned.withColumns(
        {
            "security_score": security.score(found),
            "security_findings": listed,
            "security_finding_count": F.size(listed).cast("bigint"),
            "security_high_count": security.count_severity(listed, "HIGH"),
        }
    ).drop("_found")


def security_findings(df: DataFrame, id_col: str = "id", content_col: str = "content") -> DataFrame:
    """One row (id, severity, text, line) per finding."""
    # The plain form would derive a not-empty filter and scan every text twice.
    hits = df.select(id_col, F.inline_outer(_findings(df, content_col)))
    return hits.filter("severity is not null")


def add_max_severity(df: DataFrame) -> DataFrame:
    return df.withColumn("security_severity", security.max_severity(F.col("security_findings")))


def add_composite_score(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    parts = [col_or_default(df, n) for n in ("syntactic_score", "doc_score", "security_score")]
    llm = F.col("llm_score") if "llm_score" in df.columns else F.lit(None).cast("double")
    return df.withColumn("composite_score", scores.composite(*parts, llm, settings))


def add_threshold_flag(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    passed = F.col("composite_score") >= F.lit(float(settings.quality_threshold))
    return df.withColumn("above_threshold", F.coalesce(passed, F.lit(False)))
