"""Counts, distributions and a browsing view over the layers.

Every report aggregates map-side and returns a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.config import Settings
from corpusq.plans import stages

# The columns the reports look for.
SCORE_COLUMNS = ("syntactic_score", "doc_score", "security_score", "llm_score")
BROWSE_COLUMNS = ("composite_score", "language", "num_lines", "is_parseable", "content")


def _ratio(part: Column, whole: Column) -> Column:
    """Share to 6 places; null where there is nothing to divide by."""
    return F.round(part.cast("decimal(18,0)") / F.nullif(whole, F.lit(0)).cast("decimal(18,0)"), 6).cast("double")


def _with_ratios(counts: DataFrame, whole: str, **ratios: str) -> DataFrame:
    return counts.withColumns({name: _ratio(F.col(part), F.col(whole)) for name, part in ratios.items()})


def run_summary(scored: DataFrame) -> DataFrame:
    """Rows scored, passed and with findings, with the shares of the latter two."""
    counts = scored.agg(
        F.count("*").alias("total"),
        F.count_if("above_threshold").alias("passed"),
        F.count_if(F.col("security_finding_count") > 0).alias("with_findings"),
    )
    return _with_ratios(counts, "total", pass_rate="passed", findings_rate="with_findings")


def overview_metrics(scored: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Total, passed and distinct texts; rows with a finding of any severity, and their share."""
    threshold = F.lit(float(settings.quality_threshold))
    aggregates = [
        F.count("*").alias("total"),
        F.count_if(F.col("composite_score") >= threshold).alias("passed"),
        F.countDistinct("content_hash").alias("unique_samples"),
    ]
    shares = {"pass_rate": "passed"}
    if "security_severity" in scored.columns:
        aggregates.append(F.count_if(F.col("security_severity") != "NONE").alias("flagged"))
        shares["flagged_rate"] = "flagged"
    return _with_ratios(scored.agg(*aggregates), "total", **shares)


def rows_above(scored: DataFrame, threshold: float = 0.7) -> DataFrame:
    """How many rows the browser has to show at a threshold."""
    return scored.agg(F.count_if(F.col("composite_score") >= threshold).alias("matching"))


def score_histogram(scored: DataFrame, bins: int = 50) -> DataFrame:
    """Rows per equal-width bin of the composite over 0 to 1, empty bins included."""
    # DECIMAL keeps scores on a bin edge, such as 0.58, in the upper bin.
    bin_of = F.least(
        F.floor(F.col("composite_score").cast("decimal(6,4)") * bins).cast("int"), F.lit(bins - 1)
    )
    counts = scored.filter(F.col("composite_score").isNotNull()).groupBy(bin_of.alias("bin")).agg(
        F.count("*").alias("n")
    )
    every_bin = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every_bin.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def score_distribution(scored: DataFrame) -> DataFrame:
    """Box summary (min, quartiles, max, count) of each score column present."""
    present = [c for c in SCORE_COLUMNS if c in scored.columns]
    long = scored.select(*[F.col(c).cast("double") for c in present]).unpivot(
        [], present, "score_type", "score"
    )
    # Scores take few distinct values, and the exact percentile keeps a count per
    # value, so its state stays small however many rows there are.
    quartiles = F.percentile("score", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        long.filter("score is not null").groupBy("score_type")
        .agg(F.min("score").alias("low"), quartiles.alias("_q"), F.max("score").alias("high"),
             F.count("*").alias("n"))
        .select("score_type", "low", *[F.round(F.col("_q")[i], 6).alias(f"q{i + 1}") for i in range(3)],
                "high", "n")
    )


def sample_browser(scored: DataFrame, threshold: float = 0.7, rows: int | None = None, id_col: str = "id") -> DataFrame:
    """Rows at or above a composite, best first, as those browse columns that exist; the best
    ``rows`` of them if given. Without a composite column, all rows in order of id.

    ``scored`` should be the stored table. A top-n runs over (composite, id) alone and the
    winners' texts are fetched afterwards.
    """
    columns = [c for c in BROWSE_COLUMNS if c in scored.columns]
    order = [F.col(id_col)]
    shown = scored
    if "composite_score" in scored.columns:
        order = [F.col("composite_score").desc(), *order]
        shown = scored.filter(F.col("composite_score") >= threshold)
    if rows is not None:
        narrow = [id_col, *(c for c in ("composite_score",) if c in scored.columns)]
        best = shown.select(*narrow).orderBy(*order).limit(rows).select(id_col)
        return shown.join(best, id_col, "left_semi").orderBy(*order).limit(rows).select(id_col, *columns)
    return shown.orderBy(*order).select(id_col, *columns)


def stage_counts(raw: DataFrame, language: str, settings: Settings = Settings()) -> DataFrame:
    """Rows left and share removed after exact dedup, near dedup (where switched on) and
    the cut-offs, and rows that parse, as a run over ``raw`` counts them."""
    counts = stages.StageCounts()
    cleaned = stages.transform_rows(raw, "counted", language, settings, counts)
    cleaned.write.format("noop").mode("overwrite").save()
    return counts_table(raw.sparkSession, counts)


def counts_table(spark: SparkSession, counts: stages.StageCounts) -> DataFrame:
    """A run's counts with the share that each step removed."""
    seen = counts.get()
    table = spark.createDataFrame([tuple(seen.values())], ", ".join(f"{name} bigint" for name in seen))

    def removed(left: str, before: str) -> Column:
        return _ratio(F.col(before) - F.col(left), F.col(before))

    return table.withColumns(
        {
            "duplicate_rate": removed("unique_rows", "raw_rows"),
            "near_duplicate_rate": removed("near_rows", "unique_rows"),
            "filtered_rate": removed("kept_rows", "near_rows"),
        }
    )
