"""Quality scores as column expressions.

Rule scores are counted in whole hundredths and divided once at the end; the
composite is computed in DECIMAL and rounded half-up. Equal inputs therefore give
equal bits on every engine, also on rounding ties.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusq.config import Settings


def _points_to_score(points: Column) -> Column:
    return F.greatest(F.least(points, F.lit(100)), F.lit(0)) / F.lit(100)


def syntactic(is_parseable: Column, num_lines: Column, avg_line_length: Column,
              alphanum_fraction: Column, num_functions: Column, num_classes: Column) -> Column:
    """0 if unparseable, else 1 less penalties for short, wide or symbol-heavy text."""
    # Points and limits of the score.
    points = (
        F.lit(100)
        - F.when(num_lines < 10, 15).otherwise(0)
        - F.when(avg_line_length > 120, 10).when(avg_line_length > 80, 5).otherwise(0)
        - F.when(alphanum_fraction < 0.35, 20).otherwise(0)
        + F.when((num_functions > 0) | (num_classes > 0), 5).otherwise(0)
    )
    return F.when(is_parseable, _points_to_score(points)).otherwise(F.lit(0.0))


def documentation(has_docstring: Column, comment_ratio: Column, num_functions: Column) -> Column:
    """Credit for a module docstring and for comment lines, a fine for many bare functions."""
    # Points and limits of the score.
    bare = (num_functions >= 3) & ~F.coalesce(has_docstring, F.lit(False))
    points = (
        F.when(has_docstring, 50).otherwise(0)
        + F.when(comment_ratio >= 0.10, 30).when(comment_ratio >= 0.05, 15).otherwise(0)
        - F.when(bare, 10).otherwise(0)
    )
    return _points_to_score(points)


def composite(syntactic_score: Column, doc_score: Column, security_score: Column,
              llm_score: Column, settings: Settings) -> Column:
    """Weighted mean to 4 places; without a judgement its weight goes to the other scores."""
    parts = {"syntactic": syntactic_score, "documentation": doc_score, "security": security_score}

    def weighted(weights: dict[str, Decimal]) -> Column:
        terms = [_exact(col) * _weight(weights[name]) for name, col in parts.items()]
        return terms[0] + terms[1] + terms[2]

    judged = weighted(settings.weights) + (_exact(llm_score) - F.lit(Decimal(1))) * _weight(
        settings.weights["llm"] / 4
    )
    alone = weighted(settings.weights_without_judge())
    return F.round(F.when(llm_score.isNull(), alone).otherwise(judged), 4).cast("double")


def _exact(score: Column) -> Column:
    return score.cast("decimal(12,8)")


def _weight(w: Decimal) -> Column:
    return F.lit(w).cast("decimal(9,8)")
