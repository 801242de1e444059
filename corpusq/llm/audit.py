"""Filter interaction audit: which filter removes what, in every order, and its Shapley share.

Five filters fail documents; what matters is how they overlap. All of it follows from one
table per part: v(S), the number of documents that fail at least one filter of a coalition S,
for all 32 coalitions (and the same for documents labelled good and labelled toxic).

* Step counts are coalition differences. In an order, the step of filter f after the earlier
  filters P removes v(P + f) - v(P), keeps total - v(P + f); f's redundant failures are
  v(P) + v(f) - v(P + f); its unique failures v(all) - v(all - f).
* Shapley values come from the exact constrained least-squares problem of kernel SHAP:
  over all 30 proper coalitions, weights (M - 1) / (C(M, |S|) |S| (M - |S|)), subject to the
  efficiency constraint sum(phi) = v(all). The normal equations with one Lagrange multiplier
  are solved in rationals, so the solution is the Shapley value itself; ``shapley`` reports it
  times 120, the filter's removals summed over all orders, a whole number.

Spark does the work that grows with the corpus: per document, five flags; for E (text equal to
that of a smaller doc_id anywhere in the table) a grouping by a 256-bit digest of the text, whose
partial aggregation keeps one large group of copies from meeting in one task. Documents are then
folded into at most 32 x 4 counts per part, and each part's 32-row table is solved in one small
Pandas task. Nothing is collected to the driver.

Defined cases: a null text is empty (no words: fails A, passes B, C and D). A null doc_id is
never smaller nor larger than another id: it neither fails E nor makes another row fail it; repeated rows (same id, same text) do not fail E by each other. Labels are taken
per doc_id as the largest value given (several rows for one id do not multiply documents); a
document without labels, or with a null label, counts as 0. A null lang is the part ''. An
empty table gives no rows. Columns other than doc_id, text, lang and the labels' are ignored.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations, permutations
from math import comb

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusq.llm.common import words_of

# The filters, in the order of their bits.
FILTERS = "ABCDE"
MIN_WORDS = 100
DISTINCT_PERCENT = 80
CAPITALS_PERCENT = 10
SYMBOLS = "[#$%&*|]"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
FULL = (1 << len(FILTERS)) - 1

RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def _flags(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, fails): ``fails`` has bit i set where filter FILTERS[i] fails, E aside."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = words_of(text)
    n = F.size(words)
    a = n < MIN_WORDS
    b = 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * n
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    c = 100 * capitals > CAPITALS_PERCENT * F.length(text)
    d = text.rlike(SYMBOLS)
    bits = sum(F.when(flag, 1 << i).otherwise(0) for i, flag in enumerate((a, b, c, d)))
    return docs.select(
        "doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.sha2(text, 256).alias("digest"), bits.alias("fails"))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents by part and full failure pattern (all five bits)."""
    flags = _flags(docs)
    # Rows with the same id, text and part are one entry with a count: repeated rows go in once.
    rows = flags.groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n"))
    marks = labels.groupBy("doc_id").agg(
        F.max(F.coalesce("quality", F.lit(0))).alias("good"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    rows = rows.join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    # E: ids above the least id of the same text fail. Grouped first by everything that decides
    # the outcome, so a group of copies is a few rows per digest before any window sees it.
    grouped = rows.groupBy("digest", "part", "fails", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    least = F.min("least.doc_id").over(Window.partitionBy("digest"))
    passing = F.col("n_null") + F.when(F.col("least.doc_id") == least, F.col("least.n")).otherwise(0)
    split = grouped.select(
        "part", "fails", "good", "toxic", passing.alias("pass_e"), (F.col("n") - passing).alias("fail_e"))
    parts = split.select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("fails").alias("fails"), F.col("pass_e").alias("n")),
            F.struct((F.col("fails") + (1 << 4)).alias("fails"), F.col("fail_e").alias("n")))).alias("x"))
    return parts.groupBy("part", F.col("x.fails").alias("fails")).agg(
        F.sum("x.n").cast("long").alias("n"),
        F.sum(F.when(F.col("good") == 1, F.col("x.n")).otherwise(0)).cast("long").alias("good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("x.n")).otherwise(0)).cast("long").alias("toxic"))


def coalition_values(counts: dict[int, int]) -> list[int]:
    """v(S) for S in 0..31: documents failing any filter of S, from counts per failure pattern."""
    return [sum(n for fails, n in counts.items() if fails & s) for s in range(FULL + 1)]


def _solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Gaussian elimination in rationals; the matrix is square and regular."""
    size = len(right)
    rows = [row[:] + [r] for row, r in zip(matrix, right)]
    for col in range(size):
        pivot = next(r for r in range(col, size) if rows[r][col] != 0)
        rows[col], rows[pivot] = rows[pivot], rows[col]
        for r in range(size):
            if r != col and rows[r][col] != 0:
                factor = rows[r][col] / rows[col][col]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[col])]
    return [rows[i][size] / rows[i][i] for i in range(size)]


def shapley(values: list[int], players: int = len(FILTERS)) -> list[Fraction]:
    """Shapley values of the game v by kernel-weighted least squares under efficiency, exactly.

    Minimise sum over proper, non-empty S of w(S) (v(S) - sum_{i in S} phi_i)^2 subject to
    sum(phi) = v(all) (v(empty) is 0). Setting the gradient of the Lagrangian to zero gives
    players + 1 linear equations, solved in rationals.
    """
    m = players
    gram = [[Fraction(0)] * m for _ in range(m)]
    moment = [Fraction(0)] * m
    for size in range(1, m):
        weight = Fraction(m - 1, comb(m, size) * size * (m - size))
        for members in combinations(range(m), size):
            s = sum(1 << i for i in members)
            for i in members:
                moment[i] += weight * values[s]
                for j in members:
                    gram[i][j] += weight
    matrix = [gram[i] + [Fraction(1)] for i in range(m)] + [[Fraction(1)] * m + [Fraction(0)]]
    right = moment + [Fraction(values[(1 << m) - 1])]
    return _solve(matrix, right)[:m]


def audit_part(rows: pd.DataFrame) -> pd.DataFrame:
    """All 600 rows (order, step) of one part, from its counts per failure pattern."""
    part = rows["part"].iloc[0]
    tables = {k: coalition_values(dict(zip(rows["fails"].tolist(), rows[k].tolist())))
              for k in ("n", "good", "toxic")}
    v, good, toxic = tables["n"], tables["good"], tables["toxic"]
    total = v[FULL] + int(rows.loc[rows["fails"] == 0, "n"].sum())
    phi = shapley(v)
    orders_total = len(ORDERS)
    times = [phi_i * orders_total for phi_i in phi]
    assert all(t.denominator == 1 for t in times), "Shapley value times 120 is a whole number"
    out = []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, start=1):
            bit = 1 << FILTERS.index(letter)
            after = before | bit
            out.append((part, order, step, total - v[after], v[after] - v[before],
                        v[before] + v[bit] - v[after], v[FULL] - v[FULL & ~bit],
                        good[after] - good[before], toxic[after] - toxic[before],
                        int(times[FILTERS.index(letter)])))
            before = after
    return pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step; see the module's text for columns."""
    return failure_counts(docs, labels).groupBy("part").applyInPandas(audit_part, RESULT)
