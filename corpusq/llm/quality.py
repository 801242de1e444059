"""Quality rules: a table of thresholds compiled into one native projection.

Measures of a text (all whole numbers) feed rules of the form
``low * denominator <= 100 * numerator <= high * denominator``; a rule may apply to texts
of some length only. No user function runs, no row moves, and every row comes back.

Defined cases: a null or empty text has no words and fails the base rule. Rows repeat as
they come, ids are never looked at. Columns of the input that bear the name of a measure
are replaced; all others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import let, words_of

WINDOW = 5
SYMBOLS = "#*$%&|<>"
# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au aux avec dans de des du en est et la le les par pas pour que qui sur un une "
    "als auf das dem den der des die ein eine für ich ist mit nicht sich sie und von zu "
    "al como con de del el en es la las lo los no para por que se su un una y"
)


@dataclass(frozen=True)
class Rule:
    """Percent bounds on numerator / denominator for texts of at least ``min_words`` words."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None
    min_words: int = 0


# The threshold table; a bound is a percentage, so 300 means three characters a word.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=200, high=1200),
    Rule("symbols", "n_symbols", "n_words", high=20),
    Rule("capitals", "n_capitals", "word_chars", high=40),
    Rule("letters", "n_letters", "word_chars", low=50),
    Rule("stop_words", "n_stop_words", "n_words", low=1, min_words=100),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=60),
)


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))) > 0)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in the text.

    Windows are compared by 64-bit hash. Sorting (hash, place) pairs finds equal ones in
    n log n steps; texts whose hashes all differ skip the sort.
    """
    hashes = F.when(
        F.size(words) >= window,
        F.slice(
            F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, window)))),
            F.lit(1), F.size(words) - (window - 1)),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, k: F.least(
            F.lit(window), F.coalesce(F.get(places, k + 1) - p, F.lit(window))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def by_sorting(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = let(ordered, lambda s: F.filter(s, lambda x, k: F.coalesce(
            (F.get(s, k - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(
            (F.get(s, k + 1)["h"] == x["h"]), F.lit(False))))
        return let(F.array_sort(F.transform(repeated, lambda x: x["i"])), covered)

    return let(hashes, lambda found: F.when(
        F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(by_sorting(found)))


def _measures(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    letters = F.split(F.lower(text), r"[^\p{L}]+")
    count = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    return {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": count(rf"[^{SYMBOLS}]+"),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(words),
        "n_capitals": count(r"[^\p{Lu}]+"),
        "n_letters": F.length(text) - count(r"\p{L}+"),
        "n_stop_words": F.size(F.filter(letters, lambda w: w.isin(sorted(set(STOP_WORDS.split()))))),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda s: F.rtrim(s).endswith("...") | F.rtrim(s).endswith("…"))),
    }


def _passes(rule: Rule, m: Column) -> Column:
    part, whole = m[rule.numerator] * 100, m[rule.denominator]
    tests = []
    if rule.low is not None:
        tests.append(part >= whole * rule.low)
    if rule.high is not None:
        tests.append(part <= whole * rule.high)
    held = reduce(and_, tests)
    return held if not rule.min_words else held | (m["n_words"] < rule.min_words)


def apply_rules(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``df`` with its measures, ``base_failed``, ``failed_rules`` (names) and ``kept``."""
    measured = let(F.coalesce(F.col(text), F.lit("")), lambda t: let(
        F.struct(words_of(t).alias("w"), _lines(t).alias("l")),
        lambda x: F.struct(*(c.cast("bigint").alias(k) for k, c in _measures(t, x["w"], x["l"]).items())),
    ))

    def judged(m: Column) -> Column:
        base = (m["n_words"] < 10) | (m["n_repeat_words"] * 100 > m["n_words"] * 20)
        failed = F.filter(F.array(*(F.when(~_passes(r, m), F.lit(r.name)) for r in rules)), lambda x: x.isNotNull())
        return F.struct(m.alias("m"), base.alias("base_failed"), failed.alias("failed_rules"))

    held = "__quality"
    out = df.withColumn(held, let(measured, judged))
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals",
             "n_letters", "n_stop_words", "n_ellipsis_lines"]
    made = [F.col(f"{held}.m.{n}").alias(n) for n in names] + [
        F.col(f"{held}.base_failed").alias("base_failed"),
        F.col(f"{held}.failed_rules").alias("failed_rules"),
        (~F.col(f"{held}.base_failed") & (F.size(F.col(f"{held}.failed_rules")) == 0)).alias("kept"),
    ]
    taken = {*names, "base_failed", "failed_rules", "kept", held}
    return out.select(*(F.col(f"`{c}`") for c in df.columns if c not in taken), *made)


def keep_good(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that are kept, columns unchanged whatever their names."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    return apply_rules(df.select(row, "text"), rules).filter("kept").select("row.*")
