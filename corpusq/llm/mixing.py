"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, three passes long. A copy of a
document has a virtual finish time: the source's words up to and including it, divided by
the source's target. All queues are thus served together, each at the rate of its target,
and at virtual time 1 all targets are met. Copies are range-sorted by finish time and cut
at the total budget; a copy still in service then is taken up to the part served.

Running sums are formed in two levels, so that a source with a third of all rows is no
single task's work: sums per (source, slice of the shuffle key), then windows in a slice;
likewise for ranges of finish time. Only a row per source meets in one task.

Defined cases: a null text has no words. Null sources are one source, ordered last. Equal
shuffle keys are ordered by id, size and text hash; rows equal in all of these are alike.
Documents without words take nothing but come back. Without any words every target is 0.
Extra columns are ignored by ``mix`` and kept by ``take_copies``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusq.llm.common import words_of
from corpusq.session import written

WEIGHTS = (1, 2, 3)
PASSES = 3
# Hex digits of the shuffle key that name a slice, and ranges per unit of virtual time.
SLICE_DIGITS = 3
RANGES = 4096


def sizes(text: Column) -> Column:
    return F.size(words_of(text)).cast("bigint")


def targets(by_source: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(source, source_size) with each source's ``target``: its weight's share of all words,
    no more than ``passes`` times its size, what exceeds that reshared by weight.

    Sources whose cap binds are the first ones in the order of cap / weight; the level that
    the rest shares follows from running sums over that order. One row per source.
    """
    by_name = W.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*(F.lit(int(w)).cast("bigint") for w in weights))
    weighed = by_source.withColumn(
        "weight", F.get(cycle, ((F.row_number().over(by_name) - 1) % len(weights)).cast("int"))
    ).withColumn("cap", F.col("source_size") * passes)
    everything = W.partitionBy(F.lit(0))
    before = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(
        W.unboundedPreceding, -1)
    left = weighed.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("words_left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    # The first source that its share does not fill sets the level for itself and all after it.
    free = F.col("words_left") * F.col("weight") <= F.col("cap") * F.col("weight_left")
    level = left.withColumn("level", F.when(free, F.struct(
        F.col("cap") / F.col("weight"), F.col("source").isNull(), "source",
        F.col("words_left").alias("l"), F.col("weight_left").alias("w"))))
    first = F.min("level").over(everything)
    share = (F.col("weight") * first["l"]).cast("double") / first["w"]
    return level.select(
        "source", "source_size", F.least(share, F.col("cap").cast("double")).alias("target"),
        F.sum("source_size").over(everything).alias("budget"))


def _offsets(sums: DataFrame, keys: list[str], slice_key: str, value: str) -> DataFrame:
    before = W.partitionBy(*keys).orderBy(slice_key).rowsBetween(W.unboundedPreceding, -1)
    return sums.withColumn("before", F.coalesce(F.sum(value).over(before), F.lit(0))).drop(value)


def queued(df: DataFrame, narrow: DataFrame) -> DataFrame:
    """``df`` (made by ``keyed``; ``narrow`` is the same without payload) plus its place in its source's queue: ``slice``, ``place``,
    ``served`` (the source's words up to and with this row), ``source_size``, ``target`` and
    the mix's ``budget``."""
    slice_of = F.substr("key", F.lit(1), F.lit(SLICE_DIGITS))
    sums = narrow.groupBy("source", slice_of.alias("slice")).agg(F.sum("size").alias("words"))
    by_source = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")))
    offsets = _offsets(sums, ["source"], "slice", "words")
    known = offsets.join(by_source, offsets["source"].eqNullSafe(by_source["source"])).select(
        offsets["source"].alias("_source"), F.col("slice").alias("_slice"), "before", "source_size", "target", "budget")
    order = W.partitionBy("source", "slice").orderBy("key", "tie", "size", "hash")
    ranked = df.withColumn("slice", slice_of).select(
        "*", F.row_number().over(order).alias("place"),
        F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)).alias("_sum"))
    return ranked.join(
        known, ranked["source"].eqNullSafe(known["_source"]) & (ranked["slice"] == known["_slice"])
    ).withColumn("served", F.col("before") + F.col("_sum")).drop("_source", "_slice", "_sum", "before")


def keyed(df: DataFrame, *keep: Column, seed: str = "mix") -> DataFrame:
    """(tie = doc_id, source, size, key, hash) and ``keep`` of each row, ready to queue."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return df.select(
        F.col("doc_id").alias("tie"), F.col("source").alias("source"), sizes(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit(seed), ident).cast("binary")).alias("key"), F.xxhash64("text").alias("hash"), *keep)


def _start(number: Column) -> Column:
    """Words of the source that come before a row's copy of pass ``number``."""
    return number * F.col("source_size") + F.col("served") - F.col("size")


def _served_at_end(number: Column) -> Column:
    """How many words of a row's copy of pass ``number`` are served by virtual time 1."""
    return F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - _start(number)))


def _copies(queue: DataFrame, passes: int = PASSES) -> DataFrame:
    """One row per copy with ``words`` to take and virtual ``finish``; pass 0 stays without any."""
    finish = F.try_divide((_start(F.col("pass")) + F.col("size")).cast("double"), F.col("target"))
    return (
        queue.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
        .withColumn("words", _served_at_end(F.col("pass")))
        .filter((F.col("pass") == 0) | (F.col("words") > 0))
        .withColumn("finish", F.coalesce(finish, F.lit(0.0)))
    )


def mix(df: DataFrame) -> DataFrame:
    """The mix as a sequence of copies: (tie, source, slice, place, size, source_size, target,
    pass, words, finish, position), where ``position`` counts the words taken before a copy
    in the order of finish times, and ``words`` ends at the total budget."""
    narrow = written(keyed(df), "mix-queue")
    # Copies that take something go to the range of their finish time, those in service at
    # the end to the last one; rows that take nothing are dealt over ranges of their own.
    of_time = F.least(F.floor(F.col("finish") * RANGES), F.lit(RANGES))
    copies = _copies(queued(narrow, narrow)).withColumn(
        "range", F.when(F.col("words") > 0, of_time).otherwise(-1 - F.pmod(F.hash("key"), F.lit(RANGES))))
    copies = written(copies.drop("hash", "key"), "mix-copies")
    sums = copies.groupBy("range").agg(F.sum("words").alias("sum")).withColumn("all", F.lit(0))
    offsets = _offsets(sums, ["all"], "range", "sum").drop("all")
    order = W.partitionBy("range").orderBy("finish", "source", "slice", "place", "pass")
    ran = copies.withColumn("_sum", F.coalesce(F.sum("words").over(
        order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    position = F.col("before") + F.col("_sum")
    return ran.join(offsets, "range").withColumn("position", position).withColumn(
        "words", F.greatest(F.lit(0), F.least(F.col("words"), F.col("budget") - F.col("position")))
    ).drop("_sum", "before", "budget", "range")


def taken(df: DataFrame) -> DataFrame:
    """What the mix takes of each row: (doc_id, size, source_size, target, taken)."""
    return mix(df).groupBy("source", "slice", "place").agg(
        F.first("tie").alias("doc_id"), F.first("size").alias("size"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum("words").cast("bigint").alias("taken"),
    ).drop("slice", "place")


def take_copies(df: DataFrame) -> DataFrame:
    """``df`` with each row as often as the mix takes it whole, columns unchanged.

    A row's copies follow from its place in its queue alone, so the texts move once.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    queue = queued(keyed(df, row), written(keyed(df), "mix-queue"))
    whole = reduce(add, [(_served_at_end(F.lit(k)) == F.col("size")).cast("int") for k in range(PASSES)])
    times = F.when(F.col("size") > 0, whole).otherwise(1)
    return queue.withColumn("times", times).filter("times > 0").select(
        "row", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("row.*")
