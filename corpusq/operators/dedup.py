"""Exact and near-duplicate removal.

Every step is a grouping that combines map-side or an equi-join on a narrow key.
No step gathers a group: a text or bucket that a third of the corpus shares costs
one partial row per task in the groupings, and its members are joined without
being moved to one place (see ``attach``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusq.config import Settings
from corpusq.functions import minhash
from corpusq.functions import text as tx
from corpusq.session import Scratch, ship_package, written

# A bucket above this many members is joined by broadcast instead of by shuffle.
HOT_MEMBERS = 100_000
# Most hot buckets there can be; the floor rises with the input to keep it so.
MAX_HOT_BUCKETS = 50_000
# How near-duplicate removal orders rows: by a seeded hash of the id, or by the id itself.
ORDERS = ("hashed", "arrival")


def add_content_hash(df: DataFrame, content_col: str = "content") -> DataFrame:
    return df.withColumn("content_hash", tx.content_hash(F.col(content_col)))


def first_per(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each ``key`` in the order of the given columns.

    Filtering a row number to 1 makes Spark keep one row per key in every map task
    before the shuffle, so copies of a text are dropped where they are read.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def deduplicate(df: DataFrame, content_col: str = "content", order_col: str = "id") -> DataFrame:
    """Keep the first row of every distinct stripped text."""
    return first_per(add_content_hash(df, content_col), "content_hash", order_col)


def minhash_bands(df: DataFrame, content_col: str = "content", id_col: str = "id",
                  settings: Settings = Settings()) -> DataFrame:
    """(id, band, key): the bucket of each row in every band."""
    # No row has an empty array. The outer form spares the not-empty filter that Spark
    # derives for the plain one and that would compute every signature twice.
    return add_bucket_keys(df, content_col, id_col, settings).select(
        id_col, F.posexplode_outer("_buckets").alias("band", "key")
    )


def add_bucket_keys(df: DataFrame, content_col: str, id_col: str, settings: Settings) -> DataFrame:
    """``_buckets``: one key per band; a row without text gets a bucket of its own."""
    ship_package(df.sparkSession)
    bands, rows = minhash.choose_bands(settings.minhash_threshold, settings.minhash_num_perm)
    sig = minhash.signature(F.col(content_col), bands * rows)
    lone = F.array(F.concat(F.lit("no text "), F.col(id_col).cast("string")))
    return (
        df.withColumn("_signature", sig)
        .withColumn("_buckets", F.when(F.col("_signature").isNull(), lone).otherwise(
            minhash.band_keys(F.col("_signature"), bands, rows)))
        .drop("_signature")
    )


def hot_floor(member_rows: int, hot_members: int = HOT_MEMBERS) -> int:
    """Size above which a bucket is hot. Fewer than MAX_HOT_BUCKETS can exceed it."""
    return max(hot_members, member_rows // MAX_HOT_BUCKETS)


def attach(members: DataFrame, buckets: DataFrame, floor: int) -> DataFrame:
    """Inner join of (bucket, id, ...) with one row (bucket, n, ...) per bucket.

    Buckets of more than ``floor`` members are few, by ``hot_floor`` fewer than
    MAX_HOT_BUCKETS, so they are broadcast and their members stay where they are.
    The rest holds no large group and is joined by shuffle.
    """
    hot = buckets.filter(F.col("n") > floor)
    cold = buckets.filter(F.col("n") <= floor)
    in_hot = members.join(F.broadcast(hot), "bucket")
    in_cold = members.join(F.broadcast(hot.select("bucket")), "bucket", "left_anti").join(cold, "bucket")
    return in_hot.unionByName(in_cold)


def _members(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("buckets").alias("bucket"), "id")


def _sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("first"))


def near_duplicate_lookup(df: DataFrame, content_col: str = "content", id_col: str = "id",
                          settings: Settings = Settings(), hot_members: int = HOT_MEMBERS) -> DataFrame:
    """For each row that shares a band with an earlier one: the earliest such row, and
    in how many bands some earlier row is met. One output row per input row at most."""
    rows = written(_bucket_rows(df, content_col, id_col, settings), "bands")
    members = _members(rows)
    floor = hot_floor(rows.count() * minhash.choose_bands(
        settings.minhash_threshold, settings.minhash_num_perm)[0], hot_members)
    met = attach(members, _sizes(members).filter(F.col("n") > 1), floor).filter(F.col("first") < F.col("id"))
    return met.groupBy("id").agg(
        F.min("first").alias("first_id"), F.count("*").alias("shared_bands")
    ).withColumnRenamed("id", id_col)


def _bucket_rows(df: DataFrame, content_col: str, id_col: str, settings: Settings) -> DataFrame:
    source = df.select(F.col(id_col).alias("id"), F.col(content_col).alias("content"))
    return add_bucket_keys(source, "content", "id", settings).select("id", F.col("_buckets").alias("buckets"))


def order_key(id_col: Column, order: str = "hashed", seed: int = 42) -> Column:
    """What near-duplicate removal takes as a row's place. Hashed places make the number of
    rounds logarithmic, whatever chains of versions the ids of a corpus follow."""
    if order not in ORDERS:
        raise ValueError(f"unknown order {order!r}, known are {ORDERS}")
    if order == "arrival":
        return id_col
    text = id_col.cast("string")
    return F.concat(F.md5(F.concat(F.lit(f"{seed}:"), text)), F.lit(":"), text)


def near_deduplicate(df: DataFrame, content_col: str = "content", id_col: str = "id",
                     settings: Settings = Settings(), order: str = "hashed") -> DataFrame:
    """Keep a row, in the given order, unless it shares a band with an earlier kept row.

    Ids must be unique and not null."""
    rows = _bucket_rows(df, content_col, id_col, settings)
    kept = keep_first(rows.withColumn("id", order_key(F.col("id"), order)))
    place = order_key(F.col(id_col), order)
    return df.withColumn("_place", place).join(kept.withColumnRenamed("id", "_place"), "_place", "left_semi").drop("_place")


def keep_first(rows: DataFrame, hot_members: int = HOT_MEMBERS) -> DataFrame:
    """Ids kept by the first-come rule over (id, buckets), in the order of ids; ids must be unique.

    The rule is sequential: a row is kept iff none of its buckets holds an earlier
    kept row. It is evaluated in rounds instead. A row that is first among the
    open rows of all its buckets is kept, since every earlier neighbour has been
    dropped; its neighbours are dropped; both leave. Each round settles at least
    the first open row of every connected group; with ids in hashed order the
    number of rounds grows with the logarithm of the rows. The rounds' tables are
    removed once the kept ids are written.
    """
    scratch = Scratch(rows.sparkSession, "near-rounds")
    # Rows in identical buckets share their fate with the first of them: whatever
    # keeps or drops it drops them. Copies thus vanish in one combining grouping.
    heads = scratch.written(rows.groupBy("buckets").agg(F.min("id").alias("id")))
    all_members = _members(heads)
    member_rows = heads.select(F.sum(F.size("buckets"))).first()[0] or 0
    floor = hot_floor(member_rows, hot_members)

    # Only rows that meet another row need deciding, and only in shared buckets.
    shared = scratch.written(_sizes(all_members).filter(F.col("n") > 1).drop("first"))
    open_rows = scratch.written(
        attach(all_members, shared, floor).groupBy("id").agg(F.collect_list("bucket").alias("buckets")))
    dropped: list[DataFrame] = []
    while open_rows.count() > 0:
        settled = scratch.written(_settle(open_rows, floor))
        dropped.append(settled.filter("status = 'dropped'").select("id"))
        open_rows = settled.filter("status = 'open'").select("id", "buckets")

    kept = heads.select("id")
    if dropped:
        kept = kept.join(reduce(DataFrame.unionByName, dropped), "id", "left_anti")
    kept = written(kept, "kept")
    scratch.remove()
    return kept


def _settle(open_rows: DataFrame, floor: int) -> DataFrame:
    """One round: (id, buckets, status) with status kept, dropped or open."""
    members = _members(open_rows)
    sizes = _sizes(members)
    leads = sizes.groupBy(F.col("first").alias("id")).agg(F.count("*").alias("led"))
    kept = (
        open_rows.join(leads, "id")
        .filter(F.col("led") == F.size("buckets"))
        .select("id", F.lit(True).alias("is_kept"))
    )
    closed = sizes.join(kept.select(F.col("id").alias("first")), "first")
    beaten = (
        attach(members, closed, floor)
        .filter(F.col("id") != F.col("first"))
        .groupBy("id").agg(F.lit(True).alias("is_beaten"))
    )
    return open_rows.join(kept, "id", "left").join(beaten, "id", "left").select(
        "id", "buckets",
        F.when(F.col("is_kept"), "kept").when(F.col("is_beaten"), "dropped").otherwise("open").alias("status"),
    )
