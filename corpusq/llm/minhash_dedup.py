"""MinHash near-dedup with tensored banding, verified on full shingle sets.

Classic banding needs bands x rows minhashes per set. Tensored banding computes two small
collections of minhashes instead; each collection is cut into ``BANDS`` half-keys of ``ROWS``
minhashes, and every pair (half-key i of the first, half-key j of the second) forms the key
of table (i, j). That gives BANDS^2 tables of 2 x ROWS minhashes from 2 x BANDS x ROWS
minhashes: roughly the square root of what independent tables would cost. Two sets meet in
some table exactly when they agree on some half-key of each collection, so with similarity
J the chance is (1 - (1 - J^ROWS)^BANDS)^2: 0.9987 at J = 0.85, 0.99996 at J = 0.9 for the
defaults.

Candidates are verified, never trusted: nodes that meet in a bucket and whose sizes allow a
link belong to one cluster, and every pair of a cluster's nodes is compared on the full sets
(100 |A and B| >= percent |A or B|) by the blocked products of ``jaccard``; no pair is waived
because one of the two has linked with a third. Links found form components by alternating
stars.

The first pass over the texts (numpy on Arrow batches) leaves a set's size, a 128-bit digest
and its 2 x BANDS half-keys; Spark forms the BANDS^2 keys of each class from them. Buckets
are narrow (key, size, node) rows, of which neighbours by size become edges: a bucket costs
one edge per member, never its pairs. Full sets are read again for clustered classes only.

Sets are the distinct ``words``-word shingles of a text, A-Z lower-cased, words being runs of
anything but ASCII white space, each shingle as a 63-bit hash; a text with fewer words has its
whole sequence as one shingle. Equal sets are one class, identified by the digest of the
sorted set and compared once; its node is the least 64-bit hash of a row's id and text.

Defined cases: null and empty texts (no words) have no shingles, link with nothing and are
components of their own (component_id = doc_id). Repeated rows and exact copies share a
class and a component. A row without an id takes the least id reachable, null if none is;
``kept`` is ``doc_id = component_id``, false where either is null, so repeated rows of the
least id are all kept. An empty table gives no rows. Columns other than doc_id and text are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusq.llm.batches import map_slices
from corpusq.llm.common import let
from corpusq.llm.graph import components
from corpusq.llm.jaccard import verified_components
from corpusq.llm.shingles import ShingleSets, mixed
from corpusq.session import Scratch, written

WORDS, PERCENT = 5, 85
ROWS, BANDS = 4, 10
SEEDS = 2 * BANDS * ROWS
AT_ONCE = 1 << 16  # shingles minhashed at once, so that they stay in the cache
GOLDEN = 0x9E3779B97F4A7C15  # fixed value: 2^64 over the golden ratio, odd


def minhashes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """SEEDS minhashes of each set ``hashes[bounds[i]:bounds[i + 1]]``; no set may be empty."""
    k = np.arange(1, SEEDS + 1, dtype=np.uint64)
    factor, offset = mixed(k * np.uint64(GOLDEN)) | np.uint64(1), mixed(k * np.uint64(GOLDEN) + np.uint64(1))
    out = np.empty((len(bounds) - 1, SEEDS), np.uint64)
    row = 0
    while row < len(out):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + AT_ONCE, "right")) - 1)
        x = hashes[bounds[row]:bounds[end]].astype(np.uint64)
        starts = bounds[row:end] - bounds[row]
        for seed in range(SEEDS):
            out[row:end, seed] = np.minimum.reduceat((x ^ offset[seed]) * factor[seed], starts)
        row = end
    return out


def half_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """2 x BANDS half-keys of each set: hashes of ROWS minhashes each."""
    of_half = minhashes(hashes, bounds).reshape(-1, 2 * BANDS, ROWS)
    place = np.arange(1, ROWS + 1, dtype=np.uint64) * np.uint64(GOLDEN)
    return mixed(mixed(of_half + place).sum(axis=2, dtype=np.uint64)).view(np.int64)


def table_keys(half: Column) -> Column:
    """BANDS^2 bucket keys: each a hash of one half-key of each collection and the table's place."""
    def of_halves(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(BANDS * BANDS - 1)), lambda t: F.xxhash64(
            F.get(h, F.floor(t / BANDS).cast("int")), F.get(h, BANDS + t % BANDS), t))

    return let(half, of_halves)


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, key, n, digest, halves) of every row; digest and halves null without a word."""
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = ShingleSets(batch.column("text"), words)
            n = sets.sizes
            full = np.flatnonzero(n)
            halves = half_keys(sets.hashes, np.concatenate([sets.bounds[full], sets.bounds[-1:]])) if len(full) else np.zeros((0, 0))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(halves.reshape(-1).astype(np.int64)), 2 * BANDS)
            at = np.zeros(len(n), np.int64)
            at[full] = np.arange(len(full))
            return pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("key"), pa.array(n),
                pa.array([xxhash.xxh3_128_digest(sets.of(i).tobytes()) if n[i] else None for i in range(len(n))], pa.binary()),
                lists.cast(pa.list_(pa.int64())).take(pa.array(at, mask=n == 0))],
                names=["doc_id", "key", "n", "digest", "halves"])

        return step

    kind = dict(docs.dtypes)["doc_id"]
    return map_slices(docs, make, f"doc_id {kind}, key long, n long, digest binary, halves array<long>")


def _meetings(classes: DataFrame, percent: int) -> DataFrame:
    """Edges (u, v) that tie the members of each bucket, neighbours by size.

    Between two neighbours whose sizes forbid a link the bucket falls apart: whoever is on
    one side has a size that forbids a link with anyone on the other."""
    entries = classes.select("node", "n", F.explode(table_keys(F.col("halves"))).alias("key"))
    by_size = Window.partitionBy("key").orderBy("n", "node")
    tied = entries.select(F.col("node").alias("u"), "n", F.lag("node").over(by_size).alias("v"), F.lag("n").over(by_size).alias("n_v"))
    return tied.filter(F.col("v").isNotNull() & (100 * F.col("n_v") >= percent * F.col("n"))).select("u", "v")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "minhash-dedup")
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    rows = scratch.written(_sketches(keyed, words))
    classes = scratch.written(rows.filter("n > 0").groupBy("digest").agg(
        F.min("key").alias("node"), F.first("n").alias("n"), F.first("halves").alias("halves"), F.min("doc_id").alias("least")))
    clusters = components(_meetings(classes, percent), "minhash-clusters").select("node", F.col("component").alias("cluster"))
    found = verified_components(keyed.select(F.col("key").alias("doc_id"), "text"), clusters, words, percent, id_is_text=True)
    # The least id of each component, and so each class's component_id.
    placed = scratch.written(classes.select("digest", "node", "least").join(found, "node", "left").select(
        "digest", "least", F.coalesce("component", "node").alias("component")))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "component").select("digest", "component_id")
    out = rows.select("doc_id", "n", "digest").join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    out = written(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))),
                  "minhash-dedup-result")
    scratch.remove()
    return out
