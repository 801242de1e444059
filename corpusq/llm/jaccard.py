"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Rows of the matrix are classes of documents with equal shingle sets. The product is formed
only where its entries can reach the size-derived bound, block by block:

* Rarest-first columns come first. Two rows that reach the bound share at least ``SHARED``
  of the first (size - needed overlap + SHARED) columns of either, whatever the order; the
  order itself (frequent shingles last, judged by counts of words, of locally frequent
  shingles, and of a first round's columns) only keeps this first product sparse. Its overlap counts are accumulated by
  column; pairs below the bound, or of incompatible sizes, are discarded.
* A column of more than ``SHORT_COLUMN`` rows forms no pairs: its rows are only noted to
  belong together.
* What survives falls into clusters. A cluster's rows are sorted by size and cut into row
  blocks; each pair of blocks whose sizes are compatible is multiplied column block by
  column block, with overlap counts accumulating and the product ended once no pair can
  still reach its bound. Of the links found a block pair reports a spanning forest. Pairs are
  taken in rounds, neighbours first, each of which deals every row a bounded number of times;
  a pair whose rows are connected by then is left out.

No link between different texts is lost, and no step forms all pairs of a group as rows.
Components of the links follow by alternating stars.

Defined cases: null and empty texts have no shingles, link with nothing and are components
of their own. Copies and repeated rows share a class. Rows without an id take their class's
component, null if no row of it has an id. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.llm.batches import map_slices, sliced
from corpusq.llm.graph import components
from corpusq.llm.shingles import ShingleSets
from corpusq.session import Scratch, written

SHARED = 3
SHORT_COLUMN = 32
ROW_BLOCK = 512
COLUMN_BLOCK = 4096
# What the column order is judged by, at most: locally frequent shingles and words.
LOCAL_COUNT = 8
FREQUENT_SHINGLES, FREQUENT_WORDS = 1 << 17, 1 << 16
# Shingles or words a task counts at a time while it looks for frequent ones.
HELD = 1 << 18
NEEDED_BITS = 1 << 24
# How often, on average, a row with its set may be dealt to pairs of blocks in one round.
DEALT = 1.5


def needed_overlap(a, b, percent: int):
    """The least overlap with which sets of sizes ``a`` and ``b`` link: 100 i >= percent (a + b - i)."""
    return -(-(percent * (a + b)) // (100 + percent))


# ---- column order ---------------------------------------------------------------------

class Order:
    """How late a shingle comes among the columns: weights of shingles known to be frequent
    (sorted, with counts), and of words. Both lists are bounded; any lists give the same links."""

    def __init__(self, counts: list[tuple[int, int]], terms: dict[str, int]):
        self.counts, self.terms = dict(counts), terms
        self.shingles = np.array(sorted(self.counts), np.int64)
        self.weights = np.array([int(self.counts[s]).bit_length() for s in self.shingles.tolist()], np.int64)

    def with_counts(self, more: list[tuple[int, int]]) -> Order:
        return Order([*self.counts.items(), *more], self.terms)

    def places(self, sets: ShingleSets) -> np.ndarray:
        by_words = sets.word_sums(self.terms)
        if not len(self.shingles):
            return by_words
        at = np.minimum(np.searchsorted(self.shingles, sets.hashes), len(self.shingles) - 1)
        return by_words + (np.where(self.shingles[at] == sets.hashes, self.weights[at], 0) << 32)


def _frequent(docs: DataFrame, words: int) -> Order:
    """The order by words and shingles that are frequent within some task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, terms = [], {}
        for batch in batches:
            for part in sliced(batch) if batch.num_rows else ():
                sets = ShingleSets(part.column("text"), words)
                shingles.append(np.unique(sets.hashes, return_counts=True))
                each = np.bincount(sets.codes, minlength=len(sets.vocabulary))
                often = np.flatnonzero(each >= LOCAL_COUNT)
                for term, k in zip(sets.vocabulary.take(pa.array(often)).to_pylist(), each[often].tolist()):
                    terms[term] = terms.get(term, 0) + k
                if len(terms) > 2 * HELD:
                    terms = dict(sorted(terms.items(), key=lambda item: -item[1])[:HELD])
                if sum(len(seen) for seen, _ in shingles) > 4 * HELD:
                    shingles = [_most(*_merged(shingles))]
        seen, n = _merged(shingles)
        often = n >= LOCAL_COUNT
        pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_arrays([
            pa.array([None] * int(often.sum()) + list(terms), pa.string()),
            pa.array(seen[often].tolist() + [None] * len(terms), pa.int64()),
            pa.array(n[often].tolist() + list(terms.values()), pa.int64())], names=["word", "shingle", "n"])

    sums = docs.select("text").mapInArrow(count, "word string, shingle long, n long").groupBy("word", "shingle").agg(
        F.sum("n").alias("n"))
    top = lambda column, limit: sums.filter(F.col(column).isNotNull()).orderBy(F.desc("n"), column).limit(limit)
    sums = written(sums, "frequent")
    counts = [(r[0], r[1]) for r in top("shingle", FREQUENT_SHINGLES).select("shingle", "n").collect()]
    return Order(counts, {r[0]: int(r[1]).bit_length() for r in top("word", FREQUENT_WORDS).select("word", "n").collect()})


def _refined(docs: DataFrame, words: int, percent: int, order: Order) -> Order:
    """``order`` with what it leaves too long among the first columns moved to the end.

    A passage that some dozens of texts share is frequent in no single task, yet would tie
    all of them together; counting the first columns themselves shows it."""
    first = _first_columns(docs, words, percent, order).select(F.explode("first").alias("column"))
    long = written(first.groupBy("column").agg(F.count("*").alias("rows")).filter(F.col("rows") > SHORT_COLUMN // 2), "long-columns")
    return order.with_counts([(r[0], r[1]) for r in long.orderBy(F.desc("rows"), "column").limit(FREQUENT_SHINGLES).collect()])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return seen, np.bincount(inverse, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def _most(seen: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The HELD shingles with the highest counts, of those seen twice or more: a task's counts
    have a fixed bound, and what they miss changes the columns' order, never the links."""
    at = np.flatnonzero(n > 1)
    if len(at) > HELD:
        at = np.sort(at[np.argpartition(n[at], len(at) - HELD)[len(at) - HELD:]])
    return seen[at], n[at]


# ---- first columns --------------------------------------------------------------------

def _first_columns(docs: DataFrame, words: int, percent: int, order: Order) -> DataFrame:
    """(doc_id, n, digest, first): each text's set size, a digest of the set, and its first columns."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def make():
        columns = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = ShingleSets(batch.column("text"), words)
            n = sets.sizes
            rows = np.repeat(np.arange(len(n)), n)
            by_order = np.lexsort((sets.hashes, columns.places(sets), rows))
            place = np.arange(len(by_order)) - sets.bounds[rows]
            # A set at its size's bound overlaps a partner in at least this many shingles.
            least = -(-n * percent // 100)
            length = np.minimum(n, n - least + SHARED)
            taken = by_order[place < length[rows]]
            digests = [xxhash.xxh3_128_digest(sets.of(i).tobytes()) if n[i] else None for i in range(len(n))]
            offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            return pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n), pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(sets.hashes[taken]))],
                names=["doc_id", "n", "digest", "first"])

        return step

    return map_slices(docs.select("doc_id", "text"), make, "doc_id long, n long, digest binary, first array<long>")


def _candidates(classes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Edges (u, v) between classes that may link, directly or as rows of one long column.
    They read a table of ``scratch``."""
    entries = classes.select("node", "n", F.explode("first").alias("column"))
    columns = entries.groupBy("column").agg(F.count("*").alias("rows"), F.min("node").alias("least")).filter("rows > 1")
    shared = scratch.written(entries.join(columns, "column"))
    long = shared.filter(F.col("rows") > SHORT_COLUMN)
    in_long = long.groupBy("node").agg(F.count("*").alias("long"))
    side = lambda x: shared.filter(F.col("rows") <= SHORT_COLUMN).select(
        "column", F.col("node").alias(f"node_{x}"), F.col("n").alias(f"n_{x}"))
    sizes_fit = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    overlaps = (
        side("a").join(side("b"), "column").filter((F.col("node_a") < F.col("node_b")) & sizes_fit)
        .groupBy("node_a", "node_b", "n_a", "n_b").agg(F.count("*").alias("overlap"))
    )
    # Long columns are not multiplied: each that both rows have may have counted.
    rows_in_long = lambda x: in_long.select(F.col("node").alias(f"node_{x}"), F.col("long").alias(f"long_{x}"))
    bound = F.least(F.lit(SHARED), F.ceil(percent * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent)))
    uncounted = F.least(F.coalesce("long_a", F.lit(0)), F.coalesce("long_b", F.lit(0)))
    close = overlaps.join(rows_in_long("a"), "node_a", "left").join(rows_in_long("b"), "node_b", "left").filter(
        F.col("overlap") + uncounted >= bound)
    return close.select(F.col("node_a").alias("u"), F.col("node_b").alias("v")).union(
        long.select(F.col("node").alias("u"), F.col("least").alias("v")))


# ---- row blocks -----------------------------------------------------------------------

def _needed_filter(nodes: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over node ids: only texts that may be needed are read into sets."""
    bits = nodes.select(F.explode(F.array(*(
        F.pmod(F.xxhash64("node", F.lit(k)), F.lit(NEEDED_BITS)) for k in range(2)))).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 5).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit & 31 as int)))").alias("set"))
    table = np.zeros(NEEDED_BITS // 32, np.uint32)
    for word, held in words.collect():  # at most NEEDED_BITS / 32 rows, whatever the corpus
        table[word] = held
    return table


def _sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, cluster, n, hashes) of the clustered classes, read from the text of the row that names each."""
    held = docs.sparkSession.sparkContext.broadcast(_needed_filter(nodes))
    probes = docs.select("doc_id", "text", *(
        F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(k)), F.lit(NEEDED_BITS)).alias(f"bit{k}") for k in range(2)))

    def make():
        table = held.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            hit = np.ones(batch.num_rows, bool)
            for k in range(2):
                bit = batch.column(f"bit{k}").to_numpy(zero_copy_only=False)
                hit &= (table[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1
            rows = batch.select(["doc_id", "text"]).take(pa.array(np.flatnonzero(hit)))
            sets = ShingleSets(rows.column("text"), words)
            return pa.RecordBatch.from_arrays([
                rows.column("doc_id"), pa.array(sets.sizes),
                pa.ListArray.from_arrays(pa.array(sets.bounds.astype(np.int32)), pa.array(sets.hashes))],
                names=["node", "n", "hashes"])

        return step

    made = map_slices(probes.filter("doc_id is not null"), make, "node long, n long, hashes array<long>")
    return made.filter("n > 0").join(nodes, "node")


def _blocked(sets: DataFrame) -> DataFrame:
    """``sets`` with the row block of each: (cluster, block, node, n, hashes).

    Blocks are ranges of sizes, found by counting rows by (cluster, size): no cluster has to
    be sorted in one task, and only the counts of its sizes meet. A size with more rows than
    a block holds is split by hash.
    """
    from pyspark.sql import Window as W

    counts = sets.groupBy("cluster", "n").agg(F.count("*").alias("rows"))
    before = W.partitionBy("cluster").orderBy("n").rowsBetween(W.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    spread = F.floor(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) * F.col("rows") / (1 << 20))
    block = F.floor((F.col("before") + spread) / ROW_BLOCK).cast("int")
    return sets.join(placed, ["cluster", "n"]).select("cluster", block.alias("block"), "node", "n", "hashes")


def _block_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(cluster, i, j, dealt): pairs of blocks whose sizes allow a link, and the shingles that go there."""
    ranges = rows.groupBy("cluster", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.sum("n").alias("entries"))
    i, j = (ranges.select("cluster", F.col("block").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("low", "high", "entries")))
            for x in "ij")
    pairs = i.join(j, "cluster").filter((F.col("i") <= F.col("j")) & (100 * F.col("high_i") >= percent * F.col("low_j")))
    return pairs.select("cluster", "i", "j", F.when(F.col("i") == F.col("j"), F.col("entries_i")).otherwise(
        F.col("entries_i") + F.col("entries_j")).alias("dealt"))


def _deal(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows dealt to pairs of row blocks: (cluster, i, j, block, node, n, hashes)."""
    sides = pairs.select("cluster", "i", "j", F.explode(
        F.when(F.col("i") == F.col("j"), F.array("i")).otherwise(F.array("i", "j"))).alias("block"))
    return rows.join(sides, ["cluster", "block"])


def _rounds(pairs: DataFrame) -> list[tuple[int, int]]:
    """Ranges of block distances j - i that are dealt at once: a row goes to two pairs of each
    distance at most, and ranges grow while they deal no more than DEALT times all rows."""
    of = pairs.groupBy((F.col("j") - F.col("i")).alias("apart")).agg(F.sum("dealt").alias("dealt")).orderBy("apart").collect()
    rounds, room = [], 0
    for apart, dealt in of:
        if not rounds or dealt > room:
            rounds.append((apart, apart))
            room = DEALT * of[0][1]
        rounds[-1] = (rounds[-1][0], apart)
        room -= dealt
    return rounds


def _open_pairs(pairs: DataFrame, rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``pairs`` less those whose rows all are in one component already: they add no link that matters."""
    of_block = rows.select("cluster", "block", "node").join(linked, "node", "left").groupBy("cluster", "block").agg(
        F.when(F.min("component") == F.max("component"), F.when(F.count("component") == F.count("*"), F.min("component"))).alias("all"))
    side = lambda x: of_block.select("cluster", F.col("block").alias(x), F.col("all").alias(f"all_{x}"))
    met = pairs.join(side("i"), ["cluster", "i"]).join(side("j"), ["cluster", "j"])
    return met.filter(~F.coalesce(F.col("all_i") == F.col("all_j"), F.lit(False))).select(*pairs.columns)


def link_forest(nodes: np.ndarray, n: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray,
                percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows ``left`` and ``right`` (places in ``sets``)."""
    needed = needed_overlap(n[left][:, None], n[right][None, :], percent)
    overlap = np.zeros(needed.shape, np.int64)
    flat = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    columns, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    # Columns of a single row add nothing; the others are taken block by block.
    column = (np.cumsum(counts > 1) - 1)[inverse]
    kept = counts[inverse] > 1
    rows, column = rows[kept], column[kept]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    width = int(column[-1]) + 1 if len(column) else 0
    left_of = np.full(len(sets), -1)
    right_of = np.full(len(sets), -1)
    left_of[left], right_of[right] = np.arange(len(left)), np.arange(len(right))
    todo = np.bincount(rows, minlength=len(sets))
    for start in range(0, width, COLUMN_BLOCK):
        a, b = np.searchsorted(column, [start, start + COLUMN_BLOCK])
        r, c = rows[a:b], column[a:b] - start
        x, y = np.zeros((len(left), COLUMN_BLOCK), np.float32), np.zeros((len(right), COLUMN_BLOCK), np.float32)
        on = left_of[r] >= 0
        x[left_of[r[on]], c[on]] = 1
        on = right_of[r] >= 0
        y[right_of[r[on]], c[on]] = 1
        overlap += np.rint(x @ y.T).astype(np.int64)
        todo -= np.bincount(r, minlength=len(sets))
        reach = overlap + np.minimum(todo[left][:, None], todo[right][None, :])
        if not (reach >= needed).any():
            return []
    linked = overlap >= needed
    parent = list(range(len(sets)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    forest = []
    for p, q in zip(*np.nonzero(linked)):
        u, v = root(int(left[p])), root(int(right[q]))
        if u != v:
            parent[u] = v
            forest.append((int(nodes[left[p]]), int(nodes[right[q]])))
    return forest


def _links(dealt: DataFrame, percent: int) -> DataFrame:
    """Forest edges (u, v) of every block pair. A task meets one block pair after the other."""
    keys = ["cluster", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []

        def multiplied() -> pa.RecordBatch:
            nodes, n = np.array([h[0] for h in held]), np.array([h[1] for h in held])
            block = np.array([h[3] for h in held])
            left, right = np.flatnonzero(block == here[1]), np.flatnonzero(block == here[2])
            edges = link_forest(nodes, n, [h[2] for h in held], left, right, percent) if len(held) > 1 else []
            u, v = zip(*edges) if edges else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            hashes = batch.column("hashes")
            flat, bounds = hashes.flatten().to_numpy(), hashes.offsets.to_numpy() - hashes.offsets[0].as_py()
            key = list(zip(*(batch.column(k).to_pylist() for k in keys)))
            node, n, block = (batch.column(k).to_pylist() for k in ("node", "n", "block"))
            for row in range(batch.num_rows):
                if key[row] != here:
                    if held:
                        yield multiplied()
                    here, held = key[row], []
                held.append((node[row], n[row], flat[bounds[row]:bounds[row + 1]].copy(), block[row]))
        if held:
            yield multiplied()

    sorted_rows = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return sorted_rows.select(*keys, "block", "node", "n", "hashes").mapInArrow(run, "u long, v long")


def verified_components(docs: DataFrame, clusters: DataFrame, words: int, percent: int, id_is_text: bool = False) -> DataFrame:
    """(node, component) of every node that links with another of its cluster, by full sets.

    ``clusters`` (node, cluster) names texts by doc_id. Every pair of a cluster's nodes whose
    sizes allow a link is multiplied, unless links already found connect all of both blocks, so
    no link that joins components is lost. Block pairs are taken in rounds, near ones first:
    what lies on disk at a time is a few times the sets, however large a cluster."""
    scratch = Scratch(docs.sparkSession, "sets")
    sets = scratch.written(_sets(docs, scratch.written(clusters), words))
    if id_is_text and not sets.groupBy("node").count().filter("count > 1").isEmpty():
        sets = scratch.written(sets.dropDuplicates(["node"]))
        scratch.keep_last()
    blocks = Scratch(docs.sparkSession, "blocks")
    rows = blocks.written(_blocked(sets))
    scratch.remove()
    pairs = blocks.written(_block_pairs(rows, percent))
    linked = None
    for near, far in _rounds(pairs):
        now = pairs.filter((F.col("j") - F.col("i")).between(near, far))
        if linked is not None:
            now = _open_pairs(now, rows, linked)
        edges = _links(_deal(rows, now), percent)
        if linked is not None:
            edges = edges.union(linked.select(F.col("node").alias("u"), F.col("component").alias("v")))
        linked = components(edges, "links")
    blocks.remove()
    return docs.sparkSession.createDataFrame([], "node long, component long") if linked is None else linked


def near_duplicates(docs: DataFrame, words: int, percent: int, id_is_text: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text). With
    ``id_is_text`` rows of one id have one text, and any number of them is multiplied once."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = _refined(docs, words, percent, _frequent(docs, words))
    # Tables with columns go as soon as they are read: what the result reads is narrow.
    texts, scratch = Scratch(docs.sparkSession, "first-columns"), Scratch(docs.sparkSession, "classes")
    first = texts.written(_first_columns(docs, words, percent, order))
    rows = written(first.drop("first"), "rows")
    classes = scratch.written(first.filter("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("first").alias("first")))
    texts.remove()
    named = written(classes.select("digest", "node"), "class-names")
    clusters = written(components(_candidates(classes.filter("node is not null"), percent, scratch), "clusters").select(
        "node", F.col("component").alias("cluster")), "clusters")
    scratch.remove()
    found = verified_components(docs, clusters, words, percent, id_is_text)
    named = named.join(found, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component"))
    full, empty = rows.filter("n > 0"), rows.filter("n = 0")
    return full.join(named, "digest").select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")).union(
        empty.select("doc_id", "n", "doc_id"))


def keep_one(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One row of each component of near duplicates, the one with the least id, any id before
    none; of rows equal in id and text one. Rows without a text's words all stay. Columns stay
    as they are.

    Rows are told apart by a 64-bit hash of id and text, as shingles are by theirs: ids may
    repeat or be missing.
    """
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = written(near_duplicates(docs.select(key.alias("doc_id"), "text"), words, percent, id_is_text=True).filter("n_shingles > 0").groupBy(
        F.col("doc_id").alias("key")).agg(F.first("component_id").alias("component"), F.count("*").alias("rows")), "found")
    ids = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id")).join(found, "key")
    kept = ids.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).getField("key").alias("key"))
    kept = written(kept, "kept")
    lost = found.join(kept, "key", "left_anti").select("key")
    left = docs.select(key.alias("key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).join(
        lost, "key", "left_anti")
    repeated = written(found.filter("rows > 1").join(kept, "key", "left_semi").select("key"), "repeated")
    if repeated.isEmpty():
        return left.select("row.*")
    one = left.join(repeated, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row"))
    return left.join(repeated, "key", "left_anti").select("row.*").union(one.select("row.*"))
