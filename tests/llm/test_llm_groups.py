"""Jaccard join, packing, neighbours and the pipeline against brute force."""
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from corpusq.llm import graph, jaccard, neighbours, packing


# ---- Jaccard join ---------------------------------------------------------------------

def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            u, v = sorted((root(a), root(b)))
            parent[v] = u
    return {i: (len(s), root(i)) for i, s in sets.items()}


def corpus(rng):
    """Families of near copies with drift, a passage that most texts share, short texts and ties."""
    passage = " ".join(f"p{i}" for i in range(30))
    texts = []
    for family in range(12):
        base = [f"f{family}w{i}" for i in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, 14)):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            if rng.random() < 0.2:
                base = w
            texts.append(" ".join(w))
    texts += [f"{passage} " + " ".join(f"own{n}x{i}" for i in range(rng.randint(0, 12))) for n in range(45)]
    texts += ["a b", "A  b", "a", "", None, "a b c", "c b a", "a b c d e f g h i j k", "A B c d e f g h i j"]
    return list(enumerate(texts))


@pytest.mark.parametrize("k, percent, small", [(3, 90, True), (5, 80, False)])
def test_join_equals_brute_force(spark, monkeypatch, k, percent, small):
    if small:  # long columns, several row blocks and column blocks
        monkeypatch.setattr(jaccard, "SHORT_COLUMN", 4)
        monkeypatch.setattr(jaccard, "ROW_BLOCK", 5)
    rows = corpus(random.Random(k))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n", F.lit("clash")).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, k, percent).collect()}
    assert got == brute(rows, k, percent)


def test_join_edge_cases(spark):
    df = spark.createDataFrame([(None, "x y z"), (4, "x y z"), (4, "x y z"), (3, None), (3, None), (None, "q")],
                               "doc_id bigint, text string")
    got = sorted((tuple(r) for r in jaccard.near_duplicates(df, 3, 90).collect()), key=str)
    assert got == sorted([(None, 1, 4), (4, 1, 4), (4, 1, 4), (3, 0, 3), (3, 0, 3), (None, 1, None)], key=str)
    assert jaccard.near_duplicates(df.limit(0), 3, 90).count() == 0
    assert jaccard.keep_one(df, 3, 90).columns == df.columns


def test_one_row_of_each_component_stays(spark):
    other = "k l m n o p q r s t"
    rows = [(None, "x y z"), (4, "x y z"), (4, "x y z"), (9, "x  Y z"),  # one component, repeated least id
            (5, other), (5, "u v w"), (6, "u v w"), (7, other),  # an id with two texts
            (None, "q"), (None, "q"), (None, " Q"),  # no ids
            (8, "h h"), (8, "h h"), (3, None), (3, None), (None, "")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id bigint, text string, `a.b` string").repartition(3)
    kept = jaccard.keep_one(df, 3, 90)
    got = Counter((r[0], (r[1] or "").strip().lower()) for r in kept.collect())
    assert got == {(4, "x y z"): 1, (5, other): 1, (5, "u v w"): 1, (None, "q"): 1, (8, "h h"): 1, (3, ""): 2, (None, ""): 1}
    assert kept.columns == df.columns


def test_forest_covers_the_links():
    rng = np.random.default_rng(4)
    base = rng.choice(10_000, 400, replace=False)
    sets = [np.unique(np.where(rng.random(400) < p, rng.integers(10_000, 90_000, 400), base)) for p in rng.uniform(0, 0.12, 40)]
    n, nodes = np.array([len(s) for s in sets]), np.arange(40) * 10
    left, right = np.arange(25), np.arange(25, 40)
    links = {(a, b) for a in left for b in right
             if 100 * (i := len(np.intersect1d(sets[a], sets[b]))) >= 80 * (n[a] + n[b] - i)}
    forest = jaccard.link_forest(nodes, n, sets, left, right, 80)
    assert {(u // 10, v // 10) for u, v in forest} <= links and 0 < len(forest) < 40

    def groups(edges):
        parent = list(range(40))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            parent[root(a)] = root(b)
        return {frozenset(i for i in range(40) if root(i) == r) for r in map(root, range(40))}

    assert groups(links) == groups([(u // 10, v // 10) for u, v in forest])


def test_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000 + i, 1000) for i in range(1, 60)] + [(7, 7), (5, 3), (5, 3)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(60)}
    assert graph.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# ---- packing --------------------------------------------------------------------------

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_encoding_equals_the_library():
    import pyarrow as pa

    rng, encoder = random.Random(2), packing.Encoder(TOKENIZER)
    parts = ["a", "The", " ", "  ", "\n", "é", "É", "word", ".", ",", "...", " and", "\t", "中", "😀", "'s", "don't", "x1y2",
             "<|endoftext|>", "\x00", "ΑΣ", "\xa0", "İ", "é", "ß", "!!", '"', "l'"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    ids, bounds = encoder.encode(pa.array(texts))
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for i, w in enumerate(want):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == w.ids, texts[i]


def test_more_parts_than_are_remembered(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "REMEMBERED", 3)
    monkeypatch.setattr(packing, "AT_ONCE", 2, raising=False)
    encoder = packing.Encoder(TOKENIZER)
    for batch in (["one two"], ["one 11 22 33 44 three four 55 two"], ["44 55 one, 66", "77 88 one two"]):
        ids, bounds = encoder.encode(pa.array(batch))
        for text, start, end in zip(batch, bounds, bounds[1:]):
            assert ids[start:end].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder.parts) <= 3


def test_best_fit_takes_the_tightest():
    rng = random.Random(6)
    lengths = sorted((rng.randint(1, 64) for _ in range(400)), reverse=True)
    numbers, offsets = packing.best_fit(np.array(lengths), 64)
    room = []
    for length, number, offset in zip(lengths, numbers, offsets):
        fits = [r for r in room if r >= length]
        if fits:
            assert room[number] == min(fits)
        else:
            assert number == len(room)
            room.append(64)
        assert offset == 64 - room[number]
        room[number] -= length


def test_packing_rows(spark):
    texts = [None, "", "one two three", "one two three", "word " * 5000, *(f"{'t ' * (i * 37 % 900)}" for i in range(120))]
    df = spark.createDataFrame([(i % 100, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, offset string")
    rows = packing.pack(packing.cut(df, TOKENIZER, with_ids=True), group_pieces=50).collect()
    by_sequence = {}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length <= 2048
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in by_sequence.values():
        placed.sort()
        assert placed[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(placed, placed[1:]))
        assert sum(placed[-1]) <= 2048
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 2048) + 4
    assert Counter(r.length for r in rows)[2048] >= 2 and sum(r.length == 1 for r in rows) >= 2
    assert packing.pack(packing.cut(df.limit(0), TOKENIZER)).count() == 0


# ---- neighbours -----------------------------------------------------------------------

def test_neighbours_recall_and_scores(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = table.select("vec_id", "embedding").collect()
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    got = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in ids[ids % 20 == 0]:
        score = v @ v[ids == q][0]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        found = sorted(got[q])
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(f[2] - score[ids == f[1]][0]) < 1e-12 for f in found)
        hits += len({f[1] for f in found} & set(ids[order].tolist()))
    assert hits >= 0.9 * 20 * len(got)


def test_neighbours_of_unequal_lengths_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i), (rng.standard_normal(6) * (1 + i % 9)).tolist()) for i in range(200)]
    odd = [(300, None), (301, [0.0] * 6), (302, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (303, [float("nan")] * 6),
           (304, [float("inf")] * 6), (None, [9.0] * 6), (40, rows[40][1]), (320, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").withColumn("id", F.lit("clash"))
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=5, confidence=1 - 1e-9).collect()
    v = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    assert {r.query_id for r in got} == set(range(0, 200, 20))
    for q in range(0, 200, 20):
        score = v @ v[q]
        want = [i for i in np.argsort(-score, kind="stable") if i != q][:5]
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == want
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert len(neighbours.nearest(df.filter("vec_id < 3"), F.col("vec_id") % 20 == 0).collect()) == 2


def test_chi_square():
    assert abs(neighbours.chi_square_cdf(neighbours.stopping_ratio(0.95)) - 0.95) < 1e-9
    assert abs(neighbours.stopping_ratio(0.95) - 15.507) < 1e-2  # tabled value for 8 degrees


# ---- pipeline -------------------------------------------------------------------------

def test_pipeline_stage_by_stage(spark):
    from corpusq.llm import mixing, quality, toxicity
    from corpusq.session import written

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SMALL), "test-stage")
        kept[name] = docs
        if name == "toxicity":
            scored = toxicity.score_texts(before, toxicity.learn(before, labels))
            want = {r.doc_id for r in scored.filter(F.col("score") < toxicity.REJECT).collect()}
            assert {r.doc_id for r in docs.collect()} == want
        elif name == "quality_rules":
            want = {r.doc_id for r in quality.apply_rules(before).filter("kept").collect()}
            assert {r.doc_id for r in docs.collect()} == want
        elif name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert {r.doc_id for r in docs.collect()} == {c for _, c in brute(rows, 5, 80).values()}
        elif name == "mix_sources":
            whole = {r.doc_id: r.taken // r["size"] for r in mixing.taken(before).collect()}
            assert Counter(r.doc_id for r in docs.collect()) == Counter(whole) and before.columns == docs.columns
        else:
            assert docs.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
            assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "near_duplicates", "mix_sources", "packing"]
    final = corpus_pipeline.run(spark, SMALL)
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, final.select(key).collect())) == sorted(map(tuple, kept["packing"].select(key).collect()))
