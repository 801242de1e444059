"""Token alignment, MinHash near-dedup and the filter audit against brute force."""
import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations, permutations

import public_tokenizers
import pytest
from conftest import SMALL

from corpusq.llm import alignment, audit, minhash_dedup

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---- op11: cross-tokenizer alignment ----------------------------------------------------

def aligned_by_hand(rows):
    """(doc_id -> 7 columns) by encoding each text alone and walking both token lists."""
    am, ap, _ = alignment._a_model(A_PATH)
    bm, bp, _ = alignment._b_model(B_PATH)
    per = []
    for d, t in rows:
        t = t or ""
        a = am.encode(" " + t, add_special_tokens=False).ids if t else []
        b = bm.encode(t) if t else []
        want = (" " + t).encode()
        if not t or b"".join(ap[x] for x in a) != want or b"".join(bp[x] for x in b) != want:
            per.append((d, None))
            continue
        ends_a = [sum(len(ap[x]) for x in a[:i + 1]) for i in range(len(a))]
        ends_b = [sum(len(bp[x]) for x in b[:i + 1]) for i in range(len(b))]
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            ga, gb = [], []
            while i < len(a) and ends_a[i] <= cut:
                ga.append(a[i])
                i += 1
            while j < len(b) and ends_b[j] <= cut:
                gb.append(b[j])
                j += 1
            groups.append((ga, gb))
        per.append((d, (a, b, groups)))
    count = Counter()
    for _, v in per:
        if v:
            count.update({(x, y) for ga, gb in v[2] for x in ga for y in gb})
    best = defaultdict(int)
    for (x, _), c in count.items():
        best[x] = max(best[x], c)
    out = []
    for d, v in per:
        if v is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups = v
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((d, len(a), len(b), len(groups), len(links), sum(count[k] == best[k[0]] for k in links),
                    sum(count[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_walk_on_hostile_texts(spark):
    rng = random.Random(11)
    pieces = ["the", "Straße", "naïve", "<|endoftext|>", "<s>", "</s>", "\n", "  ", "東京", "😀", "a,b", "x" * 300, "--"]
    texts = [None, "", " ", "plain words here", "double  space", "tab\tand\nline", "<s>hi</s>", "<|endoftext|>"]
    texts += [" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "plain words here"), (None, "plain words here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in alignment.align(df, A_PATH, B_PATH).select(COLUMNS).collect()), key=repr)
    assert got == aligned_by_hand(rows)


def test_alignment_excluded_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in alignment.align(df, A_PATH, B_PATH).select(COLUMNS).orderBy("doc_id").collect()] == \
        [(0, 0, 0, 0, 0, 0, "")] * 2
    empty = spark.createDataFrame([], "doc_id long, text string, n_a string")
    assert alignment.align(empty.select("doc_id", "text"), A_PATH, B_PATH).count() == 0


def test_alignment_on_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    got = sorted((tuple(r) for r in alignment.align(docs, A_PATH, B_PATH).select(COLUMNS).collect()), key=repr)
    assert got == aligned_by_hand([(r.doc_id, r.text) for r in docs.collect()])


# ---- op12: MinHash near-dedup -------------------------------------------------------------

def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def components_by_hand(rows, percent=85):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        both = len(a & b)
        if a and b and 100 * both >= percent * (len(a) + len(b) - both):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    least = defaultdict(lambda: None)
    for i, (d, s) in enumerate(sets):
        if s and d is not None:
            r = root(i)
            least[r] = d if least[r] is None else min(least[r], d)
    out = []
    for i, (d, s) in enumerate(sets):
        c = least[root(i)] if s else d
        out.append((d, len(s), c, d is not None and c is not None and d == c))
    return sorted(out, key=repr)


def test_minhash_dedup_equals_brute_force_with_edges(spark):
    rng = random.Random(12)
    vocab = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(30, 120))) for _ in range(12)]
    rows = []
    for k, text in enumerate(base):
        words = text.split()
        for c in range(rng.randint(1, 6)):
            w = list(words)
            for _ in range(c):  # a few edits: most copies stay above the bound, some fall below
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((len(rows) + 100, " ".join(w).upper() if c == 2 else " ".join(w)))
    rows += [(1, None), (2, ""), (3, "  \t "), (4, "one two"), (5, "ONE two"), (None, "one two"), (None, base[0]),
             (7, base[1]), (7, base[1]), (8, "x " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in minhash_dedup.near_duplicates(df).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    assert got == components_by_hand(rows)


def test_minhash_dedup_on_table_and_empty(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    got = sorted((tuple(r) for r in minhash_dedup.near_duplicates(docs).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    assert got == components_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash_dedup.near_duplicates(empty).count() == 0


def test_minhash_dedup_keeps_links_of_nodes_that_linked_with_others(spark):
    """One text links with every other; crowds of its versions share its buckets and do not link with the rest."""
    hub = [f"h{i}" for i in range(204)]
    rows = [(1000, " ".join(hub))]
    rows += [(2000 + i, " ".join(hub + [f"c{i}x{k}" for k in range(5)])) for i in range(300)]
    for j in range(10):
        w = list(hub)
        for k in range(3):
            w[6 + 6 * (3 * j + k)] = f"b{j}x{k}"
        rows.append((3000 + j, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in minhash_dedup.near_duplicates(df).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    assert got == components_by_hand(rows)
    assert {r[2] for r in got} == {1000}


# ---- op13: filter audit ---------------------------------------------------------------------

def test_shapley_by_least_squares_equals_average_over_orders():
    rng = random.Random(13)
    for _ in range(20):
        v = [0] + [rng.randint(0, 50) for _ in range(31)]
        phi = audit.shapley(v)
        for i in range(5):
            total = Fraction(0)
            for order in permutations(range(5)):
                before = 0
                for p in order:
                    if p == i:
                        total += v[before | 1 << i] - v[before]
                        break
                    before |= 1 << p
            assert phi[i] == total / 120


def test_audit_edge_rows(spark):
    long_clean = " ".join(f"word{i}" for i in range(150))
    rows = [(1, None, None, "x"), (2, "", "en", "x"), (3, long_clean, "en", "x"), (3, long_clean, "en", "x"),
            (4, long_clean, "en", "x"), (None, long_clean, "en", "x"), (5, long_clean + " #", "de", "x"),
            (6, "A" * 500, "de", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, part string")
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 1), (4, 1, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    out = {(r.part, r.filter_order, r.step): r for r in audit.audit(docs, labels).collect()}
    assert len(out) == 3 * 120 * 5
    # E first: doc 4 repeats the text of doc 3, doc 2's empty text that of doc 1 (null is empty);
    # repeated rows of doc 3 and the row without an id pass.
    en = out[("en", "EABCD", 1)]
    assert (en.removed, en.kept, en.good_lost, en.toxic_lost) == (2, 3, 1, 0)
    a = out[("en", "ABCDE", 1)]  # the empty text of doc 2 is short, and fails E as well
    assert (a.removed, a.unique_fails) == (1, 0)
    assert out[("", "ABCDE", 1)].removed == 1  # a null text has no words, a null lang is ''
    assert out[("de", "DABCE", 1)].removed == 1 and out[("de", "CABDE", 1)].removed == 1
    shapley_e = sum(r.removed for (p, _, _), r in out.items() if p == "en" and r.filter_order[r.step - 1] == "E")
    assert out[("en", "ABCDE", 5)].shapley == shapley_e
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert audit.audit(empty, labels).count() == 0
