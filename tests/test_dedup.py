"""Exact and near-duplicate removal, also against a sequential fold."""
import random

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from corpusq.config import Settings
from corpusq.functions import minhash
from corpusq.operators import dedup


def ids(df):
    return {r.id for r in df.select("id").collect()}


# ---- exact ----------------------------------------------------------------------------

def test_exact_keeps_the_first_of_equal_stripped_texts(texts):
    contents = ["SELECT 1", "SELECT 2", "\tSELECT 1\n", "SELECT 1", "\u3000SELECT 2", "select 1"]
    assert ids(dedup.deduplicate(texts(contents))) == {0, 1, 5}


def test_exact_null_texts_collapse_to_one(texts):
    assert ids(dedup.deduplicate(texts([None, None, "a"]))) == {0, 2}


def test_exact_survives_a_group_of_a_third_of_all_rows(texts):
    contents = ["same"] * 1000 + [f"text {i}" for i in range(2000)]
    assert ids(dedup.deduplicate(texts(contents).repartition(8))) == {0, *range(1000, 3000)}


def test_exact_empty_input(texts):
    assert dedup.deduplicate(texts([])).count() == 0


# ---- signatures -----------------------------------------------------------------------

def slow_signature(text, count):
    """Straight from the definition, in plain integers."""
    shingles = {text[j:j + 5] for j in range(max(1, len(text) - 4))}
    hashes = []
    for shingle in shingles:
        h = 0
        for c in shingle:
            h = (h * minhash.FOLD + ord(c) + 1) % 2**32
        for _ in range(2):
            h = ((h ^ h >> 16) * minhash.SCRAMBLE) % 2**32
        hashes.append(h ^ h >> 16)
    return [min((a * h + b) % 2**32 for h in hashes) for a, b in minhash.permutations(count)]


def test_signature_matches_definition(texts):
    contents = ["", "a", "abcd", "abcde", "abcdef", "na\u00efve caf\u00e9 \U0001f600 text", "xy" * 400, None, "z" * 9]
    rows = texts(contents).select("id", minhash.signature(F.col("content"), 20).alias("s")).orderBy("id").collect()
    for text, row in zip(contents, rows):
        assert row.s == (None if text is None else slow_signature(text, 20))


def test_signature_of_a_text_cut_into_pieces(monkeypatch):
    rng = random.Random(5)
    contents = ["".join(rng.choices("abcdef ", k=n)) for n in (0, 3, 4, 5, 6, 49, 50, 51, 53, 54, 55, 56, 400)]
    whole = minhash.signatures(contents, 16)
    monkeypatch.setattr(minhash, "PIECE", 50)
    assert (minhash.signatures(contents, 16) == whole).all()
    assert [list(map(int, r)) for r in whole] == [slow_signature(t, 16) for t in contents]


def test_signature_estimates_jaccard():
    words = [f"w{i}" for i in range(4000)]
    left, right = " ".join(words[:3000]), " ".join(words[1000:])
    shingles = [{t[j:j + 5] for j in range(len(t) - 4)} for t in (left, right)]
    true = len(shingles[0] & shingles[1]) / len(shingles[0] | shingles[1])
    a, b = minhash.signatures([left, right], 2000)
    assert np.mean(a == b) == pytest.approx(true, abs=0.05)


def test_band_choice():
    assert minhash.choose_bands(0.8, 128) == (9, 13)


# ---- near -----------------------------------------------------------------------------

def listing(seed, lines=250):
    """A text of random statements; texts of different seeds share next to nothing."""
    rng = random.Random(seed)
    return "\n".join(f"{rng.choice('pqrs')}{rng.randrange(10**6)} <- {rng.randrange(10**9)};" for _ in range(lines))


def test_near_keeps_one_of_each_family(texts):
    families = [listing(1), listing(2), listing(3)]
    contents = [variant for f in families for variant in (f, f + "\n-- reviewed", f.replace(";", " ;", 1))]
    kept = ids(dedup.near_deduplicate(texts(contents)))
    assert {i // 3 for i in kept} == {0, 1, 2} and len(kept) == 3
    assert ids(dedup.near_deduplicate(texts(contents), order="arrival")) == {0, 3, 6}


def test_near_short_empty_and_null_texts(texts):
    assert dedup.near_deduplicate(texts([listing(4)])).count() == 1
    assert ids(dedup.near_deduplicate(texts(["", "abc", "", "abc", None, None]), order="arrival")) == {0, 1, 4, 5}


def test_near_empty_input(texts):
    assert dedup.near_deduplicate(texts([])).count() == 0


def sequential(rows):
    """Keep a row iff no earlier kept row shares a bucket."""
    taken, kept = set(), set()
    for row_id, buckets in sorted(rows):
        if taken.isdisjoint(buckets):
            taken.update(buckets)
            kept.add(row_id)
    return kept


def kept_by_spark(spark, rows, **options):
    df = spark.createDataFrame(rows, "id bigint, buckets array<string>")
    return ids(dedup.keep_first(df.repartition(4), **options))


CHAIN = [(i, [f"b{i}", f"b{i + 1}"]) for i in range(1, 13)] + [(50, ["lone", "lone2"])]


def test_chain_is_not_a_component(spark):
    # Neighbours share a bucket, ends do not: every other row of the chain stays.
    assert kept_by_spark(spark, CHAIN) == {1, 3, 5, 7, 9, 11, 50}


@pytest.mark.parametrize("hot_members", [1, 100_000])
def test_random_bucket_graphs(spark, hot_members):
    # Many independent graphs in one run, told apart by bucket names and id ranges.
    rng = random.Random(7)
    rows = []
    for g in range(150):
        nodes = rng.sample(range(100), rng.randint(1, 9))
        width = rng.randint(2, 12)
        rows += [(g * 100 + n, [f"{g}-{band}-{rng.randrange(width)}" for band in range(3)]) for n in nodes]
    rows += [(20_000 + i, [f"hot-{i % 2}", f"own-{i}", f"pair-{i // 2}"]) for i in range(300)]
    assert kept_by_spark(spark, rows, hot_members=hot_members) == sequential(rows)


def test_a_long_chain_of_versions_ends_in_few_rounds(spark, monkeypatch):
    rounds = []
    settle = dedup._settle
    monkeypatch.setattr(dedup, "_settle", lambda *a: rounds.append(settle(*a)) or rounds[-1])
    chain = spark.range(20_000).select(
        dedup.order_key(F.col("id")).alias("id"),
        F.array(F.concat(F.lit("b"), "id"), F.concat(F.lit("b"), F.col("id") + 1)).alias("buckets"))
    kept = {int(r.id.split(":")[1]) for r in dedup.keep_first(chain).collect()}
    assert len(rounds) < 30
    # No two neighbours stay, and of three in a row at least one does.
    assert not any(i + 1 in kept for i in kept)
    assert all({i, i + 1, i + 2} & kept for i in range(19_998))
    for df in rounds:
        plan = plan_of(df)
        assert not [x for x in ("CartesianProduct", "NestedLoop", "MapInArrow", "Python") if x in plan]


def test_rounds_leave_no_tables_behind(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    from corpusq.session import shared_dir

    folder = Path(urlparse(shared_dir(spark)).path) / "corpusq"
    kept_by_spark(spark, CHAIN)
    assert not list(folder.glob("near-rounds-*"))


def test_lookup_names_the_earliest_partner(spark, texts):
    base = "\n".join(f"value_{i} = {i}" for i in range(300))
    contents = [base, "unrelated " + " ".join(f"q{i}" for i in range(400)), base + "\n# end", base]
    rows = {r.id: (r.first_id, r.shared_bands) for r in dedup.near_duplicate_lookup(texts(contents)).collect()}
    assert set(rows) == {2, 3}
    assert rows[3] == (0, 9) and rows[2][0] == 0


def test_hot_floor_bounds_the_broadcast():
    for member_rows in (10, 10**6, 10**9, 10**12):
        assert member_rows // dedup.hot_floor(member_rows) <= dedup.MAX_HOT_BUCKETS


def test_threshold_changes_bands(texts):
    strict = Settings(minhash_threshold=0.95)
    bands, rows = minhash.choose_bands(0.95, 128)
    got = dedup.minhash_bands(texts(["some text to be cut into bands"]), settings=strict).collect()
    assert len(got) == bands and rows > 13
