"""Toxicity: a learned lexicon, matched through Levenshtein automata, weighed by context.

Learning takes a bounded sample of labelled documents (``SAMPLE_DOCS``). Words, and stems
that several words share, become terms if they occur with the toxic label far more often
than without; near copies in the sample count once. Exact hits and misspelt ones get
log-odds weights from the sample, so that a neighbour that is an ordinary word weighs
nothing.

Scoring reads every whole text: each distinct word of a batch passes a sieve, survivors are
matched against the trie, and only texts with hits are looked at again. A hit in quotation
marks or next to reporting words counts for little, a hit near another or near a word of
address counts for more.

Defined cases: null and empty texts have no hits and get the score of a text without hits.
Rows come back one for one, repeated ids included; a null label is no label. Without any
labelled row, or without a toxic one, all texts score the prior. Extra columns pass through
``score_texts`` untouched; input columns of the result's names are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.llm.batches import coded_words, filled, map_batches
from corpusq.llm.common import fold
from corpusq.llm.lexicon import Lexicon
from corpusq.session import written

# Bounds of what is learned from and of what is learned.
SAMPLE_DOCS = 20_000
MAX_TERMS = 2_000
STEM_LENGTHS = range(4, 9)
STEM_FORMS = 4
LEAST_EVIDENCE = 30.0
LEAST_PRECISION = 0.9
CLEAN_SHARE = 0.997
REJECT = 0.7
WINDOW = 6

PUNCTUATION = ".,;:!?\"'`()[]{}<>«»“”‘’„…*_~|/\\-–—#%&+="
OPENING, CLOSING = "\"“„«‘", "\"”“»’"
LOOKALIKES = str.maketrans("0134578@$", "oieastbas")
# Words that report speech, and words that address someone.
REPORTING = frozenset("said says wrote called quote quoted term word dit écrit mot sagte schrieb wort dijo palabra".split())
ADDRESS = frozenset("you your yours u du dich dir ihr tu te toi vous tú usted ustedes".split())


def cores(vocabulary: pa.Array) -> pa.Array:
    """Words in lower case without punctuation at their ends, look-alike digits as letters."""
    bare = pc.utf8_trim(pc.utf8_lower(vocabulary), characters=PUNCTUATION)
    mixed = pc.and_(pc.match_substring_regex(bare, "[0-9@$]"), pc.match_substring_regex(bare, r"\p{L}"))
    if not pc.any(mixed).as_py():
        return bare
    return pa.array([w.translate(LOOKALIKES) if m else w for w, m in zip(bare.to_pylist(), mixed.to_pylist())])


@dataclass(frozen=True)
class Model:
    terms: tuple[tuple[str, bool], ...]
    weights: tuple[tuple[float, float], ...]  # of exact hits, of misspelt ones
    base: float  # log-odds of a text without hits


def _matches(lexicon: Lexicon, words: pa.Array) -> dict[int, tuple[int, int]]:
    passed = pc.indices_nonzero(pc.match_substring_regex(words, lexicon.sieve)).to_pylist()
    found = ((i, lexicon.match(words[i].as_py())) for i in passed)
    return {i: hit for i, hit in found if hit}


# ---- learning -------------------------------------------------------------------------

def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, text) of the sampled labelled documents outside the held-out fold."""
    marks = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 3) != 1))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    )
    # The limit bounds what is broadcast; texts stay where they are.
    return docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")


def _sketches(sample: DataFrame) -> DataFrame:
    """Four minima of hashed 5-word windows of each sampled text."""
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            codes, vocabulary, bounds = coded_words(batch.column("text"))
            rng = np.random.default_rng(7)
            hashes = np.array([hash_of(w) for w in vocabulary.to_pylist()] or [0], dtype=np.uint64)[codes]
            factors = rng.integers(1, 2**63, 5, dtype=np.uint64) | np.uint64(1)
            salts = rng.integers(1, 2**63, 4, dtype=np.uint64) | np.uint64(1)
            rows = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                h, n = hashes[a:b], max(1, b - a - 4)
                g = np.zeros(n, np.uint64)
                for k, f in enumerate(factors):
                    part = h[k:k + n]
                    g[:len(part)] += part * f
                rows.append([int(((g ^ (g >> np.uint64(29))) * s).min() >> np.uint64(1)) for s in salts])
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "sketch"])

        return step

    return map_batches(sample.select("doc_id", "text"), make, "doc_id long, sketch array<long>")


def hash_of(word: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def _first_of_copies(sample: DataFrame) -> list[int]:
    """Ids of sampled documents that share no minimum with an earlier one (a bounded list)."""
    seen, kept = set(), []
    for doc_id, sketch in sorted({(r[0], tuple(r[1])) for r in _sketches(sample).collect()}):
        marks = set(enumerate(sketch))
        if not marks & seen:
            kept.append(doc_id)
        seen |= marks
    return kept


def _word_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, clean): in how many sampled documents with either label a word occurs."""
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            codes, vocabulary, bounds = coded_words(batch.column("text"))
            coded = cores(vocabulary).dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)[codes]
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False) > 0
            counts = np.zeros((2, max(1, len(coded.dictionary))), np.int64)
            for is_toxic, a, b in zip(toxic, bounds[:-1], bounds[1:]):
                counts[int(is_toxic)][np.unique(codes[a:b])] += 1
            n = len(coded.dictionary)
            return pa.RecordBatch.from_arrays(
                [coded.dictionary, pa.array(counts[1][:n]), pa.array(counts[0][:n])], names=["word", "toxic", "clean"])

        return step

    made = map_batches(sample.select("text", "toxic"), make, "word string, toxic long, clean long")
    return made.filter(F.length("word") >= 3).groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _evidence(n_toxic: int, n_clean: int):
    """Log-likelihood ratio of a term's toxic share against the sample's, as an expression."""
    n = F.col("toxic") + F.col("clean")
    base = n_toxic / (n_toxic + n_clean)
    part = lambda k, share: F.when(k > 0, 2 * k * F.log(k / (n * share))).otherwise(0.0)
    return part(F.col("toxic"), base) + part(F.col("clean"), 1 - base)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    spark = docs.sparkSession
    sample = written(_sample(docs, labels), "toxicity-sample")
    kept = _first_of_copies(sample)
    ids = spark.createDataFrame([(i,) for i in kept], "doc_id long")
    sample = sample.join(F.broadcast(ids), "doc_id", "left_semi")
    totals = {int(r[0]) > 0: r[1] for r in sample.groupBy((F.col("toxic") > 0).cast("int")).count().collect()}
    n_toxic, n_clean = totals.get(True, 0), totals.get(False, 0)
    prior = (n_toxic + 1) / (n_toxic + n_clean + 20)
    base = math.log(prior / (1 - prior))
    if not n_toxic or not n_clean:
        return Model((), (), base)

    words = _word_counts(sample).persist()
    stems = words.select("toxic", "clean", F.explode(F.array(
        *(F.when(F.length("word") >= k, F.substring("word", 1, k)) for k in STEM_LENGTHS))).alias("text"))
    counted = words.select(F.col("word").alias("text"), "toxic", "clean", F.lit(1).alias("forms"), F.lit(False).alias("stem")).union(
        stems.filter("text is not null").groupBy("text").agg(
            F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count("*").alias("forms"))
        .filter(F.col("forms") >= STEM_FORMS).withColumn("stem", F.lit(True)))
    chosen = (
        counted.filter((F.col("toxic") > F.col("clean")) & (F.col("toxic") >= LEAST_PRECISION * (F.col("toxic") + F.col("clean"))))
        .withColumn("evidence", _evidence(n_toxic, n_clean)).filter(F.col("evidence") >= LEAST_EVIDENCE)
        .orderBy(F.desc("evidence"), "text").limit(MAX_TERMS).select("text", "stem", "toxic", "clean", "forms").collect()
    )
    terms = _essential(chosen)
    weights = _weights(words, terms, n_toxic, n_clean) if terms else ()
    words.unpersist()
    # Terms that clean texts show too must not reject one by a chance hit or two: what all but
    # a few clean texts of the sample reach stays below the mark for rejection.
    model = Model(tuple(terms), weights, base)
    reached = score_texts(sample.filter("toxic = 0").select("doc_id", "text"), model, keep=["doc_id"]).agg(
        F.percentile("evidence", F.lit(CLEAN_SHARE))).first()[0]
    return Model(model.terms, weights, min(base, math.log(0.65 / 0.35) - (reached or 0.0)))


def _essential(chosen: list) -> list[tuple[str, bool]]:
    """Without terms that a kept stem covers; of nested stems the one that gathers most wins,
    and a stem that gathers hardly more than one of its words gives way to the word."""
    whole = {r["text"]: r for r in chosen if not r["stem"]}
    stems = []
    for r in sorted((r for r in chosen if r["stem"]), key=lambda r: (len(r["text"]), r["text"])):
        largest = max((w["toxic"] for t, w in whole.items() if t.startswith(r["text"])), default=0)
        if largest < 0.8 * r["toxic"] and not any(r["text"].startswith(s) for s in stems):
            stems.append(r["text"])
    words = [t for t in whole if not any(t.startswith(s) for s in stems)]
    return [(s, True) for s in stems] + [(w, False) for w in sorted(words)]


def _weights(words: DataFrame, terms: list[tuple[str, bool]], n_toxic: int, n_clean: int) -> tuple:
    """Log-odds of exact and of misspelt hits of each term among the sample's words."""
    def make():
        lexicon = Lexicon(terms)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = _matches(lexicon, batch.column("word"))
            at = list(found)
            return pa.RecordBatch.from_arrays([
                pa.array([found[i][0] for i in at], pa.int64()), pa.array([found[i][1] for i in at], pa.int64()),
                batch.column("toxic").take(pa.array(at, pa.int64())), batch.column("clean").take(pa.array(at, pa.int64())),
            ], names=["term", "edits", "toxic", "clean"])

        return step

    rows = map_batches(words.select("word", "toxic", "clean"), make, "term long, edits long, toxic long, clean long")
    sums = {(r[0], r[1]): (r[2], r[3]) for r in rows.groupBy("term", "edits").agg(F.sum("toxic"), F.sum("clean")).collect()}

    def odds(toxic: float, clean: float) -> float:
        return max(0.0, math.log(toxic / n_toxic) - math.log(clean / n_clean))

    made = []
    for number in range(len(terms)):
        exact, near = sums.get((number, 0), (0, 0)), sums.get((number, 1), (0, 0))
        # A misspelling that the sample never shows is taken as toxic, if less surely so.
        made.append((odds(exact[0] + 0.5, exact[1] + 0.5), odds(near[0] + 1.0, near[1] + n_clean / n_toxic * 0.02)))
    return tuple(made)


# ---- scoring --------------------------------------------------------------------------

def _quoted(words: list[str], at: int) -> bool:
    before, after = words[max(0, at - WINDOW):at], words[at + 1:at + 1 + WINDOW]
    opened = any(w[0] in OPENING for w in [*before, words[at]])
    closed = any(w.rstrip(".,;:!?")[-1:] in CLOSING for w in [words[at], *after] if w.rstrip(".,;:!?"))
    return opened and closed


def context_factor(words: list[str], at: int, hits: set[int]) -> float:
    """How far the words around a hit make it a quotation (below 1) or abuse (above 1)."""
    around = [*range(max(0, at - WINDOW), at), *range(at + 1, min(len(words), at + 1 + WINDOW))]
    near = {words[i].strip(PUNCTUATION).lower() for i in around}
    if _quoted(words, at):
        return 0.25
    factor = 0.6 if near & REPORTING else 1.0
    return factor * (1.25 if near & ADDRESS else 1.0) * (1.25 if hits & set(around) else 1.0)


def score_texts(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` (its columns ``keep``) plus ``score`` (0 to 1), ``evidence`` (log-odds of
    the hits), ``n_hits`` and ``hit_terms`` (distinct, sorted)."""
    names = [c for c in (df.columns if keep is None else keep) if c not in ("score", "evidence", "n_hits", "hit_terms")]
    schema = T.StructType([*(df.schema[c] for c in names), T.StructField("score", T.DoubleType()),
                           T.StructField("evidence", T.DoubleType()), T.StructField("n_hits", T.LongType()), T.StructField("hit_terms", T.ArrayType(T.StringType()))])
    def make():
        lexicon = Lexicon(list(model.terms))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = filled(batch.column(text))
            codes, vocabulary, bounds = coded_words(texts)
            found = _matches(lexicon, cores(vocabulary)) if model.terms else {}
            hit = np.zeros(max(1, len(vocabulary)), bool)
            hit[list(found)] = True
            places = np.flatnonzero(hit[codes])
            total, count, terms = np.zeros(len(texts)), np.zeros(len(texts), np.int64), [[] for _ in range(len(texts))]
            first = np.searchsorted(places, bounds)
            for doc in np.flatnonzero(np.diff(first)):
                own = places[first[doc]:first[doc + 1]]
                words = vocabulary.take(pa.array(codes[bounds[doc]:bounds[doc + 1]])).to_pylist()
                at = {int(p - bounds[doc]): found[int(codes[p])] for p in own}
                for place, (number, edits) in at.items():
                    total[doc] += model.weights[number][min(edits, 1)] * context_factor(words, place, at.keys() - {place})
                count[doc] = len(at)
                terms[doc] = sorted({model.terms[number][0] for number, _ in at.values()})
            score = 1 / (1 + np.exp(-np.clip(model.base + total, -30, 30)))
            columns = [batch.column(c) for c in names]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(score), pa.array(total), pa.array(count), pa.array(terms, pa.list_(pa.string()))],
                names=[*names, "score", "evidence", "n_hits", "hit_terms"])

        return step

    return map_batches(df, make, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score stays below ``REJECT``, columns unchanged."""
    model = learn(docs, labels)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    scored = score_texts(docs.select(row, "text"), model, keep=["row"])
    return scored.filter(F.col("score") < REJECT).select("row.*")
