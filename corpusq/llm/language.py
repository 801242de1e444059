"""Language identification in two steps: the language's family first, then, within it, one
linear support vector machine for each pair of languages.

Features are the shares of hashed byte trigrams of the lower-cased letters of a text.
Families come from the data: languages whose mean profiles lie close are merged. All
machines are trained on the driver from a bounded sample (``SAMPLE_DOCS`` whole texts and
one sentence of each); every text is then scored in Arrow batches without a per-text loop.

Defined cases: null texts and texts without a letter are ``und`` with score 0. Without any
labelled row every text is ``und``; with a single language each lettered text is that
language. Rows come back one for one. Extra columns pass through unless they bear a
result's name.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.llm.batches import filled, map_batches
from corpusq.llm.common import fold

SAMPLE_DOCS = 1_200
DIMENSIONS = 4096
UNKNOWN = "und"
STEPS = 80
REGULARISATION = 1e-4


def _symbols() -> np.ndarray:
    """Bytes that belong to letters stay apart, all others are one gap."""
    kept = [*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]
    table = np.zeros(256, np.uint32)
    table[kept] = np.arange(1, len(kept) + 1)
    return table


SYMBOLS = _symbols()


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, starts, ends): text i has the hashed trigrams ``codes[starts[i]:ends[i]]``; a
    gap of any length is one symbol apart from the last, doubled gaps hash to code 0."""
    lower = pc.utf8_lower(filled(texts))
    offsets = np.frombuffer(lower.buffers()[1], np.int32)[lower.offset:lower.offset + len(lower) + 1].astype(np.int64)
    raw = np.frombuffer(lower.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    s = SYMBOLS[raw]
    if len(s) < 3:
        return np.zeros(0, np.int64), np.zeros(len(lower), np.int64), np.zeros(len(lower), np.int64)
    mixed = (s[:-2] * np.uint32(0x9E3779B1)) ^ (s[1:-1] * np.uint32(0x85EBCA6B)) ^ (s[2:] * np.uint32(0xC2B2AE35))
    codes = 1 + ((mixed ^ (mixed >> np.uint32(15))) % np.uint32(DIMENSIONS - 1)).astype(np.int64)
    codes[(s[1:-1] == 0) & ((s[:-2] == 0) | (s[2:] == 0))] = 0
    ends = np.maximum(offsets[:-1], offsets[1:] - 2)
    return codes, np.minimum(offsets[:-1], len(codes)), np.minimum(ends, len(codes))


@dataclass(frozen=True)
class Model:
    """``planes`` holds a weight per trigram and machine; code 0 weighs nothing."""

    languages: tuple[str, ...]
    families: tuple[tuple[int, ...], ...]
    pairs: tuple[tuple[int, int], ...]
    planes: np.ndarray  # (machines, DIMENSIONS): one per family, then one per pair
    bias: np.ndarray
    scale: np.ndarray


def _profiles(texts: list[str]) -> np.ndarray:
    rows = np.zeros((len(texts), DIMENSIONS), np.float32)
    for i, text in enumerate(texts):
        codes, starts, ends = trigrams(pa.array([text]))
        own = codes[starts[0]:ends[0]]
        rows[i] = np.bincount(own[own > 0], minlength=DIMENSIONS)
    return rows / np.maximum(1, rows.sum(1, keepdims=True))


def _machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, float]:
    """A linear support vector machine by averaged subgradient steps, classes weighed alike."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    spread = float(np.sqrt((x**2).sum(1)).mean()) or 1.0
    w, b, mean_w, mean_b = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1], np.float32), 0.0
    z = x / spread
    for step in range(1, STEPS + 1):
        rate = 4.0 / np.sqrt(step)
        short = (y * (z @ w + b) < 1) * share * y
        w = w * (1 - rate * REGULARISATION) + rate * (short @ z)
        b += rate * 0.1 * float(short.sum())
        if step > STEPS // 2:
            mean_w += w
            mean_b += b
    w, b = mean_w / (STEPS - STEPS // 2), mean_b / (STEPS - STEPS // 2)
    margin = float(np.median(np.abs(z @ w + b))) or 1.0
    return w / spread, b, 3.0 / margin


def _families(centres: np.ndarray) -> list[list[int]]:
    """Languages merged while two groups lie closer than the mean distance of all languages."""
    groups = [[i] for i in range(len(centres))]
    if len(groups) < 3:
        return [sum(groups, [])] if groups else []
    unit = centres / np.maximum(1e-9, np.linalg.norm(centres, axis=1, keepdims=True))
    apart = 1 - unit @ unit.T
    limit = apart[np.triu_indices(len(centres), 1)].mean()
    while len(groups) > 2:
        between = {(i, j): apart[np.ix_(groups[i], groups[j])].mean() for i, j in combinations(range(len(groups)), 2)}
        (i, j), nearest = min(between.items(), key=lambda e: (e[1], e[0]))
        if nearest >= limit:
            break
        groups[i] += groups.pop(j)
    return groups


def learn(docs: DataFrame) -> Model:
    """From ``text`` and ``lang`` of rows outside the held-out fold."""
    rows = (
        docs.filter((fold(F.col("doc_id"), 4) != 2) & F.col("lang").isNotNull() & F.regexp_like("text", F.lit(r"\p{L}")))
        .select("lang", F.xxhash64("doc_id", "lang").alias("order"), "doc_id")
    )
    # A bounded number of ids of each language, so that rare ones are learned too.
    langs = sorted(r[0] for r in rows.select("lang").distinct().collect())
    each = max(20, SAMPLE_DOCS // max(1, len(langs)))
    picked = None
    for lang in langs:
        own = rows.filter(F.col("lang") == lang).orderBy("order", "doc_id").limit(each).select("doc_id", "lang")
        picked = own if picked is None else picked.union(own)
    if picked is None:
        return Model((), (), (), np.zeros((0, DIMENSIONS), np.float32), np.zeros(0), np.zeros(0))
    texts = docs.join(F.broadcast(picked.distinct()), ["doc_id", "lang"]).select("lang", "text", "doc_id")
    sample = sorted({(r[0], r[1]) for r in texts.collect()})
    # A sentence of each text as well: short texts are to be told apart too.
    shorts = [(lang, max(text.split("\n"), key=len).split(".")[0]) for lang, text in sample]
    labelled = sample + [x for x in shorts if any(c.isalpha() for c in x[1])]
    y = np.array([langs.index(lang) for lang, _ in labelled])
    x = _profiles([text for _, text in labelled])
    centres = np.array([x[y == k].mean(0) for k in range(len(langs))])
    families = _families(centres)
    of_family = np.zeros(len(langs), int)
    for f, members in enumerate(families):
        of_family[members] = f
    machines = [_machine(x, np.where(of_family[y] == f, 1.0, -1.0)) for f in range(len(families))] if len(families) > 1 else []
    pairs = [p for members in families for p in combinations(sorted(members), 2)]
    for a, b in pairs:
        own = (y == a) | (y == b)
        machines.append(_machine(x[own], np.where(y[own] == a, 1.0, -1.0)))
    planes = np.array([m[0] for m in machines], np.float32).reshape(-1, DIMENSIONS)
    planes[:, 0] = 0
    return Model(tuple(langs), tuple(map(tuple, families)), tuple(pairs), planes,
                 np.array([m[1] for m in machines]), np.array([m[2] for m in machines]))


def decide(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language number, score) of each row of scaled margins."""
    n = len(margins)
    sure = 1 / (1 + np.exp(-np.clip(margins, -30, 30)))
    several = len(model.families) > 1
    first = margins[:, :len(model.families)].argmax(1) if several else np.zeros(n, int)
    family_score = sure[np.arange(n), first] if several else np.ones(n)
    skip = len(model.families) if several else 0
    votes, least = np.zeros((n, len(model.languages))), np.ones((n, len(model.languages)))
    for k, (a, b) in enumerate(model.pairs):
        p = sure[:, skip + k]
        votes[:, a] += (p >= 0.5) + 1e-3 * p
        votes[:, b] += (p < 0.5) + 1e-3 * (1 - p)
        least[:, a], least[:, b] = np.minimum(least[:, a], p), np.minimum(least[:, b], 1 - p)
    for f, members in enumerate(model.families):
        outside = np.setdiff1d(np.arange(len(model.languages)), members)
        votes[np.ix_(first == f, outside)] = -1
    best = votes.argmax(1)
    return best, family_score * least[np.arange(n), best]


def identify(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` (its columns ``keep``) plus ``lang_pred`` and ``score`` (0 to 1)."""
    names = [c for c in (df.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    schema = T.StructType([*(df.schema[c] for c in names), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = filled(batch.column(text))
            lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            codes, starts, ends = trigrams(texts)
            counted = np.concatenate([[0], np.cumsum(codes > 0)])
            n = np.maximum(1, counted[ends] - counted[starts])
            margins = np.zeros((len(texts), len(model.planes)))
            for k, plane in enumerate(model.planes):
                sums = np.concatenate([[0.0], np.cumsum(plane[codes], dtype=np.float64)])
                margins[:, k] = ((sums[ends] - sums[starts]) / n + model.bias[k]) * model.scale[k]
            if model.languages:
                best, score = decide(model, margins)
                named = np.array(model.languages, object)[best]
            else:
                named, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
                lettered[:] = False
            return pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in names),
                pa.array(np.where(lettered, named, UNKNOWN), pa.string()), pa.array(np.where(lettered, score, 0.0))],
                names=[*names, "lang_pred", "score"])

        return step

    return map_batches(df, make, schema)
