"""MinHash signatures over 5-character shingles, and their bands.

The second Arrow function of the library. Hashing every shingle under over a
hundred permutations is far too much work for row expressions, while numpy does
it as a handful of passes per batch. Bands are cut from the signature by native
expressions.

All arithmetic is modulo 2**32, so any engine with 64-bit integers can recompute
a signature:

* a shingle is folded over its code points with ``h = h * FOLD + (code + 1)`` and
  then scrambled twice with ``h = (h ^ h >> 16) * SCRAMBLE`` and a last
  ``h ^ h >> 16``;
* permutation ``i`` maps ``h`` to ``a_i * h + b_i`` with odd ``a_i``.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SHINGLE = 5
FOLD = 0x01000193
SCRAMBLE = 0x045D9F3B
SEED = "corpusq-1"

# Positions hashed together. Bounds memory for texts of any length and keeps the
# working arrays within the processor cache.
PIECE = 1 << 17


@lru_cache(maxsize=None)
def permutations(count: int) -> list[tuple[int, int]]:
    """``(a, b)`` of each permutation, drawn from a hash of the seed and its number."""
    drawn = []
    for i in range(count):
        word = hashlib.sha256(f"{SEED}:{i}".encode()).digest()
        drawn.append((int.from_bytes(word[:4], "big") | 1, int.from_bytes(word[4:8], "big")))
    return drawn


@lru_cache(maxsize=None)
def choose_bands(threshold: float, num_perm: int) -> tuple[int, int]:
    """Bands and rows per band that balance both kinds of error at ``threshold``.

    Two sets of similarity s share a band with probability 1-(1-s^r)^b. The
    choice minimises the false-positive area below the threshold plus the
    false-negative area above it, both weighing the same.
    """
    steps = 2000
    below = (np.arange(steps) + 0.5) * threshold / steps
    above = threshold + (np.arange(steps) + 0.5) * (1 - threshold) / steps
    best = None
    for bands in range(1, num_perm + 1):
        for rows in range(1, num_perm // bands + 1):
            false_positive = threshold * np.mean(1 - (1 - below**rows) ** bands)
            false_negative = (1 - threshold) * np.mean((1 - above**rows) ** bands)
            cost = false_positive + false_negative
            if best is None or cost < best[0]:
                best = (cost, bands, rows)
    return best[1], best[2]


def shingle_hashes(text: str) -> np.ndarray:
    """One 32-bit hash per shingle position; a text below five characters is one shingle."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    positions = max(1, len(codes) - SHINGLE + 1)
    h = np.zeros(positions, dtype=np.uint32)
    for offset in range(min(SHINGLE, len(codes))):
        h *= np.uint32(FOLD)
        h += codes[offset:offset + positions] + np.uint32(1)
    for _ in range(2):
        h ^= h >> np.uint32(16)
        h *= np.uint32(SCRAMBLE)
    h ^= h >> np.uint32(16)
    return h


def _pieces(text: str):
    """The text cut so that every shingle lies whole in exactly one piece."""
    for start in range(0, max(1, len(text) - SHINGLE + 1), PIECE):
        yield text[start:start + PIECE + SHINGLE - 1]


def signatures(texts: list[str], count: int) -> np.ndarray:
    """Signature rows of ``texts``, hashing neighbours together in cache-sized blocks."""
    perms = [(np.uint32(a), np.uint32(b)) for a, b in permutations(count)]
    result = np.full((len(texts), count), 0xFFFFFFFF, dtype=np.uint32)
    owners: list[int] = []
    block: list[np.ndarray] = []

    def flush() -> None:
        h = np.concatenate(block)
        starts = np.cumsum([0] + [len(b) for b in block[:-1]])
        scratch = np.empty_like(h)
        lows = np.empty((len(block), count), dtype=np.uint32)
        for i, (a, b) in enumerate(perms):
            np.multiply(h, a, out=scratch)
            scratch += b
            lows[:, i] = np.minimum.reduceat(scratch, starts)
        np.minimum.at(result, np.array(owners), lows)
        owners.clear()
        block.clear()

    held = 0
    for row, text in enumerate(texts):
        for piece in _pieces(text):
            hashes = shingle_hashes(piece)
            block.append(hashes)
            owners.append(row)
            held += len(hashes)
            if held >= PIECE:
                flush()
                held = 0
    if block:
        flush()
    return result


@lru_cache(maxsize=None)
def _signature_udf(count: int):
    def signature_batch(text: pa.Array) -> pa.Array:
        present = text.is_valid().to_pylist()
        rows = signatures(text.drop_null().to_pylist(), count).astype(np.int64)
        width = np.cumsum([0] + [count if p else 0 for p in present])
        offsets = pa.array(width, type=pa.int32(), mask=np.array([not p for p in present] + [False]))
        return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))

    signature_batch.__annotations__ = {"text": pa.Array, "return": pa.Array}
    return F.arrow_udf(signature_batch, "array<bigint>")


def signature(text: Column, num_perm: int) -> Column:
    """The lowest permuted shingle hash under each of ``num_perm`` permutations."""
    return _signature_udf(num_perm)(text)


def band_keys(sig: Column, bands: int, rows: int) -> Column:
    """One key per band: the MD5 of the band number and its signature values."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda band: F.md5(
            F.concat_ws(",", band.cast("string"),
                        F.slice(sig, band * rows + 1, rows).cast("array<string>"))
        ),
    )
