"""Sets of hashed word shingles, made batch-wise with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from corpusq.llm.batches import coded_words, filled


def mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit spread over the output."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class ShingleSets:
    """The distinct shingles of each text of a batch: text i has the hashes
    ``hashes[bounds[i]:bounds[i + 1]]``, sorted; ``first`` tells at which of the batch's words
    each was first seen.

    A to Z are lower-cased. A shingle is ``words`` words in a row, or all of a text's words
    where there are fewer; a text without words has none. Hashes have 63 bits.
    """

    def __init__(self, texts: pa.Array, words: int):
        self.words = words
        self.codes, self.vocabulary, starts = coded_words(pc.ascii_lower(filled(texts)))
        hashed = np.fromiter(map(xxhash.xxh64_intdigest, self.vocabulary.to_pylist()), np.uint64, len(self.vocabulary))
        h = hashed[self.codes]
        total = np.zeros(len(h), np.uint64)
        for k in range(min(words, len(h))):
            total[:len(h) - k] += mixed(h[k:] + np.uint64(k * 0x51ED27 + 1))
        total = (mixed(total) >> np.uint64(1)).astype(np.int64)
        self.lengths = np.diff(starts)
        sets, first = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        sizes = np.zeros(len(self.lengths), np.int64)
        for row, n in enumerate(self.lengths.tolist()):
            start = starts[row]
            if n >= words:
                own, at = np.unique(total[start:start + n - words + 1], return_index=True)
            elif n:
                place = np.arange(n, dtype=np.uint64) * np.uint64(0x51ED27) + np.uint64(n << 40)
                whole = mixed(np.array([mixed(h[start:start + n] + place).sum(dtype=np.uint64)]))
                own, at = (whole >> np.uint64(1)).astype(np.int64), np.zeros(1, np.int64)
            else:
                continue
            sizes[row] = len(own)
            sets.append(own)
            first.append(at + start)
        self.hashes, self.first = np.concatenate(sets), np.concatenate(first)
        self.sizes, self.bounds = sizes, np.concatenate([[0], np.cumsum(sizes)])

    def of(self, row: int) -> np.ndarray:
        return self.hashes[self.bounds[row]:self.bounds[row + 1]]

    def word_sums(self, weight_of: dict[str, int]) -> np.ndarray:
        """The sum of its words' weights for each shingle; 0 for a text shorter than a shingle."""
        weight = np.fromiter((weight_of.get(w, 0) for w in self.vocabulary.to_pylist()), np.int64, len(self.vocabulary))[self.codes]
        sums = np.zeros(len(weight), np.int64)
        for k in range(min(self.words, len(weight))):
            sums[:len(weight) - k] += weight[k:]
        return np.where(np.repeat(self.lengths < self.words, self.sizes), 0, sums[self.first])
