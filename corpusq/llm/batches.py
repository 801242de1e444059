"""Arrow batches inside Spark tasks: texts as words coded by a per-batch vocabulary.

Work per distinct word of a batch instead of per word keeps Python out of the inner loop.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def filled(column: pa.Array) -> pa.Array:
    """A text column with nulls as empty texts."""
    return pc.fill_null(column, "")


def coded_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(codes, vocabulary, bounds): text i has the words ``vocabulary[codes[bounds[i]:bounds[i + 1]]]``.

    Words are runs of anything but ASCII white space.
    """
    lists = pc.ascii_split_whitespace(filled(texts))
    found = lists.flatten().dictionary_encode()
    codes = found.indices.to_numpy(zero_copy_only=False)
    counts = np.diff(lists.offsets.to_numpy())
    blank = pc.index(found.dictionary, "").as_py()
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if blank >= 0:  # white space at a text's ends leaves empty words
        real = codes != blank
        bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
        codes = codes[real]
    return codes, found.dictionary, bounds


SLICE_BYTES = 1 << 21


def sliced(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text, or one row: what a worker holds
    beside the batch is then bounded, whatever Spark hands it."""
    sizes = pc.binary_length(filled(batch.column("text"))).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    yield batch.slice(start)


def map_slices(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str,
               limit: int = SLICE_BYTES) -> DataFrame:
    """``df``, which has a column ``text``, through a function of one slice (see ``sliced``),
    which ``make`` sets up once a task. Arrow's unused memory goes back at the end of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                for part in sliced(batch, limit):
                    yield step(part)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """``df`` through a function of one batch, which ``make`` sets up once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return df.mapInArrow(run, schema)
