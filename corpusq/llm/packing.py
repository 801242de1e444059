"""Best-fit packing of tokenized documents into sequences of a fixed length.

Documents are tokenized where they lie and cut into pieces no longer than a sequence. Pieces
are dealt in turn to groups of bounded size, and each group is packed by best-fit
decreasing: a segment tree over remaining capacities finds the tightest open sequence in
logarithmic time. A group leaves at most about one sequence part-filled, so splitting the
work costs next to nothing, whatever the corpus.

Encodings of the parts between spaces are independent under this tokenizer (its splits
never reach across white space), so they are remembered per worker, up to ``REMEMBERED``.

Defined cases: null and empty texts are documents of the end token alone. Repeated rows and
ids are separate documents. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import islice
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.llm.batches import filled, map_slices
from corpusq.session import written

SEQUENCE = 2048
END_ID = 0
GROUP_PIECES = 100_000
REMEMBERED = 500_000
AT_ONCE = 5_000  # parts handed to the tokenizer at once


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as they are, others moved up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(moved)}


BYTE_LETTERS = _byte_letters()
SIMPLE_TAIL = ".,;:!?"


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers, remembered per part."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        """Ids of what the tokenizer's splitting leaves as one word."""
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            spelled = word.encode().decode("latin-1").translate(BYTE_LETTERS)
            found = self.words[word] = np.array(
                [t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()
        return found

    def _encoded(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts not remembered. Letters (Latin ones, where case and form are simple) with
        closing punctuation are one word or two; anything else takes the whole tokenizer."""
        found, others = {}, []
        for part in parts:
            letters = part.rstrip(SIMPLE_TAIL)
            lower = letters.lower()
            if lower.isalpha() and max(letters) < "ɐ":
                tail = part[len(letters):]
                found[part] = self._word(lower) + (self._word(tail) if tail else b"")
            else:
                others.append(part)
        for start in range(0, len(others), AT_ONCE):
            some = others[start:start + AT_ONCE]
            for part, encoding in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False)):
                found[part] = np.array(encoding.ids, "<u4").tobytes()
        return found

    def _resolve(self, parts: list[str]) -> list[bytes]:
        """Ids of each part. The memory only saves work: it is cleared and filled after all parts
        have been looked up, so a batch may hold any number of them."""
        known = self.parts
        own = self._encoded([p for p in parts if p not in known])
        each = [own[p] if p in own else known[p] for p in parts]
        if len(known) + len(own) > REMEMBERED:
            known.clear()
        known.update(islice(own.items(), REMEMBERED))
        return each

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text i has ``ids[bounds[i]:bounds[i + 1]]``."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        parts = coded.dictionary.to_pylist()
        each = self._resolve(parts)
        pool = np.frombuffer(b"".join(each), "<u4")
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(each) else np.zeros(0, np.int64)
        at = coded.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.repeat(starts[at] - (ends - lengths), lengths) + np.arange(total)]
        return ids, np.concatenate([[0], ends])[lists.offsets.to_numpy()]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(df: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) and, if asked for, ``ids`` of every piece."""
    def make():
        encoder = _encoder(tokenizer_path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, bounds = encoder.encode(filled(batch.column("text")))
            rows, pieces, starts, lengths, sums, kept = [], [], [], [], [], []
            for row in range(batch.num_rows):
                own = np.append(ids[bounds[row]:bounds[row + 1]], np.uint32(END_ID)).astype("<u4")
                for number, start in enumerate(range(0, len(own), sequence)):
                    piece = own[start:start + sequence]
                    rows.append(row)
                    pieces.append(number)
                    starts.append(start)
                    lengths.append(len(piece))
                    sums.append(zlib.crc32(piece))
                    if with_ids:
                        kept.append(piece.astype(np.int32))
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())), "piece": pa.array(pieces, pa.int32()),
                "start": pa.array(starts, pa.int64()), "length": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
            } | ({"ids": pa.array(kept, pa.list_(pa.int32()))} if with_ids else {})
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return step

    kind = dict(df.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return map_slices(df.select("doc_id", "text"), make, schema)


class OpenSequences:
    """Open sequences by remaining capacity; a node of the tree tells whether any sequence
    with a capacity below it is open."""

    def __init__(self, sequence: int):
        self.leaves = 1 << sequence.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(sequence + 1)]

    def put(self, number: int, capacity: int) -> None:
        if not self.open[capacity]:
            node = capacity + self.leaves
            while node and not self.some[node]:
                self.some[node] = 1
                node >>= 1
        self.open[capacity].append(number)

    def take(self, length: int) -> tuple[int, int] | None:
        """(number, capacity) of an open sequence with the least capacity that holds ``length``."""
        some, node = self.some, length + self.leaves
        if not some[node]:
            while node & 1 or not some[node + 1]:  # up until something open lies to the right
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node = 2 * node if some[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        number = self.open[capacity].pop()
        if not self.open[capacity]:
            some[node] = 0
            while node > 1 and not some[node ^ 1]:
                node >>= 1
                some[node] = 0
        return number, capacity


def best_fit(lengths: np.ndarray, sequence: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of each piece; ``lengths`` come in descending order."""
    numbers, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree, opened = OpenSequences(sequence), 0
    for i, length in enumerate(lengths.tolist()):
        found = tree.take(length)
        if found is None:
            found, opened = (opened, sequence), opened + 1
        number, capacity = found
        numbers[i], offsets[i] = number, sequence - capacity
        if capacity > length:
            tree.put(number, capacity - length)
    return numbers, offsets


def pack(pieces: DataFrame, sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. Pieces are written to the shared folder
    first: the number of groups needs their count, and dealing needs them in a fixed order."""
    held = written(pieces, "pieces")
    groups = max(1, ceil(held.count() / group_pieces))
    dealt = held.withColumn("group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    names = pieces.columns

    def pack_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        number, offset = best_fit(rows["length"].to_numpy(), sequence)
        return rows.assign(sequence_id=rows["group"].to_numpy() * 2**32 + number, offset=offset)[[*names, "sequence_id", "offset"]]

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("group").applyInPandas(pack_group, f"{kinds}, sequence_id long, offset long")
