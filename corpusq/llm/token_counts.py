"""Token counts of whole texts, huge ones by overlap resynchronisation.

A huge text is cut into chunks that overlap. Each chunk is encoded with the offsets of its
tokens; two neighbours are spliced at a boundary inside their overlap that both encodings
have and that is stable by proof: no vocabulary piece reaches across it, so no merge on one
side depends on the other. Where an overlap holds no such boundary it is widened, in the
end to the whole rest of the text. Counts are thus exactly those of encoding at one go.

Boundaries are stable before a line feed (no piece holds one) and before a space that
follows neither space nor the vocabulary's own space mark (no piece holds the mark after
another character); ``stable_vocabulary`` checks both facts against the vocabulary at hand
and without them nothing is cut. Texts cut at such places repeat the same short segments
over and over, so segment counts are remembered, up to ``REMEMBERED`` of them per worker.

Defined cases: null and empty texts have no bytes and no tokens. Rows come back one for
one, repeated ones included; extra columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from corpusq.llm.batches import filled, map_batches

# Characters: above the first a text is huge and cut into chunks that overlap by the second.
CHUNK = 16_384
OVERLAP = 256
REMEMBERED = 600_000
AT_ONCE = 50_000  # segments handed to the model at once
LIMIT = 4096
MARK = "\u2581"  # fixed value: how the vocabulary writes a space

STABLE = re.compile(rf"\n|(?<=[^ {MARK}\n]) ")


@lru_cache(maxsize=2)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def stable_vocabulary(path: str) -> bool:
    """Whether no piece holds a line feed, or the space mark after another character."""
    model = _processor(path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return not any("\n" in p or re.search(f"[^{MARK}]{MARK}", p) for p in pieces)


def stable_boundaries(text: str, start: int, end: int) -> list[int]:
    """Places strictly inside ``text[start:end]`` before which no token can reach back."""
    return [m.start() for m in STABLE.finditer(text, start, end) if m.start() > start]


class Counter:
    """Counts tokens with one model; remembers the counts of segments."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.model, self.stable = _processor(path), stable_vocabulary(path)
        self.chunk, self.overlap = chunk, overlap
        self.known: dict[str, int] = {}
        # What encoding adds before a text: a lone mark, when the text opens with a line feed.
        self.lead = len(self.model.encode("\n")) - len(self.model.encode("\n\n")) + len(self.model.encode("\n"))

    def _resolve(self, segments: list[str]) -> list[int]:
        """Tokens of each segment. The memory only saves work: it is cleared and filled after all
        segments have been looked up, so a batch may hold any number of them."""
        known, own = self.known, {}
        missing = [s for s in segments if s not in known]
        for start in range(0, len(missing), AT_ONCE):
            some = missing[start:start + AT_ONCE]
            own.update(zip(some, map(len, self.model.encode(some, num_threads=1))))
        each = [own[s] if s in own else known[s] for s in segments]
        if len(known) + len(own) > REMEMBERED:
            known.clear()
        known.update(islice(own.items(), REMEMBERED))
        return each

    def count_all(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        counts = np.zeros(len(texts), np.int64)
        lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        marked = pc.match_substring(texts, MARK).to_numpy(zero_copy_only=False)
        huge = lengths > self.chunk
        for i in np.flatnonzero(huge | marked | (not self.stable)):
            text = texts[int(i)].as_py()
            counts[i] = self.count_huge(text) if huge[i] and self.stable else len(self.model.encode(text))
        rest = np.flatnonzero(~huge & ~marked & self.stable & (lengths > 0))
        if len(rest):
            counts[rest] = self._count_by_segments(texts.take(pa.array(rest)))
        return counts

    def _count_by_segments(self, texts: pa.Array) -> np.ndarray:
        """Texts without the space mark: cut before line feeds and before single spaces.

        A segment after a space is encoded without it, since encoding puts one in front; a
        segment that opens with a line feed gets a lone mark in front, which is taken off.
        """
        cut = pc.replace_substring(texts, "\n", "\x00\n")
        # A space is a cut if a lone one; in runs the first is, and the others stay with the word.
        cut = pc.replace_substring_regex(cut, r"([^ \n\x00]) ", "\\1\x00")
        zero = pc.match_substring(texts, "\x00").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(cut, "\x00")
        coded = lists.flatten().dictionary_encode()
        segments = coded.dictionary.to_pylist()
        tokens = self._resolve(segments)
        # An empty segment is a space with nothing after it, or the mark before a text that
        # opens with a line feed: a lone mark either way.
        each = np.fromiter(
            (n - self.lead * s.startswith("\n") if s else self.lead for s, n in zip(segments, tokens)), np.int64, len(segments))
        bounds = lists.offsets.to_numpy()
        sums = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy(zero_copy_only=False)])])
        counts = sums[bounds[1:]] - sums[bounds[:-1]]
        for i in np.flatnonzero(zero):
            counts[i] = len(self.model.encode(texts[int(i)].as_py()))
        return counts

    def _offsets(self, text: str, start: int, end: int) -> np.ndarray:
        """Where the tokens of ``text[start:end]`` begin, in ``text``. The mark that encoding
        puts before a chunk stands for the space that opens it, or else is set aside."""
        first = start > 0 and text[start] == " "
        piece = text[start + first:end]
        # The library gives places in UTF-8 bytes.
        opens = (np.frombuffer(piece.encode(), np.uint8) & 0xC0) != 0x80
        place = np.concatenate([np.cumsum(opens) - 1, [len(piece)]])
        begins = place[[p.begin for p in self.model.encode(piece, return_type="proto").pieces]] if piece else np.zeros(1, np.int64)
        if first:
            return np.concatenate([[start], begins[1:] + start + 1])
        if start > 0 and text[start] == "\n":
            begins = begins[self.lead:]
        return begins + start

    def count_huge(self, text: str) -> int:
        """Tokens of one text, chunk by chunk."""
        total, start = 0, 0
        while True:
            end, overlap = min(len(text), start + self.chunk), self.overlap
            splice = None
            left = self._offsets(text, start, end)
            while end < len(text):
                # The next chunk opens at a stable place of the overlap; both must have a token
                # begin at a later stable place, and that is where they are joined.
                low = max(start + 1, end - overlap)
                places = stable_boundaries(text, low, end)
                if len(places) >= 2:
                    begun = set(left[left >= places[0]].tolist())
                    right = set(self._offsets(text, places[0], min(len(text), end)).tolist())
                    splice = next((p for p in places[1:] if p in begun and p in right), None)
                    if splice is not None:
                        break
                if low > start + 1:
                    overlap *= 2  # widen to the left within the chunk, then by longer chunks
                else:
                    end = min(len(text), end + max(self.chunk, end - start))
                    left = self._offsets(text, start, end)
            if splice is None:
                return total + len(left)
            total += int((left < splice).sum())
            start = splice


def count_tokens(df: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row's ``text``."""
    def make():
        counter = _counter(model_path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = filled(batch.column("text"))
            n = counter.count_all(texts)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

        return step

    kind = dict(df.dtypes)["doc_id"]
    return map_batches(df.select("doc_id", "text"), make, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(path)
