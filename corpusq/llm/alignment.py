"""Cross-tokenizer alignment: which tokens of one vocabulary cover the bytes of which of another.

Each text is encoded twice: " " + text by a byte-level BPE (A), text by a SentencePiece BPE
that puts its own space in front (B). Both then cover the same bytes. Offsets where a token
of A and a token of B both end cut the text into groups; every A token of a group links with
every B token of it. How many documents hold an id pair linked is counted corpus-wide.

Texts are cut before lone spaces (white space on neither side), where a token of A and one of
B always end: A's splitting never reaches from a character to a space after it, and no piece
of B holds its space mark after another character (checked against the vocabulary at hand).
What lies between is aligned once and remembered per worker, up to ``REMEMBERED`` parts, in one
Arrow table with a row a part (when it is full, the parts of the slice at hand stay); groups of
a text are those of its parts in order, and its links their sum. A text with U+2581, NUL or a
part whose bytes do not come back is aligned whole.

The work inside a task is columnar, on Arrow arrays of a whole batch:

* the id lists of all texts are flattened, with parent indices telling each token's text;
* byte lengths come from a table per vocabulary, and a segmented cumulative sum (the running
  total less the total at the start of its text) gives every token's end offset;
* an Acero hash join on (text, end offset) keys finds the ends both share;
* a search among the shared ends gives every token its group; distinct ids are counted per
  group and joined on the group (Acero again), so a pair's occurrences in a text are the
  product of its ids' counts, and a long group costs its distinct ids, not its tokens squared;
* ``Table.group_by`` folds links into (text, A id, B id, occurrences) and then into partial
  counts (A id, B id, texts of the batch); Spark sums the partial counts of all batches, finds
  each A id's highest count and joins the counts back to the links of each text.

Defined cases: texts that are null, empty, or whose joined A or B bytes differ from the UTF-8
of " " + text (a normaliser changed it, or an unknown piece stood in) have no tokens: all
counts 0, ``groups_sha256`` ''. Every row is a document of its own: repeated rows are counted
as often as they occur, a null doc_id is carried as it is. An empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusq.llm.batches import filled, map_slices
from corpusq.llm.token_counts import stable_vocabulary
from corpusq.session import written

LINK = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
PART = pa.schema([("good", pa.bool_()), *((k, pa.int64()) for k in COUNTS), ("groups", pa.string()), ("links", pa.list_(LINK))])
SCHEMA = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "links array<struct<a:int,b:int,n:long>>, pa int, pb int, pn long")
BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
SPACE_MARK = "▁"  # fixed value: how SentencePiece writes a space


def _byte_level_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level BPE vocabularies.

    Bytes that print as themselves ('!' to '~', and the Latin-1 ranges from U+00A1 to U+00AC and
    from U+00AE to U+00FF) stand for themselves; the others take the code points from 256 on,
    in rising byte order.
    """
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    alphabet, extra = {}, 0
    for byte in range(256):
        if byte in own:
            alphabet[chr(byte)] = byte
        else:
            alphabet[chr(256 + extra)] = byte
            extra += 1
    return alphabet


@lru_cache(maxsize=2)
def _a_model(path: str):
    # Spark's tasks share out the cores; threads inside one only add to the CPU time.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    alphabet = _byte_level_alphabet()
    size = model.get_vocab_size(with_added_tokens=True)
    pieces = [b""] * size
    for token, i in model.get_vocab(with_added_tokens=True).items():
        if all(c in alphabet for c in token):
            pieces[i] = bytes(alphabet[c] for c in token)
        else:  # no byte-level spelling: joined bytes will not match and the text is left out
            pieces[i] = token.encode("utf-8")
    return model, pieces, np.array([len(p) for p in pieces], np.int64)


@lru_cache(maxsize=2)
def _b_model(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = BYTE_PIECE.fullmatch(piece) if model.is_byte(i) else None
        if byte:
            pieces.append(bytes([int(byte.group(1), 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            pieces.append(b"")
        else:
            pieces.append(piece.replace(SPACE_MARK, " ").encode("utf-8"))
    return model, pieces, np.array([len(p) for p in pieces], np.int64)


@lru_cache(maxsize=2)
def _spellings(a_path: str, b_path: str) -> tuple[pa.Array, pa.Array]:
    """The bytes of every id of A and of B."""
    return pa.array(_a_model(a_path)[1], pa.binary()), pa.array(_b_model(b_path)[1], pa.binary())


def _lists(ids: list[list[int]]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))]).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _a_encoded(texts: list[str], wants: pa.Array, model, lengths: np.ndarray) -> pa.ListArray:
    """A's ids of " " + each text, whose bytes are ``wants``.

    Texts with white space at neither end are encoded in one go, each after a lone space, where
    a token always ends, and told apart by their bytes: most texts here are single words, and
    to the library a text costs more than a word. The fast encoding leaves out the offsets of
    tokens, which byte lengths give here."""
    edged = np.fromiter((not t or t[0].isspace() or t[-1].isspace() for t in texts), bool, len(texts))
    order = np.argsort(edged, kind="stable")
    some, other = ([texts[i] for i in part.tolist()] for part in np.split(order, [int((~edged).sum())]))
    lists = _lists([e.ids for e in model.encode_batch_fast([" " + t for t in other], add_special_tokens=False)])
    if some:
        flat = np.array(model.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, np.int32)
        ends = np.concatenate([[0], np.cumsum(lengths[flat])])
        bounds = np.concatenate([[0], np.cumsum(pc.binary_length(wants).to_numpy()[order[:len(some)]])])
        offsets = np.searchsorted(ends, bounds)
        if ends[-1] == bounds[-1] and np.array_equal(ends[offsets], bounds):
            first = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
        else:
            first = _lists([e.ids for e in model.encode_batch_fast([" " + t for t in some], add_special_tokens=False)])
        lists = pa.concat_arrays([first, lists])
    return lists.take(pa.array(np.argsort(order))) if other and some else lists


def _spelled(ids: pa.ListArray, spelling: pa.Array) -> pa.Array:
    """The bytes that the tokens of each text spell."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, spelling.take(ids.flatten())), b"")


def _ends(ids: pa.ListArray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent, id, end): each token's text, id and end offset by a segmented cumulative sum."""
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    parent = pc.list_parent_indices(ids).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(lengths[flat])
    offsets = ids.offsets.to_numpy()
    before = np.concatenate([[0], total])[offsets[:-1]]
    return parent, flat, total - before[parent]


SEPARATORS = pa.array([",", "|", ";", ""])  # fixed values: within a side, A to B, group to group, end


def _groups_texts(n: int, pa_: np.ndarray, ida: np.ndarray, ga: np.ndarray,
                  pb_: np.ndarray, idb: np.ndarray, gb: np.ndarray) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` of every text, built with Arrow kernels: all ids of the batch in
    order (group, A before B, place), each followed by its separator, joined per text."""
    group = np.concatenate([ga, gb])
    side = np.concatenate([np.zeros(len(ga), np.int8), np.ones(len(gb), np.int8)])
    order = np.argsort(2 * group + side, kind="stable")
    ids = np.concatenate([ida, idb])[order]
    group, side = group[order], side[order]
    text = np.concatenate([pa_, pb_])[order]
    last = np.ones(len(ids), bool)
    last[:-1] = text[1:] != text[:-1]
    code = np.where(last, 3, np.where(np.append(group[1:] != group[:-1], True), 2,
                                      np.where(np.append(side[1:] != side[:-1], True), 1, 0)))
    separators = pa.DictionaryArray.from_arrays(pa.array(code.astype(np.int8)), SEPARATORS).cast(pa.string())
    pieces = pc.binary_join_element_wise(pc.cast(pa.array(ids), pa.string()), separators, "")
    offsets = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), pieces), "")


def _aligned(texts: list[str], a_path: str, b_path: str) -> dict:
    """Counts, groups string and links (sorted by text) of each text; ``good`` tells which keep tokens."""
    a_model, _, a_len = _a_model(a_path)
    b_model, _, b_len = _b_model(b_path)
    n = len(texts)
    wants = pa.array([" " + t for t in texts], pa.string()).cast(pa.binary())
    good = np.fromiter(map(bool, texts), bool, n)
    a_lists = _a_encoded(texts, wants, a_model, a_len)
    b_lists = _lists(b_model.encode(texts, num_threads=1) if n else [])
    for lists, spelling in zip((a_lists, b_lists), _spellings(a_path, b_path)):
        good &= pc.equal(_spelled(lists, spelling), wants).to_numpy(zero_copy_only=False)
    if not good.all():  # left-out texts keep no tokens: everything below sees empty lists for them
        a_lists, b_lists = (_lists([x if g else [] for x, g in zip(lists.to_pylist(), good)]) for lists in (a_lists, b_lists))
    pa_, ida, enda = _ends(a_lists, a_len)
    pb_, idb, endb = _ends(b_lists, b_len)
    shared = pa.table({"row": pa_, "end": enda}).join(
        pa.table({"row": pb_, "end": endb}), keys=["row", "end"], join_type="inner", use_threads=False)
    scale = np.int64(1) << 40  # offsets of one text stay far below 2^40
    cuts = np.sort(shared.column("row").to_numpy() * scale + shared.column("end").to_numpy())
    ga = np.searchsorted(cuts, pa_ * scale + enda)
    gb = np.searchsorted(cuts, pb_ * scale + endb)
    # Links without forming them one by one: per group, each distinct A id meets each distinct
    # B id (an Acero hash join on the group), as often as their counts multiply. A long group
    # costs its distinct ids, not its tokens squared.
    a_counts = pa.table({"g": ga, "a": ida.astype(np.int32)}).group_by(["g", "a"], use_threads=False).aggregate([([], "count_all")])
    b_counts = pa.table({"g": gb, "b": idb.astype(np.int32)}).group_by(["g", "b"], use_threads=False).aggregate([([], "count_all")])
    met = a_counts.rename_columns(["g", "a", "ca"]).join(b_counts.rename_columns(["g", "b", "cb"]), keys="g", use_threads=False)
    text_of_group = (cuts // scale).astype(np.int64)
    links = pa.table({
        "row": text_of_group[met.column("g").to_numpy()], "a": met.column("a"), "b": met.column("b"),
        "n": pc.multiply(met.column("ca"), met.column("cb"))})
    per_text = links.group_by(["row", "a", "b"], use_threads=False).aggregate([("n", "sum")]).sort_by("row")
    per_group = np.bincount(ga, minlength=len(cuts)) * np.bincount(gb, minlength=len(cuts))
    return {
        "good": good, "n_a": np.bincount(pa_, minlength=n), "n_b": np.bincount(pb_, minlength=n),
        "n_groups": np.bincount(text_of_group, minlength=n),
        "n_links": np.bincount(text_of_group, weights=per_group, minlength=n).astype(np.int64),
        "groups": _groups_texts(n, pa_, ida, ga, pb_, idb, gb),
        "row": per_text.column("row").to_numpy(), "a": per_text.column("a").to_numpy().astype(np.int64),
        "b": per_text.column("b").to_numpy().astype(np.int64), "n": per_text.column("n_sum").to_numpy()}


class Segments:
    """Alignments of the parts between lone spaces, remembered per worker.

    ``parts`` has a row (see ``PART``) for each part remembered, ``place`` its number. ``good``
    is false where the bytes of a part do not come back. The memory only saves work."""

    def __init__(self, a_path: str, b_path: str):
        self.paths, self.stable = (a_path, b_path), stable_vocabulary(b_path)
        self.place: dict[str, int] = {}
        self.parts = PART.empty_table()

    def _resolve(self, parts: list[str]) -> tuple[pa.Table, np.ndarray]:
        """A table of parts, and in which of its rows each of these (different) parts is."""
        before = self.parts.num_rows
        at = np.fromiter((self.place.get(p, -1) for p in parts), np.int64, len(parts))
        missing = np.flatnonzero(at < 0)
        if not len(missing):
            return self.parts, at
        at[missing] = before + np.arange(len(missing))
        found = _as_parts(_aligned([parts[i] for i in missing.tolist()], *self.paths))
        table = pa.concat_tables([self.parts, found]).combine_chunks()
        short = [i for i in missing.tolist() if len(parts[i]) <= LONGEST]
        if before + len(short) <= REMEMBERED:
            self.place.update((parts[i], before + k) for k, i in enumerate(short))
            self.parts = table if len(short) == len(missing) else table.take(np.concatenate([np.arange(before), at[short]]))
        else:  # full: what this slice holds stays, known parts first
            held = ([*np.flatnonzero(at < before).tolist(), *short])[:REMEMBERED]
            self.place = {parts[i]: k for k, i in enumerate(held)}
            self.parts = table.take(at[held])
        return table, at

    def aligned(self, texts: pa.Array) -> dict:
        """As ``_aligned``, for texts of which ``whole`` tells which have to be taken whole."""
        n = len(texts)
        whole = pc.match_substring_regex(texts, f"[\x00{SPACE_MARK}]").to_numpy(zero_copy_only=False) | (not self.stable)
        odd = pc.match_substring_regex(texts, ODD_SPACE).to_numpy(zero_copy_only=False)
        plain = pc.replace_substring(texts, " ", "\x00")
        if odd.any():
            plain = pa.array([LONE_SPACE.sub("\x00", t) if o else p for t, o, p in
                              zip(texts.to_pylist(), odd.tolist(), plain.to_pylist())], pa.string())
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False) | whole
        lists = pc.split_pattern(pc.if_else(pa.array(empty), pa.scalar(None, pa.string()), plain), "\x00")
        coded = lists.flatten().dictionary_encode()
        parts, place = self._resolve(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        code = place[coded.indices.to_numpy(zero_copy_only=False)]
        row = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        # A text with a part whose bytes do not come back is taken whole.
        whole[row[~_column(parts, "good").to_numpy(zero_copy_only=False)[code]]] = True
        on = ~whole[row]
        row, code = row[on], code[on]
        columns = {}
        for name in COUNTS:
            columns[name] = np.bincount(row, weights=_column(parts, name).to_numpy()[code], minlength=n).astype(np.int64)
        strings = _column(parts, "groups").take(pa.array(code))
        offsets = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
        columns["groups"] = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), strings), ";")
        # Links of each text's distinct parts, as often as the part occurs in it.
        links = _column(parts, "links")
        pool_a, pool_b, pool_n = (x.to_numpy().astype(np.int64) for x in links.flatten().flatten())
        start = links.offsets.to_numpy().astype(np.int64) - links.offsets[0].as_py()
        size, start = np.diff(start), start[:-1]
        pair, times = np.unique(row * max(1, len(size)) + code, return_counts=True)
        row, code = pair // max(1, len(size)), pair % max(1, len(size))
        length = size[code]
        ends = np.cumsum(length)
        at = np.repeat(start[code] - (ends - length), length) + np.arange(int(length.sum()))
        key = (np.repeat(row, length) << 40) + (pool_a[at] << 20) + pool_b[at]  # ids stay below 2^20
        link, inverse = np.unique(key, return_inverse=True)
        n_link = np.bincount(inverse, weights=pool_n[at] * np.repeat(times, length), minlength=len(link)).astype(np.int64)
        return columns | {"whole": whole, "row": link >> 40, "a": (link >> 20) & 0xFFFFF, "b": link & 0xFFFFF, "n": n_link}


@lru_cache(maxsize=2)
def _segments(a_path: str, b_path: str) -> Segments:
    return Segments(a_path, b_path)


def _column(table: pa.Table, name: str) -> pa.Array:
    """A column in one piece."""
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def _links(found: dict, n: int) -> pa.ListArray:
    """The links of each of n texts."""
    offsets = np.searchsorted(found["row"], np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(found["a"], pa.int32()), pa.array(found["b"], pa.int32()), pa.array(found["n"], pa.int64())], fields=list(LINK)))


def _as_parts(found: dict) -> pa.Table:
    """What ``_aligned`` found, as rows of ``PART``."""
    n = len(found["good"])
    return pa.table([pa.array(found["good"]), *(pa.array(found[k], pa.int64()) for k in COUNTS), found["groups"], _links(found, n)], schema=PART)


def _as_batch(rows: pa.Array, doc_ids: pa.Array, found: dict) -> pa.RecordBatch:
    """One row per text with its counts and links, then one row per partial pair count."""
    n = len(rows)
    digests = [hashlib.sha256(t.encode()).hexdigest() if k else "" for t, k in zip(found["groups"].to_pylist(), found["n_a"].tolist())]
    pairs, texts = np.unique((found["a"] << 20) + found["b"], return_counts=True)
    m = len(pairs)
    nulls = lambda kind, k: pa.nulls(k, kind)
    texts_part = pa.RecordBatch.from_arrays([
        rows.cast(pa.int64()), doc_ids.cast(pa.int64()), *(pa.array(found[k], pa.int64()) for k in COUNTS),
        pa.array(digests, pa.string()), _links(found, n),
        nulls(pa.int32(), n), nulls(pa.int32(), n), nulls(pa.int64(), n)], names=_NAMES)
    counts_part = pa.RecordBatch.from_arrays([
        nulls(pa.int64(), m), nulls(pa.int64(), m), *(nulls(pa.int64(), m) for _ in range(4)), nulls(pa.string(), m),
        nulls(pa.list_(LINK), m), pa.array(pairs >> 20, pa.int32()), pa.array(pairs & 0xFFFFF, pa.int32()),
        pa.array(texts, pa.int64())], names=_NAMES)
    return pa.Table.from_batches([texts_part, counts_part]).combine_chunks().to_batches()[0]


def align_slice(batch: pa.RecordBatch, a_path: str, b_path: str) -> pa.RecordBatch:
    """Texts by their remembered parts; those that cannot be cut, whole."""
    texts = filled(batch.column("text"))
    found = _segments(a_path, b_path).aligned(texts)
    out = []
    for whole in (False, True):
        at = np.flatnonzero(found["whole"] == whole)
        if not len(at):
            continue
        rows, ids = batch.column("row").take(pa.array(at)), batch.column("doc_id").take(pa.array(at))
        if whole:
            out.append(_as_batch(rows, ids, _aligned(texts.take(pa.array(at)).to_pylist(), a_path, b_path)))
        else:
            of = {k: found[k][at] for k in COUNTS}
            of |= {"groups": found["groups"].take(pa.array(at)), "row": np.searchsorted(at, found["row"])}
            out.append(_as_batch(rows, ids, of | {k: found[k] for k in "abn"}))
    return pa.Table.from_batches(out).combine_chunks().to_batches()[0]


SLICE_BYTES = 1 << 20
REMEMBERED = 300_000
LONGEST = 64  # characters of a part that is remembered
# A lone space between characters that are not white space; Arrow's pattern finds texts with others.
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_WHITE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
ODD_SPACE = rf"(^|[{_WHITE}]) | ([{_WHITE}]|$)"


_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of docs."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")

    def make():
        return lambda batch: align_slice(batch, a_path, b_path)

    both = written(map_slices(numbered, make, SCHEMA, SLICE_BYTES), "alignment")
    texts = both.filter("pa is null")
    counts = (both.filter("pa is not null").groupBy("pa", "pb").agg(F.sum("pn").alias("count"))
              .select(F.col("pa").alias("a"), F.col("pb").alias("b"), "count",
                      F.max("count").over(Window.partitionBy("pa")).alias("best")))
    linked = texts.select("row", F.inline("links")).join(counts, ["a", "b"])
    sums = linked.groupBy("row").agg(
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
        F.sum(F.when(F.col("count") == F.col("best"), F.col("n")).otherwise(0)).alias("n_best"))
    return texts.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
