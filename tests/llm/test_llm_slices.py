"""What a Python worker holds is bounded, and remembered parts give what whole texts give."""
import random

import numpy as np
import public_tokenizers
import pyarrow as pa

from corpusq.llm import batches


def test_slices_bound_the_text_of_a_step():
    texts = ["x" * 100, None, "y" * 900, "z" * 5000, "", "é" * 300, "w"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(batches.sliced(batch, 1000))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column("text").to_pylist()) <= 1000 for p in parts)
    assert [p.num_rows for p in parts] == [3, 1, 3]


def test_packing_meets_large_batches_in_slices(monkeypatch):
    """The encoder never meets more text at once than a slice, whatever a batch holds."""
    from corpusq.llm import packing

    met, encode = [], packing.Encoder.encode
    monkeypatch.setattr(packing.Encoder, "encode", lambda self, texts: (
        met.append(sum(len(t) for t in texts.to_pylist())), encode(self, texts))[1])

    class Rows:  # stands for a DataFrame whose one batch holds 6 MB of text
        dtypes = [("doc_id", "bigint"), ("text", "string")]

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            texts = pa.array([f"word{i} " * 30_000 for i in range(30)])
            return list(run(iter([pa.RecordBatch.from_arrays([pa.array(range(30)), texts], names=["doc_id", "text"])])))

    out = packing.cut(Rows(), public_tokenizers.path("word_bpe_49k.json"))
    assert {i for b in out for i in b.column("doc_id").to_pylist()} == set(range(30))
    assert max(met) <= 1 << 21


def test_parts_give_what_whole_texts_give():
    from corpusq.llm import alignment

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    rng = random.Random(5)
    pieces = ["the", "Straße", "<|endoftext|>", "<s>", "\n", " ", "  ", "東京", "　", "\x85", "\x1c", "\x00", "▁", "\t", "it's", "12"]
    texts = ["", " "] + ["".join(rng.choice(pieces + [" "] * 9) for _ in range(rng.randint(1, 40))) for _ in range(500)]
    segments = alignment.Segments(*paths)
    for _ in range(2):  # the second time from memory
        cut, whole = segments.aligned(pa.array(texts)), alignment._aligned(texts, *paths)
        at = [i for i in range(len(texts)) if not cut["whole"][i]]
        assert len(at) > 100
        links = lambda x, i: sorted((a, b, n) for r, a, b, n in zip(*(x[k].tolist() for k in ("row", "a", "b", "n"))) if r == i)
        for i in at:
            assert [cut[k][i] for k in ("n_a", "n_b", "n_groups", "n_links", "groups")] == [
                whole[k][i] for k in ("n_a", "n_b", "n_groups", "n_links", "groups")]
            assert links(cut, i) == links(whole, i)


def test_a_repeated_part_is_aligned_once(monkeypatch):
    from corpusq.llm import alignment

    met, aligned = [], alignment._aligned
    monkeypatch.setattr(alignment, "_aligned", lambda texts, *p: (met.extend(texts), aligned(texts, *p))[1])
    segments = alignment.Segments(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    for _ in range(3):
        segments.aligned(pa.array(["some words and some words", "and words"]))
    assert sorted(met) == ["and", "some", "words"]


def test_parts_reach_the_library_in_one_go(monkeypatch):
    """A text costs the library more than a word: parts without white space at an end go as one."""
    from corpusq.llm import alignment

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    real, met = alignment._a_model(paths[0]), []

    class Spy:
        def __getattr__(self, name):
            return lambda texts, **options: (met.extend(texts), getattr(real[0], name)(texts, **options))[1]

    monkeypatch.setattr(alignment, "_a_model", lambda path: (Spy(), *real[1:]))
    found = alignment.Segments(*paths).aligned(pa.array(["one two three it's", "two 's four\n", "five"]))
    assert sorted(met) == [" four\n", " one two three it's 's five"]
    ids = [[i for part in text.split(" ") for i in real[0].encode(" " + part, add_special_tokens=False).ids]
           for text in ("one two three it's", "two 's four\n", "five")]
    assert found["n_a"].tolist() == [len(x) for x in ids]


def test_a_text_whose_joined_tokens_do_not_part_is_encoded_alone():
    from corpusq.llm import alignment

    model, _, lengths = alignment._a_model(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["one", " two", "", "three", "x\n"]
    wants = pa.array([(" " + t).encode() for t in texts])
    own = [model.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert alignment._a_encoded(texts, wants, model, lengths).to_pylist() == own
    assert alignment._a_encoded(texts, wants, model, lengths * 2).to_pylist() == own  # bytes that do not add up
    assert alignment._a_encoded([], wants[:0], model, lengths).to_pylist() == []


def test_a_full_memory_keeps_the_parts_at_hand(monkeypatch):
    from corpusq.llm import alignment

    met, aligned = [], alignment._aligned
    monkeypatch.setattr(alignment, "_aligned", lambda texts, *p: (met.extend(texts), aligned(texts, *p))[1])
    monkeypatch.setattr(alignment, "REMEMBERED", 4)
    segments = alignment.Segments(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    for text in ("a b c", "a b d e", "e d b a"):
        segments.aligned(pa.array([text]))
    assert sorted(met) == ["a", "b", "c", "d", "e"]


def test_a_small_memory_changes_no_result(monkeypatch):
    from corpusq.llm import alignment

    monkeypatch.setattr(alignment, "REMEMBERED", 7)
    monkeypatch.setattr(alignment, "LONGEST", 6)
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    rng = random.Random(8)
    pieces = ["the", "Straße", "unremembered", "ﬁne", "<s>", "it's", "12", "東京", "x\n", "of", "and", "b,c"]
    segments = alignment.Segments(*paths)
    for texts in [[""], [], *([" ".join(rng.choices(pieces, k=rng.randint(0, 6))) for _ in range(4)] for _ in range(40))]:
        cut, whole = segments.aligned(pa.array(texts, pa.string())), alignment._aligned(texts, *paths)
        assert len(segments.place) == segments.parts.num_rows <= 7
        links = lambda x, i: sorted((a, b, n) for r, a, b, n in zip(*(x[k].tolist() for k in ("row", "a", "b", "n"))) if r == i)
        for i in np.flatnonzero(~cut["whole"]).tolist():
            assert [cut[k][i] for k in ("n_a", "n_b", "n_groups", "n_links", "groups")] == [
                whole[k][i] for k in ("n_a", "n_b", "n_groups", "n_links", "groups")]
            assert links(cut, i) == links(whole, i)


def test_counts_of_shingles_are_bounded(monkeypatch):
    from corpusq.llm import jaccard

    monkeypatch.setattr(jaccard, "HELD", 4)
    seen, n = jaccard._most(np.arange(10), np.array([1, 5, 2, 9, 1, 7, 3, 1, 8, 2]))
    assert (seen.tolist(), n.tolist()) == ([1, 3, 5, 8], [5, 9, 7, 8])
    seen, n = jaccard._most(np.arange(3), np.array([1, 2, 1]))
    assert (seen.tolist(), n.tolist()) == ([1], [2])
