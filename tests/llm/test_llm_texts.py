"""Toxicity, language, main text, token counts: fixtures, references and held-out figures."""
import random

import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from corpusq.llm import html_text, language, token_counts, toxicity
from corpusq.llm.lexicon import FUZZY_LENGTH, Lexicon
from corpusq.llm.queries import llm_queries
from corpusq.llm.token_counts import Counter, count_tokens


# ---- toxicity -------------------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lexicon_equals_edit_distance():
    rng = random.Random(5)
    word = lambda low, high: "".join(rng.choice("abcd") for _ in range(rng.randint(low, high)))
    terms = sorted({(word(3, 8), rng.random() < 0.4) for _ in range(40)})
    lexicon = Lexicon(terms)
    import re

    for w in [word(1, 10) for _ in range(3000)] + [""]:
        best = None
        for number, (text, is_stem) in enumerate(terms):
            near = min(distance(text, w[:k]) for k in range(len(w) + 1)) if is_stem else distance(text, w)
            if near == 0 or near == 1 and len(text) >= FUZZY_LENGTH:
                best = min(best or (9,), (near, -len(text), number))
        got = lexicon.match(w)
        assert got == (best and (best[2], best[0])), w
        if best:
            assert re.search(lexicon.sieve, w), w


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    plain = [f"{rng.choice('bdfgklmn')}{rng.choice('aeiou')}{rng.choice('rstvz')}{rng.choice('aeiou')}{c}" for c in "lmnpqr" * 60]
    texts = []
    for i in range(900):
        w = [rng.choice(plain) for _ in range(60)]
        if i % 6 == 0:
            for _ in range(3):
                w[rng.randrange(60)] = rng.choice(["wretchling", "mudwort", "gorpson", "gorpling", "gorpish", "gorpent", "gorpas"])
        texts.append((i, " ".join(w), int(i % 6 == 0)))
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id bigint, text string")
    labels = spark.createDataFrame([(t[0], t[2]) for t in texts], "doc_id bigint, toxic int")
    return docs, labels, toxicity.learn(docs, labels)


def scores(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("score", F.lit("clash"))
    return [r.score for r in toxicity.score_texts(df, model).orderBy("doc_id").collect()]


def test_toxicity_learns_terms_and_stems(labelled, spark):
    docs, labels, model = labelled
    assert {"wretchling", "mudwort"} <= {t for t, stem in model.terms if not stem}
    assert any("gorp".startswith(t) or t.startswith("gorp") for t, stem in model.terms if stem)
    out = toxicity.score_texts(docs, model).join(labels, "doc_id").filter(toxicity.fold(F.col("doc_id"), 3) == 1)
    wrong = out.filter((F.col("score") >= toxicity.REJECT) != (F.col("toxic") == 1)).count()
    assert wrong <= 0.02 * out.count()


def test_toxicity_of_spellings_and_contexts(labelled, spark):
    model = labelled[2]
    calm = "baralm dotem fusin gavon " * 3
    plain, exact, misspelt, lookalike, stem, quoted, upper = scores(spark, model, [
        calm, calm + "wretchling " + calm, calm + "wretchlng " + calm, calm + "mudw0rt " + calm, calm + "gorpolis " + calm,
        calm + 'he wrote "wretchling" there ' + calm, calm + "WRETCHLING!! " + calm])
    assert plain < quoted < exact and quoted < toxicity.REJECT
    assert min(exact, upper, lookalike, stem) >= toxicity.REJECT and plain < misspelt <= exact


def test_toxicity_edge_cases(labelled, spark):
    model = labelled[2]
    none, empty, long = scores(spark, model, [None, "", "calm " * 50_000 + "mudwort " * 3])
    assert none == empty < toxicity.REJECT <= long
    docs = spark.createDataFrame([(1, "mudwort"), (1, "mudwort"), (None, None)], "doc_id bigint, text string")
    no_labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    bare = toxicity.learn(docs, no_labels)
    assert bare.terms == () and toxicity.score_texts(docs, bare).count() == 3
    assert toxicity.score_texts(docs.limit(0), model).count() == 0
    assert toxicity.drop_toxic(docs, labelled[1]).columns == docs.columns


def test_op2_on_held_out_labels(spark):
    out = llm_queries()["op2_toxicity"](spark, SMALL)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.filter("score between 0 and 1").count() == 200


# ---- language -------------------------------------------------------------------------

def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = llm_queries()["op7_language"](spark, SMALL).join(docs, "doc_id").filter("held_out and n_chars > 60")
    assert out.count() > 30 and out.filter("lang = lang_pred").count() >= 0.95 * out.count()


def test_language_edge_cases(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.learn(docs)
    odd = spark.createDataFrame([(None, None), (1, ""), (1, "12 !! \n"), (2, "é"), (3, "the " * 90_000)], "doc_id bigint, text string")
    got = {(r.doc_id, r.text[:1] if r.text else r.text): (r.lang_pred, r.score) for r in language.identify(odd, model).collect()}
    assert got[None, None] == got[1, ""] == got[1, "1"] == ("und", 0.0)
    assert got[2, "é"][0] != "und" and got[3, "t"][0] == "en"
    assert language.identify(odd.limit(0), model).count() == 0
    nothing = language.learn(docs.limit(0))
    assert {r.lang_pred for r in language.identify(odd, nothing).collect()} == {"und"}
    one = language.learn(docs.filter("lang = 'de'"))
    assert {r.lang_pred for r in language.identify(odd, one).collect()} == {"und", "de"}


# ---- main text ------------------------------------------------------------------------

PARAGRAPH = "This is a paragraph of some length, with commas, that says what an article says, and no more than that."
PAGES = {
    "": "",
    "plain text only": "plain text only",
    f"<body><nav><a href=/>Home</a></nav><article><h1>T &amp; U</h1><p>{PARAGRAPH}<p>Second,\n two&nbsp;three</article><footer>x</footer>":
        f"T & U {PARAGRAPH} Second, two three",
    f'<div id=main><p>{PARAGRAPH}</p><div class="comments"><p>{PARAGRAPH}</p></div><div class="ad">Buy, buy, buy</div><form><p>Mail</p></form></div>':
        PARAGRAPH,
    f'<div class=sidebar><p>a, b, c, d, e, f</p></div><div><p>{PARAGRAPH}</p><script>if (a < b) "</p>"</script><style>p{{}}</style><p>End.</p></div>':
        f"{PARAGRAPH} End.",
    f"<main><p>{PARAGRAPH}</p><ul><li>one<li>two</ul><!-- <p>no</p> --></main><p hidden>{PARAGRAPH}</p>": f"{PARAGRAPH} one two",
    f"<ul><li><a href=a>{PARAGRAPH}</a><li><a href=b>{PARAGRAPH}</a></ul><div><p>{PARAGRAPH}</p></div>": PARAGRAPH,
    f"<article><p>{PARAGRAPH}</p><p>cut <b": f"{PARAGRAPH} cut",
    "<p>a &lt; b &#233; &eacute; &bogus; 3 < 4</p>": "a < b é é &bogus; 3 < 4",
    "<div>" * 5000 + "deep" + "</div>" * 5000: "deep",
}


@pytest.mark.parametrize("html", PAGES)
def test_main_text(html):
    assert html_text.main_text(html) == PAGES[html]


LONG = " ".join([PARAGRAPH] * 4)


@pytest.mark.parametrize("names", [
    "content has-sidebar", "page no-sidebar", "post-content with-comments", "football", "footnotes", "naval", "side", "header",
    "main share", "comments"])
def test_names_do_not_drop_an_article(names):
    assert html_text.main_text(f"<body><h1>T</h1><div class='{names}'><p>{LONG}</p><p>{PARAGRAPH}</p></div>").endswith(f"{LONG} {PARAGRAPH}")


@pytest.mark.parametrize("names", ["sidebar", "comments", "footer", "ad", "nav-main", "navbar", "related"])
def test_names_drop_what_lies_beside_an_article(names):
    page = f"<article><p>{LONG}</p></article><div class='{names}'><p>{PARAGRAPH}</p></div>"
    assert html_text.main_text(page) == LONG


def test_text_beside_the_best_container():
    item = "An item of this list, that says in about a hundred characters what is on it and not much more than that"
    short = "A paragraph of about sixty characters is a part of it, too."
    links = f"<ul><li><a href=a>{PARAGRAPH}</a><li><a href=b>{PARAGRAPH}</a></ul>"
    assert html_text.main_text(f"<article><p>{short}</p><ul>{f'<li>{item}</li>' * 30}</ul>{links}</article>") == " ".join([short] + [item] * 30)
    # a short section beside a long one, in deeper containers, and other tags
    page = f"<body><div><div><h4>H</h4>{short}</div><div><section><p>{LONG}</p><p>{LONG}</p></section><pre>x = 1</pre><table><tr><td>c</table></div></div>{links}"
    assert html_text.main_text(page) == f"H {short} {LONG} {LONG} x = 1 c"
    assert html_text.main_text(f"<div><p>{LONG}</p></div><div><p>End.</p></div>") == f"{LONG} End."


def test_a_head_without_end_and_figures():
    assert html_text.main_text(f"<html><head><title>T</title><meta a=b><body><p>{PARAGRAPH}</p></body></html>") == PARAGRAPH
    assert html_text.main_text(f"<head><title>T</title><p>{PARAGRAPH}</p>") == PARAGRAPH
    assert html_text.main_text(
        f"<article><p>{PARAGRAPH}</p><figure><img src=a><figcaption>A cap.</figcaption></figure>"
        "<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math>.</p></article>") == f"{PARAGRAPH} A cap. So x=1."


def test_pages_with_nulls_repeats_and_no_rows(spark):
    rows = [(1, "u", "<p>x</p>", 0), (1, "u", "<p>x</p>", 0), (None, None, None, 0)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = [tuple(r) for r in html_text.extract(df).collect()]
    assert got == [(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0)]
    assert html_text.extract(df.limit(0)).count() == 0


# ---- token counts ---------------------------------------------------------------------

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "the", " ", "  ", "\n", "\n\n", " \n", "▁", "é", "word", ".", " and", "x" * 30, "\t", "中", "😀", "   ",
         "<s>", "</s>", "\x00", "\r\n", "!!"]


def made(rng, low, high):
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(low, high)))


def test_token_counts_equal_the_library():
    rng, counter = random.Random(1), Counter(MODEL)
    texts = [made(rng, 0, 14) for _ in range(4000)] + ["\n", "\n\n", " ", "a ", "a\n", "\na", " a", ""]
    assert counter.stable
    assert counter.count_all(pa.array(texts)).tolist() == [len(x) for x in counter.model.encode(texts)]


def test_more_segments_than_are_remembered(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    monkeypatch.setattr(token_counts, "AT_ONCE", 2, raising=False)
    counter = Counter(MODEL)
    for batch in (["one two"], ["one 11 22 33 44 three four 55 two"], ["44 55 one, 66", "\n77 88\none two "]):
        assert counter.count_all(pa.array(batch)).tolist() == [len(counter.model.encode(t)) for t in batch]
        assert len(counter.known) <= 3


def test_spliced_chunks_equal_one_encoding():
    rng = random.Random(2)
    counter = Counter(MODEL, chunk=40, overlap=8)
    texts = [made(rng, 30, 90) for _ in range(500)] + ["x" * 5000, "ab " * 2000, "\n" * 300, " " * 300, "中" * 700]
    assert [counter.count_huge(t) for t in texts] == [len(x) for x in counter.model.encode(texts)]


def test_token_count_rows(spark):
    df = spark.createDataFrame([(1, None, 0), (1, "", 0), (None, "a b", 0), (None, "a b", 0), (2, "word " * 20_000, 0)],
                               "doc_id bigint, text string, n_tokens int")
    got = sorted((tuple(r) for r in count_tokens(df, MODEL).collect()), key=str)
    n = len(Counter(MODEL).model.encode("word " * 20_000))
    assert got == sorted([(1, 0, 0, False), (1, 0, 0, False), (None, 3, 2, False), (None, 3, 2, False), (2, 100_000, n, True)], key=str)
    assert count_tokens(df.limit(0), MODEL).count() == 0
