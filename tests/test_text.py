"""Text measures against Python's own string methods."""
import hashlib
import unicodedata

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from corpusq.functions.text import BLANKS, LINE_ENDS
from corpusq.operators import dedup, features

# Texts with (lines, characters outside line ends, letters and numbers, comment lines).
EDGES = {
    "": (0, 0, 0, 0), "\n": (1, 0, 0, 0), "a": (1, 1, 1, 0), "a\n": (1, 1, 1, 0), "a\r\nb": (2, 2, 2, 0),
    "a\r\n": (1, 1, 1, 0), "\r\n\r\n": (2, 0, 0, 0), "\n\n#": (3, 1, 0, 1), "\r\r\n\n": (3, 0, 0, 0),
    "#": (1, 1, 0, 1), "  #": (1, 3, 0, 1), "##\n##": (2, 4, 0, 2), "# x\n  # y\n\t#z\nq # n": (4, 16, 5, 3),
    "a\x0b#b\x0c#c": (3, 5, 3, 2), "\r\n#a\r\n #b\r#c": (4, 7, 3, 3),
    "\xa0# nb\x1cx\x85# y\u2028#z\u2029 \u3000# w": (5, 16, 6, 4), "\u3000code\x1f\n": (1, 6, 4, 0),
    "\u65e5\u672c\u8a9e\U0001f600\xbd\xb2\u2177": (1, 7, 6, 0), "e\u0301 combining": (1, 12, 10, 0),
    "x" * 300: (1, 300, 300, 0), "\x1c\x1d\x1e": (3, 0, 0, 0), "a\x00b\nc": (2, 4, 3, 0), "no end\n\n\n": (3, 6, 5, 0),
}
ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def by_scan(text):
    """The same four figures, read character by character."""
    lines, letters, outside, comments = 0, 0, 0, 0
    fresh, begun, previous = True, False, ""
    for c in text:
        if c in ENDS:
            if not (c == "\n" and previous == "\r"):
                lines += 1
            fresh, begun = True, False
        else:
            outside, begun = outside + 1, True
            letters += unicodedata.category(c)[0] in "LN"
            if fresh and c not in BLANKS:
                comments, fresh = comments + (c == "#"), False
        previous = c
    return lines + begun, outside, letters, comments


def expected(text, figures):
    lines, outside, letters, comments = figures
    digest = hashlib.sha256(text.strip(BLANKS).encode()).hexdigest()
    return lines, outside / max(lines, 1), letters / max(len(text), 1), comments / max(lines, 1), digest


def measured(texts, contents):
    df = dedup.add_content_hash(features.add_text_features(texts(contents)))
    rows = df.orderBy("id").select(
        "num_lines", "avg_line_length", "alphanum_fraction", "comment_ratio", "content_hash"
    ).collect()
    return [tuple(r) for r in rows]


def test_blank_sets_are_pythons():
    everything = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert set(LINE_ENDS) == {c for c in everything if len(f"a{c}b".splitlines()) == 2}
    assert set(BLANKS) == {c for c in everything if not c.strip()}


def test_edge_texts(texts):
    for (text, figures), got in zip(EDGES.items(), measured(texts, list(EDGES))):
        assert got == expected(text, figures), repr(text)
        assert by_scan(text) == figures, repr(text)


# Letters assigned long ago: the JVM and Python may follow different Unicode versions.
SETTLED = st.characters(exclude_categories=["Cs"]).filter(
    lambda c: unicodedata.ucd_3_2_0.category(c) != "Cn")


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.one_of(st.sampled_from(list(BLANKS + "##ab1\xe9_")), SETTLED), max_size=40),
                min_size=60, max_size=90))
def test_random_texts(texts, contents):
    for text, row in zip(contents, measured(texts, contents)):
        assert row == expected(text, by_scan(text)), repr(text)


def test_null_text_stays_null(texts):
    assert measured(texts, [None, "x"])[0] == (None, None, None, None, None)


def test_source_columns_of_the_same_name_are_replaced(spark):
    df = spark.createDataFrame([(1, "ab\ncd", 99.0)], "id bigint, content string, avg_line_length double")
    out = features.add_text_features(df)
    assert out.columns.count("avg_line_length") == 1
    assert out.first()["avg_line_length"] == 2.0


def test_hard_filter_on_texts(texts):
    contents = ["let v = 7;\n" * 4, "let v = 7;\n" * 5, "let v = 7;\n" * 1000, "let v = 7;\n" * 1001,
                ("w" * 201 + "\n") * 6, ("w" * 200 + "\n") * 6, "!?!?a\n" * 9, "!?!a\n" * 9, "", None]
    kept = features.apply_hard_filters(features.add_text_features(texts(contents)))
    # Of "!?!a" and its line end, one character in five is a letter.
    assert {r.id for r in kept.collect()} == {1, 2, 5}
    assert features.apply_hard_filters(features.add_text_features(texts([]))).count() == 0


def test_hard_filter_bounds_are_inclusive(spark):
    rows = [
        (1, 5, 10.0, 0.5), (2, 4, 10.0, 0.5), (3, 1000, 10.0, 0.5), (4, 1001, 10.0, 0.5),
        (5, 10, 10.0, 0.25), (6, 10, 10.0, 0.2499), (7, 10, 200.0, 0.5), (8, 10, 200.01, 0.5),
        (9, None, 10.0, 0.5), (10, 10, None, 0.5), (11, 10, 10.0, None),
    ]
    df = spark.createDataFrame(rows, "id int, num_lines int, avg_line_length double, alphanum_fraction double")
    assert {r.id for r in features.apply_hard_filters(df).collect()} == {1, 3, 5, 7}
