"""Structure of Python texts."""
import pytest

from corpusq.functions.structure import describe
from corpusq.operators import features

CASES = [
    ("", (True, 0, 0, False)),
    ("def f():\n    def g():\n        pass\n", (True, 2, 0, False)),
    ("class A:\n    def m(self): pass\n    class B:\n        def n(self): pass\n", (True, 2, 2, False)),
    ("async def f():\n    pass\n", (True, 0, 0, False)),
    ("async def f():\n    def g(): pass\n", (True, 1, 0, False)),
    ('def f():\n    """Only here."""\n', (True, 1, 0, False)),
    ('""""""\nx = 1\n', (True, 0, 0, True)),
    ('"""Module."""\n', (True, 0, 0, True)),
    ("if x:\n    def a(): pass\nelse:\n    def b(): pass\n", (True, 2, 0, False)),
    ("try:\n    def a(): pass\nexcept E:\n    def b(): pass\nelse:\n    class C: pass\nfinally:\n    def d(): pass\n",
     (True, 3, 1, False)),
    ("match x:\n    case 1:\n        def a(): pass\n", (True, 1, 0, False)),
    ("for i in x:\n    with y:\n        while z:\n            def a(): pass\n", (True, 1, 0, False)),
    ("f = lambda: 0\n", (True, 0, 0, False)),
    ("print 1", (False, 0, 0, False)),
    ("x = 1\x00", (False, 0, 0, False)),
    ("(" * 5000, (False, 0, 0, False)),
    ("x = " + "-" * 100_000 + "1", (False, 0, 0, False)),
    ("s = '\\d'\n", (True, 0, 0, False)),
]


@pytest.mark.parametrize("code,want", CASES, ids=range(len(CASES)))
def test_describe(code, want):
    got = describe(code)
    assert (got["is_parseable"], got["num_functions"], got["num_classes"], got["has_docstring"]) == want
    assert (got["parse_error"] is None) == want[0]


def test_python_rows_in_spark(texts):
    out = features.add_structure(texts([c for c, _ in CASES]), "python").orderBy("id").collect()
    for row, (_, want) in zip(out, CASES):
        assert (row.is_parseable, row.num_functions, row.num_classes, row.has_docstring) == want


def test_other_languages_get_constants(spark):
    df = spark.createDataFrame([(1, "go", "x = 1"), (2, "python", "x = 1"), (3, None, "x")],
                               "id int, language string, content string")
    rows = {r.id: r for r in features.add_structure(df).collect()}
    for i in (1, 3):
        assert (rows[i].is_parseable, rows[i].num_functions, rows[i].num_classes, rows[i].has_docstring,
                rows[i].parse_error) == (None, 0, 0, False, None)
    assert rows[2].is_parseable is True


def test_same_layout_on_every_path(texts, spark):
    types = [features.add_structure(texts(["x"]), lang).select(*features.STRUCTURE_COLUMNS).dtypes
             for lang in ("python", "go")]
    assert types[0] == types[1]
    assert features.add_structure(texts([]), "python").count() == 0


def test_prose_with_texts_beyond_the_parsers_limits(spark):
    # Among these are texts on which the parser runs out of its own stack.
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumnRenamed("text", "content")
    out = features.add_structure(docs, "python").select("is_parseable", "parse_error").collect()
    assert len(out) == 1000 and not any(r.is_parseable for r in out) and all(r.parse_error for r in out)
