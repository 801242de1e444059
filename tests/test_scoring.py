"""Scores: the stated behaviours, reachable values, and rounding."""
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from corpusq.config import DEFAULT_WEIGHTS, Settings
from corpusq.operators import scoring

# A row that no rule fines, and that documentation rules neither reward nor fine.
PLAIN = {
    "num_functions": ("bigint", 1), "num_classes": ("bigint", 1), "comment_ratio": ("double", 0.01),
    "has_docstring": ("boolean", False), "is_parseable": ("boolean", True), "num_lines": ("int", 44),
    "avg_line_length": ("double", 31.5), "alphanum_fraction": ("double", 0.72), "doc_score": ("double", 0.3),
    "syntactic_score": ("double", 0.95), "security_score": ("double", 0.85), "llm_score": ("double", None),
}
SCHEMA = ", ".join(f"{name} {kind}" for name, (kind, _) in PLAIN.items())


@pytest.fixture(scope="module")
def score(spark):
    def run(add, column, *rows):
        values = [tuple(r.get(name, value) for name, (_, value) in PLAIN.items()) for r in rows]
        df = spark.createDataFrame(values, SCHEMA).coalesce(1)
        return [r[0] for r in add(df).select(column).collect()]
    return run


BARE = dict(num_functions=0, num_classes=0)


@pytest.mark.parametrize("row, value", [
    ({}, 1.0), (BARE, 1.0), (dict(is_parseable=False), 0.0), (dict(is_parseable=None), 0.0),
    ({**BARE, "num_lines": 9}, 0.85), ({**BARE, "num_lines": 10}, 1.0), (dict(num_lines=1), 0.9),
    ({**BARE, "avg_line_length": 80.0}, 1.0), ({**BARE, "avg_line_length": 80.1}, 0.95),
    ({**BARE, "avg_line_length": 120.0}, 0.95), ({**BARE, "avg_line_length": 120.1}, 0.9),
    ({**BARE, "alphanum_fraction": 0.35}, 1.0), ({**BARE, "alphanum_fraction": 0.34}, 0.8),
    (dict(num_functions=0, alphanum_fraction=0.2), 0.85), (dict(num_classes=0, alphanum_fraction=0.2), 0.85),
    ({**BARE, "num_lines": 3, "avg_line_length": 500.0, "alphanum_fraction": 0.0}, 0.55),
])
def test_syntactic(score, row, value):
    assert score(scoring.add_syntactic_score, "syntactic_score", row) == [value]


def test_documentation(score):
    grid = [(d, c, n) for d in (True, False, None) for c in (0.049, 0.05, 0.099, 0.10) for n in (2, 3)]
    got = score(scoring.add_doc_score, "doc_score",
                *[dict(has_docstring=d, comment_ratio=c, num_functions=n) for d, c, n in grid])
    for (docstring, comments, functions), value in zip(grid, got):
        points = 50 * bool(docstring) + {0.049: 0, 0.05: 15, 0.099: 15, 0.10: 30}[comments]
        assert value == max(0, points - 10 * (functions == 3 and not docstring)) / 100


def test_composite_at_its_ends(score):
    def s(*rows):
        return score(scoring.add_composite_score, "composite_score", *rows)

    parts = ("syntactic_score", "doc_score", "security_score")
    best, worst = dict.fromkeys(parts, 1.0), dict.fromkeys(parts, 0.0)
    assert s(best, {**best, "llm_score": 5.0}, {**best, "llm_score": 1.0}) == [1.0, 1.0, 0.8]
    assert s(worst, {**worst, "llm_score": 1.0}, {**worst, "llm_score": 5.0}) == [0.0, 0.0, 0.2]


def test_composite_rounds_half_up_everywhere(score):
    grid = [(a, b, c, m) for a in (0.0, 0.55, 0.85, 1.0) for b in (0.0, 0.05, 0.65, 0.8)
            for c in (0.0, 0.5, 0.95) for m in (None, 1.0, 4.0)]
    got = score(scoring.add_composite_score, "composite_score",
                *[dict(syntactic_score=a, doc_score=b, security_score=c, llm_score=m) for a, b, c, m in grid])
    for (a, b, c, m), value in zip(grid, got):
        a, b, c = (Decimal(str(x)) for x in (a, b, c))
        exact = (a * Decimal("0.4375") + b * Decimal("0.3125") + c * Decimal("0.25") if m is None else
                 a * Decimal("0.35") + b * Decimal("0.25") + (c + (Decimal(str(m)) - 1) / 4) * Decimal("0.20"))
        assert value == float(exact.quantize(Decimal("0.0001"), ROUND_HALF_UP))


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.7,), (0.6999,), (None,)], "composite_score double").coalesce(1)
    assert [r.above_threshold for r in scoring.add_threshold_flag(df).collect()] == [True, False, False]


def test_missing_columns_take_their_defaults(spark):
    one = spark.createDataFrame([(1,)], "id int")
    assert scoring.add_syntactic_score(one).first()["syntactic_score"] == 0.0
    assert scoring.add_doc_score(one).first()["doc_score"] == 0.0
    assert scoring.add_composite_score(one).first()["composite_score"] == 0.0
    parsed = one.withColumn("is_parseable", F.lit(True))
    assert scoring.add_syntactic_score(parsed).first()["syntactic_score"] == 0.85


def test_security(texts):
    contents = [
        "def add(a, b):\n    return a + b\n", None, "import os\nos.system('ls')", 'x = eval("1")\r\n\ny = exec(z)',
        "subprocess.run(c, shell=True)\n" * 4, 'api_token = "abc"\nimport telnetlib', "medieval (x)\nretrieval(y)",
        "yaml.load(f)\nyaml.load(f, Loader=yaml.SafeLoader)", "", "model.eval()\n", "r = 0\nassert r\n  assert(r)",
    ]
    rows = scoring.add_security(texts(contents)).orderBy("id").collect()
    got = [(r.security_score, r.security_finding_count, r.security_high_count) for r in rows]
    assert got == [(1.0, 0, 0), (0.5, 0, 0), (0.7, 1, 1), (0.7, 2, 0), (0.0, 4, 4), (0.65, 2, 1), (1.0, 0, 0),
                   (0.85, 1, 0), (1.0, 0, 0), (1.0, 0, 0), (0.9, 2, 0)]
    assert [(f.severity, f.line) for f in rows[3].security_findings] == [("MEDIUM", 1), ("MEDIUM", 3)]
    assert all(len(r.security_findings) == r.security_finding_count for r in rows)
    assert {"security_score", "security_findings", "security_finding_count", "security_high_count"} <= set(
        rows[0].asDict())
    worst = scoring.add_max_severity(scoring.add_security(texts(contents))).orderBy("id").collect()
    assert [r.security_severity for r in worst] == ["NONE", "NONE", "HIGH", "MEDIUM", "HIGH", "HIGH", "NONE",
                                                    "MEDIUM", "NONE", "NONE", "LOW"]


def test_needles_occur_in_every_hit():
    """The byte search must never rule out a line the pattern would match."""
    import re

    from corpusq.functions.security import RULES

    samples = {
        "exec runs text as code": "exec (x)", "eval runs text as code": "eval(x)",
        "process started through a shell": "shell = True", "command line handed to a shell": "os.popen(c)",
        "deserialising untrusted data": "marshal.loads(b)", "yaml.load without a safe loader": "yaml.load(f)",
        "weak hash function": "hashlib.sha1()", "certificate check switched off": "verify=False",
        "unverified TLS context": "ssl._create_unverified_context()", "hard-coded password or token": "PASSWD == 'x'",
        "listens on all interfaces": "bind('0.0.0.0')", "racy temporary file name": "tempfile.mktemp()",
        "fixed path in a shared temporary folder": "open('/var/tmp/x')",
        "permissions open to everyone": "os.chmod(p, 0o777)", "web server in debug mode": "app.run(debug=True)",
        "clear-text protocol module": "from ftplib import FTP", "assert vanishes in optimised runs": "assert x",
        "random numbers unfit for secrets": "random.choice(x)",
    }
    for rule in RULES:
        line = samples[rule.text]
        assert re.search(rule.pattern, line) and any(n in line for n in rule.needles), rule.text


def test_settings_are_checked():
    assert Settings().weights_without_judge() == {
        "syntactic": Decimal("0.4375"), "documentation": Decimal("0.3125"), "security": Decimal("0.25")}
    with pytest.raises(ValueError):
        Settings(weights={**DEFAULT_WEIGHTS, "llm": Decimal("0.3")})
    with pytest.raises(ValueError):
        Settings(weights={"syntactic": Decimal(1)})
    with pytest.raises(ValueError):
        Settings(minhash_threshold=1.5)


def test_tree_analysis_resolves_aliases_and_ignores_comments(spark):
    from corpusq.functions import analysis

    code = [
        "# never call eval(x) here\nx = 1\n",
        'def f():\n    """exec(code) would run it"""\n    return 1\n',
        'from os import system\nsystem("ls")\n',
        "from pickle import loads\nloads(b)\n",
        "import subprocess as s\ns.run(c, shell=1)\n",
        'print("os.system(x)")\n',
        "import hashlib as h\nh.md5(b)\nh.sha1(b, usedforsecurity=False)\n",
        "def broken(:\n    eval(x)\n",
    ]
    rows = spark.createDataFrame([(i, c, "python") for i, c in enumerate(code)], "id bigint, content string, language string")
    got = {r.id: [(f.severity, f.text, f.line) for f in r.security_findings]
           for r in scoring.add_security(rows).collect()}
    assert got[0] == [] and got[1] == [] and got[5] == []
    assert got[2] == [("HIGH", "command line handed to a shell", 2)]
    assert got[3] == [("MEDIUM", "deserialising untrusted data", 2)]
    assert got[4] == [("HIGH", "process started through a shell", 2)]
    assert got[6] == [("HIGH", "weak hash function", 2)]
    assert got[7] == [("MEDIUM", "eval runs text as code", 2)]  # does not parse: the line rules
    # Other languages are scanned by lines, as before.
    prose = spark.createDataFrame([(0, "# never call eval(x) here", "text")], "id bigint, content string, language string")
    assert scoring.add_security(prose).first().security_finding_count == 1


def test_tree_analysis_ends_a_slow_row_not_the_task(monkeypatch):
    from corpusq.functions import analysis

    monkeypatch.setattr(analysis, "PARSE_SECONDS", 0.01)
    slow = "x = [" + ", ".join(f"({i}, {i} + {i})" for i in range(300_000)) + "]\n"
    assert analysis.analyse(slow) == {"state": analysis.FAILED, "findings": None}
    monkeypatch.setattr(analysis, "PARSE_SECONDS", 10)
    assert analysis.analyse("eval(1)")["state"] == analysis.TREE
