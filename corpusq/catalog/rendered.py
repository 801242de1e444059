"""Python-like texts of known structure, rendered from document numbers.

Prose does not parse as Python, so structure and scores are exercised on texts
whose every property follows from the document number by arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


ALIASED = ('from os import system as run_cmd\nimport subprocess as sp\n# never call eval(x) here\n'
           'run_cmd("ls")\nsp.run("ls", shell=1)\n')


def _times(line: str, n: Column) -> Column:
    return F.repeat(F.lit(line), n.cast("int"))


def _if(condition: Column, line: str) -> Column:
    return F.when(condition, F.lit(line)).otherwise(F.lit(""))


def rendered_corpus(documents: DataFrame) -> DataFrame:
    """(doc_id, id, source, language, content); every tenth text copies its predecessor."""
    d = F.col("doc_id")
    copy = d % 10 == 9
    k = F.when(copy, d - 1).otherwise(d)
    number = k.cast("string")
    content = F.concat(
        _if(copy, "\n\n"),
        F.when(k % 2 == 0, F.concat(F.lit('"""Module '), number, F.lit('."""\n'))).otherwise(F.lit("")),
        _times("# note\n", k % 6),
        _times("def f(x):\n    return x\n", k % 5),
        _times("class C:\n    def m(self):\n        return 1\n", k % 3),
        _if(k % 7 == 0, "async def g():\n    return 0\n"),
        F.repeat(F.concat(F.lit("x = "), number, F.lit("\n")), (k % 13).cast("int")),
        _if(k % 17 == 0, 'eval("1")\n'),
        _if(k % 4 == 1, 'password = "hunter2x"\n'),
        # Calls behind import aliases, and a call that only a comment names.
        _if(k % 19 == 0, ALIASED),
        _if(k % 11 == 0, "def broken(:\n"),
    )
    return documents.select(
        "doc_id",
        F.format_string("rendered_python_%06d", d).alias("id"),
        F.lit("rendered").alias("source"),
        F.lit("python").alias("language"),
        content.alias("content"),
    )
