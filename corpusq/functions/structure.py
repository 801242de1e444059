"""Structure of a Python source text, read with the interpreter's own parser.

No Spark expression can parse Python, so this is one of the two Arrow functions
of the library: batches of whole texts go to the Python workers, row by row
through ``ast``, and come back as one struct column.
"""

from __future__ import annotations

import ast
import warnings

import pyarrow as pa
from pyspark.sql import functions as F

from corpusq.schemas import STRUCTURE


# The fields of a statement that hold further statements.
_BLOCKS = ("body", "orelse", "finalbody", "handlers", "cases")


def _definitions(tree: ast.Module) -> tuple[int, int]:
    """Functions and classes at any depth; only statements are visited, as none hides elsewhere."""
    functions = classes = 0
    pending = list(tree.body)
    while pending:
        node = pending.pop()
        kind = type(node)
        if kind is ast.FunctionDef:  # an async function is a kind of its own
            functions += 1
        elif kind is ast.ClassDef:
            classes += 1
        for block in _BLOCKS:
            pending.extend(getattr(node, block, ()))
    return functions, classes


def describe(code: str) -> dict:
    """Parse one text; any failure, also of the parser's own limits, is a result."""
    try:
        tree = ast.parse(code)
        functions, classes = _definitions(tree)
        documented = ast.get_docstring(tree, clean=False) is not None
    except Exception as failure:  # not only SyntaxError: MemoryError and RecursionError too
        error = str(failure) or type(failure).__name__
        return dict(is_parseable=False, num_functions=0, num_classes=0, has_docstring=False,
                    parse_error=error.encode("utf-8", "replace").decode("utf-8"))
    return dict(is_parseable=True, num_functions=functions, num_classes=classes,
                has_docstring=documented, parse_error=None)


_ARROW_STRUCT = pa.struct(
    [
        ("is_parseable", pa.bool_()),
        ("num_functions", pa.int64()),
        ("num_classes", pa.int64()),
        ("has_docstring", pa.bool_()),
        ("parse_error", pa.string()),
    ]
)


@F.arrow_udf(STRUCTURE)
def python_structure(code: pa.Array) -> pa.Array:
    # Null in, null out: rows of other languages arrive as null and cost nothing.
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return pa.array([c if c is None else describe(c) for c in code.to_pylist()], type=_ARROW_STRUCT)
