"""Security findings from the syntax tree of a Python text, with import aliases resolved.

One parse per text gives the findings: a visitor walks the tree, resolves every called name
through the module's imports (``from os import system as run`` makes ``run(...)`` a call of
``os.system``) and applies the checks of ``security.RULES`` to calls, keywords, assignments,
imports, asserts and string constants. Comments are not in the tree, and calls written inside
strings or docstrings are text, not calls, so neither gives a finding.

A text that does not parse is marked ``unparsed``; the caller then falls back to the line
rules. The parse is bounded in time (``PARSE_SECONDS``) and depth (the interpreter's own
limits): a text beyond them ends its own row as ``failed`` (scored 0.5, unknown, by the
caller), never the task.
"""

from __future__ import annotations

import ast
import re
import signal
import warnings
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.functions.security import RULES
from corpusq.schemas import FINDING

PARSE_SECONDS = 10

# Places of the checks in security.RULES, by what they find.
EXEC, EVAL, SHELL, SYSTEM, UNPICKLE, YAML, WEAK_HASH, NO_VERIFY, UNVERIFIED_TLS, PASSWORD, \
    ALL_INTERFACES, MKTEMP, TMP_PATH, CHMOD, DEBUG, CLEAR_TEXT, ASSERT, RANDOM = range(18)
SECRET_NAME = re.compile(r"(?:password|passwd|pwd|secret|token)", re.IGNORECASE)
SHARED_TMP = ("/tmp", "/var/tmp", "/dev/shm")
WEAK_HASHES = {"hashlib.md5", "hashlib.sha1"}
LOADERS = {f"{m}.{f}" for m in ("pickle", "marshal", "dill") for f in ("load", "loads")}
RANDOMS = {f"random.{f}" for f in ("random", "randrange", "randint", "choice", "uniform", "triangular")}
CLEAR_TEXT_MODULES = ("telnetlib", "ftplib")


class _Timeout(Exception):
    pass


@contextmanager
def _bounded(seconds: float):
    """Raise _Timeout in the block after ``seconds``; without an interval timer, unbounded."""
    def expire(*_):
        raise _Timeout

    try:
        previous = signal.signal(signal.SIGALRM, expire)
    except ValueError:  # not the main thread: no timer can be set
        yield
        return
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, previous)


def _truthy(node: ast.AST) -> bool:
    return isinstance(node, ast.Constant) and bool(node.value) and node.value is not Ellipsis


def _false(node: ast.AST) -> bool:
    return isinstance(node, ast.Constant) and node.value is False


class _Visitor(ast.NodeVisitor):
    def __init__(self):
        self.aliases: dict[str, str] = {}
        self.hits: set[tuple[int, int]] = set()
        self.docstrings: set[int] = set()

    def hit(self, node: ast.AST, rule: int) -> None:
        self.hits.add((getattr(node, "lineno", 0), rule))

    def name_of(self, node: ast.AST) -> str | None:
        if isinstance(node, ast.Name):
            return self.aliases.get(node.id, node.id)
        if isinstance(node, ast.Attribute):
            base = self.name_of(node.value)
            return f"{base}.{node.attr}" if base else None
        return None

    # -- imports: remember what each local name stands for
    def visit_Import(self, node: ast.Import) -> None:
        for a in node.names:
            if a.name.split(".")[0] in CLEAR_TEXT_MODULES:
                self.hit(node, CLEAR_TEXT)
            self.aliases[a.asname or a.name.split(".")[0]] = a.name if a.asname else a.name.split(".")[0]

    def visit_ImportFrom(self, node: ast.ImportFrom) -> None:
        module = node.module or ""
        if module.split(".")[0] in CLEAR_TEXT_MODULES:
            self.hit(node, CLEAR_TEXT)
        for a in node.names:
            if a.name != "*":
                self.aliases[a.asname or a.name] = f"{module}.{a.name}" if module else a.name

    # -- statements
    def visit_Assert(self, node: ast.Assert) -> None:
        self.hit(node, ASSERT)
        self.generic_visit(node)

    def _secret(self, target: ast.AST, value: ast.AST | None) -> None:
        name = target.id if isinstance(target, ast.Name) else target.attr if isinstance(target, ast.Attribute) else None
        if name and SECRET_NAME.search(name) and isinstance(value, ast.Constant) \
                and isinstance(value.value, str) and value.value:
            self.hit(value, PASSWORD)

    def visit_Assign(self, node: ast.Assign) -> None:
        for t in node.targets:
            self._secret(t, node.value)
        self.generic_visit(node)

    def visit_AnnAssign(self, node: ast.AnnAssign) -> None:
        self._secret(node.target, node.value)
        self.generic_visit(node)

    def visit_Compare(self, node: ast.Compare) -> None:
        if len(node.ops) == 1 and isinstance(node.ops[0], (ast.Eq, ast.NotEq)):
            self._secret(node.left, node.comparators[0])
        self.generic_visit(node)

    def visit_Expr(self, node: ast.Expr) -> None:
        if isinstance(node.value, ast.Constant) and isinstance(node.value.value, str):
            self.docstrings.add(id(node.value))  # a lone string: documentation, not data
        self.generic_visit(node)

    def visit_Constant(self, node: ast.Constant) -> None:
        if isinstance(node.value, str) and id(node) not in self.docstrings:
            if node.value == "0.0.0.0":
                self.hit(node, ALL_INTERFACES)
            if any(node.value == p or node.value.startswith(p + "/") for p in SHARED_TMP):
                self.hit(node, TMP_PATH)

    # -- calls
    def visit_Call(self, node: ast.Call) -> None:
        called = self.name_of(node.func) or ""
        plain = called.removeprefix("builtins.")
        keywords = {k.arg: k.value for k in node.keywords if k.arg}
        if plain == "exec":
            self.hit(node, EXEC)
        elif plain == "eval":
            self.hit(node, EVAL)
        if called in ("os.system", "os.popen"):
            self.hit(node, SYSTEM)
        if called in LOADERS:
            self.hit(node, UNPICKLE)
        if called == "yaml.load":
            loader = keywords.get("Loader", node.args[1] if len(node.args) > 1 else None)
            if loader is None or "SafeLoader" not in (self.name_of(loader) or ""):
                self.hit(node, YAML)
        if called in WEAK_HASHES and not _false(keywords.get("usedforsecurity", ast.Constant(True))):
            self.hit(node, WEAK_HASH)
        if called.endswith("_create_unverified_context"):
            self.hit(node, UNVERIFIED_TLS)
        if called == "tempfile.mktemp":
            self.hit(node, MKTEMP)
        if called.endswith("chmod"):
            mode = keywords.get("mode", node.args[1] if len(node.args) > 1 else None)
            if isinstance(mode, ast.Constant) and isinstance(mode.value, int) and mode.value & 0o002:
                self.hit(node, CHMOD)
        if called in RANDOMS:
            self.hit(node, RANDOM)
        if _truthy(keywords.get("shell", ast.Constant(False))):
            self.hit(node, SHELL)
        if _false(keywords.get("verify", ast.Constant(True))):
            self.hit(node, NO_VERIFY)
        if isinstance(node.func, ast.Attribute) and node.func.attr == "run" and _truthy(keywords.get("debug", ast.Constant(False))):
            self.hit(node, DEBUG)
        for k in node.keywords:
            if k.arg:
                self._secret(ast.Name(id=k.arg), k.value)
        self.generic_visit(node)


def analyse(code: str) -> dict:
    """{"state", "findings"}: state "tree" with the findings in line order, then rule order;
    "unparsed" if the text does not parse; "failed" if the parse ran out of time."""
    try:
        with _bounded(PARSE_SECONDS):
            tree = ast.parse(code)
            visitor = _Visitor()
            visitor.visit(tree)
    except _Timeout:
        return dict(state=FAILED, findings=None)
    except (SyntaxError, ValueError, MemoryError, RecursionError):
        return dict(state=UNPARSED, findings=None)
    return dict(state=TREE, findings=[dict(severity=RULES[rule].severity, text=RULES[rule].text, line=line)
                                      for line, rule in sorted(visitor.hits)])


TREE, UNPARSED, FAILED = "tree", "unparsed", "failed"
ANALYSIS = T.StructType([T.StructField("state", T.StringType()), T.StructField("findings", T.ArrayType(FINDING))])
_ARROW = pa.struct([("state", pa.string()), ("findings", pa.list_(
    pa.struct([("severity", pa.string()), ("text", pa.string()), ("line", pa.int32())])))])


@F.arrow_udf(ANALYSIS)
def tree_findings(code: pa.Array) -> pa.Array:
    # Null in, null out: texts that are no Python arrive as null and cost nothing.
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return pa.array([None if c is None else analyse(c) for c in code.to_pylist()], type=_ARROW)
