"""Line rules for risky constructs, applied inside each row.

The rules are a small fixed list, so they enter the plan as literals: a document
is cut into lines, every line is tested, and the findings stay in the row as an
array. Nothing is exploded, joined or shuffled, whatever the size of the corpus.
Patterns keep to the syntax Java and RE2 share and do not backtrack.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusq.functions.text import LINE_BREAK
from corpusq.schemas import FINDING

# Severities in rising order, and the points each costs out of 100.
SEVERITIES = ("LOW", "MEDIUM", "HIGH")
PENALTY = {"HIGH": 30, "MEDIUM": 15, "LOW": 5}
UNKNOWN_SCORE = 0.5


@dataclass(frozen=True)
class Rule:
    """``needles``: a hit holds at least one of these, so a byte search can rule a text out."""

    severity: str
    text: str
    needles: tuple[str, ...]
    pattern: str
    unless: str | None = None


_START = r"(?:^|[^A-Za-z0-9_.])"

# Publicly documented checks for Python source text.
RULES = (
    Rule("MEDIUM", "exec runs text as code", ("exec",), _START + r"exec[ \t]*\("),
    Rule("MEDIUM", "eval runs text as code", ("eval",), _START + r"eval[ \t]*\("),
    Rule("HIGH", "process started through a shell", ("shell",), r"shell[ \t]*=[ \t]*True"),
    Rule("HIGH", "command line handed to a shell", ("os.system", "os.popen"),
         r"os\.(?:system|popen)[ \t]*\("),
    Rule("MEDIUM", "deserialising untrusted data", ("pickle.load", "marshal.load", "dill.load"),
         r"(?:pickle|marshal|dill)\.loads?[ \t]*\("),
    Rule("MEDIUM", "yaml.load without a safe loader", ("yaml.load",), r"yaml\.load[ \t]*\(",
         unless="SafeLoader"),
    Rule("HIGH", "weak hash function", ("hashlib.",), r"hashlib\.(?:md5|sha1)[ \t]*\("),
    Rule("HIGH", "certificate check switched off", ("verify",), r"verify[ \t]*=[ \t]*False"),
    Rule("MEDIUM", "unverified TLS context", ("_create_unverified_context",),
         r"_create_unverified_context"),
    Rule("LOW", "hard-coded password or token",
         ("password", "passwd", "pwd", "secret", "token", "PASSWORD", "PASSWD", "SECRET", "TOKEN"),
         r"(?:password|passwd|pwd|secret|token|PASSWORD|PASSWD|SECRET|TOKEN)"
         r"[ \t]*==?[ \t]*[\"'][^\"']+[\"']"),
    Rule("MEDIUM", "listens on all interfaces", ("0.0.0.0",), r"[\"']0\.0\.0\.0[\"']"),
    Rule("MEDIUM", "racy temporary file name", ("tempfile.mktemp",), r"tempfile\.mktemp[ \t]*\("),
    Rule("MEDIUM", "fixed path in a shared temporary folder", ("/tmp", "/dev/shm"),
         r"[\"'](?:/tmp|/var/tmp|/dev/shm)"),
    Rule("MEDIUM", "permissions open to everyone", ("chmod",), r"chmod[ \t]*\([^)]*0o?777"),
    Rule("HIGH", "web server in debug mode", ("debug",), r"\.run\(.*debug[ \t]*=[ \t]*True"),
    Rule("HIGH", "clear-text protocol module", ("telnetlib", "ftplib"),
         r"^[ \t]*(?:import|from)[ \t]+(?:telnetlib|ftplib)"),
    Rule("LOW", "assert vanishes in optimised runs", ("assert",), r"^[ \t]*assert[ \t(]"),
    Rule("LOW", "random numbers unfit for secrets", ("random.",),
         r"random\.(?:random|randrange|randint|choice|uniform|triangular)[ \t]*\("),
)


def _holds(text: Column, rule: Rule) -> Column:
    return reduce(or_, [F.contains(text, F.lit(n)) for n in rule.needles])


def _hit(line: Column, rule: Rule) -> Column:
    found = _holds(line, rule) & line.rlike(rule.pattern)
    return found & ~F.contains(line, F.lit(rule.unless)) if rule.unless else found


def findings(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All (severity, text, line) hits in line order, then rule order; null text gives null.

    Each rule is gated by a byte search of the whole text, and only rules that pass it look
    at lines. Texts that no rule passes are not even cut into lines.
    """
    kind = f"array<{FINDING.simpleString()}>"
    none = F.array().cast(kind)
    suspect = reduce(or_, [_holds(text, r) for r in rules])

    def of_lines(lines: Column) -> Column:
        def hits(place: int, rule: Rule) -> Column:
            at = F.transform(lines, lambda line, i: F.when(_hit(line, rule), F.struct(
                (i + 1).cast("int").alias("line"), F.lit(place).alias("rule"))))
            return F.when(_holds(text, rule), F.array_compact(at))

        by_rule = [hits(place, rule) for place, rule in enumerate(rules)]
        found = F.array_sort(F.flatten(F.array_compact(F.array(*by_rule))))
        named = F.array(*(F.struct(F.lit(r.severity).alias("severity"), F.lit(r.text).alias("text")) for r in rules))
        return F.transform(found, lambda f: F.struct(
            F.get(named, f["rule"])["severity"].alias("severity"),
            F.get(named, f["rule"])["text"].alias("text"), f["line"].alias("line"))).cast(kind)

    # The lines are bound once; an expression would be repeated for every rule.
    split = F.element_at(F.transform(F.array(F.split(text, LINE_BREAK, -1)), of_lines), 1)
    return F.when(suspect, split).otherwise(F.when(text.isNotNull(), none))


def count_severity(found: Column, severity: str) -> Column:
    return F.size(F.filter(found, lambda f: f["severity"] == severity)).cast("bigint")


def score(found: Column) -> Column:
    """1 less a penalty per finding, not below 0; 0.5 where the text could not be scanned."""
    points = reduce(
        lambda left, item: left - count_severity(found, item[0]) * item[1],
        PENALTY.items(),
        F.lit(100).cast("bigint"),
    )
    return F.when(found.isNull(), F.lit(UNKNOWN_SCORE)).otherwise(
        F.greatest(points, F.lit(0)) / F.lit(100)
    )


def max_severity(found: Column) -> Column:
    """The gravest severity among the findings, or NONE."""
    ranked = F.lit("NONE")
    for severity in SEVERITIES:
        ranked = F.when(F.exists(found, lambda f: f["severity"] == severity), severity).otherwise(ranked)
    return ranked
