"""Line, character and comment measures of a text, as native column expressions.

Line ends and blanks follow Python's ``str.splitlines`` and ``str.strip``; the
measures hold for every Unicode text and never leave the JVM.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that end a line, and those that are blank without ending one.
LINE_ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
INLINE_BLANKS = (
    "\t \x1f\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
BLANKS = LINE_ENDS + INLINE_BLANKS


def char_class(chars: str) -> str:
    """The inside of a regex class listing ``chars``, in syntax Java and RE2 share."""
    return "".join(rf"\x{{{ord(c):x}}}" for c in chars)


END_CLASS = f"[{char_class(LINE_ENDS)}]"
BLANK_CLASS = f"[{char_class(INLINE_BLANKS)}]"
LINE_BREAK = rf"\r\n|{END_CLASS}"


def _has(text: Column, needle: str) -> Column:
    return F.contains(text, F.lit(needle))


def _without(text: Column, needle: str) -> Column:
    return F.replace(text, F.lit(needle), F.lit(""))


def strip(text: Column) -> Column:
    """Drop blanks of every kind from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def content_hash(text: Column) -> Column:
    """Hex SHA-256 of the stripped text's UTF-8 bytes."""
    return F.sha2(strip(text), 256)


def has_unusual_ends(text: Column) -> Column:
    """True where some line ends in anything but a bare line feed.

    Few texts do. This is a plain byte search, and it spares all others the slower
    general treatment in the functions below; each takes its result as ``unusual``
    where the caller has it at hand already.
    """
    return reduce(or_, [_has(text, c) for c in LINE_ENDS[1:]])


def length_without_line_ends(text: Column, unusual: Column | None = None) -> Column:
    unusual = has_unusual_ends(text) if unusual is None else unusual
    return F.when(unusual, F.length(F.regexp_replace(text, END_CLASS, ""))).otherwise(
        F.length(_without(text, "\n"))
    )


def line_count(text: Column, unusual: Column | None = None, unended: Column | None = None) -> Column:
    """Number of lines; a closing line end opens no further line, CR LF ends one.

    ``unended`` may pass in ``length_without_line_ends``.
    """
    unusual = has_unusual_ends(text) if unusual is None else unusual
    ends = F.length(text) - (length_without_line_ends(text, unusual) if unended is None else unended)
    pairs = ((F.length(text) - F.length(_without(text, "\r\n"))) / 2).cast("int")
    closed = reduce(or_, [F.endswith(text, F.lit(c)) for c in LINE_ENDS])
    tail = F.when(closed | (text == ""), 0).otherwise(1)
    return (ends - F.when(unusual, pairs).otherwise(0) + tail).cast("int")


def at_least_one(n: Column) -> Column:
    return F.greatest(n, F.lit(1))


def alphanumeric_fraction(text: Column) -> Column:
    """Share of code points in the letter and number categories."""
    kept = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))
    return kept / at_least_one(F.length(text))


def comment_line_count(text: Column, unusual: Column | None = None) -> Column:
    """Lines whose first non-blank character is ``#``."""
    unusual = has_unusual_ends(text) if unusual is None else unusual
    after_end = F.when(unusual, F.regexp_count(text, F.lit(rf"{END_CLASS}{BLANK_CLASS}*#"))).otherwise(
        F.regexp_count(text, F.lit(rf"\n{BLANK_CLASS}*#"))
    )
    first = F.startswith(F.ltrim(text, F.lit(INLINE_BLANKS)), F.lit("#")).cast("int")
    return F.when(_has(text, "#"), after_end + first).otherwise(F.when(text.isNotNull(), 0))
