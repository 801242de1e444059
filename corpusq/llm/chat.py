"""Chat formatting: conversations become one templated text each, natively and reversibly.

A conversation's turns are collected as structs and sorted, adjacent turns of one role are
merged, and the pieces are joined. The template of a block of merged turns is

    ### role: text</seg>text</turn>

``&``, ``<``, ``#`` and (in roles) ``:`` inside texts are written as character references, so
that no marker can occur in a text and reading back is splitting on markers. The loss mask
is a list of character spans, each within its block, covering every assistant text once.

Defined cases: null texts and roles count as empty; turns sort by (turn, role, text) with
null turns first, so ties and repeated rows come out alike on every run; rows with a null
conversation id form one conversation. Extra columns are ignored. Tables without rows give
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import let

# The template's markers, and what stands for a control character in a text.
HEAD, HEAD_END, BETWEEN, END = "### ", ": ", "</seg>", "</turn>\n"
REFERENCES = (("&", "&amp;"), ("<", "&lt;"), ("#", "&num;"), (":", "&colon;"))
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    for char, reference in REFERENCES:
        text = F.replace(text, F.lit(char), F.lit(reference))
    return text


def unescape(text: Column) -> Column:
    for char, reference in reversed(REFERENCES):
        text = F.replace(text, F.lit(reference), F.lit(char))
    return text


def _merged(turns: Column) -> Column:
    """Sorted turns as blocks of adjacent turns with one role: (role, texts)."""
    firsts = F.filter(
        F.transform(turns, lambda t, i: F.when(
            (i == 0) | (F.get(turns, i - 1)["role"] != t["role"]), i)),
        lambda i: i.isNotNull(),
    )

    def cut(at: Column) -> Column:
        return F.transform(at, lambda i, k: F.struct(
            F.get(turns, i)["role"].alias("role"),
            F.transform(
                F.slice(turns, i + 1, F.coalesce(F.get(at, k + 1), F.size(turns)) - i),
                lambda t: t["text"],
            ).alias("texts"),
        ))

    return let(firsts, cut)


def _spans(block: Column, number: Column) -> Column:
    """Where the learned texts of one block lie: (block, start, length) in characters."""
    first = F.length(F.lit(HEAD + HEAD_END)) + F.length(block["role"])
    lengths = F.transform(block["texts"], lambda t: F.length(t))
    # Each text moves the next by its own length and the separator's.
    ends = let(lengths, lambda ls: F.aggregate(
        ls, F.array().cast("array<int>"),
        lambda done, n: F.array_append(done, F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)) + n + len(BETWEEN)),
    ))
    return F.when(
        block["role"] == LEARNED_ROLE,
        let(F.struct(lengths.alias("n"), ends.alias("e")), lambda x: F.transform(
            x["n"], lambda n, k: F.struct(
                number.alias("block"),
                (first + F.coalesce(F.get(x["e"], k - 1), F.lit(0))).alias("start"),
                n.alias("length")))),
    ).otherwise(F.array().cast("array<struct<block:int,start:int,length:int>>"))


def format_chats(df: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation: its id, ``formatted``, ``blocks`` and ``loss_spans``.

    ``formatted`` is the concatenation of ``blocks``; spans refer to blocks by place from 0.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        escape(F.coalesce(F.col("role"), F.lit(""))).alias("role"),
        escape(F.coalesce(F.col("text"), F.lit(""))).alias("text"),
    )
    merged = (
        df.groupBy(F.col(conv)).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
        .select(conv, let(F.col("turns"), _merged).alias("merged"))
    )
    blocks = F.transform("merged", lambda b: F.concat(
        F.lit(HEAD), b["role"], F.lit(HEAD_END), F.array_join(b["texts"], BETWEEN), F.lit(END)))
    return merged.select(
        conv,
        blocks.alias("blocks"),
        F.flatten(F.transform("merged", _spans)).alias("loss_spans"),
    ).select(conv, F.array_join("blocks", "").alias("formatted"), "blocks", "loss_spans")


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation, merged turns apart again."""
    def turns(block: Column) -> Column:
        role = F.substring_index(F.substr(block, F.lit(len(HEAD) + 1)), HEAD_END, 1)
        body = F.substr(block, F.length(role) + len(HEAD + HEAD_END) + 1)
        return F.transform(F.split(body, BETWEEN), lambda t: F.struct(
            unescape(role).alias("role"), unescape(t).alias("text")))

    blocks = F.filter(F.split(formatted, END), lambda b: b != "")
    return F.flatten(F.transform(blocks, turns))


def read_loss(blocks: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, spans in order with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(F.get(blocks, s["block"]), s["start"] + 1, s["length"]))), "")
