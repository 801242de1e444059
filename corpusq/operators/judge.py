"""Usefulness judgements: which rows to ask about, what to ask, and what came back.

The call to a hosted model is not part of the library. ``judge_prompts`` yields
the questions as a table, and a table of raw replies comes back in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusq.config import Settings
from corpusq.functions import text as tx

RUBRIC = (
    "You review source files for a beginners' programming course. Read the file between the fences and decide\n"
    "whether a tutor should hand it out. Weigh, in this order: does it run as it stands; can a newcomer follow\n"
    "it without outside help; is each name and comment true to what happens; would copying it do harm.\n\n"
    "Answer on a scale of 1 (never hand out) to 5 (hand out as a model), as JSON with the keys score and reason,\n"
    "the reason in a few words. Write nothing around it.\n\n"
)
FENCE = "```"


def judge_sample_ids(df: DataFrame, settings: Settings = Settings(), id_col: str = "id") -> DataFrame:
    """Ids of exactly min(n, rows) rows, drawn uniformly without replacement; of all without n.

    A seeded hash of the id orders the rows, so the draw does not depend on
    partitioning. Only the narrow id column takes part, ranked within hash ranges, so
    that no size of the sample passes through one task.
    """
    n = settings.judge_sample_size
    if n is None:
        return df.select(id_col)
    key = F.md5(F.concat_ws(":", F.lit(str(settings.judge_seed)), F.col(id_col).cast("string")))
    # 65,536 ranges of even size, as the hash is uniform; their counts are one small table.
    ranged = df.select(id_col, key.alias("_draw"), F.substring(key, 1, 4).alias("_range"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
        .filter(F.col("_before") < n)
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_draw", id_col))
    return (
        ranged.join(starts, "_range").withColumn("_place", F.col("_before") + place)
        .filter(F.col("_place") <= n).select(id_col)
    )


def judge_sample(df: DataFrame, settings: Settings = Settings(), id_col: str = "id") -> DataFrame:
    """The sampled rows with all their columns."""
    if settings.judge_sample_size is None:
        return df
    return df.join(judge_sample_ids(df, settings, id_col), id_col, "left_semi")


def judge_prompts(df: DataFrame, settings: Settings = Settings(), id_col: str = "id",
                  content_col: str = "content") -> DataFrame:
    """(id, prompt) per row; the prompt quotes the text, or its opening characters if so set."""
    cut = settings.judge_prefix_chars
    quoted = F.col(content_col) if cut is None else F.substring(content_col, 1, cut)
    return df.select(
        id_col,
        F.concat(F.lit(RUBRIC + FENCE + "\n"), quoted, F.lit("\n" + FENCE)).alias("prompt"),
    )


def reply_body(reply: Column) -> Column:
    """The JSON text of a reply: stripped, and taken out of its fence if it is fenced."""
    plain = tx.strip(reply)
    fenced = tx.strip(F.ltrim(F.get(F.split(plain, FENCE, -1), F.lit(1)), F.lit("json")))
    return F.when(F.startswith(plain, F.lit(FENCE)), fenced).otherwise(plain)


def parse_replies(df: DataFrame, reply_col: str = "reply") -> DataFrame:
    """Add llm_score and llm_reason; both null where the reply is not one JSON object.

    A mark outside 1 to 5, or none, gives a null score; a missing reason reads as "".
    """
    body = F.col("_body")
    # from_json alone would take the first of several values, or of an array.
    single = F.startswith(body, F.lit("{")) & (
        F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1
    )
    parsed = F.from_json(F.when(single, body), "score double, reason string, _corrupt string",
                         {"columnNameOfCorruptRecord": "_corrupt"})
    with_reply = df.withColumn("_body", reply_body(F.col(reply_col))).withColumn("_parsed", parsed)
    p = F.col("_parsed")
    return with_reply.withColumns(
        {
            "llm_score": F.when(p["score"].between(1, 5), p["score"]),
            "llm_reason": F.when(single, F.coalesce(p["reason"], F.lit(""))),
        }
    ).drop("_body", "_parsed")


def attach_judgements(df: DataFrame, replies: DataFrame | None, settings: Settings = Settings(),
                      id_col: str = "id") -> DataFrame:
    """Left-join parsed replies to their rows; rows without a reply stay unjudged.

    ``replies`` holds (id, reply), and each of them counts: the sample decides what to ask,
    not which answers are heard. Of several replies to one row the usable one with the
    lowest mark counts, so a failed reply never cancels a good one.
    Without a table of replies no row is judged.
    """
    df = df.drop("llm_score", "llm_reason")
    if replies is None:
        return df.withColumns({"llm_score": F.lit(None).cast("double"),
                               "llm_reason": F.lit(None).cast("string")})
    score, reason = F.col("llm_score"), F.col("llm_reason")
    mark = F.struct(score.isNull().alias("unusable"), score, reason.isNull().alias("unread"), reason)
    marks = (
        parse_replies(replies.select(id_col, "reply")).groupBy(id_col).agg(F.min(mark).alias("_mark"))
        .select(id_col, "_mark.llm_score", "_mark.llm_reason")
    )
    return df.join(marks, id_col, "left")
