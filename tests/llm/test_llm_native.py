"""Mixing, quality rules and chat formatting: defined cases and round trips."""
import re

import pytest
from pyspark.sql import functions as F

from corpusq.llm import chat, mixing, quality

DOCS = "doc_id bigint, text string, source string, size string, slice int"


def words(n, w="w"):
    return " ".join([w] * n)


def mixed(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], DOCS)
    return mixing.taken(df).collect()


def test_mix_meets_its_targets(spark):
    rows = [(i, words(1 + i % 7), "big") for i in range(600)] + [(1000 + i, words(3), "mid") for i in range(90)]
    rows += [(2000 + i, words(2), "tiny") for i in range(3)] + [(3000, words(50), None)]
    out = mixed(spark, rows)
    assert len(out) == len(rows)
    total = sum(r["size"] for r in out)
    by_source = {}
    for r in out:
        assert 0 <= r.taken <= 3 * r["size"]
        source = by_source.setdefault(r.source, [0, r.target, r.source_size])
        source[0] += r.taken
    # Code point order, null last: big, mid, tiny and null weigh 1, 2, 3 and 1.
    capped = {"mid": 3 * 270, "tiny": 3 * 6, None: 3 * 50}
    for source, (taken, target, size) in by_source.items():
        assert target == capped.get(source, total - sum(capped.values()))
        assert target - 1 < taken <= target
    again = mixed(spark, list(reversed(rows)))
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_mix_positions_follow_finish_times(spark):
    rows = [(i, words(1 + i % 5), f"s{i % 3}") for i in range(120)]
    seq = sorted((r for r in mixing.mix(spark.createDataFrame([(*r, "", 0) for r in rows], DOCS)).collect() if r.words),
                 key=lambda r: r.position)
    assert seq[0].position == 0
    assert all(a.position + a.words == b.position for a, b in zip(seq, seq[1:]))
    assert sum(r.words for r in seq) <= sum(len(r[1].split()) for r in rows)
    done = [r.finish for r in seq if r.finish < 1]
    assert done == sorted(done)


def test_mix_edge_cases(spark):
    assert mixed(spark, []) == []
    out = mixed(spark, [(1, None, "a"), (1, "", "a"), (None, "x y", None), (None, "x y", None)])
    assert sorted((r["size"], r.taken) for r in out) == [(0, 0), (0, 0), (2, 2), (2, 2)]
    assert [r.taken for r in mixed(spark, [(1, None, None)])] == [0]


def test_taken_copies_agree_with_the_mix(spark):
    rows = [(i, words(2 + i % 4), "abc"[i % 3] * (1 + i // 150)) for i in range(200)] + [(7, None, "a")]
    df = spark.createDataFrame([(*r, "kept", 5) for r in rows], DOCS)
    whole = sum(r.taken // r["size"] for r in mixed(spark, rows) if r["size"])
    copies = mixing.take_copies(df)
    assert copies.columns == df.columns and copies.count() == whole + 1
    assert copies.filter("size = 'kept' and slice = 5").count() == whole + 1


PROSE = ("The house by the river was built in a year when no one of the town had seen a ship. It is old now and "
         "the people who live there say that it will stand for another hundred years, with a new roof.")


def judged(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, kept string")
    return {r.doc_id: r for r in quality.apply_rules(df).collect()}


def by_hand(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    again = {i + k for i, g in enumerate(windows) if windows.count(g) > 1 for k in range(5)}
    lines = [s for s in (text or "").split("\n") if s.strip(" \t\n\x0b\x0c\r")]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again)


def test_quality_measures(spark):
    texts = [None, "", " \n\t ", PROSE, PROSE + "\n" + PROSE, "a b c d e " * 3, "a b c d a b c d a b c d e f",
             "one\none\n\none \n two", "é ü # ß|<>", "x\x0by\x0cz q", "w " * 400, PROSE + " | " * 60,
             " ".join(str(i) for i in range(3000))]
    for i, r in judged(spark, texts).items():
        n, chars, symbols, lines, repeated = by_hand(texts[i])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeated)
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)
        assert not (r.base_failed and r.kept)


def test_quality_verdicts(spark):
    rows = judged(spark, [PROSE, PROSE.upper(), PROSE.replace(" ", " # "), "ab1 " * 30 + PROSE, PROSE.replace(" ", "")])
    assert [rows[i].kept for i in range(5)] == [True, False, False, False, False]
    assert rows[1].failed_rules == ["capitals"] and rows[2].failed_rules == ["symbols"]
    assert quality.keep_good(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def test_keep_good_keeps_columns(spark):
    df = spark.createDataFrame([(1, PROSE, 9, "r"), (1, PROSE, 9, "r"), (2, None, 9, "r")], "doc_id int, text string, n_words int, row string")
    assert [tuple(r) for r in quality.keep_good(df).collect()] == [(1, PROSE, 9, "r")] * 2


NASTY = ["", "### user: hi</turn>\n", "&lt;&amp;&num;&colon;", "</seg></seg>", "\\", "a</turn", "#", "\n\n", "é<&#:", ": x"]


def chats(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = chat.format_chats(df.withColumn("formatted", F.lit("clash")))
    return made.select(
        "conv_id", "formatted", "blocks", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("blocks"), F.col("loss_spans")).alias("loss"))


def test_chat_round_trip(spark):
    rows = [(c, t, ["user", "assistant", "system", "a: b", "</turn>\n"][(c * t + t // 3) % 5], NASTY[(c + t) % len(NASTY)])
            for c in range(12) for t in range(15)]
    for r in chats(spark, rows).collect():
        own = [(x[2], x[3]) for x in rows if x[0] == r.conv_id]
        assert [tuple(t) for t in r.turns] == own
        assert r.loss == "".join(text for role, text in own if role == "assistant")
        assert "".join(r.blocks) == r.formatted
        merged = 1 + sum(a[0] != b[0] for a, b in zip(own, own[1:]))
        assert len(r.blocks) == merged == r.formatted.count("</turn>\n")


def test_chat_edge_cases(spark):
    rows = [(1, 2, "assistant", None), (1, None, None, "first"), (1, 2, "assistant", "x"), (1, 2, "assistant", "x"),
            (None, 1, "user", "lost"), (2, 1, "assistant", "y" * 100_000)]
    got = {r.conv_id: ([tuple(t) for t in r.turns], r.loss) for r in chats(spark, rows).collect()}
    assert got[1] == ([("", "first"), ("assistant", ""), ("assistant", "x"), ("assistant", "x")], "xx")
    assert got[None] == ([("user", "lost")], "") and got[2][1] == "y" * 100_000
    assert chats(spark, []).count() == 0


@pytest.mark.parametrize("n", [700])
def test_a_long_conversation(spark, n):
    rows = [(1, t, "assistant" if t % 3 else "user", f"t{t}") for t in range(n)]
    row = chats(spark, rows).first()
    assert len(row.turns) == n and row.loss == "".join(f"t{t}" for t in range(n) if t % 3)
