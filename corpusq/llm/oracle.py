"""DuckDB SQL for those of the ten operators that SQL can express.

Rules and word lists are shared with the operators on purpose: they are parameters, and the
SQL checks what is computed from them.
"""

from __future__ import annotations

from corpusq.llm import audit, chat, mixing, quality

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def mix_sql(documents: str = "documents") -> str:
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return f"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size,
    md5('mix' || coalesce(doc_id::VARCHAR, '')) AS key FROM {documents}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([{weights}])[1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(mixing.WEIGHTS)}]::BIGINT
    AS weight, source_size * {mixing.PASSES} AS cap FROM s),
c AS (SELECT *, cap / weight AS fill,
    (SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER o, 0) AS words_left,
    sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS weight_left FROM w
    WINDOW o AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT words_left AS l, weight_left AS wl FROM c WHERE words_left * weight <= cap * weight_left
    ORDER BY fill, source IS NULL, source LIMIT 1),
t AS (SELECT source, source_size, least((weight * l)::DOUBLE / wl::DOUBLE, cap::DOUBLE) AS target FROM c, f),
q AS (SELECT doc_id, size, source_size, target,
    (sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS served
    FROM d JOIN t USING (source))
SELECT doc_id, size, source_size, target, (SELECT sum(greatest(0, least(size,
    floor(target)::BIGINT - (p * source_size + served - size)))) FROM range({mixing.PASSES}) r(p))::BIGINT AS taken
FROM q"""


def quality_sql(documents: str = "documents") -> str:
    stops = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS.split())))
    tests = []
    for r in quality.RULES:
        t = [f"100 * {r.numerator} >= {r.low} * {r.denominator}"] if r.low is not None else []
        t += [f"100 * {r.numerator} <= {r.high} * {r.denominator}"] if r.high is not None else []
        test = " AND ".join(t)
        tests.append(f"({test}{f' OR n_words < {r.min_words}' if r.min_words else ''})")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM {documents}),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda s: length(trim(s, ' ' || chr(9) || chr(11) || chr(12) || chr(13))) > 0) AS lines FROM d),
p AS (SELECT row, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
g AS (SELECT row, i, words[i:i+4] AS g FROM p),
r AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS n FROM g) WHERE n > 1),
rw AS (SELECT row, count(DISTINCT i + k)::BIGINT AS n FROM r, range(5) o(k) GROUP BY row),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(rw.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS n_capitals,
    length(text) - length(regexp_replace(text, '\p{{L}}+', '', 'g')) AS n_letters,
    len(list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}]+'), lambda x: x IN ({stops}))) AS n_stop_words,
    len(list_filter(lines, lambda s: ends_with(rtrim(s), '...') OR ends_with(rtrim(s), '…'))) AS n_ellipsis_lines
    FROM w LEFT JOIN rw USING (row)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {' AND '.join(tests)} AS kept FROM b"""


def _escaped(text: str) -> str:
    for char, reference in chat.REFERENCES:
        text = f"replace({text}, '{char}', '{reference}')"
    return text


def chat_sql() -> str:
    said = r"\### Assistant: </turn> ok"
    fixed = len(chat.HEAD + chat.HEAD_END + chat.END)
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{said}' UNION ALL SELECT -7, 1, 'assistant', '{said}'),
o AS (SELECT *, coalesce(role <> lag(role) OVER w, true) AS first FROM c
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (SELECT conv_id, count(*)::BIGINT AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length({_escaped('text')}) + CASE WHEN first THEN {fixed} + length({_escaped('role')})
        ELSE {len(chat.BETWEEN)} END)::BIGINT AS formatted_chars
    FROM o GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
    sha256(loss) AS loss_sha256, formatted_chars FROM s"""


def audit_sql() -> str:
    letters = ", ".join(f"('{x}')" for x in audit.FILTERS)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
f AS (SELECT doc_id, part, text, len(words) < {audit.MIN_WORDS} AS a,
    100 * len(list_distinct(words)) < {audit.DISTINCT_PERCENT} * len(words) AS b,
    100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {audit.CAPITALS_PERCENT} * length(text) AS c,
    regexp_matches(text, '{audit.SYMBOLS}') AS d FROM w),
m AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
l AS (SELECT doc_id, max(coalesce(quality, 0)) AS good, max(coalesce(toxic, 0)) AS toxic FROM labels GROUP BY doc_id),
x AS (SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END,
    CASE WHEN c THEN 'C' ELSE '' END, CASE WHEN d THEN 'D' ELSE '' END,
    CASE WHEN coalesce(f.doc_id > m.least, false) THEN 'E' ELSE '' END) AS fails,
    coalesce(l.good, 0) = 1 AS good, coalesce(l.toxic, 0) = 1 AS toxic
    FROM f JOIN m USING (text) LEFT JOIN l ON l.doc_id = f.doc_id),
k AS (SELECT part, fails, good, toxic, count(*) AS n FROM x GROUP BY ALL),
p AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM (VALUES {letters}) a(x), (VALUES {letters}) b(x),
    (VALUES {letters}) c(x), (VALUES {letters}) d(x), (VALUES {letters}) e(x)
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
o AS (SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS earlier
    FROM p, range(1, 6) r(step)),
j AS (SELECT part, filter_order, step, letter, n, good, toxic, contains(fails, letter) AS here,
    len(list_filter(str_split(earlier, ''), lambda ch: ch <> '' AND contains(fails, ch))) > 0 AS before,
    fails = letter AS alone FROM k, o),
c AS (SELECT part, filter_order, step::INTEGER AS step, letter,
    sum(n) FILTER (NOT before AND NOT here)::BIGINT AS kept,
    coalesce(sum(n) FILTER (here AND NOT before), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (here AND before), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (here AND NOT before AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (here AND NOT before AND toxic), 0)::BIGINT AS toxic_lost
    FROM j GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM c"""


def llm_oracles() -> dict[str, str]:
    return {"op1_mix_sources": mix_sql(), "op3_quality_rules": quality_sql(), "op4_chat_format": chat_sql(),
            "op13_filter_audit": audit_sql()}
