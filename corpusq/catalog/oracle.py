"""DuckDB SQL that recomputes each registered query from the given tables.

Texts are measured and scanned by DuckDB's own functions. Security rules, permutations of
the signature and the prompt are shared with the code: they are parameters, and the SQL
checks what is computed from them. The structure of rendered
texts is taken from document-number arithmetic, so no parser is trusted twice.
"""

from __future__ import annotations

from corpusq.catalog.queries import FIRST_N, SAMPLED, TABLE_SOURCES, WIDE_FROM
from corpusq.catalog.rendered import ALIASED
from corpusq.config import Settings
from corpusq.functions import minhash, security

S = Settings()
# Spelt out apart from the code under test: what ends a line, and what else is blank.
END = r"[\x{a}-\x{d}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
INLINE = r"[\x{9}\x{1f}\x{20}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
STRIP_SET = "||".join(f"chr({n})" for n in [
    *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])
RUN_DATE, RUN_STAMP = "2024-05-17", "2024-05-17T10:30:00"


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def with_ctes(*ctes: str, final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


# ---- texts ----------------------------------------------------------------------------

NL = "chr(10)"
RENDERED = f"""rendered AS (
  SELECT doc_id, k, dup, printf('rendered_python_%06d', doc_id) AS id,
    (CASE WHEN dup THEN {NL}||{NL} ELSE '' END)
    || (CASE WHEN k % 2 = 0 THEN '\"\"\"Module '||k||'.\"\"\"'||{NL} ELSE '' END)
    || repeat('# note'||{NL}, k % 6)
    || repeat('def f(x):'||{NL}||'    return x'||{NL}, k % 5)
    || repeat('class C:'||{NL}||'    def m(self):'||{NL}||'        return 1'||{NL}, k % 3)
    || (CASE WHEN k % 7 = 0 THEN 'async def g():'||{NL}||'    return 0'||{NL} ELSE '' END)
    || repeat('x = '||k||{NL}, k % 13)
    || (CASE WHEN k % 17 = 0 THEN 'eval("1")'||{NL} ELSE '' END)
    || (CASE WHEN k % 4 = 1 THEN 'password = "hunter2x"'||{NL} ELSE '' END)
    || (CASE WHEN k % 19 = 0 THEN {quoted(ALIASED)} ELSE '' END)
    || (CASE WHEN k % 11 = 0 THEN 'def broken(:'||{NL} ELSE '' END) AS content
  FROM (SELECT doc_id, doc_id % 10 = 9 AS dup,
               CAST(CASE WHEN doc_id % 10 = 9 THEN doc_id - 1 ELSE doc_id END AS BIGINT) AS k FROM documents))"""

STRUCTURE = """structure AS (
  SELECT id, k % 11 <> 0 AS is_parseable,
    CAST(CASE WHEN k % 11 = 0 THEN 0 ELSE k % 5 + k % 3 END AS BIGINT) AS num_functions,
    CAST(CASE WHEN k % 11 = 0 THEN 0 ELSE k % 3 END AS BIGINT) AS num_classes,
    k % 11 <> 0 AND k % 2 = 0 AS has_docstring
  FROM rendered)"""

BOTH = """corpora AS (
  SELECT printf('documents_text_%06d', doc_id) AS id, 'documents' AS source, 'text' AS language, text AS content
  FROM documents
  UNION ALL SELECT id, 'rendered', 'python', content FROM rendered)"""


def measures(source: str, name: str = "measured") -> str:
    return f"""{name} AS (
  SELECT *, length(regexp_replace(content, '{END}', '', 'g'))::DOUBLE / greatest(num_lines, 1) AS avg_line_length,
    length(regexp_replace(content, '[^\\p{{L}}\\p{{N}}]', '', 'g'))::DOUBLE / greatest(length(content), 1)
      AS alphanum_fraction,
    len(regexp_extract_all(content, '(?:\\A|{END}){INLINE}*#'))::DOUBLE / greatest(num_lines, 1) AS comment_ratio
  FROM (SELECT *, CAST(len(regexp_extract_all(content, '\\r\\n|{END}'))
          + CASE WHEN length(content) > 0 AND NOT regexp_matches(content, '{END}\\z') THEN 1 ELSE 0 END
          AS INTEGER) AS num_lines FROM {source}))"""


HASH = f"sha256(trim(content, {STRIP_SET}))"
PASSES = (f"num_lines BETWEEN {S.min_lines} AND {S.max_lines} AND alphanum_fraction >= {S.min_alphanum}"
          f" AND avg_line_length <= {S.max_avg_line_length}")
MEASURED = "id, num_lines, avg_line_length, alphanum_fraction, comment_ratio"
TEXTS = (RENDERED, BOTH, measures("corpora"))

# First copy per text within each corpus, then the cut-offs.
CLEANED = f"""cleaned AS (
  SELECT m.id, source, language, content, content_hash, num_lines, avg_line_length, alphanum_fraction,
    comment_ratio, s.is_parseable, coalesce(s.num_functions, 0) AS num_functions,
    coalesce(s.num_classes, 0) AS num_classes, coalesce(s.has_docstring, false) AS has_docstring
  FROM (SELECT *, row_number() OVER (PARTITION BY source, content_hash ORDER BY id) AS copy
        FROM (SELECT *, {HASH} AS content_hash FROM measured)) m
  LEFT JOIN structure s ON s.id = m.id
  WHERE copy = 1 AND {PASSES})"""


# A run over both corpora as one Python source: code first, then prose, which as a rule
# does not parse; numbered in that order.
FULL_CLEANED = f"""numbered AS (
  SELECT *, row_number() OVER (ORDER BY source <> 'rendered', id) - 1 AS position FROM measured),
cleaned AS (
  SELECT printf('rendered_python_%06d', position) AS id, 'rendered' AS source, 'python' AS language, content,
    content_hash, num_lines, avg_line_length, alphanum_fraction, comment_ratio,
    coalesce(s.is_parseable, false) AS is_parseable, coalesce(s.num_functions, 0) AS num_functions,
    coalesce(s.num_classes, 0) AS num_classes, coalesce(s.has_docstring, false) AS has_docstring
  FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY position) AS copy
        FROM (SELECT *, {HASH} AS content_hash FROM numbered)) m
  LEFT JOIN structure s ON s.id = m.id
  WHERE copy = 1 AND {PASSES})"""


# ---- scores ---------------------------------------------------------------------------

def found(source: str) -> str:
    """Findings by lines; for Python that parses, comment lines give none and the calls behind
    the rendered aliases (which no line rule sees) are expected from the syntax tree."""
    rules = ",\n    ".join(
        f"({i}, '{r.severity}', {quoted(r.text)}, {quoted(r.pattern)}, {quoted(r.unless or chr(0x110000 - 1))}, false)"
        for i, r in enumerate(security.RULES)
    )
    system, shell = security.RULES[3], security.RULES[2]
    tree = (f"(100, '{system.severity}', {quoted(system.text)}, '^run_cmd\\(', {quoted(chr(0x110000 - 1))}, true),\n"
            f"    (101, '{shell.severity}', {quoted(shell.text)}, 'shell=1\\)', {quoted(chr(0x110000 - 1))}, true)")
    return f"""rules(rule, severity, text, pattern, unless, tree) AS (VALUES
    {rules},
    {tree}),
found AS (
  SELECT id, severity, rules.text, CAST(line AS INTEGER) AS line FROM (
    SELECT id, parsed, unnest(parts) AS body, generate_subscripts(parts, 1) AS line
    FROM (SELECT c.id, coalesce(c.language = 'python' AND st.is_parseable, false) AS parsed,
            string_split_regex(c.content, '\\r\\n|{END}') AS parts
          FROM {source} c LEFT JOIN structure st ON st.id = c.id)) lines
  JOIN rules ON (parsed OR NOT tree) AND NOT (parsed AND regexp_matches(body, '^[ \\t]*#'))
    AND regexp_matches(body, pattern) AND NOT contains(body, unless)),
per_row AS (
  SELECT id, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (severity = 'HIGH') AS BIGINT) AS high,
    sum(CASE severity WHEN 'HIGH' THEN 30 WHEN 'MEDIUM' THEN 15 WHEN 'LOW' THEN 5 ELSE 0 END) AS cost,
    max(CASE severity WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END) AS worst
  FROM found GROUP BY id)"""


SYNTACTIC = """CASE WHEN is_parseable THEN greatest(0, least(100, 100
    - CASE WHEN num_lines < 10 THEN 15 ELSE 0 END
    - CASE WHEN avg_line_length > 120 THEN 10 WHEN avg_line_length > 80 THEN 5 ELSE 0 END
    - CASE WHEN alphanum_fraction < 0.35 THEN 20 ELSE 0 END
    + CASE WHEN num_functions > 0 OR num_classes > 0 THEN 5 ELSE 0 END))::DOUBLE / 100 ELSE 0.0::DOUBLE END"""
DOC = """greatest(0, least(100, CASE WHEN has_docstring THEN 50 ELSE 0 END
    + CASE WHEN comment_ratio >= 0.10 THEN 30 WHEN comment_ratio >= 0.05 THEN 15 ELSE 0 END
    - CASE WHEN num_functions >= 3 AND NOT has_docstring THEN 10 ELSE 0 END))::DOUBLE / 100"""

# Structure of both corpora: prose is no Python and is not parsed.
BOTH_STRUCTURE = """SELECT m.*, s.is_parseable, coalesce(s.num_functions, 0) AS num_functions,
    coalesce(s.num_classes, 0) AS num_classes, coalesce(s.has_docstring, false) AS has_docstring
  FROM measured m LEFT JOIN structure s USING (id)"""

REPLIES = """replies AS (
  SELECT doc_id,
    CASE WHEN doc_id % 11 = 0 OR (doc_id % 13 <> 0 AND (doc_id % 17 = 0 OR doc_id % 19 = 0)) THEN NULL
         ELSE (1 + 4 * quality)::DOUBLE END AS llm_score,
    CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN '' WHEN doc_id % 17 = 0 THEN 'off the scale'
         WHEN doc_id % 19 = 0 THEN 'no mark' ELSE 'r' || doc_id END AS llm_reason
  FROM labels
  UNION ALL SELECT doc_id, (1 + 4 * quality)::DOUBLE, 'asked again' FROM labels WHERE doc_id % 22 = 0
  UNION ALL SELECT doc_id, 1.0::DOUBLE, 'second look' FROM labels WHERE doc_id % 23 = 1),
marks AS (SELECT * FROM replies QUALIFY row_number() OVER (
  PARTITION BY doc_id ORDER BY llm_score IS NULL, llm_score, llm_reason IS NULL, llm_reason) = 1)"""
RECORD_REPLIES = """record_marks AS (
  SELECT printf('documents_text_%06d', doc_id) AS id, llm_score, llm_reason FROM marks
  UNION ALL SELECT printf('rendered_python_%06d', doc_id), llm_score, llm_reason FROM marks)"""


def sampled(source: str) -> str:
    return f"sampled AS (SELECT id FROM {source} ORDER BY md5('{S.judge_seed}:' || id), id LIMIT {SAMPLED})"


def scored(judged: bool = True, cleaned: str = CLEANED) -> list[str]:
    marks = "LEFT JOIN record_marks j ON j.id = c.id" if judged else (
        "LEFT JOIN (SELECT '' AS id, NULL::DOUBLE AS llm_score, NULL::VARCHAR AS llm_reason) j ON j.id = c.id")
    return [RENDERED, STRUCTURE, BOTH, measures("corpora"), cleaned, found("cleaned"), REPLIES, RECORD_REPLIES,
            f"""parts AS (
  SELECT c.*, {SYNTACTIC} AS syntactic_score, {DOC} AS doc_score,
    greatest(0, 100 - coalesce(cost, 0))::DOUBLE / 100 AS security_score,
    coalesce(p.n, 0) AS security_finding_count, coalesce(p.high, 0) AS security_high_count,
    coalesce(p.worst, 0) AS worst, j.llm_score, j.llm_reason
  FROM cleaned c LEFT JOIN per_row p ON p.id = c.id {marks})""", """scored AS (
  SELECT *, CASE worst WHEN 3 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' WHEN 1 THEN 'LOW' ELSE 'NONE' END AS security_severity,
    composite_score >= 0.7 AS above_threshold, 'v0.1.0' AS pipeline_version FROM (
    SELECT *, CAST(round(CASE WHEN llm_score IS NULL
      THEN syn * 0.4375::DECIMAL(9,8) + doc * 0.3125::DECIMAL(9,8) + sec * 0.25::DECIMAL(9,8)
      ELSE syn * 0.35::DECIMAL(9,8) + doc * 0.25::DECIMAL(9,8) + sec * 0.20::DECIMAL(9,8)
        + (llm_score::DECIMAL(12,8) - 1) * 0.05::DECIMAL(9,8) END, 4) AS DOUBLE) AS composite_score
    FROM (SELECT *, syntactic_score::DECIMAL(12,8) AS syn, doc_score::DECIMAL(12,8) AS doc,
            security_score::DECIMAL(12,8) AS sec FROM parts)))"""]


SCORED_COLUMNS = """id, source, language, content_hash, num_lines, syntactic_score, doc_score, security_score,
  security_finding_count, security_high_count, security_severity, llm_score, llm_reason, composite_score,
  above_threshold,
  pipeline_version"""


def ratio(part: str, whole: str) -> str:
    return f"round(({part})::DOUBLE / nullif({whole}, 0), 6)"


# ---- MinHash --------------------------------------------------------------------------

def buckets(documents: str = "documents") -> list[str]:
    bands, rows = minhash.choose_bands(S.minhash_threshold, S.minhash_num_perm)
    perms = minhash.permutations(bands * rows)
    folded = "0"
    steps = []
    for i in range(minhash.SHINGLE):
        folded = f"(({folded} * {minhash.FOLD} + codes[j + {i}] + 1) & 4294967295)"
        steps.append(folded)
    # A text below five characters is one shingle over all it has.
    whole = "CASE len(codes) WHEN 0 THEN 0 " + " ".join(
        f"WHEN {i + 1} THEN {steps[i].replace('j + ', '1 + ')}" for i in range(minhash.SHINGLE - 1)) + " END"
    scramble = f"((xor(h, h >> 16) * {minhash.SCRAMBLE}) & 4294967295)"
    lows = ", ".join(
        f"min(({a}::UBIGINT * h + {b}::UBIGINT) % 4294967296::UBIGINT)::BIGINT AS m{i}"
        for i, (a, b) in enumerate(perms))
    keys = ", ".join(
        f"md5(concat_ws(',', {band}, " + ", ".join(f"m{band * rows + r}" for r in range(rows)) + "))"
        for band in range(bands))
    return [
        f"""codes AS (SELECT doc_id AS id, CASE WHEN text = '' THEN []::BIGINT[] ELSE
  list_transform(string_split(text, ''), lambda c: unicode(c)::BIGINT) END AS codes FROM {documents})""",
        f"""folded AS (SELECT id, unnest(CASE WHEN len(codes) < 5 THEN [{whole}] ELSE
  list_transform(range(1, len(codes) - 3), lambda j: {folded}) END)::BIGINT AS h FROM codes)""",
        f"once AS (SELECT id, {scramble} AS h FROM folded)",
        f"twice AS (SELECT id, {scramble} AS h FROM once)",
        "hashes AS (SELECT id, xor(h, h >> 16)::UBIGINT AS h FROM twice)",
        f"signatures AS (SELECT id, {lows} FROM hashes GROUP BY id)",
        f"keyed AS (SELECT id, [{keys}] AS keys FROM signatures)",
        "bands AS (SELECT id, CAST(generate_subscripts(keys, 1) - 1 AS INTEGER) AS band, unnest(keys) AS key FROM keyed)",
    ]


def kept_fold(rows: str, id_kind: str = "BIGINT") -> str:
    """Recursive fold over (pos, id, keys): keep a row iff it shares no key with the kept ones."""
    return f"""fold(pos, taken, kept, id) AS (
  SELECT 0::BIGINT, []::VARCHAR[], false, NULL::{id_kind}
  UNION ALL
  SELECT r.pos, CASE WHEN list_has_any(f.taken, r.keys) THEN f.taken ELSE list_concat(f.taken, r.keys) END,
    NOT list_has_any(f.taken, r.keys), r.id
  FROM fold f JOIN {rows} r ON r.pos = f.pos + 1)"""


# Rows that meet no other row are kept whatever happens; only the others enter the fold.
MEETING = """meeting AS (
  SELECT row_number() OVER (ORDER BY {order}) AS pos, k.id, k.keys FROM {rows} k
  WHERE k.id IN (SELECT id FROM {bands} b JOIN
    (SELECT key FROM {bands} JOIN {rows} USING (id) GROUP BY key HAVING count(*) > 1) s USING (key)))"""


# Documents after exact dedup, with the fold over what is left.
NEAR_TEXTS = [
    "corpora AS (SELECT doc_id, printf('documents_text_%06d', doc_id) AS id, text AS content FROM documents)",
    measures("corpora"),
    f"unique_rows AS (SELECT min(doc_id) AS id, {HASH} AS content_hash FROM measured GROUP BY 2)",
    *buckets(),
    "unique_keys AS (SELECT keyed.id, keys, content_hash FROM keyed JOIN unique_rows USING (id))",
    MEETING.format(rows="unique_keys", bands="bands", order="k.content_hash"), kept_fold("meeting"),
]


# Documents of two days, every second one changed on the later day, after exact dedup.
DAYS = [
    """corpora AS (
  SELECT doc_id, 0 AS day, text AS content FROM documents
  UNION ALL SELECT doc_id, 1, CASE WHEN doc_id % 2 = 1 THEN text || chr(10) || 'changed since' ELSE text END FROM documents)""",
    measures("corpora"),
    f"""day_firsts AS (
  SELECT *, printf('daily_text_%06d', place) AS id FROM (
    SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY day, place) AS copy FROM (
      SELECT *, {HASH} AS content_hash, row_number() OVER (PARTITION BY day ORDER BY doc_id) - 1 AS place FROM measured))
  WHERE copy = 1)""",
]


# ---- assembly -------------------------------------------------------------------------

def source_mapping() -> str:
    names = ["source", "content"]
    kinds = {}
    for spec in TABLE_SOURCES.values():
        kinds.update(spec.extras)
    sql_kind = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}
    absent = {("documents", "size")}
    parts = []
    for spec in TABLE_SOURCES.values():
        content = "''" if spec.name == "labels" else spec.content_field
        columns = [f"'{spec.name}' AS source", f"{content} AS content"]
        for name, kind in kinds.items():
            here = name in spec.extras and (spec.name, name) not in absent
            columns.append(f"CAST({name if here else 'NULL'} AS {sql_kind[kind.simpleString()]}) AS {name}")
        parts.append(f"SELECT {', '.join(columns)} FROM {spec.name}")
    return "\nUNION ALL ".join(parts)


def ingested(where: str = "") -> str:
    return f"""SELECT printf('documents_mixed_%06d', row_number() OVER (ORDER BY doc_id) - 1) AS id,
  'documents' AS source, 'mixed' AS language, text AS content, '{RUN_STAMP}' AS ingested_at,
  row_number() OVER (ORDER BY doc_id) - 1 AS position, doc_id, n_chars, NULL::BIGINT AS size FROM documents {where}"""


def stage_counts(rows: str, near: str, parses: str) -> str:
    return f"""SELECT *, {ratio('raw_rows - unique_rows', 'raw_rows')} AS duplicate_rate,
  {ratio('unique_rows - near_rows', 'unique_rows')} AS near_duplicate_rate,
  {ratio('near_rows - kept_rows', 'near_rows')} AS filtered_rate
FROM (SELECT count(*) AS raw_rows, count(*) FILTER (copy = 1) AS unique_rows,
  count(*) FILTER (copy = 1 AND {near}) AS near_rows,
  count(*) FILTER (copy = 1 AND {near} AND passes) AS kept_rows,
  count(*) FILTER (copy = 1 AND {near} AND passes AND {parses}) AS parseable_rows FROM {rows})"""


def all_oracles() -> dict[str, str]:
    full = scored()
    sql = {
        "source_mapping": source_mapping(),
        "scan_language": "SELECT text AS content, doc_id FROM documents WHERE lang = 'en'",
        "ingest_records": ingested(),
        "ingest_first_n": ingested(f"ORDER BY doc_id LIMIT {FIRST_N}"),
        "partition_roundtrip": f"""SELECT printf('%s_%s_%06d', source, lang, doc_id) AS id, source,
  lang AS language, text AS content, '{RUN_DATE}' AS date FROM documents""",
        "jsonl_roundtrip": f"""SELECT printf('documents_mixed_%06d', row_number() OVER (ORDER BY doc_id) - 1) AS id,
  'documents' AS source, 'mixed' AS language, row_number() OVER (ORDER BY doc_id) - 1 AS position,
  text AS content, '{RUN_STAMP}.000000' AS ingested_at, doc_id, n_chars, NULL::BIGINT AS size,
  true AS null_is_explicit FROM documents""",
        "normalise_schema": "SELECT doc_id, 'the-stack' AS source, text AS content FROM documents",
        "union_by_name": """SELECT doc_id, text AS content, lang, NULL::BIGINT AS page_id, NULL::BIGINT AS item_id
FROM documents UNION ALL SELECT NULL, html, NULL, page_id, NULL FROM pages
UNION ALL SELECT NULL, text, NULL, NULL, item_id FROM benchmark""",
        "text_features": with_ctes(*TEXTS, final=f"SELECT {MEASURED} FROM measured"),
        "content_hash": with_ctes(RENDERED, BOTH, final=f"SELECT id, {HASH} AS content_hash FROM corpora"),
        "exact_dedup": with_ctes(
            RENDERED, BOTH, final=f"SELECT min(id) AS id, {HASH} AS content_hash FROM corpora GROUP BY 2"),
        "hard_filter": with_ctes(*TEXTS, final=f"SELECT {MEASURED} FROM measured WHERE {PASSES}"),
        "python_structure": with_ctes(
            RENDERED, STRUCTURE, final="SELECT *, NOT is_parseable AS has_error FROM structure"),
        "structure_non_python": """SELECT doc_id, NULL::BOOLEAN AS is_parseable, 0::BIGINT AS num_functions,
  0::BIGINT AS num_classes, false AS has_docstring, NULL::VARCHAR AS parse_error FROM documents""",
        "minhash_bands": with_ctes(*buckets(), final="SELECT id, band, key FROM bands"),
        "near_dup_lookup": with_ctes(*buckets(), final="""SELECT id, min(first) AS first_id,
  CAST(count(*) AS BIGINT) AS shared_bands
FROM (SELECT id, min(id) OVER (PARTITION BY key) AS first FROM bands) WHERE first < id GROUP BY id"""),
        "near_dedup": "WITH RECURSIVE " + ",\n".join(
            [*buckets(), MEETING.format(rows="keyed", bands="bands", order="md5('42:' || k.id), k.id"), kept_fold("meeting")]
        ) + "\nSELECT id FROM keyed WHERE id NOT IN (SELECT id FROM fold WHERE pos > 0 AND NOT kept)",
        "transforms_near": "WITH RECURSIVE " + ",\n".join(NEAR_TEXTS) + f"""\nSELECT m.id, content_hash, num_lines, avg_line_length, alphanum_fraction, comment_ratio
FROM measured m JOIN unique_rows u ON u.id = m.doc_id
WHERE {PASSES} AND m.doc_id NOT IN (SELECT id FROM fold WHERE pos > 0 AND NOT kept)""",
        "syntactic_score": with_ctes(
            RENDERED, STRUCTURE, BOTH, measures("corpora"),
            final=f"SELECT id, {SYNTACTIC} AS syntactic_score FROM ({BOTH_STRUCTURE})"),
        "doc_score": with_ctes(
            RENDERED, STRUCTURE, BOTH, measures("corpora"),
            final=f"SELECT id, {DOC} AS doc_score FROM ({BOTH_STRUCTURE})"),
        "security_findings": with_ctes(
            RENDERED, STRUCTURE, BOTH, found("corpora"), final="SELECT id, severity, text, line FROM found"),
        "security_score": with_ctes(
            RENDERED, STRUCTURE, BOTH, found("corpora"),
            final="""SELECT id, greatest(0, 100 - coalesce(cost, 0))::DOUBLE / 100 AS security_score,
  coalesce(n, 0) AS security_finding_count, coalesce(high, 0) AS security_high_count
FROM corpora LEFT JOIN per_row USING (id)"""),
        "max_severity": with_ctes(
            RENDERED, STRUCTURE, BOTH, found("corpora"),
            final="""SELECT id, CASE worst WHEN 3 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' WHEN 1 THEN 'LOW' ELSE 'NONE' END
  AS security_severity FROM corpora LEFT JOIN per_row USING (id)"""),
        "judge_sample": with_ctes(
            "rows AS (SELECT doc_id AS id, text AS content FROM documents)", sampled("rows"),
            final="SELECT id, content FROM rows JOIN sampled USING (id)"),
        "judge_prompt": prompt(),
        "judge_parse": with_ctes(REPLIES, final="SELECT doc_id, llm_score, llm_reason FROM replies"),
        "judge_attach": with_ctes(
            REPLIES, final="""SELECT d.doc_id AS id, llm_score, llm_reason
FROM documents d LEFT JOIN marks ON marks.doc_id = d.doc_id"""),
        "composite_no_judge": with_ctes(
            *scored(judged=False), final="SELECT id, llm_score, composite_score FROM scored"),
        "composite_with_judge": with_ctes(
            *full, final="SELECT id, llm_score, composite_score FROM scored WHERE llm_score IS NOT NULL"),
        "threshold_flag": with_ctes(*full, final="SELECT id, composite_score, above_threshold FROM scored"),
        "run_transforms": with_ctes(RENDERED, STRUCTURE, BOTH, measures("corpora"), CLEANED, final="SELECT * FROM cleaned"),
        "score_stage": with_ctes(*full, final=f"SELECT {SCORED_COLUMNS} FROM scored"),
        "full_run": with_ctes(
            *scored(cleaned=FULL_CLEANED),
            final=f"""SELECT {SCORED_COLUMNS}, NULL::BIGINT AS size, '{RUN_STAMP}' AS scored_at FROM scored"""),
        "run_summary": with_ctes(*full, final=f"""SELECT *, {ratio('passed', 'total')} AS pass_rate,
  {ratio('with_findings', 'total')} AS findings_rate
FROM (SELECT count(*) AS total, count(*) FILTER (above_threshold) AS passed,
  count(*) FILTER (security_finding_count > 0) AS with_findings FROM scored)"""),
        "stage_counts": with_ctes(
            RENDERED, STRUCTURE, BOTH, measures("corpora"),
            f"""firsts AS (SELECT *, row_number() OVER (PARTITION BY {HASH} ORDER BY id) AS copy,
  {PASSES} AS passes FROM ({BOTH_STRUCTURE}))""",
            final=stage_counts("firsts", "true", "coalesce(is_parseable, false)")),
        "stage_counts_near": "WITH RECURSIVE " + ",\n".join(
            [*NEAR_TEXTS, f"""firsts AS (SELECT m.*, CASE WHEN u.id IS NULL THEN 2 ELSE 1 END AS copy, {PASSES} AS passes
  FROM measured m LEFT JOIN unique_rows u ON u.id = m.doc_id)""",
             "beaten AS (SELECT id FROM fold WHERE pos > 0 AND NOT kept)"]
        ) + "\n" + stage_counts("firsts", "doc_id NOT IN (SELECT id FROM beaten)", "false"),
        "overview_metrics": with_ctes(*full, final=f"""SELECT *, {ratio('passed', 'total')} AS pass_rate,
  {ratio('flagged', 'total')} AS flagged_rate
FROM (SELECT count(*) AS total, count(*) FILTER (composite_score >= 0.7) AS passed,
  count(DISTINCT content_hash) AS unique_samples, count(*) FILTER (worst > 0) AS flagged FROM scored)"""),
        "score_histogram": with_ctes(*full, final="""SELECT CAST(b AS INTEGER) AS bin, count(composite_score) AS n
FROM range(50) t(b) LEFT JOIN scored ON least(49, floor(composite_score::DECIMAL(6,4) * 50)) = b GROUP BY b"""),
        "score_distribution": with_ctes(
            *full, """long AS (
  SELECT 'syntactic_score' AS score_type, syntactic_score AS score FROM scored
  UNION ALL SELECT 'doc_score', doc_score FROM scored
  UNION ALL SELECT 'security_score', security_score FROM scored
  UNION ALL SELECT 'llm_score', llm_score FROM scored)""",
            final="""SELECT score_type, min(score) AS low, round(quantile_cont(score, 0.25), 6) AS q1,
  round(quantile_cont(score, 0.5), 6) AS q2, round(quantile_cont(score, 0.75), 6) AS q3,
  max(score) AS high, count(*) AS n FROM long WHERE score IS NOT NULL GROUP BY score_type"""),
        "sample_browser": with_ctes(
            *full, final="""SELECT id, composite_score, language, num_lines, is_parseable, content
FROM scored WHERE composite_score >= 0.7"""),
        "browse_unscored": with_ctes(
            RENDERED, STRUCTURE, BOTH, measures("corpora"), CLEANED,
            final="SELECT id, language, num_lines, is_parseable, content FROM cleaned"),
        "rows_above": with_ctes(*full, final="SELECT count(*) FILTER (composite_score >= 0.7) AS matching FROM scored"),
        "registered_sources": """SELECT 'the-stack' AS source, text AS content, n_chars AS size,
  NULL::DOUBLE AS avg_line_length, NULL::BIGINT AS max_line_length, NULL::DOUBLE AS alphanum_fraction,
  NULL::VARCHAR AS func_documentation_string, NULL::VARCHAR AS repository_name, NULL::VARCHAR AS canonical_solution,
  NULL::VARCHAR AS test, NULL::VARCHAR AS entry_point FROM documents
UNION ALL SELECT 'codesearchnet', text, NULL, NULL, NULL, NULL, NULL, source, NULL, NULL, NULL FROM documents
UNION ALL SELECT 'humaneval', text, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, lang FROM documents""",
        "two_days": with_ctes(
            *DAYS, final=f"SELECT id, doc_id, content_hash, num_lines FROM day_firsts WHERE {PASSES}"),
        "two_days_near": "WITH RECURSIVE " + ",\n".join([
            *DAYS, *buckets("(SELECT content_hash AS doc_id, content AS text FROM day_firsts)"),
            MEETING.format(rows="keyed", bands="bands", order="k.id"), kept_fold("meeting", "VARCHAR")]) + f"""
SELECT id, doc_id, content_hash, num_lines FROM day_firsts
WHERE {PASSES} AND content_hash NOT IN (SELECT id FROM fold WHERE pos > 0 AND NOT kept)""",
        "wide_positions": with_ctes(
            "corpora AS (SELECT doc_id, text AS content FROM documents)", measures("corpora"),
            final=f"""SELECT printf('documents_text_%06d', doc_id + {WIDE_FROM}) AS id, content_hash FROM (
  SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) AS copy
  FROM (SELECT *, {HASH} AS content_hash FROM measured)) WHERE copy = 1 AND {PASSES}"""),
        "language_profile": with_ctes(
            "rows AS (SELECT doc_id AS id, lang AS language, text AS content FROM documents)", measures("rows"),
            final=f"""SELECT language, count(*) AS n, CAST(sum(num_lines) AS BIGINT) AS lines
FROM (SELECT *, row_number() OVER (PARTITION BY {HASH} ORDER BY id) AS copy FROM measured)
WHERE copy = 1 AND {PASSES} GROUP BY language"""),
    }
    return sql


def prompt() -> str:
    from corpusq.operators.judge import FENCE, RUBRIC

    lead, tail = RUBRIC + FENCE + "\n", "\n" + FENCE
    return (f"SELECT doc_id AS id, {quoted(lead)} || text || {quoted(tail)}"
            " AS prompt FROM documents")
