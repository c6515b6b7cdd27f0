"""DuckDB SQL that computes the registered queries' results independently."""

from quizloom.checks.inputs import EMBED_DIM, INSTRUCTIONS, PANEL, SEED, SILENT_MODEL

NL = "chr(10)"

QUESTIONS = f"""
q AS (
  SELECT source || '.json' AS file_path,
         'Corpus.' || lang || '.' || source AS taxonomy_id,
         doc_id AS pos,
         'Q' || doc_id || '. ' || text || {NL}
         || '(1) ' || lang || {NL} || '(2)  ' || source
         || CASE WHEN n_chars % 5 >= 1 THEN {NL} || '(3) about 300 of ' || n_chars ELSE '' END
         || CASE WHEN n_chars % 5 >= 2 THEN {NL} || '(4) about 400 of ' || n_chars ELSE '' END
         || CASE WHEN n_chars % 5 >= 3 THEN {NL} || '(5) about 500 of ' || n_chars ELSE '' END
         || CASE WHEN n_chars % 5 >= 4 THEN {NL} || '(6) about 600 of ' || n_chars ELSE '' END
         || {NL}
         || CASE n_chars % 11
              WHEN 0 THEN 'Answer: C' WHEN 1 THEN 'answer: because' WHEN 2 THEN 'Answer: 9'
              WHEN 3 THEN 'Answer: G' WHEN 4 THEN 'The key is missing' WHEN 5 THEN 'Answer: 12'
              ELSE 'Answer: ' || (n_chars % 4 + 1) END AS q_raw
  FROM documents
)"""

KEYED = f"""{QUESTIONS},
keyed AS (
  SELECT *, CASE WHEN token = '' THEN NULL
                 WHEN token BETWEEN '1' AND '8' THEN CAST(ascii(token) - 48 AS BIGINT)
                 ELSE CAST(ascii(token) - 64 AS BIGINT) END AS correct
  FROM (SELECT *, upper(regexp_extract(q_raw, 'Answer:\\s*([A-F1-8])', 1, 'i')) AS token FROM q)
)"""

_PANEL_ROWS = ", ".join(f"({i}, '{m}')" for i, m in enumerate(PANEL))
RESPONSES = f"""
panel(i, model) AS (VALUES {_PANEL_ROWS}),
replies AS (
  SELECT source || '.json' AS file_path, doc_id AS pos, model,
         CASE (doc_id * 31 + n_chars + i * 17) % 13
           WHEN 0 THEN 'Error: timeout'
           WHEN 1 THEN ''
           WHEN 2 THEN '5 it is not.' || {NL} || 'answer: ' || pick
           WHEN 3 THEN '<final_answer> ' || pick || ' </final_answer>'
           WHEN 4 THEN 'The correct option is (' || pick || ')'
           WHEN 5 THEN 'The final answer is ' || pick || '.'
           WHEN 6 THEN 'After thought:' || {NL} || '  (' || pick || ') looks right'
           WHEN 7 THEN 'maybe ' || pick || ' or 8'
           WHEN 8 THEN '12 monkeys, no choice'
           ELSE 'My choice is ((' || pick || '))' END AS raw
  FROM (SELECT *, (n_chars + (doc_id + i) // 2) % 4 + 1 AS pick FROM documents, panel)
)"""

# The patterns that decide what a model chose.
_CHOICES = (
    r"Answer:\s*([1-8])",
    r"<final_answer>\s*([1-8])\s*</final_answer>",
    r"The correct option is \s*\(*([1-8])",
    r"The final answer is \s*\(*([1-8])",
    r"My choice is \s*\(*([1-8])",
    r"^\s*\(*([1-8])\)",
)
_TRIES = ", ".join(f"nullif(regexp_extract(raw, '(?im){p}', 1), '')" for p in _CHOICES)
CHOICES = f"""{RESPONSES},
picks AS (
  SELECT *, CAST(coalesce({_TRIES}, nullif(regexp_extract(raw, '\\b([1-8])\\b', 1), '')) AS BIGINT)
            AS any_choice
  FROM replies
),
choices AS (
  SELECT *, CASE WHEN raw LIKE 'Error:%' THEN NULL ELSE any_choice END AS choice FROM picks
)"""

GRADED = f"""{KEYED}, {CHOICES},
graded AS (
  SELECT c.*, k.correct,
         CASE WHEN choice IS NULL THEN 'unanswered' WHEN choice = correct THEN 'correct'
              ELSE 'incorrect' END AS outcome
  FROM choices c JOIN keyed k USING (file_path, pos) WHERE k.correct IS NOT NULL
)"""

SUMMARY = f"""{GRADED},
names(model) AS (SELECT model FROM panel UNION ALL SELECT '{SILENT_MODEL}'),
summary AS (
  SELECT n.model,
         count(*) FILTER (outcome = 'correct') AS correct,
         count(*) FILTER (outcome = 'incorrect') AS incorrect,
         count(*) FILTER (outcome = 'unanswered') AS unanswered,
         count(outcome) AS total,
         CASE WHEN count(outcome) = 0 THEN 0.0::DOUBLE
              ELSE count(*) FILTER (outcome = 'correct')::DOUBLE / count(outcome) END AS accuracy
  FROM names n LEFT JOIN graded g ON n.model = g.model GROUP BY n.model
)"""

PARSED = f"""{QUESTIONS},
hits AS (
  SELECT *, regexp_extract(q_raw, pattern, 1, 's') AS g1, regexp_extract(q_raw, pattern, 2, 's') AS g2,
         regexp_extract(q_raw, pattern, 3, 's') AS g3
  FROM (SELECT *, 'Q\\d+\\.\\s*(.*?)\\n((?:\\(\\d+\\).*?\\n)+)Answer:\\s*(\\d+)' AS pattern FROM q)
),
split AS (
  SELECT *, list_transform(string_split(trim(g2, chr(10) || ' '), {NL}),
                           lambda o: regexp_replace(trim(o), '^\\(\\d+\\)\\s*', '')) AS options
  FROM hits WHERE g3 <> ''
),
parsed AS (
  SELECT file_path, pos, trim(g1, chr(10) || ' ') AS question, options, CAST(g3 AS BIGINT) AS answer_number,
         CASE WHEN CAST(g3 AS BIGINT) BETWEEN 1 AND len(options) THEN options[CAST(g3 AS BIGINT)]
              ELSE 'Error: Invalid Answer Index' END AS answer_text
  FROM split
)"""

CHUNKS = r"""
chunks AS (
  SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS chunk_id
  FROM documents WHERE len(regexp_extract_all(text, '\S+')) >= 20
)"""


def _embedded(name: str, source: str, key: str, text: str = "text") -> str:
    """CTEs ``<name>``: key and unit-length word-count vector of each source row."""
    return f"""
{name}_words AS (
  SELECT {key}, unnest(regexp_extract_all(lower({text}), '\\S+')) AS word FROM {source}
),
{name}_counts AS (
  SELECT {key}, ('0x' || substr(md5(word), 1, 8))::BIGINT % {EMBED_DIM} AS dim, count(*) AS c
  FROM {name}_words GROUP BY ALL
),
{name}_norms AS (
  SELECT {key}, sqrt(CAST(sum(c * c) AS DOUBLE)) AS norm FROM {name}_counts GROUP BY ALL
),
{name}_cells AS (
  SELECT {key}, dim, CAST(c / norm AS FLOAT) AS w FROM {name}_counts JOIN {name}_norms USING ({key})
),
{name} AS (
  SELECT s.{key}, list(CAST(coalesce(w, 0) AS DOUBLE) ORDER BY d.dim) AS v
  FROM {source} s CROSS JOIN range({EMBED_DIM}) d(dim)
  LEFT JOIN {name}_cells c ON c.{key} = s.{key} AND c.dim = d.dim
  GROUP BY s.{key}
)"""


_SUM_IN_ORDER = "list_reduce(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]), lambda a, b: a + b)"


def _hits(queries: str, vectors: str, k: int) -> str:
    return f"""
hits AS (
  SELECT query_id, chunk_id, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
    FROM (SELECT q.query_id, c.chunk_id, {_SUM_IN_ORDER} AS score
          FROM {queries} q CROSS JOIN {vectors} c))
  WHERE rank <= {k}
)"""


_OWN_HITS = (
    """
own AS (SELECT vec_id AS query_id, vec_id AS chunk_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
"""
    + _hits("own", "own", 4)
)

FLAT = """
flat AS (
  SELECT p_partkey, p_size, p_name, 'Parts' AS domain, replace(p_brand, '#', ' # ') AS category,
         '§ ' || p_name || ' – ' || p_type || ' – use' AS topic,
         CASE WHEN p_size > 33 THEN 'H' WHEN p_size > 16 THEN 'M' ELSE 'E' END AS difficulty,
         'Parts.' || p_brand || '.' || replace(p_name, ' ', '') AS leaf_id
  FROM part
)"""

LEAVES = f"""{FLAT},
leaves AS (
  SELECT leaf_id AS id, topic AS label, difficulty FROM flat
  QUALIFY row_number() OVER (PARTITION BY leaf_id ORDER BY p_partkey DESC) = 1
)"""

_TOPK = f"""
WITH {_OWN_HITS}
SELECT query_id, rank, chunk_id, round(score, 6) AS score FROM hits"""

_WITH_TEXT = f"""
WITH {_OWN_HITS}, {CHUNKS}
SELECT query_id, rank, chunk_id, doc_id, text FROM hits JOIN chunks USING (chunk_id)"""

_FIELDS = ("prompt_type", "description", "template", "parser_regex", "version")


def _part_prompts(name: str, low: int, high: int, version: float) -> str:
    last = ", ".join(
        f"arg_max({f}, p_partkey) FILTER ({f} IS NOT NULL) AS {f}" for f in _FIELDS
    )
    return f"""
{name} AS (
  SELECT prompt_id, {last} FROM (
    SELECT p_partkey, CASE WHEN p_size <> 25 THEN p_brand || '/' || p_name END AS prompt_id,
           CASE WHEN p_size % 2 = 0 THEN 'mcq' END AS prompt_type,
           CASE WHEN p_size % 3 = 0 THEN p_name END AS description,
           CASE WHEN p_size % 5 <> 0 THEN p_type || ' {{n}}' END AS template,
           CASE WHEN p_size % 7 <> 0 THEN 'Q\\d+' END AS parser_regex,
           CAST({version} AS DOUBLE) AS version
    FROM part WHERE p_size BETWEEN {low} AND {high})
  WHERE prompt_id IS NOT NULL GROUP BY prompt_id
)"""


_MERGED = ", ".join(f"coalesce(n.{f}, o.{f}) AS {f}" for f in _FIELDS)
_CHANGED = " OR ".join(
    f"(n.{f} IS NOT NULL AND n.{f} IS DISTINCT FROM o.{f})" for f in _FIELDS
)

SEVERAL = f"""{QUESTIONS},
replies AS (
  SELECT pos AS doc_id, taxonomy_id,
         'Here they are.' || {NL} || q_raw || {NL} || {NL} || 'Q2. In between?' || {NL} || '(1) '
         || taxonomy_id || {NL} || '(2) no' || {NL} || 'Answer: 3' || {NL} || {NL} || q_raw AS raw
  FROM q
)"""


def _blocks(pattern: str, group: int, where: str = "true") -> str:
    return f"""
SELECT doc_id, CAST(pos - 1 AS BIGINT) AS pos, block FROM (
  SELECT doc_id, unnest(b) AS block, generate_subscripts(b, 1) AS pos FROM (
    SELECT doc_id, regexp_extract_all(raw, '{pattern}', {group}, 's') AS b
    FROM replies WHERE {where}))"""


_F1 = r"Q\d+\..+?Answer:\s*[A-F0-8]"
_CUSTOM = " UNION ALL ".join(
    _blocks(pattern, group, f"doc_id % 5 = {i}")
    for i, (pattern, group) in enumerate(
        [
            (r"Q\d+\..+?Answer:\s*[1-12]", 0),
            (r"Q\d+\.(.+?)Answer:\s*[1-8]", 1),
            (_F1, 0),
            (r"Q(\d{1,2})\d{0,9}\.[^?]+Answer:\s*\d+", 1),
        ]
    )
)
_CUSTOM += r"""
 UNION ALL SELECT doc_id, pos - 1 AS pos, '["' || a || '","' || b || '"]' AS block FROM (
    SELECT doc_id, unnest(regexp_extract_all(raw, '(Q\d+)\..+?Answer:\s*([A-F0-8])', 1, 's')) AS a,
           unnest(regexp_extract_all(raw, '(Q\d+)\..+?Answer:\s*([A-F0-8])', 2, 's')) AS b,
           generate_subscripts(regexp_extract_all(raw, '(Q\d+)\..+?Answer:\s*([A-F0-8])', 1, 's'), 1) AS pos
    FROM replies WHERE doc_id % 5 = 4)"""


def _filled(region: str, text: str, n: int, tag: str, label: str) -> str:
    return f"""'Write {n} ' || {tag} || ' questions about *' || {label} || '* for {region}.'
         || {NL} || '{{keep}} (8-1) None' || {NL} || '---' || {NL} || {text} || {NL} || '---'"""


GENERATED = f"""
prompts AS (
  SELECT CAST(doc_id AS VARCHAR) AS taxonomy_id, doc_id IN (SELECT doc_id FROM labels) AS done,
         {_filled("ASIA", "text", 3, "'H'", "doc_id")} AS prompt
  FROM documents
),
runs AS (SELECT taxonomy_id, done, length(prompt) AS n FROM prompts)"""

_SHOWN = r"list_filter(string_split(q_raw, chr(10)), lambda l: NOT starts_with(lower(trim(l)), 'answer:'))"
_PROMPT = f"""'{INSTRUCTIONS.replace("'", "''")}' || {NL} || array_to_string({_SHOWN}, {NL})
       || {NL} || {NL} || 'Your answer:'"""
_ASKED_ROWS = ", ".join(f"({i}, '{m}')" for i, m in enumerate(PANEL[:-1]))
_SHEET = """question AS "Question Text",
       coalesce(options[1], '') AS "Option 1", coalesce(options[2], '') AS "Option 2",
       coalesce(options[3], '') AS "Option 3", coalesce(options[4], '') AS "Option 4",
       coalesce(options[5], '') AS "Option 5", coalesce(options[6], '') AS "Option 6",
       answer_text AS "Answer Text\""""
_STEM = r"trim(regexp_extract(q_raw, '\A(.*?)\n\s*\-?\(1\)', 1, 's'), chr(10) || ' ')"

_TOKENS = r"list_distinct(regexp_extract_all(lower({0}), '\S+'))"


def _overlap(part: str, whole: str) -> str:
    part, whole = _TOKENS.format(part), _TOKENS.format(whole)
    return (
        f"CASE WHEN len({part}) = 0 THEN 0.0::DOUBLE "
        f"ELSE len(list_intersect({part}, {whole}))::DOUBLE / len({part}) END"
    )


_RAG = f"""
WITH {CHUNKS}, {_embedded("ce", "chunks", "chunk_id")},
items AS (
  SELECT item_id, trim('Q' || item_id || '. ' || text, chr(10) || ' ') AS query
  FROM benchmark WHERE item_id % 9 <> 4
),
{_embedded("qe", "items", "item_id", "query")},
qv AS (SELECT item_id AS query_id, v FROM qe),
{_hits("qv", "ce", 4)},
read AS (
  SELECT query_id AS item_id, string_agg(text, {NL} || {NL} ORDER BY rank) AS context
  FROM hits JOIN chunks USING (chunk_id) GROUP BY query_id
),
answered AS (
  SELECT item_id, query, context, array_to_string(list_append(list_filter(
           regexp_extract_all(lower(query), '\\S+'),
           lambda w: list_contains(regexp_extract_all(lower(context), '\\S+'), w)), 'hence'), ' ') AS response
  FROM items JOIN read USING (item_id)
),
scored AS (
  SELECT *, {_overlap("response", "context")} AS f,
         {_overlap("query", "(response || ' ' || context)")} AS r
  FROM answered
)"""

ORACLE = {
    "corpus_filter": r"""
SELECT doc_id, n_words FROM (
  SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS n_words FROM documents)
WHERE n_words >= 20""",
    "dense_chunk_ids": f"WITH {CHUNKS} SELECT doc_id, chunk_id FROM chunks",
    "hash_embed": f"""
WITH {_embedded("e", "documents", "doc_id")}
SELECT doc_id, dim, round(CAST(w AS DOUBLE), 6) AS w FROM e_cells""",
    "topk_retrieval": _TOPK,
    "topk_retrieval_grid": _TOPK,
    "topk_few_vectors": f"""
WITH own AS (
  SELECT vec_id AS query_id, vec_id AS chunk_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), {_hits("own", "own", "(SELECT count(*) FROM own)")}
SELECT query_id, rank, chunk_id, round(score, 6) AS score FROM hits""",
    "topk_groups": f"""
WITH own AS (
  SELECT vec_id AS query_id, vec_id AS chunk_id,
         list_transform(embedding, lambda e, i:
           CAST(CAST(e + CASE WHEN i - 1 = label THEN 20 ELSE 0 END AS FLOAT) AS DOUBLE)) AS v
  FROM embeddings
), {_hits("own", "own", 2)}
SELECT query_id, rank, chunk_id, round(score, 6) AS score, true AS groups_skipped FROM hits""",
    "topk_equal_queries": f"""
WITH own AS (SELECT vec_id AS chunk_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
few AS (
  SELECT doc_id AS query_id, v FROM documents JOIN own ON chunk_id = doc_id % 10
), {_hits("few", "own", 3)}
SELECT query_id, rank, chunk_id, round(score, 6) AS score FROM hits""",
    "score_check": f"""
WITH {_OWN_HITS}
SELECT query_id, chunk_id, round(score, 6) AS score, true AS same FROM hits WHERE rank <= 3""",
    "retrieve_with_text": _WITH_TEXT,
    "retrieve_with_text_ranges": _WITH_TEXT,
    "retrieve_with_text_salted": _WITH_TEXT,
    "bundles": f"""
WITH {LEAVES}, {CHUNKS}, {_embedded("ce", "chunks", "chunk_id")}, {_embedded("qe", "leaves", "id", "label")},
qv AS (SELECT id AS query_id, v FROM qe),
{_hits("qv", "ce", 4)}
SELECT id AS taxonomy_id, any_value(label) AS query_terms,
       string_agg(CAST(chunk_id AS VARCHAR), ',' ORDER BY rank) AS chunk_ids,
       string_agg(text, {NL} || {NL} ORDER BY rank) AS context
FROM leaves JOIN hits ON id = query_id JOIN chunks USING (chunk_id) GROUP BY id""",
    "leaf_flatten": f"""
WITH {FLAT} SELECT p_partkey, domain, category, topic, difficulty, leaf_id FROM flat""",
    "leaf_flatten_legacy": f"""
WITH {FLAT} SELECT p_partkey, domain, category, topic, difficulty,
  'Parts.' || category || '.§' || replace(p_name, ' ', '') AS leaf_id FROM flat""",
    "leaf_upsert": f"""
WITH {FLAT}
SELECT domain, category, topic, difficulty, leaf_id FROM (
  SELECT *, 0 AS load FROM flat WHERE p_size <= 30 UNION ALL
  SELECT *, 1 AS load FROM flat WHERE p_size >= 20)
QUALIFY row_number() OVER (PARTITION BY leaf_id ORDER BY load DESC, p_partkey DESC) = 1""",
    "pipeline_leaves": f"""
WITH {LEAVES}
SELECT id, label, difficulty, string_split(id, '.')[-1] AS last_part, label AS terms FROM leaves""",
    "prompt_upsert": f"""
WITH {_part_prompts("o", 1, 30, 1.0)}, {_part_prompts("n", 20, 50, 2.0)}
SELECT prompt_id, {_MERGED} FROM o FULL JOIN n USING (prompt_id)""",
    "prompt_upsert_report": f"""
WITH {_part_prompts("o", 1, 30, 1.0)}, {_part_prompts("n", 20, 50, 1.0)}
SELECT count(*) FILTER (o.prompt_id IS NULL) AS upserted,
       count(*) FILTER (o.prompt_id IS NOT NULL AND ({_CHANGED})) AS modified
FROM n LEFT JOIN o ON n.prompt_id = o.prompt_id""",
    "mcq_extract": f"WITH {SEVERAL} {_blocks(_F1, 0)}",
    "mcq_extract_custom_regex": f"WITH {SEVERAL} {_CUSTOM}",
    "prompt_render": f"""
SELECT 'Corpus.' || source || '.' || doc_id AS taxonomy_id,
  CASE lang
    WHEN 'fr' THEN {_filled("EUROPE", f"text || {NL} || {NL} || text", 5, "'H'", "doc_id")}
    WHEN 'en' THEN {_filled("ASIA", f"text || {NL} || {NL} || text", 5, "'M'", "doc_id")}
  END AS prompt,
  CASE WHEN lang NOT IN ('fr', 'en') THEN 'unknown prompt mcq_unknown' END AS problem
FROM documents""",
    "skip_existing": """
SELECT CAST(doc_id AS VARCHAR) AS taxonomy_id FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "generated_questions": f"""
WITH {GENERATED}
SELECT taxonomy_id, CAST(pos AS BIGINT) AS pos,
       CASE pos WHEN 0 THEN 'Q1. About ' || n || '?' || {NL} || '(1) yes' || {NL} || '(2) no' || {NL} || 'Answer: 2'
                ELSE 'Q2. Is ' || n || ' odd?' || {NL} || '(1) yes' || {NL} || '(2) no' || {NL}
                     || 'Answer: ' || (2 - n % 2) END AS q_raw
FROM runs, range(2) r(pos) WHERE NOT done AND n % 5 > 1""",
    "generation_status": f"""
WITH {GENERATED}
SELECT taxonomy_id,
       CASE WHEN done THEN 'Skipped: ' || taxonomy_id
            WHEN n % 5 = 0 THEN 'Failed: ' || taxonomy_id || ' with error: TimeoutError: no reply'
            WHEN n % 5 = 1 THEN 'Failed: ' || taxonomy_id || ' with error: Error: 503'
            ELSE 'Success: ' || taxonomy_id END AS line
FROM runs""",
    "generation_counts": f"""
WITH {GENERATED}
SELECT count(*) FILTER (NOT done AND n % 5 > 1) AS success, count(*) FILTER (done) AS skipped,
       count(*) FILTER (NOT done AND n % 5 <= 1) AS failed
FROM runs""",
    "batch_inference": r"""
SELECT conv_id, turn,
       CASE WHEN length(text) % 3 <> 0 THEN length(text) || ' characters, '
            || len(regexp_extract_all(text, '\S+')) || ' words' END AS raw,
       CASE WHEN length(text) % 3 = 0 THEN 'ValueError: ' || length(text) || ' characters' END AS error
FROM conversations""",
    "mcq_parse": f"""
WITH {PARSED}
SELECT pos, question, array_to_string(options, '|') AS options, answer_text, answer_number FROM parsed""",
    "answer_key": f"WITH {KEYED} SELECT pos, correct FROM keyed",
    "model_answer": f"WITH {CHOICES} SELECT pos, model, any_choice, choice FROM choices",
    "judge_prompt": f"""
WITH {QUESTIONS}
SELECT pos, {_PROMPT} AS prompt FROM q""",
    "question_stem": f"""
WITH {QUESTIONS} SELECT pos, query FROM (SELECT pos, {_STEM} AS query FROM q) WHERE query <> ''""",
    "first_stems": f"""
WITH {QUESTIONS}
SELECT file_path, pos, query FROM (
  SELECT file_path, pos, {_STEM} AS query FROM (SELECT * FROM q ORDER BY file_path, pos LIMIT 15))
WHERE query <> ''""",
    "strip_text": r"""
SELECT page_id, trim(html, chr(9) || chr(10) || chr(13) || ' ') AS html FROM pages""",
    "panel_model_accuracy": f"""
WITH {SUMMARY} SELECT model, correct, incorrect, unanswered, total, accuracy FROM summary""",
    "panel_question_difficulty": f"""
WITH {GRADED},
counts AS (
  SELECT file_path, pos, count(*) FILTER (outcome = 'correct') AS correct_models,
         count(*) FILTER (outcome = 'incorrect') AS incorrect_models,
         count(*) FILTER (outcome = 'unanswered') AS unanswered_models,
         count(*) AS total_models
  FROM graded GROUP BY ALL
)
SELECT file_path, pos, taxonomy_id, q_raw AS question_raw, correct, correct_models,
       incorrect_models, unanswered_models, total_models,
       correct_models::DOUBLE / total_models AS correct_ratio,
       CASE WHEN correct_models::DOUBLE / total_models >= 0.75 THEN 'easy'
            WHEN correct_models::DOUBLE / total_models >= 0.5 THEN 'medium'
            WHEN correct_models::DOUBLE / total_models >= 0.25 THEN 'hard'
            ELSE 'very_hard' END AS difficulty_tag
FROM counts JOIN keyed USING (file_path, pos)""",
    "panel_empty": f"""
WITH {KEYED}
SELECT file_path, pos, CAST(0 AS BIGINT) AS total_models, 0.0::DOUBLE AS correct_ratio,
       'very_hard' AS difficulty_tag
FROM keyed WHERE correct IS NOT NULL""",
    "panel_outcomes": f"WITH {GRADED} SELECT file_path, pos, model, outcome FROM graded",
    "panel_summary": f"""
WITH {SUMMARY}
SELECT model, '  ' || rpad(model, 22, ' ') || '  acc=' || printf('%.2f', accuracy * 100) || '%  (C:'
       || correct || ' I:' || incorrect || ' U:' || unanswered || ')' AS line FROM summary
UNION ALL SELECT 'total_questions', CAST(count(*) AS VARCHAR) FROM q""",
    "panel_debug": f"""
WITH {GRADED}
SELECT file_path AS file, pos, CAST(NULL AS VARCHAR) AS question_error, model,
       choice AS answer, correct, raw FROM graded
UNION ALL
SELECT file_path, pos, 'Answer tag missing.', NULL, NULL, NULL, NULL FROM keyed WHERE correct IS NULL""",
    "panel_asked": f"""
WITH {KEYED}, panel(i, model) AS (VALUES {_ASKED_ROWS}),
asked AS (
  SELECT file_path, pos, model, i + length({_PROMPT}) AS n
  FROM keyed, panel WHERE correct IS NOT NULL
)
SELECT file_path, pos, model,
       CASE n % 7 WHEN 0 THEN 'Error: ConnectionError: reset' WHEN 1 THEN 'no idea'
                  ELSE 'Answer: ' || (n % 4 + 1) END AS raw
FROM asked""",
    "panel_document": f"""
WITH {SUMMARY}
SELECT (SELECT count(*) FROM q) AS total_questions, model, correct, incorrect, unanswered, total,
       accuracy FROM summary""",
    "index_files": f"""
WITH {CHUNKS}, {_embedded("ce", "chunks", "chunk_id")}
SELECT chunk_id, doc_id, text, round(list_sum(v), 4) AS total FROM chunks JOIN ce USING (chunk_id)""",
    "bundle_files": """
SELECT CAST(doc_id AS VARCHAR) AS taxonomy_id, CAST(NULL AS VARCHAR) AS difficulty,
       doc_id AS chunk_id, doc_id, text, 1.0::DOUBLE AS score FROM documents""",
    "question_set_files": f"""
WITH {SEVERAL}
SELECT 'Set.' || doc_id || '.json' AS file_name, 'Set.' || doc_id AS taxonomy_id, pos, block AS q_raw
FROM ({_blocks(_F1, 0)})""",
    "review_sheet_csv": f"""
WITH {PARSED}
SELECT row_number() OVER (ORDER BY md5('{SEED}:' || file_path || '#' || pos), file_path || '#' || pos) - 1
         AS position,
       {_SHEET}, CAST(answer_number AS VARCHAR) AS "Answer Number"
FROM parsed""",
    "leaf_store": f"""
WITH {FLAT}
SELECT leaf_id AS id, topic AS label, difficulty FROM (
  SELECT *, 0 AS load FROM flat WHERE p_size <= 30 UNION ALL
  SELECT *, 1 AS load FROM flat WHERE p_size >= 20)
QUALIFY row_number() OVER (PARTITION BY leaf_id ORDER BY load DESC, p_partkey DESC) = 1""",
    "shuffle_order": f"""
WITH {QUESTIONS}
SELECT file_path, pos, row_number() OVER
       (ORDER BY md5('{SEED}:' || file_path || '#' || pos), file_path || '#' || pos) - 1 AS position
FROM q""",
    "review_sheet": f"""
WITH {PARSED}
SELECT row_number() OVER (ORDER BY md5('{SEED}:' || file_path || '#' || pos), file_path || '#' || pos) - 1
         AS position,
       {_SHEET}, answer_number AS "Answer Number"
FROM parsed""",
    "widest_options": f"WITH {PARSED} SELECT CAST(max(len(options)) AS BIGINT) AS max_options FROM parsed",
    "rag_eval": f"""{_RAG}
SELECT 'items.json' AS file_path, item_id AS pos, query, response, f >= 0.5 AS is_faithful,
       f AS faithfulness_score, r >= 0.5 AS is_relevant, r AS relevancy_score,
       CAST(NULL AS VARCHAR) AS error
FROM scored""",
    "rag_eval_failures": f"""{_RAG},
runs AS (SELECT *, length(query) % 3 = 0 AS failed FROM scored)
SELECT 'items.json' AS file_path, item_id AS pos, query,
       CASE WHEN NOT failed THEN response END AS response,
       CASE WHEN NOT failed THEN f >= 0.5 END AS is_faithful,
       CASE WHEN NOT failed THEN f END AS faithfulness_score,
       CASE WHEN NOT failed THEN r >= 0.5 END AS is_relevant,
       CASE WHEN NOT failed THEN r END AS relevancy_score,
       CASE WHEN failed THEN 'TimeoutError: ' || length(query) || ' characters' END AS error
FROM runs""",
    "question_sets_without_id": f"""
WITH {SEVERAL}
SELECT pos, block AS q_raw, 1::BIGINT AS rows_of_key, true AS has_key FROM ({_blocks(_F1, 0)})""",
    # The odd patterns of the template files.
    "prompt_files": r"""
SELECT 'mcq_' || s_suppkey AS prompt_id, 'for ' || s_name AS template,
       'v' || CASE WHEN s_suppkey % 4 = 1 THEN 2 ELSE 1 END || '.' || s_suppkey AS version,
       CASE s_suppkey % 4 WHEN 0 THEN '(?P<b>Q\d{,3})' WHEN 1 THEN '(Q\d+)(.+?)Answer'
            WHEN 2 THEN 'Q(\d' END AS parser_regex,
       CAST(s_suppkey % 4 AS VARCHAR) AS region,
       CASE WHEN s_suppkey % 4 = 1 THEN 'again' END AS note
FROM supplier""",
    # What the JSON and YAML readers say.
    "prompt_rejects": """
SELECT s_suppkey || CASE s_suppkey % 5 WHEN 1 THEN '.yaml' ELSE '.json' END AS name,
       CASE s_suppkey % 5 WHEN 0 THEN '2:2' WHEN 1 THEN '2:' || (length(s_name) + 17) END AS place,
       CASE s_suppkey % 5 WHEN 0 THEN 'Expecting property name enclosed in double quotes'
            WHEN 1 THEN 'expected '','' or '']'', but got ''<stream end>' || chr(39)
            ELSE 'no prompt_id' END AS reason
FROM supplier WHERE s_suppkey % 5 <= 2""",
    "prompt_lookup": """
SELECT 'part-' || p_partkey AS prompt_id, p_name AS template, p_type AS prompt_type
FROM part WHERE p_partkey = 7""",
    "taxonomy_files": """
SELECT 'Parts.' || p_brand || '.' || replace(p_name, ' ', '') || '.' || p_partkey AS id,
       p_name || '.' || p_partkey AS label,
       CASE WHEN p_size > 33 THEN 'H' WHEN p_size > 16 THEN 'M' ELSE 'E' END AS difficulty FROM part""",
    "chunk_files": """
SELECT doc_id AS chunk_id, doc_id, text, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total
FROM documents LEFT JOIN embeddings ON vec_id = doc_id""",
    "corpus_positions": """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, text FROM documents""",
    "panel_files_order": f"""
WITH {KEYED}
SELECT row_number() OVER (ORDER BY file_path, pos) - 1 AS line, file_path, pos FROM keyed
WHERE correct IS NOT NULL""",
    "benchmark_run": f"""
WITH {LEAVES}, {CHUNKS}, {_embedded("ce", "chunks", "chunk_id")}, {_embedded("qe", "leaves", "id", "label")},
qv AS (SELECT id AS query_id, v FROM qe),
{_hits("qv", "ce", 4)}, contexts AS (
  SELECT id AS taxonomy_id, string_split(id, '.')[-1] AS label,
         string_agg(text, {NL} || {NL} ORDER BY rank) AS context
  FROM leaves JOIN hits ON id = query_id JOIN chunks USING (chunk_id) GROUP BY id
), runs AS (
  SELECT taxonomy_id, length({_filled("ASIA", "context", 3, "'H'", "label")}) AS n FROM contexts
)
SELECT taxonomy_id, CAST(pos AS BIGINT) AS pos,
       CASE pos WHEN 0 THEN 'Q1. About ' || n || '?' || {NL} || '(1) yes' || {NL} || '(2) no' || {NL} || 'Answer: 2'
                ELSE 'Q2. Is ' || n || ' odd?' || {NL} || '(1) yes' || {NL} || '(2) no' || {NL}
                     || 'Answer: ' || (2 - n % 2) END AS q_raw
FROM runs, range(2) r(pos) WHERE n % 5 > 1""",
    "panel_files": f"""
WITH {KEYED}, panel(i, model) AS (VALUES {_ASKED_ROWS}),
asked AS (
  SELECT file_path, pos, correct, length(prompt) + i AS n
  FROM (SELECT file_path, pos, correct, {_PROMPT} AS prompt FROM keyed WHERE correct IS NOT NULL), panel
),
marked AS (SELECT *, CASE WHEN n % 7 > 1 THEN n % 4 + 1 END AS choice FROM asked)
SELECT file_path, pos, count(*) FILTER (choice = correct) AS correct_models,
       count(*) FILTER (choice <> correct) AS incorrect_models,
       count(*) FILTER (choice IS NULL) AS unanswered_models, count(*) AS debug_rows
FROM marked GROUP BY ALL""",
}

# Runs that find everything in the journal end as the runs before them.
ORACLE["generation_resumed"] = ORACLE["generated_questions"]
ORACLE["panel_asked_again"] = ORACLE["panel_asked"]
