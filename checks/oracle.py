"""The queries once more, as SQL over the same tables.

Replies are built around table values, so the SQL states the expected fields and never parses one.
"""

from __future__ import annotations

from checks.queries import PASSAGE_TEMPLATE, SEED, TIED_WEIGHTS
from pairsmith.plans.datasets import BRAINSTORMED, RUN_ORDER, WITH_HARD_NEGATIVES
from pairsmith.operators.triples import INSTRUCTIONS, REPLY_KEYS
from pairsmith.plans import presets

DOCS = "docs AS (SELECT doc_id AS id, text, lang, source FROM documents)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def numbers(values) -> str:
    """A list of doubles with all their digits."""
    return "string_split('" + ",".join(repr(float(v)) for v in values) + "', ',')::DOUBLE[]"


def strings(values) -> str:
    return "string_split(" + text("|".join(values)) + ", '|')"


def u(tag: str, key: str) -> str:
    return f"((('0x' || substr(md5('{SEED}:{tag}:' || {key} || ':0'), 1, 14))::UBIGINT >> 3) / 9007199254740992::DOUBLE)"


def place(u_sql: str, length) -> str:
    return f"floor({u_sql} * {length})::INT"


def search(cdf: str, u_sql: str) -> str:
    return f"len(list_filter({cdf}, lambda c: c <= {u_sql}))::INT"


def uniform_value(tag: str, key: str, values) -> str:
    return f"({strings(values)})[{place(u(tag, key), len(values))} + 1]"


def reach(weights: str) -> str:
    """Running sums of a list, up to 1."""
    return f"list_transform(range(1, len({weights}) + 1), lambda i: list_sum(({weights})[1:i]) / list_sum({weights}))"


LANGUAGE_TABLE = f"""weights AS (SELECT {numbers(presets.LANGUAGE_WEIGHTS)} AS w),
shares AS (SELECT list_transform(w, lambda x: x / list_sum(w)) AS p FROM weights),
lists AS (SELECT {reach('p')} AS cdf, p, {strings(presets.LANGUAGES)} AS names,
  {reach('list_transform(p, lambda x: x * (1 - x))')} AS first_cdf FROM shares)"""


def template(words: str, columns: dict[str, str]) -> str:
    """A prompt template as a chain of concatenations."""
    import string

    parts = []
    for literal, name, _, _ in string.Formatter().parse(words):
        if literal:
            parts.append(text(literal).replace("\n", "' || chr(10) || '"))
        if name is not None:
            parts.append(columns[name])
    return "(" + " || ".join(parts) + ")"


def pair_ctes(source: str, key: str) -> str:
    """``pairs(id, src_lang, tgt_lang)``: two unequal languages for every id."""
    return f"""
{LANGUAGE_TABLE},
first_draw AS (SELECT {key} AS id, {search('first_cdf', u('src_lang', key))} AS s, {u('tgt_lang', key)} AS u2 FROM {source}, lists),
line AS (SELECT id, s, p[s + 1] AS qs, cdf[s + 1] AS fin, u2 * (1 - p[s + 1]) AS x, cdf, names FROM first_draw, lists),
shifted AS (SELECT id, s, cdf, names,
  CASE WHEN x >= fin - qs THEN least(greatest(x + qs, fin), 1 - pow(2, -53)) ELSE x END AS v FROM line),
pairs AS (SELECT id, names[s + 1] AS src_lang, names[{search('cdf', 'v')} + 1] AS tgt_lang FROM shifted)"""


def weighted_language(tag: str, key: str) -> str:
    return f"(SELECT names[{search('cdf', u(tag, key))} + 1] FROM lists)"


# --- ideas -----------------------------------------------------------------------------------
IDEA_ROWS = """idea_rows AS (
SELECT id, CASE shape WHEN 1 THEN 'json_list' WHEN 2 THEN 'quoted' WHEN 3 THEN 'bullets' ELSE 'python_list' END AS parse_branch,
  unnest(CASE shape WHEN 0 THEN [n, t] WHEN 1 THEN [n, b] WHEN 2 THEN [n, t] WHEN 3 THEN [n, b, t] WHEN 4 THEN [n, t, b]
         ELSE [n, '7', t] END) AS idea
FROM (SELECT p_partkey AS id, p_partkey % 6 AS shape, p_name AS n, p_type AS t, p_brand AS b FROM part))"""
IDEA_LIST = "idea_list AS (SELECT row_number() OVER (ORDER BY idea) - 1 AS idx, idea FROM (SELECT DISTINCT idea FROM idea_rows))"

# --- replies ---------------------------------------------------------------------------------


def triple_select(data_type: str, label: str) -> str:
    keys = [k for k in REPLY_KEYS[data_type] if k]
    negative = "lang" if len(keys) == 3 else "''"
    derived = "CASE WHEN id % 2 = 0 THEN 'task ' || lang ELSE split_part(split_part(prompt, ': ', 2), chr(10), 1) END"
    instruction = text(INSTRUCTIONS[data_type]) if data_type in INSTRUCTIONS else derived
    return f"""SELECT id, '{label}' AS data_type, {instruction} AS instruction, text AS query, source AS positive, {negative} AS negative
FROM (SELECT *, 'This is your task: about ' || source || chr(10) || 'in ' || lang AS prompt FROM docs) WHERE id % 7 <> 0"""


# --- vectors ---------------------------------------------------------------------------------

def word_vectors(name: str, source: str, key: str, words: str) -> str:
    return f"""{name}_buckets AS (SELECT {key} AS id, list_transform(string_split({words}, ' '),
  lambda w: (('0x' || substr(md5(w), 1, 8))::UBIGINT % 64)::INT) AS buckets FROM {source}),
{name}_counts AS (SELECT id, list_transform(range(64), lambda b: len(list_filter(buckets, lambda x: x = b))::DOUBLE) AS c FROM {name}_buckets),
{name} AS (SELECT id, list_transform(c, lambda x: (x / greatest(sqrt(list_inner_product(c, c)), 1e-12))::FLOAT::DOUBLE) AS v FROM {name}_counts)"""


def ranked(queries: str, corpus: str, k: int) -> str:
    return f"""ranked AS (SELECT q, d, sim, rank FROM (
  SELECT q, d, sim, row_number() OVER (PARTITION BY q ORDER BY sim DESC, d) AS rank FROM (
    SELECT a.id AS q, b.id AS d, round(list_inner_product(a.v, b.v), 6) AS sim FROM {queries} a, {corpus} b))
WHERE rank <= {k})"""


def mining(k: int) -> str:
    """Picks over ``rows(id, positive)`` and ``ranked``: ``picked(id, negative, negative_branch)``."""
    blank = "NOT regexp_matches({}, '\\S')"
    return f"""near AS (SELECT r.q, r.rank, own.positive AS own, other.positive AS other
  FROM ranked r JOIN rows own ON own.id = r.q JOIN rows other ON other.id = r.d WHERE NOT {blank.format('other.positive')}),
pools AS (SELECT id, list(n.other ORDER BY n.rank) FILTER (n.other <> n.own) AS others,
    list(n.other ORDER BY n.rank) FILTER (n.rank > 1) AS mine
  FROM rows LEFT JOIN near n ON n.q = rows.id GROUP BY id),
open_rows AS (SELECT id, positive FROM rows JOIN pools USING (id) WHERE coalesce(len(others), 0) = 0 AND coalesce(len(mine), 0) = 0),
ring AS (SELECT o.id, arg_min(r.positive, CASE WHEN r.id <= o.id THEN 1 ELSE 0 END * 1000000000000 + r.id) AS following
  FROM open_rows o, rows r WHERE r.positive <> o.positive AND NOT {blank.format('r.positive')} GROUP BY o.id),
picked AS (SELECT id,
  CASE WHEN len(others) > 0 THEN others[{place(u('negative', 'id'), 'len(others)')} + 1]
       WHEN len(mine) > 0 THEN mine[{place(u('negative', 'id'), 'len(mine)')} + 1] ELSE following END AS negative,
  CASE WHEN len(others) > 0 THEN 'neighbour' WHEN len(mine) > 0 THEN 'own_positive'
       WHEN following IS NOT NULL THEN 'next_row' ELSE 'unresolved' END AS negative_branch
  FROM pools LEFT JOIN ring USING (id))"""


EMBEDDED = "vectors AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings)"


def sentence_pairs(data_type: str, prompt: str, ctes: str, source: str, instruction: str) -> str:
    return f"""WITH {ctes}, prompts AS (SELECT id, {instruction} AS instruction, {prompt} AS prompt FROM {source})
SELECT id, '{data_type}' AS data_type, instruction, split_part(prompt, chr(10), 1) AS query, md5(prompt) AS positive,
  upper(split_part(prompt, chr(10), 1)) AS negative FROM prompts"""


def scored(key: str) -> dict[str, str]:
    return {
        "high_score": uniform_value("high_score", key, presets.HIGH_SCORES),
        "low_score": uniform_value("low_score", key, presets.LOW_SCORES),
        "unit": uniform_value("unit", key, presets.UNITS),
        "difficulty": uniform_value("difficulty", key, presets.SCHOOL_LEVELS),
    }


def dataset(data_type: str) -> str:
    """All steps of a data type over the names of parts and the texts of documents."""
    tasks = ""
    if data_type in BRAINSTORMED:
        tasks = f"""
part_names AS (SELECT row_number() OVER (ORDER BY p_name) - 1 AS idx, p_name FROM (SELECT DISTINCT p_name FROM part)),
talks AS (SELECT p_name FROM (SELECT {place(u('name', 'range'), '(SELECT count(*) FROM part_names)')} AS idx
  FROM range((SELECT count(*) FROM part))) JOIN part_names USING (idx)),
idea_list AS (SELECT row_number() OVER (ORDER BY idea) - 1 AS idx, idea FROM (
  SELECT 'Search for ' || p_name AS idea FROM talks UNION SELECT 'List ' || p_name FROM talks)),
tasks AS (SELECT id, idea AS task FROM (SELECT id, {place(u('task', 'id'), '(SELECT count(*) FROM idea_list)')} AS idx FROM runs)
  JOIN idea_list USING (idx)),"""
    if data_type == "bitext":
        languages, head = pair_ctes("runs", "id"), "'from ' || src_lang || ' to ' || tgt_lang"
    else:
        languages = f"{LANGUAGE_TABLE}, pairs AS (SELECT id, {weighted_language('language', 'id')} AS language FROM runs)"
        head = "'in ' || language"
    instruction = "task" if tasks else text(INSTRUCTIONS[data_type])
    sql = f"""WITH runs AS (SELECT range AS id FROM range((SELECT count(*) FROM documents))), {tasks} {languages},
passages AS (SELECT row_number() OVER (ORDER BY text) - 1 AS idx, text FROM (SELECT DISTINCT text FROM documents)),
rows AS (SELECT id, '{data_type}' AS data_type, {instruction} AS instruction,
    {head} || ': ' || array_to_string(string_split(passages.text, ' ')[1:3], ' ') AS query, passages.text AS positive
  FROM (SELECT *, {place(u('passage', 'id'), '(SELECT count(*) FROM passages)')} AS idx FROM pairs {'JOIN tasks USING (id)' if tasks else ''})
  JOIN passages USING (idx))"""
    if data_type not in WITH_HARD_NEGATIVES:
        return sql + " SELECT id, data_type, instruction, query, positive, md5(positive) AS negative FROM rows"
    return sql + f""",
{word_vectors('qv', 'rows', 'id', "'Instruct: ' || instruction || chr(10) || 'Query: ' || query")}, {word_vectors('pv', 'rows', 'id', 'positive')},
{ranked('qv', 'pv', 10)}, {mining(10)}
SELECT id, data_type, instruction, query, positive, negative FROM rows JOIN picked USING (id)"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Sampling
    key = "o_orderkey"
    sql["sample_uniform"] = f"""SELECT id, clarity, num_words, clarity || ', ' || num_words || ' words' AS formatted_prompt FROM (
SELECT {key} AS id, {uniform_value('clarity', key, presets.CLARITY)} AS clarity,
  {uniform_value('num_words', key, presets.NUM_WORDS)} AS num_words FROM orders)"""
    sql["sample_weighted"] = f"""WITH {LANGUAGE_TABLE}
SELECT {key} AS id, names[{search('cdf', u('language', key))} + 1] AS language FROM orders, lists"""
    bitext = template(presets.TEMPLATES["bitext"], {**scored("id"), "src_lang": "src_lang", "tgt_lang": "tgt_lang"})
    sql["sample_constrained"] = f"""WITH {pair_ctes('orders', key)}
SELECT id, src_lang, tgt_lang, {scored('id')['unit']} AS unit, {bitext} AS formatted_prompt FROM pairs"""
    sql["constraint_filter"] = f"""WITH {LANGUAGE_TABLE}
SELECT * FROM (SELECT {key} AS id, {search('cdf', u('a', key))} AS a, {place(u('b', key), 98)} AS b FROM orders, lists) WHERE a <> b"""
    sql["sample_task_join"] = f"""WITH tasks AS (SELECT row_number() OVER (ORDER BY task) - 1 AS idx, task FROM (
  SELECT DISTINCT concat_ws(' ', p_name, p_brand, p_type) AS task FROM part))
SELECT o.{key} AS id, task, 'Do: ' || task AS formatted_prompt
FROM (SELECT *, {place(u('task', key), '(SELECT count(*) FROM tasks)')} AS idx FROM orders) o JOIN tasks USING (idx)"""
    # The joint weights of all choices, and from them the conditional ones, argument by argument.
    weight = f"(SELECT {numbers(TIED_WEIGHTS)} AS p)"
    sql["sample_tied"] = f"""WITH every AS (SELECT a, b, c, p[a + 1] * p[b + 1] * p[c + 1] AS w
  FROM {weight}, range(5) r(a), range(5) s(b), range(5) t(c) WHERE a <> b AND b <> c AND a <> c),
one AS (SELECT a, sum(w) OVER (ORDER BY a) AS reach, sum(w) OVER () AS whole FROM (SELECT a, sum(w) AS w FROM every GROUP BY a)),
two AS (SELECT a, b, sum(w) OVER (PARTITION BY a ORDER BY b) AS reach, sum(w) OVER (PARTITION BY a) AS whole
  FROM (SELECT a, b, sum(w) AS w FROM every GROUP BY a, b)),
three AS (SELECT a, b, c, sum(w) OVER (PARTITION BY a, b ORDER BY c) AS reach, sum(w) OVER (PARTITION BY a, b) AS whole FROM every),
drawn AS (SELECT {key} AS id, {u('first', key)} AS u1, {u('second', key)} AS u2, {u('third', key)} AS u3 FROM orders),
d1 AS (SELECT id, u2, u3, min(a) AS a FROM drawn, one WHERE reach > u1 * whole GROUP BY id, u2, u3),
d2 AS (SELECT id, u3, a, min(b) AS b FROM d1 JOIN two USING (a) WHERE reach > u2 * whole GROUP BY id, u3, a),
d3 AS (SELECT id, a, b, min(c) AS c FROM d2 JOIN three USING (a, b) WHERE reach > u3 * whole GROUP BY id, a, b)
SELECT id, substr('vwxyz', (a + 1)::INT, 1) || substr('vwxyz', (b + 1)::INT, 1) || substr('vwxyz', (c + 1)::INT, 1) AS formatted_prompt FROM d3"""
    sql["sample_table_weights"] = f"""WITH names AS (SELECT row_number() OVER (ORDER BY p_name) - 1 AS idx, p_name, sum(p_size)::HUGEINT AS w FROM part GROUP BY p_name),
size AS (SELECT count(*) AS n, sum(w)::HUGEINT AS whole FROM names),
places AS (SELECT idx, p_name, w * n AS own, whole, greatest(whole - w * n, 0) AS lacks, greatest(w * n - whole, 0) AS has FROM names, size),
line AS (SELECT *, sum(lacks) OVER (ORDER BY idx) - lacks AS lacks_before, sum(has) OVER (ORDER BY idx) - has AS has_before FROM places),
light AS (SELECT * FROM line WHERE lacks > 0), heavy AS (SELECT * FROM line WHERE has > 0),
slots AS (
  SELECT l.idx, l.p_name, l.own::DOUBLE / l.whole::DOUBLE AS keeps, h.p_name AS other
  FROM light l ASOF JOIN heavy h ON l.lacks_before >= h.has_before
  UNION ALL
  SELECT h.idx, h.p_name, 1 - greatest(coalesce(l.lacks_before + l.lacks, 0) - (h.has_before + h.has), 0)::DOUBLE / h.whole::DOUBLE, next.p_name
  FROM heavy h ASOF LEFT JOIN light l ON h.has_before + h.has > l.lacks_before LEFT JOIN heavy next ON next.has_before = h.has_before + h.has
  UNION ALL SELECT idx, p_name, 1, p_name FROM line WHERE lacks = 0 AND has = 0),
drawn AS (SELECT {key} AS id, floor({u('name', key)} * n)::BIGINT AS idx, {u('name', key).replace(", 1, 14)", ", 17, 14)")} AS place FROM orders, size)
SELECT id, 'about ' || CASE WHEN place < keeps THEN p_name ELSE other END AS formatted_prompt FROM drawn JOIN slots USING (idx)"""
    sql["brainstorm_prompts"] = f"SELECT p_partkey AS id, {template(presets.BRAINSTORMS['short_long'], {})} AS formatted_prompt FROM part"
    sql["render_prompt"] = """SELECT p_partkey, '{' || p_name || '} by ' || p_brand || chr(10) || 'size ' || p_size AS prompt FROM part"""

    # Models
    sql["generate_chat"] = f"WITH {DOCS} SELECT id, '2:' || md5(text) AS output FROM docs"
    sql["generate_resumed"] = sql["generate_chat"]
    sql["generate_base"] = """SELECT event_id AS id, length(event_type) || '@' ||
  CASE WHEN event_id % 3 = 0 THEN (event_id % 10)::VARCHAR ELSE '0.5' END AS output FROM events"""
    sql["merge_params"] = r"""SELECT event_id, coalesce(nullif(regexp_extract(props, '"k": ([0-9]+)', 1), ''), '5') AS k,
  '0.8' AS temperature, 2 AS n_params FROM events"""
    sql["chat_messages"] = f"""SELECT conv_id, turn, 0 AS place, 'system' AS role, {text(presets.SYSTEM_PROMPT)} AS content FROM conversations
UNION ALL SELECT conv_id, turn, 1, 'user', text FROM conversations"""
    sql["restore_order"] = "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents"

    # Replies
    # A plain text is read as key/value pairs where it holds an even number of quoted strings, none of them a key here.
    shaped = """shaped AS (SELECT *, id % 12 AS shape, substr(to_json(text)::VARCHAR, 2, length(to_json(text)::VARCHAR) - 2) AS escaped,
  len(regexp_extract_all(text, '"([^"]*)"', 1)) AS quotes FROM docs)"""
    pairs = "quotes > 0 AND quotes % 2 = 0"
    sql["collect_json"] = f"""WITH {DOCS}, {shaped} SELECT id,
  CASE shape WHEN 1 THEN 'json_fence' WHEN 2 THEN 'fence' WHEN 3 THEN 'python_fence' WHEN 4 THEN 'repaired_braces'
    WHEN 5 THEN 'quoted_pairs' WHEN 6 THEN 'quoted_pairs' WHEN 8 THEN 'fence' WHEN 10 THEN 'json_fence' ELSE 'braces' END AS parse_branch,
  CASE WHEN shape <= 4 OR shape = 10 THEN text WHEN shape = 5 THEN '{{x}} ' || escaped WHEN shape = 9 THEN '5' END AS input,
  CASE WHEN shape <= 5 THEN source WHEN shape = 9 THEN text WHEN shape = 10 THEN '{{"a":["' || source || '"]}}' END AS document
FROM shaped WHERE shape NOT IN (7, 11) AND (shape <> 6 OR {pairs})"""
    sql["collect_list_json"] = f"""WITH {DOCS} SELECT id,
  CASE shape WHEN 1 THEN 'repaired_brackets' WHEN 2 THEN 'fence' WHEN 4 THEN 'none' ELSE 'brackets' END AS parse_branch,
  CASE WHEN shape < 3 THEN text WHEN shape = 3 THEN text || ' ' || source END AS first,
  CASE WHEN shape < 3 THEN source END AS second FROM (SELECT *, id % 6 AS shape FROM docs) WHERE shape < 5"""
    sql["collect_ideas"] = f"WITH {IDEA_ROWS} SELECT id, parse_branch, idea FROM idea_rows"
    sql["distinct_ideas"] = f"WITH {IDEA_ROWS} SELECT DISTINCT idea FROM idea_rows"
    for name in REPLY_KEYS:
        sql[f"triples_{name}"] = f"WITH {DOCS} {triple_select(name, name)}"
    sql["triples_mixed"] = f"WITH {DOCS} " + " UNION ALL ".join(triple_select(n, n + "_v2") for n in REPLY_KEYS)
    sql["triples_foreign"] = f"""WITH {DOCS} SELECT id, 'short_short' AS data_type, 'about ' || source AS instruction, text AS query,
  source AS positive, '' AS negative FROM docs WHERE id % 7 <> 0"""
    sql["reply_rejects"] = f"""WITH {DOCS}, {shaped} SELECT id,
  CASE WHEN shape = 6 AND {pairs} THEN 'quoted_pairs' WHEN shape = 6 THEN 'none' WHEN shape = 9 THEN 'braces'
    WHEN shape = 10 THEN 'json_fence' ELSE 'fence' END AS parse_branch,
  CASE WHEN shape = 6 AND NOT ({pairs}) THEN 'no_json' WHEN shape = 7 THEN 'json_null' WHEN shape = 8 THEN 'not_object' ELSE 'bad_field' END AS reason
FROM shaped WHERE shape BETWEEN 6 AND 10"""
    sql["derive_instruction"] = """SELECT doc_id AS id,
  CASE WHEN doc_id % 5 = 0 THEN lang WHEN doc_id % 3 = 0 THEN lang ELSE source END AS instruction FROM documents"""

    # Vectors
    tokens = """tokens AS (SELECT vec_id, t.i AS i, j.j AS dim, embedding[t.i * 8 + j.j + 1]::DOUBLE AS x,
  NOT (vec_id % 50 = 7 OR (vec_id + t.i) % 3 = 0) AS kept FROM embeddings, range(8) t(i), range(8) j(j))"""
    sql["pool_mean"] = f"WITH {tokens} SELECT vec_id, dim::INT AS dim, round(avg(x), 6) + 0.0::DOUBLE AS v FROM tokens WHERE kept GROUP BY vec_id, dim"
    sql["pool_cls"] = f"WITH {tokens} SELECT vec_id, dim::INT AS dim, round(x, 6) + 0.0::DOUBLE AS v FROM tokens WHERE i = 0"
    sql["l2_normalise"] = """WITH scaled AS (SELECT vec_id, j.j AS dim, embedding[j.j + 1]::DOUBLE * (label % 4) AS x FROM embeddings, range(64) j(j)),
norms AS (SELECT vec_id, greatest(sqrt(sum(x * x)), 1e-12) AS n FROM scaled GROUP BY vec_id)
SELECT vec_id, dim::INT AS dim, round(x / n, 6) + 0.0::DOUBLE AS v FROM scaled JOIN norms USING (vec_id)"""
    sql["truncate_tokens"] = f"""WITH {DOCS} SELECT id, len(kept)::INT AS n_tokens, array_to_string(kept, ' ') AS kept
FROM (SELECT id, string_split(text, ' ')[1:16] AS kept FROM docs)"""
    sql["embed_stub"] = f"""WITH {DOCS}, {word_vectors('wv', 'docs', 'id', 'text')}
SELECT id, bucket, round(v, 6) AS v FROM (SELECT id, unnest(range(64))::INT AS bucket, unnest(v) AS v FROM wv) WHERE v <> 0"""

    # Neighbours
    sql["topk_approximate"] = "SELECT vec_id AS q, least(10, (SELECT count(*) FROM embeddings)) AS hits, 0::BIGINT AS wrong_scores, true AS recall_reached FROM embeddings"
    sql["topk_neighbours"] = f"WITH {EMBEDDED}, {ranked('vectors', 'vectors', 10)} SELECT q, d, sim, rank::INT AS rank FROM ranked"
    turns = "turns AS (SELECT conv_id * 1000 + turn AS id, text FROM conversations)"
    sql["pairwise_similarity"] = f"""WITH {DOCS}, {turns}, {word_vectors('tv', 'turns', 'id', 'text')}, {word_vectors('dv', 'docs', 'id', 'text')},
{ranked('tv', 'dv', 3)} SELECT q, d, sim, rank::INT AS rank FROM ranked"""
    sql["hard_negatives"] = f"""WITH {DOCS}, {EMBEDDED},
rows AS (SELECT docs.id, 'about ' || source AS query, text AS positive FROM docs),
kept AS (SELECT vectors.* FROM vectors JOIN rows USING (id)), {ranked('kept', 'kept', 10)}, {mining(10)}
SELECT id, query, negative, negative_branch FROM rows JOIN picked USING (id)"""
    sql["hard_negatives_fallback"] = f"""WITH {EMBEDDED},
rows AS (SELECT id, CASE WHEN label % 4 = 0 THEN ' ' ELSE 'group ' || label END AS positive FROM vectors),
{ranked('vectors', 'vectors', 2)}, {mining(2)}
SELECT id, positive, negative, negative_branch FROM rows JOIN picked USING (id)"""

    # Files
    sql["jsonl_roundtrip"] = "SELECT doc_id, text, lang, n_chars FROM documents"
    sql["csv_roundtrip"] = "SELECT doc_id, text, lang, n_chars FROM documents"
    sql["json_array_roundtrip"] = "SELECT row_number() OVER (ORDER BY text) - 1 AS idx, text AS value FROM documents"
    sql["idea_list_scan"] = f"WITH {IDEA_ROWS}, {IDEA_LIST} SELECT idx, idea AS value FROM idea_list"
    sql["write_mode_skip"] = "SELECT doc_id, lang, true AS was_skipped, upper(lang) AS replaced FROM documents"

    # Datasets
    sql["bitext_pairs"] = sentence_pairs("bitext", bitext, pair_ctes("documents", "doc_id"), "pairs", text(INSTRUCTIONS["bitext"]))
    sts = template(presets.TEMPLATES["sts"], {**scored("doc_id"), "language": weighted_language("language", "doc_id")})
    sql["sts_pairs"] = sentence_pairs("sts", sts, LANGUAGE_TABLE, "(SELECT *, doc_id AS id FROM documents)", text(INSTRUCTIONS["sts"]))
    drawn = f"""drawn AS (SELECT id, idea AS task FROM (SELECT doc_id AS id, {place(u('task', 'doc_id'), '(SELECT count(*) FROM idea_list)')} AS idx
  FROM documents) JOIN idea_list USING (idx))"""
    long_short = template(presets.TEMPLATES["long_short"], {
        "task": "task", "language": weighted_language("language", "id"),
        "difficulty": uniform_value("difficulty", "id", presets.STUDY_LEVELS),
        "clarity": uniform_value("clarity", "id", presets.CLARITY),
        "num_words": uniform_value("num_words", "id", presets.NUM_WORDS),
    })
    sql["long_short_pairs"] = sentence_pairs("long_short", long_short, f"{LANGUAGE_TABLE}, {IDEA_ROWS}, {IDEA_LIST}, {drawn}", "drawn", "task")
    assert PASSAGE_TEMPLATE.count("{") == 3
    sql["short_long_pairs"] = f"""WITH {DOCS}, {IDEA_ROWS}, {IDEA_LIST}, {drawn},
passages AS (SELECT row_number() OVER (ORDER BY text) - 1 AS idx, text FROM (SELECT DISTINCT text FROM docs)),
rows AS (SELECT drawn.id, 'short_long' AS data_type, task AS instruction,
    array_to_string(string_split(passages.text, ' ')[1:3], ' ') AS query, passages.text AS positive
  FROM (SELECT *, {place(u('passage', 'id'), '(SELECT count(*) FROM passages)')} AS idx FROM drawn) drawn JOIN passages USING (idx)),
{word_vectors('qv', 'rows', 'id', "'Instruct: ' || instruction || chr(10) || 'Query: ' || query")}, {word_vectors('pv', 'rows', 'id', 'positive')},
{ranked('qv', 'pv', 10)}, {mining(10)}
SELECT id, data_type, instruction, query, positive, negative, negative_branch FROM rows JOIN picked USING (id)"""
    for name in RUN_ORDER:
        sql[f"pipeline_{name}"] = dataset(name)
    sql["pipeline_all"] = " UNION ALL ".join(
        f"SELECT * REPLACE (id * {len(RUN_ORDER)} + {i} AS id) FROM ({dataset(name)})" for i, name in enumerate(RUN_ORDER))
    return sql
