"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement recomputes a query's result from the raw tables in plain SQL,
written independently of the Spark code path (only prompt texts of our own
wording are shared; fixed values are written out below).  For queries that go through files, streams or the Python literal parser the
statement recomputes the end result of the whole path.
"""

from __future__ import annotations

from ..operators import convert, episodes as E, judge_reward as J
from ..sources.standins import CODE_PROMPT_LEAD

# ---- fixed values, as the reference states them ----
BLANKS = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
DIMENSIONS = ("faithfulness", "coverage", "no_redundancy", "appropriate_length", "coherence")
NO_SUBMISSION = "no <solution> submitted within turn limit"
DB_MISSING = "database file not found for db_id '{db_id}' ({path})"
SQL_FAILED = "final SQL failed to execute: {error}"
CORRECT, INCORRECT = "correct: result matches gold", "incorrect: result does not match gold"
NO_ANSWER = "No answer produced. Ran {a} SQL quer(ies), {e} errored, over {n} turn(s) before the limit. Reason: {reason}."
ALL_ERRORED = " Every SQL query errored: last error -> {last}"
ANSWER = "Answer {verdict} ({how}). {reason}. Ran {a} SQL quer(ies) ({e} errored) over {n} turn(s)."
SUBMITTED, FALLBACK = "submitted via <solution>", "no explicit <solution>; used last successful query"
NO_ROWS = "Query executed successfully. No rows returned."
# ----------------------------------------------------
GOLD_FAILED = "gold SQL failed to execute"  # our own


def lit(s: str) -> str:
    """SQL string literal (raw newlines are fine inside DuckDB literals)."""
    return "'" + s.replace("'", "''") + "'"


WSQ = "(" + " || ".join(f"chr({c})" for c in BLANKS) + ")"
NL = "chr(10)"


def strip(x: str) -> str:
    return f"trim({x}, {WSQ})"


def blank(x: str) -> str:
    return f"(coalesce({strip(x)}, '') = '')"


def snap(a: str) -> str:
    cut = f"left({a}, 4000)"
    p1 = f"length(regexp_replace({cut}, '[^.]*$', ''))"
    return f"(CASE WHEN length({a}) > 4000 THEN (CASE WHEN {p1} - 1 > 2000 THEN left({cut}, {p1}) ELSE {cut} END) ELSE {a} END)"


def count_parts(s: str, sep: str = "'. '") -> str:
    return f"len(list_filter(string_split({s}, {sep}), lambda x: {strip('x')} <> ''))"


def length_rule(s: str) -> str:
    n = count_parts(f"replace({s}, '.' || {NL}, '. ')")
    return f"CAST(CASE WHEN {blank(s)} THEN 0 WHEN {n} BETWEEN 2 AND 4 THEN 1 ELSE 0 END AS BIGINT)"


def unfence(t: str, tag: str) -> str:
    return (f"{strip(f'''(CASE WHEN contains({t}, '{tag}') THEN split_part(split_part({t}, '{tag}', 2), '```', 1) '''
                     f'''WHEN contains({t}, '```') THEN split_part({t}, '```', 2) ELSE {t} END)''')}")


def nonblank_lines(code: str) -> str:
    return f"len(list_filter(string_split({code}, {NL}), lambda x: {strip('x')} <> ''))"


def concise(n: str) -> str:
    return (f"(CASE WHEN {n} <= 10 THEN 1.0::DOUBLE WHEN {n} >= 30 THEN 0.2::DOUBLE "
            f"ELSE 1.0::DOUBLE - 0.8::DOUBLE * (CAST({n} - 10 AS DOUBLE) / 20.0::DOUBLE) END)")


# ------------------------------------------------------------------ CTEs
ART = f"art AS (SELECT doc_id AS ordinal, {strip('text')} AS a, {strip('text')} AS h FROM documents)"
RLAIF_KEPT = "(length(a) >= 100 AND length(h) >= 20)"
RLAIF_CONTENT = f"({lit(convert.SUMMARY_INSTRUCTION)} || {lit(chr(10) + chr(10) + 'Article:' + chr(10))} || {snap('a')})"

QUESTIONS = (f"q AS (SELECT doc_id AS ordinal, CASE WHEN doc_id % 25 = 0 THEN {lit(' ' + chr(9) + chr(10))} ELSE text END AS question, "
             f"'db_' || CAST(doc_id AS VARCHAR) AS db_id, CASE WHEN doc_id % 40 = 7 THEN '  ' ELSE "
             f"'SELECT quality, toxic FROM labels WHERE doc_id = ' || CAST(doc_id AS VARCHAR) END AS query FROM documents)")
AVAIL = "avail AS (SELECT 'db_' || CAST(doc_id AS VARCHAR) AS db_id FROM labels)"
_K = "CAST(doc_id AS VARCHAR)"
SCHEMA_FILES = (
    "sf AS (SELECT 'db_' || " + _K + " AS db_id, "
    + lit("PRAGMA foreign_keys = ON;\n") + " || (CASE WHEN quality = 1 THEN "
    + lit('CREATE TABLE "doc_') + f" || {_K} || " + lit('" (\n  "doc_id" int,\n  "quality" int,\n  PRIMARY KEY ("doc_id")\n);\n')
    + " ELSE '' END) || " + lit('INSERT INTO "doc_') + f" || {_K} || " + lit('" VALUES (') + f" || {_K} || ',' || "
    "CAST(quality AS VARCHAR) || " + lit(");\n") + " || (CASE WHEN quality = 1 AND toxic = 0 THEN "
    + lit("create table flags_") + f" || {_K} || " + lit(" (\n  toxic int\n);\n") + " ELSE '' END) AS schema_sql FROM labels)")
CREATE_RE = r"'(?si)CREATE TABLE.*?\(.*?\);'"
CORPUS = (f"corpus AS (SELECT db_id, ddl FROM (SELECT db_id, array_to_string(list_transform(regexp_extract_all(schema_sql, "
          f"{CREATE_RE}, 0), lambda x: {strip('x')}), {lit(chr(10) + chr(10))}) AS ddl FROM sf) WHERE ddl <> '')")
DEFAULT_SCHEMA = "('-- Database: ' || db_id || " + lit("\n-- WARNING: no schema.sql found; schema unknown") + ")"

LINES = ("lines AS (SELECT l_orderkey, l_linenumber - 1 AS idx, bool_or(l_returnflag <> 'R') AS passed FROM lineitem GROUP BY 1, 2)")
KEYS = ("ks AS (SELECT coalesce(d.doc_id, o.k) AS doc_id, coalesce(d.text, 'def f(x):' || chr(10) || "
        "repeat('    x = x + 1' || chr(10), coalesce(d.doc_id, o.k) % 40) || '    return x') AS text "
        "FROM documents d FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) o ON d.doc_id = o.k)")


def _each(first: str, text: str) -> str:
    return f"array_to_string(list_transform(range({first}, doc_id % 8 + 1), lambda i: {text}), ',')"


RESPONSE = ("(CASE WHEN doc_id % 50 = 49 THEN '' WHEN doc_id % 4 = 0 THEN " + lit("```python\n") + " || text || " + lit("\n```")
            + " WHEN doc_id % 4 = 1 THEN " + lit("Answer:\n```\n") + " || text || " + lit("\n```\nDone.")
            + " WHEN doc_id % 4 = 2 THEN " + lit("```python\n") + " || text ELSE text END)")
_NUMBER, _RESULT = "CAST(i AS VARCHAR)", "CAST(i * doc_id AS VARCHAR)"
_QUOTED = "'\"' || {} || '\"'"
GT = ("(CASE WHEN doc_id % 17 = 0 THEN 'not json [' WHEN doc_id % 3 = 0 THEN '{' || "
      "(CASE WHEN doc_id % 7 = 0 THEN '\"fn_name\":\"g\",' ELSE '' END) || '\"fn_name\":\"f\",\"inputs\":[' || "
      "(CASE WHEN doc_id % 5 = 0 THEN '1' || (CASE WHEN doc_id % 8 > 1 THEN ',' || " + _each("2", _QUOTED.format(_NUMBER))
      + " ELSE '' END) ELSE " + _each("1", _QUOTED.format(_NUMBER)) + " END) || '],\"outputs\":[' || "
      + _each("1", _QUOTED.format(_RESULT)) + " || ']}' ELSE '[' || "
      + _each("1", f"'\"assert f(' || {_NUMBER} || ') == ' || {_RESULT} || '\"'") + " || ']' END)")
# of the object form's tests, the one with an integer input is dropped
_DROPPED = "(CASE WHEN doc_id % 3 = 0 AND doc_id % 5 = 0 AND doc_id % 8 > 0 THEN 1 ELSE 0 END)"
CODE_SAMPLES = (f"{KEYS}, cs AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, {RESPONSE} AS response, "
                f"CASE WHEN doc_id % 17 = 0 THEN 0 ELSE doc_id % 8 - {_DROPPED} END AS total, {_DROPPED} AS dropped, {GT} AS gt FROM ks)")
# the passed tests of an order, joined by its key alone
OKS = "oks AS (SELECT l_orderkey, list(idx) AS passed_tests FROM lines WHERE passed GROUP BY l_orderkey)"
PASSED = "coalesce(len(list_filter(oks.passed_tests, lambda t: t < total)), 0)"
CODE_SCORED = (
    "cx AS (SELECT cs.*, " + unfence("response", "```python") + " AS code FROM cs), "
    "cl AS (SELECT doc_id, id, total, code = '' AS blank, " + nonblank_lines("code") + " AS lines FROM cx), "
    "cz AS (SELECT cl.id, cl.total, " + PASSED + " AS passed, cl.lines, (cl.total = 0 OR cl.blank) AS zero "
    "FROM cl LEFT JOIN oks ON oks.l_orderkey = cl.doc_id), "
    "cr AS (SELECT id, total, passed, zero, CASE WHEN total > 0 THEN CAST(passed AS DOUBLE) / total ELSE 0.0::DOUBLE END AS corr, "
    "lines, " + concise("lines") + " AS conc FROM cz)")
CODE_WITH = f"WITH {LINES}, {OKS}, {CODE_SAMPLES}, {CODE_SCORED}"
# correctness alone needs no code
CODE_PASSED = (f"WITH {LINES}, {OKS}, ks AS (SELECT doc_id FROM documents UNION SELECT l_orderkey FROM lineitem), "
               f"tt AS (SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN 0 ELSE doc_id % 8 - {_DROPPED} END AS total FROM ks), "
               f"cr AS (SELECT CAST(doc_id AS VARCHAR) AS id, total, {PASSED} AS passed FROM tt LEFT JOIN oks ON oks.l_orderkey = tt.doc_id)")
_CORR = "CASE WHEN total > 0 THEN CAST(passed AS DOUBLE) / total ELSE 0.0::DOUBLE END"

PROBLEMS = (
    "pp AS (SELECT p_partkey AS problem_id, p_name, p_brand, CAST(p_size AS VARCHAR) AS size, "
    "lower(p_type) || '_' || replace(p_name, ' ', '_') AS fn, p_partkey, p_size FROM part), "
    "pt AS (SELECT problem_id, p_name, fn, "
    "'assert ' || fn || '(' || size || ', ' || CAST(p_partkey AS VARCHAR) || ') == ' || CAST(p_size + p_partkey AS VARCHAR) AS t1, "
    "'assert ' || fn || '(''' || p_brand || ''', [' || size || ', 2]) == (' || size || ', ''' || p_brand || ''')' AS t2, "
    "'assert set(' || fn || '(' || size || ')) == set([' || size || '])' AS t3, "
    "'assert ' || fn || '(' || size || ' ** 2) == ' || CAST(p_size * p_size AS VARCHAR) AS t4, "
    "'assert ' || fn || '(\"' || p_name || '\", None, True) == {\"n\": ' || size || '}' AS t5, "
    "p_partkey, p_brand, size, p_size FROM pp), "
    "pl AS (SELECT problem_id, p_name, p_brand, size, p_partkey, p_size, CASE WHEN p_partkey % 13 = 5 THEN []::VARCHAR[] "
    "WHEN p_partkey % 9 = 4 THEN [t3, t1, t2] ELSE [t1, t2, t3, t4, t5] END AS tests FROM pt)")
FN_NAME = ("nullif(regexp_extract((CASE WHEN starts_with(" + strip("tests[1]") + ", 'assert ') THEN substring("
           + strip("tests[1]") + ", 8) ELSE " + strip("tests[1]") + " END), '^([a-zA-Z_][a-zA-Z0-9_]*)\\(', 1), '')")
ASSERTS = (
    "pf AS (SELECT pl.*, " + FN_NAME + " AS fn_name FROM pl), "
    "pu AS (SELECT problem_id, fn_name, unnest(tests) AS t, generate_subscripts(tests, 1) AS pos FROM pf), "
    "ps AS (SELECT problem_id, fn_name, pos, (CASE WHEN starts_with(" + strip("t") + ", 'assert ') THEN substring(" + strip("t")
    + ", 8) ELSE " + strip("t") + " END) AS s FROM pu), "
    "pq AS (SELECT problem_id, fn_name, pos, strpos(s, ' == ') AS k, s FROM ps), "
    "pr AS (SELECT problem_id, fn_name, pos, " + strip("left(s, k - 1)") + " AS call, " + strip("substring(s, k + 4)")
    + " AS expected FROM pq WHERE k > 0), "
    "pv AS (SELECT problem_id, fn_name, pos, substring(call, length(fn_name) + 2, length(call) - length(fn_name) - 2) AS args, "
    "expected FROM pr WHERE fn_name IS NOT NULL AND starts_with(call, fn_name || '(') AND ends_with(call, ')') "
    "AND length(call) >= length(fn_name) + 2)")
PROB_WITH = f"WITH {PROBLEMS}, {ASSERTS}"

JUDGE_SAMPLES = (
    f"js AS (SELECT CAST(d.doc_id AS VARCHAR) AS id, d.doc_id, l.quality, l.toxic, "
    f"{strip(f'CASE WHEN l.toxic = 1 THEN {lit(chr(32) * 2)} ELSE d.text END')} AS summary, "
    f"CASE WHEN l.toxic = 1 THEN {lit(chr(32) * 2)} ELSE d.text END AS response, "
    f"{strip(snap(strip('d.text')))} AS article, d.text AS reference "
    f"FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")
REPLY = (
    "(CASE WHEN doc_id % 5 = 0 THEN '{\"faithfulness\": ' || CAST(quality * 2 + 2 AS VARCHAR) || ', \"coverage\": 4, "
    "\"no_redundancy\": ' || CAST(5 - toxic * 2 AS VARCHAR) || ', \"appropriate_length\": 2, \"coherence\": 5}' "
    "WHEN doc_id % 5 = 1 THEN " + lit('Here is my rating:\n```json\n{"faithfulness": 5, "coverage": ')
    + " || CAST(quality + 3 AS VARCHAR) || " + lit(', "no_redundancy": 4, "appropriate_length": 1, "coherence": 4}\n```')
    + " WHEN doc_id % 5 = 2 THEN '{\"faithfulness\": 4, \"coverage\": ' || CAST(quality AS VARCHAR) || '}' "
    "WHEN doc_id % 5 = 3 THEN 'The summary looks fine to me.' END)")
# every ninth reply has not come, every fourth came twice
REPLIES = (f"jr AS (SELECT CAST(doc_id AS VARCHAR) AS sample_id, {REPLY} AS judge_text FROM labels, (VALUES (1), (2)) v(copy) "
           "WHERE doc_id % 9 <> 4 AND (copy = 1 OR doc_id % 4 = 1))")


def _dim(body: str, ok: str, d: str) -> str:
    return f"coalesce(CASE WHEN {ok} THEN TRY_CAST(json_extract({body}, '$.{d}') AS DOUBLE) END, 3.0::DOUBLE)"


JUDGE_PARSED = (
    "jb AS (SELECT sample_id, " + unfence(strip("judge_text"), "```json") + " AS body FROM jr), "
    "jo AS (SELECT sample_id, body, coalesce(regexp_matches(body, '(?s)^\\{.*\\}$') AND json_valid(body), false) AS ok FROM jb), "
    "jp AS (SELECT sample_id, " + ", ".join(f"{_dim('body', 'ok', d)} AS {d}" for d in DIMENSIONS) + " FROM jo)")
JUDGE_SCORED = (
    "jq AS (SELECT js.id, js.summary, js.summary = '' AS empty, " + length_rule("js.summary") + " AS rule, "
    + count_parts("js.summary") + " AS sents, jp.faithfulness AS f, jp.coverage AS c, jp.no_redundancy AS nr, "
    "jp.coherence AS co, js.summary <> '' AND jp.sample_id IS NULL AS pending "
    "FROM js LEFT JOIN (SELECT DISTINCT * FROM jp) jp ON js.id = jp.sample_id), "
    "jz AS (SELECT id, empty, pending, rule, sents, coalesce(f, 3.0) AS f, coalesce(c, 3.0) AS c, coalesce(nr, 3.0) AS nr, "
    "CASE WHEN rule = 1 THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END AS al, coalesce(co, 3.0) AS co FROM jq)")
JUDGE_WITH = f"WITH {JUDGE_SAMPLES}, {REPLIES}, {JUDGE_PARSED}, {JUDGE_SCORED}"
JUDGE_SCORE = "CASE WHEN empty THEN 0.0::DOUBLE WHEN NOT pending THEN round_even((f + c + nr + al + co - 5.0) / 20.0, 4) END"

_TSQL = "'SELECT count(*) FROM t WHERE turn = ' || CAST(turn AS VARCHAR)"
TRAJ = (
    "cv AS (SELECT conv_id, turn, role, text, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role FROM conversations), "
    "tr AS (SELECT CAST(conv_id AS VARCHAR) AS episode_id, CAST(turn AS BIGINT) AS turn, role, "
    "CASE WHEN role = 'assistant' THEN (CASE WHEN (conv_id + turn) % 5 = 3 THEN text || " + lit("\n<solution>SELECT ")
    + " || CAST(conv_id AS VARCHAR) || ' AS answer</solution>' WHEN (conv_id + turn) % 5 = 1 THEN '' "
    "WHEN (conv_id + turn) % 5 = 4 THEN text ELSE '<think>' || text || " + lit("</think>\n<sql>") + f" || {_TSQL} || '</sql>' END) "
    "WHEN role = 'user' AND prev_role = 'assistant' THEN " + lit("<observation>\n")
    + " || (CASE WHEN (conv_id + turn) % 7 = 0 THEN 'Error: ' ELSE '' END) || text || " + lit("\n</observation>")
    + " ELSE text END AS content, "
    f"CASE WHEN role = 'assistant' AND (conv_id + turn) % 5 = 1 AND conv_id % 6 <> 1 THEN {_TSQL} END AS tool_sql FROM cv)")
OBS_RE = "'(?s)<observation>\\n(.*?)\\n</observation>'"
ACTS = (
    "tn AS (SELECT tr.*, lead(role) OVER w AS next_role, lead(content) OVER w AS next_content FROM tr "
    "WINDOW w AS (PARTITION BY episode_id ORDER BY turn)), "
    "ta AS (SELECT episode_id, turn, coalesce(content, '') AS content, tool_sql, next_role, next_content, "
    "nullif(" + strip("regexp_extract(coalesce(content, ''), '(?s)<solution>(.*?)</solution>', 1)") + ", '') AS solution, "
    "nullif(" + strip("regexp_extract(coalesce(content, ''), '(?s)<sql>(.*?)</sql>', 1)") + ", '') AS tag_sql "
    "FROM tn WHERE role = 'assistant'), "
    "tb AS (SELECT ta.*, CASE WHEN solution IS NULL THEN coalesce(tag_sql, tool_sql) END AS sql FROM ta), "
    "tc AS (SELECT tb.*, CASE WHEN sql IS NOT NULL AND next_role = 'user' AND regexp_matches(coalesce(next_content, ''), " + OBS_RE
    + ") THEN regexp_extract(next_content, " + OBS_RE + ", 1) END AS obs, "
    "row_number() OVER (PARTITION BY episode_id ORDER BY turn) AS a_idx, "
    "coalesce(sum(CASE WHEN solution IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY episode_id ORDER BY turn "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior_sol FROM tb), "
    "td AS (SELECT tc.*, coalesce(starts_with(obs, 'Error:'), false) AS errored, "
    "coalesce(obs IS NOT NULL AND NOT starts_with(obs, 'Error:'), false) AS succeeded, "
    "CASE WHEN solution IS NOT NULL THEN 'solution' WHEN tag_sql IS NOT NULL THEN 'sql_tag' "
    "WHEN tool_sql IS NOT NULL THEN 'tool_call' ELSE 'none' END AS action FROM tc), "
    "tk AS (SELECT * FROM td WHERE a_idx <= 5 AND prior_sol = 0)")
METRICS = (
    "ep AS (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS episode_id, conv_id FROM conversations), "
    "agg AS (SELECT episode_id, count(*) AS num_turns, count(sql) AS sql_attempts, count(*) FILTER (WHERE errored) AS sql_errors, "
    "count(*) FILTER (WHERE content = '') AS empty_responses, arg_max(solution, a_idx) FILTER (WHERE solution IS NOT NULL) AS solution, "
    "arg_max(sql, a_idx) FILTER (WHERE succeeded) AS last_successful_sql, "
    "arg_max(obs, a_idx) FILTER (WHERE obs IS NOT NULL) AS last_observation FROM tk GROUP BY episode_id), "
    "em AS (SELECT ep.episode_id, ep.conv_id, coalesce(num_turns, 0) AS num_turns, coalesce(sql_attempts, 0) AS sql_attempts, "
    "coalesce(sql_errors, 0) AS sql_errors, coalesce(empty_responses, 0) AS empty_responses, "
    "solution IS NOT NULL AS submitted_solution, solution, last_successful_sql, coalesce(last_observation, '') AS last_observation "
    "FROM ep LEFT JOIN agg ON ep.episode_id = agg.episode_id)")
RESULTS = (
    "ro AS (SELECT CAST(o_custkey AS VARCHAR) AS episode_id, o_custkey AS c, o_orderkey, o_orderstatus AS s, year(o_orderdate) AS y, "
    "o_totalprice AS tp, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,8)) + CAST(9000000000000000 AS DECIMAL(38,8)) AS p, "
    "CAST('0.' || CAST(o_orderkey % 10 AS VARCHAR) AS DECIMAL(38,30)) AS r, CAST('1' || repeat('0', 25) AS DECIMAL(38,0)) AS z FROM orders), "
    "rpa AS (SELECT episode_id, o_orderkey, s, y, p + CAST(CASE WHEN c % 5 = 0 THEN '0.00000001' ELSE '0' END AS DECIMAL(38,8)) AS p, "
    "r + CAST(CASE WHEN c % 7 = 0 THEN '0.' || repeat('0', 29) || '1' ELSE '0' END AS DECIMAL(38,30)) AS r, "
    "z + CAST(CASE WHEN c % 11 = 0 THEN 1 ELSE 0 END AS DECIMAL(38,0)) AS z "
    "FROM ro WHERE c % 3 <> 0 OR tp > 50000), "
    "rp AS (SELECT DISTINCT episode_id, s, y, p, r, z FROM rpa), "
    "rg AS (SELECT DISTINCT episode_id, s, y, p, r, z FROM ro), "
    "rpo AS (SELECT episode_id, count(*) AS n FROM (SELECT * FROM rp EXCEPT SELECT * FROM rg) GROUP BY episode_id), "
    "rgo AS (SELECT episode_id, count(*) AS n FROM (SELECT * FROM rg EXCEPT SELECT * FROM rp) GROUP BY episode_id), "
    "req AS (SELECT CAST(c_custkey AS VARCHAR) AS episode_id, coalesce(rpo.n, 0) AS pred_only, coalesce(rgo.n, 0) AS gold_only, "
    "coalesce(rpo.n, 0) = 0 AND coalesce(rgo.n, 0) = 0 AS sets_equal FROM customer "
    "LEFT JOIN rpo ON rpo.episode_id = CAST(c_custkey AS VARCHAR) LEFT JOIN rgo ON rgo.episode_id = CAST(c_custkey AS VARCHAR))")


def digits(x: str) -> str:
    return f"(CASE WHEN contains(CAST({x} AS VARCHAR), '.') THEN rtrim(rtrim(CAST({x} AS VARCHAR), '0'), '.') ELSE CAST({x} AS VARCHAR) END)"


def _fmt(template: str, **cols: str) -> str:
    out, rest = [], template
    while rest:
        i = rest.find("{")
        if i < 0:
            out.append(lit(rest))
            break
        j = rest.index("}", i)
        if i:
            out.append(lit(rest[:i]))
        out.append(f"CAST({cols[rest[i + 1:j]]} AS VARCHAR)")
        rest = rest[j + 1:]
    return "(" + " || ".join(out) + ")"


def rewards_cte(fallback: bool) -> str:
    fb = "TRUE" if fallback else "FALSE"
    reason = (
        "CASE WHEN status = 'error' THEN NULL WHEN final_sql IS NULL THEN " + lit(NO_SUBMISSION)
        + " WHEN NOT db_present THEN " + _fmt(DB_MISSING, db_id="db_id", path="'/db/' || db_id || '.sqlite'")
        + " WHEN pred_status = 'error' THEN " + _fmt(SQL_FAILED, error="pred_error")
        + " WHEN gold_status = 'error' THEN " + lit(GOLD_FAILED)
        + " WHEN sets_equal THEN " + lit(CORRECT) + " ELSE " + lit(INCORRECT) + " END")
    return (
        "meta AS (SELECT episode_id, conv_id, 'db_' || CAST(conv_id % 8 AS VARCHAR) AS db_id, "
        "CASE WHEN conv_id % 23 = 22 THEN 'error' ELSE 'ok' END AS status, "
        "CASE WHEN conv_id % 11 = 10 THEN 'error' ELSE 'ok' END AS pred_status, "
        "CASE WHEN conv_id % 23 = 22 THEN 'ValueError: no reply' WHEN conv_id % 11 = 10 THEN 'no such column: x' END AS pred_error, "
        "CASE WHEN conv_id % 31 = 30 THEN 'error' ELSE 'ok' END AS gold_status, conv_id % 8 <> 7 AS db_present FROM ep), "
        f"fs AS (SELECT em.*, (solution IS NULL AND last_successful_sql IS NOT NULL AND {fb}) AS used_last_sql_fallback, "
        f"CASE WHEN solution IS NULL AND last_successful_sql IS NOT NULL AND {fb} THEN last_successful_sql ELSE solution END AS final_sql FROM em), "
        "rj AS (SELECT meta.episode_id, meta.db_id, meta.status, meta.pred_status, meta.pred_error, meta.gold_status, meta.db_present, fs.num_turns, "
        "fs.sql_attempts, fs.sql_errors, fs.empty_responses, fs.submitted_solution, fs.used_last_sql_fallback, fs.final_sql, "
        "fs.last_observation, coalesce(req.sets_equal, false) AS sets_equal FROM meta JOIN fs ON meta.episode_id = fs.episode_id "
        "LEFT JOIN req ON req.episode_id = meta.episode_id), "
        "rw AS (SELECT rj.*, CASE WHEN status = 'error' THEN -1.0 WHEN final_sql IS NULL THEN -0.1 WHEN NOT db_present THEN 0.0 "
        "WHEN pred_status = 'error' THEN 0.0 WHEN gold_status = 'error' THEN NULL WHEN sets_equal THEN 1.0 ELSE 0.0 END::DOUBLE AS reward, "
        f"{reason} AS reason FROM rj), "
        "rv AS (SELECT rw.*, CASE WHEN status = 'error' THEN 'error' WHEN gold_status = 'error' AND final_sql IS NOT NULL AND db_present "
        "AND pred_status <> 'error' THEN 'gold_error' ELSE 'ok' END AS st2 FROM rw), "
        "rf AS (SELECT rv.*, CASE WHEN status = 'error' THEN 'error' WHEN final_sql IS NULL THEN 'no_submission' "
        "WHEN st2 = 'gold_error' THEN 'gold_error' WHEN reward = 1.0 THEN 'correct' ELSE 'incorrect' END AS verdict FROM rv)")


EP_WITH = f"WITH {TRAJ}, {ACTS}, {METRICS}"
REWARD_WITH = lambda fb: f"WITH {TRAJ}, {ACTS}, {METRICS}, {RESULTS}, {rewards_cte(fb)}"

OUTCOME = (
    "CASE WHEN status = 'error' THEN " + _fmt("agent raised {error}", error="pred_error")
    + " WHEN final_sql IS NULL THEN " + _fmt(NO_ANSWER, a="sql_attempts", e="sql_errors", n="num_turns", reason="reason")
    + " || (CASE WHEN sql_errors > 0 AND sql_errors = sql_attempts THEN " + _fmt(ALL_ERRORED, last="last_observation")
    + " ELSE '' END) ELSE " + _fmt(ANSWER, verdict="CASE WHEN reward IS NULL THEN 'UNSCORED' WHEN reward = 1.0 THEN 'CORRECT' ELSE 'WRONG' END",
                                   how=f"CASE WHEN used_last_sql_fallback THEN {lit(FALLBACK)} ELSE {lit(SUBMITTED)} END",
                                   reason="reason", a="sql_attempts", e="sql_errors", n="num_turns") + " END")

JUDGE_REQ = (lit(J.JUDGE_TEMPLATE.split("{article}")[0]) + " || left(article, 3000) || "
             + lit(J.JUDGE_TEMPLATE.split("{article}")[1].split("{summary}")[0]) + " || summary || "
             + lit(J.JUDGE_TEMPLATE.split("{summary}")[1].split("{reference}")[0]) + " || left(reference, 500) || "
             + lit(J.JUDGE_TEMPLATE.split("{reference}")[1]))

GUIDE = (f"CASE WHEN errored THEN {lit(E.GUIDE_AFTER_ERROR)} ELSE {lit(E.GUIDE_AFTER_RESULT)} END")
OBS_TEXT = (f"CASE WHEN sql IS NOT NULL THEN {lit('<observation>' + chr(10))} || coalesce(obs, '') || "
            f"{lit(chr(10) + '</observation>' + chr(10))} || {GUIDE} || ' Turns left: ' || CAST(5 - a_idx AS VARCHAR) || "
            f"'.' ELSE {lit(E.NUDGE)} END")

HINT = convert.CODE_NAME_HINT.split("{fn}")


def EXACT_MEAN(c: str) -> str:  # noqa: N802 - mirrors monitor.exact_mean
    return f"(CAST(sum({c}::DECIMAL(18,4)) AS DOUBLE) / count({c}))"

ORACLE_SQL: dict[str, str] = {
    # ---------------------------------------------------------- converters
    "q_rlaif_convert": f"""WITH {ART} SELECT ordinal, 'cnn_dailymail' AS data_source, 'user' AS role, {RLAIF_CONTENT} AS content,
        'summarization' AS ability, 'llmj' AS style, h AS ground_truth FROM art WHERE {RLAIF_KEPT}""",
    "q_min_length": f"WITH {ART} SELECT ordinal, length(a) AS article_chars, length(h) AS highlight_chars FROM art WHERE {RLAIF_KEPT}",
    "q_sentence_snap": f"WITH {ART} SELECT ordinal, length(a) AS article_chars, length({snap('a')}) AS snapped_chars, {snap('a')} AS article FROM art",
    "q_first_n": f"WITH {ART} SELECT ordinal, h AS ground_truth FROM art WHERE {RLAIF_KEPT} ORDER BY ordinal LIMIT 5000",
    "q_convert_stats": f"""WITH {ART}, t AS (SELECT ordinal, CASE WHEN {RLAIF_KEPT} THEN 'converted' ELSE 'skipped_short' END AS reason FROM art),
        k AS (SELECT ordinal FROM t WHERE reason = 'converted' ORDER BY ordinal LIMIT 5000),
        c AS (SELECT count(*) AS n, max(ordinal) AS last FROM k)
        SELECT reason, count(*) AS n FROM t, c WHERE c.n < 5000 OR t.ordinal <= c.last GROUP BY reason""",
    "q_first_n_splits": f"""WITH sp AS (SELECT CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS split_ord, doc_id AS ordinal, {strip('text')} AS h FROM documents)
        SELECT split_ord, ordinal, h AS ground_truth FROM sp WHERE length(h) >= 100 ORDER BY split_ord, ordinal
        LIMIT (SELECT count(*) + 60 FROM sp WHERE split_ord = 0)""",
    "q_convert_stats_splits": f"""WITH sp AS (SELECT CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS split_ord, doc_id AS ordinal,
          CASE WHEN length({strip('text')}) >= 100 THEN 'converted' ELSE 'skipped_short' END AS reason FROM documents),
        pl AS (SELECT *, row_number() OVER (ORDER BY split_ord, ordinal) AS place,
          coalesce(sum(CASE WHEN reason = 'converted' THEN 1 ELSE 0 END) OVER (ORDER BY split_ord, ordinal
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS kept_before FROM sp)
        SELECT reason, count(*) AS n FROM pl WHERE kept_before < 60 GROUP BY reason""",
    "q_length_rule": f"SELECT doc_id, {length_rule(strip('text'))} AS length_rule FROM documents",
    "q_summary_sentences": f"SELECT doc_id, {count_parts(strip('text'))} AS summary_sentences FROM documents",
    "q_union_splits": """SELECT 'train' AS split, doc_id AS ordinal, text AS article FROM documents WHERE lang = 'en'
        UNION ALL SELECT 'test', doc_id, text FROM documents WHERE lang <> 'en' OR lang IS NULL""",
    "q_blank_filter": f"WITH {QUESTIONS} SELECT ordinal, db_id FROM q WHERE NOT {blank('question')} AND NOT {blank('query')}",
    "q_semi_available": f"""WITH {QUESTIONS}, {AVAIL} SELECT ordinal, db_id FROM q WHERE NOT {blank('question')}
        AND NOT {blank('query')} AND db_id IN (SELECT db_id FROM avail)""",
    "q_anti_missing": f"""WITH {QUESTIONS}, {AVAIL} SELECT ordinal, db_id FROM q WHERE NOT {blank('question')}
        AND NOT {blank('query')} AND db_id NOT IN (SELECT db_id FROM avail)""",
    "q_schema_default": f"""WITH {QUESTIONS}, {SCHEMA_FILES}, {CORPUS}
        SELECT q.ordinal, q.db_id, coalesce(corpus.ddl, {DEFAULT_SCHEMA.replace('db_id', 'q.db_id')}) AS schema
        FROM q LEFT JOIN corpus ON q.db_id = corpus.db_id""",
    "q_mtrl_convert": f"""WITH {QUESTIONS}, {AVAIL}, {SCHEMA_FILES}, {CORPUS},
        k AS (SELECT q.*, coalesce(corpus.ddl, {DEFAULT_SCHEMA.replace('db_id', 'q.db_id')}) AS schema FROM q
              LEFT JOIN corpus ON q.db_id = corpus.db_id
              WHERE NOT {blank('q.question')} AND NOT {blank('q.query')} AND q.db_id IN (SELECT db_id FROM avail))
        SELECT ordinal, db_id, {lit(convert.SQL_SYSTEM_PROMPT)} AS system_content,
          {lit('Database Schema:' + chr(10))} || schema || {lit(chr(10) + chr(10) + 'Question: ')} || question AS user_content,
          'text2sql' AS env_class, query AS ground_truth, 'train' AS split FROM k""",
    "q_regex_all": f"""WITH {SCHEMA_FILES} SELECT db_id, len(regexp_extract_all(schema_sql, {CREATE_RE}, 0)) AS n_creates,
        array_to_string(list_transform(regexp_extract_all(schema_sql, {CREATE_RE}, 0), lambda x: {strip('x')}), {lit(chr(10) * 2)}) AS ddl FROM sf""",
    "q_available_keys": f"WITH {AVAIL} SELECT DISTINCT db_id FROM avail",
    # ---------------------------------------------------------- code reward
    "q_extract_code": f"WITH {CODE_SAMPLES} SELECT id, {unfence('response', '```python')} AS code FROM cs",
    "q_conciseness": f"""{CODE_WITH} SELECT id, {nonblank_lines('code')} AS code_lines, {concise(nonblank_lines('code'))} AS conciseness FROM cx""",
    "q_rlvr_reward": f"""{CODE_WITH} SELECT id,
        CASE WHEN zero THEN 0.0::DOUBLE ELSE round_even(0.8::DOUBLE * corr + 0.2::DOUBLE * conc, 4) END AS aggregate_reward_score,
        total, passed, CASE WHEN zero THEN NULL ELSE corr END AS correctness, CASE WHEN zero THEN NULL ELSE conc END AS conciseness,
        CASE WHEN zero THEN NULL ELSE lines END AS code_lines FROM cr""",
    "q_rlvr_correctness": f"{CODE_PASSED} SELECT id AS sample_id, total, passed, {_CORR} AS correctness FROM cr",
    "q_ground_truth_fallback": f"""WITH {CODE_SAMPLES}
        SELECT id, CASE WHEN CAST(id AS BIGINT) % 13 = 0 THEN 'reference_answer' ELSE 'reward_model' END AS gt_source, gt FROM cs""",
    "q_zip_tests": f"""WITH {CODE_SAMPLES}, t AS (SELECT id, doc_id, dropped, unnest(range(total)) AS idx FROM cs)
        SELECT id AS sample_id, idx AS test_idx,
          CASE WHEN doc_id % 3 <> 0 THEN 'assert f(' || CAST(idx + 1 AS VARCHAR) || ') == ' || CAST((idx + 1) * doc_id AS VARCHAR) END AS assertion,
          CASE WHEN doc_id % 3 = 0 THEN 'f' END AS fn_name,
          CASE WHEN doc_id % 3 = 0 THEN CAST(idx + 1 + dropped AS VARCHAR) END AS args_text,
          CASE WHEN doc_id % 3 = 0 THEN CAST((idx + 1 + dropped) * doc_id AS VARCHAR) END AS expected FROM t""",
    "q_test_outcomes": f"""WITH {LINES}, {CODE_SAMPLES}, t AS (SELECT id, doc_id, unnest(range(total)) AS idx FROM cs)
        SELECT t.id AS sample_id, t.idx AS test_idx, coalesce(l.passed, false) AS passed
        FROM t LEFT JOIN lines l ON l.l_orderkey = t.doc_id AND l.idx = t.idx""",
    "q_fn_name": f"{PROB_WITH} SELECT problem_id, fn_name FROM pf",
    "q_assert_table": f"""{PROB_WITH} SELECT problem_id, CAST(row_number() OVER (PARTITION BY problem_id ORDER BY pos) - 1 AS BIGINT) AS test_idx,
        fn_name, args, expected FROM pv""",
    "q_rlvr_convert": f"""{PROB_WITH}, ok AS (SELECT pf.* FROM pf WHERE fn_name IS NOT NULL AND p_partkey % 13 <> 5 AND p_partkey % 9 <> 4
          AND problem_id IN (SELECT problem_id FROM pv))
        SELECT problem_id, fn_name, CAST(4 AS BIGINT) AS n_tests,
          {lit(CODE_PROMPT_LEAD)} || p_name || '.' || {lit(chr(10) * 2 + HINT[0])} || fn_name || {lit(HINT[1])} AS content,
          CAST(to_json(struct_pack(fn_name := fn_name,
            inputs := [size || {NL} || CAST(p_partkey AS VARCHAR), '"' || p_brand || '"' || {NL} || '[' || size || ', 2]',
                       CAST(p_size * p_size AS VARCHAR), '"' || p_name || '"' || {NL} || 'null' || {NL} || 'true'],
            outputs := [CAST(p_size + p_partkey AS VARCHAR), '[' || size || ', "' || p_brand || '"]', CAST(p_size * p_size AS VARCHAR), '{{"n": ' || size || '}}'])) AS VARCHAR)
          AS ground_truth FROM ok""",
    "q_double_json": f"""{PROB_WITH}, ok AS (SELECT pf.* FROM pf WHERE fn_name IS NOT NULL AND p_partkey % 13 <> 5 AND p_partkey % 9 <> 4
          AND problem_id IN (SELECT problem_id FROM pv))
        SELECT problem_id, fn_name, CAST(4 AS BIGINT) AS n_inputs, size || {NL} || CAST(p_partkey AS VARCHAR) AS first_input,
          CAST(p_size + p_partkey AS VARCHAR) AS first_output FROM ok""",
    # ---------------------------------------------------------- judge reward
    "q_judge_parse": f"WITH {REPLIES}, {JUDGE_PARSED} SELECT sample_id, {', '.join(DIMENSIONS)} FROM jp",
    "q_judge_aggregate": f"""{JUDGE_WITH}, jt AS (SELECT jz.*, {JUDGE_SCORE} AS s FROM jz)
        SELECT id, s AS aggregate_reward_score, CASE WHEN empty THEN 0.0 WHEN NOT pending THEN f END AS faithfulness,
          CASE WHEN empty THEN 0.0 WHEN NOT pending THEN c END AS coverage, CASE WHEN empty THEN 0.0 WHEN NOT pending THEN nr END AS no_redundancy,
          CASE WHEN empty THEN 0.0 WHEN NOT pending THEN al END AS appropriate_length, CASE WHEN empty THEN 0.0 WHEN NOT pending THEN co END AS coherence,
          CASE WHEN empty THEN NULL ELSE sents END AS summary_sentences, rule AS length_rule, (s < 0 OR s > 1) AS out_of_range FROM jt""",
    "q_judge_request": f"WITH {JUDGE_SAMPLES} SELECT id, {JUDGE_REQ} AS request FROM js WHERE summary <> ''",
    "q_article_from_prompt": f"WITH {JUDGE_SAMPLES} SELECT id, article FROM js",
    "q_metrics_long": f"""{CODE_WITH}, {JUDGE_SAMPLES}, {REPLIES}, {JUDGE_PARSED}, {JUDGE_SCORED},
        m1 AS (SELECT 'rlvr' AS scorer, id, CAST(0 AS BIGINT) AS metric_idx, 'correctness' AS name, corr AS value, 'Reward' AS type FROM cr WHERE NOT zero
          UNION ALL SELECT 'rlvr', id, 1, 'conciseness', conc, 'Metric' FROM cr WHERE NOT zero
          UNION ALL SELECT 'rlvr', id, 2, 'tests_passed', CAST(passed AS DOUBLE), 'Metric' FROM cr WHERE NOT zero
          UNION ALL SELECT 'rlvr', id, 3, 'code_lines', CAST(lines AS DOUBLE), 'Metric' FROM cr WHERE NOT zero),
        m2 AS (SELECT 'rlaif' AS scorer, id, CAST(0 AS BIGINT) AS metric_idx, 'faithfulness' AS name, CASE WHEN empty THEN 0.0 ELSE f END AS value, 'Reward' AS type FROM jz WHERE NOT pending
          UNION ALL SELECT 'rlaif', id, 1, 'coverage', CASE WHEN empty THEN 0.0 ELSE c END, 'Reward' FROM jz WHERE NOT pending
          UNION ALL SELECT 'rlaif', id, 2, 'no_redundancy', CASE WHEN empty THEN 0.0 ELSE nr END, 'Reward' FROM jz WHERE NOT pending
          UNION ALL SELECT 'rlaif', id, 3, 'appropriate_length', CASE WHEN empty THEN 0.0 ELSE al END, 'Reward' FROM jz WHERE NOT pending
          UNION ALL SELECT 'rlaif', id, 4, 'coherence', CASE WHEN empty THEN 0.0 ELSE co END, 'Reward' FROM jz WHERE NOT pending
          UNION ALL SELECT 'rlaif', id, 5, 'summary_sentences', CAST(sents AS DOUBLE), 'Metric' FROM jz WHERE NOT empty AND NOT pending)
        SELECT scorer, id, metric_idx, name, value, type FROM m1 UNION ALL SELECT scorer, id, metric_idx, name, value, type FROM m2""",
    "q_prompt_parse": """SELECT doc_id, CAST(CASE WHEN doc_id % 10 = 0 THEN 1 ELSE 2 END AS BIGINT) AS n_messages, text AS user_content,
        CASE WHEN doc_id % 10 = 0 THEN '' ELSE 'SELECT ' || CAST(doc_id AS VARCHAR) END AS gold_query,
        CASE WHEN doc_id % 10 = 0 THEN '' ELSE 'db_' || CAST(doc_id AS VARCHAR) END AS db_id FROM documents""",
    # ---------------------------------------------------------- episodes
    "q_extract_sql": f"""WITH {TRAJ} SELECT episode_id, turn,
        nullif({strip("regexp_extract(coalesce(content, ''), '(?s)<sql>(.*?)</sql>', 1)")}, '') AS sql FROM tr WHERE role = 'assistant'""",
    "q_extract_solution": f"""WITH {TRAJ} SELECT episode_id, turn,
        nullif({strip("regexp_extract(coalesce(content, ''), '(?s)<solution>(.*?)</solution>', 1)")}, '') AS solution FROM tr WHERE role = 'assistant'""",
    "q_observation_body": f"""WITH {TRAJ}, b AS (SELECT episode_id, turn, regexp_extract(content, {OBS_RE}, 1) AS body FROM tr
        WHERE role = 'user' AND regexp_matches(coalesce(content, ''), {OBS_RE}))
        SELECT episode_id, turn, body, starts_with(body, 'Error:') AS is_error FROM b""",
    "q_action_kind": f"""WITH {TRAJ}, {ACTS} SELECT episode_id, turn, action, sql,
        CASE WHEN content = '' AND sql IS NOT NULL AND tag_sql IS NULL THEN {lit('<sql>' + chr(10))} || sql || {lit(chr(10) + '</sql>')}
        ELSE content END AS recorded_content FROM td""",
    "q_action_observation": f"WITH {TRAJ}, {ACTS} SELECT episode_id, turn, sql, obs AS observation, errored FROM tk WHERE sql IS NOT NULL",
    "q_episode_truncate": f"WITH {TRAJ}, {ACTS} SELECT episode_id, turn, a_idx, 5 - a_idx AS turns_left, action FROM tk",
    "q_episode_metrics": f"""{EP_WITH} SELECT episode_id, num_turns, sql_attempts, sql_errors, empty_responses, submitted_solution,
        last_successful_sql, last_observation FROM em""",
    "q_last_success": f"""WITH {TRAJ}, {ACTS} SELECT episode_id, turn, last_value(CASE WHEN succeeded THEN sql END IGNORE NULLS)
        OVER (PARTITION BY episode_id ORDER BY a_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_successful_sql FROM tk""",
    "q_observation_text": f"""WITH {TRAJ}, {ACTS} SELECT episode_id, turn, 5 - a_idx AS turns_left, {OBS_TEXT} AS message
        FROM tk WHERE solution IS NULL""",
    "q_episode_rewards": f"""{REWARD_WITH(False)} SELECT episode_id, db_id, reward, st2 AS status, verdict, reason, final_sql,
        num_turns, sql_attempts, sql_errors, empty_responses, submitted_solution, used_last_sql_fallback FROM rf""",
    "q_fallback_reward": f"""{REWARD_WITH(True)} SELECT episode_id, reward, verdict, final_sql, used_last_sql_fallback FROM rf""",
    "q_episode_outcome": f"{REWARD_WITH(False)} SELECT episode_id, {OUTCOME} AS outcome FROM rf",
    "q_episode_flat": f"""{REWARD_WITH(False)} SELECT episode_id, reward AS episode_reward, coalesce(verdict, '') AS episode_verdict,
        coalesce(db_id, '') AS episode_db_id, num_turns AS episode_num_turns, sql_attempts AS episode_sql_attempts,
        sql_errors AS episode_sql_errors, empty_responses AS episode_empty_responses,
        submitted_solution AS episode_submitted_solution, used_last_sql_fallback AS episode_used_last_sql_fallback,
        coalesce(final_sql, '') AS episode_final_sql, CASE WHEN status = 'error' THEN pred_error ELSE '' END AS episode_error FROM rf""",
    "q_verdict_summary": f"""{REWARD_WITH(False)} SELECT verdict, db_id, count(*) AS episodes, {EXACT_MEAN('reward')} AS mean_reward
        FROM rf GROUP BY verdict, db_id""",
    # ---------------------------------------------------------- result sets
    "q_resultset_reward": f"""WITH {RESULTS} SELECT episode_id, sets_equal, pred_only, gold_only,
        CASE WHEN sets_equal THEN 1.0 ELSE 0.0 END::DOUBLE AS reward FROM req""",
    "q_resultset_diff": f"""WITH {RESULTS}, d AS (SELECT 'pred' AS only_in, * FROM (SELECT * FROM rp EXCEPT SELECT * FROM rg)
          UNION ALL SELECT 'gold', * FROM (SELECT * FROM rg EXCEPT SELECT * FROM rp))
        SELECT episode_id, only_in, s AS status, y AS yr, {digits('p')} AS price, {digits('r')} AS ratio, {digits('z')} AS size FROM d""",
    "q_result_preview": f"""WITH {RESULTS}, sides AS (SELECT episode_id, 'pred' AS side, o_orderkey, s, CAST(y AS VARCHAR) AS y, p, CAST(r AS VARCHAR) AS r, CAST(z AS VARCHAR) AS z FROM rpa
          UNION ALL SELECT episode_id, 'gold', o_orderkey, s, CAST(y AS VARCHAR) || '.0', p, left(CAST(r AS VARCHAR), 3), '1e+25' FROM ro),
        rk AS (SELECT sides.*, row_number() OVER (PARTITION BY episode_id, side ORDER BY o_orderkey) AS rn,
          count(*) OVER (PARTITION BY episode_id, side) AS n FROM sides),
        pv AS (SELECT episode_id, side, n AS n_rows, 'Result (' || CAST(n AS VARCHAR) || {lit(' rows):' + chr(10))} ||
          string_agg('  (''' || s || ''', ' || y || ', ' || CAST(p AS VARCHAR) || ', ' || r || ', ' || z || ')' || {NL}, '' ORDER BY rn) ||
          CASE WHEN n > 20 THEN '  ... (' || CAST(n - 20 AS VARCHAR) || ' more rows)' || {NL} ELSE '' END AS preview
        FROM rk WHERE rn <= 20 GROUP BY episode_id, side, n),
        es AS (SELECT CAST(c_custkey AS VARCHAR) AS episode_id, v.side FROM customer, (VALUES ('pred'), ('gold')) v(side))
        SELECT es.episode_id, es.side, coalesce(pv.n_rows, 0) AS n_rows,
          coalesce(pv.preview, {lit(NO_ROWS)}) AS preview
        FROM es LEFT JOIN pv ON es.episode_id = pv.episode_id AND es.side = pv.side""",
    # ---------------------------------------------------------- monitors
    "q_rollout_stats": f"""SELECT user_id, count(*) AS n, {EXACT_MEAN('value')} AS mean_score,
        stddev_pop(value) AS std_score,
        max(value) AS max_score, first(event_id ORDER BY value DESC, event_id DESC) AS best_event_id FROM events GROUP BY user_id""",
    "q_reward_monitor": f"""SELECT CAST(time_bucket(INTERVAL '1 day', ts) AS VARCHAR) AS window_start, count(*) AS n,
        {EXACT_MEAN('value')} AS mean_reward FROM events GROUP BY 1""",
    "q_stream_monitor": f"""SELECT CAST(time_bucket(INTERVAL '1 day', ts) AS VARCHAR) AS window_start, count(*) AS n,
        {EXACT_MEAN('value')} AS mean_reward FROM events GROUP BY 1""",
    # ---------------------------------------------------------- documented SQL shapes
    "q_count_filter": "SELECT count(*) AS n FROM customer WHERE c_acctbal > 1000",
    "q_above_avg": "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)",
    "q_point_lookup": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey = 7",
    "q_top_n": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "q_in_list": """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
        (SELECT c_custkey FROM customer WHERE c_nationkey = 5 ORDER BY c_custkey LIMIT 20)""",
}

_TOOL_ARGS = (
    "ta0 AS (SELECT p_partkey AS call_id, 'SELECT * FROM part WHERE p_partkey = ' || CAST(p_partkey AS VARCHAR) AS q, p_name, "
    "p_partkey % 6 AS k FROM part), "
    "ta1 AS (SELECT call_id, CASE WHEN k = 0 THEN '  ' || q || ' ' WHEN k = 1 THEN '{\"sql\": \" ' || q || '\"}' "
    "WHEN k = 2 THEN '{\"query\": \"' || q || '\", \"sql\": \"SELECT 1\"}' "
    "WHEN k = 3 THEN '{\"limit\": 5, \"note\": \"' || p_name || '\", \"text\": \"' || q || '\"}' "
    "WHEN k = 4 THEN '\"' || q || '\"' ELSE '[1, 2]' END AS a FROM ta0)")


def _key_str(k: str) -> str:
    return f"CASE WHEN json_type(a, '$.{k}') = 'VARCHAR' THEN a ->> '$.{k}' END"


TOOL_SQL = (
    "CASE WHEN a IS NULL OR a = '' THEN NULL WHEN NOT json_valid(a) THEN " + strip("a")
    + " WHEN json_type(a) = 'VARCHAR' THEN " + strip("a ->> '$'")
    + " WHEN json_type(a) = 'OBJECT' THEN " + strip(
        "coalesce(" + ", ".join(_key_str(k) for k in ("sql", "query", "statement"))
        + ", a ->> ('$.\"' || list_filter(json_keys(a), lambda x: json_type(a, '$.\"' || x || '\"') = 'VARCHAR')[1] || '\"'))")
    + " END")

JUDGE_SCORE_ROWS = (f"{JUDGE_WITH}, jt AS (SELECT jz.*, {JUDGE_SCORE} AS s FROM jz) "
                    "SELECT id, CAST(id AS BIGINT) AS sample_ord, s AS aggregate_reward_score FROM jt")

ORACLE_SQL.update({
    "q_tool_call_sql": f"WITH {_TOOL_ARGS} SELECT call_id, {TOOL_SQL} AS sql FROM ta1",
    "q_assert_literals": f"""{PROB_WITH}, ok AS (SELECT pf.* FROM pf WHERE fn_name IS NOT NULL AND p_partkey % 13 <> 5 AND p_partkey % 9 <> 4
          AND problem_id IN (SELECT problem_id FROM pv))
        SELECT problem_id, CAST(0 AS BIGINT) AS test_idx, size || {NL} || CAST(p_partkey AS VARCHAR) AS input, CAST(p_size + p_partkey AS VARCHAR) AS output FROM ok
        UNION ALL SELECT problem_id, 1, '"' || p_brand || '"' || {NL} || '[' || size || ', 2]', '[' || size || ', "' || p_brand || '"]' FROM ok
        UNION ALL SELECT problem_id, 2, CAST(p_size * p_size AS VARCHAR), CAST(p_size * p_size AS VARCHAR) FROM ok
        UNION ALL SELECT problem_id, 3, '"' || p_name || '"' || {NL} || 'null' || {NL} || 'true', '{{"n": ' || size || '}}' FROM ok""",
    "q_score_batch": JUDGE_SCORE_ROWS,
    "q_score_array": JUDGE_SCORE_ROWS,
    "q_stream_score": JUDGE_SCORE_ROWS,
    "q_mtrl_stats": f"""WITH {QUESTIONS}, {AVAIL}, t AS (SELECT ordinal, CASE WHEN {blank('question')} OR {blank('query')} THEN 'skipped_empty'
          WHEN db_id NOT IN (SELECT db_id FROM avail) THEN 'skipped_missing_db' ELSE 'converted' END AS reason FROM q),
        k AS (SELECT ordinal FROM t WHERE reason = 'converted' ORDER BY ordinal LIMIT 500),
        c AS (SELECT count(*) AS n, max(ordinal) AS last FROM k)
        SELECT reason, count(*) AS n FROM t, c WHERE c.n < 500 OR t.ordinal <= c.last GROUP BY reason""",
    "q_observed_counts": f"""WITH {QUESTIONS}, {AVAIL}, t AS (SELECT CASE WHEN {blank('question')} OR {blank('query')} THEN 'skipped_empty'
          WHEN db_id NOT IN (SELECT db_id FROM avail) THEN 'skipped_missing_db' ELSE 'converted' END AS reason FROM q),
        r AS (SELECT unnest(['converted', 'skipped_empty', 'skipped_missing_db', 'rows']) AS counter)
        SELECT counter, (SELECT count(*) FROM t WHERE counter = 'rows' OR t.reason = counter) AS n FROM r""",
    "q_available_files": "SELECT DISTINCT CAST(doc_id AS VARCHAR) || ' db' AS db_id FROM labels",
    "q_stream_dedup": f"WITH {JUDGE_SAMPLES} SELECT id, CAST(id AS BIGINT) AS sample_ord FROM js",
    "q_schema_corpus": f"WITH {SCHEMA_FILES}, {CORPUS} SELECT db_id, ddl FROM corpus",
    "q_stream_episodes": f"""{EP_WITH} SELECT episode_id, num_turns, sql_attempts, sql_errors, empty_responses, submitted_solution,
        solution AS final_sql, CASE WHEN submitted_solution THEN 'solution' WHEN num_turns >= 5 THEN 'turn_cap' ELSE 'timeout' END AS ended_by
        FROM em""",
})

ORACLE_SQL["q_sink_prompt"] = f"""WITH {QUESTIONS}, {AVAIL}, {SCHEMA_FILES}, {CORPUS},
    k AS (SELECT q.*, coalesce(corpus.ddl, {DEFAULT_SCHEMA.replace('db_id', 'q.db_id')}) AS schema FROM q
          LEFT JOIN corpus ON q.db_id = corpus.db_id
          WHERE NOT {blank('q.question')} AND NOT {blank('q.query')} AND q.db_id IN (SELECT db_id FROM avail))
    SELECT CAST(to_json(struct_pack(
        prompt := [struct_pack(role := 'system', content := {lit(convert.SQL_SYSTEM_PROMPT)}),
                   struct_pack(role := 'user', content := {lit('Database Schema:' + chr(10))} || schema
                               || {lit(chr(10) + chr(10) + 'Question: ')} || question)],
        env_class := 'text2sql',
        reward_spec := struct_pack(ground_truth := query, style := 'rule'),
        extra_info := struct_pack(db_id := db_id, question := question, split := 'train'))) AS VARCHAR) AS prompt FROM k"""

ORACLE_SQL["q_sink_jsonl"] = f"""SELECT data_source, content, ability, style, ground_truth FROM ({ORACLE_SQL['q_rlaif_convert']})
    UNION ALL SELECT 'mbpp', content, 'code', 'rule', ground_truth FROM ({ORACLE_SQL['q_rlvr_convert']})"""
_SLIDING = "(SELECT unnest([time_bucket(INTERVAL '1 day', ts), time_bucket(INTERVAL '1 day', ts) - INTERVAL '1 day']) AS w, * FROM events)"
ORACLE_SQL.update({
    "q_reward_presets": f"{CODE_PASSED} SELECT id, CASE WHEN total > 0 THEN round_even({_CORR}, 4) ELSE 0.0::DOUBLE END AS aggregate_reward_score FROM cr",
    "q_reward_plugin": f"""WITH {JUDGE_SAMPLES} SELECT id, CASE WHEN summary = '' THEN 0.0::DOUBLE ELSE least(length(response), 1000) / 1000.0::DOUBLE END
          AS aggregate_reward_score, CASE WHEN summary <> '' THEN CAST(length(response) AS DOUBLE) END AS chars,
        CASE WHEN summary = '' THEN 'ValueError: no response' END AS error FROM js""",
    "q_length_monitor": f"""SELECT CAST(w AS VARCHAR) AS window_start, count(*) AS n, {EXACT_MEAN('value')} AS mean_reward,
        avg(event_id % 5 + 1) AS mean_length FROM {_SLIDING} GROUP BY 1""",
    "q_stream_monitor_append": f"""SELECT CAST(w AS VARCHAR) AS window_start, count(*) AS n, {EXACT_MEAN('value')} AS mean_reward
        FROM {_SLIDING} GROUP BY 1""",
})
ORACLE_SQL["q_stream_counts"] = ORACLE_SQL["q_observed_counts"]
ORACLE_SQL["q_stream_lengths"] = f"""SELECT CAST(time_bucket(INTERVAL '1 day', ts) AS VARCHAR) AS window_start, count(*) AS n,
    {EXACT_MEAN('value')} AS mean_reward, avg(event_id % 5 + 1) AS mean_length FROM events GROUP BY 1"""
