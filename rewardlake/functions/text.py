"""Column functions reproducing the Python text rules of the reference.

All of them are Catalyst expressions (no Python UDF), so they stay inside
whole-stage code generation and run wherever the rows are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes every character with str.isspace(); plain
# SQL trim only removes spaces.  The set is derived by rule (29 characters).
WS: str = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# ---- fixed values (markers and limits that must equal the reference) ----
FENCE = "```"
FENCE_PY = "```python"
FENCE_JSON = "```json"
ARTICLE_MARK = "Article:\n"
MAX_ARTICLE_LENGTH = 4000
JUDGE_ARTICLE_CHARS = 3000
JUDGE_REFERENCE_CHARS = 500
CONCISE_REFERENCE_LINES = 10
CREATE_TABLE_PATTERN = r"(?si)CREATE TABLE.*?\(.*?\);"
SQL_TAG_PATTERN = r"(?s)<sql>(.*?)</sql>"
SOLUTION_TAG_PATTERN = r"(?s)<solution>(.*?)</solution>"
OBSERVATION_PATTERN = r"(?s)<observation>\n(.*?)\n</observation>"
FN_NAME_PATTERN = r"^([a-zA-Z_][a-zA-Z0-9_]*)\("
# -------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(c) -> Column:
    """Python ``str.strip()``."""
    return F.btrim(_c(c), F.lit(WS))


def is_blank(c) -> Column:
    """``not s.strip()`` with NULL treated as blank."""
    return F.coalesce(py_strip(c) == F.lit(""), F.lit(True))


def unwrap_fence(c, tag: str = FENCE_PY) -> Column:
    """Text between the first tagged fence and the next fence, else between
    the first two bare fences, else the whole text; stripped (FN1 / FN12)."""
    c = _c(c)
    inner = F.when(c.contains(tag), F.split_part(F.split_part(c, F.lit(tag), F.lit(2)), F.lit(FENCE), F.lit(1))) \
             .when(c.contains(FENCE), F.split_part(c, F.lit(FENCE), F.lit(2))) \
             .otherwise(c)
    return py_strip(inner)


def extract_code(response) -> Column:
    """FN1: code of a model response (NULL response treated as '')."""
    return unwrap_fence(F.coalesce(_c(response), F.lit("")), FENCE_PY)


def nonblank_lines(code) -> Column:
    """FN2/FN3: number of lines with non-blank content (split on '\\n')."""
    return F.size(F.filter(F.split(_c(code), "\n"), lambda x: py_strip(x) != F.lit("")))


def conciseness(n_lines, reference_length: int = CONCISE_REFERENCE_LINES) -> Column:
    """FN2: 1.0 up to the reference length, 0.2 from 3x on, linear between."""
    n = _c(n_lines)
    top = reference_length * 3
    return (F.when(n <= reference_length, F.lit(1.0))
             .when(n >= top, F.lit(0.2))
             .otherwise(F.lit(1.0) - F.lit(0.8) * ((n - F.lit(reference_length)) / F.lit(float(top - reference_length)))))


def drop_assert_prefix(s) -> Column:
    s = _c(s)
    return F.when(s.startswith("assert "), F.substring(s, 8, 1 << 30)).otherwise(s)


def fn_name_from_tests(test_list) -> Column:
    """FN4: identifier called by the first assertion, NULL if none."""
    first = py_strip(F.get(_c(test_list), 0))
    return F.nullif(F.regexp_extract(drop_assert_prefix(first), FN_NAME_PATTERN, 1), F.lit(""))


def split_asserts(assertions, fn_name) -> Column:
    """FN5 structural part: ARRAY<STRUCT<ok, args, expected>>, one for each assertion.

    ``ok`` is true when the text splits at the first ' == ' and the left side
    is exactly ``fn(...)``; ``args`` is the text between the parentheses.  Each
    step is an array of its own, so that no text is cut or stripped twice.
    """
    head = F.concat(_c(fn_name), F.lit("("))
    texts = F.transform(F.transform(_c(assertions), py_strip), drop_assert_prefix)
    cut = F.transform(texts, lambda s: F.struct(s.alias("s"), F.locate(" == ", s).alias("pos")))
    sides = F.transform(cut, lambda c: F.struct(
        py_strip(F.when(c["pos"] > 0, F.substring(c["s"], F.lit(1), c["pos"] - 1))).alias("call"),
        py_strip(F.when(c["pos"] > 0, F.substring(c["s"], c["pos"] + 4, F.lit(1 << 30)))).alias("expected")))

    def parts(c: Column) -> Column:
        call = c["call"]
        ok = call.startswith(head) & call.endswith(")") & (F.length(call) >= F.length(head) + 1)
        args = F.substring(call, F.length(head) + 1, F.length(call) - F.length(head) - 1)
        return F.struct(F.coalesce(ok, F.lit(False)).alias("ok"), args.alias("args"), c["expected"].alias("expected"))

    return F.transform(sides, parts)


def first_user_content(prompt) -> Column:
    """FLT6: content of the first message whose role is 'user' (NULL if none)."""
    first = F.try_element_at(F.filter(_c(prompt), lambda m: m["role"] == F.lit("user")), F.lit(1))
    return first["content"]


def article_from_prompt(prompt) -> Column:
    """FN8: article after the first 'Article:\\n' of the first user message."""
    content = F.coalesce(first_user_content(prompt), F.lit(""))
    after = F.substring(content, F.locate(ARTICLE_MARK, content) + F.lit(len(ARTICLE_MARK)), F.lit(1 << 30))
    return (F.when(F.coalesce(F.size(F.filter(_c(prompt), lambda m: m["role"] == F.lit("user"))), F.lit(0)) <= 0,
                   F.lit(""))
             .when(content.contains(ARTICLE_MARK), py_strip(after))
             .otherwise(content))


def last_char_position(s, ch: str) -> Column:
    """1-based position of the last ``ch`` in ``s``; 0 when absent."""
    s = _c(s)
    return F.length(s) - F.length(F.substring_index(s, ch, -1))


def sentence_snap(article, max_len: int = MAX_ARTICLE_LENGTH) -> Column:
    """FN9: cut to ``max_len``; keep through the last '.' if it lies past the
    half-way point (0-based index > max_len // 2), else hard cut."""
    a = _c(article)
    cut = F.left(a, F.lit(max_len))
    p = last_char_position(cut, ".")
    snapped = F.when(p - 1 > F.lit(max_len // 2), F.left(cut, p)).otherwise(cut)
    return F.when(F.length(a) > max_len, snapped).otherwise(a)


def sentence_parts(s, fold_newline: bool) -> Column:
    s = _c(s)
    if fold_newline:
        s = F.replace(s, F.lit(".\n"), F.lit(". "))
    return F.filter(F.split(s, r"\. "), lambda x: py_strip(x) != F.lit(""))


def length_rule(summary) -> Column:
    """FN10: 1 when the summary has 2-4 sentences, else 0 (blank -> 0)."""
    n = F.size(sentence_parts(summary, True))
    return F.when(is_blank(summary), F.lit(0)).when(n.between(2, 4), F.lit(1)).otherwise(F.lit(0))


def summary_sentences(summary) -> Column:
    """FN11: the metric variant: split on '. ' without folding '.\\n'."""
    return F.size(sentence_parts(F.coalesce(_c(summary), F.lit("")), False))


def create_statements(schema_sql) -> Column:
    """FN15: every ``CREATE TABLE ... ( ... );`` joined by a blank line."""
    found = F.regexp_extract_all(_c(schema_sql), F.lit(CREATE_TABLE_PATTERN), F.lit(0))
    return F.array_join(F.transform(found, lambda x: py_strip(x)), "\n\n")


def extract_tag(text, pattern: str) -> Column:
    """FN16: stripped first match of a DOTALL tag pattern; '' and no match -> NULL.

    The reference returns '' for an empty tag and the caller treats it as
    absent, so both collapse to NULL here.
    """
    return F.nullif(py_strip(F.regexp_extract(F.coalesce(_c(text), F.lit("")), pattern, 1)), F.lit(""))


def extract_sql(text) -> Column:
    return extract_tag(text, SQL_TAG_PATTERN)


def extract_solution(text) -> Column:
    return extract_tag(text, SOLUTION_TAG_PATTERN)


def observation_body(text) -> Column:
    """FN26: body of ``<observation>\\n...\\n</observation>``; NULL if absent."""
    t = F.coalesce(_c(text), F.lit(""))
    return F.when(t.rlike(OBSERVATION_PATTERN), F.regexp_extract(t, OBSERVATION_PATTERN, 1))


def strict_json_object(text) -> Column:
    """True when ``text`` is a single JSON object (guards lenient parsers)."""
    t = py_strip(_c(text))
    return F.coalesce(t.startswith("{") & t.endswith("}") & F.try_parse_json(t).isNotNull(), F.lit(False))
