"""SQL (DuckDB dialect) fragments for the oracle statements, generated from the
same fixed values the Spark column functions use, so both sides stay in step."""

from __future__ import annotations

import re
from collections.abc import Iterable

from .. import config as C


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(words: Iterable[str]) -> str:
    return "(" + ", ".join(q(w) for w in sorted(set(words))) + ")"


SUFFIX_RE = "".join(re.escape(ch) + "?" for ch in reversed(C.STRIP_ORDER)) + "$"
PREFIX_RE = "^" + "".join(re.escape(ch) + "?" for ch in C.STRIP_ORDER)
SPLIT_RE = r"[ \n\t\r]"


def raw_tokens(expr: str) -> str:
    return f"regexp_split_to_array(translate(lower({expr}), {q(C.DELETED_CHARS)}, ''), {q(SPLIT_RE)})"


def strip(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, {q(SUFFIX_RE)}, ''), {q(PREFIX_RE)}, '')"


def rule_flags(w: str, prefixes=C.DROP_PREFIXES) -> dict[str, str]:
    flags = {"short": f"length({w}) <= 1"}
    for name, pattern in C.TOKEN_PATTERNS.items():
        flags[name] = f"regexp_full_match({w}, {q(pattern)})"
    flags["prefix"] = "(" + " OR ".join(f"starts_with({w}, {q(p)})" for p in prefixes) + ")"
    return flags


# the platform of a case: one source of the documents has none set
PLATFORM = "CASE WHEN source = 'src13' THEN 'Please specify' ELSE source END"

FIXED_WORDS = sorted(set(C.STOP_WORDS) | set(C.DOMAIN_STOP_WORDS) | set(C.NAMES_AND_MONTHS))


def keep_predicate(w: str) -> str:
    parts = [f"NOT ({f})" for f in rule_flags(w).values()]
    parts.append(f"{w} NOT IN {in_list(FIXED_WORDS)}")
    return " AND ".join(parts)


OWNER_WORDS = "(SELECT DISTINCT lower(role) AS word FROM conversations WHERE role IS NOT NULL)"

CLEAN_TOKENS_S = f"""
(SELECT DISTINCT case_id, series, token FROM (
   SELECT doc_id AS case_id, lang AS series, {strip('w')} AS token
   FROM (SELECT doc_id, lang, unnest({raw_tokens("coalesce(text, " + q(C.DEFAULT_HISTORY) + ")")}) AS w
         FROM documents)
 ) s
 WHERE {keep_predicate('token')}
   AND token NOT IN (SELECT word FROM {OWNER_WORDS} o))
"""
CLEAN_TOKENS = f"(SELECT DISTINCT case_id, token FROM {CLEAN_TOKENS_S} cts)"


def line_terms(expr: str) -> str:
    return f"list_distinct(list_transform({raw_tokens(expr)}, lambda w: {strip('w')}))"


def md5_mod(expr: str, m: int) -> str:
    step = (1 << 32) % m
    acc = "0::BIGINT"
    for i in range(4):
        chunk = f"('0x' || substr(md5({expr}), {1 + 8 * i}, 8))::BIGINT"
        acc = f"(({acc}) * {step} + {chunk}) % {m}"
    return acc


def md5_unit(expr: str) -> str:
    return f"(('0x' || substr(md5({expr}), 1, 8))::BIGINT / {C.HASH_SCALE})"


def list_lit(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]::VARCHAR[]"


def templates_table(templates) -> str:
    rows = ", ".join(f"({i}, {list_lit(t.split(' '))})" for i, t in enumerate(templates))
    return f"(VALUES {rows}) AS tpl(template_id, twords)"


HISTORY_H = f"replace(lower(coalesce(text, {q(C.DEFAULT_HISTORY)})), chr(9), ' ')"
HISTORY_LINES = (f"CASE WHEN regexp_replace({HISTORY_H}, '\\n+$', '') = '' AND {HISTORY_H} <> '' "
                 f"THEN []::VARCHAR[] ELSE string_split(regexp_replace({HISTORY_H}, '\\n+$', ''), chr(10)) END")


def region_lines_sql(region: str) -> str:
    """(case_id, line_no, line) of a history region, from documents."""
    if region == "problem":
        sl = "lines[1 : len(lines) // 4]"
    else:
        sl = "lines[(3 * len(lines)) // 4 + 1 : len(lines)]"
    return (f"(SELECT case_id, unnest(r) AS line, generate_subscripts(r, 1) AS line_no FROM "
            f"(SELECT doc_id AS case_id, {sl} AS r FROM (SELECT doc_id, {HISTORY_LINES} AS lines "
            f"FROM documents) d0) d1)")


def longest_sql(region: str, templates) -> str:
    """(case_id, line_no, template_id, L, twords AS T, n, m, s, run) with the
    longest common run of each pair, by trying every start in both."""
    words = "string_split(regexp_replace(line, ' +$', ''), ' ')"
    return f"""
 SELECT case_id, line_no, template_id, L, T, n, m, best.i AS s, best.run AS run FROM (
   SELECT case_id, line_no, template_id, any_value(L) AS L, any_value(T) AS T, any_value(n) AS n, any_value(m) AS m,
          arg_max(struct_pack(i := i, run := run), [run, -i, -u]) AS best FROM (
     SELECT *, coalesce(list_min(list_filter(range(0, least(n - i, m - u)), lambda k: L[i + 1 + k] <> T[u + 1 + k])),
                        least(n - i, m - u)) AS run
     FROM (SELECT case_id, line_no, template_id, L, T, n, m, i, unnest(list_filter(range(0, m), lambda u: T[u + 1] = L[i + 1])) AS u
           FROM (SELECT *, unnest(list_filter(range(0, n), lambda i: list_contains(T, L[i + 1]))) AS i
                 FROM (SELECT case_id, line_no, template_id, L, twords AS T, len(L) AS n, len(twords) AS m
                       FROM (SELECT case_id, line_no, {words} AS L FROM {region_lines_sql(region)} x) l,
                            {templates_table(templates)}) y WHERE n >= m) z) v) w
   GROUP BY case_id, line_no, template_id) g"""


COSINE = """, round(CASE WHEN len(su) = m THEN
     list_reduce(list_transform(range(1, m + 1), lambda i: su[i] * tu[i]), lambda a, b: a + b)
     / (sqrt(list_reduce(list_transform(su, lambda a: a * a), lambda a, b: a + b))
        * sqrt(list_reduce(list_transform(tu, lambda a: a * a), lambda a, b: a + b))) ELSE 0.0 END, 6) AS cosine"""


def alignment_sql(region: str, templates, pick: str = "rightmost", more: str = "") -> str:
    """Aligned (line, template) pairs of a region with start/run/front/middle/tail/score."""
    words = "string_split(regexp_replace(line, ' +$', ''), ' ')"
    unit = "lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT / " + str(C.HASH_SCALE)
    found = f"""l AS (SELECT case_id, line_no, {words} AS L FROM {region_lines_sql(region)} x),
 a1 AS (SELECT case_id, line_no, template_id, L, twords AS T, len(L) AS n, len(twords) AS m,
              list_max(list_transform(twords, lambda t: coalesce(list_position(L, t), 0) - 1)) AS s
        FROM l, {templates_table(templates)}),
 a2 AS (SELECT *, list_position(T, L[s + 1]) AS u FROM a1 WHERE n >= m AND s >= 0),
 a3 AS (SELECT *, coalesce(list_min(list_filter(range(0, least(n - s, m - u + 1)),
                                                lambda k: L[s + 1 + k] <> T[u + k])),
                           least(n - s, m - u + 1)) AS run FROM a2)"""
    if pick == "longest":
        found = f"a3 AS ({longest_sql(region, templates)})"
    return f"""
(WITH {found},
 a4 AS (SELECT *, '<' || array_to_string(L[1 : s], '-') || '>' AS front,
               array_to_string(L[s + 1 : s + run], ' ') AS middle,
               '<' || array_to_string(L[s + run + 1 : n], '-') || '>' AS tail FROM a3),
 a5 AS (SELECT *, list_transform(list_concat([front], L[s + 1 : s + run], [tail]), {unit}) AS su,
               list_transform(T, {unit}) AS tu FROM a4),
 a6 AS (SELECT *, CASE WHEN len(su) = m THEN list_reduce(list_transform(range(1, m + 1),
                          lambda i: su[i] * tu[i]), lambda a, b: a + b) ELSE 0.0 END AS dt,
               CASE WHEN len(su) = m THEN sqrt(list_reduce(list_transform(range(1, m + 1),
                          lambda i: su[i] * su[i] + tu[i] * tu[i]), lambda a, b: a + b)) ELSE 0.0 END AS dn
        FROM a5)
 SELECT case_id, line_no, template_id, s + 1 AS start, run, front, middle, tail,
        round(CASE WHEN dn > 0 THEN dt / dn ELSE 0.0 END, 6) AS score{more} FROM a6)
"""


def guessed_sql(region: str, templates, default: str, pick: str = "rightmost") -> str:
    """(case_id, line, score) best line of a region per case with default."""
    return f"""
(WITH sc AS (SELECT r.case_id, r.line_no, r.line, coalesce(max(a.score), 0.0) AS score
             FROM {region_lines_sql(region)} r
             LEFT JOIN {alignment_sql(region, templates, pick)} a
               ON a.case_id = r.case_id AND a.line_no = r.line_no
             GROUP BY r.case_id, r.line_no, r.line),
 best AS (SELECT case_id, line, score
          FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY score DESC, line_no) AS k
                FROM sc) z WHERE k = 1)
 SELECT d.doc_id AS case_id, coalesce(b.line, {q(default)}) AS line, coalesce(b.score, 0.0) AS score
 FROM documents d LEFT JOIN best b ON b.case_id = d.doc_id)
"""
