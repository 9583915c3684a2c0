"""Text preparation as Spark column expressions (JVM side, no Python UDF).

Every function maps Column -> Column so Catalyst can fuse them into one
projection next to the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

# stripping one of each from the end in STRIP_ORDER removes a suffix matching the
# characters in reverse order, each optional; the start is stripped in order
_SUFFIX_RE = "".join(re.escape(ch) + "?" for ch in reversed(C.STRIP_ORDER)) + r"\z"
_PREFIX_RE = "^" + "".join(re.escape(ch) + "?" for ch in C.STRIP_ORDER)


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_default(c: Column | str, default: str) -> Column:
    """``Option(x).getOrElse(d)``."""
    return F.coalesce(col_(c), F.lit(default))


def delete_chars(c: Column | str, chars: str = C.DELETED_CHARS) -> Column:
    """Remove every character of ``chars`` (one pattern over the text;
    ``translate`` makes a string of every character)."""
    return F.regexp_replace(col_(c), f"[{re.escape(chars)}]+", "") if chars else col_(c)


def raw_tokens(c: Column | str) -> Column:
    """lower -> delete characters -> split on space/newline/tab/CR."""
    return F.split(delete_chars(F.lower(col_(c))), C.TOKEN_SPLIT)


def strip_affixes(w: Column) -> Column:
    """Strip at most one each of ``. : , ~ -`` from the end (in that order),
    then the same from the start.  Most words begin and end with none of them
    and are left as they are without a pattern."""
    ends = F.when(F.substring(w, -1, 1).isin(C.STRIP_ORDER), F.regexp_replace(w, _SUFFIX_RE, "")).otherwise(w)
    return F.when(F.substring(w, 1, 1).isin(C.STRIP_ORDER), F.regexp_replace(ends, _PREFIX_RE, "")).otherwise(ends)


def full_match(w: Column, pattern: str) -> Column:
    return w.rlike(f"^(?:{pattern})\\z")


def token_rule_flags(w: Column, prefixes: Sequence[str] = C.DROP_PREFIXES) -> dict[str, Column]:
    """One boolean column per drop rule that does not need a dictionary."""
    flags = {"short": F.length(w) <= 1}
    for name, pattern in C.TOKEN_PATTERNS.items():
        flags[name] = full_match(w, pattern)
    flags["prefix"] = F.lit(False)
    for p in prefixes:
        flags["prefix"] = flags["prefix"] | w.startswith(p)
    return flags


def any_pattern(patterns=None) -> str:
    """All drop patterns as one anchored alternation (one regex test per token)."""
    patterns = C.TOKEN_PATTERNS.values() if patterns is None else patterns
    return "^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")\\z"


def may_match(w: Column) -> Column:
    """False for tokens that match none of ``TOKEN_PATTERNS`` for sure: a match
    begins with a digit or one of ``< > . -`` (all of them at most ``@``), holds
    an ``@`` or ends with one of the suffixes."""
    return ((F.substring(w, 1, 1) <= "@") | w.endswith("ed") | w.endswith("ly") | w.endswith("ing")
            | w.contains("@"))


def token_is_kept(w: Column, dictionaries: Iterable[Sequence[str]] = (),
                  prefixes: Sequence[str] = C.DROP_PREFIXES) -> Column:
    """True when no rule drops the token.  Cheap tests first: fixed
    dictionaries as an ``InSet`` hash lookup, length, prefixes, then a single
    regex for all patterns, for the few tokens that may match one."""
    keep = F.length(w) > 1
    words = sorted({x for d in dictionaries for x in d})
    if words:
        keep = ~w.isin(words) & keep
    for p in prefixes:
        keep = keep & ~w.startswith(p)
    return keep & ~(may_match(w) & w.rlike(any_pattern()))


def clean_token_array(text: Column | str, dictionaries: Iterable[Sequence[str]] = (),
                      prefixes: Sequence[str] = C.DROP_PREFIXES) -> Column:
    """The whole per-document cleaning chain, as a de-duplicated array."""
    dictionaries = list(dictionaries)
    # de-duplicate first: each distinct token is stripped and tested once
    toks = F.transform(F.array_distinct(raw_tokens(null_default(text, C.DEFAULT_HISTORY))), strip_affixes)
    return F.filter(F.array_distinct(toks), lambda w: token_is_kept(w, dictionaries, prefixes))


def word_set(c: Column | str) -> Column:
    """Title words: lower, delete characters, split, de-duplicate (no filters)."""
    return F.array_distinct(raw_tokens(c))


def pack(a: Column | str, b: Column | str, sep: str = C.PACK_SEPARATOR) -> Column:
    """``a || '--' || b`` where NULL counts as ''."""
    return F.concat(F.coalesce(col_(a), F.lit("")), F.lit(sep), F.coalesce(col_(b), F.lit("")))


def unpack(c: Column | str, k: int, sep: str = C.PACK_SEPARATOR) -> Column:
    """k-th (1-based) part of a packed column; NULL when missing."""
    return F.try_element_at(F.split(col_(c), sep), F.lit(k))


def normalise_platform(c: Column | str) -> Column:
    low = F.lower(col_(c))
    return F.when(low == C.PLATFORM_UNSET, F.lit(C.PLATFORM_UNKNOWN)).otherwise(low)


def history_lines(c: Column | str) -> Column:
    """lower, tabs to spaces, split on newline; trailing empty lines are
    dropped like a Java split does (an all-newline text gives no lines)."""
    h = F.replace(F.lower(null_default(c, C.DEFAULT_HISTORY)), F.lit("\t"), F.lit(" "))
    trimmed = F.rtrim(h, F.lit("\n"))
    return F.when((trimmed == "") & (h != ""), F.array().cast("array<string>")) \
        .otherwise(F.split(trimmed, "\n"))


def leading_slice(lines: Column, num: int = C.PROBLEM_FRACTION[0],
                  den: int = C.PROBLEM_FRACTION[1]) -> Column:
    """First floor(n * num/den) lines."""
    n = F.size(lines)
    return F.slice(lines, 1, F.floor(n * num / den).cast("int"))


def trailing_slice(lines: Column, num: int = C.SOLUTION_FRACTION[0],
                   den: int = C.SOLUTION_FRACTION[1]) -> Column:
    """Lines from index floor(n * num/den) (0-based) to the end."""
    n = F.size(lines)
    start = F.floor(n * num / den).cast("int")
    return F.slice(lines, start + 1, n - start)


def line_words(line: Column) -> Column:
    """Split a line on single spaces; trailing empty words are dropped."""
    return F.split(F.regexp_replace(line, " +\\z", ""), " ")


def explode_once(df, array_col: Column, alias: str, *keep: str, pos: str | None = None):
    """Explode an expensive array expression.  With plain ``explode`` the
    optimizer infers a ``size(array) > 0`` filter below the generator and
    evaluates the array expression twice (and below any exchange); the outer
    form plus a null filter evaluates it once."""
    if pos:
        out = df.select(*keep, F.posexplode_outer(array_col).alias(pos, alias))
    else:
        out = df.select(*keep, F.explode_outer(array_col).alias(alias))
    return out.where(F.col(alias).isNotNull())
