"""Tokenisers and string helpers as Column expressions (JVM side, codegen).

Three splitters with different edge behaviour exist in the reference and are
kept apart on purpose:

* ``whitespace_tokens`` - a Java ``StringTokenizer`` on its default
  delimiters; never yields empty tokens.
* ``space_split`` - Java/Scala ``String.split(" ")``: inner and leading empty
  strings stay, trailing ones go, ``""`` gives ``[""]`` and a line of only
  spaces gives ``[]``.
* ``word_tokens`` - Python's Unicode ``\\w+`` find-all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default delimiter set of java.util.StringTokenizer
# (space, tab, newline, carriage return, form feed).  ``\s`` is not used
# because Java and RE2 disagree on the vertical tab.
TOKENIZER_DELIMS = "[ \\t\\n\\r\\f]+"

# Fixed value: Python's Unicode ``\w`` as an explicit class (Java's ``\w`` is
# ASCII only).
WORD_CLASS = "[\\p{L}\\p{N}_]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whitespace_tokens(c) -> Column:
    """ARRAY<STRING> of non-empty tokens split on the tokenizer delimiters."""
    parts = F.split(_col(c), TOKENIZER_DELIMS)
    return F.filter(parts, lambda t: t != F.lit(""))


# The same delimiters as single characters.
TOKENIZER_DELIM_CHARS = [" ", "\t", "\n", "\r", "\f"]


def whitespace_token_count(c) -> Column:
    """Number of non-empty whitespace tokens, without a lambda (stays in
    whole-stage codegen): a greedy split only leaves an empty first token
    after a leading delimiter and an empty last one before a trailing
    delimiter, and gives ``[""]`` for the empty string."""
    v = _col(c)
    first_is_delim = F.substring(v, 1, 1).isin(TOKENIZER_DELIM_CHARS).cast("int")
    last_is_delim = F.substring(v, -1, 1).isin(TOKENIZER_DELIM_CHARS).cast("int")
    n = F.size(F.split(v, TOKENIZER_DELIMS)) - first_is_delim - last_is_delim
    return F.when(v == F.lit(""), F.lit(0)).otherwise(F.greatest(n, F.lit(0)))


def space_split(c) -> Column:
    """ARRAY<STRING> with the semantics of Java ``line.split(" ")``."""
    v = _col(c)
    stripped = F.rtrim(v)                      # trailing spaces only
    return (F.when(v == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, " ")))


def word_tokens(c) -> Column:
    """ARRAY<STRING> of Unicode word runs (Python ``re.findall(r'\\w+')``)."""
    return F.regexp_extract_all(_col(c), F.lit(WORD_CLASS), 0)


_REGEX_META = set(".^$*+?()[]{}|\\")


def literal_of(pattern: str) -> str | None:
    """The literal text a regex matches if it is a plain literal (escaped
    punctuation allowed, e.g. ``\\.``), else ``None``."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            if i + 1 >= len(pattern) or pattern[i + 1].isalnum():
                return None                     # \d, \w, \Q... are not literals
            out.append(pattern[i + 1])
            i += 2
            continue
        if ch in _REGEX_META:
            return None
        out.append(ch)
        i += 1
    return "".join(out) if out else None


def delete_patterns(c, patterns: Sequence[str]) -> Column:
    """Remove every match of each Java regex, in list order (duplicates are
    dropped first, keeping the first occurrence).  Literal patterns use a
    plain string replace, which removes the same left-to-right,
    non-overlapping matches without the regex engine."""
    out = _col(c)
    seen: list[str] = []
    for p in patterns:
        if p not in seen:
            seen.append(p)
    for p in seen:
        lit = literal_of(p)
        out = F.replace(out, F.lit(lit), F.lit("")) if lit is not None \
            else F.regexp_replace(out, p, "")
    return out


# The regex characters that end a literal, and the escapes of
# single punctuation characters, as Java regexes.
_LITERAL_HEAD = r"^(?:[^\\.^$*+?()\[\]{}|]|\\[^a-zA-Z0-9])+"
_LAST_UNIT = r"(?:\\[^a-zA-Z0-9]|[^\\])$"


def pattern_entries(patterns: Column) -> Column:
    """An array of Java regexes as a struct ``(entries, gate)``.

    ``entries`` holds ``(pattern, head, plain)`` of each pattern once, in
    order: ``head`` is a literal that every match holds (the text before the
    first regex character; empty where alternatives or inline constructs make
    none certain), ``plain`` says that the head is the whole pattern.
    ``gate`` is a character class of the heads' first characters, empty if
    some pattern has no head."""
    def entry(p):
        raw = F.regexp_extract(p, _LITERAL_HEAD, 0)
        after = p.substr(F.length(raw) + 1, F.lit(1))
        sure = F.when(after.isin("*", "?", "{"), F.regexp_replace(raw, _LAST_UNIT, "")).otherwise(raw)
        sure = F.when(p.contains("|"), F.lit("")).otherwise(sure)
        return F.struct(p.alias("pattern"), F.regexp_replace(sure, r"\\(.)", "$1").alias("head"), (raw == p).alias("plain"))
    entries = F.transform(F.array_distinct(F.filter(patterns, lambda p: p != "")), entry)
    firsts = F.array_distinct(F.transform(entries, lambda e: F.substring(e["head"], 1, 1)))
    shown = F.transform(firsts, lambda c: F.regexp_replace(c, r"([\[\]\\^&-])", r"\\$1"))
    gate = F.when(F.array_contains(firsts, F.lit("")) | (F.size(firsts) == 0), F.lit("")) \
        .otherwise(F.concat(F.lit("["), F.array_join(shown, ""), F.lit("]")))
    return F.struct(entries.alias("entries"), gate.alias("gate"))


def delete_pattern_entries(c, patterns: Column) -> Column:
    """Remove every match of each pattern of ``pattern_entries``, in order.

    The patterns are folded over, so their number is not limited by the
    expression.  A pattern is applied only to a text that holds its head at
    that point, and a text in which the gate finds nothing is left as it is
    without looking at the patterns one by one."""
    text = _col(c)

    def step(acc, e):
        cut = F.when(e["plain"], F.replace(acc, e["head"], F.lit(""))).otherwise(F.regexp_replace(acc, e["pattern"], F.lit("")))
        return F.when(acc.contains(e["head"]), cut).otherwise(acc)

    some = (patterns["gate"] == "") | (F.regexp_instr(text, patterns["gate"]) > 0)
    return F.when(some, F.aggregate(patterns["entries"], text, step)).otherwise(text)


def normalise_line(c, lower: bool = False, patterns: Sequence[str] | Column = ()) -> Column:
    """Optional lower-casing, **then** pattern removal (the order matters).
    ``patterns`` is a list, or a column of ``pattern_entries``."""
    out = _col(c)
    if lower:
        out = F.lower(out)
    return delete_pattern_entries(out, patterns) if isinstance(patterns, Column) else delete_patterns(out, patterns)
