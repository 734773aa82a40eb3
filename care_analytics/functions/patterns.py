"""LIKE patterns given by users, as Spark predicates.

Pattern text follows the source dialect: ``%`` and ``_`` are wildcards,
``[abc]`` / ``[a-z]`` / ``[^a]`` are character classes, and there is no
escape character.  Comparison is case-insensitive by default, like the
source's collation.  Patterns without a class become ``ilike`` (JVM-side,
codegen'd); a pattern with a class becomes an anchored ``rlike``.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def like_to_regex(pattern: str) -> str:
    """Translate a LIKE pattern with character classes to a Java regex."""
    out = []
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif ch == "[":
            close = pattern.find("]", i + 1)
            if close == -1:
                out.append(re.escape(ch))
            else:
                body = pattern[i + 1:close]
                negate = body.startswith("^")
                if negate:
                    body = body[1:]
                cls = "".join("\\" + c if c in "\\[]&^" else c for c in body)
                out.append(("[^" if negate else "[") + cls + "]")
                i = close
        else:
            out.append(re.escape(ch))
        i += 1
    return "^" + "".join(out) + "$"


def like(col: Column, pattern: str, case_sensitive: bool = False) -> Column:
    """``col LIKE pattern`` with the source dialect's rules."""
    if "[" in pattern:
        flags = "(?s)" if case_sensitive else "(?is)"
        return col.rlike(flags + like_to_regex(pattern))
    # No escape character in the source: a backslash is literal.
    escaped = pattern.replace("\\", "\\\\")
    return col.like(escaped) if case_sensitive else col.ilike(escaped)


def match_any(col: Column, patterns: list[str], case_sensitive: bool = False) -> Column:
    """True when ``col`` matches at least one pattern (NULL when ``col`` is NULL)."""
    if not patterns:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [like(col, p, case_sensitive) for p in dict.fromkeys(patterns)])


def match_none(col: Column, patterns: list[str], case_sensitive: bool = False) -> Column:
    """True when ``col`` matches no pattern; a NULL ``col`` counts as no match."""
    return ~F.coalesce(match_any(col, patterns, case_sensitive), F.lit(False))


def contains_pattern(token: str) -> str:
    """``'%' + token + '%'``."""
    return f"%{token}%"
