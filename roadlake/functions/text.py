"""String helpers: glob patterns, topic names, path parts, blank checks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def glob_regex(pattern: str) -> str:
    """A shell glob (*, ?, [seq], [!seq]) as an anchored Java regular expression."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        close = pattern.find("]", i + 2) if ch == "[" else -1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif close > 0:
            body = pattern[i + 1 : close].replace("\\", "\\\\")
            out.append("[" + ("^" + body[1:] if body.startswith("!") else body) + "]")
            i = close
        else:
            out.append(re.escape(ch))
        i += 1
    return "(?s)^" + "".join(out) + "$"


def matches_any(name: Column, patterns: list[str] | tuple[str, ...]) -> Column:
    """True when `name` matches one of the globs; false for no patterns."""
    if not patterns:
        return F.lit(False)
    return F.coalesce(name.rlike("|".join(f"(?:{glob_regex(p)})" for p in patterns)), F.lit(False))


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def path_part(value: Column) -> Column:
    """Characters outside letters, digits and ._=- become one underscore per run."""
    return F.regexp_replace(value, "[^A-Za-z0-9._=-]+", "_")


def topic_domain(topic: Column) -> Column:
    return F.regexp_replace(topic, "^signals\\.", "")
