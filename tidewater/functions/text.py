"""String semantics that differ from Spark's own functions."""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def instr(s: Column, sub: str, start: int = 1, occurrence: int = 1) -> Column:
    """1-based position of the n-th occurrence of ``sub`` at or after ``start``; 0 if absent.

    Occurrences may overlap.
    """
    at = F.locate(sub, s, start) if isinstance(start, int) else start
    for _ in range(occurrence - 1):
        at = F.when(at > 0, F.call_function("locate", F.lit(sub), s, at + 1)).otherwise(F.lit(0))
    return at


def split_literal(s: Column, delimiter: str) -> Column:
    """SPLIT on a plain delimiter (Spark's own takes a pattern)."""
    return F.split(s, re.escape(delimiter), -1)


def initcap(s: Column, delimiters: str = " ") -> Column:
    """Capitalise the letter after the start or any of ``delimiters``, lower-case the rest."""
    lowered = F.lower(s)
    out = F.concat(F.upper(F.substring(lowered, 1, 1)), F.substring(lowered, 2, 2147483647))
    for d in delimiters:
        words = split_literal(out, d)
        out = F.array_join(
            F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2147483647))), d
        )
    return out


def full_match(s: Column, pattern: str) -> Column:
    return F.rlike(s, F.lit(f"^(?:{pattern})$"))
