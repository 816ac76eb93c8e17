"""Repeatable synthetic rows, one per input key."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS_PER_STRING = 10
INT_BOUND = 100


def _digest(key: Column, column: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(column), F.lit(str(seed))))


def _byte(digest: Column, i: int) -> Column:
    return F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("int")


def random_string(key: Column, column: str, seed: int) -> Column:
    """Lowercase letters, repeatable for (key, column, seed)."""
    d = _digest(key, column, seed)
    return F.concat(*[F.char(F.lit(97) + _byte(d, i) % 26) for i in range(LETTERS_PER_STRING)])


def random_int(key: Column, column: str, seed: int) -> Column:
    """Integer in [0, 100), repeatable for (key, column, seed)."""
    return F.conv(F.substring(_digest(key, column, seed), 1, 8), 16, 10).cast("bigint") % INT_BOUND


def generate_rows(keys: DataFrame, key: str, layout: Mapping[str, str], seed: int = 0) -> DataFrame:
    """One row per key with the columns of ``layout`` (name -> "string" or "bigint").

    Values depend on the key and the seed alone, so a retried task makes the same rows.
    """
    make = {"string": random_string, "bigint": random_int}
    return keys.select(key, *[make[t](F.col(key), n, seed).alias(n) for n, t in layout.items()])
