"""Exact-duplicate groups, stable buckets and host roll-ups."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_groups(df: DataFrame, text: str, key: str, *more: Column) -> DataFrame:
    """One row per distinct whole text: digest, the key that is kept, and the number of copies.

    Only digests and keys are shuffled, and copies are combined before the
    shuffle, so a text with very many copies costs one row per task.
    """
    return df.groupBy(F.sha2(text, 256).alias("digest")).agg(
        F.min(key).alias("kept"), F.count(F.lit(1)).alias("n_copies"), *more
    )


def stable_bucket(columns: Sequence[str | Column], n: int, seed: int = 0) -> Column:
    """Repeatable bucket in [0, n) from the column values alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(n)).cast("int")


def host_of(url: Column | str) -> Column:
    return F.lower(F.call_function("try_parse_url", F.col(url) if isinstance(url, str) else url, F.lit("HOST")))


def last_labels(host: Column, n: int) -> Column:
    """Last ``n`` dot-separated labels of a host."""
    return F.substring_index(host, ".", -n)
