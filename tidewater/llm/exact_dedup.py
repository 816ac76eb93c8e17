"""Exact deduplication against a persistent digest index.

The index is a table with one row per distinct text: its digest, the id of the
row that stays, the number of its copies and the batch it came in. It is
bucketed and sorted by digest, with a folder per batch. A batch of new documents
is reduced to one row per digest first (combined before the shuffle, so a group
of copies of any size arrives as a few rows), anti-joined by sort-merge with what
other batches left in the index, and appended. Both joins read the index by its
buckets: it is never shuffled.

A batch is named by the caller and owns its folder. If it is run again, as after
a failed job, it meets the other batches only, replaces what it had written, and
gives the same answer. Batches must not run at the same time.

Defined results: NULL text counts as the empty text; texts are equal when they
agree after lower-casing A to Z; of equal texts the row with the largest id
stays and NULL ids come last; a text an earlier batch holds is a copy of the row
that stayed then; ``group_size`` counts the rows of this batch and, where the
text is older, of the batch it came in; of rows that repeat both id and text one
stays; an empty table gives no rows; other columns of the input are not looked at.
"""
from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, fresh_name, whole_text
from tidewater.session import materialise, scratch_path

# Rows one array of repeated rows may expand to at once.
REPEATS = 1_000_000
# Rows with one digest, above which they are joined apart, where Spark can split them.
HOT_ROWS = 100_000


class DigestIndex:
    """A bucketed, sorted table of the digests seen so far.

    ``path`` is the folder of an index, new or written before; without it a new
    one is made in the shared folder. Open an index with the number of buckets
    it was made with.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = f"digest_index_{uuid.uuid4().hex}"
        location = self.path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.table} (text_sha256 STRING, keep_id BIGINT, group_size BIGINT, batch STRING) "
            f"USING parquet PARTITIONED BY (batch) CLUSTERED BY (text_sha256) SORTED BY (text_sha256) "
            f"INTO {self.buckets} BUCKETS LOCATION '{location}'"
        )
        if path:
            spark.sql(f"MSCK REPAIR TABLE {self.table}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, groups: DataFrame, batch: str) -> None:
        """Write the digests of ``groups`` that no other batch holds as this batch's part of the index."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
            raise ValueError("a batch is named by letters, digits, - and _")
        others = self.rows().filter(F.col("batch") != batch)
        dealt = groups.repartition(self.buckets, "text_sha256")
        fresh = dealt.hint("merge").join(others.select("text_sha256"), "text_sha256", "left_anti")
        # Written apart first: a table cannot be read while a part of it is replaced.
        fresh = materialise(fresh.select("text_sha256", "keep_id", "group_size"), "fresh-digests")
        view = f"fresh_{self.table}"
        sorted_buckets = fresh.repartition(self.buckets, "text_sha256").sortWithinPartitions("text_sha256")
        sorted_buckets.createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION (batch = '{batch}') SELECT * FROM {view}")
        self.spark.catalog.dropTempView(view)

    def forget(self) -> None:
        """Drop the table's name; the folder stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the digest of the normalised whole text, a row per row."""
    return docs.select("doc_id", F.sha2(ascii_lower(whole_text()), 256).alias("text_sha256"))


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``index`` holds earlier batches; ``batch`` names this one. Rows that repeat
    id and digest travel as one row with a count.
    """
    spark = docs.sparkSession
    index, batch = index or DigestIndex(spark), batch or uuid.uuid4().hex
    rows = materialise(
        digests(docs).groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("copies")), "digests"
    )
    sizes = rows.groupBy("text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"), F.count(F.lit(1)).alias("rows")
    )
    sizes = materialise(sizes, "groups")
    index.add(sizes.drop("rows"), batch)

    def answered(groups: DataFrame) -> DataFrame:
        """The row that stays and the size of each group, from the index by its buckets."""
        dealt = groups.select("text_sha256", F.col("group_size").alias("own")).repartition(index.buckets, "text_sha256")
        found = dealt.hint("merge").join(index.rows(), "text_sha256")
        mine = F.col("batch") == batch
        size = F.when(mine, F.col("own")).otherwise(F.col("own") + F.col("group_size"))
        return found.select("text_sha256", "keep_id", size.alias("group_size"), mine.alias("mine"))

    # A digest of very many rows is one key of a join: those are joined apart, with nothing but
    # shuffles on either side, where adaptive execution splits what is large.
    hot = materialise(answered(sizes.filter(F.col("rows") > HOT_ROWS)), "hot-groups")
    cold = rows.join(hot.select("text_sha256"), "text_sha256", "left_anti").repartition(index.buckets, "text_sha256")
    joined = cold.hint("merge").join(answered(sizes.filter(F.col("rows") <= HOT_ROWS)), "text_sha256")
    joined = joined.unionByName(rows.join(hot, "text_sha256"))
    blocks = joined.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / REPEATS))))
    first = F.col("block") * REPEATS
    copies = blocks.withColumn(
        "copy", F.explode(F.sequence(first, F.least(first + REPEATS, F.col("copies")) - 1))
    )
    stays = F.col("mine") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)
    return copies.select("doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """The documents that stay, with all their columns."""
    digest, key, rank = (fresh_name(docs, c) for c in ("_digest", "_key", "_rank"))
    as_key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    stay = deduplicate(docs, index, batch).filter("kept").select(F.col("text_sha256").alias(digest), as_key("doc_id").alias(key))
    marked = docs.withColumns({digest: F.sha2(ascii_lower(whole_text()), 256), key: as_key("doc_id")})
    one = Window.partitionBy(digest, key).orderBy(F.xxhash64(whole_text()))
    return (
        marked.join(stay, [digest, key], "left_semi")
        .withColumn(rank, F.row_number().over(one))
        .filter(F.col(rank) == 1)
        .select(*docs.columns)
    )
