"""Phrase collocations by stripes.

A stripe is a prefix with an associative counter of the words that follow it.
Level k counts phrases of k words: tasks count chunks of many texts, send one
stripe per prefix (and a few for a prefix that a large share of all words
follows, by the next word's hash), and stripes of a prefix are merged element
by element where they meet. One structure gives everything that is needed:

* extensions: the merged counts of a prefix are the phrases one word longer;
* totals: the empty prefix's stripe counts the words, under the empty word all
  of them, and a longer prefix's own total is its entry one level lower;
* subsumption: the largest count of any phrase one word longer, over stripes
  read by prefix and by suffix.

A phrase is counted only if both phrases it has one word less of may reach
``least``. Tasks test that on a bitmap of fixed size with a bit for each phrase
of the level before that did; a full bitmap costs time, never a phrase, because
a set bit only lets a phrase be counted, and every count is of real words.

Defined results: NULL text is the empty text; NULL lang is ``und``; ids,
repeated rows and other columns are not looked at (a repeated row counts again);
texts of any length are read whole, and long ones are cut at piece ends; ties
in score and count go by the phrase's bytes; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import LOWER, UPPER, mix, small_batches, whole_text
from tidewater.session import materialise

LONGEST = 4
LEAST = 30
TOP = 2000
COVERED = 80  # per cent
SCALE = 2_000_000
CHUNK_BYTES = 12 << 20
# Bits of the bitmap of frequent phrases: 8 MiB, whatever the size of the tables.
FILTER_BITS = 26
# A prefix with more than this share of all words is split; there are at most 1 / share of them a level.
HOT_SHARE = 1 / 10_000
SALTS = 64
WORD_SALTS = 256

BREAK = b"."
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(_ENDS + UPPER.encode(), BREAK * len(_ENDS) + LOWER.encode())

STRIPE = "lang string, prefix string, salt int, next array<string>, counts array<bigint>"
_STRIPE_ARROW = pa.schema(
    [
        ("lang", pa.string()),
        ("prefix", pa.string()),
        ("salt", pa.int32()),
        ("next", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)


def word_hash(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(np.asarray(words.to_pylist(), object), categorize=False) if len(words) else np.zeros(0, np.uint64)


def phrase_hash(columns: list[np.ndarray], lang: str) -> np.ndarray:
    """Hash of phrases given by the hashes of their first, second, ... words."""
    total = np.full(len(columns[0]), word_hash(pa.array([lang]))[0], np.uint64)
    for words in columns:
        total = mix(total * np.uint64(3) + words)
    return total


class Words:
    """The words of a chunk as numbers, -1 where a piece ends, with the hashes of the distinct ones."""

    def __init__(self, data: bytes):
        line = pa.array([data], pa.binary()).cast(pa.string())
        coded = pc.ascii_split_whitespace(line).values.dictionary_encode()
        self.vocabulary = coded.dictionary
        ids = coded.indices.to_numpy().astype(np.int64)
        names = pc.index_in(pa.array(["", BREAK.decode()]), value_set=self.vocabulary).to_pylist()
        if names[0] is not None:
            ids = ids[ids != names[0]]
        if names[1] is not None:
            ids[ids == names[1]] = -1
        self.ids, self.hashes = ids, word_hash(self.vocabulary)

    def phrases(self, length: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(which places start a phrase of ``length`` words, the numbers of its words, a column each)."""
        n = max(0, len(self.ids) - length + 1)
        columns = [self.ids[k : k + n] for k in range(length)]
        inside = np.ones(n, bool)
        for c in columns:
            inside &= c >= 0
        return inside, columns

    def known(self, length: int, lang: str, bitmap: np.ndarray) -> np.ndarray:
        """Which places start a phrase whose bit is set."""
        inside, columns = self.phrases(length)
        at = np.flatnonzero(inside)
        place = phrase_hash([self.hashes[c[at]] for c in columns], lang) & np.uint64((len(bitmap) << 6) - 1)
        hit = (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
        inside[at] = hit.astype(bool)
        return inside


def stripes_of(words: Words, level: int, lang: str, bitmap: np.ndarray | None, hot: np.ndarray) -> pa.RecordBatch | None:
    """The stripes of a chunk: counts of phrases of ``level`` words by their first ``level - 1``."""
    if level == 1:
        counts = np.bincount(words.ids[words.ids >= 0], minlength=len(words.vocabulary))
        nexts = np.flatnonzero(counts)
        if not len(nexts):
            return None
        counts, group = counts[nexts], np.zeros(len(nexts), np.int64)
        salts = (words.hashes[nexts] % np.uint64(WORD_SALTS)).astype(np.int64)
        prefixes = pa.array([""])
    else:
        starts = words.known(level - 1, lang, bitmap)
        at = np.flatnonzero(starts[:-1] & starts[1:])
        if not len(at):
            return None
        columns = [words.ids[at + k] for k in range(level)]
        width = len(words.vocabulary)
        group = columns[0]
        for c in columns[1:-1]:
            group = np.unique(group * width + c, return_inverse=True)[1]
        codes, first, counts = np.unique(group * width + columns[-1], return_index=True, return_counts=True)
        group, nexts = codes // width, codes % width
        # One row of ``first`` per prefix, to spell and to hash it.
        distinct, one, group = np.unique(group, return_index=True, return_inverse=True)
        heads = [c[first[one]] for c in columns[:-1]]
        spelt = [words.vocabulary.take(pa.array(c)) for c in heads]
        prefixes = pc.binary_join_element_wise(*spelt, " ") if len(spelt) > 1 else spelt[0]
        is_hot = np.isin(phrase_hash([words.hashes[c] for c in heads], lang), hot)
        salts = np.where(is_hot[group], (words.hashes[nexts] % np.uint64(SALTS)).astype(np.int64), 0)
    order = np.lexsort((salts, group))
    group, salts, nexts, counts = group[order], salts[order], nexts[order], counts[order]
    edges = np.flatnonzero(np.concatenate(([True], (np.diff(group) != 0) | (np.diff(salts) != 0))))
    offsets = pa.array(np.append(edges, len(group)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.repeat(lang, len(edges)),
            prefixes.take(pa.array(group[edges])),
            pa.array(salts[edges], pa.int32()),
            pa.ListArray.from_arrays(offsets, words.vocabulary.take(pa.array(nexts))),
            pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
        ],
        schema=_STRIPE_ARROW,
    )


def _pieces(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` cut at piece ends into parts of ``size`` bytes, longer only where a piece is."""
    at = 0
    while len(data) - at > size:
        cut = data.rfind(BREAK, at, at + size)
        cut = cut if cut > at else data.find(BREAK, at + size)
        if cut < 0:
            break
        yield data[at:cut]
        at = cut
    yield data[at:]


def chunks_by_lang(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, Words]]:
    """Texts of a language, folded and joined with piece ends, about ``size`` bytes at a time."""
    held: dict[str, list[bytes]] = {}
    total: dict[str, int] = {}

    def give(lang: str) -> Words:
        data = (b" " + BREAK + b" ").join(held.pop(lang))
        del total[lang]
        return Words(data)

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for part in _pieces(text.encode().translate(_FOLD), size):
                held.setdefault(lang, []).append(part.replace(BREAK, b" " + BREAK + b" "))
                total[lang] = total.get(lang, 0) + len(part)
                if total[lang] >= size:
                    yield lang, give(lang)
        while sum(total.values()) >= 2 * size:  # many languages at once: the fullest goes
            lang = max(total, key=total.get)
            yield lang, give(lang)
    for lang in sorted(held):
        yield lang, give(lang)


def _merged(spark: SparkSession, docs: DataFrame, level: int, bitmap: np.ndarray | None, hot: np.ndarray) -> DataFrame:
    """lang, prefix, next, f of the phrases of ``level`` words that occur at all (and may be frequent)."""
    sent, context = (bitmap, hot), spark.sparkContext
    shared = context.broadcast(sent)  # 2^FILTER_BITS bits and at most 1 / HOT_SHARE hashes

    def run(batches):
        bits, split = shared.value
        for lang, words in chunks_by_lang(batches, CHUNK_BYTES):
            found = stripes_of(words, level, lang, bits, split)
            if found is not None:
                yield found
            if level == 1:  # the empty word stands for all words
                n = int((words.ids >= 0).sum())
                yield pa.RecordBatch.from_arrays(
                    [[lang], [""], pa.array([0], pa.int32()), [[""]], pa.array([[n]], pa.list_(pa.int64()))], schema=_STRIPE_ARROW
                )

    stripes = docs.mapInArrow(run, STRIPE).repartition("lang", "prefix", "salt")
    pair = F.explode(F.arrays_zip("next", "counts"))
    entries = stripes.select("lang", "prefix", "salt", pair.alias("e")).select("lang", "prefix", "salt", "e.next", "e.counts")
    # The stripes already lie together, so this adds up in place and spills where it must.
    return entries.groupBy("lang", "prefix", "salt", "next").agg(F.sum("counts").alias("f")).drop("salt")


def phrase_of(prefix: str = "prefix", following: str = "next") -> Column:
    return F.when(F.col(prefix) == "", F.col(following)).otherwise(F.concat_ws(" ", prefix, following))


def _bitmap(phrases: DataFrame, bits: int) -> np.ndarray:
    """A bit for each phrase. What reaches the driver is at most the bitmap."""

    def places(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for lang in table.column("lang").unique().to_pylist():
                mine = table.filter(pc.equal(table.column("lang"), lang)).column("phrase").combine_chunks()
                split = pc.split_pattern(mine, " ")
                length = pc.list_value_length(split).to_numpy()[0]  # all of one level
                words = word_hash(split.flatten()).reshape(-1, length)
                at = np.unique(phrase_hash([words[:, k] for k in range(length)], lang) & np.uint64((1 << bits) - 1))
                slot, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
                edges = np.flatnonzero(np.concatenate(([True], np.diff(slot) != 0)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot[edges]), pa.array(np.bitwise_or.reduceat(bit, edges).view(np.int64))], names=["slot", "bits"]
                )

    rows = phrases.mapInArrow(places, "slot bigint, bits bigint").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    bitmap[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return bitmap


def frequent(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, n) and the phrases of up to ``longest`` words that occur ``least`` times: lang, m, prefix, next, f."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text"))
    bitmap, hot, levels, totals, words = None, np.zeros(0, np.uint64), [], None, 0
    for level in range(1, longest + 1):
        merged = _merged(spark, texts, level, bitmap, hot)
        found = materialise(merged.filter((F.col("f") >= least) | (F.col("next") == "")), f"phrases-{level}")
        if level == 1:
            totals = found.filter("next = ''").select("lang", F.col("f").alias("n"))
            words = totals.agg(F.sum("n")).first()[0] or 0
            found = found.filter("next <> ''")
        levels.append(found.select("lang", F.lit(level).alias("m"), "prefix", "next", "f"))
        if level < longest:
            spelt = found.select("lang", phrase_of().alias("phrase"), "f")
            bitmap = _bitmap(spelt.select("lang", "phrase"), FILTER_BITS)
            if not bitmap.any():
                break
            largest = spelt.filter(F.col("f") > F.lit(max(1.0, words * HOT_SHARE))).select("lang", "phrase").collect()
            hot = np.array([_hash_of(r["lang"], r["phrase"]) for r in largest], np.uint64)
    union = levels[0]
    for more in levels[1:]:
        union = union.unionByName(more)
    return totals, union


def _hash_of(lang: str, phrase: str) -> int:
    hashes = word_hash(pa.array(phrase.split(" ")))
    return int(phrase_hash([hashes[k : k + 1] for k in range(len(hashes))], lang)[0])


def mine(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of each lang: lang, rank, phrase, a, l, r, n, score.

    ``covered`` (per cent): a phrase goes if one that holds it occurs at least
    that share as often. A longer phrase is never more frequent than one inside
    it, so the phrases one word longer decide.
    """
    totals, phrases = frequent(docs, longest, least)
    spelt = materialise(phrases.select("lang", "m", "prefix", "next", phrase_of().alias("phrase"), "f"), "phrases")
    size = spelt.select("lang", "phrase", "f")
    candidates = spelt.filter("m > 1").withColumn("words", F.split("phrase", " "))

    rest = F.concat_ws(" ", F.slice("words", F.lit(2), F.col("m") - 1))
    parts = candidates.filter("m > 2").select("lang", F.explode(F.array("prefix", rest)).alias("phrase"), "f")
    longer = parts.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.col("most").isNull()
        | (F.col("most").cast("decimal(20,0)") * 100 < F.col("f").cast("decimal(20,0)") * covered)
    )

    def cut(k: Column) -> Column:
        first, last = F.slice("words", F.lit(1), k), F.slice("words", k + 1, F.col("m") - k)
        return F.struct(k.alias("k"), F.concat_ws(" ", first).alias("first"), F.concat_ws(" ", last).alias("last"))

    cuts = kept.select(
        "lang", "phrase", F.col("f").alias("a"), F.explode(F.transform(F.sequence(F.lit(1), F.col("m") - 1), cut)).alias("c")
    ).select("lang", "phrase", "a", "c.k", "c.first", "c.last")
    left = size.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = size.select("lang", F.col("phrase").alias("last"), F.col("f").alias("r"))
    # Products in decimals: they may pass 64 bits.
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "last"])
    scored = scored.withColumns({"_above": wide("a") * SCALE, "_below": wide("l") + wide("r")})
    scored = scored.withColumn("score", F.expr("_above div _below"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (
        lowest.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .withColumn("rank", F.col("rank").cast("bigint"))
    )
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
