"""Similarity join of documents by the Jaccard similarity of their word n-grams, with PartEnum signatures.

A document's set is its distinct n-grams of lower-cased words (the whole
sequence where there are fewer words). Two sets link when their intersection
is at least ``percent`` hundredths of their union; components of links are
returned. The join is exact up to 64-bit hashes of n-grams and sets.

1. Sets that are equal count once, as a class.
2. Sizes fall into bands, such that linked sets lie in one band or two
   neighbouring ones. In a band linked sets differ in at most k n-grams, so of
   n1 > k partitions of the n-gram domain at least n1 - k hold the same n-grams
   of either. Each set sends a signature of every partition it has n-grams in,
   for its own band and the next. Partitions beyond k + 1 are a reserve: they
   pay for the empty ones, and let a set do without signatures that very many
   sets share as long as these are fewer than the reserve. A set whose reserve
   does not cover its empty partitions sends those too.
3. Signatures meet in buckets as packed arrays. Sets that share a signature
   with few others become candidate pairs. Signatures that more than ``FEW``
   sets share matter only for sets that have more of them than their reserve.
4. Candidates pass an exact lower bound of their difference (parity bitmaps of
   about two bits per n-gram, then, with the texts at hand, of eight), which
   leaves few pairs that do not link, and then the n-grams of the texts decide.
5. Two rounds: each signature's first set is compared with its others, which
   gives most components. Then only pairs of different components remain: the
   candidate pairs among them, and the sets that crowded signatures join (a
   crowd), compared across components in blocks of bounded size and like sizes.

Defined results: NULL and word-less texts have an empty set, link to nothing
and are their own component; NULL ids belong to a component but never name one
unless all its ids are NULL; repeated rows share a set; an empty table gives no
rows; other columns are not looked at.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import Memo, batches_of, blocks_for, by_bucket, fresh_name, give_back, gram_hashes, mix, small_batches, sorted_distinct, tidy, whole_text, word_hashes
from tidewater.operators.clusters import components
from tidewater.session import materialise

FEW = 16  # sets that share a signature and are paired directly
RESERVE = 0.15  # partitions beyond k + 1, as a share
BATCH_BYTES = 16 << 20  # text whose signatures travel together
BUCKET_BYTES = 32 << 20  # text whose signatures a bucket holds
TURNS = 4  # shares of a bucket that are compared one after the other
BLOCK = 512  # texts compared with one text by one task
CROWD_BLOCK, CROWD_BYTES = 1 << 15, 8 << 20  # sets and their bytes on either side of a block of bitmap comparisons
TILE = 4096  # sets whose bitmaps one set is compared with at once
COARSE, FINE = 2, 8  # bits of a parity bitmap per n-gram, for all sets and for those whose text is at hand
FILTER_WORDS = 1 << 17  # 64-bit words of the Bloom filter of wanted documents: one megabyte


def gram_set(text: bytes, n: int) -> np.ndarray:
    """Hashes of the distinct n-grams of a text."""
    words = word_hashes(text.lower())
    return sorted_distinct(gram_hashes(words, min(n, len(words)))) if len(words) else np.zeros(0, np.uint64)


def set_key(grams: np.ndarray) -> int:
    """64-bit name of a set."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(grams).sum(dtype=np.uint64) + np.uint64(len(grams))]))[0].astype(np.int64))


def parity(grams: np.ndarray, per_gram: int = COARSE) -> bytes:
    """Per bit whether an odd number of n-grams fall on it; a power of two of bits, about ``per_gram`` per n-gram."""
    size = 1 << max(6, (per_gram * len(grams) - 1).bit_length())
    odd = np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A parity bitmap as it would be with ``size`` 64-bit words."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def could_link(na: int, a: np.ndarray, nb: int, b: np.ndarray, percent: int) -> bool:
    """False only if the sets cannot link: each odd difference is a differing n-gram."""
    if 100 * min(na, nb) < percent * max(na, nb):
        return False
    size = min(len(a), len(b))
    apart = int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum())
    return apart * (100 + percent) <= (na + nb) * (100 - percent)


class Bands:
    """Size bands and their partitions."""

    def __init__(self, percent: int):
        self.percent, self.edges = percent, [1]

    def band(self, n: int) -> int:
        while self.edges[-1] <= n:
            self.edges.append(self.edges[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.edges, n, side="right")) - 1

    def layouts(self, n: int) -> list[tuple[int, tuple[int, int, int]]]:
        """(0 or 1 for the own or the next band, (band, most differing n-grams, partitions)) of a set of size ``n``."""
        own, out = self.band(n), []
        for band in (own, own + 1):
            low = self.edges[band]
            high = low * 100 // self.percent  # the largest size of the band
            if 100 * n < self.percent * low:
                continue
            k = 2 * high * (100 - self.percent) // (100 + self.percent)
            if k:  # without differences sets are equal, and equal sets are one class
                out.append((band - own, (band, k, k + 1 + int(np.ceil(RESERVE * (k + 1))))))
        return out


def signatures(grams: np.ndarray, mixed: np.ndarray, band: int, k: int, partitions: int) -> tuple[np.ndarray, int]:
    """Signatures of a set in a band, and how many of them it can do without.

    ``grams`` ascend, and partitions are ranges of hashes, so those of one
    partition stand together; ``mixed`` are the n-grams hashed once more.
    """
    which = (grams >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)
    starts = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
    held, sums = which[starts], np.add.reduceat(mixed, starts)
    spare = len(held) - k - 1
    if spare < 0:  # empty partitions count too
        full = np.zeros(partitions, np.uint64)
        full[held.astype(np.int64)] = sums
        held, sums, spare = np.arange(partitions, dtype=np.uint64), full, 0
    return mix(sums + mix(held + np.uint64(band << 32))), spare


def read_sets(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, key (NULL for the empty set), bits and a hash of the text of every row."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Memo.forget()
        for batch in batches:
            found = [gram_set(t.encode("utf-8", "surrogatepass"), n) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(g) for g in found], pa.int64()),
                    pa.array([set_key(g) if len(g) else None for g in found], pa.int64()),
                    pa.array([parity(g) if len(g) else None for g in found], pa.binary()),
                    batch.column("hash"),
                ],
                names=["doc_id", "n_shingles", "key", "bits", "hash"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text"), F.xxhash64(whole_text()).alias("hash")).mapInArrow(
        tidy(sets), f"doc_id {kind}, n_shingles long, key long, bits binary, hash long"
    )


def send_signatures(docs: DataFrame, n: int, percent: int, buckets: int) -> DataFrame:
    """Signatures packed per bucket: 32 bits each (the bucket comes from those above), in the order of the row's table.

    The table holds only sets that have signatures in the bucket, so a row grows
    with its signatures and not with the number of buckets.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Memo.forget()
        bands = Bands(percent)
        for held in batches_of(batches, "text", BATCH_BYTES):
            seen: set[int] = set()
            signs, which, table = [], [], []

            def packed_rows() -> Iterator[pa.RecordBatch]:
                sign, place = np.concatenate(signs), np.concatenate(which)
                columns = [np.array(c, k) for c, k in zip(zip(*table), TABLE.values())]
                packed = np.zeros(len(sign), [("low", SIGN), ("place", np.int32)])
                packed["low"], packed["place"] = sign & np.uint64(0xFFFFFFFF), place
                for bucket, part in by_bucket(packed, (sign >> np.uint64(40)).astype(np.int64) % buckets, buckets):
                    counts = np.bincount(part["place"], minlength=2 * len(table)).astype(np.int32).reshape(-1, 2)
                    used = counts.any(axis=1)
                    row = [bucket, part["low"].tobytes(), counts[used].tobytes(), *(c[used].tobytes() for c in columns)]
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], schema=SENT)

            for text in held.column("text").to_pylist():
                grams = gram_set(text.encode("utf-8", "surrogatepass"), n)
                if not len(grams) or (key := set_key(grams)) in seen:
                    continue
                seen.add(key)
                spares = [0, 0]  # for its own band and the next
                mixed = mix(grams)
                for side, (band, k, partitions) in bands.layouts(len(grams)):
                    found, spares[side] = signatures(grams, mixed, band, k, partitions)
                    signs.append(found)
                    which.append(np.full(len(found), 2 * len(table) + side, np.int32))
                table.append((key, len(grams), *(min(x, 32767) for x in spares)))
                if len(table) == 1 << 15:
                    yield from packed_rows() if signs else ()
                    signs, which, table = [], [], []
            if signs:
                yield from packed_rows()

    return docs.select(whole_text().alias("text")).mapInArrow(
        tidy(send), "bucket long, signs binary, counts binary, keys binary, sizes binary, own binary, next binary"
    )


#: A signature in a bucket: 32 of its bits. Others that agree in them cost a comparison, never a link.
SIGN = np.dtype("<u4")
#: The sets of a row: key, size, and the reserves in its own and the next band; ``counts`` has its signatures of either band.
TABLE = {"keys": np.int64, "sizes": np.int32, "own": np.int16, "next": np.int16}
SENT = pa.schema([("bucket", pa.int64()), *((c, pa.binary()) for c in ("signs", "counts", *TABLE))])


def meet_signatures(sent: DataFrame, percent: int) -> DataFrame:
    """What signatures join.

    Rows that are not crowded: keys a < b of a candidate pair, and whether a is
    the first set of a signature they share. Crowded rows: signature a, set b,
    its side (own or next band) and its reserve there.
    """

    def meet(table: pa.Table) -> pa.Table:
        met = meet_shares(table)
        give_back()
        return met

    def meet_shares(table: pa.Table) -> pa.Table:
        read = lambda c, k: [np.frombuffer(x.as_buffer(), k) for x in table.column(c)]
        parts, counts = read("signs", SIGN), read("counts", np.int32)
        tables = {c: np.concatenate(read(c, k)) for c, k in TABLE.items()}
        return pa.concat_tables([meet_share(table.column("bucket")[0].as_py(), parts, counts, tables, turn) for turn in range(TURNS)])

    def meet_share(bucket: int, parts: list, counts: list, tables: dict, turn: int) -> pa.Table:
        """What the signatures join that leave ``turn`` when divided by ``TURNS``."""
        signs, places, before = [], [], 0
        for part, n in zip(parts, counts):
            mine = part % SIGN.type(TURNS) == turn
            signs.append(part[mine])
            places.append(np.repeat(np.arange(before, before + len(n), dtype=np.int64), n)[mine])
            before += len(n)
        signs, places = np.concatenate(signs), np.concatenate(places)
        # Most signatures are of one set. Only the others are looked at further.
        order = np.argsort(signs)
        ordered = signs[order]
        same = ordered[1:] == ordered[:-1]
        order = order[np.append(same, False)[: len(order)] | np.append(False, same)[: len(order)]]
        signs, places = signs[order], places[order]
        side, at = (places & 1).astype(np.int8), places >> 1
        of = lambda c: tables[c][at]
        keys, sizes, spares, sides = of("keys"), of("sizes"), np.where(side == 1, of("next"), of("own")), side
        order = np.lexsort((keys, signs))
        signs, keys = signs[order], keys[order]
        first = np.append(True, (signs[1:] != signs[:-1]) | (keys[1:] != keys[:-1]))[: len(signs)]
        order, signs, keys = order[first], signs[first], keys[first]
        sizes, spares, sides = sizes[order], spares[order], sides[order]
        starts = np.flatnonzero(np.append(True, signs[1:] != signs[:-1])[: len(signs)])
        counts = np.diff(np.append(starts, len(signs)))
        pairs, heads = [np.zeros((0, 2), np.int64)], [np.zeros(0, bool)]
        for count in range(2, FEW + 1):
            rows = starts[counts == count]
            if len(rows):
                left, right = np.triu_indices(count, 1)
                a, b = (rows[:, None] + left).ravel(), (rows[:, None] + right).ravel()
                fits = 100 * np.minimum(sizes[a], sizes[b]).astype(np.int64) >= percent * np.maximum(sizes[a], sizes[b]).astype(np.int64)
                pairs.append(np.stack([keys[a][fits], keys[b][fits]], axis=1))  # keys ascend within a signature
                heads.append(np.tile(left == 0, len(rows))[fits])
        pairs, at = np.unique(np.concatenate(pairs), axis=0, return_inverse=True)
        head = np.bincount(at.ravel(), np.concatenate(heads), len(pairs)) > 0
        crowd = np.repeat(counts > FEW, counts)
        n, m = len(pairs), int(crowd.sum())
        return pa.table({
            "crowded": pa.array(np.append(np.zeros(n, bool), np.ones(m, bool))),
            "a": pa.array(np.append(pairs[:, 0], signs[crowd].astype(np.int64))),
            "b": pa.array(np.append(pairs[:, 1], keys[crowd])),
            "head": pa.array(np.append(head, np.zeros(m, bool))),
            "side": pa.array(np.append(np.zeros(n, np.int32), sides[crowd])),
            "spare": pa.array(np.append(np.zeros(n, np.int32), spares[crowd])),
            "bucket": pa.array(np.full(n + m, bucket, np.int64)),
        }).cast(MET)

    schema = "crowded boolean, a long, b long, head boolean, side int, spare int, bucket long"
    return sent.groupBy("bucket").applyInArrow(meet, schema)


MET = pa.schema([
    ("crowded", pa.bool_()), ("a", pa.int64()), ("b", pa.int64()), ("head", pa.bool_()),
    ("side", pa.int32()), ("spare", pa.int32()), ("bucket", pa.int64()),
])


class Join:
    """The tables a join works with: the documents, and one row per class of equal sets."""

    def __init__(self, docs: DataFrame, rows: DataFrame, n: int, percent: int):
        self.docs, self.n, self.percent = docs, n, percent
        self.classes = materialise(
            rows.filter("key IS NOT NULL").groupBy("key").agg(
                F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "hash")).alias("one"),
                F.min("n_shingles").alias("size"),
                F.min("bits").alias("bits"),
            ).select("key", "one.doc_id", "one.hash", "size", "bits"),
            "classes",
        )

    def plausible(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs (a, b) that the parity bitmaps of ``sets`` (key, size, bits) do not rule out."""
        percent = self.percent
        side = lambda x: sets.select(F.col("key").alias(x), F.col("size").alias(f"n{x}"), F.col("bits").alias(f"bits{x}"))

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                c = {x: batch.column(x).to_pylist() for x in ("na", "nb", "bitsa", "bitsb")}
                stay = [
                    could_link(na, np.frombuffer(a, np.uint64), nb, np.frombuffer(b, np.uint64), percent)
                    for na, nb, a, b in zip(c["na"], c["nb"], c["bitsa"], c["bitsb"])
                ]
                yield batch.select(["a", "b"]).filter(pa.array(stay, pa.bool_()))

        joined = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
        return joined.select("a", "b", "na", "nb", "bitsa", "bitsb").mapInArrow(tidy(check), "a long, b long")

    def texts_of(self, wanted: DataFrame) -> DataFrame:
        """(key, size, bits, text) of one document of each class in ``wanted`` (key), with fine bitmaps.

        Documents are found by id and text together, as ids may be missing or
        repeated, and known by the key of their set. A Bloom filter of fixed size
        (one hash, ``FILTER_WORDS`` 64-bit words) spares most others the shuffle
        while few are wanted; it never drops a wanted one.
        """
        n = self.n
        look = lambda text: F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), text).alias("id")
        named = wanted.join(self.classes.select("key", "doc_id", "hash"), "key").select(look(F.col("hash")), "key")
        named = materialise(named, "wanted")
        word = F.pmod("id", F.lit(FILTER_WORDS)).alias("word")
        mask = F.expr("shiftleft(1L, cast(shiftright(id, 40) & 63 AS INT))")
        words = named.groupBy(word).agg(F.bit_or(mask).alias("bits"))
        texts = self.docs.select(look(F.xxhash64(whole_text())), whole_text().alias("text"))
        near = texts.join(F.broadcast(words), F.pmod("id", F.lit(FILTER_WORDS)) == F.col("word"))
        found = near.filter(F.col("bits").bitwiseAND(mask) != 0).select("id", "text").join(named, "id")

        def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, held = batch.column("key").to_pylist(), batch.column("text").to_pylist()
                found = [gram_set(t.encode("utf-8", "surrogatepass"), n) for t in held]
                stay = [len(g) > 0 and set_key(g) == k for k, g in zip(keys, found)]
                fine = pa.array([parity(g, FINE) if s else None for g, s in zip(found, stay)], pa.binary())
                columns = [batch.column("key"), pa.array([len(g) for g in found], pa.int64()), fine, batch.column("text")]
                rows = pa.RecordBatch.from_arrays(columns, names=["key", "size", "bits", "text"])
                yield rows.filter(pa.array(stay, pa.bool_()))

        schema = "key long, size long, bits binary, text string"
        return materialise(found.select("key", "text").mapInArrow(tidy(own), schema), "texts")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs that link, decided by the n-grams of their texts."""
        n, percent = self.n, self.percent
        pairs = materialise(self.plausible(pairs, self.classes), "plausible")
        texts = self.texts_of(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
        # A text may stand there twice.
        pairs = materialise(self.plausible(pairs, texts.select("key", "size", "bits")).distinct(), "near")
        texts = texts.select("key", "text")
        parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
        right = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b")
        right = right.join(texts.withColumnRenamed("key", "b").hint("merge"), "b")
        left = parts.select(F.col("a").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("slice"))
        left = left.join(texts.select(F.col("key").alias("pivot"), F.col("text").alias("own")).hint("merge"), "pivot")
        grams = lambda t: gram_set(t.encode("utf-8", "surrogatepass"), n)

        def compare(one: pa.Table, many: pa.Table) -> pa.Table:
            out = set()  # a text that stands twice gives its key once
            if len(one):
                a = grams(one.column("own")[0].as_py())
                for key, text in zip(many.column("b").to_pylist(), many.column("text").to_pylist()):
                    b = grams(text)
                    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                    both = int((a[at] == b).sum())
                    if 100 * both >= percent * (len(a) + len(b) - both):
                        out.add(key)
            pivot = one.column("pivot")[0].as_py() if out else None
            return pa.table({"a": pa.array([pivot] * len(out), pa.int64()), "b": pa.array(sorted(out), pa.int64())})

        met = left.groupBy("pivot", "slice").cogroup(right.select("a", "part", "b", "text").groupBy("a", "part"))
        return met.applyInArrow(compare, "a long, b long")

    def roots(self, links: DataFrame) -> DataFrame:
        """(id, root) of the classes that have a link."""
        ends = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        return materialise(components(ends, links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "roots")

    def apart(self, pairs: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs whose ends are in different components."""
        root = lambda x: roots.select(F.col("id").alias(x), F.col("root").alias(f"root_{x}"))
        named = pairs.join(root("a").hint("merge"), "a", "left").join(root("b").hint("merge"), "b", "left")
        return named.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")

    def across(self, crowds: DataFrame, roots: DataFrame) -> DataFrame:
        """Plausible pairs within a crowd (key, crowd) that no link joins yet.

        A crowd is cut into blocks of sets of like size; only blocks whose sizes
        allow a link meet, and each pair of sets meets once.
        """
        percent = self.percent
        step = 100 / percent * 1.001  # sets that link lie in one bin or two neighbouring ones
        named = crowds.join(roots.select(F.col("id").alias("key"), "root").hint("merge"), "key", "left")
        named = named.withColumn("root", F.coalesce("root", "key"))
        several = named.groupBy("crowd").agg((F.min("root") != F.max("root")).alias("open")).filter("open").select("crowd")
        sized = named.join(several, "crowd").join(self.classes.select("key", "size", "bits").hint("merge"), "key")
        bin_of = F.floor(F.log("size") / float(np.log(step))).cast("int")
        rows = materialise(sized.withColumn("bin", bin_of), "crowded")
        blocks = F.greatest(F.count(F.lit(1)) / CROWD_BLOCK, F.sum(F.octet_length("bits") + 64) / CROWD_BYTES)
        parts = rows.groupBy("crowd", "bin").agg(F.ceil(blocks).cast("int").alias("parts"))
        parts = materialise(parts, "blocks")
        rows = rows.join(parts, ["crowd", "bin"])
        rows = rows.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).drop("parts")
        # Which blocks meet: every block of the own bin and the next.
        reached = F.explode(F.sequence(F.col("bin"), F.col("bin") + 1)).alias("j")
        each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        grid = parts.select("crowd", F.col("bin").alias("i"), F.col("parts").alias("ni"), reached).join(
            parts.select("crowd", F.col("bin").alias("j"), F.col("parts").alias("nj")).hint("merge"), ["crowd", "j"]
        )
        grid = grid.withColumn("p", each("ni")).withColumn("q", each("nj")).filter("i < j OR p <= q").select("crowd", "i", "p", "j", "q")
        block = ["crowd", "i", "p", "j", "q"]
        side = lambda bin_name, part: rows.select("crowd", F.col("bin").alias(bin_name), F.col("part").alias(part), "key", "root", "size", "bits")
        left = grid.join(side("i", "p").hint("merge"), ["crowd", "i", "p"]).select(*block, "key", "root", "size", "bits")
        right = grid.join(side("j", "q").hint("merge"), ["crowd", "j", "q"]).select(
            *[F.col(c).alias(f"other_{c}") for c in (*block, "key", "root", "size", "bits")]
        )

        def compare(one: pa.Table, other: pa.Table) -> pa.Table:
            found = []
            if len(one) and len(other):
                same = [one.column(c)[0].as_py() for c in "ip"] == [one.column(c)[0].as_py() for c in "jq"]
                other = other.rename_columns([c.removeprefix("other_") for c in other.column_names])
                (ka, ra, na), (kb, rb, nb) = ([t.column(c).to_numpy() for c in ("key", "root", "size")] for t in (one, other))
                raw = [[np.frombuffer(x, np.uint64) for x in t.column("bits").to_pylist()] for t in (one, other)]
                width = min(len(x) for r in raw for x in r)
                a, b = (np.stack([folded(x, width) for x in r]) for r in raw)
                order = np.argsort(nb, kind="stable")
                kb, rb, nb, b = kb[order], rb[order], nb[order], b[order]
                # Sizes that allow a link are one stretch: nb from percent hundredths of na to na by percent hundredths.
                low = np.searchsorted(nb, -(-percent * na // 100), "left")
                high = np.searchsorted(nb, 100 * na // percent, "right")
                # Most pairs differ enough in the first words already.
                b, some = np.ascontiguousarray(b.T), -(-5 * width // 8)
                count = np.uint16 if width < 1000 else np.int64
                most = (100 - percent) / (100 + percent)
                allowed = nb * most + 0.001
                for x, start in ((x, start) for start in range(0, len(kb), TILE) for x in range(len(ka))):
                    y = slice(max(low[x], start), min(high[x], start + TILE))
                    if y.start >= y.stop:
                        continue
                    apart = np.bitwise_count(b[:some, y] ^ a[x, :some, None]).sum(axis=0, dtype=count)
                    at = y.start + np.flatnonzero(apart <= allowed[y] + na[x] * most)
                    at = at[(rb[at] != ra[x]) & ((kb[at] > ka[x]) | (not same))]
                    found += [
                        (int(min(ka[x], kb[y])), int(max(ka[x], kb[y])))
                        for y in at.tolist()
                        if could_link(int(na[x]), raw[0][x], int(nb[y]), raw[1][order[y]], percent)
                    ]
            first, second = zip(*found) if found else ((), ())
            return pa.table({"a": pa.array(first, pa.int64()), "b": pa.array(second, pa.int64())})

        met = left.groupBy(*block).cogroup(right.groupBy(*[f"other_{c}" for c in block]))
        return met.applyInArrow(compare, "a long, b long")


def similar_sets(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows as ``read_sets`` gives them, and key, doc_id, root of the classes of equal sets."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    rows = materialise(read_sets(docs, n), "set-keys")
    join = Join(docs, rows, n, percent)
    buckets = blocks_for(docs, BUCKET_BYTES)  # of the upper 24 bits of a signature: 128 TiB of text
    met = materialise(meet_signatures(send_signatures(docs, n, percent, buckets), percent), "met")
    pairs = met.filter("NOT crowded").groupBy("a", "b").agg(F.bool_or("head").alias("head"))
    crowded = met.filter("crowded").withColumn("sign", F.xxhash64("bucket", "a")).withColumnRenamed("b", "key")
    # Only sets with more crowded signatures than they can do without need them.
    needing = crowded.groupBy("key", "side").agg(F.count(F.lit(1)).alias("n"), F.min("spare").alias("spare")).filter("n > spare")
    members = materialise(crowded.join(needing.select("key", "side").hint("merge"), ["key", "side"]).select("sign", "key"), "members")
    pivots = members.groupBy("sign").agg(F.min("key").alias("a"))
    to_pivot = members.join(pivots.hint("merge"), "sign").filter("key <> a").select("a", F.col("key").alias("b")).distinct()
    to_pivot = materialise(to_pivot, "to-pivot")
    links = materialise(join.linked(pairs.filter("head").select("a", "b").unionByName(to_pivot).distinct()), "links")
    roots = join.roots(links)
    # Sets that crowded signatures join, directly or through others, are one crowd.
    crowds = join.roots(to_pivot).select(F.col("id").alias("key"), F.col("root").alias("crowd"))
    rest = join.apart(pairs.filter("NOT head").select("a", "b"), roots).unionByName(join.across(crowds, roots))
    links = materialise(links.unionByName(join.linked(rest.distinct())), "links")
    named = (
        join.classes.select("key", "doc_id")
        .join(join.roots(links).withColumnRenamed("id", "key"), "key", "left")
        .select("key", "doc_id", F.coalesce("root", "key").alias("root"))
    )
    return rows, named


def similar_documents(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    rows, named = similar_sets(docs, n, percent)
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    groups = materialise(named.join(least, "root").select("key", "component_id"), "groups")
    full = rows.filter("key IS NOT NULL").join(groups.hint("merge"), "key")
    lone = rows.filter("key IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "n_shingles", "component_id").unionByName(lone)


def keep_one(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """The documents that stay, with all their columns: of each component the row with the smallest id.

    Of rows with that id the one whose text has the least hash stays. A row
    without an id stays if its component has none with one. Rows with an empty set stay.
    """
    rows, named = similar_sets(docs, n, percent)
    key, text, rank = (fresh_name(docs, c) for c in ("_id", "_hash", "_rank"))
    as_key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    roots = materialise(named.select("key", "root"), "roots-of-keys")
    full = rows.filter("key IS NOT NULL").join(roots.hint("merge"), "key")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "hash")).alias("first")
    stays = full.groupBy("root").agg(first).select("first.*")
    names = [as_key("doc_id").alias(key), F.col("hash").alias(text)]
    chosen = materialise(stays.select(*names), "stays")
    lone = materialise(rows.filter("key IS NULL").select(*names).distinct(), "lone")
    marked = docs.withColumns({key: as_key("doc_id"), text: F.xxhash64(whole_text())})
    one = Window.partitionBy(key, text).orderBy(F.lit(0))  # equal id and text: any
    once = marked.join(chosen, [key, text], "left_semi").withColumn(rank, F.row_number().over(one)).filter(F.col(rank) == 1)
    return once.select(*docs.columns).unionByName(marked.join(lone, [key, text], "left_semi").select(*docs.columns))
