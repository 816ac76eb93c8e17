"""Scoring of texts by context-tree weighting over bytes.

A text is read as its words (lower-cased A to Z) joined by one space and ended
by a newline. A byte is eight binary decisions; each decision has a context
tree over the ``DEPTH`` bytes before it. A node of a tree estimates the next
bit from the counts below it (Krichevsky-Trofimov) and mixes this, half and
half before any data, with what its children say; so all depths are weighted by
how well they would have coded the training texts. A context that training
never saw leaves the word to the longest one it did see. The score of a text
is the base-10 logarithm of its probability; over its bytes, the code length.

1. Every task counts the distinct (context, byte) grams and words of its
   documents and sends them, once each, to buckets by the last two bytes of the
   context, or by the word. A bucket adds up the counts and weights the trees
   from full depth up to depth two. What the two shallow levels need is summed
   by Spark: at most 256 * 256 rows, which become the top of the trees.
2. Documents are dealt to blocks of bounded size. A block asks the buckets for
   its grams and words; a bucket answers each block with the probabilities and
   counts, and blocks score their documents. The documents cross the network
   once: both uses of a block read one shuffle.

The base score is that of words by themselves with one added to every count.

Defined results: NULL text counts as the empty text (the end alone); an id that
is NULL folds as the empty text; repeated rows count and are scored each; with
no training row every bit has probability one half; an empty table gives no
rows; other columns are not looked at.
"""
from __future__ import annotations

from collections.abc import Iterator
from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import batches_of, blocks_for, by_bucket, crc_fold, dealt_to_blocks, mix, sorted_distinct, small_batches, whole_text, word_hashes
from tidewater.session import materialise

DEPTH = 5  # bytes of context
BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 8 << 20
END = 0xE2D  # key of the end token among the word hashes

_HALF = 2 * lgamma(0.5)


class Block:
    """The texts of a block as arrays: grams by position, words, and which document each belongs to."""

    def __init__(self, texts: list[str]):
        pad, parts, hashes = b"\n" * DEPTH, [], []
        for text in texts:
            low = text.encode("utf-8", "surrogatepass").lower()
            parts.append(pad + b" ".join(low.split()) + b"\n")
            hashes.append(np.append(word_hashes(low), np.uint64(END)))
        lengths = np.array([len(p) for p in parts], np.int64)
        data = np.frombuffer(b"".join(parts), np.uint8)
        inside = np.ones(len(data), bool)
        starts = np.cumsum(lengths) - lengths
        for k in range(DEPTH):
            inside[starts + k] = False
        keys = np.zeros(len(data), np.uint64)
        for back in range(DEPTH + 1):
            keys[back:] |= data[: len(data) - back].astype(np.uint64) << np.uint64(8 * back)
        self.grams = keys[inside]
        self.gram_docs = np.repeat(np.arange(len(texts), dtype=np.int32), lengths - DEPTH)
        self.words = np.concatenate(hashes)
        self.word_docs = np.repeat(np.arange(len(texts)), [len(h) for h in hashes])

    def counted(self, kind: str, trains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys of all documents, sorted, and how often the training documents have them."""
        keys, docs = (self.grams, self.gram_docs) if kind == "gram" else (self.words, self.word_docs)
        learned, n = np.unique(keys if trains.all() else keys[trains[docs]], return_counts=True)
        if trains.all():
            return learned, n
        values = sorted_distinct(keys)
        counts = np.zeros(len(values), np.int64)
        counts[np.searchsorted(values, learned)] = n
        return values, counts


def bucket_of(kind: str, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Grams with the same two last bytes of context share a bucket."""
    near = keys >> np.uint64(8) & np.uint64(0xFFFF) if kind == "gram" else keys
    return (mix(near) % np.uint64(buckets)).astype(np.int64)


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1.0) - _HALF


def _lgamma(x: np.ndarray) -> np.ndarray:
    """lgamma for positive numbers: Stirling's series, after a shift upwards for small ones."""
    x = np.asarray(x, float)
    small = x < 8
    y = np.where(small, x + 8, x)
    series = (y - 0.5) * np.log(y) - y + 0.5 * log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.where(small, np.log(np.where(small, x + k, 1.0)), 0.0)
    return series - shift


def decisions(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte its eight decisions: the bits before (with a leading one) and the bit."""
    bits = np.arange(8)
    before = (1 << bits) | (byte[:, None].astype(np.int64) >> (8 - bits))
    return before, byte[:, None].astype(np.int64) >> (7 - bits) & 1


def weighted_bits(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Probability of each gram's eight bits from depth two on (NaN where training lacks the two bytes).

    Also, for the levels above, the counts and weighted probability per last
    byte and decision.
    """
    context = grams >> np.uint64(8)
    before, bit = decisions((grams & np.uint64(255)).astype(np.uint8))
    weight = np.repeat(counts.astype(float), 8)
    bit = bit.ravel()
    probability = np.full(len(bit), np.nan)
    levels = []
    for depth in range(DEPTH, 1, -1):
        own = context & np.uint64((1 << 8 * depth) - 1)
        node = ((own[:, None] << np.uint64(8)) | before.astype(np.uint64)).ravel()
        names, at = np.unique(node, return_inverse=True)
        ones = np.bincount(at, weight * bit, len(names))
        zeros = np.bincount(at, weight, len(names)) - ones
        kt = _log_kt(zeros, ones)
        if levels:
            lower = levels[-1]
            # children of a node: the nodes one byte deeper
            parent = np.searchsorted(names, _parents(lower["names"], depth))
            below = np.bincount(parent, lower["weighted"], len(names))
            weighted = np.logaddexp(kt, below) - log(2)
        else:
            below, weighted = np.zeros(len(names)), kt
        at = at.astype(np.int32)
        levels.append({"names": names, "at": at, "zeros": zeros, "ones": ones, "kt": kt, "below": below, "weighted": weighted})
        del node
    for i, level in enumerate(levels):
        seen = level["zeros"] + level["ones"]
        one = (level["ones"] + 0.5) / (seen + 1)
        own = np.where(bit == 1, one[level["at"]], 1 - one[level["at"]])
        if i:
            odds = np.exp(np.clip(level["kt"] - level["below"], -50, 50))[level["at"]]
            mixed = (odds * own + probability) / (odds + 1)
            own = np.where(np.isnan(probability), own, mixed)
        probability = np.where(seen[level["at"]] > 0, own, np.nan)
    top = levels[-1]
    # depth-two nodes by (last byte, decision)
    last = (top["names"] >> np.uint64(8) & np.uint64(255)).astype(np.int64)
    key = last << 8 | (top["names"] & np.uint64(255)).astype(np.int64)
    names, at = np.unique(key, return_inverse=True)
    sums = {"node": names} | {c: np.bincount(at, top[c], len(names)) for c in ("zeros", "ones", "weighted")}
    return probability.reshape(-1, 8), sums


def _parents(names: np.ndarray, depth: int) -> np.ndarray:
    """The name one level up: the context without its oldest byte, the decision as it is."""
    return names & np.uint64((1 << 8 * (depth + 1)) - 1)


class Top:
    """The two shallow levels of the trees: dense arrays by (last byte, decision) and by decision."""

    def __init__(self, rows: list):
        node = np.array([r["node"] for r in rows], np.int64)
        # by last byte and decision: counts, and what the children say
        zeros, ones, below = (
            np.bincount(node, np.array([r[c] for r in rows], float), 1 << 16).reshape(256, 256) for c in ("zeros", "ones", "weighted")
        )
        self.levels = []
        for _ in range(2):
            kt, seen = _log_kt(zeros, ones), zeros + ones
            self.levels.append((seen, (ones + 0.5) / (seen + 1), np.exp(np.clip(kt - below, -50, 50))))
            weighted = np.logaddexp(kt, below) - log(2)
            # the root: no byte of context (a context without data says nothing: its weighted probability is 1)
            zeros, ones, below = (x.sum(axis=0, keepdims=True) for x in (zeros, ones, np.where(seen > 0, weighted, 0.0)))

    def log10(self, grams: np.ndarray, probability: np.ndarray) -> np.ndarray:
        """Base-10 logarithm of each gram's probability, from that of its bits below depth two."""
        before, bit = decisions((grams & np.uint64(255)).astype(np.uint8))
        last = (grams >> np.uint64(8) & np.uint64(255)).astype(np.int64)[:, None]
        for (seen, one, odds), row in zip(self.levels, (last, np.zeros_like(last))):
            p = one[row, before]
            own = np.where(bit == 1, p, 1 - p)
            o = odds[row, before]
            own = np.where(np.isnan(probability), own, (o * own + probability) / (o + 1))
            probability = np.where(seen[row, before] > 0, own, np.nan)
        return np.log10(np.where(np.isnan(probability), 0.5, probability)).sum(axis=1)


SENT = "bucket int, holder int, kind string, keys binary, counts binary"
NODES = "node int, zeros double, ones double, weighted double, tokens double, words double"


def squeeze(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as differences, byte by byte, which a shuffle compresses well."""
    steps = np.diff(values, prepend=np.uint64(0))
    return steps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def expand(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def sent_rows(own: Block, trains: np.ndarray, holder: int, buckets: int) -> pa.Table:
    """The distinct grams and words of some documents, packed per bucket, with their training counts."""
    rows = []
    for kind in ("gram", "word"):
        keys, counts = own.counted(kind, trains)
        packed = np.stack([keys, counts.astype(np.uint64)], axis=1)
        for k, part in by_bucket(packed, bucket_of(kind, keys, buckets), buckets):
            rows.append((k, holder, kind, squeeze(part[:, 0]), squeeze(np.cumsum(part[:, 1], dtype=np.uint64))))
    kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) or [[] for _ in kinds]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "holder", "kind", "keys", "counts"])


def _merge(table: pa.Table, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a kind in a bucket, sorted, with their counts in total."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0)]
    for k, packed, sums in zip(*(table.column(c).to_pylist() for c in ("kind", "keys", "counts"))):
        if k == kind:
            keys.append(expand(packed))
            counts.append(np.diff(expand(sums), prepend=np.uint64(0)).astype(float))
    values, at = np.unique(np.concatenate(keys), return_inverse=True)
    return values, np.bincount(at, np.concatenate(counts), len(values))


def _nodes(table: pa.Table) -> pa.Table:
    """What the top of the trees, and the base score, need from a bucket."""
    rows = []
    words, counts = _merge(table, "word")
    if len(words):
        rows.append({"tokens": counts.sum(), "words": float((counts > 0).sum())})
    grams, counts = _merge(table, "gram")
    if len(grams):
        _, sums = weighted_bits(grams, counts)
        names = ("node", "zeros", "ones", "weighted")
        rows += [dict(zip(names, row)) for row in zip(*(sums[c].tolist() for c in names))]
    schema = pa.schema([("node", pa.int32()), *((c, pa.float64()) for c in ("zeros", "ones", "weighted", "tokens", "words"))])
    return pa.Table.from_pylist(rows, schema)


def score_texts(docs: DataFrame, held_out: Column) -> DataFrame:
    """Learn from the rows where ``held_out`` is false and score all rows.

    Gives doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    and n_bytes (what the score covers: words, single spaces and the end).
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", whole_text().alias("text"), (~held_out).alias("trains"))
    blocks, buckets = blocks_for(rows, BLOCK_BYTES), blocks_for(rows, BUCKET_BYTES)
    flags = lambda column: column.to_numpy(zero_copy_only=False).astype(bool)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in batches_of(batches, "text", BLOCK_BYTES):
            sent = sent_rows(Block(held.column("text").to_pylist()), flags(held.column("trains").combine_chunks()), 0, buckets)
            yield from sent.to_batches()

    counted = rows.filter("trains").select("text", "trains").mapInArrow(count, SENT)
    nodes = materialise(counted.groupBy("bucket").applyInArrow(_nodes, NODES), "nodes")
    total = nodes.agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).first()
    tokens, distinct = int(total["tokens"] or 0), int(total["words"] or 0)
    # At most 256 * 256 rows.
    sums = nodes.filter("node IS NOT NULL").groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")])
    top = spark.sparkContext.broadcast(Top(sums.collect()))
    dealt = dealt_to_blocks(rows, "block", blocks)

    def ask(table: pa.Table) -> pa.Table:
        number = table.column("block")[0].as_py()
        return sent_rows(Block(table.column("text").to_pylist()), flags(table.column("trains")), number, buckets)

    def answer(table: pa.Table) -> pa.Table:
        words, counts = _merge(table, "word")
        known = {"word": (words, counts.astype("<u8"))}
        grams, counts = _merge(table, "gram")
        if len(grams):
            known["gram"] = grams, top.value.log10(grams, weighted_bits(grams, counts)[0]).astype("<f4")
        rows = []
        for bucket, holder, kind, packed in zip(*(table.column(c).to_pylist() for c in ("bucket", "holder", "kind", "keys"))):
            keys, values = known[kind]
            rows.append((holder, bucket, kind, values[np.searchsorted(keys, expand(packed))].tobytes()))
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["holder", "bucket", "kind", "answers"])

    def score(table: pa.Table, told: pa.Table) -> pa.Table:
        n, own = len(table), Block(table.column("text").to_pylist())
        kinds, numbers, answers = (told.column(c).to_pylist() for c in ("kind", "bucket", "answers"))

        def looked_up(kind: str, keys: np.ndarray, dtype: str) -> np.ndarray:
            """The answer for every position, in the order the questions were asked in."""
            values = sorted_distinct(keys)
            order = np.argsort(bucket_of(kind, values, buckets), kind="stable")
            parts = sorted((b, a) for k, b, a in zip(kinds, numbers, answers) if k == kind)
            out = np.zeros(len(values), dtype)
            out[order] = np.concatenate([np.frombuffer(a, dtype) for _, a in parts])
            return out[np.searchsorted(values, keys)]

        seen = looked_up("word", own.words, "<u8").astype(float)
        logs = np.log10((seen + 1) / (tokens + distinct + 1))
        per_doc = lambda docs, values=None: np.bincount(docs, values, n)
        columns = {
            "doc_id": table.column("doc_id"),
            "held_out": pa.array(~flags(table.column("trains"))),
            "n_tokens": pa.array(per_doc(own.word_docs).astype(np.int64)),
            "n_known": pa.array(per_doc(own.word_docs, (seen > 0).astype(float)).astype(np.int64)),
            "train_tokens": pa.array(np.full(n, tokens, np.int64)),
            "base_score": pa.array(per_doc(own.word_docs, logs)),
            "score": pa.array(per_doc(own.gram_docs, looked_up("gram", own.grams, "<f4"))),
            "n_bytes": pa.array(per_doc(own.gram_docs).astype(np.int64)),
        }
        return pa.table(columns)

    asked = dealt.groupBy("block").applyInArrow(ask, SENT)
    told = asked.groupBy("bucket").applyInArrow(answer, "holder int, bucket int, kind string, answers binary")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"
    return dealt.groupBy("block").cogroup(told.groupBy("holder")).applyInArrow(score, schema)


def held_out() -> Column:
    """Rows kept out of training: fold 2 of 7 of the id."""
    return crc_fold("doc_id", 7) == 2
