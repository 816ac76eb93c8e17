"""Helpers the operators of this package share: text access, safe cuts, word hashes, packed exchange."""
from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import ship

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Rows per Arrow batch between Spark and its Python workers. Documents differ in
# length by orders of magnitude, so batches are kept short.
BATCH_ROWS = 256

# White space that every tokenizer here counts as white space, then the rest of a
# chunk. The four separators U+001C to U+001F are white space to Python only.
_SPACE, _OTHER = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
CHUNK = re.compile(f"{_SPACE}*{_OTHER}+|{_SPACE}+")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Ready the session for Arrow functions: the package on the executors, batches of ``rows`` rows."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def whole_text(column: str = "text") -> Column:
    """The text; NULL is the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def crc_fold(column: str, folds: int) -> Column:
    """Fold of an id: CRC-32 of its decimal text. NULL ids fold as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def fresh_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name where the frame already has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def chunks(text: str) -> list[str]:
    """Cut a text where no tokenizer here can join the two sides.

    Every cut stands before white space that follows something else. The
    pre-tokenizer patterns never match across such a place and look ahead only
    inside a run of white space, so encoding the chunks one by one gives the
    ids of the whole text.
    """
    return CHUNK.findall(text)


def chunk_starts(data: bytes, bounds: np.ndarray) -> np.ndarray:
    """Where chunks of texts start that stand one after the other in ``data``, from each of ``bounds`` to the next.

    Places of ``chunks``, but only at ASCII white space, and never after
    characters whose bytes are like those of some white space.
    """
    codes = np.frombuffer(data, np.uint8)
    white = (codes - np.uint8(9) < np.uint8(5)) | (codes == np.uint8(32))
    starts = np.append(False, white[1:] & (codes[:-1] > 32))
    high = np.flatnonzero(starts[1:] & (codes[:-1] > 127)) + 1  # after a character of several bytes, of which U+0085 to U+3000 may be white space
    two, three = codes[high - 2], codes[np.maximum(high - 3, 0)]
    unsure = (two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3) & np.isin(two, (0x80, 0x81, 0x9A)))
    starts[high[unsure]] = False
    starts[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(starts[: len(codes)])


def byte_batches(items: Sequence[str], size: int) -> Iterator[list[str]]:
    """Batches of about ``size`` characters in all, so that no batch is much heavier than another."""
    batch, held = [], 0
    for item in items:
        if batch and held + len(item) > size:
            yield batch
            batch, held = [], 0
        batch.append(item)
        held += len(item)
    if batch:
        yield batch


def batches_of(rows: Iterable[pa.RecordBatch], column: str, size: int) -> Iterator[pa.Table]:
    """Join Arrow batches until ``column`` holds about ``size`` bytes."""
    held, total = [], 0
    for batch in rows:
        held.append(batch)
        total += batch.column(column).nbytes
        if total >= size:
            yield pa.Table.from_batches(held)
            held, total = [], 0
    if held:
        yield pa.Table.from_batches(held)


def give_back() -> None:
    """Return to the system what a worker no longer uses; its C library and Arrow would keep it for later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it
        pass


def tidy(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` of a task's batches, after which the worker keeps little for as long as it waits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return run


class Memo:
    """Answers a worker remembers: at most ``2 * limit``, those not asked for lately go first.

    Forgetting costs time only; an answer is always what ``make`` gives.
    """

    made: list["Memo"] = []  # all memos of this worker
    holders: list[dict] = []  # what else operators keep and can make again, with the memos it uses

    def __init__(self, limit: int):
        self.limit, self.now, self.old = limit, {}, {}
        Memo.made.append(self)

    @classmethod
    def forget(cls, *kept: "Memo") -> None:
        """Empty all memos but ``kept``: an operator that needs the memory itself calls this as its task starts."""
        for memo in cls.made:
            if memo not in kept:
                memo.now, memo.old = {}, {}
        for holder in cls.holders:
            for key in [k for k, held in holder.items() if not any(memo in kept for memo in held)]:
                cls.made[:] = [memo for memo in cls.made if memo not in holder[key]]
                del holder[key]
        give_back()

    def learn(self, wanted: set, make: Callable[[list], Iterable]) -> dict:
        """A mapping that has every wanted key; ``make`` answers a list of keys in order."""
        missing = wanted.difference(self.now)
        if len(self.now) + len(missing) > self.limit:
            self.old, self.now, missing = self.now, {}, wanted
        known = {x: self.old[x] for x in missing if x in self.old}
        self.now.update(known)
        if len(known) < len(missing):
            new = [x for x in missing if x not in known]
            self.now.update(zip(new, make(new)))
        return self.now


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the splitmix64 finaliser)."""
    z = values + _MIX
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


# Of eight bytes read at once, those that belong to the last piece of a word.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words (runs without ASCII white space) of a text, in order.

    A word is read eight bytes at a time, and every piece is mixed in turn.
    """
    n = len(text)
    data = np.frombuffer(text + bytes(8), np.uint8)
    here = data[:n]
    space = (here - np.uint8(9) < np.uint8(5)) | (here == np.uint8(32))
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if n and not space[0]:
        edges = np.concatenate(([0], edges))
    if len(edges) % 2:
        edges = np.append(edges, n)
    starts = edges[::2]
    lengths = edges[1::2] - starts
    eight = np.ndarray((n + 1,), "<u8", data, strides=(1,))  # from every place on
    out = mix((eight[starts] & _LOW_BYTES[np.minimum(lengths, 8)]) + lengths.astype(np.uint64) * _MIX)
    longer, at = np.flatnonzero(lengths > 8), 8
    while len(longer):
        rest = lengths[longer] - at
        out[longer] = mix(out[longer] ^ mix(eight[starts[longer] + at] & _LOW_BYTES[np.minimum(rest, 8)]))
        longer, at = longer[rest > 8], at + 8
    return out


def sorted_distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order (by sorting, which is several times faster here than a hash table)."""
    ordered = np.sort(values)
    return ordered[np.append(True, ordered[1:] != ordered[:-1])] if len(ordered) else ordered


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words (none where there are fewer)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    prefix = np.zeros(len(words) + 1, np.uint64)
    # hash of i..i+n-1 as a polynomial: prefix sums times inverse powers of an odd base
    prefix[1:] = np.cumsum(words * _odd_powers(len(words), _ODD), dtype=np.uint64)
    runs = (prefix[n:] - prefix[:-n]) * _odd_powers(len(words), _INVERSE)[: len(words) - n + 1]
    return mix(runs)


_ODD = 0xD6E8FEB86659FD93
_INVERSE = pow(_ODD, -1, 1 << 64)
_power_tables: dict[int, np.ndarray] = {}


def _odd_powers(n: int, base: int) -> np.ndarray:
    table = _power_tables.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, 1 << 16), base, np.uint64)
        table[0] = 1
        table = np.cumprod(table, dtype=np.uint64)
        if len(table) <= 1 << 20:
            _power_tables[base] = table
    return table[:n]


def blocks_for(docs: DataFrame, size: int, column: str = "text") -> int:
    """How many blocks of about ``size`` text bytes the documents make."""
    total = docs.agg(F.sum(F.octet_length(whole_text(column)))).first()[0] or 0
    return max(1, -(-total // size))


def dealt_to_blocks(docs: DataFrame, block: str, blocks: int) -> DataFrame:
    """``docs`` with a block number from a hash of id and text, so copies of a text spread over blocks."""
    return docs.withColumn(block, F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))


def by_bucket(values: np.ndarray, bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """The values of each bucket (below ``buckets``) that has some. ``values`` may have several columns."""
    order = np.argsort(bucket, kind="stable")
    ordered = bucket[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    for k, a, b in zip(ordered[starts].tolist(), starts, np.append(starts[1:], len(ordered))):
        yield int(k), values[order[a:b]]
