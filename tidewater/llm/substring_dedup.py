"""Removal of passages that recur anywhere in the corpus.

A window is ``length`` consecutive words. Windows that start at two places or
more, in one document or in several, are removed with every word they cover.

1. Documents are dealt to blocks of bounded size. A block sends each distinct
   window it holds as a 64-bit hash, once however often it occurs there, to a
   bucket chosen by an independent hash (so what tells windows apart grows with
   the number of buckets, as the number of windows does).
2. A bucket finds the windows that two blocks hold and tells those blocks.
3. A block finds the recurring passages in its documents by their hashes (words
   of different blocks are never compared; the automata only recheck), lays tiles of one
   window's length over each (recurring windows that together cover it),
   compiles them into Aho-Corasick automata over words, a bounded number of
   words in each, and streams all its documents through them; every occurrence
   covers its words.

The documents cross the network once: both uses of a block read one shuffle.
A window that everyone has is one entry per block, so no bucket grows hot.

Defined results: NULL text has no words; words are runs without ASCII white
space, compared byte by byte; repeated rows are places of their own, so all
their windows recur; texts shorter than a window stay whole; an empty table
gives no rows; other columns pass through.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import Memo, blocks_for, by_bucket, dealt_to_blocks, fresh_name, give_back, gram_hashes, mix, ship, sorted_distinct, word_hashes

BLOCK_BYTES = 4 << 20  # text in a block
BUCKET_BYTES = 16 << 20  # text whose windows a bucket compares
AUTOMATON_WORDS = 1 << 17  # words of all patterns of one automaton

_OTHER = np.uint64(0x5851F42D4C957F2D)


def windows(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every window of a text."""
    words = word_hashes(text)
    return gram_hashes(words, length), gram_hashes(mix(words ^ _OTHER), length)


def _texts(table: pa.Table) -> list[bytes]:
    return [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]


def block_windows(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct window hashes of a block, the second hash of each, how often each occurs."""
    found = [windows(t, length) for t in texts]
    both = np.empty((2, sum(len(f) for f, _ in found)), np.uint64)
    at = both.shape[1]
    while found:  # from the last on, each let go of once it is copied
        first, second = found.pop()
        at -= len(first)
        both[0, at : at + len(first)], both[1, at : at + len(first)] = first, second
    order = np.argsort(both[0], kind="stable")
    starts = both[0, order]
    starts = np.flatnonzero(np.append(True, starts[1:] != starts[:-1])[: len(starts)])
    counts = np.diff(np.append(starts, len(order)))
    order = order[starts]
    return both[0, order], both[1, order], counts


def held_windows(texts: list[bytes], length: int) -> np.ndarray:
    """The window hashes of all places of a block, ascending."""
    found = [gram_hashes(word_hashes(t), length) for t in texts]
    held, at = np.empty(sum(map(len, found)), np.uint64), 0
    found.reverse()
    while found:
        held[at : at + len(found[-1])] = found[-1]
        at += len(found.pop())
    held.sort()
    return held


class Alphabet:
    """Word numbers as fixed-length strings of few letters.

    A node of an automaton searches its children one by one, so with a letter
    per word the root would look at as many as there are patterns. Six bits a
    letter, and other letters for each of a word's places, leave at most 64, and
    no match can start inside a word.
    """

    BITS = 6

    def __init__(self, numbers: int):
        self.letters = max(1, -(-max(numbers - 1, 1).bit_length() // self.BITS))

    def spell(self, ids: np.ndarray) -> str:
        out = np.empty((len(ids), self.letters), np.uint8)
        for k in range(self.letters):
            low = (ids >> (self.BITS * (self.letters - 1 - k))) & ((1 << self.BITS) - 1)
            out[:, k] = low + (1 + (k << self.BITS))
        return out.tobytes().decode("latin-1")


def automata(tiles: set[str], alphabet: Alphabet) -> Iterator:
    """Aho-Corasick automata over spelt words, one after another, with a bounded number of pattern words each.

    Only one is in memory at a time, if the caller lets go of it.
    """
    import ahocorasick

    shard, held = ahocorasick.Automaton(ahocorasick.STORE_INTS), 0
    for tile in tiles:
        words = len(tile) // alphabet.letters
        if held and held + words > AUTOMATON_WORDS:
            shard.make_automaton()
            yield shard
            shard, held = ahocorasick.Automaton(ahocorasick.STORE_INTS), 0
        shard.add_word(tile, words)
        held += words
    if held:
        shard.make_automaton()
        yield shard


def tiles_of(recurs: np.ndarray, length: int) -> Iterator[int]:
    """Starts of recurring windows that together cover every recurring window."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], recurs, [False])).astype(np.int8)))
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        yield from range(start, end, length)
        yield end - 1


def covered_words(texts: list[bytes], recurring: np.ndarray, length: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words of each text, and which of them a recurring window covers. ``recurring`` is sorted."""
    numbers: dict[bytes, int] = {}
    docs, marked = [], []
    for text in texts:
        # only the numbers of the words are held, not the words of the whole block
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in text.split()], np.int32)
        docs.append(ids)
        starts: list[int] = []
        if len(ids) >= length and len(recurring):
            own = gram_hashes(word_hashes(text), length)
            at = np.minimum(np.searchsorted(recurring, own), len(recurring) - 1)
            starts = list(tiles_of(recurring[at] == own, length))
        marked.append(starts)
    alphabet = Alphabet(len(numbers))
    del numbers
    width = alphabet.letters
    spelt = [alphabet.spell(ids) for ids in docs]
    tiles = {text[i * width : (i + length) * width] for text, starts in zip(spelt, marked) for i in starts}
    steps = [np.zeros(len(ids) + 1, np.int32) for ids in docs]
    del docs
    for shard in automata(tiles, alphabet):
        for text, step in zip(spelt, steps):
            if len(step) > length:
                ends = sorted_distinct(np.array([end for end, _ in shard.iter(text)], np.int64)) // width
                np.add.at(step, ends - length + 1, 1)
                np.add.at(step, ends + 1, -1)
        del shard
    del spelt, tiles
    for text, step in zip(texts, steps):
        yield text.split(), np.cumsum(step[:-1]) > 0


def remove_repeats(docs: DataFrame, length: int = 35) -> DataFrame:
    """``docs`` with n_words, n_removed, removed (spans of words) and kept (the words that stay).

    ``kept`` joins words by one space. Columns of ``docs`` with these names are replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    added = ["n_words", "n_removed", "removed", "kept"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    block = fresh_name(docs, "_block")
    blocks, buckets = blocks_for(docs, BLOCK_BYTES), blocks_for(docs, BUCKET_BYTES)
    dealt = dealt_to_blocks(docs, block, blocks)

    # Workers wait between blocks, some of them for whole stages, so they give back memory after each as well.

    def send(table: pa.Table) -> pa.Table:
        Memo.forget()
        sent = dealt_windows(table)
        give_back()
        return sent

    def dealt_windows(table: pa.Table) -> pa.Table:
        values, second, counts = block_windows(_texts(table), length)
        number = table.column(block)[0].as_py()
        rows = []
        for repeated in (False, True):
            mine = (counts > 1) == repeated
            chosen = (second[mine] % np.uint64(buckets)).astype(np.int64)
            rows += [(k, number, repeated, v.tobytes()) for k, v in by_bucket(values[mine], chosen, buckets)]
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = (pa.int32(), pa.int32(), pa.bool_(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "holder", "repeated", "windows"])

    def tell(table: pa.Table) -> pa.Table:
        Memo.forget()
        told = shared_windows(table)
        give_back()
        return told

    def shared_windows(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(w.as_buffer(), np.uint64) for w in table.column("windows")]  # not copied
        held = np.concatenate(parts)
        held.sort()
        recurring, rows = sorted_distinct(held[1:][held[1:] == held[:-1]]), {}
        del held
        for part, holder, repeated in zip(parts, table.column("holder").to_pylist(), table.column("repeated").to_pylist()):
            # a window that recurs within the block is known there already
            if not repeated and len(recurring):
                at = np.minimum(np.searchsorted(recurring, part), len(recurring) - 1)
                if len(news := part[recurring[at] == part]):
                    rows.setdefault(holder, []).append(news)
        return pa.table({
            "holder": pa.array(list(rows), pa.int32()),
            "windows": pa.array([np.concatenate(v).tobytes() for v in rows.values()], pa.binary()),
        })

    def remove(table: pa.Table, news: pa.Table) -> pa.Table:
        Memo.forget()
        texts = _texts(table)
        held = held_windows(texts, length)
        twice = held[1:][held[1:] == held[:-1]]
        told = [np.frombuffer(w, np.uint64) for w in news.column("windows").to_pylist()]
        recurring = sorted_distinct(np.concatenate([twice, *told]))
        del held, twice, told
        out = []
        for words, covered in covered_words(texts, recurring, length):
            edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
            spans = [{"start": a, "stop": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
            stay = [w for w, gone in zip(words, covered.tolist()) if not gone]
            out.append((len(words), len(words) - len(stay), spans, b" ".join(stay)))
        del texts, recurring
        columns = list(zip(*out)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.string())
        table = table.drop_columns([block])
        for name, column, kind in zip(added, columns, kinds):
            table = table.append_column(name, pa.array(column, kind))
        del out, columns, column
        give_back()
        return table

    sent = dealt.groupBy(block).applyInArrow(send, "bucket int, holder int, repeated boolean, windows binary")
    news = sent.groupBy("bucket").applyInArrow(tell, "holder int, windows binary")
    span = T.ArrayType(T.StructType().add("start", "integer").add("stop", "integer"))
    schema = docs.select("*").schema.add("n_words", "long").add("n_removed", "long").add("removed", span).add("kept", "string")
    return dealt.groupBy(block).cogroup(news.groupBy("holder")).applyInArrow(remove, schema)


def keep_unique_text(docs: DataFrame, length: int = 35) -> DataFrame:
    """``docs`` whose texts have lost their recurring passages.

    A text that loses nothing stays as it is; the others become their kept
    words. ``n_chars``, where there is such a column, follows the text.
    """
    found = remove_repeats(docs.select([F.col(c).alias(f"in_{c}" if c not in ("doc_id", "text") else c) for c in docs.columns]), length)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    columns = {c: F.col(c if c in ("doc_id", "text") else f"in_{c}") for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast(kind)).otherwise(columns["n_chars"])
    return found.select(*[columns[c].alias(c) for c in docs.columns])
