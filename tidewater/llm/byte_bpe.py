"""Byte-level BPE by recursive SQL, and its inverse.

Each Spark task holds a DuckDB connection with the vocabulary and the merge
table: every pair of tokens whose joined bytes are a token, with that token's
rank. The distinct words of a batch (matches of the pattern) become rows of
(word, position, token). In every round of a recursive query neighbouring
tokens join the merge table, and every word contracts its leftmost pair of
least rank, until no pair is left. Ordered aggregations turn rows into the
tokens of a word, and parts of a sequence, whose ids are looked up in the list
of all tokens, back into bytes.

Texts are cut into chunks before white space, and only the distinct chunks of a
batch, and then the distinct words of the new ones, are looked at.

A word of n bytes takes up to n rounds, so long words are cut first where no
token of the vocabulary spans the cut, which changes nothing. What is still
longer than ``ROUNDS`` bytes is contracted by the same rule with a heap.

Defined results: NULL text counts as the empty text (no ids, no bytes);
repeated rows, NULL ids and other columns pass through; an empty table gives
no rows; texts are encoded whole.
"""
from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewater.llm.common import Memo, batches_of, byte_batches, chunk_starts, small_batches, whole_text

# Text bytes taken together; what a worker remembers; bytes of a word for the
# recursive query; words in one query; tokens decoded by one query;
# tokens in a row of it; bytes of a word that is not cut.
BATCH_BYTES = 4 << 20
REMEMBERED_CHUNKS, REMEMBERED_WORDS = 250_000, 450_000
ROUNDS = 256
WORDS = 24_000
DECODE_TOKENS = 1 << 20
PART = 1024
UNCUT = 64

ENCODE = """
WITH RECURSIVE steps(word, toks) AS (
  SELECT word, list(tok ORDER BY pos) FROM start GROUP BY word
  UNION ALL
  (
    WITH open AS MATERIALIZED (SELECT word, toks FROM steps WHERE len(toks) > 1),
    pairs AS (SELECT word, unnest(toks) AS a, unnest(toks[2:]) AS b, generate_subscripts(toks, 1) AS pos FROM open),
    best AS (SELECT word, min(rank::BIGINT * 65536 + pos) AS best FROM pairs JOIN merges USING (a, b) GROUP BY word)
    SELECT word, toks[:best % 65536 - 1] || [(best // 65536)::INTEGER] || toks[best % 65536 + 2:] FROM best JOIN open USING (word)
  )
)
SELECT word, arg_min(toks, len(toks)) AS ids FROM steps GROUP BY word ORDER BY word
"""

# One character per byte (Latin-1), as strings can be aggregated and blobs cannot.
DECODE = """
SELECT seq, string_agg(array_to_string(list_select(vocabulary, places), ''), '' ORDER BY part) AS latin
FROM tokens, vocabularies GROUP BY seq
"""

_codecs: dict[tuple[str, str], "Codec"] = {}


def codec(path: str, pattern: str) -> "Codec":
    """The worker's codec for a rank file; built once and kept."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def answers(memo: Memo, keys: pa.Array, make: Callable[[list[str]], list[bytes]]) -> pa.Array:
    """What the memo knows of each key; each distinct key is looked up once."""
    coded = keys.dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    known = memo.learn(set(distinct), make)
    return pa.array([known[x] for x in distinct], pa.large_binary()).take(coded.indices)


def joined(parts: pa.Array, first: np.ndarray) -> list[bytes]:
    """The parts from each place in ``first`` to the next, put together."""
    if not len(parts):
        return [b""] * (len(first) - 1)
    at = (np.frombuffer(parts.buffers()[1], np.int64)[parts.offset :][first]).tolist()
    data = parts.buffers()[2].to_pybytes() if at[-1] else b""
    return [data[a:b] for a, b in zip(at, at[1:])]


class Codec:
    """Vocabulary, merge table and connection of one worker."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
        self.split = regex.compile(pattern).findall
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.of_chunk, self.of_word = Memo(REMEMBERED_CHUNKS), Memo(REMEMBERED_WORDS)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        pairs = [
            (self.ranks[token[:i]], self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        a, b, rank = (pa.array(np.array(x, np.int32)) for x in zip(*pairs))
        self._load("merges", a=a, b=b, rank=rank)
        self._load("vocabularies", vocabulary=[[t.decode("latin-1") for t in self.ranks]])
        self.place = np.zeros(max(self.ranks.values()) + 1, np.int32)  # in that list, from 1
        self.place[list(self.ranks.values())] = np.arange(1, len(self.ranks) + 1)
        self.grams = {t for t in self.ranks if len(t) in (2, 3)}
        self.grams |= {t[i : i + 4] for t in self.ranks for i in range(len(t) - 3)}

    def _load(self, name: str, **columns) -> None:
        given = pa.table(columns)
        self.con.register("given", given)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def cut(self, word: bytes) -> list[bytes]:
        """Cut a long word at every place that no token of the vocabulary spans."""
        if len(word) <= UNCUT:
            return [word]
        pieces, start = [], 0
        for i in range(1, len(word)):
            windows = [word[i - 1 : i + 1]]
            windows += [word[j : j + 3] for j in (i - 2, i - 1) if j >= 0 and j + 3 <= len(word)]
            windows += [word[j : j + 4] for j in (i - 3, i - 2, i - 1) if j >= 0 and j + 4 <= len(word)]
            if not any(w in self.grams for w in windows):
                pieces.append(word[start:i])
                start = i
        return [*pieces, word[start:]]

    def contract(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of each word (of at most ``ROUNDS`` bytes), by the recursive query."""
        out = []
        for i in range(0, len(words), WORDS):
            part = words[i : i + WORDS]
            lengths = np.array([len(w) for w in part])
            starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
            self.con.register("start", pa.table({
                "word": pa.array(np.repeat(np.arange(len(part), dtype=np.int32), lengths)),
                "pos": pa.array((np.arange(len(starts)) - starts).astype(np.int32)),
                "tok": pa.array(self.single[np.frombuffer(b"".join(part), np.uint8)]),
            }))
            ids = self.con.sql(ENCODE).to_arrow_table().column("ids").combine_chunks()
            self.con.unregister("start")
            packed, at = ids.flatten().to_numpy().astype("<u4").tobytes(), (4 * (ids.offsets.to_numpy() - ids.offsets[0].as_py())).tolist()
            out += [packed[a:b] for a, b in zip(at, at[1:])]
        return out

    def contract_long(self, word: bytes) -> bytes:
        """The same rule for one long word: a heap of (rank, position) over a linked list."""
        tokens: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap = [(r, i, t) for i in range(len(word) - 1) if (r := self.ranks.get(t := word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if tokens[i] is None or j >= len(word) or tokens[i] + tokens[j] != joined:
                continue
            tokens[i], tokens[j], after[i] = joined, None, after[j]
            if after[i] < len(word):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < len(word):
                    pair = tokens[k] + tokens[after[k]]
                    if pair in self.ranks:
                        heapq.heappush(heap, (self.ranks[pair], k, pair))
        return np.array([self.ranks[t] for t in tokens if t is not None], "<u4").tobytes()

    def word_ids(self, words: list[str]) -> list[bytes]:
        """The packed ids of each match of the pattern. A match that is a token is that token."""
        raw = [w.encode() for w in words]
        whole = {w: rank.to_bytes(4, "little") for w in raw if (rank := self.ranks.get(w)) is not None}
        pieces = {w: self.cut(w) if len(w) > UNCUT else [w] for w in raw if w not in whole}
        rest = set().union(*pieces.values())
        short = [w for w in rest if len(w) <= ROUNDS]
        ids = dict(zip(short, self.contract(short)))
        ids.update((w, self.contract_long(w)) for w in rest if len(w) > ROUNDS)
        return [whole[w] if w in whole else b"".join(map(ids.__getitem__, pieces[w])) for w in raw]

    def matches(self, texts: list[str]) -> list[list[str]]:
        """The matches of the pattern in each text. The texts are split as one, if it leaves no character out."""
        found = self.split("".join(texts))
        ends, bounds = np.cumsum([0, *map(len, found)]), np.cumsum([0, *map(len, texts)])
        if ends[-1] != bounds[-1]:
            return [self.split(t) for t in texts]
        at = np.searchsorted(ends, bounds).tolist()
        return [found[a:b] for a, b in zip(at, at[1:])]

    def chunk_ids(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each chunk."""
        # From white space to something else: such chunks may follow each other, as they do in texts.
        follow = [c[0] in " \t\n\v\f\r" and not c[-1].isspace() for c in texts]
        split = iter(self.matches([c for c, x in zip(texts, follow) if x]))
        split = [next(split) if x else self.split(c) for c, x in zip(texts, follow)]
        words = pa.array([w for ws in split for w in ws], pa.large_string())
        return joined(answers(self.of_word, words, self.word_ids), np.cumsum([0, *map(len, split)]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as packed little-endian unsigned 32-bit integers."""
        raw = [text.encode() for text in texts]
        bounds, data = np.cumsum([0, *map(len, raw)]), b"".join(raw)
        starts = chunk_starts(data, bounds)
        places = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        parts = pa.Array.from_buffers(pa.large_string(), len(starts), [None, places, pa.py_buffer(data)])
        return joined(answers(self.of_chunk, parts, self.chunk_ids), np.searchsorted(starts, bounds))

    def decode(self, sequences: list[bytes]) -> list[bytes]:
        """The bytes of each packed sequence of ids."""
        return [text for batch in byte_batches(sequences, 4 * DECODE_TOKENS) for text in self._decode(batch)]

    def _decode(self, sequences: list[bytes]) -> list[bytes]:
        lengths = np.array([len(s) // 4 for s in sequences])
        parts = -(-lengths // PART)
        seq = np.repeat(np.arange(len(sequences), dtype=np.int32), parts)
        part = np.arange(len(seq)) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.cumsum(np.minimum(PART, lengths[seq] - PART * part))
        places = pa.array(self.place[np.frombuffer(b"".join(sequences), "<u4")])
        self.con.register("tokens", pa.table({
            "seq": pa.array(seq),
            "part": pa.array(part),
            "places": pa.LargeListArray.from_arrays(pa.array(np.append(0, ends), pa.int64()), places),
        }))
        found = self.con.sql(DECODE).to_arrow_table()
        self.con.unregister("tokens")
        out = [b""] * len(sequences)
        for seq, text in zip(found.column("seq").to_pylist(), found.column("latin").to_pylist()):
            out[seq] = text.encode("latin-1")
        return out


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids (packed little-endian unsigned 32-bit integers) of every row."""
    small_batches(docs.sparkSession)

    def ids_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for held in batches_of(rows, "text", BATCH_BYTES):
            ids = own.encode(held.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [held.column("doc_id").combine_chunks(), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(ids_of, f"doc_id {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of ``encoded`` with the bytes of their ``ids`` as ``decoded`` (NULL ids: no bytes)."""
    small_batches(encoded.sparkSession)

    def bytes_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for held in batches_of(rows, "ids", BATCH_BYTES):
            texts = own.decode([x or b"" for x in held.column("ids").to_pylist()])
            yield from held.append_column("decoded", pa.array(texts, pa.binary())).combine_chunks().to_batches()

    schema = encoded.select("*").schema.add("decoded", "binary")
    return encoded.mapInArrow(bytes_of, schema)
