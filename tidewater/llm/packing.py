"""Packing token sequences into as few bins as possible by bin completion.

Texts are tokenised and cut into pieces of at most the capacity. Only lengths
matter for packing, and there are at most ``capacity`` of them, so the search
works on a table of counts per length: it is as large for a billion pieces as
for a thousand. The search is bin completion by branch and bound: take the
largest length left, enumerate the undominated fillings of the room beside it,
least waste first, and use the chosen filling as often as the counts allow. A
first search is narrow: it takes each length in a filling as often as it goes and
goes on from the first filling without waste. If its plan does not meet the bound
on the sum, a second one looks at all undominated fillings, with fewer of a length
too, and falls back to using a filling fewer times. A branch ends when the
waste so far exceeds what a better solution could have. Best-fit decreasing
gives the first incumbent. The search is bounded by the numbers below, so only a
plan that meets the bound on the sum, or a search that ends before its steps do
with every filling kept, is proven least. The plan then meets the pieces:
each gets its number among those of its length, which the plan maps to a bin
and a place in it.

Defined results: NULL text counts as the empty text, which is the end token
alone; repeated rows and ids are packed as rows of their own; an empty table
gives no rows; other columns of the input are not looked at. In ``pack``, a
length that is NULL or below 1 gets no bin, one above the capacity is an error.
"""
from __future__ import annotations

import os
import string
import struct
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import Memo, batches_of, byte_batches, fresh_name, small_batches, tidy, whole_text
from tidewater.session import materialise

# Steps to enumerate and fillings kept per bin, and steps of each search before the incumbent stands.
FILLING_STEPS, FILLINGS, SEARCH_STEPS = 4000, 6, 20_000
ENCODE_CHARS, JOINED_CHARS = 1 << 18, 1 << 12
# Runs and words a worker remembers; after other steps, which leave executors less memory, the fewer ones.
REMEMBERED, FEWER_REMEMBERED = (300_000, 900_000), (60_000, 120_000)

# Text whose distinct runs are looked up at once, in bytes a run that is remembered.
LOOKUP_BYTES = 7

_encoders: dict[tuple, tuple] = {}
Memo.holders.append(_encoders)  # a tokenizer is larger than most of what other steps need


# ---------------------------------------------------------------- tokens


def _encoder(path: str, remembered: tuple[int, int] = REMEMBERED) -> tuple:
    """What encodes runs, and its memos of runs and of words."""
    key = path, remembered
    if key not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()

        ends = np.zeros(model.get_vocab_size(), bool)
        ends[[i for token, i in model.get_vocab().items() if token.endswith("</w>")]] = True

        def joined_ids(words: list[str]) -> list[bytes] | None:
            """The ids of words of letters alone, encoded as one text and cut at tokens that end a word."""
            ids = np.array(model.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
            cuts = [0, *((np.flatnonzero(ends[ids]) + 1) * 4).tolist()]
            packed = ids.tobytes()
            return [packed[a:b] for a, b in zip(cuts, cuts[1:])] if len(cuts) == len(words) + 1 else None

        def word_ids(words: list[str]) -> Iterator[bytes]:
            found: dict[str, bytes] = {}
            for batch in byte_batches([w for w in words if w.isalpha()], JOINED_CHARS):
                found.update(zip(batch, joined_ids(batch) or ()))
            rest = [w for w in words if w not in found]
            for batch in byte_batches(rest, ENCODE_CHARS):
                encoded = model.encode_batch_fast(batch, add_special_tokens=False)
                found.update((w, pack_ids(e.ids)) for w, e in zip(batch, encoded))
            return map(found.__getitem__, words)

        whole, words = map(Memo, remembered)

        def run_ids(runs: list[str]) -> Iterator[bytes]:
            split = [stem_and_tail(run.lower() if run.isascii() and "<|" not in run else run) for run in runs]
            known = words.learn(set().union(*split), word_ids)
            return (known[stem] + known[tail] for stem, tail in split)

        _encoders[key] = run_ids, whole, words
    return _encoders[key]


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def stem_and_tail(run: str) -> tuple[str, str]:
    """Cut a run before the ASCII marks that end it, where they follow an ASCII or accented Latin letter.

    Letters and marks never share a token. U+0130 gets a mark when lower-cased,
    and ``<|`` may open a special token, so such runs stay whole.
    """
    stem = run.rstrip(string.punctuation)
    if len(stem) < len(run) and stem and stem[-1] < "\u0250" and stem[-1] != "\u0130" and stem[-1].isalpha() and "<|" not in run:
        return stem, run[len(stem) :]
    return run, ""


def text_ids(texts: list[str], path: str, remembered: tuple[int, int] = REMEMBERED) -> list[bytes]:
    """Packed little-endian unsigned 32-bit ids of each text, for tokenizers that drop white space and lower-case."""
    out: list[bytes] = []
    for batch in byte_batches(texts, LOOKUP_BYTES * remembered[0]):
        ids, bounds = batch_ids(pa.array(batch, pa.string()), path, remembered)
        packed, cuts = ids.tobytes(), (4 * bounds).tolist()
        out += [packed[a:b] for a, b in zip(cuts, cuts[1:])]
    return out


def batch_ids(texts: pa.Array, path: str, remembered: tuple[int, int] = REMEMBERED) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and where each text's start, with the end of the last.

    Texts are cut at ASCII white space, which joins no two tokens, and the
    distinct runs are looked up. A to Z are lower-cased first only where
    nothing else can depend on them: in ASCII texts without ``<|``.
    """
    encode, memo, _ = _encoder(path, remembered)
    plain = pc.and_not(pc.string_is_ascii(texts), pc.match_substring(texts, "<|"))
    runs = pc.ascii_split_whitespace(pc.if_else(plain, pc.ascii_lower(texts), texts))
    distinct = runs.flatten().dictionary_encode()
    keys = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
    known = memo.learn(set(keys), encode)
    found = [known[k] for k in keys]
    ids = np.frombuffer(b"".join(found), "<u4")
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    which = distinct.indices.to_numpy()
    counts = sizes[which]
    ends = np.append(0, np.cumsum(counts))
    shift = (np.cumsum(sizes) - sizes)[which] - ends[:-1]
    return ids[np.repeat(shift, counts) + np.arange(ends[-1])], ends[runs.offsets.to_numpy()]


def token_pieces(
    docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, remembered: tuple[int, int] = REMEMBERED
) -> DataFrame:
    """The pieces of every text: doc_id, piece, start, length, ids (packed as in ``text_ids``).

    A text's ids are followed by ``end_id``; only what is longer than
    ``capacity`` is cut, into full pieces and a rest. ``remembered`` bounds the
    runs and words a worker remembers, which changes its time and memory only.
    """
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Memo.forget(*_encoder(path, remembered)[1:])
        for batch in batches_of(rows, "text", LOOKUP_BYTES * remembered[0]):
            which, piece, start, ids = [], [], [], []
            flat, bounds = batch_ids(batch.column("text").combine_chunks(), path, remembered)
            for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                packed = flat[a:b].tobytes() + end
                for k, at in enumerate(range(0, len(packed), 4 * capacity)):
                    which.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    ids.append(packed[at : at + 4 * capacity])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").combine_chunks().take(pa.array(which, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        tidy(cut), f"doc_id {kind}, piece int, start long, length long, ids binary"
    )


# ---------------------------------------------------------------- the plan

Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first


def bins_of(plan: list[tuple[Pattern, int]]) -> int:
    return sum(times for _, times in plan)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over counts: the fullest bins that still fit take the longest pieces.

    Bins with equal contents are one entry with a count.
    """
    rooms: list[int] = []  # room left in open bins, ascending
    held: dict[int, list[tuple[dict[int, int], int]]] = {}

    def put(contents: dict[int, int], times: int, room: int) -> None:
        if room not in held:
            held[room] = []
            insort(rooms, room)
        held[room].append((contents, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                per = capacity // length
                full, rest = divmod(left, per)
                if full:
                    put({length: per}, full, capacity - per * length)
                if rest:
                    put({length: rest}, 1, capacity - rest * length)
                break
            room = rooms[at]
            contents, times = held[room].pop()
            if not held[room]:
                del held[room], rooms[at]
            per = min(room // length, left)
            used = min(times, left // per)
            if used < times:
                put(contents, times - used, room)
            put(contents | {length: per}, used, room - per * length)
            left -= used * per
    return [(tuple(sorted(c.items(), reverse=True)), n) for groups in held.values() for c, n in groups]


def fillings(counts: dict[int, int], lengths: list[int], room: int, beside: int = 0, narrow: bool = False) -> Iterator[Pattern]:
    """Undominated ways to fill ``room``: those without waste as they are found, then by waste.

    ``lengths`` are those in ``counts``, ascending; one piece of length ``beside``
    is in the bin already. ``narrow`` looks for a good choice rather than for
    all: each length is taken as often as it goes or not at all, the first filling
    without waste ends the enumeration, and some that are dominated stay. A single piece as long as the room dominates every
    other filling; several pieces that fill it do not. A filling that could take a further piece is dominated by the one that has it,
    and so is one that holds fewer tokens than the longest single piece.
    """
    if not lengths or lengths[0] > room:
        yield ()
        return
    at = bisect_left(lengths, room + 1) - 1
    if lengths[at] == room:
        yield ((room, 1),)
        return
    floor, steps, full = lengths[at], 0, 0
    found: list[tuple[int, Pattern]] = []

    def extend(picked: Pattern, room_left: int, upto: int, spare: int) -> Iterator[Pattern]:
        """Add shorter and shorter lengths. ``spare`` is the shortest length left out so far."""
        nonlocal steps
        steps += 1
        k = min(upto, bisect_left(lengths, room_left + 1)) - 1
        if k < 0:
            if room_left == 0:
                yield picked
            elif room - room_left >= floor and (narrow or spare > room_left):
                found.append((room_left, picked))
            return
        # a piece as long as what is left dominates all other ways to go on
        stop = k - 1 if lengths[k] == room_left else -1
        for i in range(k, stop, -1):
            there = counts[lengths[i]] - (lengths[i] == beside)
            most = min(there, room_left // lengths[i])
            for n in range(most, most - 1 if narrow else 0, -1):
                if steps >= FILLING_STEPS or steps > FILLING_STEPS // 2 and found:
                    return
                out = spare if n == there else lengths[i]
                yield from extend((*picked, (lengths[i], n)), room_left - n * lengths[i], i, out)
            spare = lengths[i]

    for pattern in extend((), room, len(lengths), room + 1):
        full += 1
        yield pattern
        if full == (1 if narrow else FILLINGS):
            break
    found.sort(key=lambda x: (x[0], len(x[1])))
    del found[FILLINGS - full :]  # the rest is not held while the search goes deeper
    yield from [pattern for _, pattern in found]
    if not full and not found:
        yield ((lengths[at], 1),)


def bin_completion(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """A plan with as few bins as the search finds; proven least when it meets the bound on the sum.

    Depth first over one table of counts: a choice is taken by subtracting its
    pieces and taken back by adding them again.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    lengths = sorted(left)
    total = sum(length * n for length, n in left.items())
    least = -(-total // capacity)
    best = best_fit(left, capacity)
    fewest = bins_of(best)
    plan: list[tuple[Pattern, int]] = []
    used = waste = 0
    choices: list[Iterator[tuple[Pattern, int]]] = []  # per level, the choices not tried yet

    def options(narrow: bool) -> Iterator[tuple[Pattern, int]]:
        """Each filling as often as it goes; then, unless ``narrow``, half as often and so on down to once."""
        longest = lengths[-1]
        rest = lengths if left[longest] > 1 else lengths[:-1]
        repeated = []
        for filling in fillings(left, rest, capacity - longest, longest, narrow):
            contents = dict(filling)
            contents[longest] = contents.get(longest, 0) + 1
            pattern = tuple(sorted(contents.items(), reverse=True))
            times = min(left[length] // n for length, n in pattern)
            repeated.append((pattern, times))
            yield pattern, times
        for pattern, times in () if narrow else repeated:
            while times > 1:
                times //= 2
                yield pattern, times

    def take(pattern: Pattern, times: int) -> None:
        nonlocal used, waste
        for length, n in pattern:
            left[length] -= n * times
            if not left[length]:
                del lengths[bisect_left(lengths, length)]
        plan.append((pattern, times))
        used += times
        waste += times * (capacity - sum(length * n for length, n in pattern))

    def give_back() -> None:
        nonlocal used, waste
        pattern, times = plan.pop()
        for length, n in pattern:
            if not left[length]:
                insort(lengths, length)
            left[length] += n * times
        used -= times
        waste -= times * (capacity - sum(length * n for length, n in pattern))

    for narrow in (True, False):
        steps = 0
        while fewest > least and steps < SEARCH_STEPS:
            steps += 1
            if lengths and waste <= (fewest - 1) * capacity - total:
                choices.append(options(narrow))
            elif not lengths and used < fewest:
                best, fewest = _merged(plan), used
            # the next untried choice, from the deepest level up
            while choices:
                if len(plan) == len(choices):
                    give_back()
                choice = next(choices[-1], None)
                if choice is not None:
                    take(*choice)
                    break
                choices.pop()
            else:
                break
        choices.clear()
        while plan:
            give_back()
    return best


def _merged(plan: list[tuple[Pattern, int]]) -> list[tuple[Pattern, int]]:
    """The plan with one entry per pattern."""
    times: dict[Pattern, int] = {}
    for pattern, n in plan:
        times[pattern] = times.get(pattern, 0) + n
    return list(times.items())


def places(plan: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """The plan as arrays ordered by (length, first number).

    Pieces ``first`` to the next ``first`` of a length go ``per`` to a bin,
    starting with bin ``sequence`` at place ``offset``. A plan has at most as
    many rows as there are lengths, or steps of a search, times lengths in a bin,
    whatever the data.
    """
    rows, taken, sequence = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for length, n in pattern:
            first = taken.get(length, 0)
            rows.append((length, first, n, sequence, offset))
            taken[length] = first + n * times
            offset += length * n
        sequence += times
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "per", "sequence", "offset"), columns))


# ---------------------------------------------------------------- the frame


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` with sequence_id and offset: its ``length`` column decides, the rest passes through.

    Numbers within a length are counted per part of the input and then shifted
    by the counts of the parts before, so no length has to meet in one task.
    """
    spark = pieces.sparkSession
    row, part, before, number = (fresh_name(pieces, c) for c in ("_row", "_part", "_before", "_number"))
    rows = materialise(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    rows = rows.withColumn(part, F.shiftright(row, 33))
    fits = F.when(F.col("length") <= capacity, F.col("length")).when(
        F.col("length").isNotNull(), F.raise_error(F.lit("a piece is longer than the capacity")).cast("long")
    )
    per_part = rows.filter("length >= 1").groupBy(fits.alias("length"), part).agg(F.count(F.lit(1)).alias("n"))
    per_part = materialise(per_part, "lengths")
    # One row per length: at most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = places(bin_completion(counts, capacity))
    earlier = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_part.select("length", part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    in_part = Window.partitionBy("length", part).orderBy(row)
    numbered = (
        rows.filter("length >= 1")
        .withColumn(number, F.row_number().over(in_part) - 1)
        .join(shifts.hint("merge"), ["length", part])  # a row per length and part: grows with the input
        .select(*pieces.columns, (F.col(number) + F.col(before)).alias(number))
    )
    key, columns = plan["length"] << 44 | plan["first"], pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            own = batch.column(number).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(key, length << 44 | own, side="right") - 1
            bins, slot = np.divmod(own - plan["first"][at], plan["per"][at])
            kept = [batch.column(c) for c in columns]
            added = [pa.array(plan["sequence"][at] + bins), pa.array(plan["offset"][at] + slot * length)]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=[*columns, "sequence_id", "offset"])

    schema = pieces.select("*").schema.add("sequence_id", "long").add("offset", "long")
    placed = numbered.mapInArrow(place, schema)
    unplaced = rows.filter("length IS NULL OR length < 1").select(*pieces.columns)
    return placed.unionByName(
        unplaced.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    )
