"""Tokenizer operators against the libraries themselves."""
import base64
import hashlib
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest

from tidewater.llm import packing
from tidewater.llm.byte_bpe import Codec, decode, encode
from tidewater.llm.common import Memo, chunk_starts, chunks
from tidewater.llm.packing import best_fit, bin_completion, bins_of, pack, token_pieces
from tidewater.llm.token_counts import count_tokens

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_round_trip(docs, no_docs, encoding):
    rows = decode(encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).collect()
    want = sorted((r["doc_id"] or -1, r["text"] or "") for r in docs.collect())
    got = sorted((r["doc_id"] or -1, bytes(r["decoded"]).decode()) for r in rows)
    assert got == want
    by_text = {bytes(r["decoded"]).decode(): np.frombuffer(r["ids"], "<u4").tolist() for r in rows}
    assert all(ids == encoding.encode_ordinary(text) for text, ids in by_text.items())
    assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in rows)
    assert encode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_odd_texts(encoding):
    draw = random.Random(1)
    codec = Codec(RANKS, public_tokenizers.PATTERN)
    odd = ["a" * 3000, "=" * 1000, "0" * 700, "ab" * 2000, "日本語のテキスト" * 300, "🙂" * 500, "I'll 'S  \n\n x\t\ty  ", "<|endoftext|> a"]
    odd += ["".join(draw.choice(" \n\t\x1c\x1d\x0b 　aAé1.'s") for _ in range(60)) for _ in range(400)]
    ids = codec.encode(odd)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [encoding.encode_ordinary(t) for t in odd]
    assert [x.decode() for x in codec.decode(ids)] == odd


def test_byte_bpe_looks_at_distinct_pieces(encoding, monkeypatch):
    """Chunks start only where ``chunks`` cuts; a word is contracted once; decoding reads rows of many tokens."""
    draw = random.Random(2)
    texts = ["".join(draw.choice(" \n\t\x1c\x1f\x85\xa0\u1680\u2003\u2028\u3000é”aA1.'s") for _ in range(draw.randrange(40))) for _ in range(400)]
    texts += ["", "word wörd слово  word", "", "字 word\u2029 word ", "\x0b\x0cword"]
    raw = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, raw)])
    own = {b + x for t, b in zip(texts, bounds.tolist()) for x in np.cumsum([0, *[len(c.encode()) for c in chunks(t)]])[:-1].tolist()}
    starts = chunk_starts(b"".join(raw), bounds)
    assert own.issuperset(starts.tolist()) and len(starts) > len(own) / 3
    codec, seen = Codec(RANKS, public_tokenizers.PATTERN), []
    contract = codec.contract
    monkeypatch.setattr(codec, "contract", lambda words: seen.extend(words) or contract(words))
    texts += ["zyxwvut slovoqq " * 3000, "zyxwvut! slovoqq " * 10]
    ids = codec.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [encoding.encode_ordinary(t) for t in texts]
    assert seen.count(b" zyxwvut") == seen.count(b" slovoqq") == 1
    connection, rows = codec.con, []
    codec.con = SimpleNamespace(
        register=lambda name, table: rows.append(table.num_rows) or connection.register(name, table),
        unregister=connection.unregister, sql=connection.sql,
    )
    assert [x.decode() for x in codec.decode(ids)] == texts
    assert sum(rows) <= len(texts) + sum(map(len, ids)) / 4 / 1000


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts(docs, no_docs, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        length = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        length = lambda t: len(model.encode(t, add_special_tokens=False))
    want = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()), length(r["text"] or "")) for r in docs.collect())
    got = count_tokens(docs, path, limit=50).collect()
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 50) for r in got)
    assert count_tokens(no_docs, path).count() == 0


def test_special_strings_count_as_one_token(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|>  b<|endoftext|>"), (2, "  <|endoftext|>\n\n\nx ")], "doc_id long, text string")
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path := public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: len(model.encode(r["text"], add_special_tokens=False)) for r in docs.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs, path).collect()} == want


def least_sequences(lengths, capacity):
    """A lower bound that also counts pieces too long to share a sequence (the bound L2 of Martello and Toth)."""
    best = 0
    for a in {0, *(n for n in lengths if n <= capacity / 2)}:
        alone = [n for n in lengths if n > capacity - a]
        long = [n for n in lengths if capacity / 2 < n <= capacity - a]
        rest = sum(n for n in lengths if a <= n <= capacity / 2)
        best = max(best, len(alone) + len(long) + max(0, -(-(rest - len(long) * capacity + sum(long)) // capacity)))
    return best


def test_packing(docs, no_docs):
    from tokenizers import Tokenizer

    path, capacity = public_tokenizers.path("word_bpe_49k.json"), 256
    model = Tokenizer.from_file(path)
    want = []
    for r in docs.collect():
        ids = [*model.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        want += [(r["doc_id"] or -1, k, at, ids[at : at + capacity]) for k, at in enumerate(range(0, len(ids), capacity))]
    rows = pack(token_pieces(docs, path, capacity), capacity).collect()
    got = [(r["doc_id"] or -1, r["piece"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in rows]
    assert sorted(got) == sorted(want)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) == least_sequences([r["length"] for r in rows], capacity)  # no packing has fewer
    assert pack(token_pieces(no_docs, path)).count() == 0
    assert zlib.crc32(b"") == 0


def test_packing_remembers_within_bounds(texts):
    path, bounds = public_tokenizers.path("word_bpe_49k.json"), (30, 20)
    own, other = packing._encoder(path, bounds)[1:], Memo(5)
    other.learn({"x"}, lambda keys: keys)
    given = [t or "" for t in texts]
    assert [packing.text_ids([t], path, bounds) for t in given] == [packing.text_ids([t], path) for t in given]
    for memo, bound in zip(own, bounds):  # the runs of one text are learnt at once
        longest = max(len(set(t.split())) for t in given)
        assert 0 < len(memo.now) <= max(bound, 2 * longest)
    Memo.forget(*own)
    assert all(memo.now for memo in own) and not other.now


def test_packing_ids_of_odd_texts():
    """Looking up lower-cased stems and marks gives the ids of the whole text."""
    from tokenizers import Tokenizer

    draw = random.Random(4)
    path = public_tokenizers.path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    texts = ["", " ", "\x1c", "<|endoftext|>", "a<|ENDOFTEXT|>", "A<|endoftext|>b.", "It'S we'LL 'TIS'", "J\u030c T\u0308.", "\u0130. x\u0130*** \u212a!", "né. NÉ*** e\u0301,"]
    texts += ["".join(draw.choice(" \n\t\x0b\x1c\x1f\x85\xa0\u2028\u3000aATéÉ\u0130J\u030c1'sS.*$_<|>") for _ in range(draw.randrange(60))) for _ in range(3000)]
    want = [model.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.text_ids(texts, path)] == want


def test_packing_encodes_a_word_once_whatever_its_case_and_marks():
    path, bounds = public_tokenizers.path("word_bpe_49k.json"), (40, 41)
    packing.text_ids(["Orrin orrin ORRIN*** orrin?\nOrrin$$$", "Orrin é orrin### née%%% née."], path, bounds)
    assert set(packing._encoder(path, bounds)[2].now) == {"orrin", "é", "née", "", "***", "?", "$$$", "###", "%%%", "."}


def test_other_steps_let_go_of_the_tokenizer():
    path, bounds = public_tokenizers.path("word_bpe_49k.json"), (50, 51)
    own = packing._encoder(path, bounds)[1:]
    want = packing.text_ids(["some words"], path, bounds)
    Memo.forget(*own)
    assert list(packing._encoders) == [(path, bounds)] and own[0] in Memo.made
    Memo.forget()
    assert not packing._encoders and not any(memo in own for memo in Memo.made)
    assert packing.text_ids(["some words"], path, bounds) == want


def test_pack_without_a_length(spark):
    pieces = spark.createDataFrame([(1, None), (2, 0), (3, 5), (3, 5)], "id long, length long")
    rows = pack(pieces, 8).collect()
    assert sorted((r["id"], r["sequence_id"] is None) for r in rows) == [(1, True), (2, True), (3, False), (3, False)]


def _fewest(lengths, capacity):
    """Fewest bins by trying everything."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1 :])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def test_bin_completion_is_optimal_on_small_cases():
    draw = random.Random(2)
    for _ in range(60):
        lengths = sorted((draw.randint(8, 60) for _ in range(draw.randint(1, 11))), reverse=True)
        counts = {x: lengths.count(x) for x in lengths}
        plan = bin_completion(counts, 100)
        packed = [x for pattern, times in plan for _ in range(times) for x, n in pattern for _ in range(n)]
        assert sorted(packed) == sorted(lengths)
        assert all(sum(x * n for x, n in pattern) <= 100 for pattern, _ in plan)
        assert bins_of(plan) == _fewest(lengths, 100) <= bins_of(best_fit(counts, 100))


def test_bin_completion_goes_on_after_a_full_filling():
    counts = {1536: 8, 1024: 8, 768: 16}  # best fit takes 9; 1536 + 1024 + 768 + 768 is full
    plan = bin_completion(counts, 4096)
    assert bins_of(plan) == 8 < bins_of(best_fit(counts, 4096))
    packed = Counter()
    for pattern, times in plan:
        assert sum(x * n for x, n in pattern) <= 4096
        packed.update({x: n * times for x, n in pattern})
    assert packed == counts


def test_fillings_are_all_that_no_other_dominates():
    counts = {5: 2, 4: 3, 3: 2}
    assert set(packing.fillings(counts, [3, 4, 5], 13)) == {
        ((5, 2), (3, 1)), ((5, 1), (4, 2)), ((5, 1), (4, 1), (3, 1)), ((5, 1), (3, 2)), ((4, 3),), ((4, 2), (3, 1)),
    }
    assert list(packing.fillings(counts, [3, 4, 5], 5)) == [((5, 1),)]


def test_plan_is_bounded_by_lengths_not_pieces():
    counts = {x: 10**9 + x for x in range(1, 200)}
    plan = bin_completion(counts, 256)
    assert bins_of(plan) >= sum(x * n for x, n in counts.items()) // 256
    assert len(packing.places(plan)["first"]) < 200 * 256
    assert hashlib.sha256(b"").hexdigest()
