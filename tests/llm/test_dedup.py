"""Exact, near and passage deduplication against brute force."""
import hashlib
import random
import tracemalloc
import uuid
from collections import Counter

import numpy as np
import pytest

from tidewater.llm.exact_dedup import DigestIndex, deduplicate, drop_copies
from tidewater.llm.jaccard_join import Bands, could_link, gram_set, keep_one, parity, signatures, similar_documents
from tidewater.llm.common import gram_hashes, mix, word_hashes
from tidewater.llm import exact_dedup, jaccard_join, substring_dedup
from tidewater.llm.substring_dedup import covered_words, keep_unique_text, remove_repeats

ids = lambda rows: sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in rows)


def lowered(text):
    return (text or "").encode().lower()


def test_exact_dedup(docs, no_docs):
    given = docs.collect()
    groups = {}
    for r in given:
        groups.setdefault(lowered(r["text"]), []).append(r["doc_id"])
    rows = deduplicate(docs).collect()
    assert ids(rows) == ids(given)
    by_digest = {hashlib.sha256(t).hexdigest(): g for t, g in groups.items()}
    for r in rows:
        group = by_digest[r["text_sha256"]]
        assert r["keep_id"] == max((x for x in group if x is not None), default=None)
        assert r["group_size"] == len(group)
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    stay = drop_copies(docs)
    assert stay.columns == docs.columns
    assert ids(stay.collect()) == ids(kept)
    assert deduplicate(no_docs).count() == 0 and drop_copies(no_docs).count() == 0


def test_index_is_kept_between_batches(spark):
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")
    second = spark.createDataFrame([(4, "B"), (5, "c"), (6, None), (7, "")], "doc_id long, text string")
    index = DigestIndex(spark)
    assert {r["doc_id"] for r in deduplicate(first, index).filter("kept").collect()} == {2, 3}
    again = DigestIndex(spark, index.path, index.buckets)  # opened anew from its folder
    assert {r["doc_id"]: r["keep_id"] for r in deduplicate(second, again).filter("kept").collect()} == {5: 5, 7: 7}
    rows = again.rows()
    assert rows.count() == 4 and rows.select("text_sha256").distinct().count() == 4
    plan = rows.groupBy("text_sha256").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # bucketed by digest
    copy = next(r for r in deduplicate(spark.createDataFrame([(9, "A")], "doc_id long, text string"), again).collect())
    assert (copy["keep_id"], copy["group_size"], copy["kept"]) == (3, 3, False)  # two then, one now
    again.forget()
    index.forget()
    assert uuid.UUID(again.table.rsplit("_", 1)[1])


def test_batch_that_is_run_again(spark):
    """A batch named by the caller gives the same answer again, also after its first run was cut short."""
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A"), (4, None)], "doc_id long, text string")
    more = spark.createDataFrame([(5, "a"), (6, "c"), (7, "C")], "doc_id long, text string")
    index = DigestIndex(spark, buckets=4)
    answer = lambda docs, batch: sorted(map(tuple, deduplicate(docs, index, batch).collect()))
    once, then = answer(rows, "first"), answer(more, "second")
    assert answer(rows, "first") == once and answer(more, "second") == then
    assert {r[0] for r in once if r[3]} == {2, 3, 4} and {r[0] for r in then if r[3]} == {7}
    assert ids(drop_copies(rows, index, "first").collect()) == [2, 3, 4]
    # Only a part of the batch had been written.
    spark.sql(f"INSERT OVERWRITE TABLE {index.table} PARTITION (batch = 'second') SELECT sha2('c', 256), 6L, 1L")
    assert answer(more, "second") == then
    with pytest.raises(ValueError):
        deduplicate(rows, index, "no 'name'")
    assert index.rows().count() == 4
    index.forget()


def test_batches_by_falling_ids_equal_one_batch(spark, docs):
    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", "text").distinct()
    index = DigestIndex(spark, buckets=4)
    kept = [ids(drop_copies(rows.filter(part), index, f"b{k}").collect()) for k, part in enumerate(("doc_id >= 40", "doc_id < 40"))]
    assert sorted(kept[0] + kept[1]) == ids(drop_copies(rows).collect())
    index.forget()


def test_index_is_never_shuffled_and_hot_digests_are_joined_apart(spark, monkeypatch):
    index = DigestIndex(spark, buckets=5)
    rows = spark.createDataFrame([(i, "copy" if i % 2 else f"t{i}") for i in range(60)] + [(1, "copy")] * 3, "doc_id long, text string")
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 10)
    found = deduplicate(rows, index, "one")
    out = found.collect()
    assert len(out) == 63 and {r["group_size"] for r in out if r["keep_id"] == 59} == {33} and sum(r["kept"] for r in out) == 31
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 5 out of 5" in plan
    index.forget()


def brute_components(rows, n, percent):
    sets = {}
    for i, text in rows:
        w = lowered(text).split()
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("few", [16, 2])
def test_jaccard_join(docs, no_docs, monkeypatch, few):
    """With ``few`` 2 almost every signature is crowded and goes the way by pivots and blocks."""
    monkeypatch.setattr(jaccard_join, "FEW", few)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "CROWD_BLOCK", 8)
    unique = {r["doc_id"]: r["text"] for r in docs.filter("doc_id IS NOT NULL").collect()}
    want = brute_components(unique.items(), 5, 75)
    rows = similar_documents(docs, 5, 75).collect()
    assert ids(rows) == ids(docs.collect())
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None} == want
    stay = keep_one(docs, 5, 75)
    assert stay.columns == docs.columns
    assert {r["doc_id"] for r in stay.collect()} == {i for i, (_, c) in want.items() if i == c} | {None}
    assert similar_documents(no_docs).count() == 0


def test_keep_one_keeps_one_row_of_ids_missing_or_repeated(spark):
    near = [" ".join([*(f"w{i}" for i in range(60)), end]) for end in ("a", "b", "c")]
    other = [" ".join([*(f"v{i}" for i in range(60)), end]) for end in ("a", "b")]
    third = [" ".join([*(f"u{i}" for i in range(60)), end]) for end in ("a", "b")]
    given = [(4, near[0]), (None, near[1]), (5, near[2]), (None, other[0]), (None, other[1]), (5, third[0]), (2, third[1]), (4, ""), (None, "")]
    stay = keep_one(spark.createDataFrame(given, "doc_id long, text string"), 5, 75).collect()
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in stay))
    assert [g for g in got if g[1] not in other] == sorted([(4, near[0]), (2, third[1]), (4, ""), (0, "")])
    assert len([g for g in got if g[1] in other]) == 1


def test_signatures_miss_no_link():
    """Random pairs at the edge of the threshold share a signature, and no bound rules them out."""
    random = np.random.default_rng(4)
    for _ in range(400):
        size = int(random.integers(4, 120))
        a = np.unique(random.integers(0, 2**63, size).astype(np.uint64))
        common = a[: max(1, int(np.ceil(len(a) * 0.86)))]
        extra = random.integers(0, 2**63, int(len(a) * 0.14)).astype(np.uint64)
        b = np.unique(np.concatenate([common, extra]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both) or np.array_equal(a, b):
            continue
        bands = Bands(75)
        found = [{(band, s) for _, (band, k, p) in bands.layouts(len(x)) for s in signatures(x, mix(x), band, k, p)[0].tolist()} for x in (a, b)]
        assert found[0] & found[1]
        bits = [np.frombuffer(parity(x), np.uint8) for x in (a, b)]
        assert could_link(len(a), bits[0], len(b), bits[1], 75)
    assert len(gram_set(b"", 5)) == 0 and len(gram_set(b"a b", 5)) == 1


def test_rows_of_signatures_hold_only_sets_that_have_some(spark):
    """What is sent grows with the signatures, not with the number of buckets times that of sets."""
    docs = spark.createDataFrame([(" ".join(f"w{i}x{j}" for j in range(10 + i % 7)),) for i in range(300)], "text string").coalesce(1)
    tables = {}
    for buckets in (1, 4, 4000):
        rows = jaccard_join.send_signatures(docs, 5, 75, buckets).collect()
        counts = [np.frombuffer(r["counts"], np.int32).reshape(-1, 2) for r in rows]
        assert all(c.any(axis=1).all() and len(c) == len(r["keys"]) // 8 for c, r in zip(counts, rows))
        assert all(c.sum() == len(r["signs"]) // jaccard_join.SIGN.itemsize for c, r in zip(counts, rows))
        tables[buckets] = sum(len(r["keys"]) // 8 for r in rows), sum(c.sum() for c in counts)
    assert tables[1][0] == 300 and tables[4][0] <= 1200
    assert tables[1][1] == tables[4][1] == tables[4000][1] >= tables[4000][0]


def test_bitmaps_rule_out_pairs_that_just_miss():
    """In a large group of near copies most pairs of 7 in 10 must not reach the texts."""
    random = np.random.default_rng(9)
    coarse = fine = 0
    for _ in range(400):
        common, own = random.integers(0, 2**63, 120).astype(np.uint64), random.integers(0, 2**63, (2, 26)).astype(np.uint64)
        a, b = (np.sort(np.append(common, x)) for x in own)  # 120 of 172: 0.698
        held = lambda *args: could_link(*(y for x in (a, b) for y in (len(x), np.frombuffer(parity(x, *args), np.uint64))), 75)
        coarse, fine = coarse + held(), fine + held(jaccard_join.FINE)
    assert coarse < 120 and fine < 20


def brute_repeats(rows, length):
    places = Counter()
    split = [((t or "").encode().split()) for _, t in rows]
    for w in split:
        places.update(tuple(w[k : k + length]) for k in range(len(w) - length + 1))
    out = []
    for (i, _), w in zip(rows, split):
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if places[tuple(w[k : k + length])] > 1:
                gone[k : k + length] = [True] * length
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length,block", [(35, 8 << 20), (8, 4000)])
def test_substring_dedup(docs, no_docs, monkeypatch, length, block):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", block)
    monkeypatch.setattr(substring_dedup, "AUTOMATON_WORDS", 200)
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = remove_repeats(docs, length).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in rows), key=str) == brute_repeats(given, length)
    for r in rows:
        assert sum(s["stop"] - s["start"] for s in r["removed"]) == r["n_removed"]
    cut = keep_unique_text(docs, length)
    assert cut.columns == docs.columns and cut.count() == len(given)
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[0] is None and texts[2] == "  \t\n "  # nothing removed, nothing changed
    assert remove_repeats(no_docs).count() == 0


def test_word_hashes():
    words = ["a", "b", "ab", "ba", "a" * 8, "a" * 9, "a" * 16, "a" * 17, "12345678", "123456789", "x" * 5000, "x" * 5001, "é", "ß"]
    text = " \t".join(words + words) + "\n\x1c"
    hashes = word_hashes(text.encode())
    assert len(hashes) == 2 * len(words) + 1 and (hashes[: len(words)] == hashes[len(words) : -1]).all()
    assert len(set(hashes.tolist())) == len(words) + 1
    assert len(word_hashes(b"")) == len(word_hashes(b" \t\n")) == 0 and len(word_hashes(b"one")) == 1
    # A word of 1,024 letters and its complement, whose sums by powers of two cancel, are two words.
    flips = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = ("".join("ab"[(f + turn) % 2] for f in flips).encode() for turn in (0, 1))
    assert word_hashes(one)[0] != word_hashes(two)[0]


def test_jaccard_without_ids(spark, words):
    """Many rows without an id, and many that share one, next to near copies of each."""
    base = [words[i % 50] for i in range(60)]
    near = lambda k: " ".join(base[:59] + [f"end{k}"])
    rows = [(None, near(k % 40)) for k in range(400)] + [(7, near(k)) for k in range(40, 80)] + [(8, "something else entirely here")] * 3
    got = similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), n=5, percent=75).collect()
    assert len(got) == len(rows)
    assert {r["component_id"] for r in got if r["doc_id"] != 8} == {7} and {r["component_id"] for r in got if r["doc_id"] == 8} == {8}


def test_removal_holds_numbers_not_words():
    draw = random.Random(5)
    words = [f"word{i:07d}" for i in range(300)]
    texts = [" ".join(draw.choices(words, k=2000)).encode() for _ in range(60)]
    texts += [texts[0]]
    recurring = np.sort(gram_hashes(word_hashes(texts[0]), 35))
    tracemalloc.start()
    covered = [(len(w), int(c.sum())) for w, c in covered_words(texts, recurring, 35)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert covered == [(2000, 2000)] + [(2000, 0)] * 59 + [(2000, 2000)]
    assert peak < 30 * 2000 * len(texts)  # bytes per word; a word of its own takes 44 and a place in a list


def test_windows_of_a_block_are_held_once():
    draw = random.Random(6)
    texts = [" ".join(str(draw.randrange(300)) for _ in range(400)).encode() for _ in range(500)] + [b"a few", b"x " * 900]
    plain = [substring_dedup.windows(t, 35) for t in texts]
    first, second = (np.concatenate(p) for p in zip(*plain))
    values, at, counts = np.unique(first, return_index=True, return_counts=True)
    del plain
    tracemalloc.start()
    try:
        got = substring_dedup.block_windows(texts, 35)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 64 * len(first)  # bytes a window: its hashes, an order and the distinct ones; 90 with lists and copies of the hashes
    for mine, want in zip(got, (values, second[at], counts)):
        assert np.array_equal(mine, want)
    assert np.array_equal(substring_dedup.held_windows(texts, 35), np.sort(first))
    assert [len(x) for x in substring_dedup.block_windows([], 35)] == [0, 0, 0] and len(substring_dedup.held_windows([], 35)) == 0
