"""Phrase mining against a direct count."""
import random
import re
from collections import Counter, defaultdict

import pytest

from tidewater.llm import phrases
from tidewater.llm.phrases import chunks_by_lang, frequent, mine

SCHEMA = "doc_id long, text string, lang string, prefix string, next int, F string, phrase string"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_of(rows, longest=4):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i : i + m])] += 1
    return f, n


def expected(rows, longest=4, least=30, covered=80, top=2000):
    f, n = counts_of(rows, longest)
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        most = {}
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    most[p[i : i + m]] = max(a, most.get(p[i : i + m], 0))
        scored = []
        for p, a in found.items():
            if 100 * most.get(p, 0) >= covered * a:
                continue
            score, _, left, right = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def prose():
    """Few words, so that phrases recur; fixed phrases, odd characters, NULLs and repeated rows."""
    draw = random.Random(5)
    names = ["ab", "Cd", "cd", "É", "é", "x\x1cy", "10", "ß", "w\u0085v", "-", "ef", "gh"]
    fixed = ["new york city hall", "as soon as", "Kick The bucket", "la la la la la"]
    rows = []
    for i in range(300):
        parts = []
        for _ in range(draw.randint(0, 40)):
            parts.append(draw.choice(fixed) if draw.random() < 0.3 else draw.choice(names))
            parts.append(draw.choice([" ", " ", "  ", "\t", ". ", "\n", "!\x0b", " ,", "\x0c"]))
        rows.append(("".join(parts), draw.choice(["en", "en", "fr", "und", None])))
    rows += [(None, "en"), ("", None), (" \t\n.", "fr"), ("one", "rare lang"), ("long " * 40_000, "de"), ("wörd, " * 3000, "de")]
    return rows + [rows[3]] * 40


def frame(spark, rows):
    return spark.createDataFrame([(None if i % 5 else i, t, lang, "p", 1, "f", "q") for i, (t, lang) in enumerate(rows)], SCHEMA)


def got(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def test_mine(spark, prose):
    result = mine(frame(spark, prose).repartition(3))
    assert got(result) == expected(prose)
    kinds = {f.name: f.dataType.simpleString() for f in result.schema}
    assert all(kinds[c] == "bigint" for c in ("rank", "a", "l", "r", "n", "score"))


def test_other_limits(spark, prose):
    assert got(mine(frame(spark, prose), longest=3, least=5, covered=60, top=7)) == expected(prose, 3, 5, 60, 7)


def test_full_bitmap_split_prefixes_and_small_chunks(spark, prose, monkeypatch):
    monkeypatch.setattr(phrases, "FILTER_BITS", 6)  # every bit set: nothing is ruled out
    monkeypatch.setattr(phrases, "HOT_SHARE", 1e-9)  # every prefix is split
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 700)
    assert got(mine(frame(spark, prose).repartition(3))) == expected(prose)


def test_counts_are_of_real_words(spark, prose):
    f, n = counts_of(prose)
    totals, found = frequent(frame(spark, prose), least=1)
    assert {r["lang"]: r["n"] for r in totals.collect()} == {k: v for k, v in (n | {"fr": n["fr"]}).items()}
    rows = {(r["lang"], tuple(f"{r['prefix']} {r['next']}".split(" ")) if r["prefix"] else (r["next"],)): r["f"] for r in found.collect()}
    assert rows == {(lang, p): a for lang, count in f.items() for p, a in count.items()}


def test_nothing_to_find(spark):
    assert mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mine(frame(spark, [(None, None), ("", "en"), (". .", "en"), ("a b c", "en")])).count() == 0


def test_products_beyond_64_bits(spark):
    """Scores stay exact for counts no test table reaches."""
    df = spark.range(1).selectExpr("cast(9000000000000000001 as decimal(20,0)) * 2000000 as _above", "cast(18000000000000000005 as decimal(20,0)) as _below")
    assert df.selectExpr("_above div _below as s").first()["s"] == 9000000000000000001 * 2000000 // 18000000000000000005


def test_chunks_hold_all_words():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([["a", "b", "a"], ["x y. z " * 50, "one", "tail, end"]], names=["lang", "text"])
    words = {}
    for lang, chunk in chunks_by_lang(iter([batch]), 40):
        words.setdefault(lang, Counter()).update(chunk.vocabulary.take(pa.array(chunk.ids[chunk.ids >= 0])).to_pylist())
    assert words == {"a": Counter({"x": 50, "y": 50, "z": 50, "tail": 1, "end": 1}), "b": Counter({"one": 1})}
