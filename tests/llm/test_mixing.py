"""Mixing by weighted fair queueing against a direct computation."""
import hashlib
import re

import pytest

from tidewater.llm.source_mixing import mix, schedule

SCHEMA = "doc_id long, text string, source string, finish string, _size int, COPY int"


def words_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected(rows, weights=(5, 2, 1), share=1.5, repeats=2):
    """(targets by source, taken words by (source, doc_id, size) as sorted lists)."""
    by_source = {}
    for i, text, source, *_ in rows:
        by_source.setdefault(source, []).append((i, words_of(text)))
    order = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(n for _, n in by_source[s]) for s in order}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, target, open_ = share * sum(size.values()), {}, list(order)
    while open_:  # share, fix what is above its limit, share the rest again
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] >= repeats * size[s]]
        if not full:
            target.update({s: level * weight[s] for s in open_})
            break
        for s in full:
            target[s] = float(repeats * size[s])
            left -= target[s]
            open_.remove(s)
    entries = []
    for turn, s in enumerate(order):
        shuffled = sorted(by_source[s], key=lambda r: (hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest()[:15], r[1]))
        at = 0
        for _ in range(repeats):
            for i, n in shuffled:
                if n:
                    entries.append(((at + n) / target[s], turn, at, s, i, n))
                at += n
    used, taken = 0, {}
    for s, rows_ in by_source.items():
        for i, n in rows_:
            taken.setdefault((s, i, n), 0)
    for _, _, _, s, i, n in sorted(entries):
        used += n
        if used > share * sum(size.values()):
            break
        taken[s, i, n] += n
    return size, target, taken


@pytest.fixture(scope="module")
def mixed_rows(texts):
    names = ["b", "a", None, "ä", "B", ""]
    rows = [(i, t, names[min(i % 9, 5)], "x", 1, 2) for i, t in enumerate(texts * 4)]
    rows += [(7001, "one two three", "a", None, None, None)] * 5  # repeated rows
    rows += [(None, "no id here", "a", None, None, None), (None, "no id there at all", "b", None, None, None)]
    return rows + [(7002, None, "only nothing", None, None, None), (7003, " \t", "only nothing", None, None, None)]


def test_schedule(spark, mixed_rows):
    size, target, taken = expected(mixed_rows)
    got = schedule(spark.createDataFrame(mixed_rows, SCHEMA).repartition(5)).collect()
    assert len(got) == len(mixed_rows)
    sums = {}
    for r in got:
        key = (r["source"], r["doc_id"], r["size"])
        sums[key] = sums.get(key, 0) + r["taken"]
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]], rel=1e-12)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert sums == taken
    assert sum(sums.values()) <= 1.5 * sum(size.values())


def test_targets_stop_at_what_there_is(spark):
    rows = [(i, "w " * 10, "big" if i < 90 else f"small{i}", None, None, None) for i in range(100)]
    got = {r["source"]: (r["target"], r["taken"]) for r in schedule(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["small95"] == (20.0, 20)  # both passes over its only document
    assert got["big"][0] == 1500.0 - 10 * 20.0


def test_mix_gives_whole_documents_in_order(spark, mixed_rows):
    frame = spark.createDataFrame(mixed_rows, SCHEMA)
    plan = schedule(frame).collect()
    got = mix(frame)
    assert got.columns == [*frame.columns, "_finish"]
    rows = got.collect()
    assert sorted(r["_finish"] for r in rows) == [r["_finish"] for r in rows]
    assert sum(words_of(r["text"]) for r in rows) == sum(r["taken"] for r in plan)
    count = lambda keys: {k: keys.count(k) for k in set(keys)}
    wanted = [(r["doc_id"], r["source"], r["size"]) for r in plan for _ in range(r["passes"])]
    assert count([(r["doc_id"], r["source"], words_of(r["text"])) for r in rows]) == count(wanted)


def test_same_on_a_rerun_and_on_other_partitions(spark, mixed_rows):
    frame = spark.createDataFrame(mixed_rows, SCHEMA)
    once = sorted(map(tuple, schedule(frame.repartition(3)).select("source", "doc_id", "size", "taken").collect()), key=repr)
    again = sorted(map(tuple, schedule(frame.repartition(7)).select("source", "doc_id", "size", "taken").collect()), key=repr)
    assert once == again


def test_empty_and_wordless_tables(spark):
    assert schedule(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    wordless = spark.createDataFrame([(1, None, "a", None, None, None), (2, "", None, None, None, None)], SCHEMA)
    assert [(r["target"], r["taken"]) for r in schedule(wordless).collect()] == [(0.0, 0)] * 2
    assert mix(wordless).count() == 0


def test_plan_has_no_python(spark, mixed_rows):
    plan = schedule(spark.createDataFrame(mixed_rows, SCHEMA))._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan
