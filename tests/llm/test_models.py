"""Trained operators: held-out quality, exact parts against brute force, odd inputs."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import context_tree, language_id, toxicity
from tidewater.llm.queries import QUERIES
from tidewater.llm.vector_search import search
from tidewater.session import table

SF = "/root/testdata/sf0.01"


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def test_language_id_is_right_on_held_out_rows(spark):
    docs = table(spark, SF, "documents").select("doc_id", "lang")
    rows = QUERIES["op5_language_id"](spark, SF).join(docs, "doc_id").collect()
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert np.mean([r["rejected"] for r in rows]) < 0.01
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_letters_and_labels(spark, monkeypatch):
    assert not any(map(language_id.has_letter, ("", "½ ² ٣ _ 12", "①", "...")))
    assert all(map(language_id.has_letter, ("½ a", "ß", "文", "٣ب")))
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    rows = spark.createDataFrame([(f"some words {k}", f"l{k % 4}") for k in range(20)], "text string, lang string")
    with pytest.raises(ValueError, match="4 labels"):
        language_id.train(rows)


def test_language_id_odd_inputs(spark, docs, no_docs):
    model = language_id.train(docs)
    rows = language_id.identify(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] == "en"
    kept = language_id.keep_known(docs, model)
    assert kept.columns == docs.columns
    untrained = language_id.train(no_docs)
    assert {r["lang_pred"] for r in language_id.identify(docs, untrained).collect()} == {"und"}
    assert language_id.identify(no_docs, model).count() == 0


def test_language_id_samples_a_language_of_copies(spark):
    spell = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    text = F.when(F.col("id") < 700, spell).otherwise(F.lit("the same text again"))
    many = spark.range(60_000).select(text.alias("text"), F.lit("xx").alias("lang"))
    few = spark.range(60_000).select(F.when(F.col("id") < 40, spell).otherwise(F.lit("zz zz")).alias("text"), F.lit("yy").alias("lang"))
    sample = language_id._sample(many.unionByName(few), "lang")  # a whole and a piece of each text
    assert Counter(lang for lang, *_ in sample) == {"xx": 2 * language_id.SAMPLE, "yy": 2 * 41}


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    rows = QUERIES["op9_toxicity"](spark, sf).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.03


def test_toxicity_odd_inputs(spark, docs, no_docs):
    labels = docs.filter("doc_id IS NOT NULL").select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.lit(1)).when(F.col("doc_id") % 3 == 0, 0).alias("toxic"))
    scored = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    no_labels = labels.filter("false")
    assert {r["score"] < 1e-6 for r in toxicity.score(docs, toxicity.train(docs, no_labels)).collect()} == {True}
    assert toxicity.score(no_docs, toxicity.train(no_docs, no_labels)).count() == 0


def test_label_model_finds_accuracies_and_shares_the_weight_of_copies():
    random = np.random.default_rng(1)
    y = random.random(6000) < 0.3
    fire = lambda p1, p0: np.where(y, random.random(6000) < p1, random.random(6000) < p0)
    a, b, c = fire(0.8, 0.05), fire(0.6, 0.02), fire(0.5, 0.5)
    votes, counts = np.unique(np.stack([a, b, c, b], axis=1).astype(float), axis=0, return_counts=True)
    labelled = np.zeros((len(votes), 2))
    for row, label in zip(np.stack([a, b, c, b], axis=1)[:300], y[:300]):
        labelled[np.flatnonzero((votes == row).all(axis=1))[0], int(label)] += 1
    model = toxicity.fit_label_model(votes, counts - labelled.sum(axis=1), labelled)
    assert abs(model.prior - 0.3) < 0.06
    assert np.allclose(model.rates[0], [0.05, 0.8], atol=0.08)
    assert model.correlations[1, 3] > 0.9 and model.weights[1] < 0.6 < model.weights[0]


def brute_tree(train, text, depth):
    """Weighted probability of a text's bits, from dictionaries of counts."""
    counts, children = Counter(), {}
    def steps(t):
        data = b"\n" * depth + b" ".join(t.lower().split()) + b"\n"
        for i in range(depth, len(data)):
            for b in range(8):
                yield data[i - depth : i], 1 << b | data[i] >> 8 - b, data[i] >> 7 - b & 1
    for t in train:
        for context, node, bit in steps(t):
            for d in range(depth + 1):
                counts[context[depth - d :], node, bit] += 1
                if d:
                    children.setdefault((context[depth - d + 1 :], node), set()).add(context[depth - d :])
    kt = lambda c, n: math.lgamma(counts[c, n, 0] + 0.5) + math.lgamma(counts[c, n, 1] + 0.5) - math.lgamma(counts[c, n, 0] + counts[c, n, 1] + 1) - 2 * math.lgamma(0.5)
    memo = {}

    def weighted(c, n):
        if (c, n) not in memo:
            own = kt(c, n)
            memo[c, n] = own if len(c) == depth else np.logaddexp(own, below(c, n)) - math.log(2)
        return memo[c, n]

    def below(c, n):
        return sum(weighted(x, n) for x in children.get((c, n), ()))

    total = 0.0
    for context, node, bit in steps(text):
        p = None
        for d in range(depth, -1, -1):
            c = context[depth - d :]
            seen = counts[c, node, 0] + counts[c, node, 1]
            if not seen:
                continue
            own = (counts[c, node, bit] + 0.5) / (seen + 1)
            odds = math.exp(min(50, max(-50, kt(c, node) - below(c, node))))
            p = own if p is None else (odds * own + p) / (odds + 1)
        total += math.log10(0.5 if p is None else p)
    return total


@pytest.mark.parametrize("block", [12 << 20, 3000])
def test_context_tree(docs, no_docs, monkeypatch, block):
    monkeypatch.setattr(context_tree, "BLOCK_BYTES", block)
    monkeypatch.setattr(context_tree, "BUCKET_BYTES", block)
    given = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    train = [t for i, t in given if fold(i, 7) != 2]
    words = Counter(w for t in train for w in [*t.lower().split(), None])
    total = sum(words.values())
    rows = context_tree.score_texts(docs, context_tree.held_out()).collect()
    assert len(rows) == len(given)
    texts = dict(given)
    for r in rows:
        own = [*texts[r["doc_id"]].lower().split(), None]
        assert r["held_out"] == (fold(r["doc_id"], 7) == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(words[w] > 0 for w in own), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((words[w] + 1) / (total + len(words) + 1)) for w in own))
    for r in [r for r in rows if len(texts[r["doc_id"]]) < 300][:6]:
        assert r["score"] == pytest.approx(brute_tree(train, texts[r["doc_id"]], context_tree.DEPTH), rel=1e-4)
    assert context_tree.score_texts(no_docs, context_tree.held_out()).count() == 0
    nothing_learned = context_tree.score_texts(docs, F.lit(True)).collect()
    assert all(r["score"] == pytest.approx(8 * r["n_bytes"] * math.log10(0.5)) for r in nothing_learned)


def test_context_tree_beats_single_words(spark):
    rows = QUERIES["op4_context_tree"](spark, "/root/testdata/sf0.1").filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert rows["s"] > rows["b"]


def test_vector_search_prunes_structured_rows(spark, monkeypatch):
    """6,000 rows in 60 clusters: recall of the queries that did not calibrate, and how many rows were compared."""
    from tidewater.llm import vector_search

    draw = np.random.default_rng(4)
    centres = draw.normal(size=(60, 24))
    rows = centres[draw.integers(0, 60, 6000)] + 0.15 * draw.normal(size=(6000, 24))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<float>").repartition(4)
    monkeypatch.setattr(vector_search, "LEAF_ROWS", 100)
    monkeypatch.setattr(vector_search, "CALIBRATION", 100)
    seen, visits = {}, vector_search._visits

    def watched(dealt, probes, tree, k):
        seen.update(n=visits(dealt, probes, tree, k), tree=tree, probes=set(probes["vec_id"]))
        return seen["n"]

    monkeypatch.setattr(vector_search, "_visits", watched)
    found = {}
    for r in search(table, F.col("vec_id") % 20 == 0, 20).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    vectors = rows.astype(np.float32).astype(float)
    fresh = [q for q in range(0, 6000, 20) if q not in seen["probes"]]
    assert len(fresh) == 200
    leaf, hits, compared = seen["tree"].assign(vectors), 0, 0
    for q in fresh:
        products = vectors @ vectors[q]
        products[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-products, kind="stable")[:20].tolist()))
        compared += int(np.isin(leaf, seen["tree"].ranked_leaves(vectors[q], seen["n"])).sum())
    print(f"recall {hits / (20 * len(fresh)):.3f}, rows compared {compared / (len(fresh) * len(rows)):.3f}")
    assert hits >= 0.9 * 20 * len(fresh)
    assert compared < 0.5 * len(fresh) * len(rows)


def test_vector_search(spark):
    rows = table(spark, SF, "embeddings")
    odd = spark.createDataFrame(
        [(2000, None), (2020, [0.0] * 64), (2040, [float("nan")] * 64), (2060, [None] * 64), (2080, [1.0]), (None, [1.0] * 64)],
        "vec_id long, embedding array<float>",
    )
    copies = rows.filter("vec_id = 40").select(F.explode(F.sequence(F.lit(3041).cast("long"), F.lit(3440).cast("long"))).alias("vec_id"), "embedding")
    both = rows.select("vec_id", "embedding").unionByName(odd).unionByName(copies)
    given = {r["vec_id"]: np.array(r["embedding"], float) for r in rows.unionByName(copies.withColumn("label", F.lit(0))).select("vec_id", "embedding").collect()}
    found = {}
    for r in search(both, F.col("vec_id") % 20 == 0, 20).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in given if i % 20 == 0}
    names = np.array(sorted(given))
    matrix = np.stack([given[i] for i in names])
    hits = 0
    for q, got in found.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, 21)) and q not in {g[1] for g in got}
        scores = (matrix * given[q]).sum(axis=1)
        assert all(g[2] == scores[np.flatnonzero(names == g[1])[0]] for g in got)
        others = names != q
        best = names[others][np.lexsort((names[others], -scores[others]))[:20]]
        hits += len(set(best.tolist()) & {g[1] for g in got})
        if q == 40:
            assert [g[1] for g in got] == best.tolist()  # ties go to the smaller id
    assert hits / (20 * len(found)) >= 0.9
    assert search(both.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert search(both.filter("vec_id <= 6"), F.col("vec_id") % 20 == 0, 20).count() == 6
