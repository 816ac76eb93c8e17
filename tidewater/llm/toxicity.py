"""Toxicity by weak supervision.

1. Cues: words and word beginnings that the labelled training rows tie to one
   label, by log odds with enough support, from a bounded sample of those rows.
2. Voters: lexicons of cues and surface patterns; each fires on a text or not.
3. Label model: a generative model of label and votes. Expectation maximisation
   over all training rows (as counts of vote patterns, of which there are at
   most two to the number of voters) estimates the prior, each voter's rates
   under either label, and the correlations between voters given the label.
   Correlated voters share their weight.
4. Classifier: logistic regression on the cues a text holds, trained on
   posterior labels (the voters' posterior with the given label as one more
   voice), scores every text.

Defined results: NULL and empty texts hold no cue and get the score of such a
text; without any label the score is 0; repeated rows and NULL ids pass
through; rows with a NULL label are not learned from; an id labelled more than
once counts as toxic if one of its labels says so; an empty table gives no rows.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Memo, crc_fold, small_batches, whole_text
from tidewater.session import materialise

SAMPLE = 12_000  # labelled training rows the cues and the classifier are learned from
LEXICONS, LEXICON_CUES = 6, 20  # lexicon voters, cues in each
CUES = 600  # cues per label the classifier sees
SUPPORT, ODDS = 8, 1.0  # rows a cue must be in, least log odds
EVIDENCE = 40.0  # least log-likelihood ratio of a cue in a lexicon
TRUST = 0.97  # how often a given label is right, as one more voice beside the voters
PREFIXES = (3, 4, 5, 6, 7)
MANY = (2, 3, 5)  # words with one beginning that make a cue of their own
ROUNDS = 30
LIMIT = 0.3

_WORDS = re.compile(r"[^\W\d_]+").findall
# Surface patterns; each is one voter.
PATTERNS = {
    "shouting": re.compile(r"(?:[A-Z]{3,}\W+){4}").search,
    "exclaiming": lambda text: text.count("!") >= 4,
    "censored": re.compile(r"\w[*#@$]{2}").search,
}


def word_cues(word: str) -> list[str]:
    """The word and its beginnings."""
    return [word, *(f"{word[:n]}~" for n in PREFIXES if len(word) > n)]


def text_words(text: str) -> set[str]:
    return set(_WORDS(text.lower()))


def counted(cues: Iterable[str]) -> Iterator[str]:
    """The cues of all words of a text, and those that several words share with their count."""
    for cue, n in Counter(cues).items():
        yield cue
        if n > 1:
            yield from (f"{cue}{many}" for many in MANY if n >= many)


@dataclass
class Voters:
    """Lexicons (cue to voters that hold it) and the surface patterns."""

    cues: dict[str, int]  # cue to its lexicon
    names: list[str]

    def fire(self, text: str, held: set[str]) -> int:
        """The votes as a bit pattern; ``held`` are the cues of the text."""
        lexicons = [self.cues[c] for c in held if c in self.cues]
        votes = 0
        for k in lexicons:
            votes |= 1 << k
        if len(lexicons) >= 2:
            votes |= 1 << LEXICONS
        if not lexicons:
            votes |= 1 << (LEXICONS + 1)
        for k, pattern in enumerate(PATTERNS.values()):
            if pattern(text):
                votes |= 1 << (LEXICONS + 2 + k)
        return votes


@dataclass
class LabelModel:
    """P(label), P(voter fires | label), the correlations given the label, the voters' weights."""

    prior: float
    rates: np.ndarray  # voters x labels
    correlations: np.ndarray
    weights: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic) of each row of votes (0 or 1 per voter)."""
        log = votes @ (self.weights[:, None] * np.log(self.rates)) + (1 - votes) @ (self.weights[:, None] * np.log1p(-self.rates))
        gap = log[:, 1] - log[:, 0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(gap, -60, 60)))


def fit_label_model(votes: np.ndarray, free: np.ndarray, labelled: np.ndarray) -> LabelModel:
    """Expectation maximisation over vote patterns.

    ``votes`` has a row per pattern; ``free`` counts rows without a label and
    ``labelled`` rows with label 0 and 1, which anchor the model.
    """
    n = votes.shape[1]
    known = labelled.sum(axis=0)
    prior = float((known[1] + 1) / (known.sum() + 2))
    rates = np.stack([(votes.T @ labelled[:, y] + 0.5) / (known[y] + 1) for y in (0, 1)], axis=1)
    model = LabelModel(prior, np.clip(rates, 1e-4, 1 - 1e-4), np.eye(n), np.ones(n))
    for _ in range(ROUNDS):
        toxic = model.posterior(votes)
        mass = np.stack([free * (1 - toxic) + labelled[:, 0], free * toxic + labelled[:, 1]], axis=1)
        total = mass.sum(axis=0)
        rates = np.clip((votes.T @ mass + 0.5) / (total + 1), 1e-4, 1 - 1e-4)
        # correlations left between voters once the label is known
        covariance = np.zeros((n, n))
        for y in (0, 1):
            rest = votes - rates[:, y]
            covariance += (rest * mass[:, y : y + 1]).T @ rest
        spread = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
        correlations = covariance / np.outer(spread, spread)
        shared = np.abs(correlations) - np.eye(n)
        weights = 1 / (1 + np.where(shared > 0.1, shared, 0).sum(axis=1))
        new = LabelModel(float((total[1] + 1) / (total.sum() + 2)), rates, correlations, weights)
        done = abs(new.prior - model.prior) < 1e-6 and np.abs(new.rates - model.rates).max() < 1e-5
        model = new
        if done:
            break
    return model


@dataclass
class Classifier:
    """Weight of each cue and the bias."""

    weights: dict[str, float]
    bias: float

    def score(self, held: set[str]) -> float:
        z = self.bias + sum(self.weights[c] for c in held)
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def fit_classifier(rows: list[tuple[list[int], float, int]], cues: list[str]) -> Classifier:
    """Logistic regression on (cues held, posterior, how many rows)."""
    weights, bias = np.zeros(len(cues)), 0.0
    which = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    column = np.array([c for r in rows for c in r[0]], np.int64)
    target, count = np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float)
    count /= count.sum()
    # Adam over the whole sample; the squared weights keep rare cues small
    state = np.zeros((2, len(cues) + 1))
    for step in range(1, 401):
        z = bias + np.bincount(which, weights[column], len(rows))
        error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - target) * count
        slope = np.append(np.bincount(column, error[which], len(cues)) + 1e-5 * weights, error.sum())
        state[0] = 0.9 * state[0] + 0.1 * slope
        state[1] = 0.999 * state[1] + 0.001 * slope**2
        move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-9)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Classifier(dict(zip(cues, weights.tolist())), float(bias))


_memos: dict[int, tuple] = {}


def _held_by(cues: dict) -> tuple:
    """The worker's memo of words to the cues in them (for these cues)."""
    key = hash(frozenset(cues))
    if key not in _memos:
        _memos.clear()
        stems = {c.rstrip("0123456789") for c in cues}
        _memos[key] = Memo(300_000), lambda words: (tuple(c for c in word_cues(w) if c in stems) for w in words)
    return _memos[key]


def cues_of(text: str, cues: dict) -> set[str]:
    """The cues that a text holds."""
    memo, make = _held_by(cues)
    words = text_words(text)
    known = memo.learn(words, make)
    return {c for c in counted(c for w in words for c in known[w]) if c in cues}


def mine_cues(sample: DataFrame) -> tuple[list[tuple[str, float]], list[tuple[str, float]]]:
    """Toxic cues and clean cues with their evidence, strongest first, from rows of (text, toxic).

    Each task counts its rows before the shuffle; the strongest are found by Spark.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(), Counter()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts[toxic].update(counted(c for w in text_words(text) for c in word_cues(w)))
            cues = list(counts[0] | counts[1])
            n = [pa.array([c[x] for x in cues], pa.int64()) for c in counts]
            yield pa.RecordBatch.from_arrays([pa.array(cues, pa.string()), *n], names=["cue", "clean", "toxic"])

    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    per_cue = sample.mapInArrow(count, "cue string, clean long, toxic long").groupBy("cue").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    n = {"clean": totals.get(0, 0) + 1.0, "toxic": totals.get(1, 0) + 1.0}
    held = {y: F.col(y) + 0.5 for y in n}
    share = (held["clean"] + held["toxic"]) / (n["clean"] + n["toxic"])
    odds = F.log(held["toxic"] / n["toxic"]) - F.log(held["clean"] / n["clean"])
    # log-likelihood ratio of two rates against one
    evidence = sum(
        2 * (h * F.log(h / (n[y] * share)) + (n[y] - h) * F.log(F.greatest((n[y] - h) / (n[y] * (1 - share)), F.lit(1e-9))))
        for y, h in held.items()
    )
    scored = per_cue.filter((F.col("clean") + F.col("toxic") >= SUPPORT) & (share < 1)).select(
        "cue", odds.alias("odds"), evidence.alias("evidence")
    )
    scored = materialise(scored.filter(F.abs("odds") > ODDS), "cues")
    toxic = scored.filter(F.col("odds") > ODDS).orderBy(F.desc("evidence"), "cue").limit(CUES)
    clean = scored.filter(F.col("odds") < -ODDS).orderBy(F.desc("evidence"), "cue").limit(CUES)
    found = [(r["cue"], r["evidence"], r["odds"] > 0) for r in toxic.unionAll(clean).collect()]
    return [(c, e) for c, e, is_toxic in found if is_toxic], [(c, e) for c, e, is_toxic in found if not is_toxic]


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    spark = docs.sparkSession
    small_batches(spark)
    label = labels.filter("toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    texts = docs.select("doc_id", whole_text().alias("text"))
    # By hash of the id, so that the draw is the same on every run; at most SAMPLE ids are broadcast.
    known = docs.select("doc_id").join(label, "doc_id").distinct()
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = materialise(texts.join(F.broadcast(drawn), "doc_id").select("text", "toxic"), "sample")
    toxic, clean = mine_cues(sample)
    if not toxic:
        return Classifier({}, -60.0)
    chosen = [c for c, evidence in toxic[: LEXICONS * LEXICON_CUES] if evidence >= EVIDENCE] or [toxic[0][0]]
    names = [*(f"lexicon{k}" for k in range(LEXICONS)), "two cues", "no cue", *PATTERNS]
    voters = Voters({c: i % LEXICONS for i, c in enumerate(chosen)}, names)
    everything = {c: i for i, (c, _) in enumerate([*toxic, *clean])}

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = [voters.fire(t, cues_of(t, everything)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(votes, pa.int32())], names=["doc_id", "votes"])

    # Counts per pattern over all training rows: at most 2 ** voters times three rows.
    kind = docs.schema["doc_id"].dataType.simpleString()
    cast = texts.mapInArrow(vote, f"doc_id {kind}, votes int").join(label.hint("merge"), "doc_id", "left")
    patterns: dict[int, list[int]] = {}
    for r in cast.groupBy("votes", "toxic").count().collect():
        patterns.setdefault(r["votes"], [0, 0, 0])[2 if r["toxic"] is None else r["toxic"]] += r["count"]
    order = sorted(patterns)
    matrix = np.array([[v >> k & 1 for k in range(len(names))] for v in order], float)
    counts = np.array([patterns[v] for v in order], float)
    model = fit_label_model(matrix, counts[:, 2], counts[:, :2])
    posterior = dict(zip(order, model.posterior(matrix).tolist()))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                held = cues_of(t, everything)
                given = TRUST if toxic else 1 - TRUST
                p = posterior[voters.fire(t, held)]
                out.append((sorted(everything[c] for c in held), p * given / (p * given + (1 - p) * (1 - given))))
            columns = list(zip(*out)) or [[], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.list_(pa.int32())), pa.array(columns[1], pa.float64())], names=["held", "posterior"]
            )

    found = sample.mapInArrow(features, "held array<int>, posterior double")
    rows = found.groupBy("held", "posterior").count().collect()  # at most the sample
    rows = sorted((list(r["held"]), r["posterior"], r["count"]) for r in rows)
    return fit_classifier(rows, list(everything))


def score(docs: DataFrame, classifier: Classifier, limit: float = LIMIT) -> DataFrame:
    """doc_id, score and predicted (1 from ``limit`` on) of every row."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [classifier.score(cues_of(t, classifier.weights)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    scored = docs.select("doc_id", whole_text().alias("text")).mapInArrow(scores, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= limit).cast("int"))


def held_out() -> Column:
    """Rows kept out of training: fold 2 of 4 of the id."""
    return crc_fold("doc_id", 4) == 2
