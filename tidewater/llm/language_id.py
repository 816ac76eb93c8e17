"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are the runs of two to four bytes of its lower-cased letters,
hashed into a fixed number of buckets. Their embeddings are averaged and a
linear softmax names the language. Embeddings and softmax are trained together
by stochastic gradient descent in numpy on a bounded sample of labelled rows
(``SAMPLE`` per language, by hash of the text), each whole and as a short
piece. A part of the sample is held back to fit the temperature, so that the
score is a calibrated probability, and the limit below which a text is rejected.

Defined results: NULL texts and texts without a letter are ``und`` with score 0
and rejected; with no labelled row every text is ``und``; repeated rows and
NULL ids pass through; an empty table gives no rows; other columns are unused;
texts of any length are read whole; of equally likely languages the first by
name is given; more than ``MAX_LANGUAGES`` labels fail.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import Memo, crc_fold, fresh_name, small_batches, tidy
from tidewater.session import materialise

SAMPLE = 500  # labelled rows per language to learn from
BITS, WIDTH = 15, 16  # buckets (as a power of two) and numbers per embedding
EPOCHS, BATCH, RATE = 8, 64, 0.5
PIECE = 60  # characters of the short piece of a sampled text
REJECTED = 0.002  # share of the calibration texts that may be rejected

UNKNOWN = "und"
# More labels than this are no languages; the model and its sample grow with them.
MAX_LANGUAGES = 1000
_WORDLIKE = re.compile(r"[^\W\d_]")
# ASCII other than letters becomes a space; bytes of longer characters stay.
_LETTERS_ONLY = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """Whether a text has a letter; fractions, powers and the like are none."""
    return any(found.group().isalpha() for found in _WORDLIKE.finditer(text))


def buckets(text: str) -> np.ndarray:
    """The bucket of every subword of a text."""
    data = np.frombuffer(b" %b " % b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS_ONLY).split()), np.uint8)
    codes, out = data.astype(np.uint32), []
    for n in (2, 3, 4):
        if len(data) < n:
            break
        codes = (codes[:-1] << np.uint32(8)) | data[n - 1 :]
        out.append(((codes + np.uint32(n * 0x1F123BB5)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


@dataclass
class Model:
    """Languages, each bucket's contribution to their logits, temperature and limit of rejection."""

    languages: list[str]
    logits: np.ndarray  # buckets x languages: the embeddings times the softmax weights
    bias: np.ndarray
    temperature: float
    limit: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, probability, whether the text is rejected."""
        if not self.languages or text is None or not has_letter(text):
            return UNKNOWN, 0.0, True
        found = buckets(text)
        z = (np.take(self.logits, found, axis=0).mean(axis=0, dtype=np.float64) + self.bias) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.limit)


def _sample(docs: DataFrame, label: str) -> list[tuple[str, bool, np.ndarray, np.ndarray]]:
    """(language, for calibration, buckets, shares) of the sampled texts: at most two rows each."""
    rows = docs.filter(F.col("text").isNotNull() & F.col(label).isNotNull()).select(
        F.col(label).cast("string").alias("lang"), "text", F.xxhash64("text").alias("order")
    )
    # A few times the wanted number by the size of the hash, which needs no shuffle of texts; copies
    # of a text count once, in the share too, or a language of copies would give too few; then exactly
    # the wanted number.
    texts = rows.select("lang", "order").distinct()
    share = texts.groupBy("lang").agg((F.lit(4.0 * SAMPLE) / F.count(F.lit(1))).alias("share"))
    spread = F.pmod(F.hash("order"), F.lit(1 << 30)) / float(1 << 30)
    share = materialise(share, "share")
    if (labels := share.count()) > MAX_LANGUAGES:
        raise ValueError(f"{labels} labels are more than the {MAX_LANGUAGES} languages the model may have")
    some = rows.join(share, "lang").filter(spread < F.col("share")).drop("share")
    nth = Window.partitionBy("lang").orderBy("order")
    once = some.dropDuplicates(["lang", "order"])
    drawn = once.withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") <= SAMPLE)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text, order in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "order"))):
                at = order % max(1, len(text) - PIECE)
                for part in (text, text[at : at + PIECE]):
                    if has_letter(part):
                        found, n = np.unique(buckets(part), return_counts=True)
                        shares = (n / n.sum()).astype(np.float32)
                        out.append((lang, order % 5 == 0, found.astype(np.uint16).tobytes(), shares.tobytes()))
            columns = list(zip(*out)) or [[], [], [], []]
            kinds = (pa.string(), pa.bool_(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "held", "found", "shares"])

    # Small: SAMPLE texts a language, each at most 2**BITS buckets.
    found = drawn.select("lang", "text", "order").mapInArrow(vectors, "lang string, held boolean, found binary, shares binary")
    rows = sorted(found.collect(), key=lambda r: (r["lang"], bytes(r["found"]), bytes(r["shares"])))
    return [(r["lang"], r["held"], np.frombuffer(r["found"], np.uint16), np.frombuffer(r["shares"], np.float32)) for r in rows]


def train(docs: DataFrame, label: str = "lang") -> Model:
    """Fit the model on the labelled rows of ``docs``."""
    small_batches(docs.sparkSession)
    sample = _sample(docs, label)
    languages = sorted({lang for lang, *_ in sample})
    size = 1 << BITS
    if not languages:
        return Model([], np.zeros((size, 0), np.float32), np.zeros(0), 1.0, 1.0)
    target = np.array([languages.index(lang) for lang, *_ in sample])
    held = np.array([h for _, h, *_ in sample])
    if held.all() or len(set(target[~held])) < len(languages):
        held[:] = False
    random = np.random.default_rng(11)
    embed = random.normal(0, 0.1, (size, WIDTH)).astype(np.float32)
    weight = random.normal(0, 0.1, (WIDTH, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)

    def dense(which: np.ndarray) -> np.ndarray:
        x = np.zeros((len(which), size), np.float32)
        for row, i in enumerate(which):
            x[row, sample[i][2]] = sample[i][3]
        return x

    def softmax(z: np.ndarray) -> np.ndarray:
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    fit = np.flatnonzero(~held)
    share = np.bincount(target[fit], minlength=len(languages))
    balance = (len(fit) / (len(languages) * np.maximum(share, 1))).astype(np.float32)
    for epoch in range(EPOCHS):
        order = random.permutation(fit)
        rate = RATE * (1 - epoch / EPOCHS)
        for i in range(0, len(order), BATCH):
            which = order[i : i + BATCH]
            x, t = dense(which), target[which]
            mean = x @ embed
            error = softmax(mean @ weight + bias)
            error[np.arange(len(which)), t] -= 1
            error *= balance[t][:, None]
            to_embed = x.T @ (error @ weight.T)
            weight -= rate * mean.T @ error / len(which) * 10
            bias -= rate * error.mean(axis=0)
            embed -= rate * to_embed * (size / 256 / len(which))
    logits = embed @ weight
    check = np.flatnonzero(held) if held.any() else fit
    z = np.stack([sample[i][3] @ logits[sample[i][2]] for i in check]) + bias
    own = np.arange(len(check)), target[check]
    losses = {t: -np.log(softmax(z / t)[own] + 1e-12).mean() for t in np.geomspace(0.05, 20, 60)}
    temperature = float(min(losses, key=losses.get))
    sure = softmax(z / temperature).max(axis=1)
    limit = min(0.5, float(np.quantile(sure, REJECTED)))
    return Model(languages, logits.astype(np.float32), bias, temperature, limit)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score and rejected in place of any columns of these names."""
    small_batches(docs.sparkSession)
    added = ["lang_pred", "score", "rejected"]
    kept = [c for c in docs.columns if c.lower() not in added]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by BITS and the languages

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Memo.forget()
        for batch in batches:
            found = [shared.value.predict(text) for text in batch.column("text").to_pylist()]
            columns = list(zip(*found)) or [[], [], []]
            values = [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *values], names=[*kept, *added])

    own = docs.select(*kept)
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return own.mapInArrow(tidy(predict), schema)


def held_out(docs: DataFrame) -> Column:
    """Rows kept out of training: fold 2 of 4 of the id."""
    return crc_fold("doc_id", 4) == 2


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    mark = fresh_name(docs, "_rejected")
    names = [fresh_name(docs, f"_c{i}") for i in range(len(docs.columns))]
    if "text" not in docs.columns:
        raise ValueError("documents need a text column")
    # columns travel under other names, so that clashes with the added ones do no harm
    plain = docs.select(*[F.col(c).alias(c if c == "text" else n) for c, n in zip(docs.columns, names)])
    marked = identify(plain, model).withColumnRenamed("rejected", mark).filter(~F.col(mark))
    return marked.select(*[F.col(c if c == "text" else n).alias(c) for c, n in zip(docs.columns, names)])
