"""Token counts: batch encoding that returns lengths only.

Texts are cut at safe boundaries (see ``common.chunks``); the chunks a worker
has not met yet are encoded in batches of equal bytes, and a document's count
is the sum over its chunks. What a worker remembers is bounded and never
changes a count.

Defined results: NULL text counts as the empty text (0 bytes, 0 tokens); ids,
repeated rows and other columns pass through untouched; an empty table gives
no rows; texts of any length are counted whole.
"""
from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Memo, byte_batches, chunks, small_batches, whole_text

# Characters per call of the tokenizer, and chunks a worker remembers.
ENCODE_CHARS = 1 << 18
REMEMBERED = 300_000

_encoders: dict[str, tuple] = {}


def _encoder(path: str) -> tuple:
    """The worker's tokenizer (texts to lengths) and what it remembers."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            encode = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]
        _encoders[path] = encode, Memo(REMEMBERED)
    return _encoders[path]


def text_lengths(texts: list[str], path: str) -> list[int]:
    """Tokens of each text."""
    encode, memo = _encoder(path)
    balanced = lambda items: (n for batch in byte_batches(items, ENCODE_CHARS) for n in encode(batch))
    if path.endswith(".model"):  # sentencepiece marks the start of a text, so texts are not cut
        return list(balanced(texts))
    parts = [chunks(text) for text in texts]
    known = memo.learn(set().union(*parts), balanced)
    return [sum(map(known.__getitem__, p)) for p in parts]


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``.

    ``path`` names the tokenizer's file: ``.json`` for tokenizers, ``.model``
    for sentencepiece. It must exist on every executor.
    """
    small_batches(docs.sparkSession)

    def lengths(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = batch.column("text").to_pylist()
            counts = pa.array(text_lengths(texts, path), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), counts], names=["doc_id", "n_bytes", "n_tokens"]
            )

    rows = docs.select("doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), whole_text().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(lengths, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
