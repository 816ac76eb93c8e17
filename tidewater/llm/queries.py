"""The queries over the given tables, and the SQL that checks them where SQL can express them."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidewater.session import prepare, table

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under its own name."""

    def register(fn):
        def run(spark, sf_dir):
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql:
            ORACLE[fn.__name__] = sql
        return run

    return register


@query(
    """
    WITH d AS (
      SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents
    ), r AS (
      SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size,
             row_number() OVER (PARTITION BY text_sha256, doc_id) AS copy
      FROM d
    )
    SELECT doc_id, keep_id, group_size, (doc_id IS NOT DISTINCT FROM keep_id AND copy = 1) AS kept, text_sha256 FROM r
    """
)
def op7_exact_dedup(spark, sf_dir):
    from tidewater.llm.exact_dedup import deduplicate

    return deduplicate(table(spark, sf_dir, "documents"))


@query()
def op10_token_counts(spark, sf_dir):
    from tidewater.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query()
def op2_byte_bpe(spark, sf_dir):
    from tidewater.llm.byte_bpe import decode, encode

    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = decode(encode(table(spark, sf_dir, "documents"), *vocabulary), *vocabulary)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op1_best_fit_packing(spark, sf_dir):
    from tidewater.llm.packing import pack, token_pieces

    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(digests)


@query()
def op5_language_id(spark, sf_dir):
    from tidewater.llm.language_id import held_out, identify, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out(docs)).select("text", "lang"))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(found).alias("held_out"), "lang_pred", "score", "rejected")


@query()
def op9_toxicity(spark, sf_dir):
    from tidewater.llm.toxicity import held_out, score, train

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    classifier = train(docs.filter(~held_out()), labels.filter(~held_out()))
    return score(docs, classifier).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query()
def op8_nearest_vectors(spark, sf_dir):
    from tidewater.llm.vector_search import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query()
def op3_substring_dedup(spark, sf_dir):
    from tidewater.llm.substring_dedup import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op6_jaccard_join(spark, sf_dir):
    from tidewater.llm.jaccard_join import similar_documents

    return similar_documents(table(spark, sf_dir, "documents"), n=5, percent=75)


@query()
def op4_context_tree(spark, sf_dir):
    from tidewater.llm.context_tree import held_out, score_texts

    return score_texts(table(spark, sf_dir, "documents"), held_out())


@query(
    r"""
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS shuffle
      FROM documents
    ), s AS (
      SELECT *, [5, 2, 1][1 + (turn - 1) % 3] AS weight, 2 * source_size AS most, 2 * source_size / weight AS fills_at
      FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS turn
            FROM d GROUP BY source)
    ), f AS (
      SELECT *, sum(most) OVER w + fills_at * (sum(weight) OVER () - sum(weight) OVER w) <= 1.5::DOUBLE * sum(source_size) OVER () AS is_full,
             1.5::DOUBLE * sum(source_size) OVER () AS budget
      FROM s WINDOW w AS (ORDER BY fills_at, turn)
    ), t AS (
      SELECT *, CASE WHEN is_full THEN most::DOUBLE ELSE weight *
               ((budget - coalesce(sum(most) FILTER (is_full) OVER (), 0)) / sum(weight) FILTER (NOT is_full) OVER ()) END AS target
      FROM f
    ), q AS (
      SELECT row_number() OVER () AS rid, doc_id, size, source_size, turn, target, budget,
             sum(size) OVER (PARTITION BY turn ORDER BY shuffle, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    ), e AS (
      SELECT rid, size, budget, sum(size) OVER (ORDER BY (start + p * source_size + size)::DOUBLE / target, turn, start + p * source_size
                                                ROWS UNBOUNDED PRECEDING) AS upto
      FROM q, (VALUES (0), (1)) AS passes(p) WHERE size > 0
    ), m AS (SELECT rid, sum(size) AS taken FROM e WHERE upto <= budget GROUP BY rid)
    SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM q LEFT JOIN m USING (rid)
    """
)
def op11_source_mixing(spark, sf_dir):
    from tidewater.llm.source_mixing import schedule

    return schedule(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query(
    r"""
    WITH p AS (
      SELECT lang, row_number() OVER () AS piece_id, piece
      FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents)
    ), o AS (
      SELECT lang, piece_id, unnest(ws) AS w1, generate_subscripts(ws, 1) AS pos
      FROM (SELECT lang, piece_id, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p)
    ), g AS (
      SELECT lang, w1, lead(w1, 1) OVER x AS w2, lead(w1, 2) OVER x AS w3, lead(w1, 3) OVER x AS w4
      FROM o WINDOW x AS (PARTITION BY piece_id ORDER BY pos)
    ), f AS (
      SELECT lang, [w1] AS ws, count(*) AS f FROM g GROUP BY lang, w1
      UNION ALL SELECT lang, [w1, w2], count(*) FROM g WHERE w2 IS NOT NULL GROUP BY lang, w1, w2
      UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM g WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3
      UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM g WHERE w4 IS NOT NULL GROUP BY lang, w1, w2, w3, w4
    ), c AS (
      SELECT lang, ws, f AS a, len(ws) AS m FROM f WHERE f >= 30 AND len(ws) > 1
    ), held AS (
      SELECT lang, ws, max(a) AS most
      FROM (SELECT lang, ws[i:j] AS ws, a FROM c, range(1, 4) AS s(i), range(2, 5) AS t(j) WHERE i < j AND j <= m AND j - i + 1 < m)
      GROUP BY lang, ws
    ), k AS (
      SELECT c.* FROM c LEFT JOIN held USING (lang, ws) WHERE most IS NULL OR 100 * most < 80 * a
    ), cuts AS (
      SELECT k.lang, k.ws, a, i, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f) AS score
      FROM k, range(1, 4) AS s(i), f AS l, f AS r
      WHERE i < m AND l.lang = k.lang AND l.ws = k.ws[1:i] AND r.lang = k.lang AND r.ws = k.ws[i + 1:m]
    ), lowest AS (
      SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score
      FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, i) = 1
    ), n AS (SELECT lang, count(*) AS n FROM o GROUP BY lang)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM lowest JOIN n USING (lang) QUALIFY rank <= 2000
    """
)
def op12_phrase_mining(spark, sf_dir):
    from tidewater.llm.phrases import mine

    return mine(table(spark, sf_dir, "documents"), longest=4, least=30, covered=80, top=2000)


@query()
def op13_embedding_whitening(spark, sf_dir):
    from tidewater.llm.whitening import fit, transform

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(vectors, components=4)
    rows = transform(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(v) for v in model.explained]).cast("array<double>")
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
