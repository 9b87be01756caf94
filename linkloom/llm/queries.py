"""The ``opN_*`` queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import (
    bpe_codec,
    chat_format,
    common,
    exact_dedup,
    fertility,
    language_id,
    mixing,
    quality,
    simhash,
    token_store,
    url_filter,
)

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = quality.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
VOCABULARIES = (PIECES, BYTES)
END_ID = 2

URL_RULES = {
    "com/en/": "block",
    "example.com/en/7": "allow",
    "net/de/": "allow",
    "example.net/de/8": "block",
    "org/es/": "block",
}

#: Target weights of the mix; sources not named share weight MIX_REST.
MIX_WEIGHTS = (
    {"src0": 5}
    | {f"src{i}": 3 for i in range(1, 5)}
    | {f"src{i}": 2 for i in range(5, 10)}
    | {f"src{i}": 1 for i in range(10, 20)}
)
MIX_REST, MIX_BLOCK = 1, 32


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """Learnt from labels whose id is not held out."""
    labels = common.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality.fit(docs, labels.filter(common.bucket_of(F.col("doc_id"), 3) != 1), BYTES)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(common.table(spark, sf_dir, "pages"), URL_RULES, keep=["page_id"])


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, MIX_WEIGHTS, MIX_REST, MIX_BLOCK)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_path(spark, "tokens")
    token_store.write_tokens(common.table(spark, sf_dir, "documents"), path, VOCABULARY, END_ID)
    return token_store.read_documents(spark, path)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.table(spark, sf_dir, "documents"), keep=["doc_id"])


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat_format.read_back(common.written(chat_format.format_conversations(rows.union(own)), "chat"))


def op6_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    labels = common.table(spark, sf_dir, "labels").filter(common.bucket_of(F.col("doc_id"), 3) != 1)
    measured = common.written(fertility.measures(docs, VOCABULARIES, keep=["doc_id"]), "measures")
    return fertility.judge_from(measured, VOCABULARIES, fertility.learn_from(measured, VOCABULARIES, labels), ["doc_id"])


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(common.table(spark, sf_dir, "documents"), keep=["doc_id"])


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(common.bucket_of(F.col("doc_id"), 4) != 2))
    found = language_id.identify(docs, model, keep=["doc_id"])
    return found.select(
        "doc_id", (common.bucket_of(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return bpe_codec.bpe_encode(docs, VOCABULARY, keep=["doc_id"], with_ids=False)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_model(spark, docs, sf_dir), keep=["doc_id"])
    return scored.select(
        "doc_id", (common.bucket_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted"
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_mix_sources,
        op3_token_files,
        op4_simhash_near_dedup,
        op5_chat_format,
        op6_fertility_rules,
        op7_exact_dedup,
        op8_language_id,
        op9_bpe_codec,
        op10_quality_classifier,
    )
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _escaped(c: str) -> str:
    controls = "|".join(re.escape(x[1:]) for x in chat_format.CONTROL)
    return f"regexp_replace(replace({c}, '\\', '\\\\'), '([<\\[])({controls})', '\\1\\\\\\2', 'g')"


_MARKS = len(chat_format.START) + len(chat_format.END) + 2

ORACLES = {
    # Roles have neither control strings nor backslashes or line ends.
    "op5_chat_format": f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(role) + length({_escaped('text')}) + {_MARKS})::BIGINT AS formatted_chars
        FROM rows GROUP BY conv_id""",
    "op7_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWERED} AS norm FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM d""",
    # One pass over all slots, where the operator schedules each round apart.
    "op2_mix_sources": f"""
        WITH RECURSIVE weights(pool, a) AS (
            VALUES {", ".join(f"('{s}', {w})" for s, w in MIX_WEIGHTS.items())}, ('{mixing.POOL}', {MIX_REST})
        ), placed AS (
            SELECT d.doc_id, d.source, coalesce(w.pool, '{mixing.POOL}') AS pool
            FROM documents d LEFT JOIN weights w ON d.source = w.pool
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY pool ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS place
            FROM placed
        ), pools AS (
            SELECT pool, any_value(a) AS a, (count(*) + {MIX_BLOCK - 1}) // {MIX_BLOCK} AS n
            FROM placed JOIN weights USING (pool) GROUP BY pool
        ), served AS (
            SELECT p.pool, any_value(p.a) AS a, any_value(p.n) AS n, k.k,
                   sum(least(q.a * k.k, q.n * p.a))::BIGINT AS served
            FROM pools p, LATERAL (SELECT unnest(range(p.n + 1)) AS k) k, pools q GROUP BY p.pool, k.k
        ), blocks AS (
            SELECT x.pool, x.k, x.served // x.a AS release, (y.served + x.a - 1) // x.a AS deadline
            FROM served x JOIN served y ON x.pool = y.pool AND y.k = x.k + 1 WHERE x.k < x.n
        ), run AS (
            SELECT 0::BIGINT AS slot, pool, 0::BIGINT AS k FROM pools
            UNION ALL
            SELECT slot + 1, pool, k + (pool = pick)::BIGINT
            FROM (
                SELECT r.slot, r.pool, r.k, first_value(r.pool) OVER (ORDER BY
                    CASE WHEN b.release <= r.slot THEN b.deadline END NULLS LAST, r.pool) AS pick
                FROM run r LEFT JOIN blocks b ON r.pool = b.pool AND r.k = b.k
            ) WHERE slot < (SELECT sum(n) FROM pools)
        ), slots AS (SELECT pool, k, max(slot) AS slot FROM run GROUP BY pool, k)
        SELECT r.doc_id, r.source, r.pool, b.k AS block, b.release, b.deadline, s.slot,
               s.slot * {MIX_BLOCK} + r.place % {MIX_BLOCK} AS position
        FROM ranked r
        JOIN blocks b ON r.pool = b.pool AND r.place // {MIX_BLOCK} = b.k
        JOIN slots s ON s.pool = b.pool AND s.k = b.k""",
}
