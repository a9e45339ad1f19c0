"""One query per operator over the whole of its table, in the form that its contract fixes."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import bpe_decode, bpe_encode
from tidemark.llm.common import ascii_lower, text_of
from tidemark.llm.exact_dedup import exact_groups
from tidemark.llm.filter_audit import audit, mask_cells
from tidemark.llm.hard_negatives import hard_negatives
from tidemark.llm.hmm import hmm_scores
from tidemark.llm.mixing import mix
from tidemark.llm.passages import repeated_passages
from tidemark.llm.pii import KINDS, find_pii, train_tagger
from tidemark.llm.quality import BASE, MEASURES, STRICT, fails, quality_ledger
from tidemark.llm.sharding import histogram_shards
from tidemark.llm.simhash import simhash_components
from tidemark.llm.toxicity import toxicity_scores, train_toxicity
from tidemark.llm.url_filter import judge_urls
from tidemark.session import cut

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of one table; ``table`` names it, the file is read by Spark."""

    def register(fn: Callable[..., DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder(id_column: str, parts: int) -> Column:
    """A fixed part of an id: the checksum of its digits modulo ``parts``."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


@query("op1_hidden_markov")
def op1_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    return hmm_scores(table(spark, folder, "documents"), remainder("doc_id", 10) == 0)


#: The rules of the query: a host with its subdomains, and the beginning of the path.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query("op2_link_propagation")
def op2_link_propagation(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), URL_RULES)


def tokenizer_file(path: str | None = None) -> str:
    """The content of a tokenizer file, by default the byte-level vocabulary of 50,257 tokens."""
    return Path(path or public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")


@query("op3_bpe_transducer")
def op3_bpe_transducer(spark: SparkSession, folder: str) -> DataFrame:
    definition = tokenizer_file()
    tokens = bpe_encode(table(spark, folder, "documents").select("doc_id", "text"), definition).drop("text")
    return bpe_decode(tokens, definition).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op4_positive_unlabelled")
def op4_positive_unlabelled(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    learnt = remainder("doc_id", 3) != 1
    weights = train_toxicity(docs.filter(learnt), labels.filter(learnt))
    return toxicity_scores(docs, weights).select(
        "doc_id", (~learnt).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query("op5_pfair_mixing")
def op5_pfair_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents").select("doc_id", "source"))


@query("op6_simhash_tiles")
def op6_simhash_tiles(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_components(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query(
    "op7_exact_dedup",
    """
    WITH t AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
    FROM t WINDOW g AS (PARTITION BY body)
    """,
)
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    narrow = docs.select("doc_id", "text", F.sha2(ascii_lower(text_of("text")), 256).alias("text_sha256"))
    return exact_groups(narrow, carried=["doc_id", "text_sha256"])


@query("op8_histogram_shards")
def op8_histogram_shards(spark: SparkSession, folder: str) -> DataFrame:
    return histogram_shards(table(spark, folder, "documents"))


@query("op9_paragraph_minhash")
def op9_paragraph_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))


@query(
    "op10_quality_rules",
    """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
    w AS (
        SELECT doc_id, body, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words,
               list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
        FROM t
    ),
    windows AS (
        SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
        FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w)
    ),
    again AS (
        SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1
    ),
    covered AS (
        SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n_repeat_words FROM again, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id
    ),
    m AS (
        SELECT w.doc_id, len(words)::BIGINT AS n_words,
               length(regexp_replace(body, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
               (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
               (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
        FROM w LEFT JOIN covered USING (doc_id)
    ),
    b AS (
        SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
               + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (10 * n_dup_lines > 4 * n_lines)::BIGINT
               + 16 * (word_chars < 3 * n_words)::BIGINT + 32 * (word_chars > 10 * n_words)::BIGINT
               + 64 * (2 * n_capitals > word_chars)::BIGINT + 128 * (n_words = 0)::BIGINT)::BIGINT AS failed_bits
        FROM m
    )
    SELECT *, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept FROM b
    """,
)
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    ledger = quality_ledger(table(spark, folder, "documents").select("doc_id", "text"))
    return ledger.select("doc_id", *MEASURES, "failed_bits", fails(BASE).alias("base_failed"), (~fails(STRICT)).alias("kept"))


@query("op11_personal_data")
def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_pii(docs, train_tagger(docs)).drop("text")
    counts = [f"n_{k}" for k in KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")


@query(
    "op12_filter_audit",
    """
    WITH t AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents
    ),
    l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    judged AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
               (len(words) < 200)::INT AS a,
               (100 * len(list_distinct(words)) < 50 * len(words))::INT AS b,
               (100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 3 * length(body))::INT AS c,
               regexp_matches(body, '[#$%&*|]')::INT AS d,
               coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false)::INT AS e
        FROM t LEFT JOIN l USING (doc_id)
    ),
    cells AS (
        SELECT part, {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
        FROM judged GROUP BY ALL
    ),
    orders AS (
        SELECT v.l || w.l || x.l || y.l || z.l AS filter_order
        FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) v, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) w,
             (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) x, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) y,
             (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) z
        WHERE len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5
    ),
    failing AS (
        SELECT part, n, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'],
               lambda k: (k = 'A' AND fails['A'] = 1) OR (k = 'B' AND fails['B'] = 1) OR (k = 'C' AND fails['C'] = 1)
                   OR (k = 'D' AND fails['D'] = 1) OR (k = 'E' AND fails['E'] = 1)) AS letters
        FROM cells
    ),
    stepped AS (
        SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter, letters, n, good, toxic,
               list_contains(letters, substr(filter_order, step, 1)) AS fails,
               len(list_filter(letters, lambda k: contains(substr(filter_order, 1, step - 1), k))) > 0 AS gone
        FROM failing, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
    ),
    m AS (
        SELECT part, filter_order, step, letter,
               sum(n) FILTER (NOT fails AND NOT gone) AS kept, sum(n) FILTER (fails AND NOT gone) AS removed,
               sum(n) FILTER (fails AND gone) AS redundant, sum(n) FILTER (letters = [letter]) AS unique_fails,
               sum(good) FILTER (fails AND NOT gone) AS good_lost, sum(toxic) FILTER (fails AND NOT gone) AS toxic_lost
        FROM stepped GROUP BY ALL
    )
    SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
           coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
           coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
           (sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter))::BIGINT AS shapley
    FROM m
    """,
)
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    # The cells are a small table that three branches read: written once, so that texts are read once.
    return audit(cut(mask_cells(table(spark, folder, "documents"), table(spark, folder, "labels"))))


@query(
    "op13_hard_negatives",
    """
    WITH r AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    s AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
        FROM r a, r b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ),
    p AS (
        SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
    )
    SELECT anchor_id, positive_id,
           (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INT AS rank,
           other AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5
    """,
)
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, component = F.col("vec_id"), F.col("embedding")
    # A whole number of a large double is the double itself; ``floor`` gives a long.
    floors = F.transform(component, lambda x: F.when(F.abs(x) < 2.0**44, F.floor(x.cast("double") * 256).cast("double")).otherwise(x.cast("double") * 256))
    label = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    return hard_negatives(table(spark, folder, "embeddings").select("vec_id", label, floors.alias("vector")), vec_id % 100 == 0)
