"""Registered queries of the subpackage: each applies one operator, with
production parameters, to its whole table. ``ORACLE`` has DuckDB SQL for those
that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.llm.bpe import bpe_digests
from goldvein.llm.chat_format import rotate_perspectives
from goldvein.llm.common import read_table
from goldvein.llm.exact_dedup import exact_dedup
from goldvein.llm.html_extract import extract_main_text
from goldvein.llm.jaccard_join import jaccard_components
from goldvein.llm.lexical_search import lexical_search
from goldvein.llm.packing import pack_documents
from goldvein.llm.periodic_runs import periodic_runs
from goldvein.llm.quality_classifier import quality_scores
from goldvein.llm.quality_rules import quality_rules
from goldvein.llm.suffix_dedup import repeated_passages
from goldvein.llm.token_counts import token_counts
from goldvein.llm.toxicity import toxicity_scores

QUERIES, ORACLE = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE["op1_quality_rules"] = r"""
WITH docs AS (
    SELECT doc_id, source, text AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
lines AS (
    SELECT doc_id, len(l) - len(list_distinct(l)) AS n_dup_lines
    FROM (SELECT doc_id, list_filter(string_split(coalesce(t, ''), chr(10)),
                                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs)),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM docs WHERE len(words) >= 8)),
again AS (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c FROM windows) WHERE c > 1),
covered AS (
    SELECT doc_id, sum(least(coalesce(following - i, 8), 8)) AS n_repeat_words FROM again GROUP BY doc_id),
base AS (
    SELECT doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(coalesce(t, '')) - length(regexp_replace(coalesce(t, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
           n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM docs JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base),
hosts AS (
    SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM judged WHERE source IS NOT NULL GROUP BY source),
prior AS (
    SELECT sum(f) / sum(n) AS m, count(*) AS h, sum(1.0 / n) AS inv, avg(f / n) AS r1, avg((f / n) * (f / n)) AS r2
    FROM hosts),
strength AS (
    SELECT m, CASE WHEN v > 0 AND m > 0 AND m < 1 THEN least(greatest(m * (1 - m) / v - 1, 2), 1000) ELSE 1000 END AS s
    FROM (SELECT m, r2 - r1 * r1 - m * (1 - m) * inv / h AS v FROM prior)),
verdicts AS (
    SELECT source, n >= 20 AND (f + m * s) / (n + s) > 0.5 AS rejected FROM hosts, strength)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM judged LEFT JOIN verdicts USING (source)
"""


@query
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_perspectives(read_table(spark, sf_dir, "conversations"))


ORACLE["op3_perspectives"] = r"""
WITH turns AS (
    SELECT conv_id, turn, replace(coalesce(nullif(trim(role), ''), 'unknown'), '<|', '<\|') AS speaker,
           replace(coalesce(text, ''), '<|', '<\|') AS t
    FROM conversations),
views AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'),
rendered AS (
    SELECT t.*, perspective,
           CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS chat_role,
           CASE WHEN speaker = 'system' THEN '<|system|>' WHEN speaker = perspective THEN '<|assistant|>'
                ELSE '<|user name=' || speaker || '|>' END || chr(10) AS head
    FROM turns t JOIN views v ON t.conv_id IS NOT DISTINCT FROM v.conv_id),
placed AS (
    SELECT *, row_number() OVER w - 1 AS position, head || t || '<|end|>' || chr(10) AS segment,
           coalesce(sum(length(head) + length(t) + 8) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM rendered WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, t))
SELECT conv_id, perspective, position::BIGINT AS position, turn, speaker, chat_role, segment, start,
       length(segment)::BIGINT AS length,
       CASE WHEN chat_role = 'assistant' THEN start + length(head) END::BIGINT AS loss_start,
       CASE WHEN chat_role = 'assistant' THEN start + length(segment) END::BIGINT AS loss_end
FROM placed
"""


@query
def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(read_table(spark, sf_dir, "documents")).withColumn("s", F.explode("spans"))
    later = F.aggregate("later", F.lit(0), lambda a, r: a + F.greatest(
        F.lit(0), F.least(r["end"], F.col("s.end")) - F.greatest(r["start"], F.col("s.start"))))
    return found.select("doc_id", F.col("s.start").cast("long").alias("start_word"), F.col("s.end").cast("long").alias("end_word"),
                        later.cast("long").alias("n_later_words"))


ORACLE["op4_repeated_passages"] = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (
    SELECT doc_id, i - 1 AS p, md5(array_to_string(w[i:i + 49], ' ')) AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)),
marked AS (
    SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1 AS later,
           count(*) OVER (PARTITION BY k) AS c FROM runs),
hits AS (
    SELECT doc_id, p, later, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 50, true) AS opens
    FROM marked WHERE c > 1),
grouped AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM hits),
spans AS (SELECT doc_id, span, min(p) AS start_word, max(p) + 50 AS end_word FROM grouped GROUP BY ALL),
cover AS (
    SELECT doc_id, span, sum(least(coalesce(following - p, 50), 50)) AS n
    FROM (SELECT doc_id, span, p, lead(p) OVER (PARTITION BY doc_id, span ORDER BY p) AS following FROM grouped WHERE later)
    GROUP BY ALL)
SELECT doc_id, start_word::BIGINT AS start_word, end_word::BIGINT AS end_word, coalesce(n, 0)::BIGINT AS n_later_words
FROM spans LEFT JOIN cover USING (doc_id, span)
"""


@query
def op5_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


ORACLE["op6_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query
def op7_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op8_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(read_table(spark, sf_dir, "documents"), repeat_tenth=True)
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    # Runs come by start and period, so of equal exponents the first stays.
    best = F.aggregate("runs", none, lambda a, r: F.when(
        a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLE["op13_lexical_search"] = r"""
WITH terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY ALL),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term, n_docs),
scored AS (
    SELECT item_id, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id), corpus
    GROUP BY item_id, doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
"""
