"""The registered queries of this subpackage and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import chat_report, text_part
from .common import table
from .decontaminate import decontaminate
from .exact_dedup import exact_dedup
from .langid import language_id
from .license_scan import license_scan
from .minhash import minhash_groups
from .packing import pack
from .quality import quality_rules
from .spelling import spelling_variants
from .suffix_dedup import remove_repeats
from .token_counts import token_counts
from .toxicity import toxicity
from .whitening import whiten


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    return chat_report(rows.unionByName(extra).select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts")))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("failed")


_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7_SQL = f"""
WITH n AS (SELECT doc_id, sha256({_AZ}) AS s FROM documents),
g AS (SELECT s, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY s)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, s AS text_sha256 FROM n JOIN g USING (s)
"""

_ESC = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;')"

OP4_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learned,
    sum(length({_ESC.format("role")}) + length({_ESC.format("text")}) + 23) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
  cast(formatted_chars AS BIGINT) AS formatted_chars FROM g
"""


_WORD = r"[^\x20\x09-\x0D]"

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM (SELECT rid, regexp_extract_all(t, '{_WORD}+') AS ws FROM d)),
k AS (SELECT *, lead(w, 7) OVER x IS NOT NULL AS whole,
    concat_ws(' ', w, lead(w, 1) OVER x, lead(w, 2) OVER x, lead(w, 3) OVER x, lead(w, 4) OVER x, lead(w, 5) OVER x, lead(w, 6) OVER x, lead(w, 7) OVER x) AS k
  FROM w WINDOW x AS (PARTITION BY rid ORDER BY p)),
a AS (SELECT rid, p, w, whole AND count(*) OVER (PARTITION BY rid, k) > 1 AS twice FROM k),
c AS (SELECT rid, w, max(twice::INT) OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS again FROM a),
n AS (SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars, sum(again) AS n_repeat_words, count_if(regexp_matches(w, '[A-Za-z]|[^\x00-\x7F]')) AS lettered FROM c GROUP BY rid),
f AS (SELECT rid, max(m) AS most FROM (SELECT rid, w, count(*) AS m FROM w GROUP BY ALL) GROUP BY rid),
l AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines, count_if(l[1] IN ('-', '*')) AS dashed, count_if(suffix(l, '...')) AS opened
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{_WORD}') GROUP BY rid),
s AS (SELECT rid, doc_id, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper,
    length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters, length(regexp_replace(t, '[^\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]', '', 'g')) AS marks FROM d),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_words, 0) < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, lettered, most, n_lines, dashed, opened, upper, letters, marks
  FROM s LEFT JOIN n USING (rid) LEFT JOIN f USING (rid) LEFT JOIN l USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 100 * n_symbols > 20 * n_words OR 100 * n_dup_lines > 30 * n_lines OR 100 * lettered < 70 * n_words
    OR 100 * upper > 60 * letters OR 100 * marks > 30 * word_chars OR 100 * most > 30 * n_words OR 100 * dashed > 90 * n_lines OR 100 * opened > 30 * n_lines) AS kept
FROM m
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_dedup": op1_minhash_dedup, "op2_license_scan": op2_license_scan, "op3_token_counts": op3_token_counts,
        "op4_chat_format": op4_chat_format, "op5_best_fit_packing": op5_best_fit_packing, "op6_decontaminate": op6_decontaminate,
        "op7_exact_dedup": op7_exact_dedup, "op8_language_id": op8_language_id, "op9_suffix_dedup": op9_suffix_dedup, "op10_toxicity": op10_toxicity,
        "op11_embedding_whitening": op11_embedding_whitening, "op12_spelling_variants": op12_spelling_variants, "op13_quality_rules": op13_quality_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_format": OP4_SQL, "op7_exact_dedup": OP7_SQL, "op13_quality_rules": OP13_SQL}
