"""The queries of this subpackage and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.llm.alignment import align_tokens
from caseledger.llm.bpe import token_digests
from caseledger.llm.chat import format_digests
from caseledger.llm.common import table
from caseledger.llm.decontam import contained_items
from caseledger.llm.html import extract_text
from caseledger.llm.langid import language_scores
from caseledger.llm.media import media_features
from caseledger.llm.periodic import periodic_runs
from caseledger.llm.quality import quality_scores
from caseledger.llm.repeats import repeat_digests
from caseledger.llm.sharding import shard_documents
from caseledger.llm.simhash import near_duplicate_classes
from caseledger.llm.toxicity import toxicity_scores


def tokenizer_path() -> str:
    """Where the installed package of public tokenizers keeps the byte-level vocabulary, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained_items(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_found", F.round("containment", 6).alias("containment")).distinct()


OP4_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents), b AS (SELECT DISTINCT item_id, text FROM benchmark),
dw AS (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM d),
bw AS (SELECT item_id, text, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM b),
bk AS (SELECT *, least(len(w), 5) AS k FROM bw WHERE len(w) > 0),
bs AS (SELECT DISTINCT item_id, text, k, array_to_string(w[i:i+k-1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
bn AS (SELECT item_id, text, k, count(*) AS n FROM bs GROUP BY ALL),
ds AS (SELECT DISTINCT doc_id, text, k, array_to_string(w[i:i+k-1], ' ') AS s
       FROM (SELECT doc_id, text, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM bk) WHERE len(w) >= k)),
hit AS (SELECT ds.doc_id, ds.text AS dt, bs.item_id, bs.text AS bt, count(*) AS f FROM ds JOIN bs USING (k, s) GROUP BY ALL)
SELECT DISTINCT hit.doc_id, hit.item_id, bn.n AS n_shingles, hit.f AS n_found, round(hit.f / bn.n, 6) AS containment
FROM hit JOIN bn ON bn.item_id = hit.item_id AND bn.text = hit.bt WHERE hit.f >= ceil(bn.n * 0.8::DOUBLE - 1e-9)
"""


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicate_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return format_digests(rows.unionByName(extra))


OP8_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, row_number() OVER w - 1 AS i, coalesce(lag(role) OVER w, 'start') AS prev, last_value(role) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fin
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
f AS (SELECT *, prev || '>' || role IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user', 'assistant>tool', 'tool>assistant') AS good,
      14 + length(role) + length(text) + length(regexp_replace(role, '[^\\<#:]', '', 'g')) + length(regexp_replace(text, '[^\\<#]', '', 'g')) AS chars FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars, bool_and(good) AND any_value(fin) = 'assistant' AS valid,
       coalesce(min(i) FILTER (WHERE NOT good), -1)::BIGINT AS bad_turn
FROM f GROUP BY conv_id
"""


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"), words=51)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=16, law="bytes")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), planted=True)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_html_text": op1_html_text,
    "op3_media": op3_media,
    "op2_toxicity": op2_toxicity,
    "op5_bpe": op5_bpe,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op4_decontamination": op4_decontamination,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_repeats": op9_repeats,
    "op10_sharding": op10_sharding,
    "op11_language_id": op11_language_id,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
}
ORACLE_SQL = {"op4_decontamination": OP4_SQL, "op8_chat_formatting": OP8_SQL}
