"""The opN_ queries over the given tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.llm import (chat_format, conversation_repair, decontaminate, fingerprints, html_text, jaccard_join, packing, secrets,
                            suffix_dedup, token_counts, toxicity, url_filter, whitening)
from screenlake.llm.tables import table

URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rule_table(spark, URL_RULES)
    return url_filter.judge(table(spark, sf_dir, "pages"), rules, "page_id")


_RULE_ROWS = ", ".join(
    "('{}', '{}', '{}', '{}')".format(r.split("/", 1)[0], "/" + r.split("/", 1)[1], r, v) for v, r in URL_RULES)
OP1_SQL = f"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(rule_host, rule_path, rule, verdict) AS (VALUES {_RULE_ROWS}),
j AS (
  SELECT p.*, (SELECT struct_pack(rule := r.rule, verdict := r.verdict) FROM r
               WHERE (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host))
                 AND starts_with(p.path, r.rule_path)
               ORDER BY length(r.rule) DESC LIMIT 1) AS w
  FROM p)
SELECT page_id, host, path, w.rule AS rule, coalesce(w.verdict, 'allow') AS verdict FROM j
"""


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (html_text.extract(table(spark, sf_dir, "pages"))
            .withColumn("n_chars", F.length("text").cast("long")))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    n = {f"n_{k}": secrets.count_kind(F.col("base"), k) for k, *_ in secrets.STRONG}
    return found.select("doc_id", *[c.alias(k) for k, c in n.items()],
                        F.sha2(secrets.render(F.col("base")), 256).alias("base_sha256"),
                        secrets.render(F.col("spans")).alias("spans"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", packing.ids_crc32(F.col("ids")).alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


HELD_OUT = "crc32(cast(doc_id as string)) % 3 = 1"


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~F.expr(HELD_OUT))
    return toxicity.score_documents(docs, model).select(
        "doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"), "threshold", "rejected")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, sf_dir, "documents"))


HARD_TEXT = "\\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = spark.createDataFrame([(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT)],
                                 "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    done = chat_format.format_conversations(rows)
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = chat_format.loss_text(F.col("formatted"), F.col("loss_spans"))
    return done.withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "round_trip")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


TOKEN_LIMIT = 4096


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(rows), rows)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


OP8_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, (contains(role || chr(10) || text, '###') OR contains(role || chr(10) || text, '</turn>')
             OR contains(role || text, '\') OR contains(role, ':')) AS hard
  FROM c),
w AS (
  SELECT *, 4 + length(role) + 2 + length(text) + 8
            + CASE WHEN hard THEN length(regexp_replace(role, '[^\\<#:]', '', 'g'))
                                + length(regexp_replace(text, '[^\\<#:]', '', 'g')) ELSE 0 END AS seg
  FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(seg)::BIGINT AS formatted_chars, true AS round_trip
FROM w GROUP BY conv_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_html_text": op2_html_text,
    "op3_secrets": op3_secrets,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_fingerprints": op6_fingerprints,
    "op8_chat_format": op8_chat_format,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_decontamination": op10_decontamination,
    "op11_token_counts": op11_token_counts,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_whitening": op13_whitening,
}
ORACLE: dict[str, str] = {"op1_url_filter": OP1_SQL, "op8_chat_format": OP8_SQL}
