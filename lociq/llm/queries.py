"""The queries op1 to op13 and the pipeline, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

import hashlib
import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.llm import bpe, chat, chunk_store, conversation_sql, html_text, near_join, packing, repair, secrets, sketch, toxicity, turn_trie, url_trie
from lociq.llm.frames import fold_column, map_columns, read_table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a public tokenizer's file is; LOCIQ_TOKENIZERS names another folder."""
    if folder := os.environ.get("LOCIQ_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_texts(docs, model).select("doc_id", (fold_column() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("ratio").alias("log_ratio_per_word"))


def op2_chunk_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_store.media_features(read_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_chunks")


def op3_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the packed matrices to the shared folder; the rows tell of the files read back."""
    packed = packing.written_matrix(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("sequence_id", "n_tokens", "cu_seqlens", "doc_ids", "starts", "doc_tokens", F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secrets.scan_texts(read_table(spark, sf_dir, "documents"), tokenizer_path())
    said = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.array_join(F.transform(F.filter("spans", lambda s: s["kind"] != "guess"), said), ",")
    costs = F.filter(F.transform("spans", lambda s: s["cost"]), lambda c: c >= 0)
    return spans.select("doc_id", count("assign"), count("access"), count("hex"), count("guess"), F.sha2(base, 256).alias("base_sha256"), F.array_join(F.transform("spans", said), ",").alias("spans"), F.array_max(costs).alias("most_guesses_log10"))


def op5_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_join(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()

    def run(cols: dict) -> dict:
        coder = bpe.load(path)
        out: dict[str, list] = {"doc_id": cols["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for data in coder.encode_many(cols["text"]):
            out["n_tokens"].append(len(data) // 4)
            out["ids_sha256"].append(hashlib.sha256(data).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(coder.decode(np.frombuffer(data, dtype="<u4")).encode("utf-8")).hexdigest())
        return out

    return map_columns(read_table(spark, sf_dir, "documents").select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trie.judge_urls(read_table(spark, sf_dir, "pages"))


def op8_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.sketch_with_next(read_table(spark, sf_dir, "documents"))


def op9_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(read_table(spark, sf_dir, "conversations")).select(
        "conv_id", "perspective", "first_turn", "last_turn", "n_turns", "n_own", "rendered", F.array_join(F.zip_with("mask_starts", "mask_ends", lambda s, e: F.concat_ws("-", s.cast("string"), e.cast("string"))), ",").alias("mask"), "own_chars"
    )


def op10_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_pieces(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    fixed = repair.repair(repair.damage(turns))
    found = fixed.summary.join(repair.repaired_hashes(fixed.pieces).withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of").withColumnRenamed("conv_id", "of")
    every = turns.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    return every.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in repair.COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.trie_nodes(turn_trie.rebuilt(read_table(spark, sf_dir, "conversations")))


def op13_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read_table(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {f.__name__: f for f in (op1_toxicity, op2_chunk_store, op3_best_fit, op4_secrets, op5_near_join, op6_bpe, op7_url_trie, op8_sketch, op9_perspectives, op10_bin_slack, op11_repair, op12_turn_trie, op13_tag_paths, pipeline)}


_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_trie.RULES)
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op7_url_trie": f"""
WITH rules(rhost, rpath, verdict) AS (VALUES {_RULES}),
cut AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, {_LOW.format("regexp_extract(rest, '^[^/]*')")} AS host, substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path FROM cut),
fits AS (SELECT page_id, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) - length(replace(rhost, '.', '')) DESC, length(rpath) DESC) AS k
         FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.k = 1""",
    "op9_perspectives": f"""
WITH t AS (SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unnamed') AS speaker, coalesce(text, '') AS text FROM conversations),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, speaker, text) AS k FROM t),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
said AS (SELECT p.conv_id, perspective, turn, k, speaker = perspective AS own, text,
         '{chat.OPEN}' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user name=' || speaker END || chr(10) AS head
         FROM placed p JOIN people USING (conv_id)),
spot AS (SELECT *, sum(length(head) + length(text) + {len(chat.CLOSE)}) OVER (PARTITION BY conv_id, perspective ORDER BY k) AS stop FROM said)
SELECT conv_id, perspective, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_own,
       string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY k) AS rendered,
       coalesce(string_agg(CAST(stop - length(text) - {len(chat.CLOSE)} AS BIGINT) || '-' || CAST(stop AS BIGINT), ',' ORDER BY k) FILTER (WHERE own), '') AS mask,
       CAST(coalesce(sum(length(text)) FILTER (WHERE own), 0) AS BIGINT) AS own_chars
FROM spot GROUP BY conv_id, perspective""",
    "op11_repair": conversation_sql.REPAIR,
    "op12_turn_trie": conversation_sql.TRIE,
    "op13_tag_paths": conversation_sql.MAIN_TEXT,
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
