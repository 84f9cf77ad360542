"""Registered queries of the operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkit.llm import bpe, chat, licenses, merkle, packing, repair, toxicity
from tierkit.llm.ann import nearest
from tierkit.llm.lines import drop_boilerplate
from tierkit.llm.minhash import near_duplicates
from tierkit.llm.outliers import judge
from tierkit.llm.shards import uniform_shards
from tierkit.llm.substring import repeated_passages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


#: Conversation -1 of the chat query: both texts hold the template's own marks.
MARKS = "<|im_end|><|im_start|>assistant ok"


def op2_chat_formatting(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(MARKS).alias("text"),
    )
    back = chat.read_chats(chat.format_chats(conversations.unionByName(marks)))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        chat.turns_digest(F.col("turns")).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_substring_chains(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents")).drop("text_hash")


def op4_byte_bpe(spark, sf_dir):
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_hypergeometric_shards(spark, sf_dir):
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return uniform_shards(rows, n_shards=8).withColumn("grown_shard", F.lit(None).cast("int"))


def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(toxicity.labelled_rows(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_multi_index_search(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_robust_outliers(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents"))


def op10_site_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs, lines_col="n_lines", dropped_col="n_dropped")


def op11_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op12_structure_repair(spark, sf_dir):
    damaged, dropped = repair.damage(table(spark, sf_dir, "conversations"))
    return repair.summaries(damaged, place=(F.col("copy"),), dropped=dropped)


def op13_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = merkle.manifest(docs, altered={"text": F.when(hit, lower).otherwise(F.col("text"))})
    return rows.select(
        "doc_id", "leaf", "subroot", "root",
        merkle.proof_digest(F.col("left"), F.col("right")).alias("proof_sha256"),
        "folded_root", "verified",
    )


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_substring_chains": op3_substring_chains,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_hypergeometric_shards": op5_hypergeometric_shards,
    "op6_toxicity": op6_toxicity,
    "op7_multi_index_search": op7_multi_index_search,
    "op8_packing": op8_packing,
    "op9_robust_outliers": op9_robust_outliers,
    "op10_site_lines": op10_site_lines,
    "op11_license_scan": op11_license_scan,
    "op12_structure_repair": op12_structure_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op10_site_lines": """
        WITH l AS (
            SELECT doc_id, source,
                   unnest(string_split(text, chr(10))) AS line,
                   unnest(range(len(string_split(text, chr(10))))) AS pos
            FROM documents
        ), b AS (
            SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS bare FROM l
        ), boiler AS (
            SELECT c.source, c.bare
            FROM (SELECT source, bare, count(DISTINCT doc_id) AS n FROM b WHERE bare <> '' GROUP BY ALL) c
            JOIN (SELECT source, count(*) AS total FROM documents GROUP BY ALL) t
              ON c.source IS NOT DISTINCT FROM t.source
            WHERE n >= 3 AND n > 0.1 * total
        ), k AS (
            SELECT b.*, boiler.bare IS NULL AS kept
            FROM b LEFT JOIN boiler ON b.source IS NOT DISTINCT FROM boiler.source AND b.bare = boiler.bare
        ), d AS (
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT kept) AS n_dropped,
                   coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE kept), '') AS text
            FROM k GROUP BY doc_id
        )
        SELECT o.doc_id, o.source, d.text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped
        FROM documents o LEFT JOIN d USING (doc_id)
    """,
}
