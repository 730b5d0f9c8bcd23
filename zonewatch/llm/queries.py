"""The query and, where SQL can express it, the DuckDB SQL of each operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewatch.llm import (
    bpe_tree, chat, cuckoo, kn_rules, line_dedup, minhash, packing, periodic, pu_quality, sharding, token_align, vptree, warc_zip)
from zonewatch.llm.common import UPPER, run_folder, stage, table


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pu_quality.score_documents(docs, pu_quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.pages_through_archives(spark, table(spark, sf_dir, "pages"))


def op3_fast_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents"))


def op5_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    return line_dedup.remove_common_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.octet_length(text).cast("long").alias("left_bytes"),
        F.sha2(text, 256).alias("left_sha256"))


def op6_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.round_trip_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_budgeted_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    windows = chat.format_conversations(turns, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return chat.read_back(stage(windows, run_folder(spark, "chat"), "windows"))


def op10_kneser_ney_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kn_rules.quality_rules(table(spark, sf_dir, "documents"))


def op11_galloping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align_tokenizers(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = periodic.periodic_runs(docs.withColumn("text", _with_turns(F.col("doc_id"), F.col("text"))))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"strongest.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _with_turns(doc_id: Column, text: Column) -> Column:
    """Of every tenth document (by CRC-32 of its id) the words from some place on repeated from there
    with some period; the other texts as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def turned(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)))
        return F.array_join(F.transform(at, lambda i: F.get(w, i.cast("int"))), " ")

    # the words are named once, by a list of one list
    changed = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, turned(w))), F.lit(0))
    return F.when(F.coalesce(F.pmod(h, F.lit(10)) == 0, F.lit(False)), F.coalesce(changed, text)).otherwise(text)


def op13_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0).select(
        "query_id", "rank", "vec_id", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_pu_quality, op2_warc_zip, op3_fast_minhash, op4_stratified_shards, op5_site_lines, op6_cuckoo_dedup,
    op7_tree_bpe, op8_best_fit_packing, op9_budgeted_chat, op10_kneser_ney_rules, op11_galloping_alignment,
    op12_lyndon_runs, op13_vantage_trees)}

_BLANK = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"

ORACLES = {
    "op2_warc_zip": f"""
        WITH t AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
             w AS (SELECT *, CASE WHEN payload_bytes >= {warc_zip.MIN_REVISIT}
                                  THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS target FROM t)
        SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN target > page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN target > page_id THEN target END AS refers_to
        FROM w""",
    "op5_site_lines": f"""
        WITH l AS (SELECT rowid AS r, doc_id, source, unnest(string_split(text, chr(10))) AS line,
                          unnest(range(len(string_split(text, chr(10))))) AS pos
                   FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
             k AS (SELECT *, trim(line, {_BLANK}) AS bare FROM l),
             c AS (SELECT bare FROM k WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}),
             m AS (SELECT k.*, c.bare IS NOT NULL AS gone FROM k LEFT JOIN c ON k.bare = c.bare),
             d AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
                          coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM m GROUP BY r)
        SELECT doc_id, n_lines, n_dropped, CAST(strlen(kept) AS BIGINT) AS left_bytes, sha256(kept) AS left_sha256 FROM d""",
    "op6_cuckoo_dedup": f"""
        WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')) AS text_sha256
                   FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
}
