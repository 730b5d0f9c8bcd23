"""Sharding (operator 4): proportional stratified interleaving, DataFrame functions only.

Rows of each source are put in a seeded random order and get the fractional
rank (2 * rank - 1) / (2 * rows of the source).  In the order of that rank every
stretch holds the sources in the corpus' proportions; it is cut into shards
whose row counts differ by one at most (law ``rows``).

No source and no global order is ever sorted in one task.  Ranks come from
equal ranges of the hash (within a source) and of the fractional rank (over
all): rows are numbered inside a range, and a running sum over the ranges'
counts, a table of one row a range, gives where each begins.

Cases: a null source is a source of its own; a null text has no bytes (size 1,
checksum 0); null and repeated doc_ids are rows like any other, and rows equal
in all of it may stand for each other.  Fewer rows than shards leave shards
empty.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewatch.llm.common import run_folder, stage

SHARDS, SEED = 16, 20_240_817
RANGE_ROWS = 16_384


def _range_of_hash(ranges: int) -> Column:
    """Number of the range of a hash, growing with the hash."""
    return F.floor((F.shiftright("hash", 32) + F.lit(1 << 31)) * F.lit(ranges) / F.lit(1 << 32)).cast("long")


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    folder = run_folder(docs.sparkSession, "shards")
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    rows = stage(docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.lit(seed), docs["doc_id"], F.crc32(text)).alias("hash")), folder, "rows")
    n = rows.count()
    ranges = max(1, ceil(n / RANGE_ROWS))

    # rank within the source
    rows = rows.withColumn("range", _range_of_hash(ranges))
    by_source = Window.partitionBy("source")
    counts = rows.groupBy("source", "range").agg(F.count("*").alias("n")).select(
        F.col("source").alias("_source"), F.col("range").alias("_range"),
        F.coalesce(F.sum("n").over(by_source.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(by_source).alias("total"))
    within = Window.partitionBy("source", "range").orderBy("hash", "doc_id", "text_crc32", "size")
    numbered = rows.withColumn("rank", F.row_number().over(within))
    ranked = numbered.join(counts, numbered["source"].eqNullSafe(counts["_source"]) & (numbered["range"] == counts["_range"]))
    rank = F.col("before") + F.col("rank")
    ranked = stage(ranked.select("doc_id", "source", "size", "text_crc32", "hash",
                                 ((2 * rank - 1) / (2 * F.col("total"))).alias("fraction")), folder, "ranked")

    # rank over all
    ranked = ranked.withColumn("range", F.floor(F.col("fraction") * ranges).cast("long"))
    starts = ranked.groupBy("range").agg(F.count("*").alias("n")).select(
        F.col("range").alias("_range"),
        F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    order = Window.partitionBy("range").orderBy("fraction", "source", "hash", "doc_id", "text_crc32", "size")
    placed = ranked.withColumn("at", F.row_number().over(order)).join(starts, F.col("range") == F.col("_range")).select(
        "doc_id", "size", "text_crc32", (F.col("before") + F.col("at") - 1).alias("position"))
    shard = F.expr(f"position * {shards} div {max(n, 1)}")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
        (F.col("position") - F.expr(f"((position * {shards} div {max(n, 1)}) * {n} + {shards - 1}) div {shards}")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
