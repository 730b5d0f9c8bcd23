"""Line dedup (operator 5): removal of lines that stand on many sites, DataFrame functions only.

Every non-blank line, without the white space around it, is hashed to 128
bits.  A HyperLogLog sketch of the sites of each line hash is built in every
task and merged by the aggregation, so a line's cost does not depend on how
often it occurs.  A line whose estimated spread is clearly below ``min_sites``
stays, one clearly above goes, and one within ``SIGMAS`` standard errors is
counted exactly.  Lines on ``min_sites`` distinct sites or more are removed
from all documents.

Cases: a null text has no lines and stays null; blank lines are never removed;
a null source is no site.  Null and repeated doc_ids are rows like any other.
Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewatch.llm.common import run_folder, stage

MIN_SITES = 5
LG_SIZE, SIGMAS = 12, 3
BLANK = " \t\r\x0b\x0c"


def _line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(BLANK))
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("h1"), F.xxhash64(F.lit(1), bare).alias("h2")))


def common_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """h1, h2 of the lines (h1, h2, site) on ``min_sites`` sites or more."""
    error = SIGMAS * 1.04 / (1 << LG_SIZE) ** 0.5
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(LG_SIZE)).alias("sites")).select(
        "h1", "h2", F.hll_sketch_estimate("sites").alias("spread"))
    spread = spread.filter(F.col("spread") >= F.lit(int(min_sites * (1 - error))))
    sure = F.col("spread") > min_sites * (1 + error)
    near = spread.filter(~sure).select("h1", "h2")
    exact = lines.join(near, ["h1", "h2"], "left_semi").groupBy("h1", "h2", "site").agg(F.lit(1).alias("one")).groupBy(
        "h1", "h2").agg(F.count("site").alias("sites")).filter(F.col("sites") >= min_sites)
    return spread.filter(sure).select("h1", "h2").unionByName(exact.select("h1", "h2"))


def remove_common_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """One row per document: doc_id, text without the common lines, n_lines, n_dropped."""
    folder = run_folder(docs.sparkSession, "lines")
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
                       docs["source"].cast("string").alias("source"))
    row = F.xxhash64("doc_id", "text").alias("row")
    lines = stage(docs.select("doc_id", row, F.col("source").alias("site"), F.explode(F.split("text", "\n", -1)).alias("line")).select(
        "doc_id", "row", "site", _line_key(F.col("line")).alias("key")).filter("key is not null").select(
        "doc_id", "row", "site", "key.h1", "key.h2"), folder, "lines")
    common = stage(common_lines(lines.select("h1", "h2", "site"), min_sites), folder, "common")
    # distinct lines of a document, so the array is no longer than the document's own lines
    dropped = lines.join(common, ["h1", "h2"]).groupBy("row", "doc_id").agg(
        F.collect_set(F.struct("h1", "h2")).alias("dropped")).withColumnRenamed("doc_id", "_doc").withColumnRenamed("row", "_row")
    joined = docs.withColumn("row", row).join(
        dropped, (F.col("row") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    parts = F.split("text", "\n", -1)
    left = F.filter(parts, lambda x: ~F.coalesce(F.array_contains(F.col("dropped"), _line_key(x)), F.lit(False)))
    return joined.select("doc_id", "text", "dropped", F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
                         F.when(F.col("dropped").isNull(), parts).otherwise(left).alias("left")).select(
        "doc_id", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join("left", "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
        F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines") - F.size("left")).cast("long").alias("n_dropped"))
