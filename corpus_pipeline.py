"""The corpus pipeline: quality rules, quality classifier, exact dedup, near dedup, packing.

Each stage works on all that its predecessor kept; the first four return the
columns of ``documents``, the last one row per packed piece.  The classifier
learns from the labelled documents that reach it.  Rows are told apart by a written
key, not by ``doc_id``, which may be null or repeat: a decision on one row touches
no other, and of equal rows one stays (ties fall to the smallest key).  The key of a row
that is read from Parquet files is its file and place there, so no copy of the texts is
written for it; any other frame is written once with a key.

Cases: an empty table gives an empty result.  Extra columns, whatever their names, are carried to
packing and ignored.  Null texts have no words and go with the first stage; texts of any length
are taken whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonewatch.llm import cuckoo, kn_rules, minhash, packing, pu_quality
from zonewatch.llm.common import run_folder, stage, table, without

ROW, MARK = "_pipeline_row", "pipeline.row"
ROW_BITS = 40  # of a key, for the row's place in its file


def row_key(rows: DataFrame) -> str | None:
    """The key column of ``rows``: told by its mark, not by its name, which the input may have too."""
    return next((f.name for f in rows.schema.fields if f.metadata and f.metadata.get(MARK)), None)


def plain_read(spark: SparkSession, docs: DataFrame) -> bool:
    """Whether ``docs`` is nothing but a read of one Parquet file or folder: each row once, the same at every read."""
    files = docs.inputFiles()
    folders = {f.rsplit("/", 1)[0] for f in files}
    if len(folders) != 1:
        return False
    paths = folders | set(files if len(files) == 1 else ())
    paths |= {p.removeprefix("file://") for p in paths}  # frames are the same if their paths are spelt alike
    return any(docs.sameSemantics(spark.read.schema(docs.schema).parquet(p)) for p in paths)


def keyed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with a written key for every row, unless it has one."""
    if row_key(docs):
        return docs
    name = ROW
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    folder, mark = run_folder(spark, "rows"), {MARK: True}
    if not plain_read(spark, docs):
        return stage(docs.select("*", F.monotonically_increasing_id().alias(name, metadata=mark)), folder, "keyed")
    at = docs.metadataColumn("_metadata")
    order = Window.orderBy("_path")  # one row a file
    files = stage(docs.select(at["file_path"].alias("_path")).distinct().select(
        "_path", (F.row_number().over(order) - 1).cast("long").alias("_file")), folder, "files")
    placed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_own"), at["file_path"].alias("_at"), at["row_index"].alias("_index"))
    key = F.shiftleft("_file", ROW_BITS) + F.col("_index")
    return placed.join(F.broadcast(files), F.col("_at") == F.col("_path")).select("_own.*", key.alias(name, metadata=mark))


def by_row(rows: DataFrame) -> DataFrame:
    """What the operators decide on: text and language, with the row's key in the place of doc_id."""
    return rows.select(rows[row_key(rows)].alias("doc_id"), rows["text"], rows["lang"])


def named(rows: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """``group`` of each row with its key (_key) and doc_id (_id)."""
    key = row_key(rows)
    own = rows.select(rows[key].alias("_row"), rows["doc_id"].cast("long").alias("_id"))
    return groups.select(F.col("doc_id").alias("_key"), group).join(own, F.col("_key") == F.col("_row"))


def like(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(rows[c] for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = keyed(spark, docs)
    return like(without(rows, kn_rules.quality_rules(by_row(rows)).filter(~F.col("kept")), row_key(rows)), docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = keyed(spark, docs)
    model = pu_quality.fit(rows.select(rows["doc_id"], rows["text"]), table(spark, sf_dir, "labels"))
    return like(without(rows, pu_quality.score_documents(by_row(rows), model).filter("predicted = 0"), row_key(rows)), docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row with the largest doc_id stays, a null being the smallest."""
    rows = keyed(spark, docs)
    groups = named(rows, cuckoo.exact_groups(by_row(rows)), "keep_id")
    keepers = groups.groupBy("keep_id").agg(F.max(F.struct("_id", (-F.col("_key")).alias("k"))).alias("m"))
    return like(only(rows, keepers.select((-F.col("m.k")).alias("_keep"))), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the row with the smallest doc_id stays, a null being the largest."""
    rows = keyed(spark, docs)
    groups = named(rows, minhash.near_duplicates(by_row(rows)), "component_id")
    keepers = groups.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("n"), "_id", "_key")).alias("m"))
    return like(only(rows, keepers.select(F.col("m._key").alias("_keep"))), docs)


def only(rows: DataFrame, keepers: DataFrame) -> DataFrame:
    return rows.join(keepers, rows[row_key(rows)] == keepers["_keep"], "left_semi")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("packing", pack),
]

# a model, a similarity search and a tokenizer: SQL cannot express these stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    folder = run_folder(spark, "pipeline")
    docs = keyed(spark, table(spark, sf_dir, "documents"))
    for k, (_, step) in enumerate(STAGES):
        docs = stage(step(spark, docs, sf_dir), folder, f"stage-{k}")
    return docs
