"""Skew-safe sequence numbers within low-cardinality groups.

``row_number() OVER (PARTITION BY camera ORDER BY t)`` puts a whole camera in
one task; with a handful of cameras (or Kafka partitions, or one global
order) that is a handful of tasks for the whole data set, and a hot camera
holding a third of all rows becomes one giant task.  Here the order itself is
dealt out:

1. rows are range-partitioned on (group, order), so a hot group, and rows that
   share one order value, are spread over as many partitions as they fill;
2. the partition of each row is written with it to the shared folder, so every
   later read (and every retry) sees the same partitions;
3. rows are numbered inside (group, partition), and a running sum over the
   per-partition counts (groups + partitions rows) gives the number of rows of
   the group in earlier partitions.

NULL groups and NULL order values are ranked like any other (NULLs first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewatch.session import run_dir


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def sequence_number(df: DataFrame, group_cols: list[str], order_cols: list, out: str = "seq",
                    slices: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based row number per group in ``order_cols`` order.

    ``order_cols`` must give a total order inside each group (end with a
    unique id).  Pass narrow rows: they are written once.
    """
    spark = df.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = _cols(order_cols)
    path = f"{run_dir(spark, 'seq')}/rows"
    dealt = df.repartitionByRange(n, *_cols(group_cols), *order).withColumn("_part", F.spark_partition_id())
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    local = dealt.withColumn("_local", F.row_number().over(Window.partitionBy(*group_cols, "_part").orderBy(*order)))
    counts = dealt.groupBy(*group_cols, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_part").alias("_opart"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group_cols)],
                            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    cond = F.col("_part") == F.col("_opart")
    for i, g in enumerate(group_cols):
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    seq = (F.col("_before") + F.col("_local")).cast("long")
    return local.join(offsets, cond).select(*df.columns, seq.alias(out))
