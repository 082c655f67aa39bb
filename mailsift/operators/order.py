"""Row numbers over a whole table without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mailsift.session import written


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """1-based position in ``order``, whose last column is unique.

    Rows are range-partitioned and written once; each partition numbers its own rows and adds
    the number of rows before it, which is one broadcast row per partition.
    """
    placed = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return placed.join(F.broadcast(offsets), "_part").withColumn(out, F.col("_before") + own).drop("_part", "_before")
