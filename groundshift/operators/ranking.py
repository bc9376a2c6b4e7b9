"""Numbers over a whole table without gathering it: rows are range-partitioned, counted in their partition, and moved on by the sizes of the partitions before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundshift.operators.components import written


def numbered(df: DataFrame, order: list[Column], name: str, by: list[str] | None = None) -> DataFrame:
    """df with name, the number of each row in the order, from one on; within each group of by, if given. Ties must not matter or not occur.

    What meets in one task is a row for each partition, or for each partition and group.
    """
    by = by or []
    keys = [F.col(c) for c in by] + list(order)
    place = F.monotonically_increasing_id()
    s = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", place))
    s = s.withColumn("__part", F.shiftright("__at", 33))
    sizes = s.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return s.join(sizes, [*by, "__part"]).withColumn(name, F.col("__before") + F.col("__at") - F.col("__first") + 1).select(*df.columns, name)
