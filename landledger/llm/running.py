"""Running totals over large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running_before(
    df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], amount: str, result: str
) -> DataFrame:
    """Add ``result``: the sum of ``amount`` over the rows before each row of its group.

    Rows are ordered by ``bucket``, then by ``order``. A bucket is one task's work:
    pass a column with many values in every group, like the first digits of a
    digest, so that a group with a third of all rows is spread over its buckets. The sums
    of whole buckets come from a partial aggregation. Neither column may be null.
    """
    group = list(group)
    sums = df.groupBy(*group, bucket).agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*group, bucket, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(starts, [*group, bucket])
        .withColumn(result, F.col("_start") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("_start")
    )
