"""Running totals in a total order, without a group ever coming together in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


def running(df: DataFrame, group: list[str], order: list[str], weight: str, out: str = "before") -> DataFrame:
    """``df`` with the sum of ``weight`` over the rows of the same group that come earlier.

    Rows are dealt by ranges of (group, order), so one group spreads over as many tasks as its share
    of the rows asks for. Each range then sums up its own rows, and the totals of the ranges, of
    which there are as many as shuffle partitions and groups, give each range its start. ``order``
    must tell the rows of a group apart. Groups may be null.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(
        df.repartitionByRange(ranges, *group, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*group, "__range").agg(F.sum(weight).alias("__sum")).select(
        *(F.col(c).alias(f"__s{i}") for i, c in enumerate(group)), F.col("__range").alias("__at"),
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    own = Window.partitionBy(*group, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.withColumn("__own", F.coalesce(F.sum(weight).over(own), F.lit(0)))
    same = F.col("__range") == F.col("__at")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"__s{i}"))
    return summed.join(starts, same).select(
        *df.columns, (F.col("__start") + F.col("__own")).alias(out))
