"""Ranks without one window over a whole group: ranks inside blocks of values, and counts of the blocks before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Neighbouring values that are ranked in one window.
BLOCK = 4096


def dense_ranks(values: DataFrame, group: list[str], value: str = "value", block: int = BLOCK) -> DataFrame:
    """Distinct rows (group.., value) with `rank`, the number of smaller values of their group, from 0; values are whole numbers or null, which comes first.

    A window holds `block` rows at most, however many values a group has; what one group puts in order at once is one row a block.
    """
    rows = values.withColumn("block", F.floor(F.col(value) / block))
    inside = Window.partitionBy(*group, "block").orderBy(value)
    sizes = rows.groupBy(*group, "block").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy(*group).orderBy("block")) - F.col("n")).drop("n")
    ranked = rows.withColumn("inside", F.row_number().over(inside) - 1)
    same = [ranked[k].eqNullSafe(before[k]) for k in [*group, "block"]]
    return ranked.join(before, same).select(*[ranked[k] for k in group], ranked[value], (F.col("inside") + F.col("before")).cast("int").alias("rank"))
