"""Positions of rows inside ordered groups, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import side, written

# monotonically_increasing_id: the partition stands above this many bits, the row within it below.
_ROW_BITS = 33


def ranked(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows of ``df`` with ``_rank`` (from 0) and ``_size`` (rows) in their group; nulls first, equal rows in any order.

    Rows are dealt by ranges of (group, order, row number), so a group of any size, and rows that repeat as often, are cut
    over many tasks. A sorted partition holds each of its groups in one piece; a row's rank is its distance from the start of
    its piece plus the rows in the group's earlier pieces. The table of pieces has a row per partition and per group.
    """
    numbered = written(df.withColumn("_row", F.monotonically_increasing_id()), "rank-rows")
    keys = [group, *order, "_row"]
    placed = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(placed.drop("_row").withColumn("_at", F.monotonically_increasing_id()), "rank-sorted")
    placed = placed.withColumn("_part", F.shiftright("_at", _ROW_BITS))
    pieces = placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_piece")).agg(
        F.min("_at").alias("_start"), F.count(F.lit(1)).alias("_rows")
    )
    own = Window.partitionBy("_group")
    earlier = own.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "_group",
        "_piece",
        (F.col("_start") - F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).alias("_zero"),
        F.sum("_rows").over(own).alias("_size"),
    )
    pieces = written(pieces, "rank-pieces")
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_piece"))
    found = placed.join(side(pieces, 100), same)
    return found.select(*df.columns, (F.col("_at") - F.col("_zero")).alias("_rank"), "_size")
