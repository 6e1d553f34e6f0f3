"""Numbering of rows in an order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameloom.session import stage


def ranked(frame: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``frame`` with each row's number from 0 in an order that leaves no ties, as an int.

    Rows are sorted by ranges and written; the driver adds up one count a partition, as a bounded table.
    """
    sorted_rows = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    held = stage(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part, within = F.shiftright("_at", 33).cast("int"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = held.groupBy(part.alias("_part")).count().orderBy("_part").collect()  # one row a partition
    starts, total = [], 0
    for r in counts:
        starts.append((r["_part"], total))
        total += r["count"]
    offsets = frame.sparkSession.createDataFrame(starts, "_part int, _start long")
    rows = held.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return rows.withColumn(name, (F.col("_start") + within).cast("int")).drop("_part", "_start", "_at")
