"""Sinks: vectors by space, JSON artifacts, single documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_vectors(batch: DataFrame, path: str, spaces: tuple[str, ...] = ("dinov2", "clip_image")) -> None:
    """Both spaces in one table, partitioned by space, so a read of one space skips the other's files."""
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("space"), F.col(s).alias("vector")) for s in spaces)))
    batch.select("sample_token", each.alias("x")).select("sample_token", "x.*").write.mode("overwrite").partitionBy("space").parquet(path)


def write_json(frame: DataFrame, path: str) -> None:
    """JSON lines, a file a partition."""
    frame.write.mode("overwrite").json(path)


def json_document(frame: DataFrame, order: list[str], most: int = 100_000) -> str:
    """The rows as one JSON array, in order; a document is for small artifacts, so more than ``most`` rows are refused."""
    rows = frame.orderBy(*order).select(F.to_json(F.struct(*frame.columns)).alias("j")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows; write them as lines")
    return "[" + ",".join(r.j for r in rows) + "]"


def write_document(spark: SparkSession, text: str, path: str) -> None:
    """One small document as one file of that name."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(jpath, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
