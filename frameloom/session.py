"""Session defaults, and durable stages for iterative plans."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "frameloom", **conf: str) -> SparkSession:
    """A session with the engine's defaults. On a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return show_package(builder.getOrCreate())


def show_package(spark: SparkSession) -> SparkSession:
    """Lets Python workers import the package from where the driver has it, if that folder is there; else ship it with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` where the session has it, else, on one machine, a local one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.gettempdir()}/frameloom-{os.getuid()}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_STAGES: list[Stage] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Removes at its end all stages that were made inside. Results must have been written by then."""
    before = set(_STAGES)
    try:
        yield
    finally:
        for s in [s for s in _STAGES if s not in before]:
            s.drop()


class Stage:
    """A table written to the shared folder and read again, which cuts the lineage.

    The files outlive any executor. ``drop`` removes a stage that nothing reads any more; ``scratch`` removes all of a stretch of
    work. ``by`` is a column by whose values the table is kept, so that a read of one value skips the rest; ``rows`` are the most of a file.
    """

    def __init__(self, frame: DataFrame, name: str = "stage", by: str | None = None, rows: int = 0):
        self.spark = frame.sparkSession
        self.path = f"{shared_folder(self.spark)}/frameloom-stages/{name}-{uuid.uuid4().hex}"
        schema = frame.schema
        (frame.write.partitionBy(by) if by else frame.write).option("maxRecordsPerFile", rows).parquet(self.path)
        _STAGES.append(self)
        self.frame = self.spark.read.schema(schema).parquet(self.path)

    def drop(self) -> None:
        if self in _STAGES:
            _STAGES.remove(self)
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(frame: DataFrame, name: str = "stage", rows: int = 0) -> DataFrame:
    return Stage(frame, name, rows=rows).frame
