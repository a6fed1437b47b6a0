"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Lets Spark remove a query's shuffle files as soon as it ends, not when the driver's memory is collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Only a local session that names none gets a private one; a cluster session must
    name it, since its driver and executors have no other folder in common.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="corpus-")
    return _own[app]


class Scratch:
    """A folder of written tables that later steps read instead of computing them again.

    Written tables outlive lost executors and cut the lineage.  Results are lazy, so
    the folder goes when the session ends; `drop` removes a table that is superseded.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._tables = 0
        folder = self._hadoop(self.path)
        self._system(folder).deleteOnExit(folder)

    def new_path(self) -> str:
        self._tables += 1
        return f"{self.path}/{self._tables}"

    def write(self, df: DataFrame) -> DataFrame:
        """`df` written once and read back; what it shuffled is removed, being in the table."""
        path = self.new_path()
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(CLEANUP)
            else:
                self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_scratch_path", None)
        if path:
            folder = self._hadoop(path)
            self._system(folder).delete(folder, True)

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, folder):
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
