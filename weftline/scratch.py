"""Written intermediate tables in the folder that every executor shares.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading it again, so a lost
executor costs a re-read and never a recomputation from the source.  The setting is read from the
session; only a session in local mode, as in tests, may do without it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a folder of our own only where that is unset and all runs on this machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = f"file://{tempfile.gettempdir()}/weftline-scratch"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through Hadoop's file system, so any store works."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Written tables of one operator run.

    Operators ``drop`` what nothing reads any more; what a result still reads goes when the driver's
    JVM ends, by Hadoop's own list of folders to delete then, whether or not the session was stopped.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/weft-{name}-{uuid.uuid4().hex}"
        self._count = 0
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        store.mkdirs(root)
        store.deleteOnExit(root)

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the table read from the shared folder."""
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._weft_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables from :meth:`write` that nothing reads any more."""
        for table in tables:
            delete(self.spark, table._weft_path)
