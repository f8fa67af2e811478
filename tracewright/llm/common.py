"""Scratch tables in the cluster's shared folder, and small helpers for Arrow-fed operators."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows in one Arrow batch: texts can be long, and a Python worker holds a batch whole.
ARROW_ROWS = 1000
#: Bytes in one Arrow batch.
ARROW_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only where that is unset in a local session, as in tests, a temporary folder is set for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tracewright-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def arrow_limits(spark: SparkSession) -> None:
    """Bounds what one Python worker gets at a time."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{ARROW_BYTES}b")


class Scratch:
    """Written tables that cut lineage: a lost executor never loses them, as they are in the shared folder.

    The folder goes when the driver's process ends, as lazy results may still read it before.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        arrow_limits(spark)
        atexit.register(self.close)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        if self.spark.sparkContext._jsc is not None:
            try:
                self.drop()
            except Exception:  # noqa: BLE001  the JVM may be gone by now
                pass

    def release(self) -> None:
        """Lets Spark's cleaner delete the shuffle files of plans that are no longer referred to."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
