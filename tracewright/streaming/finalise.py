"""Incremental finalisation: window results arrive as a stream, complete samples are fused once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewright.operators.segments import fuse_windows
from tracewright.operators.windows import complete, last_results

RESULTS = "sample_id string, window_id int, transitions array<int>, labels array<string>, seq long"


def finalise_stream(spark: SparkSession, windows: DataFrame, incoming: str, store: str, out: str, checkpoint: str, files_per_trigger: int = 20) -> StreamingQuery:
    """Appends each micro-batch of results to store and the segments of samples that became complete to out.

    Results are at least once and keyed by window: the last one counts. Each batch writes its own folder, replaced if
    it is run again, so a restart repeats nothing. files_per_trigger is the back-pressure.
    """

    def batch(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{store}/batch={number}")
        touched = rows.select("sample_id").distinct()
        have = last_results(spark.read.parquet(store).drop("batch").join(touched, "sample_id", "left_semi"), ["sample_id"], "seq")
        mine = windows.join(touched, "sample_id", "left_semi")
        ready = complete(mine, have, ["sample_id"]).select("sample_id")
        fused = fuse_windows(mine.join(ready, "sample_id", "left_semi"), have, ["sample_id"])
        fused.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(RESULTS).option("maxFilesPerTrigger", files_per_trigger).parquet(incoming)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def finalised(spark: SparkSession, out: str) -> DataFrame:
    """The newest segments of each sample."""
    rows = spark.read.parquet(out)
    newest = rows.groupBy("sample_id").agg(F.max("batch").alias("batch"))
    return rows.join(newest, ["sample_id", "batch"]).drop("batch")
