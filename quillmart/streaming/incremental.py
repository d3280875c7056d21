"""Incremental staging by a load-time watermark (batch and Structured Streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def incremental(df: DataFrame, watermark, col: str = "_loaded_at") -> DataFrame:
    """Rows loaded after ``watermark`` (a value, or None for everything)."""
    if watermark is None:
        return df
    return df.where(F.col(col) > F.lit(str(watermark)).cast(df.schema[col].dataType))


def watermark_of(spark: SparkSession, sink_dir: str, schema, col: str = "_loaded_at"):
    """The latest load time that the target holds, None before the first increment."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sink_dir)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(schema).parquet(sink_dir).agg(F.max(col)).head()[0]


def stream_increment(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                     schema, transform=None, watermark=None, col: str = "_loaded_at") -> int:
    """Apply the batch transform to every new Parquet drop under ``source_dir``.

    ``readStream`` over the drop folder with ``trigger(availableNow=True)``:
    processes all files not yet recorded in ``checkpoint`` and stops, so a
    re-run picks up only new drops (exactly-once through the file sink log).
    Returns the number of micro-batches that the checkpoint has committed so far.
    """
    stream = spark.readStream.schema(schema).parquet(source_dir)
    stream = incremental(stream, watermark, col)
    if transform is not None:
        stream = transform(stream)
    q = (stream.writeStream.format("parquet").option("compression", "zstd")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start(sink_dir))
    q.awaitTermination()
    last = q.lastProgress
    return 0 if last is None else int(last["batchId"]) + 1
