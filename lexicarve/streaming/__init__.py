"""Streaming use of the row-wise parts.

The reference reads only bounded files and has no stream operator. The
column functions (T1-T7) and a fitted model's ``transform`` are row-wise,
so Spark runs them unchanged on a file stream; this module only wires
that up (file source, checkpoint in the shared folder, parquet sink).
Nothing here adds an operator of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as tx
from ..session import scratch_path


def clean_text_stream(spark: SparkSession, source_dir: str, schema: T.StructType, text: str = "text") -> DataFrame:
    """New parquet files under ``source_dir`` -> rows with normalised text and tokens."""
    s = spark.readStream.schema(schema).parquet(source_dir)
    return s.withColumn("clean", tx.preprocess(text)).withColumn("tokens", tx.word_tokens("clean"))


def write_parquet_stream(df: DataFrame, sink_dir: str, checkpoint: str | None = None,
                         available_now: bool = True) -> StreamingQuery:
    """Parquet sink with its checkpoint in the shared folder (restartable after executor loss)."""
    ckpt = checkpoint or scratch_path(df.sparkSession, "stream-checkpoint")
    w = df.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
