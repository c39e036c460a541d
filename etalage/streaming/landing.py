"""Landing of raw feed files as they arrive (Structured Streaming).

The models read raw retailer feeds that a copy job drops as files. This is the
Spark form of that landing step: a file-source stream over the drop folder,
appended as-is to the landing (source) table the bronze models read. The
schema is given, never inferred; progress lives in a checkpoint under the
session's shared checkpoint folder, so a restarted or failed run picks up
exactly the files it had not committed. ``availableNow`` processes what is
there and stops, which is how a daily batch job runs a stream.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from etalage.session import checkpoint_dir


def land_feed_stream(
    spark: SparkSession,
    drop_dir: str,
    landing_dir: str,
    schema: StructType,
    name: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start appending new parquet files from ``drop_dir`` to ``landing_dir``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(drop_dir)
    return (
        stream.writeStream.format("parquet")
        .option("path", landing_dir)
        .option("checkpointLocation", f"{checkpoint_dir(spark)}/landing-{name}")
        .outputMode("append")
        .trigger(availableNow=True)
        .queryName(f"landing_{name}")
        .start()
    )


def land_available(spark: SparkSession, drop_dir: str, landing_dir: str, schema: StructType, name: str) -> None:
    """Land every file present now and wait for it to be committed."""
    q = land_feed_stream(spark, drop_dir, landing_dir, schema, name)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
