"""Best-price serving over a stream of host requests (Structured Streaming).

The original answered one request per call on the driver. Here requests
arrive as files (any streaming source works); each micro-batch runs the
batch ``best_price`` operator, so all requests of a batch share one job.

Exactly-once output: every micro-batch is written to its own
``batch_id=<n>`` folder with overwrite, so a batch replayed after a failure
replaces its earlier partial output instead of duplicating it. The stream
checkpoint defaults to a folder under the session's ``spark.checkpoint.dir``
(the shared folder on a cluster).
"""

from __future__ import annotations

import posixpath
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodgeframe.operators import profit
from lodgeframe.session import ensure_checkpoint_dir


def read_request_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of host requests landing in ``folder``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def best_price_stream(requests: DataFrame, predict: Callable, sink_path: str, *,
                      name: str = "best_price", checkpoint_location: str | None = None,
                      available_now: bool = False) -> StreamingQuery:
    """Start a query writing each micro-batch's best prices under ``sink_path``."""
    spark = requests.sparkSession
    ckpt = checkpoint_location or posixpath.join(ensure_checkpoint_dir(spark), "streams", name)

    def handle(batch: DataFrame, batch_id: int) -> None:
        out = profit.best_price(batch, predict).withColumn("batch_id", F.lit(batch_id))
        out.write.mode("overwrite").parquet(posixpath.join(sink_path, f"batch_id={batch_id}"))

    writer = requests.writeStream.queryName(name).foreachBatch(handle) \
        .option("checkpointLocation", ckpt)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
