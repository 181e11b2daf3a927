"""Stream of host requests -> per-batch best prices equals the batch operator."""

from pyspark.sql import functions as F

from lodgeframe.operators import profit
from lodgeframe.streaming import best_price_stream, read_request_stream


def test_best_price_stream_matches_batch(spark, tmp_path):
    hosts = spark.createDataFrame([(i, 4.0 + i / 7.0, 1.2) for i in range(12)],
                                  "host_id long, intercept double, slope double")
    src = str(tmp_path / "requests")
    hosts.where(F.col("host_id") < 6).write.parquet(src + "/a")
    hosts.where(F.col("host_id") >= 6).write.parquet(src + "/b")
    stream = read_request_stream(spark, src + "/*", hosts.schema)
    sink = str(tmp_path / "sink")
    q = best_price_stream(stream, profit.closed_form_log_price(), sink,
                          checkpoint_location=str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    got = sorted(spark.read.parquet(sink).select("host_id", "price", "profit").collect())
    want = sorted(profit.best_price(hosts, profit.closed_form_log_price())
                  .select("host_id", "price", "profit").collect())
    assert got == want
