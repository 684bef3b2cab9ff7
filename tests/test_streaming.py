from datetime import datetime, timedelta

from helixframe.operators.intervals import binned_depth
from helixframe.streaming.depth import binned_depth_stream

SCHEMA = "event_id long, ts timestamp, sample string, chr string, pos long, value double"


def test_stream_counts_like_the_batch(spark, tmp_path):
    at = datetime(2024, 1, 1)
    rows = [(i, at + timedelta(minutes=i), f"s{i % 2}", "1", i * 7 % 300, i / 3) for i in range(60)]
    spark.createDataFrame(rows[:40], SCHEMA).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame(rows[35:], SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    query = binned_depth_stream(stream, 100).writeStream.format("memory").queryName("depth").outputMode("complete").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    bins = spark.createDataFrame([("1", b * 100, b * 100 + 99) for b in range(3)], "chr string, start long, end long")
    want = binned_depth(spark.createDataFrame(rows, SCHEMA), bins, 100).where("n_reads > 0").drop("end")
    assert sorted(map(tuple, spark.table("depth").collect())) == sorted(map(tuple, want.collect()))
