from pyspark.sql import functions as F

from skein.plans.reader import read_header, read_log
from skein.streaming.reader import stream_log


def test_a_stream_gives_what_the_batch_reader_gives(spark, log, tmp_path):
    a = log("in/a.log", ["ts", "id.orig_h", "v"], ["time", "addr", "vector[count]"], ["1\t10.0.0.1\t1,2", "61\t::1\t-"])
    log("in/b.log", ["ts", "id.orig_h", "v"], ["time", "addr", "vector[count]"], ["62\t10.0.0.2\t3"])
    stream = stream_log(spark, str(tmp_path / "in"), read_header(spark, a))
    query = stream.writeStream.format("memory").queryName("streamed").trigger(availableNow=True).start()
    query.awaitTermination()
    want = sorted(map(tuple, read_log(spark, f"{tmp_path}/in/*.log").collect()), key=repr)
    assert sorted(map(tuple, spark.table("streamed").collect()), key=repr) == want and len(want) == 3


def test_windows_over_a_stream(spark, log, tmp_path):
    a = log("in/a.log", ["ts", "kind"], ["time", "string"], [f"{i}\tk{i % 2}" for i in range(0, 600, 10)])
    stream = stream_log(spark, str(tmp_path / "in"), read_header(spark, a)).withWatermark("ts", "1 minute")
    counted = stream.groupBy("kind", F.window("ts", "5 minutes")).count()
    query = counted.writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["count"] for r in spark.table("windows").collect()) == [30, 30]
