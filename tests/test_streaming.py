from pyspark.sql import functions as F

from warpline.streaming.sessions import session_writes, stream_session_writes

EVENTS = [(1, 1, "write", 5), (1, 2, "begin", 0), (1, 3, "begin", 0), (1, 4, "end", 0), (1, 5, "write", 7), (1, 6, "end", 0), (1, 7, "end", 0), (1, 8, "begin", 0), (1, 9, "write", 1), (2, 10, "write", 4)]
SCHEMA = "thread long, seq long, event string, size long"


def test_batch_and_stream_agree(spark, tmp_path):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    batch = sorted((r.thread, r.seq, r.session, r["size"]) for r in session_writes(df, "thread", "seq").collect())
    assert batch == [(1, 5, 1, 7), (1, 9, 2, 1)]
    for i, part in enumerate((F.col("seq") <= 4, F.col("seq") > 4)):
        df.where(part).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream_session_writes(stream).writeStream.format("memory").queryName("writes").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r.thread, r.seq, r.session, r["size"]) for r in spark.table("writes").collect())
    assert got == batch
