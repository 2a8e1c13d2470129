from pyspark.sql import functions as F

from tallyforge.operators.latest import keep_latest
from tallyforge.session import shared_dir
from tallyforge.streaming import amendments


def test_stored_table_equals_the_batch_result(spark, tmp_path):
    shared_dir(spark)
    schema = "code string, due string, amendment int, v int"
    latest = lambda df: keep_latest(df, ["code", "due"], [F.col("amendment").desc(), F.col("v")])
    landing, table, checkpoint = (str(tmp_path / x) for x in ("landing", "table", "checkpoint"))
    batches = [[("a", "1", 0, 1), ("b", "1", 0, 2)], [("a", "1", 1, 3), ("c", "2", 0, 4)], [("a", "1", 0, 9), ("b", "1", 0, 2)]]
    everything = None
    for rows in batches:
        df = spark.createDataFrame(rows, schema)
        everything = df if everything is None else everything.union(df)
        df.coalesce(1).write.mode("append").parquet(landing)
        stream = amendments.landing(spark, landing, df.schema)
        amendments.maintain_latest(stream, table, checkpoint, ["code", "due"], latest).awaitTermination()
        got = {tuple(r) for r in spark.read.parquet(table).select("code", "due", "amendment", "v").collect()}
        assert got == {tuple(r) for r in latest(everything).collect()}


def test_windows_in_a_stream(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01 00:10:00", "x", 1.0), ("2024-01-01 00:50:00", "x", 2.0), ("2024-01-01 05:00:00", "x", 3.0)], "t string, k string, v double").withColumn("ts", F.to_timestamp("t")).drop("t")
    path = str(tmp_path / "in")
    df.write.parquet(path)
    totals = amendments.windowed_totals(amendments.landing(spark, path, df.schema), "ts", ["k"], "v")
    q = totals.writeStream.format("memory").queryName("totals").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r.event_count, r.total_value) for r in spark.sql("SELECT * FROM totals").collect()] == [(2, 3.0)]
    assert amendments.sessions(df, "ts", "k", "1 hour").count() == 2
    assert amendments.alerts(df, F.col("v") > 2).count() == 1
