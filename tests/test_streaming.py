from pyspark.sql import functions as F

from hazeline.streaming import live as L
from hazeline.streaming.run import drain_append, drain_complete, drain_update, event_stream


def source(spark, panel, tmp_path):
    df = panel.select("city", F.col("dt").alias("ts"), "pm25", "co").repartition(3)
    path = str(tmp_path / "in")
    df.write.parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 10).parquet(path)
    return stream, df


def same(a, b):
    cols = a.columns
    rnd = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in a.dtypes]
    a, b = a.select(*rnd), b.select(*cols).select(*rnd)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_equals_batch(spark, panel, tmp_path):
    stream, batch = source(spark, panel, tmp_path)
    cols = ["pm25", "co"]
    assert same(drain_update(L.stream_hourly(stream, cols), ["city", "dt"], "h"), L.stream_hourly(batch, cols))
    assert same(drain_update(L.stream_rolling(stream, 6, cols), ["city", "dt"], "r"), L.stream_rolling(batch, 6, cols))
    assert same(drain_update(L.stream_latest(stream, 900), ["city", "slot"], "l"), L.stream_latest(batch, 900))
    assert same(drain_complete(L.bad_air_sessions(stream, "pm25", 60.0), "s"), L.bad_air_sessions(batch, "pm25", 60.0))


def test_late_duplicates_are_dropped(spark, panel, tmp_path):
    path = str(tmp_path / "dup")
    rows = panel.select("city", "dt", "co")
    rows.write.parquet(path)
    rows.withColumn("co", F.col("co") + 1).write.mode("append").parquet(path)
    stream = event_stream(spark, path, "*.parquet", rows.schema)
    out = drain_append(L.stream_dedupe(stream), "d")
    assert out.count() == out.select("city", "dt").distinct().count() == panel.count()
