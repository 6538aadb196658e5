"""Alert stretches on a stream against the batch operator."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from brookmark.operators.metrics import hold
from brookmark.streaming.alerts import ENDED, FIRING, Stretch, hold_stream

START = datetime(2024, 1, 1)
SCHEMA = "at timestamp, series string, value long"


def at(minute):
    return START + timedelta(minutes=minute)


def run(spark, path, loads, lateness="3 minutes"):
    for load in loads:
        spark.createDataFrame(load, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
        fired = hold_stream(stream, "at", "series", F.col("value") > 0, 300, max_gap=120, lateness=lateness)
        fired.writeStream.option("checkpointLocation", f"{path}/check").trigger(availableNow=True).start(
            f"{path}/out", format="parquet", outputMode="append"
        ).awaitTermination()
    return spark.read.parquet(f"{path}/out")


def test_stream_gives_the_stretches_of_the_batch(spark, tmp_path):
    values = [1] * 8 + [0] + [1] * 4 + [0, 1, None] + [1] * 7
    rows = [(at(m), "a", v) for m, v in enumerate(values)]
    rows += [(at(m), "b", 1) for m in (0, 2, 4, 6, 9, 11, 13, 15)]  # a gap of three minutes parts two stretches
    rows += [(at(m), None, 1) for m in range(7)]
    rows.sort(key=lambda r: r[0])
    rows[5], rows[9] = rows[9], rows[5]  # a little late
    half = len(rows) // 2
    out = run(spark, str(tmp_path), [rows[:half], rows[half:] + [(None, "a", 1)], [(at(60), "clock", 0)]])
    names = ["series", "since", "until", "samples", "held_seconds"]
    want = hold(spark.createDataFrame([r for r in rows if r[1]], SCHEMA), "at", "series", F.col("value") > 0, 300, max_gap=120).select(*names)
    assert out.where("series is null and state = 'ended'").select("samples").first()[0] == 7
    out = out.where("series is not null")
    ended = out.where(F.col("state") == ENDED).select(*names)
    assert sorted(map(tuple, ended.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert want.count() == 4  # two of "a" (one of 180 seconds is too short) and two of "b"
    starts = out.where(F.col("state") == FIRING).select("series", "since")
    assert sorted(map(tuple, starts.collect()), key=repr) == sorted(map(tuple, want.select("series", "since").collect()), key=repr)


def test_an_alert_fires_while_it_holds(spark, tmp_path):
    out = run(spark, str(tmp_path), [[(at(m), "a", 1) for m in range(20)]])
    assert [(r["state"], r["until"]) for r in out.collect()] == [(FIRING, at(5))]  # not ended: samples may follow


def test_samples_after_the_watermark_are_dropped(spark, tmp_path):
    loads = [[(at(m), "a", int(m != 3)) for m in range(30)], [(at(3), "a", 1), (at(90), "a", 0)], [(at(200), "clock", 0)]]
    out = run(spark, str(tmp_path), loads).where(F.col("state") == ENDED).collect()
    assert [(r["since"], r["until"]) for r in out] == [(at(4), at(29))]


def test_stretches_without_a_stream():
    one = Stretch(10, 5)
    for t, true in ((0, True), (5, True), (10, True), (15, True), (16, False), (20, True)):
        one.add(t, true)
    one.silent(25)
    assert one.samples == 1  # exactly a gap is not silence
    one.silent(26)
    assert one.out == [(FIRING, 0, 10, 3), (ENDED, 0, 15, 4)] and not one.samples
