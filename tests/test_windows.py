"""Event-time windows of the streaming sketch: closed windows are written once."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tessera.functions.hashing import h60
from tessera.operators import cardinality as K
from tessera.streaming.distinct import hll_stream_windowed, hll_window_estimate, keep_windows

P = 6
ROWS = "ts TIMESTAMP, kind STRING, user BIGINT"
REGISTERS = "window_start TIMESTAMP, window_end TIMESTAMP, kind STRING, idx INT, rank INT, seen TIMESTAMP"
DAY0 = dt.datetime(2024, 1, 1)


def at(day, hour=0):
    return DAY0 + dt.timedelta(days=day, hours=hour)


def days_of(spark, path):
    """Folder -> days it holds, of every version on storage."""
    if not os.path.exists(path):
        return {}
    return {
        f: {(r.window_start - DAY0).days for r in spark.read.parquet(f"{path}/{f}").select("window_start").distinct().collect()}
        for f in os.listdir(path)
    }


def folders(spark, out):
    return days_of(spark, f"{out}/open") | days_of(spark, f"{out}/closed")


def test_stream_equals_batch_and_windows_are_kept_once(spark, tmp_path):
    rows = [(at(i // 40, i % 24), "a" if i % 3 else None, i * 7 % 90) for i in range(400)]  # ten days in order
    src = str(tmp_path / "in")
    for i in range(10):
        spark.createDataFrame(rows[i * 40 : (i + 1) * 40], ROWS).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(src)
    out = str(tmp_path / "out")
    q, _ = hll_stream_windowed(stream, "user", P, "ts", "1 day", "2 days", "kind", out_dir=out)
    q.awaitTermination()
    held = folders(spark, out)
    for day in range(10):
        assert 1 <= sum(day in days for days in held.values()) <= 2
    closed = [d for f, days in held.items() if f.startswith("batch=") for d in days]
    assert len(closed) == len(set(closed)) and set(closed) == set(range(7))  # ends up to day 7: last event less two days
    assert len([f for f in held if f.startswith("v=")]) <= 2

    idx, rank = K.hll_index_rank(F.col("h"), P)
    df = spark.createDataFrame(rows, ROWS).withColumn("h", h60(F.col("user")))
    regs = df.groupBy(F.date_trunc("day", "ts").alias("window_start"), "kind", idx.alias("idx")).agg(F.max(rank).alias("rank"))
    want = K.hll_estimate(regs, P, ["window_start", "kind"])
    key = lambda t: sorted((r.window_start, r.kind or "", r.registers_used, r.estimate) for r in t.collect())
    assert key(hll_window_estimate(spark, out, P, "kind")) == key(want)


def batch(spark, *rows):
    return spark.createDataFrame([(at(d), at(d + 1), k, i, r, at(d, h)) for d, k, i, r, h in rows], REGISTERS)


def test_replayed_batches_write_the_same(spark, tmp_path):
    out = str(tmp_path / "w")
    write = keep_windows(out, "1 day", ["kind"])
    steps = [
        batch(spark, (0, "a", 1, 3, 5), (0, None, 2, 1, 6)),
        batch(spark, (0, "a", 1, 4, 9), (1, "a", 1, 2, 3)),
        batch(spark, (2, "a", 5, 2, 1)),
        batch(spark),
        batch(spark, (6, "a", 5, 7, 1)),
    ]

    def all_rows():
        return sorted(map(str, hll_window_estimate(spark, out, P, "kind").collect()))

    for i, b in enumerate(steps):
        write(b, i)
        once = folders(spark, out), all_rows()
        write(b, i)  # replayed after a loss
        assert (folders(spark, out), all_rows()) == once
    held = folders(spark, out)
    assert held["batch=2"] == {0} and held["batch=4"] == {1, 2} and held["v=4"] == {6}
    assert [r.registers_used for r in hll_window_estimate(spark, out, P, "kind").where("window_start < '2024-01-02'").collect()] == [1, 1]


def test_nothing_seen(spark, tmp_path):
    out = str(tmp_path / "e")
    keep_windows(out, "1 day", ["kind"])(batch(spark), 0)
    assert hll_window_estimate(spark, out, P, "kind").count() == 0
