"""Registered streaming queries: the events table replayed as a file stream
(several files, one per trigger) through the streaming sketches. Their SQL
twin is the batch sketch of the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import h60_sql
from tessera.plans.cardinality import _EV_HASH, hll_sql, kmv_sql
from tessera.session import scratch_path
from tessera.sources.tables import table
from tessera.streaming.distinct import streaming_distinct

STREAM_P, STREAM_K, FILES = 8, 64, 4


def event_stream(spark, sf_dir, files: int = FILES):
    """Write the events as ``files`` parquet files into a fresh folder below
    the checkpoint folder and read them back as a stream, one file per
    trigger."""
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "event-stream")
    ev.repartitionByRange(files, "event_id").write.parquet(path)
    return spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)


def q_stream_hll(spark, sf_dir):
    est = streaming_distinct(event_stream(spark, sf_dir), "user_id", "hll", "event_type", p=STREAM_P)
    return est.select("event_type", F.lit(STREAM_P).alias("p"), "registers_used", F.round("estimate", 4).alias("estimate"))


def q_stream_kmv(spark, sf_dir):
    est = streaming_distinct(event_stream(spark, sf_dir), "user_id", "kmv", "event_type", k=STREAM_K)
    return est.select("event_type", F.lit(STREAM_K).alias("k"), "held", F.round("estimate", 4).alias("estimate"))


def q_stream_hll_daily(spark, sf_dir):
    """Distinct users per event type and day, from the event stream with a
    one-day watermark."""
    from tessera.streaming.distinct import hll_stream_windowed, hll_window_estimate

    q, out = hll_stream_windowed(
        event_stream(spark, sf_dir), "user_id", STREAM_P, "ts", "1 day", "1 day", "event_type"
    )
    q.awaitTermination()
    est = hll_window_estimate(spark, out, STREAM_P, "event_type")
    utc_day = F.date_from_unix_date(F.floor(F.unix_seconds("window_start") / 86400).cast("int"))
    return est.select(
        F.date_format(utc_day, "yyyy-MM-dd").alias("day"),
        "event_type",
        "registers_used",
        F.round("estimate", 4).alias("estimate"),
    )


QUERIES = {"stream_hll": q_stream_hll, "stream_kmv": q_stream_kmv, "stream_hll_daily": q_stream_hll_daily}

_DAY_HASH = f"""ev AS (SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type,
  {h60_sql('user_id')} AS h FROM events)"""

ORACLES = {
    "stream_hll_daily": f"""SELECT day, event_type, registers_used, estimate FROM (
WITH {_DAY_HASH}, {hll_sql('ev', ['day', 'event_type'], (STREAM_P,))})""",
    "stream_hll": f"WITH {_EV_HASH}, {hll_sql('ev', ['event_type'], (STREAM_P,))}",
    "stream_kmv": f"WITH {_EV_HASH}, {kmv_sql('ev', ['event_type'], (STREAM_K,))}",
}
