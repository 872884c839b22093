"""Distinct counting over Structured Streaming sources.

* HyperLogLog: the registers are a plain streaming aggregate,
  ``groupBy(g, idx).agg(max(rank))``; Spark's state store keeps at most
  2^p rows per group and the checkpoint makes it exactly-once. Each trigger
  writes the complete (small) register table as version ``batch_id`` and
  removes versions older than the previous one, so a reader always finds a
  whole table; the estimate is a batch query over the latest.
* K-min-values: ``foreachBatch`` merges the batch's k smallest distinct
  hashes per group into the previous version of a small state table and
  writes version ``batch_id``. A replayed batch recomputes the same version
  from the version before it, so replays are harmless (set union is
  idempotent). Versions older than the previous one are removed.
* Windowed HyperLogLog: registers of open event-time windows are kept in
  versions too; a window that the watermark has passed is written once to
  the closed ones.

State, output and checkpoints live below the session's checkpoint folder
(or a folder the caller names on shared storage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import h60
from tessera.operators import cardinality as K
from tessera.session import scratch_path


def _hash(stream: DataFrame, value_col: str, group_cols: list[str]) -> DataFrame:
    return stream.select(*group_cols, h60(F.col(value_col)).alias("h")).where(F.col("h").isNotNull())


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, state_dir: str) -> list[int]:
    fs, p = _fs(spark, state_dir)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(st.getPath().suffix("/_SUCCESS")):
            out.append(int(name[2:]))
    return sorted(out)


def _drop_version(spark: SparkSession, state_dir: str, v: int) -> None:
    fs, p = _fs(spark, f"{state_dir}/v={v}")
    if fs.exists(p):
        fs.delete(p, True)


def _latest(spark: SparkSession, state_dir: str) -> DataFrame:
    """The last whole version."""
    vs = _versions(spark, state_dir)
    if not vs:
        raise ValueError("no state written yet")
    return spark.read.parquet(f"{state_dir}/v={vs[-1]}")


def hll_stream(
    stream: DataFrame,
    value_col: str,
    p: int,
    group_cols=None,
    out_dir: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
):
    """Start the register aggregate; returns (query, out_dir). ``trigger``
    defaults to ``availableNow``."""
    spark = stream.sparkSession
    g = K._groups(group_cols)
    out_dir = out_dir or scratch_path(spark, "hll-registers")
    checkpoint = checkpoint or scratch_path(spark, "hll-checkpoint")
    idx, rank = K.hll_index_rank(F.col("h"), p)
    regs = (
        _hash(stream, value_col, g)
        .select(*g, idx.alias("idx"), rank.alias("rank"))
        .groupBy(*g, "idx")
        .agg(F.max("rank").alias("rank"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        older = [v for v in _versions(s, out_dir) if v < batch_id]
        batch.write.mode("overwrite").parquet(f"{out_dir}/v={batch_id}")
        for v in older[:-1]:
            _drop_version(s, out_dir, v)

    q = (
        regs.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    return q, out_dir


def hll_stream_estimate(spark: SparkSession, out_dir: str, p: int, group_cols=None) -> DataFrame:
    return K.hll_estimate(_latest(spark, out_dir), p, group_cols)


def kmv_stream(
    stream: DataFrame,
    value_col: str,
    k: int,
    group_cols=None,
    state_dir: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
):
    """Start the k-smallest merge; returns (query, state_dir)."""
    spark = stream.sparkSession
    g = K._groups(group_cols)
    state_dir = state_dir or scratch_path(spark, "kmv-state")
    checkpoint = checkpoint or scratch_path(spark, "kmv-checkpoint")
    hashed = _hash(stream, value_col, g)

    def merge(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        partial = K.kmv_smallest(batch, k, g).select(*g, "h")
        older = [v for v in _versions(s, state_dir) if v < batch_id]
        if older:
            prev = s.read.parquet(f"{state_dir}/v={older[-1]}").select(*g, "h")
            partial = K.kmv_merge(prev, partial, k=k, group_cols=g).select(*g, "h")
        partial.write.mode("overwrite").parquet(f"{state_dir}/v={batch_id}")
        for v in older[:-1]:
            _drop_version(s, state_dir, v)

    q = (
        hashed.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(merge)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    return q, state_dir


def kmv_stream_estimate(spark: SparkSession, state_dir: str, k: int, group_cols=None) -> DataFrame:
    g = K._groups(group_cols)
    return K.kmv_estimate(K.kmv_merge(_latest(spark, state_dir), k=k, group_cols=g), k, g)


def streaming_distinct(
    stream: DataFrame, value_col: str, sketch: str = "hll", group_cols=None, p: int = 12, k: int = 1024, **kw
) -> DataFrame:
    """Run ``sketch`` ("hll" or "kmv") over ``stream`` until the available
    input is consumed and return the estimate per group."""
    spark = stream.sparkSession
    if sketch == "hll":
        q, out = hll_stream(stream, value_col, p, group_cols, **kw)
        q.awaitTermination()
        return hll_stream_estimate(spark, out, p, group_cols)
    if sketch == "kmv":
        q, out = kmv_stream(stream, value_col, k, group_cols, **kw)
        q.awaitTermination()
        return kmv_stream_estimate(spark, out, k, group_cols)
    raise ValueError(f"unknown sketch {sketch!r}")


def keep_windows(out_dir: str, watermark: str, group_cols: list[str]):
    """``foreachBatch`` writer of window registers (window_start, window_end,
    groups, idx, rank, seen: the latest event time) that keeps at most two
    versions of a window on storage.

    ``open/v=<batch id>`` holds the registers of all open windows: those of the
    version before, merged with the batch. Windows that the watermark has passed
    (latest event time of all, less the delay) get no more rows; they leave the open
    table and are written once, to ``closed/batch=<batch id>``. The open table's size
    follows the open windows only. A batch that is replayed starts from the same version
    and writes the same folders again; versions older than the one before are removed."""
    keys = ["window_start", "window_end", *group_cols, "idx"]
    open_dir, closed_dir = f"{out_dir}/open", f"{out_dir}/closed"

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        older = [v for v in _versions(s, open_dir) if v < batch_id]
        rows = batch.select(*keys, "rank", "seen")
        if older:
            rows = rows.unionByName(s.read.schema(rows.schema).parquet(f"{open_dir}/v={older[-1]}"))
        rows = rows.groupBy(*keys).agg(F.max("rank").alias("rank"), F.max("seen").alias("seen")).persist()
        try:
            # The stream's watermark counts whole milliseconds.
            last = F.date_trunc("millisecond", F.max("seen")) - F.expr(f"INTERVAL {watermark}")
            passed = rows.agg(F.unix_micros(last)).first()[0]
            over = F.lit(False) if passed is None else F.unix_micros("window_end") <= passed
            closed = rows.where(over)
            if not closed.isEmpty():
                closed.drop("seen").write.mode("overwrite").parquet(f"{closed_dir}/batch={batch_id}")
            rows.where(~over).write.mode("overwrite").parquet(f"{open_dir}/v={batch_id}")
        finally:
            rows.unpersist()
        for v in older[:-1]:
            _drop_version(s, open_dir, v)

    return write


def hll_stream_windowed(
    stream: DataFrame,
    value_col: str,
    p: int,
    event_time: str,
    window: str,
    watermark: str,
    group_cols=None,
    out_dir: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
):
    """HyperLogLog registers per event-time window (tumbling ``window``) and
    group. The watermark lets Spark drop the state of closed windows, and
    ``keep_windows`` writes what each trigger updated (update mode).
    Returns (query, out_dir)."""
    spark = stream.sparkSession
    g = K._groups(group_cols)
    out_dir = out_dir or scratch_path(spark, "hll-window-registers")
    checkpoint = checkpoint or scratch_path(spark, "hll-window-checkpoint")
    idx, rank = K.hll_index_rank(F.col("h"), p)
    ts = F.col(event_time)
    if isinstance(stream.schema[event_time].dataType, T.TimestampNTZType):
        # watermarks need an instant: read the wall-clock value as UTC
        ts = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).cast("timestamp")
    regs = (
        stream.withColumn("_et", ts)
        .withWatermark("_et", watermark)
        .select(F.window("_et", window).alias("w"), "_et", *g, h60(F.col(value_col)).alias("h"))
        .where(F.col("h").isNotNull())
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "_et", *g,
            idx.alias("idx"), rank.alias("rank"),
        )
        .groupBy("window_start", "window_end", *g, "idx")
        .agg(F.max("rank").alias("rank"), F.max("_et").alias("seen"))
    )

    q = (
        regs.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(keep_windows(out_dir, watermark, g))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    return q, out_dir


def hll_window_estimate(spark: SparkSession, out_dir: str, p: int, group_cols=None) -> DataFrame:
    """(window_start, groups..., registers_used, estimate) of closed and open
    windows. A window that is just being closed is in both tables: the larger
    rank counts."""
    g = ["window_start", *K._groups(group_cols)]
    regs = _latest(spark, f"{out_dir}/open").select(*g, "idx", "rank")
    fs, closed = _fs(spark, f"{out_dir}/closed")
    if fs.exists(closed):
        regs = regs.unionByName(spark.read.parquet(f"{out_dir}/closed").select(*g, "idx", "rank"))
    return K.hll_estimate(regs.groupBy(*g, "idx").agg(F.max("rank").alias("rank")), p, g)
