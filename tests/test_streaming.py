
from tessera.operators import cardinality as K
from tessera.session import scratch_path
from tessera.sources.tables import table
from tessera.streaming.distinct import _versions, hll_stream, hll_stream_estimate, kmv_stream, kmv_stream_estimate

SF = "/root/testdata/sf0.001"


def _stream(spark, files=3):
    ev = table(spark, SF, "events")
    path = scratch_path(spark, "ev")
    ev.repartitionByRange(files, "event_id").write.parquet(path)
    return ev, spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch_hll(spark):
    ev, st = _stream(spark)
    q, out = hll_stream(st, "user_id", 6, "event_type")
    q.awaitTermination()
    # at least the version before the last stays for readers that opened it
    assert _versions(spark, out) == [1, 2]
    got = sorted(hll_stream_estimate(spark, out, 6, "event_type").collect())
    want = sorted(K.hll_count(ev, "user_id", 6, "event_type").collect())
    assert got == want


def test_stream_equals_batch_kmv_and_replay(spark):
    ev, st = _stream(spark)
    ck = scratch_path(spark, "ck")
    state = scratch_path(spark, "state")
    q, out = kmv_stream(st, "user_id", 16, "event_type", state_dir=state, checkpoint=ck)
    q.awaitTermination()
    want = sorted(K.kmv_count(ev, "user_id", 16, "event_type").collect())
    assert sorted(kmv_stream_estimate(spark, out, 16, "event_type").collect()) == want
    # a restart on the same checkpoint and state finds nothing new and keeps the answer
    q2, _ = kmv_stream(st, "user_id", 16, "event_type", state_dir=state, checkpoint=ck)
    q2.awaitTermination()
    assert sorted(kmv_stream_estimate(spark, out, 16, "event_type").collect()) == want


def test_empty_stream(spark):
    ev = table(spark, SF, "events").limit(0)
    path = scratch_path(spark, "empty")
    ev.write.parquet(path)
    st = spark.readStream.schema(ev.schema).parquet(path)
    q, out = kmv_stream(st, "user_id", 8)
    q.awaitTermination()
