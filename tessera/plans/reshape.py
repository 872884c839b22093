"""Registered reshaping and IO round-trip queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.bags import token_bag
from tessera.operators.classify import majority_vote
from tessera.operators.graph.core import message_loop
from tessera.operators.reshape import pivot, sequence_ids, tag_union, unpivot
from tessera.operators.similarity import knn_exact
from tessera.plans import corpus as C
from tessera.plans import graph as GP
from tessera.plans import text as TX
from tessera.session import scratch_path
from tessera.sources import io
from tessera.sources.tables import table

# Fixed value: the event types the SQL twins list by name; the queries take
# the keys from the data, so another type shows as a difference.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _daily(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count(F.lit(1)).cast("double").alias("n_events"), F.round(F.sum("value"), 4).alias("total_value")
    )


def q_query_sample(spark, sf_dir):
    return C.query_sample(spark, sf_dir).select("doc_id", "label")


def q_events_unpivot(spark, sf_dir):
    return unpivot(_daily(spark, sf_dir), ["day", "event_type"], ["n_events", "total_value"])


def q_events_pivot(spark, sf_dir):
    daily = _daily(spark, sf_dir).select("day", "event_type", F.col("n_events").cast("bigint").alias("n"))
    return pivot(daily, "day", "event_type", "n")


def q_events_records(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    seq = sequence_ids(ev, "event_type", ["ts", "event_id"], F.date_trunc("hour", "ts"))
    return pivot(seq.select("seq", "event_type", "value"), "seq", "event_type", "value")


def q_edge_list_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "edge-pairs")
    io.write_long_pairs(GP.edges(spark, sf_dir), path, ("src", "dst"))
    return io.read_long_pairs(spark, path, ("src", "dst"))


def q_edge_list(spark, sf_dir):
    """Edges written as text lines and read with the tolerant reader."""
    path = scratch_path(spark, "edge-list")
    io.write_long_pairs(GP.edges(spark, sf_dir), path, ("src", "dst"))
    return io.read_edge_list(spark, path)


def q_kv_log(spark, sf_dir):
    """A key/value log (event type and id per line, in event order) written
    as one sorted text file set, read back and numbered per file and line."""
    path = scratch_path(spark, "kv-log")
    ev = table(spark, sf_dir, "events")
    ev.select(
        F.concat_ws(" ", F.coalesce("event_type", F.lit("none")), F.col("event_id").cast("string")).alias("value"), "event_id"
    ).repartitionByRange("event_id").sortWithinPartitions("event_id").select("value").write.text(path)
    log = io.read_kv_log(spark, path)
    # Event ids rise along the lines of every file.
    place = Window.partitionBy("file").orderBy("value")
    rows = log.withColumn("by_value", F.row_number().over(place) - 1)
    return rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("bigint")).alias("ids"),
        F.count_if(F.col("by_value") == F.col("line_no")).alias("in_order"),
    )


def _corpus_tree(spark, sf_dir):
    """The labelled documents as a tree of files; those of toxic documents are
    not valid UTF-8."""
    path = scratch_path(spark, "corpus-tree")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"), "toxic")
    broken = F.concat(F.unhex(F.lit("FF")).cast("string"), F.coalesce("text", F.lit("")))
    rows = docs.join(labels, "doc_id").select(
        F.col("source").alias("set"), "label", "doc_id", F.when(F.col("toxic") == 1, broken).otherwise(F.col("text")).alias("text")
    )
    io.write_corpus_tree(rows, path)
    return path


def _tree_counts(found):
    text = F.when(F.col("valid"), F.length("text") - 1)  # without the line end of the file
    return found.groupBy("set", F.col("label").cast("int").alias("label")).agg(
        F.count_if("valid").alias("n_read"), F.count_if(~F.col("valid")).alias("n_dropped"),
        F.coalesce(F.sum(text), F.lit(0)).alias("n_chars"),
    )


def q_corpus_tree(spark, sf_dir):
    """Written as one file a message, read back: files read and dropped."""
    return _tree_counts(io.read_messages(spark, [_corpus_tree(spark, sf_dir)], io.TREE))


def q_stream_corpus_tree(spark, sf_dir):
    """The same tree as a file stream."""
    found = io.stream_messages(spark, _corpus_tree(spark, sf_dir), io.TREE)
    out = scratch_path(spark, "corpus-stream")
    io.stream_to_files(found, out)
    return _tree_counts(spark.read.schema(found.schema).parquet(out))


def q_log_records(spark, sf_dir):
    """A key/value log of two lines per event (time, then value) read back,
    turned into one record per event, with the columns of a chart derived: time
    in days, value in thousands, zero shown as a half for a log axis."""
    path = scratch_path(spark, "record-log")
    ev = table(spark, sf_dir, "events").select("event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"), "value")
    lines = F.array(F.format_string("Time %d", "at"), F.concat(F.lit("Mem "), F.coalesce("value", F.lit(0.0)).cast("string")))
    ev.where(F.col("at").isNotNull()).repartitionByRange("event_id").sortWithinPartitions("event_id").select(
        F.explode(lines).alias("value")
    ).write.text(path)
    log = io.read_kv_log(spark, path).withColumn("seq", F.floor(F.col("line_no") / 2))
    records = log.groupBy("file_no", "seq").pivot("key", ["Time", "Mem"]).agg(F.first("value"))
    derived = records.select(
        F.floor(F.col("Time") / 86400).cast("bigint").alias("day"),
        (F.col("Mem") / 1e3).alias("thousands"),
        F.when(F.col("Mem") == 0, 0.5).otherwise(F.col("Mem")).alias("shown"),
    )
    return derived.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.max("thousands").alias("most_thousands"), F.min("shown").alias("least_shown")
    )


def q_tagged_union(spark, sf_dir):
    """Balances of customers and suppliers as one tagged table."""
    cust, supp = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    parts = {
        "customer": cust.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance")),
        "supplier": supp.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance")),
    }
    return tag_union(parts, "kind")


def q_knn_saved_model(spark, sf_dir):
    """Save the exact model (bag + labels), load it back, classify."""
    model = C.model(spark, sf_dir)
    path = scratch_path(spark, "knn-model")
    io.save_model(
        path,
        {"bag": token_bag(model), "labels": model.select(F.col("doc_id").alias("m_id"), "label")},
        {"k": TX.K, "kind": "exact"},
    )
    parts, params = io.load_model(spark, path, ["bag", "labels"])
    qs = C.holdout(spark, sf_dir)
    nn = knn_exact(token_bag(qs), parts["bag"], params["k"]).select("q_id", "m_id")
    votes = majority_vote(nn, parts["labels"])
    return (
        qs.select(F.col("doc_id").alias("q_id"), "label").join(votes, "q_id", "left").select("q_id", "label", "predicted")
    )


QUERIES = {
    "corpus_tree": q_corpus_tree,
    "stream_corpus_tree": q_stream_corpus_tree,
    "log_records": q_log_records,
    "query_sample": q_query_sample,
    "events_unpivot": q_events_unpivot,
    "events_pivot": q_events_pivot,
    "events_records": q_events_records,
    "edge_list_roundtrip": q_edge_list_roundtrip,
    "edge_list": q_edge_list,
    "kv_log": q_kv_log,
    "tagged_union": q_tagged_union,
    "knn_saved_model": q_knn_saved_model,
}

_DAILY = """daily AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*)::DOUBLE AS n_events,
  round(SUM(value), 4) AS total_value FROM events GROUP BY 1, 2)"""

ORACLES = {
    "query_sample": f"WITH {C.CORPUS_CTES} SELECT doc_id, label FROM qsample",
    "events_unpivot": f"""WITH {_DAILY}
SELECT day, event_type, 'n_events' AS variable, n_events AS value FROM daily
UNION ALL SELECT day, event_type, 'total_value', total_value FROM daily""",
    "events_pivot": f"""WITH {_DAILY} SELECT day, """
    + ", ".join(f"max(n_events::BIGINT) FILTER (WHERE event_type = '{t}') AS {t}" for t in EVENT_TYPES)
    + " FROM daily GROUP BY day",
    "events_records": """WITH s AS (SELECT event_type, value,
  row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS seq FROM events)
SELECT seq, """
    + ", ".join(f"max(value) FILTER (WHERE event_type = '{t}') AS {t}" for t in EVENT_TYPES)
    + " FROM s GROUP BY seq",
    "edge_list": f"WITH {GP.GRAPH} SELECT src, dst FROM g_edges",
    **dict.fromkeys(("corpus_tree", "stream_corpus_tree"), """SELECT d.source AS set, l.quality AS label,
  count(*) FILTER (WHERE coalesce(l.toxic, 0) <> 1) AS n_read, count(*) FILTER (WHERE l.toxic = 1) AS n_dropped,
  coalesce(sum(length(coalesce(d.text, ''))) FILTER (WHERE coalesce(l.toxic, 0) <> 1), 0)::BIGINT AS n_chars
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2"""),
    "log_records": """SELECT floor(epoch(ts) / 86400)::BIGINT AS day, count(*) AS n,
  max(coalesce(value, 0.0) / 1e3::DOUBLE) AS most_thousands,
  min(CASE WHEN coalesce(value, 0.0) = 0 THEN 0.5 ELSE value END) AS least_shown
FROM events WHERE ts IS NOT NULL GROUP BY 1""",
    "kv_log": """SELECT coalesce(event_type, 'none') AS key, count(*) AS n, sum(event_id)::BIGINT AS ids, count(*) AS in_order
FROM events GROUP BY 1""",
    "tagged_union": """SELECT 'customer' AS kind, c_custkey AS key, c_acctbal AS balance FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier""",
    "edge_list_roundtrip": f"WITH {GP.GRAPH} SELECT src, dst FROM g_edges",
    "knn_saved_model": TX.ORACLES["knn_classify"],
}


# ---- message passing, metrics sinks --------------------------------------------


def q_message_lpa(spark, sf_dir):
    """Partitioned label propagation as Column expressions: the state is the
    superstep's number, from which iteration and active slice follow."""
    e = GP.edges(spark, sf_dir)
    steps, parts, seed = GP.PLPA["steps"], GP.PLPA["partitions"], GP.PLPA["seed"]
    start = GP.vertices_of(e).select("id", F.col("id").alias("label"))
    active = lambda i: GP.LP.slice_of(F.col("dst"), parts, seed) == F.lit(i % parts)
    out = message_loop(
        start, GP.LP.links_of(e),
        send=lambda i: F.when(active(i), F.col("src_label")),
        merge=F.mode("msg", True),  # the most frequent label, of equals the least
        update=lambda i: {"label": F.coalesce("msg", "label")},
        max_iter=steps * parts, state=1, next_state=lambda i: i + 1,
    )
    return out.select("id", F.col("label").alias("cluster"))


def q_min_label_components(spark, sf_dir):
    """Weak components through the generic message-passing loop: every
    vertex sends its label to neighbours with a larger one; receivers keep
    the smallest; stop when no message is sent."""
    return _min_label(GP.edges(spark, sf_dir))


def q_min_label_forest(spark, sf_dir):
    """The same loop on a graph of many components."""
    return _min_label(GP.forest_edges(spark, sf_dir))


def _min_label(edges):
    from tessera.operators.graph.core import iterate_messages, simple_edges, vertices_of

    e = simple_edges(edges, directed=False)
    v = vertices_of(e).select("id", F.col("id").alias("lab"))

    def send(t, state):
        return t.where(F.col("src_lab") < F.col("dst_lab")).select("dst", F.col("src_lab").alias("m"))

    def merge(msgs):
        return msgs.groupBy("dst").agg(F.min("m").alias("m"))

    def update(vs, merged, state):
        return vs.join(merged.withColumnRenamed("dst", "id"), "id", "left").select(
            "id", F.least("lab", F.coalesce("m", "lab")).alias("lab")
        )

    out = iterate_messages(v, e, send, merge, update)
    return out.select("id", F.col("lab").alias("component"))


def q_lsh_sweep_csv(spark, sf_dir):
    """The plane sweep written as a CSV metrics file and read back."""
    from pyspark.sql import types as T

    from tessera.plans.lsh import q_lsh_sweep

    path = scratch_path(spark, "sweep-csv")
    io.write_metrics_csv(q_lsh_sweep(spark, sf_dir), path)
    schema = T.StructType(
        [
            T.StructField("num_hyperplanes", T.IntegerType()),
            T.StructField("queries", T.LongType()),
            T.StructField("mean_abs_err", T.DoubleType()),
            T.StructField("fallbacks", T.LongType()),
        ]
    )
    return io.read_metrics_csv(spark, path, schema)


def q_rmse_json(spark, sf_dir):
    """The RMSE experiment as one JSON object of arrays per algorithm
    (sizes in order), parsed back to (algorithm, pos, value)."""
    from tessera.plans.cardinality import q_estimator_rmse

    js = io.metrics_to_json(q_estimator_rmse(spark, sf_dir), "algorithm", "rmse", "size")
    return io.metrics_from_json(js).select("algorithm", F.col("pos").cast("int").alias("pos"), "value")


QUERIES.update(
    {
        "message_lpa": q_message_lpa,
        "min_label_components": q_min_label_components,
        "min_label_forest": q_min_label_forest,
        "lsh_sweep_csv": q_lsh_sweep_csv,
        "rmse_json": q_rmse_json,
    }
)


def _oracles_late():
    from tessera.plans import cardinality as CA
    from tessera.plans import lsh as LS

    return {
        "message_lpa": GP.ORACLES["lpa_partitioned"],
        "min_label_components": GP.components_sql(False),
        "min_label_forest": GP.components_sql(False, GP.FOREST_GRAPH),
        "lsh_sweep_csv": LS.ORACLES["lsh_sweep"],
        "rmse_json": f"""SELECT algorithm, (row_number() OVER (PARTITION BY algorithm ORDER BY size) - 1)::INTEGER AS pos,
  rmse AS value FROM ({CA.ORACLES['estimator_rmse']})""",
    }


ORACLES.update(_oracles_late())
