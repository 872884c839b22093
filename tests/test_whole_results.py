"""Nothing is capped, dropped or left unfinished: cases beyond the fixtures."""

import random

import pytest
from conftest import edges_df, ids_df
from pyspark.sql import functions as F

from tessera.operators import cardinality as K
from tessera.operators import evaluate as E
from tessera.operators import lsh as L
from tessera.operators.bags import token_bag
from tessera.operators.graph import centrality as G
from tessera.operators.graph import components as CC
from tessera.operators.reshape import pivot, sequence_ids


def test_fallback_draws_from_the_whole_model(spark):
    n = 1500
    ids = spark.range(n).select(F.col("id").alias("m_id"))
    pool = L.fallback_pool(ids).collect()
    assert sorted(r.pos for r in pool) == list(range(n)) and len({r.m_id for r in pool}) == n
    model = spark.range(n).select((F.col("id") + 10**6).alias("doc_id"), F.concat(F.lit("m"), "id").alias("text"))
    queries = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("q"), "id").alias("text"))
    out = L.lsh_nearest(
        token_bag(queries), token_bag(model), L.lsh_signature(queries, 60, 1), L.lsh_signature(model, 60, 1)
    )
    assert out.where("fallback").count() == 200


def test_long_path_is_one_component(spark):
    path = edges_df(spark, [(i, i + 1) for i in range(300)])
    assert {r.component for r in CC.weak_components(path).collect()} == {0}
    with pytest.raises(RuntimeError, match="not finished"):
        CC.weak_components(path, max_iter=2)


def test_chain_and_cycles_of_strong_components(spark):
    chain = [(i, i + 1) for i in range(6)]
    cycles = [(100, 101), (101, 102), (102, 100), (6, 100), (102, 200), (200, 201), (201, 200)]
    got = {r.id: r.component for r in CC.strong_components(edges_df(spark, chain + cycles)).collect()}
    assert got == {**{i: i for i in range(7)}, 100: 100, 101: 100, 102: 100, 200: 200, 201: 200}
    with pytest.raises(RuntimeError, match="not finished"):
        two = [(0, 1), (1, 0), (1, 2), (2, 3), (3, 2)]
        CC.strong_components(edges_df(spark, two), max_rounds=0)


def test_tolerance_that_is_not_reached_is_an_error(spark):
    e = edges_df(spark, [(0, 1), (1, 2), (2, 0), (0, 2), (3, 0)])
    with pytest.raises(RuntimeError, match="tol"):
        G.pagerank(e, max_iter=1, tol=1e-12)
    with pytest.raises(RuntimeError, match="tol"):
        G.hits(e, max_iter=1, tol=1e-12)
    assert G.hits(e, max_iter=3, tol=None).count() == 4


def test_kmv_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 2), ("a", 3), ("a", 3)], "g STRING, v BIGINT")
    got = {r.g: r.estimate for r in K.kmv_count(df, "v", 16, "g").collect()}
    assert got == {None: 2, "a": 3}
    assert "Arrow" not in K.kmv_count(df, "v", 16, "g")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 5, 6, 23, 39])
def test_nmi_of_one_cluster_each(spark, n):
    one = spark.range(n).select("id", F.lit("x").alias("cluster"))
    r = E.nmi(one, one).first()
    assert (r.h_pred, r.h_actual, r.mi, r.nmi) == (0.0, 0.0, 0.0, None)
    many = spark.range(n).select("id", F.col("id").alias("cluster"))
    r = E.nmi(one, many).first()
    assert r.mi == 0.0 and r.h_pred == 0.0 and (r.nmi in (None, 0.0))


def test_pair_counts_above_two_to_the_32_ids(spark):
    n = 10**10
    table = spark.createDataFrame([("p", "a", n), ("p", "b", n + 1), ("q", "b", 3)], "pred STRING, actual STRING, n BIGINT")
    r = E.pair_crosstab_from(table).first()
    c2 = lambda x: x * (x - 1) // 2
    tp = c2(n) + c2(n + 1) + c2(3)
    pp, ap = c2(2 * n + 1) + c2(3), c2(n) + c2(n + 4)
    assert (int(r.tp), int(r.fp), int(r.fn)) == (tp, pp - tp, ap - tp)
    assert int(r.tn) == c2(2 * n + 4) - pp - ap + tp


def test_records_of_null_keys_and_new_types(spark):
    rows = [("a", 1), (None, 2), ("a", 3), (None, 4), ("new", 5)]
    df = spark.createDataFrame(rows, "k STRING, t BIGINT")
    seq = sequence_ids(df, "k", ["t"], F.floor(F.col("t") / 2))
    assert sorted((str(r.k), r.t, r.seq) for r in seq.collect()) == [
        ("None", 2, 1), ("None", 4, 2), ("a", 1, 1), ("a", 3, 2), ("new", 5, 1),
    ]
    assert "new" in pivot(seq.where("k is not null"), "seq", "k", "t").columns


def test_pairs_of_rows_without_a_time(spark):
    from tessera.operators.graph.core import sequential_pairs

    rows = [("a", None, 9, 4), ("a", "2024-01-01 00:10:00", 1, 1), ("a", "2024-01-01 05:00:00", 2, 2), ("a", None, 3, 3)]
    ev = spark.createDataFrame(rows, "event_type STRING, t STRING, event_id BIGINT, user_id BIGINT")
    ev = ev.select("event_type", F.to_timestamp("t").alias("ts"), "event_id", "user_id")
    assert sorted(tuple(r) for r in sequential_pairs(ev).collect()) == [(1, 2), (2, 3), (3, 4)]


def test_ranking_does_not_depend_on_the_size_of_scores(spark):
    df = spark.createDataFrame([(1, 2.110001e-12), (2, 2.110002e-12)], "id BIGINT, x DOUBLE")
    keys = [r.k for r in df.select(G.significant(F.col("x"), 12).alias("k")).collect()]
    assert keys[0] < keys[1]


def test_building_a_plan_starts_no_job(spark):
    from tessera.plans import corpus as C
    from tessera.plans.lsh import q_lsh_classify
    from tessera.plans.text import q_knn_exact

    sf = "/root/testdata/sf0.001"
    C.corpus(spark, sf), spark.sparkContext.setJobGroup("build", "plans only")
    try:
        tracker = spark.sparkContext.statusTracker()
        spark.conf.set("spark.sql.parquet.mergeSchema", "false")
        for q in (q_knn_exact, q_lsh_classify):
            q(spark, sf)
        # Reading a Parquet footer for its schema is a job of one task.
        tasks = [
            tracker.getStageInfo(s).numTasks
            for j in tracker.getJobIdsForGroup("build")
            for s in tracker.getJobInfo(j).stageIds
            if tracker.getStageInfo(s)
        ]
        assert all(t == 1 for t in tasks) and len(tasks) <= 12
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_events_without_type_or_value_are_kept(spark, tmp_path):
    from tessera.plans import cardinality, reshape

    rows = [(i, 10 + i, t, v) for i, (t, v) in enumerate([("click", 1.0), (None, 2.0), ("view", None), (None, None), ("buy", 3.0)])]
    ev = spark.createDataFrame(rows, "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")
    ev.write.parquet(f"{tmp_path}/events.parquet")
    assert cardinality.q_hll_merge(spark, str(tmp_path)).first().registers_used == 5
    assert {r.key: r.n for r in reshape.q_kv_log(spark, str(tmp_path)).collect()} == {"click": 1, "view": 1, "buy": 1, "none": 2}


def test_star_contraction_takes_few_rounds(spark, monkeypatch):
    rounds = []
    plain = CC._rounds
    monkeypatch.setattr(CC, "_rounds", lambda limit, what: (rounds.append(i) or i for i in plain(limit, what)))
    order = list(range(10_001))
    random.Random(3).shuffle(order)
    for ids in (list(range(10_001)), order):
        rounds.clear()
        got = CC.weak_components(edges_df(spark, list(zip(ids, ids[1:]))))
        assert got.count() == 10_001 and got.where("component <> 0").isEmpty()
        assert len(rounds) < 20


def test_star_contraction_matches_union_find(spark):
    rng = random.Random(8)
    pairs = [(rng.randrange(900), rng.randrange(900)) for _ in range(500)]
    pairs += [(2000, 3000 + i) for i in range(400)] + [(1500, 5000 + i) for i in range(400)] + [(2000, 1500), (7, 7), (9999, 9999)]
    up = {x: x for p in pairs for x in p}

    def root(x):
        return x if up[x] == x else root(up[x])

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    assert {r.id: r.component for r in CC.star_components(edges_df(spark, pairs)).collect()} == {x: root(x) for x in up}
    text = edges_df(spark, pairs).select(F.format_string("v%05d", "src").alias("src"), F.format_string("v%05d", "dst").alias("dst"))
    assert CC.star_components(text).where("component > id").isEmpty()
    assert CC.star_components(text.limit(0)).isEmpty()


def brute_strong(pairs, ids=()):
    """Components by mutual reachability."""
    out = {x: set() for p in pairs for x in p} | {x: set() for x in ids}
    for a, b in pairs:
        out[a].add(b)

    def reach(x):
        seen, todo = {x}, [x]
        while todo:
            for y in out[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        return seen

    r = {x: reach(x) for x in out}
    return {x: min(y for y in r[x] if x in r[y]) for x in out}


def test_long_chains_of_strong_components_take_few_rounds(spark, monkeypatch):
    rounds = []
    plain = CC._rounds
    monkeypatch.setattr(CC, "_rounds", lambda limit, what: (rounds.append(what) or i for i in plain(limit, what)))
    n = 1000
    got = CC.strong_components(edges_df(spark, [(i, i + 1) for i in range(n)]))
    assert got.count() == n + 1 and got.where("id <> component").isEmpty()
    assert rounds.count("strong components") <= 3
    n = 100
    order = list(range(5, n + 5))
    random.Random(4).shuffle(order)
    rounds.clear()
    got = CC.strong_components(edges_df(spark, list(zip(order, order[1:] + order[:1]))))
    assert got.count() == n and got.where("component <> 5").isEmpty()
    assert rounds.count("strong components") <= 8


def test_strong_components_match_reachability(spark):
    rng = random.Random(21)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(75)]
    pairs += [(100 + i, 101 + i) for i in range(9)] + [(109, 3), (7, 100), (200, 201), (201, 200), (300, 300), (310, 311)]
    pairs += [(400 - i, 399 - i) for i in range(8)] + [(392, 400), (50, 400)]
    ids = ids_df(spark, sorted({x for p in pairs for x in p} | {999}))
    got = {r.id: r.component for r in CC.strong_components(edges_df(spark, pairs), ids).collect()}
    assert got == brute_strong(pairs, [999])


def test_batches_change_no_measure(spark):
    rng = random.Random(31)
    pairs = [(rng.randrange(70), rng.randrange(70)) for _ in range(900)] + [(200, 201), (5, 5)]
    e = edges_df(spark, pairs)
    whole = {r.id: r.closeness for r in G.closeness(e).collect()}
    sources = {r.id: r.closeness for r in G.closeness(e, sources=ids_df(spark, range(70))).collect()}
    for batch in (64,):
        assert {r.id: r.closeness for r in G.closeness(e, batch=batch).collect()} == whole
    assert {k: v for k, v in whole.items() if k < 70} == pytest.approx({k: v for k, v in sources.items() if k in whole})
    for directed in (False, True):
        one = {r.id: r.betweenness for r in G.betweenness(e, directed=directed).collect()}
        cut = {r.id: r.betweenness for r in G.betweenness(e, directed=directed, batch=33).collect()}
        assert cut == pytest.approx(one, abs=1e-12)


def outer_exchanges(df):
    """Exchanges of a plan that do not belong to what it reads from a cache."""
    n, skip = 0, None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :|+-*"))
        if skip is not None and depth > skip:
            continue
        skip = depth if "InMemoryRelation" in line else None
        n += " Exchange " in line or "- Exchange" in line
    return n


def test_a_superstep_has_one_exchange(spark):
    from tessera.operators.graph import core, labelprop

    e = edges_df(spark, [(i % 50, (i * 7) % 50) for i in range(400)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with core.laid_out(e) as n:
            loop, ids = core.Loop(), spark.range(50)

            def lay(df, key):
                return loop.keep(df.repartition(n, key), now=True)

            w = lay(e.withColumn("w", F.lit(0.5)), "src")
            plain, other = lay(e, "src"), lay(e, "dst")
            ranks = lay(ids.select("id", F.lit(1.0).alias("rank"), F.lit(1.0).alias("was")), "id")
            assert outer_exchanges(G._rank_step(ranks, w, 0.15, 0.0)) == 1
            scores = lay(ids.select("id", F.lit(1.0).alias("hub"), F.lit(1.0).alias("authority")), "id")
            assert outer_exchanges(G._hits_half(scores.drop("authority"), plain, "hub", "authority")) == 1
            assert outer_exchanges(G._hits_half(scores.drop("hub"), other, "authority", "hub")) == 1
            bits = ids.select("id", F.lit(1).cast("long").alias("f0"), F.lit(1).cast("long").alias("s0"),
                              *[F.lit(0).cast("long").alias(c) for c in ("total", "reached", "d")])
            assert outer_exchanges(G._reach_step(lay(bits, "id"), other, ["f0"], ["s0"])) == 1
            labels = lay(ids.select("id", F.col("id").alias("label")), "id")
            assert outer_exchanges(labelprop._superstep(labels, plain, None, 1.0, 0, 1, False)) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.catalog.clearCache()


def test_message_loop_joins_only_the_ends_it_names(spark):
    from tessera.operators.graph import core

    e = edges_df(spark, [(1, 2), (2, 3), (3, 4), (4, 2), (9, 9)])
    v = ids_df(spark, [1, 2, 3, 4, 9]).select("id", (10 - F.col("id")).alias("w"), F.lit(0).cast("long").alias("seen"))

    def joins(message):
        return core.sent(v, e, message)._jdf.queryExecution().optimizedPlan().toString().count("Join")

    assert [joins(m) for m in (F.lit(1), F.col("src_w"), F.col("dst_w"), F.col("src_w") + F.col("dst_seen"))] == [0, 1, 1, 2]
    # The largest weight that reaches a vertex, and the step at which it came.
    got = core.message_loop(
        v, e,
        send=lambda step: F.when(F.col("src_w") > F.col("dst_w"), F.col("src_w")),
        merge=F.max("msg"),
        update=lambda step: {"w": F.coalesce("msg", "w"), "seen": F.when(F.col("msg").isNotNull(), step).otherwise(F.col("seen"))},
        state=1, next_state=lambda step: step + 1,
    )
    assert {r.id: (r.w, r.seen) for r in got.collect()} == {1: (9, 0), 2: (9, 1), 3: (9, 2), 4: (9, 3), 9: (1, 0)}
