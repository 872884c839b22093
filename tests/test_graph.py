import hashlib
import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from conftest import edges_df, ids_df
from tessera.operators.graph import centrality as G
from tessera.operators.graph import components as CC
from tessera.operators.graph import labelprop as LP
from tessera.operators.graph.core import graph_counts, in_degree, iterate_messages, sequential_pairs, top_n
from tessera.sources.tables import table

PATH4 = [(1, 2), (2, 3), (3, 4)]
STAR = [(0, i) for i in range(1, 5)]


def as_dict(df, col):
    return {r.id: getattr(r, col) for r in df.collect()}


def test_counts_degrees_top(spark):
    e = edges_df(spark, STAR + [(1, 1)])
    r = graph_counts(e).first()
    assert (r.vertices, r.edges) == (5, 5)
    assert as_dict(in_degree(e), "in_degree") == {1: 2, 2: 1, 3: 1, 4: 1}
    assert [x.id for x in top_n(in_degree(e), "in_degree", 2).collect()] == [1, 2]


def test_betweenness_path_and_star(spark):
    bc = as_dict(G.betweenness(edges_df(spark, PATH4)), "betweenness")
    assert math.isclose(bc[2], 2 / 3) and math.isclose(bc[3], 2 / 3) and bc[1] == 0 and bc[4] == 0
    star = as_dict(G.betweenness(edges_df(spark, STAR)), "betweenness")
    assert math.isclose(star[0], 1.0) and star[1] == 0
    raw = as_dict(G.betweenness(edges_df(spark, PATH4), directed=True, normalized=False), "betweenness")
    assert raw == {1: 0.0, 2: 2.0, 3: 2.0, 4: 0.0}


def test_closeness_and_kpp(spark):
    cl = as_dict(G.closeness(edges_df(spark, PATH4)), "closeness")
    assert cl == {1: 1 / 6, 2: 1 / 3, 3: 1.0, 4: 0.0}
    kp = as_dict(G.kpp(G.closeness(edges_df(spark, PATH4)), 4), "kpp")
    assert math.isclose(kp[1], 1 / 18)


def test_pagerank_cycle_and_sink(spark):
    pr = as_dict(G.pagerank(edges_df(spark, [(1, 2), (2, 1)]), max_iter=5), "rank")
    assert all(math.isclose(v, 1.0) for v in pr.values())
    pr2 = as_dict(G.pagerank(edges_df(spark, [(1, 2)]), reset=0.15, max_iter=3), "rank")
    assert math.isclose(pr2[1], 0.15) and math.isclose(pr2[2], 0.15 + 0.85 * 0.15)
    tol = as_dict(G.pagerank(edges_df(spark, PATH4 + [(4, 1)]), tol=1e-4, max_iter=100), "rank")
    assert all(math.isclose(v, 1.0, abs_tol=1e-3) for v in tol.values())


def test_hits_star(spark):
    h = {r.id: (r.hub, r.authority) for r in G.hits(edges_df(spark, STAR), max_iter=5).collect()}
    assert math.isclose(h[0][0], 1.0) and math.isclose(h[1][1], 0.25) and h[0][1] == 0.0


def test_weak_components(spark):
    cliques = [(a, b) for a in range(1, 4) for b in range(1, 4) if a != b]
    cliques += [(a, b) for a in range(4, 7) for b in range(4, 7) if a != b] + [(3, 4)]
    e = edges_df(spark, cliques + [(11, 10)])
    v = ids_df(spark, list(range(1, 7)) + [10, 11, 20])
    got = as_dict(CC.weak_components(e, v), "component")
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 10: 10, 11: 10, 20: 20}
    long_path = edges_df(spark, [(i + 1, i) for i in range(1, 40)])
    assert set(as_dict(CC.weak_components(long_path), "component").values()) == {1}


def test_strong_components(spark):
    e = edges_df(spark, [(1, 2), (2, 3), (3, 1), (3, 4), (5, 5), (6, 7), (7, 6), (8, 9), (9, 10), (2, 8)])
    got = as_dict(CC.strong_components(e), "component")
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 9: 9, 10: 10}


def _h32(*parts):
    return int(hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()[:8], 16)


def simulate_lpa(edges, ids, steps, partitions=1, seed=0, accept=lambda it: 1.0, labels=None, sweep=False):
    lab = dict(labels) if labels is not None else {i: i for i in ids}
    links = [(a, b) for a, b in edges] + [(b, a) for a, b in edges]
    for i in range(1, steps * partitions + 1):
        it, active = divmod(i, partitions)
        msgs = defaultdict(Counter)
        for s, d in links:
            if lab.get(s) is not None:
                if partitions > 1 and (_h32("slice", seed, d) * partitions) >> 32 != active:
                    continue
                msgs[d][lab[s]] += 1
        new = dict(lab)
        for v, c in msgs.items():
            best = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[0][0]
            ok = not sweep or lab[v] is None
            p = accept(it)
            if p < 1.0 and lab[v] is not None:
                ok = ok and _h32("accept", seed, it, v) < int(p * (1 << 32))
            if ok:
                new[v] = best
        lab = new
    return lab


def test_label_propagation_matches_simulation(spark):
    ed = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (6, 4), (6, 6), (2, 1), (7, 8)]
    ids = sorted({x for p in ed for x in p})
    e = edges_df(spark, ed)
    for steps, parts, decay in [(1, 1, 0), (3, 1, 0), (2, 2, 0), (2, 3, 0), (1, 1, 2), (2, 2, 2)]:
        acc, total = LP.annealing(steps, decay)
        want = simulate_lpa(ed, ids, total, parts, 0, acc)
        got = as_dict(LP.label_propagation(e, steps=steps, partitions=parts, decay_steps=decay), "cluster")
        assert got == want, (steps, parts, decay)


def test_seeded_propagation_and_sweep(spark):
    ed = [(1, 2), (2, 3), (3, 4), (10, 11)]
    e = edges_df(spark, ed)
    seeds = ids_df(spark, [1])
    got = as_dict(LP.seeded_propagation(e, seeds, steps=1, sweep_steps=2), "cluster")
    ids = sorted({x for p in ed for x in p})
    lab = simulate_lpa(ed, ids, 1, labels={i: (i if i == 1 else None) for i in ids})
    lab = simulate_lpa(ed, ids, 2, labels=lab, sweep=True)
    assert got == {k: (v if v is not None else -1) for k, v in lab.items()}
    assert got[10] == -1 and got[11] == -1


def test_seeded_propagation_with_decay(spark):
    ed = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (6, 4), (10, 11)]
    ids = sorted({x for p in ed for x in p})
    acc, total = LP.annealing(2, 2)
    lab = simulate_lpa(ed, ids, total, accept=acc, labels={i: (i if i in (1, 6) else None) for i in ids})
    lab = simulate_lpa(ed, ids, 2, labels=lab, sweep=True)
    got = as_dict(LP.seeded_propagation(edges_df(spark, ed), ids_df(spark, [1, 6]), steps=2, decay_steps=2), "cluster")
    assert got == {k: (v if v is not None else -1) for k, v in lab.items()}


def test_random_clusters_partition(spark):
    v = ids_df(spark, list(range(200)))
    rc = LP.random_clusters(v, 7, 3).collect()
    assert {r.cluster for r in rc} <= set(range(7)) and len(rc) == 200
    assert all(r.cluster == (_h32("slice", 3, r.id) * 7) >> 32 for r in rc)


def test_iterate_messages_max_propagation(spark):
    e = edges_df(spark, PATH4)
    v = spark.createDataFrame([(1, 5), (2, 1), (3, 9), (4, 0)], "id BIGINT, val BIGINT")

    def send(t, state):
        return t.where(F.col("src_val") > F.col("dst_val")).select("dst", F.col("src_val").alias("m"))

    def merge(msgs):
        return msgs.groupBy("dst").agg(F.max("m").alias("m"))

    def update(vs, merged, state):
        return vs.join(merged.withColumnRenamed("dst", "id"), "id", "left").select(
            "id", F.greatest("val", F.coalesce("m", "val")).alias("val")
        )

    out = as_dict(iterate_messages(v, e, send, merge, update, max_iter=10), "val")
    assert out == {1: 5, 2: 5, 3: 9, 4: 9}


def test_sequential_pairs_match_lead(spark):
    ev = table(spark, "/root/testdata/sf0.001", "events")
    got = sorted((r.src, r.dst) for r in sequential_pairs(ev, bucket_seconds=7200).collect())
    pdf = ev.select("event_type", "ts", "event_id", "user_id").toPandas()
    pdf = pdf.sort_values(["event_type", "ts", "event_id"])
    pdf["nxt"] = pdf.groupby("event_type")["user_id"].shift(-1)
    want = sorted((int(a), int(b)) for a, b in pdf.dropna()[["user_id", "nxt"]].itertuples(index=False))
    assert got == want


def test_sources_bound_all_pairs_state(spark):
    ed = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 3)]
    e = edges_df(spark, ed)
    full = as_dict(G.closeness(e), "closeness")
    part = as_dict(G.closeness(e, sources=ids_df(spark, [1, 4])), "closeness")
    assert part == {1: full[1], 4: full[4]}
    every = as_dict(G.betweenness(e, sources=ids_df(spark, [1, 2, 3, 4, 5])), "betweenness")
    assert every == as_dict(G.betweenness(e), "betweenness")


def test_iterate_messages_with_state(spark):
    e = edges_df(spark, PATH4)
    v = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 0)], "id BIGINT, val BIGINT")

    def send(t, state):
        # every superstep adds the superstep number to each receiver
        return t.select("dst", F.lit(state).alias("m"))

    def merge(msgs):
        return msgs.groupBy("dst").agg(F.sum("m").alias("m"))

    def update(vs, merged, state):
        return vs.join(merged.withColumnRenamed("dst", "id"), "id", "left").select(
            "id", (F.col("val") + F.coalesce("m", F.lit(0))).alias("val")
        )

    out = as_dict(iterate_messages(v, e, send, merge, update, max_iter=3, state=1, next_state=lambda s: s + 1), "val")
    assert out == {1: 0, 2: 6, 3: 6, 4: 6}


def test_closeness_wf_improved(spark):
    e = edges_df(spark, PATH4)
    wf = as_dict(G.closeness(e, wf_improved=True), "closeness")
    # vertex 1 reaches 3 of 3 others (sum 6); vertex 3 reaches 1 of 3 (sum 1)
    assert math.isclose(wf[1], 1 / 6) and math.isclose(wf[3], 1 / 3) and wf[4] == 0.0


def test_betweenness_sampled_sources(spark):
    cliques = [(a, b) for a in range(1, 6) for b in range(1, 6) if a != b] + [(5, 6), (6, 7)]
    e = edges_df(spark, cliques)
    exact = as_dict(G.betweenness(e), "betweenness")
    full_sample = as_dict(G.betweenness(e, sample=100), "betweenness")
    assert all(math.isclose(full_sample[k], exact[k], abs_tol=1e-12) for k in exact)
    est = as_dict(G.betweenness(e, sample=4, seed=1), "betweenness")
    assert set(est) == set(exact) and all(v >= 0 for v in est.values())


def test_pagerank_spread_dangling_matches_power_iteration(spark):
    import numpy as np

    ed = [(1, 2), (2, 3), (3, 1), (3, 4), (1, 4)]  # 4 is a sink
    ids = [1, 2, 3, 4]
    n, reset = 4, 0.15
    out = {1: [2, 4], 2: [3], 3: [1, 4], 4: []}
    r = np.ones(n)
    for _ in range(15):
        s = np.zeros(n)
        for u, vs in out.items():
            for x in vs:
                s[x - 1] += r[u - 1] / len(vs)
        mass = sum(r[u - 1] for u, vs in out.items() if not vs)
        r = reset + (1 - reset) * (s + mass / n)
    got = as_dict(G.pagerank(edges_df(spark, ed), ids_df(spark, ids), reset, 15, dangling="spread"), "rank")
    assert all(math.isclose(got[i], r[i - 1], rel_tol=1e-9) for i in ids)
    assert math.isclose(sum(got.values()), n, rel_tol=1e-9)
