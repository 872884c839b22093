import random
from collections import deque

import numpy as np
import pytest

from conftest import edges_df, ids_df
from tessera.operators.graph import centrality as G
from tessera.operators.graph import searches


def brute(pairs, ids, directed):
    """Distances and path counts by plain search: sums of distances, betweenness."""
    nxt = {v: set() for v in ids}
    for a, b in pairs:
        if a != b:
            nxt[a].add(b)
            if not directed:
                nxt[b].add(a)
    near, between = {}, dict.fromkeys(ids, 0.0)
    for s in ids:
        dist, paths, order, todo = {s: 0}, {s: 1}, [], deque([s])
        while todo:
            v = todo.popleft()
            order.append(v)
            for w in nxt[v]:
                if w not in dist:
                    dist[w], paths[w] = dist[v] + 1, 0
                    todo.append(w)
                if dist[w] == dist[v] + 1:
                    paths[w] += paths[v]
        near[s] = sum(dist.values())
        delta = dict.fromkeys(order, 0.0)
        for v in reversed(order):
            delta[v] = sum(paths[v] / paths[w] * (1 + delta[w]) for w in nxt[v] if dist[w] == dist[v] + 1)
            between[v] += delta[v] if v != s else 0.0
    return near, between


def graphs():
    rng = random.Random(17)
    yield [(rng.randrange(150), rng.randrange(150)) for _ in range(420)] + [(300, 301), (7, 7), (400, 400)]
    # Long and narrow, numbered at random, with a dense end and a second component.
    order = list(range(1000, 1090))
    rng.shuffle(order)
    dense = [(rng.choice(order[:9]), rng.choice(order[:9])) for _ in range(60)]
    yield list(zip(order, order[1:])) + dense + [(5, 6), (6, 7), (7, 5)]


@pytest.mark.parametrize("pairs", list(graphs()))
def test_searches_match_plain_search(spark, pairs):
    e = edges_df(spark, pairs)
    ids = sorted({x for p in pairs for x in p} | {9999})
    near, _ = brute(pairs, ids, True)
    for batch in (1 << 11, 64, 50):
        got = {r.id: r.closeness for r in G.closeness(e, ids_df(spark, ids), batch=batch).collect()}
        assert got == {v: 1.0 / x if x else 0.0 for v, x in near.items()}
    for directed in (True, False):
        _, between = brute(pairs, ids, directed)
        want = {v: x if directed else x / 2 for v, x in between.items()}
        for batch in (1 << 11, 7):
            got = G.betweenness(e, ids_df(spark, ids), directed=directed, normalized=False, batch=batch).collect()
            assert {r.id: r.betweenness for r in got} == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_supersteps_above_what_a_task_holds(spark):
    pairs = next(graphs())[:30]
    e = edges_df(spark, pairs)
    ids = G.vertices_of(e)
    one, many = ({r.id: (r.total, r.reached) for r in G.reach_sums(e, ids, held=h).collect()} for h in (1 << 24, 40))
    assert one == many
    one, many = ({r.id: r.betweenness for r in G.betweenness(e, held=h).collect()} for h in (1 << 24, 40))
    assert one == pytest.approx(many, abs=1e-12)


def jobs_of(spark, group, make):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    make().collect()
    sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("measure", [G.closeness, G.betweenness])
def test_levels_take_no_jobs(spark, measure):
    short, long = (edges_df(spark, [(i, i + 1) for i in range(n)]) for n in (3, 40))
    name = measure.__name__
    assert jobs_of(spark, f"{name} long", lambda: measure(long)) <= jobs_of(spark, f"{name} short", lambda: measure(short)) + 3


def test_odd_sources_and_ids(spark):
    """Null ends, sources without an arc, repeated or outside the vertices."""
    e = edges_df(spark, [(1, 2), (2, 3), (3, 4), (2, 5), (5, 4), (None, 3), (4, None)])
    every = {r.id: r.betweenness for r in G.betweenness(e, normalized=False).collect()}
    assert every == {None: 0.0, 1: 0.0, 2: 3.5, 3: 1.0, 4: 0.5, 5: 1.0}
    some = G.betweenness(e, ids_df(spark, [1, 2, 3, 4, 5]), directed=True, normalized=False, sources=ids_df(spark, [1, 4, 4, 77]))
    assert {r.id: r.betweenness for r in some.collect()} == {1: 0.0, 2: 3.0, 3: 0.5, 4: 0.0, 5: 0.5}
    near = {r.id: r.closeness for r in G.closeness(e).collect()}
    assert near == {None: 0.0, 1: 1 / 8, 2: 1 / 4, 3: 1.0, 4: 0.0, 5: 1.0}


def test_resets_of_a_report_share_supersteps(spark):
    e = edges_df(spark, [(1, 2), (2, 3), (3, 1), (3, 4), (4, 4), (5, 1)])
    resets = (0.05, 0.15, 0.3)

    def report(some):
        only = [f"pagerank_{r}" for r in some]
        return G.measure_report(e, resets=some, pagerank_iter=4, only=only)

    got = {(r.measure, r.id): r.score for r in report(resets).collect()}
    want = {(f"pagerank_{r}", x.id): x.rank for r in resets for x in G.pagerank(e, reset=r, max_iter=4).collect()}
    assert got == pytest.approx(want)
    assert jobs_of(spark, "three resets", lambda: report(resets)) < 2 * jobs_of(spark, "one reset", lambda: report(resets[:1]))


def test_sources_of_a_batch_share_arcs(monkeypatch):
    """64 sources follow few more arcs than one, in groups far apart as well."""
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 100, (2, 30, 1500)) + 100 * np.arange(30)[:, None]
    a, b = np.append(a, 100 * np.arange(29)), np.append(b, 100 * np.arange(1, 30))
    key = np.unique(np.concatenate([a << 32 | b, b << 32 | a])[np.tile(a != b, 2)])
    out = np.searchsorted(key >> 32, np.arange(3001)), key & 0xFFFFFFFF
    plain, counted = searches._arcs, []
    monkeypatch.setattr(searches, "_arcs", lambda rows, arcs: (counted.append(len(x[-1])) or x for x in plain(rows, arcs)))

    def run(sources):
        counted.clear()
        sums = np.zeros(3000)
        searches._dependencies(out, out, sources, sums)
        return sums, sum(counted)

    one = [run(np.array([s])) for s in range(64)]
    sums, followed = run(np.arange(64))
    assert sums == pytest.approx(sum(x for x, _ in one))
    assert followed < 4 * max(n for _, n in one)


def test_steps_follow_arcs_of_moving_vertices(monkeypatch):
    """A long path: all steps together follow each arc a few times, not each step all arcs."""
    n = 2000
    ends = np.minimum(np.arange(n + 1), n - 1)
    out = ends, np.arange(1, n)
    into = np.concatenate(([0], np.arange(n))), np.arange(n - 1)
    plain, counted = searches._arcs, []
    monkeypatch.setattr(searches, "_arcs", lambda rows, arcs: (counted.append(len(x[-1])) or x for x in plain(rows, arcs)))
    total, reached = np.zeros(n, np.int64), np.zeros(n, np.int64)
    searches._reach(out, into, n, n - 1, n, total, reached)
    assert (total == np.arange(n)[::-1]).all() and reached.sum() == n - 1
    assert sum(counted) < 4 * n
