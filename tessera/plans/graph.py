"""Registered graph queries on the user graph of ``events`` and their SQL.

The graph: distinct (user, next user of the same event type in (ts,
event_id) order) pairs over the whole events table; self loops kept.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import h32_sql
from tessera.operators.graph import centrality as G
from tessera.operators.graph import components as CC
from tessera.operators.graph import labelprop as LP
from tessera.operators.graph.core import graph_counts, in_degree, out_degree, top_n, user_graph, vertices_of
from tessera.sources.tables import table

PR_ITER, PR_RESET, PR_TOL = 10, 0.15, 0.001
PR_UNROLLED = 40  # supersteps written out in the SQL twins of the tolerance mode
HITS_ITER = 10
HITS_TOL, HITS_UNROLLED = 1e-6, 30
LPA_STEPS = 5
PLPA = dict(steps=2, partitions=2, seed=0)
ANNEAL = dict(steps=1, decay_steps=2)
SEEDED = dict(n=5, steps=2)
RANDOM_P = 42
BFS_DEPTH = 12  # unrolled depth of the SQL twins (the graph's diameter is far below)


def edges(spark, sf_dir):
    return user_graph(table(spark, sf_dir, "events"))


def _r(col, d=9):
    return F.round(col, d).alias(col)


def q_graph_counts(spark, sf_dir):
    return graph_counts(edges(spark, sf_dir))


def q_in_degree(spark, sf_dir):
    return in_degree(edges(spark, sf_dir))


def q_out_degree(spark, sf_dir):
    return out_degree(edges(spark, sf_dir))


def q_top_in_degree(spark, sf_dir):
    return top_n(in_degree(edges(spark, sf_dir)), "in_degree", 5)


def q_pagerank_k(spark, sf_dir):
    return G.pagerank(edges(spark, sf_dir), reset=PR_RESET, max_iter=PR_ITER).select("id", _r("rank", 6))


def q_pagerank(spark, sf_dir, reset=PR_RESET):
    """Tolerance mode (0.001)."""
    return G.pagerank(edges(spark, sf_dir), reset=reset, max_iter=200, tol=PR_TOL).select("id", _r("rank", 6))


def q_pagerank_reset_low(spark, sf_dir):
    return q_pagerank(spark, sf_dir, 0.05)


def q_pagerank_reset_high(spark, sf_dir):
    return q_pagerank(spark, sf_dir, 0.3)


def q_hits_k(spark, sf_dir):
    return G.hits(edges(spark, sf_dir), max_iter=HITS_ITER, tol=None).select("id", _r("hub"), _r("authority"))


def q_hits(spark, sf_dir):
    """Tolerance mode (1e-6)."""
    return G.hits(edges(spark, sf_dir), tol=HITS_TOL).select("id", _r("hub", 6), _r("authority", 6))


def q_closeness(spark, sf_dir):
    return G.closeness(edges(spark, sf_dir)).select("id", _r("closeness"))


def q_kpp(spark, sf_dir):
    e = edges(spark, sf_dir)
    n = vertices_of(e).count()
    return G.kpp(G.closeness(e), n).select("id", G.significant(F.col("kpp"), 9).alias("kpp"))


def q_betweenness(spark, sf_dir):
    return G.betweenness(edges(spark, sf_dir)).select("id", _r("betweenness"))


def q_weak_components(spark, sf_dir):
    return CC.weak_components(edges(spark, sf_dir))


def q_strong_components(spark, sf_dir):
    return CC.strong_components(edges(spark, sf_dir))


def forest_edges(spark, sf_dir):
    """Customers and suppliers to their nations, nations to their regions and
    back: as many weak components as regions, with hubs, and a strong one
    (a region and its nations) in each."""
    def key(name, col, base):
        return (F.col(col) + base).cast("bigint").alias(name)

    cust, supp, nat = (table(spark, sf_dir, t) for t in ("customer", "supplier", "nation"))
    return (
        cust.select(key("src", "c_custkey", 1_000_000_000), key("dst", "c_nationkey", 100))
        .union(supp.select(key("src", "s_suppkey", 1_000_000), key("dst", "s_nationkey", 100)))
        .union(nat.select(key("src", "n_nationkey", 100), key("dst", "n_regionkey", 0)))
        .union(nat.select(key("src", "n_regionkey", 0), key("dst", "n_nationkey", 100)))
        .distinct()
    )


def q_weak_components_forest(spark, sf_dir):
    return CC.weak_components(forest_edges(spark, sf_dir))


def q_strong_components_forest(spark, sf_dir):
    return CC.strong_components(forest_edges(spark, sf_dir))


def q_lpa_k(spark, sf_dir):
    return LP.label_propagation(edges(spark, sf_dir), steps=LPA_STEPS)


def q_lpa_partitioned(spark, sf_dir):
    return LP.label_propagation(edges(spark, sf_dir), **PLPA)


def q_lpa_annealed(spark, sf_dir):
    return LP.label_propagation(edges(spark, sf_dir), **ANNEAL)


def q_lpa_seeded(spark, sf_dir):
    e = edges(spark, sf_dir)
    seeds = LP.central_vertices(e, "outdeg", SEEDED["n"])
    return LP.seeded_propagation(e, seeds, steps=SEEDED["steps"])


def q_lpa_seeded_annealed(spark, sf_dir):
    """Seeds by in-degree, with falling acceptance before the sweep."""
    return LP.cluster(
        edges(spark, sf_dir), "authorities", centrality="indeg", n=SEEDED["n"], **ANNEAL
    )


def q_lpa_seeded_hubs(spark, sf_dir):
    return LP.cluster(edges(spark, sf_dir), "authorities", centrality="hubs", **SEEDED)


def q_lpa_seeded_auths(spark, sf_dir):
    return LP.cluster(edges(spark, sf_dir), "authorities", centrality="auths", **SEEDED)


def q_rank_report(spark, sf_dir):
    """Top vertices by HITS and PageRank, each run to its tolerance."""
    rep = G.measure_report(
        edges(spark, sf_dir), 5, REPORT_RESETS, 200, hits_tol=HITS_TOL, pagerank_tol=PR_TOL,
        only=("hub", "authority", *(f"pagerank_{r}" for r in REPORT_RESETS)),
    )
    return rep.select("measure", "position", "id", G.significant(F.col("score"), 5).alias("score"))


def q_random_clusters(spark, sf_dir):
    return LP.random_clusters(vertices_of(edges(spark, sf_dir)), RANDOM_P, 0)


REPORT_RESETS, REPORT_PR_ITER = (0.05, 0.15, 0.3), 20


def q_measure_report(spark, sf_dir):
    rep = G.measure_report(
        edges(spark, sf_dir), 5, REPORT_RESETS, REPORT_PR_ITER, hits_iter=HITS_ITER, hits_tol=None
    )
    return rep.select("measure", "position", "id", G.significant(F.col("score"), 6).alias("score"))


QUERIES = {
    "graph_counts": q_graph_counts,
    "in_degree": q_in_degree,
    "out_degree": q_out_degree,
    "top_in_degree": q_top_in_degree,
    "pagerank_k": q_pagerank_k,
    "pagerank": q_pagerank,
    "pagerank_reset_low": q_pagerank_reset_low,
    "pagerank_reset_high": q_pagerank_reset_high,
    "hits_k": q_hits_k,
    "hits": q_hits,
    "lpa_seeded_hubs": q_lpa_seeded_hubs,
    "lpa_seeded_auths": q_lpa_seeded_auths,
    "rank_report": q_rank_report,
    "closeness": q_closeness,
    "kpp": q_kpp,
    "betweenness": q_betweenness,
    "weak_components": q_weak_components,
    "strong_components": q_strong_components,
    "weak_components_forest": q_weak_components_forest,
    "strong_components_forest": q_strong_components_forest,
    "lpa_k": q_lpa_k,
    "lpa_partitioned": q_lpa_partitioned,
    "lpa_annealed": q_lpa_annealed,
    "lpa_seeded": q_lpa_seeded,
    "lpa_seeded_annealed": q_lpa_seeded_annealed,
    "random_clusters": q_random_clusters,
    "measure_report": q_measure_report,
}

# ---- SQL twins ---------------------------------------------------------------

GRAPH = """g_edges AS (SELECT DISTINCT user_id AS src, nxt AS dst FROM (
    SELECT user_id, lead(user_id) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS nxt FROM events)
  WHERE nxt IS NOT NULL),
verts AS (SELECT src AS id FROM g_edges UNION SELECT dst FROM g_edges)"""


def pagerank_sql(k: int, reset: float, digits: int = 6, tol: float | None = None) -> str:
    parts = [
        GRAPH,
        "od AS (SELECT src, count(*) AS outdeg FROM g_edges GROUP BY 1)",
        "w AS (SELECT e.src, e.dst, 1.0::DOUBLE / od.outdeg AS w FROM g_edges e JOIN od USING (src))",
        "r0 AS (SELECT id, 1.0::DOUBLE AS rank FROM verts)",
    ]
    for i in range(1, k + 1):
        parts.append(
            f"""r{i} AS MATERIALIZED (SELECT v.id, {reset!r}::DOUBLE + {1.0 - reset!r}::DOUBLE * COALESCE(x.s, 0.0) AS rank
  FROM verts v LEFT JOIN (SELECT w.dst, SUM(r.rank * w.w) AS s FROM w JOIN r{i - 1} r ON r.id = w.src GROUP BY 1) x
  ON x.dst = v.id)"""
        )
    if tol is None:
        return "WITH " + ",\n".join(parts) + f"\nSELECT id, round(rank, {digits}) AS rank FROM r{k}"
    # The first step whose largest change is within the tolerance.
    parts += [
        f"d{i} AS (SELECT {i} AS step, max(abs(a.rank - b.rank)) AS d FROM r{i} a JOIN r{i - 1} b USING (id))"
        for i in range(1, k + 1)
    ]
    deltas = " UNION ALL ".join(f"SELECT * FROM d{i}" for i in range(1, k + 1))
    ranks = " UNION ALL ".join(f"SELECT {i} AS step, id, rank FROM r{i}" for i in range(1, k + 1))
    parts.append(f"stop AS (SELECT min(step) AS step FROM ({deltas}) WHERE d <= {tol!r})")
    return (
        "WITH " + ",\n".join(parts)
        + f"\nSELECT id, round(rank, {digits}) AS rank FROM ({ranks}) JOIN stop USING (step)"
    )


def hits_parts(k: int) -> list[str]:
    parts = [GRAPH, "h0 AS (SELECT id, 1.0::DOUBLE AS hub FROM verts)"]
    for i in range(1, k + 1):
        parts.append(
            f"""ar{i} AS MATERIALIZED (SELECT v.id, COALESCE(x.s, 0.0) AS auth FROM verts v LEFT JOIN (
  SELECT e.dst, SUM(h.hub) AS s FROM g_edges e JOIN h{i - 1} h ON h.id = e.src GROUP BY 1) x ON x.dst = v.id)"""
        )
        parts.append(f"a{i} AS MATERIALIZED (SELECT id, auth / (SELECT SUM(auth) FROM ar{i}) AS auth FROM ar{i})")
        parts.append(
            f"""hr{i} AS MATERIALIZED (SELECT v.id, COALESCE(x.s, 0.0) AS hub FROM verts v LEFT JOIN (
  SELECT e.src, SUM(a.auth) AS s FROM g_edges e JOIN a{i} a ON a.id = e.dst GROUP BY 1) x ON x.src = v.id)"""
        )
        parts.append(f"h{i} AS MATERIALIZED (SELECT id, hub / (SELECT SUM(hub) FROM hr{i}) AS hub FROM hr{i})")
    return parts


def hits_tol_parts(k: int, tol: float) -> list[str]:
    """The first of k steps, from the second on, that moves no score more than ``tol``."""
    parts = hits_parts(k)
    parts += [
        f"""hd{i} AS (SELECT {i} AS step, max(greatest(abs(h.hub - g.hub), abs(a.auth - b.auth))) AS d
  FROM h{i} h JOIN h{i - 1} g USING (id) JOIN a{i} a USING (id) JOIN a{i - 1} b USING (id))"""
        for i in range(2, k + 1)
    ]
    deltas = " UNION ALL ".join(f"SELECT * FROM hd{i}" for i in range(2, k + 1))
    scores = " UNION ALL ".join(
        f"SELECT {i} AS step, id, hub, auth FROM h{i} JOIN a{i} USING (id)" for i in range(2, k + 1)
    )
    parts.append(f"hstop AS (SELECT min(step) AS step FROM ({deltas}) WHERE d <= {tol!r})")
    parts.append(f"hits AS (SELECT id, hub, auth AS authority FROM ({scores}) JOIN hstop USING (step))")
    return parts


def hits_sql(k: int, digits: int = 9) -> str:
    return (
        "WITH " + ",\n".join(hits_parts(k))
        + f"\nSELECT h.id, round(h.hub, {digits}) AS hub, round(a.auth, {digits}) AS authority FROM h{k} h JOIN a{k} a USING (id)"
    )


def bfs_sql(edge_cte: str, depth: int, with_sigma: bool) -> list[str]:
    sig0 = ", 1.0::DOUBLE AS sigma" if with_sigma else ""
    parts = [f"b0 AS (SELECT id AS s, id AS v, 0 AS d{sig0} FROM verts)", "seen0 AS (SELECT s, v FROM b0)"]
    for i in range(1, depth + 1):
        if with_sigma:
            body = f"""SELECT f.s, e.dst AS v, {i} AS d, SUM(f.sigma) AS sigma FROM b{i - 1} f JOIN {edge_cte} e ON e.src = f.v
  WHERE NOT EXISTS (SELECT 1 FROM seen{i - 1} x WHERE x.s = f.s AND x.v = e.dst) GROUP BY 1, 2"""
        else:
            body = f"""SELECT DISTINCT f.s, e.dst AS v, {i} AS d FROM b{i - 1} f JOIN {edge_cte} e ON e.src = f.v
  WHERE NOT EXISTS (SELECT 1 FROM seen{i - 1} x WHERE x.s = f.s AND x.v = e.dst)"""
        parts.append(f"b{i} AS MATERIALIZED ({body})")
        parts.append(f"seen{i} AS MATERIALIZED (SELECT s, v FROM seen{i - 1} UNION ALL SELECT s, v FROM b{i})")
    cols = "s, v, d" + (", sigma" if with_sigma else "")
    parts.append("allp AS (" + " UNION ALL ".join(f"SELECT {cols} FROM b{i}" for i in range(depth + 1)) + ")")
    return parts


SIMPLE = "se AS (SELECT DISTINCT src, dst FROM g_edges WHERE src <> dst)"
UNDIRECTED = "ue AS (SELECT src, dst FROM se UNION SELECT dst, src FROM se)"


def closeness_sql(kpp: bool, raw: bool = False) -> str:
    parts = [GRAPH, SIMPLE] + bfs_sql("se", BFS_DEPTH, False)
    parts.append(
        "cl AS (SELECT s AS id, CASE WHEN SUM(d) > 0 THEN 1.0 / SUM(d) ELSE 0.0 END AS closeness FROM allp GROUP BY 1)"
    )
    if kpp:
        score = "closeness / ((SELECT count(*) FROM verts) - 1)"
        score = score if raw else f"printf('%.8e', {score})::DOUBLE"
        return "WITH " + ",\n".join(parts) + f"\nSELECT id, {score} AS kpp FROM cl"
    score = "closeness" if raw else "round(closeness, 9)"
    return "WITH " + ",\n".join(parts) + f"\nSELECT id, {score} AS closeness FROM cl"


def betweenness_sql(raw: bool = False) -> str:
    parts = [GRAPH, SIMPLE, UNDIRECTED] + bfs_sql("ue", BFS_DEPTH, True)
    parts.append(
        """pd AS (SELECT sv.v AS id, SUM(sv.sigma * vt.sigma / st.sigma) AS b
  FROM allp sv JOIN allp vt ON vt.s = sv.v JOIN allp st ON st.s = sv.s AND st.v = vt.v
  WHERE sv.d > 0 AND vt.d > 0 AND sv.d + vt.d = st.d GROUP BY 1)"""
    )
    parts.append("n AS (SELECT count(*)::DOUBLE AS n FROM verts)")
    score = "COALESCE(pd.b, 0.0) / ((n - 1) * (n - 2))"
    score = score if raw else f"round({score}, 9)"
    return "WITH " + ",\n".join(parts) + f"""
SELECT v.id, {score} AS betweenness
FROM verts v LEFT JOIN pd USING (id), n"""


FOREST_GRAPH = """g_edges AS (SELECT 1000000000 + c_custkey AS src, (100 + c_nationkey)::BIGINT AS dst FROM customer
  UNION SELECT 1000000 + s_suppkey, 100 + s_nationkey FROM supplier
  UNION SELECT 100 + n_nationkey, n_regionkey FROM nation
  UNION SELECT n_regionkey, 100 + n_nationkey FROM nation),
verts AS (SELECT src AS id FROM g_edges UNION SELECT dst FROM g_edges)"""


def components_sql(strong: bool, graph: str = GRAPH) -> str:
    e = "se" if strong else "ue"
    head = f"""WITH RECURSIVE {graph}, {SIMPLE}, {UNDIRECTED},
reach(a, b) AS (SELECT id, id FROM verts UNION SELECT r.a, e.dst FROM reach r JOIN {e} e ON e.src = r.b)"""
    if strong:
        return head + """
SELECT r1.a AS id, min(r1.b) AS component FROM reach r1 JOIN reach r2 ON r2.a = r1.b AND r2.b = r1.a GROUP BY 1"""
    return head + "\nSELECT a AS id, min(b) AS component FROM reach GROUP BY 1"


def lpa_sql(
    steps: int,
    partitions: int = 1,
    seed: int = 0,
    accept=LP.always_accept,
    init: str = "SELECT id, id AS label FROM verts",
    extra: list[str] | None = None,
    sweep_steps: int = 0,
) -> str:
    parts = [GRAPH] + (extra or []) + [
        "links AS (SELECT src, dst FROM g_edges UNION ALL SELECT dst, src FROM g_edges)",
        f"l0 AS ({init})",
    ]
    n = 0

    def step(i_global: int, it: int, active: int, sweep: bool):
        nonlocal n
        n += 1
        where = ""
        if partitions > 1:
            sl = f"(({h32_sql('k.dst', 'slice', seed)} * {partitions}) >> 32)"
            where = f" AND {sl} = {active}"
        p = accept(it)
        take = "b.new IS NOT NULL"
        if sweep:
            take += " AND v.label IS NULL"
        if p < 1.0:
            u = h32_sql("v.id", "accept", seed, it)
            take += f" AND (v.label IS NULL OR {u} < {int(p * LP.TWO32)})"
        parts.append(
            f"""c{n} AS MATERIALIZED (SELECT k.dst, l.label AS msg, count(*) AS cnt FROM links k
  JOIN l{n - 1} l ON l.id = k.src WHERE l.label IS NOT NULL{where} GROUP BY 1, 2),
b{n} AS (SELECT dst, msg AS new FROM (SELECT *, row_number() OVER (PARTITION BY dst ORDER BY cnt DESC, msg) AS o
  FROM c{n}) WHERE o = 1),
l{n} AS MATERIALIZED (SELECT v.id, CASE WHEN {take} THEN b.new ELSE v.label END AS label
  FROM l{n - 1} v LEFT JOIN b{n} b ON b.dst = v.id)"""
        )

    for i in range(1, steps * partitions + 1):
        it, active = divmod(i, partitions)
        step(i, it, active, False)
    for i in range(1, sweep_steps * partitions + 1):
        it, active = divmod(i, partitions)
        step(i, it, active, True)
    return "WITH " + ",\n".join(parts) + f"\nSELECT id, COALESCE(label, -1) AS cluster FROM l{n}"


_acc, _tot = LP.annealing(ANNEAL["steps"], ANNEAL["decay_steps"])
_SEEDS = "seeds AS (SELECT src AS id FROM g_edges GROUP BY 1 ORDER BY count(*) DESC, src LIMIT 5)"

ORACLES = {
    "graph_counts": f"""WITH {GRAPH} SELECT (SELECT count(*) FROM verts)::BIGINT AS vertices,
  (SELECT count(*) FROM g_edges)::BIGINT AS edges""",
    "in_degree": f"WITH {GRAPH} SELECT dst AS id, count(*)::BIGINT AS in_degree FROM g_edges GROUP BY 1",
    "out_degree": f"WITH {GRAPH} SELECT src AS id, count(*)::BIGINT AS out_degree FROM g_edges GROUP BY 1",
    "top_in_degree": f"""WITH {GRAPH} SELECT dst AS id, count(*)::BIGINT AS in_degree FROM g_edges GROUP BY 1
  ORDER BY in_degree DESC, id LIMIT 5""",
    "pagerank_k": pagerank_sql(PR_ITER, PR_RESET),
    "pagerank": pagerank_sql(PR_UNROLLED, PR_RESET, tol=PR_TOL),
    "pagerank_reset_low": pagerank_sql(PR_UNROLLED, 0.05, tol=PR_TOL),
    "pagerank_reset_high": pagerank_sql(PR_UNROLLED, 0.3, tol=PR_TOL),
    "hits_k": hits_sql(HITS_ITER),
    "hits": "WITH " + ",\n".join(hits_tol_parts(HITS_UNROLLED, HITS_TOL))
    + "\nSELECT id, round(hub, 6) AS hub, round(authority, 6) AS authority FROM hits",
    **{
        f"lpa_seeded_{name}": lpa_sql(
            SEEDED["steps"],
            init="SELECT v.id, CASE WHEN s.id IS NOT NULL THEN v.id END AS label FROM verts v LEFT JOIN seeds s USING (id)",
            extra=hits_tol_parts(HITS_UNROLLED, HITS_TOL)[1:]
            + [f"seeds AS (SELECT id FROM hits ORDER BY printf('%.8e', {col})::DOUBLE DESC, id LIMIT {SEEDED['n']})"],
            sweep_steps=SEEDED["steps"],
        )
        for name, col in (("hubs", "hub"), ("auths", "authority"))
    },
    "closeness": closeness_sql(False),
    "kpp": closeness_sql(True),
    "betweenness": betweenness_sql(),
    "weak_components": components_sql(False),
    "strong_components": components_sql(True),
    "lpa_k": lpa_sql(LPA_STEPS),
    "lpa_partitioned": lpa_sql(PLPA["steps"], PLPA["partitions"], PLPA["seed"]),
    "lpa_annealed": lpa_sql(_tot, accept=_acc),
    "lpa_seeded": lpa_sql(
        SEEDED["steps"],
        init="SELECT v.id, CASE WHEN s.id IS NOT NULL THEN v.id END AS label FROM verts v LEFT JOIN seeds s USING (id)",
        extra=[_SEEDS],
        sweep_steps=SEEDED["steps"],
    ),
    "lpa_seeded_annealed": lpa_sql(
        _tot,
        accept=_acc,
        init="SELECT v.id, CASE WHEN s.id IS NOT NULL THEN v.id END AS label FROM verts v LEFT JOIN seeds s USING (id)",
        extra=[_SEEDS.replace("src", "dst")],
        sweep_steps=ANNEAL["steps"],
    ),
    "random_clusters": f"""WITH {GRAPH} SELECT id, (({h32_sql('id', 'slice', 0)} * {RANDOM_P}) >> 32)::BIGINT AS cluster
  FROM verts""",
}


# ---- cluster, then evaluate (the clustering job dispatch + evaluation) -------

CLUSTERINGS = {
    "random": dict(algorithm="random", partitions=RANDOM_P, seed=0),
    "cc": dict(algorithm="cc"),
    "scc": dict(algorithm="scc"),
    "lpa": dict(algorithm="lpa", steps=2),
    "plpa": dict(algorithm="plpa", steps=2, partitions=2, seed=0),
    "annealed": dict(algorithm="annealed", steps=1, decay_steps=2),
}


def departments(spark, sf_dir):
    """The reference clustering of users: each user's most frequent event
    type (ties to the smaller type name)."""
    from pyspark.sql import Window

    ev = table(spark, sf_dir, "events")
    n = ev.groupBy(F.col("user_id").alias("id"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("id").orderBy(F.col("n").desc(), F.col("event_type"))
    return n.withColumn("o", F.row_number().over(w)).where("o = 1").select("id", F.col("event_type").alias("cluster"))


def q_cluster_evaluation(spark, sf_dir):
    from tessera.operators.evaluate import evaluate_clustering

    e = edges(spark, sf_dir)
    actual = departments(spark, sf_dir)
    out = None
    for name, opts in CLUSTERINGS.items():
        opts = dict(opts)
        pred = LP.cluster(e, opts.pop("algorithm"), **opts)
        r = evaluate_clustering(pred, actual).select(
            F.lit(name).alias("algorithm"), "n", "tp", "fp", "fn", "tn",
            *[_r(c) for c in ("nmi", "precision", "recall", "f1")],
        )
        out = r if out is None else out.unionByName(r)
    return out


QUERIES["cluster_evaluation"] = q_cluster_evaluation


def _clustering_sql(name: str) -> str:
    if name == "random":
        return ORACLES["random_clusters"]
    if name == "cc":
        return components_sql(False).replace("AS component", "AS cluster")
    if name == "scc":
        return components_sql(True).replace("AS component", "AS cluster")
    if name == "lpa":
        return lpa_sql(2)
    if name == "plpa":
        return lpa_sql(2, 2, 0)
    acc, tot = LP.annealing(1, 2)
    return lpa_sql(tot, accept=acc)


def cluster_evaluation_sql() -> str:
    preds = "\nUNION ALL ".join(
        f"SELECT '{n}' AS algorithm, id, cluster::VARCHAR AS cluster FROM ({_clustering_sql(n)})" for n in CLUSTERINGS
    )
    return f"""WITH preds AS ({preds}),
dept AS (SELECT id, event_type AS cluster FROM (
  SELECT user_id AS id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS o
  FROM events GROUP BY 1, 2) WHERE o = 1),
ct AS (SELECT p.algorithm, p.cluster AS pred, d.cluster AS actual, count(*) AS n
  FROM preds p JOIN dept d USING (id) GROUP BY 1, 2, 3),
tot AS (SELECT algorithm, SUM(n)::DOUBLE AS total FROM ct GROUP BY 1),
pm AS (SELECT algorithm, pred, SUM(n) AS ni FROM ct GROUP BY 1, 2),
am AS (SELECT algorithm, actual, SUM(n) AS nj FROM ct GROUP BY 1, 2),
hp AS (SELECT algorithm, -SUM(ni / total * ln(ni / total)) AS h_pred FROM pm JOIN tot USING (algorithm) GROUP BY 1),
ha AS (SELECT algorithm, -SUM(nj / total * ln(nj / total)) AS h_actual FROM am JOIN tot USING (algorithm) GROUP BY 1),
mi AS (SELECT algorithm, SUM(n / total * ln(total * n / (ni * nj))) AS mi
  FROM ct JOIN pm USING (algorithm, pred) JOIN am USING (algorithm, actual) JOIN tot USING (algorithm) GROUP BY 1),
xt AS (SELECT t.algorithm, t.total::BIGINT AS n,
  (SELECT SUM(n * (n - 1) // 2) FROM ct WHERE ct.algorithm = t.algorithm)::BIGINT AS tp,
  (SELECT SUM(ni * (ni - 1) // 2) FROM pm WHERE pm.algorithm = t.algorithm)::BIGINT AS pp,
  (SELECT SUM(nj * (nj - 1) // 2) FROM am WHERE am.algorithm = t.algorithm)::BIGINT AS ap FROM tot t)
SELECT x.algorithm, x.n, x.tp, (x.pp - x.tp)::BIGINT AS fp, (x.ap - x.tp)::BIGINT AS fn,
  (x.n * (x.n - 1) // 2 - x.pp - x.ap + x.tp)::BIGINT AS tn,
  round(CASE WHEN (h_pred + h_actual) / 2 > 0 THEN mi / ((h_pred + h_actual) / 2) END, 9) AS nmi,
  round(CASE WHEN x.pp > 0 THEN x.tp::DOUBLE / x.pp END, 9) AS precision,
  round(CASE WHEN x.ap > 0 THEN x.tp::DOUBLE / x.ap END, 9) AS recall,
  round(CASE WHEN x.tp > 0 THEN 2.0 * x.tp / (x.pp + x.ap) END, 9) AS f1
FROM xt x JOIN hp USING (algorithm) JOIN ha USING (algorithm) JOIN mi USING (algorithm)"""


ORACLES["cluster_evaluation"] = cluster_evaluation_sql()


def measure_report_sql() -> str:
    parts = [
        ("in_degree", ORACLES["in_degree"], "in_degree"),
        ("out_degree", ORACLES["out_degree"], "out_degree"),
        ("betweenness", betweenness_sql(True), "betweenness"),
        ("closeness", closeness_sql(False, True), "closeness"),
        ("kpp", closeness_sql(True, True), "kpp"),
        ("hub", hits_sql(HITS_ITER, 17), "hub"),
        ("authority", hits_sql(HITS_ITER, 17), "authority"),
    ] + [(f"pagerank_{r}", pagerank_sql(REPORT_PR_ITER, r, 17), "rank") for r in REPORT_RESETS]
    union = "\nUNION ALL ".join(
        f"SELECT '{name}' AS measure, id, {col}::DOUBLE AS score FROM ({sql})" for name, sql, col in parts
    )
    return f"""WITH m AS ({union})
SELECT measure, position::INTEGER AS position, id, printf('%.5e', score)::DOUBLE AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY measure ORDER BY printf('%.11e', score)::DOUBLE DESC, id) AS position FROM m)
WHERE position <= 5"""


ORACLES["measure_report"] = measure_report_sql()


def rank_report_sql() -> str:
    hits = "WITH " + ",\n".join(hits_tol_parts(HITS_UNROLLED, HITS_TOL)) + "\nSELECT id, {} AS score FROM hits"
    parts = [(m, hits.format(m), "score") for m in ("hub", "authority")]
    parts += [(f"pagerank_{r}", pagerank_sql(PR_UNROLLED, r, 17, PR_TOL), "rank") for r in REPORT_RESETS]
    union = "\nUNION ALL ".join(
        f"SELECT '{name}' AS measure, id, {col}::DOUBLE AS score FROM ({sql})" for name, sql, col in parts
    )
    return f"""WITH m AS ({union})
SELECT measure, position::INTEGER AS position, id, printf('%.4e', score)::DOUBLE AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY measure ORDER BY printf('%.11e', score)::DOUBLE DESC, id) AS position FROM m)
WHERE position <= 5"""


ORACLES["rank_report"] = rank_report_sql()
ORACLES["weak_components_forest"] = components_sql(False, FOREST_GRAPH)
ORACLES["strong_components_forest"] = components_sql(True, FOREST_GRAPH)
