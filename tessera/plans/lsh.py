"""Registered LSH queries over the labelled corpus and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import h60_sql
from tessera.functions.text import TOKEN_SPLIT_SQL
from tessera.operators import lsh as L
from tessera.operators.bags import token_bag
from tessera.operators.classify import spam_confusion
from tessera.plans import corpus as C
from tessera.session import scratch_path
from tessera.sources import io
from tessera.sources.tables import table

PLANES, BANDS, SEED = 16, 4, 0
NEAREST_PLANES = 16
SWEEP = (1, 2, 4, 8, 16, 32, 64)


def _labels(df):
    return df.select(F.col("doc_id").alias("m_id"), "label")


def q_lsh_signature(spark, sf_dir):
    return L.lsh_signature(table(spark, sf_dir, "documents"), PLANES, BANDS, SEED)


def _sigs(queries, model):
    return L.lsh_signature(queries, PLANES, BANDS, SEED), L.lsh_signature(model, PLANES, BANDS, SEED)


def q_lsh_candidates(spark, sf_dir):
    qs, ms = _sigs(C.holdout(spark, sf_dir), C.model(spark, sf_dir))
    return L.lsh_candidates(qs, ms, bands=BANDS)


def q_lsh_vote(spark, sf_dir):
    qs, model = C.holdout(spark, sf_dir), C.model(spark, sf_dir)
    sigs, ms = _sigs(qs, model)
    # Labels go with the vectors, with the number of rows that have them.
    labels = model.groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("times"))
    cands = L.lsh_candidates(sigs, ms.join(labels, "doc_id"), bands=BANDS, kept=["label", "times"])
    votes = L.lsh_vote(cands.withColumn("hits", F.col("hits") * F.col("times")), None)
    return (
        qs.select(F.col("doc_id").alias("q_id"), "label")
        .join(votes, "q_id", "left")
        .select("q_id", "label", "predicted", F.coalesce("votes", F.lit(0)).cast("bigint").alias("votes"))
    )


def q_lsh_nearest(spark, sf_dir):
    qs, model = C.holdout(spark, sf_dir), C.model(spark, sf_dir)
    out = L.lsh_nearest(
        token_bag(qs),
        token_bag(model),
        L.lsh_signature(qs, NEAREST_PLANES, 1, SEED),
        L.lsh_signature(model, NEAREST_PLANES, 1, SEED),
        seed=SEED,
    )
    return out.select("q_id", F.round("distance", 6).alias("distance"), "fallback")


def _classified(spark, sf_dir, queries):
    model = C.model(spark, sf_dir)
    qb, mb = token_bag(queries), token_bag(model)
    best = L.lsh_classify(L.nearest_candidates(*_sigs(queries, model), qb, mb), qb, mb, _labels(model))
    return queries.select(F.col("doc_id").alias("q_id"), "label").join(best, "q_id", "left")


def q_lsh_classify(spark, sf_dir):
    out = _classified(spark, sf_dir, C.holdout(spark, sf_dir))
    return out.select("q_id", "label", "m_id", F.round("distance", 6).alias("distance"), "predicted")


def q_lsh_saved_model(spark, sf_dir):
    """Save the index (signatures, bags, labels), load it, classify from it."""
    model, queries = C.model(spark, sf_dir), C.holdout(spark, sf_dir)
    path = scratch_path(spark, "lsh-model")
    parts = {"sig": L.lsh_signature(model, PLANES, BANDS, SEED), "bag": token_bag(model), "labels": _labels(model)}
    io.save_model(path, parts, {"planes": PLANES, "bands": BANDS, "seed": SEED, "kind": "lsh"})
    saved, p = io.load_model(spark, path, ["sig", "bag", "labels"])
    qb, sigs = token_bag(queries), L.lsh_signature(queries, p["planes"], p["bands"], p["seed"])
    best = L.lsh_classify(L.nearest_candidates(sigs, saved["sig"], qb, saved["bag"]), qb, saved["bag"], saved["labels"])
    out = queries.select(F.col("doc_id").alias("q_id"), "label").join(best, "q_id", "left")
    return out.select("q_id", "label", "m_id", F.round("distance", 6).alias("distance"), "predicted")


def q_lsh_confusion(spark, sf_dir):
    return spam_confusion(_classified(spark, sf_dir, C.holdout(spark, sf_dir)), C.HAM, C.SPAM)


def q_lsh_sweep(spark, sf_dir):
    qs, model = C.query_sample(spark, sf_dir), C.model(spark, sf_dir)
    out = L.plane_sweep(qs, model, token_bag(qs), token_bag(model), SWEEP, SEED)
    return out.select(
        "num_hyperplanes", "queries", F.round("mean_abs_err", 6).alias("mean_abs_err"), "fallbacks"
    )


QUERIES = {
    "lsh_signature": q_lsh_signature,
    "lsh_candidates": q_lsh_candidates,
    "lsh_vote": q_lsh_vote,
    "lsh_nearest": q_lsh_nearest,
    "lsh_classify": q_lsh_classify,
    "lsh_saved_model": q_lsh_saved_model,
    "lsh_confusion": q_lsh_confusion,
    "lsh_sweep": q_lsh_sweep,
}

# ---- SQL twins ---------------------------------------------------------------


def _range(name, col, n):
    return f"{name}({col}) AS (SELECT range FROM range({n}))"


def sig_sql(name: str, src: str, planes: int, bands: int, seed: int = SEED) -> str:
    """CTEs ending in ``{name}(doc_id, band, sig_lo, sig_hi)``."""
    salt = f"'{seed}|' || CAST(b AS VARCHAR) || '|' || token"
    bit = "(CASE WHEN i < 32 THEN lo >> i ELSE hi >> (i - 32) END) & 1"
    return f"""{name}_occ AS (SELECT doc_id, token FROM (
    SELECT doc_id, unnest(regexp_split_to_array(text, '{TOKEN_SPLIT_SQL}')) AS token FROM {src}) t
  WHERE token <> ''),
{name}_bits AS (SELECT doc_id, b AS band,
    ('0x' || substr(md5({salt}), 1, 8))::BIGINT AS lo,
    ('0x' || substr(md5({salt}), 9, 8))::BIGINT AS hi
  FROM {name}_occ, (SELECT range AS b FROM range({bands}))),
{name}_proj AS (SELECT doc_id, band, i, SUM(CASE WHEN ({bit}) = 1 THEN 1 ELSE -1 END) AS pr
  FROM {name}_bits, (SELECT range AS i FROM range({planes})) GROUP BY ALL),
{name} AS (SELECT doc_id, band::INTEGER AS band,
    SUM(CASE WHEN pr > 0 AND i < 32 THEN 1::BIGINT << i ELSE 0 END)::BIGINT AS sig_lo,
    SUM(CASE WHEN pr > 0 AND i >= 32 THEN 1::BIGINT << (i - 32) ELSE 0 END)::BIGINT AS sig_hi
  FROM {name}_proj GROUP BY 1, 2)"""


def pair_dist_sql(name: str, pairs: str) -> str:
    """Distances for ``pairs(q_id, m_id)``; needs qb, mb, qn, mn."""
    return f"""{name}_dot AS (SELECT p.q_id, p.m_id, COALESCE(SUM(a.cnt * b.cnt), 0) AS dot
  FROM (SELECT DISTINCT q_id, m_id FROM {pairs}) p JOIN qb a ON a.doc_id = p.q_id
  LEFT JOIN mb b ON b.doc_id = p.m_id AND b.token = a.token GROUP BY 1, 2),
{name} AS (SELECT q_id, m_id, acos(LEAST(GREATEST(dot / (sqrt(qn.sq_norm) * sqrt(mn.sq_norm)), -1.0), 1.0))
    AS distance
  FROM {name}_dot JOIN qn ON qn.doc_id = q_id JOIN mn ON mn.doc_id = m_id)"""


def _base(qsrc: str) -> str:
    return f"""WITH {C.CORPUS_CTES},
{C.bag_cte('qb', qsrc)},
{C.bag_cte('mb', 'model')},
{C.norms_cte('qn', 'qb')},
{C.norms_cte('mn', 'mb')},
{sig_sql('qs', qsrc, PLANES, BANDS)},
{sig_sql('ms', 'model', PLANES, BANDS)},
cands AS (SELECT q.doc_id AS q_id, m.doc_id AS m_id, count(*)::BIGINT AS hits
  FROM qs q JOIN ms m ON q.band = m.band AND q.sig_lo = m.sig_lo AND q.sig_hi = m.sig_hi GROUP BY 1, 2)"""


def _classify_sql(qsrc: str) -> str:
    return f"""{_base(qsrc)},
{pair_dist_sql('cd', 'cands')},
best AS (SELECT q_id, m_id, distance, label FROM (
  SELECT cd.*, m.label, row_number() OVER (PARTITION BY q_id ORDER BY distance, m_id) AS o
  FROM cd JOIN model m ON m.doc_id = cd.m_id WHERE distance IS NOT NULL) WHERE o = 1),
cls AS (SELECT q.doc_id AS q_id, q.label, b.m_id, b.distance, b.label AS predicted
  FROM {qsrc} q LEFT JOIN best b ON b.q_id = q.doc_id)"""


def _nearest_sql(planes_list, qsrc: str) -> str:
    """Nearest distance with fallback for one band of max(planes_list)
    planes masked to each count in planes_list."""
    top = max(planes_list)
    ns = ", ".join(f"({n})" for n in planes_list)
    lo = "CASE WHEN n >= 32 THEN 4294967295 ELSE (1::BIGINT << n) - 1 END"
    hi = "(1::BIGINT << GREATEST(n - 32, 0)) - 1"
    return f"""WITH {C.CORPUS_CTES},
{C.bag_cte('qb', qsrc)},
{C.bag_cte('mb', 'model')},
{C.norms_cte('qn', 'qb')},
{C.norms_cte('mn', 'mb')},
{sig_sql('qs0', qsrc, top, 1)},
{sig_sql('ms0', 'model', top, 1)},
ns(n) AS (VALUES {ns}),
qs AS (SELECT n, doc_id, sig_lo & ({lo}) AS sig_lo, sig_hi & ({hi}) AS sig_hi FROM qs0, ns),
ms AS (SELECT n, doc_id, sig_lo & ({lo}) AS sig_lo, sig_hi & ({hi}) AS sig_hi FROM ms0, ns),
cands AS (SELECT q.n, q.doc_id AS q_id, m.doc_id AS m_id FROM qs q JOIN ms m
  ON q.n = m.n AND q.sig_lo = m.sig_lo AND q.sig_hi = m.sig_hi),
{pair_dist_sql('cd', 'cands')},
best AS (SELECT c.n, c.q_id, min(cd.distance) AS distance FROM cands c
  JOIN cd ON cd.q_id = c.q_id AND cd.m_id = c.m_id GROUP BY 1, 2),
pool AS (SELECT row_number() OVER (ORDER BY hk, m_id) - 1 AS pos, m_id FROM (
  SELECT m_id, {h60_sql('m_id', 'pool', SEED)} AS hk FROM (SELECT DISTINCT doc_id AS m_id FROM ms0)
)),
missing AS (SELECT DISTINCT q.n, q.doc_id AS q_id FROM qs q
  WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.n = q.n AND b.q_id = q.doc_id)),
picks AS (SELECT mi.n, mi.q_id, p.m_id FROM missing mi JOIN pool p
  ON p.pos = {h60_sql('mi.q_id', 'pick', SEED)} % (SELECT count(*) FROM pool)),
{pair_dist_sql('fd', 'picks')},
approx AS (SELECT n, q_id, distance, false AS fallback FROM best
  UNION ALL SELECT pk.n, pk.q_id, fd.distance, true FROM picks pk
  JOIN fd ON fd.q_id = pk.q_id AND fd.m_id = pk.m_id)"""


_NEAREST_EXACT = """ex_dot AS (SELECT a.doc_id AS q_id, b.doc_id AS m_id, SUM(a.cnt * b.cnt) AS dot
  FROM qb a JOIN mb b ON a.token = b.token GROUP BY 1, 2),
exact AS (SELECT q_id, acos(COALESCE(max(LEAST(GREATEST(dot / (sqrt(qn.sq_norm) * sqrt(mn.sq_norm)), -1.0), 1.0)), 0))
    AS exact FROM ex_dot JOIN qn ON qn.doc_id = q_id JOIN mn ON mn.doc_id = m_id GROUP BY 1)"""

ORACLES = {
    "lsh_signature": f"WITH {sig_sql('s', 'documents', PLANES, BANDS)} SELECT * FROM s",
    "lsh_candidates": f"{_base('holdout')} SELECT q_id, m_id, hits FROM cands",
    "lsh_vote": f"""{_base('holdout')},
votes AS (SELECT c.q_id, m.label, SUM(hits) AS n FROM cands c JOIN model m ON m.doc_id = c.m_id GROUP BY 1, 2),
best AS (SELECT q_id, label, n, row_number() OVER (PARTITION BY q_id ORDER BY n DESC) AS o,
  count(*) OVER (PARTITION BY q_id, n) AS same, SUM(n) OVER (PARTITION BY q_id) AS tot FROM votes)
SELECT q.doc_id AS q_id, q.label, CASE WHEN b.same = 1 THEN b.label END AS predicted,
  COALESCE(b.tot, 0)::BIGINT AS votes
FROM holdout q LEFT JOIN best b ON b.q_id = q.doc_id AND b.o = 1""",
    "lsh_nearest": f"""{_nearest_sql((NEAREST_PLANES,), 'holdout')}
SELECT q_id, round(distance, 6) AS distance, fallback FROM approx""",
    "lsh_classify": f"""{_classify_sql('holdout')}
SELECT q_id, label, m_id, round(distance, 6) AS distance, predicted FROM cls""",
    "lsh_confusion": f"""{_classify_sql('holdout')}
SELECT count(*) FILTER (WHERE predicted = {C.HAM} AND label = {C.HAM})::BIGINT AS true_ham,
  count(*) FILTER (WHERE predicted = {C.HAM} AND label = {C.SPAM})::BIGINT AS false_ham,
  count(*) FILTER (WHERE predicted = {C.SPAM} AND label = {C.SPAM})::BIGINT AS true_spam,
  count(*) FILTER (WHERE predicted = {C.SPAM} AND label = {C.HAM})::BIGINT AS false_spam,
  count(*) FILTER (WHERE predicted IS NULL)::BIGINT AS no_pred FROM cls""",
    "lsh_sweep": f"""{_nearest_sql(SWEEP, 'qsample')},
{_NEAREST_EXACT}
SELECT n::INTEGER AS num_hyperplanes, count(*)::BIGINT AS queries,
  round(avg(abs(a.distance - e.exact)), 6) AS mean_abs_err,
  count(*) FILTER (WHERE fallback)::BIGINT AS fallbacks
FROM approx a JOIN exact e USING (q_id) GROUP BY 1""",
}

ORACLES["lsh_saved_model"] = ORACLES["lsh_classify"]
