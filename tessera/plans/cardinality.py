"""Registered distinct-count queries and their SQL twins.

Streams: ``events.user_id`` per ``event_type`` (small true counts) and the
token stream of ``documents`` (every token occurrence, in text order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import h60_sql
from tessera.functions.text import TOKEN_SPLIT_SQL, tokens
from tessera.operators import cardinality as K
from tessera.sources.tables import table

EVENT_PS = (2, 4, 6, 8, 10)
TOKEN_PS = (4, 8, 12, 16)
EVENT_KS = (8, 64, 256)
TOKEN_KS = (16, 256, 1024)
MERGE_P = 8
MERGE_K = 64
THETA_LG = 16  # exact up to 65,536 users of a type and day
TWO60 = float(1 << 60)


def token_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text")
    return docs.select(F.explode(tokens(F.col("text"))).alias("token")).where(F.col("token") != "")


def _events(spark, sf_dir):
    return K.with_hash(table(spark, sf_dir, "events").select("event_type", "user_id"), "user_id")


def _hll_many(hashed: DataFrame, ps, group_cols) -> DataFrame:
    """Registers at the largest p, folded to every p in one pipeline."""
    pmax = max(ps)
    regs = K.hll_registers(hashed, pmax, group_cols)
    return K.hll_estimate_many(K.hll_fold_many(regs, pmax, ps, group_cols), ps, group_cols)


def _kmv_many(hashed: DataFrame, ks, group_cols) -> DataFrame:
    return K.kmv_estimate_many(K.kmv_smallest(hashed, max(ks), group_cols), ks, group_cols)


def q_distinct_exact(spark, sf_dir):
    return K.distinct_exact(table(spark, sf_dir, "events"), "user_id", "event_type")


def q_distinct_exact_tokens(spark, sf_dir):
    return K.distinct_exact(token_stream(spark, sf_dir), "token")


def q_hll_estimate(spark, sf_dir):
    return _hll_many(_events(spark, sf_dir), EVENT_PS, "event_type").select(
        "event_type", "p", "registers_used", F.round("estimate", 4).alias("estimate")
    )


def q_hll_tokens(spark, sf_dir):
    hashed = K.with_hash(token_stream(spark, sf_dir), "token")
    return _hll_many(hashed, TOKEN_PS, None).select("p", "registers_used", F.round("estimate", 4).alias("estimate"))


def q_kmv_estimate(spark, sf_dir):
    return _kmv_many(_events(spark, sf_dir), EVENT_KS, "event_type").select(
        "event_type", "k", "held", F.round("estimate", 4).alias("estimate")
    )


def q_kmv_tokens(spark, sf_dir):
    hashed = K.with_hash(token_stream(spark, sf_dir), "token")
    return _kmv_many(hashed, TOKEN_KS, None).select("k", "held", F.round("estimate", 4).alias("estimate"))


def q_hll_merge(spark, sf_dir):
    """Sketch each event type (null is one too), then merge the sketches into one."""
    per_type = K.hll_registers(_events(spark, sf_dir), MERGE_P, "event_type")
    merged = K.hll_merge(per_type.drop("event_type"))
    return K.hll_estimate(merged, MERGE_P).select("registers_used", F.round("estimate", 4).alias("estimate"))


def q_kmv_merge(spark, sf_dir):
    hashed = _events(spark, sf_dir)
    per_type = K.kmv_smallest(hashed, MERGE_K, "event_type").drop("event_type")
    merged = K.kmv_merge(per_type, k=MERGE_K)
    return K.kmv_estimate(merged, MERGE_K).select("held", F.round("estimate", 4).alias("estimate"))


def q_estimator_rmse(spark, sf_dir):
    return K.estimator_rmse(token_stream(spark, sf_dir), "token").select(
        "algorithm", "size", "exact", F.round("rmse", 3).alias("rmse")
    )


def q_theta_returning(spark, sf_dir):
    """Per event type and day: users, users of the day before, those of both
    days, of either, and new ones, from one sketch per type and day."""
    ev = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), "user_id")
    daily = K.theta_sketch(ev, "user_id", ["event_type", "day"], THETA_LG)
    before = daily.select("event_type", F.date_add("day", 1).alias("day"), F.col("sketch").alias("before"))
    pairs = daily.join(before, ["event_type", "day"], "left")
    return K.theta_compare(pairs, "sketch", "before", THETA_LG).select(
        "event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), F.col("n_a").alias("users"),
        F.col("n_b").alias("users_before"), F.col("n_both").alias("returning"), F.col("n_union").alias("either"),
        F.col("n_only_a").alias("new"),
    )


def q_theta_merge(spark, sf_dir):
    """Daily sketches united per event type: users of the type over all days."""
    ev = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), "user_id")
    daily = K.theta_sketch(ev, "user_id", ["event_type", "day"], THETA_LG)
    whole = K.theta_union(daily, ["event_type"], THETA_LG)
    return whole.select("event_type", F.theta_sketch_estimate("sketch").cast("bigint").alias("users"))


QUERIES = {
    "theta_returning": q_theta_returning,
    "theta_merge": q_theta_merge,
    "distinct_exact": q_distinct_exact,
    "distinct_exact_tokens": q_distinct_exact_tokens,
    "hll_estimate": q_hll_estimate,
    "hll_tokens": q_hll_tokens,
    "kmv_estimate": q_kmv_estimate,
    "kmv_tokens": q_kmv_tokens,
    "hll_merge": q_hll_merge,
    "kmv_merge": q_kmv_merge,
    "estimator_rmse": q_estimator_rmse,
}

# ---- SQL twins ---------------------------------------------------------------

TOKENS_SQL = f"""toks AS (SELECT token FROM (
  SELECT unnest(regexp_split_to_array(text, '{TOKEN_SPLIT_SQL}')) AS token FROM documents) t
  WHERE token <> '')"""


def _values(name: str, col: str, vals) -> str:
    return f"{name}({col}) AS (VALUES {', '.join(f'({v})' for v in vals)})"


def _alpha_case(ps) -> str:
    whens = " ".join(f"WHEN {p} THEN {K.hll_alpha(p)!r}" for p in ps)
    return f"CASE p {whens} END"


def hll_sql(hashed: str, gcols: list[str], ps, digits: int = 4) -> str:
    g = "".join(f"{c}, " for c in gcols)
    rest = "(60 - p)"
    low = f"(h & ((1::BIGINT << {rest}) - 1))"
    rank = f"({rest} - CASE WHEN {low} = 0 THEN 0 ELSE length(bin({low})) END + 1)"
    return f"""{_values('ps', 'p', ps)},
regs AS (SELECT {g}p, (h >> {rest}) AS idx, max({rank}) AS rank FROM {hashed}, ps GROUP BY ALL),
per_rank AS (SELECT {g}p, rank, count(*) AS c FROM regs GROUP BY ALL),
sums AS (SELECT {g}p, SUM(c * pow(2.0, -rank)) AS z, SUM(c)::BIGINT AS used FROM per_rank GROUP BY ALL),
est AS (SELECT {g}p, used, (1::BIGINT << p)::DOUBLE AS m, {_alpha_case(ps)} AS alpha, z FROM sums)
SELECT {g}p, used AS registers_used, round(CASE
  WHEN alpha * m * m / (z + (m - used)) <= 2.5 * m AND m - used > 0 THEN m * ln(m / (m - used))
  ELSE alpha * m * m / (z + (m - used)) END, {digits}) AS estimate FROM est"""


def kmv_sql(hashed: str, gcols: list[str], ks, digits: int = 4) -> str:
    g = "".join(f"{c}, " for c in gcols)
    part = f"PARTITION BY {', '.join(gcols)} " if gcols else ""
    return f"""{_values('ks', 'k', ks)},
d AS (SELECT DISTINCT {g}h FROM {hashed}),
r AS (SELECT {g}h, row_number() OVER ({part}ORDER BY h) AS pos FROM d),
s AS (SELECT {g}k, count(*)::BIGINT AS held, max(h) AS h_k FROM r JOIN ks ON pos <= k GROUP BY ALL)
SELECT {g}k, held, round(CASE WHEN held < k THEN held::DOUBLE
  ELSE CAST(CASE WHEN k = 1 THEN 1 ELSE k - 1 END AS DOUBLE) * {TWO60!r} / h_k END, {digits}) AS estimate FROM s"""


_EV_HASH = f"ev AS (SELECT event_type, {h60_sql('user_id')} AS h FROM events)"
_TOK_HASH = f"{TOKENS_SQL}, th AS (SELECT {h60_sql('token')} AS h FROM toks)"


def rmse_sql(seeds=tuple(range(1, 11))) -> str:
    hashed = f"""{TOKENS_SQL},
{_values('seeds', 'seed', seeds)},
sh AS (SELECT seed, ('0x' || substr(md5(CAST(seed AS VARCHAR) || '|' || token), 1, 15))::BIGINT AS h
       FROM toks, seeds)"""
    hll = hll_sql("sh", ["seed"], K.HLL_PS, digits=12)
    kmv = kmv_sql("sh", ["seed"], K.KMV_KS, digits=12)
    return f"""WITH {hashed},
hll_est AS (WITH {hll}),
kmv_est AS (WITH {kmv}),
allest AS (SELECT seed, 'hll' AS algorithm, p AS size, estimate FROM hll_est
           UNION ALL SELECT seed, 'kmv', k, estimate FROM kmv_est),
ex AS (SELECT count(DISTINCT token)::BIGINT AS exact FROM toks)
SELECT algorithm, size, exact, round(sqrt(avg(pow(estimate - exact, 2))), 3) AS rmse
FROM allest, ex GROUP BY ALL"""


ORACLES = {
    "theta_returning": """WITH d AS (SELECT DISTINCT event_type, ts::DATE AS day, user_id FROM events),
n AS (SELECT event_type, day, count(user_id) AS users FROM d GROUP BY 1, 2),
b AS (SELECT x.event_type, x.day, count(*) AS both FROM d x JOIN d y
  ON x.event_type = y.event_type AND x.user_id = y.user_id AND y.day = x.day - 1 GROUP BY 1, 2)
SELECT n.event_type, strftime(n.day, '%Y-%m-%d') AS day, n.users::BIGINT AS users,
  coalesce(p.users, 0)::BIGINT AS users_before, coalesce(b.both, 0)::BIGINT AS returning,
  (n.users + coalesce(p.users, 0) - coalesce(b.both, 0))::BIGINT AS either, (n.users - coalesce(b.both, 0))::BIGINT AS new
FROM n LEFT JOIN n p ON p.event_type = n.event_type AND p.day = n.day - 1
LEFT JOIN b ON b.event_type = n.event_type AND b.day = n.day""",
    "theta_merge": "SELECT event_type, count(DISTINCT user_id)::BIGINT AS users FROM events GROUP BY 1",
    "distinct_exact": "SELECT event_type, count(DISTINCT user_id)::BIGINT AS n_distinct FROM events GROUP BY 1",
    "distinct_exact_tokens": f"WITH {TOKENS_SQL} SELECT count(DISTINCT token)::BIGINT AS n_distinct FROM toks",
    "hll_estimate": f"WITH {_EV_HASH}, {hll_sql('ev', ['event_type'], EVENT_PS)}",
    "hll_tokens": f"WITH {_TOK_HASH}, {hll_sql('th', [], TOKEN_PS)}",
    "kmv_estimate": f"WITH {_EV_HASH}, {kmv_sql('ev', ['event_type'], EVENT_KS)}",
    "kmv_tokens": f"WITH {_TOK_HASH}, {kmv_sql('th', [], TOKEN_KS)}",
    "hll_merge": f"""SELECT registers_used, estimate FROM (
WITH {_EV_HASH}, {hll_sql('ev', [], (MERGE_P,))})""",
    "kmv_merge": f"""SELECT held, estimate FROM (
WITH {_EV_HASH}, {kmv_sql('ev', [], (MERGE_K,))})""",
    "estimator_rmse": rmse_sql(),
}
