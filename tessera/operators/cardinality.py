"""Distinct counting: exact, HyperLogLog and K-min-values, all mergeable.

Hashes are 60-bit (``h60``). HyperLogLog takes the register index from the
top ``p`` bits and the rank from the leading zeros of the remaining
``60 - p`` bits, so the registers of any smaller ``p`` are a fold of the
registers of a larger one (``hll_fold``): one pass over the data serves every
precision. K-min-values keeps the ``k`` smallest distinct hashes; the ``k'``
smallest for any ``k' < k`` are a prefix of them.

Plans: HyperLogLog is ``groupBy(g, idx).max(rank)``, whose partial aggregate
leaves at most ``2^p`` rows per group and task before the shuffle, so a hot
group never moves more than its registers. K-min-values keeps per task and
group the ``k`` smallest distinct hashes (an Arrow batch step) and merges
those bounded partials with a group-limited window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import h60

HASH_BITS = 60

# HyperLogLog bias constants alpha_m for p = 0..10
# (m = 2^p); above p = 10 the closed form 0.7213 / (1 + 1.079 / m) is used.
HLL_ALPHAS = [
    0.0176262649461293,
    0.3511939471167616,
    0.5324346139959726,
    0.6256087109372577,
    0.6731020238676673,
    0.6971226338010236,
    0.7092084528700252,
    0.7152711899613444,
    0.7183076381917926,
    0.7198271478203816,
    0.7205872259765094,
]


def hll_alpha(p: int) -> float:
    m = 1 << p
    return HLL_ALPHAS[p] if p < len(HLL_ALPHAS) else 0.7213 / (1.0 + 1.079 / m)


def _check_p(p: int) -> None:
    if not 0 <= p <= 31:
        raise ValueError("p must be in 0..31")


def bit_length(x: Column) -> Column:
    """Number of significant bits of a non-negative BIGINT (0 for 0)."""
    return F.when(x == 0, F.lit(0)).otherwise(F.length(F.bin(x)))


def _groups(group_cols: Sequence[str] | str | None) -> list[str]:
    if group_cols is None:
        return []
    return [group_cols] if isinstance(group_cols, str) else list(group_cols)


def with_hash(df: DataFrame, value_col: str, *salts, hash_fn: str = "md5") -> DataFrame:
    return df.withColumn("h", h60(F.col(value_col), *salts, hash_fn=hash_fn))


# ---- exact -------------------------------------------------------------------


def distinct_exact(df: DataFrame, value_col: str, group_cols=None) -> DataFrame:
    """(groups..., n_distinct): partial + final hash aggregate on the value
    (map-side combine, then a shuffle by value); nulls are not counted."""
    g = _groups(group_cols)
    agg = F.count_distinct(F.col(value_col)).alias("n_distinct")
    return df.groupBy(*g).agg(agg) if g else df.agg(agg)


# ---- HyperLogLog -------------------------------------------------------------


def hll_index_rank(h: Column, p: int) -> tuple[Column, Column]:
    rest = HASH_BITS - p
    idx = F.shiftrightunsigned(h, rest) if p > 0 else F.lit(0).cast("bigint")
    w = h.bitwiseAND(F.lit((1 << rest) - 1))
    rank = (F.lit(rest) - bit_length(w) + 1).cast("int")
    return idx.cast("int"), rank


def hll_registers(hashed: DataFrame, p: int, group_cols=None) -> DataFrame:
    """(groups..., idx, rank) for non-empty registers; ``hashed`` has ``h``."""
    _check_p(p)
    g = _groups(group_cols)
    idx, rank = hll_index_rank(F.col("h"), p)
    return (
        hashed.select(*g, idx.alias("idx"), rank.alias("rank"))
        .groupBy(*g, "idx")
        .agg(F.max("rank").alias("rank"))
    )


def hll_fold(registers: DataFrame, p_from: int, p_to: int, group_cols=None) -> DataFrame:
    """Registers of precision ``p_to`` from those of ``p_from >= p_to``:
    the dropped index bits lead the remaining hash bits."""
    if p_to > p_from:
        raise ValueError("can only fold to a smaller p")
    g = _groups(group_cols)
    d = p_from - p_to
    if d == 0:
        return registers
    low = F.col("idx").bitwiseAND(F.lit((1 << d) - 1))
    rank = F.when(low > 0, F.lit(d) - bit_length(low) + 1).otherwise(F.lit(d) + F.col("rank"))
    return (
        registers.select(*g, F.shiftright("idx", d).alias("idx"), rank.cast("int").alias("rank"))
        .groupBy(*g, "idx")
        .agg(F.max("rank").alias("rank"))
    )


def hll_merge(*register_tables: DataFrame, group_cols=None) -> DataFrame:
    """Union of sketches = register-wise max."""
    g = _groups(group_cols)
    u = register_tables[0]
    for r in register_tables[1:]:
        u = u.unionByName(r)
    return u.groupBy(*g, "idx").agg(F.max("rank").alias("rank"))


def hll_estimate(registers: DataFrame, p: int, group_cols=None) -> DataFrame:
    """(groups..., registers_used, estimate). Raw estimate
    alpha * m^2 / sum(2^-M); linear counting m * ln(m / V) when the raw value
    is at most 2.5 m and V > 0 registers are empty. The sum is taken per rank
    value first (counts times a power of two) so it is exact."""
    _check_p(p)
    g = _groups(group_cols)
    m = float(1 << p)
    per_rank = registers.groupBy(*g, "rank").agg(F.count(F.lit(1)).alias("c"))
    s = per_rank.groupBy(*g).agg(
        F.sum(F.col("c") * F.pow(F.lit(2.0), -F.col("rank"))).alias("z_used"),
        F.sum("c").alias("used"),
    )
    empty = F.lit(m) - F.col("used")
    raw = F.lit(hll_alpha(p) * m * m) / (F.col("z_used") + empty)
    est = F.when((raw <= 2.5 * m) & (empty > 0), F.lit(m) * F.log(F.lit(m) / empty)).otherwise(raw)
    return s.select(*g, F.col("used").alias("registers_used"), est.alias("estimate"))


def hll_fold_many(registers: DataFrame, p_from: int, ps: Sequence[int], group_cols=None) -> DataFrame:
    """(groups..., p, idx, rank) for every precision in ``ps`` at once: each
    register row is exploded into its folded index and rank per p, then one
    ``groupBy(groups, p, idx)`` takes the max (a single pipeline)."""
    if max(ps) > p_from:
        raise ValueError("can only fold to a smaller p")
    g = _groups(group_cols)
    entries = []
    for p in ps:
        d = p_from - p
        if d == 0:
            entries.append(F.struct(F.lit(p).alias("p"), F.col("idx").alias("i"), F.col("rank").alias("r")))
            continue
        low = F.col("idx").bitwiseAND(F.lit((1 << d) - 1))
        rank = F.when(low > 0, F.lit(d) - bit_length(low) + 1).otherwise(F.lit(d) + F.col("rank"))
        entries.append(
            F.struct(F.lit(p).alias("p"), F.shiftright("idx", d).alias("i"), rank.cast("int").alias("r"))
        )
    e = registers.select(*g, F.explode(F.array(*entries)).alias("e"))
    return (
        e.select(*g, F.col("e.p").alias("p"), F.col("e.i").alias("idx"), F.col("e.r").alias("rank"))
        .groupBy(*g, "p", "idx")
        .agg(F.max("rank").alias("rank"))
    )


def hll_estimate_many(registers: DataFrame, ps: Sequence[int], group_cols=None) -> DataFrame:
    """``hll_estimate`` for a register table with a ``p`` column."""
    g = [*_groups(group_cols), "p"]
    alpha = None
    for p in ps:
        alpha = (F.when(F.col("p") == p, F.lit(hll_alpha(p))) if alpha is None
                 else alpha.when(F.col("p") == p, F.lit(hll_alpha(p))))
    m = F.pow(F.lit(2.0), F.col("p"))  # exact for integer p
    per_rank = registers.groupBy(*g, "rank").agg(F.count(F.lit(1)).alias("c"))
    s = per_rank.groupBy(*g).agg(
        F.sum(F.col("c") * F.pow(F.lit(2.0), -F.col("rank"))).alias("z_used"),
        F.sum("c").alias("used"),
    )
    empty = m - F.col("used")
    raw = alpha * m * m / (F.col("z_used") + empty)
    est = F.when((raw <= m * 2.5) & (empty > 0), m * F.log(m / empty)).otherwise(raw)
    return s.select(*g, F.col("used").alias("registers_used"), est.alias("estimate"))


def hll_count(df: DataFrame, value_col: str, p: int, group_cols=None, hash_fn: str = "md5") -> DataFrame:
    return hll_estimate(hll_registers(with_hash(df, value_col, hash_fn=hash_fn), p, group_cols), p, group_cols)


def hll_builtin(df: DataFrame, value_col: str, lg_k: int = 12, group_cols=None) -> DataFrame:
    """Spark's own HLL sketch (lgK 4..21), for production use without an oracle."""
    g = _groups(group_cols)
    agg = F.hll_sketch_estimate(F.hll_sketch_agg(F.col(value_col), lg_k)).alias("estimate")
    return df.groupBy(*g).agg(agg) if g else df.agg(agg)


# ---- K-min-values ------------------------------------------------------------


def kmv_smallest(hashed: DataFrame, k: int, group_cols=None, distinct_input: bool = False) -> DataFrame:
    """(groups..., h, pos): the k smallest distinct hashes of every group.

    Raw rows are made distinct first (partial aggregates keep a hot value's
    duplicates out of the shuffle; ``distinct_input=True`` says they are), then
    a ``dense_rank <= k`` window, which Spark limits per task before its
    shuffle. Null groups are groups like others."""
    if k < 1:
        raise ValueError("k must be >= 1")
    g = _groups(group_cols)
    src = hashed.select(*g, "h").where(F.col("h").isNotNull())
    w = Window.partitionBy(*g).orderBy("h") if g else Window.orderBy("h")
    rows = src if distinct_input else src.distinct()
    ranked = rows.withColumn("pos", F.dense_rank().over(w)).where(F.col("pos") <= k)
    return ranked.dropDuplicates([*g, "h"])


def kmv_estimate(smallest: DataFrame, k: int, group_cols=None, estimator: str = "k-1") -> DataFrame:
    """(groups..., held, estimate): exact count when fewer than k distinct
    hashes exist; else (k-1) / U_k with U_k = h_k / 2^60 (``estimator="k"``
    gives k / U_k, used automatically for k = 1)."""
    g = _groups(group_cols)
    top = smallest.where(F.col("pos") <= k)
    s = top.groupBy(*g).agg(F.count(F.lit(1)).alias("held"), F.max("h").alias("h_k"))
    num = k if (estimator == "k" or k == 1) else k - 1
    est = F.when(F.col("held") < k, F.col("held").cast("double")).otherwise(
        F.lit(float(num) * float(1 << HASH_BITS)) / F.col("h_k")
    )
    return s.select(*g, "held", est.alias("estimate"))


def kmv_estimate_many(smallest: DataFrame, ks: Sequence[int], group_cols=None) -> DataFrame:
    """(groups..., k, held, estimate) for every k in ``ks`` from one table of
    the max(ks) smallest hashes (each k takes a prefix), in one aggregate."""
    g = _groups(group_cols)
    e = smallest.select(*g, "h", "pos", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"))
    s = e.where(F.col("pos") <= F.col("k")).groupBy(*g, "k").agg(
        F.count(F.lit(1)).alias("held"), F.max("h").alias("h_k")
    )
    num = F.when(F.col("k") == 1, F.lit(1.0)).otherwise((F.col("k") - 1).cast("double"))
    est = F.when(F.col("held") < F.col("k"), F.col("held").cast("double")).otherwise(
        num * F.lit(float(1 << HASH_BITS)) / F.col("h_k")
    )
    return s.select(*g, "k", "held", est.alias("estimate"))


def kmv_count(df: DataFrame, value_col: str, k: int, group_cols=None, hash_fn: str = "md5") -> DataFrame:
    return kmv_estimate(kmv_smallest(with_hash(df, value_col, hash_fn=hash_fn), k, group_cols), k, group_cols)


def kmv_merge(*smallest_tables: DataFrame, k: int, group_cols=None) -> DataFrame:
    """Union of KMV sketches = k smallest of the union (set semantics)."""
    g = _groups(group_cols)
    u = smallest_tables[0].select(*g, "h")
    for t in smallest_tables[1:]:
        u = u.unionByName(t.select(*g, "h"))
    w = Window.partitionBy(*g).orderBy("h") if g else Window.orderBy("h")
    return u.distinct().withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= k)


# ---- error experiment ----------------------------------------------------------

HLL_PS = (3, 4, 5, 6, 7, 8, 9, 10)
KMV_KS = (8, 16, 32, 64, 128, 256, 512, 1024)


def estimator_rmse(
    df: DataFrame,
    value_col: str,
    seeds: Sequence[int] = tuple(range(1, 11)),
    hll_ps: Sequence[int] = HLL_PS,
    kmv_ks: Sequence[int] = KMV_KS,
) -> DataFrame:
    """(algorithm, size, exact, rmse) over one stream seen through ``seeds``
    independent salted hashes. One pass: registers at the largest p and the
    largest-k minimum set per seed; every smaller size is a fold/prefix of
    those bounded tables, and the exact count comes from the same scan."""
    seeds = list(seeds)
    pmax, kmax = max(hll_ps), max(kmv_ks)
    # The exact count needs the distinct values anyway; sketches are blind
    # to duplicates, so each seed hashes the distinct values only.
    values = df.select(F.col(value_col).alias("v")).where(F.col("v").isNotNull()).distinct()
    salted = values.select("v", F.explode(F.array(*[F.lit(s) for s in seeds])).alias("seed"))
    hashed = salted.select("seed", F.conv(
        F.substring(F.md5(F.concat_ws("|", F.col("seed").cast("string"), F.col("v").cast("string"))), 1, 15), 16, 10
    ).cast("bigint").alias("h"))
    exact = values.agg(F.count(F.lit(1)).alias("exact")).select(
        "exact", F.explode(F.array(*[F.lit(s) for s in seeds])).alias("seed")
    )
    regs = hll_registers(hashed, pmax, "seed")
    hll = hll_estimate_many(hll_fold_many(regs, pmax, hll_ps, "seed"), hll_ps, "seed").select(
        "seed", F.lit("hll").alias("algorithm"), F.col("p").alias("size"), "estimate"
    )
    mins = kmv_smallest(hashed, kmax, "seed", distinct_input=True)
    kmv = kmv_estimate_many(mins, kmv_ks, "seed").select(
        "seed", F.lit("kmv").alias("algorithm"), F.col("k").alias("size"), "estimate"
    )
    allest = hll.unionByName(kmv)
    return (
        allest.join(F.broadcast(exact), "seed")  # one row per seed
        .groupBy("algorithm", "size", "exact")
        .agg(F.sqrt(F.avg(F.pow(F.col("estimate") - F.col("exact"), 2))).alias("rmse"))
    )



# ---- theta sketches: sets of distinct values ------------------------------------------


def theta_sketch(df: DataFrame, value_col: str, group_cols=None, lg_entries: int = 12) -> DataFrame:
    """(groups..., sketch): a mergeable sketch of the distinct values of each
    group, exact up to 2^lg_entries of them; beyond, the relative standard error
    of its size is about 1 / sqrt(2^lg_entries). Null values are in no set. One
    partial aggregate and one exchange of a sketch per group and task."""
    return df.groupBy(*_groups(group_cols)).agg(F.theta_sketch_agg(value_col, F.lit(lg_entries)).alias("sketch"))


def theta_union(sketches: DataFrame, group_cols=None, lg_entries: int = 12) -> DataFrame:
    """Sketches of the same or of larger groups, united."""
    return sketches.groupBy(*_groups(group_cols)).agg(F.theta_union_agg("sketch", F.lit(lg_entries)).alias("sketch"))


def theta_compare(pairs: DataFrame, a: str, b: str, lg_entries: int = 12) -> DataFrame:
    """Adds n_a, n_b, n_union, n_both, n_only_a and n_only_b to rows with two
    sketch columns, without the values; a null sketch is an empty set. The
    error of a difference or intersection is relative to the union's size."""
    size = lambda c: F.coalesce(F.theta_sketch_estimate(c), F.lit(0)).cast("bigint")
    x, y = F.col(a), F.col(b)
    both = F.when(x.isNotNull() & y.isNotNull(), size(F.theta_intersection(x, y))).otherwise(F.lit(0))
    union = F.when(x.isNotNull() & y.isNotNull(), size(F.theta_union(x, y, F.lit(lg_entries)))).otherwise(size(F.coalesce(x, y)))
    only_a = F.when(y.isNull(), size(x)).when(x.isNull(), F.lit(0)).otherwise(size(F.theta_difference(x, y)))
    only_b = F.when(x.isNull(), size(y)).when(y.isNull(), F.lit(0)).otherwise(size(F.theta_difference(y, x)))
    named = {"n_a": size(x), "n_b": size(y), "n_union": union, "n_both": both, "n_only_a": only_a, "n_only_b": only_b}
    return pairs.select("*", *[c.cast("bigint").alias(k) for k, c in named.items()])
