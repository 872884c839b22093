"""URL filter: rules first, then gradient-boosted trees on lexical features.

``split_url`` gives host and path. ``rule_for`` finds the longest of a short
list of rules (host with its subdomains, path prefix). Where none fits,
``UrlModel`` judges: lengths, depth, digit ratio, entropy of the host's
characters, counts of parameters, hyphens and dots, and statistics of the
host's suffix, alone and with the first part of the path (how often it was seen
in training and how often to be blocked).

The trees are trained with Spark's own learner on labelled URLs, at most
``max_rows`` distinct ones, half for each label, picked by hash, so the choice
does not depend on the partitioning. Labels are given: by a table, or by the
rules (``labelled_by_rules``), whose decisions the trees carry over to URLs that
no rule fits. Suffix and section statistics come from the sample alone: the tables
have at most ``max_rows`` rows and are broadcast. A training row is shown the statistics of the
other folds only, so a label does not reach the trees through its own suffix.

Null URLs and URLs without ``://`` have empty host and path, fit no rule and
are judged by their features like all others. Without any labelled URL of one
of the labels everything is allowed. Repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, action) of the longest fitting rule, or null."""
    best = F.lit(None).cast("struct<rule:string,action:string>")
    for action, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        best = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("action"))).otherwise(best)
    return best


def labelled_by_rules(urls: DataFrame, rules: list[tuple[str, str, str]], url: str = "url") -> DataFrame:
    """(url, label) of the URLs that a rule decides: 1 for block, 0 for allow."""
    host, path = split_url(F.col(url))
    action = rule_for(host, path, rules)["action"]
    return urls.select(F.col(url).alias("url"), action.alias("action")).where("action is not null").select(
        "url", (F.col("action") == "block").cast("double").alias("label")
    )


FOLDS = 5
SMOOTH = 10.0  # rows of the average label that every suffix is given


def _fold(url: Column) -> Column:
    return F.pmod(F.xxhash64(url, F.lit("fold")), F.lit(FOLDS)).cast("int")


FEATURES = [
    "f_host", "f_path", "f_url", "f_depth", "f_digits", "f_entropy", "f_params", "f_hyphens", "f_labels",
    "f_longest", "f_query", "f_suffix_seen", "f_suffix_rate", "f_section_seen", "f_section_rate",
]


def _entropy(text: Column) -> Column:
    n = F.length(text)
    letters = F.filter(F.split(text, ""), lambda c: c != "")

    def term(c: Column) -> Column:
        p = F.size(F.filter(letters, lambda x: x == c)) / n
        return -p * F.log2(p)

    return F.when(n == 0, 0.0).otherwise(
        F.aggregate(F.transform(F.array_distinct(letters), term), F.lit(0.0), lambda a, x: a + x)
    )


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """Add the lexical features of a URL, its suffix (the host's last two labels)
    and its section (suffix and first part of the path)."""
    text = F.coalesce(F.col(url), F.lit(""))
    host, path = split_url(F.col(url))
    labels = F.split(host, r"\.")
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    n = F.greatest(F.length(text), F.lit(1))
    return (
        df.withColumn("f_host", F.length(host).cast("double"))
        .withColumn("f_path", F.length(path).cast("double"))
        .withColumn("f_url", F.length(text).cast("double"))
        .withColumn("f_depth", F.size(F.filter(F.split(path, "/"), lambda s: s != "")).cast("double"))
        .withColumn("f_digits", F.length(F.regexp_replace(text, "[^0-9]", "")) / n)
        .withColumn("f_entropy", _entropy(host))
        .withColumn("f_params", F.size(F.filter(F.split(query, "&"), lambda s: s != "")).cast("double"))
        .withColumn("f_hyphens", (F.length(host) - F.length(F.translate(host, "-", ""))).cast("double"))
        .withColumn("f_labels", F.size(labels).cast("double"))
        .withColumn("f_longest", F.array_max(F.transform(labels, lambda s: F.length(s))).cast("double"))
        .withColumn("f_query", F.length(query).cast("double"))
        .withColumn("suffix", F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2))))
        .withColumn("section", F.concat("suffix", F.regexp_extract(path, "^/[^/]*", 0)))
    )


@dataclass
class UrlModel:
    """Suffix and section statistics (each: key, f_seen, f_rate) and trees;
    without trees everything is allowed."""

    suffixes: DataFrame | None
    sections: DataFrame | None
    trees: GBTClassificationModel | None
    prior: float

    def _features(self, df: DataFrame, url: str) -> DataFrame:
        return _with_rates(lexical(df, url), {"suffix": self.suffixes, "section": self.sections}, [], self.prior)

    def score(self, df: DataFrame, url: str = "url", out: str = "p_block") -> DataFrame:
        """Add the probability that a URL is to be blocked."""
        if self.trees is None:
            return df.withColumn(out, F.lit(0.0))
        columns = df.columns
        rows = VectorAssembler(inputCols=FEATURES, outputCol="f_vector").transform(self._features(df, url))
        scored = self.trees.transform(rows)
        return scored.select(*columns, vector_to_array(F.col("f_probability"))[1].alias(out))


def _with_rates(rows: DataFrame, tables: dict[str, DataFrame], on: list[str], prior: float) -> DataFrame:
    """Statistics of the suffix and the section, joined by those and ``on``."""
    for key, table in tables.items():
        rows = rows.join(F.broadcast(table), [key, *on], "left")
        rows = rows.withColumn(f"f_{key}_seen", F.log1p(F.coalesce("f_seen", F.lit(0)))).withColumn(
            f"f_{key}_rate", F.coalesce("f_rate", F.lit(prior))
        ).drop("f_seen", "f_rate")
    return rows


def _rates(sample: DataFrame, key: str, prior: float) -> tuple[DataFrame, DataFrame]:
    """(key, f_seen, f_rate) of all rows, and (key, fold, f_seen, f_rate) of the
    rows of the other folds."""
    parts = sample.groupBy(key, "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked"))
    parts = written(parts, "url-rates")
    sums = parts.groupBy(key).agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"))
    stats = F.col("n").alias("f_seen"), ((F.col("blocked") + SMOOTH * prior) / (F.col("n") + SMOOTH)).alias("f_rate")
    own = parts.select(key, "fold", F.col("n").alias("own_n"), F.col("blocked").alias("own_blocked"))
    others = own.join(sums, key).select(
        key, "fold", (F.col("n") - F.col("own_n")).alias("n"), (F.col("blocked") - F.col("own_blocked")).alias("blocked")
    )
    return written(sums.select(key, *stats), "url-rates"), others.select(key, "fold", *stats)


def train(
    labelled: DataFrame, url: str = "url", label: str = "label", max_rows: int = 20_000, trees: int = 20, depth: int = 4,
    seed: int = 7,
) -> UrlModel:
    """Fit on at most ``max_rows`` distinct labelled URLs (label 1: block, 0:
    allow). A URL with both labels is there once for each."""
    distinct = labelled.where(F.col(url).isNotNull() & F.col(label).isNotNull()).select(
        F.col(url).alias("url"), F.col(label).cast("double").alias("label")
    ).distinct()
    order = F.xxhash64("url"), F.col("url"), F.col("label")
    half = max_rows // 2
    sample = distinct.where("label = 1").orderBy(*order).limit(half).unionAll(
        distinct.where("label = 0").orderBy(*order).limit(max_rows - half)
    )
    sample = written(sample, "url-sample")
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return UrlModel(None, None, None, 0.0)
    prior = counts[1.0] / sum(counts.values())
    told = lexical(sample).withColumn("fold", _fold(F.col("url")))
    (suffixes, other_suffixes), (sections, other_sections) = (_rates(told, key, prior) for key in ("suffix", "section"))
    model = UrlModel(suffixes, sections, None, prior)
    shown = _with_rates(told, {"suffix": other_suffixes, "section": other_sections}, ["fold"], prior)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="f_vector").transform(shown)
    rows = rows.select("f_vector", "label", "url").coalesce(1).sortWithinPartitions(F.xxhash64("url"), "url")
    learner = GBTClassifier(
        featuresCol="f_vector", labelCol="label", maxIter=trees, maxDepth=depth, seed=seed, maxBins=64
    )
    learner.setPredictionCol("f_prediction").setRawPredictionCol("f_raw").setProbabilityCol("f_probability")
    model.trees = learner.fit(rows)
    return model


def judge(
    pages: DataFrame, model: UrlModel, rules: list[tuple[str, str, str]], keep: list[str], url: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """``keep`` columns, host, path, rule and verdict of every row."""
    host, path = split_url(F.col("_url"))
    rows = model.score(pages.select(*keep, F.col(url).alias("_url")), "_url", "_p")
    best = rule_for(F.col("host"), F.col("path"), rules)
    return (
        rows.withColumn("host", host)
        .withColumn("path", path)
        .withColumn("_best", best)
        .withColumn("rule", F.col("_best.rule"))
        .withColumn(
            "verdict",
            F.coalesce(F.col("_best.action"), F.when(F.col("_p") >= threshold, "block").otherwise("allow")),
        )
        .select(*keep, "host", "path", "rule", "verdict", F.col("_p").alias("p_block"))
    )
