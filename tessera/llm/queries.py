"""Registered queries of the text-collection operators and their SQL twins.

Each query applies one operator with its production parameters to its whole
table. Twins are given where SQL can express the result; the trees (op3), the
page tree (op4), the tokenizer (op5), the trained classifiers (op8, op9) and
the XXH64 fingerprints (op13) have none and are tested against brute force, round trips or held-out rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, decontam, gridcodes, htmltext, langid, mixing, ngramjoin, pivots, quality, repeats, sketch, tokenfile, urlfilter
from .common import document_key, id_of, read_table, written

# The rules of the URL filter (action, host, path).
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    plan = mixing.mix_plan(written(sized, "mix-sized"))
    return plan.select("doc_id", "source", "size", "source_size", "target", "reps", "taken")


def op2_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf, "documents"), with_text=False)


def op3_urls(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "pages").select("page_id", "url")
    labelled = urlfilter.labelled_by_rules(pages, RULES)
    return urlfilter.judge(pages, urlfilter.train(labelled), RULES, ["page_id"])


def op4_html(spark: SparkSession, sf: str) -> DataFrame:
    return htmltext.extract_text(read_table(spark, sf, "pages"))


def op5_tokens(spark: SparkSession, sf: str) -> DataFrame:
    path = tokenfile.write_tokens(
        read_table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER), end_id=END_ID
    )
    return tokenfile.read_tokens(spark, path, with_ids=False)


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontam.matches(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
    return found.select(id_of("k_id").alias("doc_id"), "item_id", "similarity", "start", F.col("n").alias("n_words"))


def op7_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    classes = ngramjoin.similarity_classes(docs)
    key = dict(zip(ngramjoin.KEY, document_key(), strict=True))
    rows = docs.select("doc_id", *[c.alias(n) for n, c in key.items()]).join(classes, ngramjoin.KEY)
    return rows.select("doc_id", id_of("c_id").alias("class_id"), "n_links")


def op8_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    out = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~out))
    return langid.predict(docs, model, [F.col("doc_id"), out.alias("held_out")])


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return quality.score(docs, quality.train(docs, read_table(spark, sf, "labels")))


def op10_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = read_table(spark, sf, "documents").select("doc_id", text.alias("text"))
    rows = sketch.with_next(docs, "doc_id", ["text"], {"sk": sketch.sketch(F.col("text"))})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sk", "next_sk", edited.alias("edited"))
    rows = rows.select(
        "doc_id", "n_chars", "sk", "next_sk",
        F.sha2("edited", 256).alias("edited_sha256"), sketch.sketch(F.col("edited")).alias("ek"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.concat_ws(" ", "sk").alias("fingerprint"),
        F.concat_ws(" ", "ek").alias("edited_fingerprint"),
        sketch.likeness(F.col("sk"), F.col("ek")).alias("near_edited"),
        sketch.likeness(F.col("sk"), F.col("next_sk")).alias("near_next"),
    )


def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded = gridcodes.encode(read_table(spark, sf, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit(audit.judge(read_table(spark, sf, "documents"), read_table(spark, sf, "labels")))


def op13_simhash(spark: SparkSession, sf: str) -> DataFrame:
    linked = pivots.near_components(read_table(spark, sf, "documents"))
    return linked.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing, op2_repeats, op3_urls, op4_html, op5_tokens, op6_decontamination, op7_ngram_join, op8_language,
        op9_quality, op10_fingerprints, op11_vector_codes, op12_filter_audit, op13_simhash,
    )
}


# --- SQL twins ---------------------------------------------------------------

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = f"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         ('0x' || substr(md5('mix|0|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s
), o AS (
  SELECT *, 3 * source_size AS cap,
         row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS k FROM w
), p AS (
  SELECT *, (SELECT sum(source_size) FROM s) AS budget,
         coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
         sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM o
), l AS (
  SELECT CAST(budget - taken AS DOUBLE) / CAST(open AS DOUBLE) AS level
  FROM p WHERE CAST(budget - taken AS DOUBLE) / CAST(open AS DOUBLE) * weight <= cap
  ORDER BY k LIMIT 1
), t AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), level * weight) AS target FROM o, l
), n AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t
), m AS (
  SELECT *, target - whole * source_size AS need FROM n
), c AS (
  SELECT d.*, m.source_size, m.target, m.whole, m.need,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN m ON d.source IS NOT DISTINCT FROM m.source
), g AS (
  SELECT source, max(need) - coalesce(max(upto) FILTER (WHERE upto <= need), 0) AS gap FROM c GROUP BY source
), f AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.source ORDER BY
             (upto > need AND size < 2 * gap) DESC, abs(gap - size), h, doc_id, size, upto) = 1
             AND upto > need AND size < 2 * gap AS fills
  FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, source, size, source_size, target,
       CAST(whole + (upto <= need OR fills)::INT AS BIGINT) AS reps,
       CAST(whole + (upto <= need OR fills)::INT AS BIGINT) * size AS taken
FROM f
"""

_OP2 = f"""
WITH d AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), x AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d
), k AS (
  SELECT doc_id, i, w[i] AS word,
         CASE WHEN i + 19 <= len(w) THEN md5(array_to_string(w[i:i + 19], ' ')) END AS h FROM x
), r AS (
  SELECT *, h IS NOT NULL AND row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS again FROM k
), c AS (
  SELECT doc_id, i, word,
         max(again::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM r
), a AS (
  SELECT doc_id, sum(gone)::BIGINT AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS kept
  FROM c GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN a ON d.doc_id = a.doc_id
"""

_OP6 = r"""
WITH i AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark
), items AS (
  SELECT *, len(w) AS n, least(len(w), 5) AS k FROM i WHERE len(w) > 0
), d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), ip AS (
  SELECT item_id, n, k, j, array_to_string(w[j:j + k - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, n - k + 2)) AS j FROM items)
), ks AS (
  SELECT DISTINCT k FROM items
), dp AS (
  SELECT doc_id, w, k, j, array_to_string(w[j:j + k - 1], ' ') AS s
  FROM (SELECT d.*, ks.k, unnest(range(1, len(w) - k + 2)) AS j FROM d, ks)
), laid AS (
  SELECT DISTINCT dp.doc_id, dp.w, ip.item_id, ip.n, ip.k,
         greatest(least(dp.j - ip.j, len(dp.w) - ip.n), 0) AS start
  FROM dp JOIN ip ON dp.s = ip.s AND dp.k = ip.k
), ws AS (
  SELECT doc_id, item_id, n, start, array_to_string(v[j:j + k - 1], ' ') AS s, count(*) AS c
  FROM (SELECT *, unnest(range(1, len(v) - k + 2)) AS j
        FROM (SELECT *, w[start + 1:start + n] AS v FROM laid))
  GROUP BY ALL
), it AS (
  SELECT item_id, s, count(*) AS c FROM ip GROUP BY ALL
), wa AS (
  SELECT doc_id, item_id, n, start, sum(c * length(replace(s, ' ', ''))) AS a FROM ws GROUP BY ALL
), ia AS (
  SELECT item_id, sum(c * length(replace(s, ' ', ''))) AS b FROM it GROUP BY ALL
), m AS (
  SELECT ws.doc_id, ws.item_id, ws.n, ws.start, sum(least(ws.c, it.c) * length(replace(ws.s, ' ', ''))) AS shared
  FROM ws JOIN it ON ws.item_id = it.item_id AND ws.s = it.s GROUP BY ALL
), q AS (
  SELECT m.doc_id, m.item_id, m.n, m.start,
         CAST(shared AS DOUBLE) / CAST(a + b - shared AS DOUBLE) AS similarity
  FROM m JOIN wa USING (doc_id, item_id, n, start) JOIN ia USING (item_id)
)
SELECT doc_id, item_id, similarity, CAST(start AS INT) AS start, CAST(n AS INT) AS n_words
FROM q WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""

_OP7 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[j:j + 4], ' ') AS h
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS j FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS MATERIALIZED (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE c >= 0.8 * (a.n + b.n - c)
), reach AS (
  SELECT x, y FROM l UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x
), least_ AS (
  SELECT x, min(y) AS m FROM reach GROUP BY x
), links AS (
  SELECT x, count(*) AS c FROM l GROUP BY x
)
SELECT doc_id, least(doc_id, coalesce(m, doc_id)) AS class_id, coalesce(c, 0) AS n_links
FROM d LEFT JOIN least_ ON least_.x = doc_id LEFT JOIN links ON links.x = doc_id
"""


def _sketch_sql(words: str) -> str:
    hashes = (
        f"[substr(md5(array_to_string({words}[i:i + 4], ' ')), 1, 16)"
        f" for i in range(1, greatest(len({words}) - 4, 1) + 1)]"
    )
    return f"CASE WHEN len({words}) = 0 THEN [] ELSE {hashes} END"


_KEPT = "list_sort(list_distinct(list_append([x for x in {0} if x < '6'], list_min({0}))))"


def _like_sql(a: str, b: str) -> str:
    low = [f"[x for x in {c} if x < '6']" for c in (a, b)]
    least = f"least(len({low[0]}), len({low[1]}))"
    return f"""CASE WHEN {least} = 0 THEN ({a} = {b})::INT::DOUBLE
            ELSE len(list_intersect({low[0]}, {low[1]}))::DOUBLE / {least} END"""



_OP10 = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents
), o AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first(text) OVER (ORDER BY doc_id DESC)) AS nxt FROM d
), e AS (
  SELECT *, text[1:length(text) - length(text) // 2] || nxt[1:length(text) // 2] AS edited FROM o
), ew AS (
  SELECT *, {_WORDS.replace("text", "edited")} AS we FROM e
), h AS (
  SELECT *, {_sketch_sql("w")} AS hw, {_sketch_sql("we")} AS he FROM ew
), k AS (
  SELECT *, CASE WHEN len(w) = 0 THEN [] ELSE {_KEPT.format("hw")} END AS sk,
            CASE WHEN len(we) = 0 THEN [] ELSE {_KEPT.format("he")} END AS ek FROM h
), z AS (
  SELECT *, coalesce(lead(sk) OVER (ORDER BY doc_id DESC), first(sk) OVER (ORDER BY doc_id DESC)) AS nk FROM k
)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256,
       coalesce(array_to_string(sk, ' '), '') AS fingerprint,
       coalesce(array_to_string(ek, ' '), '') AS edited_fingerprint,
       {_like_sql("sk", "ek")} AS near_edited,
       {_like_sql("sk", "nk")} AS near_next
FROM z
"""

def _op11_sql(rounds: int = 6, entries: int = 16, parts: int = 8) -> str:
    """Every round unrolled: nearest entries, then floored means of their parts."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096.0 * x) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: isnan(x) OR isinf(x))) = 0
), pieces AS MATERIALIZED (
  SELECT vec_id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x
  FROM kept, range({parts}) t(p)
), book0 AS MATERIALIZED (
  SELECT p, e, x FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM pieces)
  WHERE e < {entries}
)"""]
    near = """
near{k} AS MATERIALIZED (
  SELECT vec_id, p, x, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT i.vec_id, i.p, i.x, b.e,
           CAST(list_sum(list_transform(list_zip(i.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM pieces i JOIN book{k} b ON i.p = b.p)
  GROUP BY vec_id, p, x
)"""
    for k in range(rounds):
        steps.append(near.format(k=k))
        steps.append(f"""
sums{k} AS (
  SELECT p, e, j, sum(x[j + 1]) AS s, count(*) AS c FROM near{k}, range(64) t(j) WHERE j < len(x) GROUP BY p, e, j
), means{k} AS (
  SELECT p, e, list(CAST((s - ((s % c) + c) % c) // c AS BIGINT) ORDER BY j) AS x FROM sums{k} GROUP BY p, e
), book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN means{k} m ON b.p = m.p AND b.e = m.e
)""")
    steps.append(near.format(k=rounds))
    return f"""
WITH {",".join(steps)}, sha AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
), coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id
)
SELECT c.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded c JOIN kept k ON c.vec_id = k.vec_id, sha
"""


_OP12 = f"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {_WORDS} AS w FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first_id FROM w GROUP BY text
), j AS (
  SELECT w.doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 3 * length(w.text) AS c,
         regexp_matches(w.text, '[#$%&*|]') AS d, w.doc_id > first_id AS e
  FROM w JOIN firsts ON w.text = firsts.text
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, if(a, 'A', '') || if(b, 'B', '') || if(c, 'C', '') || if(d, 'D', '') || if(coalesce(e, false), 'E', '') AS fails,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM j LEFT JOIN l ON j.doc_id = l.doc_id
), g AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), r AS (
  SELECT part, fails, n, good, toxic, o, step::INT AS step, substr(o, step::INT, 1) AS x,
         len(regexp_replace(left(o, step::INT - 1), '[^' || fails || 'Z]', '', 'g')) > 0 AS earlier
  FROM g, orders, range(1, 6) t(step)
), s AS (
  SELECT part, o AS filter_order, step, x,
         coalesce(sum(n) FILTER (WHERE NOT earlier AND NOT contains(fails, x)), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE NOT earlier AND contains(fails, x)), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE earlier AND contains(fails, x)), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = x), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE NOT earlier AND contains(fails, x)), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE NOT earlier AND contains(fails, x)), 0) AS toxic_lost
  FROM r GROUP BY part, o, step, x
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM s
"""

ORACLES = {
    "op1_mixing": _OP1,
    "op2_repeats": _OP2,
    "op6_decontamination": _OP6,
    "op7_ngram_join": _OP7,
    "op10_fingerprints": _OP10,
    "op11_vector_codes": _op11_sql(),
    "op12_filter_audit": _OP12,
}
