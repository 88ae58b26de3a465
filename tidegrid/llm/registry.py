"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import corpus, decontaminate, divergence, exact, language, lines, mixing, neighbours, rules, secrets, simhash, tokens, warc, whitening
from tidegrid.llm.common import held_out, stored, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Containment in SQL: for each length of shingles all shingles of all rows against all shingles of all item texts.
DECONTAMINATE_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents),
it AS (
  SELECT row_number() OVER () AS t, item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL)),
iw AS (SELECT *, least(len(w), 5) AS m FROM it WHERE len(w) > 0),
s AS (
  SELECT DISTINCT t, item_id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS s FROM iw),
n AS (SELECT t, count(*) AS n FROM s GROUP BY t),
ds AS (
  SELECT DISTINCT r, doc_id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS s
  FROM dw, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m),
f AS (SELECT r, doc_id, t, item_id, count(*) / CAST(any_value(n) AS DOUBLE) AS contained
      FROM ds JOIN s USING (m, s) JOIN n USING (t) GROUP BY r, doc_id, t, item_id)
SELECT doc_id, item_id, max(contained) AS contained FROM f WHERE contained >= 0.8 - 1e-12 GROUP BY doc_id, item_id
"""


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents"), tokens.vocabulary())


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = stored(mixing.with_sizes(docs.select("doc_id", "source", "text")).drop("text"), "sizes")
    return mixing.decisions(sized).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_taken").alias("taken"),
        F.round("_first", 6).alias("first_position"),
    )


#: The mix in SQL: the same order within a source, without ranges.
MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, CAST([3, 1, 2][rank % 3 + 1] AS DOUBLE) AS weight, [-0.5, 0.0, 0.5][rank % 3 + 1]::DOUBLE AS slope,
             source_size * 2.0::DOUBLE AS bound FROM r),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                 - coalesce(sum(bound) OVER (ORDER BY bound / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / (sum(weight) OVER ()
                 - coalesce(sum(weight) OVER (ORDER BY bound / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM w),
f AS (SELECT max(level) AS level FROM (SELECT level FROM l WHERE bound > level * weight ORDER BY bound / weight, rank LIMIT 1)),
t AS (SELECT source, source_size, slope,
             CASE WHEN f.level IS NULL THEN bound ELSE least(bound, f.level * weight) END AS target FROM l, f),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.slope, CAST(round(t.target) AS BIGINT) AS goal,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin_at
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, greatest(least(size, goal - begin_at), 0) AS w0, greatest(least(size, goal - begin_at - source_size), 0) AS w1 FROM p),
q AS (SELECT *, (begin_at + w0 / 2.0::DOUBLE) / greatest(goal, 1) AS share FROM k)
SELECT doc_id, size, source_size, target, CAST(w0 + w1 AS BIGINT) AS taken,
       CASE WHEN w0 > 0 THEN round(CASE WHEN slope = 0 THEN share
         ELSE 2 * share / ((1 - slope) + sqrt(greatest((1 - slope) * (1 - slope) + 4 * slope * share, 0))) END, 6) END AS first_position
FROM q
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rules.train(docs, table(spark, sf_dir, "labels"))
    return rules.classify(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id"), rules.FOLDS, rules.FOLD).alias("held_out"),
        "score",
        (F.col("score") >= rules.CUT).cast("int").alias("predicted"),
    )


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs))
    fold = held_out(F.col("doc_id"), language.FOLDS, language.FOLD)
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score", "ambiguous")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


WARC_SQL = """
WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest),
r AS (SELECT p.*, CASE WHEN f.first IS NOT NULL AND p.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
      FROM p LEFT JOIN f USING (payload_digest))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, url
FROM r
"""


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


#: The audit in SQL: shares of all kept terms in all groups, all pairs of groups.
DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(n.n, 0) + 2 * v.v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (k.total + 2)) // (v.n + 2 * v.v)::HUGEINT AS q
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
f AS (
  SELECT *, row_number() OVER (PARTITION BY part, lang, source ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM f WHERE part = 'pair' OR rank <= 10
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.decisions(exact.build(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("key")).alias("text_sha256"))


EXACT_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""


_ALL: dict[str, tuple[Query, str | None]] = {
    "op1_decontaminate": (op1_decontaminate, DECONTAMINATE_SQL),
    "op2_tokens": (op2_tokens, None),
    "op3_simhash": (op3_simhash, None),
    "op4_secrets": (op4_secrets, None),
    "op5_mixing": (op5_mixing, MIXING_SQL),
    "op6_quality": (op6_quality, None),
    "op7_lines": (op7_lines, None),
    "op8_neighbours": (op8_neighbours, None),
    "op9_language": (op9_language, None),
    "op10_warc": (op10_warc, WARC_SQL),
    "op11_divergence": (op11_divergence, DIVERGENCE_SQL),
    "op12_whitening": (op12_whitening, None),
    "op13_exact": (op13_exact, EXACT_SQL),
    "pipeline": (corpus.run, corpus.ORACLE_SQL),
}


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
