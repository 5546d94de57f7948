"""The registered queries of this subpackage: thin digests of the operators' results, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestay.llm import (bpe, centroids, decontaminate, fingerprint, html_main, license_scan, linededup, quality, secret_scan,
                          simhash, suffixarray, toxicity, whitening)
from carestay.llm.store import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def default_vocabulary() -> str:
    """The vocabulary file of the installed public tokenizers package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _predicted(scored: DataFrame, held: F.Column, threshold: float) -> DataFrame:
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


@_query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _predicted(toxicity.score(docs, model), toxicity.is_held_out(F.col("doc_id"), 3, 1), 0.7)


@_query
def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


@_query
def op3_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages"))


@_query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicate_groups(table(spark, sf_dir, "documents"), shingle_words=4, radius=4)
    return groups.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@_query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(table(spark, sf_dir, "documents"))


@_query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@_query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _predicted(quality.score(docs, model), quality.is_held_out(F.col("doc_id"), 5, 0), 0.3)


@_query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)


@_query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), default_vocabulary())


@_query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.kept_digests(table(spark, sf_dir, "documents"), min_chars=10)


@_query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"), clusters=8, rounds=10, seed=3, scale=1024)


@_query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixarray.kept_digests(table(spark, sf_dir, "documents"), length=50)


@_query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a deviation that outgrows a long is null here; the operator gives it as a decimal
    rows = whitening.whitened(table(spark, sf_dir, "embeddings"), components=4, scale=256)
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


ORACLES["op8_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)),
b AS (
  SELECT item_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM benchmark)),
items AS (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS gram
            FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT size FROM items),
places AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
           FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, p.size, i, item_id FROM places p JOIN windows USING (size, gram)),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
          FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# white space is named by code point: DuckDB's plain trim() strips only blanks
ORACLES["op10_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
owners AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT doc_id, pos, line, coalesce(owner <> doc_id, false) AS lost FROM keyed LEFT JOIN owners USING (k))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _centroid_sql(clusters: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024) -> str:
    """Rounds written out one after another, over one row a component."""
    placed = """{name} AS MATERIALIZED (
  SELECT rid, arg_min(c, d * 100 + c) AS c, min(d) AS d
  FROM (SELECT rid, c, sum((v.x - m.x) * (v.x - m.x)) AS d FROM v JOIN m{i} m USING (dim) GROUP BY rid, c) GROUP BY rid)"""
    parts = [f"""
WITH rows AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings WHERE len(embedding) = 64),
cells AS (SELECT rid, unnest(embedding) AS e, unnest(range(64)) AS dim FROM rows),
fine AS (SELECT rid FROM cells GROUP BY rid HAVING bool_and(e IS NOT NULL AND isfinite(coalesce(e, 0)))),
v AS MATERIALIZED (SELECT rid, dim, CAST(floor({scale} * CAST(e AS DOUBLE)) AS HUGEINT) AS x FROM cells JOIN fine USING (rid)),
firsts AS (SELECT rid, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, embedding) - 1 AS c FROM rows JOIN fine USING (rid)),
m0 AS MATERIALIZED (SELECT c, dim, x FROM firsts JOIN v USING (rid) WHERE c < {clusters})"""]
    for i in range(rounds):
        parts.append(placed.format(name=f"a{i}", i=i))
        parts.append(f"""m{i + 1} AS MATERIALIZED (
  SELECT m.c, m.dim, coalesce(t.x, m.x) AS x
  FROM m{i} m LEFT JOIN (SELECT c, dim, (s - ((s % n) + n) % n) // n AS x
    FROM (SELECT c, dim, sum(x) AS s, count(*) AS n FROM v JOIN a{i} USING (rid) GROUP BY c, dim)) t ON t.c = m.c AND t.dim = m.dim)""")
    parts.append(placed.format(name="final", i=rounds))
    return ",\n".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM final JOIN rows USING (rid)
JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM m{rounds} GROUP BY c) USING (c)
"""


ORACLES["op11_centroids"] = _centroid_sql()

# bytes as pairs of hexadecimal digits
ORACLES["op12_suffix_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (SELECT rid, doc_id, p, substr(x, 2 * p + 1, 100) AS w
            FROM (SELECT rid, doc_id, x, unnest(range(len(x) // 2 - 49)) AS p FROM d WHERE len(x) >= 100)),
owners AS (SELECT w, min(doc_id) AS owner FROM windows GROUP BY w),
starts AS (SELECT rid, p FROM windows JOIN owners USING (w) WHERE owner < doc_id),
gone AS (SELECT DISTINCT rid, p FROM (SELECT rid, unnest(range(p, p + 50)) AS p FROM starts)),
runs AS (SELECT rid, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before < p - 1) AS n_spans
         FROM (SELECT rid, p, lag(p) OVER (PARTITION BY rid ORDER BY p) AS before FROM gone) GROUP BY rid),
bytes AS (SELECT rid, substr(x, 2 * p + 1, 2) AS b, p FROM (SELECT rid, x, unnest(range(len(x) // 2)) AS p FROM d JOIN runs USING (rid))),
kept AS (SELECT rid, string_agg(b, '' ORDER BY p) AS x FROM bytes ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n_removed IS NULL THEN d.x ELSE coalesce(kept.x, '') END)) AS kept_sha256
FROM d LEFT JOIN runs USING (rid) LEFT JOIN kept USING (rid)
"""
