"""The registered queries of the operators: each applies one to its whole table."""

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import (alignment, language, licenses, mixing, nearest, neardup, packing, repetition,
                           resampling, substrings, tokencount, toxicity, urlfilter)
from orderloom.llm.common import from_parquet

QUERIES, ORACLE = {}, {}


def tokenizer_file(name: str) -> str:
    """Where the vocabulary file of a public tokenizer lies, on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)



def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(from_parquet(spark, sf_dir, "documents"),
                                   tokenizer_file("byte_bpe_50k.json"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(from_parquet(spark, sf_dir, "documents"),
                        tokenizer_file("word_bpe_49k.json"))


@query
def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(from_parquet(spark, sf_dir, "documents"))


@query
def op4_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.repetition(from_parquet(spark, sf_dir, "documents"))
    return found.select("doc_id", *repetition.COUNTS, "base_failed", "kept")


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(from_parquet(spark, sf_dir, "documents"))


@query
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(from_parquet(spark, sf_dir, "documents"))


ORACLE["op6_substrings"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM s)
  WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM r, (SELECT unnest(range(0, 20)) AS j)),
words AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (
  SELECT words.doc_id, string_agg(x, ' ' ORDER BY words.p) AS t, count(*) AS n
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p
  WHERE gone.p IS NULL GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(from_parquet(spark, sf_dir, "documents"),
                             from_parquet(spark, sf_dir, "labels"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(from_parquet(spark, sf_dir, "documents"))


ORACLE["op8_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, n, cap, w, cap / w AS r, sum(n) OVER () * 1.5::DOUBLE AS total FROM (
    SELECT source, sum(size)::DOUBLE AS n, 2 * sum(size)::DOUBLE AS cap,
      [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
    FROM d GROUP BY source)),
levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY r, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY r, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
    row_number() OVER (ORDER BY r, source) AS k FROM s),
first AS (SELECT min(k) AS k0, min_by(level, k) AS level0 FROM levels WHERE cap > w * level),
t AS (SELECT source, n::BIGINT AS n, CASE WHEN k < coalesce(k0, k + 1) THEN cap ELSE w * level0 END AS target
      FROM levels, first),
p AS (
  SELECT d.*, n, target, floor(target)::BIGINT AS q,
    (sum(size) OVER (PARTITION BY d.source ORDER BY md5('17:' || coalesce(doc_id::VARCHAR, '')), doc_id, size
      ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, n AS source_size, target,
  CASE WHEN n = 0 THEN 0 ELSE (q // n) * size + least(size, greatest(0, q - (q // n) * n - before)) END::BIGINT AS taken
FROM p
"""


@query
def op9_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(from_parquet(spark, sf_dir, "pages"))


_any = lambda words: "|".join(words)

ORACLE["op9_urlfilter"] = rf"""
WITH p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(path, '(?s)(^/.*[.]({_any(urlfilter.ENDINGS)})$)|(/({_any(urlfilter.PARTS)})([/.]|$))')
    OR regexp_matches(host || path, '^([^/]*[.])?({_any(urlfilter.LABELS)})[.]') THEN 'block'
  ELSE 'allow' END AS verdict
FROM r
"""


@query
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(from_parquet(spark, sf_dir, "embeddings"))


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(from_parquet(spark, sf_dir, "documents"),
                               tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


@query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(from_parquet(spark, sf_dir, "documents"),
                                from_parquet(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# The checksum's table is the usual one: eight steps of the reflected polynomial for each byte.
ORACLE["op12_resampling"] = r"""
WITH RECURSIVE steps AS (
  SELECT unnest(range(256))::UBIGINT AS i, unnest(range(256))::UBIGINT AS c, 0 AS k
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM steps WHERE k = 8),
f AS (
  SELECT doc_id, NULL::BIGINT AS item, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT NULL, item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
counted AS (SELECT w, count(*) FILTER (WHERE item IS NULL) AS s, count(*) FILTER (WHERE item IS NOT NULL) AS t
            FROM f GROUP BY w),
bytes AS (SELECT w, s, t, list_prepend(4294967295::UBIGINT, list_transform(range(strlen(w)),
    lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::UBIGINT)) AS b FROM counted),
bucket AS (
  SELECT w, s, t, xor(4294967295::UBIGINT, list_reduce(b, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255)::BIGINT + 1]))) % 10000 AS k
  FROM bytes, crc),
sums AS (SELECT k, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM bucket GROUP BY k),
gain AS (SELECT k, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000)
    / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000))))::BIGINT AS g FROM sums),
per AS (SELECT doc_id, count(*) AS n, sum(g)::BIGINT AS weight
        FROM f JOIN bucket USING (w) JOIN gain USING (k) WHERE item IS NULL GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r,
  count(*) FILTER (WHERE n_features >= 20) OVER () * 10 // 100 AS most FROM scored)
SELECT doc_id, n_features, weight, score::BIGINT AS score,
  CASE WHEN n_features >= 20 AND r <= most THEN r END::BIGINT AS rank FROM ranked
"""


@query
def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(from_parquet(spark, sf_dir, "documents"),
                              tokenizer_file("piece_bpe_32k.model"))
