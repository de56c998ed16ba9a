"""Registered queries of the corpus operators and, where SQL can express one, its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.llm import fingerprint, jaccard, langid, license_scan, line_dedup, mixing, packing, periodic, quality, search, secrets, token_count, toxicity
from gaugeflow.session import tune

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark = tune(spark)
            return fn(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

# Water level in closed form: sources in order of size / weight are full until the level lies below the next one's cap.
SQL_MIX = f"""
WITH sized AS (
  SELECT doc_id, source, CAST({WORDS} AS BIGINT) AS size, md5(concat('{mixing.SEED}:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS o
  FROM documents
), totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source),
weighted AS (
  SELECT source, s, [5, 2, 1][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)] AS w FROM totals
), steps AS (
  SELECT *, sum(s) OVER () AS total,
    coalesce(sum(s) OVER (ORDER BY s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS full_s,
    coalesce(sum(w) OVER (ORDER BY s / w, source NULLS LAST ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS open_w,
    row_number() OVER (ORDER BY s / w, source NULLS LAST) AS k
  FROM weighted
), capped AS (
  SELECT *, lag(3 * total - 4 * full_s, 1, 3 * total) OVER (ORDER BY k) AS num, open_w + w AS den FROM steps
), level AS (SELECT min(k) AS k FROM capped WHERE NOT w * num > 4 * den * s),
goal AS (
  SELECT c.source, c.s, CASE WHEN c.k < l.k THEN 2.0::DOUBLE * c.s
    ELSE CAST(c.w AS DOUBLE) * CAST(b.num AS DOUBLE) / CAST(2 * b.den AS DOUBLE) END AS target
  FROM capped c, level l, capped b WHERE b.k = l.k
), part AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS t,
    CASE WHEN s > 0 THEN CAST(floor(floor(target + 0.5) / s) AS BIGINT) ELSE 0 END AS n FROM goal
)
SELECT d.doc_id, d.source, d.size, p.s AS source_size, p.target,
  CAST(p.n * d.size + greatest(0, least(d.size, p.t - p.n * p.s - coalesce(sum(d.size) OVER (
    PARTITION BY d.source ORDER BY o, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS taken
FROM sized d JOIN part p ON d.source IS NOT DISTINCT FROM p.source
"""

SQL_LINES = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), trimmed AS (
  SELECT *, regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS t FROM lines
), wide AS (
  SELECT t FROM trimmed WHERE t <> '' GROUP BY t HAVING count(DISTINCT coalesce(source, chr(0))) >= {line_dedup.MIN_SITES}
), firsts AS (SELECT t, min((doc_id, pos)) AS first FROM trimmed WHERE t IN (FROM wide) GROUP BY t),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (f.t IS NULL OR (l.doc_id, l.pos) = f.first) AS text,
    count(*) FILTER (f.t IS NOT NULL AND (l.doc_id, l.pos) <> f.first) AS removed
  FROM trimmed l LEFT JOIN firsts f ON l.t = f.t GROUP BY l.doc_id
)
SELECT d.doc_id, d.lang, d.source, length(coalesce(k.text, '')) AS n_chars, CAST(k.removed AS BIGINT) AS n_removed,
  md5(coalesce(k.text, '')) AS text_md5
FROM documents d JOIN kept k ON d.doc_id = k.doc_id
"""

TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL_SEARCH = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {TERMS} AS t FROM documents WHERE text IS NOT NULL
), totals AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM docs WHERE len(t) > 0),
asked AS (SELECT DISTINCT item_id, text, unnest({TERMS}) AS term FROM benchmark),
found AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM found, totals GROUP BY term, n_docs
), scored AS (
  SELECT item_id, text, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN found USING (term) JOIN weights USING (term), totals GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@query("op1_toxicity")
def _toxicity(spark, docs, sf_dir):
    return toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op2_license_scan")
def _licenses(spark, docs, sf_dir):
    return license_scan.scan(docs)


@query("op3_quality_rules")
def _quality(spark, docs, sf_dir):
    return quality.quality(docs)


@query("op4_language_id")
def _language(spark, docs, sf_dir):
    return langid.identify(docs)


@query("op5_source_mixing", SQL_MIX)
def _mixing(spark, docs, sf_dir):
    return mixing.mix(docs).drop("text_key")


@query("op6_packing")
def _packing(spark, docs, sf_dir):
    return packing.pack(docs, packing.default_tokenizer())


@query("op7_line_dedup", SQL_LINES)
def _lines(spark, docs, sf_dir):
    return line_dedup.dedup_lines(docs).selectExpr(
        "doc_id", "lang", "source", "CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars", "CAST(_removed AS BIGINT) AS n_removed",
        "md5(coalesce(text, '')) AS text_md5",
    )


@query("op8_secret_scan")
def _secrets(spark, docs, sf_dir):
    return secrets.scan(docs)


@query("op9_ngram_jaccard")
def _jaccard(spark, docs, sf_dir):
    return jaccard.components(docs)


@query("op10_fingerprints")
def _fingerprints(spark, docs, sf_dir):
    return fingerprint.compare_edits(docs)


@query("op11_token_counts")
def _token_counts(spark, docs, sf_dir):
    return token_count.count_tokens(docs, token_count.default_tokenizer())


@query("op12_periodic_runs")
def _periodic(spark, docs, sf_dir):
    return periodic.digest(periodic.scan(docs, periodic.planted))


@query("op13_ranked_search", SQL_SEARCH)
def _search(spark, docs, sf_dir):
    return search.search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
