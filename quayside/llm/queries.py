"""The operators' queries, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.llm import (bin_slack, bpe, compress_quality, exact_dedup, jaccard_join,
                          license_scan, multi_index, page_text, quality_rules, suffix_dedup,
                          text_tries, url_filter, whitening)
from quayside.llm.frames import table

#: The public vocabulary's file; its path is a parameter of the operators.
VOCABULARY = "byte_bpe_50k.json"
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block"))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def held_out(doc_id):
    return F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 3 == 1


def fold_model(spark, sf_dir: str) -> compress_quality.Model:
    """The quality model, of labels outside the held-out third."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return compress_quality.fit(table(spark, sf_dir, "documents"), labels)


def op1_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = compress_quality.score_documents(docs, fold_model(spark, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op2_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op3_nearest_neighbours(spark, sf_dir):
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_best_fit_packing(spark, sf_dir):
    return bin_slack.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_html_extraction(spark, sf_dir):
    found = page_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_ngram_jaccard_join(spark, sf_dir):
    return jaccard_join.components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op7_suffix_dedup(spark, sf_dir):
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return found.select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
        .alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op8_bpe_automaton(spark, sf_dir):
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary_path())
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


def op9_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judge(docs, quality_rules.fit(docs))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "posterior")


def op10_license_scans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word",
                                          "base_labels", "labels", "score")


def op11_filter_audit(spark, sf_dir):
    counts = text_tries.masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return text_tries.audit(counts)


def op12_embedding_whitening(spark, sf_dir):
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_exact_dedup(spark, sf_dir):
    found = exact_dedup.deduplicate(exact_dedup.halves(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_url_filters, op3_nearest_neighbours, op4_best_fit_packing,
    op5_html_extraction, op6_ngram_jaccard_join, op7_suffix_dedup, op8_bpe_automaton,
    op9_quality_rules, op10_license_scans, op11_filter_audit, op12_embedding_whitening,
    op13_exact_dedup, pipeline)}

_URL_ORACLE = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
         THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS h,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
urls AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         path FROM parts),
rules(rh, rp, verdict) AS (VALUES %s),
fits AS (
  SELECT host, path, rh || rp AS rule, verdict,
         row_number() OVER (PARTITION BY host, path ORDER BY length(rh) DESC, length(rp) DESC) AS k
  FROM (SELECT DISTINCT host, path FROM urls) u JOIN rules r
    ON (u.host = r.rh OR ends_with(u.host, '.' || r.rh)) AND starts_with(u.path, r.rp))
SELECT u.page_id, u.host, u.path, f.rule AS rule, coalesce(f.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN fits f ON u.host = f.host AND u.path = f.path AND f.k = 1
""" % ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

_SHINGLE_ORACLE = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1),
              lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM members a JOIN members b
    ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least_id AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.c AS component_id
FROM sets s JOIN least_id l ON s.doc_id = l.a
"""

_REPEAT_ORACLE = """
WITH bytes AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h,
         octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS w FROM bytes, unnest(range(0, n - 49)) t(p)
  WHERE n >= 50),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
repeated AS (SELECT x.doc_id, x.p FROM windows x JOIN firsts f ON x.w = f.w AND f.first < x.doc_id),
gaps AS (
  SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM repeated),
runs AS (
  SELECT doc_id, p, sum(CASE WHEN gap IS NULL OR gap > 50 THEN 1 ELSE 0 END)
         OVER (PARTITION BY doc_id ORDER BY p) AS run FROM gaps),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY doc_id, run),
edges AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before
  FROM spans),
kept AS (
  SELECT e.doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM edges e JOIN bytes USING (doc_id) GROUP BY e.doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (doc_id)
"""

_AUDIT_ORACLE = """
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM texts),
marks AS (SELECT doc_id, max(coalesce(quality, 0) = 1) AS good, max(coalesce(toxic, 0) = 1) AS bad
          FROM labels GROUP BY doc_id),
facts AS (
  SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
          100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t),
          regexp_matches(t, '[#$%&*|]'),
          coalesce(min(w_.doc_id) OVER (PARTITION BY t) < w_.doc_id, false)] AS fails
  FROM words w_ LEFT JOIN marks m ON w_.doc_id = m.doc_id),
counts AS (SELECT part, good, bad, fails, count(*) AS n FROM facts GROUP BY ALL),
f(i) AS (VALUES (1), (2), (3), (4), (5)),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (
  SELECT array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') AS filter_order,
         o[s] AS f, s AS step, o[1:s - 1] AS before FROM orders, range(1, 6) r(s)),
marked AS (
  SELECT part, filter_order, step, f, n, good, bad, fails[f] AS failing,
         len(list_filter(before, lambda i: fails[i])) > 0 AS gone,
         len(list_filter(fails, lambda x: x)) = 1 AS single
  FROM counts, steps),
summed AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT failing AND NOT gone THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failing AND single THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN failing AND NOT gone AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN failing AND NOT gone AND bad THEN n ELSE 0 END) AS toxic_lost
  FROM marked GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM summed
"""

_EXACT_ORACLE = """
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""

ORACLES = {"op2_url_filters": _URL_ORACLE, "op6_ngram_jaccard_join": _SHINGLE_ORACLE,
           "op7_suffix_dedup": _REPEAT_ORACLE, "op11_filter_audit": _AUDIT_ORACLE,
           "op13_exact_dedup": _EXACT_ORACLE}
