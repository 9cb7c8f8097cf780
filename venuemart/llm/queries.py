"""The registered queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from venuemart.llm import exact_dedup as exact
from venuemart.llm import line_dedup as lines
from venuemart.llm import html_cut, lexical, licenses, mixing, personal, pieces, quality, rules, simhash, toxicity, whitening
from venuemart.llm.common import read_table
from venuemart.llm.recipe import graded, held_out, vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query()
def op1_simhash_near_dedup(spark, sf_dir):
    return simhash.simhash_dedup(read_table(spark, sf_dir, "documents"))


@query()
def op2_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(~held_out())
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "score", "predicted", "toxicity", "ordinary", "worst")


@query(r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""")
def op3_exact_dedup(spark, sf_dir):
    """The older half of the ids is the history that the hash is built on."""
    docs = read_table(spark, sf_dir, "documents")
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0] or 0
    return exact.exact_dedup(docs, F.col("doc_id") <= middle)


@query(r"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
common AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN common c ON l.key = c.key GROUP BY doc_id""")
def op4_line_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return lines.drop_lines(docs.select("doc_id", "text")).select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op5_quality_classifier(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, graded(read_table(spark, sf_dir, "labels").where(~held_out())))
    scored = quality.score(docs, model, least=1.0)
    return scored.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "expected_grade", "tail", (F.col("tail") >= 0.5).alias("kept"))


_WORDS = ", ".join(f"'{w}'" for w in rules.COMMON_WORDS)


@query(
    rf"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
  regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS s1 FROM t),
a AS (SELECT *, regexp_replace(s1, '\p{{Ll}}+', '', 'g') AS s2 FROM w),
b AS (SELECT *, regexp_replace(s2, '\p{{Lu}}+', '', 'g') AS s3 FROM a),
c AS (SELECT *, regexp_replace(s3, '\p{{Nd}}+', '', 'g') AS s4 FROM b),
d AS (SELECT *, regexp_replace(s4, '[.,;:!?''"()-]+', '', 'g') AS s5 FROM c),
e AS (SELECT *, regexp_replace(s5, '[#*$%&|<>]+', '', 'g') AS s6 FROM d),
f AS (SELECT doc_id, lang, len(ws) AS n_words, length(s1) AS word_chars, length(s5) - length(s6) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, ws,
  [length(text) - length(s1), length(s1) - length(s2), length(s2) - length(s3), length(s3) - length(s4), length(s4) - length(s5), length(s5) - length(s6), length(s6)] AS classes,
  list_transform([{_WORDS}], lambda k: len(list_filter(ws, lambda x: x = k))) AS common FROM e),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM f)),
h AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g WHERE n > 1) GROUP BY doc_id),
f2 AS (SELECT f.* EXCLUDE common, list_append(common, n_words - list_sum(common)) AS common, coalesce(h.n, 0) AS n_repeat_words FROM f LEFT JOIN h ON f.doc_id = h.doc_id),
r00 AS (SELECT lang, n_words, list_transform(classes, lambda x: floor(x / list_sum(classes) * 1000000)) || list_transform(common, lambda x: floor(x / list_sum(common) * 1000000)) AS vs
  FROM f2 WHERE n_words >= {rules.LEAST_WORDS} AND 100 * n_repeat_words <= 50 * n_words),
r0 AS (SELECT lang, unnest(vs) AS v, generate_subscripts(vs, 1) AS i FROM r00),
r1 AS (SELECT lang, i, sum(v) AS v FROM r0 GROUP BY lang, i),
pool AS (SELECT i, {rules.POOLED}::DOUBLE * sum(v)::DOUBLE / (SELECT count(*) FROM r00) AS rest FROM r1 GROUP BY i),
r AS (SELECT lang, list(v::DOUBLE + rest ORDER BY i) AS v FROM r1 JOIN pool USING (i) GROUP BY lang),
m AS (SELECT f2.*, list_transform(classes, lambda x: x / list_sum(classes)) AS p1, list_transform(common, lambda x: x / list_sum(common)) AS p2,
  list_transform(r.v[1:7], lambda x: x / list_sum(r.v[1:7])) AS q1, list_transform(r.v[8:], lambda x: x / list_sum(r.v[8:])) AS q2
  FROM f2 LEFT JOIN r ON f2.lang IS NOT DISTINCT FROM r.lang),
s AS (SELECT *, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  sqrt(greatest(0, list_sum(list_transform(range(1, 8), lambda i: (CASE WHEN p1[i] > 0 THEN p1[i] * log2(2 * p1[i] / (p1[i] + q1[i])) ELSE 0 END + CASE WHEN q1[i] > 0 THEN q1[i] * log2(2 * q1[i] / (p1[i] + q1[i])) ELSE 0 END) / 2)))) AS d1,
  sqrt(greatest(0, list_sum(list_transform(range(1, {len(rules.COMMON_WORDS) + 2}), lambda i: (CASE WHEN p2[i] > 0 THEN p2[i] * log2(2 * p2[i] / (p2[i] + q2[i])) ELSE 0 END + CASE WHEN q2[i] > 0 THEN q2[i] * log2(2 * q2[i] / (p2[i] + q2[i])) ELSE 0 END) / 2)))) AS d2 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (q1 IS NULL OR d1 < {rules.CLASSES_APART}) AND (n_words < {rules.WORDS_FOR_COMMON} OR q1 IS NULL OR d2 < {rules.COMMON_APART}) AS kept
FROM s"""
)
def op6_quality_rules(spark, sf_dir):
    out = rules.quality_rules(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op7_sentencepiece(spark, sf_dir):
    return pieces.encode_and_decode(read_table(spark, sf_dir, "documents"), vocabulary())


@query()
def op8_license_scan(spark, sf_dir):
    out = licenses.license_scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", F.size("matches").cast("bigint").alias("n_matches"), "matches")


@query()
def op9_source_mixing(spark, sf_dir):
    return mixing.mix_sizes(read_table(spark, sf_dir, "documents"))


@query()
def op10_html_extraction(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_cut.extract(pages).select("row.page_id", "row.url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query()
def op11_personal_data(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal.find(docs, personal.fit(docs))
    return found.select("row.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')"


@query(
    rf"""
WITH t AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM t WHERE len(ts) > 0),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM t) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
m AS (SELECT doc_id, 50 + (50 * len(ts) * n_docs) // n_terms AS m FROM t, s WHERE len(ts) > 0),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= {lexical.BEST}"""
)
def op12_ranked_search(spark, sf_dir):
    return lexical.ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query()
def op13_embedding_whitening(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
