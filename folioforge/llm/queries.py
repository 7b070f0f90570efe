"""Registered queries of the text operators, and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import (bpe, fingerprints, hard_negatives, html_extract, line_dedup, minhash, mixing, phrases, pu_quality, quality,
                            substring_dedup, suffix_dedup, toxicity)
from folioforge.llm.common import read_table, ready


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return substring_dedup.removed_units(read_table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    done = fingerprints.fingerprint_chain(read_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                       "edited_fingerprint", "near_edited", "near_next")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    done = line_dedup.line_dedup(read_table(spark, sf_dir, "documents"), min_chars=10)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return quality.quality_rules(read_table(spark, sf_dir, "documents"))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    done = suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    done = bpe.decode(bpe.encode(read_table(spark, sf_dir, "documents")))
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return pu_quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_fingerprints": op2_fingerprints,
    "op3_minhash": op3_minhash,
    "op4_line_dedup": op4_line_dedup,
    "op5_suffix_array": op5_suffix_array,
    "op6_mixing": op6_mixing,
    "op7_quality_rules": op7_quality_rules,
    "op8_bpe": op8_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_html_extract": op10_html_extract,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_collocations": op13_collocations,
}

ORACLES = {
    "op1_substring_dedup": r"""
WITH p AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\n]*?[.!?][ \t]|[^\n]*\n|[^\n]+') AS parts FROM documents),
u AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS unit FROM p),
w AS (SELECT doc_id, unit, part, regexp_extract_all(part, '[^ \t\n\x0B\f\r]+') AS words,
    sum(length(part)) OVER (PARTITION BY doc_id ORDER BY unit) AS stop FROM u),
k AS (SELECT doc_id, unit, (stop - length(part))::BIGINT AS start, stop::BIGINT AS stop,
    translate(array_to_string(words, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM w WHERE length(array_to_string(words, ' ')) >= 40),
f AS (SELECT *, first_value(doc_id) OVER o AS first_doc_id, first_value(unit) OVER o AS first_unit
  FROM k WINDOW o AS (PARTITION BY key ORDER BY doc_id, unit))
SELECT doc_id, unit, start, stop AS "end", first_doc_id, first_unit FROM f
WHERE doc_id <> first_doc_id OR unit <> first_unit
""",
    "op4_line_dedup": r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
m AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key),
d AS (SELECT k.doc_id, pos, line, coalesce(k.doc_id > m.keeper, false) AS late FROM k LEFT JOIN m ON k.key = m.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE late) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT late), '')) AS kept_sha256
FROM d GROUP BY doc_id
""",
    "op7_quality_rules": r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS x FROM documents),
w AS (SELECT doc_id, unnest(regexp_extract_all(x, '[^ \t\n\x0B\f\r]+')) AS word,
    generate_subscripts(regexp_extract_all(x, '[^ \t\n\x0B\f\r]+'), 1) AS pos FROM t),
v AS (SELECT doc_id, pos, array_agg(word) OVER (PARTITION BY doc_id ORDER BY pos
    ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS win, lead(pos, 7) OVER (PARTITION BY doc_id ORDER BY pos) AS full8 FROM w),
r AS (SELECT doc_id, pos, full8 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) >= 2 AS twice FROM v),
c AS (SELECT doc_id, max(twice) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS hit FROM r),
n AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE hit) AS n_repeat_words FROM c GROUP BY doc_id),
l AS (SELECT doc_id, source, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key,
    len(regexp_extract_all(line, '[^ \t\n\x0B\f\r]+')) AS words
  FROM (SELECT doc_id, source, unnest(string_split(x, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]')),
f AS (SELECT source, key FROM l GROUP BY source, key HAVING count(DISTINCT doc_id) > 5 AND count(DISTINCT doc_id) >
    0.02 * (SELECT count(*) FROM t WHERE t.source = l.source)),
g AS (SELECT doc_id, sum(words) AS gone FROM l JOIN f USING (source, key) GROUP BY doc_id),
u AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY doc_id),
a AS (SELECT t.doc_id, coalesce(n_words, 0) AS n_words, length(regexp_replace(x, '[ \t\n\x0B\f\r]+', '', 'g')) AS word_chars,
    length(regexp_replace(x, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(gone, 0)::BIGINT AS frequent_words
  FROM t LEFT JOIN n USING (doc_id) LEFT JOIN u USING (doc_id) LEFT JOIN g USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
      AND NOT (frequent_words > 0 AND (n_words - frequent_words < 20 OR n_words - frequent_words < 0.2 * n_words)) AS kept,
    frequent_words
FROM a
""",
    "op11_hard_negatives": r"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
x AS (SELECT r, vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM v),
bad AS (SELECT DISTINCT r FROM x WHERE x IS NULL OR NOT isfinite(x)),
q AS MATERIALIZED (SELECT r, vec_id, label, i, floor(256 * x)::HUGEINT AS c FROM x WHERE r NOT IN (SELECT r FROM bad)),
s AS MATERIALIZED (SELECT a.r AS ar, a.vec_id AS anchor_id, a.label AS al, b.r, b.vec_id, b.label, sum(a.c * b.c)::BIGINT AS score
  FROM q a JOIN q b ON a.i = b.i WHERE a.vec_id % 50 = 0 AND a.r <> b.r GROUP BY ALL),
p AS (SELECT ar, anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = al
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM p JOIN s ON s.ar = p.ar WHERE s.label <> s.al AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
""",
    "op13_collocations": r"""
WITH p AS MATERIALIZED (SELECT row_number() OVER () AS id, lang, piece FROM (SELECT coalesce(lang, 'und') AS lang, unnest(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents)),
u AS (SELECT lang, id, unnest(regexp_extract_all(piece, '[^\x20\x09]+')) AS w,
    generate_subscripts(regexp_extract_all(piece, '[^\x20\x09]+'), 1) AS i FROM p),
s AS MATERIALIZED (SELECT lang, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM u WINDOW o AS (PARTITION BY id ORDER BY i)),
n AS (SELECT lang, count(*) AS n FROM s GROUP BY lang),
g AS (SELECT lang, w AS phrase, count(*) AS f FROM s GROUP BY lang, w
  UNION ALL SELECT lang, w || ' ' || w2, count(*) FROM s WHERE w2 IS NOT NULL GROUP BY lang, w, w2
  UNION ALL SELECT lang, w || ' ' || w2 || ' ' || w3, count(*) FROM s WHERE w3 IS NOT NULL GROUP BY lang, w, w2, w3),
f AS MATERIALIZED (SELECT lang, phrase, lang || chr(10) || phrase AS key, f FROM g WHERE f >= 10),
c AS MATERIALIZED (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS x FROM f WHERE contains(phrase, ' ')),
k AS (SELECT lang, phrase, a, 1 AS k, x[1] AS head, array_to_string(x[2:], ' ') AS tail FROM c
  UNION ALL SELECT lang, phrase, a, 2, x[1] || ' ' || x[2], x[3] FROM c WHERE len(x) = 3),
y AS MATERIALIZED (SELECT k.lang, k.phrase, a, k, f.f AS l, k.lang || chr(10) || tail AS rest
  FROM k JOIN f ON f.key = k.lang || chr(10) || head),
z AS (SELECT y.lang, y.phrase, a, k, l, f.f AS r, ((1000000::HUGEINT * a * a) // (l::HUGEINT * f.f))::BIGINT AS score
  FROM y JOIN f ON f.key = rest),
b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
t AS (SELECT lang || chr(10) || unnest([x[1] || ' ' || x[2], x[2] || ' ' || x[3]]) AS key, a FROM c WHERE len(x) = 3),
m AS (SELECT key, max(a) AS most FROM t GROUP BY key),
d AS (SELECT b.* FROM b LEFT JOIN m ON m.key = b.lang || chr(10) || b.phrase WHERE most IS NULL OR 100 * most < 50 * a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000
""",
}
