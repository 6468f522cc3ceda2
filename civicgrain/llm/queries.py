"""Registered queries of the text operators and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicgrain.llm.components import group_records
from civicgrain.llm.entity_match import match_bodies
from civicgrain.llm.leaks import find_leaks
from civicgrain.llm.mixing import mix_sources, tokenizer
from civicgrain.llm.name_variants import spelling_pairs
from civicgrain.llm.near_duplicates import near_duplicate_pairs
from civicgrain.llm.personal_information import find_personal_information, redact
from civicgrain.llm.repeated_lines import recurring_lines, without_recurring_lines
from civicgrain.llm.scan_noise import read_pages
from civicgrain.sources.tables import table, texts


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return read_pages(texts(spark, folder), repair=False).select("doc_id", F.inline("noise")).distinct()


def p1_repaired(spark: SparkSession, folder: str) -> DataFrame:
    return read_pages(texts(spark, folder)).select("doc_id", "text")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_pairs(texts(spark, folder), width=3, threshold=0.7, expand=None)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_pairs(table(spark, folder, "signals"), table(spark, folder, "documents"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return group_records(table(spark, folder, "signal_matches"), table(spark, folder, "signals"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return match_bodies(table(spark, folder, "bodies"), table(spark, folder, "registry_units")).select("body_id", "unit_id").distinct()


def p6_confidence(spark: SparkSession, folder: str) -> DataFrame:
    return match_bodies(table(spark, folder, "bodies"), table(spark, folder, "registry_units"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return recurring_lines(texts(spark, folder))


def p7_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return without_recurring_lines(texts(spark, folder))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    found = find_leaks(texts(spark, folder), table(spark, folder, "eval_items"))
    return found.where("exact_words >= 12").select("doc_id", "item_id").distinct()


def p8_near(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of twelve words with at most one of them replaced, added or left out."""
    return find_leaks(texts(spark, folder), table(spark, folder, "eval_items")).select("doc_id", "item_id", "distance")


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(texts(spark, folder), table(spark, folder, "mix_targets"), tokenizer())[0]


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(texts(spark, folder), table(spark, folder, "mix_targets"), tokenizer())[1]


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_information(texts(spark, folder)).select("doc_id", "pii_kind", "found").distinct()


def p10_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return redact(texts(spark, folder))


QUERIES = {
    query.__name__: query
    for query in (p1_found, p1_repaired, p2_found, p4_found, p5_found, p6_found, p6_confidence, p7_found, p7_cleaned, p8_found, p8_near, p9_mix, p9_report, p10_found, p10_redacted)
}

_LINES = r"""
WITH lines AS (
  SELECT doc_id, body_id, u.i - 1 AS line_no, u.line AS line FROM (
    SELECT doc_id, body_id, unnest(list_zip(string_split(text, chr(10)), range(1, len(string_split(text, chr(10))) + 1))) AS p FROM documents WHERE text IS NOT NULL AND body_id IS NOT NULL
  ), LATERAL (SELECT p[1] AS line, p[2] AS i) u
), keyed AS (
  SELECT doc_id, body_id, line_no, lower(regexp_replace(line, '[^\p{L}]+', '', 'g')) AS k FROM lines WHERE length(regexp_replace(line, '^\s+|\s+$', '', 'g')) >= 25
), docs AS (SELECT body_id, count(*) AS d FROM documents WHERE text IS NOT NULL GROUP BY body_id),
common AS (
  SELECT body_id, k FROM keyed JOIN docs USING (body_id) GROUP BY body_id, k, d HAVING count(DISTINCT doc_id) >= 6 AND count(DISTINCT doc_id) * 100 >= d * 15
), hit AS (SELECT DISTINCT doc_id, line_no FROM keyed JOIN common USING (body_id, k))
"""

_WORDS = r"SELECT {id}, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM {table} WHERE text IS NOT NULL AND {id} IS NOT NULL"
# six words of an item stand in a text unchanged; what comes before and after them may differ in one word
_NEAR = rf"""WITH i AS ({_WORDS.format(id='item_id', table='eval_items')}), d AS ({_WORDS.format(id='doc_id', table='documents')}),
ip AS (SELECT item_id, w, unnest(range(1, len(w) - 4)) AS pos FROM i WHERE len(w) >= 12), dp AS (SELECT doc_id, w, unnest(range(1, len(w) - 4)) AS pos FROM d WHERE len(w) >= 6),
ik AS (SELECT item_id, pos, list_aggregate(w[pos : pos + 5], 'string_agg', ' ') AS k FROM ip), dk AS (SELECT doc_id, pos, list_aggregate(w[pos : pos + 5], 'string_agg', ' ') AS k FROM dp),
h AS (SELECT DISTINCT doc_id, item_id, ik.pos AS ia, dk.pos AS da FROM ik JOIN dk USING (k)),
t AS (SELECT doc_id, item_id, i.w AS iw, d.w AS dw, ia, da FROM h JOIN i USING (item_id) JOIN d USING (doc_id)),
-- a piece is the first or the second half of a passage; the other half of it, six words, has at most one error
half AS (SELECT doc_id, item_id, iw[ia + 6 : ia + 11] AS a, dw[da + 6 : da + 12] AS b FROM t WHERE ia + 11 <= len(iw)
UNION ALL SELECT doc_id, item_id, list_reverse(iw[ia - 6 : ia - 1]), list_reverse(dw[greatest(da - 7, 1) : da - 1]) FROM t WHERE ia > 6),
same AS (SELECT *, list_aggregate(list_filter(range(0, 7), lambda k: a[1 : k] IS NOT DISTINCT FROM b[1 : k]), 'max') AS k FROM half),
said AS (SELECT doc_id, item_id, CASE WHEN k = 6 THEN 0 WHEN a[k + 2 : 6] = b[k + 2 : 6] OR a[k + 2 : 6] = b[k + 1 : 5] OR a[k + 1 : 6] = b[k + 2 : 7] THEN 1 END AS distance FROM same)
SELECT doc_id, item_id, CAST(min(distance) AS INTEGER) AS distance FROM said WHERE distance IS NOT NULL GROUP BY doc_id, item_id"""

ORACLE: dict[str, str] = {
    "p2_found": rf"""WITH w AS ({_WORDS.format(id='doc_id', table='documents')}),
g AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM w), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id)
SELECT x.doc_id AS doc_a, y.doc_id AS doc_b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2) p
JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE shared >= 0.7 * (x.n + y.n - shared)""",
    "p8_found": rf"""WITH i AS ({_WORDS.format(id='item_id', table='eval_items')}), d AS ({_WORDS.format(id='doc_id', table='documents')}),
ik AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 10), lambda k: list_aggregate(w[k : k + 11], 'string_agg', ' '))) AS k FROM i),
dk AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda k: list_aggregate(w[k : k + 11], 'string_agg', ' '))) AS k FROM d)
SELECT DISTINCT doc_id, item_id FROM ik JOIN dk USING (k)""",
    "p8_near": _NEAR,
    "p5_found": """
WITH RECURSIVE latest AS (
  SELECT least(left_id, right_id) AS a, greatest(left_id, right_id) AS b, score,
    row_number() OVER (PARTITION BY least(left_id, right_id), greatest(left_id, right_id) ORDER BY matched_at DESC NULLS LAST, match_id DESC) AS n
  FROM signal_matches WHERE left_id <> right_id
), good AS (
  SELECT a, b FROM latest WHERE n = 1 AND score >= 0.5 AND a IN (SELECT signal_id FROM signals) AND b IN (SELECT signal_id FROM signals)
), e AS (SELECT a, b FROM good UNION SELECT b, a FROM good),
r(v, g) AS (SELECT a, a FROM e UNION SELECT e.b, r.g FROM r JOIN e ON r.v = e.a WHERE r.g < e.b)
SELECT v AS signal_id, min(g) AS group_id FROM r GROUP BY v""",
    "p7_found": _LINES + "SELECT doc_id, CAST(line_no AS INTEGER) AS line_no FROM hit",
    "p7_cleaned": _LINES
    + """, kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM lines ANTI JOIN hit USING (doc_id, line_no) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL WHEN d.body_id IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text FROM documents d LEFT JOIN kept k USING (doc_id)""",
}
