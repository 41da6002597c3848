"""Queries of this package and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.llm import canonical, frequency, leakage, mixing, pii
from citelake.operators.shred import flat_table
from citelake.plans.tables import table
from citelake.session import materialise

FIELDS = ["publisher", "container_title", "first_subject_area"]


def _spelled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    summaries, citations = table(spark, d, "crossref_works_summaries"), table(spark, d, "crossref_works_citations")
    return canonical.canonical_spellings([canonical.Records(summaries, "doi", "row_id"), canonical.Records(citations, "cited_doi", "row_id")])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.spelling_pairs(*_spelled(spark, d))


def p4_dois(spark: SparkSession, d: str) -> DataFrame:
    _, found = _spelled(spark, d)
    return found.withColumnRenamed("key", "doi_key")


def _frequencies(spark: SparkSession, d: str) -> DataFrame:
    return frequency.frequencies(table(spark, d, "crossref_works_summaries"), FIELDS, "row_id")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return frequency.marked(_frequencies(spark, d))


def p5_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return _frequencies(spark, d)


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).where("edits = 0").select("doc_id", "item_id")


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d)


def p8_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    exact = F.col("edits") == 0
    return _leaks(spark, d).groupBy("item_id").agg(F.count_if(exact).alias("n_documents"), F.count_if(~exact).alias("n_near"), F.max("windows").alias("most_windows"))


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sized = materialise(mixing.sized_documents(table(spark, d, "documents")), "sized")
    return mixing.mix(sized, table(spark, d, "mix_targets"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


def _names(spark: SparkSession, d: str) -> DataFrame:
    return pii.name_table(flat_table(table(spark, d, "works_pages"), "author"), "given", "family")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_mentions(table(spark, d, "documents"), _names(spark, d)).select("doc_id", "kind", "start_char")


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redact_documents(table(spark, d, "documents"), _names(spark, d))


QUERIES = {
    "p4_found": p4_found,
    "p4_dois": p4_dois,
    "p5_found": p5_found,
    "p5_frequencies": p5_frequencies,
    "p8_found": p8_found,
    "p8_leaks": p8_leaks,
    "p8_leaked_items": p8_leaked_items,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_redacted": p10_redacted,
}

_SPELLED = r"""
WITH records AS (
  SELECT doi AS s, 0 AS source, row_id FROM crossref_works_summaries WHERE doi IS NOT NULL
  UNION ALL SELECT cited_doi, 1, row_id FROM crossref_works_citations WHERE cited_doi IS NOT NULL),
spelled AS (
  SELECT s, regexp_replace(lower(s), '[^\p{L}\p{N}]+', '', 'g') AS k, count(*) AS n, min((source, row_id)) AS first
  FROM records GROUP BY s)
"""
_ITEMS = (
    r"WITH cells AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS field, row_id, {c} AS v FROM crossref_works_summaries WHERE {c} IS NOT NULL" for c in FIELDS)
    + r"""), items AS (
  SELECT field, 'value' AS unit, row_id, v AS item FROM cells
  UNION ALL SELECT field, 'term', row_id, unnest(regexp_extract_all(lower(v), '[\p{L}\p{N}]+')) FROM cells),
filled AS (SELECT field, count(*) AS filled FROM cells GROUP BY field),
counted AS (
  SELECT field, unit, item, count(*) AS occurrences, count(DISTINCT row_id) AS n_rows FROM items GROUP BY ALL),
judged AS (
  SELECT field, unit, item, occurrences, n_rows, n_rows <= 2 AS is_rare, n_rows > 0.05 * filled AS is_common
  FROM counted JOIN filled USING (field))
"""
)
_WINDOWS = r"""
WITH words AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE text IS NOT NULL),
runs AS (
  SELECT DISTINCT item_id, ' ' || array_to_string(w[i:i + 11], ' ') || ' ' AS run
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS i FROM words WHERE len(w) >= 12)),
docs AS (
  SELECT doc_id, unnest(range(1, greatest(len(w) - 10, 1))) AS i, w
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL)
  WHERE len(w) >= 12),
held AS (SELECT DISTINCT doc_id, ' ' || array_to_string(w[i:i + 11], ' ') || ' ' AS run FROM docs)
SELECT DISTINCT doc_id, item_id FROM held JOIN runs USING (run)
"""
ORACLES = {
    "p4_found": _SPELLED + "SELECT a.s AS doi_a, b.s AS doi_b FROM spelled a JOIN spelled b ON a.k = b.k AND a.s < b.s WHERE a.k <> ''",
    "p4_dois": _SPELLED
    + """SELECT k AS doi_key, arg_min(s, first) AS representative, min(first)[1]::INT AS source, min(first)[2] AS identifier,
    sum(n)::BIGINT AS n_copies, count(*) AS n_spellings FROM spelled WHERE k <> '' GROUP BY k""",
    "p5_found": _ITEMS + "SELECT field, unit, item, 'rare' AS mark FROM judged WHERE is_rare UNION ALL SELECT field, unit, item, 'common' FROM judged WHERE is_common",
    "p5_frequencies": _ITEMS + "SELECT * FROM judged",
    "p8_found": _WINDOWS,
}
