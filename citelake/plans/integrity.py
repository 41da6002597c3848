"""Queries over delivered records: orphans, redeliveries, nested pages, load profiles and heavy keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.operators import delivery, orphans, quality, shred, tree
from citelake.functions.keys import doi_key, present
from citelake.plans.tables import table

PROFILED = ["reference_count", "num_references", "author_count"]
HEAVY_SHARE = 0.01


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphans.find_orphans(
        table(spark, d, "crossref_works_citations"),
        id_col="row_id",
        key_cols=["citing_doi", "cited_doi"],
        time_col="received_at",
        parents=[orphans.Keys(table(spark, d, "crossref_works_summaries"), "doi", "received_at"), orphans.Keys(table(spark, d, "registered_works"), "doi")],
        withdrawn=[orphans.Keys(table(spark, d, "works_withdrawn"), "doi", "withdrawn_at")],
    )


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select(F.col("id").alias("row_id"), "field")


def p1_orphan_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(_orphans(spark, d), "crossref_works_citations")


def _deliveries(spark: SparkSession, d: str, columns: list[str]) -> tuple[DataFrame, delivery.DeliveryStore]:
    rows = table(spark, d, "crossref_works_summaries")
    named = rows.where(present(doi_key(F.col("doi"))))
    return named, delivery.merge_batches(named, identifier="doi", order=["received_at", "row_id"], columns=columns, batch="load_no")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    named, store = _deliveries(spark, d, [])
    return delivery.superseded(named, store.read(), "row_id")


def p2_kept(spark: SparkSession, d: str) -> DataFrame:
    _, store = _deliveries(spark, d, ["title", "publisher", "type", "provenance", "load_no"])
    return store.read().select("row_id", "doi", "title", "publisher", "type", "provenance", "load_no")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return shred.child_places(table(spark, d, "works_pages"))


def _flat(kind: str):
    return lambda spark, d: shred.flat_table(table(spark, d, "works_pages"), kind)


def _profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.profile_loads(table(spark, d, "crossref_works_summaries"), load="load_no", columns=PROFILED)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.unusual_loads(_profile(spark, d)).withColumnRenamed("load", "load_no")


#: What a well-formed value of these columns looks like.
PATTERNS = {"doi": r"^10\.[0-9]{4,9}/[^ \t\r\n]+\z", "created": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z\z", "type": r"^[a-z]+(-[a-z]+)*\z"}


#: Every column of the summaries but the load itself.
NUMBERS = [*PROFILED, "row_id", "referenced_by_count", "has_references", "num_citations_without_doi", "num_duplicate_citation_dois"]
TEXTS = ["doi", "title", "created", "type", "publisher", "container_title", "first_subject_area", "subject_areas", "cited_dois", "provenance"]


def p6_profile(spark: SparkSession, d: str) -> DataFrame:
    p = quality.profile_loads(table(spark, d, "crossref_works_summaries"), load="load_no", columns=[*NUMBERS, *TEXTS, "received_at"], patterns=PATTERNS)
    whole = [F.col(c).cast("bigint").alias(c) for c in ("n_rows", "n_null", "n_distinct", "n_outside", "n_broken", "n_valid", "lowest", "highest", "s1", "s2")]
    return p.select(F.col("load").alias("load_no"), "column_name", "overall", *whole)


def p6_shifts(spark: SparkSession, d: str) -> DataFrame:
    return quality.shifts(_profile(spark, d)).withColumnRenamed("load", "load_no")


def _publishers(spark: SparkSession, d: str) -> DataFrame:
    return tree.tree_aggregate(
        table(spark, d, "crossref_works_summaries"),
        {"publisher": F.col("publisher")},
        {
            "n_rows": tree.counting(),
            "n_with_references": tree.summing(F.col("has_references")),
            "sum_reference_count": tree.summing(F.col("reference_count")),
            "max_referenced_by": tree.highest(F.col("referenced_by_count")),
            "first_received": tree.lowest(F.col("received_at")),
        },
    )


def _cited(spark: SparkSession, d: str) -> DataFrame:
    return tree.tree_aggregate(
        table(spark, d, "crossref_works_citations"),
        {"cited_doi": F.col("cited_doi")},
        {"n_rows": tree.counting(), "first_received": tree.lowest(F.col("received_at")), "last_received": tree.highest(F.col("received_at"))},
    )


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    out = []
    for field, name, totals in (("publisher", "crossref_works_summaries", _publishers), ("cited_doi", "crossref_works_citations", _cited)):
        heavy = tree.heavy_keys(totals(spark, d).where(F.col(field).isNotNull()), "n_rows", table(spark, d, name).count(), HEAVY_SHARE)
        out.append(heavy.select(F.lit(field).alias("field"), F.col(field).alias("key_value")))
    return out[0].unionByName(out[1])


def p7_publishers(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "crossref_works_summaries").count()
    return _publishers(spark, d).withColumn("heavy", F.col("publisher").isNotNull() & (F.col("n_rows") > HEAVY_SHARE * rows))


def p7_cited(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "crossref_works_citations").count()
    return _cited(spark, d).withColumn("heavy", F.col("cited_doi").isNotNull() & (F.col("n_rows") > HEAVY_SHARE * rows))


QUERIES = {
    "p1_found": p1_found,
    "p1_orphan_report": p1_orphan_report,
    "p2_found": p2_found,
    "p2_kept": p2_kept,
    "p3_found": p3_found,
    "p3_works": _flat("work"),
    "p3_authors": _flat("author"),
    "p3_affiliations": _flat("affiliation"),
    "p3_subjects": _flat("subject"),
    "p3_references": _flat("reference"),
    "p6_found": p6_found,
    "p6_profile": p6_profile,
    "p6_shifts": p6_shifts,
    "p7_found": p7_found,
    "p7_publishers": p7_publishers,
    "p7_cited": p7_cited,
}

_KEY = r"regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}]+', '', 'g')"
_ORPHANS = f"""
WITH seen AS (SELECT {_KEY.format(c="doi")} AS k, min(received_at) AS t FROM crossref_works_summaries GROUP BY 1),
reg AS (SELECT DISTINCT {_KEY.format(c="doi")} AS k FROM registered_works WHERE doi IS NOT NULL),
gone AS (SELECT {_KEY.format(c="doi")} AS k, min(withdrawn_at) AS t FROM works_withdrawn GROUP BY 1),
refs AS (
  SELECT row_id, 'citing_doi' AS field, {_KEY.format(c="citing_doi")} AS k, received_at FROM crossref_works_citations
  UNION ALL SELECT row_id, 'cited_doi', {_KEY.format(c="cited_doi")}, received_at FROM crossref_works_citations),
judged AS (
  SELECT refs.*, coalesce(gone.t <= refs.received_at, false) AS withdrawn, seen.t AS known_at,
    reg.k IS NULL AND coalesce(seen.t > refs.received_at, true) AS missing
  FROM refs LEFT JOIN seen USING (k) LEFT JOIN reg USING (k) LEFT JOIN gone USING (k) WHERE refs.k <> '')
"""  # fmt: skip
_LOSERS = r"""
WITH named AS (SELECT * FROM crossref_works_summaries WHERE regexp_matches(doi, '[\p{L}\p{N}]')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY received_at NULLS LAST, row_id NULLS LAST) AS place FROM named)
"""
_NUMBERS = """
WITH cells AS (
  SELECT load_no, 'reference_count' AS column_name, reference_count::BIGINT AS v FROM crossref_works_summaries
  UNION ALL SELECT load_no, 'num_references', num_references FROM crossref_works_summaries
  UNION ALL SELECT load_no, 'author_count', author_count FROM crossref_works_summaries),
loads AS (
  SELECT load_no, column_name, count(*) AS n, count(*) - count(v) AS nulls, count(DISTINCT v) AS d,
    count(*) FILTER (WHERE v < 0 OR v > 10000) AS outside,
    avg(v) FILTER (WHERE v BETWEEN 0 AND 10000) AS mean FROM cells GROUP BY ALL),
cols AS (
  SELECT column_name, count(*) AS n, count(*) - count(v) AS nulls, avg(v) FILTER (WHERE v BETWEEN 0 AND 10000) AS mean
  FROM cells GROUP BY ALL)
"""


def _profile_sql() -> str:
    cells = [f"SELECT load_no, '{c}' AS column_name, {c}::VARCHAR AS v, {c}::BIGINT AS x, true AS ok FROM crossref_works_summaries" for c in NUMBERS]
    for c in (*TEXTS, "received_at"):
        ok = f"regexp_matches({c}, '{PATTERNS[c]}')" if c in PATTERNS else "true"
        number = "NULL" if c == "received_at" else f"CASE WHEN regexp_full_match({c}, '[+-]?[0-9]{{1,37}}([.]0*)?') THEN TRY_CAST({c} AS BIGINT) END"
        cells.append(f"SELECT load_no, '{c}', {c}::VARCHAR, {number}, {ok} FROM crossref_works_summaries")
    stats = """count(*) AS n_rows, count(*) - count(v) AS n_null, count(DISTINCT v) AS n_distinct,
      count(*) FILTER (WHERE x < 0 OR x > 10000) AS n_outside, count(*) FILTER (WHERE v IS NOT NULL AND NOT ok) AS n_broken,
      count(*) FILTER (WHERE x BETWEEN 0 AND 10000) AS n_valid, min(x) FILTER (WHERE x BETWEEN 0 AND 10000) AS lowest,
      max(x) FILTER (WHERE x BETWEEN 0 AND 10000) AS highest,
      coalesce(sum(x) FILTER (WHERE x BETWEEN 0 AND 10000), 0)::BIGINT AS s1,
      coalesce(sum(x * x) FILTER (WHERE x BETWEEN 0 AND 10000), 0)::BIGINT AS s2"""
    return f"""WITH cells AS ({" UNION ALL ".join(cells)})
    SELECT load_no, column_name, false AS overall, {stats} FROM cells GROUP BY load_no, column_name
    UNION ALL SELECT NULL, column_name, true, {stats} FROM cells GROUP BY column_name"""


def listed(raw: str, text_is_json: bool = False) -> str:
    """SQL for the elements of `raw` as a JSON array: an array, one element in its place, or what JSON text holds."""
    if text_is_json:
        raw = f"(CASE WHEN json_type({raw}) = 'VARCHAR' THEN CASE WHEN json_valid({raw} ->> '$') THEN ({raw} ->> '$')::JSON END ELSE {raw} END)"
    return f"CASE json_type({raw}) WHEN 'ARRAY' THEN {raw} WHEN 'NULL' THEN NULL ELSE CASE WHEN {raw}::VARCHAR <> '\"\"' THEN json_array({raw}) END END"


_FULL = "json_type(e) <> 'NULL' AND e::VARCHAR NOT IN ('{}', '[]') AND NOT (json_type(e) = 'VARCHAR' AND trim(e ->> '$', E' \\t\\n\\r') = '')"


def _elements(name: str, source: str, keys: str, arr: str, place: str) -> str:
    at = f"json_extract(a, '$[' || {place} || ']')"
    return f"""{name} AS (SELECT {keys}, {place}, {at} AS e FROM (
      SELECT {keys}, a, unnest(range(json_array_length(a)::BIGINT)) AS {place} FROM (SELECT {keys}, {arr} AS a FROM {source}) WHERE a IS NOT NULL))"""


NESTED = "WITH " + ", ".join(
    [
        _elements("items", "works_pages", "member", "CASE WHEN json_valid(content) THEN " + listed("json_extract(content, '$.message.items')") + " END", "item_no"),
        "works AS (SELECT member, item_no, e AS w FROM items WHERE json_type(e) = 'OBJECT' AND e::VARCHAR <> '{}')",
        _elements("authors_", "works", "member, item_no", listed("json_extract(w, '$.author')", True), "child_no"),
        f"authors AS (SELECT * FROM authors_ WHERE {_FULL})",
        _elements("affiliations_", "authors", "member, item_no, child_no", listed("json_extract(e, '$.affiliation')"), "sub_no"),
        f"affiliations AS (SELECT * FROM affiliations_ WHERE {_FULL})",
        _elements("refs_", "works", "member, item_no", listed("json_extract(w, '$.reference')", True), "child_no"),
        f"refs AS (SELECT * FROM refs_ WHERE {_FULL})",
        _elements("subjects_", "works", "member, item_no", listed("json_extract(w, '$.subject')"), "child_no"),
        f"subjects AS (SELECT * FROM subjects_ WHERE {_FULL} AND json_type(e) NOT IN ('OBJECT', 'ARRAY')) ",
    ]
)
_PLACES = "member, item_no::INT AS item_no, child_no::INT AS child_no"


def listed_text(key: str) -> str:
    v = f"json_extract(w, '$.\"{key}\"')"
    return f"CASE json_type({v}) WHEN 'ARRAY' THEN array_to_string(from_json({v}, '[\"VARCHAR\"]'), ' ') ELSE {v} ->> '$' END"


_SHIFTS = """
WITH cells AS (
  SELECT load_no, 'reference_count' AS column_name, reference_count::DOUBLE AS v FROM crossref_works_summaries
  UNION ALL SELECT load_no, 'num_references', num_references FROM crossref_works_summaries
  UNION ALL SELECT load_no, 'author_count', author_count FROM crossref_works_summaries),
sums AS (
  SELECT load_no, column_name, count(v) AS n, coalesce(sum(v), 0) AS s1, coalesce(sum(v*v), 0) AS s2, coalesce(sum(v*v*v), 0) AS s3, coalesce(sum(v*v*v*v), 0) AS s4
  FROM (SELECT load_no, column_name, CASE WHEN v BETWEEN 0 AND 10000 THEN v END AS v FROM cells) GROUP BY ALL),
whole AS (SELECT column_name, sum(n) AS cn, sum(s1) AS c1, sum(s2) AS c2 FROM sums GROUP BY ALL),
m AS (
  SELECT *, s1 / nullif(n, 0) AS mean, (c1 - s1) / nullif(cn - n, 0) AS rest, s2 / nullif(n, 0) AS m2, s3 / nullif(n, 0) AS m3, s4 / nullif(n, 0) AS m4,
    (c2 - s2) / nullif(cn - n, 0) AS r2 FROM sums JOIN whole USING (column_name) WHERE cn > 0),
d AS (SELECT *, m2 - mean * mean AS var, r2 - rest * rest AS rvar FROM m)
SELECT load_no, column_name, round(mean, 6) AS mean, round(rest, 6) AS rest_mean, round(sqrt(greatest(var, 0)), 6) AS deviation,
  CASE WHEN var > 0 THEN round((m3 - 3 * mean * m2 + 2 * mean * mean * mean) / pow(var, 1.5), 4) END AS skewness,
  CASE WHEN var > 0 THEN round((m4 - 4 * mean * m3 + 6 * mean * mean * m2 - 3 * mean * mean * mean * mean) / (var * var) - 3, 4) END AS kurtosis,
  CASE WHEN var + rvar > 0 THEN round((mean - rest) / sqrt((var + rvar) / 2), 6) END AS standardised_difference FROM d
"""

ORACLES = {
    "p1_found": _ORPHANS + "SELECT row_id, field FROM judged WHERE withdrawn OR missing",
    "p1_orphan_report": _ORPHANS
    + """SELECT 'crossref_works_citations' AS table_name, field,
    CASE WHEN withdrawn THEN 'withdrawn' WHEN known_at IS NULL THEN 'unknown' ELSE 'late' END AS reason,
    strftime(received_at, '%Y-%m') AS month, count(*) AS n_orphans FROM judged WHERE withdrawn OR missing GROUP BY ALL""",
    "p2_found": _LOSERS + "SELECT row_id FROM ranked WHERE place > 1",
    "p2_kept": _LOSERS + "SELECT row_id, doi, title, publisher, type, provenance, load_no FROM ranked WHERE place = 1",
    "p3_found": NESTED
    + """SELECT member, item_no::INT AS item_no, kind, child_no::INT AS child_no, sub_no::INT AS sub_no FROM (
    SELECT member, item_no, 'author' AS kind, child_no, -1 AS sub_no FROM authors UNION ALL SELECT member, item_no, 'affiliation', child_no, sub_no FROM affiliations
    UNION ALL SELECT member, item_no, 'reference', child_no, -1 FROM refs UNION ALL SELECT member, item_no, 'subject', child_no, -1 FROM subjects)""",
    "p3_works": NESTED
    + f"""SELECT member, item_no::INT AS item_no, w ->> '$.DOI' AS doi, {listed_text("title")} AS title, {listed_text("publisher")} AS publisher,
    {listed_text("container-title")} AS container_title, w ->> '$.type' AS type, w ->> '$."reference-count"' AS reference_count,
    w ->> '$."is-referenced-by-count"' AS referenced_by_count, w ->> '$.created."date-time"' AS created FROM works""",
    "p3_authors": NESTED + f"SELECT {_PLACES}, e ->> '$.given' AS given, e ->> '$.family' AS family, e ->> '$.sequence' AS sequence FROM authors",
    "p3_affiliations": NESTED + f"SELECT {_PLACES}, sub_no::INT AS sub_no, e ->> '$.name' AS affiliation_name FROM affiliations",
    "p3_subjects": NESTED + f"SELECT {_PLACES}, e ->> '$' AS subject FROM subjects",
    "p3_references": NESTED
    + f"SELECT {_PLACES}, e ->> '$.key' AS reference_key, e ->> '$.DOI' AS reference_doi, e ->> '$.year' AS reference_year, json(e)::VARCHAR AS reference_json FROM refs",
    "p6_shifts": _SHIFTS,
    "p6_found": _NUMBERS
    + """, j AS (SELECT l.*, c.mean AS cm, c.nulls / c.n AS cs FROM loads l JOIN cols c USING (column_name))
    SELECT load_no, column_name, 'nulls' AS mark FROM j WHERE nulls / n - cs > 0.2
    UNION ALL SELECT load_no, column_name, 'range' FROM j WHERE outside > 0
    UNION ALL SELECT load_no, column_name, 'shift' FROM j WHERE mean > 2 * cm OR mean * 2 < cm
    UNION ALL SELECT load_no, column_name, 'constant' FROM j WHERE d = 1""",
    "p6_profile": _profile_sql(),
    "p7_found": """
    SELECT 'publisher' AS field, publisher AS key_value FROM crossref_works_summaries WHERE publisher IS NOT NULL
    GROUP BY publisher HAVING count(*) > 0.01 * (SELECT count(*) FROM crossref_works_summaries)
    UNION ALL SELECT 'cited_doi', cited_doi FROM crossref_works_citations WHERE cited_doi IS NOT NULL
    GROUP BY cited_doi HAVING count(*) > 0.01 * (SELECT count(*) FROM crossref_works_citations)""",
    "p7_publishers": """SELECT publisher, count(*) AS n_rows, sum(has_references)::BIGINT AS n_with_references,
    sum(reference_count)::BIGINT AS sum_reference_count, max(referenced_by_count) AS max_referenced_by, min(received_at) AS first_received,
    publisher IS NOT NULL AND count(*) > 0.01 * (SELECT count(*) FROM crossref_works_summaries) AS heavy
    FROM crossref_works_summaries GROUP BY publisher""",
    "p7_cited": """SELECT cited_doi, count(*) AS n_rows, min(received_at) AS first_received, max(received_at) AS last_received,
    cited_doi IS NOT NULL AND count(*) > 0.01 * (SELECT count(*) FROM crossref_works_citations) AS heavy
    FROM crossref_works_citations GROUP BY cited_doi""",
}
