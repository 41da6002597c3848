"""A query for each operator over the driver's tables, and the SQL it is compared with."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.functions import text
from citelake.operators import citations, doi_quality, ordered, profile, summaries, typed_counts
from citelake.operators.refs import references_without_doi
from citelake.plans import analytics as a
from citelake.plans import integrity
from citelake.plans.tables import table
from citelake.plans.works import broken_pages, orders_as_works, pages_to_works
from citelake.session import scratch_path
from citelake.sources import delimited

KEPT_TYPE, MERGED, MERGED_LABEL = "journal-article", "press", "Press (all)"


def _works(s: SparkSession, d: str) -> DataFrame:
    return orders_as_works(table(s, d, "orders"), table(s, d, "lineitem"), table(s, d, "customer"))


def _summaries(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "crossref_works_summaries")


def _cleaned(s: SparkSession, d: str) -> DataFrame:
    """Line items as cleaned citations: a cleaned DOI, the original, and whether it was valid and corrected."""
    n = F.col("l_orderkey") + F.col("l_linenumber")
    original = F.concat(F.lit("10.5555/P"), F.col("l_partkey").cast("string"))
    cleaned = F.when(n % 4 == 0, F.lower(original)).when(n % 4 == 1, F.concat(original, F.lit("x"))).when(n % 4 == 2, original).otherwise("")
    return table(s, d, "lineitem").select(
        F.concat(F.lit("10.5555/"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("citing_doi"),
        cleaned.alias("cited_doi"),
        F.when(n % 9 != 0, original).otherwise("").alias("original_cited_doi"),
        F.when(n % 4 != 3, "true").otherwise("false").alias("cited_doi_valid"),
        F.when(n % 4 < 2, "true").otherwise("false").alias("cited_doi_corrected"),
    )


def works_summary(s, d):
    return summaries.summarise(_works(s, d), provenance=True)


def citation_links(s, d):
    return citations.citation_links(_works(s, d)).select("citing_doi", "cited_doi")


def citation_links_empty(s, d):
    return citations.citation_links(_works(s, d), empty_link=True, provenance=True)


def citation_arrays(s, d):
    return citations.citation_arrays(_works(s, d)).withColumn("cited_dois", F.array_join("cited_dois", "|"))


def _page_works(s, d):
    return pages_to_works(table(s, d, "works_pages"), quarantine=True)


def pages_summary(s, d):
    return summaries.summarise(_page_works(s, d), provenance=True)


def pages_debug(s, d):
    debug = F.col("debug")
    rows = summaries.summarise(_page_works(s, d), provenance=True, debug=True)
    return rows.select("provenance", "doi", F.json_array_length(debug).alias("n_without_doi"), F.get_json_object(debug, "$[0].key").alias("first_key"))


def pages_links(s, d):
    return citations.citation_links(_page_works(s, d), empty_link=True, provenance=True)


def pages_broken(s, d):
    return broken_pages(table(s, d, "works_pages")).select("member")


def page_cursors(s, d):
    c = F.col("content")
    return table(s, d, "works_pages").where(F.try_parse_json(c).isNotNull()).select("member", text.next_cursor(c).alias("next_cursor"), text.total_results(c).alias("total_results"))


def clean_text_documents(s, d):
    return table(s, d, "documents").select("doc_id", text.clean_text(F.col("text")).alias("clean"))


def clean_doi_citations(s, d):
    return table(s, d, "crossref_works_citations").select("row_id", text.clean_doi(F.col("cited_doi")).alias("clean"))


def _profiled(df, by=None):
    long = profile.profile_long(df, by)
    doubles = {c: F.round(c, 4).cast("double") for c in ("min", "max", "sum", "mean", "mean_non_zero")}
    return long.withColumns(doubles)


#: Every column of the summaries.
PROFILE = {
    **dict.fromkeys(["doi", "title", "created", "type", "publisher", "container_title", "first_subject_area", "subject_areas", "cited_dois", "provenance", "received_at"]),
    **{c: c for c in ["row_id", "reference_count", "referenced_by_count", "author_count", "has_references", "num_references", "num_citations_without_doi", "num_duplicate_citation_dois", "load_no"]},
}


def profile_summaries(s, d):
    return _profiled(_summaries(s, d).select(*PROFILE))


def profile_summaries_by_type(s, d):
    return _profiled(_summaries(s, d).select(*PROFILE), ["type", "publisher"])


def profile_lineitem(s, d):
    # Amounts in hundredths: their sums are exact in any order.
    cents = {c: F.round(F.col(c) * 100).cast("bigint") for c in ("l_extendedprice", "l_discount", "l_tax")}
    return _profiled(table(s, d, "lineitem").withColumns(cents), ["l_returnflag", "l_linestatus"])


def profile_bool_literals(s, d):
    flag = F.when(F.col("l_returnflag") == "R", "True").when(F.col("l_returnflag") == "A", "false").otherwise("1")
    mixed = F.when(F.col("l_linenumber") == 1, "x1").otherwise(F.col("l_linenumber").cast("string"))
    return _profiled(table(s, d, "lineitem").select(flag.alias("flag"), mixed.alias("mixed")))


def profile_matrix(s, d):
    return profile.profile(_summaries(s, d).select("has_references", "num_references", "reference_count", "publisher"))


def _typed(s, d):
    return typed_counts.typed_counts(typed_counts.summary_keys(_summaries(s, d)))


def _typed_keys(s, d):
    return typed_counts.key_counts(typed_counts.summary_keys(_summaries(s, d)))


def _stored(s, df, name):
    """A table written as a delimited file and read back."""
    path = scratch_path(s, "file") + f"/{name}"
    delimited.write_delimited_dir(df, path)
    return delimited.read_delimited(s, path, multi_line=False)


def typed_total(s, d):
    return typed_counts.in_order(_typed(s, d)).select("type", "key", "count", F.array_join("examples", "|").alias("examples"))


def typed_reference_keys(s, d):
    counts = typed_counts.typed_counts(typed_counts.reference_keys(_works(s, d).withColumn("doi", text.clean_doi(F.col("doi"))), references_without_doi(F.col("references"))))
    first = F.transform("examples", lambda e: F.concat(e["doi"], F.lit("#"), F.get_json_object(e["reference"], "$.key")))
    return counts.select("type", "key", "count", F.element_at(F.array_sort(first), 1).alias("example"), F.size("examples").alias("n_examples"))


def doi_ids(s, d):
    return ordered.doi_dictionary(table(s, d, "crossref_works_citations"), ["citing_doi", "cited_doi"])


def sort_unique(s, d):
    return ordered.sort_unique(table(s, d, "lineitem").select("l_shipdate", "l_returnflag", "l_linestatus", "l_linenumber"))


def in_batches(s, d):
    return ordered.in_batches(table(s, d, "orders").select("o_orderkey"), "o_orderkey", 1000)


def sort_window_exact(s, d):
    return ordered.windowed(table(s, d, "orders").select("o_orderkey", "o_custkey"), order="o_orderkey", key="o_custkey", size=100)


def uniq_window_exact(s, d):
    return ordered.windowed(table(s, d, "orders").select("o_orderkey", "o_custkey"), order="o_orderkey", key="o_custkey", size=100, sort=False)


def doi_case_equal(s, d):
    return doi_quality.with_case_flag(_cleaned(s, d))


def doi_corrected_differs(s, d):
    return doi_quality.corrected_differs(_cleaned(s, d)).select("citing_doi", "cited_doi", "original_cited_doi")


def doi_unmatched(s, d):
    return doi_quality.unmatched(_cleaned(s, d)).select("citing_doi", "original_cited_doi")


def doi_cleaning_report(s, d):
    return doi_quality.cleaning_report(_cleaned(s, d))


def open_pct_overall(s, d):
    return a.overall(_summaries(s, d))


def open_references_overall(s, d):
    return a.overall_references(_summaries(s, d))


def open_pct_by_type(s, d):
    return a.work_counts(_summaries(s, d), ["type"])


def open_pct_by_type_publisher(s, d):
    return a.work_counts(_summaries(s, d), ["type", "publisher"])


def counts_from_profile(s, d):
    rows = _summaries(s, d).select("type", "publisher", "doi", "reference_count", "num_references")
    return a.counts_from_profile(profile.profile_long(rows, ["type", "publisher"]), ["type", "publisher"])


def work_totals(s, d):
    return a.work_counts(_summaries(s, d), ["type", "publisher"]).agg(*[F.sum(c).alias(c) for c in a.WORK_COUNTS])


def open_sentences(s, d):
    return a.sentences(a.work_counts(_summaries(s, d), ["type"]), "type")


def journal_vs_other(s, d):
    return a.regroup(a.collapse_type(a.work_counts(_summaries(s, d), ["type"]), KEPT_TYPE), ["type"])


def top_publishers_semi(s, d):
    counts = a.work_counts(_summaries(s, d), ["type", "publisher"])
    return a.regroup(a.collapse_type(a.of_top_publishers(counts), KEPT_TYPE), ["type", "publisher"])


def merged_publishers(s, d):
    counts = a.merge_names(a.work_counts(_summaries(s, d), ["type", "publisher"]), MERGED, MERGED_LABEL)
    return a.regroup(a.collapse_type(a.of_top_publishers(counts), KEPT_TYPE), ["type", "publisher"])


def merged_names(s, d):
    return _summaries(s, d).where(text.contains_ignoring_case(F.col("publisher"), MERGED)).select("publisher").distinct()


def closed_by_publisher(s, d):
    return a.top(a.closed_share(_summaries(s, d), "publisher"), "n_closed", 10, "publisher")


def closed_by_publisher_joined(s, d):
    return a.closed_share_joined(_typed_keys(s, d), "publisher", how="left")


def closed_ratio_topk(s, d):
    return a.top(a.closed_share(_summaries(s, d), "publisher").where("n_closed > 3"), "ratio", 10, "publisher")


def closed_by_container(s, d):
    return a.top(a.closed_share(_summaries(s, d), "container_title"), "n_closed", 10, "container_title")


def closed_by_subject(s, d):
    return a.top(a.closed_share(_summaries(s, d), "first_subject_area"), "n_closed", 10, "first_subject_area")


def closed_by_year(s, d):
    return a.closed_share(_summaries(s, d).withColumn("year", text.year_of(F.col("created"))), "year").orderBy(F.col("year").desc())


def refs_by_type(s, d):
    return a.top(a.reference_counts(_summaries(s, d), ["type"]), "references_claimed", 5, "type")


def refs_by_publisher(s, d):
    return a.top(a.reference_counts(_summaries(s, d), ["publisher"]), "references_claimed", 5, "publisher")


def refs_by_merged_publisher(s, d):
    return a.top(a.regroup(a.merge_names(a.reference_counts(_summaries(s, d), ["publisher"]), MERGED, MERGED_LABEL), ["publisher"]), "references_claimed", 5, "publisher")


def refs_by_type_merged_publisher(s, d):
    merged = a.merge_names(a.reference_counts(_summaries(s, d), ["type", "publisher"]), MERGED, MERGED_LABEL)
    return a.top(a.regroup(merged, ["type", "publisher"]), "references_claimed", 5, "type", "publisher")


def references_by_year(s, d):
    bare = typed_counts.reference_keys(_works(s, d), references_without_doi(F.col("references"))).where("type = 'year'")
    years = typed_counts.key_counts(bare).select(F.col("key").alias("year"), F.col("count").alias("n"))
    return years.where("n > 100").orderBy(F.col("year").desc()).limit(150)


def closed_top_ratio(s, d):
    return a.closed_share_joined(_typed_keys(s, d), "countainer_title", how="inner", most=10)


def typed_from_file(s, d):
    rows = typed_counts.typed_counts(typed_counts.reference_keys(_works(s, d).withColumn("doi", text.clean_doi(F.col("doi"))), references_without_doi(F.col("references"))))
    back = typed_counts.from_file(_stored(s, typed_counts.to_file(rows), "typed.tsv"))
    return back.select("type", "key", "count", F.transform("without_source", lambda e: F.get_json_object(e, "$.key")).getItem(0).alias("first_key"))


def profile_from_file(s, d):
    matrix = profile.profile(_summaries(s, d).select("type", "publisher", "doi", "reference_count", "num_references"), ["type", "publisher"])
    return a.counts_from_profile(profile.from_matrix(_stored(s, matrix, "profile.tsv"), ["type", "publisher"]), ["type", "publisher"])


def grouped_equals_ungrouped(s, d):
    return a.grouped_equals_ungrouped(_summaries(s, d))


def formatted_counts(s, d):
    return a.work_counts(_summaries(s, d), ["type"]).select("type", text.format_count(F.col("work_count")).alias("works"), text.format_percent(F.col("p_open")).alias("open"))


_NAMES = """works_summary citation_links citation_links_empty citation_arrays pages_summary pages_debug pages_links pages_broken page_cursors clean_text_documents
clean_doi_citations profile_summaries profile_summaries_by_type profile_lineitem profile_bool_literals profile_matrix typed_total typed_reference_keys doi_ids
sort_unique in_batches sort_window_exact uniq_window_exact doi_case_equal doi_corrected_differs doi_unmatched doi_cleaning_report open_pct_overall
open_references_overall open_pct_by_type open_pct_by_type_publisher counts_from_profile work_totals open_sentences journal_vs_other top_publishers_semi
merged_publishers merged_names closed_by_publisher closed_by_publisher_joined closed_ratio_topk closed_by_container closed_by_subject closed_by_year refs_by_type
refs_by_publisher refs_by_merged_publisher refs_by_type_merged_publisher references_by_year grouped_equals_ungrouped formatted_counts
closed_top_ratio typed_from_file profile_from_file"""
QUERIES = {name: globals()[name] for name in _NAMES.split()}

# ---- SQL -------------------------------------------------------------------------------------------------------------

_REFS = """refs AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN '10.5555/p' || l_partkey END AS ref_doi,
    year(l_shipdate)::VARCHAR AS ref_year, CASE WHEN l_linestatus = 'F' THEN 'text' ELSE '' END AS unstructured FROM lineitem),
per AS (
  SELECT l_orderkey, count(*)::INT AS n, (count(*) - count(ref_doi))::INT AS without, (count(ref_doi) - count(DISTINCT ref_doi))::INT AS dup,
    coalesce(list_sort(list(DISTINCT ref_doi) FILTER (WHERE ref_doi IS NOT NULL)), []) AS cited FROM refs GROUP BY l_orderkey),
works AS (
  SELECT o.*, '10.5555/' || o_orderkey AS doi, c.c_mktsegment, (per.n IS NOT NULL)::INT AS has, coalesce(per.n, 0) AS n, coalesce(without, 0) AS without,
    coalesce(dup, 0) AS dup, coalesce(cited, []) AS cited
  FROM orders o LEFT JOIN per ON o_orderkey = per.l_orderkey LEFT JOIN customer c ON o_custkey = c_custkey)"""
_COUNTS = "has AS has_references, n AS num_references, without AS num_citations_without_doi, dup AS num_duplicate_citation_dois"
_PCT = "100.0::DOUBLE * {a} / nullif({b}, 0)"


def _work_counts(keys: dict[str, str], source: str = "crossref_works_summaries") -> str:
    cols = ", ".join(f"{v} AS {k}" for k, v in keys.items())
    return f"""SELECT {cols}, count(*) AS work_count, count(*) FILTER (WHERE reference_count <> 0) AS has_references_claimed,
    count(*) FILTER (WHERE num_references <> 0) AS has_references_open,
    {_PCT.format(a="count(*) FILTER (WHERE num_references <> 0)", b="count(*) FILTER (WHERE reference_count <> 0)")} AS p_open FROM {source} GROUP BY ALL"""


def _ref_counts(keys: dict[str, str]) -> str:
    cols = ", ".join(f"{v} AS {k}" for k, v in keys.items())
    order = ", ".join(keys)
    return f"""SELECT {cols}, coalesce(sum(reference_count), 0)::BIGINT AS references_claimed, coalesce(sum(num_references), 0)::BIGINT AS references_open,
    {_PCT.format(a="coalesce(sum(num_references), 0)", b="coalesce(sum(reference_count), 0)")} AS p_open
    FROM crossref_works_summaries GROUP BY ALL ORDER BY references_claimed DESC, {order} LIMIT 5"""


_TYPE, _PUB = "coalesce(type, '')", "coalesce(publisher, '')"
_KEPT = f"CASE WHEN type = '{KEPT_TYPE}' THEN type ELSE 'non-{KEPT_TYPE}' END"
_MERGED = f"CASE WHEN contains(lower(publisher), '{MERGED}') THEN '{MERGED_LABEL}' ELSE coalesce(publisher, '') END"
_SHUT = "reference_count > 0 AND has_references = 0"


def _closed(column: str, source: str = "crossref_works_summaries", having: str = "n_closed > 0") -> str:
    return f"""SELECT {column}, count(*) FILTER (WHERE {_SHUT}) AS n_closed, count(*) AS n_works, (count(*) FILTER (WHERE {_SHUT}))::DOUBLE / count(*) AS ratio
    FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING {having}"""


def _profile_sql(source: str, columns: dict[str, str | None], by: dict[str, str] | None = None) -> str:
    """Columns with an expression for their number (None: text without any)."""
    by = by or {}
    keys = "".join(f"{v} AS {k}, " for k, v in by.items())
    group = " GROUP BY ALL" if by else ""
    parts = []
    for c, number in columns.items():
        x = number or "NULL::DOUBLE"
        parts.append(
            f"""SELECT {"".join(f"{k}, " for k in by)}'{c}' AS column_name, n AS count, valid AS count_valid,
            CASE WHEN n > 0 THEN CASE WHEN ok THEN 'numeric' ELSE 'str' END END AS value_type,
            CASE WHEN ok THEN round(lo, 4) END AS min, CASE WHEN ok THEN round(hi, 4) END AS max, CASE WHEN ok THEN round(total, 4) END AS sum,
            CASE WHEN ok THEN num END AS count_numeric, CASE WHEN ok THEN nz END AS count_non_zero, CASE WHEN ok THEN num - nz END AS count_zero,
            CASE WHEN ok THEN round(total / num, 4) END AS mean, CASE WHEN ok THEN CASE WHEN nz = 0 THEN 0 ELSE round(total / nz, 4) END END AS mean_non_zero
            FROM (SELECT *, valid > 0 AND valid = num AS ok FROM (SELECT {keys}count(*) AS n, count({c}) AS valid, count({x}) AS num, min({x})::DOUBLE AS lo,
            max({x})::DOUBLE AS hi, sum({x})::DOUBLE AS total, count(*) FILTER (WHERE {x} <> 0) AS nz FROM {source}{group}))"""
        )
    return " UNION ALL ".join(parts)


def _matrix_sql(source: str, columns: dict[str, str | None]) -> str:
    """The long profile with a row per statistic and a text cell per column, numbers unrounded."""
    long = re.sub(r"round\((.*?), 4\)", r"(\1)", _profile_sql(source, columns))
    whole, real = [s for s in profile.STATISTICS if s.startswith("count")], ("max", "mean", "mean_non_zero", "min", "sum")
    cells = [f"SELECT column_name, '{s}' AS stat, {s}::VARCHAR AS cell FROM p" for s in whole]
    cells += [f"SELECT column_name, '{s}', CASE WHEN {s} = floor({s}) THEN {s}::BIGINT::VARCHAR ELSE {s}::DOUBLE::VARCHAR END FROM p" for s in real]
    cells.append("SELECT column_name, 'type', value_type FROM p")
    picked = ", ".join(f"max(cell) FILTER (WHERE column_name = '{c}') AS {c}" for c in columns)
    return f"WITH p AS ({long}), cells AS ({' UNION ALL '.join(cells)}) SELECT stat, {picked} FROM cells WHERE cell IS NOT NULL GROUP BY stat"


_FLAGS = """(SELECT CASE l_returnflag WHEN 'R' THEN 'True' WHEN 'A' THEN 'false' ELSE '1' END AS flag,
  CASE WHEN l_linenumber = 1 THEN 'x1' ELSE l_linenumber::VARCHAR END AS mixed FROM lineitem)"""
_CLEANED = """WITH cleaned AS (
  SELECT '10.5555/' || l_orderkey || '-' || l_linenumber AS citing_doi, n,
    CASE n % 4 WHEN 0 THEN lower(original) WHEN 1 THEN original || 'x' WHEN 2 THEN original ELSE '' END AS cited_doi,
    CASE WHEN n % 9 <> 0 THEN original ELSE '' END AS original_cited_doi, CASE WHEN n % 4 <> 3 THEN 'true' ELSE 'false' END AS cited_doi_valid,
    CASE WHEN n % 4 < 2 THEN 'true' ELSE 'false' END AS cited_doi_corrected
  FROM (SELECT *, l_orderkey + l_linenumber AS n, '10.5555/P' || l_partkey AS original FROM lineitem)),
flagged AS (
  SELECT *, CASE WHEN cited_doi <> '' AND cited_doi_corrected = 'true' THEN (lower(cited_doi) = lower(original_cited_doi))::INT END AS flag FROM cleaned) """
_STRIP = f"translate(trim(cited_doi, '{text.PYTHON_WHITESPACE}'), E'\\n\\t\"', '')"
_TYPED = """pairs AS (
  SELECT doi, reference_count, has_references, unnest([{'t': 'publisher', 'k': publisher}, {'t': 'countainer_title', 'k': container_title},
    {'t': 'first_subject_area', 'k': first_subject_area}, {'t': 'created', 'k': year(created::TIMESTAMP)::VARCHAR}]) AS p FROM crossref_works_summaries),
keyed AS (
  SELECT 'total_' || p.t AS type, p.k AS key, doi FROM pairs
  UNION ALL SELECT 'non_oa_ref_' || p.t, p.k, doi FROM pairs WHERE reference_count > 0 AND has_references = 0)"""

_STRIPPED = f"CASE WHEN {{c}} <> '' THEN translate(trim({{c}}, '{text.PYTHON_WHITESPACE}'), E'\\n\\t\"', '') END"
_TIDY = r"regexp_replace(translate({c}, E'\n\r\t', '   '), ' +', ' ', 'g')"
_PAGES = (
    integrity.NESTED
    + f""", counted AS (
  SELECT member, item_no, child_no, e, {_STRIPPED.format(c="doi")} AS cited FROM (
    SELECT *, CASE WHEN json_type(e) = 'OBJECT' THEN e ->> '$.DOI' END AS doi FROM refs_
    WHERE json_type(e) <> 'NULL' AND NOT (json_type(e) = 'VARCHAR' AND trim(e ->> '$', E' \\t\\n\\r') = ''))),
per AS (
  SELECT member, item_no, count(*)::INT AS n, count(*) FILTER (WHERE coalesce(cited, '') = '')::INT AS without,
    (count(*) FILTER (WHERE cited <> '') - count(DISTINCT cited) FILTER (WHERE cited <> ''))::INT AS dup,
    list_sort(list(DISTINCT cited) FILTER (WHERE cited <> '')) AS cited,
    first(e ->> '$.key' ORDER BY child_no) FILTER (WHERE coalesce(cited, '') = '') AS bare_key FROM counted GROUP BY ALL),
named AS (
  SELECT member, item_no, count(*)::INT AS n_subjects, first(v ORDER BY child_no) AS first_subject, string_agg(v, '|' ORDER BY child_no) AS joined
  FROM (SELECT *, CASE WHEN json_type(e) NOT IN ('OBJECT', 'ARRAY') THEN e ->> '$' END AS v FROM subjects_) GROUP BY ALL),
work AS (
  SELECT works.*, {_STRIPPED.format(c="(w ->> '$.DOI')")} AS doi, ({integrity.listed("json_extract(w, '$.reference')", True)} IS NOT NULL)::INT AS has_references,
    coalesce(n, 0) AS num_references, coalesce(without, 0) AS num_citations_without_doi, coalesce(dup, 0) AS num_duplicate_citation_dois, coalesce(cited, []) AS cited,
    bare_key, first_subject, joined, json_array_length({integrity.listed("json_extract(w, '$.author')", True)})::INT AS author_count
  FROM works LEFT JOIN per USING (member, item_no) LEFT JOIN named USING (member, item_no))
"""
)
_WINDOW = "WITH RECURSIVE o AS MATERIALIZED (SELECT list(o_orderkey ORDER BY o_orderkey) AS ks, list(o_custkey ORDER BY o_orderkey) AS cs FROM orders), "

ORACLES = {
    "pages_summary": _PAGES
    + f"""SELECT doi, {_TIDY.format(c=integrity.listed_text("title"))} AS title, TRY_CAST(w ->> '$."reference-count"' AS BIGINT) AS reference_count,
    TRY_CAST(w ->> '$."is-referenced-by-count"' AS BIGINT) AS referenced_by_count, w ->> '$.created."date-time"' AS created, w ->> '$.type' AS type,
    {_TIDY.format(c=integrity.listed_text("publisher"))} AS publisher, {_TIDY.format(c=integrity.listed_text("container-title"))} AS container_title, author_count,
    first_subject AS first_subject_area, coalesce(joined, '') AS subject_areas, has_references, num_references, num_citations_without_doi, num_duplicate_citation_dois,
    to_json(cited)::VARCHAR AS cited_dois, member AS provenance FROM work""",
    "pages_debug": _PAGES + "SELECT member AS provenance, doi, num_citations_without_doi AS n_without_doi, bare_key AS first_key FROM work",
    "pages_links": _PAGES
    + """, flat AS (SELECT * REPLACE (unnest(list_concat([NULL], cited)) AS cited) FROM work)
    SELECT doi AS citing_doi, cited AS cited_doi, CASE WHEN cited IS NULL THEN has_references END AS has_references, CASE WHEN cited IS NULL THEN num_references END AS num_references,
    CASE WHEN cited IS NULL THEN num_citations_without_doi END AS num_citations_without_doi, CASE WHEN cited IS NULL THEN num_duplicate_citation_dois END AS num_duplicate_citation_dois,
    member AS provenance FROM flat""",
    "uniq_window_exact": _WINDOW
    + """w AS (
      SELECT 0::BIGINT AS i, NULL::BIGINT AS k, NULL::BIGINT AS c, []::BIGINT[] AS held, false AS kept
      UNION ALL SELECT i, k, c, CASE WHEN list_contains(held, c) THEN held WHEN len(held) >= 100 THEN list_append(held[1:99], c) ELSE list_append(held, c) END, NOT list_contains(held, c)
      FROM (SELECT i + 1 AS i, ks[i + 1] AS k, cs[i + 1] AS c, held FROM w, o WHERE i < len(ks)))
    SELECT k AS o_orderkey, c AS o_custkey, row_number() OVER (ORDER BY i) - 1 AS _place FROM w WHERE kept""",
    "sort_window_exact": _WINDOW
    + """w AS (
      SELECT 0::BIGINT AS i, []::STRUCT(c BIGINT, i BIGINT, k BIGINT)[] AS held, NULL::STRUCT(c BIGINT, i BIGINT, k BIGINT) AS gone
      UNION ALL SELECT i, CASE WHEN len(full_) > 99 THEN full_[2:] ELSE full_ END, CASE WHEN len(full_) > 99 THEN full_[1] END
      FROM (SELECT i + 1 AS i, list_sort(list_append(held, {'c': cs[i + 1], 'i': i, 'k': ks[i + 1]})) AS full_ FROM w, o WHERE i < len(ks))),
    leaving AS (
      SELECT i AS step, 0 AS nth, gone AS r FROM w WHERE gone IS NOT NULL
      UNION ALL SELECT i + 1, unnest(range(len(held))), unnest(held) FROM w WHERE i = (SELECT len(ks) FROM o))
    SELECT r.k AS o_orderkey, r.c AS o_custkey, row_number() OVER (ORDER BY step, nth) - 1 AS _place FROM leaving""",
    "profile_matrix": _matrix_sql("crossref_works_summaries", {"has_references": "has_references", "num_references": "num_references", "reference_count": "reference_count", "publisher": None}),
    "works_summary": f"""WITH {_REFS} SELECT doi, 'Order ' || o_orderkey || ' for ' || o_custkey AS title, o_orderkey % 7 AS reference_count,
    o_orderkey % 11 AS referenced_by_count, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created, o_orderstatus AS type, o_orderpriority AS publisher,
    c_mktsegment AS container_title, CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 4)::INT END AS author_count,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS first_subject_area,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus || '|' || o_orderpriority ELSE '' END AS subject_areas, {_COUNTS},
    CASE WHEN len(cited) = 0 THEN '[]' ELSE '["' || array_to_string(cited, '","') || '"]' END AS cited_dois, 'orders-' || o_orderkey % 16 AS provenance FROM works""",
    "citation_links": f"WITH {_REFS} SELECT doi AS citing_doi, unnest(cited) AS cited_doi FROM works",
    "citation_links_empty": f"""WITH {_REFS}, flat AS (SELECT * REPLACE (unnest(list_concat([NULL], cited)) AS cited) FROM works)
    SELECT doi AS citing_doi, cited AS cited_doi, CASE WHEN cited IS NULL THEN has END AS has_references, CASE WHEN cited IS NULL THEN n END AS num_references,
    CASE WHEN cited IS NULL THEN without END AS num_citations_without_doi, CASE WHEN cited IS NULL THEN dup END AS num_duplicate_citation_dois,
    'orders-' || o_orderkey % 16 AS provenance FROM flat""",
    "citation_arrays": f"WITH {_REFS} SELECT doi AS citing_doi, {_COUNTS}, array_to_string(cited, '|') AS cited_dois FROM works",
    "pages_broken": "SELECT member FROM works_pages WHERE NOT json_valid(content)",
    "page_cursors": """SELECT member, json_extract_string(content, '$.message.next-cursor') AS next_cursor,
    TRY_CAST(json_extract_string(content, '$.message.total-results') AS BIGINT) AS total_results FROM works_pages WHERE json_valid(content)""",
    "clean_text_documents": r"SELECT doc_id, regexp_replace(translate(text, E'\n\r\t', '   '), ' +', ' ', 'g') AS clean FROM documents",
    "clean_doi_citations": f"SELECT row_id, CASE WHEN cited_doi <> '' THEN {_STRIP} END AS clean FROM crossref_works_citations",
    "profile_summaries": _profile_sql("crossref_works_summaries", PROFILE),
    "profile_summaries_by_type": _profile_sql("crossref_works_summaries", {c: n for c, n in PROFILE.items() if c not in ("type", "publisher")}, {"type": _TYPE, "publisher": _PUB}),
    "profile_lineitem": _profile_sql(
        "(SELECT * REPLACE (round(l_extendedprice * 100)::BIGINT AS l_extendedprice, round(l_discount * 100)::BIGINT AS l_discount, round(l_tax * 100)::BIGINT AS l_tax) FROM lineitem)",
        {c: c for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")} | {"l_shipdate": None},
        {"l_returnflag": "l_returnflag", "l_linestatus": "l_linestatus"},
    ),
    "profile_bool_literals": _profile_sql(_FLAGS, {"flag": "(CASE flag WHEN 'True' THEN 1 WHEN 'false' THEN 0 ELSE 1 END)", "mixed": "TRY_CAST(mixed AS DOUBLE)"}),
    "typed_total": f"""WITH {_TYPED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY type, key ORDER BY doi NULLS FIRST) AS r FROM keyed)
    SELECT type, key, count(*) AS count, array_to_string(list(doi ORDER BY r) FILTER (WHERE r <= 10), '|') AS examples FROM ranked GROUP BY type, key""",
    "typed_reference_keys": f"""WITH {_REFS}, bare AS (SELECT '10.5555/' || l_orderkey || '#ref' || l_linenumber AS ex, '10.5555/' || l_orderkey AS doi, l_linenumber, * FROM refs WHERE ref_doi IS NULL),
    keyed AS (
      SELECT 'key_combination' AS type, CASE WHEN unstructured <> '' THEN 'key|unstructured|year' ELSE 'key|year' END AS key, ex, doi, l_linenumber FROM bare
      UNION ALL SELECT 'year', ref_year, ex, doi, l_linenumber FROM bare),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY type, key ORDER BY doi, l_linenumber) AS r FROM keyed)
    SELECT type, key, count(*) AS count, min(ex) FILTER (WHERE r <= 10) AS example, (count(*) FILTER (WHERE r <= 10))::INT AS n_examples FROM ranked GROUP BY type, key""",
    "doi_ids": """SELECT row_number() OVER (ORDER BY doi) - 1 AS id, doi FROM (
      SELECT citing_doi AS doi FROM crossref_works_citations UNION SELECT cited_doi FROM crossref_works_citations) WHERE doi IS NOT NULL AND doi <> ''""",
    "sort_unique": "SELECT DISTINCT l_shipdate, l_returnflag, l_linestatus, l_linenumber FROM lineitem",
    "in_batches": "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS batch FROM orders",
    "doi_case_equal": _CLEANED + f"SELECT * EXCLUDE (n, flag), flag AS {doi_quality.FLAG} FROM flagged",
    "doi_corrected_differs": _CLEANED + "SELECT citing_doi, cited_doi, original_cited_doi FROM flagged WHERE flag = 0",
    "doi_unmatched": _CLEANED + "SELECT citing_doi, original_cited_doi FROM flagged WHERE original_cited_doi <> '' AND cited_doi_valid = 'false'",
    "doi_cleaning_report": _CLEANED
    + """SELECT count(*) AS n_dois, count(*) FILTER (WHERE cited_doi_valid = 'true') AS n_valid, count(*) FILTER (WHERE cited_doi_valid <> 'true') AS n_invalid,
    count(*) FILTER (WHERE cited_doi_corrected = 'true') AS n_corrected,
    count(*) FILTER (WHERE cited_doi_corrected = 'true') - count(*) FILTER (WHERE flag = 1) AS n_corrected_excluding_case FROM flagged""",
    "open_pct_overall": f"""SELECT count(*) AS n_works, count(*) FILTER (WHERE reference_count <> 0) AS n_claimed, count(*) FILTER (WHERE has_references <> 0) AS n_open,
    {_PCT.format(a="count(*) FILTER (WHERE has_references <> 0)", b="count(*) FILTER (WHERE reference_count <> 0)")} AS p_open FROM crossref_works_summaries""",
    "open_references_overall": f"""SELECT sum(reference_count)::BIGINT AS claimed, sum(num_references)::BIGINT AS open,
    (sum(num_references) - sum(num_citations_without_doi))::BIGINT AS with_doi, sum(num_citations_without_doi)::BIGINT AS without_doi,
    sum(num_duplicate_citation_dois)::BIGINT AS duplicates, {_PCT.format(a="sum(num_references)", b="sum(reference_count)")} AS p_open FROM crossref_works_summaries""",
    "open_pct_by_type": _work_counts({"type": _TYPE}),
    "open_pct_by_type_publisher": _work_counts({"type": _TYPE, "publisher": _PUB}),
    "counts_from_profile": _work_counts({"type": _TYPE, "publisher": _PUB}),
    "work_totals": """SELECT count(*) AS work_count, count(*) FILTER (WHERE reference_count <> 0) AS has_references_claimed,
    count(*) FILTER (WHERE num_references <> 0) AS has_references_open FROM crossref_works_summaries""",
    "open_sentences": f"""SELECT type, type || ': ' || format('{{:,}}', has_references_claimed) || ' works say they cite others; the references of '
    || format('{{:,}}', has_references_open) || ' can be read, ' || printf('%.2f', p_open) || '% of them.' AS sentence
    FROM ({_work_counts({"type": _TYPE})}) WHERE has_references_claimed > 0""",
    "journal_vs_other": _work_counts({"type": _KEPT}),
    "top_publishers_semi": f"""WITH best AS (SELECT {_PUB} AS p FROM crossref_works_summaries GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5)
    {_work_counts({"type": _KEPT, "publisher": "p"}, f"(SELECT *, {_PUB} AS p FROM crossref_works_summaries WHERE {_PUB} IN (SELECT p FROM best))")}""",
    "merged_publishers": f"""WITH m AS (SELECT * REPLACE ({_MERGED} AS publisher) FROM crossref_works_summaries),
    best AS (SELECT publisher AS p FROM m GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5)
    {_work_counts({"type": _KEPT, "publisher": "publisher"}, "(SELECT * FROM m WHERE publisher IN (SELECT p FROM best))")}""",
    "merged_names": f"SELECT DISTINCT publisher FROM crossref_works_summaries WHERE contains(lower(publisher), '{MERGED}')",
    "closed_by_publisher": _closed("publisher") + " ORDER BY n_closed DESC, publisher LIMIT 10",
    "closed_by_publisher_joined": _closed("publisher").replace("SELECT publisher", "SELECT publisher AS key", 1).replace("WHERE publisher IS NOT NULL", ""),
    "closed_ratio_topk": _closed("publisher", having="n_closed > 3") + " ORDER BY ratio DESC, publisher LIMIT 10",
    "closed_by_container": _closed("container_title") + " ORDER BY n_closed DESC, container_title LIMIT 10",
    "closed_by_subject": _closed("first_subject_area") + " ORDER BY n_closed DESC, first_subject_area LIMIT 10",
    "closed_by_year": _closed("year", "(SELECT *, year(created::TIMESTAMP)::INT AS year FROM crossref_works_summaries)"),
    "refs_by_type": _ref_counts({"type": _TYPE}),
    "refs_by_publisher": _ref_counts({"publisher": _PUB}),
    "refs_by_merged_publisher": _ref_counts({"publisher": _MERGED}),
    "refs_by_type_merged_publisher": _ref_counts({"type": _TYPE, "publisher": _MERGED}),
    "references_by_year": f"WITH {_REFS} SELECT ref_year AS year, count(*) AS n FROM refs JOIN orders ON l_orderkey = o_orderkey WHERE ref_doi IS NULL GROUP BY 1 HAVING n > 100 ORDER BY year DESC LIMIT 150",
    "closed_top_ratio": _closed("container_title").replace("SELECT container_title", "SELECT container_title AS key", 1).replace("WHERE container_title IS NOT NULL", "")
    + " ORDER BY n_closed DESC, container_title LIMIT 10",
    "typed_from_file": f"""WITH {_REFS}, bare AS (SELECT '10.5555/' || l_orderkey AS doi, 'ref' || l_linenumber AS ex, l_linenumber, * FROM refs WHERE ref_doi IS NULL),
    keyed AS (
      SELECT 'key_combination' AS type, CASE WHEN unstructured <> '' THEN 'key|unstructured|year' ELSE 'key|year' END AS key, ex, doi, l_linenumber FROM bare
      UNION ALL SELECT 'year', ref_year, ex, doi, l_linenumber FROM bare)
    SELECT type, key, count(*) AS count, first(ex ORDER BY doi, l_linenumber) AS first_key FROM keyed GROUP BY type, key""",
    "profile_from_file": _work_counts({"type": _TYPE, "publisher": _PUB}),
    "grouped_equals_ungrouped": "SELECT coalesce(sum(reference_count), 0)::BIGINT AS claimed, coalesce(sum(num_references), 0)::BIGINT AS open, true AS equal FROM crossref_works_summaries",
    "formatted_counts": f"SELECT type, format('{{:,}}', work_count) AS works, printf('%.2f', p_open) || '%' AS open FROM ({_work_counts({'type': _TYPE})})",
}
