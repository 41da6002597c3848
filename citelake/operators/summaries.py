"""One flat row per work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citelake.functions.text import clean_doi, clean_text, first_or_null, pipe_joined, size_or_null
from citelake.operators.refs import reference_stats, references_without_doi

COLUMNS = [
    "doi", "title", "reference_count", "referenced_by_count", "created", "type", "publisher", "container_title", "author_count",
    "first_subject_area", "subject_areas", "has_references", "num_references", "num_citations_without_doi", "num_duplicate_citation_dois", "cited_dois",
]


def summarise(works: DataFrame, *, clean_dois: bool = True, provenance: bool = False, debug: bool = False, dedupe: bool = False, strict: bool = True) -> DataFrame:
    """Works (`citelake.plans.works` columns) as summary rows.

    A work without a DOI raises if `strict`, else its `doi` is NULL. Works delivered twice stay, unless `dedupe` keeps one per
    DOI. `provenance` adds the page's name, `debug` the references without a DOI as JSON.
    """
    doi = clean_doi(F.col("doi")) if clean_dois else F.col("doi")
    if strict:
        doi = F.when(F.col("doi").isNull(), F.raise_error(F.lit("work without a DOI"))).otherwise(doi)
    out = works.withColumn("_refs", reference_stats(F.col("references"), clean_dois))
    columns = [
        doi.alias("doi"),
        clean_text(F.col("title")).alias("title"),
        F.col("reference_count").cast("bigint").alias("reference_count"),
        F.col("referenced_by_count").cast("bigint").alias("referenced_by_count"),
        F.col("created"),
        F.col("type"),
        clean_text(F.col("publisher")).alias("publisher"),
        clean_text(F.col("container_title")).alias("container_title"),
        size_or_null(F.col("authors")).alias("author_count"),
        first_or_null(F.col("subjects")).alias("first_subject_area"),
        pipe_joined(F.col("subjects")).alias("subject_areas"),
        F.col("_refs.has_references"),
        F.col("_refs.num_references"),
        F.col("_refs.num_citations_without_doi"),
        F.col("_refs.num_duplicate_citation_dois"),
        F.to_json(F.col("_refs.cited_dois")).alias("cited_dois"),
    ]
    if provenance:
        columns.append(F.col("member").alias("provenance"))
    if debug:
        columns.append(F.to_json(F.coalesce(references_without_doi(F.col("references"), clean_dois), F.array().cast("array<map<string,string>>"))).alias("debug"))
    out = out.select(*columns)
    return out.dropDuplicates(["doi"]) if dedupe else out
