"""Citing-to-cited links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citelake.functions.text import clean_doi
from citelake.operators.refs import reference_stats, references_without_doi

COUNTS = ["has_references", "num_references", "num_citations_without_doi", "num_duplicate_citation_dois"]


def citation_arrays(works: DataFrame, *, clean_dois: bool = True) -> DataFrame:
    """One row per work: `citing_doi` (NULL allowed), the four counts, `cited_dois` as an array."""
    citing = clean_doi(F.col("doi")) if clean_dois else F.col("doi")
    rows = works.withColumn("_refs", reference_stats(F.col("references"), clean_dois))
    return rows.select(citing.alias("citing_doi"), *[F.col(f"_refs.{c}") for c in [*COUNTS, "cited_dois"]])


def citation_links(works: DataFrame, *, clean_dois: bool = True, empty_link: bool = False, provenance: bool = False, debug: bool = False, columns: list[str] | None = None) -> DataFrame:
    """One row per cited DOI, counts empty. With `empty_link` every work also has a row with its counts and no cited DOI, before its links.

    `debug` adds the references without a DOI as JSON to that row, and implies it. `columns` narrows the result, e.g. to the two DOIs.
    """
    citing = clean_doi(F.col("doi")) if clean_dois else F.col("doi")
    rows = works.withColumn("_refs", reference_stats(F.col("references"), clean_dois))
    cited = F.col("_refs.cited_dois")
    if empty_link or debug:
        cited = F.concat(F.array(F.lit(None).cast("string")), cited)
    extra = ["member"] if provenance else []
    if debug:
        rows = rows.withColumn("_debug", F.to_json(F.coalesce(references_without_doi(F.col("references"), clean_dois), F.array().cast("array<map<string,string>>"))))
        extra.append("_debug")
    out = rows.select(citing.alias("citing_doi"), "_refs", *extra, F.explode(cited).alias("cited_doi"))
    per_work = F.col("cited_doi").isNull()
    picked = ["citing_doi", "cited_doi", *[F.when(per_work, F.col(f"_refs.{c}")).alias(c) for c in COUNTS]]
    if provenance:
        picked.append(F.col("member").alias("provenance"))
    if debug:
        picked.append(F.when(per_work, F.col("_debug")).alias("debug"))
    out = out.select(*picked)
    return out.select(*columns) if columns else out
