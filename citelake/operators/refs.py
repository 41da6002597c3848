"""What a work's references come to: counts and the cited identifiers, computed once and shared by summaries and citations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citelake.functions.text import clean_doi


def _doi(ref: Column, clean: bool) -> Column:
    return clean_doi(ref["DOI"]) if clean else ref["DOI"]


def reference_stats(references: Column, clean: bool = True) -> Column:
    """A struct of has_references, num_references, num_citations_without_doi, num_duplicate_citation_dois, cited_dois (sorted, distinct).

    A missing array counts as present-less (`has_references` 0); an empty one as present. References without a DOI, or whose
    DOI cleans to nothing, are `without`.
    """
    dois = F.filter(F.transform(references, lambda r: F.coalesce(_doi(r, clean), F.lit(""))), lambda d: d != "")

    def stats(d: Column) -> Column:
        distinct = F.sort_array(F.array_distinct(d))
        return F.struct(
            F.when(references.isNotNull(), 1).otherwise(0).alias("has_references"),
            F.coalesce(F.size(references), F.lit(0)).alias("num_references"),
            (F.coalesce(F.size(references), F.lit(0)) - F.size(d)).alias("num_citations_without_doi"),
            (F.size(d) - F.size(distinct)).alias("num_duplicate_citation_dois"),
            distinct.alias("cited_dois"),
        )

    # A one-element transform binds the DOI list to a variable, so it is computed once.
    return F.get(F.transform(F.array(F.coalesce(dois, F.array().cast("array<string>"))), stats), F.lit(0))


def references_without_doi(references: Column, clean: bool = True) -> Column:
    """The references as they are that have no usable DOI."""
    return F.filter(references, lambda r: F.coalesce(_doi(r, clean), F.lit("")) == "")
