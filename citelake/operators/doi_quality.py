"""What a cleaning step did to cited DOIs. Columns: cited_doi, original_cited_doi, cited_doi_valid, cited_doi_corrected (`true`/`false`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citelake.functions.text import equal_ignoring_case, number_or_null

FLAG = "doi_corrected_equal_case_insensitve"  # fixed value: the column's name in published files


def with_case_flag(cleaned: DataFrame) -> DataFrame:
    """Adds 1 or 0 where a DOI was corrected: does it equal the original ignoring case? NULL elsewhere."""
    corrected = (F.coalesce("cited_doi", F.lit("")) != "") & (F.col("cited_doi_corrected") == "true")
    return cleaned.withColumn(FLAG, F.when(corrected, equal_ignoring_case(F.col("cited_doi"), F.col("original_cited_doi")).cast("int")))


def corrected_differs(cleaned: DataFrame) -> DataFrame:
    """Corrections that are more than a change of case."""
    return with_case_flag(cleaned).where(F.col(FLAG) == 0)


def unmatched(cleaned: DataFrame) -> DataFrame:
    """Original DOIs that are not valid."""
    return cleaned.where((F.coalesce("original_cited_doi", F.lit("")) != "") & (F.col("cited_doi_valid") == "false"))


def cleaning_report(cleaned: DataFrame) -> DataFrame:
    """One row: links in all, valid, all others, corrected, corrected in more than case; a flag counts where it reads as a number other than 0."""
    yes = lambda c: F.coalesce(number_or_null(F.col(c).cast("string")) != 0, F.lit(False))
    flagged = with_case_flag(cleaned).agg(
        F.count("*").alias("n_dois"), F.count_if(yes("cited_doi_valid")).alias("n_valid"), F.count_if(yes("cited_doi_corrected")).alias("n_corrected"), F.count_if(yes(FLAG)).alias("_case")
    )
    return flagged.select("n_dois", "n_valid", (F.col("n_dois") - F.col("n_valid")).alias("n_invalid"), "n_corrected", (F.col("n_corrected") - F.col("_case")).alias("n_corrected_excluding_case"))
