"""Questions about works and how open their references are, over summary rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citelake.functions.text import contains_ignoring_case, percentage
from citelake.operators.typed_counts import closed

WORK_COUNTS = ["work_count", "has_references_claimed", "has_references_open"]
REFERENCE_COUNTS = ["references_claimed", "references_open"]


def key(name: str) -> Column:
    """A group key with `''` for NULL."""
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def work_counts(summaries: DataFrame, by: list[str]) -> DataFrame:
    """Works per group, those that claim references and those whose references are there, with the open share in per cent."""
    out = summaries.select(*[key(c) for c in by], "reference_count", "num_references").groupBy(*by).agg(
        F.count("*").alias("work_count"), F.count_if(F.col("reference_count") != 0).alias("has_references_claimed"), F.count_if(F.col("num_references") != 0).alias("has_references_open")
    )
    return with_open_share(out)


def with_open_share(counts: DataFrame) -> DataFrame:
    claimed, opened = ("has_references_claimed", "has_references_open") if "work_count" in counts.columns else REFERENCE_COUNTS
    return counts.withColumn("p_open", percentage(F.col(opened), F.col(claimed)))


def regroup(counts: DataFrame, by: list[str]) -> DataFrame:
    """Group counts summed up to fewer or other keys."""
    names = WORK_COUNTS if "work_count" in counts.columns else REFERENCE_COUNTS
    return with_open_share(counts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in names]))


def reference_counts(summaries: DataFrame, by: list[str]) -> DataFrame:
    """References claimed and open per group, with the open share in per cent."""
    out = summaries.select(*[key(c) for c in by], "reference_count", "num_references").groupBy(*by).agg(
        F.coalesce(F.sum("reference_count"), F.lit(0)).alias("references_claimed"), F.coalesce(F.sum("num_references"), F.lit(0)).alias("references_open")
    )
    return with_open_share(out)


def counts_from_profile(long: DataFrame, by: list[str]) -> DataFrame:
    """The work counts from a long profile grouped by `by`: rows of the DOI column joined with non-zero counts of the others."""
    works = long.where("column_name = 'doi'").groupBy(*by).agg(F.sum("count").alias("work_count"))
    sides = long.where("column_name in ('reference_count', 'num_references')").groupBy(*by).agg(
        F.sum(F.when(F.col("column_name") == "reference_count", F.col("count_non_zero"))).alias("has_references_claimed"),
        F.sum(F.when(F.col("column_name") == "num_references", F.col("count_non_zero"))).alias("has_references_open"),
    )
    return with_open_share(works.join(sides, by, "full_outer").fillna(0, WORK_COUNTS))


def top(counts: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """The k largest rows, ties in key order."""
    return counts.orderBy(F.col(by).desc(), *ties).limit(k)


def collapse_type(counts: DataFrame, kept: str) -> DataFrame:
    """Every type but `kept` becomes `non-` + `kept`."""
    return counts.withColumn("type", F.when(F.col("type").eqNullSafe(kept), F.lit(kept)).otherwise(f"non-{kept}"))


def merge_names(counts: DataFrame, part: str, label: str, column: str = "publisher") -> DataFrame:
    """Names that contain `part`, whatever the case, become `label`."""
    return counts.withColumn(column, F.when(contains_ignoring_case(F.col(column), part), F.lit(label)).otherwise(F.col(column)))


def of_top_publishers(counts: DataFrame, k: int = 5) -> DataFrame:
    """The rows of the k publishers with most works."""
    best = counts.groupBy("publisher").agg(F.sum("work_count").alias("_n")).orderBy(F.col("_n").desc(), "publisher").limit(k)
    return counts.join(F.broadcast(best.select("publisher")), "publisher", "left_semi")  # k rows


def overall(summaries: DataFrame) -> DataFrame:
    """One row: works in all, with claimed and open references, per cent open."""
    return summaries.agg(
        F.count("*").alias("n_works"), F.count_if(F.col("reference_count") != 0).alias("n_claimed"), F.count_if(F.col("has_references") != 0).alias("n_open")
    ).withColumn("p_open", percentage(F.col("n_open"), F.col("n_claimed")))


def overall_references(summaries: DataFrame) -> DataFrame:
    """One row: references claimed, open, with and without DOI, repeated DOIs, per cent open."""
    s = summaries.agg(*[F.sum(c).alias(c) for c in ("reference_count", "num_references", "num_citations_without_doi", "num_duplicate_citation_dois")])
    return s.select(
        F.col("reference_count").alias("claimed"), F.col("num_references").alias("open"), (F.col("num_references") - F.col("num_citations_without_doi")).alias("with_doi"),
        F.col("num_citations_without_doi").alias("without_doi"), F.col("num_duplicate_citation_dois").alias("duplicates"),
        percentage(F.col("num_references"), F.col("reference_count")).alias("p_open"),
    )


def closed_share(summaries: DataFrame, column: str) -> DataFrame:
    """Closed works per value (at least one), all works of the value, and the share; a NULL value has no row."""
    return summaries.where(F.col(column).isNotNull()).groupBy(column).agg(F.count_if(closed()).alias("n_closed"), F.count("*").alias("n_works")).where("n_closed > 0").withColumn("ratio", F.col("n_closed") / F.col("n_works"))


def closed_share_joined(typed: DataFrame, name: str, least: int = 0, how: str = "inner", most: int | None = None) -> DataFrame:
    """The same from typed counts: closed counts over `least`, the `most` largest of them, joined with totals by key."""
    shut = typed.where((F.col("type") == f"non_oa_ref_{name}") & (F.col("count") > least)).select("key", F.col("count").alias("n_closed"))
    if most is not None:
        shut = top(shut, "n_closed", most, "key")
    total = typed.where(F.col("type") == f"total_{name}").select("key", F.col("count").alias("n_works"))
    joined = shut.join(total.withColumnRenamed("key", "_key"), F.col("key").eqNullSafe(F.col("_key")), how).drop("_key")
    return joined.withColumn("ratio", F.col("n_closed") / F.col("n_works"))


def sentences(counts: DataFrame, label: str) -> DataFrame:
    """A sentence per group that claims references."""
    text = F.format_string("%s: %,d works say they cite others; the references of %,d can be read, %.2f%% of them.", F.col(label), F.col("has_references_claimed"), F.col("has_references_open"), F.col("p_open"))
    return counts.where("has_references_claimed > 0").select(label, text.alias("sentence"))


def grouped_equals_ungrouped(summaries: DataFrame) -> DataFrame:
    """One row: do the sums over groups equal the sums over all works?"""
    grouped = reference_counts(summaries, ["type", "publisher"]).agg(F.sum("references_claimed").alias("g_claimed"), F.sum("references_open").alias("g_open"))
    whole = summaries.agg(F.coalesce(F.sum("reference_count"), F.lit(0)).alias("claimed"), F.coalesce(F.sum("num_references"), F.lit(0)).alias("open"))
    both = grouped.crossJoin(F.broadcast(whole))  # one row each
    return both.select("claimed", "open", ((F.col("g_claimed") == F.col("claimed")) & (F.col("g_open") == F.col("open"))).alias("equal"))
