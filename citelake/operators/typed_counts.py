"""Counts per type and key with the first examples of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from citelake.functions.text import populated_keys, year_of

# Labels as they are in published files, misspelling included.
SIMPLE = ["publisher", "countainer_title", "first_subject_area", "created"]


def closed() -> Column:
    """Of a summary: references are claimed but not there."""
    return F.coalesce((F.col("reference_count") > 0) & (F.col("has_references") == 0), F.lit(False))


def summary_keys(summaries: DataFrame) -> DataFrame:
    """`(type, key, example)`: publisher, container title, first subject and creation year of every work, and again for closed works."""
    values = [F.col("publisher"), F.col("container_title"), F.col("first_subject_area"), year_of(F.col("created")).cast("string")]
    total = [F.struct(F.lit(f"total_{n}").alias("type"), v.alias("key")) for n, v in zip(SIMPLE, values, strict=True)]
    shut = [F.struct(F.lit(f"non_oa_ref_{n}").alias("type"), v.alias("key")) for n, v in zip(SIMPLE, values, strict=True)]
    pairs = F.when(closed(), F.array(*total, *shut)).otherwise(F.array(*total))
    return summaries.select(F.col("doi").alias("example"), F.inline(pairs)).select("type", "key", "example")


def reference_keys(works: DataFrame, references: Column) -> DataFrame:
    """`(type, key, example)` for each of the given references of a work: its combination of populated keys, and its year."""
    each = works.select("doi", F.posexplode(references).alias("pos", "ref"))
    example = F.struct(F.col("doi").alias("doi"), F.col("pos").alias("pos"), F.to_json("ref").alias("reference"))
    pairs = F.array(F.struct(F.lit("key_combination").alias("type"), populated_keys(F.col("ref")).alias("key")), F.struct(F.lit("year").alias("type"), F.col("ref")["year"].alias("key")))
    return each.select(example.alias("example"), F.inline(pairs)).select("type", "key", "example")


def key_counts(keyed: DataFrame) -> DataFrame:
    """`(type, key, count)`, without examples: one combined aggregation."""
    return keyed.groupBy("type", "key").agg(F.count("*").alias("count"))


def typed_counts(keyed: DataFrame, limit: int = 10) -> DataFrame:
    """`(type, key, count, examples)`, `examples` the `limit` smallest examples in order; a NULL key is a key.

    Counts and examples are two branches: counts combine before the shuffle, and the rank filter keeps at most `limit`
    rows of a key per task before it.
    """
    counts = key_counts(keyed)
    ranked = keyed.withColumn("_rank", F.row_number().over(Window.partitionBy("type", "key").orderBy("example"))).where(F.col("_rank") <= limit)
    examples = ranked.groupBy("type", "key").agg(F.transform(F.sort_array(F.collect_list(F.struct("_rank", "example"))), lambda x: x["example"]).alias("examples"))
    match = (F.col("c.type") == F.col("e.type")) & F.col("c.key").eqNullSafe(F.col("e.key"))
    return counts.alias("c").join(examples.alias("e"), match).select("c.type", "c.key", "c.count", "e.examples")


def in_order(counts: DataFrame) -> DataFrame:
    """By type, most frequent first, ties by key."""
    return counts.orderBy("type", F.col("count").desc(), "key")


def to_file(counts: DataFrame) -> DataFrame:
    """Typed counts as they are written: examples as a JSON list of texts, or of pairs of DOI and reference."""
    if isinstance(counts.schema["examples"].dataType.elementType, T.StructType):
        # An array of one text is that text as JSON between brackets.
        quoted = lambda c: F.coalesce(F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1), F.lit("null"))
        pairs = F.transform("examples", lambda e: F.concat(F.lit("["), quoted(e["doi"]), F.lit(", "), e["reference"], F.lit("]")))
        return counts.withColumn("examples", F.concat(F.lit("["), F.array_join(pairs, ", "), F.lit("]")))
    return counts.withColumn("examples", F.to_json("examples", {"ignoreNullFields": "false"}))


def from_file(rows: DataFrame) -> DataFrame:
    """Typed counts as they were written (all text): `(type, key, count, examples, without_source)`, most frequent first.

    `without_source` has the second element of every example: the reference of a pair; of a text, as when a text is indexed, its
    second character. An empty key stands for NULL and for ''.
    """
    parsed = F.try_variant_get(F.try_parse_json("examples"), "$", "array<variant>")
    text = lambda e: F.try_variant_get(e, "$", "string")
    second = F.transform(parsed, lambda e: F.when(F.schema_of_variant(e) == "STRING", F.substring(text(e), 2, 1)).otherwise(F.to_json(F.try_variant_get(e, "$[1]", "variant"))))
    out = rows.select("type", F.coalesce("key", F.lit("")).alias("key"), F.col("count").cast("bigint").alias("count"), "examples", second.alias("without_source"))
    return out.orderBy(F.col("count").desc(), "type", "key")
