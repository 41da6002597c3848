"""Works: from pages of JSON, and a view of the driver's order tables with the same columns.

Columns: member, doi, title, publisher, container_title, type, reference_count, referenced_by_count, created, authors
(array of VARIANT), subjects (array of text), references (array of text maps; NULL where the key is missing or null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citelake.functions.text import elements, list_or_scalar, plain_text

REFERENCE = "map<string,string>"


def pages_to_works(pages: DataFrame, *, quarantine: bool = False) -> DataFrame:
    """The works of pages `(member, content)`. A page that is no JSON raises, or is left out with `quarantine` (see `broken_pages`).

    A single author, subject or reference in place of a list is a list of one; authors and references given as JSON text count as
    what it holds. Every author counts. Null and blank references are left out; one that is no object has no keys. Null and blank
    works are left out.
    """
    parse = F.try_parse_json if quarantine else F.parse_json
    w = F.col("w")
    works = pages.select("member", F.explode(elements(parse(F.col("content")), "$.message.items")).alias("w"))
    filled = F.filter(elements(w, "$.reference", True), lambda r: (F.schema_of_variant(r) != "VOID") & F.coalesce(plain_text(r), F.lit("x")).rlike(r"\S"))
    return works.where(F.schema_of_variant(w).startswith("OBJECT") & (F.to_json(w) != "{}")).select(
        "member",
        F.try_variant_get(w, "$.DOI", "string").alias("doi"),
        list_or_scalar(w, "$.title").alias("title"),
        list_or_scalar(w, "$.publisher").alias("publisher"),
        list_or_scalar(w, '$["container-title"]').alias("container_title"),
        F.try_variant_get(w, "$.type", "string").alias("type"),
        F.try_variant_get(w, '$["reference-count"]', "bigint").alias("reference_count"),
        F.try_variant_get(w, '$["is-referenced-by-count"]', "bigint").alias("referenced_by_count"),
        F.try_variant_get(w, '$.created["date-time"]', "string").alias("created"),
        elements(w, "$.author", True).alias("authors"),
        F.transform(elements(w, "$.subject"), plain_text).alias("subjects"),
        F.transform(filled, lambda r: F.coalesce(F.from_json(F.to_json(r), REFERENCE), F.create_map().cast(REFERENCE))).alias("references"),
    )


def broken_pages(pages: DataFrame) -> DataFrame:
    """The pages that are no complete JSON, as they are."""
    return pages.where(F.col("content").isNotNull() & F.try_parse_json(F.col("content")).isNull())


def orders_as_works(orders: DataFrame, lineitem: DataFrame, customer: DataFrame) -> DataFrame:
    """An order as a work, its line items as references: a DOI per part, none for returned ones. DOIs are written dirtily, to be cleaned."""
    # Only what the references are made of is shuffled; the maps are made after.
    narrow = F.struct("l_linenumber", F.when(F.col("l_returnflag") != "R", F.col("l_partkey")).alias("part"), F.year("l_shipdate").alias("year"), (F.col("l_linestatus") == "F").alias("f"))
    refs = lineitem.select("l_orderkey", narrow.alias("r")).groupBy("l_orderkey").agg(F.sort_array(F.collect_list("r")).alias("lines"))

    def reference(x):
        doi = F.concat(F.lit(' "10.5555/p'), x["part"].cast("string"), F.lit('"\n'))
        values = F.array(F.concat(F.lit("ref"), x["l_linenumber"].cast("string")), doi, x["year"].cast("string"), F.when(x["f"], "text").otherwise(""))
        return F.map_from_arrays(F.array(F.lit("key"), F.lit("DOI"), F.lit("year"), F.lit("unstructured")), values)

    refs = refs.select("l_orderkey", F.transform("lines", reference).alias("references"))
    segment = customer.select("c_custkey", "c_mktsegment")
    o = orders.join(refs, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(segment, F.col("o_custkey") == F.col("c_custkey"), "left")
    return o.select(
        F.concat(F.lit("orders-"), (F.col("o_orderkey") % 16).cast("string")).alias("member"),
        F.concat(F.lit(' "10.5555/'), F.col("o_orderkey").cast("string"), F.lit('"\n')).alias("doi"),
        F.concat(F.lit("Order\t"), F.col("o_orderkey").cast("string"), F.lit("  for\n"), F.col("o_custkey").cast("string")).alias("title"),
        F.col("o_orderpriority").alias("publisher"),
        F.col("c_mktsegment").alias("container_title"),
        F.col("o_orderstatus").alias("type"),
        (F.col("o_orderkey") % 7).alias("reference_count"),
        (F.col("o_orderkey") % 11).alias("referenced_by_count"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created"),
        F.when(F.col("o_orderkey") % 5 != 0, F.array_repeat(F.parse_json(F.lit("{}")), (F.col("o_orderkey") % 4).cast("int"))).alias("authors"),
        F.when(F.col("o_orderkey") % 3 != 0, F.array(F.col("o_orderstatus"), F.col("o_orderpriority"))).alias("subjects"),
        "references",
    )
