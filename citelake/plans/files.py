"""Queries through files: what is written and read back is compared with the tables it came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.operators import ordered
from citelake.plans.tables import table
from citelake.session import hadoop_path, scratch_path
from citelake.sources import delimited, zip_pages

COLUMNS = {"row_id": "bigint", "doi": "string", "title": "string", "reference_count": "bigint", "created": "string", "publisher": "string", "has_references": "int", "received_at": "timestamp_ntz"}


def _summaries(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "crossref_works_summaries").select(*COLUMNS)


def _path(s: SparkSession, name: str) -> str:
    folder = scratch_path(s, "file")
    fs, path = hadoop_path(s, folder)
    fs.mkdirs(path)
    return f"{folder}/{name}"


def delimited_gzip_crlf(s, d):
    path = _path(s, "summaries.tsv.gz")
    delimited.write_delimited(_summaries(s, d), path, crlf=True)
    return delimited.read_delimited(s, path, types=COLUMNS, partitions=8, multi_line=True)


def delimited_headerless(s, d):
    path = _path(s, "lines.csv")
    rows = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    delimited.delimited_lines(rows, ",").write.text(path)
    return delimited.read_delimited(s, path, header=False, types={"0": "bigint", "1": "int", "2": "double"}).toDF(*rows.columns)


def sort_unique_in_place(s, d):
    path = _path(s, "flags.tsv.gz")
    delimited.write_delimited(table(s, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"), path)
    delimited.replace_with_backup(ordered.sort_unique(delimited.read_delimited(s, path)), path)
    return delimited.read_delimited(s, path)


def typed_export(s, d):
    path = _path(s, "typed")
    delimited.write_typed(_summaries(s, d).drop("received_at").withColumn("debug", F.lit("[]")), path)
    return s.read.parquet(path)


def typed_links_export(s, d):
    path = _path(s, "links")
    delimited.write_typed_links(table(s, d, "crossref_works_citations"), path)
    return s.read.parquet(path)


def fan_out(s, d):
    first = delimited.fan_out(table(s, d, "orders"), lambda df: df.where("o_orderstatus = 'F'").count(), lambda df: df.where("o_orderstatus <> 'F'").count())
    return s.createDataFrame([tuple(first)], "n_filled bigint, n_open bigint")


def zip_round_trip(s, d):
    path = _path(s, "pages.zip").removeprefix("file:")
    zip_pages.append_to_zip(table(s, d, "works_pages"), path, "deflate")
    return zip_pages.read_zip(s, path)


_NAMES = "delimited_gzip_crlf delimited_headerless sort_unique_in_place typed_export typed_links_export fan_out zip_round_trip"
QUERIES = {name: globals()[name] for name in _NAMES.split()}
# The reader takes CRLF for a line feed, inside quotes too, and an empty field for NULL.
_LINE_FEEDS = "replace(nullif({c}, ''), chr(13) || chr(10), chr(10)) AS {c}"
ORACLES = {
    "delimited_gzip_crlf": f"SELECT {', '.join(_LINE_FEEDS.format(c=c) if t == 'string' else c for c, t in COLUMNS.items())} FROM crossref_works_summaries",
    "delimited_headerless": "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
    "sort_unique_in_place": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber::VARCHAR AS l_linenumber, l_suppkey::VARCHAR AS l_suppkey FROM lineitem",
    "typed_export": """SELECT row_id, doi, title, reference_count, created::TIMESTAMP AS created, publisher, has_references::BOOLEAN AS has_references, '[]' AS "references"
    FROM crossref_works_summaries""",
    "typed_links_export": "SELECT citing_doi, cited_doi FROM crossref_works_citations WHERE cited_doi IS NOT NULL",
    "fan_out": "SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS n_filled, count(*) FILTER (WHERE o_orderstatus <> 'F') AS n_open FROM orders",
    "zip_round_trip": "SELECT member, content FROM works_pages",
}
