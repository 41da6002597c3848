"""Command line: `python -m citelake.cli COMMAND ...`, one command per stage."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citelake.operators import citations, doi_quality, ordered, profile, summaries, typed_counts
from citelake.plans.works import pages_to_works
from citelake.session import build_session
from citelake.sources.delimited import fan_out, read_delimited, replace_with_backup, write_delimited, write_delimited_dir, write_typed, write_typed_links
from citelake.sources.zip_pages import append_to_zip, read_zip
from citelake.streaming.incremental import land_pages, page_stream


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="citelake", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, **arguments: str) -> argparse.ArgumentParser:
        c = commands.add_parser(name, help=text, description=text)
        for argument, what in arguments.items():
            c.add_argument(f"--{argument.replace('_', '-')}", required=True, help=what)
        return c

    def delimiter(c: argparse.ArgumentParser) -> None:
        c.add_argument("--delimiter", help="of the delimited files; by default a tab where the name has .tsv, else a comma")

    c = command("download-works", "pages of a cursor-paged interface into parquet, and a zip archive if named", base_url="", output="folder of the parquet pages", checkpoint="")
    c.add_argument("--zip")
    c.add_argument("--compression", choices=["deflate", "bzip2", "lzma"], default="deflate")
    c.add_argument("--batch-size", type=int, default=1000)
    c.add_argument("--max-retries", type=int, default=10)
    c.add_argument("--email")
    c.add_argument("--debug", action="store_true", help="log more")
    for name, text in (("extract-summaries", "one row per work"), ("extract-citations", "citing to cited links")):
        c = command(name, text, input_file="zip of pages", output_file="")
        delimiter(c)
        c.add_argument("--no-clean-dois", action="store_true")
        c.add_argument("--provenance", action="store_true")
        c.add_argument("--debug", action="store_true", help="add the references without a DOI")
        if name == "extract-citations":
            c.add_argument("--empty-link", action="store_true")
            c.add_argument("--columns", help="comma-separated subset of the columns")
        else:
            c.add_argument("--dedupe", action="store_true", help="one row per DOI, over all works")
            c.add_argument("--clean-window-size", type=int, default=0, help="drop works whose DOI is among this many kept before, in page order (serial)")
            c.add_argument("--sort", action="store_true")
    c = command("csv-stats", "statistics per column", input_file="", output_file="")
    delimiter(c)
    c.add_argument("--no-header", action="store_true")
    c.add_argument("--group-by", default="")
    c = command("reference-stats", "typed counts of works and their references without a DOI", input_file="summaries with the debug column", output_file="")
    delimiter(c)
    c.add_argument("--examples", type=int, default=10)
    c.add_argument("--save-failing-df", help="where rows go that can't be read, before the command fails")
    c = command("doi-cleaning-stats", "a profile, corrections beyond case, and unmatched DOIs of cleaned citations, from one scan", input_file="", stats_file="", corrected_file="", unmatched_file="")
    delimiter(c)
    c = command("export-typed", "summaries or citations as typed parquet for a warehouse", input_file="", output="folder")
    c.add_argument("--kind", choices=["summaries", "citations"], required=True)
    delimiter(c)
    c = command("number-dois", "distinct DOIs with numbers from 0", input_file="", output_file="")
    delimiter(c)
    c = command("sort-unique", "sort a gzip file and drop repeated rows, in place", input_file="")
    delimiter(c)
    for c in commands.choices.values():
        if any(x.dest == "output_file" for x in c._actions):
            c.add_argument("--parts", action="store_true", help="write a folder of files in parallel instead of one file")
    return top


def failing(rows: DataFrame) -> DataFrame:
    """Summary rows (all text) whose counts, time or debug column can't be read."""
    bad = F.lit(False)
    for c, kind in (("reference_count", "bigint"), ("has_references", "bigint"), ("created", "timestamp")):
        bad = bad | (F.coalesce(c, F.lit("")) != "") & F.col(c).try_cast(kind).isNull()
    return rows.where(bad | ((F.coalesce("debug", F.lit("")) != "") & F.try_parse_json("debug").isNull()))


def reference_stats(rows: DataFrame, examples: int = 10) -> DataFrame:
    """Typed counts as they are written, from summary rows (all text) with their debug column."""
    typed = rows.withColumns({c: F.col(c).cast("bigint") for c in ("reference_count", "has_references")})
    counts = typed_counts.to_file(typed_counts.typed_counts(typed_counts.summary_keys(typed), examples))
    bare = typed_counts.reference_keys(typed, F.from_json("debug", "array<map<string,string>>"))
    return typed_counts.in_order(counts.unionByName(typed_counts.to_file(typed_counts.typed_counts(bare, examples))))


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = build_session()

    def write(df: DataFrame, path: str) -> None:
        (write_delimited_dir if getattr(a, "parts", False) else write_delimited)(df, path, sep=a.delimiter)

    if a.command == "download-works":
        logging.basicConfig(level="DEBUG" if a.debug else "INFO")
        options = {"rows": a.batch_size, "maxRetries": a.max_retries} | ({"email": a.email} if a.email else {})
        query = land_pages(page_stream(spark, a.base_url, **options), a.output, a.checkpoint)
        query.processAllAvailable()
        query.stop()
        if a.zip:
            append_to_zip(spark.read.parquet(a.output).orderBy("member"), a.zip, a.compression)
    elif a.command == "extract-summaries":
        works = pages_to_works(read_zip(spark, a.input_file))
        out = summaries.summarise(works, clean_dois=not a.no_clean_dois, provenance=a.provenance, debug=a.debug, dedupe=a.dedupe)
        if a.clean_window_size:
            out = ordered.windowed(out.withColumn("_n", F.monotonically_increasing_id()), order="_n", key="doi", size=a.clean_window_size, sort=False).drop("_n", "_place")
        write(out.orderBy("doi") if a.sort else out, a.output_file)
    elif a.command == "extract-citations":
        works = pages_to_works(read_zip(spark, a.input_file))
        columns = [c.strip() for c in a.columns.split(",")] if a.columns else None
        write(citations.citation_links(works, clean_dois=not a.no_clean_dois, empty_link=a.empty_link, provenance=a.provenance, debug=a.debug, columns=columns), a.output_file)
    elif a.command == "csv-stats":
        by = [c.strip() for c in a.group_by.split(",") if c.strip()]
        if by and a.no_header:
            raise SystemExit("--group-by needs a header")
        write(profile.profile(read_delimited(spark, a.input_file, header=not a.no_header, sep=a.delimiter), by), a.output_file)
    elif a.command == "reference-stats":
        rows = read_delimited(spark, a.input_file, sep=a.delimiter)
        if not (bad := failing(rows)).isEmpty():
            if a.save_failing_df:
                write_delimited(bad, a.save_failing_df, sep=a.delimiter)
            raise SystemExit("some rows can't be read" + (f"; they are in {a.save_failing_df}" if a.save_failing_df else "; name a file for them by --save-failing-df"))
        write(reference_stats(rows, a.examples), a.output_file)
    elif a.command == "doi-cleaning-stats":
        fan_out(
            doi_quality.with_case_flag(read_delimited(spark, a.input_file, sep=a.delimiter)),
            lambda df: write_delimited(df.where(F.col(doi_quality.FLAG) == 0), a.corrected_file, sep=a.delimiter),
            lambda df: write_delimited(doi_quality.unmatched(df), a.unmatched_file, sep=a.delimiter),
            lambda df: write_delimited(profile.profile(df), a.stats_file, sep=a.delimiter),
        )
    elif a.command == "export-typed":
        rows = read_delimited(spark, a.input_file, sep=a.delimiter)
        (write_typed if a.kind == "summaries" else write_typed_links)(rows, a.output)
    elif a.command == "number-dois":
        write(ordered.doi_dictionary(read_delimited(spark, a.input_file, sep=a.delimiter), ["citing_doi", "cited_doi"]), a.output_file)
    else:
        replace_with_backup(ordered.sort_unique(read_delimited(spark, a.input_file, sep=a.delimiter)), a.input_file, sep=a.delimiter)
    return 0


if __name__ == "__main__":
    sys.exit(main())
