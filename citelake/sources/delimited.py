"""Delimited files: reading with all-text or declared columns, and writing one file as spreadsheet tools expect it.

Paths are Hadoop paths: a local folder on one machine, any file system the cluster has otherwise.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.session import hadoop_path


def separator(path: str) -> str:
    """Tab where the name has `.tsv`, else comma."""
    return "\t" if ".tsv" in os.path.basename(path) else ","


def read_delimited(
    spark: SparkSession, path: str, *, header: bool = True, sep: str | None = None, types: dict[str, str] | None = None, columns: list[str] | None = None,
    partitions: int | None = None, multi_line: bool = False,
) -> DataFrame:
    """A delimited file (also gzip) or a folder of them, all columns text but those in `types`; an empty field is NULL.

    Lines may end in CRLF; a CRLF inside quotes is then read as a line feed.

    Without a header, columns are named `0`, `1`, ... unless `columns` names them. Large files are read in splits; with
    `multi_line`, for line feeds inside quotes, a file is one split. So is a gzip file: `partitions` spreads its rows.
    """
    options = {"sep": sep or separator(path), "header": str(header).lower(), "quote": '"', "escape": '"', "multiLine": str(multi_line).lower(), "mode": "FAILFAST", "inferSchema": "false"}
    df = spark.read.options(**options).csv(path)
    if not header:
        df = df.toDF(*(columns or [str(i) for i in range(len(df.columns))]))
    elif columns:
        df = df.toDF(*columns)
    df = df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in (types or {}).items()})
    return df.repartition(partitions) if partitions else df


def _field(c: Column, sep: str) -> Column:
    """A value as it is written: quoted where it holds a separator, a quote or a line end; nothing for NULL."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.contains(sep) | text.contains('"') | text.contains("\n") | text.contains("\r"), quoted).otherwise(text)


def delimited_lines(df: DataFrame, sep: str) -> DataFrame:
    """One text column `line`; a lone empty field is written as `""`, so no line is blank."""
    line = F.concat_ws(sep, *[_field(F.col(f"`{c}`"), sep) for c in df.columns])
    return df.select((F.when(line == "", F.lit('""')).otherwise(line) if len(df.columns) == 1 else line).alias("line"))


def write_delimited_dir(df: DataFrame, path: str, sep: str | None = None) -> None:
    """A folder of delimited files with headers, written in parallel; the form for large results."""
    writer = df.write.mode("overwrite").options(
        sep=sep or separator(path), header="true", quote='"', escape='"', emptyValue="", nullValue="", lineSep="\n", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    )
    (writer.option("compression", "gzip") if path.endswith(".gz") else writer).csv(path)


def write_delimited(df: DataFrame, path: str, *, crlf: bool = False, sep: str | None = None) -> None:
    """One delimited file with a header, gzip by suffix `.gz`, in the order of the rows.

    Tasks write (and compress) parts in parallel; the parts are then put behind one another byte by byte, which is valid for
    gzip too, and the file is renamed into place, so a reader never sees half of it. With `crlf` records end in CRLF; line feeds
    inside fields stay.
    """
    spark, sep, zipped = df.sparkSession, sep or separator(path), path.endswith(".gz")
    fs, target = hadoop_path(spark, path)
    fs.mkdirs(target.getParent())
    folder, beside = f"{path}.parts", hadoop_path(spark, f"{path}.part")[1]
    options = {"lineSep": "\r\n" if crlf else "\n"} | ({"compression": "gzip"} if zipped else {})
    head = spark.createDataFrame([tuple(df.columns)], ", ".join(f"c{i} string" for i in range(len(df.columns))))
    out = fs.create(beside, True)
    try:
        for part, rows in (("head", head), ("rows", df)):
            delimited_lines(rows, sep).write.mode("overwrite").options(**options).text(f"{folder}/{part}")
            names = sorted(s.getPath().toString() for s in fs.listStatus(hadoop_path(spark, f"{folder}/{part}")[1]) if s.getPath().getName().startswith("part-"))
            for name in names:
                with_part = fs.open(hadoop_path(spark, name)[1])
                spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(with_part, out, 1 << 20, False)
                with_part.close()
    finally:
        out.close()
        fs.delete(hadoop_path(spark, folder)[1], True)
    fs.delete(target, False)
    if not fs.rename(beside, target):
        raise OSError(f"cannot rename to {path}")


def replace_with_backup(df: DataFrame, path: str, sep: str | None = None) -> None:
    """Replace a gzip file in place, keeping the old one as `.backup`; refuses other files, missing ones, and to overwrite a backup."""
    fs, target = hadoop_path(df.sparkSession, path)
    backup = hadoop_path(df.sparkSession, f"{path}.backup")[1]
    if not path.endswith(".gz"):
        raise ValueError(f"{path} is no .gz file")
    if not fs.exists(target):
        raise FileNotFoundError(path)
    if fs.exists(backup):
        raise FileExistsError(f"{path}.backup")
    new = hadoop_path(df.sparkSession, os.path.join(os.path.dirname(path), f"new-{os.path.basename(path)}"))[1]
    write_delimited(df, new.toString(), sep=sep or separator(path))
    if not (fs.rename(target, backup) and fs.rename(new, target)):
        raise OSError(f"cannot rename to {path}")


def write_typed(summaries: DataFrame, path: str) -> None:
    """Summaries for a warehouse: parquet with whole numbers, a timestamp, booleans and the debug column as `references`."""
    counts = [c for c in summaries.columns if c in ("reference_count", "referenced_by_count", "author_count") or c.startswith("num_")]
    typed = {c: F.col(c).cast("bigint") for c in counts} | {"created": F.to_timestamp("created"), "has_references": F.col("has_references").cast("int").cast("boolean")}
    summaries.withColumns(typed).withColumnRenamed("debug", "references").write.mode("overwrite").parquet(path)


def write_typed_links(links: DataFrame, path: str) -> None:
    """Citation links for a warehouse: parquet with the two DOIs only, links without a cited DOI left out."""
    links.where("cited_doi is not null").select("citing_doi", "cited_doi").write.mode("overwrite").parquet(path)


def fan_out(df: DataFrame, *consumers: Callable[[DataFrame], object]) -> list:
    """Several results from one scan: the rows are kept (spilling to disk) while the consumers run."""
    kept = df.persist()
    try:
        return [consume(kept) for consume in consumers]
    finally:
        kept.unpersist()


def split_corrupt(df_text: DataFrame, schema: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON lines parsed to `schema`, and the lines that don't parse, to be put aside."""
    parsed = df_text.withColumn("_parsed", F.from_json(F.col(column), f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    good = parsed.where("_parsed._corrupt is null").select("_parsed.*").drop("_corrupt")
    return good, parsed.where("_parsed._corrupt is not null").select(column)
