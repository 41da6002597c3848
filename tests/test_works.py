"""The hand-written corpus: pages to works, summaries, links, counts, profile, command line."""

import csv
import gzip
import json

import pytest
from pyspark.sql import functions as F

from citelake import cli
from citelake.operators import citations, doi_quality, profile, summaries, typed_counts
from citelake.operators.refs import references_without_doi
from citelake.plans.works import broken_pages, pages_to_works
from citelake.sources import delimited, zip_pages

WORKS = [
    {
        "DOI": " 10.5555/A\n", "title": ["A\ttitle", "part  two"], "publisher": "Pub One", "container-title": ["J1"], "type": "journal-article", "reference-count": 3,
        "is-referenced-by-count": 5, "created": {"date-time": "2018-03-01T00:00:00Z"}, "author": [{}, {}], "subject": ["Bio", "Chem"],
        "reference": [{"DOI": "10.5555/b", "year": "2001"}, {"DOI": '10.5555/"b', "key": "k"}, {"key": "k3", "year": "1999", "unstructured": ""}],
    },
    {"DOI": "10.5555/c", "type": "book", "publisher": "Other Press", "reference-count": 7, "created": {"date-time": "2019-12-31T23:30:00Z"}},
    {"DOI": "10.5555/d", "reference-count": 0, "reference": []},
    {"DOI": "10.5555/e", "title": "[scalar]", "author": [], "reference-count": 3, "reference": [{"DOI": ""}, {"DOI": None}, {"DOI": "  "}]},
]


def page(works):
    return json.dumps({"status": "ok", "message": {"next-cursor": "n", "total-results": len(works), "items": works}})


@pytest.fixture(scope="module")
def works(spark):
    return pages_to_works(spark.createDataFrame([("p0", page(WORKS))], "member string, content string"))


def test_summaries(works):
    rows = {r["doi"]: r for r in summaries.summarise(works, provenance=True, debug=True).collect()}
    expected = {
        "10.5555/A": ("A title part two", 2, "Bio|Chem", 1, 3, 1, 1, '["10.5555/b"]'),
        "10.5555/c": (None, None, "", 0, 0, 0, 0, "[]"),
        "10.5555/d": (None, None, "", 1, 0, 0, 0, "[]"),
        "10.5555/e": ("[scalar]", 0, "", 1, 3, 3, 0, "[]"),
    }
    names = ["title", "author_count", "subject_areas", "has_references", "num_references", "num_citations_without_doi", "num_duplicate_citation_dois", "cited_dois"]
    assert {d: tuple(r[n] for n in names) for d, r in rows.items()} == expected
    assert rows["10.5555/A"]["first_subject_area"] == "Bio" and rows["10.5555/A"]["provenance"] == "p0"
    assert json.loads(rows["10.5555/A"]["debug"]) == [{"key": "k3", "year": "1999", "unstructured": ""}]
    assert summaries.summarise(works).columns == summaries.COLUMNS


def test_duplicates_stay_unless_asked(spark):
    twice = pages_to_works(spark.createDataFrame([("p0", page(WORKS)), ("p1", page(WORKS[:1]))], "member string, content string"))
    assert summaries.summarise(twice).count() == 5
    assert summaries.summarise(twice, dedupe=True).count() == 4


def test_missing_doi(spark):
    none = pages_to_works(spark.createDataFrame([("p", page([{"title": "x", "reference": None}]))], "member string, content string"))
    with pytest.raises(Exception, match="work without a DOI"):
        summaries.summarise(none).collect()
    assert summaries.summarise(none, strict=False).first()["has_references"] == 0
    assert citations.citation_links(none, empty_link=True).first()["citing_doi"] is None


def test_links(works):
    assert [tuple(r) for r in citations.citation_links(works, columns=["citing_doi", "cited_doi"]).collect()] == [("10.5555/A", "10.5555/b")]
    rows = citations.citation_links(works, debug=True, provenance=True).collect()
    assert len(rows) == 5 and sum(r["cited_doi"] is None for r in rows) == 4
    assert all((r["num_references"] is None) == (r["cited_doi"] is not None) for r in rows)


def test_uncleaned_dois(works):
    row = citations.citation_arrays(works, clean_dois=False).where("citing_doi like '%A%'").first()
    assert row["citing_doi"] == " 10.5555/A\n" and row["cited_dois"] == ['10.5555/"b', "10.5555/b"]


def test_broken_page_raises_or_is_put_aside(spark):
    pages = spark.createDataFrame([("p0", page(WORKS)), ("p1", '{"message": {"items": [')], "member string, content string")
    with pytest.raises(Exception, match="MALFORMED"):
        pages_to_works(pages).collect()
    assert pages_to_works(pages, quarantine=True).count() == 4
    assert [r["member"] for r in broken_pages(pages).collect()] == ["p1"]


def test_typed_counts(spark, works):
    counts = {(r["type"], r["key"]): r for r in typed_counts.typed_counts(typed_counts.summary_keys(summaries.summarise(works))).collect()}
    assert counts["non_oa_ref_created", "2019"]["examples"] == ["10.5555/c"]
    assert counts["total_countainer_title", None]["count"] == 3
    assert {k for t, k in counts if t.startswith("non_oa")} == {"2019", "Other Press", None}
    refs = typed_counts.typed_counts(typed_counts.reference_keys(works, references_without_doi(F.col("references"))))
    got = {(r["type"], r["key"]): r["count"] for r in refs.collect()}
    assert got == {("key_combination", "key|year"): 1, ("key_combination", ""): 2, ("key_combination", "DOI"): 1, ("year", "1999"): 1, ("year", None): 3}


def test_examples_are_capped_and_ordered(spark):
    keyed = spark.range(25).selectExpr("'t' as type", "'k' as key", "lpad(id, 2, '0') as example")
    row = typed_counts.typed_counts(keyed).first()
    assert row["count"] == 25 and row["examples"] == [f"{i:02d}" for i in range(10)]


def test_profile_of_summaries(works):
    rows = {r["column_name"]: r for r in profile.profile_long(summaries.summarise(works).select("has_references", "doi")).collect()}
    has = rows["has_references"]
    assert (has["count"], has["count_numeric"], has["sum"], has["min"], has["max"], has["count_non_zero"], has["count_zero"], has["mean"], has["mean_non_zero"]) == (4, 4, 3, 0, 1, 3, 1, 0.75, 1.0)
    assert (rows["doi"]["value_type"], rows["doi"]["count_valid"], rows["doi"]["sum"]) == ("str", 4, None)


@pytest.mark.parametrize("compression", ["deflate", "bzip2", "lzma"])
def test_zip_source(spark, tmp_path, compression):
    path = str(tmp_path / "works.zip")
    pages = spark.createDataFrame([(zip_pages.member_name("works", i, i * 4), page(WORKS)) for i in range(5)], "member string, content string")
    assert zip_pages.append_to_zip(pages, path, compression) == 5
    read = zip_pages.read_zip(spark, path, members_per_task=2)
    assert read.rdd.getNumPartitions() == 3
    assert [tuple(r) for r in read.orderBy("member").collect()] == [tuple(r) for r in pages.orderBy("member").collect()]
    assert summaries.summarise(pages_to_works(read)).count() == 20


def test_command_line(spark, tmp_path):
    archive = str(tmp_path / "works.zip")
    zip_pages.append_to_zip(spark.createDataFrame([("p0", page(WORKS))], "member string, content string"), archive)
    cli.main(["extract-summaries", "--input-file", archive, "--output-file", str(tmp_path / "s.tsv.gz"), "--sort"])
    lines = gzip.open(tmp_path / "s.tsv.gz", "rt").read().splitlines()
    assert lines[0].split("\t") == summaries.COLUMNS and len(lines) == 5
    cli.main(["extract-citations", "--input-file", archive, "--output-file", str(tmp_path / "c.csv"), "--empty-link"])
    assert len((tmp_path / "c.csv").read_text().splitlines()) == 6
    cli.main(["csv-stats", "--input-file", str(tmp_path / "s.tsv.gz"), "--output-file", str(tmp_path / "stats.tsv"), "--group-by", "type"])
    assert (tmp_path / "stats.tsv").read_text().startswith("type\tstat\t")
    cli.main(["number-dois", "--input-file", str(tmp_path / "c.csv"), "--output-file", str(tmp_path / "ids.tsv")])
    assert (tmp_path / "ids.tsv").read_text().splitlines()[1] == "0\t10.5555/A"
    cli.main(["extract-summaries", "--input-file", archive, "--output-file", str(tmp_path / "d.tsv"), "--debug", "--clean-window-size", "2"])
    cli.main(["reference-stats", "--input-file", str(tmp_path / "d.tsv"), "--output-file", str(tmp_path / "r.tsv")])
    stats = [tuple(r) for r in csv.reader(open(tmp_path / "r.tsv", newline=""), delimiter="\t")]
    assert stats[0] == ("type", "key", "count", "examples")
    found = {(t, k): (int(n), json.loads(x)) for t, k, n, x in stats[1:]}
    assert found["year", "1999"] == (1, [["10.5555/A", {"key": "k3", "unstructured": "", "year": "1999"}]])
    assert found["non_oa_ref_publisher", "Other Press"] == (1, ["10.5555/c"]) and found["key_combination", ""][0] == 2
    typed = typed_counts.from_file(delimited.read_delimited(spark, str(tmp_path / "r.tsv"))).collect()
    assert [r["without_source"] for r in typed if (r["type"], r["key"]) == ("year", "1999")] == [['{"key":"k3","unstructured":"","year":"1999"}']]
    (tmp_path / "bad.tsv").write_text((tmp_path / "d.tsv").read_text().replace("\t3\t", "\tmany\t"))
    with pytest.raises(SystemExit):
        cli.main(["reference-stats", "--input-file", str(tmp_path / "bad.tsv"), "--output-file", "x", "--save-failing-df", str(tmp_path / "failing.tsv")])
    assert len((tmp_path / "failing.tsv").read_text().splitlines()) == 3
    cli.main(["export-typed", "--kind", "summaries", "--input-file", str(tmp_path / "d.tsv"), "--output", str(tmp_path / "w")])
    cli.main(["export-typed", "--kind", "citations", "--input-file", str(tmp_path / "c.csv"), "--output", str(tmp_path / "wc")])
    assert spark.read.parquet(str(tmp_path / "w")).count() == 4 and spark.read.parquet(str(tmp_path / "wc")).columns == ["citing_doi", "cited_doi"]
    cli.main(["extract-citations", "--input-file", archive, "--output-file", str(tmp_path / "c.psv"), "--empty-link", "--delimiter", "|", "--parts"])
    assert delimited.read_delimited(spark, str(tmp_path / "c.psv"), sep="|").count() == 5
    cli.main(["sort-unique", "--input-file", str(tmp_path / "s.tsv.gz")])
    assert (tmp_path / "s.tsv.gz.backup").exists()
    with pytest.raises(FileExistsError):
        delimited.replace_with_backup(spark.range(1), str(tmp_path / "s.tsv.gz"))
    with pytest.raises(SystemExit):
        cli.main(["csv-stats", "--input-file", "x", "--output-file", "y", "--group-by", "a", "--no-header"])


def test_cleaning_stage(spark, tmp_path):
    rows = [("a", "10.1/X", "10.1/x", "true", "true"), ("a", "10.1/y", "10.1/yy", "true", "true"), ("b", "", "10.1/z", "false", "false"), ("c", "10.1/w", "10.1/w", "true", "false")]
    df = spark.createDataFrame(rows, "citing_doi string, cited_doi string, original_cited_doi string, cited_doi_valid string, cited_doi_corrected string")
    delimited.write_delimited(df, str(tmp_path / "cleaned.tsv.gz"), crlf=True)
    names = {n: str(tmp_path / f"{n}.tsv") for n in ("stats", "corrected", "unmatched")}
    cli.main(["doi-cleaning-stats", "--input-file", str(tmp_path / "cleaned.tsv.gz"), *[x for n, p in names.items() for x in (f"--{n}-file", p)]])
    lines = {n: open(p).read().splitlines() for n, p in names.items()}
    assert [x.split("\t")[1] for x in lines["corrected"][1:]] == ["10.1/y"] and [x.split("\t")[2] for x in lines["unmatched"][1:]] == ["10.1/z"]
    assert "doi_corrected_equal_case_insensitve" in lines["stats"][0]
    report = doi_quality.cleaning_report(delimited.read_delimited(spark, str(tmp_path / "cleaned.tsv.gz"))).first()
    assert tuple(report) == (4, 3, 1, 2, 1)


def test_works_of_other_shapes(spark):
    """A single author, subject or reference, JSON text, nulls and blanks, as the flat tables have them."""
    items = [
        {"DOI": "a", "author": {"given": "G"}, "subject": "Bio", "reference": {"DOI": "x"}},
        {"DOI": "b", "author": json.dumps([{"given": "G"}, {}]), "reference": json.dumps([{"key": "k"}, None, " "]), "subject": ["A", None, "B"]},
        {"DOI": "c", "author": "", "subject": "", "reference": "no json"}, None, {}, "text", {"DOI": "d", "author": [None, {}], "reference": ["text", {}, {"DOI": "y", "n": {"m": 1}}]},
    ]
    works = pages_to_works(spark.createDataFrame([("p", page(items)), ("q", json.dumps({"message": {"items": items[0]}}))], "member string, content string"))
    got = {(r["provenance"], r["doi"]): tuple(r[c] for c in ("author_count", "first_subject_area", "subject_areas", "has_references", "num_references", "num_citations_without_doi")) for r in summaries.summarise(works, provenance=True).collect()}
    assert got == {
        ("p", "a"): (1, "Bio", "Bio", 1, 1, 0), ("q", "a"): (1, "Bio", "Bio", 1, 1, 0), ("p", "b"): (2, "A", "A|B", 1, 1, 1),
        ("p", "c"): (None, None, "", 0, 0, 0), ("p", "d"): (2, None, "", 1, 3, 2),
    }
