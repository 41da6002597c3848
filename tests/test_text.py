import random

import pytest
from pyspark.sql import functions as F

from citelake.functions import text
from citelake.functions.keys import doi_key


def apply(spark, fn, values, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def python_clean(doi):
    return doi.strip().translate({ord(c): None for c in '\n\t"'}) if doi else None


def test_clean_doi_cases(spark):
    plain = "10.12345/path"
    values = [None, "", plain, f"  {plain}  ", f"\n{plain}\n", "10.12345/\npath", "10.12345\t/path", '10.12345/"path"', "  ", "a\rb", '" x"', " y\xa0"]
    assert apply(spark, text.clean_doi, values) == [None, None, *[plain] * 6, "", "a\rb", " x", "y"]


def test_clean_doi_like_python_on_random_text(spark):
    rng = random.Random(3)
    values = ["".join(rng.choice(' \t\n\r"\x0b\x1c\x85 　ab/.') for _ in range(rng.randrange(12))) for _ in range(400)]
    assert apply(spark, text.clean_doi, values) == [python_clean(v) for v in values]


@pytest.mark.parametrize("value", ["a\nb", "a\rb", "a\tb", "a  b", "a \r\n b"])
def test_clean_text(spark, value):
    assert apply(spark, text.clean_text, [value]) == ["a b"]


def test_clean_text_keeps_ends_and_falsy(spark):
    assert apply(spark, text.clean_text, [None, "", " a "]) == [None, "", " a "]


def test_numbers(spark):
    values = ["1", " 2.5 ", "-3e2", "1d", "1.0f", "", None, "true", "False", "abc", "inf", "nan", ".5", "+7."]
    assert apply(spark, text.number_or_null, values) == [1, 2.5, -300, None, None, None, None, 1, 0, None, float("inf"), None, 0.5, 7]


def test_safe_mean_and_percentage(spark):
    df = spark.createDataFrame([(6, 3), (6, 0)], "t int, n int")
    assert [tuple(r) for r in df.select(text.safe_mean(F.col("t"), F.col("n")), text.percentage(F.col("t"), F.col("n"))).collect()] == [(2.0, 200.0), (0.0, None)]


def test_list_or_scalar(spark):
    df = spark.createDataFrame([('{"t": ["a", "b"]}',), ('{"t": "[c]"}',), ("{}",), ('{"t": []}',)], "j string")
    assert [r[0] for r in df.select(text.list_or_scalar(F.parse_json("j"), "$.t")).collect()] == ["a b", "[c]", None, ""]


@pytest.mark.parametrize(
    "base, parameters, expected",
    [
        ("http://h", None, "http://h"), ("http://h", {}, "http://h"), ("http://h", "a=1", "http://h?a=1"), ("http://h?b=2", {"a": 1}, "http://h?b=2&a=1"),
        ("http://h", {"a": "?& "}, "http://h?a=%3F%26+"), ("http://h", [("a", 1), ("a", 2)], "http://h?a=1&a=2"),
    ],
)
def test_with_parameters(base, parameters, expected):
    assert text.with_parameters(base, parameters) == expected


def test_formats_and_case(spark):
    df = spark.createDataFrame([(1234567, 12.345, "Foo PRESS", None)], "n bigint, p double, s string, z string")
    row = df.select(text.format_count(F.col("n")), text.format_percent(F.col("p")), text.contains_ignoring_case(F.col("s"), "press"), text.contains_ignoring_case(F.col("z"), "press"), text.equal_ignoring_case(F.col("s"), F.lit("foo press"))).first()
    assert row[0] == "1,234,567" and row[1] in ("12.34%", "12.35%") and tuple(row[2:]) == (True, False, True)


def test_doi_key(spark):
    assert apply(spark, doi_key, ["10.1/A-b", " 10.1 / a B. ", "-", None, "", "É1"]) == ["101ab", "101ab", "", None, "", "é1"]


def test_populated_keys(spark):
    df = spark.createDataFrame([({"year": "1", "key": "k", "x": "", "y": None},), ({},)], "m map<string,string>")
    assert [r[0] for r in df.select(text.populated_keys(F.col("m"))).collect()] == ["key|year", ""]
