import pytest

from citelake.operators.profile import merge_profiles, profile, profile_long


def stats(df, by=None):
    return {r["stat"]: r.asDict() for r in profile(df, by).collect()}


def one(spark, values, type_):
    return {k: r["a"] for k, r in stats(spark.createDataFrame([(v,) for v in values], f"a {type_}")).items()}


def test_empty(spark):
    got = stats(spark.createDataFrame([], "a int, b string"))
    assert {k: (r["a"], r["b"]) for k, r in got.items()} == {"count": ("0", "0"), "count_valid": ("0", "0")}


@pytest.mark.parametrize(
    "values, type_, expected",
    [
        ([1, 2, 10, 11], "int", {"count": "4", "count_valid": "4", "min": "1", "max": "11", "sum": "24", "mean": "6", "type": "numeric"}),
        ([1, 2, None, 11], "int", {"count": "4", "count_valid": "3", "count_numeric": "3", "mean": str(14 / 3)}),
        ([1, 2, 0, 11], "int", {"mean": "3.5", "mean_non_zero": str(14 / 3), "count_zero": "1", "count_non_zero": "3"}),
        (["true", "false", "true", "true"], "string", {"count_non_zero": "3", "count_zero": "1", "type": "numeric"}),
        ([True, False, None], "boolean", {"sum": "1", "type": "numeric", "count_numeric": "2"}),
        ([0, 0], "int", {"mean": "0", "mean_non_zero": "0"}),
    ],
)
def test_numbers(spark, values, type_, expected):
    got = one(spark, values, type_)
    assert {k: got[k] for k in expected} == expected


@pytest.mark.parametrize("values", [["a1", "a2", "a3", "a4"], ["a1", "a2", None, "a4"], ["a1", "a2", "3", "a4"], ["1", "2", "a3", "a4"], ["a1", "a2", "false", "a4"], [None, None]])
def test_text_has_no_numeric_statistics(spark, values):
    assert one(spark, values, "string") == {"count": str(len(values)), "count_valid": str(sum(v is not None for v in values)), "type": "str"}


def test_groups(spark):
    df = spark.createDataFrame([("x", "p", 1), ("x", "q", 2), ("y", "q", 1), ("y", None, 5)], "g1 string, g2 string, a int")
    got = {(r["g1"], r["g2"]): r["a"] for r in profile(df, ["g1", "g2"]).collect() if r["stat"] == "sum"}
    assert got == {("x", "p"): "1", ("x", "q"): "2", ("y", "q"): "1", ("y", ""): "5"}
    assert {r["g1"]: r["a"] for r in profile(df.drop("g2"), ["g1"]).collect() if r["stat"] == "count"} == {"x": "2", "y": "2"}


def test_na_tokens_and_group_named_type(spark):
    df = spark.createDataFrame([("t", "1"), ("t", "NA")], "type string, a string")
    row = profile_long(df, ["type"], na_tokens=["NA"]).first()
    assert (row["count_valid"], row["value_type"]) == (1, "numeric")
    with pytest.raises(ValueError):
        profile_long(df.withColumnRenamed("type", "count"), ["count"])


def test_batches_merge_to_the_whole(spark):
    a = spark.createDataFrame([("1", 1), ("2", None)], "s string, n int")
    b = spark.createDataFrame([("x", 4), (None, 0)], "s string, n int")
    merged = {tuple(sorted(r.asDict().items())) for r in merge_profiles(profile_long(a), profile_long(b)).collect()}
    assert merged == {tuple(sorted(r.asDict().items())) for r in profile_long(a.unionByName(b)).collect()}
