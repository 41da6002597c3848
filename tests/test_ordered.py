import random

import pytest

from citelake.operators import ordered


@pytest.mark.parametrize("size, expected", [(1, [5, 4, 3, 2, 1]), (2, [4, 3, 2, 1, 5]), (3, [3, 2, 1, 4, 5]), (5, [1, 2, 3, 4, 5]), (9, [1, 2, 3, 4, 5])])
def test_sort_window(size, expected):
    assert list(ordered.sort_window([5, 4, 3, 2, 1], size)) == expected


@pytest.mark.parametrize("rows", [[5, 3, 3, 3, 1], [5, 3, 3, 1, 1]])
def test_sort_window_unique(rows):
    dropped = []
    assert list(ordered.sort_window(rows, 3, unique=True, dropped=dropped.append)) == [3, 1, 5]
    assert len(dropped) == 2


def test_ties_keep_arrival_order():
    rows = [(1, "b"), (1, "a"), (0, "c")]
    assert list(ordered.sort_window(rows, 10, key=lambda r: r[0])) == [(0, "c"), (1, "b"), (1, "a")]


def test_uniq_window_forgets_the_newest():
    assert list(ordered.uniq_window([1, 2, 3, 2, 1, 3], 2)) == [1, 2, 3, 2, 3]


def test_exact_window_on_spark(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(40)) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, k int").repartition(4)
    got = [(r["i"], r["k"]) for r in ordered.windowed(df, order="i", key="k", size=20).orderBy("_place").collect()]
    assert got == list(ordered.sort_window(rows, 20, key=lambda r: r[1]))
    got = [(r["i"], r["k"]) for r in ordered.windowed(df, order="i", key="k", size=20, sort=False).orderBy("_place").collect()]
    assert got == list(ordered.uniq_window(rows, 20, key=lambda r: r[1]))


def test_numbering(spark):
    links = spark.createDataFrame([("b", "a"), ("é", None), ("", "B"), ("b", "a")], "x string, y string")
    assert [tuple(r) for r in ordered.doi_dictionary(links, ["x", "y"]).orderBy("id").collect()] == [(0, "B"), (1, "a"), (2, "b"), (3, "é")]
    assert [r["batch"] for r in ordered.in_batches(spark.range(7), "id", 3).orderBy("id").collect()] == [0, 0, 0, 1, 1, 1, 2]


def test_sort_unique_uses_whole_lines(spark):
    df = spark.createDataFrame([("a", "z"), ("a b", "c"), ("a", "z")], "x string, y string")
    assert [tuple(r) for r in ordered.sort_unique(df).collect()] == [("a", "z"), ("a b", "c")]
    assert ordered.deduplicated(df, ["x"]).count() == 2
    assert [r["x"] for r in ordered.sorted_by(df, "x").collect()] == ["a", "a", "a b"]


def test_dropped_rows_come_with_the_window(spark):
    df = spark.createDataFrame([(i, k) for i, k in enumerate("abacab")], "n int, k string")
    rows = ordered.windowed(df, order="n", key="k", size=2, sort=False, with_dropped=True).collect()
    kept = [r["n"] for r in sorted((r for r in rows if r["_place"] is not None), key=lambda r: r["_place"])]
    assert kept == [0, 1, 3, 5] and sorted(r["n"] for r in rows if r["_place"] is None) == [2, 4]
