"""The operators over delivered records against brute force, with nulls, ties, repeats, hot keys, empty tables and clashing names."""

import random
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citelake.operators import delivery, orphans, quality, shred, tree
from citelake.session import hadoop_path, scratch_path

T0 = datetime(2019, 1, 1)


def at(n):
    return None if n is None else T0 + timedelta(hours=n)


def key(s):
    return "".join(c for c in s.lower() if c.isalnum())


# ---- orphans ---------------------------------------------------------------------------------------------------------

REFS, SEEN, REG, GONE = "id bigint, a string, b string, t timestamp_ntz, h string, field string", "k string, t timestamp_ntz", "k string, id int", "k string, at timestamp_ntz"


def orphans_of(spark, refs, seen, reg, gone, **kw):
    df = orphans.find_orphans(
        spark.createDataFrame([(i, a, b, at(t), "x", "y") for i, a, b, t in refs], REFS),
        id_col="id", key_cols=["a", "b"], time_col="t",
        parents=[orphans.Keys(spark.createDataFrame([(k, at(t)) for k, t in seen], SEEN), "k", "t"), orphans.Keys(spark.createDataFrame([(k, 0) for k in reg], REG), "k")],
        withdrawn=[orphans.Keys(spark.createDataFrame([(k, at(t)) for k, t in gone], GONE), "k", "at")],
        **kw,
    )
    return sorted(((r["id"], r["field"], r["reason"]) for r in df.collect()), key=str)


def brute_orphans(refs, seen, reg, gone):
    out = []
    for i, a, b, t in refs:
        for field, value in (("a", a), ("b", b)):
            k = key(value) if value else ""
            if not k:
                continue
            times = [x for s, x in seen if s and key(s) == k and x is not None]
            known = k in {key(r) for r in reg if r} or (t is not None and any(x <= t for x in times))
            withdrawn = t is not None and any(x <= t for s, x in gone if s and key(s) == k and x is not None)
            if withdrawn or not known:
                out.append((i, field, "withdrawn" if withdrawn else "late" if times else "unknown"))
    return sorted(out, key=str)


def spelled(rng, k):
    return rng.choice([k, k.upper(), f" {k}", f"{k[:2]}-{k[2:]}"])


@pytest.mark.parametrize("ranges, hot_limit", [(None, None), (7, 30), (1, 5)])
def test_orphans_against_brute_force(spark, ranges, hot_limit):
    rng = random.Random(5)
    pool = [f"10.1/k{i}" for i in range(60)]
    time = lambda: rng.choice([None, *range(50)])
    pick = lambda: rng.choice([None, "", " - ", *[spelled(rng, rng.choice(pool)) for _ in range(6)], *["10.1/hot"] * 4])
    refs = [(rng.choice([None, i]), pick(), pick(), time()) for i in range(800)]
    refs += refs[:40]
    seen = [(rng.choice([None, spelled(rng, rng.choice(pool))]), time()) for _ in range(80)] + [("10.1/hot", 25)] * 3
    reg = [None, "", *rng.sample(pool, 5)]
    gone = [(spelled(rng, rng.choice(pool)), time()) for _ in range(8)] + [(None, 3)]
    assert orphans_of(spark, refs, seen, reg, gone, ranges=ranges, hot_limit=hot_limit) == brute_orphans(refs, seen, reg, gone)


def test_orphans_of_empty_tables(spark):
    assert orphans_of(spark, [], [], [], []) == []
    assert orphans_of(spark, [(1, "x", None, 3)], [], [], []) == [(1, "a", "unknown")]


def test_equal_hashes_of_different_keys():
    batch = pa.RecordBatch.from_pydict(
        {"h": [5, 5, 5, 9], "key": ["a", "b", "c", "z"], "t": [1, 2, 3, 4], "always": [False] * 4, "gone": pa.array([None, 7, None, None], pa.int64())}
    )
    seen, gone = orphans._Parents([batch]).times(np.array([5, 5, 5, 9, 1]), pa.array(["c", "b", "d", "y", "a"]))
    assert seen.tolist() == [3, 2, orphans.NEVER, orphans.NEVER, orphans.NEVER] and gone[1] == 7


def test_no_parent_is_copied_unless_its_key_is_hot(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key")).withColumn("h", F.xxhash64("key"))
    rows = keys.unionByName(keys.where("key = 'k7'").withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("x"))
    refs = rows.select("*", F.monotonically_increasing_id().alias("id"), F.lit(None).cast("timestamp_ntz").alias("t"), F.lit("a").alias("field"))
    hot = orphans.hot_hashes(refs, 6, 500).cache()
    assert [(r["h"], r["splits"]) for r in hot.collect()] == [(keys.where("key = 'k7'").first()["h"], 7)]
    copies = {r["key"]: r["count"] for r in orphans.placed(keys, hot, 6, False).groupBy("key").count().collect()}
    assert len(copies) == 20_000 and copies.pop("k7") == 7 and set(copies.values()) == {1}
    sizes = [r["count"] for r in orphans.placed(refs, hot, 6, True).groupBy("pid").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 2 * 23_000 / 64 + 500
    # At a million ranges: a key is in one range, and ranges are even.
    far = orphans.placed(keys, hot.limit(0), 20, False)
    assert far.count() == 20_000 and far.groupBy("pid").count().agg(F.max("count")).first()[0] <= 4
    assert orphans.range_bits(10**12, 8) == 21 and orphans.range_bits(0, 1) == 0 and orphans.range_bits(10, 8) == 3


def test_report(spark):
    df = spark.createDataFrame([(1, "a", "k", at(1), "late"), (2, "a", "k", at(2), "late"), (3, "b", "k", None, "unknown")], "id int, field string, key string, t timestamp_ntz, reason string")
    assert {tuple(r) for r in orphans.orphan_report(df, "refs").collect()} == {("refs", "a", "late", "2019-01", 2), ("refs", "b", "unknown", None, 1)}


# ---- deliveries ------------------------------------------------------------------------------------------------------

MESSAGES = "doi string, row_id bigint, t timestamp_ntz, load int, slot string, w string"


def messages(spark, rows):
    return spark.createDataFrame([(d, i, at(t), load, "s", "w") for d, i, t, load in rows], MESSAGES)


def winners(rows):
    best = {}
    for d, i, t, _ in rows:
        if d is not None:
            order = (t is None, t or 0, i is None, i or 0)
            best[d] = min(best.get(d, (order, i)), (order, i))
    return {d: i for d, (_, i) in best.items()}


def test_deliveries_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "hot", "hot", f"d{rng.randrange(60)}"]), i, rng.choice([None, *range(9)]), rng.choice([None, 1, 2, 3])) for i in range(600)]
    rows += rows[:25]
    df = messages(spark, rows)
    store = delivery.merge_batches(df, identifier="doi", order=["t", "row_id"], columns=["load", "slot"], batch="load")
    assert {r["doi"]: r["row_id"] for r in store.read().collect()} == winners(rows)
    assert store.read().columns == ["doi", "t", "row_id", "load", "slot"]
    named = [r for r in rows if r[0] is not None]
    kept = list(winners(rows).values())
    expected = sorted(i for _, i, _, _ in named)
    for i in kept:
        expected.remove(i)
    assert sorted(r["row_id"] for r in delivery.superseded(df.where("doi is not null"), store.read(), "row_id").collect()) == expected


def test_only_beaten_partitions_are_written_again(spark):
    path = scratch_path(spark, "store")
    make = lambda: delivery.DeliveryStore(spark, path, identifier="doi", order=["t", "row_id"], columns=[])
    store = make()
    store.merge(messages(spark, [("a", 1, 5, 1), ("b", 2, 5, 1)]), "1")
    store.merge(messages(spark, [("c", 3, 5, 2)]), "2")
    before = {int(s): f for s, f in store.manifest["files"].items()}
    store.merge(messages(spark, [("a", 9, 6, 3), ("c", 4, 1, 3), ("d", 5, 1, 3)]), "3")
    after = {int(s): f for s, f in store.manifest["files"].items()}
    # Only c's partition is written again: the later copy of a changes nothing, d is added beside.
    assert len(store.manifest["touched"]) == 1 and all(after[s][: len(f)] == f for s, f in before.items() if s not in store.manifest["touched"])
    expected = {"a": 1, "b": 2, "c": 4, "d": 5}
    assert {r["doi"]: r["row_id"] for r in store.read().collect()} == expected
    store.merge(messages(spark, [("a", 0, 0, 3)]), "3")  # a batch taken in before
    again = make()
    again.merge(messages(spark, [("a", 0, 0, 3)]), "2")
    assert {r["doi"]: r["row_id"] for r in again.read().collect()} == expected
    with pytest.raises(ValueError):
        delivery.DeliveryStore(spark, path, identifier="doi", order=["t"], columns=["w"])


def test_a_growing_store_is_rearranged_and_cleaned(spark):
    path = scratch_path(spark, "store")
    store = delivery.DeliveryStore(spark, path, identifier="doi", order=["t", "row_id"], columns=["w"], rows_per_partition=4)
    for batch in range(4):
        store.merge(messages(spark, [(f"d{i}", i, 9 - batch, batch) for i in range(batch, 60 + 60 * batch)]), str(batch))
    assert store.manifest["slots"] > delivery.LEAST_SLOTS and store.manifest["rows"] == 240
    expected = {r["doi"]: (r["row_id"], r["t"]) for r in store.read().collect()}
    assert len(expected) == 240 and expected["d2"][1] == at(7) and expected["d100"][1] == at(6)
    assert store.vacuum() > 0 and store.vacuum() == 0
    again = delivery.DeliveryStore(spark, path, identifier="doi", order=["t", "row_id"], columns=["w"])
    assert {r["doi"]: (r["row_id"], r["t"]) for r in again.read().collect()} == expected


def test_merges_double():
    assert delivery.merges([1] * 9) == [[0], [1], [2, 3], [4, 5, 6, 7], [8]]
    assert delivery.merges([100, 1, 1]) == [[0], [1, 2]] and delivery.merges([]) == [] and delivery.merges([0, 0, 5]) == [[0], [1], [2]]


def test_a_lost_race_leaves_the_store_as_it_was(spark):
    path = scratch_path(spark, "store")
    make = lambda: delivery.DeliveryStore(spark, path, identifier="doi", order=["t"], columns=["row_id"])
    first, second = make(), make()
    first.merge(messages(spark, [("a", 1, 5, 1)]), "1")
    with pytest.raises(RuntimeError):
        second.merge(messages(spark, [("a", 2, 1, 1)]), "x")
    assert [r["row_id"] for r in first.read().collect()] == [1]
    fs, root = hadoop_path(spark, f"{path}/manifest")
    assert len([s for s in fs.listStatus(root) if s.getPath().getName().isdigit()]) == 1


def test_no_deliveries(spark):
    store = delivery.merge_batches(messages(spark, []), identifier="doi", order=["t"], columns=[], batch="load")
    assert store.read().count() == 0


# ---- shredding -------------------------------------------------------------------------------------------------------


def brute_children(content):
    import json

    def listed(x, texts=False):
        if texts and isinstance(x, str):
            try:
                x = json.loads(x)
            except ValueError:
                return []
        return x if isinstance(x, list) else [] if x in (None, "") else [x]

    full = lambda x: x not in (None, {}, [], "") and not (isinstance(x, str) and not x.strip())
    try:
        items = listed(json.loads(content)["message"]["items"])
    except (ValueError, TypeError, KeyError):
        return []
    out = []
    for i, w in enumerate(items):
        if not isinstance(w, dict):
            continue
        for j, a in enumerate(listed(w.get("author"), True)):
            if full(a):
                out.append((i, "author", j, -1))
                if isinstance(a, dict):
                    out += [(i, "affiliation", j, k) for k, f in enumerate(listed(a.get("affiliation"))) if full(f)]
        out += [(i, "reference", j, -1) for j, r in enumerate(listed(w.get("reference"), True)) if full(r)]
        out += [(i, "subject", j, -1) for j, x in enumerate(listed(w.get("subject"))) if full(x) and not isinstance(x, (dict, list))]
    return out


ODD = [
    None, "", "{", "[]", "null", "{}", '{"message": null}', '{"message": {"items": null}}', '{"message": {"items": []}}',
    '{"message": {"items": [null, {}, {"author": null, "subject": "", "reference": {}}, {"author": {"family": "x", "affiliation": {"name": "y"}}, "subject": "s"}]}}',
    '{"message": {"items": [{"author": [null, {}, {"given": "g", "affiliation": [null, {"name": "n"}, {}]}], "subject": [" ", null, "t", 5, {"a": 1}], "reference": "[null, {\\"key\\": \\"k\\"}]"}]}}',
    '{"message": {"items": [{"author": "no json", "reference": "{\\"DOI\\": \\"d\\", \\"year\\": 1999}"}]}}',
    '{"message": {"items": {"DOI": "single", "subject": ["a", "b"]}}}',
]


def test_children_against_brute_force(spark, sf_dir):
    pages = spark.createDataFrame([(f"m{i}", c, 1) for i, c in enumerate(ODD)] + [(None, ODD[10], 2), ("m10", ODD[10], 3)], "member string, content string, item_no int")
    got = sorted((str(r["member"]), *tuple(r)[1:]) for r in shred.child_places(pages).collect())
    assert got == sorted((str(r["member"]), *c) for r in pages.collect() for c in brute_children(r["content"]))
    table = spark.read.parquet(f"{sf_dir}/works_pages.parquet")
    got = sorted(tuple(r) for r in shred.child_places(table, pages_at_a_time=3).collect())
    assert got == sorted((r["member"], *c) for r in table.collect() for c in brute_children(r["content"]))


def test_flat_tables_keep_parents_and_values(spark):
    pages = spark.createDataFrame([("m", ODD[10]), ("n", ODD[11])], "member string, content string")
    assert [tuple(r) for r in shred.flat_table(pages, "affiliation").collect()] == [("m", 0, 2, 1, "n")]
    assert [tuple(r) for r in shred.flat_table(pages, "author").collect()] == [("m", 0, 2, "g", None, None)]
    refs = [tuple(r)[:-1] for r in shred.flat_table(pages, "reference").collect()]
    assert refs == [("m", 0, 1, "k", None, None), ("n", 0, 0, None, "d", "1999")]
    assert shred.flat_table(pages, "work").count() == 2
    assert [r["subject"] for r in shred.flat_table(pages, "subject").collect()] == ["t", "5"]


def test_levels():
    s = shred.Shredder()
    s.page('{"message": {"items": [{"author": [{"family": "a"}, null]}, {}, {"author": []}]}}')
    s.page("broken")
    column = s.columns["work", "author", "family"]
    assert (column.rep, column.dfn, column.val) == ([0, 2, 1, 1, 0], [5, 3, 1, 2, 0], ["a", None, None, None, None])


def test_no_pages(spark):
    empty = spark.createDataFrame([], "member string, content string")
    assert shred.child_places(empty).count() == 0 and shred.flat_table(empty, "work").count() == 0


def test_one_very_long_page(spark):
    many = '{"message": {"items": [' + ",".join(['{"subject": ["a", "b"]}'] * 20_000) + "]}}"
    assert shred.child_places(spark.createDataFrame([("m", many)], "member string, content string")).count() == 40_000


# ---- load profiles ---------------------------------------------------------------------------------------------------


def test_unusual_loads(spark):
    rows = [(1, 5, "x")] * 40 + [(1, 6, "y")] + [(2, None, "x")] * 30 + [(2, 5, "x")] * 10 + [(3, 7, "x")] * 9 + [(4, 20_000, "x"), (4, 5, "x"), (4, 6, None)] + [(5, 400, "z"), (5, 500, "z")] + [(6, 0, "q"), (6, 1, "q")]
    df = spark.createDataFrame(rows, "load int, v int, n string")
    got = {(r["load"], r["mark"]) for r in quality.unusual_loads(quality.profile_loads(df, load="load", columns=["v"])).collect()}
    c_mean = sum(v for _, v, _ in rows if v is not None and v <= 10_000) / sum(v is not None and v <= 10_000 for _, v, _ in rows)
    assert got == {(2, "nulls"), (2, "constant"), (3, "constant"), (4, "range"), (5, "shift"), *({(6, "shift")} | {(n, "shift") for n, m in ((1, 206 / 41), (2, 5), (3, 7), (4, 5.5)) if m * 2 < c_mean})}


def test_profile_statistics(spark):
    df = spark.createDataFrame([(1, 2, "ab"), (1, -3, "9"), (None, 2, None), (1, 2, "ab")], "n_rows int, v bigint, s string")
    p = {(r["load"], r["column_name"], r["overall"]): r for r in quality.profile_loads(df, load="n_rows", columns=["v", "s"], patterns={"s": r"^[a-z]+\z"}).collect()}
    v = p[1, "v", False]
    assert (v["n_rows"], v["n_null"], v["n_distinct"], v["n_outside"], v["n_valid"], int(v["s1"]), int(v["s2"]), int(v["s4"]), int(v["lowest"])) == (3, 0, 2, 1, 2, 4, 8, 32, 2)
    s = p[None, "s", True]
    assert (s["n_rows"], s["n_null"], s["n_distinct"], s["n_broken"]) == (4, 1, 2, 1)
    assert p[None, "v", False]["n_rows"] == 1


def test_shifts_match_numpy(spark):
    rng = np.random.default_rng(1)
    data = {1: rng.integers(0, 50, 200), 2: rng.integers(10, 90, 150)}
    df = spark.createDataFrame([(k, int(v)) for k, vs in data.items() for v in vs], "load int, v int")
    got = {r["load"]: r for r in quality.shifts(quality.profile_loads(df, load="load", columns=["v"])).collect()}
    a, b = data[1].astype(float), data[2].astype(float)
    z = (a - a.mean()) / a.std()
    assert got[1]["mean"] == pytest.approx(a.mean(), abs=1e-5) and got[1]["deviation"] == pytest.approx(a.std(), abs=1e-5)
    assert got[1]["standardised_difference"] == pytest.approx((a.mean() - b.mean()) / np.sqrt((a.var() + b.var()) / 2), abs=1e-5)
    assert got[1]["skewness"] == pytest.approx((z**3).mean(), abs=1e-3) and got[1]["kurtosis"] == pytest.approx((z**4).mean() - 3, abs=1e-3)


def test_profile_of_nothing(spark):
    empty = spark.createDataFrame([], "load int, v int")
    p = quality.profile_loads(empty, load="load", columns=["v"])
    assert p.count() == 0 and quality.unusual_loads(p).count() == 0 and quality.shifts(p).count() == 0


# ---- tree aggregation ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("partitions, fan_in, chunk_rows", [(1, 2, 7), (13, 2, 3), (13, 3, 100), (5, 8, 1)])
def test_tree_against_group_by(spark, partitions, fan_in, chunk_rows):
    rng = random.Random(4)
    rows = [(rng.choice([None, "hot", "hot", f"k{rng.randrange(9)}"]), rng.choice([None, *range(5)]), "x") for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, v int, n string").repartition(partitions)
    states = {"n": tree.counting(), "filled": tree.counting(F.col("v")), "total": tree.summing(F.col("v")), "low": tree.lowest(F.col("v")), "high": tree.highest(F.col("v"))}
    got = {tuple(r) for r in tree.tree_aggregate(df, {"k": F.col("k")}, states, fan_in, chunk_rows).collect()}
    want = df.groupBy("k").agg(F.count("*"), F.count("v"), F.sum("v"), F.min("v"), F.max("v")).collect()
    assert got == {tuple(r) for r in want}


def test_tree_rounds():
    assert [tree.rounds(n, 8) for n in (1, 8, 9, 64, 65)] == [1, 1, 2, 2, 3]
    with pytest.raises(ValueError):
        tree.tree_aggregate(None, {}, {}, 1)


def test_tree_of_nothing(spark):
    empty = spark.createDataFrame([], "k string")
    assert tree.tree_aggregate(empty, {"k": F.col("k")}, {"n": tree.counting()}).count() == 0
    assert tree.heavy_keys(spark.createDataFrame([("a", 2), ("b", 1)], "k string, n bigint"), "n", 100, 0.01).collect()[0]["k"] == "a"
