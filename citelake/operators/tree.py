"""Aggregation per key in rounds of bounded fan-in.

Keys with very many rows are found first, exactly: rows are counted by hash bucket, and by key in the buckets that are too full
only. All other keys have a bounded number of rows and are aggregated by one shuffle. The rows of a hot key are combined by
input chunks of a fixed size, where they are read; the partial states then merge in rounds, each node taking at most `fan_in`
states of a key, until one state is left. However many rows a key has, no task receives more than `fan_in` states of it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citelake.session import materialise

CHUNK_ROWS = 1024
MOST_HOT = 100_000


@dataclass(frozen=True)
class Merge:
    """A mergeable state: `start` over the rows of a chunk, `again` over states."""

    start: Column
    again: Callable[[str], Column]


def counting(c: Column | None = None) -> Merge:
    return Merge(F.count("*") if c is None else F.count(c), F.sum)


def summing(c: Column) -> Merge:
    return Merge(F.sum(c.cast("bigint")), F.sum)


def lowest(c: Column) -> Merge:
    return Merge(F.min(c), F.min)


def highest(c: Column) -> Merge:
    return Merge(F.max(c), F.max)


def rounds(chunks: int, fan_in: int) -> int:
    """Merge rounds that bring `chunks` states down to one."""
    n = 1
    while fan_in**n < chunks:
        n += 1
    return n


def hot_hashes(rows: DataFrame, limit: int, buckets: int) -> DataFrame:
    """`(h)` of keys (by hash `h`) with more than `limit` rows, exact: fewer than rows / limit of them."""
    bucket = F.pmod("h", F.lit(buckets))
    full = rows.groupBy(bucket.alias("full")).agg(F.count("*").alias("n")).where(F.col("n") > limit).select("full")
    some = rows.select("h", bucket.alias("bucket")).join(F.broadcast(full), F.col("bucket") == F.col("full"))
    return some.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("h")


def tree_aggregate(df: DataFrame, keys: dict[str, Column], states: dict[str, Merge], fan_in: int = 8, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per key combination with its `states`; a null key is a key, an empty table gives no rows.

    `keys` and `states` name the output columns; columns of `df` with the same names don't get in the way, since only
    the given expressions are read. Repeated rows and ties all count. A key is hot with more rows than `fan_in` chunks have (more,
    if that could be more than `MOST_HOT` keys). The table is read four times, so store it first if it is costly.
    """
    if fan_in < 2 or chunk_rows < 1:
        raise ValueError("fan_in must be at least 2, chunk_rows at least 1")
    inner = {name: f"__state_{i}" for i, name in enumerate(states)}
    key_names = [f"__key_{i}" for i in range(len(keys))]
    start = [states[name].start.alias(c) for name, c in inner.items()]
    again = [states[name].again(c).alias(c) for name, c in inner.items()]
    total = df.count()
    limit = max(fan_in * chunk_rows, total // MOST_HOT)
    level = df.withColumns(dict(zip(key_names, keys.values(), strict=True)))
    level = level.withColumn("__h", F.xxhash64(*key_names))
    hot = materialise(hot_hashes(level.select(F.col("__h").alias("h")), limit, min(1 << 20, max(4096, 16 * total // limit))), "hot")
    level = level.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), F.col("__h") == F.col("h"), "left")  # at most MOST_HOT rows
    cold = level.where("__hot is null").groupBy(*key_names).agg(*start)

    # A row's number is its split's above its place in the split; chunks are numbered through, as many as the fullest split has in each.
    number = F.monotonically_increasing_id()
    split, chunk = F.shiftright(number, 33), F.floor(number.bitwiseAND((1 << 33) - 1) / chunk_rows)
    some = level.where("__hot").withColumns({"__split": split, "__chunk": chunk})
    last = some.agg(F.max("__split").alias("split"), F.max("__chunk").alias("chunk")).first()
    wide, chunks = ((last["chunk"] + 1), (last["split"] + 1) * (last["chunk"] + 1)) if last["split"] is not None else (1, 1)
    tree = some.withColumn("__node", F.floor((F.col("__split") * wide + F.col("__chunk")) / fan_in)).groupBy(*key_names, "__node").agg(*start)
    for _ in range(rounds(chunks, fan_in) - 2):
        tree = tree.withColumn("__node", F.floor(F.col("__node") / fan_in)).groupBy(*key_names, "__node").agg(*again)
    tree = tree.groupBy(*key_names).agg(*again)
    both = cold.unionByName(tree)
    return both.select(*[F.col(c).alias(n) for c, n in zip(key_names, keys, strict=True)], *[F.col(c).alias(n) for n, c in inner.items()])


def heavy_keys(totals: DataFrame, count: str, rows: int, share: float) -> DataFrame:
    """Rows of `totals` whose `count` is more than `share` of `rows`; at most 1/share of them."""
    return totals.where(F.col(count) > F.lit(share) * F.lit(rows))
