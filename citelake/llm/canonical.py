"""Duplicates hidden by formatting: records that agree in a canonical key collapse into one, with their number of copies.

Records are combined per spelling where they are read. Keys with very many records are found by an exact count of partial
counts; those are aggregated in two levels, salted by spelling, all others by one shuffle on the key. The representative of a
key is the spelling of its smallest record identifier.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citelake.functions.keys import doi_key, present
from citelake.session import materialise, shuffle_partitions

SALTS = 64
PAIRS_SIDE = 1_000


@dataclass(frozen=True)
class Records:
    """A column of spellings and the identifier of its rows."""

    df: DataFrame
    spelling: str
    identifier: str


def spellings(sources: list[Records], key_fn: Callable[[Column], Column] = doi_key) -> DataFrame:
    """`(spelling, key, n, source, identifier)`: each distinct spelling as stored, its copies and its first record.

    Records are ordered by the position of their source in `sources`, then by identifier (null last). Null and blank
    spellings are no records. Other columns are ignored.
    """
    rows = None
    for i, s in enumerate(sources):
        part = s.df.select(F.col(f"`{s.spelling}`").cast("string").alias("spelling"), F.lit(i).alias("source"), F.col(f"`{s.identifier}`").cast("bigint").alias("id")).where("spelling is not null")
        rows = part if rows is None else rows.unionByName(part)
    firsts = [F.min(F.when(F.col("source") == i, F.col("id"))).alias(f"id{i}") for i in range(len(sources))]
    out = rows.groupBy("spelling").agg(F.count("*").alias("n"), F.min("source").alias("source"), *firsts)
    out = out.withColumn("identifier", F.element_at(F.array(*[f"id{i}" for i in range(len(sources))]), F.col("source") + 1))
    return out.withColumn("key", key_fn(F.col("spelling"))).where(present(F.col("key"))).select("spelling", "key", "n", "source", "identifier")


def hot_keys(spelled: DataFrame, limit: int) -> DataFrame:
    """`(key)` with more than `limit` records; of N records, fewer than N / limit keys."""
    return spelled.groupBy("key").agg(F.sum("n").alias("m")).where(F.col("m") > limit).select("key")


def classes(spelled: DataFrame, hot_limit: int | None = None) -> DataFrame:
    """One row per key: `(key, representative, source, identifier, n_copies, n_spellings)`; `spelled` is read several times, so store it first.

    A key is hot with more than `hot_limit` records; by default a quarter of what a task would get if all had alike.
    """
    if hot_limit is None:
        records = spelled.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        hot_limit = max(1, records // (4 * shuffle_partitions(spelled.sparkSession)))
    hot = F.broadcast(hot_keys(spelled, hot_limit).withColumn("hot", F.lit(True)))  # at most 4 keys a partition
    first = F.struct(F.col("source").alias("source"), F.col("identifier").isNull().alias("unknown"), F.col("identifier").alias("identifier"), F.col("spelling").alias("spelling"))
    states = spelled.join(hot, "key", "left").select("key", "hot", "spelling", F.col("n").alias("copies"), F.lit(1).cast("bigint").alias("spelled"), first.alias("first"))
    merge = [F.sum("copies").alias("copies"), F.sum("spelled").alias("spelled"), F.min("first").alias("first")]
    cold = states.where("hot is null").groupBy("key").agg(*merge)
    salted = states.where("hot").groupBy("key", F.pmod(F.xxhash64("spelling"), F.lit(SALTS)).alias("salt")).agg(*merge).groupBy("key").agg(*merge)
    both = cold.unionByName(salted)
    return both.select("key", F.col("first.spelling").alias("representative"), "first.source", "first.identifier", F.col("copies").alias("n_copies"), F.col("spelled").alias("n_spellings"))


def spelling_pairs(spelled: DataFrame, found: DataFrame) -> DataFrame:
    """`(doi_a, doi_b)`: each pair of different spellings of one key once, the smaller in UTF-8 byte order first.

    Keys with one spelling never enter the join. A key with many spellings has its left side cut into slices of about
    `PAIRS_SIDE`, so no task joins more than that with the key's other spellings.
    """
    many = found.where("n_spellings > 1").select("key", F.ceil(F.col("n_spellings") / PAIRS_SIDE).cast("int").alias("slices"))
    some = spelled.select("key", "spelling").join(many, "key")
    left = some.select("key", F.pmod(F.xxhash64("spelling"), F.col("slices")).cast("int").alias("slice"), F.col("spelling").alias("doi_a"))
    right = some.select("key", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.col("spelling").alias("doi_b"))
    return left.join(right, ["key", "slice"]).where("doi_a < doi_b").select("doi_a", "doi_b")


def canonical_spellings(sources: list[Records]) -> tuple[DataFrame, DataFrame]:
    """The stored spellings and their classes."""
    spelled = materialise(spellings(sources), "spellings")
    return spelled, classes(spelled)
