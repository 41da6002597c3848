"""References to records that do not exist.

Keys are hashed to 64 bits and the hash space is cut into equal ranges, so many that each has a bounded number of references
and of parents; hashes are even, so the only keys that can crowd a range are single ones with very many references. Those hot
keys are found by exact counts, first of narrow hash buckets, then of the keys in buckets that are too full. A range's parents
become one sorted array; reference batches of the range are probed by binary search, and the key itself is compared at the place
found, so hash collisions change nothing. References of a hot key are spread over as many ranges as they fill, each with a copy of that one parent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.functions.keys import doi_key, present
from citelake.session import materialise, shuffle_partitions

NEVER, ALWAYS = np.iinfo(np.int64).max, np.iinfo(np.int64).min
ROWS_PER_RANGE = 500_000


@dataclass(frozen=True)
class Keys:
    """A table of keys: `time` is when the key became (or ceased to be) known; None means from the start."""

    df: DataFrame
    key: str
    time: str | None = None


def range_bits(rows: int, least: int) -> int:
    """Bits of the hash that number the ranges: at least `least` ranges, and at most `ROWS_PER_RANGE` rows a range on average."""
    return max(least - 1, -(-rows // ROWS_PER_RANGE) - 1, 0).bit_length()


def range_of(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits).cast("int") if bits else F.lit(0)


def hot_hashes(refs: DataFrame, bits: int, limit: int) -> DataFrame:
    """`(h, splits)` of the keys with more than `limit` references: exact, and fewer than references / limit rows.

    A bucket (a sixteenth of a range) with no more than `limit` references has no such key; keys are counted in the others only.
    """
    bucket = range_of(F.col("h"), bits + 4)
    full = refs.groupBy(bucket.alias("full")).agg(F.count("*").alias("n")).where(F.col("n") > limit).select("full")
    some = refs.select("h", bucket.alias("bucket")).join(F.broadcast(full), F.col("bucket") == F.col("full"))
    counted = some.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    return counted.select("h", F.ceil(F.col("n") / limit).cast("int").alias("splits"))


def placed(rows: DataFrame, hot: DataFrame, bits: int, is_reference: bool) -> DataFrame:
    """`rows` with the range they go to (`pid`): home by hash; a hot key's references to any of its ranges, its parent to each of them."""
    splits = F.least(F.coalesce("splits", F.lit(1)), F.lit(1 << bits))
    step = F.pmod(F.xxhash64("id", "t", "field"), splits).cast("int") if is_reference else F.explode(F.sequence(F.lit(0), splits - 1))
    rows = rows.join(F.broadcast(hot), "h", "left").select("*", step.alias("step"))
    return rows.withColumn("pid", F.pmod(range_of(F.col("h"), bits) + F.col("step"), F.lit(1 << bits)))


class _Parents:
    """Sorted hashes of one range with the parents' keys and times."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches) if batches else None
        self.n = table.num_rows if table else 0
        if self.n:
            table = table.take(pa.array(np.argsort(table["h"].to_numpy(), kind="stable")))
            self.h = table["h"].to_numpy()
            self.key = table["key"].combine_chunks()
            self.seen = _micros(table["t"], NEVER)
            self.seen[table["always"].to_numpy(zero_copy_only=False).astype(bool)] = ALWAYS
            self.gone = _micros(table["gone"], NEVER)

    def times(self, h: np.ndarray, key: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        seen, gone = np.full(len(h), NEVER), np.full(len(h), NEVER)
        if not self.n:
            return seen, gone
        pos = np.searchsorted(self.h, h)
        todo = np.arange(len(h))
        while len(todo):
            at = pos[todo]
            inside = at < self.n
            inside[inside] = self.h[at[inside]] == h[todo[inside]]
            todo, at = todo[inside], at[inside]
            if not len(todo):
                break
            same = pc.equal(self.key.take(pa.array(at)), key.take(pa.array(todo))).to_numpy(zero_copy_only=False)
            seen[todo[same]], gone[todo[same]] = self.seen[at[same]], self.gone[at[same]]
            todo = todo[~same]
            pos[todo] += 1
        return seen, gone


def _micros(column, null: int) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), null).to_numpy(zero_copy_only=False).copy()


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches come sorted by kind: the parents of the range, then its references."""
    waiting: list[pa.RecordBatch] = []
    parents = None
    for batch in batches:
        split = int(np.searchsorted(batch.column("kind").to_numpy(), 1))
        if split:
            waiting.append(batch.slice(0, split))
        refs = batch.slice(split)
        if not refs.num_rows:
            continue
        if parents is None:
            parents, waiting = _Parents(waiting), []
        seen, gone = parents.times(refs.column("h").to_numpy(), refs.column("key"))
        at = _micros(refs.column("t"), ALWAYS)
        withdrawn, missing = gone <= at, seen > at
        reason = np.where(withdrawn, "withdrawn", np.where(seen == NEVER, "unknown", "late"))
        miss = pa.array(withdrawn | missing)
        hit = refs.filter(miss)
        yield pa.RecordBatch.from_arrays(
            [hit.column("id"), hit.column("field"), hit.column("key"), hit.column("t"), pa.array(reason, pa.string()).filter(miss)],
            names=["id", "field", "key", "t", "reason"],
        )


def find_orphans(
    references: DataFrame,
    *,
    id_col: str,
    key_cols: list[str],
    time_col: str,
    parents: list[Keys],
    withdrawn: list[Keys] = (),
    key_fn=doi_key,
    ranges: int | None = None,
    hot_limit: int | None = None,
) -> DataFrame:
    """Orphan references: `(id, field, key, t, reason)`, one row for each row and key column that is an orphan.

    `reason` is `withdrawn` (taken back at or before the reference's time), `late` (known, but only after it) or `unknown`.
    A null or blank key refers to nothing and is no orphan. A parent or withdrawal whose time is null is left aside, unless
    its table has no time at all (`Keys.time` None: known from the start). A reference without a time is later than nothing:
    only parents known from the start save it, and no withdrawal touches it. Repeated reference rows come out as often as
    they are there. Empty tables are allowed everywhere. Other columns, whatever their names, are ignored.

    `ranges` is rounded up to a power of two; by default it follows from the sizes of the tables. A key with more than `hot_limit`
    references (by default half a range) is hot. The tables are read more than once, so store them first if they are costly.
    """
    spark = references.sparkSession
    ntz, none = T.TimestampNTZType(), F.lit(None)
    refs = references.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{time_col}`").cast(ntz).alias("t"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("field"), key_fn(F.col(f"`{c}`").cast("string")).alias("key")) for c in key_cols])).alias("r"),
    ).select("id", "t", "r.field", "r.key")
    refs = refs.where(present(F.col("key"))).withColumn("h", F.xxhash64("key"))

    def side(k: Keys, seen: bool) -> DataFrame:
        time: Column = F.col(f"`{k.time}`").cast(ntz) if k.time else none.cast(ntz)
        out = k.df.select(
            key_fn(F.col(f"`{k.key}`").cast("string")).alias("key"),
            (time if seen else none.cast(ntz)).alias("t"),
            F.lit(seen and k.time is None).alias("always"),
            (none.cast(ntz) if seen else time).alias("gone"),
        ).where(present(F.col("key")))
        return out.where(F.col("t").isNotNull() | F.col("always") | F.col("gone").isNotNull())

    known = None
    for part in [*(side(k, True) for k in parents), *(side(k, False) for k in withdrawn)]:
        known = part if known is None else known.unionByName(part)
    known = known.groupBy("key").agg(F.min("t").alias("t"), F.max("always").alias("always"), F.min("gone").alias("gone"))
    known = known.withColumn("h", F.xxhash64("key"))

    # Counting rows of a parquet table reads its footers only.
    sizes = [references.count() * len(key_cols), sum(k.df.count() for k in [*parents, *withdrawn])]
    bits = range_bits(max(sizes), ranges or shuffle_partitions(spark))
    tasks = 1 << bits
    hot_limit = hot_limit or max(1_000, sizes[0] // (2 * tasks))
    hot = materialise(hot_hashes(refs, bits, hot_limit), "hot")  # fewer than 2 rows a range
    refs = placed(refs, hot, bits, True).select("pid", F.lit(1).cast("tinyint").alias("kind"), "h", "key", "t", F.lit(False).alias("always"), none.cast(ntz).alias("gone"), "field", "id")
    known = placed(known, hot, bits, False).select(
        "pid", F.lit(0).cast("tinyint").alias("kind"), "h", "key", "t", "always", "gone",
        none.cast("string").alias("field"), none.cast(references.schema[id_col].dataType).alias("id"),
    )
    both = known.unionByName(refs).repartitionById(tasks, F.col("pid")).sortWithinPartitions("kind").drop("pid")
    schema = T.StructType(
        [
            T.StructField("id", references.schema[id_col].dataType),
            T.StructField("field", T.StringType()),
            T.StructField("key", T.StringType()),
            T.StructField("t", ntz),
            T.StructField("reason", T.StringType()),
        ]
    )
    return both.mapInArrow(_probe, schema)


def orphan_report(orphans: DataFrame, table: str) -> DataFrame:
    """Orphans per table, key column, reason and month of the reference (NULL month: no time)."""
    month = F.date_format(F.col("t"), "yyyy-MM")
    return orphans.groupBy(F.lit(table).alias("table_name"), "field", "reason", month.alias("month")).agg(F.count("*").alias("n_orphans"))
