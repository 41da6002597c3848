"""Order-sensitive operators: bounded windows over a stream of rows, dense numbers, sorted distinct rows."""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Callable, Hashable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.session import materialise


def uniq_window(rows: Iterable, size: int, key: Callable[[object], Hashable] = lambda x: x, dropped: Callable[[object], None] | None = None) -> Iterator:
    """Rows whose key is not among those remembered. At `size` keys the one remembered last is forgotten for the new one."""
    memory: deque = deque()
    held: set = set()
    for row in rows:
        k = key(row)
        if k in held:
            if dropped:
                dropped(row)
            continue
        if len(memory) >= size:
            held.discard(memory.pop())
        memory.append(k)
        held.add(k)
        yield row


def _buffered(rows: Iterable, room: int, key: Callable[[object], object]) -> Iterator:
    heap: list = []
    for arrival, row in enumerate(rows):
        entry = (key(row), arrival, row)
        if len(heap) < room:
            heapq.heappush(heap, entry)
        else:
            yield heapq.heappushpop(heap, entry)[2]
    yield from (row for _, _, row in sorted(heap, key=lambda e: e[:2]))


def sort_window(rows: Iterable, size: int, key: Callable[[object], object] = lambda x: x, unique: bool = False, dropped: Callable[[object], None] | None = None) -> Iterator:
    """Rows through a buffer of `size` - 1: when it is full the smallest leaves, ties in order of arrival; at the end the rest, sorted.

    A `size` of 1 or less passes rows through as they are. With `unique` what leaves the buffer goes through `uniq_window`.
    """
    if size <= 1:
        return iter(rows)
    out = _buffered(rows, size - 1, key)
    return uniq_window(out, size, key, dropped) if unique else out


def windowed(df: DataFrame, *, order: str, key: str, size: int, sort: bool = True, unique: bool = False, with_dropped: bool = False) -> DataFrame:
    """Exactly what a bounded window makes of the rows in the order of column `order`, with the place in `_place`.

    `with_dropped` adds the rows that a uniqueness window dropped, with no place. Inherently serial: all rows pass one task, in
    bounded memory. `sorted_by` and `deduplicated` are the scalable forms.
    """
    columns = df.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for frame in frames for row in frame.itertuples(index=False, name=None))
        at, gone = columns.index(key), []
        dropped = gone.append if with_dropped else None
        pick = lambda r: r[at]
        out = sort_window(rows, size, pick, unique, dropped) if sort else uniq_window(rows, size, pick, dropped)
        buffer, place = [], 0
        for row in out:
            buffer.append((*row, place))
            place += 1
            if len(buffer) + len(gone) >= 10_000:
                yield frame_of(buffer, gone)
                buffer = []
        yield frame_of(buffer, gone)

    def frame_of(kept: list, gone: list) -> pd.DataFrame:
        frame = pd.DataFrame([*kept, *((*row, None) for row in gone)], columns=[*columns, "_place"])
        gone.clear()
        return frame.astype({"_place": "Int64"})

    schema = T.StructType([*df.schema.fields, T.StructField("_place", T.LongType())])
    return df.orderBy(order).coalesce(1).mapInPandas(run, schema)


def sorted_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Globally sorted: range partitioning, no single task."""
    return df.orderBy(*keys)


def deduplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropDuplicates(keys)


def in_batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """Rows with a batch number of `size` rows each, by the order of a column."""
    return numbered(df, order, "_n").withColumn("batch", F.floor(F.col("_n") / size)).drop("_n")


def numbered(df: DataFrame, order: str, name: str = "id") -> DataFrame:
    """Dense numbers from 0 in the order of a column: ranges are sorted in parallel, and each adds the sizes of those before it.

    Equal values are numbered one after the other. Only the sizes, one number a range, go through the driver.
    """
    mask = (1 << 33) - 1  # monotonically_increasing_id: the range above, the place in it below
    ranged = df.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id())
    ranged = materialise(ranged, "ranged").withColumn("_range", F.shiftright("_at", 33))
    sizes = {r["_range"]: r["n"] for r in ranged.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for r in sorted(sizes):
        starts.append((r, total))
        total += sizes[r]
    offsets = df.sparkSession.createDataFrame(starts, "_range bigint, _start bigint")
    placed = ranged.join(F.broadcast(offsets), "_range")  # one row a range
    return placed.select((F.col("_start") + F.col("_at").bitwiseAND(mask)).alias(name), *[F.col(f"`{c}`") for c in df.columns])


def doi_dictionary(links: DataFrame, columns: list[str]) -> DataFrame:
    """`(id, doi)`: the distinct non-empty values of the columns, numbered in byte order."""
    values = links.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("doi"))
    return numbered(values.where("doi is not null and doi <> ''").distinct(), "doi")


def sort_unique(df: DataFrame, separator: str = "\t") -> DataFrame:
    """Distinct rows in the byte order of their joined text."""
    line = F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    return df.distinct().orderBy(line)
