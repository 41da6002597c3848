"""How often every value and term occurs, and in how many records, from a vertical index.

Record identifiers are cut into chunks of 65,536. Every value and term has, per chunk, a compressed bitmap of the records that
hold it (a sorted array while it is sparse, a bit field from 4,096 records on) and a counter of its occurrences beside it. Tasks
make bitmaps of the rows they read: of each distinct value, and of a term as the union over the values that hold it, so a value
is split into words once, however many rows have it. The bitmaps of a (term, chunk) meet in one task, where they are merged by
union; chunks are disjoint, so document frequency is the sum of their cardinalities. No task gets all records of a term.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, DENSE = 1 << 16, 4096
ROWS_AT_A_TIME = 1 << 16
WORD = re.compile(r"[^\W_]+")
POSTINGS = "field string, unit string, item string, chunk bigint, rows binary, occurrences bigint"
NAMES = ["field", "unit", "item", "chunk", "rows", "occurrences"]
TYPES = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64()]


def pack(rows: np.ndarray) -> bytes:
    """Sorted distinct places below 65,536 as a container."""
    if len(rows) < DENSE:
        return rows.astype("<u2").tobytes()
    bits = np.zeros(CHUNK, dtype=np.uint8)
    bits[rows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(container: bytes) -> np.ndarray:
    if len(container) < CHUNK // 8:
        return np.frombuffer(container, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(container, np.uint8), bitorder="little"))


def union(containers: list[bytes]) -> bytes:
    return pack(np.unique(np.concatenate([unpack(c) for c in containers])) if containers else np.zeros(0, np.int64))


def words(value: str) -> list[str]:
    """The longest runs of letters and digits, in lower case."""
    return WORD.findall(value.lower())


def _containers(ids: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(chunk, sorted distinct places) of some record identifiers."""
    ids = np.unique(ids)
    chunks = ids >> 16
    starts = np.flatnonzero(np.r_[True, chunks[1:] != chunks[:-1]])
    return [(int(chunks[s]), part & (CHUNK - 1)) for s, part in zip(starts, np.split(ids, starts[1:]), strict=True)]


def _postings(field: str, ids: np.ndarray, column: pa.Array) -> Iterator[tuple]:
    """The rows of an index for one column of some records. A value's and a term's occurrences are booked in its first chunk."""
    coded = column.dictionary_encode()
    codes = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(codes, kind="stable")
    order = order[codes[order] >= 0]
    if not len(order):
        return
    starts = np.flatnonzero(np.r_[True, np.diff(codes[order]) != 0])
    terms: dict[str, list[np.ndarray]] = defaultdict(list)
    occurrences: dict[str, int] = defaultdict(int)

    def rows(unit: str, item: str, of: np.ndarray, n: int) -> Iterator[tuple]:
        for k, (chunk, places) in enumerate(_containers(of)):
            yield field, unit, item, chunk, pack(places), n if k == 0 else 0

    for group in np.split(order, starts[1:]):
        value, of = coded.dictionary[int(codes[group[0]])].as_py(), ids[group]
        yield from rows("value", value, of, len(of))
        found = words(value)
        for term in set(found):
            terms[term].append(of)
        for term in found:
            occurrences[term] += len(of)
    for term, of in terms.items():
        yield from rows("term", term, np.concatenate(of), occurrences[term])


def _batches(rows: Iterator[tuple], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*part, strict=True), TYPES, strict=True)], names=NAMES)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches `(identifier, field...)`, taken together up to about `ROWS_AT_A_TIME` rows."""

    def made(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(waiting).combine_chunks()
        ids = table.column(0).to_numpy()
        for field in table.column_names[1:]:
            column = table[field].combine_chunks()
            yield from _batches(_postings(field, ids, column.chunk(0) if isinstance(column, pa.ChunkedArray) else column))

    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += batch.num_rows
        if n >= ROWS_AT_A_TIME:
            yield from made(waiting)
            waiting, n = [], 0
    if n:
        yield from made(waiting)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings sorted by item and chunk, those of one (item, chunk) merged by union."""

    def merged() -> Iterator[tuple]:
        held, containers, n = None, [], 0
        for batch in batches:
            for *key, container, occurrences in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != held:
                    if held:
                        yield *held, containers[0] if len(containers) == 1 else union(containers), n
                    held, containers, n = key, [], 0
                elif len(containers) > 64:
                    containers = [union(containers)]
                containers.append(container)
                n += occurrences
        if held:
            yield *held, containers[0] if len(containers) == 1 else union(containers), n

    return _batches(merged())


def term_index(df: DataFrame, fields: list[str], identifier: str) -> DataFrame:
    """The vertical index: `(field, unit, item, chunk, rows, occurrences)`, one row per item and chunk of records.

    A record with a null in a field holds nothing there; an empty text is a value without terms. Rows of one identifier are one
    record, whose occurrences add up. Rows without an identifier are no records. Other columns are ignored.
    """
    rows = df.where(F.col(f"`{identifier}`").isNotNull())
    rows = rows.select(F.col(f"`{identifier}`").cast("bigint").alias("_identifier"), *[F.col(f"`{c}`").cast("string").alias(c) for c in fields])
    parts = rows.mapInArrow(_index, POSTINGS)
    return parts.repartition("field", "unit", "item", "chunk").sortWithinPartitions("field", "unit", "item", "chunk").mapInArrow(_merge, POSTINGS)


def cardinality(container) -> F.Column:
    """Rows in a container."""
    return F.when(F.length(container) < CHUNK // 8, (F.length(container) / 2).cast("bigint")).otherwise(F.bitmap_count(container))


def frequencies(df: DataFrame, fields: list[str], identifier: str, *, rare: int = 2, common: float = 0.05) -> DataFrame:
    """`(field, unit, item, occurrences, n_rows, is_rare, is_common)` of every value (`unit` value) and word (`unit` term).

    Rare: in at most `rare` records. Common: in more than `common` of the rows where the field and the identifier are not null.
    In a very small table an item can be both.
    """
    index = term_index(df, fields, identifier)
    counts = index.groupBy("field", "unit", "item").agg(F.sum("occurrences").alias("occurrences"), F.sum(cardinality(F.col("rows"))).alias("n_rows"))
    filled = df.where(F.col(f"`{identifier}`").isNotNull()).agg(*[F.count(f"`{c}`").alias(str(i)) for i, c in enumerate(fields)]).first()
    limit = F.lit(None).cast("double")
    for i, c in enumerate(fields):
        limit = F.when(F.col("field") == c, F.lit(filled[str(i)] * common)).otherwise(limit)
    return counts.withColumns({"is_rare": F.col("n_rows") <= rare, "is_common": F.col("n_rows") > limit})


def marked(found: DataFrame) -> DataFrame:
    """`(field, unit, item, mark)`: a row for each mark of an item."""
    marks = F.filter(F.array(F.when(F.col("is_rare"), F.lit("rare")), F.when(F.col("is_common"), F.lit("common"))), lambda m: m.isNotNull())
    return found.select("field", "unit", "item", F.explode(marks).alias("mark"))
