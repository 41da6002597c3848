"""Nested records as columns with repetition and definition levels, and flat tables from those levels.

A page of works is taken apart along its leaf paths. Each path becomes one column of entries: a repetition level (at which
repeated ancestor a new element began), a definition level (how much of the path is there) and a value. Two entries of a
level's definition belong to a repeated ancestor: one for an element's place, one more if the element holds something, so
null and blank elements keep their place. The table of a repeated ancestor (works, authors, affiliations, subjects,
references) comes from the levels alone: places are running counts of repetitions, presence is a definition level.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _blank(x: object) -> bool:
    """Null, empty, or white space only."""
    return x is None or x in ({}, [], "") or (isinstance(x, str) and not x.strip())


def _as_list(x: object, text_is_json: bool) -> list:
    """The elements of an array, of a single element in its place, or of JSON text if the field may be given so."""
    if text_is_json and isinstance(x, str):
        try:
            x = json.loads(x)
        except ValueError:
            return []
    if isinstance(x, list):
        return x
    return [] if x is None or x == "" else [x]


def _text(x: object) -> str | None:
    """A scalar as text; a list of scalars joined by blanks; an object as JSON."""
    if x is None or isinstance(x, str):
        return x
    if isinstance(x, list) and all(y is None or isinstance(y, str) for y in x):
        return " ".join(y for y in x if y is not None)
    return json.dumps(x, ensure_ascii=False, separators=(",", ":"))


@dataclass(frozen=True)
class Repeated:
    """A repeated field: its leaves (name to key path; an empty path is the element itself) and repeated fields inside it."""

    name: str
    key: str
    leaves: dict[str, tuple[str, ...]]
    inner: tuple[Repeated, ...] = ()
    text_is_json: bool = False
    scalar: bool = False


AFFILIATION = Repeated("affiliation", "affiliation", {"affiliation_name": ("name",)})
AUTHOR = Repeated("author", "author", {"given": ("given",), "family": ("family",), "sequence": ("sequence",)}, (AFFILIATION,), text_is_json=True)
SUBJECT = Repeated("subject", "subject", {"subject": ()}, scalar=True)
REFERENCE = Repeated("reference", "reference", {"reference_key": ("key",), "reference_doi": ("DOI",), "reference_year": ("year",), "reference_json": ()}, text_is_json=True)
WORK = Repeated(
    "work",
    "items",
    {
        "doi": ("DOI",), "title": ("title",), "publisher": ("publisher",), "container_title": ("container-title",), "type": ("type",),
        "reference_count": ("reference-count",), "referenced_by_count": ("is-referenced-by-count",), "created": ("created", "date-time"),
    },
    (AUTHOR, SUBJECT, REFERENCE),
)


@dataclass
class Column:
    """One leaf path of many pages: its levels and values."""

    rep: list[int] = field(default_factory=list)
    dfn: list[int] = field(default_factory=list)
    val: list[str | None] = field(default_factory=list)

    def add(self, rep: int, dfn: int, value: str | None = None) -> None:
        self.rep.append(rep)
        self.dfn.append(dfn)
        self.val.append(value)


def leaf_paths(spec: Repeated, above: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    here = (*above, spec.name)
    return [*((*here, leaf) for leaf in spec.leaves), *(p for s in spec.inner for p in leaf_paths(s, here))]


class Shredder:
    """Takes pages apart into one `Column` per leaf path of `spec`."""

    def __init__(self, spec: Repeated = WORK):
        self.spec = spec
        self.columns = {path: Column() for path in leaf_paths(spec)}
        self._below = {}
        self._index(spec, ())

    def _index(self, spec: Repeated, above: tuple[str, ...]) -> None:
        here = (*above, spec.name)
        self._below[here] = [self.columns[p] for p in leaf_paths(spec, above)]
        for s in spec.inner:
            self._index(s, here)

    def page(self, content: str | None) -> None:
        """Add one page; one that is no complete JSON object, or has no items, is an entry of definition level 0."""
        try:
            message = json.loads(content)["message"]
            items = message["items"] if isinstance(message, dict) else None
        except (ValueError, TypeError, KeyError, RecursionError):
            items = None
        self._repeated(self.spec, (), items, 0, 0)

    def _repeated(self, spec: Repeated, above: tuple[str, ...], value: object, rep: int, depth: int) -> None:
        here = (*above, spec.name)
        elements = _as_list(value, spec.text_is_json)
        if not elements:
            for column in self._below[here]:
                column.add(rep, 2 * depth)
            return
        for i, x in enumerate(elements):
            r = rep if i == 0 else depth + 1
            if _blank(x) or (spec.scalar and isinstance(x, (dict, list))):
                for column in self._below[here]:
                    column.add(r, 2 * depth + 1)
                continue
            for leaf, keys in spec.leaves.items():
                v = x
                for k in keys:
                    v = v.get(k) if isinstance(v, dict) else None
                v = _text(v)
                self.columns[(*here, leaf)].add(r, 2 * depth + 2 + (v is not None), v)
            for s in spec.inner:
                self._repeated(s, here, x.get(s.key) if isinstance(x, dict) else None, r, depth + 1)


def places(rep: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each entry, the place of each of its `depth` repeated ancestors, from the repetition levels alone."""
    out = []
    for level in range(1, depth + 1):
        starts = rep <= level
        count = np.cumsum(starts)
        outer = np.maximum.accumulate(np.where(rep < level, np.arange(len(rep)), 0))
        out.append((count - count[outer]).astype(np.int32))
    return out


def table_of(columns: dict[tuple[str, ...], Column], path: tuple[str, ...], leaves: list[str]) -> dict[str, np.ndarray | list]:
    """The elements of the repeated ancestor at `path`: page number, the places of all ancestors down to it, and its leaves."""
    depth = len(path)
    lead = columns[(*path, leaves[0])]
    rep, dfn = np.asarray(lead.rep, dtype=np.int8), np.asarray(lead.dfn, dtype=np.int8)
    there = dfn >= 2 * depth
    out: dict = {"page": (np.cumsum(rep == 0) - 1)[there]}
    for level, place in enumerate(places(rep, depth), 1):
        out[f"place{level}"] = place[there]
    keep = np.flatnonzero(there)
    for leaf in leaves:
        values = columns[(*path, leaf)].val
        out[leaf] = [values[i] for i in keep]
    return out


def only(spec: Repeated, path: tuple[str, ...]) -> Repeated:
    """The part of `spec` that the table at `path` needs: its leaves, and the repeated fields on the way to it."""
    rest = path[1:]
    if not rest:
        return replace(spec, inner=())
    return replace(spec, leaves={}, inner=tuple(only(s, rest) for s in spec.inner if s.name == rest[0]))


PATHS = {
    "work": (("work",), list(WORK.leaves)),
    "author": (("work", "author"), list(AUTHOR.leaves)),
    "affiliation": (("work", "author", "affiliation"), list(AFFILIATION.leaves)),
    "subject": (("work", "subject"), list(SUBJECT.leaves)),
    "reference": (("work", "reference"), list(REFERENCE.leaves)),
}
PLACES = {"work": ["item_no"], "author": ["item_no", "child_no"], "affiliation": ["item_no", "child_no", "sub_no"], "subject": ["item_no", "child_no"], "reference": ["item_no", "child_no"]}


def _pages_at_a_time(batches: Iterator[pa.RecordBatch], size: int, spec: Repeated = WORK) -> Iterator[tuple[list, Shredder]]:
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            part = batch.slice(start, size)
            shredder = Shredder(spec)
            for content in part.column(1):
                shredder.page(content.as_py())
            yield part.column(0), shredder


def _flatten(kind: str, size: int) -> Callable:
    path, leaves = PATHS[kind]
    spec = only(WORK, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members, shredder in _pages_at_a_time(batches, size, spec):
            t = table_of(shredder.columns, path, leaves)
            arrays = [members.take(pa.array(t["page"]))]
            arrays += [pa.array(t[f"place{i}"], pa.int32()) for i in range(1, len(path) + 1)]
            arrays += [pa.array(t[leaf], pa.string()) for leaf in leaves]
            yield pa.RecordBatch.from_arrays(arrays, names=["member", *PLACES[kind], *leaves])

    return run


def flat_table(pages: DataFrame, kind: str, *, member: str = "member", content: str = "content", pages_at_a_time: int = 16) -> DataFrame:
    """The flat table of `kind` (`work`, `author`, `affiliation`, `subject`, `reference`) with the places of its parents.

    A page that is null, empty, no complete JSON or without items has no rows. A single object (or single text, for subjects)
    in place of an array is an array of one; authors and references given as JSON text count as what it holds. Null, empty
    and blank elements keep their place and have no row. Pages delivered twice, and pages with a null member, each count.
    """
    path, leaves = PATHS[kind]
    schema = T.StructType([T.StructField("member", T.StringType()), *[T.StructField(c, T.IntegerType()) for c in PLACES[kind]], *[T.StructField(c, T.StringType()) for c in leaves]])
    return pages.select(f"`{member}`", f"`{content}`").mapInArrow(_flatten(kind, pages_at_a_time), schema)


def _children(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members, shredder in _pages_at_a_time(batches, size):
            for kind in ("author", "affiliation", "reference", "subject"):
                path, leaves = PATHS[kind]
                t = table_of(shredder.columns, path, leaves[:1])
                n = len(t["page"])
                sub = t["place3"] if len(path) == 3 else np.full(n, -1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [members.take(pa.array(t["page"])), pa.array(t["place1"]), pa.array([kind] * n, pa.string()), pa.array(t["place2"]), pa.array(sub)],
                    names=["member", "item_no", "kind", "child_no", "sub_no"],
                )

    return run


def child_places(pages: DataFrame, *, member: str = "member", content: str = "content", pages_at_a_time: int = 16) -> DataFrame:
    """`(member, item_no, kind, child_no, sub_no)` of every child of every work, as `flat_table` finds them, in one pass."""
    schema = "member string, item_no int, kind string, child_no int, sub_no int"
    return pages.select(f"`{member}`", f"`{content}`").mapInArrow(_children(pages_at_a_time), schema)
