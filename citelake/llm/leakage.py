"""Test items leaking into documents: q-gram counts in diagonal bands, an edit budget, and banded alignment.

Texts become their words in lower case with single blanks between and around them. A window of `words` words of an item, of
length L, that a document holds with at most `edits` edits shares at least L + 1 - q (edits + 1) of its q-grams with it, on
diagonals at most `edits` apart. Documents are read once: a table of the items' q-grams by a few bits of their hash tells
where q-grams lie so close together that a window can be there; only those are looked up, hits are counted per (document,
item, diagonal band), bands overlapping by half, and windows that reach their bound in a band go to a banded alignment,
which gives their smallest number of edits. Windows too short for a bound of 1 form a level of their own with a shorter q,
for which the lemma holds again, so nothing within the budget is missed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citelake.session import materialise, scratch_path

LETTERS = 0x34000  # no letter or digit has a code point beyond
BASE = 0x9E3779B97F4A7C15
CHARS_AT_A_TIME = 500_000
ITEM_CHARS = 8 << 20
HITS_AT_A_TIME = 2_000_000
MIX, CELLS = 0x9E3779B1, (1 << 21) - 1
FOUND = "doc_id bigint, item_id bigint, edits int, windows int"


@lru_cache
def fold_table() -> np.ndarray:
    """For every code point its lower-case letter or digit, 0 for all that is neither. Sigma has one lower case here, dotted capital I is i."""
    every = "".join(map(chr, range(LETTERS))).replace("İ", "i").replace("Σ", "σ").lower().replace("ς", "σ")
    table = np.zeros(0x110000, dtype=np.uint32)
    table[:LETTERS] = code_points(re.sub(r"[\W_]", "\0", every))
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def normal_forms(texts: list[str | None], gap: int, margin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, starts, sizes): the texts' normal forms in one array, `gap` zeros after each and `margin` around all; size 0 without words."""
    texts = [t or "" for t in texts]
    folded = fold_table()[code_points("\0".join([*texts, ""]))]
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    word = folded != 0
    keep = word.copy()
    keep[1:] |= word[:-1]  # what follows a word becomes a blank
    upto = np.cumsum(keep)[ends - 1] if len(ends) else ends
    n = np.diff(upto, prepend=0)
    starts = margin + np.cumsum(n + 1 + gap) - (n + 1 + gap)
    codes = np.zeros(int((n + 1 + gap).sum()) + 2 * margin, dtype=np.uint32)
    values = folded[keep]
    values[values == 0] = 32
    codes[np.arange(len(values)) + np.repeat(starts + 1 - (upto - n), n)] = values
    codes[starts[n > 0]] = 32
    return codes, starts, np.where(n > 0, n + 1, 0)


def gram_hashes(codes: np.ndarray, q: int, kind: type = np.uint64) -> np.ndarray:
    """A hash of the q-gram that starts at each place, by doubling widths."""
    size = len(codes)
    if size < q:
        return np.zeros(0, dtype=kind)
    space = 1 << (8 * kind().itemsize)
    base = BASE % space
    out, done, piece, width, bits = None, 0, codes.astype(kind) + kind(1), 1, q
    while bits:
        power = kind(pow(base, width, space))
        if bits & 1:
            m = size - done - width + 1
            out = piece if out is None else out[:m] * power + piece[done : done + m]
            done += width
        bits >>= 1
        if bits:
            piece = piece[:-width] * power + piece[width:]
            width *= 2
    out = out ^ (out >> kind(4 * kind().itemsize - 3))
    return out * kind(base)


def hashes_at(codes: np.ndarray, at: np.ndarray, q: int) -> np.ndarray:
    """The 64-bit hashes of the q-grams at some places."""
    h = np.zeros(len(at), dtype=np.uint64)
    for j in range(q):
        h = h * np.uint64(BASE) + codes[at + j] + np.uint64(1)
    return (h ^ (h >> np.uint64(29))) * np.uint64(BASE)


class Level:
    """The windows of one q: their bounds, and the q-grams inside them sorted by hash."""

    def __init__(self, q: int, edits: int, codes: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray, item_starts: np.ndarray, bits: int | None):
        self.q, self.n_items = q, len(item_starts)
        length = end - begin
        self.item, self.begin, self.length = item, begin - item_starts[item], length
        self.first_window = np.searchsorted(item, np.arange(self.n_items + 1))
        self.bound = length + 1 - q * (edits + 1)
        self.shortest, self.longest = int(length.min()), int(length.max())
        self.least = int(self.bound.min())
        self.span = self.shortest + edits - q + 1
        self.item_least = np.full(self.n_items, np.iinfo(np.int64).max)
        np.minimum.at(self.item_least, item, self.bound)
        inside = np.zeros(len(codes) + 1, dtype=np.int64)
        np.add.at(inside, begin, 1)
        np.add.at(inside, end - q + 1, -1)
        at = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
        h = hashes_at(codes, at, q)
        order = np.argsort(h, kind="stable")
        at = at[order]
        self.posting_item = np.searchsorted(item_starts, at, side="right") - 1
        self.posting_place = at - item_starts[self.posting_item]
        self.grams, self.first, self.count = np.unique(h[order], return_index=True, return_counts=True)
        self.keys = np.repeat(np.arange(len(self.grams)), self.count) * self.n_items + self.posting_item
        bits = bits or min(26, max(16, int(8 * len(at)).bit_length()))
        self.shift = np.uint32(32 - bits)
        self.maybe = np.zeros(1 << bits, dtype=bool)
        self.maybe[gram_hashes(codes, q, np.uint32)[at] >> self.shift] = True

    def close(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(may be a gram, lies where grams are so close together that a window can be there), by place."""
        hit = self.maybe[gram_hashes(codes, self.q, np.uint32) >> self.shift]
        return hit, _covered(hit, self.span, self.least)


def _covered(hit: np.ndarray, span: int, least: int) -> np.ndarray:
    """Places in a run of `span` places with at least `least` hits."""
    upto = np.concatenate([[0], np.cumsum(hit, dtype=np.int32)])
    dense = upto[span:] - upto[:-span] >= least
    begun = np.concatenate([np.zeros(span, dtype=np.int32), np.cumsum(dense, dtype=np.int32), np.full(span - 1, dense.sum(), dtype=np.int32)])
    return begun[span:] > begun[:-span]


class Items:
    """Items by number, with one or two levels of windows."""

    def __init__(self, ids: list[int], texts: list[str | None], words: int = 12, edits: int = 2, q: int = 12, bits: int | None = None):
        self.ids, self.edits = np.array(ids, dtype=np.int64), edits
        self.codes, starts, sizes = normal_forms(texts, 1, q)
        self.starts = starts
        blanks = np.flatnonzero(self.codes == 32)
        owner = np.searchsorted(starts, blanks, side="right") - 1
        whole = np.flatnonzero(owner[words:] == owner[:-words]) if len(blanks) > words else np.zeros(0, dtype=np.int64)
        begin, end, item = blanks[whole], blanks[whole + words] + 1, owner[whole]
        self.longest = int((end - begin).max()) if len(whole) else 0
        self.step = max(1, edits)
        self.width = 2 * self.step + 2 * edits
        self.gap = self.width + q
        short = end - begin + 1 - q * (edits + 1) < 1
        self.levels = []
        for some, size in ((~short, q), (short, max(1, (2 * words + 1) // (edits + 1)))):
            if some.any():
                self.levels.append(Level(size, edits, self.codes, item[some], begin[some], end[some], starts, bits))

    @property
    def margin(self) -> int:
        return self.longest + self.gap + self.edits


def align(pattern: np.ndarray, at: np.ndarray, lengths: np.ndarray, text: np.ndarray, place: np.ndarray, width: int, edits: int) -> np.ndarray:
    """Fewest edits of each window `pattern[at : at + length]` against `text` inside a band; `edits` + 1 stands for more.

    Window k may begin at any of the `width` places from `place[k]` on and stays on the diagonals those places begin; its end
    is free as well. All windows advance together, and those beyond `edits` on every diagonal are dropped on the way.
    """
    best = np.full(len(at), edits + 1, dtype=np.int8)
    alive = np.arange(len(at))
    cost = np.zeros((len(at), width), dtype=np.int8)
    band = np.arange(width)
    i = 0
    while len(alive):
        there = text[(place[alive] + i)[:, None] + band]
        new = cost + (there != pattern[at[alive] + i][:, None])
        np.minimum(new[:, :-1], cost[:, 1:] + 1, out=new[:, :-1])
        for _ in range(edits):
            np.minimum(new[:, 1:], new[:, :-1] + 1, out=new[:, 1:])
        cost, i = new, i + 1
        ended = lengths[alive] == i
        if ended.any():
            best[alive[ended]] = np.minimum(cost[ended].min(axis=1), edits + 1)
        if i % 4 == 0 or ended.any():
            keep = ~ended & (cost.min(axis=1) <= edits)
            alive, cost = alive[keep], cost[keep]
    return best


def _parts(level: Level, at: np.ndarray, slot: np.ndarray, reach: int) -> Iterator[tuple[slice, int, int]]:
    """(places, first item, last item) with a bounded number of hits each: overlapping stretches of text, then ranges of items.

    A gram that many items hold is so split over the items. Stretches overlap by `reach`, so each window is whole in one.
    """
    hits = np.concatenate([[0], np.cumsum(level.count[slot])])
    todo = [(0, len(at), 0, level.n_items)]
    while todo:
        lo, hi, first, last = todo.pop()
        if hi <= lo:
            continue
        if first == 0 and last == level.n_items:
            n = hits[hi] - hits[lo]
        else:
            n = (np.searchsorted(level.keys, slot[lo:hi] * level.n_items + last) - np.searchsorted(level.keys, slot[lo:hi] * level.n_items + first)).sum()
        if n > HITS_AT_A_TIME and at[hi - 1] - at[lo] > 2 * reach:
            middle = (at[lo] + at[hi - 1]) // 2
            todo += [(lo, int(np.searchsorted(at, middle + reach)), first, last), (int(np.searchsorted(at, middle)), hi, first, last)]
        elif n > HITS_AT_A_TIME and last - first > 1:
            middle = (first + last) // 2
            todo += [(lo, hi, first, middle), (lo, hi, middle, last)]
        elif n:
            yield slice(lo, hi), first, last


def _groups(level: Level, at: np.ndarray, slot: np.ndarray, first: int, last: int, starts: np.ndarray, step: int) -> tuple[np.ndarray, ...]:
    """Hits (group, place) and per group (text, item, band): places distinct and in order, groups with enough hits close together only."""
    low = np.searchsorted(level.keys, slot * level.n_items + first)
    times = np.searchsorted(level.keys, slot * level.n_items + last) - low
    entry = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - low, times)
    position = np.repeat(at, times)
    item, place = level.posting_item[entry], level.posting_place[entry]
    text = np.searchsorted(starts, position, side="right") - 1
    low = np.floor_divide(position - place, step)
    # Counts per (text, item, step), some steps sharing a counter: a hit stays if one of its two bands may have enough.
    cell = ((text * level.n_items + item) * MIX + low) & CELLS
    count = np.bincount(cell, minlength=CELLS + 1)
    keep = count[cell] + np.maximum(count[(cell + 1) & CELLS], count[(cell - 1) & CELLS]) >= level.item_least[item]
    text, item, place, low = text[keep], item[keep], place[keep], low[keep]
    # A hit counts in the band that begins in its step and in the one that began a step earlier.
    text, item, place, band = *(np.concatenate([x, x]) for x in (text, item, place)), np.concatenate([low, low - 1])
    order = np.lexsort((place, band, text * level.n_items + item))
    text, item, place, band = text[order], item[order], place[order], band[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
    fresh = new.copy()
    fresh[1:] |= place[1:] != place[:-1]
    group, place = (np.cumsum(new) - 1)[fresh], place[fresh]
    text, item, band = text[new], item[new], band[new]
    # Some run of as many hits as the item's easiest window needs is no longer than the longest window.
    need = level.item_least[item[group]]
    other = np.minimum(np.arange(len(group)) + need - 1, len(group) - 1)
    close = (np.arange(len(group)) + need - 1 < len(group)) & (group[other] == group) & (place[other] - place <= level.longest - level.q)
    good = np.zeros(len(text), dtype=bool)
    good[group[close]] = True
    number = np.cumsum(good) - 1
    keep = good[group]
    return number[group[keep]], place[keep], text[good], item[good], band[good]


def find(items: Items, codes: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text number, item number, fewest edits, windows) of every text that holds a window of an item."""
    edits, step = items.edits, items.step
    found = []
    for at_level, level in enumerate(items.levels):
        hit, near = level.close(codes)
        at = np.flatnonzero(hit & near)
        h = hashes_at(codes, at, level.q)
        slot = np.minimum(np.searchsorted(level.grams, h), len(level.grams) - 1)
        same = level.grams[slot] == h
        at, slot = at[same], slot[same]
        for places, first_item, last_item in _parts(level, at, slot, items.longest + 2 * edits + level.q):
            group, place, text, item, band = _groups(level, at[places], slot[places], first_item, last_item, starts, step)
            if not len(text):
                continue
            n = level.first_window[item + 1] - level.first_window[item]
            of = np.repeat(np.arange(len(text)), n)
            window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - level.first_window[item], n)
            begin, length = level.begin[window], level.length[window]
            key, top = group * (1 << 32) + place, of * (1 << 32)
            inside = np.searchsorted(key, top + begin + length - level.q, side="right") - np.searchsorted(key, top + begin)
            keep = inside >= level.bound[window]
            of, window, begin, length = of[keep], window[keep], begin[keep], length[keep]
            best = align(items.codes, items.starts[item[of]] + begin, length, codes, begin + band[of] * step - edits, items.width, edits)
            good = best <= edits
            found.append(np.stack([text[of[good]], item[of[good]], window[good] * len(items.levels) + at_level, best[good]]))
    if not found:
        return []
    text, item, window, best = np.concatenate(found, axis=1)
    order = np.lexsort((best, window, item, text))
    text, item, window, best = text[order], item[order], window[order], best[order]
    if not len(text):
        return []
    new = np.r_[True, (text[1:] != text[:-1]) | (item[1:] != item[:-1])]
    other = np.r_[True, new[1:] | (window[1:] != window[:-1])]
    at = np.flatnonzero(new)
    return list(zip(text[at].tolist(), item[at].tolist(), np.minimum.reduceat(best, at).tolist(), np.add.reduceat(other.astype(np.int64), at).tolist(), strict=True))


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of about `CHARS_AT_A_TIME` characters; a longer text is one by itself."""
    texts, first, size = [], 0, 0
    for n, value in enumerate(batch.column(1)):
        texts.append(value.as_py())
        size += len(texts[-1] or "")
        if size >= CHARS_AT_A_TIME:
            yield first, texts
            texts, first, size = [], n + 1, 0
    if texts:
        yield first, texts


def _rows(ids: pa.Array, items: Items, out: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    row, item, edits, windows = (np.array(c, dtype=np.int64) for c in (zip(*out, strict=True) if out else [[]] * 4))
    columns = [ids.take(pa.array(row)), pa.array(items.ids[item]), pa.array(edits, pa.int32()), pa.array(windows, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "edits", "windows"])


#: The index of this worker process and the broadcast it is made from.
_HELD: dict = {}


def _items(broadcast, words: int, edits: int, q: int) -> Items:
    key = (broadcast._path if hasattr(broadcast, "_path") else id(broadcast), words, edits, q)
    if _HELD.get("key") != key:
        _HELD.update(key=key, items=Items(*broadcast.value, words, edits, q))
    return _HELD["items"]


def _search(broadcast, words: int, edits: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _items(broadcast, words, edits, q)
        for batch in batches:
            out = []
            for first, texts in _chunks(batch) if items.levels else ():
                codes, starts, _ = normal_forms(texts, items.gap, items.margin)
                out += [(first + t, *rest) for t, *rest in find(items, codes, starts)]
            yield _rows(batch.column(0), items, out)

    return run


def _narrow(broadcast):
    """Each document's normal form where windows of any item can be, stretches parted by zeros; no row without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, longest, edits, gap = broadcast.value
        reach = longest + edits + 2 * gap
        for batch in batches:
            rows, kept = [], []
            for first, texts in _chunks(batch):
                codes, starts, sizes = normal_forms(texts, gap, longest + gap + edits)
                live = np.zeros(len(codes), dtype=bool)
                for q, span, least, shift, packed in levels:
                    hit = np.unpackbits(packed).view(bool)[gram_hashes(codes, q, np.uint32) >> shift]
                    near = np.flatnonzero(_covered(hit, span, least))
                    live[near] = True
                edge = np.flatnonzero(np.diff(np.concatenate([[0], _covered(live, 2 * reach + 1, 1)[:len(live)].view(np.int8), [0]])))
                for begin, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    for t in range(int(np.searchsorted(starts, begin, side="right")) - 1, int(np.searchsorted(starts, end))):
                        lo, hi = max(begin, int(starts[t])), min(end, int(starts[t] + sizes[t])) if t >= 0 else 0
                        if t >= 0 and lo < hi:
                            stretch = codes[lo:hi].tobytes().decode("utf-32-le", "surrogatepass")
                            if rows and rows[-1] == first + t:
                                kept[-1] += "\0" * gap + stretch
                            else:
                                rows.append(first + t)
                                kept.append(stretch)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(kept, pa.string())], names=["doc_id", "text"])

    return run


def _search_narrowed(broadcast, words: int, edits: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _items(broadcast, words, edits, q)
        margin, gap = np.zeros(items.margin, dtype=np.uint32), np.zeros(items.gap, dtype=np.uint32)
        for batch in batches:
            out = []
            for first, texts in _chunks(batch) if items.levels else ():
                coded = [code_points(t) for t in texts]
                starts = len(margin) + np.cumsum([0, *[len(c) + len(gap) for c in coded]])[:-1]
                codes = np.concatenate([margin, *[x for c in coded for x in (c, gap)], margin])
                out += [(first + t, *rest) for t, *rest in find(items, codes, starts)]
            yield _rows(batch.column(0), items, out)

    return run


def find_leaks(
    documents: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text",
    words: int = 12, edits: int = 2, q: int = 12, item_chars: int = ITEM_CHARS,
) -> DataFrame:
    """`(doc_id, item_id, edits, windows)`: documents that hold `words` consecutive words of an item with at most `edits` edits.

    `edits` in the result is the fewest of any window (0: word for word), `windows` how many of the item's windows were found.
    Nothing within the budget is missed. Items with fewer than `words` words, and null or wordless texts, give nothing.
    Documents repeated under one id come out as often as they are there; so do items. Whole texts count, however long.

    The documents are read once and never moved. Items of up to `item_chars` characters in all are broadcast. More of them go
    in blocks of that size: the one pass over the documents then keeps only the stretches where some item's window can be,
    written to the shared folder, and every block is searched in those, one block on the driver at a time.
    """
    if q < 1 or edits < 0 or words < 1:
        raise ValueError("q and words must be positive, edits not negative")
    context = documents.sparkSession.sparkContext
    docs = documents.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{doc_text}`").alias("text"))
    pairs = items.select(F.col(f"`{item_id}`").cast("bigint").alias("i"), F.col(f"`{item_text}`").alias("t")).where("i is not null and t is not null")
    size = pairs.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]

    def block(of: DataFrame) -> tuple[list[int], list[str]]:
        rows = of.collect()
        return [r["i"] for r in rows], [r["t"] for r in rows]

    if size <= item_chars:
        return docs.mapInArrow(_search(context.broadcast(block(pairs)), words, edits, q), FOUND)
    blocks = -(-size // item_chars)
    spark = documents.sparkSession
    stored = scratch_path(spark, "items")
    pairs.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(blocks))).hint("rebalance", "b").write.partitionBy("b").parquet(stored)
    filled = sorted(r["b"] for r in spark.read.parquet(stored).select("b").distinct().collect())  # one number a block

    def items_of(b: int) -> tuple[list[int], list[str]]:
        return block(spark.read.schema("i bigint, t string").parquet(f"{stored}/b={b}"))

    levels: dict[int, list] = {}
    longest = gap = 0
    for b in filled:
        part = Items(*items_of(b), words, edits, q, bits=26)
        longest, gap = max(longest, part.longest), max(gap, part.gap)
        for level in part.levels:
            known = levels.get(level.q)
            if known is None:
                levels[level.q] = [level.q, level.span, level.least, level.shift, level.maybe.copy()]
            else:
                known[1], known[2] = min(known[1], level.span), min(known[2], level.least)
                known[4] |= level.maybe
    packed = context.broadcast(([(q_, span, least, shift, np.packbits(m)) for q_, span, least, shift, m in levels.values()], longest, edits, gap))
    narrowed = materialise(docs.mapInArrow(_narrow(packed), "doc_id bigint, text string"), "narrowed")
    place = scratch_path(spark, "leaks")
    for b in filled:
        held = context.broadcast(items_of(b))
        narrowed.mapInArrow(_search_narrowed(held, words, edits, q), FOUND).write.mode("append").parquet(place)
        held.destroy()
    return spark.read.schema(FOUND).parquet(place)
