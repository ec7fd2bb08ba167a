"""Finds benchmark items in texts within an edit budget, by the q-gram lemma.

An item of m bytes found with at most e edits keeps at least m - q + 1 - q e of its q-grams,
all on diagonals (place in the text minus place in the item) that differ by at most e. An item
leaves out its most common q-grams, up to half of that bound, and lowers the bound by as many.
The shared q-grams of each text and item are counted in diagonal bands of 2 (e + 1), each band
half over the next, and only bands that reach the bound are verified: a banded alignment gives
the least edits of the whole item against any stretch of the text there, and where that lies.

Texts and items are compared with A-Z lower-cased and any ASCII white space as a blank. The
budget is ``budget`` of the item's length, less for items so short that the bound would be
empty; items shorter than q bytes must occur exactly; items without any word are ignored, as
are items without id. Items are broadcast in blocks of at most ``BLOCK_BYTES`` of text: their
number grows with the benchmark, and every block meets all rows.

Nulls and empty texts hold no item. Repeated rows and ids are judged row by row, and other
columns are kept.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import appended, text_slices

Q = 8
BUDGET = 0.1
BLOCK_BYTES = 4 * 1024 * 1024
# Candidates aligned together.
ALIGNED = 64
_TABLE_BITS = 20

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[0x09:0x0E] = 0x20

_LEAK = pa.list_(
    pa.struct([(c, pa.int64()) for c in ("item_id", "start", "end", "edits")])
)
LEAK_TYPE = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:bigint>>"


def plain(text: bytes) -> np.ndarray:
    return _PLAIN[np.frombuffer(text, np.uint8)]


def grams(data: np.ndarray) -> np.ndarray:
    """The q-gram at each place, as an integer."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, Q)).view(
        np.uint64
    ).ravel()


def _slot(values: np.ndarray) -> np.ndarray:
    spread = values * np.uint64(0x9E3779B97F4A7C15)
    return (spread >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def _commonness(own: list[np.ndarray]) -> list[np.ndarray]:
    """How common each q-gram of the items is likely to be: by the halves' counts in them."""
    every = np.concatenate([*own, np.zeros(0, np.uint64)])
    product = np.ones(len(every), np.int64)
    for half in (every & np.uint64(0xFFFFFFFF), every >> np.uint64(32)):
        _, which, count = np.unique(half, return_inverse=True, return_counts=True)
        product *= count[which]
    return np.split(product, np.cumsum([len(g) for g in own])[:-1]) if own else []


class Items:
    """q-grams of one block of benchmark items."""

    def __init__(self, rows: list[tuple[int, bytes]], budget: float):
        rows = [(i, plain(t)) for i, t in rows]
        rows = [(i, t) for i, t in rows if i is not None and (t != 0x20).any()]
        self.ids = [i for i, _ in rows]
        self.texts = [t for _, t in rows]
        sizes = np.array([len(t) for t in self.texts], np.int64)
        able = np.maximum(sizes - Q, 0) // Q
        self.edits = np.minimum((budget * sizes).astype(np.int64), able)
        self.need = np.maximum(sizes - Q + 1 - Q * self.edits, 1)
        own = [grams(t) for t in self.texts]
        left_out = self.need // 2
        kept = [
            np.sort(np.argsort(c, kind="stable")[: len(c) - drop])
            for c, drop in zip(_commonness(own), left_out, strict=True)
        ]
        self.need = self.need - left_out
        every = np.concatenate([*[g[k] for g, k in zip(own, kept)], np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(own)), [len(k) for k in kept])
        place = np.concatenate([*kept, np.zeros(0, np.int64)])
        order = np.argsort(every, kind="stable")
        self.values, self.first = np.unique(every[order], return_index=True)
        self.count = np.diff(self.first, append=len(order))
        self.owner, self.place = owner[order], place[order].astype(np.int64)
        self.known = np.zeros(1 << _TABLE_BITS, bool)
        self.known[_slot(self.values)] = True
        self.short = [(k, t.tobytes()) for k, t in enumerate(self.texts) if len(t) < Q]

    def bands(self, data: np.ndarray, offsets: np.ndarray):
        """(text, item, lowest diagonal) of the bands that reach the bound."""
        none = [np.zeros(0, np.int64)] * 3
        every = grams(data)
        at = np.flatnonzero(self.known[_slot(every)]) if len(every) else none[0]
        if not len(at) or not len(self.values):
            return none
        near = np.minimum(np.searchsorted(self.values, every[at]), len(self.values) - 1)
        text = np.searchsorted(offsets, at, side="right") - 1
        hit = (self.values[near] == every[at]) & (at + Q <= offsets[text + 1])
        at, near, text = at[hit], near[hit], text[hit]
        if not len(at):
            return none
        times = self.count[near]
        at, text = np.repeat(at, times), np.repeat(text, times)
        within = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        entry = np.repeat(self.first[near], times) + within
        item = self.owner[entry]
        diagonal = at - offsets[text] - self.place[entry]
        step = self.edits[item] + 1
        band = diagonal // step
        # A band is two steps wide: a hit counts in the band of its step and the one before.
        pair = np.unique(text * len(self.ids) + item, return_inverse=True)
        low, spread = int(band.min()) - 1, int(band.max() - band.min()) + 2
        key = pair[1].ravel() * spread + band - low
        key, hits = np.unique(np.concatenate([key, key - 1]), return_counts=True)
        both = pair[0][key // spread]
        text, item, band = both // len(self.ids), both % len(self.ids), key % spread + low
        able = hits >= self.need[item]
        text, item, band = text[able], item[able], band[able]
        return text, item, band * (self.edits[item] + 1)


def aligned(cases: list[tuple[np.ndarray, np.ndarray, int, int]]):
    """(edits, start, end) of the best place of each item in its text.

    A case is (item, text, lowest diagonal, edit budget); only places within the budget of
    the band's diagonals are looked at. All cases run through the rows together.
    """
    n, rows = len(cases), max(len(c[0]) for c in cases)
    width = max(4 * (c[3] + 1) for c in cases)
    item = np.zeros((n, rows), np.int16)
    diagonal = np.array([c[2] - c[3] for c in cases])
    sizes = np.array([len(c[0]) for c in cases])
    text = np.full((n, rows + width), -1, np.int16)
    for k, (own, whole, _, _) in enumerate(cases):
        item[k, : len(own)] = own
        low, high = diagonal[k], min(diagonal[k] + rows + width, len(whole))
        if high > max(low, 0):
            text[k, max(low, 0) - low : high - low] = whole[max(low, 0) : high]
    column = np.arange(width)
    cost, far = 1 << 20, 1 << 40
    # Each cell holds edits * cost + the column where its path began.
    state = np.tile(column, (n, 1))
    inside = (diagonal[:, None] + column >= 0) & (
        diagonal[:, None] + column <= np.array([len(c[1]) for c in cases])[:, None]
    )
    state = np.where(inside, state, far)
    best = np.where(sizes == 0, 0, far)
    end = np.zeros(n, np.int64)
    for i in range(rows):
        taken = text[:, i : i + width]
        step = state + cost * (taken != item[:, i, None])
        step = np.where(taken < 0, far, step)
        step[:, :-1] = np.minimum(step[:, :-1], state[:, 1:] + cost)
        # Bytes of the text that the item lacks move along a row.
        add = np.where(taken < 0, far, 0)
        run = np.minimum.accumulate(step - cost * column, axis=1) + cost * column
        state = np.where(add > 0, step, run)
        done = np.flatnonzero(sizes == i + 1)
        if len(done):
            at = state[done].argmin(axis=1)
            best[done] = state[done, at]
            end[done] = diagonal[done] + i + 1 + at
    return best // cost, diagonal + best % cost, end


def _leaks(items: Items, held: list) -> dict[int, dict[int, tuple[int, int, int]]]:
    """Per row and item the best place within the budget."""
    found: dict[int, dict[int, tuple[int, int, int]]] = {}
    held.sort(key=lambda h: len(items.texts[h[2]]))
    for low in range(0, len(held), ALIGNED):
        part = held[low : low + ALIGNED]
        cases = [(items.texts[k], t, d, int(items.edits[k])) for _, t, k, d in part]
        for (row, _, k, _), edits, start, end in zip(part, *aligned(cases), strict=True):
            if edits <= items.edits[k]:
                place = (int(edits), int(start), int(end))
                own = found.setdefault(row, {})
                own[k] = min(own.get(k, place), place)
    return found


def _search(block, budget: float, name: str):
    built: list[Items] = []  # once for each task

    def make(batch: pa.RecordBatch):
        if not built:
            built.append(Items(block.value, budget))
        items, held, rows = built[0], [], [[] for _ in range(len(batch))]
        for low, _, data, offsets in text_slices(batch, name):
            data = _PLAIN[data]
            for text, item, diagonal in zip(*items.bands(data, offsets), strict=True):
                whole = data[offsets[text] : offsets[text + 1]]
                held.append((low + int(text), whole, int(item), int(diagonal)))
            for k, short in items.short:
                raw = data.tobytes()
                at = raw.find(short)
                while at >= 0:
                    text = int(np.searchsorted(offsets, at, side="right")) - 1
                    if at + len(short) <= offsets[text + 1] and not any(
                        r["item_id"] == items.ids[k] for r in rows[low + text]
                    ):
                        start = at - int(offsets[text])
                        rows[low + text].append(_row(items, k, 0, start, start + len(short)))
                    at = raw.find(short, at + 1)
        for row, own in _leaks(items, held).items():
            rows[row] += [_row(items, k, *place) for k, place in sorted(own.items())]
        return [rows]

    return make


def _row(items: Items, k: int, edits: int, start: int, end: int) -> dict[str, int]:
    return {"item_id": items.ids[k], "start": start, "end": end, "edits": edits}


def with_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    budget: float = BUDGET,
    block_bytes: int = BLOCK_BYTES,
    out_col: str = "leaks",
) -> DataFrame:
    """``df`` with a list of (item_id, start, end, edits) per row; places are byte positions."""
    spark = df.sparkSession
    items = benchmark.select(
        F.col(f"`{item_id_col}`").cast("long").alias("item_id"),
        F.coalesce(F.col(f"`{item_text_col}`"), F.lit("")).alias("text"),
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + 2 * total // block_bytes
    own = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    parts = []
    for k in range(blocks):
        rows = items.filter(own == k).distinct().orderBy("item_id", "text").collect()
        block = spark.sparkContext.broadcast([(r.item_id, r.text.encode()) for r in rows])
        make = _search(block, budget, text_col)
        parts.append(f"__leaks_{k}")
        df = appended(df, make, {parts[-1]: _LEAK}, f"`{parts[-1]}` {LEAK_TYPE}")
    leaks = reduce(F.concat, [F.col(p) for p in parts])
    return df.withColumn(out_col, F.array_sort(leaks)).drop(*parts)


def decontaminated(df: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``df`` without any benchmark item, its columns unchanged."""
    marked = with_leaks(df, benchmark, text_col, out_col="__leaks")
    return marked.filter(F.size("__leaks") == 0).drop("__leaks")
