"""Document quality by co-training on text content and on metadata.

Two logistic classifiers see different views of a document: the content view has the
frequencies of its byte trigrams in hashed slots, the metadata view its language, source, stated
and real length and the layout (lines, word length, shares of character kinds). Both start from
the labelled rows. In each round each view labels the rows without a label that it is surest of,
wherever they are in the table, and the other view learns from them. At the end each view is
calibrated on labelled rows kept aside, and a small logistic model of both calibrated logits
scores every document.

* The start is fitted on at most ``labelled`` labelled ids that have a row, chosen by a hash of
  the id, with one row of each. Several labels of an id count as good only if all are.
* All other rows take part in every round. Their views are stored once in the shared scratch
  folder. A pass counts each model's logits in a histogram, from which follows what the surest
  ``SHARE`` of the rows are; further passes add up the slopes of the loss over the rows that the
  other view has labelled so. Whole numbers are added, so the way the rows are dealt out to
  tasks changes nothing, and only these sums reach the driver. Labelled rows and pseudo-labelled
  ones have a fixed ratio of weights, whatever their numbers.

Nulls and empty texts have empty views and get a score like any other row; null metadata is a
value of its own, missing metadata columns count as null, and a language or source that no labelled
row has is neutral. Very long texts are read whole. With no labels, or one class only, nothing is
rejected. Rows of equal logits get their pseudo-labels together. Repeated rows are scored one by
one, and each counts in the rounds; an empty table gives no rows. Other columns are kept,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import appended, stored, text_slices, unused
from tillstar.llm.shingles import word_hashes

SLOTS, NAMES = 512, 1024
LABELLED = 3_000
ROUNDS, SURE, SHARE = 4, 0.95, 0.1
# Passes over the pool for slopes in a round, steps after each one, and the pool's weight.
PASSES, STEPS, PULL = 2, 10, 0.25
# Logits in the histogram: bins of a tenth from -20 to 20.
BINS, FINE = 401, 10
# Slopes of a row are rounded to this part of one; no standardised value counts as more than LARGE.
PART, LARGE = 2**20, 30.0
KEEP_FROM = 0.5
_KINDS = 12


def _letters() -> np.ndarray:
    """Kind of each byte: 0 other text, 1 lower, 2 upper, 3 digit, 4 blank, 5 line end, 6 sign."""
    kind = np.zeros(256, np.int64)
    kind[33:127] = 6
    kind[48:58], kind[65:91], kind[97:123] = 3, 2, 1
    kind[[9, 11, 12, 13, 32]], kind[10] = 4, 5
    return kind


_KIND = _letters()


def _sameness(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Share of each text's words that repeat the word before them."""
    words, first = word_hashes(data, offsets)
    same = np.zeros(len(words) + 1, np.int64)
    same[2:] = np.cumsum(words[1:] == words[:-1]) if len(words) else 0
    low, high = first[:-1], first[1:]
    pairs = np.maximum(high - low - 1, 0)
    inner = same[high] - same[np.minimum(low + 1, high)]
    return np.where(pairs > 0, inner / np.maximum(pairs, 1), 0.0)


def content(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text the square roots of the shares of hashed byte trigrams, their entropy and
    largest share, and the share of words said twice in a row."""
    n = len(offsets) - 1
    counts = np.zeros((n, SLOTS))
    if len(data) > 2:
        b = data.astype(np.uint32)
        gram = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        slot = (gram * np.uint32(0x9E3779B1)) >> np.uint32(23)
        text = np.repeat(np.arange(n), np.diff(offsets))
        whole = text[:-2] == text[2:]
        counts = np.bincount(text[:-2][whole] * SLOTS + slot[whole], minlength=n * SLOTS)
        counts = counts.reshape(n, SLOTS)
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    entropy = -(share * np.log(np.where(share > 0, share, 1))).sum(axis=1)
    whole = np.stack([entropy, share.max(axis=1), _sameness(data, offsets)], 1)
    return np.concatenate([np.sqrt(share), whole], axis=1)


def _slots(values: list[str | None]) -> np.ndarray:
    """Slots of names by their hash, null in the first."""
    return np.array([0 if v is None else 1 + crc32(v.encode()) % (NAMES - 1) for v in values])


def _named(view: np.ndarray) -> np.ndarray:
    """The weights' places of each row's language and source."""
    return view[:, _KINDS:].astype(np.int64) + np.array([0, NAMES]) + _KINDS


def _opened(view: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Metadata with one column for each place of ``used``."""
    slots = _named(view)
    named = (slots[:, :1] == used) | (slots[:, 1:] == used)
    return np.concatenate([view[:, :_KINDS], named], axis=1)


def _metadata_logits(view: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return view[:, :_KINDS] @ weights[:_KINDS] + weights[_named(view)].sum(axis=1)


def metadata(data, offsets, langs, sources, stated) -> np.ndarray:
    """Per text ``_KINDS`` numbers, then the slots of its language and of its source."""
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    kinds = np.bincount(text * 8 + _KIND[data], minlength=n * 8).reshape(n, 8)
    size = np.diff(offsets)
    blank = (_KIND[data] == 4) | (_KIND[data] == 5)
    # A word ends before a blank and at the end of its text, whatever text comes next.
    ends = np.append(blank[1:] | (text[1:] != text[:-1]), True)[: len(blank)] & ~blank
    words = np.bincount(text[ends], minlength=n)
    lines = kinds[:, 5] + (size > 0)
    told = np.array([-1 if s is None else s for s in stated], np.float64)
    numbers = [
        np.log1p(size),
        np.log1p(np.maximum(told, 0)),
        told < 0,
        np.log1p(lines),
        np.log1p(words / np.maximum(lines, 1)),
        size / np.maximum(words, 1) / 10,
        *(kinds[:, k] / np.maximum(size, 1) for k in (1, 2, 3, 5, 6)),
        size == 0,
    ]
    return np.stack([*numbers, _slots(langs), _slots(sources)], 1)


def _views(batch: pa.RecordBatch, text_col: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    def column(name):
        held = name in batch.schema.names
        return batch.column(name).to_pylist() if held else [None] * len(batch)

    langs, sources, stated = column("lang"), column("source"), column("n_chars")
    for low, high, data, offsets in text_slices(batch, text_col):
        told = langs[low:high], sources[low:high], stated[low:high]
        yield content(data, offsets), metadata(data, offsets, *told)


class Linear:
    """Logistic regression on standardised columns."""

    def __init__(self, x: np.ndarray, y: np.ndarray, steps: int = 150, decay: float = 1e-3):
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = (x - self.mean) / self.spread
        self.weights, self.bias = np.zeros(z.shape[1]), 0.0
        both = [self.weights, np.zeros(1)]
        first, second = ([np.zeros_like(p) for p in both] for _ in range(2))
        for step in range(1, steps + 1):
            miss = 1 / (1 + np.exp(-np.clip(z @ both[0] + both[1], -30, 30))) - y
            slopes = [z.T @ miss / len(y) + decay * both[0], np.array([miss.mean()])]
            for p, m, v, g in zip(both, first, second, slopes, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.weights, self.bias = both[0], float(both[1][0])

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.spread

    def pulled(self, x, y, pull: np.ndarray, decay: float = 1e-3) -> Linear:
        """The model after a few steps on ``x`` and the slopes ``pull`` of other rows, its last
        entry that of the bias."""
        z, moved = self.scaled(x), copy(self)
        both = np.append(self.weights, self.bias)
        m, v = np.zeros_like(both), np.zeros_like(both)
        for step in range(1, STEPS + 1):
            miss = 1 / (1 + np.exp(-np.clip(z @ both[:-1] + both[-1], -30, 30))) - y
            g = np.append(z.T @ miss / len(y) + decay * both[:-1], miss.mean()) + pull
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            both -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        moved.weights, moved.bias = both[:-1], float(both[-1])
        return moved

    def logits(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.spread) @ self.weights + self.bias

    def folded(self) -> tuple[np.ndarray, float]:
        """Weights and bias for columns as they are."""
        weights = self.weights / self.spread
        return weights, self.bias - float(self.mean @ weights)


def _bins(logits: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(logits * FINE, -(BINS // 2), BINS // 2)).astype(np.int64) + BINS // 2


def histograms(views: list[np.ndarray], models: list[Linear]) -> np.ndarray:
    """Counts of the logits' bins, of one view after the other."""
    counts = [
        np.bincount(_bins(m.logits(v)), minlength=BINS) for m, v in zip(models, views, strict=True)
    ]
    return np.concatenate(counts)


def surest(counts: np.ndarray) -> tuple[int, int]:
    """(last bin of sure bad rows, first bin of sure good ones): the ends of the histogram up
    to ``SHARE`` of the rows, with the bin that reaches it, as far as they are sure."""
    wanted = max(1.0, SHARE * counts.sum())
    sure = np.log(SURE / (1 - SURE)) * FINE
    low = int(np.searchsorted(np.cumsum(counts), wanted))
    high = BINS - 1 - int(np.searchsorted(np.cumsum(counts[::-1]), wanted))
    return min(low, BINS // 2 - int(np.ceil(sure))), max(high, BINS // 2 + int(np.ceil(sure)))


def slopes(views, teachers: list[Linear], cuts, models: list[Linear]) -> np.ndarray:
    """Of each view's model the slopes of the loss, in whole parts, summed over the rows that the
    other view's teacher is sure of; then the slope of the bias and the number of the rows."""
    out = []
    for k, (view, model) in enumerate(zip(views, models, strict=True)):
        other = 1 - k
        at = _bins(teachers[other].logits(views[other]))
        low, high = cuts[other]
        rows = np.flatnonzero((at <= low) | (at >= high))
        z = np.clip(model.scaled(view[rows]), -LARGE, LARGE)
        miss = 1 / (1 + np.exp(-np.clip(model.logits(view[rows]), -30, 30))) - (at[rows] >= high)
        own = np.rint(np.column_stack([z, np.ones(len(rows))]) * miss[:, None] * PART)
        out += [own.astype(np.int64).sum(axis=0), [len(rows)]]
    return np.concatenate(out)


def cotrained(views: list[np.ndarray], label: np.ndarray, summed, rounds: int = ROUNDS):
    """(weights of each view, bias) from labelled rows; ``summed(make)`` adds up the whole numbers
    that ``make(views)`` gives for any part of the unlabelled rows."""
    known = np.arange(len(label))
    if not len(known) or label.min() == label.max():
        return [np.zeros(v.shape[1]) for v in views], 50.0
    aside, train = known[::5], np.setdiff1d(known, known[::5])
    if len(np.unique(label[aside])) < 2 or len(np.unique(label[train])) < 2:
        aside = train = known
    truth = label[train].astype(float)
    models = [Linear(v[train], truth) for v in views]
    for _ in range(rounds):
        teachers = models
        counts = summed(lambda part, t=teachers: histograms(part, t)).reshape(2, BINS)
        if not counts.any():
            break
        cuts = [surest(c) for c in counts]
        for _ in range(PASSES):
            sums = summed(lambda part, t=teachers, c=cuts, m=models: slopes(part, t, c, m))
            first, second = np.split(sums, [views[0].shape[1] + 2])
            pulls = [PULL * p[:-1] / PART / max(p[-1], 1) for p in (first, second)]
            models = [
                m.pulled(v[train], truth, p) for m, v, p in zip(models, views, pulls, strict=True)
            ]
    # Each view's logits are calibrated on rows that no view learned from, then combined.
    own = [m.logits(v[aside]) for m, v in zip(models, views, strict=True)]
    calibrated = [Linear(o[:, None], label[aside]) for o in own]
    scaled = np.stack([c.logits(o[:, None]) for c, o in zip(calibrated, own, strict=True)], 1)
    joint, shift = Linear(scaled, label[aside]).folded()
    weights = []
    for model, scale, share in zip(models, calibrated, joint, strict=True):
        slope, start = scale.folded()
        inner, bias = model.folded()
        weights.append(inner * slope[0] * share)
        shift += share * (start + slope[0] * bias)
    return weights, float(shift)


def _matrices(batch) -> list[np.ndarray]:
    """Both views of stored rows."""
    kinds = (("content", np.float16, SLOTS + 3), ("metadata", np.float32, _KINDS + 2))
    return [
        np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(-1, n).astype(float)
        for name, kind, n in kinds
    ]


def stored_views(
    df: DataFrame, labels: DataFrame, id_col: str, text_col: str, labelled: int
) -> DataFrame:
    """(id, label, content, metadata) of all rows, label null but for the labelled sample."""
    wanted = [c for c in ("lang", "source", "n_chars") if c in df.columns]
    told = [F.col(f"`{c}`").cast("string" if c != "n_chars" else "long").alias(c) for c in wanted]
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), *told
    )
    known = labels.select(
        F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("label")
    ).dropna()
    known = known.groupBy("id").agg(F.min("label").alias("label"))
    known = known.join(rows.select("id"), "id", "left_semi")
    known = known.orderBy(F.xxhash64("id"), "id").limit(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            for text, meta in _views(batch, "text"):
                part = batch.slice(low, len(text))
                low += len(text)
                lists = [
                    pa.array([r.tobytes() for r in view], pa.binary())
                    for view in (text.astype(np.float16), meta.astype(np.float32))
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), *lists],
                    names=["id", "label", "content", "metadata"],
                )

    rows = rows.join(F.broadcast(known), "id", "left")
    return stored(
        rows.mapInArrow(run, "id long, label int, content binary, metadata binary"), "views"
    )


def fitted(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    labelled: int = LABELLED,
):
    """Model from a bounded sample of labelled rows and all rows without a label of it."""
    table = stored_views(df, labels, id_col, text_col, labelled)
    # One row of each id, however many rows repeat it.
    least = F.min(F.struct("label", "content", "metadata")).alias("row")
    rows = table.filter("label is not null").groupBy("id").agg(least).select("id", "row.*")
    rows = rows.toArrow().sort_by("id")
    order = np.random.default_rng(5).permutation(len(rows))
    label = np.clip(rows["label"].to_numpy()[order].astype(np.int64), 0, 1)
    text, meta = (view[order] for view in _matrices(rows))
    used = np.unique(_named(meta))
    pool = table.filter("label is null").select("content", "metadata")

    def summed(make) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                inner, outer = _matrices(batch)
                total = total + make([inner, _opened(outer, used)])
            if np.ndim(total):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(total))), pa.array(total)], names=["place", "value"]
                )

        sums = pool.mapInArrow(run, "place long, value long").groupBy("place").agg(F.sum("value"))
        sums = sums.toArrow().sort_by("place")
        if len(sums):
            return sums.column(1).to_numpy()
        nothing = [np.zeros((0, text.shape[1])), np.zeros((0, _KINDS + len(used)))]
        return make(nothing)

    (inner, outer), shift = cotrained([text, _opened(meta, used)], label, summed)
    weights = np.zeros(_KINDS + 2 * NAMES)
    weights[np.concatenate([np.arange(_KINDS), used])] = outer
    return (inner, weights), shift


def with_quality(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    out_col: str = "quality_score",
    **sample: int,
) -> DataFrame:
    """``df`` with the probability that a row is good (replaced if the column exists)."""
    shared = df.sparkSession.sparkContext.broadcast(fitted(df, labels, id_col, text_col, **sample))

    def make(batch: pa.RecordBatch):
        (inner, outer), bias = shared.value
        logits = [
            text @ inner + _metadata_logits(told, outer) + bias
            for text, told in _views(batch, text_col)
        ]
        logits = np.concatenate([*logits, np.zeros(0)])
        return [1 / (1 + np.exp(-np.clip(logits, -50, 50)))]

    return appended(df, make, {out_col: pa.float64()}, f"`{out_col}` double")


def good_documents(df: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """Rows of ``df`` scored ``keep_from`` or better, its columns unchanged."""
    name = unused(df, "quality")
    scored = with_quality(df, labels, out_col=name)
    return scored.filter(F.col(name) >= keep_from).drop(name)
