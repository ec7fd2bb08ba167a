"""Toxicity scores from subword-bag embeddings, averaged into a linear softmax.

A text is the bag of character n-grams of its words, word ends marked, each hashed to a slot
with an embedding. The embeddings' average goes into a softmax over clean and toxic; slots and
softmax are trained together by gradient descent in numpy. A misspelling that was never seen
still shares most n-grams with the words it comes from.

Training uses at most ``sample`` labelled rows, chosen by a hash of the id; several labels of
one id count as toxic if any is. Scoring covers every whole text: as the model is linear after
the average, one number per slot is broadcast and summed (2**BITS numbers, a fixed size).

Nulls and empty texts have no n-grams and get the score of the bias alone. Without any usable
label, or with only one class, every score is the share of toxic labels (0 if none). Rows are
scored one by one, repeated ids included; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import chosen, text_slices
from tillstar.llm.subwords import gram_slots, padded

SIZES, BITS = (3, 4, 5), 18
SAMPLE = 4_000
DIMENSIONS, ROUNDS, RATE, DECAY = 8, 60, 0.2, 1e-6
THRESHOLD = 0.3
# Empty n-grams added to every bag: a text of a few words is no surer than these allow.
NEUTRAL = 400


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct slots and counts of each text."""
    schema = pa.schema([("toxic", pa.int64()), ("slots", pa.binary()), ("counts", pa.binary())])
    for batch in batches:
        for low, high, data, offsets in text_slices(batch):
            words, starts = padded(data, offsets)
            at, slot = (
                np.concatenate(x) for x in zip(*gram_slots(words, SIZES, BITS), strict=True)
            )
            text = np.searchsorted(starts, at, side="right") - 1
            inside = text < high - low
            key, count = np.unique((text[inside] << BITS) | slot[inside], return_counts=True)
            cuts = np.searchsorted(key >> BITS, np.arange(1, high - low))
            slots = np.split((key & ((1 << BITS) - 1)).astype(np.int32), cuts)
            counts = np.split(count.astype(np.float32), cuts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic")[low:high],
                    pa.array([s.tobytes() for s in slots], pa.binary()),
                    pa.array([c.tobytes() for c in counts], pa.binary()),
                ],
                schema=schema,
            )


class Model:
    """Bias and one number per slot: the two-class softmax's difference of logits."""

    def __init__(self, bias: float, slots: np.ndarray):
        self.bias, self.slots = bias, slots

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        words, starts = padded(data, offsets)
        total = np.zeros(len(words) + 1)
        count = np.zeros(len(words) + 1, np.int64)
        for at, slot in gram_slots(words, SIZES, BITS):
            total[at + 1] += self.slots[slot]
            count[at + 1] += 1
        total, count = np.cumsum(total)[starts], np.cumsum(count)[starts]
        mean = np.diff(total) / (np.diff(count) + NEUTRAL)
        return 1 / (1 + np.exp(-np.clip(self.bias + mean, -50, 50)))


def trained(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """Model of (label, slots, counts) rows by full-batch gradient descent (Adam)."""
    label = np.array([r[0] for r in rows], np.float64)
    if not len(rows) or label.min() == label.max() or not any(len(r[1]) for r in rows):
        share = label.mean() if len(rows) else 0.0
        odds = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model(float(odds), np.zeros(1 << BITS))
    total = np.array([r[2].sum() + NEUTRAL for r in rows], np.float32)
    seen = np.zeros(1 << BITS, np.int32)
    for _, slot, _ in rows:
        seen[slot] += 1
    used = np.flatnonzero(seen > (1 if (seen > 1).any() else 0))
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used))
    column = [place[slot] for _, slot, _ in rows]
    size = np.array([(c >= 0).sum() for c in column])
    weight = np.concatenate([n[c >= 0] / t for (_, _, n), c, t in zip(rows, column, total)])
    column = np.concatenate([c[c >= 0] for c in column])
    # The bags in both orders: by text, for the averages, and by slot, for the slopes.
    filled = np.flatnonzero(size)
    by_text = (np.cumsum(size) - size)[filled]
    order = np.argsort(column, kind="stable").astype(np.int32)
    text_by_slot = np.repeat(np.arange(len(rows), dtype=np.int32), size)[order]
    weight_by_slot = weight[order]
    by_slot = np.searchsorted(column[order], np.arange(len(used)))
    del order

    def averaged(slots: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows))
        out[filled] = np.add.reduceat(weight * slots.astype(np.float32)[column], by_text)
        return out

    rng = np.random.default_rng(11)
    inner = rng.normal(0, 0.1, (len(used), DIMENSIONS))
    outer = rng.normal(0, 0.5, (DIMENSIONS, 2))
    bias = np.zeros(2)
    parts = [inner, outer, bias]
    first = [np.zeros_like(p) for p in parts]
    second = [np.zeros_like(p) for p in parts]
    truth = np.stack([1 - label, label], 1)
    for step in range(1, ROUNDS + 1):
        # The average of embeddings times the softmax weights, one number per slot and class.
        logits = np.stack([averaged(s) for s in (inner @ outer).T], 1) + bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        miss = odds / odds.sum(axis=1, keepdims=True) - truth
        # Both classes' errors are opposite, so one sum over the bags serves both.
        error = miss[:, 1].astype(np.float32)
        pull = np.add.reduceat(weight_by_slot * error[text_by_slot], by_slot) / len(rows)
        both = np.stack([-pull, pull], 1)
        slopes = [both @ outer.T + DECAY * inner, inner.T @ both, miss.mean(axis=0)]
        for p, m, v, g in zip(parts, first, second, slopes, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            corrected = m / (1 - 0.9**step), v / (1 - 0.999**step)
            p -= RATE * corrected[0] / (np.sqrt(corrected[1]) + 1e-9)
    slots = np.zeros(1 << BITS)
    slots[used] = (inner @ outer) @ np.array([-1.0, 1.0])
    return Model(float(bias[1] - bias[0]), slots)


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model of at most ``sample`` rows of ``labels`` (doc_id, toxic) that have a text."""
    known = labels.select(
        F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("long")
    ).dropna()
    known = known.groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    rows = docs.join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    bags = rows.select("toxic", "text").mapInArrow(_bags, "toxic long, slots binary, counts binary")
    return trained(
        [
            (int(r.toxic > 0), np.frombuffer(r.slots, np.int32), np.frombuffer(r.counts, np.float32))
            for r in bags.collect()
        ]
    )


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.slots))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for low, high, data, offsets in text_slices(batch):
                scores = pa.array(own.scores(data, offsets))
                ids = batch.column("doc_id")[low:high]
                yield pa.RecordBatch.from_arrays([ids, scores], schema=schema)

    return docs.mapInArrow(run, "doc_id long, score double")


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One line per row: doc_id, held_out, score, predicted.

    Ids whose crc32 leaves 2 when divided by 4 are held out: their labels are never used.
    """
    docs = chosen(df, id_col, text_col)
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    learn = labels.filter(F.crc32(F.col("doc_id").cast("long").cast("string")) % 4 != 2)
    out = scored(docs, fitted(docs, learn, sample))
    return out.select(
        "doc_id",
        F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
