"""Removes every byte covered by a fixed-length string that also starts elsewhere.

The strings of ``length`` bytes are compared through suffix arrays of text shards.

* Each start gets the least hash of the 48-byte strings inside its window as its key. Equal
  windows have equal keys, so only keys that occur twice matter. A run of starts with one key
  is a context: the bytes its windows cover.
* Equal contexts are counted before they move on; a repeated one repeats as a whole.
* Contexts of one key that differ meet in a shard. The shard's suffix array comes from induced
  sorting: suffixes are classified, the substrings between leftmost smaller suffixes are
  named and sorted by recursion, the rest is induced from them. Permuted common prefixes then
  tell which starts share ``length`` bytes with a neighbour in the array.
* A key with more than ``key_contexts`` different contexts is not put into one shard: its
  windows are counted by a 128-bit digest instead, which aggregates before the shuffle.

Nulls and empty texts have nothing to remove. Matches never cross documents. Rows that repeat
an id are separate texts (told apart by their content; identical rows with one id count as
repeats of each other). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import chosen, mix, spread, stored, text_key, text_slices

LENGTH = 200
GRAM = 48
# Different contexts of one key that a single shard may hold.
KEY_CONTEXTS = 4_096
# Bytes of context text sorted at once inside a task.
SHARD_BYTES = 1 << 20


# --- suffix arrays -----------------------------------------------------------------------


def _places(value: np.ndarray) -> np.ndarray:
    """For each element the number of smaller ones, by counting."""
    count = np.bincount(value)
    return (np.cumsum(count) - count)[value]


def classified(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is smaller than the next one, and the leftmost of such runs."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    smaller = np.zeros(n, bool)
    rises = text[change] < text[change + 1]
    lengths = np.diff(change, prepend=-1)
    smaller[: int(lengths.sum())] = np.repeat(rises, lengths)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    return smaller, lms


def _runs_down(part: np.ndarray, ended: np.ndarray) -> np.ndarray:
    """Orders positions by what follows them up to the next ended position.

    ``part`` has each position's place by its own symbol, the end last; elements of one place
    are told apart by doubling: a part is joined with the part that follows it until it is alone
    in its place or runs into an ended position.
    """
    n, step = len(part) - 1, 1
    closed = ended.copy()
    size = np.bincount(part, minlength=n + 2)
    active = np.flatnonzero(~closed & (size[part] > 1))
    while len(active):
        follow = np.minimum(active + step, n)
        key = (part[active] << np.int64(31)) | part[follow]
        done = closed[follow]
        order = np.argsort(key)
        key = key[order]
        at = np.arange(len(key))
        new = np.append(True, key[1:] != key[:-1])
        old = np.append(True, (key[1:] >> 31) != (key[:-1] >> 31))
        shift = np.maximum.accumulate(np.where(new, at, 0))
        shift -= np.maximum.accumulate(np.where(old, at, 0))
        active, done = active[order], done[order]
        part[active] = (key >> 31) + shift
        closed[active[done]] = True
        alone = new & np.append(new[1:], True)
        active = active[~done & ~alone]
        step *= 2
    return part


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Rank of every suffix of ``text`` (non-negative integers, the end is smallest)."""
    n = len(text)
    if n < 2:
        return np.zeros(n, np.int64)
    smaller, lms = classified(text)
    plain = 2 * text.astype(np.int64) + smaller
    ended = np.zeros(n + 1, bool)
    ended[lms] = ended[n] = True
    symbol = np.zeros(n + 1, np.int64)
    symbol[:n] = 2 * plain + 1
    symbol[lms] += 1
    # Names: the substrings from one leftmost smaller suffix to the next, in their order.
    part = _runs_down(_places(symbol), ended)
    key = (plain[lms] << np.int64(31)) | part[lms + 1]
    order = np.argsort(key)
    names = np.zeros(len(lms), np.int64)
    names[order] = np.cumsum(np.append(0, key[order][1:] != key[order][:-1]))[: len(lms)]
    if len(lms) and int(names.max()) + 1 < len(lms):
        names = suffix_ranks(names)
    # The rest follows: suffixes run down to a leftmost smaller one whose rank is known.
    part = _places(symbol)
    first = np.empty(len(lms), np.int64)
    first[names] = lms
    within = np.arange(len(lms)) - _places(plain[first]) if len(lms) else first
    part[first] += within
    part = _runs_down(part, ended)
    before = np.empty(n + 1, np.int64)
    before[part] = np.arange(n + 1)
    before = before[before > 0] - 1
    kind = plain[before]
    kind = kind.astype(np.uint16) if int(kind.max()) < 1 << 16 else kind
    ranks = np.empty(n, np.int64)
    ranks[before[np.argsort(kind, kind="stable")]] = np.arange(n)
    return ranks


def permuted_common_prefixes(text: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """For each suffix the characters it shares with the one before it in suffix order.

    Compared directly only where the characters before the two differ; everywhere else the
    value is one less than its left neighbour's.
    """
    n = len(text)
    array = np.empty(n, np.int64)
    array[ranks] = np.arange(n)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    at = np.arange(n)
    direct = (before <= 0) | (at == 0)
    rest = ~direct
    direct[rest] = text[at[rest] - 1] != text[before[rest] - 1]
    left = at[direct & (before >= 0)]
    shared = np.zeros(n, np.int64)
    right, done, block = before[left], np.zeros(len(left), np.int64), 8
    active = np.arange(len(left))
    padded = np.concatenate([text, np.full(1, -1, text.dtype)])
    while len(active):
        block = min(2 * block, max(8, 4_000_000 // len(active)))
        span = np.arange(block)
        a = np.minimum(left[active, None] + done[active, None] + span, n)
        b = np.minimum(right[active, None] + done[active, None] + span, n)
        differ = (padded[a] != padded[b]) | (a == n) | (b == n)
        stop = differ.any(axis=1)
        done[active] += np.where(stop, differ.argmax(axis=1), block)
        active = active[~stop]
    shared[left] = done
    origin = np.maximum.accumulate(np.where(direct, at, 0))
    return np.maximum(shared[origin] - (at - origin), 0)


def repeated_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """Per context, which of its starts share ``length`` bytes with another start in the list."""
    lens = np.array([len(c) for c in contexts])
    text = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int64) + len(contexts)
    ends = np.cumsum(lens)
    text = np.insert(text, ends, np.arange(len(contexts)))  # a mark of its own ends each
    ranks = suffix_ranks(text)
    shared = permuted_common_prefixes(text, ranks)
    array = np.empty(len(text), np.int64)
    array[ranks] = np.arange(len(text))
    after = np.zeros(len(text), np.int64)
    after[array[:-1]] = shared[array[1:]]
    same = np.maximum(shared, after) >= length
    starts = np.concatenate([[0], ends[:-1]]) + np.arange(len(contexts))
    return [same[s : s + n - length + 1] for s, n in zip(starts, lens, strict=True)]


# --- keys and contexts -------------------------------------------------------------------


def _in_window(best: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` consecutive values, by doubling."""
    span = 1
    while 2 * span <= width:
        values = best(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return best(values[:-rest], values[rest:]) if rest else values


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position, non-negative."""
    n = len(data) - GRAM + 1
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    eight = np.ascontiguousarray(words).view(np.uint64).ravel()
    h = np.zeros(n, np.uint64)
    for k in range(0, GRAM, 8):
        h = (h ^ eight[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (mix(h) >> np.uint64(1)).view(np.int64)


def _window_keys(data: np.ndarray, offsets: np.ndarray, length: int):
    """Gram hashes, the key of each start (-1 if its window leaves the text), text of each byte."""
    grams = _grams(data)
    keys = _in_window(np.minimum, grams, length - GRAM + 1)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    last = offsets[1:]
    for low, high in zip(np.maximum(last - length + 1, offsets[:-1]), last, strict=True):
        keys[low:high] = -1
    return grams, keys, owner


def _deciding(data: np.ndarray, offsets: np.ndarray, length: int):
    """(text, key, times) of every gram that is the least of some window."""
    if len(data) < length:
        return [np.zeros(0, np.int64)] * 3
    grams, keys, owner = _window_keys(data, offsets, length)
    around = np.full(length - GRAM, -1)
    most = _in_window(np.maximum, np.concatenate([around, keys, around]), length - GRAM + 1)
    places = np.flatnonzero(most == grams)
    order = np.lexsort((grams[places], owner[places]))
    text, key = owner[places][order], grams[places][order]
    new = np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]))[: len(key)]
    first = np.flatnonzero(new)
    return text[first], key[first], np.diff(first, append=len(key))


def _runs(data: np.ndarray, offsets: np.ndarray, length: int):
    """(text, key, first start, starts) of every run of starts with one key."""
    if len(data) < length:
        return [np.zeros(0, np.int64)] * 4
    _, keys, owner = _window_keys(data, offsets, length)
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = keys[1:] != keys[:-1]
    new[offsets[offsets < len(keys)]] = True
    bound = np.flatnonzero(new)
    first, count = bound[:-1], np.diff(bound)
    real = keys[first] >= 0
    first, count = first[real], count[real]
    return owner[first], keys[first], first, count


def _keyed(length: int):
    schema = pa.schema([(c, pa.int64()) for c in ("key", "doc_id", "tag", "n")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column("doc_id"), batch.column("tag")
            for low, _, data, offsets in text_slices(batch):
                doc, key, times = _deciding(data, offsets, length)
                rows = pa.array(doc + low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), ids.take(rows), tags.take(rows), pa.array(times)],
                    schema=schema,
                )

    return run


def _digest(part: bytes) -> bytes:
    return blake2b(part, digest_size=16).digest()


def _contexts(length: int):
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "tag", "start", "key")]
        + [("context", pa.binary()), ("digest", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column("doc_id"), batch.column("tag")
            wanted = batch.column("keys")
            for low, high, data, offsets in text_slices(batch):
                doc, key, first, count = _runs(data, offsets, length)
                asked = wanted[low:high]
                owner = np.repeat(np.arange(high - low), asked.value_lengths().to_numpy())
                pairs = np.stack([owner, asked.flatten().to_numpy()], 1)
                have = np.stack([doc, key], 1)
                both = np.concatenate([pairs, have])
                code = np.unique(both, axis=0, return_inverse=True)[1].ravel()
                take = np.flatnonzero(np.isin(code[len(pairs) :], code[: len(pairs)]))
                raw = data.tobytes()
                parts = [raw[s : s + c + length - 1] for s, c in zip(first[take], count[take])]
                rows = pa.array(doc[take] + low)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(rows),
                        tags.take(rows),
                        pa.array(first[take] - offsets[doc[take]]),
                        pa.array(key[take]),
                        pa.array(parts, pa.binary()),
                        pa.array([_digest(p) for p in parts], pa.binary()),
                    ],
                    schema=schema,
                )

    return run


def _spans(flags: np.ndarray, length: int) -> list[int]:
    """Covered byte ranges (start, end, start, end, ...) for the flagged starts."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    gap = np.flatnonzero(np.diff(at) > length) + 1
    low = at[np.concatenate([[0], gap])]
    high = at[np.concatenate([gap - 1, [len(at) - 1]])] + length
    return np.stack([low, high], 1).ravel().tolist()


def _sharded(length: int):
    """Contexts sorted by key to the byte ranges that repeat in each."""
    schema = pa.schema([("digest", pa.binary()), ("spans", pa.list_(pa.int64()))])

    def shard(held):
        found = repeated_starts([c for _, c in held], length)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _ in held], pa.binary()),
                pa.array([_spans(f, length) for f in found], pa.list_(pa.int64())),
            ],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, current = [], 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "digest", "context")]
            for key, digest, context in zip(*columns, strict=True):
                if key != current and size >= SHARD_BYTES:
                    yield shard(held)
                    held, size = [], 0
                current = key
                held.append((digest, context))
                size += len(context)
        if held:
            yield shard(held)

    return run


def _windows(length: int):
    """Every window of a context as a digest, with its place."""
    schema = pa.schema(
        [("digest", pa.binary()), ("start", pa.int64()), ("n", pa.int64()), ("window", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("digest", "context", "n")]
            for digest, context, n in zip(*columns, strict=True):
                starts = range(len(context) - length + 1)
                windows = [_digest(context[s : s + length]) for s in starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([digest] * len(windows), pa.binary()),
                        pa.array(starts, pa.int64()),
                        pa.array([n] * len(windows), pa.int64()),
                        pa.array(windows, pa.binary()),
                    ],
                    schema=schema,
                )

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removes the joined ranges from each text and describes what is left."""
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")]
        + [("kept_sha256", pa.string()), ("kept", pa.binary())]
    )
    for batch in batches:
        spans = batch.column("spans").to_pylist()
        for low, high, data, offsets in text_slices(batch):
            rows = []
            for i in range(len(offsets) - 1):
                raw = data[offsets[i] : offsets[i + 1]]
                at, removed, runs, left = 0, 0, 0, []
                end = -1
                for s, e in sorted((p["s"], p["e"]) for p in spans[low + i] or ()):
                    if s > end:
                        runs += 1
                        left.append(raw[at:s].tobytes())
                        removed += e - s
                    elif e > end:
                        removed += e - end
                    end = max(end, e)
                    at = end
                left.append(raw[at:].tobytes())
                kept = b"".join(left)
                rows.append((len(raw), removed, runs, sha256(kept).hexdigest(), kept))
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, schema.field(k + 1).type) for k, c in enumerate(columns)]
            ids = batch.column("doc_id")[low:high]
            yield pa.RecordBatch.from_arrays([ids, *arrays], schema=schema)


def repeated_bytes_removed(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    key_contexts: int = KEY_CONTEXTS,
) -> DataFrame:
    """One line per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes)."""
    docs = chosen(df, id_col, text_col).withColumn("tag", text_key())
    keyed = docs.mapInArrow(_keyed(length), "key long, doc_id long, tag long, n long")
    again = keyed.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
    # Stored, so that the joins deal both sides anew and can split the rows of a hot key.
    again = stored(again, "keys")
    hits = keyed.drop("n").join(again, "key")
    hits = hits.groupBy("doc_id", "tag").agg(F.collect_set("key").alias("keys"))
    same_row = docs["doc_id"].eqNullSafe(hits["doc_id"]) & (docs["tag"] == hits["tag"])
    found = docs.join(hits, same_row).select(docs["doc_id"], docs["tag"], "text", "keys")
    found = found.mapInArrow(
        _contexts(length),
        "doc_id long, tag long, start long, key long, context binary, digest binary",
    )
    found = stored(found, "contexts")
    distinct = found.groupBy("key", "digest", "context").agg(F.count(F.lit(1)).alias("n"))
    distinct = stored(distinct, "distinct-contexts")
    per_key = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
    kinds = distinct.join(per_key, "key")
    spanned = F.array(F.lit(0).cast("long"), F.length("context").cast("long"))
    whole = kinds.filter("n > 1").select("digest", spanned.alias("spans"))
    shared = kinds.filter(f"kinds between 2 and {key_contexts} or kinds = 1 and n = 1")
    shared = shared.repartition(spread(df.sparkSession), "key").sortWithinPartitions("key")
    sorted_ = shared.select("key", "digest", "context").mapInArrow(
        _sharded(length), "digest binary, spans array<long>"
    )
    many = kinds.filter(f"kinds > {key_contexts}").select("digest", "context", "n")
    windows = many.mapInArrow(_windows(length), "digest binary, start long, n long, window binary")
    twice = windows.groupBy("window").agg(F.sum("n").alias("n")).filter("n > 1").select("window")
    counted = windows.join(twice, "window").select(
        "digest", F.array(F.col("start"), F.col("start") + length).alias("spans")
    )
    spans = whole.union(sorted_.filter("size(spans) > 0")).union(counted)
    spans = spans.groupBy("digest").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    spans = stored(spans, "spans")
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("spans") - 2, F.lit(2)),
        lambda i: F.struct(
            (F.col("start") + F.get("spans", i)).alias("s"),
            (F.col("start") + F.get("spans", i + 1)).alias("e"),
        ),
    )
    marks = found.drop("context", "key").join(spans, "digest").select(
        "doc_id", "tag", pairs.alias("spans")
    )
    marks = marks.groupBy("doc_id", "tag").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    same_row = docs["doc_id"].eqNullSafe(marks["doc_id"]) & (docs["tag"] == marks["tag"])
    out = docs.join(marks, same_row, "left").select(docs["doc_id"], "text", "spans")
    return out.mapInArrow(
        _cut,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
