"""Language spans: scripts narrow the candidates, Viterbi labels the words.

A word is a run of letters of one script, at most ``LONGEST`` of them, so scripts without blanks
and mixed texts are cut as well; combining marks are passed over. Only languages that write at
least ``SHARE`` of their letters in a word's script are its candidates; a script that no learned
language writes says nothing. A word's score in a language is the log-likelihood of its
character n-grams (lower-cased, word ends marked) under the language's smoothed counts, averaged
over the n-gram lengths. Viterbi finds the labels of all words of a text with the greatest sum of
scores less ``SWITCH`` for every change of language. Scores are whole numbers (thousandths), so
sums are exact; ties stay in the language, else go to the first one by name.

Counts cover every text that may be learned from. N-grams are hashed to 2**BITS slots, so a task
returns, and the model holds, a bounded number of lines for each language; 512 KB a language are
sent to the tasks. Texts are labelled in steps, one word of each text of a group at a time, in
time and memory proportional to the text, whole texts of any length included.

Null texts and those without a letter are ``und`` with score 0, as is every text if nothing could
be learned. Rows with a null id are labelled but not learned from. Rows are judged one by one,
repeated ids included; an empty table gives an empty result; other columns are ignored, or kept
by ``with_spans``, which replaces a column ``spans``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.llm.common import chosen, text_slices

ORDERS, BITS = (2, 3, 4), 17
LONGEST = 32
SMOOTHING = 0.1
SHARE = 0.01
# What a change of language costs, in nats.
SWITCH = 12.0
UNKNOWN = "und"

# Whole scores per nat; and one below every sum that a word may have.
UNIT, NEVER = 1_000, -(1 << 24)

# N-grams scored at once, and words times languages labelled together.
WINDOWS, GROUP = 1 << 16, 1 << 21

# The main ranges of scripts, first and last code point.
SCRIPTS = (
    ("Latin", 0x0041, 0x024F),
    ("Greek", 0x0370, 0x03FF),
    ("Cyrillic", 0x0400, 0x052F),
    ("Armenian", 0x0530, 0x058F),
    ("Hebrew", 0x0590, 0x05FF),
    ("Arabic", 0x0600, 0x06FF),
    ("Arabic", 0x0750, 0x077F),
    ("Arabic", 0x08A0, 0x08FF),
    ("Devanagari", 0x0900, 0x097F),
    ("Bengali", 0x0980, 0x09FF),
    ("Gurmukhi", 0x0A00, 0x0A7F),
    ("Gujarati", 0x0A80, 0x0AFF),
    ("Oriya", 0x0B00, 0x0B7F),
    ("Tamil", 0x0B80, 0x0BFF),
    ("Telugu", 0x0C00, 0x0C7F),
    ("Kannada", 0x0C80, 0x0CFF),
    ("Malayalam", 0x0D00, 0x0D7F),
    ("Sinhala", 0x0D80, 0x0DFF),
    ("Thai", 0x0E00, 0x0E7F),
    ("Lao", 0x0E80, 0x0EFF),
    ("Tibetan", 0x0F00, 0x0FFF),
    ("Myanmar", 0x1000, 0x109F),
    ("Georgian", 0x10A0, 0x10FF),
    ("Hangul", 0x1100, 0x11FF),
    ("Ethiopic", 0x1200, 0x139F),
    ("Khmer", 0x1780, 0x17FF),
    ("Mongolian", 0x1800, 0x18AF),
    ("Latin", 0x1E00, 0x1EFF),
    ("Greek", 0x1F00, 0x1FFF),
    ("Kana", 0x3040, 0x30FF),
    ("Hangul", 0x3130, 0x318F),
    ("Han", 0x3400, 0x9FFF),
    ("Hangul", 0xAC00, 0xD7AF),
    ("Han", 0xF900, 0xFAFF),
    ("Latin", 0xFB00, 0xFB06),
    ("Hebrew", 0xFB1D, 0xFB4F),
    ("Arabic", 0xFB50, 0xFDFF),
    ("Arabic", 0xFE70, 0xFEFF),
    ("Latin", 0xFF21, 0xFF5A),
    ("Kana", 0xFF66, 0xFF9F),
    ("Han", 0x20000, 0x323AF),
)
NAMES = ("other", *dict.fromkeys(name for name, _, _ in SCRIPTS))

# Kinds of code points; a letter's kind is LETTER plus the number of its script.
NEITHER, MARK, LETTER = 0, 1, 2


@lru_cache(maxsize=1)
def code_points() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower-case form of every code point."""
    kind = np.zeros(0x110000, np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for code in [*range(0xD800), *range(0xE000, 0x33000), *range(0xE0000, 0xE0200)]:
        char = chr(code)
        if char.isalpha():
            kind[code] = LETTER
            if len(small := char.lower()) == 1:
                lower[code] = ord(small)
        elif unicodedata.category(char)[0] == "M":
            kind[code] = MARK
    for name, first, last in SCRIPTS:
        own = kind[first : last + 1]
        own[own >= LETTER] = LETTER + NAMES.index(name)
    return kind, lower


@dataclass
class Words:
    """The words of some texts: where each starts and ends in its text's characters, its text,
    letters, script, and the lower-cased letters with a zero before and after each word."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    stream: np.ndarray


def words_of(texts: list[str]) -> Words:
    kind, lower = code_points()
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    kinds = kind[codes]
    place = np.flatnonzero(kinds != MARK)
    kinds = kinds[place]
    letter = kinds >= LETTER
    before = np.concatenate([np.zeros(1, np.uint8), kinds[:-1]]) if len(kinds) else kinds
    runs = letter & (kinds != before)
    number = np.arange(len(kinds))
    since = number - np.maximum.accumulate(np.where(runs, number, 0)) if len(kinds) else number
    first = letter & (since % LONGEST == 0)
    at = place[letter]
    heads = np.flatnonzero(first[letter])  # of each word, among all letters
    sizes = np.diff(np.append(heads, len(at)))
    stream = np.zeros(len(at) + len(heads) + max(ORDERS), np.uint32)
    owner = np.repeat(np.arange(len(heads)), sizes)
    stream[np.arange(len(at)) + owner + 1] = lower[codes[at]]
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(length + 1)])
    start, end = at[heads], at[heads + sizes - 1] + 1
    text = np.searchsorted(begin, start, side="right") - 1
    script = kinds[letter][heads] - LETTER
    return Words(start - begin[text], end - begin[text], text, sizes, script, stream)


def slots_of(stream: np.ndarray, count: int) -> list[np.ndarray]:
    """For every n-gram length the slot of the n-gram at each of the first ``count`` places; one
    past the last slot where it would reach beyond its word."""
    out = []
    for size in ORDERS:
        mixed = np.full(count, size, np.uint32)
        inside = np.ones(count, bool)
        for k in range(size):
            own = stream[k : k + count]
            mixed = (mixed ^ own) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
            if 0 < k < size - 1:
                inside &= own != 0
        out.append(np.where(inside, mixed >> np.uint32(32 - BITS), 1 << BITS))
    return out


def texts_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[str]]]:
    for low, high, data, offsets in text_slices(batch):
        raw = data.tobytes()
        cut = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield low, high, [t.decode("utf-8", "replace") for t in cut]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, key, n): n-grams by slot, and letters by script under keys below zero."""
    grams: dict[str, np.ndarray] = {}
    letters: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for low, high, texts in texts_of(batch):
            words = words_of(texts)
            names, own = np.unique(langs[low:high], return_inverse=True)
            by_word = own[words.text]
            by_place = np.repeat(by_word, words.letters + 1)
            slots = slots_of(words.stream, len(by_place))
            for k, name in enumerate(names):
                if name not in grams:
                    grams[name] = np.zeros((1 << BITS) + 1, np.int64)
                    letters[name] = np.zeros(len(NAMES), np.int64)
                here = by_place == k
                for slot in slots:
                    grams[name] += np.bincount(slot[here], minlength=(1 << BITS) + 1)
                here = by_word == k
                letters[name] += np.bincount(
                    words.script[here], words.letters[here], len(NAMES)
                ).astype(np.int64)
    for name in grams:
        slot, script = np.flatnonzero(grams[name][:-1]), np.flatnonzero(letters[name])
        yield pa.RecordBatch.from_pydict(
            {
                "lang": [name] * (len(slot) + len(script)),
                "key": np.concatenate([slot, -1 - script]).astype(np.int32),
                "n": np.concatenate([grams[name][slot], letters[name][script]]),
            }
        )


@dataclass
class Model:
    """Languages by name, whole scores by slot and language (a line of zeros at the end), and the
    candidates of every script."""

    langs: list[str]
    scores: np.ndarray
    candidates: np.ndarray

    def words(self, words: Words) -> np.ndarray:
        """Score of every word in every language."""
        out = np.zeros((len(words.start), len(self.langs)), np.int64)
        head = np.concatenate([np.zeros(1, np.int64), np.cumsum(words.letters + 1)])
        low = 0
        while low < len(out):
            high = int(np.searchsorted(head, head[low] + WINDOWS, side="right")) - 1
            first, last = int(head[low]), int(head[high])
            piece = words.stream[first : last + max(ORDERS)]
            each = sum(self.scores[slot] for slot in slots_of(piece, last - first))
            out[low:high] = np.add.reduceat(each, head[low:high] - first, axis=0)
            low = high
        able = self.candidates[words.script]
        known = able.any(axis=1, keepdims=True)
        return np.where(able, out, np.where(known, NEVER, 0))


def learned(docs: DataFrame) -> Model:
    """Model of all rows of ``docs`` (lang, text). At most 2**BITS lines a language reach the
    driver."""
    counts = docs.filter("lang is not null").select("lang", "text")
    counts = counts.mapInArrow(_counts, "lang string, key int, n long")
    lines = counts.groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(lines.column("lang").to_pylist()))
    if not langs:
        return Model([], np.zeros((1, 0), np.int32), np.zeros((len(NAMES), 0), bool))
    row = np.searchsorted(np.array(langs, object), np.array(lines.column("lang").to_pylist(), object))
    key, n = (lines.column(c).to_numpy() for c in ("key", "n"))
    seen = np.zeros(((1 << BITS) + 1, len(langs)))
    seen[key[key >= 0], row[key >= 0]] = n[key >= 0]
    total = seen.sum(axis=0)
    chance = (seen[:-1] + SMOOTHING) / (total + SMOOTHING * (1 << BITS))
    scores = np.zeros(seen.shape, np.int32)
    scores[:-1] = np.rint(np.log(chance) * UNIT / len(ORDERS))
    letters = np.zeros((len(NAMES), len(langs)))
    letters[-1 - key[key < 0], row[key < 0]] = n[key < 0]
    return Model(langs, scores, letters >= np.maximum(SHARE * letters.sum(axis=0), 1))


def viterbi(scores: np.ndarray, first: np.ndarray, switch: int) -> np.ndarray:
    """Best label of every word; the words of a text stand together and begin at ``first``, which
    ends with the number of words. One step handles one word of every text that has it."""
    label = np.zeros(len(scores), np.int64)
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    steps = int(size.max(initial=0))
    # Texts that still have a word at each step.
    alive = np.searchsorted(-size, -np.arange(steps), side="left")
    back = np.zeros(scores.shape, np.int32)
    own = np.arange(scores.shape[1])
    total = np.zeros((len(size), scores.shape[1]), np.int64)
    for step in range(steps):
        m = alive[step]
        at = begin[:m] + step
        now = total[:m]
        if step:
            best = now.argmax(axis=1)
            change = now[np.arange(m), best][:, None] - switch
            stay = now >= change
            back[at] = np.where(stay, own, best[:, None])
            now = np.where(stay, now, change)
        total[:m] = now + scores[at]
    state = total.argmax(axis=1)
    for step in range(steps - 1, -1, -1):
        m = alive[step]
        at = begin[:m] + step
        label[at] = state[:m]
        state[:m] = back[at, state[:m]]
    return label


def _labelled(
    batch: pa.RecordBatch, model: Model, switch: float
) -> Iterator[tuple[int, int, Words, np.ndarray]]:
    """Row ranges of ``batch`` with their words and the words' labels."""
    cost = round(switch * UNIT)
    held: list[tuple[int, int, Words, np.ndarray]] = []

    def done():
        first, base = [np.zeros(1, np.int64)], 0
        for low, high, words, _ in held:
            first.append(base + np.searchsorted(words.text, np.arange(1, high - low + 1)))
            base += len(words.start)
        label = viterbi(np.concatenate([s for *_, s in held]), np.concatenate(first), cost)
        base = 0
        for low, high, words, _ in held:
            yield low, high, words, label[base : base + len(words.start)]
            base += len(words.start)
        held.clear()

    for low, high, texts in texts_of(batch):
        words = words_of(texts)
        held.append((low, high, words, model.words(words)))
        if sum(s.size for *_, s in held) >= GROUP:
            yield from done()
    if held:
        yield from done()


def labelled(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text): the language with most
    letters, and its share of them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        k = len(own.langs)
        for batch in batches:
            for low, high, words, label in _labelled(batch, own, switch) if k else ():
                cell = words.text * k + label
                letters = np.bincount(cell, words.letters, (high - low) * k).reshape(-1, k)
                total = letters.sum(axis=1)
                most = letters.argmax(axis=1)
                share = letters.max(axis=1) / np.maximum(total, 1)
                names = [own.langs[b] if n else UNKNOWN for b, n in zip(most, total, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id")[low:high],
                        "lang_pred": pa.array(names, pa.string()),
                        "score": share,
                    }
                )
            if not k:
                none = batch.num_rows
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id"),
                        "lang_pred": pa.array([UNKNOWN] * none, pa.string()),
                        "score": np.zeros(none),
                    }
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )


def with_spans(
    df: DataFrame, model: Model, text_col: str = "text", switch: float = SWITCH
) -> DataFrame:
    """``df`` with ``spans``: (start, end, lang) of every stretch of words of one language, in
    characters of the whole text, from the first letter to the end of the last."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = df.drop("spans")
    types = T.StructType.fromDDL("spans array<struct<start:int,end:int,lang:string>>").fields
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            text = batch.column(text_col).cast(pa.string())
            only = pa.RecordBatch.from_arrays([text], names=["text"])
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for low, _, words, label in _labelled(only, own, switch) if own.langs else ():
                cut = np.ones(len(label), bool)
                cut[1:] = (words.text[1:] != words.text[:-1]) | (label[1:] != label[:-1])
                head = np.flatnonzero(cut)
                tail = np.append(head[1:], len(label)) - 1 if len(head) else head
                for a, b in zip(head.tolist(), tail.tolist(), strict=True):
                    span = {
                        "start": int(words.start[a]),
                        "end": int(words.end[b]),
                        "lang": own.langs[label[a]],
                    }
                    out[low + int(words.text[a])].append(span)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, "spans"]
            )

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *types]))


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 5 == 0, F.lit(False))


def fitted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model of the rows with a language whose id is not held out."""
    doc_id = F.col(f"`{id_col}`")
    known = df.filter(doc_id.isNotNull() & ~held_out(doc_id)).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    return learned(known)


def predicted(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One line per row: doc_id, held_out, lang_pred, score."""
    model = fitted(df, id_col, text_col, lang_col)
    out = labelled(chosen(df, id_col, text_col), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
