"""Encoding texts into the ids of a SentencePiece BPE model, with byte spans, and back.

* Normalisation walks each text by the longest prefix in the model's compiled character map (a
  double-array trie) and records, for every normalised character, the byte of the text it
  comes from. A model without a map keeps characters as they are.
* The normalised text falls into units that no piece can cross (a run of blanks with the word
  after it). Each distinct unit of a batch is encoded once: short units merge their best pair of
  neighbours in step, until none has a pair left; a long unit has a heap of its pairs, so that
  its time grows as n log n. A worker remembers a bounded number of units and characters, and
  a remembered unit is used only where its characters are the same.
* Characters without a piece become byte pieces, or the unknown piece in models without them.
* Every piece is projected through the record to the bytes of the original text.

Nulls are empty texts; an empty text has only the begin and end ids. Very long texts, with or
without blanks, are encoded whole. Pairs of equal rank merge from the left. Repeated rows are
encoded one by one; an empty table gives no rows. Other columns are kept, those of an output's
name are replaced.
"""

from __future__ import annotations

from array import array
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as formats

from tillstar.llm.common import appended, mix

BLANK = "▁"
# Distinct units remembered by a worker, and characters encoded at once.
REMEMBERED = 400_000
REMEMBERED_CHARS = 8_000_000
SLICE_CHARS = 400_000
# Units with more characters than this merge by a heap of their own.
LONG = 200
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharacterMap:
    """The compiled map: a double-array trie from byte strings to replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], np.uint32).tolist()
        self.replacements = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, int]:
        """Bytes of the longest key at ``at`` and where its replacement lies; (0, 0) if none."""
        units = self.units
        unit, best = units[0], (0, 0)
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for k in range(at, len(text)):
            byte = text[k]
            node ^= byte
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                best = (k + 1 - at, units[node] & 0x7FFFFFFF)
        return best

    def replacement(self, place: int) -> str:
        end = self.replacements.index(b"\0", place)
        return self.replacements[place:end].decode()

    def mapped(self, text: str) -> tuple[str, np.ndarray]:
        """The mapped text and, per character of it and one more, the byte it comes from."""
        raw, out, origin, at = text.encode(), [], [], 0
        while at < len(raw):
            step, place = self.longest(raw, at)
            if step:
                new = self.replacement(place)
            else:
                first = raw[at]
                step = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                new = raw[at : at + step].decode()
            out.append(new)
            origin += [at] * len(new)
            at += step
        return "".join(out), np.array([*origin, len(raw)], np.int64)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _utf8_lengths(points: np.ndarray) -> np.ndarray:
    return 1 + (points > 0x7F) + (points > 0x7FF).astype(np.int64) + (points > 0xFFFF)


def _gather(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The slices ``values[first : first + count]`` one after the other."""
    shift = first - (np.cumsum(count) - count)
    return values.take(np.arange(int(count.sum())) + np.repeat(shift, count), mode="clip")


class Codec:
    """Tables of one model."""

    def __init__(self, model: bytes):
        proto = formats.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type != formats.TrainerSpec.BPE:
            raise ValueError("only BPE models are supported")
        rules = proto.normalizer_spec
        self.charsmap = rules.precompiled_charsmap
        self.map = CharacterMap(self.charsmap) if self.charsmap else None
        self.prefix, self.escape = rules.add_dummy_prefix, rules.escape_whitespaces
        self.squeeze = rules.remove_extra_whitespaces
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        kinds = [p.type for p in proto.pieces]
        if USER in kinds or self.suffix:
            raise ValueError("user-defined pieces and blanks as suffix are not supported")
        self.size = len(kinds)
        names = {p.piece: k for k, p in enumerate(proto.pieces)}
        self.bos = names[proto.trainer_spec.bos_piece]
        self.eos = names[proto.trainer_spec.eos_piece]
        self.unknown = kinds.index(UNKNOWN)
        self.bytes = np.full(256, self.unknown, np.int64)
        for k, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[3:5], 16)] = k
        self.fallback = bool(proto.trainer_spec.byte_fallback)
        words = {p.piece: k for k, p in enumerate(proto.pieces) if p.type in (NORMAL, UNUSED)}
        self.symbols = np.full(0x110000, -1, np.int32)
        extra = self.size
        for word in words:
            for char in word:
                if self.symbols[ord(char)] < 0:
                    self.symbols[ord(char)] = words.get(char, extra)
                    extra += char not in words
        # Characters without any symbol share one that never merges.
        self.symbols[self.symbols < 0] = extra
        self.base = extra + 1
        self._merges(words, [p.score for p in proto.pieces])
        inside = {c for w in words if len(w) > 1 for c in w}
        self.alone = np.ones(0x110000, bool)
        self.alone[[ord(c) for c in inside]] = False
        crossing = any(BLANK in w.lstrip(BLANK) for w in words)
        if crossing:
            raise ValueError("pieces across words are not supported")
        surfaces = []
        for k, p in enumerate(proto.pieces):
            if p.type == BYTE:
                surfaces.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == UNKNOWN:
                surfaces.append(proto.trainer_spec.unk_surface.encode())
            else:
                surfaces.append(b"" if p.type == CONTROL else p.piece.replace(BLANK, " ").encode())
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.surface_len = np.array([len(s) for s in surfaces], np.int64)
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len
        self.is_byte = np.array([k == BYTE for k in kinds])
        self.is_control = np.array([k == CONTROL for k in kinds])
        self.leads = np.array([p.piece.startswith(BLANK) for p in proto.pieces])
        self._forget()

    def tables(self) -> dict:
        """Everything the codec is made of, as plain values."""
        return {k: v for k, v in vars(self).items() if k not in ("map", "known", "joins")}

    @classmethod
    def of(cls, tables: dict) -> Codec:
        codec = cls.__new__(cls)
        vars(codec).update(tables)
        codec.map = CharacterMap(codec.charsmap) if codec.charsmap else None
        codec._forget()
        return codec

    def _merges(self, words: dict[str, int], scores: list[float]) -> None:
        """Every way two symbols join into a piece, ordered by key, and its rank."""
        best = {w: r for r, w in enumerate(sorted(words, key=lambda w: -scores[words[w]]))}
        rank_of = {}
        last, rank = None, -1
        for w in best:
            rank += scores[words[w]] != last
            last = scores[words[w]]
            rank_of[w] = rank
        keys, ranks, made = [], [], []
        for word, k in words.items():
            for cut in range(1, len(word)):
                halves = word[:cut], word[cut:]
                ids = [
                    int(self.symbols[ord(h)]) if len(h) == 1 else words.get(h) for h in halves
                ]
                if None not in ids:
                    keys.append(ids[0] * self.base + ids[1])
                    ranks.append(rank_of[word])
                    made.append(k)
        order = np.argsort(np.array(keys, np.int64))
        keys = np.array(keys, np.int64)[order]
        ranks, made = np.array(ranks, np.int64)[order], np.array(made, np.int64)[order]
        # Open addressing, at most half full.
        self.bits = int(np.ceil(np.log2(2 * len(keys) + 2)))
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.rank, self.made = np.zeros((2, 1 << self.bits), np.int64)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = keys[left[free]]
            self.rank[at[free]], self.made[at[free]] = ranks[left[free]], made[left[free]]
            missed = self.slots[at] != keys[left]
            left, at = left[missed], (at[missed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.joins: dict[int, tuple[int, int]] = {}
        self.ids, self.lens, self.starts = [np.zeros(0, np.int64)] * 3
        self.chars, self.sizes, self.places = [np.zeros(0, np.int64)] * 3
        self.points = np.zeros(0, np.uint32)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, slot) of each neighbouring pair in the merge table."""
        keys = left * self.base + right
        at = self._slot(keys)
        held = self.slots[at]
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            held[open_] = self.slots[at[open_]]
            open_ = open_[(held[open_] != keys[open_]) & (held[open_] >= 0)]
        return held == keys, at

    def _merged(self, symbols: np.ndarray, unit: np.ndarray):
        """Symbols of all units after every merge, with the characters each one spans.

        In each step every short unit that still has a pair joins its best one (least rank, then
        leftmost), as a queue of one unit would.
        """
        size, done = np.bincount(unit), []
        ends = np.cumsum(size)
        for high, n in zip(ends[size > LONG], size[size > LONG], strict=True):
            own, joined, chars = self._queued(symbols[high - n : high])
            done.append((own + (high - n), joined, chars))
        place = np.flatnonzero(size[unit] <= LONG)
        symbols, unit, chars = symbols[place], unit[place], np.ones(len(place), np.int64)
        while len(symbols):
            same = unit[1:] == unit[:-1]
            found, slot = self._pair(symbols[:-1], symbols[1:])
            pairs = np.flatnonzero(found & same)
            if not len(pairs):
                done.append((place, symbols, chars))
                break
            owner = unit[pairs]
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            weight = (self.rank[slot[pairs]] << 32) | pairs
            best = np.minimum.reduceat(weight, first) & 0xFFFFFFFF
            symbols = symbols.copy()
            symbols[best] = self.made[slot[best]]
            chars[best] += chars[best + 1]
            stay = np.ones(len(symbols), bool)
            stay[best + 1] = False
            # Units without a pair are finished and leave.
            alive = np.zeros(int(unit[-1]) + 1, bool)
            alive[owner] = True
            over = stay & ~alive[unit]
            done.append((place[over], symbols[over], chars[over]))
            go = stay & ~over
            symbols, unit, chars, place = symbols[go], unit[go], chars[go], place[go]
        place = np.concatenate([d[0] for d in done])
        order = np.argsort(place)
        symbols, chars = (np.concatenate([d[k] for d in done])[order] for k in (1, 2))
        return place[order], symbols, chars

    def _queued(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, symbols and characters of one long unit after every merge."""
        if not self.joins:
            used = np.flatnonzero(self.slots >= 0)
            values = zip(self.rank[used].tolist(), self.made[used].tolist(), strict=True)
            self.joins = dict(zip(self.slots[used].tolist(), values, strict=True))
        n, base, joins = len(symbols), self.base, self.joins
        found, slot = self._pair(symbols[:-1], symbols[1:])
        ranks = np.full(n, -1, np.int64)
        ranks[:-1][found] = self.rank[slot[found]]
        pairs = np.flatnonzero(found)
        heap = ((ranks[pairs] << 32) | pairs).tolist()
        heapify(heap)
        # ``rank`` is that of the pair a symbol forms with its right neighbour, -1 if none: an
        # entry of the heap with another rank is out of date.
        rank, held = array("q", ranks.tobytes()), array("q", symbols.tobytes())
        left, right = array("q", range(-1, n - 1)), array("q", range(1, n + 1))
        while heap:
            entry = heappop(heap)
            at = entry & 0xFFFFFFFF
            if rank[at] != entry >> 32:
                continue
            gone = right[at]
            held[at] = joins[held[at] * base + held[gone]][1]
            held[gone] = rank[gone] = rank[at] = -1
            after = right[at] = right[gone]
            if after < n:
                left[after] = at
                pair = joins.get(held[at] * base + held[after])
                if pair:
                    rank[at] = pair[0]
                    heappush(heap, pair[0] << 32 | at)
            before = left[at]
            if before >= 0:
                pair = joins.get(held[before] * base + held[at])
                rank[before] = pair[0] if pair else -1
                if pair:
                    heappush(heap, pair[0] << 32 | before)
        joined = np.frombuffer(held, np.int64)
        place = np.flatnonzero(joined >= 0)
        return place, joined[place], np.diff(place, append=n)

    def _encode_units(self, points: np.ndarray, first: np.ndarray, count: np.ndarray):
        """Ids of each unit (all after another), the characters each id covers, ids a unit."""
        chars = _gather(points, first, count).astype(np.int64)
        unit = np.repeat(np.arange(len(first)), count)
        place, symbols, spans = self._merged(self.symbols[chars].astype(np.int64), unit)
        owner = unit[place]
        plain = symbols < self.size
        if plain.all():
            return symbols, spans, np.bincount(owner, minlength=len(first))
        # What has no piece is always a single character.
        times = np.ones(len(symbols), np.int64)
        if self.fallback:
            times[~plain] = _utf8_lengths(chars[place[~plain]])
        ids, owner = np.repeat(symbols, times), np.repeat(owner, times)
        part = np.arange(len(ids)) - np.repeat(np.cumsum(times) - times, times)
        odd = np.flatnonzero(ids >= self.size)
        if self.fallback:
            raw = chars[place[~plain]].astype("<u4").tobytes().decode("utf-32-le").encode()
            ids[odd] = self.bytes[np.frombuffer(raw, np.uint8)]
        else:
            ids[odd] = self.unknown
        spans = np.where(part == np.repeat(times, times) - 1, np.repeat(spans, times), 0)
        return ids, spans, np.bincount(owner, minlength=len(first))

    def normalised(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Characters with blanks marked, and the byte each one (and the end) comes from."""
        if self.map is None:
            points = _code_points(text)
            origin = np.concatenate([[0], np.cumsum(_utf8_lengths(points))])
        else:
            mapped, origin = self.map.mapped(text)
            points = _code_points(mapped)
        blank = points == 0x20
        if self.squeeze and len(points):
            keep = ~blank
            keep[1:] |= blank[1:] & ~blank[:-1]
            keep[0] = not blank[0]
            if blank[-1]:
                tail = len(points) - np.argmin(blank[::-1]) if not blank.all() else 0
                keep[tail:] = False
            end = origin[np.flatnonzero(keep)[-1] + 1] if keep.any() else origin[-1]
            points, origin = points[keep], np.append(origin[:-1][keep], end)
            blank = points == 0x20
        if self.escape:
            points = np.where(blank, np.uint32(ord(BLANK)), points)
        if self.prefix and len(points):
            points = np.concatenate([np.array([ord(BLANK)], np.uint32), points])
            origin = np.concatenate([origin[:1], origin])
        return points, origin

    def encode(self, texts: list[str]):
        """(ids, ids per text, span starts, span ends) without begin and end ids."""
        parts = [self.normalised(t) for t in texts]
        sizes = np.array([len(p) for p, _ in parts], np.int64)
        points = np.concatenate([*[p for p, _ in parts], np.zeros(0, np.uint32)])
        empty = np.zeros(0, np.int64)
        if not len(points):
            return empty, np.zeros(len(texts), np.int64), empty, empty
        bounds = np.cumsum(sizes) - sizes
        marked, alone = points == ord(BLANK), self.alone[points]
        new = np.empty(len(points), bool)
        new[0] = True
        new[1:] = (marked[1:] & ~marked[:-1]) | alone[1:] | alone[:-1]
        new[bounds[sizes > 0]] = True
        first = np.flatnonzero(new)
        count = np.diff(first, append=len(points))
        key = self._unit_keys(points, first, count)
        kinds, example, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED or len(self.points) > REMEMBERED_CHARS:
            self._forget()
        held = [self.known.get(k, -1) for k in kinds.tolist()]
        held = np.array(held, np.int64)
        missing = np.flatnonzero(held < 0)
        if len(missing):
            pick = example[missing]
            held[missing] = self._remembered(points, first[pick], count[pick])
            self.known.update(zip(kinds[missing].tolist(), held[missing].tolist(), strict=True))
        own = held[which.ravel()]
        # Units that only share the key of a remembered one are encoded by themselves.
        other = _gather(self.points, self.places[own], count) != points
        other = np.logical_or.reduceat(other, first) | (self.sizes[own] != count)
        if other.any():
            own[other] = self._remembered(points, first[other], count[other])
        ids = _gather(self.ids, self.starts[own], self.lens[own])
        chars = _gather(self.chars, self.starts[own], self.lens[own])
        # Texts begin where units begin, so ids per text follow from characters.
        ends = np.cumsum(chars)
        before = np.concatenate([[0], np.cumsum(self.lens[own])])
        unit_of = np.searchsorted(first, np.append(bounds, len(points)))
        per_text = np.diff(before[unit_of])
        text = np.repeat(np.arange(len(texts)), per_text)
        origin = np.concatenate([o for _, o in parts])
        shift = np.cumsum(sizes + 1) - (sizes + 1) - bounds
        stop = origin[ends + shift[text]]
        lead = np.concatenate([[0], ends[:-1]])
        return ids, per_text, origin[lead + shift[text]], stop

    def _remembered(self, points, first, count) -> np.ndarray:
        """Where the results of newly encoded units are kept, next to their characters."""
        ids, chars, lens = self._encode_units(points, first, count)
        own = len(self.lens) + np.arange(len(first))
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(lens) - lens)
        self.places = np.append(self.places, len(self.points) + np.cumsum(count) - count)
        self.points = np.append(self.points, _gather(points, first, count))
        self.ids, self.chars = np.append(self.ids, ids), np.append(self.chars, chars)
        self.lens, self.sizes = np.append(self.lens, lens), np.append(self.sizes, count)
        return own

    def _unit_keys(self, points, first, count) -> np.ndarray:
        inside = np.arange(len(points)) - np.repeat(first, count)
        powers = np.cumprod(np.full(int(count.max()), 0x9E3779B97F4A7C15, np.uint64))
        value = mix(points.astype(np.uint64) + np.uint64(1)) * powers[inside]
        return mix(np.add.reduceat(value, first) + count.astype(np.uint64)).view(np.int64)

    def decode(self, ids: np.ndarray, per_text: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each run of ids; bytes that form no character become U+FFFD."""
        lens = self.surface_len[ids].copy()
        first = self.surface_at[ids].copy()
        bounds = np.cumsum(per_text) - per_text
        if self.prefix or self.squeeze:
            for text in np.flatnonzero(per_text):
                low = bounds[text]
                high = low + per_text[text]
                while low < high and self.is_control[ids[low]]:
                    low += 1
                while low < high and self.leads[ids[low]]:
                    lens[low] -= 1
                    first[low] += 1
                    if not self.squeeze or lens[low]:
                        break
                    low += 1
        raw = _gather(self.surface, first, lens)
        data = raw.tobytes()
        ends = np.concatenate([[0], np.cumsum(lens)])
        out = []
        for low, n in zip(bounds.tolist(), per_text.tolist(), strict=True):
            part = data[ends[low] : ends[low + n]]
            if self.is_byte[ids[low : low + n]].any():
                part = part.decode("utf-8", "surrogateescape")
                bad = [c for c in part if "\udc80" <= c <= "\udcff"]
                for c in set(bad):
                    part = part.replace(c, "�")
                part = part.encode()
            out.append(part)
        return out


def encoded_slices(batch: pa.RecordBatch, name: str, codec: Codec):
    """(texts, ids, ids per text, starts, ends) of parts of a batch."""
    texts = pc.fill_null(batch.column(name), "").to_pylist()
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size + len(texts[high]) <= SLICE_CHARS):
            size += len(texts[high])
            high += 1
        yield texts[low:high], *codec.encode(texts[low:high])
        low = high


def on_executors(df: DataFrame, model: bytes):
    """A function for tasks that gives the model's codec, built once for each task."""
    tables = df.sparkSession.sparkContext.broadcast(Codec(model).tables())
    built: list[Codec] = []

    def codec() -> Codec:
        if not built:
            built.append(Codec.of(tables.value))
        return built[0]

    return codec


def _listed(values: np.ndarray, per_text: np.ndarray, first, last, kind) -> pa.Array:
    """Lists of ``values``, each between its element of ``first`` and of ``last``."""
    ends = np.cumsum(per_text + 2)
    out = np.empty(len(values) + 2 * len(per_text), np.int64)
    inner = np.ones(len(out), bool)
    inner[ends - 1] = inner[ends - per_text - 2] = False
    out[inner], out[ends - per_text - 2], out[ends - 1] = values, first, last
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(out).cast(kind))


def _together(parts: list, columns: int, kinds: list[pa.DataType]) -> list[pa.Array]:
    """Arrays of several slices put together, column by column."""
    if not parts:
        return [pa.array([], k) for k in kinds]
    return [pa.concat_arrays([p[k] for p in parts]) for k in range(columns)]


def with_pieces(df: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """``df`` with piece_ids (begin and end included) and the byte spans piece_starts and
    piece_ends in the text; these columns are replaced if they exist.

    ``model`` is the content of a model file; its tables are broadcast, some 20 MB.
    """
    codec = on_executors(df, model)
    kinds = [pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def make(batch: pa.RecordBatch):
        own, parts = codec(), []
        for texts, ids, per_text, starts, ends in encoded_slices(batch, text_col, own):
            sizes = np.array([len(t.encode()) for t in texts])
            parts.append(
                [
                    _listed(ids, per_text, own.bos, own.eos, pa.int32()),
                    _listed(starts, per_text, 0, sizes, pa.int64()),
                    _listed(ends, per_text, 0, sizes, pa.int64()),
                ]
            )
        return _together(parts, 3, kinds)

    names = dict(zip(("piece_ids", "piece_starts", "piece_ends"), kinds, strict=True))
    types = "piece_ids array<int>, piece_starts array<bigint>, piece_ends array<bigint>"
    return appended(df, make, names, types)


def with_digests(df: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """``df`` with n_tokens (all ids), ids_sha256 (of the ids as little-endian unsigned 32-bit
    integers), decoded_sha256 (of the text decoded from the ids) and spanned_bytes (bytes of
    the text that the pieces' spans cover); these columns are replaced if they exist."""
    codec = on_executors(df, model)

    def make(batch: pa.RecordBatch):
        own, rows = codec(), []
        for _, ids, per_text, starts, ends in encoded_slices(batch, text_col, own):
            decoded = own.decode(ids, per_text)
            bounds = np.concatenate([[0], np.cumsum(per_text)])
            covered = np.concatenate([[0], np.cumsum(ends - starts)])
            covered = np.diff(covered[bounds])
            framed = _listed(ids, per_text, own.bos, own.eos, pa.uint32())
            raw = framed.values.to_numpy().astype("<u4").tobytes()
            at = framed.offsets.to_numpy() * 4
            for k, text in enumerate(decoded):
                marks = sha256(raw[at[k] : at[k + 1]]).hexdigest(), sha256(text).hexdigest()
                rows.append((int(per_text[k]) + 2, *marks, int(covered[k])))
        return list(zip(*rows, strict=True)) or [[]] * 4

    names = {
        "n_tokens": pa.int64(),
        "ids_sha256": pa.string(),
        "decoded_sha256": pa.string(),
        "spanned_bytes": pa.int64(),
    }
    types = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, spanned_bytes bigint"
    return appended(df, make, names, types)
